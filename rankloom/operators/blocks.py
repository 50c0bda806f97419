"""BM25 from a saved index whose blocks are skipped by bounds on their scores.

Documents stand in blocks of neighbouring positions. A small table holds the
largest contribution that a term makes in a block, so a query's weights bound
what any document of a block can score. The blocks of highest bound give a
query its first k scores; of the others only those are read whose bound reaches
the k-th of these scores, so the result is that of a full search. Postings are
partitioned by ranges of blocks, and dynamic partition pruning leaves the
folders of skipped ranges unread.

Documents are sent once, by range of blocks, and made into postings where they
arrive. In a search the postings of query terms are sent by block, and a block
gives each of its queries no more than the best top_k rows: a pair of query and
document is no row.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import asdict, dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import fixed_values as fv
from ..session import settle_table
from .lexical import SCORE_DIGITS, CorpusStats, LexicalIndex, TermWeights, corpus_stats, packed_documents, term_table
from .ordering import BROADCAST_ROWS, QueryBatch, small_side, top_per_group

FORMAT = 1
POSTINGS = "block bigint, term string, entries array<struct<pos: bigint, gain: double>>, slice int"
BOUNDS = "term string, block bigint, slice int, best double"
#: Documents in a block, and folders that the postings are spread over.
BLOCK, SLICES = 128, 256
#: Blocks of highest bound that give a query its first scores.
FIRST_BLOCKS = 4
#: What rounding may add to a sum of contributions.
SLACK = 1e-6
#: Queries that meet a block at once, and meetings of a posting and a query that are summed at once.
QUERIES, MEETINGS = 16_384, 1_000_000


@dataclass(frozen=True)
class BlockIndex:
    """postings: slice, block, term, entries (pos, gain); bounds: term, block, best; terms and stats as LexicalIndex has them."""

    postings: DataFrame
    bounds: DataFrame
    whole: LexicalIndex
    block: int
    slices: int

    @classmethod
    def save(cls, docs: DataFrame, path: str, block: int = BLOCK, slices: int = SLICES) -> None:
        """Write the index of docs (pos dense from 0, title, body); a block's postings of a term are one row."""
        if block < 1 or slices < 1:
            raise ValueError("block and slices must be positive")
        spark = docs.sparkSession
        packed = settle_table(packed_documents(docs))
        term_table(packed).write.mode("overwrite").parquet(f"{path}/terms")
        stats = corpus_stats(spark.read.parquet(f"{path}/terms"))
        k1, b = fv.BM25_K1, fv.BM25_B
        rest = k1 * (1 - b + b * F.col("length") / F.lit(stats.mean_length or 1.0))
        gain = F.col("tf") * (k1 + 1) / (F.col("tf") + rest)
        blocks = max(1, -(-stats.documents // block))
        # All of a slice is in one task, so nothing is sent again.
        sliced = packed.withColumn("slice", F.expr(f"cast(pos div {block} * {slices} div {blocks} as int)")).repartition(slices, "slice")
        rows = sliced.select("slice", F.expr(f"pos div {block}").alias("block"), "pos", "length", F.explode("terms").alias("t"))
        rows = rows.select("slice", "block", "pos", "length", "t.*").select("slice", "block", "term", F.struct("pos", gain.alias("gain")).alias("e"))
        rows = rows.groupBy("slice", "block", "term").agg(F.sort_array(F.collect_list("e")).alias("entries"))
        rows = rows.select("block", "term", "entries", "slice").sortWithinPartitions("slice", "block", "term")
        rows.write.partitionBy("slice").mode("overwrite").parquet(f"{path}/postings")
        best = F.array_max(F.transform("entries", lambda e: e["gain"]))
        written = spark.read.schema(POSTINGS).parquet(f"{path}/postings").select("term", "block", "slice", best.alias("best"))
        written.write.mode("overwrite").parquet(f"{path}/bounds")
        manifest = {**asdict(stats), "format": FORMAT, "block": block, "slices": slices}
        spark.createDataFrame([(json.dumps(manifest),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/manifest")

    @classmethod
    def load(cls, spark: SparkSession, path: str, documents: int | None = None) -> "BlockIndex":
        """Open a saved index; another format or number of documents raises ValueError."""
        found = json.loads(spark.read.text(f"{path}/manifest").first().value)
        if found["format"] != FORMAT or documents not in (None, found["documents"]):
            raise ValueError(f"saved index has format {found['format']} and {found['documents']} documents")
        stats = CorpusStats(found["documents"], found["tokens"], found["vocabulary"], found["mean_idf"])
        rows = spark.read.schema(POSTINGS).parquet(f"{path}/postings")
        whole = LexicalIndex(rows, spark.read.parquet(f"{path}/terms"), stats)
        return cls(rows, spark.read.schema(BOUNDS).parquet(f"{path}/bounds"), whole, found["block"], found["slices"])

    def search(self, queries: DataFrame | QueryBatch) -> DataFrame:
        """(query_id, pos, score, rank), as LexicalIndex.search."""
        return self.search_with_report(queries)[0]

    def search_with_report(self, queries: DataFrame | QueryBatch) -> tuple[DataFrame, DataFrame]:
        """The result, and per query (query_id, met, read): blocks with a query term, and blocks whose postings were read."""
        batch = queries if isinstance(queries, QueryBatch) else QueryBatch.of(queries)
        weights = settle_table(self.whole.query_terms(batch))
        bounded = self.bounds.join(small_side(weights, batch.words), "term")
        # A term of negative weight may be absent, so it bounds nothing.
        bounded = settle_table(
            bounded.groupBy("query_id", "block", "slice").agg(F.sum(F.greatest("weight", F.lit(0.0)) * F.col("best")).alias("bound"))
        )
        order = [F.col("bound").desc(), F.col("block").asc()]
        first = settle_table(top_per_group(bounded, ["query_id"], order, FIRST_BLOCKS))
        begun = settle_table(self._scored(first, weights, batch))
        best = [F.round("score", SCORE_DIGITS).desc(), F.col("pos").asc()]
        left = bounded.join(first.select("query_id", "block"), ["query_id", "block"], "left_anti")
        if self.whole.stats.mean_idf >= 0:
            # Ranks go up to the largest top_k of the batch; a query with fewer scores has no floor.
            kth = top_per_group(begun, ["query_id"], best, batch.top_k).where(F.col("rank") == batch.top_k)
            floors = kth.select("query_id", F.col("score").alias("floor"))
            left = left.join(floors, "query_id", "left").where(F.col("floor").isNull() | (F.col("bound") + SLACK >= F.col("floor")))
        left = settle_table(left.select("query_id", "block", "slice"))
        scored = begun.unionByName(self._scored(left, weights, batch))
        if self.whole.stats.mean_idf < 0:
            scored = settle_table(scored)
        top = top_per_group(scored, ["query_id"], best, batch.top_k).drop("rank")
        read = first.select("query_id").unionByName(left.select("query_id")).groupBy("query_id").agg(F.count("*").alias("read"))
        met = bounded.groupBy("query_id").agg(F.count("*").alias("met"))
        return self.whole.ranked(batch, scored, top), met.join(read, "query_id")

    def _scored(self, pairs: DataFrame, weights: DataFrame, batch: QueryBatch) -> DataFrame:
        """(query_id, pos, score) of the documents in these pairs of query and block that hold a term of the query.

        Of a pair's documents the best top_k; all, where those without a term can rank above them.
        """
        slices = F.broadcast(pairs.where("slice >= 0").select(F.col("slice").alias("_slice")).distinct())  # at most SLICES rows
        near = self.postings.join(slices, F.col("slice") == F.col("_slice"), "left_semi")
        if batch.rows is None or batch.words is None:
            wanted = pairs.select("query_id", "block").join(weights, "query_id")
            hits = near.join(wanted, ["block", "term"]).select("query_id", "weight", F.explode("entries").alias("e"))
            return hits.groupBy("query_id", F.col("e.pos").alias("pos")).agg(F.sum(F.col("weight") * F.col("e.gain")).alias("score"))
        blocks = -(-self.whole.stats.documents // self.block)
        near = near.join(F.broadcast(weights.select("term").distinct()), "term", "left_semi")
        near = near.join(small_side(pairs.select("block").distinct(), blocks, BROADCAST_ROWS), "block", "left_semi")
        # A large batch meets a block in parts.
        parts = max(1, -(-batch.rows // QUERIES))
        near = near.select("block", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"), "term", "entries")
        asked = pairs.select("block", F.pmod(F.xxhash64("query_id"), F.lit(parts)).cast("int").alias("part"), "query_id")
        ids, known = TermWeights.collected(weights)
        held = pairs.sparkSession.sparkContext.broadcast((ids, *known.parts()))
        kind = weights.schema["query_id"].dataType.simpleString()
        score = _block_scorer(held, batch.top_k if self.whole.stats.mean_idf >= 0 else None)
        return near.groupBy("block", "part").cogroup(asked.groupBy("block", "part")).applyInArrow(score, f"query_id {kind}, pos bigint, score double")


def _block_scorer(held: Broadcast, k: int | None) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """From a block's postings and the queries that want it to (query_id, pos, score), k rows a query at most."""

    def score(near: pa.Table, asked: pa.Table) -> pa.Table:
        ids, *parts = held.value
        weights = TermWeights(*parts)
        wanted = pc.unique(pc.drop_null(pc.index_in(asked.column("query_id"), value_set=ids))).to_numpy()
        lists = near.column("entries").combine_chunks()
        entries = lists.flatten()
        pos, doc = np.unique(entries.field("pos").to_numpy(), return_inverse=True)
        gain, row = entries.field("gain").to_numpy(), np.full(len(ids), -1)
        row[wanted] = np.arange(len(wanted))
        term = pc.index_in(near.column("term"), value_set=weights.vocabulary).to_numpy()
        term = np.repeat(term, pc.list_value_length(lists).to_numpy())
        sums, met = np.zeros(len(wanted) * len(pos)), np.zeros(len(wanted) * len(pos), bool)
        times = weights.start[term + 1] - weights.start[term]
        ends, low = np.cumsum(times), 0
        while low < len(term):
            done = ends[low - 1] if low else 0
            high = max(low + 1, int(np.searchsorted(ends, done + MEETINGS, "right")))
            n = times[low:high]
            posting = np.repeat(np.arange(low, high), n)
            at = np.arange(len(posting)) - np.repeat(np.cumsum(n) - n - weights.start[term[low:high]], n)
            of = row[weights.query[at]]
            posting, at, of = posting[of >= 0], at[of >= 0], of[of >= 0]
            cell = of * len(pos) + doc[posting]
            sums += np.bincount(cell, weights=weights.weight[at] * gain[posting], minlength=len(sums))
            met[cell] = True
            low = high
        sums, met = sums.reshape(-1, len(pos)), met.reshape(-1, len(pos))
        if k is not None and k < len(pos) and len(wanted):
            # Ascending positions and a stable sort: ties go to the lower one.
            order = np.argsort(np.where(met, -np.round(sums, SCORE_DIGITS), np.inf), axis=1, kind="stable")[:, :k]
            best = np.zeros_like(met)
            np.put_along_axis(best, order, True, axis=1)
            met &= best
        query, place = np.nonzero(met)
        return pa.table({"query_id": ids.take(pa.array(wanted[query])), "pos": pos[place], "score": sums[query, place]})

    return score
