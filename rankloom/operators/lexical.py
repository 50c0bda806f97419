"""BM25 over a collection that is cut by document, never by term.

All postings of a document sit in one partition. A score is then complete
inside its partition, each task keeps the best k documents of every query, and
only those few rows are shuffled. A frequent term, which holds a posting of
nearly every document, is spread over all partitions by construction.

There are two ways to the scores. While the batch's term weights fit a
broadcast, they go to the documents: a task scores each Arrow batch as one
sparse block and keeps the best rows, so nothing is shuffled but the result.
A larger batch is cut into groups of queries that fit, one scan of the packed
documents after the other, which leaves out what can't reach a query's best
(see pruning). Over a saved index, postings are joined with the weights and
summed by (query, document).
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Iterator
from dataclasses import asdict, dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import fixed_values as fv
from ..functions import text as tx
from ..session import settle_table, small_batches
from .dense import Best
from .ordering import QueryBatch, join_small, small_side, top_per_group
from .pruning import QueryTerms, best_documents

SCORE_DIGITS, MEAN_DIGITS = 9, 10
# Bounds of the broadcast way: query tokens, result rows a task holds, and cells
# of a block.
BLOCK_WORDS, BLOCK_RESULTS, BLOCK_CELLS = 2_000_000, 2_000_000, 4_000_000
# Weights and queries of a group of a larger batch, and the top_k up to which it is cut so.
GROUP_WEIGHTS, GROUP_QUERIES, GROUP_K = 500_000, 16_384, 10_000
# The same for groups whose scan leaves out what can't be among the best.
PRUNED_WEIGHTS, PRUNED_QUERIES, PRUNED_K = 2_000_000, 100_000, 100
# One document in EARLY is searched first, for a floor; documents of a task, early and later.
EARLY, EARLY_DOCS, LATER_DOCS = 16, 4_096, 16_384
# Postings in a bucket of a saved index on average, and buckets at most.
BUCKET_POSTINGS, MOST_BUCKETS = 2_000_000, 100_000
# Pairs of query and document that a task sums on average, and tasks at most.
PART_PAIRS, MOST_PARTS = 2_000_000, 4_096
# Share of all pairs of query and document beyond which a term is summed as a column of a matrix.
DENSE_SHARE = 0.005


@dataclass(frozen=True)
class CorpusStats:
    documents: int
    tokens: int
    vocabulary: int
    mean_idf: float

    @property
    def mean_length(self) -> float:
        return self.tokens / self.documents if self.documents else 0.0


def packed_documents(docs: DataFrame) -> DataFrame:
    """(pos, length, terms) of title and body; one row per document, no shuffle."""
    words = tx.tokens(F.concat_ws(" ", F.coalesce("title", F.lit("")), F.coalesce("body", F.lit(""))))
    return docs.select("pos", "title", "body").select("pos", words.alias("words")).select(
        "pos",
        F.size("words").cast("long").alias("length"),
        tx.term_counts(F.col("words")).alias("terms"),
    )


def _exploded(packed: DataFrame) -> DataFrame:
    """(pos, length, i, term, tf); a document without tokens has one row with nulls.

    The outer explode also keeps Spark from adding a pre-filter on the size of
    the array, which would tokenise every text a second time.
    """
    rows = packed.select("pos", "length", F.posexplode_outer("terms").alias("i", "t"))
    return rows.select(
        "pos", "length", "i", F.col("t.term").alias("term"), F.col("t.tf").alias("tf")
    )


def postings(packed: DataFrame) -> DataFrame:
    """(pos, length, term, tf)."""
    return _exploded(packed).drop("i").where(F.col("term").isNotNull())


def term_table(packed: DataFrame) -> DataFrame:
    """(term, df, cf, documents, low, high) by a map-side combined count.

    documents counts the documents whose first term this is, low and high bound
    the positions seen, marks joins the hashes of these documents' positions;
    together they describe the collection, so that one pass over the texts is
    enough. Empty documents make a row with a null term.
    """
    first = F.coalesce(F.col("i"), F.lit(0)) == 0
    return _exploded(packed).groupBy("term").agg(
        F.count("term").alias("df"),
        F.coalesce(F.sum(F.col("tf").cast("long")), F.lit(0)).alias("cf"),
        F.count_if(first).alias("documents"),
        F.min("pos").alias("low"),
        F.max("pos").alias("high"),
        F.bit_xor(F.when(first, _mark("pos"))).alias("marks"),
    )


def _settled(packed: DataFrame) -> DataFrame:
    """packed, written once, with `early` documents in a folder of their own."""
    return settle_table(packed.withColumn("early", F.pmod(F.xxhash64("pos"), F.lit(EARLY)) == 0), "early")


def _mark(pos: str) -> Column:
    return F.xxhash64(F.col(pos).cast("long"))


def corpus_stats(terms: DataFrame) -> CorpusStats:
    """Collection-wide numbers; two rows reach the driver.

    Positions that are not 0..n-1 raise ValueError.
    """
    row = terms.agg(
        F.coalesce(F.sum("documents"), F.lit(0)).alias("n"),
        F.min("low").alias("low"), F.max("high").alias("high"), F.bit_xor("marks").alias("marks"),
    ).first()
    if row.n and (row.low, row.high) != (0, row.n - 1):
        raise ValueError(
            f"pos must run from 0 to {row.n - 1}, found {row.low}..{row.high}; number the rows first"
        )
    # A position that is missing or there twice changes the joined hashes, as the count is right.
    if row.n and row.marks != terms.sparkSession.range(row.n).agg(F.bit_xor(_mark("id"))).first()[0]:
        raise ValueError(f"pos must hold each number from 0 to {row.n - 1} once; number the rows first")
    known = terms.where(F.col("term").isNotNull())
    sums = known.agg(
        F.sum("cf").alias("tokens"),
        F.count("*").alias("vocabulary"),
        F.avg(raw_idf(F.col("df"), row.n)).alias("mean_idf"),
    ).first()
    # Rounded, so that a rebuild with another order of summation scores the same.
    mean_idf = round(sums.mean_idf or 0.0, MEAN_DIGITS)
    return CorpusStats(row.n, sums.tokens or 0, sums.vocabulary, mean_idf)


def raw_idf(df: Column, documents: Column | int) -> Column:
    n = documents if isinstance(documents, Column) else F.lit(documents)
    return F.log(n - df + 0.5) - F.log(df + 0.5)


def with_idf(terms: DataFrame, stats: CorpusStats) -> DataFrame:
    raw = raw_idf(F.col("df"), stats.documents)
    floor = F.lit(fv.BM25_EPSILON * stats.mean_idf)
    known = terms.where(F.col("term").isNotNull())
    return known.withColumn("idf", F.when(raw < 0, floor).otherwise(raw))


@dataclass(frozen=True)
class TermWeights:
    """Weights of a query batch by term: start[t]..start[t+1] of query and weight."""

    vocabulary: pa.Array
    start: np.ndarray
    query: np.ndarray
    weight: np.ndarray

    def parts(self) -> tuple:
        return self.vocabulary, self.start, self.query, self.weight

    @classmethod
    def collected(cls, weights: DataFrame) -> tuple[pa.Array, "TermWeights"]:
        """The query ids, and the weights (query_id, term, weight), which the caller has checked to be few."""
        rows = weights.select("query_id", "term", "weight").orderBy("term", "query_id").toArrow()
        queries = pc.unique(rows.column("query_id"))
        vocabulary = pc.unique(rows.column("term"))
        term_no = pc.index_in(rows.column("term"), value_set=vocabulary).to_numpy()
        return queries, cls(
            vocabulary,
            np.searchsorted(term_no, np.arange(len(vocabulary) + 1)),
            pc.index_in(rows.column("query_id"), value_set=queries).to_numpy().astype(np.int64),
            rows.column("weight").to_numpy(),
        )

    def dense_part(self, n_queries: int, share: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Terms that many pairs of query and document share, and their weights as a matrix of queries x terms.

        `share`: of the documents, by term. The matrix has BLOCK_CELLS cells at most.
        """
        pairs = np.diff(self.start) / max(n_queries, 1) * share
        terms = np.argsort(-pairs, kind="stable")[: BLOCK_CELLS // max(n_queries, 1)]
        terms = terms[pairs[terms] >= DENSE_SHARE]
        matrix = np.zeros((n_queries, len(terms)))
        for i, t in enumerate(terms):
            low, high = self.start[t], self.start[t + 1]
            np.add.at(matrix[:, i], self.query[low:high], self.weight[low:high])
        return terms, matrix

    def blocks(self, batch: pa.RecordBatch, n_queries: int, step: int, mean_length: float):
        """(positions, queries x documents scores) of `step` documents at a time, fewer where many postings meet queries."""
        pos = batch.column("pos").to_numpy()
        length = batch.column("length").to_numpy()
        lists = batch.column("terms")
        entries = lists.flatten()
        sizes = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
        term = pc.index_in(entries.field("term"), value_set=self.vocabulary)
        term = pc.fill_null(term, -1).to_numpy()
        known = term >= 0
        doc = np.repeat(np.arange(len(pos)), sizes)[known]
        term, tf = term[known], entries.field("tf").to_numpy()[known]
        k1, b = fv.BM25_K1, fv.BM25_B
        rest = k1 * (1 - b + b * length / (mean_length or 1.0))
        gain = tf * (k1 + 1) / (tf + rest[doc])
        dense, matrix = self.dense_part(n_queries, np.bincount(term, minlength=len(self.vocabulary)) / max(len(pos), 1))
        column = np.full(len(self.vocabulary), -1)
        column[dense] = np.arange(len(dense))
        in_matrix = column[term] >= 0
        row, of, by = column[term[in_matrix]], doc[in_matrix], gain[in_matrix]
        term, doc, gain = term[~in_matrix], doc[~in_matrix], gain[~in_matrix]
        # Every other posting meets each query that has its term.
        met = np.concatenate([[0], np.cumsum(np.bincount(doc, weights=np.diff(self.start)[term], minlength=len(pos)))])
        first = 0
        while first < len(pos):
            last = min(first + step, len(pos), max(first + 1, int(np.searchsorted(met, met[first] + BLOCK_CELLS // 4, "right")) - 1))
            n = last - first
            low, high = np.searchsorted(doc, (first, last))
            t = term[low:high]
            times = self.start[t + 1] - self.start[t]
            posting = np.repeat(np.arange(low, high), times)
            at = np.arange(len(posting)) - np.repeat(np.cumsum(times) - times - self.start[t], times)
            cell = self.query[at] * n + (doc[posting] - first)
            sums = np.bincount(cell, weights=self.weight[at] * gain[posting], minlength=n_queries * n).reshape(n_queries, n)
            if len(dense):
                low, high = np.searchsorted(of, (first, last))
                gains = np.zeros((len(dense), n))
                gains[row[low:high], of[low:high] - first] = by[low:high]
                sums = sums + matrix @ gains
            yield pos[first:last], sums
            first = last


@dataclass(frozen=True)
class LexicalIndex:
    """Postings, term table and collection numbers; packed holds a row per document.

    Without packed rows (a saved index) the postings are a bucketed table, which
    Spark knows to be hashed by pos, so that scoring needs no shuffle for them.
    Where they are not (hashed is false), those of query terms are sent by pos.
    """

    entries: DataFrame
    terms: DataFrame
    stats: CorpusStats
    packed: DataFrame | None = None
    hashed: bool = True

    @classmethod
    def build(cls, docs: DataFrame, settled: bool = False) -> "LexicalIndex":
        """Index a collection for one job; `save_index` keeps it for many.

        docs: pos BIGINT dense from 0, title, body. settled: for a large batch;
        the packed documents are written, so that texts are read once, and
        searched by groups of queries.
        """
        packed = packed_documents(docs)
        if settled:
            packed = _settled(packed)
        terms = settle_table(term_table(packed))
        return cls(postings(packed), terms, corpus_stats(terms), packed)

    def query_terms(self, batch: QueryBatch) -> DataFrame:
        """(query_id, term, weight): idf times the token's count in the query.

        Terms unknown to the collection drop out; so do those of weight 0,
        which leave every score as it is.
        """
        words = (
            batch.df.select("query_id", F.explode(tx.term_counts(tx.tokens("text"))).alias("t"))
            .select("query_id", F.col("t.term").alias("term"), F.col("t.tf").alias("qtf"))
        )
        idf = with_idf(self.terms, self.stats).select("term", "idf").where(F.col("idf") != 0)
        return idf.join(small_side(words, batch.words), "term").select(
            "query_id", "term", (F.col("idf") * F.col("qtf")).alias("weight")
        )

    def scores(self, batch: QueryBatch) -> DataFrame:
        """(query_id, pos, score) of every document that shares a term with the query."""
        weights, n = self.query_terms(batch), batch.words
        wanted = small_side(weights.select("term").distinct(), n)
        matched = self.entries.join(wanted, "term", "left_semi")
        if self.packed is not None or not self.hashed:
            matched = self._by_document(matched, batch)
        k1, b = fv.BM25_K1, fv.BM25_B
        rest = k1 * (1 - b + b * F.col("length") / F.lit(self.stats.mean_length or 1.0))
        gain = F.col("weight") * F.col("tf") * (k1 + 1) / (F.col("tf") + rest)
        return (
            join_small(matched, weights, "term", n, F.col("pos"))
            .groupBy("query_id", "pos")
            .agg(F.sum(gain).alias("score"))
        )

    def _by_document(self, matched: DataFrame, batch: QueryBatch) -> DataFrame:
        """Postings hashed by pos, so that (query, pos) is summed where they are; a task sums PART_PAIRS of these on average."""
        pairs = self.stats.documents * (batch.rows or 0)
        parts = min(MOST_PARTS, -(-pairs // PART_PAIRS))
        usual = int(matched.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        return matched.repartition(parts, "pos") if parts > usual else matched.repartition("pos")

    def search(self, queries: DataFrame | QueryBatch) -> DataFrame:
        """(query_id, pos, score, rank): the best top_k documents of every query.

        Documents without a query term score 0 and fill up short lists in
        position order.
        """
        batch = queries if isinstance(queries, QueryBatch) else QueryBatch.of(queries)
        order = [F.round("score", SCORE_DIGITS).desc(), F.col("pos").asc()]
        blocks = self.packed is not None and self.stats.mean_idf > 0 and BLOCK_WORDS > 0
        if (
            blocks
            and "early" not in self.packed.columns
            and batch.rows is not None
            and (batch.words or BLOCK_WORDS + 1) <= BLOCK_WORDS
            and batch.rows * batch.top_k <= BLOCK_RESULTS
        ):
            scored = self._block_scores(batch.top_k)(self.packed, self.query_terms(batch))[0]
        elif blocks and batch.top_k <= GROUP_K:
            scored = self._group_scores(batch, order)
        else:
            scored = self.scores(batch)
        return self.ranked(batch, scored, top_per_group(scored, ["query_id"], order, batch.top_k).drop("rank"))

    def _group_scores(self, batch: QueryBatch, order: list[Column]) -> DataFrame:
        """(query_id, pos, score) of the best top_k documents of every query, group by group of queries.

        A group's weights are broadcast and its result is written before the
        next one's turn, so neither pairs of query and document nor the weights
        of all groups are held at once.
        """
        weights = settle_table(self.query_terms(batch))
        row = weights.agg(F.count("*").alias("n"), F.count_distinct(F.coalesce(F.xxhash64("query_id"), F.lit(0))).alias("ids")).first()
        pruned = batch.top_k <= PRUNED_K
        most, ids = (PRUNED_WEIGHTS, PRUNED_QUERIES) if pruned else (GROUP_WEIGHTS, GROUP_QUERIES)
        groups = max(1, -(-row.n // most), -(-row.ids // ids), -(-row.ids * batch.top_k // BLOCK_RESULTS))
        packed = self.packed if "early" in self.packed.columns else _settled(self.packed)
        scores, parts = self._block_scores(batch.top_k), []
        with small_batches(packed.sparkSession):
            for group in range(groups):
                asked = weights.where(F.pmod(F.xxhash64("query_id"), F.lit(groups)) == group)
                if pruned:
                    found, shared = self._pruned_scores(packed, asked, batch.top_k, order)
                else:
                    found, shared = scores(packed, asked)
                parts.append(settle_table(top_per_group(found, ["query_id"], order, batch.top_k).drop("rank")))
                shared.destroy()
        return reduce(DataFrame.unionByName, parts)

    def _pruned_scores(self, packed: DataFrame, rows: DataFrame, k: int, order: list[Column]) -> tuple[DataFrame, Broadcast]:
        """As _block_scores gives them, without those that can't be among a query's best k.

        The early documents are searched first. The k-th score of a query among
        them is a floor that the tasks of the other documents start from.
        """
        ids, weights = TermWeights.collected(rows)
        term = np.repeat(np.arange(len(weights.vocabulary)), np.diff(weights.start))
        queries = QueryTerms.of(ids, weights.vocabulary, weights.query, term, weights.weight)
        context, mean_length = packed.sparkSession.sparkContext, self.stats.mean_length
        kind = rows.schema["query_id"].dataType.simpleString()

        def scan(docs: DataFrame, shared: Broadcast, share: int, each: int) -> DataFrame:
            def scores(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
                query, pos, score = best_documents(batches, shared.value, k, mean_length)
                yield pa.RecordBatch.from_arrays([query, pa.array(pos), pa.array(score)], ["query_id", "pos", "score"])

            tasks, cores = max(1, -(-self.stats.documents // (share * each))), context.defaultParallelism
            docs = docs.select("pos", "length", "terms").coalesce(tasks if share > 1 else -(-tasks // cores) * cores)
            return docs.mapInArrow(scores, f"query_id {kind}, pos bigint, score double")

        shared = context.broadcast(queries)
        early = settle_table(top_per_group(scan(packed.where("early"), shared, EARLY, EARLY_DOCS), ["query_id"], order, k))
        shared.destroy()
        floor = early.where(F.col("rank") == k).select("query_id", F.round("score", SCORE_DIGITS).alias("floor")).toArrow()
        shared = context.broadcast(queries.with_floor(floor.column("query_id"), floor.column("floor").to_numpy()))
        later = scan(packed.where("not early"), shared, 1, LATER_DOCS)
        return early.drop("rank").unionByName(later), shared

    def ranked(self, batch: QueryBatch, scored: DataFrame, best: DataFrame) -> DataFrame:
        """The best rows of each query, short lists filled up; scored: all that was scored, for what fills."""
        order = [F.round("score", SCORE_DIGITS).desc(), F.col("pos").asc()]
        # One exchange by query serves the merge and the final ranks.
        filled = (
            best.unionByName(self._zero_rows(batch, scored))
            .repartition("query_id")
            .groupBy("query_id", "pos")
            .agg(F.sum("score").alias("score"))
        )
        return batch.cut(top_per_group(filled, ["query_id"], order, batch.top_k))

    def _block_scores(self, k: int) -> Callable[[DataFrame, DataFrame], tuple[DataFrame, Broadcast]]:
        """A function of packed documents and weights to (query_id, pos, score), each task's best k documents of
        every query, and to the broadcast weights.

        The weights are collected, which the caller has checked to be few.
        """
        mean_length = self.stats.mean_length

        def scores(packed: DataFrame, rows: DataFrame) -> tuple[DataFrame, Broadcast]:
            queries, weights = TermWeights.collected(rows)
            shared = packed.sparkSession.sparkContext.broadcast((queries, *weights.parts()))
            step = max(1, BLOCK_CELLS // 4 // max(len(queries), 1))

            def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
                ids, *parts = shared.value
                if k == 0 or len(ids) == 0:
                    return
                known, best = TermWeights(*parts), Best(len(ids), k)
                for part in batches:
                    for pos, cells in known.blocks(part, len(ids), step, mean_length):
                        order = np.argsort(pos, kind="stable")
                        if (order[1:] < order[:-1]).any():
                            pos, cells = pos[order], cells[:, order]
                        # Only queries with a cell that reaches their k-th score when rounded.
                        some = np.flatnonzero(cells.max(axis=1) >= best.score[:, -1] - 10.0**-SCORE_DIGITS)
                        cells = cells[some]
                        best.add(some, pos, np.where(cells > 0, np.round(cells, SCORE_DIGITS), -np.inf), cells)
                query, pos, score = best.rows()
                yield pa.RecordBatch.from_arrays([ids.take(pa.array(query)), pa.array(pos), pa.array(score)], ["query_id", "pos", "score"])

            kind = rows.schema["query_id"].dataType.simpleString()
            return packed.mapInArrow(scan, f"query_id {kind}, pos bigint, score double"), shared

        return scores

    def _zero_rows(self, batch: QueryBatch, scored: DataFrame) -> DataFrame:
        """Zero-score candidates: enough low positions to fill any list.

        With a positive mean idf all matches score above 0, so a list that is
        short has fewer than top_k matches and 2 * top_k positions hold all the
        fill it can need. Otherwise matches may rank below unmatched documents
        and the candidates reach as far as the query's matches are many.
        """
        k = batch.top_k
        everyone = batch.df.select("query_id")
        if self.stats.mean_idf >= 0:
            spans = everyone.withColumn("reach", F.lit(2 * k))
        else:
            matches = scored.groupBy("query_id").agg(F.count("*").alias("n"))
            spans = everyone.join(matches, "query_id", "left").select(
                "query_id", (F.coalesce("n", F.lit(0)) + k).alias("reach")
            )
        reach = F.least(F.col("reach").cast("long"), F.lit(self.stats.documents).cast("long"))
        block = 4096
        blocks = spans.select("query_id", reach.alias("reach")).where("reach > 0").select(
            "query_id", "reach", F.explode(F.expr(f"sequence(0L, (reach - 1) div {block})")).alias("i")
        )
        zero = blocks.select(
            "query_id",
            F.explode(
                F.expr(f"sequence(i * {block}, least((i + 1) * {block}, reach) - 1)")
            ).alias("pos"),
            F.lit(0.0).alias("score"),
        )
        if self.stats.mean_idf >= 0:
            return zero
        # A match below 0 must not be lifted: only unmatched positions count.
        return zero.join(scored.select("query_id", "pos"), ["query_id", "pos"], "left_anti")


def _table_name(path: str, buckets: int) -> str:
    """Catalog name of a saved index: one for each place and number of buckets."""
    return "lexical_" + hashlib.sha256(f"{path.rstrip('/')} {buckets}".encode()).hexdigest()[:32]


def save_index(docs: DataFrame, path: str, buckets: int = 8, body_limit: int | None = None) -> CorpusStats:
    """Write postings bucketed by document and sorted by term, and the rest beside.

    Inside a bucket the sort lets a read skip row groups without query terms.
    There are `buckets` at least, and as many as BUCKET_POSTINGS ask for: a
    bucket is one task, in writing and in scoring.
    """
    spark = docs.sparkSession
    term_table(packed_documents(docs)).write.mode("overwrite").parquet(f"{path}/terms")
    terms = spark.read.parquet(f"{path}/terms")
    stats = corpus_stats(terms)
    held = terms.agg(F.coalesce(F.sum("df"), F.lit(0))).first()[0]
    buckets = max(buckets, min(MOST_BUCKETS, -(-held // BUCKET_POSTINGS)))
    table = _table_name(path, buckets)
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    (
        postings(packed_documents(docs))
        .repartition(buckets, "pos")
        .write.bucketBy(buckets, "pos")
        .sortBy("term")
        .option("path", f"{path}/postings")
        .mode("overwrite")
        .saveAsTable(table)
    )
    manifest = {**asdict(stats), "buckets": buckets, "format": 1, "body_limit": body_limit or 0,
                "fields": "title,body"}
    spark.createDataFrame([(json.dumps(manifest),)], "value string").coalesce(1).write.mode(
        "overwrite"
    ).text(f"{path}/manifest")
    return stats


def load_index(
    spark: SparkSession,
    path: str,
    *,
    documents: int | None = None,
    body_limit: int | None = None,
    format_version: int = 1,
) -> LexicalIndex:
    """Open a saved index; a manifest that does not fit raises ValueError."""
    found = json.loads(spark.read.text(f"{path}/manifest").first().value)
    expected = {"format": format_version, "body_limit": body_limit or 0, "fields": "title,body"}
    if documents is not None:
        expected["documents"] = documents
    wrong = {k: (found.get(k), v) for k, v in expected.items() if found.get(k) != v}
    if wrong:
        raise ValueError(f"saved index does not fit (found, expected): {wrong}")
    table = _table_name(path, found["buckets"])
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table} (pos BIGINT, length BIGINT, term STRING, tf INT) "
        f"USING parquet CLUSTERED BY (pos) SORTED BY (term) INTO {found['buckets']} BUCKETS "
        f"LOCATION '{path}/postings'"
    )
    spark.catalog.refreshTable(table)
    stats = CorpusStats(
        found["documents"], found["tokens"], found["vocabulary"], found["mean_idf"]
    )
    return LexicalIndex(
        spark.table(table),
        spark.read.parquet(f"{path}/terms"),
        stats,
    )


def open_or_build(docs: DataFrame, path: str, **expected) -> tuple[LexicalIndex, bool]:
    """Reuse the saved index if its manifest fits, else build it anew."""
    spark = docs.sparkSession
    try:
        index = load_index(spark, path, documents=docs.count(), **expected)
        return index, True
    except Exception as problem:  # a missing or unfit index is rebuilt
        if not isinstance(problem, ValueError) and "PATH_NOT_FOUND" not in str(problem):
            raise
    save_index(docs, path, body_limit=expected.get("body_limit"))
    return load_index(spark, path, **expected), False
