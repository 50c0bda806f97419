"""Search flows: queries in, ranked rows out, one plan from end to end."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import fixed_values as fv
from ..functions import text as tx
from ..operators import dense
from ..operators.encode import encoder_queries
from ..operators.fusion import fuse
from ..operators.lexical import LexicalIndex
from ..operators.ordering import BROADCAST_ROWS, QueryBatch

# A retriever takes a batch and gives (query_id, pos, score, rank).
Retriever = Callable[[QueryBatch], DataFrame]
Ranker = Callable[[DataFrame, QueryBatch], DataFrame]


def lexical_retriever(index: LexicalIndex) -> Retriever:
    return index.search


def dense_retriever(
    vectors: DataFrame,
    dim: int,
    *,
    metric: str = "inner_product",
    encode: Callable[[DataFrame], DataFrame] | None = None,
    encoder_name: str = fv.DEFAULT_ENCODERS[0],
) -> Retriever:
    """Exact dense search; without `encode` the batch brings its vectors."""

    def run(batch: QueryBatch) -> DataFrame:
        if encode is not None:
            rows = encode(encoder_queries(batch.df, encoder_name))
            batch = replace(batch, df=rows)
        return dense.search(vectors, batch, dim=dim, metric=metric)

    return run


def hybrid_retriever(lexical: Retriever, dense_side: Retriever, k: int = fv.RRF_K) -> Retriever:
    """Both retrievers at the batch's top_k, fused and cut to it."""

    def run(batch: QueryBatch) -> DataFrame:
        fused = fuse([lexical(batch), dense_side(batch)], k=k, top_k=batch.top_k)
        return batch.cut(fused)

    return run


def with_payload(results: DataFrame, docs: DataFrame, batch: QueryBatch) -> DataFrame:
    """Look documents up for the final rows only.

    The result side has at most queries x top_k rows; within the limit it is
    broadcast, so that the documents are not shuffled.
    """
    bounded = batch.rows is not None and batch.rows * max(batch.top_k, 1) <= BROADCAST_ROWS
    hits = F.broadcast(results) if bounded else results
    return docs.join(hits, "pos").withColumn("snippet", tx.snippet("body"))


def with_metadata(results: DataFrame, rows: DataFrame | None = None, metric: str | None = None) -> DataFrame:
    """Looked-up results with all of their document's metadata in `metadata`, a map<string, variant>.

    The document's entries, then those of `rows` (pos and a map<string, variant>
    `row_metadata`), which win; body and tags where neither has them; and for a
    dense search its metric and direction, which win over all.
    """
    merged = F.col("metadata")
    if rows is not None:
        results = results.join(rows.select("pos", "row_metadata"), "pos", "left")
        none = F.create_map().cast("map<string, variant>")
        merged = tx.merge_payload(F.coalesce("row_metadata", none), "metadata")
    own = F.create_map(F.lit("body"), F.col("body").cast("variant"), F.lit("tags"), F.to_variant_object("tags"))
    results = results.withColumn("metadata", merged).withColumn("metadata", tx.merge_payload("metadata", own))
    if metric is not None:
        better = "higher_is_better" if dense.higher_is_better(metric) else "lower_is_better"
        extras = {"dense_metric": metric, "score_direction": better}
        results = results.withColumn("metadata", tx.with_extras(F.col("metadata"), extras, "variant"))
    return results.drop("row_metadata")


def score_direction(results: DataFrame, metric: str) -> DataFrame:
    better = "higher_is_better" if dense.higher_is_better(metric) else "lower_is_better"
    return results.withColumn("dense_metric", F.lit(metric)).withColumn(
        "score_direction", F.lit(better)
    )


def find(
    queries: DataFrame | QueryBatch,
    docs: DataFrame,
    retriever: Retriever,
    ranker: Ranker | None = None,
) -> DataFrame:
    """Retrieve, look up, and rank if there is a ranker."""
    batch = queries if isinstance(queries, QueryBatch) else QueryBatch.of(queries)
    candidates = with_payload(retriever(batch), docs, batch)
    return candidates if ranker is None else ranker(candidates, batch)


def shown(results: DataFrame, score_name: str = "score") -> DataFrame:
    """Rank, id, named score and a short one-line snippet."""
    return results.select(
        "query_id",
        "rank",
        "model_id",
        F.col("score").alias(score_name),
        tx.shown_snippet("snippet").alias("snippet"),
    )
