"""Scoring of (query, document) pairs and the orders that follow from it."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import fixed_values as fv
from ..functions import text as tx
from .ordering import QueryBatch, rank_groups, top_per_group

# (query text, document text) -> score
PairScorer = Callable[[Column, Column], Column]


def length_scorer(query: Column, document: Column) -> Column:
    """Characters of the document text; a stand-in with a known answer."""
    return F.length(document).cast("double")


def overlap_scorer(query: Column, document: Column) -> Column:
    """Share of the query's distinct tokens that the document text holds."""

    def share(words: Column) -> Column:
        found = F.size(F.array_intersect(words, tx.tokens(document)))
        return F.when(F.size(words) > 0, found / F.size(words)).otherwise(0.0)

    bound = F.transform(F.array(F.array_distinct(tx.tokens(query))), share)
    return F.get(bound, F.lit(0))


def model_scorer(load: Callable[[], object], batch_size: int = 32) -> PairScorer:
    """Scorer around an object with predict(list of pairs), loaded once per worker."""

    @F.pandas_udf(T.DoubleType())
    def score(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        model = load()
        for queries, documents in batches:
            pairs = list(zip(queries, documents))
            values: list[float] = []
            for at in range(0, len(pairs), batch_size):
                values.extend(float(x) for x in model.predict(pairs[at : at + batch_size]))
            if len(values) != len(pairs):
                raise ValueError("the scorer returned another number of scores than pairs")
            yield pd.Series(values, dtype="float64")

    return lambda query, document: score(query, document)


def score_pairs(
    candidates: DataFrame,
    queries: DataFrame,
    scorer: PairScorer,
    *,
    strategy: str = "title_task_body",
    max_chars: int = fv.RERANK_TEXT_CHARS,
) -> DataFrame:
    """Candidates with `pair_score`; every one is scored, none is cut before."""
    text = tx.rerank_text(strategy, max_chars)
    pairs = candidates.join(queries.select("query_id", F.col("text").alias("_query")), "query_id")
    return (
        pairs.withColumn("_document", text)
        .withColumn("pair_score", scorer(F.col("_query"), F.col("_document")))
        .drop("_query", "_document")
    )


def _cut(rows: DataFrame, group: Sequence[str], order: Sequence[Column], limit: int | None):
    if limit is None:
        return rank_groups(rows, group, order)
    return top_per_group(rows, group, order, limit)


def order_by_pair_score(
    scored: DataFrame, limit: int | None = None, group: Sequence[str] = ("query_id",)
) -> DataFrame:
    """New ranks by pair score; equal scores keep the incoming order."""
    order = [F.col("pair_score").desc(), F.col("_before").asc()]
    rows = scored.withColumnRenamed("rank", "_before")
    return _cut(rows, group, order, limit)


def rerank(
    candidates: DataFrame,
    queries: DataFrame | QueryBatch,
    scorer: PairScorer,
    *,
    top_k: int | None = None,
    strategy: str = "title_task_body",
    max_chars: int = fv.RERANK_TEXT_CHARS,
) -> DataFrame:
    """Candidates in scorer order with new score and rank.

    The cut is top_k if given, else each query's own top_k.
    """
    batch = queries if isinstance(queries, QueryBatch) else QueryBatch.of(queries)
    scored = score_pairs(candidates, batch.df, scorer, strategy=strategy, max_chars=max_chars)
    limit = batch.top_k if top_k is None else max(0, int(top_k))
    ranked = (
        order_by_pair_score(scored, limit)
        .drop("score", "_before")
        .withColumnRenamed("pair_score", "score")
    )
    return batch.cut(ranked) if top_k is None else ranked


def fuse_with_candidates(
    scored: DataFrame,
    *,
    weight: float = 1.0,
    k: int = fv.RRF_K,
    limit: int | None = None,
    group: Sequence[str] = ("query_id",),
) -> DataFrame:
    """1/(k+candidate rank) + weight/(k+scorer rank); ties keep candidate order.

    Adds pair_rank and final_score and renumbers rank; candidate_rank holds the
    incoming one.
    """
    ranked = order_by_pair_score(scored, None, group).withColumnRenamed("rank", "pair_rank")
    final = F.lit(1.0) / (F.lit(k) + F.col("_before")) + F.lit(float(weight)) / (
        F.lit(k) + F.col("pair_rank")
    )
    order = [F.col("final_score").desc(), F.col("_before").asc()]
    return _cut(ranked.withColumn("final_score", final), group, order, limit).withColumnRenamed(
        "_before", "candidate_rank"
    )


def fused_rerank(
    candidates: DataFrame,
    queries: DataFrame | QueryBatch,
    scorer: PairScorer,
    *,
    weight: float = 1.0,
    k: int = fv.RRF_K,
    final_k: int | None = None,
    strategy: str = "title_task_body",
    max_chars: int = fv.RERANK_TEXT_CHARS,
) -> DataFrame:
    batch = queries if isinstance(queries, QueryBatch) else QueryBatch.of(queries)
    scored = score_pairs(candidates, batch.df, scorer, strategy=strategy, max_chars=max_chars)
    limit = batch.top_k if final_k is None else max(0, int(final_k))
    fused = (
        fuse_with_candidates(scored, weight=weight, k=k, limit=limit)
        .drop("score", "pair_score", "pair_rank", "candidate_rank")
        .withColumnRenamed("final_score", "score")
    )
    return batch.cut(fused) if final_k is None else fused


def diagnostics(
    candidates: DataFrame,
    queries: DataFrame,
    scorer: PairScorer,
    qrels: DataFrame | None = None,
    *,
    strategy: str = "title_task_body",
    max_chars: int = fv.RERANK_TEXT_CHARS,
    preview_chars: int = fv.PREVIEW_CHARS,
) -> DataFrame:
    """One row per candidate: what reranking did to it, and whether it is relevant."""
    scored = score_pairs(candidates, queries, scorer, strategy=strategy, max_chars=max_chars)
    rows = order_by_pair_score(scored).select(
        "query_id",
        "model_id",
        F.coalesce("pipeline_tag", F.lit("")).alias("pipeline_tag"),
        F.col("_before").alias("hybrid_rank"),
        F.col("rank").alias("reranked_rank"),
        (F.col("_before") - F.col("rank")).alias("rank_change"),
        F.col("score").alias("rrf_score"),
        F.col("pair_score").alias("cross_encoder_score"),
        F.substring(tx.rerank_text(strategy, max_chars), 1, preview_chars).alias(
            "reranker_text_preview"
        ),
    )
    if qrels is None:
        return rows.withColumn("qrels_relevant", F.lit(False))
    relevant = qrels.select("query_id", "model_id", F.lit(True).alias("qrels_relevant")).distinct()
    return rows.join(relevant, ["query_id", "model_id"], "left").withColumn(
        "qrels_relevant", F.coalesce("qrels_relevant", F.lit(False))
    )


def payload_gaps(candidates: DataFrame) -> DataFrame:
    """Counts of candidates without the fields that reranking needs."""
    return candidates.agg(
        F.count("*").alias("candidates"),
        F.count_if(F.col("pipeline_tag").isNull()).alias("without_task"),
        F.count_if(F.col("tags").isNull()).alias("without_tags"),
    )


def check_payload(candidates: DataFrame) -> None:
    row = payload_gaps(candidates).first()
    if row.without_task or row.without_tags:
        raise ValueError(f"candidates lack reranking fields: {row.asDict()}")


def payload_preview(
    candidates: DataFrame, strategy: str = "title_task_body", max_chars: int = fv.RERANK_TEXT_CHARS
) -> DataFrame:
    """What the scorer will see of each query's first five candidates."""
    return candidates.where(F.col("rank") <= 5).select(
        "query_id",
        "rank",
        "model_id",
        "title",
        "pipeline_tag",
        F.slice("tags", 1, 5).alias("tags"),
        F.substring("body", 1, 160).alias("body"),
        F.substring(tx.rerank_text(strategy, max_chars), 1, 240).alias("scorer_text"),
    )
