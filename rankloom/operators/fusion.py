"""Reciprocal rank fusion and comparisons between rankings."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import fixed_values as fv
from .ordering import rank_groups, top_per_group


def fuse(
    rankings: Sequence[DataFrame],
    *,
    k: int = fv.RRF_K,
    top_k: int | None = None,
    doc: str = "pos",
    group: Sequence[str] = ("query_id",),
    payload: Sequence[str] = (),
) -> DataFrame:
    """(group, doc, score, rank[, payload]) from any number of rankings.

    A ranking is cut to its own top_k and has the group columns, doc, rank and optionally place (its row
    order). A document counts once per ranking, at its first place; a rank of
    0 or less is replaced by the place. Equal scores keep the order in which
    documents were first seen; payload columns come from that first sight.
    """
    if k < 0:
        raise ValueError("k must not be negative")
    parts = []
    for number, ranking in enumerate(rankings):
        place = F.col("place") if "place" in ranking.columns else F.col("rank")
        rank = F.when(F.col("rank") > 0, F.col("rank")).otherwise(place)
        parts.append(
            ranking.select(
                *group,
                F.col(doc),
                F.struct(
                    F.lit(number).alias("source"),
                    place.cast("long").alias("place"),
                    rank.cast("long").alias("rank"),
                    *payload,
                ).alias("seen"),
            )
        )
    rows = reduce(DataFrame.unionByName, parts)
    once = rows.groupBy(*group, doc, "seen.source").agg(
        F.min_by("seen", F.col("seen.place")).alias("seen")
    )
    gains = F.transform(
        F.sort_array(F.collect_list(F.struct("seen.source", "seen.rank"))),
        lambda s: F.lit(1.0) / (F.lit(k) + s["rank"]),
    )
    merged = once.groupBy(*group, doc).agg(
        F.aggregate(gains, F.lit(0.0), lambda acc, x: acc + x).alias("score"),
        F.min_by("seen", F.struct("seen.source", "seen.place")).alias("first"),
    )
    order = [F.col("score").desc(), F.col("first.source"), F.col("first.place"), F.col(doc)]
    if top_k is None:
        ranked = rank_groups(merged, group, order)
    else:
        ranked = top_per_group(merged, group, order, top_k)
    return ranked.select(*group, doc, "score", "rank", *[F.col(f"first.{c}").alias(c) for c in payload])


def overlap(left: DataFrame, right: DataFrame, k: int = 20, doc: str = "pos") -> DataFrame:
    """(query_id, shared, jaccard) of the first k of two rankings; no rows give 0."""
    a = left.where(F.col("rank") <= k).select("query_id", doc, F.lit(1).alias("a"))
    b = right.where(F.col("rank") <= k).select("query_id", doc, F.lit(1).alias("b"))
    return (
        a.join(b, ["query_id", doc], "full")
        .groupBy("query_id")
        .agg(F.count_if(F.col("a").isNotNull() & F.col("b").isNotNull()).alias("shared"),
             F.count("*").alias("either"))
        .select("query_id", "shared", (F.col("shared") / F.col("either")).alias("jaccard"))
    )


def head_by_system(systems: dict[str, DataFrame], k: int = 5) -> DataFrame:
    """The first k rows of every named ranking under one another."""
    heads = [
        df.where(F.col("rank") <= k).withColumn("system", F.lit(name)) for name, df in systems.items()
    ]
    return reduce(DataFrame.unionByName, heads)


def rank_comparison(
    fused: DataFrame, lexical: DataFrame, dense: DataFrame, k: int = 20, doc: str = "pos"
) -> DataFrame:
    """How the two source ranks led to each of the first k fused ranks."""
    keys = ["query_id", doc]
    lex = lexical.select(*keys, F.col("rank").alias("bm25_rank"), F.col("score").alias("bm25_score"))
    den = dense.select(*keys, F.col("rank").alias("dense_rank"), F.col("score").alias("cosine_score"))
    return (
        fused.where(F.col("rank") <= k)
        .select(*keys, F.col("rank").alias("rrf_rank"), F.col("score").alias("rrf_score"))
        .join(lex, keys, "left")
        .join(den, keys, "left")
    )


def rerank_comparison(before: DataFrame, after: DataFrame, doc: str = "pos") -> DataFrame:
    """Rank and score of every reranked candidate before and after."""
    keys = ["query_id", doc]
    old = before.select(*keys, F.col("rank").alias("hybrid_rank"), F.col("score").alias("rrf_score"))
    new = after.select(
        *keys, F.col("rank").alias("reranked_rank"), F.col("score").alias("cross_encoder_score")
    )
    return old.join(new, keys).withColumn(
        "rank_change", F.col("hybrid_rank") - F.col("reranked_rank")
    )
