"""Precision, recall, MRR and nDCG of ranked results, for any number of systems at once."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import fixed_values as fv


def first_per_model(results: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Each model id once, at its first rank, renumbered; a group has at most top_k rows."""
    once = results.groupBy(*keys, "model_id").agg(F.min("rank").alias("rank"))
    place = F.row_number().over(Window.partitionBy(*keys).orderBy("rank", "model_id"))
    return once.withColumn("place", place).drop("rank")


def _ideal_gain(k: int, relevant: Column) -> Column:
    """DCG of min(k, relevant) relevant documents at the top."""
    sums, total = [], 0.0
    for position in range(1, k + 1):
        total += 1.0 / math.log2(position + 1)
        sums.append(F.lit(total))
    return F.get(F.array(*sums), F.least(F.lit(k), relevant).cast("int") - 1)


def per_query_metrics(
    queries: DataFrame,
    results: DataFrame,
    qrels: DataFrame,
    *,
    cutoffs: Sequence[int] = fv.METRIC_CUTOFFS,
    by: Sequence[str] = (),
) -> DataFrame:
    """One row per query (and `by` columns) with mrr and precision, recall, ndcg per cutoff.

    queries names every evaluated (by..., query_id), so that one without results
    counts as 0. results: by..., query_id, model_id, rank. qrels: query_id,
    model_id.
    """
    if any(k <= 0 for k in cutoffs):
        raise ValueError("cutoffs must be positive")
    keys = [*by, "query_id"]
    judged = qrels.select("query_id", "model_id").distinct()
    totals = judged.groupBy("query_id").agg(F.count("*").alias("relevant"))
    hits = first_per_model(results.select(*keys, "model_id", "rank"), keys).join(
        judged, ["query_id", "model_id"]
    )
    place, gain = F.col("place"), F.lit(1.0) / F.log2(F.col("place") + 1)
    sums = [F.min("place").alias("first")]
    for k in cutoffs:
        sums.append(F.count_if(place <= k).alias(f"hits_{k}"))
        sums.append(F.sum(F.when(place <= k, gain)).alias(f"dcg_{k}"))
    rows = (
        queries.select(*keys)
        .join(totals, "query_id", "left")
        .join(hits.groupBy(*keys).agg(*sums), keys, "left")
    )
    relevant = F.coalesce("relevant", F.lit(0))
    out = [F.coalesce(F.lit(1.0) / F.col("first"), F.lit(0.0)).alias("mrr")]
    for k in cutoffs:
        found = F.coalesce(f"hits_{k}", F.lit(0))
        share = F.when(relevant > 0, found / relevant)
        ndcg = F.when(relevant > 0, F.col(f"dcg_{k}") / _ideal_gain(k, relevant))
        out += [
            (found / F.lit(k)).alias(f"precision@{k}"),
            F.coalesce(share, F.lit(0.0)).alias(f"recall@{k}"),
            F.coalesce(ndcg, F.lit(0.0)).alias(f"ndcg@{k}"),
        ]
    return rows.select(*keys, relevant.alias("relevant"), *out)


def metric_names(cutoffs: Sequence[int] = fv.METRIC_CUTOFFS) -> list[str]:
    return ["mrr"] + [f"{m}@{k}" for k in cutoffs for m in ("precision", "recall", "ndcg")]


def to_long(per_query: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, metric, value)."""
    names = [c for c in per_query.columns if c == "mrr" or "@" in c]
    pairs = F.array(*[F.struct(F.lit(n).alias("metric"), F.col(f"`{n}`").alias("value")) for n in names])
    return per_query.select(*keys, F.explode(pairs).alias("p")).select(*keys, "p.metric", "p.value")


def summary(per_query: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """(by, metric, value): the mean over all queries; no queries, no rows."""
    long = to_long(per_query, [*by, "query_id"])
    return long.groupBy(*by, "metric").agg(F.avg("value").alias("value"))


def compact_table(per_query: DataFrame, by: Sequence[str] = ("system",)) -> DataFrame:
    """One row per system with the four headline means."""
    return per_query.groupBy(*by).agg(
        F.avg("mrr").alias("mrr"),
        F.avg("`precision@5`").alias("precision_at_5"),
        F.avg("`recall@20`").alias("recall_at_20"),
        F.avg("`ndcg@10`").alias("ndcg_at_10"),
    )


def best_row(table: DataFrame, ties: Sequence[str]) -> DataFrame:
    """The row with the highest nDCG@10, then MRR, then the first by `ties`."""
    # Rounded, so that the order of summation cannot decide between equal means.
    means = [F.round("ndcg_at_10", 9).desc(), F.round("mrr", 9).desc()]
    return table.orderBy(*means, *ties).limit(1)


def per_query_details(queries: DataFrame, results: DataFrame, qrels: DataFrame) -> DataFrame:
    """(query_id, retrieved_model_ids, ranks) for the report; lists hold at most top_k ids."""
    found = first_per_model(results.select("query_id", "model_id", "rank"), ["query_id"])
    judged = qrels.select("query_id", "model_id", F.lit(True).alias("hit")).distinct()
    lists = (
        found.join(judged, ["query_id", "model_id"], "left")
        .groupBy("query_id")
        .agg(F.sort_array(F.collect_list(F.struct("place", "model_id", "hit"))).alias("rows"))
        .select(
            "query_id",
            F.transform("rows", lambda r: r["model_id"]).alias("retrieved_model_ids"),
            F.transform(F.filter("rows", lambda r: r["hit"]), lambda r: r["place"]).alias("ranks"),
        )
    )
    return queries.select("query_id").join(lists, "query_id", "left")
