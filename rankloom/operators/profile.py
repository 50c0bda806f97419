"""Statistics, projections and clusters of a vector table."""

from __future__ import annotations

import numpy as np
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import PCA
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import fixed_values as fv
from ..functions import text as tx
from ..functions import vectors as vx
from .ordering import first_rows, number_rows, random_rows, rank_groups, sample_key, top_per_group


def norm_stats(vectors: DataFrame) -> DataFrame:
    """One row: count, dimension, storage and the distribution of lengths."""
    rows = vectors.select(F.size("embedding").alias("dim"), vx.norm(F.col("embedding")).alias("norm"))
    return rows.agg(
        F.count("*").alias("num_vectors"),
        F.max("dim").alias("dim"),
        F.round(vx.size_mb(F.count("*"), F.max("dim")), 3).alias("matrix_memory_mb"),
        F.avg("norm").alias("norm_mean"),
        F.stddev_pop("norm").alias("norm_std"),
        F.min("norm").alias("norm_min"),
        F.max("norm").alias("norm_max"),
        F.count_if(F.col("norm") == 0).alias("zero_norm_count"),
    )


def unit_vectors(vectors: DataFrame) -> DataFrame:
    return vectors.withColumn("embedding", vx.unit(F.col("embedding")).cast("array<float>"))


def storage(vectors: DataFrame, target_dim: int) -> DataFrame:
    """Size now and after a cut to target_dim, and the ratio."""
    return vectors.agg(F.count("*").alias("n"), F.max(F.size("embedding")).alias("dim")).select(
        F.col("n").alias("num_vectors"),
        F.col("dim").alias("original_dim"),
        F.lit(target_dim).alias("target_dim"),
        F.round(vx.size_mb(F.col("n"), F.col("dim")), 3).alias("original_memory_mb"),
        F.round(vx.size_mb(F.col("n"), F.lit(target_dim)), 3).alias("reduced_memory_mb"),
        F.round(F.col("dim") / F.lit(target_dim), 3).alias("memory_compression_ratio"),
    )


def sample_rows(vectors: DataFrame, n: int | None, seed: int = fv.SEED) -> DataFrame:
    """n rows without replacement, or all; row_no numbers them from 0 in pos order."""
    drawn = vectors if n is None else random_rows(vectors, n, "pos", seed).drop("place")
    return number_rows(drawn, [F.col("pos")], "row_no")


def pair_cosines(sample: DataFrame, n_pairs: int = 20_000, seed: int = fv.SEED) -> DataFrame:
    """(pair_no, i, j, cosine) of random pairs of sample rows; a row is not its own pair.

    sample has row_no 0..n-1 and embedding.
    """
    n = sample.count()
    spark = sample.sparkSession
    if n < 2:
        return spark.createDataFrame([], "pair_no bigint, i bigint, j bigint, cosine double")
    ends = spark.range(n_pairs).select(
        F.col("id").alias("pair_no"),
        F.pmod(sample_key(F.concat("id", F.lit("i")), seed), F.lit(n)).alias("i"),
        F.pmod(sample_key(F.concat("id", F.lit("j")), seed), F.lit(n)).alias("j"),
    )
    rows = sample.select("row_no", vx.unit(F.col("embedding")).alias("v"))
    left = rows.select(F.col("row_no").alias("i"), F.col("v").alias("a"))
    right = rows.select(F.col("row_no").alias("j"), F.col("v").alias("b"))
    return (
        ends.where(F.col("i") != F.col("j"))
        .join(left, "i")
        .join(right, "j")
        .select("pair_no", "i", "j", vx.dot(F.col("a"), F.col("b")).alias("cosine"))
    )


def cosine_distribution(pairs: DataFrame) -> DataFrame:
    """One row of moments and linear quantiles; no row without pairs.

    The exact quantiles hold the drawn pairs, whose number is a parameter.
    """
    points = (0.01, 0.05, 0.5, 0.95, 0.99)
    quantiles = F.percentile("cosine", F.array(*[F.lit(p) for p in points]))
    row = pairs.agg(
        F.count("*").alias("num_pairs"),
        F.avg("cosine").alias("mean"),
        F.stddev_pop("cosine").alias("std"),
        F.min("cosine").alias("min"),
        quantiles.alias("q"),
        F.max("cosine").alias("max"),
    )
    named = [F.get("q", F.lit(i)).alias(f"p{int(p * 100):02d}") for i, p in enumerate(points)]
    return row.where(F.col("num_pairs") > 0).select("num_pairs", "mean", "std", "min", *named, "max")


def fit_kmeans(sample: DataFrame, k: int = 12, seed: int = fv.SEED) -> DataFrame:
    """Sample with `cluster`; k is cut to the number of rows."""
    if sample.limit(2).count() < 2 or k < 2:
        return sample.withColumn("cluster", F.lit(0))
    points = sample.withColumn("features", array_to_vector(F.col("embedding").cast("array<double>")))
    points = points.persist()
    model = KMeans(k=min(k, points.count()), seed=seed).fit(points)
    return model.transform(points).withColumnRenamed("prediction", "cluster").drop("features")


def _top_values(rows: DataFrame, value: Column, n: int, name: str) -> DataFrame:
    counted = (
        rows.select("cluster", value.alias("v"))
        .where(F.trim("v") != "")
        .groupBy("cluster", "v")
        .agg(F.count("*").alias("n"))
    )
    best = top_per_group(counted, ["cluster"], [F.col("n").desc(), F.col("v").asc()], n)
    ordered = F.sort_array(F.collect_list(F.struct("rank", "v", "n")))
    shown = F.transform(ordered, lambda s: F.concat(s["v"], F.lit(":"), s["n"]))
    return best.groupBy("cluster").agg(F.array_join(shown, "; ").alias(name))


def cluster_summary(rows: DataFrame) -> DataFrame:
    """Size, commonest tasks, libraries and tags, and first ids of every cluster.

    rows: cluster, pos, model_id, pipeline_tag, library_name, tags. Counts are
    combined before the shuffle and lists hold at most twelve items.
    """
    sizes = rows.groupBy("cluster").agg(F.count("*").alias("size"))
    tasks = _top_values(rows, F.coalesce("pipeline_tag", F.lit("")), 8, "top_pipeline_tags")
    libraries = _top_values(rows, F.coalesce("library_name", F.lit("")), 8, "top_libraries")
    tags = _top_values(rows, F.explode(F.slice("tags", 1, 20)), 12, "top_tags")
    first = top_per_group(rows.select("cluster", "pos", "model_id"), ["cluster"], [F.col("pos")], 8)
    examples = first.groupBy("cluster").agg(
        F.array_join(
            F.transform(
                F.sort_array(F.collect_list(F.struct("rank", "model_id"))), lambda s: s["model_id"]
            ),
            "; ",
        ).alias("example_model_ids")
    )
    out = sizes
    for part in (tasks, libraries, tags, examples):
        out = out.join(part, "cluster", "left")
    names = ["top_pipeline_tags", "top_libraries", "top_tags", "example_model_ids"]
    return out.select("cluster", "size", *[F.coalesce(n, F.lit("")).alias(n) for n in names])


def common_or_other(rows: DataFrame, column: str = "pipeline_tag", n: int = 12) -> DataFrame:
    """rows with plot_tag: the value if among the n commonest, else 'Other'."""
    value = F.coalesce(column, F.lit("unknown"))
    counted = rows.groupBy(value.alias("plot_value")).agg(F.count("*").alias("rows"))
    common = (
        counted.orderBy(F.desc("rows"), "plot_value").limit(n).select("plot_value")
    )
    keyed = rows.withColumn("plot_value", value)
    return keyed.join(
        F.broadcast(common.withColumn("plot_tag", F.col("plot_value"))), "plot_value", "left"
    ).withColumn("plot_tag", F.coalesce("plot_tag", F.lit("Other"))).drop("plot_value")


class Projection:
    """Principal components of a sample, applied to any table.

    Points are moved by the sample mean before they are projected.
    """

    def __init__(self, sample: DataFrame, components: int):
        self.mean = np.array(
            [
                r.m
                for r in sample.select(F.posexplode("embedding").alias("i", "x"))
                .groupBy("i")
                .agg(F.avg(F.col("x").cast("double")).alias("m"))
                .orderBy("i")
                .collect()
            ]
        )
        points = sample.select(array_to_vector(F.col("embedding").cast("array<double>")).alias("features"))
        self.model = PCA(k=components, inputCol="features", outputCol="projected").fit(points)
        self.explained = [float(x) for x in self.model.explainedVariance]

    def apply(self, vectors: DataFrame, name: str = "projected") -> DataFrame:
        mean = F.array(*[F.lit(float(x)) for x in self.mean])
        centred = F.zip_with(F.col("embedding").cast("array<double>"), mean, lambda x, m: x - m)
        rows = vectors.withColumn("features", array_to_vector(centred))
        out = self.model.transform(rows).drop("features")
        return out.withColumn("projected", vector_to_array("projected")).withColumnRenamed(
            "projected", name
        )


def explained_variance(spark, ratios: list[float]) -> DataFrame:
    """(component, explained_variance_ratio, cumulative_explained_variance)."""
    rows = spark.createDataFrame(
        [(i, float(x)) for i, x in enumerate(ratios, 1)],
        "component int, explained_variance_ratio double",
    )
    so_far = Window.orderBy("component").rowsBetween(Window.unboundedPreceding, 0)
    return rows.withColumn(
        "cumulative_explained_variance", F.sum("explained_variance_ratio").over(so_far)
    )


def shrink(
    vectors: DataFrame, target_dim: int, *, dim: int, fit_rows: int | None = None,
    normalise: bool = True, seed: int = fv.SEED,
) -> tuple[DataFrame, Projection]:
    """Vectors cut to target_dim principal components, fitted on fit_rows of them or on all."""
    if not 0 < target_dim < dim:
        raise ValueError(f"target_dim must lie in 1..{dim - 1}, got {target_dim}")
    fitted = vectors if fit_rows is None else random_rows(vectors, fit_rows, "pos", seed).drop("place")
    projection = Projection(fitted, target_dim)
    out = projection.apply(vectors.select("pos", "embedding"), "reduced")
    value = vx.unit(F.col("reduced")) if normalise else F.col("reduced")
    return out.select("pos", value.cast("array<float>").alias("embedding")), projection
