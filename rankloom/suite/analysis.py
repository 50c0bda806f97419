"""Statistics, samples, projections and clusters of the vector table."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import fixed_values as fv
from ..functions import vectors as vx
from ..operators import profile as pf
from ..plans.experiments import profile_vectors
from ..session import settle_table
from ..sources import tables as tb
from . import sql as q
from .registry import query

NORMS = "nv AS (SELECT vec_id, len(embedding) AS dim, sqrt(list_sum([CAST(x AS DOUBLE) * x FOR x IN embedding])) AS norm FROM embeddings)"


@query(
    "e3_norm_stats",
    f"WITH {NORMS} SELECT count(*) AS num_vectors, max(dim)::INT AS dim, round(count(*) * max(dim) * 4 / (1024.0 * 1024.0)::DOUBLE, 3) AS matrix_memory_mb, "
    f"round(avg(norm), 6) AS norm_mean, round(stddev_pop(norm), 6) AS norm_std, round(min(norm), 6) AS norm_min, "
    f"round(max(norm), 6) AS norm_max, count(*) FILTER (norm = 0) AS zero_norm_count FROM nv",
)
def norm_stats(spark, sf_dir):
    out = pf.norm_stats(tb.vectors(spark, sf_dir))
    return out.withColumns({c: F.round(c, 6) for c in ("norm_mean", "norm_std", "norm_min", "norm_max")})


PAIR_I, PAIR_J = q.sample_key("i0 || 'i'"), q.sample_key("i0 || 'j'")
NUMBERED = "smp AS (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS row_no, embedding, label FROM embeddings)"


@query(
    "e4_pair_cosines",
    f"WITH {NUMBERED}, n AS (SELECT count(*) AS n FROM smp), pr AS (SELECT i0 AS pair_no, "
    f"{PAIR_I} % n AS i, {PAIR_J} % n AS j "
    f"FROM (SELECT unnest(range(20000)) AS i0), n), "
    f"c AS (SELECT list_inner_product(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])) / "
    f"(sqrt(list_inner_product(CAST(a.embedding AS DOUBLE[]), CAST(a.embedding AS DOUBLE[]))) * "
    f"sqrt(list_inner_product(CAST(b.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])))) AS c "
    f"FROM pr JOIN smp a ON a.row_no = i JOIN smp b ON b.row_no = j WHERE i <> j) "
    f"SELECT count(*) AS num_pairs, round(avg(c), 6) AS mean, round(stddev_pop(c), 6) AS std, round(min(c), 6) AS min, "
    + ", ".join(f"round(quantile_cont(c, {p}), 6) AS {n}" for p, n in ((0.01, "p01"), (0.05, "p05"), (0.5, "p50"), (0.95, "p95"), (0.99, "p99")))
    + ", round(max(c), 6) AS max FROM c",
)
def pair_cosines(spark, sf_dir):
    out = pf.cosine_distribution(pf.pair_cosines(pf.sample_rows(tb.vectors(spark, sf_dir), None), 20_000))
    return out.select(*[c if c == "num_pairs" else F.round(c, 6).alias(c) for c in out.columns])


@query(
    "c6_distinct_pairs",
    f"WITH {NUMBERED}, n AS (SELECT count(*) AS n FROM smp), pr AS (SELECT i0 AS pair_no, "
    f"{PAIR_I} % n AS i, {PAIR_J} % n AS j "
    f"FROM (SELECT unnest(range(20000)) AS i0), n) SELECT pair_no, i, j FROM pr WHERE i <> j",
)
def distinct_pairs(spark, sf_dir):
    return pf.pair_cosines(pf.sample_rows(tb.vectors(spark, sf_dir), None), 20_000).select("pair_no", "i", "j")


def top_sql(value: str, n: int, name: str, source: str = "cl") -> str:
    return (
        f"{name} AS (SELECT cluster, string_agg(v || ':' || n, '; ' ORDER BY n DESC, v) AS {name} FROM ("
        f"SELECT cluster, v, count(*) AS n FROM (SELECT cluster, {value} AS v FROM {source}) WHERE trim(v) <> '' GROUP BY cluster, v "
        f"QUALIFY row_number() OVER (PARTITION BY cluster ORDER BY count(*) DESC, v) <= {n}) GROUP BY cluster)"
    )


@query(
    "e5_cluster_summary",
    f"WITH {q.VECTOR_DOCS}, cl AS (SELECT *, label AS cluster, split_part(model_id, '/', 1) AS library_name FROM d), "
    f"{top_sql('pipeline_tag', 8, 'top_pipeline_tags')}, {top_sql('library_name', 8, 'top_libraries')}, {top_sql('unnest(tags)', 12, 'top_tags')}, "
    f"ex AS (SELECT cluster, string_agg(model_id, '; ' ORDER BY pos) AS example_model_ids FROM "
    f"(SELECT cluster, model_id, pos FROM cl QUALIFY row_number() OVER (PARTITION BY cluster ORDER BY pos) <= 8) GROUP BY cluster), "
    f"sz AS (SELECT cluster, count(*) AS size FROM cl GROUP BY cluster) "
    f"SELECT cluster, size, top_pipeline_tags, top_libraries, top_tags, example_model_ids FROM sz JOIN top_pipeline_tags USING (cluster) "
    f"JOIN top_libraries USING (cluster) JOIN top_tags USING (cluster) JOIN ex USING (cluster)",
)
def cluster_summary(spark, sf_dir):
    """The label stands for the cluster."""
    docs = tb.search_docs_with_vectors(spark, sf_dir)
    rows = docs.withColumn("cluster", F.col("label")).withColumn(
        "library_name", F.split("model_id", "/")[0]
    )
    return pf.cluster_summary(rows)


@query(
    "e6_common_or_other",
    f"WITH {q.DOCS}, c AS (SELECT pipeline_tag AS v FROM d GROUP BY pipeline_tag ORDER BY count(*) DESC, v LIMIT 12) "
    f"SELECT pos, CASE WHEN pipeline_tag IN (SELECT v FROM c) THEN pipeline_tag ELSE 'Other' END AS plot_tag FROM d",
)
def common_or_other(spark, sf_dir):
    return pf.common_or_other(tb.search_docs(spark, sf_dir)).select("pos", "plot_tag")


@query(
    "e9_storage",
    "SELECT count(*) AS num_vectors, max(len(embedding))::INT AS original_dim, 16 AS target_dim, "
    "round(count(*) * max(len(embedding)) * 4 / 1048576.0::DOUBLE, 3) AS original_memory_mb, "
    "round(count(*) * 16 * 4 / 1048576.0::DOUBLE, 3) AS reduced_memory_mb, "
    "round(max(len(embedding)) / 16.0::DOUBLE, 3) AS memory_compression_ratio FROM embeddings",
)
def storage(spark, sf_dir):
    return pf.storage(tb.vectors(spark, sf_dir), 16)


# ---- projections and clusters ----------------------------------------------


@query("l1_projection")
def projection(spark, sf_dir):
    """First two principal components of all vectors."""
    rows = settle_table(tb.vectors(spark, sf_dir))
    out = pf.Projection(rows, 2).apply(rows)
    return out.select(
        "pos", F.get("projected", F.lit(0)).alias("pc1"), F.get("projected", F.lit(1)).alias("pc2")
    )


@query("f12_explained_variance")
def explained_variance(spark, sf_dir):
    rows = settle_table(tb.vectors(spark, sf_dir))
    return pf.explained_variance(spark, pf.Projection(rows, 50).explained)


@query("l2_clusters")
def clusters(spark, sf_dir):
    rows = settle_table(tb.vectors(spark, sf_dir))
    return pf.fit_kmeans(rows, 12).groupBy("cluster").agg(F.count("*").alias("size"))


@query("l3_shrunk_vectors")
def shrunk_vectors(spark, sf_dir):
    """Every vector cut to 16 components and brought to unit length."""
    out, _ = pf.shrink(tb.vectors(spark, sf_dir), 16, dim=64)
    return out.select(
        "pos", F.size("embedding").alias("dim"), F.round(vx.norm(F.col("embedding")), 5).alias("norm")
    )


@query("l4_profile")
def profile(spark, sf_dir):
    return profile_vectors(tb.search_docs_with_vectors(spark, sf_dir))


@query("l5_two_encoders")
def two_encoders(spark, sf_dir):
    """Both encoders over all card texts, each profiled, the first one shrunk."""
    from ..functions import text as tx
    from ..plans.experiments import encoder_experiment

    rows = tb.cards(spark, sf_dir).select("pos", tx.card_text().alias("text"))
    return encoder_experiment(rows, {"hashed-64": 64, "hashed-128": 128}, target_dim=16)
