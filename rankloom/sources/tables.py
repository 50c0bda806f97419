"""The provided tables as cards, documents, vectors and queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as tx
from ..session import spread


# Tables whose rows are costly to work on: long texts and vectors.
HEAVY = ("documents", "pages", "conversations", "embeddings")
# Declared schemas spare the job that would infer them.
SCHEMAS = {
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "labels": "doc_id bigint, quality int, toxic int",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
    "pages": "page_id bigint, url string, html string",
    "benchmark": "item_id bigint, text string",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    path = f"{sf_dir}/{name}.parquet"
    rows = spark.read.schema(SCHEMAS[name]).parquet(path)
    return spread(rows, path) if name in HEAVY else rows


def raw_cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Card rows as a dataset dump holds them: numbers and lists as text."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    d = F.col
    return docs.join(labels.select("doc_id", "quality"), "doc_id", "left").select(
        d("doc_id").alias("pos"),
        F.concat(d("source"), F.lit("/doc-"), d("doc_id")).alias("model_id"),
        F.concat_ws(" ", "lang", "source", F.lit("doc"), "doc_id").alias("name"),
        F.coalesce(d("quality").cast("string"), F.lit("unknown")).alias("likes"),
        d("n_chars").cast("string").alias("downloads"),
        F.concat(F.lit("['"), d("lang"), F.lit("', '"), d("source"), F.lit("']")).alias("tags"),
        F.concat_ws("_", "lang", "source").alias("pipeline_tag"),
        d("source").alias("library_name"),
        F.concat(
            F.date_add(F.lit("2024-01-01").cast("date"), F.pmod("doc_id", F.lit(365)).cast("int")),
            F.lit("T12:34:56Z"),
        ).alias("createdAt"),
        F.concat(F.lit("['"), d("lang"), F.lit("']")).alias("languages"),
        d("text").alias("modelCard"),
    )


def cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed cards: whole-number counts, list columns, a date."""
    return raw_cards(spark, sf_dir).select(
        "pos",
        "model_id",
        "name",
        tx.number_or_zero("likes").cast("long").alias("likes"),
        tx.number_or_zero("downloads").cast("long").alias("downloads"),
        tx.read_list("tags").alias("tags"),
        "pipeline_tag",
        "library_name",
        tx.day_of("createdAt").alias("createdAt"),
        tx.read_list("languages").alias("languages"),
        "modelCard",
    )


def search_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents ready for retrieval: dense pos, title, body, task and tags."""
    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("pos"),
        F.concat(F.col("source"), F.lit("/doc-"), F.col("doc_id")).alias("model_id"),
        F.concat_ws(" ", "lang", "source", F.lit("doc"), "doc_id").alias("title"),
        F.col("text").alias("body"),
        F.concat_ws("_", "lang", "source").alias("pipeline_tag"),
        F.array("lang", "source").alias("tags"),
    )


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("pos"), "embedding", "label"
    )


def search_docs_with_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that have a vector, with that vector and its label."""
    return search_docs(spark, sf_dir).join(vectors(spark, sf_dir), "pos")


def passage_queries(spark: SparkSession, sf_dir: str, top_k: int = 10) -> DataFrame:
    """Every benchmark passage as a text query."""
    return table(spark, sf_dir, "benchmark").select(
        F.col("item_id").alias("query_id"), "text", F.lit(top_k).alias("top_k")
    )


def label_queries(vecs: DataFrame, top_k: int = 10, dim: int = 64) -> DataFrame:
    """One query per label: the mean of all vectors that carry it.

    Sums are combined before the shuffle, so a label that holds a third of the
    vectors costs one row per task. Rounding makes the mean independent of the
    order of summation.
    """
    mean = "cast(round(avg(cast(get(embedding, {i}) as double)), 6) as float)"
    means = ", ".join(mean.format(i=i) for i in range(dim))
    rows = vecs.groupBy("label").agg(F.expr(f"array({means})").alias("embedding"))
    return rows.select(F.col("label").cast("long").alias("query_id"), "embedding", F.lit(top_k).alias("top_k"))


def text_vector_queries(spark: SparkSession, sf_dir: str, top_k: int = 10) -> DataFrame:
    """Every benchmark passage as a query with both sides: its text, and the vector of its number with that vector's label."""
    passages = passage_queries(spark, sf_dir, top_k)
    own = vectors(spark, sf_dir).select(F.col("pos").alias("query_id"), "embedding", "label")
    return passages.join(own, "query_id")
