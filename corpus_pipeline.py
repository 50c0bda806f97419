"""From raw documents to training rows: five stages, each one operator of rankloom.llm over all rows of the stage before.

Documents that share a doc_id count as one document; those without a doc_id are
told apart by nothing and so are only dropped by what their own text decides.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rankloom.llm import jaccard, language, mixing, pieces, quality
from rankloom.llm.common import small_batches
from rankloom.llm.queries import TOKENIZER
from rankloom.session import settle_table

#: Below this a text is in no language that was learned.
LEAST_LANGUAGE_SCORE = 0.4


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told with some certainty."""
    told = language.identify(docs, language.fit(docs), into=("_language", "_certainty"))
    sure = (F.col("_language") != language.UNDECIDED) & (F.col("_certainty") >= LEAST_LANGUAGE_SCORE)
    return told.where(sure).select(docs.columns)


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the rules and keep enough words of their own."""
    return _chosen(docs, quality.assess(docs).where("kept"))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents the one of the smallest doc_id."""
    first = _chosen(docs, jaccard.join(docs).where(F.col("doc_id").eqNullSafe(F.col("component_id"))))
    one = Window.partitionBy("doc_id").orderBy(F.xxhash64("text"))
    return first.withColumn("_copy", F.row_number().over(one)).where("_copy = 1 or doc_id is null").select(docs.columns)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, in the order of the mix."""
    return mixing.in_order(mixing.mix(docs)).select(docs.columns)


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Training rows: the pieces of each text, which decode to it."""
    # Written between, so that a task runs one Python process at a time, on small batches. Executors come
    # here with heaps that the joins before have filled, so words are remembered in half the usual memory.
    with small_batches(spark):
        coded = settle_table(pieces.encode(docs, TOKENIZER, keep=["doc_id", "lang", "source", "text"], memo=pieces.MEMO // 2))
    back = pieces.decode(coded, TOKENIZER, into="_decoded", forget=True)
    return back.select(
        "doc_id", "lang", "source", "input_ids",
        F.size("input_ids").cast("long").alias("n_pieces"),
        F.col("_decoded").eqNullSafe(F.col("text")).alias("restored"),
    )


def _chosen(docs: DataFrame, verdict: DataFrame) -> DataFrame:
    ids = verdict.select(F.col("doc_id").alias("_chosen")).distinct()
    return docs.join(ids, F.col("doc_id").eqNullSafe(F.col("_chosen")), "left_semi")


STAGES = [
    ("language ID", language_stage),
    ("quality rules", quality_stage),
    ("n-gram Jaccard join", near_duplicate_stage),
    ("mixing sources", mixing_stage),
    ("sentence pieces", encoding_stage),
]

# SQL has neither the classifier nor the encoder; tests/llm holds the brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = settle_table(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
