"""Readers for card tables, relevance files and vector tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import fixed_values as fv
from ..operators.dense import check_vectors
from ..operators.ordering import number_rows

REQUIRED = ("model_id", "modelCard")


def read_dataset(
    spark: SparkSession,
    path: str,
    *,
    limit: int | None = None,
    order_by: str | None = None,
    schema: T.StructType | str | None = None,
) -> DataFrame:
    """Card table by path suffix: parquet, csv, tsv, jsonl (lines) or json (one document).

    limit keeps the first rows by order_by; stored rows have no order of their own.
    """
    suffix = "." + path.rstrip("/").rsplit(".", 1)[-1].lower()
    reader = spark.read if schema is None else spark.read.schema(schema)
    if suffix == ".parquet":
        rows = reader.parquet(path)
    elif suffix in (".csv", ".tsv"):
        sep = "\t" if suffix == ".tsv" else ","
        rows = reader.csv(path, sep=sep, header=True, multiLine=True, quote='"', escape='"')
    elif suffix in (".jsonl", ".json"):
        rows = reader.json(path, multiLine=suffix == ".json")
    else:
        raise ValueError(f"unsupported dataset format {suffix!r}")
    require(rows, REQUIRED)
    if limit is not None and limit > 0:
        if order_by is None:
            raise ValueError("limit needs order_by")
        rows = rows.orderBy(order_by).limit(limit)
    return rows


def require(rows: DataFrame, columns: tuple[str, ...]) -> None:
    missing = sorted(set(columns) - set(rows.columns))
    if missing:
        raise ValueError(f"missing required columns: {missing}")


def card_columns(rows: DataFrame) -> DataFrame:
    """The columns that the card work needs, and the row position."""
    return rows.select("pos", *fv.CARD_COLUMNS)


def read_qrels(spark: SparkSession, path: str) -> DataFrame:
    """(row_no, query, relevant_model_ids) of CSV files; the first data row is 2.

    Rows of several files are numbered on, by file name and place in the file.
    """
    rows = spark.read.csv(path, header=True, multiLine=True, quote='"', escape='"')
    # A file with quoted line breaks is read in one piece, so its rows have rising ids.
    rows = rows.select("*", F.col("_metadata.file_path").alias("_file"), F.monotonically_increasing_id().alias("_line"))
    rows = rows.withColumnsRenamed({c: c.lstrip("﻿").strip() for c in rows.columns})
    require(rows, ("query", "relevant_model_ids"))
    rows = number_rows(
        rows.select("query", "relevant_model_ids", "_file", "_line"), [F.col("_file"), F.col("_line")], "_row"
    )
    return rows.select((F.col("_row") + 2).alias("row_no"), "query", "relevant_model_ids")


def artifact_counts(vectors: DataFrame, ids: DataFrame, metadata: DataFrame) -> DataFrame:
    """One row: sizes of the three parts and how many rows lack a partner.

    Each part has a column pos.
    """
    parts = [("vectors", vectors), ("ids", ids), ("metadata", metadata)]
    joined = None
    for name, part in parts:
        marked = part.select("pos", F.lit(1).alias(name))
        joined = marked if joined is None else joined.join(marked, "pos", "full")
    together = F.col("vectors") + F.col("ids") + F.col("metadata")
    return joined.agg(
        *[F.coalesce(F.sum(name), F.lit(0)).alias(f"{name}_rows") for name, _ in parts],
        F.count_if(together.isNull()).alias("unmatched"),
    )


def check_artifacts(
    vectors: DataFrame,
    ids: DataFrame,
    metadata: DataFrame,
    config: dict,
    expected_dim: int | None = None,
) -> int:
    """Dimension of aligned parts; ValueError or TypeError names what does not fit."""
    counts = artifact_counts(vectors, ids, metadata).first()
    sizes = {counts.vectors_rows, counts.ids_rows, counts.metadata_rows}
    if len(sizes) > 1 or counts.unmatched:
        raise ValueError(f"artifact rows do not match: {counts.asDict()}")
    if config.get("embedding_dtype") not in (None, "float32"):
        raise ValueError("the configured dtype is not float32")
    if not config.get("model_name"):
        raise ValueError("the configuration names no model")
    dim = check_vectors(vectors, expected_dim)
    shape = tuple(config.get("embedding_shape") or ())
    if shape and shape != (counts.vectors_rows, dim):
        raise ValueError(f"configured shape {shape} is not {(counts.vectors_rows, dim)}")
    return dim
