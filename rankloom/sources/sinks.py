"""Writers of clean tables, result tables and reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_table(rows: DataFrame, path: str, mode: str = "errorifexists") -> None:
    rows.write.mode(mode).parquet(path)


def write_results(rows: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Result table as CSV with a header; quotes inside a field are doubled, blanks at its ends stay."""
    rows.write.mode(mode).csv(
        path, header=True, quote='"', escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
    )


def report_rows(summary: DataFrame, details: DataFrame, name: str) -> DataFrame:
    """One row: the metrics as a map, the number of queries, the report's name.

    Details of every query stay a table of their own.
    """
    metrics = summary.agg(
        F.map_from_entries(F.sort_array(F.collect_list(F.struct("metric", "value")))).alias("metrics")
    )
    counted = details.agg(F.count("*").alias("query_count")).first()[0]
    return metrics.select(
        F.lit(name).alias("name"), F.lit(counted).alias("query_count"), "metrics"
    )


def write_report(summary: DataFrame, details: DataFrame, path: str, name: str) -> None:
    """Summary and per-query details as JSON under path/name."""
    report_rows(summary, details, name).write.mode("overwrite").json(f"{path}/{name}/report")
    details.write.mode("overwrite").json(f"{path}/{name}/per_query")


def write_run_summary(spark, values: dict, path: str) -> None:
    """Settings and counts of a run as one JSON row."""
    names = list(values)
    row = spark.range(1).select(*[F.lit(values[n]).alias(n) for n in names])
    row.write.mode("overwrite").json(path)
