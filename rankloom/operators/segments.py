"""A lexical index in segments: documents are added, and segments merged, without a rebuild.

A segment holds the postings and the term counts of some documents and is
never changed. A version is a row of names of segments; a new version is one
new file, written last, so that a job that dies halfway leaves the versions
as they were, and readers of an older version go on reading its segments.
Counts of terms add up, so the collection's numbers come from the segments'
term tables, without the texts.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import settle_table
from .lexical import LexicalIndex, corpus_stats, packed_documents, postings, term_table

FORMAT = 1
#: Postings in a file of a segment at most, and below which a file isn't cut for the sake of more tasks.
FILE_POSTINGS, LEAST_POSTINGS = 20_000_000, 1_000_000
POSTINGS = "pos bigint, length bigint, term string, tf int"
TERMS = "term string, df bigint, cf bigint, documents bigint, low bigint, high bigint, marks bigint"


@dataclass(frozen=True)
class SegmentedIndex:
    path: str
    version: int
    segments: tuple[str, ...]

    @classmethod
    def open(cls, spark: SparkSession, path: str, version: int | None = None) -> "SegmentedIndex":
        """The newest version, or the named one; a path without it raises ValueError."""
        found = versions(spark, path)
        number = max(found, default=0) if version is None else version
        if number not in found:
            raise ValueError(f"{path} has no version {number}")
        return cls(path, number, tuple(found[number]))

    @classmethod
    def create(cls, spark: SparkSession, path: str) -> "SegmentedIndex":
        """Version 0, without documents; a path that has versions raises ValueError."""
        if versions(spark, path):
            raise ValueError(f"{path} holds an index already")
        return cls(path, 0, ())._publish(spark, 0, ())

    def append(self, docs: DataFrame, file_postings: int = FILE_POSTINGS) -> "SegmentedIndex":
        """The next version, with these documents in a segment of their own; positions go on where the index ends."""
        spark = docs.sparkSession
        packed = settle_table(packed_documents(docs))
        terms = settle_table(term_table(packed))
        held = self._terms(spark).agg(F.coalesce(F.sum("documents"), F.lit(0))).first()[0]
        row = terms.agg(F.coalesce(F.sum("documents"), F.lit(0)).alias("n"), F.min("low").alias("low"), F.max("high").alias("high")).first()
        if row.n and (row.low, row.high) != (held, held + row.n - 1):
            raise ValueError(f"positions must run from {held} to {held + row.n - 1}, found {row.low}..{row.high}")
        return self._publish(spark, self.version + 1, (*self.segments, self._write(postings(packed), terms, file_postings)))

    def merge(self, spark: SparkSession, smallest: int = 2, file_postings: int = FILE_POSTINGS) -> "SegmentedIndex":
        """The next version, in which the `smallest` segments of fewest postings are one; no text is read."""
        sizes = {s: self._read(spark, s, "terms", TERMS).agg(F.coalesce(F.sum("df"), F.lit(0))).first()[0] for s in self.segments}
        chosen = sorted(self.segments, key=lambda s: (sizes[s], s))[:smallest]
        if len(chosen) < 2:
            return self
        rows = reduce(DataFrame.unionByName, [self._read(spark, s, "postings", POSTINGS) for s in chosen])
        terms = settle_table(added([self._read(spark, s, "terms", TERMS) for s in chosen]))
        name = self._write(rows, terms, file_postings)
        return self._publish(spark, self.version + 1, (*[s for s in self.segments if s not in chosen], name))

    def index(self, spark: SparkSession) -> LexicalIndex:
        """All segments as one index to search."""
        terms = settle_table(self._terms(spark))
        parts = [self._read(spark, s, "postings", POSTINGS) for s in self.segments]
        rows = reduce(DataFrame.unionByName, parts) if parts else spark.createDataFrame([], POSTINGS)
        return LexicalIndex(rows, terms, corpus_stats(terms), hashed=False)

    def _terms(self, spark: SparkSession) -> DataFrame:
        parts = [self._read(spark, s, "terms", TERMS) for s in self.segments]
        return added(parts) if parts else spark.createDataFrame([], TERMS)

    def _read(self, spark: SparkSession, segment: str, table: str, schema: str) -> DataFrame:
        return spark.read.schema(schema).parquet(f"{self.path}/{segment}/{table}")

    def _write(self, rows: DataFrame, terms: DataFrame, file_postings: int) -> str:
        """A new segment: as many files as its postings ask for, each of some documents, sorted by term, with bloom filters.

        A file is a task's work, so a large segment has a file for each core.
        """
        name = f"segment-{uuid.uuid4().hex}"
        n = terms.agg(F.coalesce(F.sum("df"), F.lit(0))).first()[0]
        files = max(1, -(-n // file_postings), min(rows.sparkSession.sparkContext.defaultParallelism, -(-n // LEAST_POSTINGS)))
        (
            rows.repartition(files, "pos").sortWithinPartitions("term", "pos")
            .write.option("parquet.bloom.filter.enabled#term", "true")
            .parquet(f"{self.path}/{name}/postings")
        )
        terms.write.parquet(f"{self.path}/{name}/terms")
        return name

    def _publish(self, spark: SparkSession, version: int, segments: tuple[str, ...]) -> "SegmentedIndex":
        said = json.dumps({"format": FORMAT, "version": version, "segments": segments})
        spark.createDataFrame([(said,)], "value string").coalesce(1).write.text(f"{self.path}/versions/version={version}")
        return SegmentedIndex(self.path, version, segments)


def added(parts: list[DataFrame]) -> DataFrame:
    """One term table of several."""
    return reduce(DataFrame.unionByName, parts).groupBy("term").agg(
        *[F.sum(c).alias(c) for c in ("df", "cf", "documents")], F.min("low").alias("low"), F.max("high").alias("high"),
        F.bit_xor("marks").alias("marks"),
    )


def versions(spark: SparkSession, path: str) -> dict[int, list[str]]:
    """Names of the segments by version; empty where no index is."""
    try:
        rows = spark.read.text(f"{path}/versions").select("value").collect()
    except Exception as problem:
        if getattr(problem, "getCondition", lambda: None)() != "PATH_NOT_FOUND":
            raise
        return {}
    found = [json.loads(r.value) for r in rows]
    if any(x["format"] != FORMAT for x in found):
        raise ValueError(f"{path} has another format than {FORMAT}")
    return {x["version"]: x["segments"] for x in found}
