"""Rendezvous hashing of stable record keys over weighted shards.

Every shard s of weight w gives a key the time -ln(u) / w, where u in (0, 1)
comes from a hash of key and shard; the shard with the smallest time takes the
record. A shard gets its weight's part of the keys, and a shard that is added
only takes records into itself, as the times of the others stay. Everything is
a column expression: one scan for the shard, one shuffle for the slot.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def draw(key: Column, shard: int) -> Column:
    """A number in (0, 1) that only key and shard decide."""
    bits = F.shiftrightunsigned(F.xxhash64(F.concat(key, F.lit(f"|{shard}"))), 11)
    return (bits.cast("double") + 0.5) / F.lit(float(1 << 53))


def rendezvous(key: Column, weights: Mapping[int, float]) -> Column:
    """The shard of a key. Equal times go to the smaller shard number."""
    if not weights or min(weights.values()) <= 0:
        raise ValueError("at least one shard, and weights above 0")
    times = [
        F.struct((-F.ln(draw(key, s)) / F.lit(float(w))).alias("time"), F.lit(int(s)).alias("shard"))
        for s, w in sorted(weights.items())
    ]
    return F.array_min(F.array(*times))["shard"]


def number(rows: DataFrame, group: str, order: list[Column], total: int, into: str = "slot", rows_per_range: int = 16384) -> DataFrame:
    """Adds `into`: 0, 1, ... within each group, by a hash of the order columns.

    A group is numbered in ranges of a hash, each by a task of its own, and a
    range starts where the counts of the ranges before it end, so no group
    meets in one task. The number of ranges follows `total`, the row count.
    Rows that agree in all order columns may change places among themselves.
    """
    ranges = max(1, -(-total // rows_per_range))
    place = F.shiftrightunsigned(F.xxhash64(*order), 11)
    rows = rows.withColumn("_place", place).withColumn(
        "_range", F.floor(F.col("_place") / F.lit(float(1 << 53)) * ranges).cast("long")
    )
    counts = rows.groupBy(group, "_range").count()
    before = Window.partitionBy(group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(group, "_range", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_start"))
    within = Window.partitionBy(group, "_range").orderBy("_place", *order)
    numbered = rows.withColumn("_row", F.row_number().over(within))
    return (
        numbered.join(starts, [group, "_range"])
        .withColumn(into, (F.col("_start") + F.col("_row") - 1).cast("long"))
        .drop("_place", "_range", "_start", "_row")
    )


def shard(
    docs: DataFrame, weights: Mapping[int, float], key: str = "doc_id", text: str = "text", grown: Mapping[int, float] | None = None
) -> DataFrame:
    """One row per document: key, size, text_crc32, shard, slot, grown_shard.

    size: UTF-8 bytes of the text and 1; a null text has none, so 1, and its
    checksum is 0, that of no bytes. A null key is the empty key. Repeated rows
    go to one shard and have a slot each. No rows give no rows. Other columns
    are not read. grown_shard: the shard under the weights `grown`.
    """
    name = F.coalesce(F.col(key).cast("string"), F.lit(""))
    body = F.coalesce(F.col(text), F.lit("")).cast("binary")
    rows = docs.select(
        F.col(key),
        (F.octet_length(body) + 1).cast("long").alias("size"),
        F.crc32(body).alias("text_crc32"),
        rendezvous(name, weights).alias("shard"),
        (rendezvous(name, grown) if grown else F.lit(None).cast("int")).alias("grown_shard"),
    )
    order = [F.col(key), F.col("text_crc32"), F.col("size")]
    return number(rows, "shard", order, docs.count()).select(key, "size", "text_crc32", "shard", "slot", "grown_shard")


def write(docs: DataFrame, sharded: DataFrame, path: str, key: str = "doc_id") -> None:
    """The documents as one folder of Parquet files per shard."""
    docs.join(sharded.select(key, "shard").distinct(), key).write.partitionBy("shard").parquet(path)
