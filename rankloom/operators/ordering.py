"""Ranking, numbering, sampling and de-duplication that hold at any group size."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import fixed_values as fv
from ..functions.text import tokens
from ..session import settle_table

# Rows a broadcast side may have; narrow rows only (ids, terms, weights).
BROADCAST_ROWS = 1_000_000
# Above this k Spark no longer prunes the groups before the shuffle.
PRUNED_K = 1000
SALTS = 64


def row_count_within(df: DataFrame, limit: int = BROADCAST_ROWS) -> int | None:
    """Number of rows, or None when there are more than limit."""
    n = df.limit(limit + 1).count()
    return n if n <= limit else None


def small_side(df: DataFrame, rows: int | None, limit: int = BROADCAST_ROWS) -> DataFrame:
    """Broadcast hint only for a side whose size has been counted."""
    return F.broadcast(df) if rows is not None and rows <= limit else df


def salted_join(big: DataFrame, small: DataFrame, on: str, spread: Column, salts: int = SALTS):
    """Equi-join for a hot key: big rows of one key go to `salts` partitions.

    The other side is repeated once per salt, so use it for the smaller one.
    """
    left = big.withColumn("_salt", F.pmod(F.xxhash64(spread), F.lit(salts)).cast("int"))
    right = small.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return left.join(right, [on, "_salt"]).drop("_salt")


def join_small(big: DataFrame, small: DataFrame, on: str, rows: int | None, spread: Column):
    """Broadcast join behind a size check, salted shuffle join beyond it."""
    if rows is not None and rows <= BROADCAST_ROWS:
        return big.join(F.broadcast(small), on)
    return salted_join(big, small, on, spread)


def rank_groups(
    df: DataFrame, group: Sequence[str], order: Sequence[Column], rank: str = "rank"
) -> DataFrame:
    """Number all rows of groups that an earlier cut has already bounded."""
    return df.withColumn(rank, F.row_number().over(Window.partitionBy(*group).orderBy(*order)))


def top_per_group(
    df: DataFrame, group: Sequence[str], order: Sequence[Column], k: int, rank: str = "rank"
) -> DataFrame:
    """First k rows of each group, numbered from 1.

    Up to PRUNED_K every task first cuts its share of a group to k rows
    (WindowGroupLimit). A larger k is cut per salt first, so that no task sorts
    a whole hot group.
    """
    k = max(0, int(k))
    if k == 0:
        return df.withColumn(rank, F.lit(0)).where(F.lit(False))
    if k > PRUNED_K:
        salted = df.withColumn("_salt", F.pmod(F.xxhash64(*df.columns), F.lit(SALTS)))
        part = Window.partitionBy(*group, "_salt").orderBy(*order)
        df = (
            salted.withColumn("_place", F.row_number().over(part))
            .where(F.col("_place") <= k)
            .drop("_salt", "_place")
        )
    whole = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(whole)).where(F.col(rank) <= k)


def number_rows(df: DataFrame, order: Sequence[Column], name: str = "pos") -> DataFrame:
    """Dense 0-based position under a total order, without a single-task sort.

    The range-sorted rows are written once: Spark samples range bounds anew in
    every run, so offsets counted in one run only fit the copy they were
    counted on. The driver sees one count per partition.
    """
    share = F.shiftrightunsigned(F.col("_at"), 33)
    placed = settle_table(
        df.orderBy(*order).withColumn("_at", F.monotonically_increasing_id())
    )
    counts = {r[0]: r[1] for r in placed.groupBy(share).count().collect()}
    before, offsets = 0, []
    for part in range(max(counts, default=-1) + 1):
        offsets.append(before)
        before += counts.get(part, 0)
    if not offsets:
        return placed.withColumn(name, F.lit(0).cast("long")).drop("_at")
    starts = F.array(*[F.lit(x).cast("long") for x in offsets])
    within = F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    return placed.withColumn(name, F.get(starts, share.cast("int")) + within).drop("_at")


def first_rows(df: DataFrame, order: Sequence[Column], n: int, key: str) -> DataFrame:
    """The first n rows under a total order, with their 0-based place.

    `key` identifies a row; only key and order columns are sorted, the full rows
    are looked up afterwards.
    """
    narrow = df.select(F.col(key), *[_order_input(c, i) for i, c in enumerate(order)])
    keys = [_reordered(c, i) for i, c in enumerate(order)]
    if n <= PRUNED_K:
        cut = narrow.orderBy(*keys).limit(n)
        placed = cut.select(
            key, (F.row_number().over(Window.orderBy(*keys)) - 1).cast("long").alias("place")
        )
        return df.join(F.broadcast(placed), key)
    placed = number_rows(narrow, keys, "place").where(F.col("place") < n).select(key, "place")
    return df.join(placed, key)


class Desc(str):
    """Marks a column name that sorts downwards."""


def _order_input(column: str | Column, i: int) -> Column:
    return (F.col(str(column)) if isinstance(column, str) else column).alias(f"_o{i}")


def _reordered(column: str | Column, i: int) -> Column:
    col = F.col(f"_o{i}")
    return col.desc() if isinstance(column, Desc) else col.asc()


def sample_key(ident: Column, seed: int = fv.SEED) -> Column:
    """Repeatable pseudo-random number of an id: the first 60 bits of a digest."""
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), ident.cast("string")))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")


def random_rows(df: DataFrame, n: int, key: str = "pos", seed: int = fv.SEED) -> DataFrame:
    """n rows without replacement, picked by sample key; `place` is the draw order."""
    return first_rows(df, [sample_key(F.col(key), seed), F.col(key)], n, key)


def first_of_each(df: DataFrame, keys: Sequence[str], order: Sequence[str], row_key: str):
    """Keep the first row of every key.

    The winner is found by a partial aggregate over narrow rows, so a key that
    holds a third of the table costs one row per task.
    """
    place = [F.col(c).alias(f"_o{i}") for i, c in enumerate(order)]
    winner = df.groupBy(*keys).agg(F.min(F.struct(*place, F.col(row_key).alias("_row"))).alias("_first"))
    kept = winner.select(F.col("_first._row").alias(row_key))
    return df.join(kept, row_key, "left_semi")


@dataclass(frozen=True)
class QueryBatch:
    """A table of queries with its counted size.

    rows and words (text tokens) are None beyond the broadcast limit; top_k is
    the largest any query asks for, and uniform tells that all ask for the same.
    """

    df: DataFrame
    rows: int | None
    top_k: int
    words: int | None = None
    uniform: bool = False

    @classmethod
    def of(cls, queries: DataFrame, default_k: int = 10) -> "QueryBatch":
        """Count the batch once; top_k is clamped at zero."""
        if "top_k" not in queries.columns:
            queries = queries.withColumn("top_k", F.lit(default_k))
        queries = queries.withColumn("top_k", F.greatest(F.col("top_k").cast("int"), F.lit(0)))
        words = F.size(tokens("text")) if "text" in queries.columns else F.lit(0)
        row = queries.agg(
            F.count("*").alias("n"), F.max("top_k").alias("high"), F.min("top_k").alias("low"),
            F.coalesce(F.sum(words), F.lit(0)).alias("words"),
        ).first()
        within = [x if x <= BROADCAST_ROWS else None for x in (row.n, row.words)]
        return cls(queries, within[0], row.high or 0, within[1], row.low == row.high)

    def cut(self, ranked: DataFrame, rank: str = "rank") -> DataFrame:
        """Apply each query's own top_k to rows ranked up to the batch's top_k."""
        if self.uniform:
            return ranked
        limits = small_side(self.df.select("query_id", "top_k"), self.rows)
        return ranked.join(limits, "query_id").where(F.col(rank) <= F.col("top_k")).drop("top_k")
