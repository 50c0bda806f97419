"""Sequences that may be long: places within a key, running totals, and digests of all a key's text.

A key may hold a third of all rows, so what can be cut is cut into ranges, each
a task of its own. Only what is defined in sequence (a digest, a state that is
handed on) passes one task per key, sorted and streamed, never held whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import annotate

#: Turn numbers, or places, that one range holds.
SPAN = 1024
#: Digest of no bytes.
NOTHING = hashlib.sha256(b"").hexdigest()


def numbered(rows: DataFrame, key: str, turn: str, ties: list[str], into: str = "at", span: int = SPAN) -> DataFrame:
    """Adds `into`: 0, 1, ... within each key by (turn, ties), null turns first.

    A key is numbered in ranges of `span` turn numbers. A range starts where the
    counts of the ranges before it end. Rows that agree in turn and ties may
    change places.
    """
    rows = rows.withColumn("__range", F.floor(F.col(turn) / span))
    counts = rows.groupBy(F.col(key).alias("__key"), F.col("__range").alias("__of")).agg(F.count("*").alias("__n"))
    before = Window.partitionBy("__key").orderBy("__of").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.withColumn("__start", F.coalesce(F.sum("__n").over(before), F.lit(0)))
    within = Window.partitionBy(key, "__range").orderBy(turn, *ties)
    placed = rows.withColumn("__row", F.row_number().over(within) - 1)
    same = F.col(key).eqNullSafe(F.col("__key")) & F.col("__range").eqNullSafe(F.col("__of"))
    return placed.join(starts, same).withColumn(into, F.col("__start") + F.col("__row")).drop(
        "__range", "__key", "__of", "__n", "__start", "__row"
    )


def running(
    rows: DataFrame, key: str, place: str, totals: dict[str, tuple[Callable[[Column], Column], Column, Column]], span: int = SPAN
) -> DataFrame:
    """Adds inclusive running totals by place: name -> (aggregate, value, how two parts make one, as a column of both).

    totals[name] = (aggregate, value, none): `aggregate` is F.sum or F.bit_xor,
    and `none` is its total over no rows. Places are whole numbers from 0; each
    range of `span` places is a task's.
    """
    rows = rows.withColumn("__range", F.floor(F.col(place) / span))
    parts = rows.groupBy(F.col(key).alias("__key"), F.col("__range").alias("__of")).agg(
        *[total(value).alias(f"__{name}") for name, (total, value, _) in totals.items()]
    )
    before = Window.partitionBy("__key").orderBy("__of").rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.select(
        "__key", "__of",
        *[F.coalesce(total(f"__{name}").over(before), none).alias(f"__{name}") for name, (total, _, none) in totals.items()],
    )
    upto = Window.partitionBy(key, "__range").orderBy(place).rowsBetween(Window.unboundedPreceding, 0)
    within = rows.withColumns({name: total(value).over(upto) for name, (total, value, _) in totals.items()})
    same = F.col(key).eqNullSafe(F.col("__key")) & (F.col("__range") == F.col("__of"))
    both = within.join(starts, same)
    joined = {
        name: (F.col(name).bitwiseXOR(F.col(f"__{name}")) if total is F.bit_xor else F.col(name) + F.col(f"__{name}"))
        for name, (total, _, _) in totals.items()
    }
    return both.withColumns(joined).drop("__range", "__key", "__of", *[f"__{name}" for name in totals])


def streamed(
    rows: DataFrame, key: str, order: list[Column], columns: list[str], fields: str, start: Callable, keep: list[str] | None = None
) -> DataFrame:
    """Rows of a key in order through one task; as `annotate`, whose function may carry a state from row to row."""
    return annotate(rows.repartition(F.col(key)).sortWithinPartitions(key, *order), columns, fields, start, keep=keep)


def digests(pieces: DataFrame, key: str, place: str, piece: str, between: str) -> DataFrame:
    """key, sha256: lowercase hex digest of each key's pieces in order of `place`, with `between` between them.

    key and place are of any type, place unique within the key; null pieces are
    left out. Pieces are joined where they are, so make them of many rows each:
    a digest is made in sequence, by one task a key, that holds one piece at a
    time.
    """
    sep = between.encode()

    def start():
        state = {"key": (), "sha": None}

        def work(keys, texts):
            out = []
            for k, text in zip(keys, texts, strict=True):
                if state["key"] != (k,):
                    state.update(key=(k,), sha=hashlib.sha256(text))
                else:
                    state["sha"].update(sep)
                    state["sha"].update(text)
                out.append(state["sha"].hexdigest())
            return [out]

        return work

    known = pieces.where(F.col(piece).isNotNull()).select(key, place, piece)
    made = streamed(known, key, [F.col(place)], [key, piece], "sha256 string", start, keep=[key, place])
    return made.groupBy(key).agg(F.max_by("sha256", place).alias("sha256"))
