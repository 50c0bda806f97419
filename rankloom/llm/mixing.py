"""Mixing sources to target weights by Pfair scheduling.

Each source's rows, in an order by hash, are cut into blocks of equal size. Of
each slot the sources that still have blocks take shares in the proportion of
their weights, and a source leaves when its shares make up its blocks; the
others then share its part. So the sum of a source's shares by a slot is a
known number, without rounding. A block is released at the slot in which the
shares reach into it and must have its place before they go beyond it; the
earliest deadline among released blocks takes a slot. At every slot each source
then has had the sum of its shares so far to within less than one block, and
every row has its place, once.
"""

from __future__ import annotations

import heapq
import math
from bisect import bisect_right
from collections.abc import Iterator, Mapping
from dataclasses import dataclass
from fractions import Fraction

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import settle_table
from .shards import number

BATCH = 1 << 16


def check_weights(weights: Mapping[str, float]) -> None:
    if not all(0 < w < math.inf for w in weights.values()):
        raise ValueError("weights must be above 0")


def exact(weight: float) -> Fraction:
    """The weight as it is written: 0.1 is a tenth."""
    return Fraction(weight) if isinstance(weight, int | Fraction) else Fraction(repr(float(weight)))


def whole_weights(weights: Mapping[str, float], resolution: int = 1000) -> dict[str, int]:
    """Whole numbers of sum `resolution` in the weights' proportion, by largest remainders; to be read, the mix has the weights."""
    if not weights:
        return {}
    check_weights(weights)
    total = sum(map(exact, weights.values()))
    shares = {s: exact(w) / total * resolution for s, w in weights.items()}
    parts = {s: math.floor(x) for s, x in shares.items()}
    left = resolution - sum(parts.values())
    for s in sorted(shares, key=lambda s: (parts[s] - shares[s], s))[:left]:
        parts[s] += 1
    return parts


class Shares:
    """Sums of the shares of sources, as exact numbers."""

    def __init__(self, blocks: Mapping[str, int], weights: Mapping[str, float]):
        ratios = {s: exact(weights[s]) for s in blocks}
        common = math.lcm(*(r.denominator for r in ratios.values()))
        self.weight = {s: r.numerator * (common // r.denominator) for s, r in ratios.items()}
        # A source leaves when the turns, of one weight each, are its blocks by its weight.
        leaving = sorted((Fraction(n, self.weight[s]), s) for s, n in blocks.items())
        self.ends = [end for end, _ in leaving]
        self.done, self.live = [0], [sum(self.weight.values())]
        for _, s in leaving:
            self.done.append(self.done[-1] + blocks[s])
            self.live.append(self.live[-1] - self.weight[s])
        self.at = dict.fromkeys(blocks, 0)

    def slots(self, source: str, i: int) -> tuple[int, int]:
        """The slots, as a whole number and its divisor, in which the shares of a source are i blocks; i must not fall."""
        weight, at = self.weight[source], self.at[source]
        if at < len(self.ends) and self.ends[at].numerator * weight <= i * self.ends[at].denominator:
            at = self.at[source] = bisect_right(self.ends, Fraction(i, weight), at)
        return self.done[at] * weight + i * self.live[at], weight


def schedule(blocks: Mapping[str, int], weights: Mapping[str, float]) -> Iterator[tuple[str, int]]:
    """Source and block of each slot, by earliest deadline first; equal deadlines by name."""
    blocks = {s: n for s, n in blocks.items() if n}
    shares = Shares(blocks, weights)
    waiting = [(0, s, 0) for s in sorted(blocks)]  # release, source, block
    ready: list[tuple[int, str, int]] = []
    for slot in range(sum(blocks.values())):
        while waiting and waiting[0][0] <= slot:
            _, s, i = heapq.heappop(waiting)
            n, divisor = shares.slots(s, i + 1)
            heapq.heappush(ready, (-(-n // divisor), s, i))
        _, s, i = heapq.heappop(ready)
        yield s, i
        if i + 1 < blocks[s]:
            n, divisor = shares.slots(s, i + 1)
            heapq.heappush(waiting, (n // divisor, s, i + 1))


@dataclass
class Phase:
    """Slots from `start` to the last block of a source, and the weights of those that are live, to be read."""

    start: int
    length: int
    parts: dict[str, int]


def phases(counts: Mapping[str, int], weights: Mapping[str, float], block_rows: int, resolution: int) -> list[Phase]:
    """One phase per source; each ends with the last block of a source."""
    blocks = {s: -(-n // block_rows) for s, n in counts.items() if n}
    live, start, out = set(blocks), 0, []
    for slot, (s, i) in enumerate(schedule(blocks, weights)):
        if i + 1 == blocks[s]:
            out.append(Phase(start, slot + 1 - start, whole_weights({x: weights[x] for x in live}, resolution)))
            live.remove(s)
            start = slot + 1
    return out


def _plan(weights: Mapping[str, float] | None, block_rows: int, temperature: float):
    """The slot of each block and the position of its first row."""
    least = min(weights.values(), default=1.0) if weights is not None else 1.0

    def work(batches):
        counts = {}
        for batch in batches:
            counts |= zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)
        given = {s: n**temperature if weights is None else weights.get(s, least) for s, n in counts.items()}
        check_weights(given)
        position, rows = 0, []
        for slot, (s, i) in enumerate(schedule({s: -(-n // block_rows) for s, n in counts.items()}, given)):
            rows.append((s, i, slot, position))
            position += min(block_rows, counts[s] - i * block_rows)
            if len(rows) == BATCH:
                yield _batch(rows)
                rows = []
        if rows:
            yield _batch(rows)

    return work


def _batch(rows: list[tuple[str, int, int, int]]) -> pa.RecordBatch:
    source, *numbers = zip(*rows, strict=True)
    arrays = [pa.array(source, pa.string()), *(pa.array(x, pa.int64()) for x in numbers)]
    return pa.RecordBatch.from_arrays(arrays, ["_of", "_block", "mix_slot", "_first"])


def mix(
    docs: DataFrame, weights: Mapping[str, float] | None = None, source: str = "source", key: str = "doc_id", text: str = "text",
    block_rows: int = 16, temperature: float = 0.5,
) -> DataFrame:
    """Adds source_block, mix_slot and mix_position (0, 1, ..., without gaps); rows are not in order yet.

    weights: by source; a source without one has the least given weight. None:
    counts to the power of `temperature`, which raises small sources. A null
    source is the source "". Repeated rows have a place each. Any number of sources has a
    place: one task holds their counts and writes a row for each block, which
    rows are joined with; nothing comes to the driver. Other columns
    stay; columns of the new names are replaced.
    """
    check_weights(weights or {})
    docs = docs.drop("source_block", "mix_slot", "mix_position")
    rows = docs.withColumn("_source", F.coalesce(F.col(source).cast("string"), F.lit("")))
    counts = settle_table(rows.groupBy("_source").count())
    total = counts.agg(F.sum("count")).first()[0] or 0
    plan = counts.coalesce(1).mapInArrow(
        _plan(weights, block_rows, temperature), "_of string, _block long, mix_slot long, _first long"
    )
    plan = settle_table(plan)
    numbered = number(
        rows, "_source", [F.col(key), F.crc32(F.coalesce(F.col(text), F.lit("")).cast("binary"))], total, into="_number",
    )
    numbered = numbered.withColumn("source_block", F.floor(F.col("_number") / block_rows).cast("long"))
    placed = numbered.join(plan, (F.col("_source") == F.col("_of")) & (F.col("source_block") == F.col("_block")))
    placed = placed.withColumn("mix_position", F.col("_first") + F.col("_number") % block_rows)
    return placed.select(*(c for c in docs.columns), "source_block", "mix_slot", "mix_position")


def in_order(mixed: DataFrame) -> DataFrame:
    """The rows sorted by position, so that files and rows within them follow the mix."""
    return mixed.orderBy("mix_position").drop("source_block", "mix_slot", "mix_position")
