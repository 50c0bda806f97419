"""Jaccard join of documents on word shingles, heavy and light sets apart.

Two sets with a Jaccard similarity of t share t of the larger one at least. So
if a set's shingles are ranked by one order for all sets, the c smallest shared
ones stand among its first n - ceil(t n) + c. Of light sets all pairs (c = 2)
of these are signatures, of heavy sets the single ones (c = 1), whose inverted
lists are scanned; the boundary between them has the least cost over the sizes
found. Sets just below the boundary have both, as their partners can be heavy.

The order is by frequency, rare first, so that passages which many documents
share make no long lists. Frequencies are counted over all documents in a table of fixed
size by hash; any order gives the same links.

Equal sets are one class from the start. Candidates come in rounds of stars: first
each class is compared with the class at the head of most of its lists; then,
within lists, what is not yet in one component is compared with some members of the list's
largest component, as long as a round halves what is apart. Only the last round pairs freely,
and only what the stars left apart.

Signatures travel packed: a task sorts those of many sets and sends each part of the
range as one compressed block, in which a set is named once.

A pair also needs room: the elements behind its smallest shared ones bound what
it shares, so sets that agree in a common passage alone are no candidates.
Before whole sets are sent, pairs are tested on parity sketches, a bit an
element or more: bits that differ are no more than elements that do, so no
pair that links is lost.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import batched
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import settle_table
from .common import annotate, pieces, small_batches, values
from .graph import components

WORDS = 5
PERCENT = 75
COUNT_BITS = 23
FILTER_BITS = 24
CHUNK = 1 << 14  # entries of a table that travel together
CODEC = "lz4"
BLOCK = 1 << 16  # bytes of a text whose words are hashed together
ENTRIES = 1 << 21  # signatures that are sorted at once, and of a part on average
CENTERS = 16  # members of a list's largest component that others are compared with in a round
_GAP = re.compile(rb"[\t-\r ]")
_ODD = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93)]


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _ODD[1]
    x = (x ^ (x >> np.uint64(27))) * _ODD[2]
    return x ^ (x >> np.uint64(31))


_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
#: A 64-bit number for each byte.
_OF_BYTE = mixed(np.arange(1, 257, dtype=np.uint64) * _ODD[0])
_POWERS = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse modulo 2^64, n at least."""
    if len(_POWERS[0]) < n:
        size = 1 << (n - 1).bit_length()
        for i, base in enumerate((int(_ODD[1]), pow(int(_ODD[1]), -1, 1 << 64))):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _POWERS[i] = np.multiply.accumulate(steps)
    return _POWERS[0], _POWERS[1]


def word_hashes(text: bytes) -> np.ndarray:
    """64-bit hashes of the words of a whole text, block by block, so that memory follows the words and not the bytes."""
    found, at = [], 0
    while len(text) - at > BLOCK:
        gap = _GAP.search(text, at + BLOCK)
        to = gap.start() if gap else len(text)
        found.append(_block_hashes(text[at:to]))
        at = to
    return np.concatenate([*found, _block_hashes(text[at:])]) if found else _block_hashes(text)


def _block_hashes(text: bytes) -> np.ndarray:
    """Hashes of the words, all at once: differences of one running sum over the text, moved to a common power."""
    data = np.frombuffer(text, np.uint8)
    inside = np.concatenate([[False], ~_SPACE[data], [False]])
    edges = np.nonzero(inside[1:] != inside[:-1])[0]
    starts, ends = edges[::2], edges[1::2]
    up, down = powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_OF_BYTE[data] * up[: len(data)], out=sums[1:])
    return mixed((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def shingles(text: bytes | None) -> np.ndarray:
    """The set as sorted 64-bit hashes; A-Z lower-cased, fewer than WORDS words make one shingle."""
    run = word_hashes((text or b"").lower())
    if not len(run):
        return run
    size = min(WORDS, len(run))
    out = np.full(len(run) - size + 1, size, dtype=np.uint64)
    for i in range(size):
        out = mixed(out * _ODD[0] + run[i : len(run) - size + 1 + i])
    return np.unique(out)


def set_class(found: np.ndarray) -> int:
    """A number that stands for the set (64 bits, as those of shingles)."""
    return xxhash.xxh64_intdigest(found.tobytes(), seed=len(found)) - (1 << 63)


def text_mark(text: bytes | None) -> int:
    """A number that tells texts apart at less cost than their sets."""
    return xxhash.xxh64_intdigest(text or b"") - (1 << 63)


def sketch(found: np.ndarray) -> bytes:
    """Parities of the elements by hash, on a power of two of bits, 64 at least and as many as elements."""
    bits = max(6, (len(found) - 1).bit_length())
    odd = np.bincount((found >> np.uint64(8)).astype(np.int64) & (1 << bits) - 1, minlength=1 << bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def may_link(n: int, x: bytes, m: int, y: bytes) -> bool:
    """Whether sizes and sketches leave the similarity possible."""
    if 100 * min(n, m) < PERCENT * max(n, m):
        return False
    a, b = np.frombuffer(x, np.uint8), np.frombuffer(y, np.uint8)
    size = min(len(a), len(b))
    # A longer sketch folds to a shorter one, as parities add up.
    a, b = (np.bitwise_xor.reduce(v.reshape(-1, size), axis=0) for v in (a, b))
    differ = int(np.bitwise_count(a ^ b).sum())
    # shared <= (n + m - differ) / 2 must reach the percentage of the union.
    shared = (n + m - differ) // 2
    return 100 * shared >= PERCENT * (n + m - shared)


def needed(n: int) -> int:
    """Shared elements at least, of a set of n."""
    return -(-PERCENT * n // 100)


def signatures(found: np.ndarray, frequency: np.ndarray, boundary: int) -> tuple[np.ndarray, np.ndarray]:
    """Signatures, and the room of each: what a set can share if a signature holds its smallest shared elements."""
    n = len(found)
    # The set is sorted, so a stable sort leaves equally frequent ones in the order of their hashes.
    ranked = found[np.argsort(frequency[found >> np.uint64(64 - COUNT_BITS)], kind="stable")]
    out, room = [found[:0]], [np.zeros(0, np.int32)]
    if n >= 2 and n < boundary:
        first = ranked[: n - needed(n) + 2]
        i, j = np.triu_indices(len(first), 1)
        out.append(mixed(mixed(first[i] + _ODD[0]) + first[j]))
        room.append((n - j + 1).astype(np.int32))
    if n >= needed(boundary):
        first = ranked[: n - needed(n) + 1]
        out.append(mixed(first + _ODD[3]))
        room.append((n - np.arange(len(first))).astype(np.int32))
    return np.concatenate(out).view(np.int64), np.concatenate(room)


def signature_count(n: int, boundary: int) -> int:
    """Signatures of a set of n."""
    light = comb(n - needed(n) + 2, 2) if 2 <= n < boundary else 0
    return light + (n - needed(n) + 1 if n >= needed(boundary) else 0)


def boundary_of(sizes: dict[int, int], scan: int = 8, most: int = 400) -> int:
    """The least size of a heavy set, by cost: a signature costs 1 and an entry of a scanned list `scan`."""
    light = {n: k * comb(n - needed(n) + 2, 2) for n, k in sizes.items()}
    heavy = {n: k * scan * (n - needed(n) + 1) for n, k in sizes.items()}
    cost = lambda x: sum(c for n, c in light.items() if n < x) + sum(c for n, c in heavy.items() if n >= needed(x))
    return min(range(2, most + 1), key=lambda x: (cost(x), x))


def combined(chunks: DataFrame, sums: bool, size: int) -> np.ndarray:
    """A table of `size` bytes that came in chunks (chunk, data): unions of bits, or levels of sums.

    Chunks of one number are combined in a stream in one task; the whole, whose
    size is fixed, comes to the driver.
    """

    def run(batches):
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for at, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                part = _unpacked(data)
                if at not in held:
                    held[at] = part.astype(np.uint64 if sums else np.uint8)
                elif sums:
                    held[at] += part
                else:
                    held[at] |= part
        yield from _chunk_batches({at: levels(part) for at, part in held.items()} if sums else held)

    whole = np.zeros(size, np.uint8)
    for at, data in chunks.select("chunk", "data").repartition("chunk").mapInArrow(run, "chunk int, data binary").collect():
        part = _unpacked(data)
        whole[at * CHUNK : at * CHUNK + len(part)] = part
    return whole


def levels(counts: np.ndarray) -> np.ndarray:
    """Frequencies as bytes, eight steps to a doubling: all that an order by frequency asks for."""
    return np.minimum(np.ceil(8 * np.log2(counts + 1.0)), 255).astype(np.uint8)


def _packed(part: np.ndarray) -> bytes:
    """The chunk compressed, in bytes if its numbers are that small; the first byte is the width."""
    width = 1 if int(part.max(initial=0)) < 256 else 4
    return bytes([width]) + pa.compress(part.astype(f"u{width}").tobytes(), CODEC, asbytes=True)


def _unpacked(data: bytes) -> np.ndarray:
    width = data[0]
    return np.frombuffer(pa.decompress(data[1:], CHUNK * width, CODEC, asbytes=True), f"u{width}")


def _chunk_batches(held: dict[int, np.ndarray]) -> Iterator[pa.RecordBatch]:
    """The chunks, some at a time."""
    for part in batched(held.items(), 64):
        at, data = [k for k, _ in part], [_packed(x) for _, x in part]
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(data, pa.binary())], ["chunk", "data"])


def _chunks(table: np.ndarray) -> dict[int, np.ndarray]:
    """Chunks that aren't empty; a table holds a whole number of them."""
    parts = enumerate(table.reshape(-1, CHUNK))
    return {at: part for at, part in parts if part.any()}


def _survey(docs: DataFrame, key: str, text: str) -> DataFrame:
    """key, n, set, seen, sketch: per document; and, with a chunk number, the task's shingle counts."""
    fields = docs.select(key).schema[0]
    ddl = f"`{key}` {fields.dataType.simpleString()}, n int, `set` long, seen long, sketch binary, chunk int, data binary"

    def run(batches):
        counts = np.zeros(1 << COUNT_BITS, np.uint32)
        names = [key, "n", "set", "seen", "sketch", "chunk", "data"]
        key_type = None
        for batch in batches:
            key_type = batch.schema.field(0).type
            for piece in pieces(batch):
                sizes, classes, seen, marks = [], [], [], []
                for value in values(piece.column(1)):
                    found = shingles(value)
                    sizes.append(len(found))
                    classes.append(set_class(found) if len(found) else None)
                    seen.append(text_mark(value))
                    marks.append(sketch(found) if len(found) else None)
                    np.add.at(counts, found >> np.uint64(64 - COUNT_BITS), 1)
                none = piece.num_rows
                arrays = [piece.column(0), pa.array(sizes, pa.int32()), pa.array(classes, pa.int64()), pa.array(seen, pa.int64())]
                arrays += [pa.array(marks, pa.binary()), pa.nulls(none, pa.int32()), pa.nulls(none, pa.binary())]
                yield pa.RecordBatch.from_arrays(arrays, names)
        if key_type is not None:
            for part in _chunk_batches(_chunks(counts)):
                rows = part.num_rows
                arrays = [pa.nulls(rows, t) for t in (key_type, pa.int32(), pa.int64(), pa.int64(), pa.binary())]
                yield pa.RecordBatch.from_arrays([*arrays, *part.columns], names)

    return docs.select(key, text).mapInArrow(run, ddl)


def _planes(numbers: np.ndarray) -> bytes:
    """The numbers byte by byte of their places, so that empty places compress."""
    return numbers.view(np.uint8).reshape(-1, numbers.itemsize).T.tobytes()


def pack(sig: np.ndarray, room: np.ndarray, of: np.ndarray, classes: np.ndarray, sizes: np.ndarray) -> bytes:
    """A block of signatures in ascending order; `of` places each one's set in classes and sizes."""
    used, of = np.unique(of, return_inverse=True)
    steps = np.diff(sig, prepend=np.uint64(0))
    columns = [steps, room.astype(np.uint32), of.astype(np.uint32), classes[used].astype(np.int64), sizes[used].astype(np.uint32)]
    body = b"".join(map(_planes, columns))
    head = np.array([len(sig), len(used), len(body)], np.uint32).tobytes()
    return head + pa.compress(body, "zstd", asbytes=True)


def unpack(data: bytes) -> list[np.ndarray]:
    """sig, set, n, room of a block, a row for each signature."""
    rows, used, size = np.frombuffer(data[:12], np.uint32).tolist()
    body, at, columns = pa.decompress(data[12:], size, "zstd", asbytes=True), 0, []
    for count, kind in [(rows, np.uint64), (rows, np.uint32), (rows, np.uint32), (used, np.int64), (used, np.uint32)]:
        to = at + count * np.dtype(kind).itemsize
        columns.append(np.frombuffer(body[at:to], np.uint8).reshape(-1, count).T.copy().view(kind).ravel())
        at = to
    steps, room, of, classes, sizes = columns
    return [np.cumsum(steps, dtype=np.uint64), classes[of], sizes[of].astype(np.int32), room.astype(np.int32)]


def _with_signatures(docs: DataFrame, text: str, frequency: np.ndarray, boundary: int, parts: int) -> DataFrame:
    """part, data: blocks of the signatures of all sets, each part a range of signatures; a task sends copies once a block."""
    held = docs.sparkSession.sparkContext.broadcast(frequency)

    def blocks(waiting):
        classes, sizes, found, rooms = (list(x) for x in zip(*waiting, strict=True))
        of = np.repeat(np.arange(len(found)), [len(x) for x in found])
        sig, room = np.concatenate(found).view(np.uint64), np.concatenate(rooms)
        order = np.argsort(sig)
        sig, room, of = sig[order], room[order], of[order]
        part = ((sig >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)
        cuts = np.nonzero(np.diff(part, prepend=-1))[0]
        classes, sizes = np.array(classes, np.int64), np.array(sizes, np.int64)
        for some in batched(zip(cuts, [*cuts[1:], len(sig)], strict=True), 64):
            data = [pack(sig[i:j], room[i:j], of[i:j], classes, sizes) for i, j in some]
            at = pa.array([int(part[i]) for i, _ in some], pa.int32())
            yield pa.RecordBatch.from_arrays([at, pa.array(data, pa.binary())], ["part", "data"])

    def run(batches):
        marks, told, waiting, rows = set(), set(), [], 0
        for batch in batches:
            for piece in pieces(batch):
                for value in values(piece.column(0)):
                    mark = text_mark(value)
                    if mark in marks:
                        continue
                    marks.add(mark)
                    found = shingles(value)
                    of = set_class(found) if len(found) else None
                    if of is None or of in told:
                        continue
                    told.add(of)
                    waiting.append((of, len(found), *signatures(found, held.value, boundary)))
                    rows += len(waiting[-1][2])
                    if rows >= ENTRIES:
                        yield from blocks(waiting)
                        marks, told, waiting, rows = set(), set(), [], 0
        if rows:
            yield from blocks(waiting)

    return docs.select(text).mapInArrow(run, "part int, data binary")


def listed(held: list[np.ndarray], entries: list[np.ndarray]) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Heads of lists (sig, set, n, room; by sig) with those of new lists, and entries beside the heads of their lists.

    An entry that is its list's head, or stands twice, is left out.
    """
    order = np.lexsort((entries[1], entries[0]))
    entries = [x[order] for x in entries]
    new = np.ones(len(order), bool)
    new[1:] = entries[0][1:] != entries[0][:-1]
    once = new.copy()
    once[1:] |= entries[1][1:] != entries[1][:-1]
    firsts = [x[new] for x in entries]
    at = np.searchsorted(held[0], firsts[0])
    known = np.zeros(len(at), bool)
    inside = at < len(held[0])
    known[inside] = held[0][at[inside]] == firsts[0][inside]
    for old, first in zip(held, firsts, strict=True):
        first[known] = old[at[known]]
    of = np.cumsum(new) - 1
    beside = once & (entries[1] != firsts[1][of])
    rows = [x[beside] for x in entries] + [x[of[beside]] for x in firsts[1:]]
    # All of firsts that were known are held already.
    held = [np.concatenate([old, first[~known]]) for old, first in zip(held, firsts, strict=True)]
    order = np.argsort(held[0], kind="stable")
    return [x[order] for x in held], rows


def _best_other(x: np.ndarray, starts: np.ndarray, of: np.ndarray) -> np.ndarray:
    """The largest of x in the rest of each entry's list; lists begin at `starts`, `of` numbers each entry's."""
    best = np.maximum.reduceat(x, starts)
    top = x == best[of]
    none = np.iinfo(x.dtype).min
    second = np.maximum.reduceat(np.where(top, none, x), starts)
    second = np.where(np.add.reduceat(top, starts, dtype=np.int64) > 1, best, second)
    return np.where(top, second[of], best[of])


def _runs(sig: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the lists of sorted signatures begin, and the number of each entry's list."""
    new = np.ones(len(sig), bool)
    new[1:] = sig[1:] != sig[:-1]
    return np.nonzero(new)[0], np.cumsum(new) - 1


def _of_several(entries: list[np.ndarray]) -> list[np.ndarray]:
    """The entries of lists that have two or more, sorted by signature."""
    of = _runs(entries[0])[1]
    several = np.bincount(of)[of] > 1
    return [x[several] for x in entries]


def whole_lists(entries: list[np.ndarray]) -> list[np.ndarray]:
    """Members beside the first of their list, itself a row, of whole lists: those that may be roomy with another member.

    The bounds are the largest room to spare and the least size among the others, so no roomy pair is lost.
    """
    order = np.lexsort((entries[1], entries[0]))
    sig, own = entries[0][order], entries[1][order]
    once = np.ones(len(order), bool)
    once[1:] = (sig[1:] != sig[:-1]) | (own[1:] != own[:-1])
    entries = _of_several([x[order[once]] for x in entries])
    if len(entries[0]):
        starts, of = _runs(entries[0])
        size = PERCENT * entries[2].astype(np.int64)
        spare = (100 + PERCENT) * entries[3].astype(np.int64) - size
        partner = (_best_other(spare, starts, of) >= size) & (-_best_other(-size, starts, of) <= spare)
        entries = _of_several([x[partner] for x in entries])
    starts, of = _runs(entries[0])
    return entries + [x[starts[of]] for x in entries[1:]]


def with_heads(out: list[np.ndarray], told: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Entries beside the heads of their lists, and a row for each head whose list isn't among `told` signatures; with those now told."""
    sig, first = np.unique(out[0], return_index=True)
    first = first[~np.isin(sig, told, assume_unique=True)]
    heads = [x[first] for x in (out[0], *out[4:], *out[4:])]
    return [np.concatenate([x, y]) for x, y in zip(out, heads, strict=True)], np.union1d(told, sig)


def _lists_of(blocks: DataFrame, parts: int) -> DataFrame:
    """sig, set, n, room, head (set, n, room): members of lists of two sets or more, with the first one, itself a row.

    A task whose parts fit in one step leaves out members that are roomy with
    none. Others stream the blocks and hold one entry a signature, so a list's
    length doesn't matter.
    """

    def run(batches):
        kinds = (np.uint64, np.int64, np.int32, np.int32)
        held, waiting, rows = [np.zeros(0, k) for k in kinds], [], 0
        told = np.zeros(0, np.uint64)

        def step(whole=False):
            nonlocal held, told
            entries = [np.concatenate(x) for x in zip(*waiting, strict=True)]
            if whole:
                out = whole_lists(entries)
            else:
                held, out = listed(held, entries)
                out, told = with_heads(out, told)
            for at in range(0, len(out[0]), 1 << 16):
                sig, *rest = (x[at : at + (1 << 16)] for x in out)
                own, head = rest[:3], pa.StructArray.from_arrays([pa.array(x) for x in rest[3:]], ["set", "n", "room"])
                yield pa.RecordBatch.from_arrays([*map(pa.array, [sig.view(np.int64), *own]), head], ["sig", "set", "n", "room", "head"])

        for batch in batches:
            for data in batch.column(1).to_pylist():
                waiting.append(unpack(data))
                rows += len(waiting[-1][0])
                if rows >= ENTRIES:
                    yield from step()
                    waiting, rows = [], 0
        if rows:
            yield from step(whole=not len(held[0]))

    ddl = "sig long, `set` long, n int, room int, head struct<`set`: long, n: int, room: int>"
    return blocks.repartition(parts, "part").mapInArrow(run, ddl)


def _sets(docs: DataFrame, text: str, wanted: DataFrame) -> DataFrame:
    """set, elements of the classes of which `wanted` (seen) has a text, each once.

    A bit table of fixed size, asked by the mark of a text, keeps the sets of most
    other documents from being made and sent; the join with the result is exact.
    """

    def mark(batches):
        bits = np.zeros(1 << FILTER_BITS - 3, np.uint8)
        for batch in batches:
            at = batch.column(0).to_numpy().astype(np.int64).view(np.uint64) >> np.uint64(64 - FILTER_BITS)
            np.bitwise_or.at(bits, at >> np.uint64(3), (1 << (at & np.uint64(7))).astype(np.uint8))
        yield from _chunk_batches(_chunks(bits))

    bits = combined(wanted.select("seen").mapInArrow(mark, "chunk int, data binary"), False, 1 << FILTER_BITS - 3)
    held = docs.sparkSession.sparkContext.broadcast(bits)

    def start():
        table = held.value

        def work(texts):
            classes, elements = [], []
            for text in texts:
                at = (text_mark(text) & (1 << 64) - 1) >> 64 - FILTER_BITS
                found = shingles(text) if table[at >> 3] >> (at & 7) & 1 else ()
                classes.append(set_class(found) if len(found) else None)
                elements.append(found.view(np.int64) if len(found) else None)
            return classes, elements

        return work

    rows = annotate(docs.select(text), [text], "`set` long, elements array<long>", start, keep=[])
    return rows.where(F.col("set").isNotNull()).groupBy("set").agg(F.any_value("elements").alias("elements"))


def _possible(pairs: DataFrame, sketches: DataFrame) -> DataFrame:
    """The pairs (a, b, ...) that sizes and sketches leave possible."""
    of = lambda c: sketches.select(F.col("set").alias(c), F.col("n").alias(f"n_{c}"), F.col("sketch").alias(f"s_{c}"))
    both = pairs.join(of("a"), "a").join(of("b"), "b").where(similar("n_a", "n_b"))

    def start():
        return lambda *columns: [list(map(may_link, *columns))]

    tested = annotate(both, ["n_a", "s_a", "n_b", "s_b"], "possible boolean", start, keep=pairs.columns)
    return tested.where("possible").drop("possible")


def _linked(pairs: DataFrame, docs: DataFrame, text: str, sketches: DataFrame) -> DataFrame:
    """The pairs (a, b) of classes that have the similarity, counted on whole sets.

    `sketches` names a text of each class. Both joins read one exchange of the sets.
    """
    pairs = settle_table(pairs.select("a", "b"))
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("set")).distinct()
    sets = _sets(docs, text, wanted.join(sketches.select("set", "seen"), "set"))
    shared = F.size(F.array_intersect("x", "y"))
    return (
        pairs.join(sets.select(F.col("set").alias("b"), F.col("elements").alias("y")), "b")
        .join(sets.select(F.col("set").alias("a"), F.col("elements").alias("x")), "a")
        .where(100 * shared >= PERCENT * (F.size("x") + F.size("y") - shared))
        .select("a", "b")
    )


def _open(members: DataFrame, found: DataFrame) -> DataFrame:
    """sig, set, n, room, component of the lists whose members are not yet in one component, as a written table."""
    placed = members.drop("component").join(found.withColumnRenamed("id", "set"), "set", "left")
    # The join below would ask for signatures in one of two uses; asked for here, both read one exchange.
    placed = placed.where("sig is not null").withColumn("component", F.coalesce("component", "set"))
    whole = placed.groupBy("sig").agg(
        F.min("component").alias("lo"), F.max("component").alias("hi"),
        F.count("*").alias("k"), F.sum(F.xxhash64("set", "n", "room").cast("decimal(38,0)")).alias("who"),
    )
    # Lists of the same members with the same room say the same: one of them does.
    chosen = whole.where("lo != hi").groupBy("k", "who").agg(F.min("sig").alias("sig"))
    return settle_table(placed.join(chosen.select("sig"), "sig", "left_semi"))


def _stars(lists: DataFrame, sketches: DataFrame) -> DataFrame:
    """Pairs (a, b) to compare: classes with CENTERS members at most of the component that has most of their list.

    Centers are those with most room; per component on the other side and slot of centers one pair is kept, that of most lists.
    """
    slot = lambda c: F.pmod(F.xxhash64(c), F.lit(CENTERS))
    of = lists.groupBy("sig", "component", slot("set").alias("slot"))
    of = of.agg(F.count("*").alias("k"), F.max(F.struct("room", "n", "set")).alias("center"))
    of = of.groupBy("sig", "component").agg(F.sum("k").alias("k"), F.collect_list("center").alias("centers"))
    to = of.groupBy("sig").agg(F.max_by(F.struct("component", "centers"), F.struct("k", "component")).alias("to"))
    rows = lists.join(to, "sig").where("component != to.component")
    rows = rows.select("set", "n", "room", "component", F.explode("to.centers").alias("to"))
    rows = rows.where(roomy("n", "to.n", "room", "to.room"))
    pairs = rows.groupBy(F.col("to.set").alias("a"), F.col("set").alias("b"), "component").agg(F.count("*").alias("k"))
    pairs = _possible(pairs, sketches).groupBy("component", slot("a").alias("slot"))
    return pairs.agg(F.max_by(F.struct("a", "b"), F.struct("k", "a", "b")).alias("p")).select("p.*")


def similar(n: str, m: str) -> str:
    return f"100 * least({n}, {m}) >= {PERCENT} * greatest({n}, {m})"


def roomy(n: str, m: str, room_n: str, room_m: str) -> str:
    """Sizes fit, and neither set has too little left behind the signature.

    This holds in at least one list, that of their smallest shared elements, for any two sets that link.
    """
    return f"{similar(n, m)} and {100 + PERCENT} * least({room_n}, {room_m}) >= {PERCENT} * ({n} + {m})"


def join(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: key, n_shingles, component_id (the smallest key reachable by links, its own included).

    Null and empty texts, and those of blanks, have the empty set, which links
    with nothing. Documents of equal sets are linked. A null key takes part in
    links, but is no smallest key unless there are none but null ones. Rows that share a
    key are documents of their own. No rows give no rows. Other columns are not
    read.
    """
    with small_batches(docs.sparkSession):
        out = _classed(docs, key, text)
    names = out.where("component is not null").groupBy("component").agg(F.min(key).alias("component_id"))
    return out.join(names, "component", "left").select(
        key, F.col("n").cast("long").alias("n_shingles"),
        F.when(F.col("component").isNull(), F.col(key)).otherwise(F.col("component_id")).alias("component_id"),
    )


def _classed(docs: DataFrame, key: str, text: str) -> DataFrame:
    """key, n, set, component (the smallest class reachable; null for empty sets) of each document, as a written table."""
    told = settle_table(_survey(docs, key, text))
    rows = told.where("chunk is null").select(key, "n", "set")
    sketches = told.where("chunk is null and n > 0").groupBy("set")
    sketches = sketches.agg(F.any_value("n").alias("n"), F.min("seen").alias("seen"), F.any_value("sketch").alias("sketch"))
    frequency = combined(told.where("chunk is not null"), True, 1 << COUNT_BITS)
    sizes = rows.where("n > 0").groupBy(F.expr("if(n <= 600, n, 0)").alias("size")).agg(F.count("*"), F.sum("n")).collect()
    sizes = {int(n): (k, total) for n, k, total in sizes}
    above = sum(sizes.pop(0, (0, 0)))  # more than the signatures of all larger sets
    sizes = {n: k for n, (k, _) in sizes.items()}
    boundary = boundary_of(sizes)
    # Copies are counted here, so parts have less than four fifths of a step.
    parts = 1 + 5 * (above + sum(k * signature_count(n, boundary) for n, k in sizes.items())) // (4 * ENTRIES)
    lists = settle_table(_lists_of(_with_signatures(docs, text, frequency, boundary, parts), parts))
    heads = lists.where("`set` != head.`set`").where(roomy("n", "head.n", "room", "head.room")).select(F.col("head.set").alias("a"), F.col("set").alias("b"))
    heads = heads.groupBy("a", "b").agg(F.count("*").alias("k"))
    heads = _possible(heads, sketches).groupBy("b").agg(F.max_by("a", F.struct("k", "a")).alias("a"))
    first = settle_table(_linked(heads, docs, text, sketches))
    found = components(first)
    # What the first round left apart, list by list, as long as stars halve it.
    members = _open(lists.select("sig", "set", "n", "room"), found)
    apart = members.count()
    while apart:
        first = settle_table(first.unionByName(_linked(_stars(members, sketches), docs, text, sketches)))
        found = components(first)
        members, before = _open(members, found), apart
        apart = members.count()
        if 2 * apart > before:
            break
    # All that is still apart.
    a, b = members.alias("a"), members.alias("b")
    pairs = a.join(b, F.expr(f"a.sig = b.sig and a.component < b.component and {roomy('a.n', 'b.n', 'a.room', 'b.room')}"))
    pairs = pairs.select(F.least("a.set", "b.set").alias("a"), F.greatest("a.set", "b.set").alias("b")).distinct()
    second = _linked(_possible(pairs, sketches), docs, text, sketches)
    found = components(first.unionByName(second))
    out = rows.join(found.withColumnRenamed("id", "set"), "set", "left").withColumn("component", F.coalesce("component", "set"))
    return settle_table(out)
