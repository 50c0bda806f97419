"""Language-model scores by deleted interpolation.

The probability of a token is a mixture of maximum-likelihood estimates of all
orders and a uniform one. The weights depend on how often the longest known
context was seen, in buckets of powers of two, and are learned by expectation
maximisation on texts held back from the counts. The final counts are those of
all training texts.

The corpus is cut into blocks of whole texts. A block's distinct n-grams are
counted in one task and sent, once each, to the part of the hash range that
they belong to, where the blocks' counts are added up; the sums go back to
the blocks in the order in which they came, so they need no keys. A frequent n-gram is one
entry of each block, so no part is hot, and no table of n-grams is held anywhere whole.
Arrays travel packed (zstd). Tokens and n-grams are told apart by 64-bit hashes.

Sizes: a task holds a block, or BLOCK_TOKENS entries of a part. The exchange
has a row per block and part, so with the input the block size should grow
(and the executors' memory): 2^21 tokens suit 3 GB, 2^26 would suit 100 TB.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import _parse_datatype_string

from ..session import settle_table
from .common import pieces, values

BLOCK_TOKENS = 1 << 21
#: What a text serves for: the counts that weights are learned with, the learning of weights, or nothing.
COUNTED, WEIGHED, HELD_OUT = 0, 1, 2
#: No text has these as words.
END, BEGIN = b"\n", b" "
#: Buckets of context counts; the last holds all from 2^62 on.
BUCKETS = 63
LEAST_WEIGHT = 1e-6
#: Estimates are gathered in half powers of two.
STEP = 2.0


def packed(numbers: np.ndarray) -> bytes:
    return pa.compress(np.ascontiguousarray(numbers).tobytes(), "zstd", asbytes=True)


def unpacked(data: bytes, size: int, kind: str) -> np.ndarray:
    return np.frombuffer(pa.decompress(data, size * np.dtype(kind).itemsize, "zstd", asbytes=True), kind)


class _Numbers(dict):
    """Numbers words as they come; the end of a text is 0."""

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self)
        return number


class _Block:
    """Texts of one use, as numbers of their tokens."""

    def __init__(self):
        self.ids = _Numbers({END: 0})
        self.keys, self.sizes, self.tokens, self.n = [], [], [], 0

    def add(self, key, text: bytes | None) -> None:
        words = (text or b"").lower().split()
        made = np.fromiter(map(self.ids.__getitem__, words), np.int32, len(words))
        self.keys.append(key)
        self.sizes.append(len(words) + 1)
        self.tokens += [made, np.zeros(1, np.int32)]
        self.n += len(words) + 1

    def row(self, block: int, use: int) -> dict:
        words = np.fromiter(map(xxhash.xxh3_64_intdigest, self.ids), np.uint64, len(self.ids))
        return {
            "block": block, "use": use, "n_texts": len(self.keys), "n_tokens": self.n, "n_words": len(words), "keys": self.keys,
            "sizes": self.sizes, "tokens": packed(np.concatenate(self.tokens)), "words": packed(words),
        }


def blocks(docs: DataFrame, key: str, text: str, use: Column, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """A written table, one row per block of texts of one use: block, use, n_texts, n_tokens, n_words, keys, sizes, tokens, words.

    Tokens are runs of anything but ASCII white space, A-Z lower-cased, and one
    end per text; a null text is empty. A text is in one block, whole.
    """
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"), use.cast("int").alias("use"))
    kind = rows.schema["key"].dataType.simpleString()
    ddl = f"block long, use int, n_texts long, n_tokens long, n_words long, keys array<{kind}>, sizes array<int>, tokens binary, words binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, _Block] = {}
        place = TaskContext.get().partitionId() << 32
        for batch in batches:
            for piece in pieces(batch):
                for k, t, u in zip(piece.column(0).to_pylist(), values(piece.column(1)), piece.column(2).to_pylist(), strict=True):
                    now = held.setdefault(u, _Block())
                    now.add(k, t)
                    if now.n >= block_tokens:
                        yield pa.RecordBatch.from_pylist([held.pop(u).row(place, u)], schema)
                        place += 1
        for u, now in held.items():
            yield pa.RecordBatch.from_pylist([now.row(place, u)], schema)
            place += 1

    schema = to_arrow_schema(_parse_datatype_string(ddl))
    return settle_table(rows.mapInArrow(run, ddl))


def grams(row: dict, order: int) -> list[np.ndarray]:
    """The hash of the n-gram that ends at each token, for n = 1 to `order`; beginnings of texts are padded."""
    tokens = unpacked(row["tokens"], row["n_tokens"], "<i4")
    words = unpacked(row["words"], row["n_words"], "<u8")[tokens]
    begins = np.zeros(len(tokens), bool)
    begins[np.cumsum([0, *row["sizes"][:-1]])] = True
    found, before = [mixed(words, 1)], np.uint64(xxhash.xxh3_64_intdigest(BEGIN))
    for n in range(2, order + 1):
        earlier = np.empty_like(words)
        earlier[1:] = found[-1][:-1]
        earlier[begins] = before
        before = mixed(np.array([before], np.uint64), n)[0]
        found.append(mixed(earlier * np.uint64(0x9E3779B97F4A7C15) + words, n))
    return found


def mixed(x: np.ndarray, n: int) -> np.ndarray:
    """Spreads 64 bits over the range, differently for each order n."""
    with np.errstate(over="ignore"):
        x = x + np.uint64(n) * np.uint64(0xD6E8FEB86659FD93)
        for _ in range(2):
            x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        return x ^ (x >> np.uint64(32))


def split(found: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct hashes, the place of each token's among them, their counts, and where each of `parts` equal ranges begins."""
    distinct, places, counts = np.unique(found, return_inverse=True, return_counts=True)
    edges = np.array([-(-(i << 64) // parts) for i in range(parts)], np.uint64)
    return distinct, places, counts, np.append(np.searchsorted(distinct, edges), len(distinct))


@dataclass
class Totals:
    """Of the texts that count: tokens, texts and distinct tokens; `all` with the texts that weights are learned from, else `kept`."""

    n_all: int
    n_kept: int
    texts_all: int
    texts_kept: int
    words_all: int
    words_kept: int


def count(blocked: DataFrame, order: int, part_entries: int = BLOCK_TOKENS) -> tuple[DataFrame, Totals]:
    """(sums, totals). sums, a written table: block, n, part, size, seen_all, seen_kept.

    A row holds, for the distinct n-grams of a block in a part of the hash range
    in order of their hash, how often the counted texts hold them: all of them,
    and, for blocks that weights are learned from, those of use COUNTED alone.
    """
    sizes = {r["use"]: r for r in blocked.groupBy("use").agg(F.sum("n_tokens").alias("n"), F.sum("n_texts").alias("texts")).collect()}
    # Distinct n-grams are at most as many as tokens.
    parts = max(1, -(-sum(r["n"] for r in sizes.values()) * order // part_entries))

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                for n, found in enumerate(grams(row, order), 1):
                    distinct, _, counts, edges = split(found, parts)
                    out = [
                        {
                            "block": row["block"], "use": row["use"], "n": n, "part": part, "size": int(to - at),
                            "hashes": packed(np.diff(distinct[at:to], prepend=np.uint64(0))), "counts": packed(counts[at:to].astype("<i8")),
                        }
                        for part, (at, to) in enumerate(zip(edges[:-1], edges[1:], strict=True))
                        if to > at
                    ]
                    yield pa.RecordBatch.from_pylist(out, sent)

    to_send = "block long, use int, n int, part long, size long, hashes binary, counts binary"
    ddl = "block long, n int, part long, size long, seen_all binary, seen_kept binary, words_all long, words_kept long"
    sent, back = (to_arrow_schema(_parse_datatype_string(x)) for x in (to_send, ddl))

    def add_up(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        hashes = np.concatenate([np.cumsum(unpacked(r["hashes"], r["size"], "<u8"), dtype=np.uint64) for r in rows])
        counts = np.concatenate([unpacked(r["counts"], r["size"], "<i8") for r in rows])
        uses = np.repeat([r["use"] for r in rows], [r["size"] for r in rows])
        distinct, places = np.unique(hashes, return_inverse=True)
        kept = np.bincount(places, weights=counts * (uses == COUNTED), minlength=len(distinct)).astype("<i8")
        seen = kept + np.bincount(places, weights=counts * (uses == WEIGHED), minlength=len(distinct)).astype("<i8")
        out, at = [], 0
        for r in rows:
            mine = places[at : at + r["size"]]
            at += r["size"]
            out.append({
                "block": r["block"], "n": r["n"], "part": r["part"], "size": r["size"], "seen_all": packed(seen[mine]),
                "seen_kept": packed(kept[mine]) if r["use"] == WEIGHED else None, "words_all": None, "words_kept": None,
            })
        # How many distinct n-grams there are.
        out[0] |= {"words_all": int((seen > 0).sum()), "words_kept": int((kept > 0).sum())}
        return pa.Table.from_pylist(out, back)

    shipped = blocked.mapInArrow(send, to_send)
    sums = settle_table(shipped.groupBy("n", "part").applyInArrow(add_up, ddl))
    words = sums.where("n = 1").agg(F.sum("words_all").alias("all"), F.sum("words_kept").alias("kept")).first()
    n, texts = ({u: sizes[u][c] if u in sizes else 0 for u in (COUNTED, WEIGHED)} for c in ("n", "texts"))
    totals = Totals(
        n[COUNTED] + n[WEIGHED], n[COUNTED], texts[COUNTED] + texts[WEIGHED], texts[COUNTED], words["all"] or 0, words["kept"] or 0
    )
    return sums, totals


def estimates(seen: list[np.ndarray], begins: np.ndarray, tokens: int, texts: int, words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(level, bucket, parts): per token the order of the longest known context's n-gram, its count's bucket, and the estimates.

    parts[0] is uniform over the known words and one more, parts[n] the
    maximum-likelihood estimate of order n, 0 above the level.
    """
    size, order = len(seen[0]), len(seen)
    parts = np.zeros((order + 1, size))
    parts[0] = 1.0 / (words + 1)
    if tokens:
        parts[1] = seen[0] / tokens
    level, bucket = np.ones(size, int), np.zeros(size, int)
    for n in range(2, order + 1):
        context = np.empty(size, np.int64)
        context[1:] = seen[n - 2][:-1]
        context[begins] = texts
        known = context > 0
        parts[n, known] = seen[n - 1][known] / context[known]
        level[known] = n
        bucket[known] = np.minimum(np.log2(context[known]).astype(int), BUCKETS - 1)
    return level, bucket, parts


def _seen(row: dict, sums: list[dict], order: int, column: str) -> tuple[list[np.ndarray], np.ndarray]:
    """Counts by token for each order, and the places where texts begin."""
    found = []
    for n, hashes in enumerate(grams(row, order), 1):
        mine = sorted((s for s in sums if s["n"] == n), key=lambda s: s["part"])
        counts = np.concatenate([unpacked(s[column], s["size"], "<i8") for s in mine])
        found.append(counts[np.unique(hashes, return_inverse=True)[1]])
    return found, np.cumsum([0, *row["sizes"][:-1]])


def learn(blocked: DataFrame, sums: DataFrame, totals: Totals, order: int, rounds: int = 200) -> np.ndarray:
    """Mixture weights [level, bucket, order], by expectation maximisation on the texts of use WEIGHED.

    Their estimates come from the texts of use COUNTED alone. Tokens are
    gathered by level, bucket and the estimates' half powers of two, with their
    mean within; the number of such cells is bounded by the buckets, whatever the input.
    """
    names = [f"p{i}" for i in range(1, order + 1)]
    ddl = "level int, bucket int, cell string, tokens long, " + ", ".join(f"{x} double" for x in names)
    schema = to_arrow_schema(_parse_datatype_string(ddl))
    tokens, texts, words = totals.n_kept, totals.texts_kept, totals.words_kept

    def gather(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        for row in left.to_pylist():
            seen, begins = _seen(row, right.to_pylist(), order, "seen_kept")
            level, bucket, parts = estimates(seen, begins, tokens, texts, words)
            with np.errstate(divide="ignore"):
                cells = np.where(parts[1:] > 0, np.floor(STEP * np.log2(parts[1:])), 1).astype(int)
            spread = np.stack([level, bucket, *cells])
            kinds, places = np.unique(spread, axis=1, return_inverse=True)
            n = np.bincount(places.ravel())
            total = [np.bincount(places.ravel(), weights=p) for p in parts[1:]]
            cell = [" ".join(map(str, k)) for k in kinds[2:].T.tolist()]
            columns = [pa.array(kinds[0], pa.int32()), pa.array(kinds[1], pa.int32()), pa.array(cell), pa.array(n), *map(pa.array, total)]
            out.append(pa.table(columns, schema=schema))
        return pa.concat_tables(out) if out else schema.empty_table()

    mine = blocked.where(F.col("use") == WEIGHED).groupBy("block").cogroup(sums.where("seen_kept is not null").groupBy("block"))
    cells = mine.applyInArrow(gather, ddl).groupBy("level", "bucket", "cell").agg(
        F.sum("tokens").alias("tokens"), *[F.sum(x).alias(x) for x in names]
    )
    rows = cells.orderBy("level", "bucket", "cell").collect()
    table = np.array([[r["level"], r["bucket"], r["tokens"], *(r[x] / r["tokens"] for x in names)] for r in rows], float).reshape(-1, 3 + order)
    return mixture(table, order, 1.0 / (words + 1), rounds)


def mixture(table: np.ndarray, order: int, uniform: float, rounds: int = 200) -> np.ndarray:
    """Weights by expectation maximisation. table: rows of level, bucket, tokens, estimates of order 1, 2, ...

    A bucket without tokens takes the weights of its level's nearest bucket
    below, else above, and a level without tokens equal weights. No used order
    weighs less than LEAST_WEIGHT, so that no probability is 0.
    """
    weights = np.zeros((order + 1, BUCKETS, order + 1))
    for level in range(1, order + 1):
        found = {}
        for bucket in np.unique(table[table[:, 0] == level, 1]).astype(int):
            rows = table[(table[:, 0] == level) & (table[:, 1] == bucket)]
            n, p = rows[:, 2], np.column_stack([np.full(len(rows), uniform), rows[:, 3 : 3 + level]])
            w = np.full(level + 1, 1.0 / (level + 1))
            for _ in range(rounds):
                share = w * p
                share /= share.sum(axis=1, keepdims=True)
                new = np.maximum((n[:, None] * share).sum(axis=0) / n.sum(), LEAST_WEIGHT)
                new /= new.sum()
                if np.abs(new - w).max() < 1e-9:
                    break
                w = new
            found[bucket] = w
        for bucket in range(BUCKETS):
            below = [b for b in found if b <= bucket]
            near = max(below) if below else min(found, default=None)
            weights[level, bucket, : level + 1] = 1.0 / (level + 1) if near is None else found[near]
    return weights


def score(blocked: DataFrame, sums: DataFrame, totals: Totals, weights: np.ndarray, order: int, key: str = "doc_id") -> DataFrame:
    """One row per text: key, use, n_tokens, n_known, train_tokens, base_score, score.

    base_score: log10 of (c + 0.5) / (N + 0.5 (V + 1)) over the tokens; score:
    log10 of the mixture, by the counts of all training texts.
    """
    kind = blocked.schema["keys"].dataType.elementType.simpleString()
    ddl = f"`{key}` {kind}, use int, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    tokens, texts, words = totals.n_all, totals.texts_all, totals.words_all
    lam = weights.copy()

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        for i in range(left.num_rows):
            row = left.slice(i, 1).to_pylist()[0]
            seen, begins = _seen(row, right.to_pylist(), order, "seen_all")
            level, bucket, parts = estimates(seen, begins, tokens, texts, words)
            logs = np.log10((lam[level, bucket].T * parts).sum(axis=0))
            base = np.log10((seen[0] + 0.5) / (tokens + 0.5 * (words + 1)))
            add = lambda x: pa.array(np.add.reduceat(x, begins))
            size = len(begins)
            out.append(pa.table({
                key: left.column("keys").slice(i, 1).combine_chunks().flatten(), "use": pa.array([row["use"]] * size, pa.int32()),
                "n_tokens": pa.array(row["sizes"], pa.int64()), "n_known": add((seen[0] > 0).astype(np.int64)),
                "train_tokens": pa.array([tokens] * size, pa.int64()), "base_score": add(base), "score": add(logs),
            }))
        return pa.concat_tables(out)

    both = blocked.groupBy("block").cogroup(sums.select("block", "n", "part", "size", "seen_all").groupBy("block"))
    return both.applyInArrow(run, ddl)


def interpolate(docs: DataFrame, use: Column, key: str = "doc_id", text: str = "text", order: int = 2, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """Scores of all texts by a model of those whose `use` is COUNTED or WEIGHED; the fields of `score`.

    One row per row of docs: repeated rows count and are scored each, a null
    text is empty and has one token, its end. Without texts that count, every
    token is unknown. No rows give no rows. Other columns are not read.
    """
    if order < 1:
        raise ValueError("order must be 1 or more")
    blocked = blocks(docs, key, text, use, block_tokens)
    sums, totals = count(blocked, order, block_tokens)
    weights = learn(blocked, sums, totals, order)
    return score(blocked, sums, totals, weights, order, key)
