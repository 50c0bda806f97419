"""Toxic passages: maximum-scoring segments of token log-odds.

Tokens weigh as their log-odds between toxic and other documents under a
Dirichlet prior that is the corpus itself; a weight counts only where it stands
out of its standard error. A linear-time scan finds all maximal-scoring
segments of a text. The largest segment of a harmless text of n tokens follows
an extreme-value distribution, P(S >= x) = 1 - exp(-K n exp(-lambda x)), by
which segments of any text are compared; a text's score comes from the sum over
its significant segments.
"""

from __future__ import annotations

import math
import zlib
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import annotate, held_out, pieces, values

BITS = 18
_BREAKS = bytes(b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 or b == 39 else 32 for b in range(256))
MEMO = 200_000
#: Evidence (-ln of the expected number of such segments) is certain enough beyond these.
LEAST, MOST = -5.0, 15.0


def tokens(text: bytes | None) -> list[bytes]:
    return (text or b"").lower().translate(_BREAKS).split()


def column(token: bytes) -> int:
    return zlib.crc32(token) & (1 << BITS) - 1


def segments(weights: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal-scoring segments (start, end, score), in one pass, from left to right.

    A segment is a run that no longer run around it and no part of it beats.
    """
    places = np.nonzero(weights > 0)[0]
    upto = np.cumsum(weights)
    found: list[tuple[int, int, float, float]] = []  # start, end, sum before, sum at the end
    # nearer[i]: the last segment before i whose sum before lies below that of i.
    nearer: list[int] = []
    for place in places.tolist():
        start, end, right = place, place + 1, float(upto[place])
        left = right - float(weights[place])
        while True:
            j = len(found) - 1
            while j >= 0 and found[j][2] >= left:
                j = nearer[j]
            if j < 0 or found[j][3] >= right:
                found.append((start, end, left, right))
                nearer.append(j)
                break
            start, left = found[j][0], found[j][2]
            del found[j:], nearer[j:]
    return [(s, e, r - le) for s, e, le, r in found]


class _Memo(dict):
    """Weights by token; bounded, as texts hold ever new tokens."""

    def __init__(self, weights: np.ndarray):
        super().__init__()
        self.weights = weights

    def __missing__(self, token: bytes) -> float:
        if len(self) >= MEMO:
            self.clear()
        weight = self[token] = float(self.weights[column(token)])
        return weight


@dataclass
class Model:
    weights: np.ndarray  # by column of the token's hash
    rate: float = 1.0  # lambda
    size: float = 1.0  # K
    slope: float = 1.0
    offset: float = -1.0
    memo: _Memo = field(init=False, repr=False)

    def __post_init__(self):
        self.memo = _Memo(self.weights)

    def passages(self, text: bytes | None) -> list[tuple[int, int, float]]:
        """Segments in tokens, with what their score exceeds chance by: -ln of the expected number."""
        words = tokens(text)
        if not words:
            return []
        weighed = np.fromiter(map(self.memo.__getitem__, words), np.float64, len(words))
        chance = math.log(self.size * len(words))
        return [(s, e, self.rate * score - chance) for s, e, score in segments(weighed)]

    @staticmethod
    def evidence(found: list[tuple[int, int, float]]) -> float:
        """The sum over significant segments, else the best one, within LEAST and MOST."""
        strong = sum(x for _, _, x in found if x > 0)
        return min(MOST, strong) if strong > 0 else max([LEAST, *(x for _, _, x in found)])

    def score(self, found: list[tuple[int, int, float]]) -> float:
        z = self.slope * self.evidence(found) + self.offset
        return 1.0 / (1.0 + math.exp(-z))


def learned_rows(docs: DataFrame, labels: DataFrame, key: str, text: str, label: str, rows_per_label: int) -> DataFrame:
    """text, label of a bounded sample of labelled rows that aren't held out.

    At most rows_per_label labels of either value, those of the smallest hashes
    of their key; labels that contradict each other for a key are left out. As
    their number is bounded, they are sent to the documents. Equal texts of a
    label are one row.
    """
    known = labels.where(F.col(label).isin(0, 1) & F.col(key).isNotNull() & ~held_out(F.col(key)))
    known = known.groupBy(key).agg(F.min(label).alias("_label"), F.max(label).alias("_other")).where("_label = _other")
    drawn = [
        known.where(F.col("_label") == value).orderBy(F.xxhash64(F.col(key)), key).limit(rows_per_label) for value in (0, 1)
    ]
    chosen = drawn[0].unionByName(drawn[1]).select(F.col(key).alias("_key"), "_label")
    rows = docs.join(F.broadcast(chosen), F.col(key) == F.col("_key"))
    return rows.select(F.col(text).alias("text"), F.col("_label").alias("label")).dropDuplicates()


def count(rows: DataFrame) -> DataFrame:
    """col, clean, toxic: documents that hold a token of the column, by label."""

    def run(batches):
        counts = np.zeros((2, 1 << BITS), dtype=np.int64)
        for batch in batches:
            for piece in pieces(batch):
                for text, label in zip(values(piece.column(0)), piece.column(1).to_pylist(), strict=True):
                    counts[label, [column(t) for t in set(tokens(text))]] += 1
        used = np.nonzero(counts.any(axis=0))[0]
        arrays = [pa.array(x, pa.int64()) for x in (used, counts[0, used], counts[1, used])]
        yield pa.RecordBatch.from_arrays(arrays, ["col", "clean", "toxic"])

    cols = "col long, clean long, toxic long"
    return rows.mapInArrow(run, cols).groupBy("col").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))


def weigh(clean: np.ndarray, toxic: np.ndarray, prior: float = 5.0, least_z: float = 4.0, cost: float = 0.5) -> np.ndarray:
    """Log-odds with a Dirichlet prior: `prior` documents a column, shared out to the labels by their size.

    A column with little evidence is drawn to 0, and one within least_z standard
    errors of 0 is 0. A fixed cost is taken from each, so that a harmless token
    weighs below 0, which segments need.
    """
    sizes = toxic.sum(), clean.sum()
    if not min(sizes):
        return np.full(len(clean), -cost)
    share = sizes[0] / sum(sizes)
    t, c = toxic + prior * share, clean + prior * (1 - share)
    odds = np.log(t / share) - np.log(c / (1 - share))
    return np.where(np.abs(odds) >= least_z * np.sqrt(1 / t + 1 / c), odds, 0.0) - cost


def decay(weights: np.ndarray, clean: np.ndarray) -> float:
    """The lambda at which exp(lambda * weight) is 1 on average over harmless tokens."""
    share = clean / max(1, clean.sum())
    if not (weights[share > 0] > 0).any():
        share = share + 1e-9  # no harmless document holds a toxic token
        share /= share.sum()
    mean = lambda x: float((share * np.exp(np.minimum(x * weights, 700.0))).sum())
    if not (weights > 0).any():
        return 1.0
    low, high = 1e-3, 1.0
    while mean(high) < 1 and high < 64:
        high *= 2
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (middle, high) if mean(middle) < 1 else (low, middle)
    return high


def fit(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic", rows_per_label: int = 4000
) -> Model:
    """Learn from labelled documents that aren't held out; rows_per_label bounds the fit's rows.

    Without labels of both values all scores are the same, below one half.
    """
    rows = learned_rows(docs, labels, key, text, label, rows_per_label)
    table = count(rows).toPandas()
    clean, toxic = np.zeros(1 << BITS), np.zeros(1 << BITS)
    clean[table["col"].to_numpy(dtype=int)], toxic[table["col"].to_numpy(dtype=int)] = table["clean"], table["toxic"]
    weights = weigh(clean, toxic).astype(np.float32)
    model = Model(weights, rate=decay(weights.astype(np.float64), clean))
    if not (weights > 0).any():
        return Model(weights, model.rate, 1.0, 0.0, -2.0)

    def start():
        shared = Model(weights, model.rate)

        def best(texts):
            found = [[x for _, _, x in shared.passages(t)] for t in texts]
            return [max(f, default=None) for f in found], found

        return best

    seen = annotate(rows, ["text"], "best double, found array<double>", start, keep=["label"]).toPandas()
    # K by moments: a Gumbel variable's mean is its location and Euler's constant. With K = 1, `best` is rate * S - ln n.
    harmless = seen.loc[(seen["label"] == 0) & seen["best"].notna(), "best"]
    size = math.exp(float(harmless.mean()) - 0.5772156649) if len(harmless) else 1.0
    size = min(max(size, 1e-6), 1e6)
    x = np.array([Model.evidence([(0, 0, v - math.log(size)) for v in found]) for found in seen["found"]])
    slope, offset = logistic(x, seen["label"].to_numpy(dtype=float))
    return Model(weights, model.rate, size, slope, offset)


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2) -> tuple[float, float]:
    """Slope (0 or more) and offset by Newton's method, with a small ridge."""
    a = np.stack([x, np.ones_like(x)], axis=1)
    w = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -500, 500)))
        h = (a * (p * (1 - p))[:, None]).T @ a + ridge * np.eye(2)
        step = np.linalg.solve(h, a.T @ (p - y) + ridge * w)
        w -= np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-9:
            break
    return max(float(w[0]), 0.0), float(w[1])


def assess(docs: DataFrame, model: Model, text: str = "text", keep: list[str] | None = None, threshold: float = 0.7) -> DataFrame:
    """Adds score (0 to 1), predicted (score >= threshold) and passages (start, end in tokens, evidence).

    Null and empty texts have no passages and the lowest score. Rows and other
    columns stay; columns of the new names are replaced.
    """
    held = docs.sparkSession.sparkContext.broadcast((model.weights, model.rate, model.size, model.slope, model.offset))

    def start():
        shared = Model(*held.value)

        def work(texts):
            found = [shared.passages(t) for t in texts]
            scores = [shared.score(f) for f in found]
            return scores, [int(s >= threshold) for s in scores], [[p for p in f if p[2] > 0] for f in found]

        return work

    fields = "score double, predicted int, passages array<struct<start: int, end: int, evidence: double>>"
    return annotate(docs, [text], fields, start, keep=keep)
