"""Language identification from character n-grams.

Features: n-grams of one to three code points, hashed to a fixed number of
columns, as relative frequency times inverse document frequency. The document
frequencies cover all labelled documents. A sparse multinomial logistic
regression is fitted by follow-the-regularised-leader with an elastic net on a
bounded sample, and its temperature is set on a part of the sample that it
hasn't seen. A text is scored whole, by sums over its n-grams.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import annotate, held_out, pieces, values

BITS = 16
ORDERS = 3
SCALE = 32.0
UNDECIDED = "und"
# Odd multipliers of the n-gram hash, one set of summands for each length.
FACTORS = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D], dtype=np.uint32)

_SPACED = np.arange(128, dtype=np.uint32)
_SPACED[[c for c in range(128) if not chr(c).isalpha()]] = 32


def code_points(text: bytes | None) -> np.ndarray | None:
    """Lower-case code points, ASCII non-letters as blanks; None without a letter."""
    lower = (text or b"").decode("utf-8", "replace").lower()
    if not any(map(str.isalpha, lower)):
        return None
    points = np.frombuffer(lower.encode("utf-32-le", "replace"), dtype=np.uint32)
    return np.where(points < 128, _SPACED[np.minimum(points, 127)], points)


def grams(points: np.ndarray, order: int) -> np.ndarray:
    """Columns of all n-grams of a length; those that would end behind the text are left out."""
    size = max(0, len(points) - order + 1)
    mixed = np.full(size, 0x27D4EB2F * order & 0xFFFFFFFF, dtype=np.uint32)
    for i in range(order):
        mixed = (mixed ^ (points[i : i + size] * FACTORS[i])) * np.uint32(0x01000193 * 2 + 1)
        mixed ^= mixed >> np.uint32(15)
    return ((mixed * np.uint32(0x9E3779B1)) >> np.uint32(32 - BITS)).astype(np.int64)


def document_frequencies(docs: DataFrame, text: str) -> DataFrame:
    """col, df: the number of documents with an n-gram of that column."""

    def run(batches):
        counts, seen = np.zeros(1 << BITS, dtype=np.int64), np.zeros(1 << BITS, dtype=bool)
        for batch in batches:
            for piece in pieces(batch):
                for value in values(piece.column(0)):
                    if (points := code_points(value)) is not None:
                        seen[:] = False
                        for order in range(1, ORDERS + 1):
                            seen[grams(points, order)] = True
                        counts += seen
        used = np.nonzero(counts)[0]
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(counts[used], pa.int64())], ["col", "n"])

    return docs.select(text).mapInArrow(run, "col long, n long").groupBy("col").agg(F.sum("n").alias("df"))


@dataclass
class Model:
    languages: list[str]
    weights: np.ndarray  # column x language, inverse document frequency and temperature included
    bias: np.ndarray

    def scores(self, texts: list[bytes | None]) -> tuple[list[str], list[float]]:
        languages, found = [], []
        for text in texts:
            points = code_points(text)
            if points is None:
                languages.append(UNDECIDED)
                found.append(0.0)
                continue
            total, sums = 0, np.zeros(len(self.languages))
            for order in range(1, ORDERS + 1):
                for at in range(0, len(points), 1 << 18):  # bounded pieces that overlap by order - 1
                    cols = grams(points[at : at + (1 << 18) + order - 1], order)
                    total += len(cols)
                    sums += self.weights.take(cols, axis=0).sum(axis=0, dtype=np.float64)
            logits = sums * (SCALE / total) + self.bias
            odds = np.exp(logits - logits.max())
            best = int(odds.argmax())
            languages.append(self.languages[best])
            found.append(float(odds[best] / odds.sum()))
        return languages, found


def learned_rows(docs: DataFrame, key: str, text: str, label: str) -> DataFrame:
    return docs.where(~held_out(F.col(key)) & F.col(label).isNotNull()).select(key, text, label)


def sample(rows: DataFrame, key: str, label: str, sample_rows: int) -> tuple[list[str], DataFrame]:
    """The labels, and about sample_rows rows, as many of each label, chosen by a hash of the key."""
    counts = {r[0]: r[1] for r in rows.groupBy(label).count().collect()}
    if len(counts) > 1000:
        raise ValueError("more than 1000 languages")
    each = max(1, sample_rows // max(1, len(counts)))
    shares = F.create_map(*(x for k, n in counts.items() for x in (F.lit(k), F.lit(min(1.0, each / n))))) if counts else None
    drawn = F.shiftrightunsigned(F.xxhash64(F.col(key), F.lit("sample")), 11) / F.lit(float(1 << 53))
    return sorted(counts), rows.where(drawn < shares[F.col(label)]) if counts else rows.limit(0)


def fit(
    docs: DataFrame, key: str = "doc_id", text: str = "text", label: str = "lang",
    sample_rows: int = 2400, epochs: int = 4, alpha: float = 0.5, beta: float = 1.0, l1: float = 0.02, l2: float = 0.01,
) -> Model:
    """Learn from labelled documents that are not held out; sample_rows bounds the rows of the fit.

    Without any labelled document every text is undecided.
    """
    rows = learned_rows(docs, key, text, label)
    languages, chosen = sample(rows, key, label, sample_rows)
    if not languages:
        return Model([UNDECIDED], np.zeros((1 << BITS, 1), dtype=np.float32), np.zeros(1))
    table = document_frequencies(rows, text).toPandas()
    total = rows.count()
    idf = np.zeros(1 << BITS)
    idf[table["col"].to_numpy()] = np.log((1 + total) / (1 + table["df"].to_numpy())) + 1

    def start():
        def features(texts):
            cols, freqs = [], []
            for value in texts:
                points = code_points(value)
                every = [] if points is None else [grams(points, n) for n in range(1, ORDERS + 1)]
                found, n = np.unique(np.concatenate(every), return_counts=True) if every else (np.zeros(0, int), np.ones(0))
                cols.append(found.astype(np.int32))
                freqs.append((n / max(1, n.sum())).astype(np.float32))
            return cols, freqs

        return features

    rows = annotate(chosen, [text], "cols array<int>, freqs array<float>", start, keep=[key, label]).toPandas()
    rows = rows.sort_values([label, key], kind="stable").sample(frac=1.0, random_state=7)
    place = {name: i for i, name in enumerate(languages)}
    examples = [
        (np.asarray(c), SCALE * idf[np.asarray(c)] * np.asarray(f), place[y])
        for c, f, y in zip(rows["cols"], rows["freqs"], rows[label], strict=True)
        if len(c)
    ]
    held = len(examples) // 5
    weights, bias = follow_the_leader(examples[held:], len(languages), epochs, alpha, beta, l1, l2)
    heat = temperature([(x @ weights[c] + bias, y) for c, x, y in examples[:held]])
    return Model(languages, (weights * idf[:, None] / heat).astype(np.float32), bias / heat)


def follow_the_leader(examples, n_classes: int, epochs: int, alpha: float, beta: float, l1: float, l2: float):
    """FTRL-proximal: per-coordinate rates, weights at exactly 0 while |z| <= l1."""
    z, n = np.zeros((1 << BITS, n_classes)), np.zeros((1 << BITS, n_classes))
    bias = np.zeros(n_classes)

    def solved(z, n):
        return np.where(np.abs(z) <= l1, 0.0, (np.sign(z) * l1 - z) / ((beta + np.sqrt(n)) / alpha + l2))

    for epoch in range(epochs):
        for step, (cols, x, y) in enumerate(examples):
            zs, ns = z[cols], n[cols]
            w = solved(zs, ns)
            logits = x @ w + bias
            p = np.exp(logits - logits.max())
            p /= p.sum()
            p[y] -= 1.0
            g = x[:, None] * p
            grown = ns + g * g
            z[cols] = zs + g - (np.sqrt(grown) - np.sqrt(ns)) / alpha * w
            n[cols] = grown
            bias -= 0.1 / np.sqrt(1 + epoch * len(examples) + step) * p
    return solved(z, n), bias


def temperature(held: list[tuple[np.ndarray, int]]) -> float:
    """The divisor of the logits with the least log loss on rows that the fit hasn't seen."""
    if not held:
        return 1.0
    logits, y = np.stack([h[0] for h in held]), np.array([h[1] for h in held])

    def loss(t: float) -> float:
        a = logits / t
        a -= a.max(axis=1, keepdims=True)
        return float((np.log(np.exp(a).sum(axis=1)) - a[np.arange(len(y)), y]).mean())

    return float(min(np.geomspace(0.25, 8.0, 41), key=loss))


def identify(
    docs: DataFrame, model: Model, text: str = "text", keep: list[str] | None = None, into: tuple[str, str] = ("lang_pred", "score")
) -> DataFrame:
    """Adds the predicted language and its score (0 to 1). A null text or one without a letter: `und`, 0.

    Rows, their order and other columns stay; columns of the new names are replaced.
    """
    held = docs.sparkSession.sparkContext.broadcast((model.languages, model.weights, model.bias))

    def start():
        return Model(*held.value).scores

    return annotate(docs, [text], f"`{into[0]}` string, `{into[1]}` double", start, keep=keep)
