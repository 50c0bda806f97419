"""Deleted interpolation against a plain version, and its odd cases."""

import collections
import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from rankloom.llm import interpolation as lm
from rankloom.llm import queries

DDL = "doc_id long, text string, part int"


def tokens(text):
    return [w.decode() for w in (text or "").encode().lower().split()] + ["\n"]


def counted(texts, order):
    counts = [collections.Counter() for _ in range(order + 1)]
    for text in texts:
        said = [" "] * (order - 1) + tokens(text)
        for i in range(order - 1, len(said)):
            for n in range(1, order + 1):
                counts[n][tuple(said[i - n + 1 : i + 1])] += 1
    return counts


def estimates(text, counts, n_texts, order):
    """(level, bucket, estimates) of each token."""
    total, words = sum(counts[1].values()), len(counts[1])
    said = [" "] * (order - 1) + tokens(text)
    for i in range(order - 1, len(said)):
        level, bucket, found = 1, 0, [1 / (words + 1), counts[1][(said[i],)] / total if total else 0.0]
        for n in range(2, order + 1):
            context = tuple(said[i - n + 1 : i])
            seen = n_texts if set(context) == {" "} else counts[n - 1][context] if len(context) == n - 1 else 0
            if n > 2 and context[0] == " " and context[-1] != " ":
                seen = counts[n - 1][context]
            if seen:
                level, bucket = n, int(math.log2(seen))
                found += [0.0] * (n - len(found)) + [counts[n][(*context, said[i])] / seen]
        yield level, bucket, found


def learned(texts, counts, n_texts, order):
    cells = [(lv, b, 1, *p[1:], *[0.0] * (order + 1 - len(p))) for t in texts for lv, b, p in estimates(t, counts, n_texts, order)]
    return lm.mixture(np.array(cells, float).reshape(-1, 3 + order), order, 1 / (len(counts[1]) + 1))


def corpus(rng, n):
    words = ["the", "The", "cat", "sat", "on", "mat", "É", "é", "a\tb", *[f"w{i}" for i in range(300)]]
    out = []
    for i in range(n):
        text = " ".join(words[min(int(rng.expovariate(0.08)), len(words) - 1)] for _ in range(rng.randrange(0, 60)))
        out.append(rng.choice([text, text, text, text + "\n", None, ""]) if i % 9 == 0 else text)
    return out


@pytest.mark.parametrize("order,block_tokens", [(1, 1 << 21), (2, 700), (3, 400)])
def test_scores_are_brute_force(spark, order, block_tokens):
    rng = random.Random(order)
    texts = corpus(rng, 150)
    texts += [texts[5]] * 3
    uses = [rng.choice([0, 0, 0, 1, 2]) for _ in texts]
    df = spark.createDataFrame([(i, t, u, 1.0) for i, (t, u) in enumerate(zip(texts, uses, strict=True))], f"{DDL}, score double").repartition(3)
    got = {r["doc_id"]: r for r in lm.interpolate(df, F.col("part"), order=order, block_tokens=block_tokens).collect()}
    kept = [t for t, u in zip(texts, uses, strict=True) if u == 0]
    train = [t for t, u in zip(texts, uses, strict=True) if u < 2]
    weights = learned([t for t, u in zip(texts, uses, strict=True) if u == 1], counted(kept, order), len(kept), order)
    counts = counted(train, order)
    total, words = sum(counts[1].values()), len(counts[1])
    assert set(got) == set(range(len(texts)))
    for i, text in enumerate(texts):
        said, row = tokens(text), got[i]
        known = [counts[1][(w,)] for w in said]
        assert (row["n_tokens"], row["n_known"], row["train_tokens"], row["use"]) == (len(said), sum(c > 0 for c in known), total, uses[i])
        assert row["base_score"] == pytest.approx(sum(math.log10((c + 0.5) / (total + 0.5 * (words + 1))) for c in known), abs=1e-9)
        p = [sum(w * x for w, x in zip(weights[lv, b], found, strict=False)) for lv, b, found in estimates(text, counts, len(train), order)]
        # Weights are learned on gathered estimates, so they differ a little.
        assert row["score"] == pytest.approx(sum(map(math.log10, p)), rel=0.01, abs=0.05)


def test_weights_are_a_distribution_and_raise_the_likelihood():
    rng = np.random.default_rng(0)
    table = np.array([[2, b, n, *rng.random(2) * (0.2, 0.9)] for b in (1, 4) for n in rng.integers(1, 50, 30)], float)
    weights = lm.mixture(table, 2, 1e-3)
    used = weights[2]
    assert np.allclose(used.sum(axis=1), 1) and (used >= lm.LEAST_WEIGHT / 2).all() and (used[2] == used[1]).all() and (used[0] == used[1]).all()
    for b in (1, 4):
        rows = table[table[:, 1] == b]
        p = np.column_stack([np.full(len(rows), 1e-3), rows[:, 3:]])
        best = (rows[:, 2] * np.log(p @ used[b])).sum()
        for _ in range(200):
            assert best >= (rows[:, 2] * np.log(p @ rng.dirichlet(np.ones(3)))).sum() - 1e-6


def test_odd_tables(spark):
    none = spark.createDataFrame([], DDL)
    assert lm.interpolate(none, F.col("part")).collect() == []
    only = spark.createDataFrame([(1, "a b", 2), (None, None, 2), (1, "a b", 2)], DDL)
    rows = lm.interpolate(only, F.col("part")).collect()
    assert sorted((r["doc_id"] or 0, r["n_tokens"], r["n_known"], r["train_tokens"]) for r in rows) == [(0, 1, 0, 0), (1, 3, 0, 0), (1, 3, 0, 0)]
    assert all(math.isfinite(r["score"]) and r["base_score"] == 0 for r in rows)
    unweighed = spark.createDataFrame([(1, "a b " * 50_000, 0), (2, "a c", 2)], DDL)
    assert all(math.isfinite(r["score"]) and r["score"] < 0 for r in lm.interpolate(unweighed, F.col("part")).collect())
    with pytest.raises(ValueError):
        lm.interpolate(none, F.col("part"), order=0)


def test_model_query(spark, sf_dir):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = {r["doc_id"]: r for r in queries.op11_interpolated_model(spark, sf_dir).collect()}
    train = [t for d, t in docs.items() if zlib.crc32(str(d).encode()) % 5 != 1]
    counts = collections.Counter(w for t in train for w in tokens(t))
    assert set(rows) == set(docs)
    for d, r in rows.items():
        assert r["held_out"] == (zlib.crc32(str(d).encode()) % 5 == 1) and r["train_tokens"] == sum(counts.values())
        assert r["n_known"] == sum(counts[w] > 0 for w in tokens(docs[d]))
    held = [r for r in rows.values() if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)
