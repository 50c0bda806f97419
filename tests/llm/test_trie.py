"""The prefix trie against brute force, and its odd cases."""

import collections
import hashlib
import random

import pytest
from pyspark.sql import functions as F

from rankloom.llm import sequences, trie

COLUMNS = "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256".split()


def brute(convs):
    """convs: conv_id -> list of (role, text)."""
    nodes = collections.defaultdict(list)
    for c, said in convs.items():
        for d in range(len(said) + 1):
            nodes[tuple(said[:d])].append(c)
    children = collections.Counter(path[:-1] for path in nodes if path)
    rows = []
    for path, members in nodes.items():
        below = [p for p in nodes if p[: len(path)] == path]
        ends = sorted(c for c in members if len(convs[c]) == len(path))
        rows.append((
            min(members), len(path), min(nodes[path[:-1]]) if path else None, len(members), children[path],
            sum(not children[p] for p in below), sum((len(nodes[p]) - 1) * len(p[-1][1].encode()) for p in below if p),
            hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest(),
        ))
    return sorted(rows, key=str)


def grown(rng, n, longest, fork):
    """Conversations of which many share long beginnings."""
    convs = {}
    for c in range(-3, n):
        said = []
        if convs and rng.random() < 0.8:
            other = rng.choice(list(convs.values()))
            said = other[: rng.randrange(len(other) + 1)] if rng.random() < fork else list(other)
        said += [(rng.choice(["user", "assistant", ""]), rng.choice(["", "a", "é", "b c", "x" * 30])) for _ in range(rng.randrange(longest))]
        convs[c] = said
    return convs


@pytest.mark.parametrize("seed,n,longest,fork,block", [(1, 40, 5, 0.7, 8), (2, 60, 3, 0.9, 2), (3, 12, 40, 0.5, 8), (4, 30, 4, 0.2, 1)])
def test_trie_is_brute_force(spark, seed, n, longest, fork, block):
    convs = grown(random.Random(seed), n, longest, fork)
    rows = [(c, d + 1, role or None, text or None, "n", 1) for c, said in convs.items() for d, (role, text) in enumerate(said)]
    random.Random(seed).shuffle(rows)
    turns = spark.createDataFrame(rows, "conv_id long, depth long, role string, text string, node string, class int")
    ids = spark.createDataFrame([(c, 1) for c in [*convs, *convs]] + [(None, 1)], "conv_id long, first int")
    got = sorted((tuple(r) for r in trie.prefix_trie(ids, turns, block).select(COLUMNS).collect()), key=str)
    assert got == brute(convs)


def test_trie_of_nothing_and_of_turnless_conversations(spark):
    none = spark.createDataFrame([], "conv_id long, depth long, role string, text string")
    assert trie.prefix_trie(none, none).collect() == []
    ids = spark.createDataFrame([(5,), (3,)], "conv_id long")
    (root,) = trie.prefix_trie(ids, none).select(COLUMNS).collect()
    assert tuple(root) == (3, 0, None, 2, 0, 1, 0, hashlib.sha256(b"3,5").hexdigest())
    with pytest.raises(ValueError):
        trie.prefix_trie(ids, none, 0)


def test_trie_of_a_long_conversation_and_many_copies(spark):
    """3,000 turns, past the ranges of places, and 2,500 copies of one turn."""
    long = spark.range(3000).select(F.lit(0).cast("long").alias("conv_id"), (F.col("id") + 1).alias("depth"), F.lit("user").alias("role"), F.col("id").cast("string").alias("text"))
    same = spark.range(1, 2501).select(F.col("id").alias("conv_id"), F.lit(1).cast("long").alias("depth"), F.lit("user").alias("role"), F.lit("0").alias("text"))
    turns = long.unionByName(same)
    nodes = {r["depth"]: r for r in trie.prefix_trie(turns, turns).collect()}
    assert len(nodes) == 3001 and nodes[1]["n_convs"] == 2501 and nodes[1]["saved_tokens"] == 2500 and nodes[3000]["n_children"] == 0
    assert nodes[1]["ends_sha256"] == hashlib.sha256(",".join(map(str, range(1, 2501))).encode()).hexdigest()


def test_places_and_running_totals(spark):
    rng = random.Random(0)
    rows = [(k, t, rng.randrange(100)) for k in (None, 1, 2) for t in rng.sample(range(-50, 4000), 300)] + [(1, None, 1), (1, None, 0), (1, 7, 1), (1, 7, 1)]
    df = spark.createDataFrame(rows, "k long, t long, v long")
    placed = sequences.numbered(df, "k", "t", ["v"], span=16)
    totals = sequences.running(placed, "k", "at", {"s": (F.sum, F.col("v"), F.lit(0).cast("long")), "x": (F.bit_xor, F.col("v"), F.lit(0).cast("long"))}, span=8)
    by = collections.defaultdict(list)
    for r in totals.collect():
        by[r["k"]].append((r["at"], r["t"], r["v"], r["s"], r["x"]))
    for k, found in by.items():
        found.sort()
        want = sorted(((t, v) for key, t, v in rows if key == k), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
        assert [f[0] for f in found] == list(range(len(want))) and [f[1:3] for f in found] == want
        s = x = 0
        for _, _, v, total, mixed in found:
            s, x = s + v, x ^ v
            assert (total, mixed) == (s, x)
