"""Packed signatures and their lists against brute force."""

import random
from collections import defaultdict

import numpy as np

from rankloom.llm import jaccard


def test_blocks_come_back_whole():
    rng = np.random.default_rng(5)
    classes, sizes = rng.integers(-(1 << 63), 1 << 63, 50), rng.integers(1, 900, 50)
    for rows in (1, 7, 3000):
        sig = np.sort(rng.integers(0, 1 << 64, rows, dtype=np.uint64))
        room, of = rng.integers(0, 1 << 20, rows).astype(np.int32), rng.integers(0, 50, rows)
        back = jaccard.unpack(jaccard.pack(sig, room, of, classes, sizes))
        for x, y in zip(back, [sig, classes[of], sizes[of], room], strict=True):
            assert (x == y).all()


def test_lists_in_several_steps():
    rng = random.Random(3)
    rows = [(rng.randrange(40), rng.randrange(-9, 9)) for _ in range(600)] + [(99, 1)]
    kinds = (np.uint64, np.int64, np.int32, np.int32)
    held, found = [np.zeros(0, k) for k in kinds], set()
    for at in range(0, len(rows), 70):
        some = [(sig, of, of + 20, sig + of + 10) for sig, of in rows[at : at + 70]]
        held, out = jaccard.listed(held, [np.array(x, k) for x, k in zip(zip(*some, strict=True), kinds, strict=True)])
        found |= set(zip(*(x.tolist() for x in out), strict=True))
    members, heads = defaultdict(set), {}
    for sig, *rest in found:
        members[sig] |= {tuple(rest[:3]), tuple(rest[3:])}
        assert heads.setdefault(sig, rest[3:]) == rest[3:] and rest[0] != rest[3]
    expected = defaultdict(set)
    for sig, of in rows:
        expected[sig].add((of, of + 20, sig + of + 10))
    assert members == {sig: x for sig, x in expected.items() if len(x) > 1}
    assert held[0].tolist() == sorted(expected)


def test_signature_counts():
    table = np.zeros(1 << jaccard.COUNT_BITS, np.uint8)
    for n in (1, 2, 3, 9, 29, 30, 39, 40, 41, 200):
        found = np.unique(np.random.default_rng(n).integers(0, 1 << 64, n, dtype=np.uint64))
        sig, room = jaccard.signatures(found, table, 40)
        assert len(sig) == len(room) == jaccard.signature_count(len(found), 40)


def _roomy(x, y):
    (_, n, room), (_, m, other) = x, y
    return 100 * min(n, m) >= 75 * max(n, m) and 175 * min(room, other) >= 75 * (n + m)


def test_whole_lists_leave_out_members_without_room_and_no_roomy_pair():
    rng = random.Random(7)
    kinds = (np.uint64, np.int64, np.int32, np.int32)
    sizes = {of: rng.randrange(20, 60) for of in range(-30, 30)}
    rows = list({(sig := rng.randrange(300), of := rng.randrange(-30, 30)): (sig, of, sizes[of], sizes[of] - rng.randrange(sizes[of] // 2)) for _ in range(900)}.values())
    members = defaultdict(list)
    for sig, *rest in rows:
        members[sig].append(tuple(rest))
    twice = [np.array(x, k) for x, k in zip(zip(*rows + rows[:50], strict=True), kinds, strict=True)]
    found, heads = defaultdict(list), defaultdict(set)
    for sig, *rest in zip(*(x.tolist() for x in jaccard.whole_lists(twice)), strict=True):
        found[sig].append(tuple(rest[:3]))
        heads[sig].add(tuple(rest[3:]))
    for sig, entries in members.items():
        roomy = {x for x in entries if any(_roomy(x, y) for y in entries if x != y)}
        assert roomy <= set(found[sig]) <= set(entries)
        assert len(found[sig]) == len(set(found[sig])) != 1
        if found[sig]:
            assert len(heads[sig]) == 1 and heads[sig] <= set(found[sig])
        if len(entries) == 2:  # of two, the bounds are exact but for the sizes
            x, y = entries
            assert bool(found[sig]) == (175 * min(x[2], y[2]) >= 75 * (x[1] + y[1]))
    assert sum(map(len, found.values())) < 0.8 * len(rows)
    nothing = [np.zeros(0, k) for k in kinds]
    assert [len(x) for x in jaccard.whole_lists(nothing)] == [0] * 7
    assert [len(x) for x in jaccard.whole_lists([x[:1] for x in twice])] == [0] * 7


def test_links_are_the_same_in_steps(spark, monkeypatch):
    rng = random.Random(11)
    common = " ".join(f"c{i}" for i in range(12))
    docs = []
    for of in range(40):
        words = [f"w{rng.randrange(4000)}" for _ in range(rng.randrange(6, 120))]
        for copy in range(3):
            docs.append((3 * of + copy, " ".join(words + [f"x{of}{copy}"] * (copy > 0)) + (f" {common}" if of % 2 else "")))
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    whole = {tuple(r) for r in jaccard.join(frame).collect()}
    sets = {k: {tuple(w[i : i + 5]) for i in range(len(w) - 4)} for k, t in docs for w in [t.split()]}
    least = {k: k for k in sets}
    for x in sorted(sets):
        for y in sorted(sets):
            if x < y and 100 * len(sets[x] & sets[y]) >= 75 * len(sets[x] | sets[y]):
                lo, hi = sorted((least[x], least[y]))
                least = {k: lo if v == hi else v for k, v in least.items()}
    assert whole == {(k, len(x), least[k]) for k, x in sets.items()}
    # Blocks that don't fit in one step are streamed.
    listed, steps = jaccard._lists_of, []
    monkeypatch.setattr(jaccard, "ENTRIES", 200)
    monkeypatch.setattr(jaccard, "_lists_of", lambda blocks, parts: steps.append(parts) or listed(blocks, 2))
    assert {tuple(r) for r in jaccard.join(frame).collect()} == whole
    assert steps[0] > 2


def test_heads_are_rows_once():
    out = [np.array(x, k) for x, k in zip(zip((5, 2, 20, 9, 1, 21, 9), (5, 3, 22, 8, 1, 21, 9), (7, 4, 20, 7, 2, 23, 8), strict=True), (np.uint64, *[np.int64] * 6), strict=True)]
    rows, told = jaccard.with_heads(out, np.zeros(0, np.uint64))
    assert sorted(zip(*(x.tolist() for x in rows), strict=True))[0] == (5, 1, 21, 9, 1, 21, 9)
    assert len(rows[0]) == 5 and told.tolist() == [5, 7]
    rows, told = jaccard.with_heads([x[1:] for x in out], told)
    assert len(rows[0]) == 2 and told.tolist() == [5, 7]
