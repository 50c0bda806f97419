"""Structure repair against a plain dynamic programme, and its odd cases."""

import hashlib
import random
import re
import time

import pytest

from rankloom.llm import repair

COLUMNS = "conv_id gaps blank duplicate truncated illegal cost audit repaired_sha256".split()
DDL = "conv_id long, turn long, role string, text string"


def marks_of(rows):
    seen, marks = set(), []
    for role, text in rows:
        solid = re.findall(r"[^\x20\x09-\x0D]", text)
        marks.append("b" if not solid else "d" if (role, text) in seen else "t" if solid[-1] not in ".!?" else ".")
        seen.add((role, text))
    return marks


def cheapest(rows, marks):
    """Forwards by states: the least (cost, letters) with the lines."""
    names = {"s": "system", "u": "user", "a": "assistant"}

    def insert(best):
        for _ in range(2):
            for (state, role), after in repair.NEXT.items():
                if role != "s" and state in best:
                    cost, audit, lines = best[state]
                    best[after] = min(best.get(after, (9**9,)), (cost + 2, audit + "I", [*lines, f"{names[role]}:"]), key=lambda x: x[:2])
        return best

    best = insert({0: (0, "", [])})
    for (role, text), mark in zip(rows, marks, strict=True):
        ways = {}
        for state, (cost, audit, lines) in best.items():
            steps = [(state, cost + 3, audit + "D", lines)]
            if mark in ".t":
                more = cost + (mark == "t")
                for (at, kind), after in repair.NEXT.items():
                    if at == state and role[:1] == kind:
                        steps.append((after, more, audit + "K", [*lines, f"{role}:{text}"]))
                    if at == state and kind != "s":
                        steps.append((after, more + 2, audit + "R", [*lines, f"{names[kind]}:{text}"]))
            for after, *way in steps:
                ways[after] = min(ways.get(after, (9**9,)), tuple(way), key=lambda x: x[:2])
        best = insert(ways)
    return min((best[s] for s in repair.ENDS if s in best), key=lambda x: x[:2])


def brute(conv, rows):
    """rows in order: (turn, role, text)."""
    said = [(" " if r is None else r, " " if t is None else t) for _, r, t in rows]
    marks = marks_of(said)
    cost, audit, lines = cheapest(said, marks)
    turns = [t for t, _, _ in rows if t is not None]
    illegal = sum(a[0][:1] + b[0][:1] not in repair.LEGAL for a, b in zip(said, said[1:], strict=False))
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    sha = hashlib.sha256("\n".join(lines).encode()).hexdigest()
    return (conv, gaps, marks.count("b"), marks.count("d"), marks.count("t"), illegal, cost, audit, sha)


def conversation(rng, n):
    rows, role = [], "system"
    for turn in range(n):
        role = rng.choice(["user", "assistant", "system", "tool", "", None]) if rng.random() < 0.3 else {"user": "assistant"}.get(role, "user")
        text = rng.choice(["yes.", "no", " ", "", "what?\n ", f"{turn} é!", f"{turn}", None, "x. "])
        rows.append((None if turn < 2 and rng.random() < 0.2 else turn + (turn > n // 2), role, text))
    # The order of rows of one turn is that of their values.
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or " ", r[2] or " "))


@pytest.mark.parametrize("seed,sizes", [(1, range(0, 14)), (2, [63, 64, 65, 128, 129, 300])])
def test_repair_is_the_dynamic_programme(spark, seed, sizes):
    rng = random.Random(seed)
    convs = {c: conversation(rng, n) for c, n in enumerate([*sizes] * (4 if seed == 1 else 1))}
    rows = [(c, *r, 1, "x") for c, said in convs.items() for r in said] + [(None, 0, "user", "hm", 1, "x")]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, f"{DDL}, at int, chunk string")
    ids = spark.createDataFrame([(c, 1) for c in [*convs, *convs, None]], "conv_id long, gaps int")
    got = sorted((tuple(r) for r in repair.report(ids, df).select(COLUMNS).collect()), key=str)
    want = [brute(c, said) for c, said in convs.items()] + [brute(None, [(0, "user", "hm")])]
    assert got == sorted(want, key=str)


def test_repair_of_nothing(spark):
    none = spark.createDataFrame([], DDL)
    assert repair.report(none, none).collect() == []
    (row,) = repair.report(spark.createDataFrame([(4,)], "conv_id long"), none).collect()
    assert tuple(row) == (4, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())


def test_auction_prices_and_tight_arcs():
    """Prices are feasible and the origin's is the shortest distance, for chunks with any goals."""
    rng = random.Random(5)
    for _ in range(300):
        n, final = rng.randrange(0, 12), rng.random() < 0.5
        initials, marks = ("".join(rng.choice(x) for _ in range(n)) for x in ("suax", "..tbd"))
        goals = [0 if s in repair.ENDS else None for s in range(4)] if final else [rng.choice([None, 0, 3, 9]) for _ in range(4)]
        arcs, useful = repair.pruned(repair.lattice(initials, marks, goals, final))
        far = [10**9] * len(arcs)
        far[-1] = 0
        for _ in range(2 * len(arcs)):
            far[:-1] = [min((cost + far[to] for _, cost, to, _ in out), default=10**9) for out in arcs[:-1]]
        prices = repair.first_prices(initials, marks, goals)
        for begin in range(4):
            if useful[begin]:
                assert repair.auction(arcs, prices, begin) == far[begin]
                assert all(prices[i] <= cost + prices[to] for i, out in enumerate(arcs) for _, cost, to, _ in out)
        for begin, found in enumerate(repair.traces(initials, marks, goals, final, [0, 1, 2, 3])):
            assert (found is None) == (not useful[begin])
            if found:
                assert found[1] + (0 if final else goals[found[2]]) == far[begin]


def test_work_is_linear_in_a_conversation(spark):
    """20,000 turns in one conversation."""
    rng = random.Random(9)
    said = [(t, rng.choice(["user", "assistant"]), rng.choice([f"{t}.", f"{t}", ""])) for t in range(20_000)]
    df = spark.createDataFrame([(1, *r) for r in said], DDL)
    started = time.perf_counter()
    (row,) = repair.report(df, df).collect()
    assert time.perf_counter() - started < 120
    rows = [(r, t) for _, r, t in said]
    assert row["cost"] == costs_only(rows, marks_of(rows)) and len(row["audit"]) >= 20_000


def costs_only(rows, marks):
    best = {0: 0, 2: 2, 3: 4}
    for (role, _), mark in zip(rows, marks, strict=True):
        ways = {s: c + 3 for s, c in best.items()}
        if mark in ".t":
            for (at, kind), after in repair.NEXT.items():
                if at in best and kind != "s":
                    ways[after] = min(ways.get(after, 9**9), best[at] + (mark == "t") + (0 if role[:1] == kind else 2))
        for _ in range(2):
            for (at, kind), after in repair.NEXT.items():
                if kind != "s" and at in ways:
                    ways[after] = min(ways.get(after, 9**9), ways[at] + 2)
        best = ways
    return min(best[s] for s in repair.ENDS if s in best)
