"""Repair of a conversation's structure: the cheapest edits, by the auction algorithm for shortest paths.

The turns to come and what has been said make a lattice: a node is (turns read,
state), the states being nothing yet, after a system turn, after a user's and
after an assistant's. Keep, Rerole and Delete read a turn, Insert reads none,
and all cost whole numbers. The auction keeps a price at every node, never more
than an arc's cost and the price behind it, and a path from the origin: it is
extended along the cheapest arc where the price holds, else the price rises to
what the cheapest arc asks and the path is contracted. When the path reaches
the goal, the prices are dual optimal: an arc is on a shortest path only if it
is tight, and the tight arcs that lead to the goal are followed, the smallest
letter first.

A conversation is cut into chunks of CHUNK turns. The costs between the states
at both ends of a chunk are auctioned chunk by chunk, one narrow row of each is
passed through its conversation backwards for the prices at the cuts, each
chunk is traced from every state it may begin in, and one pass forwards picks
the trace. So work is linear in a conversation's length, and only the narrow rows of a
conversation meet in one task, streamed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import settle_table
from .common import annotate
from .sequences import NOTHING, digests, numbered, streamed

#: Turns in a chunk.
CHUNK = 64
MEMO = 20_000
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
#: State and role initial -> next state; a conversation may end in ENDS. States: 0 nothing, 1 system, 2 user, 3 assistant.
NEXT = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
ENDS = (0, 3)
STATES = 4
NEVER = 1 << 40
LEGAL = {"su", "ua", "au"}
#: Characters that aren't blank, and those that end a sentence.
_SOLID, _LAST = r"[^\x20\x09-\x0D]", r"([^\x20\x09-\x0D])[\x20\x09-\x0D]*\z"


def faults(turns: DataFrame, within: str | None = None) -> DataFrame:
    """conv_id, at (place from 0), turn, role, text, initial, fault: `b` blank, `d` duplicate, `t` truncated or `.` none.

    turns: conv_id, turn, role, text and, if named, a column that orders the
    rows of a turn; others are not read. Turns are ordered by (turn, that
    column, role, text), nulls first. A null role or text is one space, a null
    conv_id is a conversation of its own. A row is a duplicate if role and text
    stand in an earlier row.
    """
    role, text = F.coalesce("role", F.lit(" ")), F.coalesce("text", F.lit(" "))
    order = F.col(within) if within else F.lit(0)
    rows = turns.select("conv_id", F.col("turn").cast("long"), role.alias("role"), text.alias("text"), order.alias("within"))
    rows = numbered(rows, "conv_id", "turn", ["within", "role", "text"]).drop("within")
    rows = rows.withColumn("said", F.sha2(F.concat(F.octet_length("role").cast("string"), F.lit(":"), "role", "text"), 256))
    rows = settle_table(rows)
    earliest = rows.groupBy(F.col("conv_id").alias("of"), "said").agg(F.min("at").alias("first"))
    earliest = earliest.select("of", "first", F.lit(True).alias("new"))
    end = F.regexp_extract("text", _LAST, 1)
    fault = (
        F.when(~F.col("text").rlike(_SOLID), "b").when(F.col("new").isNull(), "d").when(~end.isin(".", "!", "?"), "t").otherwise(".")
    )
    told = rows.join(earliest, F.col("conv_id").eqNullSafe(F.col("of")) & (F.col("at") == F.col("first")), "left")
    return told.select("conv_id", "at", "turn", "role", "text", F.substring("role", 1, 1).alias("initial"), fault.alias("fault"))


def lattice(initials: str, marks: str, goals: list[int | None], final: bool) -> list[list[tuple[str, int, int, str]]]:
    """Arcs (letter, cost, next node, role) of every node; node = turns read * STATES + state, and the last node is the goal.

    goals: the cost from each state at the end to the goal, None for no way.
    Inserts after the last turn belong to the next chunk, but for the final one.
    """
    n = len(initials)
    goal = (n + 1) * STATES
    arcs: list[list[tuple[str, int, int, str]]] = [[] for _ in range(goal + 1)]
    for at in range(n + 1):
        for state in range(STATES):
            out = arcs[at * STATES + state]
            if at < n:
                ahead, mark = (at + 1) * STATES, marks[at]
                more = TRUNCATED if mark == "t" else 0
                out.append(("D", DELETE, ahead + state, ""))
                if mark in ".t":
                    if (state, initials[at]) in NEXT:
                        out.append(("K", KEEP + more, ahead + NEXT[state, initials[at]], ""))
                    out += [("R", REROLE + more, ahead + NEXT[state, r], r) for r in "ua" if (state, r) in NEXT]
            elif goals[state] is not None:
                out.append(("", goals[state], goal, ""))
            if at < n or final:
                out += [("I", INSERT, at * STATES + NEXT[state, r], r) for r in "ua" if (state, r) in NEXT]
    return arcs


def first_prices(initials: str, marks: str, goals: list[int | None]) -> list[int]:
    """What the turns to come cost in any case: feasible prices to begin with."""
    least = min((g for g in goals if g is not None), default=0)
    prices = [least] * STATES + [0]
    for mark in reversed(marks):
        least += {"b": DELETE, "d": DELETE, "t": TRUNCATED}.get(mark, 0)
        prices = [least] * STATES + prices
    return prices


def open_nodes(arcs: list) -> list[bool]:
    """Whether a node has a way to the goal; only such nodes take part."""
    back: list[list[int]] = [[] for _ in arcs]
    for node, out in enumerate(arcs):
        for arc in out:
            back[arc[2]].append(node)
    seen, todo = [False] * len(arcs), [len(arcs) - 1]
    seen[-1] = True
    while todo:
        for node in back[todo.pop()]:
            if not seen[node]:
                seen[node] = True
                todo.append(node)
    return seen


def auction(arcs: list, prices: list[int], origin: int) -> int:
    """Raises prices until a tight path leads from origin to the goal; its cost, which is the origin's price.

    Feasible prices stay feasible, so origins can be auctioned one after the
    other. Every contraction raises a price by one or more, and no price rises
    above the cost of the way from its node.
    """
    goal = len(arcs) - 1
    path = [origin]
    while path[-1] != goal:
        node = path[-1]
        asked, ahead = min((cost + prices[to], to) for _, cost, to, _ in arcs[node])
        if prices[node] < asked:
            prices[node] = asked
            if len(path) > 1:
                path.pop()
        else:
            path.append(ahead)
    return prices[origin]


def pruned(arcs: list) -> tuple[list, list[bool]]:
    useful = open_nodes(arcs)
    return [[arc for arc in out if useful[arc[2]]] for out in arcs], useful


def crossing(initials: str, marks: str, final: bool) -> list[list[int]]:
    """Cost from each state at a chunk's beginning to each at its end; for the final chunk, to the goal, the same in every column."""
    table = [[NEVER] * STATES for _ in range(STATES)]
    for end in range(1 if final else STATES):
        goals = [0 if (s in ENDS if final else s == end) else None for s in range(STATES)]
        arcs, useful = pruned(lattice(initials, marks, goals, final))
        prices = first_prices(initials, marks, goals)
        for begin in range(STATES):
            if useful[begin]:
                cost = auction(arcs, prices, begin)
                for column in range(STATES) if final else [end]:
                    table[begin][column] = cost
    return table


def traces(initials: str, marks: str, goals: list[int | None], final: bool, begins: list[int]) -> list:
    """For each state: audit letters, cost within the chunk, the state at its end, and lines (row or -1, role or ""); None if not asked for or shut.

    Among the cheapest ways the one of the least letters.
    """
    whole, useful = pruned(lattice(initials, marks, goals, final))
    prices = first_prices(initials, marks, goals)
    found: list = [None] * STATES
    for begin in begins:
        if not useful[begin]:
            continue
        auction(whole, prices, begin)
        tight, leads = pruned([[arc for arc in out if prices[node] == arc[1] + prices[arc[2]]] for node, out in enumerate(whole)])
        node, goal, cost, audit, lines = begin, len(whole) - 1, 0, [], []
        while True:
            letter, price, ahead, role = min(arc for arc in tight[node] if leads[arc[2]])
            if ahead == goal:
                break
            audit.append(letter)
            cost += price
            if letter == "I":
                lines.append((-1, role))
            elif letter != "D":
                lines.append((node // STATES, role))
            node = ahead
        found[begin] = ("".join(audit), cost, node % STATES, lines)
    return found


def edits(rows: DataFrame) -> DataFrame:
    """conv_id, chunk, audit, cost, lines (row in the chunk or -1, new role's initial or ""), n_blank, n_duplicate, n_truncated, n_illegal.

    rows: conv_id, at, initial, fault.
    """
    of = F.floor(F.col("at") / CHUNK).cast("long")
    known = F.when(F.col("initial").isin("s", "u", "a"), F.col("initial")).otherwise("x")
    marked = rows.groupBy("conv_id", of.alias("chunk")).agg(
        F.array_sort(F.collect_list(F.struct("at", known.alias("initial"), F.col("fault").alias("fault")))).alias("t")
    )
    sizes = rows.groupBy(F.col("conv_id").alias("of")).agg(F.max("at").alias("end"))
    chunks = marked.join(sizes, F.col("conv_id").eqNullSafe(F.col("of"))).select(
        "conv_id", "chunk", F.array_join("t.initial", "").alias("initials"), F.array_join("t.fault", "").alias("marks"),
        (F.floor(F.col("end") / CHUNK) == F.col("chunk")).alias("final"),
    )
    chunks = settle_table(chunks)
    said = ["initials", "marks", "final"]

    def memo(work):
        known: dict = {}

        def look(*key):
            if key not in known:
                if len(known) >= MEMO:
                    known.clear()
                known[key] = work(*key)
            return known[key]

        return look

    def start_crossing():
        one = memo(lambda initials, marks, final: [x for row in crossing(initials, marks, final) for x in row])
        return lambda a, b, c: [[one(x.decode(), y.decode(), z) for x, y, z in zip(a, b, c, strict=True)]]

    # A conversation of one chunk needs no costs between states.
    costs = annotate(chunks.where("not final or chunk > 0"), said, "crossing array<long>", start_crossing)

    def start_back():
        held: dict = {"goals": None}

        def work(finals, tables):
            out = []
            for final, table in zip(finals, tables, strict=True):
                if final:
                    held["goals"] = [0] * STATES
                goals = held["goals"]
                least = min(goals)
                out.append([g - least for g in goals])
                held["goals"] = [
                    min(NEVER, min(table[s * STATES + e] + goals[e] for e in range(STATES))) for s in range(STATES)
                ]
            return [out]

        return work

    backward = streamed(costs, "conv_id", [F.desc("chunk")], ["final", "crossing"], "goals array<long>", start_back)
    alone = chunks.where("final and chunk = 0").withColumn("goals", F.array(*[F.lit(0).cast("long")] * STATES))
    priced = backward.drop("crossing").unionByName(alone).repartition("conv_id", "chunk")
    fields = "traces array<struct<audit: string, cost: long, end: int, lines: array<struct<row: int, role: string>>>>"

    def start_traces():
        def all_of(initials, marks, final, chunk, goals):
            allowed = [(0 if s in ENDS else None) if final else g if g < NEVER // 2 else None for s, g in enumerate(goals)]
            return traces(initials, marks, allowed, final, [0] if chunk == 0 else list(range(STATES)))

        one = memo(all_of)
        return lambda a, b, c, d, e: [
            [one(x.decode(), y.decode(), z, min(k, 1), tuple(g)) for x, y, z, k, g in zip(a, b, c, d, e, strict=True)]
        ]

    traced = annotate(priced, [*said, "chunk", "goals"], fields, start_traces, keep=["conv_id", "chunk", "initials", "marks"])

    def start_forward():
        held: dict = {"state": 0, "last": ""}

        def work(chunks, initials, tables):
            out = []
            for chunk, codes, table in zip(chunks, initials, tables, strict=True):
                codes = codes.decode()
                if chunk == 0:
                    held.update(state=0, last="")
                line = held["last"] + codes
                illegal = sum(line[i : i + 2] not in LEGAL for i in range(len(line) - 1))
                trace = table[held["state"]]
                held.update(state=trace["end"], last=codes[-1:])
                out.append((trace["audit"], trace["cost"], [(x["row"], x["role"]) for x in trace["lines"]], illegal))
            return list(zip(*out, strict=True)) if out else [[], [], [], []]

        return work

    forward = streamed(
        traced, "conv_id", [F.col("chunk")], ["chunk", "initials", "traces"],
        "audit string, cost long, lines array<struct<row: int, role: string>>, n_illegal long", start_forward,
        keep=["conv_id", "chunk", "marks"],
    )

    def marks_of(letter: str):
        return (F.length("marks") - F.length(F.replace("marks", F.lit(letter), F.lit("")))).cast("long")

    return forward.select(
        "conv_id", "chunk", "audit", "cost", "lines", "n_illegal",
        marks_of("b").alias("n_blank"), marks_of("d").alias("n_duplicate"), marks_of("t").alias("n_truncated"),
    )


def repaired(rows: DataFrame, edited: DataFrame) -> DataFrame:
    """conv_id, chunk, place (in the chunk), role, text, inserted: the turns after the edits. rows: of `faults`; edited: of `edits`."""
    lines = edited.select(F.col("conv_id").alias("of"), "chunk", F.posexplode("lines").alias("place", "line"))
    at = F.when(F.col("line.row") >= 0, F.col("chunk") * CHUNK + F.col("line.row"))
    lines = lines.select("of", "chunk", "place", at.alias("from"), F.col("line.role").alias("initial"))
    role = F.when(F.col("initial") == "u", "user").when(F.col("initial") == "a", "assistant").otherwise(F.col("role"))
    texts = rows.select("conv_id", "at", "role", "text")
    kept = lines.where("from is not null").join(texts, F.col("of").eqNullSafe(F.col("conv_id")) & (F.col("from") == F.col("at")))
    kept = kept.select(F.col("of").alias("conv_id"), "chunk", "place", role.alias("role"), "text", F.lit(False).alias("inserted"))
    put = lines.where("from is null").withColumns({"role": F.lit(""), "text": F.lit("")})
    return kept.unionByName(
        put.select(F.col("of").alias("conv_id"), "chunk", "place", role.alias("role"), "text", F.lit(True).alias("inserted"))
    )


def report(conversations: DataFrame, turns: DataFrame, within: str | None = None) -> DataFrame:
    """One row per conversation: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.

    conversations: conv_id, each counted once; those without turns have zeros,
    an empty audit and the digest of nothing. turns: as `faults` takes them.
    gaps: numbers that no turn has, between the smallest and the largest.
    illegal: neighbours whose role initials can't follow each other, before the
    repair. repaired_sha256: of `role:text` of the repaired turns, joined by newlines.
    """
    rows = settle_table(faults(turns, within))
    edited = settle_table(edits(rows))
    numbers = rows.groupBy("conv_id", "turn").agg(F.lit(1).alias("one")).groupBy("conv_id").agg(
        (F.max("turn") - F.min("turn") + 1 - F.count("turn")).alias("gaps")
    )
    sums = edited.groupBy("conv_id").agg(
        *[F.sum(f"n_{x}").alias(x) for x in ("blank", "duplicate", "truncated", "illegal")], F.sum("cost").alias("cost"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("chunk", "audit"))), lambda x: x["audit"]), "").alias("audit"),
    )
    # A null conv_id is a key of its own in the digests as well.
    pieces = repaired(rows, edited).groupBy("conv_id", "chunk").agg(
        F.array_join(
            F.transform(F.array_sort(F.collect_list(F.struct("place", "role", "text"))), lambda x: F.concat(x["role"], F.lit(":"), x["text"])),
            "\n",
        ).alias("piece")
    )
    shas = digests(pieces, "conv_id", "chunk", "piece", "\n")
    out = conversations.select("conv_id").distinct()
    for part in (numbers, sums, shas):
        part = part.withColumnRenamed("conv_id", "of")
        out = out.join(part, F.col("conv_id").eqNullSafe(F.col("of")), "left").drop("of")
    zero = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return out.select(
        "conv_id", *zero, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("sha256", F.lit(NOTHING)).alias("repaired_sha256")
    )
