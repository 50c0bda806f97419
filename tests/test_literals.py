"""List literals against Python's own readers."""

import ast
import json
import random
import warnings

import pytest
from pyspark.sql import functions as F

from rankloom.functions import literals
from rankloom.functions import text as tx

CASES = [
    "[]", "[ ]", "['a']", "['a'] x", "['a', 'b'", "[1, None]", '["it\'s"]', "['a' 'b', \"c\"]", "[1_000, +5, -0, 1.50, 1e3, 007]",
    "[1e16, 1e-7, 1.5e20, 12345678.0, 0.0001, -2.5e-10]", "[null, true]", "[None, true]", "[True,]", "[,]", "['a',,'b']",
    "['\\n\\t\\x41\\u00e9\\101\\q\\\\']", '["a\\/b", "\\u00e9\\""]', "['a', ['b', 1], (1, 2)]", "('a', 'b')", "{'a'}", "[ 'a' ]\n",
    "['a\nb']", "['it\\'s']", '["tab\there"]', "[NaN, -Infinity]", "[1 2]", "['a'1]", "x['a']", "", "[']']", "['é','中']", "['a','b']]",
    "[1.]", "[.5, 5e-1]", "[-1.0]", "['\\']", '[""]', "['x','',' y ']", "[", "]", "['\\x4']", "['\\u12']", "[{'a': 1}, 'b']", "['a': 'b']",
]


def read(text, as_json):
    if as_json:
        try:
            found = json.loads(text)
            return [str(x) for x in found] if isinstance(found, list) else None
        except ValueError:
            pass
    try:
        with warnings.catch_warnings():
            warnings.simplefilter("ignore")
            found = ast.literal_eval(text.strip())
    except (SyntaxError, ValueError):
        return None
    # A list before a comma is a tuple's item in Python, and trailing text here.
    return [str(x) for x in found] if isinstance(found, list) else None


def written(rng):
    """A list with odd quotes, spaces, escapes and faults."""
    item = lambda: rng.choice([
        repr(rng.choice(["a", "it's", 'say "x"', "a\\b", "é\n", "", "]", ", ", "'"])), json.dumps(rng.choice(["b", "é\t", '"', "c, d"])),
        str(rng.choice([0, -3, 12, 1.5, -0.25, 1e22, 1e-9, True, None])), "null", "['n']", "''", "x",
    ])
    text = "[" + rng.choice([", ", ",", " , "]).join(item() for _ in range(rng.randrange(5))) + rng.choice(["]", "]", "]", ",]", " ]", "", "] ]"])
    if rng.random() < 0.2 and text:
        at = rng.randrange(len(text))
        text = text[:at] + rng.choice(["", "'", "\\", ","]) + text[at + 1 :]
    return text


@pytest.mark.parametrize("as_json", [False, True])
def test_literals_are_read_as_python_reads_them(spark, as_json):
    rng = random.Random(7)
    cases = CASES + [written(rng) for _ in range(1500)]
    df = spark.createDataFrame(list(enumerate(cases)), "i int, text string")
    got = {r["i"]: r["items"] for r in df.select("i", literals.read_literal(F.col("text"), as_json).alias("items")).collect()}
    assert [(c, got[i]) for i, c in enumerate(cases)] == [(c, read(c, as_json)) for c in cases]


def test_long_literals_do_not_nest_the_matcher(spark):
    text = "['" + "\\n" * 5_000 + "', " + ", ".join(["1"] * 2_000) + "]"
    plain = repr([str(i) for i in range(20_000)])
    df = spark.createDataFrame([(text,), (plain,), ("['" + "x" * 500_000 + "']",)], "text string")
    sizes = [len(r["items"]) for r in df.select(literals.read_literal(F.col("text")).alias("items")).collect()]
    assert sizes == [2_001, 20_000, 1]


def test_lists_and_rejects(spark):
    rows = [("['a'] x",), ("['a', 'b'",), ("[1, None]",), ('["it\'s"]',), ("a, b",), (None,), ("nan",), ("['a' , 'b',]",), ("(1, 'x')",), ("(1",)]
    df = spark.createDataFrame(rows, "text string")
    got = [tuple(r) for r in df.select(tx.read_list("text"), tx.is_bad_list("text"), tx.relevant_ids("text")).collect()]
    assert got == [
        (["['a'] x"], True, None), (["['a'", "'b'"], True, None), (["1", "None"], False, ["1", "None"]), (["it's"], False, ["it's"]),
        (["a", "b"], False, ["a, b"]), ([], False, []), ([], False, []), (["a", "b"], False, ["a", "b"]), (["(1", "'x')"], False, ["(1, 'x')"]),
        (["(1"], True, ["(1"]),
    ]
