r"""Lists written as JSON or as Python literals, read by an automaton inside the JVM.

The text is cut into tokens by one flat pattern (so that no length of text
nests a matcher), and a fold over the tokens is the automaton: it knows whether
an item, a comma or the end may follow, which quote is open, and which of the
two notations is still possible. Anything after the closing bracket, a missing
comma, quote or bracket leaves no notation possible, and the result is null.

Items become the text that Python's str() gives the value: 'None', 'True',
1_000 as 1000, 1.50 as 1.5. Neighbouring quoted strings are one item. An inner
list, tuple or dictionary is one item and keeps the text it is written with.
Hexadecimal, complex and byte literals are not read.

The automaton is written as one SQL lambda: parsed at once, it costs a plan
much less than a column built call by call.
"""

from __future__ import annotations

from functools import cache

from pyspark.sql import Column
from pyspark.sql import functions as F

# Patterns stand in raw SQL strings: \x27 and \x22 are the quotes. An escape is one token; a pair of surrogates as well.
_TOKEN = (
    r"\\u[dD][89abAB][0-9a-fA-F]{2}\\u[dD][c-fC-F][0-9a-fA-F]{2}|\\u[0-9a-fA-F]{4}|\\U[0-9a-fA-F]{8}|\\x[0-9a-fA-F]{2}"
    r"|\\[0-7]{1,3}|\\\r\n|\\[\s\S]|\\$|[\x27\x22,\[\](){}]|[ \t\f]+|[\r\n]+|[^\x27\x22,\[\](){}\\ \t\f\r\n]+"
)
# Most lists: single quotes, nothing to unescape, one comma and blank between items.
_PLAIN = r"^\[(?:\x27[^\x27\\\r\n]*+\x27, )*+\x27[^\x27\\\r\n]*+\x27\]$"
_JSON_NUMBER = r"^-?(0|[1-9][0-9]*)(\.[0-9]+)?([eE][+-]?[0-9]+)?$"
_PYTHON_NUMBER = (
    r"^[+-]?(0(_?0)*|[1-9](_?[0-9])*"
    r"|([0-9](_?[0-9])*\.([0-9](_?[0-9])*)?|\.[0-9](_?[0-9])*|[0-9](_?[0-9])*(?=[eE]))([eE][+-]?[0-9](_?[0-9])*)?)$"
)
_JSON_ESCAPE = r"^\\([\x22\\/bfnrt]|u[0-9a-fA-F]{4}(\\u[0-9a-fA-F]{4})?)$"
# States: before the list, an item or the end may follow, within quotes, after a quoted item, after another item,
# after the end, within an inner container, and the same within quotes.
BEFORE, ITEM, QUOTED, SAID, TOLD, CLOSED, INNER, INNER_QUOTED = range(8)

# What Python calls JSON's words, its own words, and the characters that letters after a backslash stand for.
_JSON_WORDS = {"null": "None", "true": "True", "false": "False", "NaN": "nan", "Infinity": "inf", "-Infinity": "-inf"}
_PYTHON_WORDS = ("None", "True", "False")
_ESCAPES = {"n": 10, "t": 9, "r": 13, "b": 8, "f": 12, "a": 7, "v": 11, "\\": 92, "'": 39, '"': 34}


def _text(value: str) -> str:
    """An SQL string of characters that need no escape."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _any(values) -> str:
    return "(" + ", ".join(map(_text, values)) + ")"


def _code_point(hex_digits: str) -> str:
    return f"decode(unhex(lpad({hex_digits}, 8, '0')), 'UTF-32')"


def _unescaped(json: bool) -> str:
    """What the escape x stands for; Python keeps an escape it does not know."""
    letters = " ".join(f"WHEN substring(x, 2, 1) = {_text(k)} THEN chr({code})" for k, code in _ESCAPES.items())
    slash = "WHEN x = '\\\\/' AND substring(a.quote, 2, 1) = '\"' THEN '/'" if json else ""
    return rf"""CASE
      WHEN length(x) = 12 THEN decode(unhex(concat(substring(x, 3, 4), substring(x, 9, 4))), 'UTF-16BE')
      WHEN length(x) > 2 AND substring(x, 2, 1) IN ('x', 'u', 'U') THEN {_code_point("substring(x, 3, 8)")}
      WHEN rlike(x, r'^\\[0-7]') THEN {_code_point("conv(substring(x, 2, 3), 8, 16)")}
      {letters} WHEN substring(x, 2, 1) IN (chr(10), chr(13)) THEN '' {slash} ELSE x END"""


def _shown_number() -> str:
    """The number x as Python shows its value."""
    plain = "regexp_replace(ltrim('+', x), '_', '')"
    java = f"cast(cast({plain} AS double) AS string)"
    power = f"regexp_replace({java}, r'\\.0E', 'E')"
    power = f"regexp_replace({power}, 'E(-?)([0-9])$', 'E$10$2')"
    power = f"regexp_replace(regexp_replace({power}, 'E-', 'e-'), 'E', 'e+')"
    flat = f"regexp_replace(regexp_replace(cast(cast(cast({plain} AS double) AS decimal(38, 20)) AS string), '0+$', ''), r'\\.$', '.0')"
    size = f"abs(cast({plain} AS double))"
    return f"""CASE
      WHEN NOT rlike(x, '[.eE]') THEN CASE WHEN rlike({plain}, '^-?0+$') THEN '0' ELSE {plain} END
      WHEN {size} = double('Infinity') THEN regexp_replace({java}, 'Infinity', 'inf')
      WHEN NOT contains({java}, 'E') THEN {java}
      WHEN {size} >= 1e-4 AND {size} < 1e16 THEN {flat} ELSE {power} END"""


def _state(m="a.m", quote="a.quote", depth="0", now="''", items="a.items", js="a.js", py="a.py") -> str:
    return f"named_struct('m', {m}, 'quote', {quote}, 'depth', {depth}, 'now', {now}, 'items', {items}, 'js', {js}, 'py', {py})"


@cache
def _reader(json: bool, openings: str) -> str:
    """The lambda from a text to its items."""
    refused = _state(js="false", py="false")
    first, closer, mark = "substring(x, 1, 1)", "substring(a.quote, 1, 1)", "substring(a.quote, 2, 1)"
    blank, quotes, opens, closes = f"{first} IN (' ', chr(9), chr(10), chr(12), chr(13))", f"{first} IN ('\\'', '\"')", "x IN ('[', '(', '{')", "x IN (']', ')', '}')"
    none = "cast(array() AS array<string>)"

    def put(item: str) -> str:
        return f"concat(a.items, array({item}))"

    opened = _state(ITEM, "CASE x WHEN '[' THEN ']' WHEN '(' THEN ')' ELSE '}' END", items=none, js="a.js AND x = '['")
    words = " ".join(f"WHEN x = {_text(k)} THEN {_text(v)}" for k, v in (_JSON_WORDS if json else {}).items())
    told = f"CASE {words} WHEN x IN {_any(_PYTHON_WORDS)} THEN x ELSE {_shown_number()} END"
    in_json = f"(a.js AND (x IN {_any(_JSON_WORDS)} OR rlike(x, r'{_JSON_NUMBER}')))"
    in_python = f"(a.py AND (x IN {_any(_PYTHON_WORDS)} OR rlike(x, r'{_PYTHON_NUMBER}')))"
    bare = f"CASE WHEN {in_json} OR {in_python} THEN {_state(TOLD, items=put(told), js=in_json, py=in_python)} ELSE {refused} END"
    # The first item may be missing, and in Python one after a comma.
    end = _state(CLOSED, js=f"a.js AND (a.m <> {ITEM} OR size(a.items) = 0)")
    quoted = _state(QUOTED, f"concat({closer}, {first})", js="a.js AND x = '\"'")
    item = f"""CASE WHEN {blank} THEN a WHEN x = {closer} THEN {end} WHEN {quotes} THEN {quoted}
      WHEN {opens} THEN {_state(INNER, depth="1", now="x", js="false")}
      WHEN x = ',' OR {closes} OR {first} = '\\\\' THEN {refused} ELSE {bare} END"""
    cut_short = r"x IN ('\\', '\\x', '\\u', '\\U', '\\N')"
    escaped = _state(QUOTED, now=f"concat(a.now, {_unescaped(json)})", js=f"a.js AND rlike(x, r'{_JSON_ESCAPE}')", py=f"a.py AND NOT {cut_short}")
    plain = _state(QUOTED, now="concat(a.now, x)", js=r"a.js AND NOT rlike(x, r'[\x00-\x1f]')")
    in_quotes = f"""CASE WHEN {first} = '\\\\' THEN {escaped} WHEN x = {mark} THEN {_state(SAID, closer, items=put("a.now"))}
      WHEN {first} IN (chr(10), chr(13)) THEN {refused} ELSE {plain} END"""
    more = _state(QUOTED, f"concat({closer}, {first})", now="element_at(a.items, -1)", items="slice(a.items, 1, size(a.items) - 1)", js="false")
    after = f"""CASE WHEN {blank} THEN a WHEN x = ',' THEN {_state(ITEM)} WHEN x = {closer} THEN {end}
      WHEN a.m = {SAID} AND {quotes} THEN {more} ELSE {refused} END"""
    held = "concat(a.now, x)"
    within = [_state(INNER, depth=d, now=held, js="false") for d in ("a.depth", "a.depth + 1", "a.depth - 1")]
    inner = f"""CASE WHEN {quotes} THEN {_state(INNER_QUOTED, f"concat({closer}, {first})", "a.depth", held, js="false")}
      WHEN {opens} THEN {within[1]} WHEN {closes} AND a.depth = 1 THEN {_state(TOLD, items=put(held), js="false")}
      WHEN {closes} THEN {within[2]} ELSE {within[0]} END"""
    inner_quoted = f"CASE WHEN x = {mark} THEN {_state(INNER, closer, 'a.depth', held, js='false')} ELSE {_state(INNER_QUOTED, depth='a.depth', now=held, js='false')} END"
    step = f"""CASE WHEN NOT (a.js OR a.py) THEN a
      WHEN a.m = {BEFORE} THEN CASE WHEN {blank} THEN a WHEN x IN {_any(openings)} THEN {opened} ELSE {refused} END
      WHEN a.m = {ITEM} THEN {item} WHEN a.m = {QUOTED} THEN {in_quotes} WHEN a.m IN ({SAID}, {TOLD}) THEN {after}
      WHEN a.m = {CLOSED} THEN CASE WHEN {blank} THEN a ELSE {refused} END
      WHEN a.m = {INNER} THEN {inner} ELSE {inner_quoted} END"""
    begin = _state(BEFORE, "''", "0", "''", none, str(json).lower(), "true")
    return f"""t -> CASE WHEN rlike(t, r'{_PLAIN}') THEN split(substring(t, 3, length(t) - 4), '\\', \\'')
      ELSE aggregate(regexp_extract_all(t, r'{_TOKEN}', 0), {begin}, (a, x) -> {step},
        a -> CASE WHEN a.m = {CLOSED} AND (a.js OR a.py) THEN a.items END) END"""


def read_literal(text: Column, json: bool = False, openings: str = "[") -> Column:
    """Items of a list literal as array<string>; null where the text is none.

    Python's notation, or JSON's if `json` is set and it fits. `openings`: the
    brackets that may begin the text, of `[`, `(` and `{`. A null text gives null.
    """
    return F.get(F.call_function("transform", F.array(text), F.expr(_reader(json, openings))), F.lit(0))
