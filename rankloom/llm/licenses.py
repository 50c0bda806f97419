"""Licence scan: an Aho-Corasick automaton over words, and licence expressions.

A text's words are joined by single spaces, and one automaton finds all phrases
in one pass over them. Where it finds the identifier tag, the expression after
it is read from the text, brought into postfix order by the shunting-yard
algorithm and evaluated: `or` takes the least demanding side, `and` the most
demanding one, `with` an exception that lowers strong copyleft to weak.
"""

from __future__ import annotations

import re

import ahocorasick
from pyspark.sql import DataFrame

from .common import annotate

# Fixed values. Phrases whose places are counted, with their labels.
BASE = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
# Further phrases: words, label, certainty that the text is under that licence.
NOTICES = {
    "permission is hereby granted free of charge to any person obtaining a copy": ("mit", 0.9),
    "redistribution and use in source and binary forms": ("bsd", 0.9),
    "permission to use copy modify and or distribute this software": ("isc", 0.9),
    "licensed under the apache license": ("apache", 0.9),
    "this is free software you can redistribute it": ("gpl", 0.8),
    "lesser general public license": ("lgpl", 0.8),
    "affero general public license": ("agpl", 0.8),
    "mozilla public license": ("mpl", 0.8),
    "eclipse public license": ("epl", 0.8),
    "boost software license": ("bsl", 0.8),
    "this is free and unencumbered software released into the public domain": ("unlicense", 0.9),
    "creative commons attribution": ("cc-by", 0.7),
    "licensed under cc by": ("cc-by", 0.8),
    "licensed under cc by nc": ("cc-by-nc", 0.8),
    "licensed under cc by sa": ("cc-by-sa", 0.8),
    "cc0 1 0 universal": ("cc0", 0.8),
    "all rights reserved": ("reserved", 0.3),
}
# Licence families of identifiers by prefix, longest first, and what they demand.
FAMILIES = {
    "apache": 0, "mit": 0, "bsd": 0, "isc": 0, "zlib": 0, "unlicense": 0, "cc0": 0, "cc-by-sa": 2, "cc-by-nc": 2, "cc-by": 0, "bsl": 0,
    "python": 0, "mpl": 1, "epl": 1, "lgpl": 1, "gpl": 2, "agpl": 2,
}
UNKNOWN = 3
#: Expressions that a task remembers.
MEMO = 4096
TAG = " spdx license identifier "
MENTION = 0.6
BINDING = {"or": 1, "and": 2, "with": 3}

_BREAKS = bytes(b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
_TAG_IN_TEXT = re.compile(rb"spdx-license-identifier:[ \t]*([^\r\n]*)")
_PART = re.compile(r"\(|\)|[a-z0-9.+\-:]+")


def family(identifier: str) -> tuple[str, int]:
    for name in sorted(FAMILIES, key=len, reverse=True):
        if identifier == name or identifier.startswith((f"{name}-", f"{name}+")):
            return name, FAMILIES[name]
    return identifier.rstrip("+"), UNKNOWN


def postfix(parts: list[str]) -> list[str] | None:
    """Shunting-yard; None where parts aren't an expression."""
    out, held, operand = [], [], False
    for part in parts:
        if part == "(":
            if operand:
                return None
            held.append(part)
        elif part == ")":
            if not operand:
                return None
            while held and held[-1] != "(":
                out.append(held.pop())
            if not held:
                return None
            held.pop()
        elif part in BINDING:
            if not operand:
                return None
            while held and held[-1] != "(" and BINDING[held[-1]] >= BINDING[part]:
                out.append(held.pop())
            held.append(part)
            operand = False
        else:
            if operand:
                return None
            out.append(part)
            operand = True
    if not operand or "(" in held:
        return None
    return out + held[::-1]


def longest(parts: list[str]) -> int:
    """How many parts the longest beginning has that is an expression; found in one pass, 0 if none is."""
    operand, opened, found = False, 0, 0
    for end, part in enumerate(parts, 1):
        if operand == (part == "(" or part not in BINDING and part != ")") or part == ")" and not opened:
            break
        opened += (part == "(") - (part == ")")
        operand = part not in BINDING and part != "("
        if operand and not opened:
            found = end
    return found


def evaluate(expression: str) -> tuple[frozenset[str], int] | None:
    """Labels and demand (0 permissive, 1 weak, 2 strong copyleft, 3 unknown) of a lower-case expression.

    The longest beginning of the line that is an expression counts, as comment
    ends and prose may follow, however long the line is.
    """
    parts = _PART.findall(expression)
    order = postfix(parts[: longest(parts)])
    if not order:
        return None
    stack: list[tuple[set[str], int, bool]] = []
    for part in order:
        if part not in BINDING:
            label, demand = family(part)
            stack.append(({label}, demand, True))
            continue
        right, left = stack.pop(), stack.pop()
        if part == "with":
            if not (left[2] and right[2]):
                return None
            stack.append((left[0], 1 if left[1] == 2 else left[1], False))
        else:
            pick = min if part == "or" else max
            few, many = sorted((left[0], right[0]), key=len)
            many |= few
            stack.append((many, pick(left[1], right[1]), False))
    return frozenset(stack[0][0]), stack[0][1]


def automaton() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    phrases: dict[str, list] = {}
    for words, label in BASE.items():
        phrases.setdefault(f" {words} ", []).append(("base", label, MENTION))
    for words, (label, sure) in NOTICES.items():
        phrases.setdefault(f" {words} ", []).append(("notice", label, sure))
    phrases.setdefault(TAG, []).append(("tag", "", 0.5))
    for words, what in phrases.items():
        found.add_word(words, (len(words), what))
    found.make_automaton()
    return found


def scanner():
    """A function from a text's bytes to the fields of `scan`."""
    phrases = automaton()
    known: dict[bytes, tuple[frozenset[str], int] | None] = {}

    def valued(expression: bytes) -> tuple[frozenset[str], int] | None:
        if expression not in known:
            if len(known) >= MEMO:
                known.clear()
            known[expression] = evaluate(expression.decode("latin-1"))
        return known[expression]

    def one(text: bytes | None):
        low = (text or b"").lower()
        words = low.translate(_BREAKS).split()
        line = f" {b' '.join(words).decode('latin-1')} "
        n_base, first, last, base, labels, score, demand = 0, None, None, set(), set(), 0.0, None
        counted = at = 0  # spaces before `at`
        tagged = False
        for end, (length, what) in phrases.iter(line):
            start = end - length + 1
            for kind, label, sure in what:
                score = max(score, sure)
                if kind == "tag":
                    tagged = True
                    continue
                labels.add(label)
                if kind == "base":
                    counted += line.count(" ", at, start) if start >= at else -line.count(" ", start, at)
                    at = start
                    n_base, base = n_base + 1, base | {label}
                    first = counted if first is None else min(first, counted)
                    last = counted if last is None else max(last, counted)
        if tagged:
            for expression in _TAG_IN_TEXT.findall(low):
                if got := valued(expression):
                    labels |= got[0]
                    demand = got[1] if demand is None else max(demand, got[1])
                    score = 1.0
        return len(words), n_base, first, last, ",".join(sorted(base)), ",".join(sorted(labels)), score, demand

    return one


def scan(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: key, n_words, n_base, first_word, last_word, base_labels, labels, score, demand.

    A null text is empty: no words, empty labels, score 0. Letters A-Z are
    lower-cased; words are runs of ASCII letters, digits and non-ASCII
    characters. Overlapping and repeated places all count. score: 1 for a valid
    identifier expression, else the largest certainty of the phrases found.
    demand: of the expressions (the most demanding of several tags), else null.
    Columns other than key and text are not read; rows stay as many as they are.
    """
    fields = "n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, demand int"

    def start():
        one = scanner()
        return lambda texts: list(zip(*map(one, texts), strict=True))

    return annotate(docs.select(key, text), [text], fields, start, keep=[key])
