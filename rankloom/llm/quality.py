"""Quality rules: figures of the text, and lines that many documents of a host share.

A line is normalised (blanks joined, ASCII letters lower-cased) and hashed.
Lines that stand in more than a share `max_share` of the distinct documents of
a host, and in `least_docs` at least, are taken out of all these documents but
the one of the smallest id, so that of a group of copies one document keeps its
text. A document that is left with too little
is rejected.
"""

from __future__ import annotations

import hashlib
import string

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import settle_table
from .common import annotate

SYMBOLS = b"#*$%&|<>"
WINDOW = 5
_LOWER = bytes.maketrans(string.ascii_uppercase.encode(), string.ascii_lowercase.encode())
FIELDS = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long,"
    " lines array<struct<hash: long, words: int>>"
)


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words that are part of a window of words found twice or more, all its places counted."""
    if len(words) <= window:
        return 0
    ids: dict[bytes, int] = {}
    run = np.array([ids.setdefault(w, len(ids)) for w in words], dtype=np.int64)
    if len(ids) == len(run):
        return 0
    # Equal runs get equal numbers, exactly: a run of n + 1 is a run of n and a word.
    code = run
    for i in range(1, window):
        pair = code[: len(run) - i] * len(ids) + run[i:]
        _, code = np.unique(pair, return_inverse=True)
    times = np.bincount(code)
    starts = np.nonzero(times[code] > 1)[0]
    edges = np.zeros(len(run) + 1, dtype=np.int64)
    np.add.at(edges, starts, 1)
    np.add.at(edges, starts + window, -1)
    return int((np.cumsum(edges)[:-1] > 0).sum())


def line_hash(line: bytes) -> tuple[int, int]:
    words = line.split()
    digest = hashlib.blake2b(b" ".join(words).translate(_LOWER), digest_size=8).digest()
    return int.from_bytes(digest, "little", signed=True), len(words)


def figures(text: bytes | None):
    """The values of FIELDS for a text; a null text has none of anything."""
    text = text or b""
    words = text.split()
    blanks = len(text) - sum(map(len, words))
    code_points = len(text.decode("utf-8", "replace"))
    lines = [line for line in text.split(b"\n") if line and not line.isspace()]
    return (
        len(words),
        code_points - blanks,
        len(text) - len(text.translate(None, SYMBOLS)),
        len(lines) - len(set(lines)),
        repeated_words(words),
        [line_hash(line) for line in lines],
    )


def failed(n_words: Column, n_repeat_words: Column) -> Column:
    return (n_words < 10) | (100 * n_repeat_words > 20 * n_words)


def assess(
    docs: DataFrame, key: str = "doc_id", text: str = "text", host: str = "source",
    max_docs: int | None = None, max_lost: float = 0.6, least_words: int = 10,
    max_share: float = 0.05, least_docs: int = 4,
) -> DataFrame:
    """One row per document: key, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, words_lost, base_failed, kept.

    Null and empty texts have no words and fail. A null host is a host like any
    other, and so is a null key one document. Rows that share a key are one
    document for the counts of lines, and each has its verdict from its own
    text. All documents of a host count, those without lines too. max_docs: a fixed limit
    in place of the share. kept: not base_failed, at most max_lost of the words lost, and
    least_words or more left. Other columns are not read.
    """

    def start():
        return lambda texts: list(zip(*map(figures, texts), strict=True))

    measured = annotate(docs.select(key, host, text), [text], FIELDS, start, keep=[key, host])
    # Row numbers hold once the rows are written.
    rows = settle_table(measured.withColumn("row", F.monotonically_increasing_id()))
    lines = rows.select("row", F.col(key).alias("doc"), F.col(host).alias("host"), F.explode("lines").alias("line"))
    lines = lines.select("row", "doc", "host", "line.hash", "line.words")
    # A struct isn't null where its field is: null hosts join, and null documents count.
    place = F.struct("host", "hash").alias("place")
    per_doc = lines.select("doc", place).select("place", F.struct("doc").alias("doc")).distinct()
    shared = per_doc.groupBy("place").agg(F.count("*").alias("docs"), F.min("doc").alias("first"))
    if max_docs is not None:
        shared = shared.where(F.col("docs") > max_docs)
    else:
        shared = shared.where(F.col("docs") >= least_docs)
        all_docs = rows.select(F.struct(F.col(host).alias("host")).alias("at"), F.struct(F.col(key).alias("doc")).alias("doc")).distinct()
        hosts = all_docs.groupBy("at").agg(F.count("*").alias("all_docs"))
        shared = shared.withColumn("at", F.struct("place.host")).join(hosts, "at").where(F.col("docs") > max_share * F.col("all_docs"))
    lost = (
        lines.select("row", F.struct("doc").alias("doc"), "words", place)
        .join(shared.select("place", "first"), "place")
        .where(F.col("doc") != F.col("first"))
        .groupBy("row")
        .agg(F.sum("words").alias("words_lost"))
    )
    rows = rows.drop("lines").join(lost, "row", "left")
    bad, gone = failed(F.col("n_words"), F.col("n_repeat_words")), F.coalesce("words_lost", F.lit(0))
    depleted = (gone > max_lost * F.col("n_words")) | (F.col("n_words") - gone < least_words)
    return rows.select(
        key, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        gone.cast("long").alias("words_lost"), bad.alias("base_failed"), (~bad & ~depleted).alias("kept"),
    )
