import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from rankloom.operators import lexical, pruning
from rankloom.operators.lexical import LexicalIndex
from rankloom.operators.ordering import QueryBatch
from rankloom.operators.pruning import Chunk, QueryTerms, Search
from tests.test_lexical import check, documents, queries


def prose(rng, kinds, words, length):
    """Words of one of several languages, the first ones most often."""
    kind = rng.integers(kinds)
    return kind * words + np.minimum(rng.zipf(1.3, size=length) - 1, words - 1)


def collection(seed, docs=900, asked=120, kinds=3, words=400):
    """(postings by document: pos, length, size, term, gain), (query, term, weight) of random prose; some documents are copies."""
    rng = np.random.default_rng(seed)
    texts = [prose(rng, kinds, words, rng.integers(0, 120)) for _ in range(docs)]
    texts[docs // 2 : docs // 2 + 40] = [texts[3]] * 40
    found = [np.unique(t, return_counts=True) for t in texts]
    share = np.bincount(np.concatenate([t for t, _ in found]), minlength=kinds * words) / docs
    weight = np.log(1 + 1 / (share + 1e-4))
    length = np.array([len(t) for t in texts])
    gain = np.concatenate([2.5 * n / (n + 1.5 * (0.25 + 0.75 * len(t) / length.mean())) for (_, n), t in zip(found, texts)])
    size = np.array([len(t) for t, _ in found])
    rows = [np.unique(prose(rng, kinds, words, rng.integers(0, 25)), return_counts=True) for _ in range(asked)]
    query = np.repeat(np.arange(asked), [len(t) for t, _ in rows])
    term, times = (np.concatenate([r[i] for r in rows]) for i in (0, 1))
    return (np.arange(docs), length, size, np.concatenate([t for t, _ in found]), gain), (query, term, times * weight[term])


def full(postings, asked, k, docs, n, terms):
    """Every score, and the best k by (score down, position up)."""
    _, _, size, term, gain = postings
    matrix = np.zeros((docs, terms))
    matrix[np.repeat(np.arange(docs), size), term] = gain
    weights = np.zeros((n, terms))
    np.add.at(weights, asked[:2], asked[2])
    scores = weights @ matrix.T
    return {q: [(d, s[d]) for d in np.lexsort((np.arange(docs), -np.round(s, 9)))[:k] if s[d] > 0] for q, s in enumerate(scores)}


def split(postings, at):
    """The documents before and from `at`."""
    pos, length, size, term, gain = postings
    cut = size[:at].sum()
    return (pos[:at], length[:at], size[:at], term[:cut], gain[:cut]), (pos[at:], length[at:], size[at:], term[cut:], gain[cut:])


@pytest.mark.parametrize("k", [1, 5, 60, 2000])
@pytest.mark.parametrize("sizes", [(1024, 2048), (64, 16), (7, 5)])
def test_the_best_are_those_of_a_full_search(monkeypatch, k, sizes):
    monkeypatch.setattr(pruning, "BLOCK_DOCS", sizes[0])
    monkeypatch.setattr(pruning, "GROUP", sizes[1])
    postings, asked = collection(k)
    terms = QueryTerms.of(pa.array(range(120)), pa.array([str(i) for i in range(1200)]), *asked)
    search = Search(terms, k)
    for part in split(postings, 300):
        search.add(Chunk.of([part], terms))
    ids, got = terms.ids.to_numpy(), {q: [] for q in range(120)}
    for q, pos, score, _ in zip(*search.rows):
        got[ids[q]].append((pos, score))
    want = full(postings, asked, k, 900, 120, 1200)
    assert {q: [p for p, _ in r] for q, r in got.items()} == {q: [p for p, _ in r] for q, r in want.items()}
    for q, rows in want.items():
        assert [s for _, s in got[q]] == pytest.approx([s for _, s in rows], abs=1e-9)


def test_a_floor_leaves_what_reaches_it():
    postings, asked = collection(3)
    early, later = split(postings, 200)
    terms = QueryTerms.of(pa.array(range(120)), pa.array([str(i) for i in range(1200)]), *asked)
    first = full(early, asked, 5, 200, 120, 1200)
    floor = {q: round(r[4][1], 9) for q, r in first.items() if len(r) == 5}
    search = Search(terms.with_floor(pa.chunked_array([pa.array(list(floor))]), np.array(list(floor.values()))), 5)
    search.add(Chunk.of([later], terms))
    ids, got = terms.ids.to_numpy(), {q: list(first[q]) for q in range(120)}
    for q, pos, score, _ in zip(*search.rows):
        assert round(score, 9) >= floor.get(ids[q], 0)
        got[ids[q]].append((pos, score))
    want = full(postings, asked, 5, 900, 120, 1200)
    for q in want:
        assert [p for p, _ in sorted(got[q], key=lambda r: (-round(r[1], 9), r[0]))[:5]] == [p for p, _ in want[q]]


def test_few_pairs_are_looked_at(monkeypatch):
    """Before, every posting of a query's terms was summed for every document that holds it."""
    summed, ranges = [], pruning.ranges
    monkeypatch.setattr(pruning, "BLOCK_DOCS", 128)
    monkeypatch.setattr(pruning, "ranges", lambda start, size: summed.append(int(size.sum())) or ranges(start, size))
    postings, asked = collection(11, docs=4000, asked=400)
    terms = QueryTerms.of(pa.array(range(400)), pa.array([str(i) for i in range(1200)]), *asked)
    chunk, search = Chunk.of([postings], terms), Search(terms, 5)
    summed.clear()
    search.add(chunk)
    pairs = np.bincount(asked[1], minlength=1200) @ np.bincount(postings[3], minlength=1200)
    assert sum(summed) < pairs / 3


def test_texts_are_read_once_and_the_result_is_the_same(spark, monkeypatch):
    """A settled index searches group by group, after a floor from its early documents."""
    rng = random.Random(5)
    texts = [" ".join(rng.choices([f"{c}{i}" for i in range(60)], [1 / (i + 1) for i in range(60)], k=rng.randrange(30))) for c in "abc" for _ in range(150)]
    docs = documents(spark, texts + ["", None, texts[7], texts[7], texts[7]])
    asked = [(i, rng.choice(texts), 5) for i in range(90)] + [(90, "", 5), (91, None, 5), (None, "a0 b7", 5), (3, "c2 c5 c5", 5)]
    asked = spark.createDataFrame(asked, "query_id bigint, text string, top_k int")
    index = LexicalIndex.build(docs, settled=True)
    assert "regexp" not in index.packed._jdf.queryExecution().executedPlan().toString()
    want = LexicalIndex.build(docs).search(asked)
    monkeypatch.setattr(lexical, "PRUNED_QUERIES", 40)
    monkeypatch.setattr(pruning, "CHUNK_POSTINGS", 200)
    monkeypatch.setattr(pruning, "BLOCK_DOCS", 16)
    monkeypatch.setattr(LexicalIndex, "scores", None)
    rows = [sorted((r.query_id is None, r.query_id or 0, r.rank, r.pos, round(r.score, 7)) for r in x.collect()) for x in (index.search(asked), want)]
    assert rows[0] == rows[1]


def test_settled_indexes_of_odd_collections(spark, monkeypatch):
    build = LexicalIndex.build
    monkeypatch.setattr(LexicalIndex, "build", lambda docs: build(docs, settled=True))
    check(spark, ["football video analysis", "text generation", "image segmentation"], ["football", "unknown", "", "text text image"], 2)
    check(spark, ["a b"] * 9 + ["", "a"], ["a", "b", "a b", "zzz"], 8)
    assert LexicalIndex.build(documents(spark, ["x"]).where("pos < 0")).search(queries(spark, ["a"], 3)).count() == 0
    assert LexicalIndex.build(documents(spark, ["a", "b"])).search(queries(spark, ["a"], 0)).count() == 0
    found = LexicalIndex.build(documents(spark, ["a b", "b c", "c d"])).search(QueryBatch.of(queries(spark, ["b"], 200)))
    assert [r.pos for r in found.orderBy(F.col("rank")).collect()] == [0, 1, 2]
