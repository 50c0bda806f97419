"""The best documents of many queries, without summing every posting that they share.

Documents are taken in blocks of similar ones and queries in groups of similar
ones. What a block holds of a query's terms bounds what any of its documents can
score, so most blocks of another language or subject are left at once. The
frequent terms of the others are summed as one matrix product in single
precision. The rest, heaviest first, is summed only as far as a document could
still reach the query's k-th score; then only documents are looked at whose sum
and the bound of the terms left out reach it. What is left at the end is scored
anew in double precision. Bounds are wider than single precision can err, so
the result is that of a full search, whatever the data; only weights above 0
are allowed.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from ..functions import fixed_values as fv

# Documents in a block, queries in a group, and postings that a task holds at once.
BLOCK_DOCS, GROUP, CHUNK_POSTINGS = 1024, 2048, 1_500_000
# Share of a block's documents from which a term is frequent, and of the pairs of a group and a block that its column must fill.
FREQUENT, FILLED = 1 / 64, 0.001
# Kinds of documents and of queries, the terms by which they are told apart, and rows looked at at once.
KINDS, KIND_TERMS, KIND_ROWS, KIND_ROUNDS = 8, 512, 4096, 3
# Share of a block's cells beyond which sums are added to all cells at once, and candidates held before they are thinned.
CROWDED, HELD = 0.3, 500_000


def ranges(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """start[i], start[i] + 1, ... of size[i] numbers, one i after the other."""
    return np.arange(size.sum()) - np.repeat(np.cumsum(size) - size - start, size)


def kinds(row: np.ndarray, term: np.ndarray, value: np.ndarray, n: int, weigh: np.ndarray) -> np.ndarray:
    """A number below KINDS for each of n sparse rows (in order of row), near for those alike in the KIND_TERMS terms that weigh most."""
    top = np.argsort(-weigh, kind="stable")[:KIND_TERMS]
    column = np.full(len(weigh), -1)
    column[top] = np.arange(len(top))

    def dense(rows: np.ndarray) -> np.ndarray:
        low = np.searchsorted(row, rows)
        times = np.searchsorted(row, rows, "right") - low
        at = ranges(low, times)
        of, place = np.repeat(np.arange(len(rows)), times), column[term[at]]
        cells = np.zeros((len(rows), len(top)), np.float32)
        cells[of[place >= 0], place[place >= 0]] = value[at[place >= 0]]
        return _directions(cells)

    if not n:
        return np.zeros(0, int)
    some = dense(np.unique(np.linspace(0, n - 1, min(n, KIND_ROWS)).astype(int)))
    centres = some[np.linspace(0, len(some) - 1, min(KINDS, len(some))).astype(int)]
    for _ in range(KIND_ROUNDS):
        own = (some @ centres.T).argmax(axis=1)
        centres = _directions(np.stack([some[own == i].sum(axis=0) for i in range(len(centres))]))
    return np.concatenate([(dense(np.arange(i, min(i + KIND_ROWS, n))) @ centres.T).argmax(axis=1) for i in range(0, n, KIND_ROWS)])


def _directions(rows: np.ndarray) -> np.ndarray:
    return rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-9)


def best_rows(k: int, query: np.ndarray, pos: np.ndarray, score: np.ndarray, rounded: np.ndarray) -> tuple[np.ndarray, ...]:
    """The k best rows of each query by (rounded score down, pos up)."""
    order = np.lexsort((pos, -rounded, query))
    of = query[order]
    order = order[np.arange(len(of)) - np.searchsorted(of, of) < k]
    return query[order], pos[order], score[order], rounded[order]


@dataclass(frozen=True)
class QueryTerms:
    """Weights by query, start[q]..start[q+1] of term and weight, heaviest first; queries of a kind are neighbours.

    asked: queries that hold a term. slack: what single precision can err in a
    sum of the query. floor: a score that top_k documents elsewhere reach.
    """

    ids: pa.Array
    vocabulary: pa.Array
    start: np.ndarray
    term: np.ndarray
    weight: np.ndarray
    asked: np.ndarray
    slack: np.ndarray
    floor: np.ndarray

    @classmethod
    def of(cls, ids: pa.Array, vocabulary: pa.Array, query: np.ndarray, term: np.ndarray, weight: np.ndarray) -> "QueryTerms":
        """Rows of one query and term are added up."""
        size, n = len(vocabulary), len(ids)
        key, same = np.unique(query.astype(np.int64) * max(size, 1) + term, return_inverse=True)
        weight = np.bincount(same, weights=weight, minlength=len(key))
        query, term = key // max(size, 1), key % max(size, 1)
        asked = np.bincount(term, minlength=size)
        order = np.argsort(kinds(query, term, weight, n, asked), kind="stable")
        place = np.empty(n, np.int64)
        place[order] = np.arange(n)
        query = place[query]
        by = np.lexsort((-weight, query))
        query, term, weight = query[by], term[by], weight[by]
        start = np.searchsorted(query, np.arange(n + 1))
        most = np.bincount(query, weights=weight, minlength=n) * (fv.BM25_K1 + 1)
        slack = (np.diff(start) + 16) * 2.0**-22 * most + 1e-8
        return cls(ids.take(pa.array(order)), vocabulary, start, term.astype(np.int32), weight, asked, slack, np.full(n, -np.inf))

    def with_floor(self, ids: pa.ChunkedArray, floor: np.ndarray) -> "QueryTerms":
        """floor: of the queries `ids`, the others have none."""
        at = pc.index_in(ids, value_set=self.ids).to_numpy()
        found = np.full(len(self.ids), -np.inf)
        found[at] = floor
        return replace(self, floor=found)


@dataclass(frozen=True)
class Chunk:
    """Documents of a task: postings of query terms by document, `order` with similar documents together."""

    pos: np.ndarray
    start: np.ndarray
    term: np.ndarray
    gain: np.ndarray
    order: np.ndarray

    @classmethod
    def of(cls, batches: list[tuple[np.ndarray, ...]], queries: QueryTerms) -> "Chunk":
        pos, length, size, term, gain = (np.concatenate(x) for x in zip(*batches, strict=True))
        doc = np.repeat(np.arange(len(pos), dtype=np.int32), size)
        met = queries.asked * np.bincount(term, minlength=len(queries.asked))
        own = kinds(doc, term, gain, len(pos), met)
        return cls(pos, np.concatenate([[0], np.cumsum(size)]), term, gain, np.lexsort((pos, length, own)))

    def scores(self, queries: QueryTerms, query: np.ndarray, doc: np.ndarray) -> np.ndarray:
        """Of these pairs, in double precision; pairs in order of doc are found faster."""
        size, out = len(queries.vocabulary), np.zeros(len(query))
        key = np.repeat(np.arange(len(self.pos)), np.diff(self.start)) * size + self.term
        gain = self.gain
        if (key[1:] <= key[:-1]).any():
            by = np.argsort(key)
            key, gain = key[by], gain[by]
        step = max(1, HELD // max(1, int(np.diff(queries.start).max(initial=1))))
        for low in range(0, len(query), step):
            q, d = query[low : low + step], doc[low : low + step]
            times = queries.start[q + 1] - queries.start[q]
            at = ranges(queries.start[q], times)
            want = np.repeat(d, times) * size + queries.term[at]
            place = np.minimum(np.searchsorted(key, want), len(key) - 1)
            part = np.where(key[place] == want, gain[place], 0.0) * queries.weight[at]
            out[low : low + step] = np.bincount(np.repeat(np.arange(len(q)), times), weights=part, minlength=len(q))
        return out


class Block:
    """Postings of some documents of a chunk by term; `most`: a term's largest gain, `frequent`: terms with a row in `gains`."""

    def __init__(self, chunk: Chunk, docs: np.ndarray, terms: int):
        times = chunk.start[docs + 1] - chunk.start[docs]
        at = ranges(chunk.start[docs], times)
        term, doc = chunk.term[at], np.repeat(np.arange(len(docs), dtype=np.int32), times)
        by = np.argsort(term, kind="stable")
        term, self.doc, self.gain = term[by], doc[by], chunk.gain[at][by].astype(np.float32)
        self.docs, self.n = docs, len(docs)
        self.size = np.bincount(term, minlength=terms)
        self.start = np.cumsum(self.size) - self.size
        self.key = term.astype(np.int64) * self.n + self.doc
        held = np.flatnonzero(self.size)
        self.most = np.zeros(terms, np.float32)
        self.most[held] = np.maximum.reduceat(self.gain, self.start[held]) if len(held) else 0
        self.frequent = np.flatnonzero(self.size >= max(2, FREQUENT * self.n))
        self.column = np.full(terms, -1, np.int32)
        self.column[self.frequent] = np.arange(len(self.frequent))
        self.gains = np.zeros((len(self.frequent), self.n), np.float32)
        row = self.column[term]
        self.gains[row[row >= 0], self.doc[row >= 0]] = self.gain[row >= 0]

    def found(self, term: np.ndarray, doc: np.ndarray) -> np.ndarray:
        """The gain of each of these terms in each of these documents."""
        want = term.astype(np.int64) * self.n + doc
        place = np.minimum(np.searchsorted(self.key, want), len(self.key) - 1)
        return np.where(self.key[place] == want, self.gain[place], np.float32(0))


class Search:
    """The best k documents of every query, of the chunks shown so far."""

    def __init__(self, queries: QueryTerms, k: int):
        self.queries, self.k = queries, k
        # Scores that so many documents reach for certain; the last is what a candidate must reach.
        self.low = np.full((len(queries.ids), k), -np.inf)
        self.least = queries.floor - 1e-8
        self.weight = queries.weight.astype(np.float32)
        self.query = np.repeat(np.arange(len(queries.ids), dtype=np.int32), np.diff(queries.start))
        self.rows = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0), np.zeros(0))

    def add(self, chunk: Chunk) -> None:
        found: list[tuple[np.ndarray, ...]] = []
        held = 0
        for at in range(0, len(chunk.order), BLOCK_DOCS):
            block = Block(chunk, chunk.order[at : at + BLOCK_DOCS], len(self.queries.vocabulary))
            for first in range(0, len(self.queries.ids), GROUP):
                query, doc, score = self._candidates(block, first, min(first + GROUP, len(self.queries.ids)))
                if len(query):
                    self._raise(query, score - self.queries.slack[query])
                    found.append((query, block.docs[doc], score))
                    held += len(query)
            if held > HELD:
                found = [self._thinned(found)]
                held = len(found[0][0])
        if not found:
            return
        query, doc, _ = self._thinned(found)
        order = np.argsort(doc, kind="stable")
        query, doc = query[order], doc[order]
        score = chunk.scores(self.queries, query, doc)
        rounded = np.round(score, 9)
        keep = (score > 0) & (rounded >= self.queries.floor[query])
        now = (query[keep], chunk.pos[doc[keep]], score[keep], rounded[keep])
        self.rows = best_rows(self.k, *(np.concatenate(x) for x in zip(self.rows, now, strict=True)))

    def _thinned(self, found: list[tuple[np.ndarray, ...]]) -> tuple[np.ndarray, ...]:
        query, doc, score = (np.concatenate(x) for x in zip(*found, strict=True))
        keep = score + self.queries.slack[query] >= self.least[query]
        return query[keep], doc[keep], score[keep]

    def _raise(self, query: np.ndarray, low: np.ndarray) -> None:
        """These documents, not seen before, reach `low`."""
        some, row = np.unique(query, return_inverse=True)
        row = np.concatenate([row, np.repeat(np.arange(len(some)), self.k)])
        low = np.concatenate([low, self.low[some].ravel()])
        order = np.lexsort((-low, row))
        row = row[order]
        rank = np.arange(len(row)) - np.searchsorted(row, row)
        order, row, rank = order[rank < self.k], row[rank < self.k], rank[rank < self.k]
        self.low[some[row], rank] = low[order]
        self.least[some] = np.maximum(self.least[some], self.low[some, -1])

    def _candidates(self, block: Block, first: int, last: int) -> tuple[np.ndarray, ...]:
        """(query, document of the block, score in single precision) of what may be among the best, for queries first..last."""
        qs, n = self.queries, block.n
        low, high = qs.start[first], qs.start[last]
        term, weight, query = qs.term[low:high], self.weight[low:high], self.query[low:high] - first
        most = weight * block.most[term]
        total = np.bincount(query, weights=most, minlength=last - first)
        alive = (total > 0) & (total + qs.slack[first:last] >= self.least[first:last])
        rows = np.flatnonzero(alive)
        if not len(rows):
            return rows, rows, np.zeros(0)
        keep = alive[query] & (most > 0)
        term, weight, most = term[keep], weight[keep], most[keep].astype(np.float64)
        query = (np.cumsum(alive) - 1)[query[keep]]
        least = (self.least - qs.slack)[first:last][rows]
        # Frequent terms as a matrix product.
        column = block.column[term]
        fill = np.bincount(column[column >= 0], minlength=len(block.frequent)) * block.size[block.frequent]
        dense = np.flatnonzero(fill >= FILLED * len(rows) * n)
        narrow = np.full(len(block.frequent) + 1, -1)
        narrow[dense] = np.arange(len(dense))
        column = narrow[column]
        known = column >= 0
        matrix = np.zeros((len(rows), len(dense)), np.float32)
        matrix[query[known], column[known]] = weight[known]
        sums = matrix @ block.gains[dense]
        top = sums.max(axis=1).astype(np.float64)
        # The others as far as a document can still reach `least`.
        term, weight, most, query = term[~known], weight[~known], most[~known], query[~known]
        before = np.concatenate([[0.0], np.cumsum(most)])
        ends = np.searchsorted(query, np.arange(len(rows) + 1))
        needed = before[ends[1:]][query] - before[:-1] + top[query] >= least[query]
        rest = np.bincount(query[~needed], weights=most[~needed], minlength=len(rows))
        wide = top + rest >= least
        times = block.size[term[needed]]
        at = ranges(block.start[term[needed]], times)
        cell = np.repeat(query[needed] * n, times) + block.doc[at]
        part = np.repeat(weight[needed], times) * block.gain[at]
        flat = sums.reshape(-1)
        if len(cell) > CROWDED * len(flat):
            flat += np.bincount(cell, weights=part, minlength=len(flat)).astype(np.float32)
        else:
            np.add.at(flat, cell, part)
        bar = least - rest
        cells = np.unique(cell[flat[cell] >= np.repeat(np.where(wide, np.inf, bar)[query[needed]], times)])
        # Of queries whose frequent terms alone may do, every document is looked at.
        wide = np.flatnonzero(wide)
        if len(wide):
            own, lowest = sums[wide], np.maximum(bar[wide], 1e-30)
            if n > self.k:
                # Sums grow from here on, so the k-th of them is reached for certain.
                kth = np.partition(own, n - self.k, axis=1)[:, n - self.k].astype(np.float64)
                lowest = np.maximum(lowest, kth - 2 * qs.slack[first + rows[wide]] - rest[wide])
            row, doc = np.nonzero(own >= lowest[:, None])
            cells = np.concatenate([cells, wide[row] * n + doc])
        row, doc = cells // n, cells % n
        score = flat[cells].astype(np.float64)
        # Candidates get the terms left out.
        term, weight = term[~needed], weight[~needed]
        ends = np.searchsorted(query[~needed], np.arange(len(rows) + 1))
        times = np.diff(ends)[row]
        at = ranges(ends[row], times)
        part = weight[at] * block.found(term[at], np.repeat(doc, times))
        score += np.bincount(np.repeat(np.arange(len(cells)), times), weights=part, minlength=len(cells))
        keep = score >= least[row]
        return first + rows[row[keep]], doc[keep], score[keep]


def best_documents(batches: Iterator[pa.RecordBatch], queries: QueryTerms, k: int, mean_length: float) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """(query_id, pos, score) of the best k of these packed documents (pos, length, terms) for every query that reach its floor."""
    search = Search(queries, k)
    held: list[tuple[np.ndarray, ...]] = []
    for batch in batches if k and len(queries.ids) else ():
        held.append(_known(batch, queries.vocabulary, mean_length))
        if sum(len(x[3]) for x in held) >= CHUNK_POSTINGS:
            search.add(Chunk.of(held, queries))
            held = []
    if held:
        search.add(Chunk.of(held, queries))
    query, pos, score, _ = search.rows
    return queries.ids.take(pa.array(query)), pos, score


def _known(batch: pa.RecordBatch, vocabulary: pa.Array, mean_length: float) -> tuple[np.ndarray, ...]:
    """(pos, length, postings) by document and (term, gain) by posting, of query terms."""
    pos, length = batch.column("pos").to_numpy(), batch.column("length").to_numpy()
    lists = batch.column("terms")
    entries = lists.flatten()
    doc = np.repeat(np.arange(len(pos)), pc.list_value_length(lists).to_numpy(zero_copy_only=False))
    term = pc.fill_null(pc.index_in(entries.field("term"), value_set=vocabulary), -1).to_numpy()
    known = term >= 0
    doc, term, tf = doc[known], term[known], entries.field("tf").to_numpy()[known]
    k1, b = fv.BM25_K1, fv.BM25_B
    gain = tf * (k1 + 1) / (tf + (k1 * (1 - b + b * length / (mean_length or 1.0)))[doc])
    return pos, length, np.bincount(doc, minlength=len(pos)), term, gain
