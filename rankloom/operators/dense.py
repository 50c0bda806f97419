"""Top-k by inner product or squared L2 over a table of vectors.

The query batch goes to the vectors, not the vectors to the queries: a task
multiplies its Arrow batches with the query matrix and keeps k rows per query.
Neither a pair of rows nor a vector is shuffled. A batch too large to broadcast
is searched on a grid of bounded blocks instead; both ways are exact.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import fixed_values as fv
from .ordering import QueryBatch, top_per_group

SCORE_DIGITS = 9
# float32 values that a broadcast query matrix may hold (32 MB).
BROADCAST_VALUES = 8_000_000
GRID_QUERIES, GRID_VECTORS = 2_048, 50_000
QUERY_CHUNK = 256
NOWHERE = np.iinfo(np.int64).max
# Parts that a query's rows are merged in before the last merge.
MERGE_PARTS = 64


def higher_is_better(metric: str) -> bool:
    if metric not in fv.METRICS:
        raise ValueError(f"unsupported metric {metric!r}; known: {fv.METRICS}")
    return metric == "inner_product"


def as_matrix(column: pa.Array, dim: int) -> np.ndarray:
    """Arrow list column as an n x dim matrix; other lengths are an error."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    lengths = column.value_lengths().to_numpy(zero_copy_only=False)
    if len(lengths) and not (lengths == dim).all():
        raise ValueError(f"every vector must have {dim} values and none may be null")
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim).astype(np.float64)


def block_scores(queries: np.ndarray, vectors: np.ndarray, metric: str) -> np.ndarray:
    """Scores of every query against every vector, larger is better."""
    products = queries @ vectors.T
    if metric == "inner_product":
        return np.round(products, SCORE_DIGITS)
    squares = (queries**2).sum(1)[:, None] + (vectors**2).sum(1)[None, :]
    return -np.round(np.maximum(squares - 2.0 * products, 0.0), SCORE_DIGITS)


class Best:
    """The k best (score, pos) of each query so far: two matrices of queries x k.

    Scores are compared as they come, rounded by the caller; ties go to the
    lower pos. The k-th score of a query is its threshold: a block is cut to
    what reaches it before anything is sorted. `least` are thresholds known
    beforehand; repeats says that the same pair may be offered more than once.
    """

    def __init__(self, queries: int, k: int, repeats: bool = False, least: np.ndarray | None = None):
        self.k, self.repeats = k, repeats
        self.score = np.full((queries, k), -np.inf)
        self.pos = np.full((queries, k), NOWHERE)
        self.exact = np.full((queries, k), -np.inf)
        self.least = np.full(queries, -np.inf) if least is None else least

    def add(self, query_rows: np.ndarray, pos: np.ndarray, scores: np.ndarray, exact: np.ndarray | None = None) -> None:
        """Offer a block of scores (queries x vectors), vectors in order of pos; `exact` are those to report, if they differ."""
        floor = np.maximum(self.score[query_rows, -1], self.least[query_rows])
        reached = scores >= floor[:, None]
        reached &= scores > -np.inf
        some = np.flatnonzero(reached.any(axis=1))
        if not len(some):
            return
        exact = scores if exact is None else exact
        if len(some) < len(query_rows):
            query_rows, scores, exact, reached = query_rows[some], scores[some], exact[some], reached[some]
        scores = np.where(reached, scores, -np.inf)
        if scores.shape[1] > self.k:
            # Exactly k of each row: all above its k-th score, and of its ties those of lowest pos.
            kth = np.partition(scores, -self.k, axis=1)[:, [-self.k]]
            above, ties = scores > kth, scores == kth
            ties &= ties.cumsum(axis=1) <= self.k - above.sum(axis=1, keepdims=True)
            columns = np.nonzero(above | ties)[1].reshape(len(some), self.k)
            scores, exact, found = (np.take_along_axis(x, columns, axis=1) for x in (scores, exact, np.broadcast_to(pos, reached.shape)))
        else:
            found = np.broadcast_to(pos, scores.shape)
        parts = [
            np.concatenate([before[query_rows], now], axis=1)
            for before, now in ((self.score, scores), (self.pos, np.where(scores > -np.inf, found, NOWHERE)), (self.exact, exact))
        ]
        parts = self._ordered(*parts)
        if self.repeats:
            score, place, _ = parts
            again = np.zeros(score.shape, bool)
            again[:, 1:] = (place[:, 1:] == place[:, :-1]) & (score[:, 1:] > -np.inf)
            parts = self._ordered(np.where(again, -np.inf, score), np.where(again, NOWHERE, place), parts[2])
        self.score[query_rows], self.pos[query_rows], self.exact[query_rows] = (x[:, : self.k] for x in parts)

    @staticmethod
    def _ordered(score: np.ndarray, pos: np.ndarray, exact: np.ndarray) -> list[np.ndarray]:
        order = np.lexsort((pos, -score), axis=1)
        return [np.take_along_axis(x, order, axis=1) for x in (score, pos, exact)]

    def rows(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row of the query, pos, exact score) of what was found."""
        query, column = np.nonzero(self.score > -np.inf)
        return query, self.pos[query, column], self.exact[query, column]


@dataclass(frozen=True)
class Routing:
    """Which vectors a query may meet.

    Vectors carry `lists`, one list number per table. probes[t] maps a list
    number of table t to the rows of the query matrix that look into it.
    """

    probes: list[dict[int, np.ndarray]]


Decoder = Callable[[np.ndarray, np.ndarray], np.ndarray]
#: From a query matrix and the queries' least scores (None if not known) to the lists they look into.
Router = Callable[[np.ndarray, np.ndarray | None], Routing]


def _search_blocks(
    batches: Iterator[pa.RecordBatch],
    queries: np.ndarray,
    k: int,
    metric: str,
    routing: Routing | None,
    decode: Decoder | None,
    least: np.ndarray | None = None,
) -> Best:
    best = Best(len(queries), k, repeats=routing is not None and len(routing.probes) > 1, least=least)
    dim = queries.shape[1]
    everyone = np.arange(len(queries))
    for batch in batches:
        if batch.num_rows == 0:
            continue
        batch = batch.sort_by("pos")
        pos = batch.column("pos").to_numpy(zero_copy_only=False)
        lists = None
        if routing is not None:
            lists = as_matrix(batch.column("lists"), len(routing.probes)).astype(np.int64)
        if decode is None:
            vectors = as_matrix(batch.column("embedding"), dim)
        else:
            codes = batch.column("codes")
            width = len(codes[0]) if len(codes) else 0
            vectors = decode(lists[:, 0], as_matrix(codes, width).astype(np.int64))
        if routing is None:
            jobs = [(everyone, slice(None))]
        else:
            jobs = [
                (table[number], np.flatnonzero(lists[:, t] == number))
                for t, table in enumerate(routing.probes)
                for number in np.unique(lists[:, t]).tolist()
                if number in table
            ]
        for rows, members in jobs:
            for at in range(0, len(rows), QUERY_CHUNK):
                part = rows[at : at + QUERY_CHUNK]
                best.add(part, pos[members], block_scores(queries[part], vectors[members], metric))
    return best


def _result(best: Best, ids: pa.Array, metric: str) -> list[pa.Array]:
    query, pos, score = best.rows()
    score = score if metric == "inner_product" else -score
    return [ids.take(pa.array(query)), pa.array(pos), pa.array(score + 0.0)]


def query_block(table: pa.Table, dim: int) -> tuple[pa.Array, np.ndarray, np.ndarray | None]:
    """Ids, matrix and, where the table has them, least scores of queries."""
    least = None
    if "least" in table.column_names:
        least = table.column("least").to_numpy().astype(np.float64)
        least = np.where(np.isnan(least), -np.inf, least)
    return table.column("query_id").combine_chunks(), as_matrix(table.column("embedding"), dim), least


def _schema(queries: DataFrame) -> str:
    kind = queries.schema["query_id"].dataType.simpleString()
    return f"query_id {kind}, pos bigint, score double"


def _ranked(found: DataFrame, batch: QueryBatch, metric: str) -> DataFrame:
    """Merged in two stages, so that no task meets the rows of one query from all tasks of the scan."""
    score = F.col("score").desc() if higher_is_better(metric) else F.col("score").asc()
    order = [score, F.col("pos").asc()]
    part = found.withColumn("_part", F.pmod(F.spark_partition_id(), F.lit(MERGE_PARTS)))
    merged = top_per_group(part, ["query_id", "_part"], order, batch.top_k).drop("_part", "rank")
    return batch.cut(top_per_group(merged, ["query_id"], order, batch.top_k))


def search(
    vectors: DataFrame,
    queries: DataFrame | QueryBatch,
    *,
    dim: int,
    metric: str = "inner_product",
    routing: Router | None = None,
    decode: Decoder | None = None,
    broadcast_values: int = BROADCAST_VALUES,
) -> DataFrame:
    """(query_id, pos, score, rank) for a batch of query vectors.

    vectors: pos BIGINT, embedding (or lists and codes for a compressed table).
    queries: query_id, embedding, optional top_k and least, a score (for l2 a
    negative squared distance) below which no vector can be a result. Scores
    are inner products (higher first) or squared distances (lower first).
    """
    higher_is_better(metric)
    batch = queries if isinstance(queries, QueryBatch) else QueryBatch.of(queries)
    wanted = ["pos"]
    wanted += ["lists"] if routing is not None else []
    wanted += ["codes"] if decode is not None else ["embedding"]
    vectors = vectors.select(*wanted)
    # A task holds the query matrix and two matrices of queries x k.
    if batch.rows is None or batch.rows * max(dim, 2 * batch.top_k) > broadcast_values:
        found = _grid_search(vectors, batch, dim, metric, routing, decode)
        return _ranked(found, batch, metric)

    ids, matrix, least = query_block(_asked(batch).orderBy("query_id").toArrow(), dim)
    k = batch.top_k
    routes = routing(matrix, least) if routing is not None else None
    shared = vectors.sparkSession.sparkContext.broadcast((ids, matrix, least))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, matrix, least = shared.value
        if k > 0 and len(matrix):
            best = _search_blocks(batches, matrix, k, metric, routes, decode, least)
            yield pa.RecordBatch.from_arrays(_result(best, ids, metric), ["query_id", "pos", "score"])

    found = vectors.mapInArrow(scan, _schema(batch.df))
    return _ranked(found, batch, metric)


def _asked(batch: QueryBatch) -> DataFrame:
    return batch.df.select("query_id", "embedding", *[c for c in batch.df.columns if c == "least"])


def _grid_search(vectors, batch, dim, metric, routing, decode) -> DataFrame:
    """Every (vector block, query block) cell is one bounded group.

    Blocks are cut by hash, so no list or label can make one large. Each cell
    returns k rows per query.
    """
    queries = _asked(batch)
    n_vectors, n_queries = vectors.count(), queries.count()
    rows = max(1, -(-n_vectors // GRID_VECTORS))
    cols = max(1, -(-n_queries // GRID_QUERIES))
    left = vectors.withColumn("_row", F.pmod(F.xxhash64("pos"), F.lit(rows))).withColumn(
        "_col", F.explode(F.sequence(F.lit(0), F.lit(cols - 1)).cast("array<bigint>"))
    )
    right = queries.withColumn("_col", F.pmod(F.xxhash64("query_id"), F.lit(cols))).withColumn(
        "_row", F.explode(F.sequence(F.lit(0), F.lit(rows - 1)).cast("array<bigint>"))
    )
    k = batch.top_k
    names = ["query_id", "pos", "score"]

    def cell(left_rows: pa.Table, right_rows: pa.Table) -> pa.Table:
        ids, matrix, least = query_block(right_rows, dim)
        routes = routing(matrix, least) if routing is not None else None
        blocks = left_rows.to_batches() if k > 0 and len(matrix) else []
        best = _search_blocks(blocks, matrix, max(k, 1), metric, routes, decode, least)
        return pa.Table.from_arrays(_result(best, ids, metric), names)

    return (
        left.groupBy("_row", "_col")
        .cogroup(right.groupBy("_row", "_col"))
        .applyInArrow(cell, _schema(batch.df))
    )


def vector_problems(vectors: DataFrame, dim: int | None = None) -> DataFrame:
    """One row of counts that must hold before vectors are searched."""
    wanted = F.lit(dim) if dim is not None else F.max(F.size("embedding"))
    return vectors.agg(
        F.count("*").alias("vectors"),
        F.countDistinct("pos").alias("distinct_ids"),
        F.min(F.size("embedding")).alias("min_dim"),
        F.max(F.size("embedding")).alias("max_dim"),
        F.count_if(F.col("embedding").isNull()).alias("null_vectors"),
        F.coalesce(
            F.sum(F.size(F.filter("embedding", lambda x: x.isNull() | F.isnan(x)))), F.lit(0)
        ).cast("long").alias("bad_values"),
        wanted.cast("int").alias("expected_dim"),
    )


def check_vectors(vectors: DataFrame, dim: int | None = None) -> int:
    """Dimension of a valid vector table; ValueError otherwise."""
    kind = vectors.schema["embedding"].dataType.simpleString()
    if kind != "array<float>":
        raise TypeError(f"embedding must be array<float>, got {kind}")
    row = vector_problems(vectors, dim).first()
    sizes = {row.min_dim, row.max_dim, row.expected_dim}
    if row.vectors and (len(sizes) > 1 or row.null_vectors or row.bad_values):
        raise ValueError(f"vectors do not share one valid dimension: {row.asDict()}")
    if row.vectors != row.distinct_ids:
        raise ValueError(f"vector ids are not unique: {row.asDict()}")
    return int(row.max_dim or dim or 0)
