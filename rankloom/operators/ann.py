"""Top-k from inverted lists, product-quantised lists and random projections.

A list index either probes a number of lists per query, or stops exactly:
bounds on what a list's members can score tell which lists to read.

Training sees a bounded sample; assigning, coding and searching are map-only
over the whole table. Members of a list are never gathered: a task scores the
rows it reads against the queries that probe their list.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import fixed_values as fv
from ..session import settle_table
from .dense import SCORE_DIGITS, Routing, as_matrix, block_scores, higher_is_better, query_block, search
from .ordering import QueryBatch, random_rows, top_per_group


def train_centroids(sample: DataFrame, k: int, seed: int = fv.SEED, steps: int = 10) -> np.ndarray:
    """k-means centres of array column `embedding`; at most k rows come back."""
    points = sample.select(array_to_vector(F.col("embedding").cast("array<double>")).alias("features"))
    model = KMeans(k=k, seed=seed, maxIter=steps).fit(points)
    return np.array(model.clusterCenters())


def nearest(vectors: np.ndarray, centroids: np.ndarray, metric: str, n: int = 1) -> np.ndarray:
    """Numbers of the n best centroids per vector, best first, ties to the lower."""
    scores = block_scores(vectors, centroids, metric)
    return np.argsort(-scores, axis=1, kind="stable")[:, :n]


def probe_routing(centroids: np.ndarray, metric: str, nprobe: int):
    def route(queries: np.ndarray, least: np.ndarray | None = None) -> Routing:
        near = nearest(queries, centroids, metric, nprobe)
        lists = np.unique(near).tolist()
        return Routing([{n: np.flatnonzero((near == n).any(1)) for n in lists}])

    return route


@dataclass(frozen=True)
class ListBounds:
    """What the members of each list can score at most.

    A member is its centroid and a rest no longer than the list's radius, and
    no longer itself than the list's reach. By the triangle inequality its
    distance from a query is at least that of the centroid less the radius,
    and its inner product at most the centroid's and radius times the query's
    length; with the lengths known, the distance bounds the product as well.
    """

    centroids: np.ndarray
    radius: np.ndarray
    reach: np.ndarray
    members: np.ndarray
    metric: str

    def best(self, queries: np.ndarray) -> np.ndarray:
        """Queries x lists: no member scores higher; -inf for empty lists."""
        lengths = np.sqrt((queries**2).sum(1))[:, None]
        squares = lengths**2 + (self.centroids**2).sum(1)[None, :] - 2.0 * queries @ self.centroids.T
        away = np.maximum(np.sqrt(np.maximum(squares, 0.0)) - self.radius, 0.0)
        if self.metric == "l2":
            bound = -(away**2)
        else:
            linear = queries @ self.centroids.T + lengths * self.radius
            bound = np.minimum(linear, (lengths**2 + self.reach**2 - away**2) / 2.0)
        slack = 10.0**-SCORE_DIGITS + 1e-9 * (lengths + self.reach) ** 2
        return np.where(self.members > 0, bound + slack, -np.inf)

    def open_lists(self, queries: np.ndarray, least: np.ndarray | None, nprobe: int) -> np.ndarray:
        """Queries x lists: which lists, beyond the nprobe nearest, may hold a better vector than `least`."""
        floor = np.full(len(queries), -np.inf) if least is None else least
        wanted = (self.best(queries) >= floor[:, None]) & (self.members > 0)
        np.put_along_axis(wanted, nearest(queries, self.centroids, self.metric, nprobe), False, axis=1)
        return wanted

    def routing(self, nprobe: int):
        def route(queries: np.ndarray, least: np.ndarray | None = None) -> Routing:
            wanted = self.open_lists(queries, least, nprobe)
            return Routing([{int(n): np.flatnonzero(wanted[:, n]) for n in np.flatnonzero(wanted.any(0))}])

        return route


def list_bounds(listed: DataFrame, centroids: np.ndarray, metric: str) -> ListBounds:
    """Radius, reach and size of each list, from all its members in one scan.

    A task returns a row per list that it met, so what reaches the driver is
    bounded by the number of lists.
    """
    shared = listed.sparkSession.sparkContext.broadcast(centroids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centres = shared.value
        radius, reach, members = np.zeros(len(centres)), np.zeros(len(centres)), np.zeros(len(centres), np.int64)
        for batch in batches:
            if batch.num_rows:
                numbers = as_matrix(batch.column("lists"), 1).astype(np.int64)[:, 0]
                rows = as_matrix(batch.column("embedding"), centres.shape[1])
                np.maximum.at(radius, numbers, np.sqrt(((rows - centres[numbers]) ** 2).sum(1)))
                np.maximum.at(reach, numbers, np.sqrt((rows**2).sum(1)))
                np.add.at(members, numbers, 1)
        met = np.flatnonzero(members)
        arrays = [pa.array(x) for x in (met, radius[met], reach[met], members[met])]
        yield pa.RecordBatch.from_arrays(arrays, ["list_no", "radius", "reach", "members"])

    met = listed.select("lists", "embedding").mapInArrow(run, "list_no bigint, radius double, reach double, members bigint")
    rows = met.groupBy("list_no").agg(F.max("radius"), F.max("reach"), F.sum("members")).collect()
    radius, reach, members = np.zeros(len(centroids)), np.zeros(len(centroids)), np.zeros(len(centroids), np.int64)
    for number, a, b, n in rows:
        radius[number], reach[number], members[number] = a, b, n
    return ListBounds(centroids, radius, reach, members, metric)


def assign_lists(vectors: DataFrame, centroids: np.ndarray, metric: str, keep: tuple[str, ...] = ()):
    """Add `lists`, the nearest centroid of every vector, as a one-item array."""
    shared = vectors.sparkSession.sparkContext.broadcast(centroids)
    kept = vectors.select("pos", "embedding", *keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            table = shared.value
            rows = as_matrix(batch.column("embedding"), table.shape[1])
            numbers = nearest(rows, table, metric)[:, 0].astype(np.int32) if len(rows) else []
            lists = pa.array([[n] for n in numbers], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays(
                batch.columns + [lists], batch.schema.names + ["lists"]
            )

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in kept.schema.fields)
    return kept.mapInArrow(run, f"{schema}, lists array<int>")


@dataclass(frozen=True)
class ListIndex:
    """Vectors by nearest centroid; with codebooks also product-quantised."""

    table: DataFrame
    centroids: np.ndarray
    metric: str
    codebooks: np.ndarray | None = None
    known_bounds: ListBounds | None = None

    @cached_property
    def bounds(self) -> ListBounds | None:
        """Counted in one scan when first asked for, and kept with a saved index; a quantised index has none."""
        if self.known_bounds is None and self.codebooks is None:
            return list_bounds(self.table, self.centroids, self.metric)
        return self.known_bounds

    @property
    def dim(self) -> int:
        return self.centroids.shape[1]

    @classmethod
    def build(
        cls,
        vectors: DataFrame,
        *,
        nlist: int = 100,
        metric: str = "inner_product",
        m: int | None = None,
        nbits: int = 8,
        centroids: np.ndarray | None = None,
        train_rows: int | None = None,
    ) -> "ListIndex":
        """Train on all rows, or train_rows of them (unless centroids are given), assign all rows.

        m > 0 also codes every residual with m sub-quantisers of 2**nbits values.
        """
        higher_is_better(metric)
        if nlist <= 0 or (m is not None and m <= 0) or nbits <= 0:
            raise ValueError("nlist, m and nbits must be positive")
        sample = (vectors if train_rows is None else random_rows(vectors, train_rows)).select("embedding").cache()
        first = sample.first()
        if first is None:
            raise ValueError("training needs at least one vector")
        dim = len(first.embedding)
        if m is not None and dim % m != 0:
            raise ValueError(f"dimension {dim} must be divisible by m={m}")
        if centroids is None:
            centroids = train_centroids(sample, nlist)
        listed = assign_lists(vectors, centroids, metric)
        if m is None:
            sample.unpersist()
            return cls(listed, centroids, metric)
        codebooks = _train_codebooks(sample, centroids, metric, m, 2**nbits)
        sample.unpersist()
        return cls(_coded(listed, centroids, codebooks), centroids, metric, codebooks)

    def search(self, queries: DataFrame | QueryBatch, nprobe: int = 10) -> DataFrame:
        if nprobe <= 0:
            raise ValueError("nprobe must be positive")
        decode = None
        if self.codebooks is not None:
            decode = ResidualDecoder(self.centroids, self.codebooks)
        batch = queries if isinstance(queries, QueryBatch) else QueryBatch.of(queries)
        return search(
            self.table,
            batch,
            dim=self.dim,
            metric=self.metric,
            routing=probe_routing(self.centroids, self.metric, nprobe),
            decode=decode,
        )

    def search_exact(self, queries: DataFrame | QueryBatch, nprobe: int = 10) -> DataFrame:
        """As an exact search, from the lists that may hold a result.

        The nprobe nearest lists of each query give its first k scores. The k-th
        is a floor: of the other lists only those are read whose bound reaches
        it, so no result can be missed. A saved index is read only in these
        lists' folders (dynamic partition pruning).
        """
        if self.bounds is None:
            raise ValueError("a list index without bounds (quantised, or of an older format) can't stop exactly")
        batch = queries if isinstance(queries, QueryBatch) else QueryBatch.of(queries)
        near = settle_table(self.pruned(batch.df, nprobe).search(batch, nprobe))
        # Ranks are cut to each query's own top_k; a query with fewer rows has no floor.
        sign = 1.0 if higher_is_better(self.metric) else -1.0
        floors = near.groupBy("query_id").agg(F.count("*").alias("_n"), F.min(F.col("score") * sign).alias("_floor"))
        asked = batch.df.join(floors, "query_id", "left").withColumn("least", F.when(F.col("_n") >= F.col("top_k"), F.col("_floor")))
        asked = settle_table(asked.drop("_n", "_floor"))
        bounds = self.bounds
        further = self._lists_of(asked, lambda matrix, least: np.flatnonzero(bounds.open_lists(matrix, least, nprobe).any(0)))
        rest = search(
            self._cut(further).table, QueryBatch(asked, batch.rows, batch.top_k, batch.words, batch.uniform),
            dim=self.dim, metric=self.metric, routing=bounds.routing(nprobe),
        )
        both = near.drop("rank").unionByName(rest.drop("rank"))
        score = F.col("score").desc() if higher_is_better(self.metric) else F.col("score").asc()
        return batch.cut(top_per_group(both, ["query_id"], [score, F.col("pos").asc()], batch.top_k))

    def probes(self, queries: DataFrame, nprobe: int) -> DataFrame:
        """(query_id, list_no, place): the nprobe nearest lists of each query, nearest first, in one pass over the queries."""
        centroids, metric, dim = self.centroids, self.metric, self.dim
        kind = queries.schema["query_id"].dataType.simpleString()

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                near = nearest(as_matrix(batch.column("embedding"), dim), centroids, metric, nprobe)
                rows, places = np.indices(near.shape)
                arrays = [batch.column("query_id").take(pa.array(rows.ravel())), pa.array(near.ravel().astype(np.int64)), pa.array(places.ravel())]
                yield pa.RecordBatch.from_arrays(arrays, ["query_id", "list_no", "place"])

        return queries.select("query_id", "embedding").mapInArrow(run, f"query_id {kind}, list_no bigint, place bigint")

    def _lists_of(self, queries: DataFrame, choose: Callable[[np.ndarray, np.ndarray | None], np.ndarray]) -> DataFrame:
        """list_no, queries: the lists that any query looks into; one row per list and task before the exchange."""
        dim = self.dim

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            found: set[int] = set()
            for batch in batches:
                _, matrix, least = query_block(pa.Table.from_batches([batch]), dim)
                found |= set(np.unique(choose(matrix, least)).tolist())
            numbers = pa.array(sorted(found), pa.int64())
            yield pa.RecordBatch.from_arrays([numbers, pa.array([1] * len(found), pa.int64())], ["list_no", "tasks"])

        columns = ["query_id", "embedding", *[c for c in queries.columns if c == "least"]]
        met = queries.select(*columns).mapInArrow(run, "list_no bigint, tasks bigint")
        return settle_table(met.groupBy("list_no").agg(F.sum("tasks").alias("tasks")))

    def _cut(self, lists: DataFrame) -> "ListIndex":
        """The members of these lists; there are no more rows than lists in the index, so they are sent to the tasks."""
        wanted = F.broadcast(lists.where("tasks > 0").select(F.col("list_no").alias("_wanted")))
        number = F.col("list_no") if "list_no" in self.table.columns else F.get("lists", F.lit(0))
        return replace(self, table=self.table.join(wanted, number == F.col("_wanted"), "left_semi"), known_bounds=None)

    def save(self, path: str, mode: str = "errorifexists") -> None:
        """Partition the table by list; a large list is split over many files."""
        spark = self.table.sparkSession
        parts = F.pmod(F.xxhash64("pos"), F.lit(16))
        (
            self.table.withColumn("list_no", F.get("lists", F.lit(0)))
            .repartition("list_no", parts)
            .write.partitionBy("list_no")
            .option("maxRecordsPerFile", 1_000_000)
            .mode(mode)
            .parquet(f"{path}/table")
        )
        books = None if self.codebooks is None else self.codebooks.tolist()
        manifest = {
            "format": 1,
            "dim": self.dim,
            "metric": self.metric,
            "nlist": len(self.centroids),
            "m": 0 if books is None else len(books),
            "count": None if self.bounds is None else int(self.bounds.members.sum()),
        }
        rows = [("manifest", json.dumps(manifest)), ("centroids", json.dumps(self.centroids.tolist()))]
        rows.append(("codebooks", json.dumps(books)))
        kept = self.bounds and {x: getattr(self.bounds, x).tolist() for x in ("radius", "reach", "members")}
        rows.append(("bounds", json.dumps(kept)))
        spark.createDataFrame(rows, "name string, value string").coalesce(1).write.mode(mode).parquet(
            f"{path}/meta"
        )

    @classmethod
    def load(cls, spark: SparkSession, path: str, dim: int, metric: str) -> "ListIndex":
        """Open a saved index; another dimension or metric raises ValueError."""
        meta = {r.name: json.loads(r.value) for r in spark.read.parquet(f"{path}/meta").collect()}
        found = meta["manifest"]
        if (found["dim"], found["metric"]) != (dim, metric):
            raise ValueError(f"saved index is {found['dim']}/{found['metric']}, not {dim}/{metric}")
        books, kept, centroids = meta["codebooks"], meta.get("bounds"), np.array(meta["centroids"])
        return cls(
            spark.read.parquet(f"{path}/table"),
            centroids,
            metric,
            None if books is None else np.array(books),
            kept and ListBounds(centroids, *(np.array(kept[x]) for x in ("radius", "reach", "members")), metric),
        )

    def pruned(self, queries: DataFrame, nprobe: int) -> "ListIndex":
        """The lists that this query batch probes; a saved table is read only in their folders."""
        centroids, metric = self.centroids, self.metric
        return self._cut(self._lists_of(queries, lambda matrix, _: nearest(matrix, centroids, metric, nprobe)))


def _train_codebooks(sample: DataFrame, centroids, metric: str, m: int, size: int) -> np.ndarray:
    """m codebooks of `size` sub-vectors, trained on the residuals of the sample."""
    spark, dim = sample.sparkSession, centroids.shape[1]
    shared = spark.sparkContext.broadcast(centroids)

    def residuals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = as_matrix(batch.column("embedding"), dim)
            if len(rows):
                rest = rows - shared.value[nearest(rows, shared.value, metric)[:, 0]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(rest), pa.list_(pa.float64()))], ["embedding"]
                )

    rest = sample.mapInArrow(residuals, "embedding array<double>").cache()
    width, books = dim // m, []
    for part in range(m):
        piece = rest.select(F.slice("embedding", part * width + 1, width).alias("embedding"))
        book = train_centroids(piece, size, steps=5)
        filled = np.full((size, width), np.inf)
        filled[: len(book)] = book
        books.append(filled)
    rest.unpersist()
    return np.array(books)


def _coded(listed: DataFrame, centroids: np.ndarray, codebooks: np.ndarray) -> DataFrame:
    """(pos, lists, codes): every residual as one code per sub-space."""
    shared = listed.sparkSession.sparkContext.broadcast((centroids, codebooks))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            centres, books = shared.value
            width = books.shape[2]
            numbers = as_matrix(batch.column("lists"), 1).astype(np.int64)[:, 0]
            rest = as_matrix(batch.column("embedding"), centres.shape[1]) - centres[numbers]
            codes = np.empty((len(rest), len(books)), np.int16)
            for part, book in enumerate(books):
                known = book[np.isfinite(book).all(1)]
                piece = rest[:, part * width : (part + 1) * width]
                codes[:, part] = nearest(piece, known, "l2")[:, 0] if len(piece) else 0
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("pos"),
                    batch.column("lists"),
                    pa.array(list(codes), pa.list_(pa.int16())),
                ],
                ["pos", "lists", "codes"],
            )

    return listed.mapInArrow(run, "pos bigint, lists array<int>, codes array<smallint>")


@dataclass(frozen=True)
class ResidualDecoder:
    """Approximate vectors from list numbers and codes."""

    centroids: np.ndarray
    codebooks: np.ndarray

    def __call__(self, lists: np.ndarray, codes: np.ndarray) -> np.ndarray:
        pieces = [book[codes[:, part]] for part, book in enumerate(self.codebooks)]
        return self.centroids[lists] + np.concatenate(pieces, axis=1)


@dataclass(frozen=True)
class ProjectionIndex:
    """Buckets of random projections; `tables` is the accuracy knob."""

    table: DataFrame
    axes: np.ndarray
    width: float
    metric: str

    @classmethod
    def build(
        cls, vectors: DataFrame, dim: int, *, tables: int = 32, width: float = 0.25,
        metric: str = "inner_product", seed: int = fv.SEED,
    ) -> "ProjectionIndex":
        higher_is_better(metric)
        if tables <= 0 or width <= 0:
            raise ValueError("tables and width must be positive")
        axes = np.random.default_rng(seed).normal(size=(tables, dim))
        axes /= np.linalg.norm(axes, axis=1, keepdims=True)
        shared = vectors.sparkSession.sparkContext.broadcast(axes)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                rows = as_matrix(batch.column("embedding"), dim)
                lists = buckets(rows, shared.value, width).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    batch.columns + [pa.array(list(lists), pa.list_(pa.int32()))],
                    ["pos", "embedding", "lists"],
                )

        rows = vectors.select("pos", "embedding")
        listed = rows.mapInArrow(run, "pos bigint, embedding array<float>, lists array<int>")
        return cls(listed, axes, width, metric)

    def search(self, queries: DataFrame | QueryBatch) -> DataFrame:
        axes, width = self.axes, self.width

        def route(matrix: np.ndarray, least: np.ndarray | None = None) -> Routing:
            found = buckets(matrix, axes, width)
            return Routing(
                [
                    {n: np.flatnonzero(found[:, t] == n) for n in np.unique(found[:, t]).tolist()}
                    for t in range(found.shape[1])
                ]
            )

        return search(self.table, queries, dim=axes.shape[1], metric=self.metric, routing=route)


def buckets(rows: np.ndarray, axes: np.ndarray, width: float) -> np.ndarray:
    return np.floor(rows @ axes.T / width).astype(np.int64)


def recall(found: DataFrame, truth: DataFrame) -> DataFrame:
    """(query_id, hits, wanted, recall) of a search against the exact result."""
    hits = found.select("query_id", "pos").join(truth.select("query_id", "pos"), ["query_id", "pos"])
    wanted = truth.groupBy("query_id").agg(F.count("*").alias("wanted"))
    got = hits.groupBy("query_id").agg(F.count("*").alias("hits"))
    return wanted.join(got, "query_id", "left").select(
        "query_id",
        F.coalesce("hits", F.lit(0)).alias("hits"),
        "wanted",
        (F.coalesce("hits", F.lit(0)) / F.col("wanted")).alias("recall"),
    )
