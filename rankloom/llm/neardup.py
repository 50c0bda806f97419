"""Near-duplicate vectors by an inverted multi-index.

Each half of the unit vectors has a codebook of its own; the cells of the index
are the pairs of centroids. A vector visits cells in the order of a lower bound
on its distance to them, two sorted lists being walked by the multi-sequence
algorithm, until the cells seen hold its neighbours with the target recall. All
vectors of visited cells are compared in double precision.

The bound of a half is the distance to the plane between the nearest centroid
and the other one. A neighbour at the largest distance that links, r, lies
beyond such a plane by a part of r that is about normal, of deviation
r / sqrt(dim), for directions that are no special ones; so cells whose bounds
of both halves go beyond z deviations hold it with probability exp(-z^2 / 2).
Neighbours do differ in special directions where the data has some. So vectors
drawn by hash are compared with all, the bound at which the index meets each
pair that links is counted, and the limit is widened until it holds as many of
them as are asked for. Too few such pairs, or a target recall of 1, take r
itself for the bound, which misses nothing.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import settle_table
from .graph import components


def matrix(column: pa.Array, dim: int) -> np.ndarray:
    """Unit vectors in double precision, a row each; not-a-number for those that link with nothing."""
    out = np.full((len(column), dim), np.nan)
    sizes = np.array([-1 if n is None else n for n in pa.compute.list_value_length(column).to_pylist()], dtype=int)
    fit = np.nonzero(sizes == dim)[0]
    if len(fit) and dim:
        whole = column.take(pa.array(fit)).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)
        with np.errstate(all="ignore"):
            whole = whole / np.abs(whole).max(axis=1, keepdims=True)
            out[fit] = whole / np.sqrt((whole * whole).sum(axis=1, keepdims=True))
    out[~np.isfinite(out).all(axis=1)] = np.nan
    return out


def units_of(raw: list[bytes], dtype: str, dim: int = -1) -> np.ndarray:
    """Unit vectors in double precision from their numbers as bytes."""
    x = np.frombuffer(b"".join(raw), dtype).astype(np.float64).reshape(len(raw), dim if not raw else -1)
    if len(x):
        x = x / np.abs(x).max(axis=1, keepdims=True)
        x = x / np.sqrt((x * x).sum(axis=1, keepdims=True))
    return x


def codebook(points: np.ndarray, k: int, rounds: int = 10) -> np.ndarray:
    """Lloyd's centroids, started from evenly spaced points of the sample."""
    centres = points[np.linspace(0, len(points) - 1, k).astype(int)].copy()
    for _ in range(rounds):
        near = distances(points, centres).argmin(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, near, points)
        held = np.bincount(near, minlength=k)
        centres[held > 0] = sums[held > 0] / held[held > 0, None]
    return centres


def distances(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared."""
    return (points**2).sum(axis=1)[:, None] - 2 * points @ centres.T + (centres**2).sum(axis=1)


def bounds(points: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest centroid, and squared lower bounds of the distance to all cells of the codebook."""
    d = distances(points, centres)
    near = d.argmin(axis=1)
    apart = np.sqrt(np.maximum(distances(centres, centres), 0))[near]
    away = np.maximum(d - d[np.arange(len(d)), near][:, None], 0)
    out = np.divide(away, 2 * apart, out=np.zeros_like(away), where=apart > 0) ** 2
    return near, out


def visited(first: np.ndarray, second: np.ndarray, within: float) -> list[tuple[int, int]]:
    """Cells by increasing sum of both halves' bounds, while it is at most `within`."""
    a, b = np.argsort(first, kind="stable"), np.argsort(second, kind="stable")
    a, b = a[first[a] <= within], b[second[b] <= within]
    if not len(a) or not len(b):
        return []
    out, heap, seen = [], [(float(first[a[0]] + second[b[0]]), 0, 0)], {(0, 0)}
    while heap:
        total, i, j = heapq.heappop(heap)
        if total > within:
            break
        out.append((int(a[i]), int(b[j])))
        for x, y in ((i + 1, j), (i, j + 1)):
            if x < len(a) and y < len(b) and (x, y) not in seen:
                seen.add((x, y))
                heapq.heappush(heap, (float(first[a[x]] + second[b[y]]), x, y))
    return out


def needed(x: np.ndarray, y: np.ndarray, books: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """The limit from which on the index meets each pair of a row of x and one of y: the vector of the smaller cell visits the other's."""
    k, half = len(books[0]), books[0].shape[1]
    (x1, one), (x2, two) = bounds(x[:, :half], books[0]), bounds(x[:, half:], books[1])
    (y1, three), (y2, four) = bounds(y[:, :half], books[0]), bounds(y[:, half:], books[1])
    home, other = x1 * k + x2, y1 * k + y2
    at = np.arange(len(x))
    out = np.where(home < other, one[at, y1] + two[at, y2], three[at, x1] + four[at, x2])
    return np.where(home == other, 0.0, out)


def _measure(asked: list[tuple[int, bytes]], books: tuple[np.ndarray, np.ndarray], threshold: float, dtype: str, dim: int):
    """Of each vector asked for, its links by the limit that they need, in STEPS of the largest."""

    def work(batches):
        ids, q = np.array([c for c, _ in asked]), units_of([raw for _, raw in asked], dtype, dim)
        for batch in batches:
            own, x = batch.column(0).to_numpy(), units_of(batch.column(1).to_pylist(), dtype, dim)
            for a in range(0, len(x), 1024):
                linked = (x[a : a + 1024] @ q.T >= threshold) & (own[a : a + 1024, None] != ids[None, :])
                row, col = np.nonzero(linked)
                found = np.zeros(len(row), dtype=np.int64)
                for b in range(0, len(row), 1024):
                    limit = needed(x[a + row[b : b + 1024]], q[col[b : b + 1024]], books)
                    found[b : b + 1024] = np.ceil(np.minimum(limit / (2 - 2 * threshold), 1) * STEPS)
                keys, times = np.unique(col * (STEPS + 1) + found, return_counts=True)
                arrays = [pa.array(v, pa.int64()) for v in (keys // (STEPS + 1), keys % (STEPS + 1), times)]
                yield pa.RecordBatch.from_arrays(arrays, ["asked", "step", "links"])

    return work


def step_for(counts: list[tuple[int, int, int]], goal: float) -> int:
    """The least step with `goal` of all links and, each vector counting the same, of the mean vector's links."""
    links, means, per = np.zeros(STEPS + 1), np.zeros(STEPS + 1), {}
    for who, _, n in counts:
        per[who] = per.get(who, 0) + n
    for who, step, n in counts:
        links[step] += n
        means[step] += n / per[who]
    # Sums of parts may be a little less than the whole.
    reached = [np.cumsum(w) >= goal * w.sum() - 1e-9 for w in (links, means)]
    return int(np.argmax(reached[0] & reached[1]))


def forest(linked: np.ndarray) -> list[tuple[int, int]]:
    """Edges of a spanning forest of the links between rows and columns, as (row, column)."""
    rows_left, cols_left, out = linked.any(axis=1), linked.any(axis=0), []
    for root in np.nonzero(rows_left)[0].tolist():
        if not rows_left[root]:
            continue
        rows_left[root] = False
        front = [(root, True)]
        while front:
            at, is_row = front.pop()
            if is_row:
                new = np.nonzero(linked[at] & cols_left)[0].tolist()
                cols_left[new] = False
                out += [(at, c) for c in new]
                front += [(c, False) for c in new]
            else:
                new = np.nonzero(linked[:, at] & rows_left)[0].tolist()
                rows_left[new] = False
                out += [(r, at) for r in new]
                front += [(r, True) for r in new]
    return out


TARGET, OWN, GUEST = 0, 1, 2
STEPS = 256


def _compare(threshold: float, dtype: str):
    """Links of one block of a cell's vectors (targets) with one block of its visitors (probes).

    The cell's own vectors visit it as well; such pairs are met from both sides.
    """

    def work(table: pa.Table) -> pa.Table:
        ids, times = table.column("class").to_numpy(), table.column("times").to_numpy()
        role = table.column("role").to_numpy()
        x = units_of(table.column("raw").to_pylist(), dtype)
        target, probe = np.nonzero(role == TARGET)[0], np.nonzero(role != TARGET)[0]
        linked = x[probe] @ x[target].T >= threshold
        linked &= ids[probe][:, None] != ids[target][None, :]
        links = np.zeros(len(ids), np.int64)
        links[probe] = linked @ times[target]
        guests = role[probe] == GUEST
        links[target] = times[probe][guests] @ linked[guests]
        some = np.nonzero(links)[0]
        edges = forest(linked)
        a = np.concatenate([ids[some], ids[probe[[e[0] for e in edges]]]]) if edges else ids[some]
        other = pa.array([None] * len(some) + [int(ids[target[e[1]]]) for e in edges], pa.int64())
        counts = pa.array(links[some].tolist() + [0] * len(edges), pa.int64())
        return pa.table({"class": pa.array(a, pa.int64()), "links": counts, "other": other})

    return work


def link(
    vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", threshold: float = 0.95, target_recall: float = 0.99,
    sample_rows: int = 20_000, cell_rows: int = 512, target_rows: int = 512, probe_rows: int = 2048,
    asked_rows: int = 1024,
) -> DataFrame:
    """One row per vector: key, n_links, component_id, kept.

    Links are pairs of cosine >= threshold. Null and zero vectors, those with
    null or non-finite components, and those that aren't of the commonest
    length link with nothing; each is its own component. Equal vectors are one class
    and are linked. Codebooks are fitted on sample_rows classes at most, by hash; every
    vector is in the index. The recall is measured in the job, with asked_rows classes by hash against all;
    the limit is set halfway between the target and 1, for chance. A cell of many vectors is compared in blocks of target_rows vectors and
    probe_rows visitors, each a group of its own. A null key takes part, but names a component only
    if all are null. Rows sharing a key are vectors of their own; kept is true for all rows whose key names their component.
    """
    rows = vectors.select(F.col(key), F.col(vector))
    lengths = rows.where(F.size(vector) > 0).groupBy(F.size(vector).alias("n")).count().orderBy(F.desc("count"), "n").first()
    dim = int(lengths["n"]) if lengths else 0

    def prepare(batches):
        for batch in batches:
            fit = np.isfinite(matrix(batch.column(1), dim)).all(axis=1) if dim else np.zeros(batch.num_rows, bool)
            some = batch.column(1).take(pa.array(np.nonzero(fit)[0]))
            raw = some.flatten().to_numpy(zero_copy_only=False).astype(dtype).reshape(len(some), dim)
            raw = iter(raw + np.zeros(1, dtype))  # no -0
            data = [next(raw).tobytes() if f else None for f in fit]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(data, pa.binary())], [key, "raw"])

    key_type = rows.schema[0].dataType.simpleString()
    dtype = "f4" if rows.schema[1].dataType.elementType.simpleString() == "float" else "f8"
    units = rows.mapInArrow(prepare, f"`{key}` {key_type}, raw binary")
    units = settle_table(units.withColumn("class", F.when(F.col("raw").isNotNull(), F.xxhash64("raw"))))
    classes = units.where("class is not null").groupBy("class").agg(F.count("*").alias("times"), F.first("raw").alias("raw"))
    n = units.agg(F.count_distinct("class")).first()[0]
    sample = units.where("class is not null").select("class", "raw").distinct().orderBy(F.xxhash64("class"), "class").limit(sample_rows)
    seen = units_of([r["raw"] for r in sample.collect()], dtype, dim)
    half = dim // 2
    k = max(1, min(math.ceil(math.sqrt(n / cell_rows)), len(seen) // 8, 1024))
    points = seen if len(seen) else np.zeros((1, max(dim, 2)))
    books = codebook(points[:, :half], k), codebook(points[:, half:], k)
    reach = 2 - 2 * threshold
    within = reach
    if target_recall < 1 and k > 1:
        asked = units.where("class is not null").select("class", "raw").distinct()
        asked = asked.orderBy(F.xxhash64("class", F.lit(3)), "class").limit(asked_rows).collect()
        told = classes.select("class", "raw").mapInArrow(
            _measure([(r["class"], bytes(r["raw"])) for r in asked], books, threshold, dtype, dim), "asked long, step long, links long"
        )
        told = [tuple(r) for r in told.groupBy("asked", "step").agg(F.sum("links")).collect()]
        if len({r[0] for r in told}) * (1 - target_recall) >= 1:
            even = -2 * math.log(1 - target_recall) * reach / max(1, dim)
            within = min(reach, max(even, step_for(told, (1 + target_recall) / 2) * reach / STEPS))

    def place(batches):
        for batch in batches:
            x = units_of(batch.column(2).to_pylist(), dtype, dim)
            homes, others = [], []
            for at in range(0, len(x), 1024):
                (near1, one), (near2, two) = bounds(x[at : at + 1024, :half], books[0]), bounds(x[at : at + 1024, half:], books[1])
                for r in range(len(one)):
                    home = int(near1[r]) * k + int(near2[r])
                    cells = {i * k + j for i, j in visited(one[r], two[r], within)}
                    homes.append(home)
                    # A pair is met once: in the cell of the larger number.
                    others.append(sorted(c for c in cells if c > home))
            arrays = [*batch.columns, pa.array(homes, pa.int64()), pa.array(others, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(arrays, ["class", "times", "raw", "cell", "visits"])

    placed = classes.select("class", "times", "raw").mapInArrow(
        place, "class long, times long, raw binary, cell long, visits array<long>"
    )
    placed = settle_table(placed)
    own = placed.select("class", "times", "raw", "cell", F.lit(OWN).alias("role"))
    guests = placed.select("class", "times", "raw", F.explode("visits").alias("cell"), F.lit(GUEST).alias("role"))
    probes = own.unionByName(guests)
    blocks = probes.groupBy("cell").agg(F.count("*").alias("m"), F.count_if(F.col("role") == OWN).alias("h"))
    blocks = blocks.where("h > 0 and m > 1").select(
        "cell",
        F.ceil(F.col("h") / target_rows).cast("int").alias("t_blocks"),
        F.ceil(F.col("m") / probe_rows).cast("int").alias("p_blocks"),
    )
    # A probe goes to all blocks of targets, a target to all blocks of probes.
    split = "cast(pmod(xxhash64(class, {0}), {1}) as int)"
    probes = probes.join(blocks, "cell").select(
        "cell", F.expr(split.format(1, "p_blocks")).alias("p"), F.explode(F.expr("sequence(0, t_blocks - 1)")).alias("t"),
        "class", "times", "raw", "role",
    )
    targets = own.join(blocks, "cell").select(
        "cell", F.explode(F.expr("sequence(0, p_blocks - 1)")).alias("p"), F.expr(split.format(2, "t_blocks")).alias("t"),
        "class", "times", "raw", F.lit(TARGET).alias("role"),
    )
    found = probes.unionByName(targets).groupBy("cell", "p", "t").applyInArrow(
        _compare(threshold, dtype), "class long, links long, other long"
    )
    found = settle_table(found)
    links = found.groupBy("class").agg(F.sum("links").alias("links"))
    joined = components(found.where("other is not null").select(F.col("class").alias("a"), F.col("other").alias("b")))
    out = units.select(key, "class").join(classes.select("class", "times"), "class", "left").join(links, "class", "left")
    out = out.join(joined.withColumnRenamed("id", "class"), "class", "left")
    out = settle_table(out.withColumn("component", F.coalesce("component", "class")))
    names = out.where("component is not null").groupBy("component").agg(F.min(key).alias("name"))
    out = out.join(names, "component", "left")
    name = F.when(F.col("component").isNull(), F.col(key)).otherwise(F.col("name"))
    return out.select(
        key,
        (F.coalesce("links", F.lit(0)) + F.coalesce("times", F.lit(1)) - 1).cast("long").alias("n_links"),
        name.alias("component_id"),
        F.col(key).eqNullSafe(name).alias("kept"),
    )
