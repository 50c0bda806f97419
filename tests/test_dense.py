import dataclasses

import numpy as np
import pytest
from pyspark.sql import functions as F

from rankloom.operators import dense as dn
from rankloom.operators.ann import ListIndex, ProjectionIndex, recall
from rankloom.operators.encode import encode_to_table, encode_with_model
from rankloom.sources.datasets import check_artifacts


def vectors(spark, matrix):
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(matrix)]
    return spark.createDataFrame(rows, "pos bigint, embedding array<float>").repartition(3)


def queries(spark, matrix, k):
    rows = [(i, [float(x) for x in v], k) for i, v in enumerate(matrix)]
    return spark.createDataFrame(rows, "query_id bigint, embedding array<float>, top_k int")


def brute(matrix, asked, k, metric):
    out = []
    for q, v in enumerate(np.float32(asked).astype(float)):
        m = np.float32(matrix).astype(float)
        s = m @ v if metric == "inner_product" else ((m - v) ** 2).sum(1)
        key = -np.round(s, 9) if metric == "inner_product" else np.round(s, 9)
        order = np.lexsort((np.arange(len(m)), key))[:k]
        out += [(q, int(p), r) for r, p in enumerate(order, 1)]
    return out


def rows(found):
    return sorted((r.query_id, r.pos, r["rank"]) for r in found.collect())


@pytest.mark.parametrize("metric", ["inner_product", "l2"])
@pytest.mark.parametrize("limit", [dn.BROADCAST_VALUES, 0])
def test_search_equals_brute_force(spark, monkeypatch, metric, limit):
    monkeypatch.setattr(dn, "GRID_QUERIES", 3)
    monkeypatch.setattr(dn, "GRID_VECTORS", 40)
    rng = np.random.default_rng(0)
    matrix = rng.normal(size=(200, 8))
    matrix[:70] = matrix[0]  # a third of the vectors are one vector
    asked = rng.normal(size=(7, 8))
    found = dn.search(
        vectors(spark, matrix), queries(spark, asked, 9), dim=8, metric=metric, broadcast_values=limit
    )
    assert rows(found) == sorted(brute(matrix, asked, 9, metric))


def test_identity(spark):
    found = dn.search(vectors(spark, np.eye(2)), queries(spark, [[1, 0]], 2), dim=2).collect()
    assert sorted((r["rank"], r.pos, r.score) for r in found) == [(1, 0, 1.0), (2, 1, 0.0)]


def test_bad_vectors_are_rejected(spark):
    good = vectors(spark, np.eye(3))
    assert dn.check_vectors(good, 3) == 3
    with pytest.raises(ValueError):
        dn.check_vectors(good, 4)
    with pytest.raises(TypeError):
        dn.check_vectors(good.withColumn("embedding", F.col("embedding").cast("array<double>")))
    with pytest.raises(ValueError):
        dn.check_vectors(good.unionByName(good))
    ragged = spark.createDataFrame([(0, [1.0]), (1, [1.0, 2.0])], "pos bigint, embedding array<float>")
    with pytest.raises(ValueError):
        dn.check_vectors(ragged)
    with pytest.raises(ValueError):
        dn.search(good, queries(spark, np.eye(3), 1), dim=3, metric="cosine")


def test_top_k_zero(spark):
    assert dn.search(vectors(spark, np.eye(2)), queries(spark, [[1, 0]], 0), dim=2).count() == 0


def test_probing_all_lists_is_exact_and_more_probes_find_more(spark):
    rng = np.random.default_rng(1)
    matrix, asked = rng.normal(size=(300, 8)), rng.normal(size=(6, 8))
    vecs, qs = vectors(spark, matrix), queries(spark, asked, 10)
    exact = dn.search(vecs, qs, dim=8)
    index = ListIndex.build(vecs, nlist=10)
    assert rows(index.search(qs, 10)) == rows(exact)
    shares = [
        recall(index.search(qs, n), exact).agg(F.avg("recall")).first()[0] for n in (1, 4, 10)
    ]
    assert shares == sorted(shares) and shares[-1] == 1.0


def test_quantised_lists(spark, tmp_path):
    rng = np.random.default_rng(2)
    matrix = rng.normal(size=(300, 8))
    vecs, qs = vectors(spark, matrix), queries(spark, matrix[:5], 10)
    index = ListIndex.build(vecs, nlist=4, m=4, nbits=5, metric="l2")
    found = index.search(qs, 4)
    share = recall(found, dn.search(vecs, qs, dim=8, metric="l2")).agg(F.avg("recall")).first()[0]
    assert share > 0.5
    path = str(tmp_path / "lists")
    index.save(path)
    loaded = ListIndex.load(spark, path, 8, "l2")
    assert rows(loaded.search(qs, 4)) == rows(found)
    assert rows(loaded.pruned(qs, 2).search(qs, 2)) == rows(index.search(qs, 2))
    with pytest.raises(ValueError):
        ListIndex.load(spark, path, 9, "l2")
    with pytest.raises(ValueError):
        ListIndex.load(spark, path, 8, "inner_product")


def clustered(rng, n, dim, centres):
    spots = rng.normal(size=(centres, dim)) * 10
    return spots[rng.integers(0, centres, n)] + rng.normal(size=(n, dim)) * 0.1


@pytest.mark.parametrize("metric", ["inner_product", "l2"])
@pytest.mark.parametrize("kind", ["clustered", "even", "copies"])
def test_bounded_lists_are_exact(spark, tmp_path, metric, kind):
    """Whatever the data, the search that stops by bounds equals the exact one."""
    rng = np.random.default_rng(8)
    matrix = clustered(rng, 400, 8, 12) if kind == "clustered" else rng.normal(size=(400, 8))
    if kind == "copies":
        matrix[::3] = matrix[0]
    asked = np.concatenate([matrix[:6], rng.normal(size=(3, 8)) * 5, np.zeros((1, 8))])
    vecs, qs = vectors(spark, matrix), queries(spark, asked, 9)
    qs = qs.withColumn("top_k", F.when(F.col("query_id") == 2, 500).when(F.col("query_id") == 3, 0).otherwise(F.col("top_k")))
    exact = rows(dn.search(vecs, qs, dim=8, metric=metric))
    index = ListIndex.build(vecs, nlist=12, metric=metric)
    assert rows(index.search_exact(qs, 2)) == exact
    index.save(str(tmp_path / "lists"))
    assert rows(ListIndex.load(spark, str(tmp_path / "lists"), 8, metric).search_exact(qs, 1)) == exact
    with pytest.raises(ValueError):
        ListIndex.build(vecs, nlist=2, m=2).search_exact(qs)


def test_bounds_keep_lists_unread(spark, tmp_path):
    """Clustered vectors: a saved index opens a few folders, by dynamic partition pruning."""
    rng = np.random.default_rng(9)
    matrix = clustered(rng, 600, 8, 12)
    vecs, qs = vectors(spark, matrix), queries(spark, matrix[:2], 5)
    path = str(tmp_path / "lists")
    ListIndex.build(vecs, nlist=12, metric="l2").save(path)
    index = ListIndex.load(spark, path, 8, "l2")
    further = index.bounds.open_lists(matrix[:2], np.array([-0.5, -0.5]), 1)
    assert further.sum() < 12
    files = dataclasses.replace(index, table=index.table.select("*", F.col("_metadata.file_path").alias("file")))
    cut = files.pruned(qs, 1).table
    assert "dynamicpruning" in cut._jdf.queryExecution().toString()
    assert 0 < cut.select("file").distinct().count() < files.table.select("file").distinct().count() / 2
    assert rows(index.search_exact(qs, 1)) == rows(dn.search(vecs, qs, dim=8, metric="l2"))


@pytest.mark.parametrize("k", [1, 4, 40])
def test_thresholds_keep_the_best(k):
    """Blocks of any order and size, ties and repeats."""
    rng = np.random.default_rng(k)
    for repeats in (False, True):
        best, seen = dn.Best(5, k, repeats), [[] for _ in range(5)]
        for _ in range(30):
            n = int(rng.integers(1, 30))
            pos = np.sort(rng.choice(60 if repeats else 10_000, n, replace=False)).astype(np.int64)
            asked = np.sort(rng.choice(5, int(rng.integers(1, 6)), replace=False))
            scores = (pos % 7)[None, :] * 0.5 + asked[:, None] if repeats else rng.integers(0, 9, (len(asked), n)) / 2
            best.add(asked, pos, scores.astype(float))
            for row, query in enumerate(asked):
                seen[query] += [(-float(s), int(p)) for s, p in zip(scores[row], pos, strict=True)]
        query, pos, score = best.rows()
        for q in range(5):
            found = [(-float(s), int(p)) for a, p, s in zip(query, pos, score, strict=True) if a == q]
            assert found == sorted(set(seen[q]) if repeats else seen[q])[:k]


def test_four_thousand_queries_cost_as_their_number(spark):
    import time

    rng = np.random.default_rng(4)
    vecs = vectors(spark, rng.normal(size=(3000, 16))).cache()
    vecs.count()
    asked = rng.normal(size=(4000, 16))

    def seconds(n):
        qs = queries(spark, asked[:n], 10).cache()
        qs.count()
        best = 9e9
        for _ in range(2):
            started = time.perf_counter()
            dn.search(vecs, qs, dim=16).write.format("noop").mode("overwrite").save()
            best = min(best, time.perf_counter() - started)
        return best

    assert seconds(4000) <= 5 * seconds(1000)


def test_index_arguments(spark):
    vecs = vectors(spark, np.eye(4))
    with pytest.raises(ValueError):
        ListIndex.build(vecs, nlist=2, m=3)
    with pytest.raises(ValueError):
        ListIndex.build(vecs.where("pos < 0"), nlist=2)
    with pytest.raises(ValueError):
        ListIndex.build(vecs, nlist=0)


def test_projections_find_each_pair_once(spark):
    rng = np.random.default_rng(3)
    matrix = rng.normal(size=(200, 8))
    vecs, qs = vectors(spark, matrix), queries(spark, matrix[:4], 10)
    exact = dn.search(vecs, qs, dim=8, metric="l2")
    shares = []
    for tables in (1, 8, 64):
        found = ProjectionIndex.build(vecs, 8, tables=tables, width=0.5, metric="l2").search(qs)
        assert found.count() == found.select("query_id", "pos").distinct().count()
        shares.append(recall(found, exact).agg(F.avg("recall")).first()[0])
    assert shares == sorted(shares) and shares[-1] > 0.9


def test_encoding_resumes(spark, tmp_path):
    docs = spark.createDataFrame([(str(i), "x" * i) for i in range(6)], "model_id string, text string")
    path = str(tmp_path / "vectors")

    class Lengths:
        def encode(self, texts):
            return np.array([[len(t), 1.0] for t in texts])

    def encode(part):
        return encode_with_model(part, Lengths, key="model_id", batch_size=2)

    assert encode_to_table(docs.where("model_id < '3'"), encode, path).count() == 3
    with pytest.raises(Exception):
        encode_to_table(docs, encode, path)
    with pytest.raises(ValueError):
        encode_to_table(docs, encode, path, overwrite=True, resume=True)
    with pytest.raises(ValueError):
        encode_to_table(docs, encode, path, resume=True, dim=5)
    done = encode_to_table(docs, encode, path, resume=True, dim=2)
    assert done.count() == done.select("model_id").distinct().count() == 6
    assert encode_to_table(docs, encode, path, overwrite=True).count() == 6


def test_artifact_checks(spark):
    vecs = vectors(spark, np.eye(3))
    ids, config = vecs.select("pos"), {"model_name": "m", "embedding_shape": [3, 3]}
    assert check_artifacts(vecs, ids, ids, config, 3) == 3
    for bad in (
        (vecs, ids.where("pos > 0"), ids, config, 3),
        (vecs, ids, ids, {"embedding_shape": [3, 3]}, 3),
        (vecs, ids, ids, {**config, "embedding_shape": [3, 4]}, 3),
        (vecs, ids, ids, {**config, "embedding_dtype": "float64"}, 3),
        (vecs, ids, ids, config, 4),
    ):
        with pytest.raises(ValueError):
            check_artifacts(*bad)
