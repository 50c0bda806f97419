import json

import pytest
from pyspark.sql import functions as F

from rankloom.operators import cards as cd
from rankloom.operators import profile as pf
from rankloom.operators.encode import HashedTermEncoder
from rankloom.operators.labels import load_qrels
from rankloom.operators.ordering import (
    first_of_each,
    join_small,
    number_rows,
    random_rows,
    top_per_group,
)
from rankloom.operators import ordering
from rankloom.sources import datasets as ds
from rankloom.sources import sinks
from rankloom.streaming.encoding import encode_new_files


def raw(spark, rows):
    return spark.createDataFrame(
        [(i, *r) for i, r in enumerate(rows)],
        "pos bigint, model_id string, likes string, downloads string, modelCard string",
    )


def test_filters_look_at_the_raw_text(spark):
    long = "x" * 21
    rows = raw(spark, [
        ("a", "1", "1", long), ("b", "1", "1", "y" * 20), ("c", "1", "1", None),
        ("d", "1", "1", "<!--  This model card has been generated automatically -->"),
        ("e", "1", "1", "# " + " " * 30),
    ])
    assert sorted(r.model_id for r in cd.usable(rows).collect()) == ["a", "e"]


def test_sampling_and_repeats(spark):
    card = "a text that is long enough"
    rows = raw(spark, [(f"m{i % 40}", str(i % 3), str(i % 5), card) for i in range(100)])
    rows = rows.withColumns({"tags": F.lit("['t']"), "languages": F.lit("[]"), "createdAt": F.lit("2024-01-02T00:00:00")})
    typed = cd.typed_numbers(rows)
    chosen = cd.popular_and_random(typed, 10, 30)
    assert chosen.groupBy("stratum").count().orderBy("stratum").collect() == [(0, 10), (1, 30)]
    best = sorted(((-(i % 5), -(i % 3), i) for i in range(100)))[:10]
    top = chosen.where("stratum = 0").orderBy("place").collect()
    assert [r.pos for r in top] == [b[2] for b in best]
    assert chosen.select("pos").distinct().count() == 40
    kept = cd.without_repeats(chosen).collect()
    firsts = {}
    for r in sorted(chosen.collect(), key=lambda r: (r.stratum, r.place)):
        firsts.setdefault(r.model_id, r.pos)
    assert {r.model_id: r.pos for r in kept} == firsts
    clean = cd.prepare(rows, 10, 30)
    assert clean.count() == len(firsts) and clean.first().tags == ["t"]


def test_large_and_small_cuts_agree(spark, monkeypatch):
    rows = spark.range(500).withColumnRenamed("id", "pos")
    direct = sorted(r.pos for r in random_rows(rows, 60).collect())
    monkeypatch.setattr(ordering, "PRUNED_K", 10)
    assert sorted(r.pos for r in random_rows(rows, 60).collect()) == direct


def test_numbering_is_dense_under_any_partitioning(spark):
    rows = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("x")).repartition(7)
    got = number_rows(rows, [F.col("x").desc()], "n").collect()
    assert sorted((r.n, r.x) for r in got) == [(i, 999 - i) for i in range(1000)]
    assert number_rows(rows.where("x < 0"), [F.col("x")], "n").count() == 0


def test_hot_groups(spark, monkeypatch):
    """One key holds two thirds of the rows."""
    rows = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, F.col("id") % 50).otherwise(-1).alias("g"), "id"
    )
    want = {}
    for r in rows.collect():
        want.setdefault(r.g, []).append(r.id)
    want = {g: sorted(v)[:5] for g, v in want.items()}

    def tops():
        out = {}
        for r in top_per_group(rows, ["g"], [F.col("id")], 5).collect():
            out.setdefault(r.g, []).append(r.id)
        return {g: sorted(v) for g, v in out.items()}

    assert tops() == want
    monkeypatch.setattr(ordering, "PRUNED_K", 2)
    assert tops() == want
    firsts = {r.g: r.id for r in first_of_each(rows, ["g"], ["id"], "id").collect()}
    assert firsts == {g: v[0] for g, v in want.items()}
    names = rows.select("g").distinct().withColumn("name", F.col("g").cast("string"))
    for size in (10, None):
        assert join_small(rows, names, "g", size, F.col("id")).count() == 3000


def test_documents_from_own_texts(spark):
    rows = spark.createDataFrame(
        [(0, "doc-0", "m/0", None, " body text ", "['a', 'b']", None), (1, "doc-1", "nan", "Title", "", None, "t")],
        "pos bigint, doc_id string, model_id string, name string, body string, tags string, pipeline_tag string",
    )
    a, b = cd.documents(rows, max_body_chars=4).orderBy("pos").collect()
    assert (a.model_id, a.title, a.body, a.tags, a.pipeline_tag) == ("m/0", "m/0", "body", ["'a'", "'b'"], "")
    assert (b.model_id, b.title, b.body, b.tags, b.pipeline_tag) == ("doc-1", "Title", "", [], "t")
    with pytest.raises(ValueError):
        cd.documents(rows, max_body_chars=0)


def test_documents_need_aligned_texts(spark):
    rows = spark.createDataFrame([(0, "a", "tag"), (1, "b", None)], "pos bigint, doc_id string, pipeline_tag string")
    source = spark.createDataFrame([("b", "text b", "other"), ("a", "text a", "other")], "model_id string, modelCard string, pipeline_tag string")
    got = cd.documents(rows, source=source).orderBy("pos").collect()
    assert [(r.body, r.pipeline_tag) for r in got] == [("text a", "tag"), ("text b", "other")]
    with pytest.raises(ValueError):
        cd.documents(rows)
    for bad in (source.where("model_id = 'a'"), source.unionByName(source), source.withColumnRenamed("model_id", "id")):
        with pytest.raises(ValueError):
            cd.documents(rows, source=bad)


def test_dataset_formats(spark, tmp_path):
    card = 'line one\nline "two", with comma'
    (tmp_path / "d.json").write_text(json.dumps([{"model_id": "a", "modelCard": card}, {"model_id": "b", "modelCard": "x"}]))
    (tmp_path / "d.jsonl").write_text(json.dumps({"model_id": "a", "modelCard": card}) + "\n")
    (tmp_path / "d.csv").write_text('model_id,modelCard\na,"line one\nline ""two"", with comma"\n')
    (tmp_path / "d.tsv").write_text('model_id\tmodelCard\na\t"line one\nline ""two"", with comma"\n')
    for name in ("d.json", "d.jsonl", "d.csv", "d.tsv"):
        rows = ds.read_dataset(spark, str(tmp_path / name)).where("model_id = 'a'").collect()
        assert [r.modelCard for r in rows] == [card], name
    assert ds.read_dataset(spark, str(tmp_path / "d.json"), limit=1, order_by="model_id").count() == 1
    (tmp_path / "bad.csv").write_text("model_id\na\n")
    for bad in ("bad.csv", "d.xml"):
        with pytest.raises(ValueError):
            ds.read_dataset(spark, str(tmp_path / bad))


def test_relevance_file_with_byte_order_mark(spark, tmp_path):
    path = tmp_path / "qrels.csv"
    path.write_text("﻿query,relevant_model_ids,label_source\none,a|b,x\n\"two\nlines\",c,x\n", encoding="utf-8")
    rows = ds.read_qrels(spark, str(path)).orderBy("row_no").collect()
    assert [(r.row_no, r.query, r.relevant_model_ids) for r in rows] == [(2, "one", "a|b"), (3, "two\nlines", "c")]
    path.write_text("query,ids\none,a\n")
    with pytest.raises(ValueError):
        ds.read_qrels(spark, str(path))


def test_relevance_files_are_numbered_on(spark, tmp_path):
    folder = tmp_path / "qrels.csv"
    folder.mkdir()
    for part in range(3):
        lines = [f"q{part}{i},a" for i in range(3)]
        (folder / f"part-{part}.csv").write_text("query,relevant_model_ids\n" + "\n".join(lines) + "\n")
    rows = ds.read_qrels(spark, str(folder))
    assert [(r.row_no, r.query) for r in rows.orderBy("row_no").collect()] == [
        (2 + 3 * part + i, f"q{part}{i}") for part in range(3) for i in range(3)
    ]
    queries, _ = load_qrels(rows)
    assert queries.select("query_id").distinct().count() == 9
    (folder / "part-9.csv").write_text("query,relevant_model_ids\nq00,b\n")
    with pytest.raises(ValueError):
        load_qrels(ds.read_qrels(spark, str(folder)))


def test_blanks_survive_a_result_table(spark, tmp_path):
    rows = spark.createDataFrame([("  lead and trail  ",)], "text string")
    sinks.write_results(rows, f"{tmp_path}/blanks")
    assert spark.read.csv(f"{tmp_path}/blanks", header=True).first().text == "  lead and trail  "


def test_reports_and_result_tables(spark, tmp_path):
    summary = spark.createDataFrame([("mrr", 0.5), ("ndcg@5", 0.25)], "metric string, value double")
    details = spark.createDataFrame([(1, ["a"], [1])], "query_id bigint, retrieved_model_ids array<string>, ranks array<int>")
    sinks.write_report(summary, details, str(tmp_path), "run")
    report = spark.read.json(f"{tmp_path}/run/report").first()
    assert (report.name, report.query_count, report.metrics["mrr"]) == ("run", 1, 0.5)
    sinks.write_run_summary(spark, {"status": "complete", "document_count": 3}, f"{tmp_path}/summary")
    assert spark.read.json(f"{tmp_path}/summary").first().document_count == 3
    odd = spark.createDataFrame([(1, 'a "b",\nc')], "rank int, snippet string")
    sinks.write_results(odd, f"{tmp_path}/table")
    back = spark.read.csv(f"{tmp_path}/table", header=True, multiLine=True, escape='"').first()
    assert back.snippet == 'a "b",\nc'


def test_filter_renumbers(spark):
    docs = spark.createDataFrame([(i, "xy"[i % 2]) for i in range(10)], "pos bigint, kind string")
    got = cd.where_equal(docs, {"kind": "y"}).orderBy("pos").collect()
    assert [(r.pos, r.source_pos) for r in got] == [(i, 2 * i + 1) for i in range(5)]


def vectors(spark, rows):
    return spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "pos bigint, embedding array<float>")


def test_vector_statistics(spark):
    vecs = vectors(spark, [[3.0, 4.0], [0.0, 0.0], [1.0, 0.0]])
    row = pf.norm_stats(vecs).first()
    assert (row.num_vectors, row.dim, row.norm_max, row.zero_norm_count) == (3, 2, 5.0, 1)
    assert row.norm_std == pytest.approx(2.1602468994)
    units = {r.pos: r.embedding for r in pf.unit_vectors(vecs).collect()}
    assert units[0] == pytest.approx([0.6, 0.8]) and units[1] == [0.0, 0.0]
    sample = pf.sample_rows(vecs, 10)
    pairs = pf.pair_cosines(sample, 50)
    assert pairs.where("i = j").count() == 0 and 10 < pairs.count() < 50
    one = pf.sample_rows(vecs.where("pos = 0"), 10)
    assert pf.cosine_distribution(pf.pair_cosines(one, 50)).count() == 0


def test_projection_and_shrinking(spark, sf_dir):
    from rankloom.sources import tables as tb

    vecs = tb.vectors(spark, sf_dir)
    small, projection = pf.shrink(vecs, 8, dim=64)
    norms = small.select(F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x * x).alias("n"), F.size("embedding").alias("d"))
    row = norms.agg(F.min("n"), F.max("n"), F.min("d"), F.count("*")).first()
    assert row[0] == pytest.approx(1, abs=1e-4) and row[1] == pytest.approx(1, abs=1e-4)
    assert (row[2], row[3]) == (8, vecs.count())
    shares = [r.cumulative_explained_variance for r in pf.explained_variance(spark, projection.explained).orderBy("component").collect()]
    assert shares == sorted(shares) and 0 < shares[-1] <= 1
    centred = projection.apply(vecs).select(*[F.avg(F.get("projected", F.lit(i))) for i in range(3)]).first()
    assert list(centred) == pytest.approx([0, 0, 0], abs=1e-6)
    for bad in (0, 64):
        with pytest.raises(ValueError):
            pf.shrink(vecs, bad, dim=64)
    sizes = pf.fit_kmeans(vecs, 5).groupBy("cluster").count().collect()
    assert len(sizes) == 5 and sum(r["count"] for r in sizes) == vecs.count()


def test_cluster_summary_order(spark):
    rows = spark.createDataFrame(
        [(0, i, f"m{i}", "ab"[i % 2], None, ["t", f"u{i}"]) for i in range(9)] + [(1, 9, "m9", "", "lib", [])],
        "cluster int, pos bigint, model_id string, pipeline_tag string, library_name string, tags array<string>",
    )
    a, b = pf.cluster_summary(rows).orderBy("cluster").collect()
    assert (a.size, a.top_pipeline_tags, a.top_libraries) == (9, "a:5; b:4", "")
    assert a.top_tags.startswith("t:9; u0:1") and len(a.top_tags.split("; ")) == 10
    assert a.example_model_ids == "; ".join(f"m{i}" for i in range(8))
    assert (b.top_pipeline_tags, b.top_libraries, b.top_tags) == ("", "lib:1", "")


def test_stream_resumes(spark, tmp_path):
    source, target, progress = (str(tmp_path / n) for n in ("in", "out", "progress"))
    rows = spark.range(10).select(F.col("id").alias("pos"), F.concat(F.lit("text "), "id").alias("text"))
    encoder = HashedTermEncoder(16).fit(rows)

    def encode(part):
        return encoder.encode(part).select("pos", "embedding")

    rows.where("pos < 4").write.parquet(source)
    assert encode_new_files(spark, source, "pos bigint, text string", encode, target, progress) == 1
    assert spark.read.parquet(target).count() == 4
    rows.where("pos >= 4").write.mode("append").parquet(source)
    encode_new_files(spark, source, "pos bigint, text string", encode, target, progress)
    done = spark.read.parquet(target)
    assert done.count() == done.select("pos").distinct().count() == 10
    assert encode_new_files(spark, source, "pos bigint, text string", encode, target, progress) == 0


def test_analysis_takes_all_vectors(spark, monkeypatch):
    from rankloom import suite
    from rankloom.plans.experiments import profile_vectors
    from rankloom.sources import tables

    n = 10_050
    vecs = spark.range(n).selectExpr(
        "id AS pos", "transform(sequence(1, 4), i -> cast(sin(id * i) as float)) AS embedding", "1 AS label"
    )
    monkeypatch.setattr(tables, "vectors", lambda spark, sf_dir: vecs)
    assert suite.QUERIES["l1_projection"](spark, "").count() == n
    assert suite.QUERIES["l2_clusters"](spark, "").agg({"size": "sum"}).first()[0] == n
    assert profile_vectors(vecs, n_pairs=10).first().sample_size == n


def test_metadata_is_kept_with_its_types_or_cut_to_the_task(spark):
    rows = spark.createDataFrame(
        [(0, "m", "body", ["a", "b"], None, 7, {"x": 1.5})],
        "pos long, doc_id string, body string, tags array<string>, task string, likes int, more map<string,double>",
    )
    read = "variant_get(metadata['likes'], '$', 'int') likes", "variant_get(metadata['more'], '$.x', 'double') x", "variant_get(metadata['tags'], '$[1]', 'string') tag"
    (row,) = cd.documents(rows).selectExpr("map_keys(metadata) k", *read).collect()
    assert sorted(row.k) == ["body", "likes", "more", "pipeline_tag", "tags", "task"] and (row.likes, row.x, row.tag) == (7, 1.5, "b")
    slim = cd.documents(rows.withColumn("task", F.lit("video-classification")), include_metadata=False)
    (row,) = slim.selectExpr("map_keys(metadata) k", "variant_get(metadata['pipeline_tag'], '$', 'string') t", "tags").collect()
    assert (row.k, row.t, row.tags) == (["pipeline_tag"], "video-classification", ["a", "b"])
