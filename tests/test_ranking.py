import math

import pytest
from pyspark.sql import functions as F

from rankloom.operators import evaluate as ev
from rankloom.operators import fusion as fu
from rankloom.operators import labels as lb
from rankloom.operators import rerank as rr
from rankloom.operators.ordering import QueryBatch
from rankloom.plans import search as fl

CANDIDATE = (
    "query_id bigint, pos bigint, model_id string, score double, rank int, title string, "
    "snippet string, body string, pipeline_tag string, tags array<string>"
)


def ranking(spark, docs, ranks=None, source="s"):
    rows = [(1, d, r, i, f"{source}-{d}") for i, (d, r) in enumerate(zip(docs, ranks or range(1, 99)), 1)]
    return spark.createDataFrame(rows, "query_id bigint, doc_id string, rank int, place int, note string")


def fused(spark, *rankings, **options):
    out = fu.fuse(rankings, doc="doc_id", payload=["note"], **options)
    return [(r.doc_id, r["rank"], r.note) for r in out.orderBy("rank").collect()]


def test_fusion_order_ranks_and_payload(spark):
    a = ranking(spark, ["a", "b", "c"], source="lexical")
    b = ranking(spark, ["b", "c"], source="dense")
    got = fused(spark, a, b, k=60, top_k=3)
    assert got == [("b", 1, "lexical-b"), ("c", 2, "lexical-c"), ("a", 3, "lexical-a")]
    assert fused(spark, a, b, top_k=2) == got[:2]
    assert fused(spark, a, b, top_k=0) == []
    assert fused(spark, a.where("false"), b.where("false")) == []


def test_fusion_counts_a_document_once_per_ranking(spark):
    a = ranking(spark, ["a", "b", "a"], source="x")
    out = fu.fuse([a], doc="doc_id", k=0)
    assert {r.doc_id: r.score for r in out.collect()} == {"a": 1.0, "b": 0.5}


def test_fusion_takes_the_place_of_a_missing_rank(spark):
    out = fu.fuse([ranking(spark, ["a", "b"], [0, -1])], doc="doc_id", k=0)
    assert {r.doc_id: r.score for r in out.collect()} == {"a": 1.0, "b": 0.5}
    with pytest.raises(ValueError):
        fu.fuse([ranking(spark, ["a"])], doc="doc_id", k=-1)


def test_fusion_ties_keep_the_first_seen(spark):
    got = fused(spark, ranking(spark, ["x", "y"]), ranking(spark, ["y", "x"]), ranking(spark, ["z"]))
    assert [g[0] for g in got] == ["x", "y", "z"]


def candidates(spark, bodies, query_id=1):
    rows = [
        (query_id, i, f"m{i}", 1.0 / i, i, "", b[:500], b, "text-generation", ["t"])
        for i, b in enumerate(bodies, 1)
    ]
    return spark.createDataFrame(rows, CANDIDATE)


def asked(spark, top_k=10, text="alpha beta"):
    return spark.createDataFrame([(1, text, top_k)], "query_id bigint, text string, top_k int")


def order(df):
    return [(r.pos, r.score, r["rank"]) for r in df.orderBy("rank").collect()]


def test_rerank_scores_all_then_cuts(spark):
    bodies = ["x" * n for n in range(1, 51)]
    got = order(rr.rerank(candidates(spark, bodies), asked(spark), rr.length_scorer, strategy="body_only"))
    assert [g[0] for g in got] == list(range(50, 40, -1))
    assert [g[2] for g in got] == list(range(1, 11))
    own = rr.rerank(candidates(spark, bodies), asked(spark), rr.length_scorer, top_k=3, strategy="body_only")
    assert [g[0] for g in order(own)] == [50, 49, 48]


def test_rerank_ties_keep_candidate_order(spark):
    got = order(rr.rerank(candidates(spark, ["aa", "bb", "ccc"]), asked(spark), rr.length_scorer, strategy="body_only"))
    assert [g[0] for g in got] == [3, 1, 2]


def test_model_scorer_must_answer_every_pair(spark):
    class Short:
        def predict(self, pairs):
            return [1.0] * (len(pairs) - 1)

    with pytest.raises(Exception, match="another number of scores"):
        rr.rerank(candidates(spark, ["a", "b"]), asked(spark), rr.model_scorer(Short)).collect()


def test_fused_rerank_weights(spark):
    rows = candidates(spark, ["aaa", "bb", "ccccccc"])

    def docs(**options):
        out = rr.fused_rerank(rows, asked(spark), rr.length_scorer, strategy="body_only", **options)
        return [r[0] for r in order(out)]

    assert docs(weight=0.0) == [1, 2, 3]
    assert docs(weight=5.0, k=1)[0] == 3
    assert docs(final_k=0) == []


def test_diagnostics(spark):
    qrels = spark.createDataFrame([(1, "m3")], "query_id bigint, model_id string")
    out = rr.diagnostics(
        candidates(spark, ["aaa", "bb", "ccccccc"]), asked(spark), rr.length_scorer, qrels, strategy="body_only"
    )
    first = out.orderBy("reranked_rank").first()
    assert (first.model_id, first.hybrid_rank, first.rank_change, first.qrels_relevant) == ("m3", 3, 2, True)
    assert first.reranker_text_preview == "ccccccc"


def test_payload_check(spark):
    rows = candidates(spark, ["a"])
    rr.check_payload(rows)
    with pytest.raises(ValueError):
        rr.check_payload(rows.withColumn("tags", F.lit(None).cast("array<string>")))


def test_overlap(spark):
    a = ranking(spark, ["a", "b", "c"]).withColumnRenamed("doc_id", "pos")
    b = ranking(spark, ["b", "d"]).withColumnRenamed("doc_id", "pos")
    row = fu.overlap(a, b, 2).first()
    assert (row.shared, row.jaccard) == (1, pytest.approx(1 / 3))


def results(spark, ids, query_id=1):
    rows = [(query_id, m, i) for i, m in enumerate(ids, 1)]
    return spark.createDataFrame(rows, "query_id bigint, model_id string, rank int")


def judged(spark, rows):
    return spark.createDataFrame(rows, "query_id bigint, model_id string")


def test_metrics_of_one_query(spark):
    got = ev.per_query_metrics(
        asked(spark), results(spark, ["m2", "m1"]), judged(spark, [(1, "m1")]), cutoffs=(1, 2)
    ).first()
    assert got.mrr == 0.5
    assert (got["recall@1"], got["recall@2"], got["precision@2"]) == (0.0, 1.0, 0.5)
    assert got["ndcg@2"] == pytest.approx(1 / math.log2(3))


def test_metrics_count_ids_once_and_look_beyond_the_cutoff(spark):
    got = ev.per_query_metrics(
        asked(spark), results(spark, ["a", "a", "b", "c"]), judged(spark, [(1, "c"), (1, "c"), (1, "z")]), cutoffs=(2,)
    ).first()
    assert got.mrr == pytest.approx(1 / 3) and got["recall@2"] == 0.0 and got.relevant == 2


def test_queries_without_relevant_or_results_count_as_zero(spark):
    queries = spark.createDataFrame([(1,), (2,), (3,)], "query_id bigint")
    rows = ev.per_query_metrics(queries, results(spark, ["a"]), judged(spark, [(1, "a"), (2, "b")]))
    by_query = {r.query_id: r for r in rows.collect()}
    assert by_query[1].mrr == 1.0 and by_query[2].mrr == 0.0 and by_query[3]["ndcg@5"] == 0.0
    means = {r.metric: r.value for r in ev.summary(rows).collect()}
    assert means["mrr"] == pytest.approx(1 / 3)
    assert set(means) == set(ev.metric_names())
    assert ev.summary(rows.where("false")).count() == 0
    with pytest.raises(ValueError):
        ev.per_query_metrics(queries, results(spark, ["a"]), judged(spark, [(1, "a")]), cutoffs=(0,))


def test_details(spark):
    row = ev.per_query_details(asked(spark), results(spark, ["a", "b", "a"]), judged(spark, [(1, "b")])).first()
    assert (row.retrieved_model_ids, row.ranks) == (["a", "b"], [2])


def label_rows(spark, rows):
    return spark.createDataFrame(
        [(i, *r) for i, r in enumerate(rows, 2)], "row_no bigint, query string, relevant_model_ids string"
    )


def test_labels_load(spark):
    known = judged(spark, [(0, "a"), (0, "b")]).select("model_id")
    queries, qrels = lb.load_qrels(label_rows(spark, [(" one ", "a|b|a"), ("two", "['b']")]), known, top_k=7)
    assert sorted((r.text, r.top_k) for r in queries.collect()) == [("one", 7), ("two", 7)]
    assert sorted((r.query_id, r.model_id) for r in qrels.collect()) == [(2, "a"), (2, "b"), (3, "b")]


@pytest.mark.parametrize(
    "rows, fault",
    [
        ([("q", "a"), (" ", "a")], "row 3: empty query"),
        ([("query one", "a"), ("Query One", "a")], "row 3: duplicate query"),
        ([("q", "[broken")], "row 2: invalid list"),
        ([("q", "[]")], "row 2: no ids"),
        ([("q", "a;x;y")], "row 2: unknown ids: x, y"),
        ([("q", "x"), ("", "a")], "row 2: unknown ids"),
    ],
)
def test_label_faults(spark, rows, fault):
    known = judged(spark, [(0, "a")]).select("model_id")
    with pytest.raises(ValueError, match=fault):
        lb.load_qrels(label_rows(spark, rows), known)


def test_labels_must_exist(spark):
    with pytest.raises(ValueError):
        lb.load_qrels(label_rows(spark, [("q", "a")]).where("false"))
    with pytest.raises(ValueError):
        lb.load_qrels(label_rows(spark, [("q", "a")]), top_k=0)
    with pytest.raises(ValueError, match="x"):
        lb.check_relevant(judged(spark, [(1, "x")]), judged(spark, [(1, "a")]).select("model_id"))


def test_silver_labels_fall_back_to_small_tasks(spark):
    rows = [(f"m{t}{i}", f" Task_{t}") for t in range(6) for i in range(5 + t)]
    cards = spark.createDataFrame(rows, "model_id string, pipeline_tag string")
    queries, qrels = lb.silver_labels(cards)
    got = {r.text: r.query_id for r in queries.collect()}
    assert set(got) == {f"task {t}" for t in range(1, 6)}  # the largest lie nearest to the target
    assert qrels.where(F.col("query_id") == got["task 5"]).count() == 10
    with pytest.raises(ValueError):
        lb.check_silver(lb.silver_labels(cards.where("pipeline_tag < ' Task_2'"))[0])


def test_containing_documents_equal_brute_force(spark):
    from rankloom.operators.lexical import LexicalIndex

    texts = ["one two three four", "xone two threex", "two", "a one two three b", "none", "one  two three"] * 5
    docs = spark.createDataFrame(
        [(i, f"m{i}", "", t) for i, t in enumerate(texts)], "pos bigint, model_id string, title string, body string"
    )
    asks = ["one two three", "two", "one two", "absent words here", "two three"]
    queries = spark.createDataFrame(list(enumerate(asks)), "query_id bigint, text string")
    got = lb.containing_documents(queries, docs, LexicalIndex.build(docs)).collect()
    want = [(i, f"m{j}") for i, a in enumerate(asks) for j, t in enumerate(texts) if a in t]
    assert sorted(map(tuple, got)) == sorted(want)


def test_short_passages_go_by_their_terms(spark, monkeypatch):
    from pyspark.sql import functions

    from rankloom.operators.lexical import LexicalIndex

    texts = ["one two three", "bone twofold", "Two, one", "on", "?!", "", "phones", "a ne tw"] * 3
    docs = spark.createDataFrame(
        [(i, f"m{i}", "", t) for i, t in enumerate(texts)], "pos bigint, model_id string, title string, body string"
    )
    asks = ["one", "one two", "e t", "ne", "n", "wo, o", "?!", "", "Two", "zebra", "one", "hones", "two three"]
    queries = spark.createDataFrame(list(enumerate(asks)), "query_id bigint, text string")
    index = LexicalIndex.build(docs)
    # Nothing is collected into one value.
    monkeypatch.setattr(functions, "collect_list", None)
    got = lb.containing_documents(queries, docs, index).collect()
    want = [(i, f"m{j}") for i, a in enumerate(asks) for j, t in enumerate(texts) if a in t]
    assert sorted(map(tuple, got)) == sorted(want)


def test_batch_and_empty_search(spark):
    batch = QueryBatch.of(spark.createDataFrame([(1, "a", -3)], "query_id bigint, text string, top_k int"))
    assert (batch.rows, batch.top_k) == (1, 0)
    docs = spark.createDataFrame([(0, "body")], "pos bigint, body string")
    none = spark.createDataFrame([], "query_id bigint, pos bigint, score double, rank int")
    assert fl.find(batch, docs, lambda b: none).count() == 0
    with pytest.raises(ValueError):
        fl.score_direction(none, "cosine")
    assert fl.score_direction(ranking(spark, ["a"]), "l2").first().score_direction == "lower_is_better"
