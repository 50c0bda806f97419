import json
import math
import random
import re

import pytest
from pyspark.sql import functions as F

from rankloom.operators import lexical
from rankloom.operators.lexical import LexicalIndex, load_index, open_or_build, save_index
from rankloom.operators.ordering import QueryBatch


def plain_bm25(texts, query, k):
    """Loop over all documents; the result to match."""
    docs = [re.findall("[a-z0-9]+", t.lower()) for t in texts]
    n, mean = len(docs), sum(map(len, docs)) / len(docs)
    df = {}
    for d in docs:
        for w in set(d):
            df[w] = df.get(w, 0) + 1
    raw = {w: math.log(n - c + 0.5) - math.log(c + 0.5) for w, c in df.items()}
    floor = 0.25 * sum(raw.values()) / len(raw)
    idf = {w: floor if v < 0 else v for w, v in raw.items()}
    scores = []
    for pos, d in enumerate(docs):
        s = 0.0
        for w in re.findall("[a-z0-9]+", query.lower()):
            tf = d.count(w)
            if tf:
                s += idf[w] * tf * 2.5 / (tf + 1.5 * (0.25 + 0.75 * len(d) / mean))
        scores.append((-round(s, 9), pos, s))
    return [(pos, s) for _, pos, s in sorted(scores)[:k]]


def documents(spark, texts):
    rows = [(i, "", t) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "pos bigint, title string, body string").repartition(3)


def queries(spark, texts, k):
    rows = [(i, t, k) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "query_id bigint, text string, top_k int")


@pytest.fixture(params=["blocks", "small blocks", "joins"])
def way(request, monkeypatch):
    """Both ways to the scores, the first one also with blocks of few documents."""
    if request.param == "joins":
        monkeypatch.setattr(lexical, "BLOCK_WORDS", 0)
    if request.param == "small blocks":
        monkeypatch.setattr(lexical, "BLOCK_CELLS", 30)


def check(spark, texts, asked, k):
    found = LexicalIndex.build(documents(spark, texts)).search(queries(spark, asked, k)).collect()
    for i, query in enumerate(asked):
        got = sorted((r.rank, r.pos, r.score) for r in found if r.query_id == i)
        want = plain_bm25(texts, query, k)
        assert [g[1] for g in got] == [w[0] for w in want], query
        assert [g[2] for g in got] == pytest.approx([w[1] for w in want], abs=1e-9)
        assert [g[0] for g in got] == list(range(1, len(want) + 1))


def test_ranks_and_zero_fill(spark, way):
    texts = ["football video analysis", "text generation", "image segmentation"]
    check(spark, texts, ["football", "unknown", "", "text text image"], 2)


def test_common_terms_are_floored(spark, way):
    words = [f"w{i}" for i in range(30)]
    rng = random.Random(1)
    texts = ["the " + " ".join(rng.choices(words, k=8)) for _ in range(40)] + ["", "the"]
    check(spark, texts, ["the", "the w1 w1", "w2 w3 nothing"], 12)


def test_negative_mean_idf(spark):
    """Every term lies in most documents: matches rank below documents without a match."""
    texts = ["a b"] * 9 + ["a b c"] * 6 + ["", "x y", "", "a"]
    texts += ["a b c"] * 5
    assert LexicalIndex.build(documents(spark, ["a b"] * 9 + ["", "a"])).stats.mean_idf < 0
    check(spark, ["a b"] * 9 + ["", "a", ""], ["a", "b", "a b", "zzz"], 8)


def test_hot_term_and_equal_documents(spark, way):
    """A third of the documents are one text; another term is in nearly all of them."""
    rng = random.Random(3)
    words = [f"w{i}" for i in range(200)]
    texts = ["common copied text here"] * 100
    texts += ["common " + " ".join(rng.choices(words, k=6)) for _ in range(200)]
    check(spark, texts, ["copied text", "common", "w1 w2 common"], 20)


def test_top_k_zero_and_empty_collection(spark, way):
    index = LexicalIndex.build(documents(spark, ["a", "b"]))
    assert index.search(queries(spark, ["a"], 0)).count() == 0
    empty = documents(spark, ["x"]).where("pos < 0")
    assert LexicalIndex.build(empty).search(queries(spark, ["a"], 3)).count() == 0


def test_positions_must_be_dense(spark):
    with pytest.raises(ValueError):
        LexicalIndex.build(documents(spark, ["a", "b", "c"]).where("pos <> 1"))


def test_positions_that_repeat_are_refused(spark):
    docs = documents(spark, ["a", "b", "c"])
    with pytest.raises(ValueError):
        LexicalIndex.build(docs.withColumn("pos", F.when(F.col("pos") == 1, 0).otherwise(F.col("pos"))))


def test_saved_indexes_of_one_base_name(spark, tmp_path):
    asked = queries(spark, ["video"], 1)
    paths = [f"{tmp_path}/{name}" for name in ("a/idx", "b/idx", "b/idx-1", "b/idx.1")]
    for at, path in enumerate(paths):
        save_index(documents(spark, ["video" if i == at else "text" for i in range(5)]), path)
    for at, path in enumerate(paths):
        assert [r.pos for r in load_index(spark, path).search(asked).collect()] == [at]
    save_index(documents(spark, ["text", "text", "text", "text", "video"]), paths[0], buckets=3)
    assert [r.pos for r in load_index(spark, paths[0]).search(asked).collect()] == [4]


def test_saved_index_is_checked_and_reused(spark, tmp_path):
    texts = ["football video", "text generation", "image segmentation", "video text"]
    docs, path = documents(spark, texts), str(tmp_path / "idx1")
    asked = queries(spark, ["video", "text"], 3)
    want = sorted(map(tuple, LexicalIndex.build(docs).search(asked).collect()))
    index, reused = open_or_build(docs, path)
    assert not reused
    assert [r[:2] for r in sorted(map(tuple, index.search(asked).collect()))] == [r[:2] for r in want]
    _, reused = open_or_build(docs, path)
    assert reused
    for wrong in ({"documents": 9}, {"body_limit": 300}, {"format_version": 2}):
        with pytest.raises(ValueError):
            load_index(spark, path, **wrong)


def test_saved_index_scores_without_shuffling_postings(spark, tmp_path):
    docs, path = documents(spark, ["a b", "b c", "c d"]), str(tmp_path / "idx2")
    save_index(docs, path, buckets=4)
    batch = QueryBatch.of(queries(spark, ["a b"], 3))
    plan = load_index(spark, path).scores(batch)._jdf.queryExecution().executedPlan().toString()
    exchanges = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert not any("pos" in line for line in exchanges), plan


def test_plan_cuts_before_the_shuffle(spark, sf_dir, monkeypatch):
    monkeypatch.setattr(lexical, "BLOCK_WORDS", 0)
    from rankloom.sources import tables as tb

    index = LexicalIndex.build(tb.search_docs(spark, sf_dir))
    found = index.search(tb.passage_queries(spark, sf_dir))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan
    assert "Python" not in plan and "MapInArrow" not in plan


def test_a_large_batch_goes_in_groups(spark, monkeypatch):
    """Beyond the broadcast bound no pair of query and document is joined; the result is that of one broadcast."""
    texts = [" ".join(f"w{(i * j) % 23}" for j in range(i % 9)) for i in range(80)] + ["", None]
    asked = queries(spark, [f"w{i % 23} w{(i * 7) % 23} common" for i in range(40)] + ["", None], 5)
    index = LexicalIndex.build(documents(spark, texts))
    whole = sorted(tuple(r) for r in index.search(asked).select("query_id", "rank", "pos", F.round("score", 7)).collect())
    monkeypatch.setattr(lexical, "BLOCK_RESULTS", 60)
    monkeypatch.setattr(LexicalIndex, "scores", None)
    found = index.search(asked)
    assert sorted(tuple(r) for r in found.select("query_id", "rank", "pos", F.round("score", 7)).collect()) == whole


def test_frequent_terms_as_a_matrix(spark, monkeypatch):
    """Sums by matrix and by posting agree."""
    texts = [" ".join(f"w{(i * j) % 23}" for j in range(i % 9)) for i in range(80)]
    asked = queries(spark, [f"w{i % 23} w{(i * 7) % 23} w1 w1" for i in range(40)], 5)
    index, found = LexicalIndex.build(documents(spark, texts)), []
    for share in (0.0, 2.0):
        monkeypatch.setattr(lexical, "DENSE_SHARE", share)
        found.append(sorted(tuple(r) for r in index.search(asked).select("query_id", "rank", "pos", F.round("score", 7)).collect()))
    assert found[0] == found[1]


def test_buckets_follow_the_postings(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(lexical, "BUCKET_POSTINGS", 3)
    docs, path = documents(spark, [f"a b w{i} w{i + 1}" for i in range(12)]), str(tmp_path / "many")
    save_index(docs, path)
    held = json.loads(spark.read.text(f"{path}/manifest").first().value)
    assert held["buckets"] == -(-12 * 4 // 3)
    asked = queries(spark, ["a w3", "w5 w6"], 4)
    rows = [sorted(tuple(r) for r in x.search(asked).select("query_id", "rank", "pos", F.round("score", 7)).collect()) for x in (load_index(spark, path), LexicalIndex.build(docs))]
    assert rows[0] == rows[1]
