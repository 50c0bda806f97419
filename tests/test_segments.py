"""An index in segments equals the index of all its documents."""

import pytest
from pyspark.sql import functions as F

from rankloom.operators import segments
from rankloom.operators.lexical import LexicalIndex
from rankloom.operators.ordering import QueryBatch
from rankloom.operators.segments import SegmentedIndex, versions

TEXTS = ["red fox", "red red hen", "", "blue hen", None, "fox and hen", "the red dog", "dog", "fox fox", "hen"]


def rows(found):
    return sorted((r["query_id"], r["rank"], r["pos"], round(r["score"], 7)) for r in found.collect())


def test_appended_and_merged_segments(spark, tmp_path):
    path = str(tmp_path / "index")
    docs = spark.createDataFrame([(i, None, t) for i, t in enumerate(TEXTS)], "pos bigint, title string, body string")
    asked = spark.createDataFrame([(0, "red fox", 4), (1, "hen", 20), (2, "unseen", 2)], "query_id bigint, text string, top_k int")
    index = SegmentedIndex.create(spark, path)
    assert index.index(spark).search(asked).count() == 0
    for low, high in ((0, 3), (3, 5), (5, 10)):
        index = index.append(docs.where(F.col("pos").between(low, high - 1)), file_postings=4)
        assert rows(index.index(spark).search(asked)) == rows(LexicalIndex.build(docs.where(F.col("pos") < high)).search(asked))
    full = rows(index.index(spark).search(asked))
    merged = index.merge(spark)
    assert len(merged.segments) == 2 and rows(merged.index(spark).search(asked)) == full
    once = merged.merge(spark, smallest=9)
    assert len(once.segments) == 1 and rows(once.index(spark).search(asked)) == full and once.merge(spark) == once
    # Older versions stay readable, and the newest is what opens.
    assert SegmentedIndex.open(spark, path) == once and sorted(versions(spark, path)) == [0, 1, 2, 3, 4, 5]
    assert rows(SegmentedIndex.open(spark, path, 3).index(spark).search(asked)) == full
    assert rows(SegmentedIndex.open(spark, path, 1).index(spark).search(asked)) == rows(LexicalIndex.build(docs.where("pos < 3")).search(asked))


def test_faults_are_told(spark, tmp_path):
    path = str(tmp_path / "index")
    docs = spark.createDataFrame([(i, None, t) for i, t in enumerate(TEXTS)], "pos bigint, title string, body string")
    with pytest.raises(ValueError):
        SegmentedIndex.open(spark, path)
    index = SegmentedIndex.create(spark, path)
    with pytest.raises(ValueError):
        SegmentedIndex.create(spark, path)
    with pytest.raises(ValueError):
        index.append(docs.where("pos > 2"))
    with pytest.raises(ValueError):
        SegmentedIndex.open(spark, path, 7)
    assert index.append(docs.where("pos < 0")).version == 1


def test_segments_are_written_and_scored_in_many_tasks(spark, tmp_path, monkeypatch):
    """A large segment has a file for each core, and (query, document) is summed where a document's postings are."""
    monkeypatch.setattr(segments, "LEAST_POSTINGS", 2)
    docs = spark.createDataFrame([(i, None, t) for i, t in enumerate(TEXTS)], "pos bigint, title string, body string")
    asked = QueryBatch.of(spark.createDataFrame([(0, "red fox", 4)], "query_id bigint, text string, top_k int"))
    index = SegmentedIndex.create(spark, str(tmp_path / "index")).append(docs)
    assert len(list(tmp_path.glob("index/segment-*/postings/part-*"))) > 2
    plan = index.index(spark).scores(asked)._jdf.queryExecution().executedPlan().toString()
    sent = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert any("hashpartitioning(pos" in line for line in sent) and not any("query_id" in line for line in sent), plan
    assert rows(index.index(spark).search(asked)) == rows(LexicalIndex.build(docs).search(asked))
