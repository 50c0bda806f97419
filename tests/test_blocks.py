"""BM25 by block bounds equals the full search, and reads little."""

import random

import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from rankloom.operators import blocks
from rankloom.operators.blocks import BlockIndex
from rankloom.operators.lexical import LexicalIndex
from rankloom.operators.ordering import QueryBatch


def rows(found):
    return sorted((r["query_id"], r["rank"], r["pos"], round(r["score"], 7)) for r in found.collect())


def collection(spark, texts):
    return spark.createDataFrame([(i, None, t) for i, t in enumerate(texts)], "pos bigint, title string, body string").repartition(4)


def asked(spark, queries):
    return spark.createDataFrame([(i, t, k) for i, (t, k) in enumerate(queries)], "query_id bigint, text string, top_k int")


@pytest.mark.parametrize("kind", ["mixed", "few words", "empty"])
def test_bounded_search_is_the_full_search(spark, tmp_path, kind):
    rng = random.Random(3)
    words = ["a", "b"] if kind == "few words" else [f"w{i}" for i in range(60)]
    texts = [" ".join(rng.choice(words[: rng.randrange(1, len(words) + 1)]) for _ in range(rng.randrange(0, 12))) for _ in range(300)]
    texts[50:120] = [texts[50]] * 70
    texts = ["", None] if kind == "empty" else texts + [None, ""]
    docs = collection(spark, texts)
    queries = asked(spark, [(" ".join(rng.choice([*words, "unseen"]) for _ in range(rng.randrange(0, 6))), rng.choice([0, 1, 5, 40])) for _ in range(12)] + [(texts[-3] if len(texts) > 2 else "a", 400), (None, 3)])
    BlockIndex.save(docs, str(tmp_path / "index"), block=16, slices=5)
    index = BlockIndex.load(spark, str(tmp_path / "index"), len(texts))
    assert rows(index.search(queries)) == rows(LexicalIndex.build(docs).search(queries))
    with pytest.raises(ValueError):
        BlockIndex.load(spark, str(tmp_path / "index"), len(texts) + 1)
    with pytest.raises(ValueError):
        BlockIndex.save(docs, str(tmp_path / "index"), block=0)


def test_blocks_below_the_floor_stay_unread(spark, tmp_path):
    """Passages of frequent words and a few rare ones: most blocks hold frequent words alone."""
    rng = random.Random(5)
    texts = [" ".join(["the", "of", "and", *(f"r{rng.randrange(20_000)}" for _ in range(8))]) for _ in range(4_000)]
    docs = collection(spark, texts)
    BlockIndex.save(docs, str(tmp_path / "index"), block=50, slices=16)
    index = BlockIndex.load(spark, str(tmp_path / "index"))
    queries = asked(spark, [(texts[i], 1) for i in range(0, 4_000, 500)])
    found, report = index.search_with_report(queries)
    assert rows(found) == rows(LexicalIndex.build(docs).search(queries))
    totals = report.agg(F.sum("met"), F.sum("read")).first()
    assert totals[0] == 8 * 80 and totals[1] < 0.25 * totals[0]
    # Folders of ranges without a wanted block are not opened.
    weights = index.whole.query_terms(QueryBatch.of(queries))
    pairs = index.bounds.where("block in (3, 4)").select(F.lit(0).cast("long").alias("query_id"), "block", "slice").distinct()
    plan = index._scored(pairs, weights, QueryBatch.of(queries))._jdf.queryExecution().toString()
    assert "dynamicpruning" in plan


def test_a_block_gives_a_query_its_best_rows_alone(spark, tmp_path, monkeypatch):
    """Pairs of query and document are no rows; queries meet a block in parts, and postings in steps."""
    texts = [f"the of w{i % 7} w{i % 11}" for i in range(300)]
    docs = collection(spark, texts)
    BlockIndex.save(docs, str(tmp_path / "index"), block=50, slices=3)
    index = BlockIndex.load(spark, str(tmp_path / "index"))
    batch = QueryBatch.of(asked(spark, [(f"the w{i % 7}", 2) for i in range(9)]))
    weights = index.whole.query_terms(batch)
    pairs = index.bounds.select("block", "slice").distinct().crossJoin(batch.df.select("query_id"))
    whole = rows(index.search(batch))
    assert whole == rows(LexicalIndex.build(docs).search(batch))
    assert index._scored(pairs, weights, batch).count() == 9 * 6 * 2
    monkeypatch.setattr(blocks, "QUERIES", 2)
    assert index._scored(pairs, weights, batch).count() == 9 * 6 * 2
    assert rows(index.search(batch)) == whole


def test_postings_are_made_where_documents_arrive(spark, tmp_path, monkeypatch):
    """Documents are sent once, by slice; their postings are not."""
    sent = []
    before = DataFrameWriter.parquet
    monkeypatch.setattr(DataFrameWriter, "parquet", lambda self, path, *a, **k: (sent.append((path, self._df._jdf.queryExecution().executedPlan().toString())), before(self, path, *a, **k))[1])
    BlockIndex.save(collection(spark, ["a b", "b c", "c"]), str(tmp_path / "index"), block=2, slices=2)
    plans = {path.rsplit("/", 1)[1]: plan for path, plan in sent}
    assert plans["postings"].count("Exchange") == 1 and "Exchange" not in plans["bounds"]
