"""Fusion, reranking, labels and evaluation over the whole tables.

The queries of the hybrid systems are all benchmark passages, each with the
vector of its number. Texts are searched in all documents and vectors among
all vectors; the rankings are fused by full union. Relevant are the documents whose
vector has the label of the query's.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import fixed_values as fv
from ..functions import text as tx
from ..operators import evaluate as ev
from ..operators import fusion as fu
from ..operators import labels as lb
from ..operators import rerank as rr
from ..operators.lexical import LexicalIndex
from ..operators.ordering import QueryBatch, number_rows, small_side
from ..plans import experiments as ex
from ..plans import search as fl
from ..session import settle_table
from ..sources import tables as tb
from . import sql as q
from .lexical_dense import DIM
from .registry import query

K = 30


class Setting:
    """Documents, queries and both source rankings, each computed once."""

    def __init__(self, spark, sf_dir, k: int = K):
        self.docs = tb.search_docs(spark, sf_dir)
        self.vectors = tb.vectors(spark, sf_dir)
        queries = settle_table(tb.text_vector_queries(spark, sf_dir, k))
        self.batch = QueryBatch.of(queries.drop("label"))
        self.lexical = fl.lexical_retriever(LexicalIndex.build(self.docs))
        self.dense = fl.dense_retriever(self.vectors, DIM)
        labelled = self.docs.select("pos", "model_id").join(self.vectors.select("pos", "label"), "pos")
        # The queries are as few as the passages, so they go to the documents: no label meets in one task.
        asked = small_side(queries.select("query_id", "label"), self.batch.rows)
        self.qrels = labelled.join(asked, "label").select("query_id", "model_id")

    def rankings(self):
        lex, den = settle_table(self.lexical(self.batch)), settle_table(self.dense(self.batch))
        hybrid = settle_table(self.batch.cut(fu.fuse([lex, den], top_k=self.batch.top_k)))
        return lex, den, hybrid

    def candidates(self):
        return fl.with_payload(self.rankings()[2], self.docs, self.batch)


def base(k: int = K) -> str:
    return f"{q.DOCS}, {q.TEXT_VECTORS}, {q.bm25(k)}, {q.dense(k, 'v')}, {q.fused(k)}"


QRELS = "qr AS (SELECT query_id, model_id FROM d JOIN v USING (pos) JOIN q USING (label))"


def scored_pairs(strategy: str = "title_task_body", chars: int = fv.RERANK_TEXT_CHARS) -> str:
    """CTE ce(query_id, pos, model_id, rank, rrf, s): candidates with their pair score."""
    return f"""
tx AS (SELECT hy.query_id, hy.pos, hy.rank, hy.score AS rrf, d.model_id, d.title, d.pipeline_tag, d.tags,
       q.text AS query_text, {q.rerank_text(strategy, chars)} AS document FROM hy JOIN d USING (pos) JOIN q ON q.query_id = hy.query_id),
ce AS (SELECT *, {q.overlap_score('query_text', 'document')} AS s FROM tx)"""


CE_RANK = "row_number() OVER (PARTITION BY query_id ORDER BY s DESC, rank)"


@query(
    "j1_rank_fusion",
    f"WITH {base()} SELECT query_id, pos, round(score, 9) AS score, rank FROM hy",
)
def rank_fusion(spark, sf_dir):
    return Setting(spark, sf_dir).rankings()[2].select(
        "query_id", "pos", F.round("score", 9).alias("score"), "rank"
    )


@query(
    "e2_fusion_of_three",
    f"WITH {base(20)}, l2 AS (SELECT query_id, pos, rank FROM ({q.dense(20, 'v', 'l2').strip().removeprefix('dn AS (').removesuffix(')')})), "
    f"u AS (SELECT query_id, pos, rank AS r, 0 AS s FROM bm UNION ALL SELECT query_id, pos, rank, 1 FROM dn "
    f"UNION ALL SELECT query_id, pos, rank, 2 FROM l2) "
    f"SELECT query_id, pos, round(sum(1.0::DOUBLE / (10 + r)), 9) AS score FROM u GROUP BY ALL",
)
def fusion_of_three(spark, sf_dir):
    """Three rankings with another constant, uncut."""
    from ..operators import dense as dn

    s = Setting(spark, sf_dir, 20)
    third = dn.search(s.vectors, s.batch, dim=DIM, metric="l2")
    fused = fu.fuse([s.lexical(s.batch), s.dense(s.batch), third], k=10)
    return fused.select("query_id", "pos", F.round("score", 9).alias("score"))


@query(
    "j2_hybrid_search",
    f"WITH {base(10)} SELECT query_id, rank, model_id, title, round(score, 9) AS score FROM hy JOIN d USING (pos)",
)
def hybrid_search(spark, sf_dir):
    s = Setting(spark, sf_dir, 10)
    rows = fl.find(s.batch, s.docs, fl.hybrid_retriever(s.lexical, s.dense))
    return rows.select("query_id", "rank", "model_id", "title", F.round("score", 9).alias("score"))


@query(
    "d6_rank_comparison",
    f"WITH {base()} SELECT hy.query_id, hy.pos, hy.rank AS rrf_rank, round(hy.score, 6) AS rrf_score, "
    f"bm.rank AS bm25_rank, round(bm.score, 6) AS bm25_score, dn.rank AS dense_rank, round(dn.score, 6) AS cosine_score "
    f"FROM hy LEFT JOIN bm ON bm.query_id = hy.query_id AND bm.pos = hy.pos "
    f"LEFT JOIN dn ON dn.query_id = hy.query_id AND dn.pos = hy.pos WHERE hy.rank <= 20",
)
def rank_comparison(spark, sf_dir):
    lex, den, hybrid = Setting(spark, sf_dir).rankings()
    out = fu.rank_comparison(hybrid, lex, den, 20)
    rounded = [F.round(c, 6).alias(c) for c in ("rrf_score", "bm25_score", "cosine_score")]
    return out.select("query_id", "pos", "rrf_rank", "bm25_rank", "dense_rank", *rounded)


@query(
    "g1_overlap",
    f"WITH {base()}, a AS (SELECT 'bm25 vs dense' AS rankings, bm.query_id, bm.pos AS x, NULL::BIGINT AS y FROM bm WHERE rank <= 20 "
    f"UNION ALL SELECT 'bm25 vs dense', query_id, NULL, pos FROM dn WHERE rank <= 20 "
    f"UNION ALL SELECT 'bm25 vs hybrid', query_id, pos, NULL FROM bm WHERE rank <= 20 "
    f"UNION ALL SELECT 'bm25 vs hybrid', query_id, NULL, pos FROM hy WHERE rank <= 20 "
    f"UNION ALL SELECT 'dense vs hybrid', query_id, pos, NULL FROM dn WHERE rank <= 20 "
    f"UNION ALL SELECT 'dense vs hybrid', query_id, NULL, pos FROM hy WHERE rank <= 20), "
    f"m AS (SELECT rankings, query_id, coalesce(x, y) AS pos, count(x) AS l, count(y) AS r FROM a GROUP BY ALL) "
    f"SELECT rankings, query_id, count(*) FILTER (l > 0 AND r > 0) AS shared, "
    f"round(count(*) FILTER (l > 0 AND r > 0) / count(*), 6) AS jaccard FROM m GROUP BY ALL",
)
def overlap(spark, sf_dir):
    lex, den, hybrid = Setting(spark, sf_dir).rankings()
    pairs = {"bm25 vs dense": (lex, den), "bm25 vs hybrid": (lex, hybrid), "dense vs hybrid": (den, hybrid)}
    parts = [
        fu.overlap(a, b, 20).select(
            F.lit(name).alias("rankings"), "query_id", "shared", F.round("jaccard", 6).alias("jaccard")
        )
        for name, (a, b) in pairs.items()
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query(
    "g2_heads_by_system",
    f"WITH {base()} SELECT 'BM25' AS system, query_id, pos, rank FROM bm WHERE rank <= 5 UNION ALL "
    f"SELECT 'Dense', query_id, pos, rank FROM dn WHERE rank <= 5 UNION ALL "
    f"SELECT 'Hybrid RRF', query_id, pos, rank FROM hy WHERE rank <= 5",
)
def heads_by_system(spark, sf_dir):
    lex, den, hybrid = Setting(spark, sf_dir).rankings()
    rows = fu.head_by_system({"BM25": lex, "Dense": den, "Hybrid RRF": hybrid})
    return rows.select("system", "query_id", "pos", "rank")


@query(
    "j3_rerank",
    f"WITH {base()}, {scored_pairs()} SELECT query_id, model_id, round(s, 6) AS score, {CE_RANK} AS new_rank "
    f"FROM ce QUALIFY new_rank <= 10",
)
def rerank(spark, sf_dir):
    s = Setting(spark, sf_dir)
    out = rr.rerank(s.candidates(), s.batch, rr.overlap_scorer, top_k=10)
    return out.select(
        "query_id", "model_id", F.round("score", 6).alias("score"), F.col("rank").alias("new_rank")
    )


@query(
    "f3_rerank_by_length",
    f"WITH {base()}, {scored_pairs('title_task_tags_body', 200)} SELECT query_id, model_id, length(document)::DOUBLE AS score, "
    f"row_number() OVER (PARTITION BY query_id ORDER BY length(document) DESC, rank) AS new_rank FROM ce",
)
def rerank_by_length(spark, sf_dir):
    """Texts cut to 200 characters tie often; ties keep the candidate order."""
    s = Setting(spark, sf_dir)
    out = rr.rerank(
        s.candidates(), s.batch, rr.length_scorer, strategy="title_task_tags_body", max_chars=200
    )
    return out.select("query_id", "model_id", "score", F.col("rank").alias("new_rank"))


class WordModel:
    """Stand-in for a pair model: the share of query words found in the document."""

    def predict(self, pairs):
        import re

        def words(text):
            return set(re.findall("[a-z0-9а-я]+", text.lower()))

        return [len(words(a) & words(b)) / len(words(a)) if words(a) else 0.0 for a, b in pairs]


@query(
    "m2_model_scorer",
    f"WITH {base()}, {scored_pairs()} SELECT query_id, model_id, round(s, 6) AS score, {CE_RANK} AS new_rank FROM ce",
)
def model_scorer(spark, sf_dir):
    s = Setting(spark, sf_dir)
    out = rr.rerank(s.candidates(), s.batch, rr.model_scorer(WordModel))
    return out.select(
        "query_id", "model_id", F.round("score", 6).alias("score"), F.col("rank").alias("new_rank")
    )


@query(
    "d11_scored_pairs",
    f"WITH {base()}, {scored_pairs()} SELECT query_id, pos, md5(query_text) AS query_md5, md5(document) AS document_md5 FROM ce",
)
def scored_pair_texts(spark, sf_dir):
    s = Setting(spark, sf_dir)
    pairs = s.candidates().join(s.batch.df.select("query_id", F.col("text").alias("query_text")), "query_id")
    return pairs.select(
        "query_id", "pos", F.md5("query_text").alias("query_md5"), F.md5(tx.rerank_text()).alias("document_md5")
    )


def fused_sql(weight: str, k: int) -> str:
    return (
        f"WITH {base()}, {scored_pairs()}, r AS (SELECT *, {CE_RANK} AS ce_rank FROM ce) "
        f"SELECT query_id, model_id, round(1.0::DOUBLE / ({k} + rank) + {weight}::DOUBLE / ({k} + ce_rank), 9) AS score, "
        f"row_number() OVER (PARTITION BY query_id ORDER BY 1.0::DOUBLE / ({k} + rank) + {weight}::DOUBLE / ({k} + ce_rank) DESC, rank) AS new_rank "
        f"FROM r QUALIFY new_rank <= 20"
    )


def _fused(spark, sf_dir, weight, k):
    s = Setting(spark, sf_dir)
    out = rr.fused_rerank(s.candidates(), s.batch, rr.overlap_scorer, weight=weight, k=k, final_k=20)
    return out.select(
        "query_id", "model_id", F.round("score", 9).alias("score"), F.col("rank").alias("new_rank")
    )


@query("j4_fused_rerank", fused_sql("1.0", 60))
def fused_rerank(spark, sf_dir):
    return _fused(spark, sf_dir, 1.0, 60)


@query("j4_fused_rerank_heavy", fused_sql("5.0", 1))
def fused_rerank_heavy(spark, sf_dir):
    return _fused(spark, sf_dir, 5.0, 1)


@query(
    "d7_rerank_comparison",
    f"WITH {base()}, {scored_pairs()} SELECT query_id, pos, rank AS hybrid_rank, {CE_RANK} AS reranked_rank, "
    f"rank - {CE_RANK} AS rank_change, round(rrf, 6) AS rrf_score, round(s, 6) AS cross_encoder_score FROM ce",
)
def rerank_comparison(spark, sf_dir):
    s = Setting(spark, sf_dir)
    before = s.candidates()
    after = rr.rerank(before, s.batch, rr.overlap_scorer)
    out = fu.rerank_comparison(before, after)
    return out.select(
        "query_id", "pos", "hybrid_rank", "reranked_rank", "rank_change",
        F.round("rrf_score", 6).alias("rrf_score"),
        F.round("cross_encoder_score", 6).alias("cross_encoder_score"),
    )


@query(
    "j5_rerank_diagnostics",
    f"WITH {base()}, {QRELS}, {scored_pairs()} SELECT ce.query_id, ce.model_id, pipeline_tag, rank AS hybrid_rank, "
    f"{CE_RANK.replace('query_id', 'ce.query_id')} AS reranked_rank, "
    f"rank - {CE_RANK.replace('query_id', 'ce.query_id')} AS rank_change, round(rrf, 6) AS rrf_score, "
    f"round(s, 6) AS cross_encoder_score, qr.model_id IS NOT NULL AS qrels_relevant, substr(document, 1, 120) AS reranker_text_preview "
    f"FROM ce LEFT JOIN qr ON qr.query_id = ce.query_id AND qr.model_id = ce.model_id",
)
def rerank_diagnostics(spark, sf_dir):
    s = Setting(spark, sf_dir)
    out = rr.diagnostics(s.candidates(), s.batch.df, rr.overlap_scorer, s.qrels)
    return out.withColumns(
        {c: F.round(c, 6) for c in ("rrf_score", "cross_encoder_score")}
    )


@query(
    "j6_search_and_rank",
    f"WITH {base()}, {scored_pairs()}, r AS (SELECT *, {CE_RANK} AS new_rank FROM ce) "
    f"SELECT query_id, new_rank AS rank, r.model_id, round(s, 6) AS cross_encoder_score, "
    f"substr({q.squeeze('substr(body, 1, 500)')}, 1, 220) AS snippet FROM r JOIN d USING (pos) WHERE new_rank <= 20",
)
def search_and_rank(spark, sf_dir):
    s = Setting(spark, sf_dir)

    def ranker(candidates, batch):
        return rr.rerank(candidates, batch, rr.overlap_scorer, top_k=fv.RERANKED)

    out = fl.find(s.batch, s.docs, fl.hybrid_retriever(s.lexical, s.dense), ranker)
    return fl.shown(out, "cross_encoder_score").withColumn(
        "cross_encoder_score", F.round("cross_encoder_score", 6)
    )


@query(
    "j7_payload_gaps",
    f"WITH {base()} SELECT count(*) AS candidates, count(*) FILTER (pos % 7 = 0) AS without_task, "
    f"count(*) FILTER (pos % 5 = 0) AS without_tags FROM hy JOIN d USING (pos)",
)
def payload_gaps(spark, sf_dir):
    """Every seventh document lost its task and every fifth its tags."""
    rows = Setting(spark, sf_dir).candidates()
    rows = rows.withColumn("pipeline_tag", F.when(F.col("pos") % 7 != 0, F.col("pipeline_tag")))
    return rr.payload_gaps(rows.withColumn("tags", F.when(F.col("pos") % 5 != 0, F.col("tags"))))


@query(
    "j7_payload_preview",
    f"WITH {base()}, {scored_pairs()} SELECT ce.query_id, ce.rank, ce.model_id, d.title, d.pipeline_tag, "
    f"array_to_string(list_slice(d.tags, 1, 5), '|') AS tags, substr(body, 1, 160) AS body, "
    f"substr(document, 1, 240) AS scorer_text FROM ce JOIN d USING (pos) WHERE ce.rank <= 5",
)
def payload_preview(spark, sf_dir):
    out = rr.payload_preview(Setting(spark, sf_dir).candidates())
    return out.withColumn("tags", F.array_join("tags", "|"))


# ---- labels ---------------------------------------------------------------

# Relevance rows made of the conversation turns: the text is the query, the ids
# name documents, some of which do not exist; some rows have no ids.
LABEL_ROWS = """
lr AS (SELECT row_number() OVER (ORDER BY conv_id, turn) + 1 AS row_no, trim(text, ' ') AS query,
  CASE WHEN turn % 5 = 4 THEN [] ELSE list_distinct([CAST(conv_id AS VARCHAR), CAST(conv_id * 31 + turn AS VARCHAR)]) END AS ids,
  [CAST(conv_id AS VARCHAR), CAST(conv_id * 31 + turn AS VARCHAR)] AS named FROM conversations)"""


def _label_rows(spark, sf_dir):
    rows = number_rows(
        tb.table(spark, sf_dir, "conversations").select("conv_id", "turn", "text"),
        [F.col("conv_id"), F.col("turn")],
    )
    a, b = F.col("conv_id").cast("string"), (F.col("conv_id") * 31 + F.col("turn")).cast("string")
    ids = F.when(F.pmod("turn", F.lit(5)) == 4, "[]").otherwise(F.concat_ws("|", a, b, a))
    return rows.select(
        (F.col("pos") + 2).alias("row_no"), F.col("text").alias("query"), ids.alias("relevant_model_ids")
    )


@query(
    "k1_label_faults",
    f"WITH {LABEL_ROWS}, f AS (SELECT lr.*, row_no > min(row_no) OVER (PARTITION BY lower({q.strip('query')})) AS again FROM lr), "
    f"miss AS (SELECT row_no, string_agg(id, ', ' ORDER BY i) AS unknown FROM (SELECT row_no, unnest(named) AS id, "
    f"generate_subscripts(named, 1) AS i, named FROM lr WHERE len(ids) > 0) WHERE id NOT IN (SELECT CAST(doc_id AS VARCHAR) FROM documents) "
    f"AND (i = 1 OR named[1] <> named[2]) GROUP BY row_no), "
    f"o AS (SELECT row_no, CASE WHEN {q.strip('query')} = '' THEN 'empty query' WHEN again THEN 'duplicate query' "
    f"WHEN len(ids) = 0 THEN 'no ids' WHEN unknown IS NOT NULL THEN 'unknown ids' END AS kind, unknown, {q.strip('query')} AS query "
    f"FROM f LEFT JOIN miss USING (row_no)) "
    f"SELECT row_no, kind, CASE WHEN kind = 'unknown ids' THEN unknown ELSE query END AS detail FROM o WHERE kind IS NOT NULL",
)
def label_faults(spark, sf_dir):
    known = tb.table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("model_id"))
    return lb.qrels_problems(_label_rows(spark, sf_dir), known)


@query(
    "d9_unknown_relevant",
    f"WITH {LABEL_ROWS} SELECT DISTINCT id AS model_id FROM (SELECT unnest(ids) AS id FROM lr) "
    f"WHERE id NOT IN (SELECT CAST(doc_id AS VARCHAR) FROM documents)",
)
def unknown_relevant(spark, sf_dir):
    known = tb.table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("model_id"))
    asked = lb.parse_qrels(_label_rows(spark, sf_dir)).select(F.explode("ids").alias("model_id"))
    return lb.unknown_relevant(asked, known)


@query(
    "g4_known_relevant",
    f"WITH {LABEL_ROWS} SELECT DISTINCT id AS model_id FROM (SELECT unnest(ids) AS id FROM lr) "
    f"INTERSECT SELECT CAST(doc_id AS VARCHAR) FROM documents",
)
def known_relevant(spark, sf_dir):
    known = tb.table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("model_id"))
    asked = lb.parse_qrels(_label_rows(spark, sf_dir)).select(F.explode("ids").alias("model_id"))
    return asked.intersect(known)


@query(
    "e10_relevant_counts",
    f"WITH {LABEL_ROWS} SELECT row_no, count(DISTINCT id) AS relevant FROM (SELECT row_no, unnest(ids) AS id FROM lr) GROUP BY row_no",
)
def relevant_counts(spark, sf_dir):
    rows = lb.parse_qrels(_label_rows(spark, sf_dir)).select("row_no", F.explode("ids").alias("id"))
    return rows.groupBy("row_no").agg(F.countDistinct("id").alias("relevant"))


TASKS = f"tc AS (SELECT task, count(*) AS models FROM (SELECT {q.task_key('pipeline_tag')} AS task FROM d) WHERE task <> '' GROUP BY task)"
BOUNDED = (
    f"bt AS (SELECT * FROM tc WHERE CASE WHEN (SELECT count(*) FROM tc WHERE models BETWEEN {fv.SILVER_LOW} AND {fv.SILVER_HIGH}) >= {fv.SILVER_QUERIES} "
    f"THEN models BETWEEN {fv.SILVER_LOW} AND {fv.SILVER_HIGH} ELSE models >= {fv.SILVER_FALLBACK} END)"
)
TARGET = (
    f"tt AS (SELECT row_number() OVER (ORDER BY abs(models - {fv.SILVER_TARGET}), models DESC, task) AS query_id, task, models "
    f"FROM bt QUALIFY query_id <= {fv.SILVER_QUERIES})"
)


@query("e8_task_counts", f"WITH {q.DOCS}, {TASKS} SELECT * FROM tc")
def task_counts(spark, sf_dir):
    return lb.task_counts(tb.search_docs(spark, sf_dir))


@query("c5_bounded_tasks", f"WITH {q.DOCS}, {TASKS}, {BOUNDED} SELECT * FROM bt")
def bounded_tasks(spark, sf_dir):
    return lb.bounded_tasks(lb.task_counts(tb.search_docs(spark, sf_dir)))


@query("f9_target_tasks", f"WITH {q.DOCS}, {TASKS}, {BOUNDED}, {TARGET} SELECT * FROM tt")
def target_tasks(spark, sf_dir):
    out = lb.target_tasks(settle_table(lb.task_counts(tb.search_docs(spark, sf_dir))))
    return out.select("query_id", "task", "models")


@query(
    "k5_silver_labels",
    f"WITH {q.DOCS}, {TASKS}, {BOUNDED}, {TARGET} SELECT query_id, translate(task, '-', ' ') AS text, model_id "
    f"FROM tt JOIN (SELECT model_id, {q.task_key('pipeline_tag')} AS task FROM d) USING (task)",
)
def silver_labels(spark, sf_dir):
    queries, qrels = lb.silver_labels(tb.search_docs(spark, sf_dir))
    return qrels.join(F.broadcast(queries.select("query_id", "text")), "query_id")


@query(
    "k10_query_summary",
    f"WITH {q.DOCS}, {TASKS}, {BOUNDED}, {TARGET} SELECT translate(task, '-', ' ') AS query, 'pipeline_tag=' || task AS label_rule, "
    f"models AS relevant_models FROM tt",
)
def query_summary(spark, sf_dir):
    return lb.query_summary(*lb.silver_labels(tb.search_docs(spark, sf_dir)))


# ---- evaluation -----------------------------------------------------------


def _metric_columns(per_query):
    named = {c: c.replace("@", "_at_") for c in per_query.columns if c == "mrr" or "@" in c}
    keep = [c for c in per_query.columns if c not in named]
    return per_query.select(*keep, *[F.round(F.col(f"`{c}`"), 6).alias(n) for c, n in named.items()])


SILVER = (
    f"{q.DOCS}, {TASKS}, {BOUNDED}, {TARGET}, q AS (SELECT query_id, translate(task, '-', ' ') AS text FROM tt), "
    f"{q.bm25(100)}, res AS (SELECT query_id, model_id, rank FROM bm JOIN d USING (pos)), "
    f"qr AS (SELECT query_id, model_id FROM tt JOIN (SELECT model_id, {q.task_key('pipeline_tag')} AS task FROM d) USING (task))"
)


def _silver_run(spark, sf_dir):
    docs = tb.search_docs(spark, sf_dir)
    queries, qrels = lb.silver_labels(docs)
    batch = QueryBatch.of(settle_table(queries))
    found = fl.lexical_retriever(LexicalIndex.build(docs))(batch)
    results = fl.with_payload(found, docs.select("pos", "model_id", "body"), batch)
    return batch.df, results, qrels


@query(
    "k2_metrics_per_query",
    f"WITH {SILVER}, {q.metrics()} SELECT query_id, relevant, {q.metric_columns()} FROM pq",
)
def metrics_per_query(spark, sf_dir):
    return _metric_columns(ev.per_query_metrics(*_silver_run(spark, sf_dir)))


KNOWN = (
    f"{q.DOCS}, {q.PASSAGES}, {q.bm25(10)}, res AS (SELECT query_id, model_id, rank FROM bm JOIN d USING (pos)), "
    f"qr AS (SELECT query_id, model_id FROM q JOIN d ON contains(body, text))"
)


@query(
    "k2_known_item_summary",
    f"WITH {KNOWN}, {q.metrics()} SELECT 'mrr' AS metric, round(avg(mrr), 6) AS value FROM pq "
    + " ".join(
        f"UNION ALL SELECT '{m}@{k}', round(avg({m[0]}{k}), 6) FROM pq"
        for k in fv.METRIC_CUTOFFS
        for m in ("precision", "recall", "ndcg")
    ),
)
def known_item_summary(spark, sf_dir):
    """Passages as queries; relevant are the documents that hold the passage.

    A document that holds a passage holds all its distinct terms, so candidates
    are found by a term join on the passage's rarest term before texts are read.
    """
    docs = tb.search_docs(spark, sf_dir)
    queries = settle_table(tb.passage_queries(spark, sf_dir, 10))
    batch = QueryBatch.of(queries)
    index = LexicalIndex.build(docs)
    results = fl.with_payload(index.search(batch), docs.select("pos", "model_id", "body"), batch)
    qrels = lb.containing_documents(queries, docs, index)
    return ev.summary(ev.per_query_metrics(queries, results, qrels)).select(
        "metric", F.round("value", 6).alias("value")
    )


@query(
    "e7_metric_means",
    f"WITH {SILVER}, {q.metrics()} SELECT {q.HEADLINE} FROM pq",
)
def metric_means(spark, sf_dir):
    out = ev.compact_table(ev.per_query_metrics(*_silver_run(spark, sf_dir)), by=())
    return out.select(*[F.round(c, 6).alias(c) for c in out.columns])


@query(
    "d8_relevant_hits",
    f"WITH {SILVER} SELECT query_id, model_id, rank FROM res SEMI JOIN qr USING (query_id, model_id)",
)
def relevant_hits(spark, sf_dir):
    _, results, qrels = _silver_run(spark, sf_dir)
    return results.join(qrels, ["query_id", "model_id"], "left_semi").select(
        "query_id", "model_id", "rank"
    )


# Results by language-and-source instead of document: many rows share an id.
@query(
    "f8_first_per_model",
    f"WITH {q.DOCS}, {q.PASSAGES}, {q.bm25(50)}, r AS (SELECT query_id, pipeline_tag AS model_id, min(rank) AS rank FROM bm "
    f"JOIN d USING (pos) GROUP BY ALL) SELECT query_id, model_id, row_number() OVER (PARTITION BY query_id ORDER BY rank) AS place FROM r",
)
def first_per_model(spark, sf_dir):
    docs = tb.search_docs(spark, sf_dir)
    batch = QueryBatch.of(tb.passage_queries(spark, sf_dir, 50))
    found = fl.with_payload(LexicalIndex.build(docs).search(batch), docs, batch)
    rows = found.select("query_id", F.col("pipeline_tag").alias("model_id"), "rank")
    return ev.first_per_model(rows, ["query_id"])


def all_systems(k: int = 100) -> str:
    return (
        f"{base(k)}, {QRELS}, {scored_pairs()}, cr AS (SELECT query_id, model_id, {CE_RANK} AS new_rank FROM ce QUALIFY new_rank <= {fv.RERANKED}), "
        f"res AS (SELECT 'bm25' AS system, query_id, model_id, rank FROM bm JOIN d USING (pos) UNION ALL "
        f"SELECT 'dense', query_id, model_id, rank FROM dn JOIN d USING (pos) UNION ALL "
        f"SELECT 'hybrid_rrf', query_id, model_id, rank FROM hy JOIN d USING (pos) UNION ALL "
        f"SELECT 'hybrid_rrf_cross_encoder', query_id, model_id, new_rank FROM cr), "
        f"fr AS (SELECT query_id, system FROM q, (SELECT unnest(['bm25', 'dense', 'hybrid_rrf', 'hybrid_rrf_cross_encoder']) AS system)), "
        f"{q.metrics('system', 'fr')}"
    )


def _systems(spark, sf_dir):
    s = Setting(spark, sf_dir, 100)
    results = ex.system_results(s.batch, s.docs, s.lexical, s.dense, rr.overlap_scorer)
    return ex.compare_systems(s.batch, results, s.qrels)


@query(
    "k7_system_comparison",
    f"WITH {all_systems()} SELECT system, {q.HEADLINE} FROM pq GROUP BY system",
)
def system_comparison(spark, sf_dir):
    out = ev.compact_table(_systems(spark, sf_dir))
    return out.select("system", *[F.round(c, 6).alias(c) for c in out.columns if c != "system"])


@query(
    "k7_system_metrics",
    f"WITH {all_systems()} SELECT system, query_id, relevant, {q.metric_columns()} FROM pq",
)
def system_metrics(spark, sf_dir):
    return _metric_columns(_systems(spark, sf_dir))


def grid() -> str:
    sizes = ", ".join(map(str, fv.ABLATION_SIZES))
    texts = " ".join(
        ("" if i == 0 else "UNION ALL ")
        + f"SELECT query_id, pos, '{n}' AS text_variant, {q.rerank_text(s, c)} AS document FROM un JOIN d USING (pos)"
        for i, (n, s, c) in enumerate(fv.ABLATION_TEXTS)
    )
    top = max(fv.ABLATION_SIZES)
    return f"""{q.DOCS}, {q.TEXT_VECTORS}, {QRELS}, {q.bm25(top)}, {q.dense(top, 'v')},
sz AS (SELECT unnest([{sizes}]) AS candidate_k),
bmk AS (SELECT bm.*, candidate_k FROM bm, sz WHERE rank <= candidate_k),
dnk AS (SELECT dn.*, candidate_k FROM dn, sz WHERE rank <= candidate_k),
{q.fused(10**6, 'bmk', 'dnk', 'hk0', 'candidate_k')},
hk AS (SELECT * FROM hk0 WHERE rank <= candidate_k),
un AS (SELECT DISTINCT query_id, pos FROM hk),
tv AS ({texts}),
sv AS (SELECT tv.query_id, pos, text_variant, {q.overlap_score('q.text', 'document')} AS s FROM tv JOIN q ON q.query_id = tv.query_id),
cg AS (SELECT text_variant, candidate_k, hk.query_id, hk.pos, model_id, hk.rank, s, row_number() OVER (
  PARTITION BY text_variant, candidate_k, hk.query_id ORDER BY s DESC, hk.rank) AS ce_rank
  FROM hk JOIN sv ON sv.query_id = hk.query_id AND sv.pos = hk.pos JOIN d ON d.pos = hk.pos)"""


def ablation_sql() -> str:
    return (
        f"{grid()}, resg AS (SELECT text_variant, candidate_k, query_id, model_id, ce_rank AS rank FROM cg WHERE ce_rank <= {fv.RERANKED}), "
        f"frg AS (SELECT DISTINCT text_variant, candidate_k, q.query_id FROM cg, q), "
        f"{q.metrics('text_variant, candidate_k', 'frg', 'resg')}, "
        f"ab AS (SELECT text_variant, candidate_k, avg(mrr) AS mrr, avg(p5) AS p5, avg(r20) AS r20, avg(n10) AS n10 FROM pq GROUP BY ALL)"
    )


def _scored_grid(spark, sf_dir):
    s = Setting(spark, sf_dir, max(fv.ABLATION_SIZES))
    hybrid = ex.hybrid_by_size(s.batch, s.lexical, s.dense, fv.ABLATION_SIZES)
    return s, settle_table(ex.ablation_candidates(hybrid, s.docs, s.batch, rr.overlap_scorer))


AB_COLUMNS = "round(mrr, 6) AS mrr, round(p5, 6) AS precision_at_5, round(r20, 6) AS recall_at_20, round(n10, 6) AS ndcg_at_10"


@query("k8_rerank_ablation", f"WITH {ablation_sql()} SELECT text_variant, candidate_k, {AB_COLUMNS} FROM ab")
def rerank_ablation(spark, sf_dir):
    s, scored = _scored_grid(spark, sf_dir)
    out = ex.ablation(scored, s.batch, s.qrels)
    keys = ("text_variant", "candidate_k")
    return out.select(*keys, *[F.round(c, 6).alias(c) for c in out.columns if c not in keys])


BEST = "best AS (SELECT * FROM ab ORDER BY round(n10, 9) DESC, round(mrr, 9) DESC, candidate_k, text_variant LIMIT 1)"


@query("f10_best_setting", f"WITH {ablation_sql()}, {BEST} SELECT text_variant, candidate_k, {AB_COLUMNS} FROM best")
def best_setting(spark, sf_dir):
    s, scored = _scored_grid(spark, sf_dir)
    out = ev.best_row(ex.ablation(scored, s.batch, s.qrels), ["candidate_k", "text_variant"])
    keys = ("text_variant", "candidate_k")
    return out.select(*keys, *[F.round(c, 6).alias(c) for c in out.columns if c not in keys])


@query(
    "k9_fusion_comparison",
    f"WITH {ablation_sql()}, {BEST}, best_rows AS (SELECT cg.* FROM cg JOIN best USING (text_variant, candidate_k)), "
    f"mx AS (SELECT query_id, model_id, row_number() OVER (PARTITION BY query_id ORDER BY 1.0::DOUBLE / (60 + rank) + 1.0::DOUBLE / (60 + ce_rank) DESC, rank) AS r FROM best_rows), "
    f"res AS (SELECT 'Hybrid' AS system, query_id, model_id, rank FROM best_rows UNION ALL "
    f"SELECT 'Pure CrossEncoder', query_id, model_id, ce_rank FROM best_rows WHERE ce_rank <= {fv.RERANKED} UNION ALL "
    f"SELECT 'Hybrid + CE Fusion', query_id, model_id, r FROM mx WHERE r <= {fv.RERANKED}), "
    f"fr AS (SELECT query_id, system FROM q, (SELECT DISTINCT system FROM res)), "
    + q.metrics("system", "fr", tag="2")
    + f" SELECT system, {q.HEADLINE} FROM pq2 GROUP BY system",
)
def fusion_comparison(spark, sf_dir):
    s, scored = _scored_grid(spark, sf_dir)
    table = settle_table(ex.ablation(scored, s.batch, s.qrels))
    best = ev.best_row(table, ["candidate_k", "text_variant"])
    out = ex.fusion_comparison(scored, s.batch, s.qrels, best)
    return out.select("system", *[F.round(c, 6).alias(c) for c in out.columns if c != "system"])
