"""Lexical and dense retrieval over the whole document and vector tables."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from ..functions import fixed_values as fv
from ..functions import text as tx
from ..functions import vectors as vx
from ..operators import cards as cd
from ..operators import dense as dn
from ..operators.ann import ListIndex, ProjectionIndex, recall
from ..operators.blocks import BlockIndex
from ..operators.encode import HashedTermEncoder, encode_with_model
from ..operators.lexical import (
    LexicalIndex,
    corpus_stats,
    load_index,
    open_or_build,
    packed_documents,
    save_index,
    term_table,
    with_idf,
)
from ..operators.ordering import QueryBatch
from ..operators.segments import SegmentedIndex
from ..plans import search as fl
from ..session import settle_table, shared_dir
from ..sources import tables as tb
from . import sql as q
from .registry import query

DIM = 64


def scored(rows):
    return rows.select("query_id", "pos", F.round("score", 6).alias("score"), "rank")


# ---- lexical --------------------------------------------------------------


@query(
    "e1_term_idf",
    f"WITH {q.DOCS}, {q.PASSAGES}, {q.bm25(1)} SELECT tm.term, df, round(idf, 6) AS idf FROM tm JOIN idf USING (term)",
)
def term_idf(spark, sf_dir):
    docs = tb.search_docs(spark, sf_dir)
    terms = settle_table(term_table(packed_documents(docs)))
    stats = corpus_stats(terms)
    return with_idf(terms, stats).select("term", "df", F.round("idf", 6).alias("idf"))


@query(
    "e1_corpus_stats",
    f"WITH {q.DOCS}, {q.PASSAGES}, {q.bm25(1)} SELECT (SELECT n FROM st) AS documents, "
    f"(SELECT sum(length) FROM ln)::BIGINT AS tokens, (SELECT count(*) FROM tm) AS vocabulary, "
    f"round((SELECT avgdl FROM st), 6) AS mean_length, round((SELECT mean FROM mi), 6) AS mean_idf",
)
def collection_stats(spark, sf_dir):
    docs = tb.search_docs(spark, sf_dir)
    s = corpus_stats(settle_table(term_table(packed_documents(docs))))
    return spark.range(1).select(
        F.lit(s.documents).cast("long").alias("documents"),
        F.lit(s.tokens).cast("long").alias("tokens"),
        F.lit(s.vocabulary).cast("long").alias("vocabulary"),
        F.lit(round(s.mean_length, 6)).alias("mean_length"),
        F.lit(round(s.mean_idf, 6)).alias("mean_idf"),
    )


@query(
    "d2_query_term_postings",
    f"WITH {q.DOCS}, {q.PASSAGES}, {q.bm25(1)} SELECT query_id, qt.term, qtf, count(*) AS postings, "
    f"sum(tf)::BIGINT AS occurrences FROM qt JOIN p USING (term) GROUP BY ALL",
)
def query_term_postings(spark, sf_dir):
    docs = tb.search_docs(spark, sf_dir)
    passages = tb.passage_queries(spark, sf_dir)
    batch = QueryBatch.of(passages)
    words = passages.select("query_id", F.explode(tx.term_counts(tx.tokens("text"))).alias("t"))
    words = words.select("query_id", F.col("t.term").alias("term"), F.col("t.tf").alias("qtf"))
    hint = F.broadcast(words) if batch.words is not None else words
    # Postings are combined per term before they meet the queries.
    return (
        term_table(packed_documents(docs))
        .join(hint, "term")
        .select(
            "query_id", "term", "qtf",
            F.col("df").alias("postings"), F.col("cf").alias("occurrences"),
        )
    )


@query(
    "h1_bm25_search",
    f"WITH {q.DOCS}, {q.PASSAGES}, {q.bm25(10)} SELECT query_id, pos, round(score, 6) AS score, rank FROM bm",
)
def bm25_search(spark, sf_dir):
    index = LexicalIndex.build(tb.search_docs(spark, sf_dir))
    return scored(index.search(tb.passage_queries(spark, sf_dir, 10)))


TURNS = "q AS (SELECT conv_id * 1000 + turn AS query_id, text FROM conversations WHERE role = 'user')"


def _turns(spark, sf_dir, top_k):
    rows = tb.table(spark, sf_dir, "conversations").where(F.col("role") == "user")
    return rows.select(
        (F.col("conv_id") * 1000 + F.col("turn")).alias("query_id"), "text", F.lit(top_k).alias("top_k")
    )


@query(
    "f1_bm25_conversation_turns",
    f"WITH {q.DOCS}, {TURNS}, {q.bm25(5)} SELECT query_id, pos, round(score, 6) AS score, rank FROM bm",
)
def bm25_turns(spark, sf_dir):
    index = LexicalIndex.build(tb.search_docs(spark, sf_dir), settled=True)
    return scored(index.search(_turns(spark, sf_dir, 5)))


# A language name and a source name as a query: the terms occur in every title
# of that language, so many scores tie and short lists are filled up.
RARE = (
    "q AS (SELECT row_number() OVER (ORDER BY lang, source) AS query_id, "
    "'unseenword ' || source || 'x ' || lang || 'x' AS text FROM (SELECT DISTINCT lang, source FROM documents))"
)


@query(
    "f2_bm25_zero_fill",
    f"WITH {q.DOCS}, {RARE}, {q.bm25(10)} SELECT text, pos, round(score, 6) AS score, rank FROM bm JOIN q USING (query_id)",
)
def bm25_zero_fill(spark, sf_dir):
    docs = tb.search_docs(spark, sf_dir)
    pairs = tb.table(spark, sf_dir, "documents").select("lang", "source").distinct()
    text = F.concat(F.lit("unseenword "), "source", F.lit("x "), "lang", F.lit("x"))
    queries = pairs.select(text.alias("query_id"), text.alias("text"), F.lit(10).alias("top_k"))
    found = LexicalIndex.build(docs).search(queries)
    return found.select(
        F.col("query_id").alias("text"), "pos", F.round("score", 6).alias("score"), "rank"
    )


@query(
    "f11_own_top_k",
    f"WITH {q.DOCS}, {q.PASSAGES}, {q.bm25(6)} SELECT query_id, pos, round(score, 6) AS score, rank FROM bm "
    f"WHERE rank <= query_id % 7",
)
def own_top_k(spark, sf_dir):
    """Every query brings its own top_k; 0 and less give no rows."""
    queries = tb.passage_queries(spark, sf_dir).withColumn(
        "top_k", F.pmod("query_id", F.lit(7)).cast("int") - F.when(F.pmod("query_id", F.lit(7)) == 0, 5).otherwise(0)
    )
    return scored(LexicalIndex.build(tb.search_docs(spark, sf_dir)).search(queries))


@query(
    "c7_filtered_search",
    f"WITH {q.DOCS.replace('FROM documents', '''FROM documents WHERE lang || '_' || source = 'en_src7' ''')}, "
    f"{q.PASSAGES}, {q.bm25(10)} SELECT query_id, pos, round(score, 6) AS score, rank FROM bm",
)
def filtered_search(spark, sf_dir):
    docs = settle_table(cd.where_equal(tb.search_docs(spark, sf_dir), {"pipeline_tag": "en_src7"}))
    found = LexicalIndex.build(docs).search(tb.passage_queries(spark, sf_dir, 10))
    back = docs.select("pos", "source_pos")
    return scored(found.join(back, "pos").drop("pos").withColumnRenamed("source_pos", "pos"))


@query(
    "a12_saved_lexical_index",
    f"WITH {q.DOCS}, {q.PASSAGES}, {q.bm25(10)} SELECT query_id, pos, round(score, 6) AS score, rank FROM bm",
)
def saved_lexical_index(spark, sf_dir):
    """Search through an index that was written, checked and opened again."""
    import uuid

    docs = tb.search_docs(spark, sf_dir)
    path = f"{shared_dir(spark)}/index_{uuid.uuid4().hex}"
    save_index(docs, path)
    index = load_index(spark, path, documents=docs.count())
    return scored(index.search(tb.passage_queries(spark, sf_dir, 10)))


def _block_index(spark, sf_dir):
    import uuid

    docs = tb.search_docs(spark, sf_dir)
    path = f"{shared_dir(spark)}/blocks_{uuid.uuid4().hex}"
    BlockIndex.save(docs, path)
    return BlockIndex.load(spark, path, docs.count())


@query(
    "h1_bounded_blocks",
    f"WITH {q.DOCS}, {q.PASSAGES}, {q.bm25(10)} SELECT query_id, pos, round(score, 6) AS score, rank FROM bm",
)
def bounded_blocks(spark, sf_dir):
    """From a saved index, of which only blocks are read that can hold a result."""
    return scored(_block_index(spark, sf_dir).search(tb.passage_queries(spark, sf_dir, 10)))


@query(
    "f11_bounded_blocks",
    f"WITH {q.DOCS}, {q.PASSAGES}, {q.bm25(6)} SELECT query_id, pos, round(score, 6) AS score, rank FROM bm "
    f"WHERE rank <= query_id % 7",
)
def bounded_blocks_own_top_k(spark, sf_dir):
    queries = tb.passage_queries(spark, sf_dir).withColumn("top_k", F.pmod("query_id", F.lit(7)).cast("int"))
    return scored(_block_index(spark, sf_dir).search(queries))


@query(
    "a12_segmented_index",
    f"WITH {q.DOCS}, {q.PASSAGES}, {q.bm25(10)} SELECT query_id, pos, round(score, 6) AS score, rank FROM bm",
)
def segmented_index(spark, sf_dir):
    """Half of the documents indexed, a quarter added twice, the two smallest segments merged: the index of all."""
    import uuid

    docs = tb.search_docs(spark, sf_dir)
    n = docs.count()
    index = SegmentedIndex.create(spark, f"{shared_dir(spark)}/segments_{uuid.uuid4().hex}")
    for low, high in ((0, n // 2), (n // 2, 3 * n // 4), (3 * n // 4, n)):
        index = index.append(docs.where((F.col("pos") >= low) & (F.col("pos") < high)))
    index = SegmentedIndex.open(spark, index.merge(spark).path)
    return scored(index.index(spark).search(tb.passage_queries(spark, sf_dir, 10)))


@query(
    "d5_result_documents",
    f"WITH {q.DOCS}, {q.PASSAGES}, {q.bm25(10)} SELECT query_id, rank, model_id, title, pipeline_tag, "
    f"array_to_string(tags, '|') AS tags, md5(substr(body, 1, 500)) AS snippet_md5 FROM bm JOIN d USING (pos)",
)
def result_documents(spark, sf_dir):
    docs = tb.search_docs(spark, sf_dir)
    retriever = fl.lexical_retriever(LexicalIndex.build(docs))
    rows = fl.find(tb.passage_queries(spark, sf_dir, 10), docs, retriever)
    return rows.select(
        "query_id", "rank", "model_id", "title", "pipeline_tag",
        F.array_join("tags", "|").alias("tags"), F.md5("snippet").alias("snippet_md5"),
    )


# ---- dense ----------------------------------------------------------------

VECTORS = "v AS (SELECT vec_id AS pos, embedding, label FROM embeddings)"


@query(
    "i1_exact_top_k",
    f"WITH {VECTORS}, {q.MEANS}, {q.dense(10, 'v', queries='lq')} "
    f"SELECT query_id, pos, round(score, 6) AS score, rank FROM dn",
)
def exact_top_k(spark, sf_dir):
    vecs = tb.vectors(spark, sf_dir)
    return scored(dn.search(vecs, tb.label_queries(vecs, 10), dim=DIM))


@query(
    "i1_exact_top_k_l2",
    f"WITH {VECTORS}, {q.MEANS}, {q.dense(10, 'v', 'l2', 'lq')} "
    f"SELECT query_id, pos, round(score, 6) AS score, rank FROM dn",
)
def exact_top_k_l2(spark, sf_dir):
    vecs = tb.vectors(spark, sf_dir)
    return scored(dn.search(vecs, tb.label_queries(vecs, 10), dim=DIM, metric="l2"))


@query(
    "d3_grid_search",
    f"WITH {VECTORS}, {q.MEANS}, {q.dense(25, 'v', queries='lq')} "
    f"SELECT query_id, pos, round(score, 6) AS score, rank FROM dn",
)
def grid_search(spark, sf_dir):
    """The same search the way a batch too large to broadcast takes."""
    vecs = tb.vectors(spark, sf_dir)
    return scored(dn.search(vecs, tb.label_queries(vecs, 25), dim=DIM, broadcast_values=0))


@query(
    "i2_dense_results",
    f"WITH {q.VECTOR_DOCS}, {q.MEANS}, {q.dense(10, 'd', queries='lq')} SELECT query_id, rank, model_id, title, "
    f"round(score, 6) AS score, 'inner_product' AS dense_metric, 'higher_is_better' AS score_direction "
    f"FROM dn JOIN d USING (pos)",
)
def dense_results(spark, sf_dir):
    docs = tb.search_docs_with_vectors(spark, sf_dir)
    queries = tb.label_queries(tb.vectors(spark, sf_dir), 10)
    rows = fl.find(queries, docs, fl.dense_retriever(docs, DIM))
    return fl.score_direction(rows, "inner_product").select(
        "query_id", "rank", "model_id", "title", F.round("score", 6).alias("score"),
        "dense_metric", "score_direction",
    )


@query(
    "i2_result_metadata",
    f"WITH {q.VECTOR_DOCS}, {q.MEANS}, {q.dense(10, 'd', queries='lq')} SELECT query_id, rank, source AS library, n_chars AS downloads, "
    f"'s' || quality AS task, md5(text) AS body_md5, CASE WHEN pos % 2 = 0 THEN 'own' ELSE lang END AS first_tag, "
    f"'inner_product' AS metric, 'higher_is_better' AS direction, CASE WHEN quality IS NULL THEN 8 ELSE 9 END AS entries "
    f"FROM dn JOIN documents ON doc_id = pos LEFT JOIN labels l ON l.doc_id = pos",
)
def result_metadata(spark, sf_dir):
    """Typed metadata of artifact rows, later rows over them, merged into each result."""
    raw = tb.table(spark, sf_dir, "documents")
    vecs = tb.vectors(spark, sf_dir)
    rows = raw.join(vecs.select(F.col("pos").alias("doc_id"), F.lit(1).alias("has_vector")), "doc_id").select(
        F.col("doc_id").alias("pos"), F.concat("source", F.lit("/doc-"), "doc_id").alias("doc_id"), F.col("text").alias("modelCard"),
        F.array("lang", "source").alias("tags"), F.col("source").alias("library_name"), F.col("n_chars").alias("downloads"),
        F.lit("none").alias("pipeline_tag"),
    )
    docs = cd.documents(rows)
    known = vecs.join(rows.select("pos"), "pos", "left_semi")
    found = fl.find(tb.label_queries(vecs, 10), docs, fl.dense_retriever(known, DIM))
    # Later rows: a task for labelled documents, tags for every second one.
    labels = tb.table(spark, sf_dir, "labels").select(F.col("doc_id").alias("pos"), "quality")
    own = F.create_map(F.lit("tags"), F.to_variant_object(F.array(F.lit("own"))))
    task = F.create_map(F.lit("quality"), F.col("quality").cast("variant"), F.lit("pipeline_tag"), F.concat(F.lit("s"), "quality").cast("variant"))
    none = F.create_map().cast("map<string, variant>")
    later = rows.select("pos").join(labels, "pos", "left").select(
        "pos", F.map_concat(F.when(F.col("pos") % 2 == 0, own).otherwise(none), F.when(F.col("quality").isNotNull(), task).otherwise(none)).alias("row_metadata")
    )
    merged = fl.with_metadata(found, later, "inner_product")

    def read(name: str, kind: str = "string"):
        return F.variant_get(F.col("metadata")[name], "$", kind)

    return merged.select(
        "query_id", "rank", read("library_name").alias("library"), read("downloads", "bigint").alias("downloads"),
        F.when(read("pipeline_tag") != "none", read("pipeline_tag")).alias("task"), F.md5(read("body")).alias("body_md5"),
        F.variant_get(F.col("metadata")["tags"], "$[0]", "string").alias("first_tag"), read("dense_metric").alias("metric"),
        read("score_direction").alias("direction"), F.size("metadata").alias("entries"),
    )


@query(
    "c3_known_positions",
    f"WITH {VECTORS}, {q.MEANS}, {q.dense(50, 'v', queries='lq')}, k AS (SELECT query_id, pos, dn.rank FROM dn "
    f"JOIN labels ON doc_id = pos) SELECT query_id, pos, row_number() OVER (PARTITION BY query_id ORDER BY rank) AS rank FROM k",
)
def known_positions(spark, sf_dir):
    """Neighbours that no labelled document stands for drop out; ranks close up."""
    from ..operators.ordering import rank_groups

    vecs = tb.vectors(spark, sf_dir)
    found = dn.search(vecs, tb.label_queries(vecs, 50), dim=DIM).withColumnRenamed("rank", "raw_rank")
    known = tb.table(spark, sf_dir, "labels").select(F.col("doc_id").alias("pos"))
    kept = rank_groups(found.join(known, "pos"), ["query_id"], [F.col("raw_rank")])
    return kept.select("query_id", "pos", "rank")


@query(
    "i6_unit_vectors",
    "SELECT vec_id, i, round(x / greatest(sqrt(list_sum([CAST(y AS DOUBLE) * y FOR y IN embedding])), 1e-12), 6) AS x FROM "
    "(SELECT vec_id, embedding, unnest(embedding) AS x, generate_subscripts(embedding, 1) - 1 AS i FROM "
    "(SELECT vec_id, [CAST(CAST(e AS DOUBLE) * (1 + label) AS FLOAT) FOR e IN embedding] AS embedding FROM embeddings))",
)
def unit_vectors(spark, sf_dir):
    """Vectors stretched by their label, brought back to unit length."""
    stretched = F.transform("embedding", lambda x: (x.cast("double") * (F.col("label") + 1)).cast("float"))
    rows = tb.vectors(spark, sf_dir).select(F.col("pos").alias("vec_id"), stretched.alias("v"))
    return rows.select("vec_id", F.posexplode(vx.unit(F.col("v"))).alias("i", "x")).select(
        "vec_id", "i", F.round("x", 6).alias("x")
    )


def _label_centroids(vecs) -> np.ndarray:
    """Label means as given list centres; one row per label."""
    rows = tb.label_queries(vecs).orderBy("query_id").select("embedding").toArrow()
    return dn.as_matrix(rows.column(0), DIM)


NPROBE = 3
PROBED = f"""
cen AS (SELECT row_number() OVER (ORDER BY query_id) - 1 AS list_no, qv AS c FROM lq),
home AS (SELECT pos, embedding, list_no FROM v CROSS JOIN cen QUALIFY row_number() OVER (
  PARTITION BY pos ORDER BY round(list_inner_product(CAST(embedding AS DOUBLE[]), c), 9) DESC, list_no) = 1),
probe AS (SELECT query_id, qv, list_no FROM lq CROSS JOIN cen QUALIFY row_number() OVER (
  PARTITION BY query_id ORDER BY round(list_inner_product(qv, c), 9) DESC, list_no) <= {NPROBE})"""


@query(
    "i3_given_lists",
    f"WITH {VECTORS}, {q.MEANS}, {PROBED} SELECT query_id, pos, round(s, 6) AS score, rank FROM ("
    f"SELECT query_id, pos, round(list_inner_product(CAST(embedding AS DOUBLE[]), qv), 9) AS s, row_number() OVER ("
    f"PARTITION BY query_id ORDER BY round(list_inner_product(CAST(embedding AS DOUBLE[]), qv), 9) DESC, pos) AS rank "
    f"FROM probe JOIN home USING (list_no)) WHERE rank <= 10",
)
def given_lists(spark, sf_dir):
    """Inverted lists around the label means; every query probes three."""
    vecs = tb.vectors(spark, sf_dir)
    index = ListIndex.build(vecs, centroids=_label_centroids(vecs))
    return scored(index.search(tb.label_queries(vecs, 10), nprobe=NPROBE))


@query(
    "d4_list_sizes",
    f"WITH {VECTORS}, {q.MEANS}, {PROBED} SELECT query_id, list_no, count(*) AS members FROM probe JOIN home USING (list_no) GROUP BY ALL",
)
def probed_list_sizes(spark, sf_dir):
    """How many vectors each query meets in each list it probes."""
    vecs = tb.vectors(spark, sf_dir)
    index = ListIndex.build(vecs, centroids=_label_centroids(vecs))
    sizes = index.table.groupBy(F.get("lists", F.lit(0)).cast("long").alias("list_no")).agg(
        F.count("*").alias("members")
    )
    return index.probes(tb.label_queries(vecs, 10), NPROBE).drop("place").join(sizes, "list_no")


@query(
    "i3_all_lists_probed",
    f"WITH {VECTORS}, {q.MEANS}, {q.dense(10, 'v', queries='lq')} "
    f"SELECT query_id, pos, round(score, 6) AS score, rank FROM dn",
)
def all_lists_probed(spark, sf_dir):
    """Trained lists, all of them probed: equal to the exact search."""
    vecs = tb.vectors(spark, sf_dir)
    index = ListIndex.build(vecs, nlist=16)
    return scored(index.search(tb.label_queries(vecs, 10), nprobe=16))


def _recall_row(found, truth):
    return recall(found, truth).agg(
        F.count("*").alias("queries"), F.round(F.avg("recall"), 6).alias("recall")
    )


@query(
    "i3_trained_lists",
    f"WITH {VECTORS}, {q.MEANS}, {q.dense(10, 'v', queries='lq')} "
    f"SELECT query_id, pos, round(score, 6) AS score, rank FROM dn",
)
def trained_lists(spark, sf_dir):
    """Trained lists, read until no other can hold a result: equal to the exact search."""
    vecs = tb.vectors(spark, sf_dir)
    queries = settle_table(tb.label_queries(vecs, 10))
    return scored(ListIndex.build(vecs, nlist=16).search_exact(queries, nprobe=4))


@query(
    "i3_trained_lists_l2",
    f"WITH {VECTORS}, {q.MEANS}, {q.dense(10, 'v', 'l2', 'lq')} "
    f"SELECT query_id, pos, round(score, 6) AS score, rank FROM dn",
)
def trained_lists_l2(spark, sf_dir):
    vecs = tb.vectors(spark, sf_dir)
    queries = settle_table(tb.label_queries(vecs, 10))
    return scored(ListIndex.build(vecs, nlist=16, metric="l2").search_exact(queries, nprobe=4))


@query(
    "i5_saved_exact_search",
    f"WITH {VECTORS}, n AS (SELECT pos AS query_id, CAST(embedding AS DOUBLE[]) AS qv FROM v WHERE pos % 25 = 0) "
    f"SELECT query_id, v.pos, round(round(list_inner_product(CAST(embedding AS DOUBLE[]), qv), 9), 6) AS score, "
    f"row_number() OVER (PARTITION BY query_id ORDER BY round(list_inner_product(CAST(embedding AS DOUBLE[]), qv), 9) DESC, v.pos) AS rank "
    f"FROM n CROSS JOIN v QUALIFY rank <= 5",
)
def saved_exact_search(spark, sf_dir):
    """Every 25th vector asked of an index that was written and opened again, each list read only where it may hold a result."""
    import uuid

    vecs = tb.vectors(spark, sf_dir)
    path = f"{shared_dir(spark)}/lists_{uuid.uuid4().hex}"
    ListIndex.build(vecs, nlist=16).save(path)
    queries = vecs.where("pos % 25 = 0").select(F.col("pos").alias("query_id"), "embedding", F.lit(5).alias("top_k"))
    index = ListIndex.load(spark, path, DIM, "inner_product")
    return scored(index.search_exact(settle_table(queries), nprobe=2))


@query("i3_product_quantised")
def product_quantised(spark, sf_dir):
    vecs = tb.vectors(spark, sf_dir)
    queries = settle_table(tb.label_queries(vecs, 10))
    index = ListIndex.build(vecs, nlist=8, m=8, nbits=4)
    return _recall_row(index.search(queries, nprobe=8), dn.search(vecs, queries, dim=DIM))


@query("i4_random_projections")
def random_projections(spark, sf_dir):
    vecs = tb.vectors(spark, sf_dir)
    queries = settle_table(tb.label_queries(vecs, 10))
    found = ProjectionIndex.build(vecs, DIM, tables=32, width=0.05).search(queries)
    return _recall_row(found, dn.search(vecs, queries, dim=DIM))


@query(
    "i5_saved_list_index",
    f"WITH {VECTORS}, {q.MEANS}, {PROBED} SELECT query_id, pos, round(s, 6) AS score, rank FROM ("
    f"SELECT query_id, pos, round(list_inner_product(CAST(embedding AS DOUBLE[]), qv), 9) AS s, row_number() OVER ("
    f"PARTITION BY query_id ORDER BY round(list_inner_product(CAST(embedding AS DOUBLE[]), qv), 9) DESC, pos) AS rank "
    f"FROM probe JOIN home USING (list_no)) WHERE rank <= 10",
)
def saved_list_index(spark, sf_dir):
    """An index written by list, opened again and read only where it is probed."""
    import uuid

    vecs = tb.vectors(spark, sf_dir)
    path = f"{shared_dir(spark)}/lists_{uuid.uuid4().hex}"
    ListIndex.build(vecs, centroids=_label_centroids(vecs)).save(path)
    queries = settle_table(tb.label_queries(vecs, 10))
    index = ListIndex.load(spark, path, DIM, "inner_product").pruned(queries, NPROBE)
    return scored(index.search(queries, nprobe=NPROBE))


@query("i7_index_comparison")
def index_comparison(spark, sf_dir):
    from ..plans.experiments import compare_indexes

    vecs = tb.vectors(spark, sf_dir)
    queries = settle_table(tb.label_queries(vecs, 10))
    return compare_indexes(vecs, queries, dim=DIM, nlist=16, nprobe=4, m=8, nbits=4)


# ---- encoding -------------------------------------------------------------


def _card_texts(spark, sf_dir):
    return tb.cards(spark, sf_dir).select("pos", "model_id", tx.card_text().alias("text"))


@query("m1_encoded_cards")
def encoded_cards(spark, sf_dir):
    """Every card as a unit vector of hashed term weights."""
    rows = _card_texts(spark, sf_dir)
    out = HashedTermEncoder(384).fit(rows).encode(rows)
    norm = F.round(vx.norm(F.col("embedding")), 5)
    return out.select("pos", F.size("embedding").alias("dim"), norm.alias("norm"))


class DigestModel:
    """Stand-in encoder: counts of md5-bucketed tokens; the check SQL repeats it."""

    def __init__(self, dim: int = 16):
        self.dim = dim

    def encode(self, texts):
        import hashlib
        import re

        out = np.zeros((len(texts), self.dim))
        for row, text in enumerate(texts):
            for word in re.findall("[a-z0-9а-я]+", (text or "").lower()):
                out[row, int(hashlib.md5(word.encode()).hexdigest()[0], 16) % self.dim] += 1
        return out


@query(
    "m1_model_encoder",
    f"WITH w AS (SELECT doc_id, unnest({q.tokens('text')}) AS t FROM documents), "
    f"b AS (SELECT doc_id AS pos, strpos('0123456789abcdef', substr(md5(t), 1, 1)) - 1 AS i, count(*) AS n FROM w GROUP BY ALL) "
    f"SELECT pos, i, round(CAST(CAST(n / sqrt(sum(n * n) OVER (PARTITION BY pos)) AS FLOAT) AS DOUBLE), 5) AS x FROM b",
)
def model_encoder(spark, sf_dir):
    rows = tb.table(spark, sf_dir, "documents").select(F.col("doc_id").alias("pos"), "text")
    out = encode_with_model(rows, DigestModel)
    return (
        out.select("pos", F.posexplode("embedding").alias("i", "x"))
        .where(F.col("x") != 0)
        .select("pos", "i", F.round(F.col("x").cast("double"), 5).alias("x"))
    )


@query("i2_encoded_search")
def encoded_search(spark, sf_dir):
    """Text queries through the default encoder against encoded documents."""
    docs = tb.search_docs(spark, sf_dir)
    texts = docs.select("pos", F.concat_ws(" ", "title", "body").alias("text"))
    encoder = HashedTermEncoder(384).fit(texts)
    vectors = settle_table(encoder.encode(texts).select("pos", "embedding"))
    retriever = fl.dense_retriever(vectors, 384, encode=encoder.encode)
    return scored(retriever(QueryBatch.of(tb.passage_queries(spark, sf_dir, 10))))
