"""Sources, sinks, checks, sampling and cleaning of the card table."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..functions import fixed_values as fv
from ..operators import cards as cd
from ..operators import dense as dn
from ..operators.encode import HashedTermEncoder, encode_to_table, not_yet_encoded
from ..operators.ordering import first_rows, number_rows, random_rows
from ..session import shared_dir
from ..sources import datasets as ds
from ..sources import sinks
from ..sources import tables as tb
from . import sql as q
from .registry import query
from .text import CARD_TEXT


def new_path(spark, suffix: str = "") -> str:
    return f"{shared_dir(spark)}/data_{uuid.uuid4().hex}{suffix}"


CARD_ROWS = (
    f"WITH {q.CARDS} SELECT model_id, likes, downloads, tags, pipeline_tag, md5(modelCard) AS card_md5 FROM raw"
)


def _card_rows(rows):
    return rows.select(
        "model_id", "likes", "downloads", "tags", "pipeline_tag", F.md5("modelCard").alias("card_md5")
    )


def _as_text(spark, sf_dir):
    rows = tb.raw_cards(spark, sf_dir)
    return rows.select(*[F.col(c).cast("string").alias(c) for c in rows.columns])


CARD_SCHEMA = (
    "pos string, model_id string, name string, likes string, downloads string, tags string, "
    "pipeline_tag string, library_name string, createdAt string, languages string, modelCard string"
)


@query("a1_read_csv", CARD_ROWS)
def read_csv(spark, sf_dir):
    path = new_path(spark, ".csv")
    sinks.write_results(_as_text(spark, sf_dir), path)
    return _card_rows(ds.read_dataset(spark, path, schema=CARD_SCHEMA))


@query("a1_read_tsv", CARD_ROWS)
def read_tsv(spark, sf_dir):
    path = new_path(spark, ".tsv")
    _as_text(spark, sf_dir).write.csv(
        path, sep="\t", header=True, quote='"', escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
    )
    return _card_rows(ds.read_dataset(spark, path, schema=CARD_SCHEMA))


@query("a1_read_jsonl", CARD_ROWS)
def read_jsonl(spark, sf_dir):
    path = new_path(spark, ".jsonl")
    _as_text(spark, sf_dir).write.json(path)
    return _card_rows(ds.read_dataset(spark, path, schema=CARD_SCHEMA))


@query("a1_read_parquet", CARD_ROWS)
def read_parquet(spark, sf_dir):
    path = new_path(spark, ".parquet")
    sinks.write_table(_as_text(spark, sf_dir), path)
    return _card_rows(ds.read_dataset(spark, path))


@query(
    "a2_card_columns",
    f"WITH {q.CARDS} SELECT pos, model_id, likes, downloads, tags, pipeline_tag, library_name, createdAt, languages, "
    f"md5(modelCard) AS card_md5 FROM raw",
)
def card_columns(spark, sf_dir):
    rows = ds.card_columns(tb.raw_cards(spark, sf_dir))
    return rows.withColumn("card_md5", F.md5("modelCard")).drop("modelCard")


@query(
    "a3_vector_checks",
    "SELECT count(*) AS vectors, count(DISTINCT vec_id) AS distinct_ids, min(len(embedding))::INT AS min_dim, "
    "max(len(embedding))::INT AS max_dim, count(*) FILTER (embedding IS NULL) AS null_vectors, 0::BIGINT AS bad_values, "
    "64 AS expected_dim FROM embeddings",
)
def vector_checks(spark, sf_dir):
    return dn.vector_problems(tb.vectors(spark, sf_dir), 64)


@query(
    "d1_artifact_counts",
    "SELECT (SELECT count(*) FROM embeddings) AS vectors_rows, (SELECT count(*) FROM documents) AS ids_rows, "
    "(SELECT count(*) FROM documents) AS metadata_rows, "
    "(SELECT count(*) FROM documents FULL JOIN embeddings ON doc_id = vec_id WHERE doc_id IS NULL OR vec_id IS NULL) AS unmatched",
)
def artifact_counts(spark, sf_dir):
    docs = tb.search_docs(spark, sf_dir)
    return ds.artifact_counts(tb.vectors(spark, sf_dir), docs.select("pos"), docs.select("pos", "title"))


@query(
    "a4_search_documents",
    f"WITH {q.CARDS} SELECT pos, model_id AS doc_id, model_id, name AS title, md5({q.strip('modelCard')}) AS body_md5, "
    f"'''' || lang || '''|''' || source || '''' AS tags, pipeline_tag FROM raw",
)
def search_documents(spark, sf_dir):
    """Slim artifact rows; texts and titles come from the processed data set."""
    raw = tb.raw_cards(spark, sf_dir)
    rows = raw.select("pos", F.col("model_id").alias("doc_id"), "pipeline_tag")
    out = cd.documents(rows, source=raw.drop("pos"))
    return out.withColumn("body_md5", F.md5("body")).withColumn("tags", F.array_join("tags", "|")).drop("body", "metadata")


@query(
    "a4_alignment",
    "SELECT (SELECT count(*) FROM embeddings)::BIGINT AS id_rows, (SELECT count(*) FROM documents)::BIGINT AS source_rows, "
    "(SELECT count(*) FROM embeddings WHERE vec_id NOT IN (SELECT doc_id FROM documents)) AS without_source, "
    "(SELECT count(*) FROM documents WHERE doc_id NOT IN (SELECT vec_id FROM embeddings)) AS without_id, 0::BIGINT AS repeated",
)
def alignment(spark, sf_dir):
    ids = tb.vectors(spark, sf_dir).select(F.col("pos").alias("doc_id"))
    source = tb.search_docs(spark, sf_dir).select(F.col("pos").alias("model_id"))
    return cd.alignment(ids, source)


@query(
    "a5_relevance_file",
    f"SELECT {q.strip('text')} AS query, 'c' || conv_id || '|t' || turn AS ids FROM conversations",
)
def relevance_file(spark, sf_dir):
    """Labels written as CSV with quotes and line breaks, and read back."""
    rows = tb.table(spark, sf_dir, "conversations").select(
        F.col("text").alias("query"),
        F.concat(F.lit("c"), "conv_id", F.lit("|t"), "turn").alias("relevant_model_ids"),
        F.lit("derived").alias("label_source"),
    )
    path = new_path(spark)
    sinks.write_results(rows, path)
    from ..operators.labels import parse_qrels

    back = parse_qrels(ds.read_qrels(spark, path))
    return back.select("query", F.array_join("ids", "|").alias("ids"))


@query(
    "a7_slim_metadata",
    f"WITH {q.CARDS} SELECT pos AS embedding_row, model_id, likes, downloads, array_to_string(tags, '|') AS tags, pipeline_tag, "
    f"library_name, CAST(createdAt AS VARCHAR) AS createdAt, array_to_string(languages, '|') AS languages, "
    f"length({CARD_TEXT}) AS text_length_chars FROM cards",
)
def slim_metadata(spark, sf_dir):
    out = cd.slim_metadata(tb.cards(spark, sf_dir))
    return out.withColumns(
        {
            "tags": F.array_join("tags", "|"),
            "languages": F.array_join("languages", "|"),
            "createdAt": F.col("createdAt").cast("string"),
        }
    )


@query(
    "a8_text_samples",
    f"WITH {q.CARDS} SELECT pos AS embedding_row, model_id, md5({CARD_TEXT}) AS text_md5 FROM cards ORDER BY pos LIMIT 20",
)
def text_samples(spark, sf_dir):
    out = cd.text_samples(tb.cards(spark, sf_dir))
    return out.select("embedding_row", "model_id", F.md5("text").alias("text_md5"))


@query(
    "a11_not_yet_encoded",
    "SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT vec_id FROM embeddings)",
)
def pending_rows(spark, sf_dir):
    docs = tb.table(spark, sf_dir, "documents").select("doc_id")
    done = tb.table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("doc_id"))
    return not_yet_encoded(docs, done, "doc_id")


@query("a11_resumed_encoding", "SELECT doc_id, 64 AS dim FROM documents")
def resumed_encoding(spark, sf_dir):
    """Documents that have a vector are there already; a resumed run adds the others."""
    docs = tb.table(spark, sf_dir, "documents").select("doc_id", "text")
    done = tb.table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("doc_id"))
    encoder = HashedTermEncoder(64).fit(docs)

    def encode(rows):
        return encoder.encode(rows).select("doc_id", "embedding")

    path = new_path(spark)
    encode_to_table(docs.join(done, "doc_id", "left_semi"), encode, path, key="doc_id")
    out = encode_to_table(docs, encode, path, resume=True, dim=64, key="doc_id")
    return out.select("doc_id", F.size("embedding").alias("dim"))


# ---- filters, sampling, cleaning ------------------------------------------

# Strata sizes follow the table: an eighth popular, three eighths random.
SAMPLE = f"""
us AS (SELECT pos, model_id, likes, downloads, modelCard FROM cards WHERE length(modelCard) > 20
       AND NOT regexp_matches(modelCard, {q.quoted(fv.AUTO_CARD)})),
n AS (SELECT count(*) // 8 AS p, 3 * count(*) // 8 AS r FROM us),
pop AS (SELECT *, row_number() OVER (ORDER BY downloads DESC, likes DESC, pos) - 1 AS place FROM us QUALIFY place < (SELECT p FROM n)),
rnd AS (SELECT *, row_number() OVER (ORDER BY {q.sample_key('pos')}, pos) - 1 AS place
        FROM us WHERE pos NOT IN (SELECT pos FROM pop) QUALIFY place < (SELECT r FROM n)),
smp AS (SELECT *, 0 AS stratum FROM pop UNION ALL SELECT *, 1 FROM rnd)"""


def _sample(spark, sf_dir):
    usable = cd.usable(cd.typed_numbers(tb.raw_cards(spark, sf_dir)))
    n = usable.count()
    return cd.popular_and_random(usable, n // 8, 3 * n // 8)


@query(
    "f4_popularity_order",
    f"WITH {q.CARDS} SELECT pos, row_number() OVER (ORDER BY downloads DESC, likes DESC, pos) - 1 AS place FROM cards",
)
def popularity_order(spark, sf_dir):
    rows = tb.cards(spark, sf_dir).select("pos", "downloads", "likes")
    order = [F.desc("downloads"), F.desc("likes"), F.col("pos")]
    return number_rows(rows, order, "place").select("pos", "place")


@query("f5_popular_and_random", f"WITH {q.CARDS}, {SAMPLE} SELECT pos, stratum, place FROM smp")
def popular_and_random(spark, sf_dir):
    return _sample(spark, sf_dir).select("pos", "stratum", "place")


@query("g3_stratum_sizes", f"WITH {q.CARDS}, {SAMPLE} SELECT stratum, count(*) AS cards, sum(downloads)::BIGINT AS downloads FROM smp GROUP BY stratum")
def stratum_sizes(spark, sf_dir):
    rows = _sample(spark, sf_dir).groupBy("stratum")
    return rows.agg(F.count("*").alias("cards"), F.sum("downloads").cast("long").alias("downloads"))


@query(
    "d10_rest_after_popular",
    f"WITH {q.CARDS}, {SAMPLE} SELECT pos FROM us WHERE pos NOT IN (SELECT pos FROM pop)",
)
def rest_after_popular(spark, sf_dir):
    usable = cd.usable(cd.typed_numbers(tb.raw_cards(spark, sf_dir))).select("pos", "downloads", "likes")
    top = first_rows(usable, cd.POPULARITY, usable.count() // 8, "pos")
    return usable.select("pos").join(top.select("pos"), "pos", "left_anti")


@query(
    "f6_first_of_repeats",
    f"WITH {q.CARDS}, {SAMPLE} SELECT pos, stratum, place FROM smp QUALIFY row_number() OVER (PARTITION BY modelCard ORDER BY stratum, place) = 1",
)
def first_of_repeats(spark, sf_dir):
    """Equal texts stand in for equal ids, which this table does not have."""
    rows = _sample(spark, sf_dir)
    return cd.without_repeats(rows, ("modelCard",)).select("pos", "stratum", "place")


@query(
    "f7_random_rows",
    f"SELECT pos FROM (SELECT vec_id AS pos FROM embeddings) ORDER BY {q.sample_key('pos')}, pos "
    f"LIMIT (SELECT count(*) // 3 FROM embeddings)",
)
def random_third(spark, sf_dir):
    vecs = tb.vectors(spark, sf_dir).select("pos")
    return random_rows(vecs, vecs.count() // 3).select("pos")


@query(
    "a6_clean_cards",
    f"WITH {q.CARDS}, {SAMPLE} SELECT model_id, md5({q.clean('modelCard')}) AS clean_md5 FROM smp",
)
def clean_cards(spark, sf_dir):
    """Filter, sample, de-duplicate and clean, written as a table and read back."""
    raw = tb.raw_cards(spark, sf_dir)
    n = cd.usable(raw).count()
    path = new_path(spark, ".parquet")
    sinks.write_table(cd.prepare(raw, n // 8, 3 * n // 8), path)
    return ds.read_dataset(spark, path).select("model_id", F.md5("modelCard").alias("clean_md5"))
