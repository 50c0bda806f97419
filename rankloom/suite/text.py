"""Scalar functions and predicates over the whole text tables.

Long texts are reported as md5 digests, so that a difference anywhere shows.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import fixed_values as fv
from ..functions import text as tx
from ..operators import cards as cd
from ..sources import tables as tb
from . import sql as q
from .registry import query

NO_ITEMS = "CAST([] AS VARCHAR[])"


@query(
    "b1_tokenize",
    f"SELECT doc_id, len(w) AS n_tokens, len(list_distinct(w)) AS n_distinct, "
    f"md5(array_to_string(w, ' ')) AS tokens_md5 FROM (SELECT doc_id, {q.tokens('text')} AS w FROM documents)",
)
def tokenize(spark, sf_dir):
    docs = tb.table(spark, sf_dir, "documents").select("doc_id", "text")
    rows = docs.select("doc_id", tx.tokens("text").alias("w"))
    return rows.select(
        "doc_id",
        F.size("w").alias("n_tokens"),
        F.size(F.array_distinct("w")).alias("n_distinct"),
        F.md5(F.array_join("w", " ")).alias("tokens_md5"),
    )


@query(
    "b2_clean_card",
    f"SELECT doc_id, length(c) AS n_chars_clean, md5(c) AS clean_md5 FROM "
    f"(SELECT doc_id, {q.clean('text')} AS c FROM documents)",
)
def clean_card(spark, sf_dir):
    docs = tb.table(spark, sf_dir, "documents").select("doc_id", "text")
    rows = docs.select("doc_id", tx.clean_card("text").alias("c"))
    return rows.select("doc_id", F.length("c").alias("n_chars_clean"), F.md5("c").alias("clean_md5"))


@query(
    "b2_clean_pages",
    f"SELECT page_id, length(c) AS n_chars_clean, md5(c) AS clean_md5 FROM "
    f"(SELECT page_id, {q.clean('html')} AS c FROM pages)",
)
def clean_pages(spark, sf_dir):
    rows = tb.table(spark, sf_dir, "pages").select("page_id", "html").select(
        "page_id", tx.clean_card("html").alias("c")
    )
    return rows.select("page_id", F.length("c").alias("n_chars_clean"), F.md5("c").alias("clean_md5"))


@query(
    "b3_compact_text",
    f"SELECT doc_id, length(c) AS n_compact, md5(c) AS compact_md5 FROM "
    f"(SELECT doc_id, {q.compact('text', fv.CARD_TEXT_CHARS)} AS c FROM documents)",
)
def compact_text(spark, sf_dir):
    docs = tb.table(spark, sf_dir, "documents").select("doc_id", "text")
    rows = docs.select("doc_id", tx.compact("text", fv.CARD_TEXT_CHARS).alias("c"))
    return rows.select("doc_id", F.length("c").alias("n_compact"), F.md5("c").alias("compact_md5"))


# List texts of three shapes by document: quoted list, comma list, empty word.
SHAPED = (
    "CASE pos % 3 WHEN 0 THEN tags WHEN 1 THEN ' ' || pipeline_tag || ' , ' || library_name || ',' "
    "ELSE 'None' END"
)


def _shaped_lists(spark, sf_dir):
    shape = F.pmod("pos", F.lit(3))
    value = (
        F.when(shape == 0, F.col("tags"))
        .when(shape == 1, F.concat(F.lit(" "), "pipeline_tag", F.lit(" , "), "library_name", F.lit(",")))
        .otherwise("None")
    )
    return tb.raw_cards(spark, sf_dir).select("pos", value.alias("value"))


# List literals by document: a template in Python's or JSON's notation, where L stands for the language and S for the
# source, and the items that Python's str() gives, | between them; None where it is no Python list literal.
LITERALS = (
    ("['L', 'S']", "L|S"),
    ('["L", \'S\', ]', "L|S"),
    ("[ 'L' ,'it\\'s S' ]", "L|it's S"),
    ('["it\'s", "L, S"]', "it's|L, S"),
    ("['L' 'S', None, True]", "LS|None|True"),
    ("[1, -2.50, 1_000, 1e3, 'S']", "1|-2.5|1000|1000.0|S"),
    ("['\\x41\\u00e9\\tL', ('S', 1), [2]]", "Aé\tL|('S', 1)|[2]"),
    ("[]", ""),
    ("['L', 'S'", None),
    ("['L'] S", None),
    ("['L', , 'S']", None),
    ("['L' : 'S']", None),
    ('[null, "L"]', None),
    ("['L', 'S]", None),
)


def _literal_sql(of: int) -> str:
    """Per document, its template filled in (0) or its items (1)."""
    cases = []
    for n, pair in enumerate(LITERALS):
        text = "NULL" if pair[of] is None else "'" + pair[of].replace("'", "''") + "'"
        cases.append(f"WHEN {n} THEN replace(replace({text}, 'L', lang), 'S', source)")
    return f"CASE doc_id % {len(LITERALS)} {' '.join(cases)} END"


def _literals(spark, sf_dir):
    docs = tb.table(spark, sf_dir, "documents").select("doc_id", "lang", "source")
    templates = F.array(*[F.lit(text) for text, _ in LITERALS])
    chosen = F.get(templates, F.pmod("doc_id", F.lit(len(LITERALS))).cast("int"))
    return docs.select("doc_id", F.replace(F.replace(chosen, F.lit("L"), "lang"), F.lit("S"), "source").alias("value"))


@query(
    "b4_read_list",
    f"WITH {q.CARDS} SELECT pos, CASE pos % 3 WHEN 0 THEN lang || '|' || source "
    f"WHEN 1 THEN pipeline_tag || '|' || library_name ELSE '' END AS items FROM raw",
)
def read_list(spark, sf_dir):
    return _shaped_lists(spark, sf_dir).select(
        "pos", F.array_join(tx.read_list("value"), "|").alias("items")
    )


@query(
    "b4_list_literals",
    f"""SELECT doc_id, coalesce({_literal_sql(1)}, array_to_string(
      [trim(p) FOR p IN string_split({_literal_sql(0)}, ',') IF trim(p) <> ''], '|')) AS items FROM documents""",
)
def list_literals(spark, sf_dir):
    return _literals(spark, sf_dir).select("doc_id", F.array_join(tx.read_list("value"), "|").alias("items"))


@query(
    "b5_read_tags",
    f"WITH {q.CARDS} SELECT pos, array_to_string([trim(p) FOR p IN string_split(trim(CASE WHEN v = 'None' "
    f"THEN '' ELSE trim(v) END, '[]'), ',') IF trim(p) <> ''], '|') AS items "
    f"FROM (SELECT pos, {SHAPED} AS v FROM raw)",
)
def read_tags(spark, sf_dir):
    return _shaped_lists(spark, sf_dir).select(
        "pos", F.array_join(tx.read_tags("value"), "|").alias("items")
    )


@query(
    "b6_first_value",
    f"SELECT conv_id, turn, coalesce(nullif(CASE WHEN role = 'user' THEN '' ELSE {q.strip('text')} END, ''), "
    f"{q.strip('role')}) AS value FROM conversations",
)
def first_value(spark, sf_dir):
    rows = tb.table(spark, sf_dir, "conversations")
    shown = F.when(F.col("role") == "user", F.lit("nan")).otherwise(F.col("text"))
    return rows.select("conv_id", "turn", tx.first_filled(shown, "role").alias("value"))


CARD_TEXT = f"""concat_ws(chr(10), 'Model ID: ' || model_id, 'Task: ' || pipeline_tag,
  'Library: ' || library_name, 'Tags: ' || array_to_string(tags, ', '),
  'Languages: ' || array_to_string(languages, ', '),
  'Popularity: ' || likes || ' likes, ' || downloads || ' downloads',
  'Model card: ' || nullif({q.compact('modelCard', fv.CARD_TEXT_CHARS)}, ''))"""


@query(
    "b7_card_text",
    f"WITH {q.CARDS} SELECT pos, length(t) AS text_length, md5(t) AS text_md5 FROM "
    f"(SELECT pos, {CARD_TEXT} AS t FROM cards)",
)
def card_text(spark, sf_dir):
    rows = tb.cards(spark, sf_dir).select("pos", tx.card_text().alias("t"))
    return rows.select("pos", F.length("t").alias("text_length"), F.md5("t").alias("text_md5"))


ENCODERS = (*fv.DEFAULT_ENCODERS, *fv.PREFIXED_ENCODERS[1:])


@query(
    "b8_encoder_query",
    f"SELECT item_id, encoder, CASE WHEN encoder LIKE '%bge%' THEN {q.quoted(fv.QUERY_PREFIX)} ELSE '' END || "
    f"{q.squeeze('text')} AS query_text FROM benchmark, "
    f"(SELECT unnest([{', '.join(map(q.quoted, ENCODERS))}]) AS encoder)",
)
def encoder_query(spark, sf_dir):
    names = F.explode(F.array(*[F.lit(n) for n in ENCODERS]))
    rows = tb.table(spark, sf_dir, "benchmark").withColumn("encoder", names)
    return rows.select("item_id", "encoder", tx.encoder_query("text", "encoder").alias("query_text"))


@query(
    "b9_numbers",
    f"WITH {q.CARDS} SELECT pos, coalesce(TRY_CAST(likes AS DOUBLE), 0) AS likes, "
    f"coalesce(TRY_CAST(downloads AS DOUBLE), 0) AS downloads FROM raw",
)
def numbers(spark, sf_dir):
    return cd.typed_numbers(tb.raw_cards(spark, sf_dir)).select("pos", "likes", "downloads")


@query("b10_created_day", f"WITH {q.CARDS} SELECT pos, CAST(createdAt AS VARCHAR) AS created FROM cards")
def created_day(spark, sf_dir):
    rows = tb.raw_cards(spark, sf_dir)
    return rows.select("pos", tx.day_of("createdAt").cast("string").alias("created"))


@query(
    "b11_list_rejects",
    f"""SELECT count(*) AS cards, count(*) FILTER (doc_id % 5 = 0) AS bad_tags,
      count(*) FILTER (({_literal_sql(1)}) IS NULL) AS bad_languages FROM documents""",
)
def list_rejects(spark, sf_dir):
    # Every fifth list of tags misses its closing quote; languages are literals of all kinds.
    broken = F.when(F.pmod("pos", F.lit(5)) == 0, F.regexp_replace("tags", "']$", "]"))
    rows = tb.raw_cards(spark, sf_dir).withColumn("tags", F.coalesce(broken, "tags")).drop("languages")
    return cd.list_rejects(rows.join(_literals(spark, sf_dir).select(F.col("doc_id").alias("pos"), F.col("value").alias("languages")), "pos"))


@query(
    "b12_phrase",
    f"WITH {q.DOCS} SELECT pos, {q.phrase('pipeline_tag')} AS phrase FROM d",
)
def phrase(spark, sf_dir):
    return tb.search_docs(spark, sf_dir).select("pos", tx.phrase("pipeline_tag").alias("phrase"))


@query(
    "b13_task_sentence",
    f"WITH {q.DOCS} SELECT pos, {q.task_sentence('pipeline_tag')} AS sentence FROM d",
)
def task_sentence(spark, sf_dir):
    rows = tb.search_docs(spark, sf_dir)
    return rows.select("pos", tx.task_sentence("pipeline_tag").alias("sentence"))


@query(
    "b14_tags_sentence",
    f"WITH {q.DOCS}, t AS (SELECT pos, list_slice([lang, source, '', 'doc-' || pos, lang || '_x', source || '-y', 'z'], 1, "
    f"CAST(pos % 8 AS INTEGER)) AS tags FROM (SELECT doc_id AS pos, lang, source FROM documents)) "
    f"SELECT pos, {q.tags_sentence('tags')} AS sentence FROM t",
)
def tags_sentence(spark, sf_dir):
    names = F.array(
        "lang", "source", F.lit(""), F.concat(F.lit("doc-"), "doc_id"),
        F.concat("lang", F.lit("_x")), F.concat("source", F.lit("-y")), F.lit("z"),
    )
    rows = tb.table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("pos"),
        F.slice(names, F.lit(1), F.pmod("doc_id", F.lit(8)).cast("int")).alias("tags"),
    )
    return rows.select("pos", tx.tags_sentence("tags").alias("sentence"))


@query(
    "b15_clip",
    f"SELECT doc_id, length(c) AS n_clip, md5(c) AS clip_md5 FROM "
    f"(SELECT doc_id, {q.clip('text', fv.RERANK_TEXT_CHARS)} AS c FROM documents)",
)
def clip(spark, sf_dir):
    docs = tb.table(spark, sf_dir, "documents").select("doc_id", "text")
    rows = docs.select("doc_id", tx.clip("text", fv.RERANK_TEXT_CHARS).alias("c"))
    return rows.select("doc_id", F.length("c").alias("n_clip"), F.md5("c").alias("clip_md5"))


@query(
    "b16_rerank_text",
    f"WITH {q.DOCS} "
    + " UNION ALL ".join(
        f"SELECT pos, '{s}' AS strategy, md5({q.rerank_text(s)}) AS text_md5 FROM d" for s in fv.TEXT_STRATEGIES
    ),
)
def rerank_text(spark, sf_dir):
    docs = tb.search_docs(spark, sf_dir).withColumn("snippet", tx.snippet("body"))
    texts = F.array(
        *[
            F.struct(F.lit(s).alias("strategy"), F.md5(tx.rerank_text(s)).alias("text_md5"))
            for s in fv.TEXT_STRATEGIES
        ]
    )
    return docs.select("pos", F.explode(texts).alias("t")).select("pos", "t.strategy", "t.text_md5")


@query(
    "b17_snippet",
    "SELECT doc_id, md5(substr(text, 1, 500)) AS snippet_md5 FROM documents",
)
def snippet(spark, sf_dir):
    rows = tb.table(spark, sf_dir, "documents")
    return rows.select("doc_id", F.md5(tx.snippet("text")).alias("snippet_md5"))


@query(
    "b18_shown_snippet",
    f"SELECT doc_id, substr({q.squeeze('substr(text, 1, 500)')}, 1, 220) AS snippet FROM documents",
)
def shown_snippet(spark, sf_dir):
    rows = tb.table(spark, sf_dir, "documents")
    return rows.select("doc_id", tx.shown_snippet(tx.snippet("text")).alias("snippet"))


@query(
    "b19_task_key",
    f"SELECT doc_id, {q.task_key(chr(39) + ' ' + chr(39) + ' || upper(lang) || chr(32) || source || chr(95) || doc_id')} AS task "
    f"FROM documents",
)
def task_key(spark, sf_dir):
    value = F.concat(F.lit(" "), F.upper("lang"), F.lit(" "), "source", F.lit("_"), "doc_id")
    return tb.table(spark, sf_dir, "documents").select("doc_id", tx.task_key(value).alias("task"))


@query(
    "b20_relevant_ids",
    "SELECT conv_id, turn, CASE (conv_id + turn) % 4 WHEN 3 THEN '' "
    "ELSE 'c' || conv_id || ',' || role || CASE WHEN turn <> 0 THEN ',t' || turn ELSE ',t0' END END AS ids "
    "FROM conversations",
)
def relevant_ids(spark, sf_dir):
    rows = tb.table(spark, sf_dir, "conversations")
    a, b = F.concat(F.lit("c"), "conv_id"), F.concat(F.lit("t"), "turn")
    shape = F.pmod(F.col("conv_id") + F.col("turn"), F.lit(4))
    value = (
        F.when(shape == 0, F.concat_ws("|", a, "role", F.lit(" "), b, a))
        .when(shape == 1, F.concat_ws(" ; ", a, "role", a, b))
        .when(shape == 2, F.concat(F.lit("['"), F.concat_ws("', '", a, "role", b, b), F.lit("']")))
        .otherwise("null")
    )
    return rows.select("conv_id", "turn", F.array_join(tx.relevant_ids(value), ",").alias("ids"))


@query(
    "b20_literal_ids",
    f"""SELECT doc_id, CASE WHEN doc_id % {len(LITERALS)} = 12 THEN 'None|' || lang WHEN ({_literal_sql(1)}) IS NOT NULL THEN array_to_string(
      list_filter(list_distinct_in_order, lambda p: p <> ''), '|') END AS ids
    FROM (SELECT doc_id, lang, source, list_reduce(
        list_prepend([]::VARCHAR[], [[p] FOR p IN [trim(x) FOR x IN string_split({_literal_sql(1)}, '|')]]),
        lambda a, x: CASE WHEN list_contains(a, x[1]) THEN a ELSE list_concat(a, x) END) AS list_distinct_in_order
      FROM documents)""",
)
def literal_ids(spark, sf_dir):
    return _literals(spark, sf_dir).select("doc_id", F.array_join(tx.relevant_ids("value"), "|").alias("ids"))


@query(
    "b22_merge_payload",
    "SELECT doc_id, md5(text) AS body_md5, lang || '|' || source AS tags, 'inner_product' AS dense_metric, "
    "'higher_is_better' AS score_direction, CASE WHEN doc_id % 2 = 0 THEN 'own' ELSE lang || '_' || source END AS task "
    "FROM documents",
)
def merge_payload(spark, sf_dir):
    rows = tb.table(spark, sf_dir, "documents")
    own = F.when(
        F.pmod("doc_id", F.lit(2)) == 0, F.create_map(F.lit("task"), F.lit("own"))
    ).otherwise(F.create_map().cast("map<string,string>"))
    defaults = F.create_map(
        F.lit("body"), F.col("text"),
        F.lit("tags"), F.concat_ws("|", "lang", "source"),
        F.lit("task"), F.concat_ws("_", "lang", "source"),
    )
    extras = {"dense_metric": "inner_product", "score_direction": "higher_is_better"}
    merged = rows.select("doc_id", tx.merge_payload(own, defaults, extras).alias("m"))
    return merged.select(
        "doc_id",
        F.md5(F.col("m")["body"]).alias("body_md5"),
        *[F.col("m")[k].alias(k) for k in ("tags", "dense_metric", "score_direction", "task")],
    )


@query("c1_long_cards", "SELECT doc_id AS pos FROM documents WHERE length(coalesce(text, '')) > 20")
def long_cards(spark, sf_dir):
    return tb.raw_cards(spark, sf_dir).where(cd.long_enough()).select("pos")


MARKED = "CASE WHEN doc_id % 7 = 0 THEN '<!-- This model card has been generated automatically -->' || text ELSE text END"


@query(
    "c2_not_generated",
    f"SELECT doc_id AS pos, length(t) AS n FROM (SELECT doc_id, {MARKED} AS t FROM documents) "
    f"WHERE NOT regexp_matches(t, {q.quoted(fv.AUTO_CARD)})",
)
def not_generated(spark, sf_dir):
    marker = F.lit("<!-- This model card has been generated automatically -->")
    text = F.when(F.pmod("pos", F.lit(7)) == 0, F.concat(marker, "modelCard")).otherwise(F.col("modelCard"))
    rows = tb.raw_cards(spark, sf_dir).withColumn("modelCard", text)
    return rows.where(cd.not_generated()).select("pos", F.length("modelCard").alias("n"))


@query(
    "c4_tagged",
    "SELECT conv_id, turn FROM conversations WHERE trim(CASE WHEN role = 'user' THEN text ELSE ' ' END) <> ''",
)
def tagged(spark, sf_dir):
    rows = tb.table(spark, sf_dir, "conversations")
    value = F.when(F.col("role") == "user", F.col("text")).otherwise(" ")
    return rows.where(F.trim(value) != "").select("conv_id", "turn")
