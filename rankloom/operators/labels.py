"""Relevance labels: validation of given ones and derivation from metadata."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import fixed_values as fv
from ..functions import text as tx
from ..session import settle_table
from .lexical import LexicalIndex
from .ordering import Desc, first_rows, join_small, row_count_within

#: Characters by which parts of terms are found.
GRAM = 3


def parse_qrels(rows: DataFrame) -> DataFrame:
    """(row_no, query, ids) from text rows; ids is null where the list is invalid."""
    return rows.select(
        "row_no",
        tx.strip(F.coalesce("query", F.lit(""))).alias("query"),
        tx.relevant_ids(F.coalesce("relevant_model_ids", F.lit(""))).alias("ids"),
    )


def qrels_problems(rows: DataFrame, known_ids: DataFrame | None = None) -> DataFrame:
    """(row_no, kind, detail), one row per faulty row, by the first fault found in it.

    Kinds in the order of the checks: empty query, duplicate query (without
    regard to case), invalid list, no ids, unknown ids (up to five of them).
    known_ids has a column model_id.
    """
    parsed = parse_qrels(rows)
    folded = tx.fold_case("query")
    firsts = (
        parsed.where(F.col("query") != "")
        .groupBy(folded.alias("folded"))
        .agg(F.min("row_no").alias("first_row"))
    )
    checked = parsed.join(firsts, folded == F.col("folded"), "left").select(
        "row_no", "query", "ids", (F.col("row_no") > F.col("first_row")).alias("again")
    )
    if known_ids is None:
        checked = checked.withColumn("unknown", F.lit(None).cast("array<string>"))
    else:
        asked = parsed.select("row_no", F.posexplode("ids").alias("i", "model_id"))
        missing = (
            asked.join(known_ids.select("model_id"), "model_id", "left_anti")
            .groupBy("row_no")
            .agg(F.sort_array(F.collect_list(F.struct("i", "model_id"))).alias("m"))
            .select("row_no", F.transform(F.slice("m", 1, 5), lambda s: s["model_id"]).alias("unknown"))
        )
        checked = checked.join(missing, "row_no", "left")
    kind = (
        F.when(F.col("query") == "", "empty query")
        .when(F.col("again"), "duplicate query")
        .when(F.col("ids").isNull(), "invalid list")
        .when(F.size("ids") == 0, "no ids")
        .when(F.col("unknown").isNotNull(), "unknown ids")
    )
    detail = F.when(kind == "unknown ids", F.array_join("unknown", ", ")).otherwise(F.col("query"))
    return checked.select("row_no", kind.alias("kind"), detail.alias("detail")).where(
        F.col("kind").isNotNull()
    )


def load_qrels(
    rows: DataFrame, known_ids: DataFrame | None = None, *, top_k: int = fv.CANDIDATES
) -> tuple[DataFrame, DataFrame]:
    """(queries, qrels) of valid label rows; the first fault raises ValueError."""
    if top_k <= 0:
        raise ValueError("top_k must be positive")
    fault = qrels_problems(rows, known_ids).orderBy("row_no").limit(1).collect()
    if fault:
        raise ValueError(f"row {fault[0].row_no}: {fault[0].kind}: {fault[0].detail}")
    parsed = parse_qrels(rows)
    if parsed.isEmpty():
        raise ValueError("the relevance file holds no evaluation queries")
    queries = parsed.select(
        F.col("row_no").alias("query_id"), F.col("query").alias("text"), F.lit(top_k).alias("top_k")
    )
    return queries, parsed.select(F.col("row_no").alias("query_id"), F.explode("ids").alias("model_id"))


def unknown_relevant(qrels: DataFrame, known_ids: DataFrame) -> DataFrame:
    """Distinct relevant ids that no document has."""
    return qrels.select("model_id").distinct().join(known_ids.select("model_id"), "model_id", "left_anti")


def check_relevant(qrels: DataFrame, known_ids: DataFrame) -> None:
    rows = unknown_relevant(qrels, known_ids).orderBy("model_id").limit(20).collect()
    if rows:
        raise ValueError(f"relevant ids without a document: {[r.model_id for r in rows]}")


def task_counts(cards: DataFrame) -> DataFrame:
    """(task, models) over normalised, non-blank tasks."""
    return (
        cards.select(tx.task_key("pipeline_tag").alias("task"))
        .where(F.col("task") != "")
        .groupBy("task")
        .agg(F.count("*").alias("models"))
    )


def bounded_tasks(counts: DataFrame) -> DataFrame:
    """Tasks of 10 to 250 models; if fewer than five, all of at least five models."""
    inside = F.col("models").between(fv.SILVER_LOW, fv.SILVER_HIGH)
    fits = counts.agg(F.count_if(inside)).first()[0] >= fv.SILVER_QUERIES
    return counts.where(inside if fits else F.col("models") >= fv.SILVER_FALLBACK)


def target_tasks(counts: DataFrame) -> DataFrame:
    """The five tasks whose size lies nearest to the target, numbered from 1."""
    distance = F.abs(F.col("models") - fv.SILVER_TARGET)
    chosen = first_rows(
        bounded_tasks(counts),
        [distance, Desc("models"), "task"],
        fv.SILVER_QUERIES,
        "task",
    )
    return chosen.withColumn("query_id", F.col("place") + 1).drop("place")


def silver_labels(
    cards: DataFrame, *, top_k: int = fv.CANDIDATES
) -> tuple[DataFrame, DataFrame]:
    """(queries, qrels): a task name is relevant to every card of that task."""
    tasks = target_tasks(settle_table(task_counts(cards)))
    queries = tasks.select(
        "query_id",
        F.translate("task", "-", " ").alias("text"),
        F.lit(top_k).alias("top_k"),
        F.concat(F.lit("pipeline_tag="), F.col("task")).alias("label_rule"),
        "task",
    )
    qrels = (
        cards.select(tx.task_key("pipeline_tag").alias("task"), "model_id")
        .join(F.broadcast(tasks.select("task", "query_id")), "task")
        .select("query_id", "model_id")
        .distinct()
    )
    return queries, qrels


def check_silver(queries: DataFrame) -> None:
    if queries.count() < fv.SILVER_QUERIES:
        raise ValueError("not enough populated tasks for an evaluation")


def query_summary(queries: DataFrame, qrels: DataFrame) -> DataFrame:
    """(query, label_rule, relevant_models)."""
    sizes = qrels.groupBy("query_id").agg(F.countDistinct("model_id").alias("relevant_models"))
    return queries.join(sizes, "query_id", "left").select(
        F.col("text").alias("query"),
        "label_rule",
        F.coalesce("relevant_models", F.lit(0)).alias("relevant_models"),
    )


def containing_documents(queries: DataFrame, docs: DataFrame, index: LexicalIndex) -> DataFrame:
    """(query_id, model_id) of the documents whose text holds the query text.

    A document can only hold a passage if it has the inner tokens of it (the
    first and last may be parts of longer words). The rarest inner token leads to
    the candidates; only their texts are compared. Passages of one or two tokens
    are led by the terms that hold the longer of these, found by a join on short
    pieces of terms. Only passages without a token are compared with every document.
    """
    words = queries.select("query_id", "text", tx.tokens("text").alias("w"))
    inner = words.where(F.size("w") > 2).select(
        "query_id", F.explode(F.slice("w", F.lit(2), F.size("w") - 2)).alias("term")
    )
    led = inner.distinct().join(index.terms.select("term", "df"), "term", "left")
    rarest = led.groupBy("query_id").agg(
        F.min_by("term", F.struct(F.coalesce("df", F.lit(0)), "term")).alias("term")
    )
    spots = settle_table(
        small_join(index.entries.select("term", "pos"), rarest, "term").select("query_id", "pos")
    )
    asked = queries.select("query_id", "text")
    holds = F.contains("body", "text")
    long = (
        docs.select("pos", "model_id", "body")
        .join(spots, "pos")
        .join(F.broadcast(asked) if row_count_within(asked) is not None else asked, "query_id")
        .where(holds)
    )
    out = long.select("query_id", "model_id")
    # A document that holds a passage of one or two tokens has a term that the longer of them is a part of.
    longer = F.when(F.length(F.col("w")[0]) >= F.length(F.element_at("w", -1)), F.col("w")[0]).otherwise(F.element_at("w", -1))
    short = settle_table(words.where(F.size("w").between(1, 2)).select("query_id", "text", longer.alias("word")))
    pieces = short.select("word").distinct().withColumn("gram", F.substring("word", 1, GRAM))
    starts = F.sequence(F.lit(1), F.length("term"))
    sizes = F.sequence(F.lit(1), F.lit(GRAM))
    grams = F.array_distinct(F.flatten(F.transform(starts, lambda i: F.transform(sizes, lambda n: F.col("term").substr(i, n)))))
    terms = index.terms.select("term", F.explode(grams).alias("gram")).join(pieces, "gram").where(F.contains("term", "word"))
    near = settle_table(small_join(index.entries.select("term", "pos"), terms.select("term", "word"), "term").select("word", "pos").distinct())
    body = docs.select("pos", "model_id", "body")
    out = out.unionByName(
        body.join(near, "pos").join(short, "word").where(holds).select("query_id", "model_id")
    )
    bare = settle_table(words.where(F.size("w") == 0).select("query_id", "text"))
    if bare.isEmpty():
        return out
    return out.unionByName(body.join(bare, holds).select("query_id", "model_id"))


def small_join(entries: DataFrame, wanted: DataFrame, on: str) -> DataFrame:
    """Postings of a few terms: broadcast when counted small, salted otherwise."""
    wanted = settle_table(wanted)
    return join_small(entries, wanted, on, row_count_within(wanted), F.col("pos"))
