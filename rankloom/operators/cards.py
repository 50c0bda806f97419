"""From raw cards to the clean collection: filters, sampling, de-duplication, cleaning."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fixed_values as fv
from ..functions import text as tx
from .ordering import Desc, first_of_each, first_rows, number_rows, random_rows


def long_enough(body: str = "modelCard", min_chars: int = fv.MIN_CARD_CHARS) -> Column:
    """Raw card text longer than min_chars; null counts as empty."""
    return F.length(F.coalesce(F.col(body), F.lit(""))) > min_chars


def not_generated(body: str = "modelCard") -> Column:
    """Card without the marker of automatic generation; null passes."""
    return ~F.coalesce(F.col(body).rlike(fv.AUTO_CARD), F.lit(False))


def usable(cards: DataFrame) -> DataFrame:
    return cards.where(long_enough()).where(not_generated())


def typed_numbers(cards: DataFrame) -> DataFrame:
    return cards.withColumns(
        {"likes": tx.number_or_zero("likes"), "downloads": tx.number_or_zero("downloads")}
    )


def typed_fields(cards: DataFrame) -> DataFrame:
    """List texts as arrays and timestamps as dates."""
    return cards.withColumns(
        {
            "tags": tx.read_list("tags"),
            "languages": tx.read_list("languages"),
            "createdAt": tx.day_of("createdAt"),
        }
    )


def list_rejects(cards: DataFrame) -> DataFrame:
    """How many list literals do not parse, per column."""
    return cards.agg(
        F.count("*").alias("cards"),
        F.count_if(tx.is_bad_list("tags")).alias("bad_tags"),
        F.count_if(tx.is_bad_list("languages")).alias("bad_languages"),
    )


POPULARITY = [Desc("downloads"), Desc("likes"), "pos"]


def popular_and_random(
    cards: DataFrame,
    popular: int = fv.POPULAR_CARDS,
    random: int = fv.RANDOM_CARDS,
    seed: int = fv.SEED,
) -> DataFrame:
    """The most popular cards and a random draw from the rest.

    Adds stratum (0 popular, 1 random) and place (order inside the stratum).
    Only ids and sort keys are sorted; card texts are joined to the chosen ids.
    """
    keys = cards.select("pos", "downloads", "likes")
    top = first_rows(keys, POPULARITY, popular, "pos").select("pos", "place")
    rest = keys.select("pos").join(top, "pos", "left_anti")
    drawn = random_rows(rest, random, "pos", seed).select("pos", "place")
    chosen = top.withColumn("stratum", F.lit(0)).unionByName(drawn.withColumn("stratum", F.lit(1)))
    return cards.join(chosen, "pos")


def without_repeats(cards: DataFrame, keys: tuple[str, ...] = ("model_id",)) -> DataFrame:
    """First card of every key in stratum and place order."""
    return first_of_each(cards, keys, ["stratum", "place"], "pos")


def cleaned(cards: DataFrame) -> DataFrame:
    return cards.withColumn("modelCard", tx.clean_card("modelCard"))


def prepare(
    raw: DataFrame,
    popular: int = fv.POPULAR_CARDS,
    random: int = fv.RANDOM_CARDS,
    seed: int = fv.SEED,
) -> DataFrame:
    """Raw cards to the clean data set, in the order that defines it."""
    chosen = popular_and_random(usable(typed_numbers(raw)), popular, random, seed)
    return cleaned(typed_fields(without_repeats(chosen)))


def documents(
    rows: DataFrame,
    *,
    source: DataFrame | None = None,
    max_body_chars: int | None = None,
    include_metadata: bool = True,
) -> DataFrame:
    """Search documents of artifact rows (pos, doc_id and metadata columns).

    Body is the first filled of body, modelCard and text; without any of them
    the texts come from `source`, matched by id. Title falls back to the model
    id, the task to the source's. metadata (map<string, variant>) keeps the other
    columns of the row with their types, or the task alone, which is there in
    any case.
    """
    if max_body_chars is not None and max_body_chars <= 0:
        raise ValueError("max_body_chars must be positive")
    bodies = tx.columns_present(rows.columns, fv.BODY_COLUMNS)
    own_tasks = tx.columns_present(rows.columns, ("pipeline_tag", "task"))
    joined = rows
    if not bodies:
        if source is None:
            raise ValueError("the metadata holds no text; pass the processed data set")
        check_aligned(rows, source)
        wanted = {
            c: f"source_{c}"
            for c in source.columns
            if c in (*fv.BODY_COLUMNS, "title", "name", "tags", "pipeline_tag", "task")
        }
        other = source.select(
            F.col("model_id").cast("string").alias("doc_id"),
            *[F.col(c).alias(n) for c, n in wanted.items()],
        )
        joined = rows.join(other, "doc_id")
        names = {c: n for c, n in wanted.items()}
    else:
        names = {c: c for c in rows.columns}

    def named(*columns: str) -> list[Column]:
        return [F.col(names[c]) for c in columns if c in names]

    model_id = tx.first_filled("model_id", default="doc_id") if "model_id" in rows.columns else F.col("doc_id")
    body = tx.first_filled(*named(*fv.BODY_COLUMNS))
    if max_body_chars is not None:
        body = F.substring(body, 1, max_body_chars)
    tags = named("tags")
    if not tags:
        tag_list = F.array().cast("array<string>")
    elif joined.select(tags[0]).schema[0].dataType.simpleString() == "array<string>":
        tag_list = F.filter(tags[0], lambda x: x.isNotNull() & (x != ""))
    else:
        tag_list = tx.read_tags(tags[0])
    task = tx.first_filled(*[F.col(c) for c in own_tasks], *named("pipeline_tag", "task"))
    kept = {c: F.col(c) for c in rows.columns if c not in ("pos", "doc_id")} if include_metadata else {}
    kept.setdefault("pipeline_tag", task)
    types = dict(joined.select(*[c.alias(name) for name, c in kept.items()]).dtypes)
    return joined.select(
        "pos",
        "doc_id",
        model_id.alias("model_id"),
        tx.first_filled(*named("title", "name"), default=model_id).alias("title"),
        body.alias("body"),
        F.coalesce(tag_list, F.array().cast("array<string>")).alias("tags"),
        task.alias("pipeline_tag"),
        tx.variant_map(kept, types).alias("metadata"),
    )


def alignment(ids: DataFrame, source: DataFrame) -> DataFrame:
    """One row: ids on either side only, and ids that occur twice."""
    a = ids.groupBy(F.col("doc_id").cast("string").alias("id")).agg(F.count("*").alias("a"))
    b = source.groupBy(F.col("model_id").cast("string").alias("id")).agg(F.count("*").alias("b"))
    return a.join(b, "id", "full").agg(
        F.coalesce(F.sum("a"), F.lit(0)).alias("id_rows"),
        F.coalesce(F.sum("b"), F.lit(0)).alias("source_rows"),
        F.count_if(F.col("b").isNull()).alias("without_source"),
        F.count_if(F.col("a").isNull()).alias("without_id"),
        F.count_if((F.col("a") > 1) | (F.col("b") > 1)).alias("repeated"),
    )


def check_aligned(ids: DataFrame, source: DataFrame) -> None:
    if "model_id" not in source.columns:
        raise ValueError("the processed data set must have a model_id")
    row = alignment(ids, source).first()
    if row.without_source or row.without_id or row.repeated:
        raise ValueError(f"ids and processed data set do not match: {row.asDict()}")


def where_equal(docs: DataFrame, filters: dict[str, str]) -> DataFrame:
    """Equality filter on document columns, renumbered for retrieval."""
    for column, value in filters.items():
        docs = docs.where(F.col(column) == value)
    return number_rows(docs.withColumnRenamed("pos", "source_pos"), [F.col("source_pos")])


def slim_metadata(cards: DataFrame) -> DataFrame:
    """Metadata without the long text, led by the row number, with the text length."""
    kept = tx.columns_present(cards.columns, fv.SLIM_COLUMNS)
    return cards.select(
        F.col("pos").alias("embedding_row"), *kept, F.length(tx.card_text()).alias("text_length_chars")
    )


def text_samples(cards: DataFrame, n: int = 20) -> DataFrame:
    """The text of the first n cards, as the encoder sees it."""
    first = cards.orderBy("pos").limit(n)
    return first.select(
        F.col("pos").alias("embedding_row"), "model_id", tx.card_text().alias("text")
    )
