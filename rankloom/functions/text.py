"""Text, list and date expressions. All stay inside the JVM."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import fixed_values as fv
from .literals import read_literal

Expr = Column | str


def _c(value: Expr) -> Column:
    return F.col(value) if isinstance(value, str) else value


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value) with value computed once per row, however often use names it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def filled(value: Column) -> Column:
    """Null instead of ''."""
    return let(value, lambda x: F.when(x != "", x))


def strip(value: Expr) -> Column:
    """Trim every kind of Unicode whitespace, not only the blank."""
    return F.btrim(_c(value), F.lit(fv.SPACE_CHARS))


def squeeze(value: Expr) -> Column:
    """Null as '', whitespace runs as one blank, ends trimmed."""
    one_line = F.regexp_replace(F.coalesce(_c(value).cast("string"), F.lit("")), f"{fv.SPACE}+", " ")
    return F.trim(one_line)


def fold_case(value: Expr) -> Column:
    """Text of which two are equal where they differ in case alone: sharp s as ss, final sigma as any sigma.

    Upper-casing undoes what lower-casing tells apart; only the dotless i, whose
    capital is that of i, is kept aside.
    """
    dotless, aside = F.lit("\u0131"), F.lit("\ufdd0")
    upper = F.upper(F.replace(F.lower(_c(value)), dotless, aside))
    # Each letter on its own: a capital sigma at a word's end would become a final one.
    return F.replace(F.lower(F.replace(upper, F.lit("\u03a3"), F.lit("\u03c3"))), aside, dotless)


def is_empty_word(value: Expr) -> Column:
    return F.coalesce(F.lower(strip(value)).isin(*fv.EMPTY_WORDS), F.lit(True))


def tokens(value: Expr) -> Column:
    """Lower-cased runs of Latin a-z, Cyrillic and digits."""
    # Matching tokens is several times faster than splitting at the rest: Java
    # is slow on a negated class that reaches beyond Latin.
    lowered = F.lower(F.coalesce(_c(value), F.lit("")))
    return F.regexp_extract_all(lowered, F.lit(fv.TOKEN), F.lit(0))


def term_counts(token_array: Column) -> Column:
    """Tokens of one row as array<struct<term, tf>>, without a shuffle.

    Equal neighbours of the sorted tokens form runs; the run starts give the
    counts.
    """

    def runs(ordered: Column) -> Column:
        starts = F.filter(
            F.sequence(F.lit(0), F.size(ordered) - 1),
            lambda i: (i == 0) | (F.get(ordered, i) != F.get(ordered, i - 1)),
        )
        return let(
            starts,
            lambda at: F.transform(
                at,
                lambda start, n: F.struct(
                    F.get(ordered, start).alias("term"),
                    (F.coalesce(F.get(at, n + 1), F.size(ordered)) - start).alias("tf"),
                ),
            ),
        )

    nothing = F.expr("cast(array() as array<struct<term:string,tf:int>>)")
    return let(
        F.sort_array(token_array),
        lambda ordered: F.when(F.size(ordered) > 0, runs(ordered)).otherwise(nothing),
    )


def clean_card(value: Expr) -> Column:
    """Card text without code, headers, links, URLs, bullets and HTML tags."""
    text = F.coalesce(_c(value), F.lit(""))
    for pattern, replacement in fv.CARD_CLEANING:
        text = F.regexp_replace(text, pattern, replacement)
    return strip(text)


def compact(value: Expr, max_chars: int | None = None) -> Column:
    """One-line text; a cut falls back to the last blank inside the limit."""
    if not max_chars or max_chars < 0:
        return squeeze(value)

    def shorten(text: Column) -> Column:
        cut = F.trim(F.regexp_replace(F.substring(text, 1, max_chars), " [^ ]*$", ""))
        return F.when(F.length(text) > max_chars, cut).otherwise(text)

    return let(squeeze(value), shorten)


def clip(value: Expr, max_chars: int) -> Column:
    """Text of at most max_chars, ending at a blank if one lies past the half."""

    def snap(cut: Column) -> Column:
        last_blank = F.lit(max_chars) - F.instr(F.reverse(cut), " ")
        snaps = (F.instr(cut, " ") > 0) & (last_blank > max_chars * 0.5)
        return strip(F.when(snaps, cut.substr(F.lit(1), last_blank)).otherwise(cut))

    def shorten(text: Column) -> Column:
        long = F.length(text) > max_chars
        return F.when(long, let(F.substring(text, 1, max_chars), snap)).otherwise(text)

    return let(strip(value), shorten)


def _trimmed_items(items: Column) -> Column:
    return F.filter(F.transform(items, strip), lambda x: x != "")


def split_list(value: Expr, separator: str = ",") -> Column:
    return _trimmed_items(F.split(_c(value), separator))


def read_list(value: Expr) -> Column:
    """List text ("['a', 'b']" or "a, b") as array<string>; empty words as [].

    What begins and ends in square brackets is read as a Python list; where it
    is none, and without brackets, commas part the items.
    """

    def items(text: Column) -> Column:
        literal = F.when(text.startswith("[") & text.endswith("]"), read_literal(text))
        return F.coalesce(literal, F.split(text, ","))

    return F.when(is_empty_word(value), F.array().cast("array<string>")).otherwise(
        _trimmed_items(let(strip(_c(value)), items))
    )


def is_bad_list(value: Expr) -> Column:
    """True where a text that opens a bracket is no Python literal (counted as a reject)."""

    def bad(text: Column) -> Column:
        opened = F.substring(text, 1, 1).isin("[", "(", "{")
        return F.when(opened, read_literal(text, openings="[({").isNull()).otherwise(F.lit(False))

    return F.coalesce(let(strip(_c(value)), bad), F.lit(False))


def read_tags(value: Expr) -> Column:
    """Tag text as array<string>; brackets go, quotes stay."""
    inner = F.regexp_replace(strip(_c(value)), r"^[\[\]]+|[\[\]]+$", "")
    return F.when(is_empty_word(value), F.array().cast("array<string>")).otherwise(
        split_list(inner)
    )


def first_filled(*columns: Expr, default: Expr | None = None) -> Column:
    """First column whose trimmed text is neither blank nor 'nan'."""
    def pick(text: Column) -> Column:
        return F.when((text != "") & (F.lower(text) != "nan"), text)

    picks = [let(strip(_c(column).cast("string")), pick) for column in columns]
    picks.append(_c(default) if default is not None else F.lit(""))
    return F.coalesce(*picks)


def number_or_zero(value: Expr) -> Column:
    """The number a text states; 0 for none, for `nan`, and for a Java number with a type letter (5d, 5f)."""
    text = _c(value).cast("string")
    number = F.when(~text.rlike(r"[0-9.][dDfF]\s*$"), text.try_cast("double"))
    return F.coalesce(F.nanvl(number, F.lit(0.0)), F.lit(0.0))


def day_of(value: Expr) -> Column:
    """The day as written, whatever the offset of the time; null for what is no time."""
    moment = F.try_to_timestamp(_c(value))
    written = F.regexp_extract(_c(value).cast("string"), r"^\s*([0-9]{4}-[0-9]{1,2}-[0-9]{1,2})", 1).try_cast("date")
    return F.when(moment.isNotNull(), F.coalesce(written, F.to_date(moment)))


def card_text(
    *,
    model_id: Expr = "model_id",
    task: Expr = "pipeline_tag",
    library: Expr = "library_name",
    tags: Expr = "tags",
    languages: Expr = "languages",
    likes: Expr = "likes",
    downloads: Expr = "downloads",
    body: Expr = "modelCard",
    max_chars: int = fv.CARD_TEXT_CHARS,
) -> Column:
    """Labelled lines that describe one card; lines without a value are left out.

    tags and languages are array<string>, likes and downloads whole numbers.
    """

    def line(label: str, text: Column) -> Column:
        return let(text, lambda x: F.when(x != "", F.concat(F.lit(label), x)))

    def joined(items: Expr, limit: int) -> Column:
        return F.coalesce(F.array_join(F.slice(_c(items), 1, limit), ", "), F.lit(""))

    liked, loaded = squeeze(likes), squeeze(downloads)
    popularity = F.when(
        (liked != "") | (loaded != ""),
        F.concat(F.lit("Popularity: "), liked, F.lit(" likes, "), loaded, F.lit(" downloads")),
    )
    return F.concat_ws(
        "\n",
        line("Model ID: ", squeeze(model_id)),
        line("Task: ", squeeze(task)),
        line("Library: ", squeeze(library)),
        line("Tags: ", joined(tags, fv.CARD_TAGS)),
        line("Languages: ", joined(languages, fv.CARD_LANGUAGES)),
        popularity,
        line("Model card: ", compact(body, max_chars)),
    )


def encoder_query(value: Expr, encoder: Expr) -> Column:
    """Query text as the named encoder expects it; `encoder` is a column."""
    text = squeeze(value)
    prefixed = _c(encoder).isin(*fv.PREFIXED_ENCODERS)
    return F.when(prefixed, F.concat(F.lit(fv.QUERY_PREFIX), text)).otherwise(text)


def phrase(value: Expr) -> Column:
    return strip(F.translate(F.coalesce(_c(value), F.lit("")), "-_", "  "))


def task_sentence(value: Expr) -> Column:
    def sentence(task: Column) -> Column:
        said = F.concat(F.lit("This model is designed for "), task, F.lit("."))
        return F.when(task != "", said).otherwise("")

    return let(phrase(value), sentence)


def tags_sentence(tags: Expr) -> Column:
    """Up to five tags as one English sentence; '' without tags."""
    named = F.filter(
        F.transform(F.coalesce(_c(tags), F.array().cast("array<string>")), phrase),
        lambda x: x != "",
    )

    def sentence(names: Column) -> Column:
        many = F.concat(
            F.array_join(F.slice(names, F.lit(1), F.size(names) - 1), ", "),
            F.lit(", and "),
            F.element_at(names, -1),
        )
        listed = F.when(F.size(names) == 1, F.element_at(names, 1)).otherwise(many)
        said = F.concat(F.lit("Relevant tags include "), listed, F.lit("."))
        return F.when(F.size(names) > 0, said).otherwise("")

    return let(F.slice(named, 1, fv.RERANK_TAGS), sentence)


def rerank_text(
    strategy: str = "title_task_body",
    max_chars: int = fv.RERANK_TEXT_CHARS,
    *,
    title: Expr = "title",
    body: Expr = "body",
    snippet: Expr = "snippet",
    task: Expr = "pipeline_tag",
    tags: Expr = "tags",
    model_id: Expr = "model_id",
) -> Column:
    """The document side of a (query, document) pair for a scorer."""
    if strategy not in fv.TEXT_STRATEGIES:
        raise ValueError(f"unknown text strategy {strategy!r}; known: {fv.TEXT_STRATEGIES}")
    if max_chars <= 0:
        raise ValueError("max_chars must be positive")

    heading = strip(F.coalesce(_c(title), F.lit("")))
    main = F.coalesce(filled(strip(body)), strip(snippet), F.lit(""))

    def headed(name: Column) -> Column:
        return F.when(name != "", F.concat(name, F.lit(".")))

    if strategy == "body_only":
        text = F.coalesce(filled(main), heading)
    else:
        parts = [let(heading, headed)]
        if strategy != "title_body":
            parts.append(filled(task_sentence(task)))
        if strategy == "title_task_tags_body":
            parts.append(filled(tags_sentence(tags)))
        text = F.concat_ws(" ", *parts, filled(main))
    return clip(F.coalesce(filled(strip(text)), filled(heading), _c(model_id)), max_chars)


def snippet(body: Expr, max_chars: int = fv.SNIPPET_CHARS) -> Column:
    return F.substring(F.coalesce(_c(body), F.lit("")), 1, max_chars)


def shown_snippet(value: Expr) -> Column:
    return F.substring(squeeze(value), 1, fv.SHOWN_SNIPPET_CHARS)


def task_key(value: Expr) -> Column:
    return F.translate(F.lower(strip(F.coalesce(_c(value), F.lit("")))), "_ ", "--")


def relevant_ids(value: Expr) -> Column:
    """Id list text (JSON or Python list, a|b or a;b) as distinct ids in order.

    A text that opens a square bracket and is neither list gives null.
    """

    def items(text: Column) -> Column:
        return (
            F.when(text.startswith("["), read_literal(text, json=True))
            .when(F.instr(text, "|") > 0, F.split(text, r"\|"))
            .otherwise(F.split(text, ";"))
        )

    return F.when(is_empty_word(value), F.array().cast("array<string>")).otherwise(
        F.array_distinct(_trimmed_items(let(strip(_c(value)), items)))
    )


def variant_map(fields: dict[str, Column], types: dict[str, str]) -> Column:
    """map<string, variant> of columns of any type, named by type where Spark must know whether it is nested."""
    pairs = []
    for name, column in fields.items():
        nested = types[name].startswith(("array", "map", "struct"))
        pairs += [F.lit(name), F.to_variant_object(column) if nested else column.cast("variant")]
    return F.create_map(*pairs)


def merge_payload(row: Expr, defaults: Expr, extras: dict[str, str] | None = None) -> Column:
    """map<string,string> or map<string,variant>: the row's entries win over defaults, extras over both."""
    merged = F.map_concat(
        F.map_filter(_c(defaults), lambda k, _: ~F.map_contains_key(_c(row), k)), _c(row)
    )
    return with_extras(merged, extras) if extras else merged


def with_extras(payload: Column, extras: dict[str, str], kind: str = "string") -> Column:
    """The payload with further entries, which win; kind: of the payload's values."""
    added = F.create_map(*[x for k, v in extras.items() for x in (F.lit(k), F.lit(v).cast(kind))])
    return F.map_concat(F.map_filter(payload, lambda k, _: ~k.isin(*extras)), added)


def columns_present(df_columns: Sequence[str], wanted: Sequence[str]) -> list[str]:
    return [name for name in wanted if name in df_columns]
