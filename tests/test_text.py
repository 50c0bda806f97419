import pytest
from pyspark.sql import functions as F

from rankloom.functions import fixed_values as fv
from rankloom.functions import text as tx


def one(spark, build, value, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(build("x").alias("y")).first().y


@pytest.mark.parametrize(
    "text, words",
    [
        ("Hello, World-2", ["hello", "world", "2"]),
        ("café Ёлка", ["caf", "лка"]),
        ("a_b c", ["a", "b", "c"]),
        ("", []),
        (None, []),
        ("!!!", []),
    ],
)
def test_tokens(spark, text, words):
    assert one(spark, tx.tokens, text) == words


def test_term_counts_count_every_token(spark):
    got = one(spark, lambda c: tx.term_counts(tx.tokens(c)), "b a b c a b")
    assert [(r.term, r.tf) for r in got] == [("a", 2), ("b", 3), ("c", 1)]
    assert one(spark, lambda c: tx.term_counts(tx.tokens(c)), "...") == []


@pytest.mark.parametrize(
    "text, clean",
    [
        ("before ```code\nmore``` after", "before after"),
        ("# Title\nbody", "Title\nbody"),
        ("see [docs](http://x.y/z) now", "see docs now"),
        ("go http://x.y/z now", "go now"),
        ("- a\n* b\n• c `d`", "a\n b\n c d"),
        ("a\n\n\n\n\nb", "a\n\nb"),
        ("<b>bold</b> text", "bold text"),
        ("end \x1c ", "end"),
        (None, ""),
    ],
)
def test_clean_card(spark, text, clean):
    assert one(spark, tx.clean_card, text) == clean


def test_compact_cuts_at_a_blank(spark):
    assert one(spark, lambda c: tx.compact(c, 10), "alpha  beta gamma") == "alpha"
    assert one(spark, lambda c: tx.compact(c, 10), "alphabetagamma") == "alphabetag"
    assert one(spark, lambda c: tx.compact(c, 100), " a \n b ") == "a b"


def test_clip_goes_back_only_past_the_half(spark):
    assert one(spark, lambda c: tx.clip(c, 10), "aaaaaaa bbbbbb") == "aaaaaaa"
    assert one(spark, lambda c: tx.clip(c, 10), "aa bbbbbbbbbbbb") == "aa bbbbbbb"
    assert len(one(spark, lambda c: tx.clip(c, 200), "x" * 5000)) == 200


@pytest.mark.parametrize(
    "text, items",
    [
        ("['a', 'b, c']", ["a", "b, c"]),
        ('["a", "b"]', ["a", "b"]),
        ("a, b ,", ["a", "b"]),
        ("nan", []),
        ("[]", []),
        (" None ", []),
        (None, []),
        ("['a', b", ["['a'", "b"]),
    ],
)
def test_read_list(spark, text, items):
    assert one(spark, tx.read_list, text) == items


def test_read_tags_keeps_quotes(spark):
    assert one(spark, tx.read_tags, "['a', 'b']") == ["'a'", "'b'"]
    assert one(spark, tx.read_tags, "null") == []


@pytest.mark.parametrize(
    "text, ids",
    [
        ("model-a|model-b|model-a", ["model-a", "model-b"]),
        ('["model-a", "model-b"]', ["model-a", "model-b"]),
        ("['x', 'y', 'x']", ["x", "y"]),
        ("a;b", ["a", "b"]),
        ("[broken", None),
        ("  ", []),
    ],
)
def test_relevant_ids(spark, text, ids):
    assert one(spark, tx.relevant_ids, text) == ids


def test_query_prefix_for_some_encoders(spark):
    rows = spark.createDataFrame(
        [(" image  classification ", "BAAI/bge-small-en-v1.5"), (" image  classification ", "other")],
        "text string, encoder string",
    )
    got = [r.q for r in rows.select(tx.encoder_query("text", "encoder").alias("q")).collect()]
    assert got == [fv.QUERY_PREFIX + "image classification", "image classification"]


def test_tags_sentence(spark):
    def said(tags):
        return one(spark, tx.tags_sentence, tags, "array<string>")

    assert said(None) == "" and said([" ", "-"]) == ""
    assert said(["computer-vision"]) == "Relevant tags include computer vision."
    assert said(list("abcdefg")) == "Relevant tags include a, b, c, d, and e."


def card(spark, **values):
    row = {
        "title": "Model A", "body": "About it.", "snippet": "", "pipeline_tag": "video-classification",
        "tags": ["computer-vision", "transformers"], "model_id": "m/a", **values,
    }
    return spark.createDataFrame(
        [tuple(row.values())],
        "title string, body string, snippet string, pipeline_tag string, tags array<string>, model_id string",
    )


def test_rerank_text_strategies(spark):
    def text(strategy, **values):
        return card(spark, **values).select(tx.rerank_text(strategy)).first()[0]

    task = "This model is designed for video classification."
    tags = "Relevant tags include computer vision, and transformers."
    assert text("body_only") == "About it."
    assert text("title_body") == "Model A. About it."
    assert text("title_task_body") == f"Model A. {task} About it."
    assert text("title_task_tags_body") == f"Model A. {task} {tags} About it."
    assert text("body_only", body=" ", snippet=" cut ") == "cut"
    assert text("title_body", body=None, title=" ", pipeline_tag=None) == "m/a"
    with pytest.raises(ValueError):
        tx.rerank_text("unknown")
    with pytest.raises(ValueError):
        tx.rerank_text("title_body", 0)


def test_card_text_leaves_out_what_is_missing(spark):
    rows = spark.createDataFrame(
        [("m/a", "", None, [], ["en"], None, 5, "Some  text")],
        "model_id string, pipeline_tag string, library_name string, tags array<string>, "
        "languages array<string>, likes bigint, downloads bigint, modelCard string",
    )
    assert rows.select(tx.card_text()).first()[0] == (
        "Model ID: m/a\nLanguages: en\nPopularity:  likes, 5 downloads\nModel card: Some text"
    )


def test_payload_merge_prefers_the_row(spark):
    own = F.create_map(F.lit("body"), F.lit("own"))
    defaults = F.create_map(F.lit("body"), F.lit("default"), F.lit("tags"), F.lit("t"))
    got = spark.range(1).select(tx.merge_payload(own, defaults, {"dense_metric": "l2"}).alias("m")).first().m
    assert got == {"body": "own", "tags": "t", "dense_metric": "l2"}


def test_numbers_and_days(spark):
    rows = spark.createDataFrame([("12", "2024-03-01T10:00:00Z"), ("x", "never")], "n string, d string")
    got = rows.select(tx.number_or_zero("n"), tx.day_of("d").cast("string")).collect()
    assert [tuple(r) for r in got] == [(12.0, "2024-03-01"), (0.0, None)]


def test_numbers_and_days_as_written(spark):
    rows = [("nan", "2024-01-02T23:30:00-05:00"), ("5d", "2024-01-02T23:59:59Z"), ("5f", "no day"), ("7.5", None), (None, "2024-01-02")]
    df = spark.createDataFrame(rows, "n string, t string")
    got = [tuple(r) for r in df.select(tx.number_or_zero("n"), tx.day_of("t").cast("string")).collect()]
    assert got == [(0.0, "2024-01-02"), (0.0, "2024-01-02"), (0.0, None), (7.5, None), (0.0, "2024-01-02")]


def test_fold_case_is_full_case_folding(spark):
    """Letters are equal as Python's casefold has it, up to the blocks that later Unicode versions add to."""
    letters = [chr(i) for i in range(1, 0x1C80) if chr(i) not in "ƛɤ"]
    letters += ["ss", "SS", "i̇", "ΟΔΟΣ", "οδος", "οδοσ", "straße", "STRASSE", "ΟΔΟΣ ΑΣ", "οδος ας", "ﬁ", "FI", "K", "ǆ", "ǅ"]
    df = spark.createDataFrame(list(enumerate(letters)), "i int, c string")
    folded = {r["c"]: r["f"] for r in df.select("c", tx.fold_case("c").alias("f")).collect()}
    ours, pythons = {}, {}
    for c in letters:
        ours.setdefault(folded[c], set()).add(c)
        pythons.setdefault(c.casefold(), set()).add(c)
    assert [ours[folded[c]] for c in letters] == [pythons[c.casefold()] for c in letters]
