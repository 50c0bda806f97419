"""The registered queries of this folder, and the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import settle_table
from . import chat, interpolation, jaccard, language, licenses, mixing, neardup, pieces, quality, repair, shards, toxicity, trie
from .common import held_out, table
from .sequences import numbered

#: A model file of the environment; the operators take any path.
TOKENIZER = "/opt/tokenizers/piece_bpe_32k.model"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
CHECKS: dict[str, str] = {}


def query(function: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[function.__name__] = function
    return function


@query
def op1_chat_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    extra = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(said).alias("text"),
    )
    back = chat.read_back(chat.windows(rows.unionByName(extra)))
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return back.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
        F.char_length("learned").cast("long").alias("loss_chars"),
        F.sha2("learned", 256).alias("loss_sha256"),
        "formatted_chars",
    )


@query
def op7_rendezvous_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = shards.shard(docs, {s: 1.0 for s in range(8)}, grown={s: 1.0 for s in range(9)})
    return out.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


@query
def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = language.identify(docs, language.fit(docs), keep=["doc_id"])
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


@query
def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


@query
def op2_toxic_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = toxicity.assess(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")), keep=["doc_id"])
    return out.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted", F.size("passages").cast("long").alias("n_passages")
    )


@query
def op8_shared_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.assess(table(spark, sf_dir, "documents")).drop("words_lost")


@query
def op3_sentence_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = pieces.encode(table(spark, sf_dir, "documents"), TOKENIZER, keep=["doc_id", "text"])
    back = pieces.decode(coded, TOKENIZER, into="decoded")
    return back.select(
        "doc_id",
        F.size("input_ids").cast("long").alias("n_pieces"),
        F.sha2(F.array_join("input_ids", " "), 256).alias("pieces_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
        F.col("decoded").eqNullSafe(F.col("text")).alias("restored"),
    )


@query
def op5_pfair_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mixing.mix(table(spark, sf_dir, "documents").select("doc_id", "source", "text"))
    return out.select("doc_id", "source", "source_block", "mix_slot", "mix_position")


@query
def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.join(table(spark, sf_dir, "documents"))


@query
def op4_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.link(table(spark, sf_dir, "embeddings"))


@query
def op11_interpolated_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    part = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5, F.lit(2))
    use = F.when(part == 1, interpolation.HELD_OUT).when(part == 0, interpolation.WEIGHED).otherwise(interpolation.COUNTED)
    out = interpolation.interpolate(docs, use)
    return out.withColumn("held_out", F.col("use") == interpolation.HELD_OUT).drop("use")


def rebuilt(rows: DataFrame) -> DataFrame:
    """conv_id, depth, role, text: the first h turns of conversation c - c % 5, then c's own after its first h.

    h is crc32 of c in decimal, modulo 9. Turns are ordered by (turn, role, text), nulls first.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    rows = rows.where("conv_id is not null").select("conv_id", "turn", role.alias("role"), text.alias("text"))
    placed = settle_table(numbered(rows, "conv_id", "turn", ["role", "text"]).drop("turn"))
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % 9).alias("h")
    lengths = placed.groupBy("conv_id").agg((F.max("at") + 1).alias("n"))
    plans = lengths.select("conv_id", h, (F.col("conv_id") - F.col("conv_id") % 5).alias("base"))
    counts = lengths.select(F.col("conv_id").alias("base"), "n")
    plans = plans.join(counts, "base", "left").withColumn("taken", F.least("h", F.coalesce("n", F.lit(0)))).drop("n")
    heads = placed.where("at < 8").withColumnRenamed("conv_id", "base")
    begun = plans.join(heads, "base").where("at < h").select("conv_id", (F.col("at") + 1).alias("depth"), "role", "text")
    gone_on = placed.join(plans, "conv_id").where("at >= h")
    return begun.unionByName(gone_on.select("conv_id", (F.col("taken") + F.col("at") - F.col("h") + 1).alias("depth"), "role", "text"))


@query
def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations")
    return trie.prefix_trie(rows, rebuilt(rows)).drop("node", "parent")


def crc32_sql(text: str) -> str:
    """CRC-32 of an ASCII text as DuckDB SQL, bit by bit."""
    bits = "list_reduce(range(8), lambda c, i: xor(c >> 1, CASE WHEN c & 1 = 1 THEN 3988292384 ELSE 0 END), xor(crc, ch))"
    chars = f"list_transform(string_split({text}, ''), lambda s: ascii(s)::BIGINT)"
    return f"xor(list_reduce({chars}, lambda crc, ch: {bits}, 4294967295::BIGINT), 4294967295::BIGINT)"


CHECKS["op12_prefix_trie"] = f"""
WITH placed AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) - 1 AS place
  FROM conversations WHERE conv_id IS NOT NULL),
plans AS (
  SELECT conv_id, conv_id - conv_id % 5 AS base, {crc32_sql("conv_id::VARCHAR")} % 9 AS h
  FROM (SELECT DISTINCT conv_id FROM placed)),
mixed AS (
  SELECT p.conv_id, 0 AS own, b.place, b.role, b.text FROM plans p JOIN placed b ON b.conv_id = p.base AND b.place < p.h
  UNION ALL
  SELECT p.conv_id, 1, b.place, b.role, b.text FROM plans p JOIN placed b ON b.conv_id = p.conv_id AND b.place >= p.h),
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY own, place) AS depth FROM mixed),
paths AS (
  SELECT conv_id, depth, octet_length(encode(text)) AS bytes, string_agg(length(role) || ':' || length(text) || ':' || role || text, '')
    OVER (PARTITION BY conv_id ORDER BY depth) AS path
  FROM numbered
  UNION ALL SELECT conv_id, 0, 0, '' FROM plans),
nodes AS (
  SELECT depth, path, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(bytes) AS bytes FROM paths GROUP BY ALL),
members AS (
  SELECT p.conv_id AS member, n.* FROM paths p JOIN nodes n USING (depth, path)),
edges AS (
  SELECT DISTINCT p.depth, p.path, p.conv_id AS parent_conv_id, c.path AS child
  FROM members p JOIN members c ON c.member = p.member AND c.depth = p.depth + 1),
leaves AS (
  SELECT * FROM nodes n WHERE NOT EXISTS (SELECT 1 FROM edges e WHERE e.depth = n.depth AND e.path = n.path)),
below AS (
  SELECT DISTINCT a.depth, a.path, b.depth AS depth_below, b.path AS path_below, b.n_convs, b.bytes
  FROM members a JOIN members b ON a.member = b.member AND b.depth >= a.depth),
totals AS (
  SELECT b.depth, b.path, sum((b.n_convs - 1) * b.bytes)::BIGINT AS saved_tokens, count(l.path) AS n_leaves
  FROM below b LEFT JOIN leaves l ON l.depth = b.depth_below AND l.path = b.path_below GROUP BY 1, 2),
ends AS (
  SELECT depth, path, sha256(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id)) AS ends_sha256
  FROM (SELECT * FROM paths QUALIFY depth = max(depth) OVER (PARTITION BY conv_id)) GROUP BY 1, 2),
fanout AS (SELECT depth, path, count(*) AS n_children FROM edges GROUP BY 1, 2)
SELECT n.conv_id, n.depth::BIGINT AS depth, e.parent_conv_id, n.n_convs, coalesce(f.n_children, 0) AS n_children,
  t.n_leaves, t.saved_tokens, coalesce(x.ends_sha256, sha256('')) AS ends_sha256
FROM nodes n JOIN totals t USING (depth, path) LEFT JOIN fanout f USING (depth, path) LEFT JOIN ends x USING (depth, path)
LEFT JOIN edges e ON e.depth + 1 = n.depth AND e.child = n.path
"""


def damaged(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, within: conversations with faults, by crc32 of `conv_id:turn` (nulls one space) modulo 20.

    0 drops a row, 1 empties its text, 2 removes `.`, `!` and `?`, 3 repeats it beside itself, 4 makes its role user.
    `within` orders the rows of a turn as they were, a repeated one after the other.
    """
    space = F.lit(" ")
    name = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    rows = rows.select(
        "conv_id", "turn", F.coalesce("role", space).alias("role"), F.coalesce("text", space).alias("text"),
        (F.crc32(name.cast("binary")) % 20).alias("fault"),
    ).where("fault != 0")
    text = F.when(F.col("fault") == 1, "").when(F.col("fault") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    copies = F.when(F.col("fault") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.withColumn("copy", F.explode(copies)).select(
        "conv_id", "turn", F.when(F.col("fault") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"),
        F.struct("role", "text", "copy").alias("within"),
    )


@query
def op13_structure_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations")
    return repair.report(rows, damaged(rows), within="within")


def _repair_sql() -> str:
    """The cheapest edits as a fold over a conversation's rows: of each state the least (cost, audit), with the lines so far."""
    never = "{'c': 1099511627776::BIGINT, 'a': '', 't': []::VARCHAR[]}"

    def add(state: str, cost: str, letter: str, line: str = "") -> str:
        lines = f"list_append({state}.t, {line})" if line else f"{state}.t"
        return f"{{'c': {state}.c + {cost}, 'a': {state}.a || '{letter}', 't': {lines}}}"

    def least(*ways: str) -> str:
        return f"list_min([{', '.join(ways)}])"

    def read(state: int) -> str:
        ways = [add(f"v.s{state}", "3", "D")]
        for before, role, after in ((0, "s", 1), (0, "u", 2), (1, "u", 2), (2, "a", 3), (3, "u", 2)):
            if after == state:
                free = "x.m IN ('.', 't')"
                more = "CASE x.m WHEN 't' THEN 1 ELSE 0 END"
                kept = add(f"v.s{before}", more, "K", "x.r || ':' || x.t")
                ways.append(f"CASE WHEN {free} AND x.i = '{role}' THEN {kept} ELSE {never} END")
                if role != "s":
                    name = {"u": "user", "a": "assistant"}[role]
                    changed = add(f"v.s{before}", f"2 + {more}", "R", f"'{name}:' || x.t")
                    ways.append(f"CASE WHEN {free} THEN {changed} ELSE {never} END")
        return least(*ways)

    user, assistant = "'user:'", "'assistant:'"
    begun = f"{{'s0': {{'c': 0::BIGINT, 'a': '', 't': []::VARCHAR[]}}, 's1': {never}, 's2': {never}, 's3': {never}}}"

    def closed(states: str) -> str:
        s2 = least("w.s2", add("w.s0", "2", "I", user), add("w.s1", "2", "I", user), add("w.s3", "2", "I", user))
        once = f"list_transform([{states}], lambda w: {{'s0': w.s0, 's1': w.s1, 's2': {s2}, 's3': {least('w.s3', add('w.s2', '2', 'I', assistant))}}})[1]"
        twice = f"{{'s0': y.s0, 's1': y.s1, 's2': y.s2, 's3': {least('y.s3', add('y.s2', '2', 'I', assistant))}}}"
        return f"list_transform([{once}], lambda y: {twice})[1]"

    step = "{" + ", ".join(f"'s{q}': {read(q)}" for q in range(4)) + "}"
    return f"""
WITH said AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    {crc32_sql("coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')")} % 20 AS fault
  FROM conversations),
damaged AS (
  SELECT conv_id, turn, CASE fault WHEN 4 THEN 'user' ELSE role END AS role,
    CASE fault WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    role AS was, text AS had, copy
  FROM said, unnest(CASE fault WHEN 3 THEN [0, 1] ELSE [0] END) AS copies(copy) WHERE fault <> 0),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, was, had, copy, role, text) AS place FROM damaged),
marked AS (
  SELECT *, CASE
      WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'b'
      WHEN place > min(place) OVER (PARTITION BY conv_id, role, text) THEN 'd'
      WHEN right(regexp_replace(text, '[\x20\x09-\x0D]+$', ''), 1) NOT IN ('.', '!', '?') THEN 't' ELSE '.' END AS mark,
    lag(role) OVER (PARTITION BY conv_id ORDER BY place) AS earlier
  FROM placed),
counted AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count(*) FILTER (mark = 'b') AS blank, count(*) FILTER (mark = 'd') AS duplicate, count(*) FILTER (mark = 't') AS truncated,
    count(*) FILTER (earlier IS NOT NULL AND left(earlier, 1) || left(role, 1) NOT IN ('su', 'ua', 'au')) AS illegal,
    list({{'i': left(role, 1), 'm': mark, 'r': role, 't': text}} ORDER BY place) AS rows
  FROM marked GROUP BY conv_id),
folded AS (
  SELECT *, list_reduce(rows, lambda v, x: {closed(step)}, {closed(begun)}) AS v FROM counted),
best AS (
  SELECT *, {least("v.s0", "v.s3")} AS b FROM folded)
SELECT c.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(b.c, 0) AS cost, coalesce(b.a, '') AS audit,
  sha256(coalesce(array_to_string(b.t, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN best ON c.conv_id IS NOT DISTINCT FROM best.conv_id
"""


CHECKS["op13_structure_repair"] = _repair_sql()
