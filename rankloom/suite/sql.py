"""Shared pieces of the check SQL (DuckDB)."""

from __future__ import annotations

from ..functions import fixed_values as fv


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


CHARS = quoted(fv.SPACE_CHARS)


def strip(x: str) -> str:
    return f"trim({x}, {CHARS})"


def squeeze(x: str) -> str:
    return f"trim(regexp_replace(coalesce(CAST({x} AS VARCHAR), ''), {quoted(fv.SPACE + '+')}, ' ', 'g'))"


def tokens(x: str) -> str:
    return f"regexp_extract_all(lower(coalesce({x}, '')), {quoted(fv.TOKEN)})"


def clean(x: str) -> str:
    for pattern, replacement in fv.CARD_CLEANING:
        swap = replacement.replace("$1", "\\1")
        x = f"regexp_replace({x}, {quoted(pattern)}, {quoted(swap)}, 'g')"
    return strip(x)


def sample_key(ident: str) -> str:
    return f"CAST('0x' || substr(md5('{fv.SEED}:' || {ident}), 1, 15) AS BIGINT)"


def compact(x: str, n: int) -> str:
    one = squeeze(x)
    return (
        f"CASE WHEN length({one}) > {n} "
        f"THEN trim(regexp_replace(substr({one}, 1, {n}), ' [^ ]*$', '')) ELSE {one} END"
    )


def clip(x: str, n: str | int) -> str:
    s = strip(x)
    cut = f"substr({s}, 1, {n})"
    last = f"({n} - instr(reverse({cut}), ' '))"
    return (
        f"CASE WHEN length({s}) > {n} THEN {strip(f'CASE WHEN instr({cut}, chr(32)) > 0 AND {last} > {n} * 0.5 THEN substr({cut}, 1, {last}) ELSE {cut} END')} "
        f"ELSE {s} END"
    )


def phrase(x: str) -> str:
    return strip(f"translate(coalesce({x}, ''), '-_', '  ')")


def task_sentence(x: str) -> str:
    return f"CASE WHEN {phrase(x)} <> '' THEN 'This model is designed for ' || {phrase(x)} || '.' ELSE '' END"


def tags_sentence(x: str) -> str:
    names = f"list_slice([p FOR p IN [{phrase('t')} FOR t IN {x}] IF p <> ''], 1, {fv.RERANK_TAGS})"
    return (
        f"CASE len({names}) WHEN 0 THEN '' WHEN 1 THEN 'Relevant tags include ' || {names}[1] || '.' "
        f"ELSE 'Relevant tags include ' || array_to_string({names}[:-2], ', ') || ', and ' || {names}[-1] || '.' END"
    )


def task_key(x: str) -> str:
    return f"translate(lower({strip(f'coalesce({x}, chr(32))')}), '_ ', '--')"


def rerank_text(strategy: str, n: str | int = fv.RERANK_TEXT_CHARS) -> str:
    """Over columns title, body, pipeline_tag, tags, model_id."""
    heading, main = strip("title"), strip("body")
    if strategy == "body_only":
        text = f"coalesce(nullif({main}, ''), {heading})"
    else:
        parts = [f"CASE WHEN {heading} <> '' THEN {heading} || '.' END"]
        if strategy != "title_body":
            parts.append(f"nullif({task_sentence('pipeline_tag')}, '')")
        if strategy == "title_task_tags_body":
            parts.append(f"nullif({tags_sentence('tags')}, '')")
        parts.append(f"nullif({main}, '')")
        text = f"concat_ws(' ', {', '.join(parts)})"
    whole = f"coalesce(nullif({strip(text)}, ''), nullif({heading}, ''), model_id)"
    return clip(whole, n)


def overlap_score(query: str, document: str) -> str:
    words = f"list_distinct({tokens(query)})"
    return (
        f"CASE WHEN len({words}) > 0 THEN len(list_intersect({words}, {tokens(document)})) * 1.0::DOUBLE "
        f"/ len({words}) ELSE 0.0::DOUBLE END"
    )


CARDS = """
raw AS (
  SELECT d.doc_id AS pos, source || '/doc-' || d.doc_id AS model_id,
         lang || ' ' || source || ' doc ' || d.doc_id AS name,
         coalesce(CAST(quality AS VARCHAR), 'unknown') AS likes,
         CAST(n_chars AS VARCHAR) AS downloads,
         '[''' || lang || ''', ''' || source || ''']' AS tags,
         lang || '_' || source AS pipeline_tag, source AS library_name,
         CAST(DATE '2024-01-01' + CAST(d.doc_id % 365 AS INTEGER) AS VARCHAR) || 'T12:34:56Z' AS createdAt,
         '[''' || lang || ''']' AS languages, text AS modelCard, lang, source
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id),
cards AS (
  SELECT pos, model_id, name, coalesce(TRY_CAST(likes AS DOUBLE), 0)::BIGINT AS likes,
         coalesce(TRY_CAST(downloads AS DOUBLE), 0)::BIGINT AS downloads,
         [lang, source] AS tags, pipeline_tag, library_name, [lang] AS languages, modelCard,
         CAST(substr(createdAt, 1, 10) AS DATE) AS createdAt
  FROM raw)"""

DOCS = """
d AS (
  SELECT doc_id AS pos, source || '/doc-' || doc_id AS model_id,
         lang || ' ' || source || ' doc ' || doc_id AS title, text AS body,
         lang || '_' || source AS pipeline_tag, [lang, source] AS tags
  FROM documents)"""

VECTOR_DOCS = (
    DOCS.replace("d AS (", "d0 AS (")
    + """,
d AS (SELECT d0.*, embedding, label FROM d0 JOIN embeddings e ON d0.pos = e.vec_id)"""
)

PASSAGES = "q AS (SELECT item_id AS query_id, text FROM benchmark)"

MEANS = """
lq AS (
  SELECT CAST(label AS BIGINT) AS query_id, list(x ORDER BY i) AS qv FROM (
    SELECT label, i, CAST(CAST(round(avg(CAST(x AS DOUBLE)), 6) AS FLOAT) AS DOUBLE) AS x FROM (
      SELECT label, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS i FROM embeddings)
    GROUP BY label, i) GROUP BY label)"""

# Every vector, and every passage with the vector of its number.
TEXT_VECTORS = """
v AS (SELECT vec_id AS pos, embedding, label FROM embeddings),
q AS (SELECT item_id AS query_id, text, CAST(embedding AS DOUBLE[]) AS qv, label FROM benchmark JOIN v ON pos = item_id)"""


def bm25(k: int) -> str:
    """CTEs up to bm(query_id, pos, score, rank) from d(pos, title, body) and q(query_id, text)."""
    return f"""
w AS (SELECT pos, {tokens("title || ' ' || body")} AS w FROM d),
ln AS (SELECT pos, len(w) AS length FROM w),
st AS (SELECT count(*) AS n, avg(length) AS avgdl FROM ln),
p AS (SELECT pos, term, count(*) AS tf FROM (SELECT pos, unnest(w) AS term FROM w) GROUP BY ALL),
tm AS (SELECT term, df, ln(n - df + 0.5) - ln(df + 0.5) AS raw
       FROM (SELECT term, count(*) AS df FROM p GROUP BY term), st),
mi AS (SELECT round(avg(raw), 10) AS mean FROM tm),
idf AS (SELECT term, CASE WHEN raw < 0 THEN {fv.BM25_EPSILON} * mean ELSE raw END AS idf FROM tm, mi),
qt AS (SELECT query_id, term, count(*) AS qtf
       FROM (SELECT query_id, unnest({tokens("text")}) AS term FROM q) GROUP BY ALL),
sc AS (SELECT query_id, p.pos, sum(qtf * idf * tf * {fv.BM25_K1 + 1} /
         (tf + {fv.BM25_K1} * ({1 - fv.BM25_B} + {fv.BM25_B} * length / avgdl))) AS score
       FROM qt JOIN idf USING (term) JOIN p USING (term) JOIN ln ON ln.pos = p.pos, st GROUP BY ALL),
bm AS (SELECT q.query_id, d.pos, coalesce(score, 0) AS score, row_number() OVER (
         PARTITION BY q.query_id ORDER BY round(coalesce(score, 0), 9) DESC, d.pos) AS rank
       FROM q CROSS JOIN d LEFT JOIN sc ON sc.query_id = q.query_id AND sc.pos = d.pos
       QUALIFY rank <= {k})"""


def dense(k: int, vectors: str = "d", metric: str = "inner_product", queries: str = "q") -> str:
    """CTE dn(query_id, pos, score, rank) from vectors(pos, embedding) and queries(query_id, qv)."""
    v = "CAST(embedding AS DOUBLE[])"
    if metric == "inner_product":
        score, way = f"list_inner_product({v}, qv)", "DESC"
    else:
        score, way = f"list_inner_product({v}, {v}) + list_inner_product(qv, qv) - 2 * list_inner_product({v}, qv)", "ASC"
    return f"""
dn AS (SELECT query_id, pos, round({score}, 9) AS score, row_number() OVER (
         PARTITION BY query_id ORDER BY round({score}, 9) {way}, pos) AS rank
       FROM {queries} CROSS JOIN {vectors} QUALIFY rank <= {k})"""


def fused(k: int, a: str = "bm", b: str = "dn", name: str = "hy", extra: str = "") -> str:
    """CTE hy(extra, query_id, pos, score, rank) from two rankings."""
    keys = f"{extra + ', ' if extra else ''}query_id, pos"
    group = f"{extra + ', ' if extra else ''}query_id"
    return f"""
{name} AS (SELECT {keys}, sum(1.0::DOUBLE / ({fv.RRF_K} + r)) AS score, row_number() OVER (
         PARTITION BY {group} ORDER BY sum(1.0::DOUBLE / ({fv.RRF_K} + r)) DESC, min(s * 1000000 + r)) AS rank
       FROM (SELECT {keys}, rank AS r, 0 AS s FROM {a} UNION ALL SELECT {keys}, rank, 1 FROM {b})
       GROUP BY {keys} QUALIFY rank <= {k})"""


def metrics(by: str = "", frame: str = "q", results: str = "res", qrels: str = "qr",
            cutoffs=fv.METRIC_CUTOFFS, tag: str = "") -> str:
    """CTE pq(by, query_id, relevant, mrr, p1, r1, n1, ...) of per-query metrics.

    tag goes into every CTE name, for a second use in one statement.
    """
    lead = f"{by}, " if by else ""
    on = " AND ".join(f"f.{c.strip()} = h.{c.strip()}" for c in (lead + "query_id").split(","))
    sums = ", ".join(
        f"count(*) FILTER (place <= {k}) AS h{k}, sum(1 / log2(place + 1)) FILTER (place <= {k}) AS g{k}"
        for k in cutoffs
    )
    out = ", ".join(
        f"coalesce(h{k}, 0) / {k}.0::DOUBLE AS p{k}, "
        f"CASE WHEN relevant > 0 THEN coalesce(h{k}, 0) * 1.0::DOUBLE / relevant ELSE 0 END AS r{k}, "
        f"CASE WHEN relevant > 0 THEN coalesce(g{k}, 0) / list_sum([1 / log2(i + 1) FOR i IN range(1, least({k}, relevant) + 1)]) ELSE 0 END AS n{k}"
        for k in cutoffs
    )
    return f"""
jd{tag} AS (SELECT DISTINCT query_id, model_id FROM {qrels}),
once{tag} AS (SELECT {lead}query_id, model_id, min(rank) AS rank FROM {results} GROUP BY ALL),
placed{tag} AS (SELECT *, row_number() OVER (PARTITION BY {lead}query_id ORDER BY rank, model_id) AS place FROM once{tag}),
hit{tag} AS (SELECT p.* FROM placed{tag} p JOIN jd{tag} USING (query_id, model_id)),
hs{tag} AS (SELECT {lead}query_id, min(place) AS first, {sums} FROM hit{tag} GROUP BY ALL),
tot{tag} AS (SELECT query_id, count(*) AS n FROM jd{tag} GROUP BY ALL),
pq{tag} AS (SELECT f.*, coalesce(relevant0, 0) AS relevant, coalesce(1.0::DOUBLE / first, 0) AS mrr, {out}
       FROM (SELECT {lead}f0.query_id, coalesce(t.n, 0) AS relevant0 FROM {frame} f0 LEFT JOIN tot{tag} t ON t.query_id = f0.query_id) f
       LEFT JOIN hs{tag} h ON {on}, LATERAL (SELECT f.relevant0 AS relevant))"""


def metric_columns(cutoffs=fv.METRIC_CUTOFFS) -> str:
    return "round(mrr, 6) AS mrr, " + ", ".join(
        f"round(p{k}, 6) AS precision_at_{k}, round(r{k}, 6) AS recall_at_{k}, round(n{k}, 6) AS ndcg_at_{k}"
        for k in cutoffs
    )


HEADLINE = (
    "round(avg(mrr), 6) AS mrr, round(avg(p5), 6) AS precision_at_5, "
    "round(avg(r20), 6) AS recall_at_20, round(avg(n10), 6) AS ndcg_at_10"
)
