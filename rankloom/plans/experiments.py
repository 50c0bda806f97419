"""Comparisons of systems, reranking settings, indexes and encoders.

All systems and settings of a comparison are rows of one table, told apart by
key columns, and are evaluated in one aggregate.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import fixed_values as fv
from ..functions import text as tx
from ..operators import evaluate as ev
from ..operators import profile as pf
from ..operators import rerank as rr
from ..operators.ann import ListIndex, ProjectionIndex, recall
from ..operators.dense import search
from ..operators.encode import HashedTermEncoder
from ..operators.fusion import fuse
from ..operators.ordering import QueryBatch
from ..session import settle_table
from .search import Retriever, with_payload


def named(rows: DataFrame, **values) -> DataFrame:
    return rows.withColumns({k: F.lit(v) for k, v in values.items()})


def for_each(queries: DataFrame, settings: Sequence[dict]) -> DataFrame:
    """(query_id, settings columns): every query under each of a few settings."""
    structs = [F.struct(*[F.lit(v).alias(k) for k, v in row.items()]) for row in settings]
    return queries.select("query_id", F.explode(F.array(*structs)).alias("s")).select(
        "query_id", "s.*"
    )


def system_results(
    batch: QueryBatch,
    docs: DataFrame,
    lexical: Retriever,
    dense_side: Retriever,
    scorer: rr.PairScorer,
    *,
    reranked: int = fv.RERANKED,
) -> DataFrame:
    """(system, query_id, model_id, rank) of four systems; each retriever runs once."""
    lex, den = settle_table(lexical(batch)), settle_table(dense_side(batch))
    hybrid = settle_table(batch.cut(fuse([lex, den], top_k=batch.top_k)))
    candidates = with_payload(hybrid, docs, batch)
    scored = rr.rerank(candidates, batch, scorer, top_k=reranked)
    ids = docs.select("pos", "model_id")
    plain = reduce(
        DataFrame.unionByName,
        [
            named(df.select("query_id", "pos", "rank"), system=name)
            for name, df in (("bm25", lex), ("dense", den), ("hybrid_rrf", hybrid))
        ],
    )
    bounded = batch.rows is not None and batch.rows * batch.top_k * 3 <= 1_000_000
    hits = F.broadcast(plain) if bounded else plain
    final = named(scored.select("query_id", "model_id", "rank"), system="hybrid_rrf_cross_encoder")
    return ids.join(hits, "pos").drop("pos").unionByName(final)


SYSTEMS = ("bm25", "dense", "hybrid_rrf", "hybrid_rrf_cross_encoder")


def compare_systems(batch: QueryBatch, results: DataFrame, qrels: DataFrame) -> DataFrame:
    """Per-query metrics of every system."""
    frame = for_each(batch.df, [{"system": name} for name in SYSTEMS])
    return ev.per_query_metrics(frame, results, qrels, by=("system",))


def ablation_settings() -> list[dict]:
    return [
        {"text_variant": name, "candidate_k": size}
        for size in fv.ABLATION_SIZES
        for name, _, _ in fv.ABLATION_TEXTS
    ]


def hybrid_by_size(
    batch: QueryBatch, lexical: Retriever, dense_side: Retriever, sizes: Sequence[int]
) -> DataFrame:
    """(candidate_k, query_id, pos, score, rank): the hybrid ranking at every size.

    The sources are searched once at the largest size; a smaller list is its head.
    """
    queries = batch.df.withColumn("top_k", F.lit(max(sizes)))
    wide = replace(batch, df=queries, top_k=max(sizes), uniform=True)

    def heads(ranking: DataFrame) -> DataFrame:
        size = F.explode(F.array(*[F.lit(n) for n in sizes]))
        rows = ranking.select("query_id", "pos", "rank", size.alias("candidate_k"))
        return rows.where(F.col("rank") <= F.col("candidate_k"))

    both = [heads(settle_table(r(wide))) for r in (lexical, dense_side)]
    fused = fuse(both, group=("candidate_k", "query_id"), top_k=max(sizes))
    return settle_table(fused.where(F.col("rank") <= F.col("candidate_k")))


def ablation_candidates(
    hybrid: DataFrame, docs: DataFrame, batch: QueryBatch, scorer: rr.PairScorer
) -> DataFrame:
    """Every candidate of every size scored under every text variant.

    A pair is scored once per variant, not once per size: candidates of the
    sizes share their documents.
    """
    pairs = hybrid.select("query_id", "pos").distinct()
    hits = F.broadcast(pairs) if batch.rows is not None and batch.rows <= 1000 else pairs
    wide = docs.join(hits, "pos").withColumn("snippet", tx.snippet("body"))
    texts = F.array(
        *[
            F.struct(F.lit(name).alias("text_variant"), tx.rerank_text(strategy, chars).alias("text"))
            for name, strategy, chars in fv.ABLATION_TEXTS
        ]
    )
    scored = (
        wide.select("query_id", "pos", "model_id", F.explode(texts).alias("t"))
        .join(batch.df.select("query_id", F.col("text").alias("_query")), "query_id")
        .select(
            "query_id", "pos", "model_id", "t.text_variant",
            scorer(F.col("_query"), F.col("t.text")).alias("pair_score"),
        )
    )
    return hybrid.select("candidate_k", "query_id", "pos", "rank").join(
        settle_table(scored), ["query_id", "pos"]
    )


GRID = ("text_variant", "candidate_k", "query_id")


def ablation(
    scored: DataFrame, batch: QueryBatch, qrels: DataFrame, reranked: int = fv.RERANKED
) -> DataFrame:
    """Headline metrics per text variant and candidate number, pure scorer order."""
    ranked = rr.order_by_pair_score(scored, reranked, GRID)
    frame = for_each(batch.df, ablation_settings())
    per_query = ev.per_query_metrics(frame, ranked, qrels, by=GRID[:2])
    return ev.compact_table(per_query, GRID[:2])


def fusion_comparison(
    scored: DataFrame,
    batch: QueryBatch,
    qrels: DataFrame,
    best: DataFrame,
    reranked: int = fv.RERANKED,
) -> DataFrame:
    """Hybrid, pure scorer and their fusion at the best setting of an ablation."""
    chosen = best.select("text_variant", "candidate_k")
    at_best = settle_table(scored.join(F.broadcast(chosen), ["text_variant", "candidate_k"]))
    pure = rr.order_by_pair_score(at_best, reranked)
    mixed = rr.fuse_with_candidates(at_best, limit=reranked)
    columns = ("query_id", "model_id", "rank")
    results = reduce(
        DataFrame.unionByName,
        [
            named(df.select(*columns), system=name)
            for name, df in (
                ("Hybrid", at_best), ("Pure CrossEncoder", pure), ("Hybrid + CE Fusion", mixed),
            )
        ],
    )
    names = ("Hybrid", "Pure CrossEncoder", "Hybrid + CE Fusion")
    frame = for_each(batch.df, [{"system": name} for name in names])
    return ev.compact_table(ev.per_query_metrics(frame, results, qrels, by=("system",)))


def compare_indexes(
    vectors: DataFrame, queries: DataFrame, *, dim: int, nlist: int = 100, nprobe: int = 10,
    m: int = 8, nbits: int = 8, tables: int = 32, metric: str = "inner_product",
) -> DataFrame:
    """(index, build_sec, search_sec, table_rows, recall) of four ways to search.

    Building writes the index table, searching writes its result; both are
    timed as whole jobs.
    """
    spark = vectors.sparkSession
    batch = QueryBatch.of(queries)

    def timed(job: Callable):
        start = time.perf_counter()
        out = job()
        return out, time.perf_counter() - start

    truth, exact_sec = timed(lambda: settle_table(search(vectors, batch, dim=dim, metric=metric)))
    rows = [("exact", 0.0, exact_sec, dim * 4, truth)]

    def built(make):
        return timed(lambda: _written(make()))

    lists, sec = built(lambda: ListIndex.build(vectors, nlist=nlist, metric=metric))
    found, search_sec = timed(lambda: settle_table(lists.search(batch, nprobe)))
    rows.append(("ivf", sec, search_sec, dim * 4 + 4, found))
    coded, sec = built(lambda: ListIndex.build(vectors, nlist=nlist, metric=metric, m=m, nbits=nbits))
    found, search_sec = timed(lambda: settle_table(coded.search(batch, nprobe)))
    rows.append(("ivf_pq", sec, search_sec, m * 2 + 4, found))
    buckets, sec = built(lambda: ProjectionIndex.build(vectors, dim, tables=tables, metric=metric))
    found, search_sec = timed(lambda: settle_table(buckets.search(batch)))
    rows.append(("projections", sec, search_sec, dim * 4 + tables * 4, found))
    n = vectors.count()
    parts = [
        recall(found, truth)
        .agg(F.avg("recall").alias("recall"))
        .select(
            F.lit(name).alias("index"),
            F.lit(float(build)).alias("build_sec"),
            F.lit(float(sec)).alias("search_sec"),
            F.lit(n * width / 2**20).alias("memory_mb"),
            "recall",
        )
        for name, build, sec, width, found in rows
    ]
    return reduce(DataFrame.unionByName, parts)


def _written(index):
    """The index with its table written once to the shared folder."""
    return replace(index, table=settle_table(index.table))


def batch_latency(seconds: float, queries: int) -> float:
    """Mean milliseconds per query of one job over a batch."""
    return 1000.0 * seconds / queries if queries else 0.0


def profile_vectors(
    rows: DataFrame, *, sample_rows: int | None = None, clusters: int = 12, n_pairs: int = 20_000,
    seed: int = fv.SEED,
) -> DataFrame:
    """One row: lengths, cosines of drawn pairs, variance and clusters, of all vectors; the latter three of sample_rows where given."""
    spark = rows.sparkSession
    sample = settle_table(
        pf.sample_rows(rows, sample_rows, seed)
    )
    n = sample.count()
    stats = pf.norm_stats(rows)
    cosines = pf.cosine_distribution(pf.pair_cosines(sample, n_pairs, seed)).first()
    dim = len(sample.first().embedding) if n else 0
    components = min(50, dim, n)
    ratios = pf.Projection(sample, components).explained if n > 1 else []
    sizes = pf.fit_kmeans(sample, clusters, seed).groupBy("cluster").count() if n > 1 else None
    values = {
        "sample_size": n,
        "pca_components": components,
        "explained_variance_pc1": ratios[0] if ratios else None,
        "explained_variance_pc2": ratios[1] if len(ratios) > 1 else None,
        "cumulative_explained_variance_10": sum(ratios[:10]) if ratios else None,
        "cumulative_explained_variance_50": sum(ratios) if ratios else None,
        "n_clusters": sizes.count() if sizes is not None else n,
    }
    if cosines is not None:
        values.update({f"cosine_{k}": v for k, v in cosines.asDict().items()})
    return stats.select("*", *[F.lit(v).alias(k) for k, v in values.items()])


def encoder_experiment(
    rows: DataFrame, encoders: dict[str, int], *, target_dim: int, sample_rows: int | None = None
) -> DataFrame:
    """Encode with each encoder, profile each result, and shrink the first one.

    rows: pos, text and metadata. encoders: name to dimension of the default
    encoder.
    """
    parts, first = [], None
    for name, dim in encoders.items():
        encoder = HashedTermEncoder(dim).fit(rows)
        vectors = settle_table(encoder.encode(rows).select("pos", "embedding"))
        parts.append(named(profile_vectors(vectors, sample_rows=sample_rows), representation=name))
        if first is None:
            first = (name, dim, vectors)
    name, dim, vectors = first
    small, _ = pf.shrink(vectors, target_dim, dim=dim, fit_rows=sample_rows)
    small = settle_table(small)
    parts.append(
        named(profile_vectors(small, sample_rows=sample_rows), representation=f"{name}-pca{target_dim}")
    )
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
