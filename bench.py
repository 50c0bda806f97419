"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Every query runs once to warm up and BENCH_RUNS times (2) for the figure, the
median. The result is written to Spark's noop sink.
"""

import json
import os
import pathlib
import statistics
import sys
import time

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parent))

from rankloom.session import local_session
from rankloom.suite import QUERIES

HEADLINE = (
    "b1_tokenize",
    "b2_clean_card",
    "b7_card_text",
    "b16_rerank_text",
    "e1_term_idf",
    "h1_bm25_search",
    "f1_bm25_conversation_turns",
    "i1_exact_top_k",
    "i3_given_lists",
    "j2_hybrid_search",
    "j4_fused_rerank",
    "k2_known_item_summary",
    "k7_system_comparison",
    "k8_rerank_ablation",
    "f5_popular_and_random",
    "a6_clean_cards",
    "e3_norm_stats",
    "e5_cluster_summary",
    "l3_shrunk_vectors",
    "m1_encoded_cards",
)


def run(spark, sf_dir: str, name: str) -> float:
    started = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    names = sys.argv[1:] or HEADLINE
    spark = local_session(cpus, partitions=int(cpus) if cpus.isdigit() else 8, memory="16g")
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in names:
        run(spark, sf_dir, name)
        seconds[name] = round(statistics.median(run(spark, sf_dir, name) for _ in range(runs)), 3)
    print(
        json.dumps(
            {
                "metric": "sum of median warm seconds of the headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": pathlib.Path(sf_dir).name.removeprefix("sf"),
                "cpus": cpus,
            }
        )
    )


if __name__ == "__main__":
    main()
