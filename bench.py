"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints ONE JSON line: {"metric", "value" (total seconds), "unit", "queries",
"sf", ...}.  Each query runs fully (``noop`` sink: every row is produced, none
is shipped to the driver) after an untimed warm-up pass on sf0.001; the median
of its runs counts.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "a1_engagement_rate", "j1_merge_features", "j2_prefix_match", "r1_rank_category", "r2_rank_all",
    "r4_many_brands", "t3_trait_count", "a10_term_frequency", "a6_alignment", "a9_sentiment_histogram",
    "n1_flatten_tree", "n2_classify_titles", "a16_roc_pr", "r5_ranking_evaluation", "a15_classification_report",
    "t7_tfidf_documents", "a17_silhouette", "w2_sorted_silhouette", "w1_roc_curve", "t3_genz_traits",
    "a10_genz_term_frequency", "m1_kmeans", "m4_svm_report",
]
RUNS, ENOUGH = 3, 15.0   # a query runs three times, or until that many seconds are spent


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from creatorlens.session import local_session
    from creatorlens.plans.queries import QUERIES
    import pyspark

    spark = local_session(cpus, shuffle_partitions=int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", "16")),
                          app="creatorlens-bench")
    warm = os.environ.get("BENCH_WARMUP_DIR", "/root/testdata/sf0.001")
    if warm and os.path.isdir(warm):
        for name in HEADLINE:
            QUERIES[name](spark, warm).write.format("noop").mode("overwrite").save()
    times = {}
    for name in HEADLINE:
        runs = []
        while len(runs) < RUNS and sum(runs) < ENOUGH:
            t0 = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - t0)
        times[name] = round(statistics.median(runs), 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "headline_queries_total_time", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": float(m.group(1)) if m else sf_dir,
        "spark": pyspark.__version__, "cores": cpus,
        "shuffle_partitions": spark.conf.get("spark.sql.shuffle.partitions"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
