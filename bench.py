"""Headline query timings: prints one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).
Every query is run once to warm up on the smallest tables, then timed on
the bench tables, writing its full result to a discarding sink.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from ferrolith.catalog import QUERIES  # noqa: E402
from ferrolith.session import build_session  # noqa: E402

HEADLINE = [
    "delay_pairs", "delay_whatif_grid", "previous_by_key", "late_share", "flatten_nested", "group_count_desc", "topk_ratio",
    "price_buckets", "explode_tokens", "having_avg_mix", "top_n_semi_join", "availability_rate", "kpi_row", "missing_ids",
    "describe_overall", "describe_categorical", "missing_profile", "stats_map_report", "first_row_per_id", "corr_by_group",
    "corr_matrix_long", "self_vs_received", "three_sigma_sequential", "histogram_equal_width", "boxplot_stats", "class_report",
    "roc_auc", "f1_threshold_sweep", "stratified_folds", "stratified_split", "heuristic_score", "impute_scale", "clean_text",
    "tfidf_long", "bigrams", "top_words_by_class", "padded_sequences", "cosine_topk", "html_fields_fallback",
    "first_n_per_group", "rank_join_filter", "access_decision", "resident_snapshot", "one_read_per_passage", "ols",
    "kmeans_zones", "pca2", "stream_access", "stream_hourly", "dbscan_euclid",
]


def run(spark, name: str, folder: str) -> float:
    started = time.perf_counter()
    QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = build_session("bench", cpus, partitions=int(cpus))
    warm = os.path.join(os.path.dirname(folder.rstrip("/")), "sf0.001")
    timings = {}
    for name in names:
        if os.path.isdir(warm):
            run(spark, name, warm)
        timings[name] = round(run(spark, name, folder), 3)
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(timings.values()), 3), "unit": "sec", "queries": timings,
        "sf": os.path.basename(folder.rstrip("/")),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
