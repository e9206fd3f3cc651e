"""Time the headline queries and print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default: all cores),
BENCH_QUERIES (comma-separated name prefixes; default: the headline list, `all`
for every registered query), BENCH_RUNS (best of n, default 1).
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

from tallyloom import build_session
from tallyloom.plans import QUERIES, load_all

HEADLINE = """
    S15_content_digest F01_catalog_search F11_low_quality F19_page_slice J01_enrich_left J02_lookup_name
    J05_semi_filter J08_thread_self_join J09_keyword_join J11_similarity_topk_join J12_lexicon_join
    A01_count_by A03_registry_totals A09_quality_issues A10_profile_columns A14_correlation_pairs
    A17_classification_metrics A25_loss_curve A31_dashboard_rollup W01_leaderboard W02_keep_best
    W05_tolerance_bands W08_running_best W10_progress_pct L05_recent_n U01_drop_duplicate_rows
    U02_dedup_by_hash U07_leakage_overlap U09_upsert P01_random_split P05_stratified_kfold P06_row_cap_sample
    C11_strip_html C12_moderate C15_char_ngrams C16_lexicon_sentiment X06_standardise X10_tfidf
    X15_cosine_match_level M03_knn_predict M17_score_linear E03_diagnose E09_removal_plan E10_retrain_queue
    R06_signal_quality R14_health_score R15_decision_path T02_latest_state T06_alert_cooldown T07_rate_limit
""".split()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS") or str(os.cpu_count())
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    chosen = os.environ.get("BENCH_QUERIES", "")
    load_all()
    names = list(QUERIES) if chosen == "all" else (
        [q for q in QUERIES if q.startswith(tuple(chosen.split(",")))] if chosen else HEADLINE)
    spark = build_session("bench", f"local[{cpus}]", spark__sql__shuffle__partitions=cpus,
                          spark__ui__enabled="false", spark__ui__showConsoleProgress="false",
                          spark__driver__memory=os.environ.get("BENCH_MEMORY", "16g"),
                          spark__checkpoint__dir=os.environ.get("BENCH_SHARED") or tempfile.mkdtemp(prefix="tallyloom-"))
    spark.sparkContext.setLogLevel("ERROR")
    # the first job pays for JVM and Python worker start-up
    spark.range(1000).mapInPandas(lambda b: b, "id long").count()
    spark.read.parquet(f"{sf_dir}/lineitem.parquet").groupBy("l_returnflag").count().collect()
    times: dict[str, float] = {}
    for name in names:
        best = None
        for _ in range(runs):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            took = time.perf_counter() - start
            best = took if best is None else min(best, took)
        times[name] = round(best, 3)
        print(f"{name:36s} {best:8.3f}s", file=sys.stderr, flush=True)
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")}))
    spark.stop()


if __name__ == "__main__":
    main()
