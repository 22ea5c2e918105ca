"""Time the headline queries; prints one JSON line.

Reads $BENCH_SF_DIR (default /root/testdata/sf0.1) on local[$BENCH_CPUS]. Every query runs to
completion into a sink that reads all columns; the first run warms up, the best of the rest counts.
"""

from __future__ import annotations

import json
import os
import sys
import time
import uuid

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from worktide.catalog import all_queries, pipeline_queries  # noqa: E402
from worktide.catalog.base import Tables  # noqa: E402
from worktide.session import build_session, checkpoint_dir  # noqa: E402

HEADLINES = (
    "d15_skill_demand_by_category", "f02_s02_standardized_postings", "d14_j02_star_fact", "w03_content_dedupe",
    "w05_w06_latest_event_per_user", "w10_running_total", "s12_merge_update_all", "j01_j02_j06_star_lookup",
    "j11_a10_f10_export_frame", "a02_skill_coverage", "a03_word_frequency", "x15_clean_requirement", "x30_find_terms",
    "k01_vocabulary_skill_extraction", "k02_greedy_leaders", "n01_tfidf_cosine_top_k", "n05_x33_x34_scored_interactions",
    "n06_user_based_filtering", "m06_d09_u02_fact_macro", "m11_vector_autoregression", "r03_gold_increments",
    "r04_latest_state_over_batches", "n02_hybrid_rank", "n07_item_based_filtering", "k04_components", "a17_drop_rare_singletons",
    "j09_f11_w17_candidates", "m12_lag_order_sweep", "m15_forecast_errors", "x12_industry_rules_by_table", "s18_rewritten_and_verified",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = build_session(
        "bench", f"local[{cpus}]",
        **{"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "16g", "spark.ui.showConsoleProgress": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    registered, seconds = all_queries(), {}
    for name in os.environ.get("BENCH_QUERIES", ",".join(HEADLINES)).split(","):
        times = []
        for _ in range(runs):
            start = time.perf_counter()
            registered[name](spark, folder).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        seconds[name] = round(min(times[1:] or times), 3)
        print(f"{name} {[round(x, 2) for x in times]}", file=sys.stderr, flush=True)
    extra = {}
    if "r03_gold_increments" in seconds:  # the increments apart from making what they read
        tables = Tables(spark, folder)
        root = f"{checkpoint_dir(spark)}/bench-{uuid.uuid4().hex}"
        pipeline_queries.enriched(tables).write.parquet(f"{root}/silver")
        start = time.perf_counter()
        pipeline_queries.gold_batches(tables, root).write.format("noop").mode("overwrite").save()
        extra["r03_increments_alone"] = round(time.perf_counter() - start, 3)
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"), "cpus": int(cpus), "runs": runs, "apart": extra,
    }))


if __name__ == "__main__":
    main()
