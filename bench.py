"""Time the headline queries: BENCH_SF_DIR (default sf0.1) on local[BENCH_CPUS]; prints one JSON line.

Each query runs BENCH_RUNS times (default 3); its value is the median, its spread the slowest less the fastest run, and ``first`` the first, cold
run. The total is of the headline queries, which are the same in every round; ``more`` are timed beside them.
"""

from __future__ import annotations

import json
import os
import statistics
import tempfile
import time

HEADLINE = [
    "x8_sessionize", "x5_pages_in_session", "c1_current_state", "c2_two_phase_fold", "c3_composite_key", "c4_incremental_fold",
    "m1_upsert", "s17_upsert_composite", "w1_replace_windows", "h2_snapshot_check", "h8_aggregate_snapshot", "j1_inner_join",
    "j6_range_join", "n3_running_sum", "a1_group_by", "a10_daily_and_weekly", "a18_metric_query", "k7_contract_credits",
    "k10_arr_by_month", "f9_html_clean", "f3_uri_percent_decode", "f22_arr_correction", "v3_flatten_array", "v19_attach_children",
    "q7_conflicting_mapping", "q20_check_runner", "s7_forced_reload", "r2_stream_current_state", "r3_stream_sessions", "l4_stratified_split",
]
MORE = ["c4_bucketed_fold", "h3_split_history", "j6_hierarchical_periods", "j7_pattern_index", "m1_bucketed_upsert", "q17_schema_contract", "q20_one_pass_rules", "r3_unknown_visitors"]


def main() -> None:
    root = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 4))

    from lakeops.queries import QUERIES
    from lakeops.session import clear_scratch, local_session

    shared = {"spark.checkpoint.dir": tempfile.mkdtemp(prefix="lakeops-bench-")}  # one machine, so all tasks see it
    spark = local_session(cpus, shuffle_partitions=max(8, int(cpus)) if cpus.isdigit() else 8, settings=shared)
    spark.read.parquet(f"{root}/orders.parquet").count()
    seconds: dict[str, float] = {}
    spread: dict[str, float] = {}
    first: dict[str, float] = {}
    for name in HEADLINE + MORE:
        runs = []
        for _ in range(int(os.environ.get("BENCH_RUNS", "3"))):
            start = time.perf_counter()
            # The noop sink computes every column of every row without moving them to the driver.
            QUERIES[name](spark, root).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - start)
        seconds[name], spread[name] = round(statistics.median(runs), 3), round(max(runs) - min(runs), 3)
        first[name] = round(runs[0], 3)
        clear_scratch(spark)
    line = {
        "metric": "headline_queries_total", "value": round(sum(seconds[n] for n in HEADLINE), 3), "unit": "sec",
        "queries": {n: seconds[n] for n in HEADLINE}, "spread": spread, "first": first, "more": {n: seconds[n] for n in MORE}, "sf": os.path.basename(root.rstrip("/")).removeprefix("sf"),
    }
    print(json.dumps(line))
    spark.stop()


if __name__ == "__main__":
    main()
