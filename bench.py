"""Benchmark the headline analyses.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Runs each headline query to completion (``write.format("noop")`` executes
the whole plan without collecting to the driver): once untimed (plan
compilation, code generation, Python workers), then once timed.  Streams
rebuild their replay from scratch on every run.  Prints one JSON line:
{"metric": "total_sec", "value": N, "unit": "sec", "queries": {...}, "sf": ...}
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "q_hot_categories",
    "q_hot_category_sessions",
    "q_page_flow",
    "q_area_top3",
    "q_area_top3_remark",
    "q_word_count",
    "q_search_keywords",
    "q_search_url",
    "q_daily_conversion",
    "q_funnel_hourly",
    "q_item_top10",
    "q_repurchase_histogram",
    "q_province_top_ads",
    "q_sla_overdue",
    "agg_count_distinct",
    "topk_global",
    "join_map_lookup",
    "win_next_page",
    "st_running_state",
    "st_blacklist",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from tessera.session import get_session
    spark = get_session(f"local[{cpus}]", int(cpus),
                        extra={"spark.driver.memory": "16g"})
    from tessera.plans.registry import queries
    qs = queries()
    names = [n for n in (sys.argv[1:] or HEADLINE) if n in qs]

    def run(name: str) -> float:
        t0 = time.perf_counter()
        qs[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t0

    timings, failed = {}, []
    for n in names:
        try:
            run(n)  # untimed warm-up run of this query
            timings[n] = round(run(n), 3)
        except Exception as e:  # noqa: BLE001 - one failure must not lose the other timings
            print(f"{n} failed: {e}", file=sys.stderr)
            timings[n] = None
            failed.append(n)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    out = {"metric": "total_sec", "value": round(sum(t for t in timings.values() if t is not None), 3),
           "unit": "sec", "queries": timings, "sf": float(m.group(1)) if m else sf_dir}
    if failed:
        out["failed"] = failed
    print(json.dumps(out))


if __name__ == "__main__":
    main()
