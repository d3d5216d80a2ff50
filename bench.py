"""Benchmark the headline jobs.

Runs each job on ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) with
``local[$BENCH_CPUS]`` and prints ONE JSON line:
  {"metric": "total_median_sec", "value": N, "unit": "sec", "queries": {...}, "sf": ...}

Each job is executed to completion into Spark's ``noop`` sink (all rows
computed, none collected); one warm-up run, then the median of
``$BENCH_RUNS`` (default 5) timed runs.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from shoplens import apps, registry  # noqa: E402
from shoplens.session import get_session  # noqa: E402

HEADLINE = {
    "q1_category_top10": "category_top10",
    "q2_category_session_top10": "category_session_top10",
    "q3_page_jump_ratio": "page_jump_ratio",
    "q4_area_product_top3": "area_product_top3",
    "q4_area_product_top3_lineitem": "area_product_top3_lineitem",
    "q5_ads_after_ban": "ads_after_ban",
    "q6_date_area_city_ad_count": "filtered_date_area_city_ad_count",
    "q7_date_area_top_ads": "date_area_top_ads",
    "q8_last_window_ad_clicks": "last_window_ad_clicks_json",
    "q9_running_word_count": "running_word_count",
}


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "5"))
    spark = get_session(
        master=f"local[{cpus}]",
        app_name="shoplens-bench",
        shuffle_partitions=int(cpus) if cpus.isdigit() else 8,
        extra={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g")},
    )
    queries = registry.queries()
    jobs = {name: (lambda key=key: run(queries[key](spark, sf_dir))) for name, key in HEADLINE.items()}
    # the offline application end to end: Q1+Q2 from one persisted aggregate, Q3, Q4
    jobs["app_offline_q1_q4"] = lambda: apps.run_offline(
        spark, sf_dir, lambda _name, df: run(df), registry.COND, task_id="bench"
    )
    times, errors = {}, {}
    for name, job in jobs.items():
        try:
            job()  # warm-up (JIT, file listing caches)
            samples = []
            for _ in range(runs):
                t0 = time.perf_counter()
                job()
                samples.append(time.perf_counter() - t0)
            times[name] = round(statistics.median(samples), 4)
        except Exception as ex:  # report the failure, keep measuring the rest
            times[name] = None
            errors[name] = f"{type(ex).__name__}: {str(ex)[:300]}"
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(
        json.dumps(
            {
                "metric": "total_median_sec",
                "value": round(sum(v for k, v in times.items() if k in HEADLINE and v is not None), 4),
                "unit": "sec",
                "queries": times,
                "sf": float(m.group(1)) if m else sf_dir,
                "cpus": cpus,
                "runs": runs,
                **({"errors": errors} if errors else {}),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
