"""Time the headline queries and print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) names the data, BENCH_CPUS (default 8) the cores.
Each query runs once to warm up and then BENCH_RUNS times (default 3); the median counts. Every
run builds its plan anew and writes all rows to a sink that drops them.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from daymetrics import session  # noqa: E402
from daymetrics.plans import catalog  # noqa: E402

HEADLINE = [
    "silver_sleep",
    "silver_steps",
    "silver_calories",
    "silver_exercise",
    "silver_heart_rate",
    "silver_spo2",
    "silver_weight",
    "gold_daily_metrics",
    "gold_single_series",
    "gold_duplicate_count",
    "week_rows",
    "week_over_week",
    "report_summary_text",
    "text_strip_markup",
    "text_strip_documents",
    "text_chunks",
    "full_run_report",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = session.build(
        f"local[{cpus}]",
        int(cpus),
        spark__driver__memory="8g",
        spark__ui__showConsoleProgress="false",
        # Plans are built many times here; without the call sites kept for error messages.
        spark__python__sql__dataFrameDebugging__enabled="false",
    )
    spark.sparkContext.setLogLevel("ERROR")

    def once(name: str) -> float:
        start = time.perf_counter()
        catalog.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    seconds = {}
    for name in HEADLINE:
        once(name)
        seconds[name] = round(statistics.median(once(name) for _ in range(runs)), 3)
    scale = re.search(r"sf([\d.]+)", sf_dir)
    print(
        json.dumps(
            {
                "metric": "total of the headline queries, median of warm runs",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(scale.group(1)) if scale else None,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
