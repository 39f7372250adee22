"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR is the folder of tables (default sf0.1), BENCH_CPUS the local cores.
Each query runs to completion into a sink that discards rows; the best of two runs
counts, so that JIT warm-up is not charged to whichever query comes first.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pulsewatch.plans import catalog  # noqa: E402
from pulsewatch.session import get_spark  # noqa: E402

HEADLINE = [
    "clean_calls",
    "enrich_geo",
    "load_fact_calls",
    "upsert_partial",
    "festival_incidents",
    "festival_incidents_shuffled",
    "festival_risk",
    "risk_scores_sql_v1",
    "zone_heatmap",
    "calls_weather",
    "weather_rates",
    "response_summary",
    "mannwhitney_response",
    "daily_features",
    "frequent_itemsets",
    "rules",
    "stratified_split",
    "planned_event_risk",
    "match_risk",
    "quality_checks",
]

# Only these feed rows/s: each reads the whole table of calls once.
CALL_QUERIES = ["clean_calls", "enrich_geo", "load_fact_calls", "upsert_partial"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = get_spark(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "12g"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    calls = spark.read.parquet(f"{sf_dir}/events.parquet").count()
    seconds = {}
    for name in HEADLINE:
        runs = []
        for _ in range(2):
            start = time.perf_counter()
            catalog.build(name)(spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - start)
        seconds[name] = round(min(runs), 3)
    result = {
        "metric": "headline_queries_total",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
        "cpus": int(cpus),
        "rows_per_second": {q: round(calls / seconds[q]) for q in CALL_QUERIES},
    }
    spark.stop()
    print(json.dumps(result))


if __name__ == "__main__":
    main()
