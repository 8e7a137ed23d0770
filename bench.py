"""Time the headline queries; prints one JSON line.

Each query runs once to warm up and then ``BENCH_RUNS`` times (default 3) into
Spark's no-op sink, which computes every row and column; the median counts.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from registry import QUERIES
from tidemark.session import build_session

HEADLINE = (
    "get_records_by_entity_type",
    "search_records",
    "multi_entity_latest",
    "top_changes",
    "time_bucket_agg",
    "multi_value_agg",
    "weighted_average",
    "gap_filled_agg_null",
    "statistics",
    "value_distribution",
    "daily_stats",
    "domain_stats",
    "ticks_1min",
    "ticks_5min",
    "ticks_1day",
    "ohlc_summary_1day",
    "symbol_daily_stats",
    "market_volatility_hourly",
    "refresh_rollup",
    "moving_averages",
    "sma",
    "ema",
    "rsi",
    "bollinger",
    "volatility",
    "obv",
    "support_resistance",
    "value_gaps",
    "fill_interpolate",
    "validate_ticks_duplicates",
    "dedupe_records",
    "upsert_records",
    "insert_many",
    "compact_partitions",
    "stream_rollup",
    "stream_latest",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = sys.argv[1:] or HEADLINE
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "12g"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds: dict[str, float] = {}
    for name in names:
        taken = []
        for _ in range(runs + 1):
            began = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - began)
        seconds[name] = round(statistics.median(taken[1:]), 4)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "cpus": int(cpus),
            }
        )
    )


if __name__ == "__main__":
    main()
