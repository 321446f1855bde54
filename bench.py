"""Time the headline queries: one warm-up, then the median of the timed runs.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default
4), BENCH_RUNS (default 3), BENCH_QUERIES (names separated by commas). Prints
one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from quotelake.catalog.queries import QUERIES
from quotelake.session import get_session

HEADLINE = [
    "trade_cube",
    "cube_distinct",
    "chain_base",
    "option_trades_by_chain",
    "strike_details",
    "chain_analytics",
    "chain_zscores",
    "screener_metrics",
    "sweep_premium_rollup",
    "option_screener",
    "symbol_master",
    "composite_score",
    "customer_percentiles",
    "fundamentals_typed",
    "ratings_typed",
    "technical_rank",
    "intraday_bars",
    "flow_contract_stats",
    "open_interest_history",
    "daily_ticker_summary",
    "flow_stats",
    "order_zscores",
    "return_shares",
    "order_neighbours",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "4")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or HEADLINE
    spark = get_session(
        "bench",
        f"local[{cpus}]",
        **{"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": os.environ.get("BENCH_MEMORY", "6g")},
    )
    seconds = {}
    for name in names:
        times = []
        for attempt in range(runs + 1):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            if attempt:
                times.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(times), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline queries, median seconds after one warm-up, summed",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")),
            }
        )
    )


if __name__ == "__main__":
    main()
