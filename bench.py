"""Time the headline queries.

Reads ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``; one warm-up, then the best
of ``$BENCH_RUNS`` (default 3), the whole result consumed by the noop sink.
Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

HEADLINE = (
    "kpi_snapshot", "kpi_par30", "kpi_default_rate", "kpi_txn_volume", "kpi_anomaly_summary", "kpi_npl_ratio",
    "eda_loan_stats", "eda_txn_rollup", "eda_top_anomalies", "eda_dpd_buckets",
    "inv_default_spike", "inv_par30_spike", "loan_outliers", "txn_zscore",
    "mon_kpi_history", "mon_alert_lifecycle", "mon_investigate",
    "etl_dim_customer", "etl_fact_loan", "etl_fact_transaction", "upsert_loan", "insert_ignore",
    "dash_cards", "dash_region_heatmap", "bi_par_region_month", "stream_anomaly_daily",
)


def main() -> None:
    from lendscope.registry import all_queries
    from lendscope.session import build_session

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "4")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = sys.argv[1:] or HEADLINE
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "8g",
            "spark.driver.host": "127.0.0.1",
            "spark.driver.bindAddress": "127.0.0.1",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries, seconds = all_queries(), {}
    for name in names:
        times = []
        for _ in range(runs + 1):
            started = time.perf_counter()
            queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - started)
        seconds[name] = round(min(times[1:]), 3)
        print(f"{name} {seconds[name]}", file=sys.stderr, flush=True)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total best-of-runs seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(sf_dir).name.removeprefix("sf"),
                "cpus": cpus,
            }
        )
    )


if __name__ == "__main__":
    main()
