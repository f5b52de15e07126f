"""Shapes of physical plans."""

from __future__ import annotations

import re

import pytest

from pyspark.sql import functions as F

from lendscope.plans import investigate, kpi
from lendscope.registry import all_queries
from lendscope.sources import bridge
from lendscope.sources.bridge import AS_OF, bridge_star
from lendscope.sources.star import warehouse_star
from lendscope.sql import register_sql


def plan(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


def scans(text: str, column: str) -> list[str]:
    """Partition filters of the scans that read month folders of ``column``."""
    return [m for m in re.findall(r"PartitionFilters: \[([^\]]*)\]", text) if column in m]


def test_date_bounds_reach_the_month_folders(spark, small):
    star = bridge_star(spark, small)
    day = AS_OF
    assert scans(plan(kpi.kpi_snapshot(star, day)), "issue_month") and scans(plan(kpi.kpi_snapshot(star, day)), "txn_month")
    assert scans(plan(investigate.default_spike(star, "2001-07-01", "2001-07-31")), "issue_month")
    assert scans(plan(investigate.npl_segments(star, 2001)), "issue_month")
    cut = star.sliced(start="2001-07-01", end="2001-07-10")
    assert scans(plan(cut.loan), "issue_month") and scans(plan(cut.txn), "txn_month")
    register_sql(star, day)
    spike = spark.sql("SELECT * FROM fn_investigate_default_spike(DATE '2001-07-01', DATE '2001-07-31')")
    flags = spark.sql("SELECT * FROM fn_investigate_anomaly_spike(DATE '2001-07-20')")
    assert scans(plan(spike), "issue_month") and scans(plan(flags), "txn_month")


def test_date_bounds_prune_the_warehouse(spark, small):
    from lendscope.queries_etl import _loaded

    star = warehouse_star(_loaded(spark, small).read)
    assert scans(plan(investigate.default_spike(star, "2001-07-01", "2001-07-31")), "issue_month")
    assert scans(plan(investigate.anomaly_spike(star, "2001-07-20")), "txn_month")


@pytest.mark.parametrize("name", ["kpi_par30", "kpi_default_rate", "eda_status_mix", "eda_monthly_origination", "eda_dpd_buckets", "bi_par30", "dash_loan_status"])
def test_loan_indicators_join_no_customer(spark, small, name):
    text = plan(all_queries()[name](spark, small))
    assert "Join" not in text and "c_custkey" not in text


def test_scans_read_only_what_is_used(spark, small):
    text = plan(kpi.par30(bridge_star(spark, small)))
    columns = re.findall(r"FileScan parquet \[([^\]]*)\]", text)
    assert columns and all("loan_id" not in c and "principal_amount" not in c for c in columns)


# queries that write tables or run streams before they return
EAGER = ("read_staging", "etl_", "warehouse_", "kpi_cache", "stream_", "alert_payload")


@pytest.mark.parametrize("name", [n for n in sorted(all_queries()) if not n.startswith(EAGER)])
def test_no_product_of_tables(spark, small, name):
    text = plan(all_queries()[name](spark, small))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


@pytest.mark.parametrize("name", ["kpi_par30", "kpi_default_rate", "kpi_anomaly_summary", "kpi_txn_volume", "eda_status_mix", "loan_outliers"])
def test_single_partition_only_after_aggregation(spark, small, name):
    lines = plan(all_queries()[name](spark, small)).splitlines()
    for i, line in enumerate(lines):
        if "Exchange SinglePartition" in line:
            below = "\n".join(lines[i + 1 : i + 8])
            assert "Aggregate" in below or "Window" in below, below


def test_large_joins_do_not_force_a_broadcast(spark, small):
    """Past the size limit every fact join shuffles; hints cover bounded sides."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for frame in (bridge.loan(spark, small), bridge.scored_events(spark, small)):
            # only the set of keys dealt in parts is broadcast, by its hint
            text = plan(frame)
            assert "SortMergeJoin" in text and text.count("BroadcastHashJoin") <= 2
        assert "BroadcastHashJoin" not in plan(bridge.loan(spark, small))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_landing_rows_are_ranked_not_packed(spark, small):
    """Newest per key is one window; what is left per task is cut before the shuffle."""
    from lendscope.plans import etl

    for checked in (etl.checked_customers(bridge.raw_customers(spark, small)), etl.checked_products(bridge.raw_products(spark, small))):
        text = plan(checked)
        assert "SortAggregate" not in text and text.count("Exchange hashpartitioning") <= 3


def test_losers_of_a_key_are_counted_not_ranked(spark, small):
    """No window over landing rows without a limit per task, in any of the checked loads."""
    from lendscope.plans import etl

    raw = {n: getattr(bridge, f"raw_{n}")(spark, small) for n in ("customers", "products", "loans", "transactions")}
    chosen = [etl._chosen(raw["customers"], "customer_id"), etl._chosen(raw["products"], "product_code"), etl._chosen(raw["loans"], "loan_id"), etl._chosen(raw["transactions"], "transaction_id", latest=False)]
    for frame in chosen:
        text = plan(frame)
        windows = [line for line in text.splitlines() if line.strip(" +-:*()0123456789").startswith("Window [")]
        limits = [line for line in text.splitlines() if "WindowGroupLimit" in line]
        assert len(windows) == 1 and len(limits) == 2, text


def test_a_hot_key_leaves_no_large_task(spark):
    """Of a key with a third of all rows each task sends one row and one count."""
    from lendscope.operators.dedup import chosen_per_key

    rows = spark.range(90_000, numPartitions=8).selectExpr("CASE WHEN id % 3 = 0 THEN 'hot' ELSE cast(id AS string) END AS k", "id AS at", "'x' AS wide")
    chosen = chosen_per_key(rows, "k", ["at"], True, F.col("k").isNull())
    hot = chosen.filter("k = 'hot'").first()
    assert (hot.at, hot._rows) == (89_997, 30_000) and chosen.agg(F.sum("_rows")).first()[0] == 90_000


def test_loan_distributions_scan_the_fact_twice(spark, small):
    from lendscope.plans import eda

    star = bridge_star(spark, small)
    assert plan(eda.loan_stats(star)).count("issue_month") == 2 == len(re.findall(r"FileScan parquet \[[^\]]*principal_amount", plan(eda.loan_stats(star))))
    text = plan(investigate.loan_outliers(star))
    assert len(re.findall(r"FileScan parquet \[[^\]]*principal_amount", text)) <= 3 and text.count("SortMergeJoin") == 0
