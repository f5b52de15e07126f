"""All registered queries: name -> function of (session, data folder)."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lendscope import queries_etl, queries_monitor
from lendscope.plans import eda, investigate, kpi
from lendscope.sources import bridge
from lendscope.sources.bridge import AS_OF, bridge_star
from lendscope.sql import register_sql

Query = Callable[[SparkSession, str], DataFrame]


def on_star(job: Callable[..., DataFrame], *args, **params) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return job(bridge_star(spark, sf_dir), *args, **params)

    return run


def _row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    star = bridge_star(spark, sf_dir)
    return eda.row_counts(
        {
            "staging.raw_customers": bridge.raw_customers(spark, sf_dir),
            "staging.raw_loans": bridge.raw_loans(spark, sf_dir),
            "staging.raw_transactions": bridge.raw_transactions(spark, sf_dir),
            "warehouse.dim_customer": star.customer,
            "warehouse.fact_loan": star.loan,
            "warehouse.fact_transaction": star.txn_unscored,
        }
    )


def _sql_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The drill-down functions called from SQL, in one result."""
    register_sql(bridge_star(spark, sf_dir), AS_OF)
    return spark.sql(
        "SELECT 'default' AS source, concat_ws('/', risk_tier, product_category, region_state) AS item, default_rate_pct AS value"
        " FROM fn_investigate_default_spike()"
        " UNION ALL SELECT 'par30', loan_id, outstanding FROM fn_investigate_par30_spike(p_dpd_max => 59)"
        " UNION ALL SELECT 'anomaly', transaction_id, anomaly_score FROM fn_investigate_anomaly_spike(DATE '2001-07-20')"
    )


YESTERDAY = AS_OF - dt.timedelta(days=1)

ANALYTICS: dict[str, Query] = {
    "eda_row_counts": _row_counts,
    "eda_null_profile": lambda spark, d: eda.null_profile(bridge.customer(spark, d)),
    "eda_credit_score_hist": on_star(eda.credit_score_hist),
    "eda_loan_stats": on_star(eda.loan_stats),
    "eda_status_mix": on_star(eda.status_mix),
    "eda_monthly_origination": on_star(eda.monthly_origination),
    "eda_txn_rollup": on_star(eda.txn_rollup),
    "eda_top_anomalies": on_star(eda.top_anomalies),
    "eda_risk_tier": on_star(eda.risk_tier_breakdown),
    "eda_dpd_buckets": on_star(eda.dpd_buckets),
    "eda_dpd_write_off": on_star(eda.dpd_buckets, write_off=True),
    "kpi_par30": on_star(kpi.par30),
    "kpi_par30_zero_fill": on_star(kpi.par30, zero_fill=True),
    "kpi_par30_dpd30": on_star(kpi.par30, rule="dpd30"),
    "kpi_par30_par_only": on_star(kpi.par30, rule="par_only"),
    "kpi_default_rate": on_star(kpi.default_rate),
    "kpi_txn_volume": on_star(kpi.txn_volume),
    "kpi_txn_volume_calendar": on_star(kpi.txn_volume, calendar=True),
    "kpi_anomaly_summary": on_star(kpi.anomaly_summary),
    "kpi_npl_ratio": on_star(kpi.npl_ratio),
    "kpi_npl_ratio_from_90": lambda spark, d: kpi.npl_ratio(bridge_star(spark, d).with_npl_from(90)),
    "kpi_snapshot": on_star(kpi.kpi_snapshot, AS_OF),
    "inv_default_spike": on_star(investigate.default_spike, AS_OF - dt.timedelta(days=365), AS_OF),
    "inv_par30_spike": on_star(investigate.par30_spike),
    "inv_anomaly_spike": on_star(investigate.anomaly_spike, YESTERDAY),
    "inv_npl": on_star(investigate.npl_segments, AS_OF.year),
    "loan_outliers": on_star(investigate.loan_outliers),
    "sql_functions": _sql_functions,
    "txn_zscore": on_star(investigate.txn_zscore),
}


def all_queries() -> dict[str, Query]:
    return {**ANALYTICS, **queries_etl.QUERIES, **queries_monitor.QUERIES}


def all_oracles() -> dict[str, str]:
    from lendscope.oracle import etl_texts, kpi_texts, monitor_texts

    return {**kpi_texts.TEXTS, **etl_texts.TEXTS, **monitor_texts.TEXTS}
