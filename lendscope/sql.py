"""The reporting views and drill-down functions for SQL users.

``register_sql`` puts the star tables, the reporting views and three table
functions into the session as temporary objects.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendscope.plans import investigate, kpi
from lendscope.sources.star import MONTHS, Star, month_key


def views(star: Star, as_of) -> dict[str, DataFrame]:
    """View name -> DataFrame; the snapshot is taken at ``as_of``."""
    return {
        "dim_region": star.region,
        "dim_customer": star.customer,
        "dim_loan_product": star.product,
        "fact_loan": star.loan,
        "fact_transaction": star.txn,
        "vw_par30": kpi.par30(star),
        "vw_default_rate": kpi.default_rate(star),
        "vw_txn_volume_by_region": kpi.txn_volume(star),
        "vw_anomaly_summary": kpi.anomaly_summary(star, store=False),
        "vw_npl_ratio": kpi.npl_ratio(star),
        "vw_kpi_snapshot": kpi.kpi_snapshot(star, as_of),
        "vw_loan_outliers": investigate.loan_outliers(star),
    }


def _detail(star: Star) -> dict[str, DataFrame]:
    """Facts with the names the table functions select from."""
    places = star.region.select("region_key", "city", "state")
    products = star.product.select("product_key", F.col("category").alias("product_category"))
    loan = star.with_customer(star.loan).join(products, "product_key").join(places, "region_key")
    txn = star.with_customer(star.txn).join(places, "region_key")
    for day, month in MONTHS.items():
        if day in loan.columns and month not in loan.columns:
            loan = loan.withColumn(month, month_key(F.col(day)))
        if day in txn.columns and month not in txn.columns:
            txn = txn.withColumn(month, month_key(F.col(day)))
    return {"loan_detail": loan, "transaction_detail": txn}


def _functions(as_of) -> list[str]:
    day = f"DATE '{as_of}'"
    month = "CAST(year({0}) * 100 + month({0}) AS INT)".format
    rounded = "round({0} + sign({0}) * 1e-9D, {1})".format
    rate = rounded("(100.0D * count_if(loan_status = 'DEFAULTED') / count(*))", 4)
    score = rounded("(CAST(sum(credit_score) AS DOUBLE) / nullif(count(credit_score), 0))", 1)
    amount = rounded("(CAST(sum(principal_amount) AS DOUBLE) / count(*))", 2)
    return [
        f"""CREATE OR REPLACE TEMPORARY FUNCTION fn_investigate_default_spike(
              p_start_date DATE DEFAULT date_sub({day}, 30), p_end_date DATE DEFAULT {day})
            RETURNS TABLE (risk_tier STRING, product_category STRING, region_state STRING, defaulted_loans BIGINT,
                           total_loans BIGINT, default_rate_pct DOUBLE, avg_credit_score DOUBLE, avg_loan_amount DOUBLE)
            RETURN SELECT risk_tier, product_category, state, count_if(loan_status = 'DEFAULTED'), count(*), {rate}, {score}, {amount}
                   FROM loan_detail WHERE issue_date BETWEEN p_start_date AND p_end_date
                     AND issue_month BETWEEN {month("p_start_date")} AND {month("p_end_date")}
                   GROUP BY risk_tier, product_category, state""",
        """CREATE OR REPLACE TEMPORARY FUNCTION fn_investigate_par30_spike(p_dpd_min INT DEFAULT 30, p_dpd_max INT DEFAULT 89)
            RETURNS TABLE (loan_id STRING, customer_id STRING, risk_tier STRING, days_past_due INT, outstanding DOUBLE,
                           product_category STRING, state STRING, days_in_par30 INT)
            RETURN SELECT loan_id, customer_id, risk_tier, CAST(days_past_due AS INT), CAST(outstanding_balance AS DOUBLE),
                          product_category, state, CAST(days_past_due - p_dpd_min AS INT)
                   FROM loan_detail WHERE days_past_due BETWEEN p_dpd_min AND p_dpd_max""",
        f"""CREATE OR REPLACE TEMPORARY FUNCTION fn_investigate_anomaly_spike(p_date DATE DEFAULT date_sub({day}, 1))
            RETURNS TABLE (transaction_id STRING, customer_id STRING, risk_tier STRING, transaction_type STRING, amount DOUBLE,
                           anomaly_score DOUBLE, anomaly_reason STRING, region STRING)
            RETURN SELECT transaction_id, customer_id, risk_tier, transaction_type, CAST(amount AS DOUBLE),
                          CAST(t.anomaly_score AS DOUBLE), anomaly_reason, city || ', ' || state
                   FROM transaction_detail t WHERE is_anomaly AND txn_date = p_date AND txn_month = {month("p_date")}
                   ORDER BY t.anomaly_score DESC, transaction_id LIMIT 50""",
    ]


def register_sql(star: Star, as_of) -> list[str]:
    """Create the temporary views and functions; returns the view names."""
    spark = star.loan.sparkSession
    named = {**views(star, as_of), **_detail(star)}
    for name, frame in named.items():
        frame.createOrReplaceTempView(name)
    for statement in _functions(as_of):
        spark.sql(statement)
    return list(named)
