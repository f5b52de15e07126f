"""Drill-downs behind an indicator breach, and statistical outliers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendscope.functions.credit import PAR_MAX_DPD, PAR_MIN_DPD
from lendscope.functions.numbers import count_if, half_up, money, percent, ratio
from lendscope.operators.quantiles import exact_percentiles
from lendscope.operators.sizes import broadcast_if_small
from lendscope.plans.kpi import npl_ratio
from lendscope.sources.star import Star


def default_spike(star: Star, start, end) -> DataFrame:
    """Defaults of loans issued in ``[start, end]`` by tier, category, state."""
    window = star.loan_between(start, end)
    by_key = star.with_customer(window).groupBy("risk_tier", "product_key", "region_key").agg(
        count_if(F.col("loan_status") == "DEFAULTED").alias("bad"),
        F.count("*").alias("n"),
        F.sum("credit_score").alias("score"),
        F.count("credit_score").alias("scored"),
        F.sum("principal_amount").alias("amount"),
    )
    return (
        by_key.join(star.product.select("product_key", "category"), "product_key")
        .join(star.region.select("region_key", "state"), "region_key")
        .groupBy("risk_tier", F.col("category").alias("product_category"), F.col("state").alias("region_state"))
        .agg(
            F.sum("bad").alias("defaulted_loans"),
            F.sum("n").alias("total_loans"),
            percent(F.sum("bad"), F.sum("n"), 4).alias("default_rate_pct"),
            half_up(ratio(F.sum("score"), F.sum("scored")), 1).alias("avg_credit_score"),
            half_up(ratio(F.sum("amount"), F.sum("n")), 2).alias("avg_loan_amount"),
        )
        .orderBy(F.desc("default_rate_pct"), "risk_tier", "product_category", "region_state")
    )


def par30_spike(
    star: Star, dpd_min: int = PAR_MIN_DPD, dpd_max: int = PAR_MAX_DPD, n: int | None = None
) -> DataFrame:
    """Loans with days past due in the range, largest balance first; with ``n``
    the first ``n`` of them, cut before the joins."""
    late = star.loan.filter(F.col("days_past_due").between(dpd_min, dpd_max))
    if n is not None:
        late = late.orderBy(F.desc("outstanding_balance"), "loan_id").limit(n)
    return (
        star.with_customer(late)
        .join(star.product.select("product_key", "category"), "product_key")
        .join(star.region.select("region_key", "state"), "region_key")
        .select(
            "loan_id",
            "customer_id",
            "risk_tier",
            F.col("days_past_due").cast("int").alias("days_past_due"),
            money(F.col("outstanding_balance")).alias("outstanding"),
            F.col("category").alias("product_category"),
            "state",
            (F.col("days_past_due") - dpd_min).cast("int").alias("days_in_par30"),
        )
        .orderBy(F.desc("outstanding"), "loan_id")
    )


def anomaly_spike(star: Star, day, n: int = 50) -> DataFrame:
    """The ``n`` highest flagged transactions of one day."""
    top = (
        star.txn_between(day, day)
        .filter("is_anomaly")
        .orderBy(F.desc("anomaly_score"), "transaction_id")
        .limit(n)
    )
    return (
        star.with_customer(top)
        .join(star.region.select("region_key", "city", "state"), "region_key")
        .select(
            "transaction_id",
            "customer_id",
            "risk_tier",
            "transaction_type",
            money(F.col("amount")).alias("amount"),
            money(F.col("anomaly_score")).alias("anomaly_score"),
            "anomaly_reason",
            F.concat("city", F.lit(", "), "state").alias("region"),
        )
        .orderBy(F.desc("anomaly_score"), "transaction_id")
    )


def npl_segments(star: Star, year: int, n: int = 10) -> DataFrame:
    """The worst segments of loans issued in ``year`` by mean monthly ratio."""
    in_year = star.loan_between(f"{year:04d}-01-01", f"{year:04d}-12-31")
    monthly = npl_ratio(star.replaced(loan=in_year))
    return (
        monthly.groupBy("risk_tier", "product_category")
        .agg(F.sum("npl_loans").alias("npl_total"), half_up(F.avg("npl_ratio_pct"), 4).alias("avg_npl_pct"))
        .orderBy(F.desc("avg_npl_pct"), "risk_tier", "product_category")
        .limit(n)
    )


def loan_outliers(star: Star, k: float = 1.5) -> DataFrame:
    """Loans outside ``q1 - k*iqr .. q3 + k*iqr`` of their category."""
    loans = star.loan.join(star.product.select("product_key", "category"), "product_key")
    categories = star.product.select("category").distinct()
    quartiles = exact_percentiles(
        loans, ["category"], "principal_amount", {"q1": 0.25, "q3": 0.75}, groups=categories
    )
    width = F.col("q3") - F.col("q1")
    fences = quartiles.select(
        "category",
        half_up(F.col("q1") - k * width, 6).alias("lower_fence"),
        half_up(F.col("q3") + k * width, 6).alias("upper_fence"),
    )
    amount = F.col("principal_amount").cast("double")
    low, high = amount < F.col("lower_fence"), amount > F.col("upper_fence")
    return (
        star.with_customer(loans.join(broadcast_if_small(fences, categories), "category").filter(low | high))
        .select(
            "loan_id",
            "customer_id",
            "risk_tier",
            "category",
            amount.alias("principal_amount"),
            "lower_fence",
            "upper_fence",
            F.when(low, "LOW_OUTLIER").otherwise("HIGH_OUTLIER").alias("outlier_type"),
        )
        .orderBy(F.desc("principal_amount"), "loan_id")
    )


def txn_zscore(star: Star) -> DataFrame:
    """Every transaction with its distance, score, flag and reason."""
    return star.with_customer(star.txn).select(
        "transaction_id",
        "customer_id",
        F.col("txn_date").alias("transaction_date"),
        money(F.col("amount")).alias("amount"),
        half_up(F.col("z_score"), 6).alias("z_score"),
        money(F.col("anomaly_score")).alias("anomaly_score"),
        "is_anomaly",
        "anomaly_reason",
    )
