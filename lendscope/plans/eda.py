"""Exploratory profiles."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lendscope.functions.credit import dpd_bucket
from lendscope.functions.dates import month_start
from lendscope.functions.numbers import count_if, half_up, mean, money, percent, ratio
from lendscope.operators.quantiles import exact_percentiles
from lendscope.sources.star import Star


def _share(column: str) -> Column:
    """Percent of the total over a handful of group rows."""
    return percent(F.col(column), F.sum(column).over(Window.partitionBy()), 2)


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    counts = [
        frame.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, frame in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts).orderBy("table_name")


def null_profile(frame: DataFrame, columns: tuple[str, ...] = ("credit_score", "annual_income", "date_of_birth")) -> DataFrame:
    """Missing values per column, in one pass."""
    counts = frame.agg(
        F.count("*").alias("_rows"), *[count_if(F.col(c).isNull()).alias(c) for c in columns]
    )
    return (
        counts.unpivot("_rows", list(columns), "field", "nulls")
        .select("field", "nulls", percent(F.col("nulls"), F.col("_rows"), 2).alias("null_pct"))
        .orderBy(F.desc("null_pct"), "field")
    )


def credit_score_hist(star: Star, low: int = 300, high: int = 850, buckets: int = 11) -> DataFrame:
    """Equal-width buckets; a score at or above ``high`` falls in the bucket after the last."""
    by_score = star.customer.filter(F.col("credit_score").isNotNull()).groupBy("credit_score").agg(
        F.count("*").alias("_n")
    )
    bucket = F.width_bucket(
        F.col("credit_score").cast("double"), F.lit(float(low)), F.lit(float(high)), F.lit(buckets)
    )
    return (
        by_score.groupBy(bucket.alias("bucket"))
        .agg(
            F.min("credit_score").alias("bucket_floor"),
            F.max("credit_score").alias("bucket_ceil"),
            F.sum("_n").alias("customers"),
        )
        .withColumn("pct", _share("customers"))
        .orderBy("bucket")
    )


LOAN_POINTS = {"p25": 0.25, "median": 0.5, "p75": 0.75, "p95": 0.95}


def loan_stats(star: Star, approximate: bool = False) -> DataFrame:
    """Distribution of the principal, in two scans. ``approximate`` leaves the
    second one out (relative rank error 1e-4)."""
    amount = F.col("principal_amount")
    moments = {
        "total_loans": F.count("*"),
        "min_amount": money(F.min(amount)),
        "max_amount": money(F.max(amount)),
        "mean_amount": half_up(mean(amount), 2),
        "stddev": half_up(F.stddev_samp(amount.cast("double")), 2),
    }
    if approximate:
        points = {n: F.percentile_approx(amount, p, 10000).cast("double") for n, p in LOAN_POINTS.items()}
        base = star.loan.agg(*[c.alias(n) for n, c in {**moments, **points}.items()])
    else:
        base = exact_percentiles(star.loan, [], "principal_amount", LOAN_POINTS, also=moments)
        base = base.withColumn("total_loans", F.coalesce("total_loans", F.lit(0).cast("bigint")))
    return base.select(
        "total_loans", "min_amount", "max_amount", "mean_amount", *[half_up(F.col(n), 4).alias(n) for n in LOAN_POINTS], "stddev"
    )


def status_mix(star: Star) -> DataFrame:
    return (
        star.loan.groupBy("loan_status")
        .agg(
            F.count("*").alias("loan_count"),
            money(F.sum("principal_amount")).alias("total_principal"),
            half_up(mean("principal_amount"), 2).alias("avg_principal"),
        )
        .withColumn("pct_of_portfolio", _share("loan_count"))
        .orderBy(F.desc("loan_count"), "loan_status")
    )


def monthly_origination(star: Star) -> DataFrame:
    monthly = star.loan.groupBy(month_start(F.col("issue_date")).alias("_month")).agg(
        F.count("loan_key").alias("loans_issued"),
        money(F.sum("principal_amount")).alias("total_disbursed"),
    )
    previous = F.lag("loans_issued").over(Window.orderBy("_month"))
    return (
        monthly.withColumn("prev_month_count", previous)
        .select(
            F.year("_month").alias("year"),
            F.month("_month").alias("month_num"),
            F.date_format("_month", "MMMM").alias("month_name"),
            "loans_issued",
            "total_disbursed",
            "prev_month_count",
            percent(F.col("loans_issued") - F.col("prev_month_count"), F.col("prev_month_count"), 2).alias("mom_growth_pct"),
        )
        .orderBy("year", "month_num")
    )


def txn_rollup(star: Star) -> DataFrame:
    """Volume by country, state and type with subtotals; ``level`` tells a
    subtotal (bit set per rolled-up column) from a missing name."""
    by_key = star.txn_unscored.groupBy("region_key", "transaction_type").agg(
        F.count("*").alias("n"), F.sum("amount").alias("volume"), F.count("amount").alias("amounts")
    )
    places = star.region.select("region_key", "country", "state")
    return (
        by_key.join(places, "region_key")
        .rollup("country", "state", "transaction_type")
        .agg(
            F.grouping_id().cast("int").alias("level"),
            F.sum("n").alias("txn_count"),
            money(F.sum("volume")).alias("total_volume"),
            half_up(ratio(F.sum("volume"), F.sum("amounts")), 2).alias("avg_amount"),
        )
        .orderBy(
            F.asc_nulls_last("country"), F.asc_nulls_last("state"), F.desc("txn_count"), F.asc_nulls_last("transaction_type")
        )
    )


def top_anomalies(star: Star, n: int = 10) -> DataFrame:
    """The highest scores; cut to ``n`` rows before the region join."""
    top = (
        star.txn.filter("is_anomaly")
        .orderBy(F.desc("anomaly_score"), "transaction_id")
        .limit(n)
    )
    return star.with_customer(top).join(star.region.select("region_key", "city", "state"), "region_key").select(
        "transaction_id",
        "customer_id",
        "risk_tier",
        "transaction_type",
        money(F.col("amount")).alias("amount"),
        money(F.col("anomaly_score")).alias("anomaly_score"),
        "anomaly_reason",
        F.col("txn_date").alias("transaction_date"),
        "city",
        "state",
    ).orderBy(F.desc("anomaly_score"), "transaction_id")


def risk_tier_breakdown(star: Star) -> DataFrame:
    return (
        star.customer.filter("is_current")
        .groupBy("risk_tier")
        .agg(
            F.count("*").alias("customers"),
            half_up(mean("credit_score"), 1).alias("avg_credit_score"),
            half_up(mean("annual_income"), 2).alias("avg_income"),
        )
        .withColumn("pct", _share("customers"))
        .orderBy(F.desc_nulls_last("avg_credit_score"), "risk_tier")
    )


def dpd_buckets(star: Star, write_off: bool = False) -> DataFrame:
    """Loans by days-past-due bucket, in order of delinquency."""
    by_days = star.loan.groupBy("days_past_due").agg(F.count("*").alias("n"), F.sum("principal_amount").alias("p"))
    return (
        by_days.groupBy(dpd_bucket(F.col("days_past_due"), write_off).alias("dpd_bucket"))
        .agg(
            F.sum("n").alias("loan_count"),
            money(F.sum("p")).alias("outstanding_principal"),
            F.min("days_past_due").alias("_first"),
        )
        .withColumn("pct_count", _share("loan_count"))
        .orderBy("_first")
        .drop("_first")
    )
