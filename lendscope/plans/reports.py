"""Report and dashboard extracts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lendscope.functions.credit import at_risk, dpd_bucket
from lendscope.functions.dates import date_lit, month_start
from lendscope.functions.numbers import count_if, half_up, money, percent, ratio, sum_if
from lendscope.plans import kpi
from lendscope.plans.monitor import THRESHOLDS, Threshold, judged, threshold_table
from lendscope.sources.star import Star

MONTHS = tuple(range(1, 13))


def _share(column: str, digits: int = 2) -> Column:
    """Percent of the total over a handful of group rows."""
    return percent(F.col(column), F.sum(column).over(Window.partitionBy()), digits)


# --- workbook extracts -------------------------------------------------------


def kpi_summary(star: Star, as_of, thresholds: tuple[Threshold, ...] = THRESHOLDS) -> DataFrame:
    """The six indicators with limit and status; the last two have no limit."""
    names = list(kpi.SNAPSHOT_KPIS)
    values = (
        kpi.kpi_snapshot(star, as_of)
        .select(*[F.col(n).cast("double").alias(n) for n in names])
        .unpivot([], names, "kpi", "value")
    )
    limits = F.broadcast(threshold_table(values.sparkSession, thresholds))
    rows = judged(values.join(limits, "kpi", "left"))
    status = F.when(
        F.col("threshold").isNotNull() & F.col("value").isNotNull(), F.coalesce("severity", F.lit("OK"))
    )
    return rows.select("kpi", F.coalesce("value", F.lit(0.0)).alias("value"), "threshold", status.alias("status"))


def default_trend(star: Star) -> DataFrame:
    """Monthly defaults; the rate as a fraction."""
    return kpi.default_rate(star).select(
        "year",
        "month_num",
        "month_name",
        "total_loans_issued",
        "defaults",
        half_up(F.col("default_rate_pct") / 100.0, 6).alias("default_rate"),
        "ytd_defaults",
    )


def par30_recent(star: Star, n: int = 90) -> DataFrame:
    return (
        kpi.par30(star)
        .select("full_date", "par30_pct", "par30_7d_avg", "par30_30d_avg")
        .orderBy(F.desc("full_date"))
        .limit(n)
    )


def anomaly_top(star: Star, n: int = 500) -> DataFrame:
    order = [F.desc("full_date"), F.desc("anomaly_count"), F.asc("transaction_type"), F.asc("country"), F.asc("state")]
    return (
        kpi.anomaly_summary(star, rolling=False)
        .orderBy(*order)
        .limit(n)
        .select(
            "full_date", "transaction_type", "country", "anomaly_count", "total_txns", "anomaly_rate_pct", "anomalous_volume"
        )
    )


def npl_top(star: Star, n: int = 200) -> DataFrame:
    order = [F.desc("year"), F.desc("npl_ratio_pct"), F.asc("month_num"), F.asc("risk_tier"), F.asc("product_category")]
    return (
        kpi.npl_ratio(star)
        .orderBy(*order)
        .limit(n)
        .select("year", "month_name", "risk_tier", "product_category", "total_loans", "npl_loans", "npl_ratio_pct")
    )


def write_report(extracts: dict[str, DataFrame], path: str, fmt: str = "parquet") -> None:
    """Each extract to its own folder below ``path`` as ``parquet`` or ``csv``."""
    for name, frame in extracts.items():
        writer = frame.write.mode("overwrite")
        if fmt == "csv":
            writer = writer.option("header", "true")
        writer.format(fmt).save(f"{path.rstrip('/')}/{name}")


# --- BI measures and visuals -------------------------------------------------


def bi_par30(star: Star) -> DataFrame:
    """At-risk share without non-performing loans; empty book -> 0."""
    return star.loan.agg(
        F.coalesce(
            percent(sum_if(F.col("is_par30"), "outstanding_balance"), F.sum("outstanding_balance"), 4), F.lit(0.0)
        ).alias("par30_rate")
    )


def bi_npl(star: Star) -> DataFrame:
    return star.loan.agg(
        F.coalesce(percent(count_if(F.col("is_npl")), F.count("*"), 4), F.lit(0.0)).alias("npl_ratio")
    )


def bi_default_mom(star: Star, as_of) -> DataFrame:
    """Defaults of the month to date against the whole previous month, in %."""
    day = date_lit(as_of)
    issued = F.col("issue_date")
    first = month_start(day)
    bad = F.col("loan_status") == "DEFAULTED"
    recent = star.loan_between(F.add_months(first, -1), day)
    return recent.agg(
        count_if(bad & (issued >= first)).alias("current_month"),
        count_if(bad & (issued < first)).alias("previous_month"),
    ).select(
        "current_month",
        "previous_month",
        F.coalesce(percent(F.col("current_month") - F.col("previous_month"), F.col("previous_month"), 2), F.lit(0.0)).alias(
            "default_rate_mom"
        ),
    )


def _default_counts(star: Star, *columns: str) -> DataFrame:
    loan = star.with_customer(star.loan) if "risk_tier" in columns else star.loan
    return loan.groupBy(*columns).agg(
        count_if(F.col("loan_status") == "DEFAULTED").alias("bad"), F.count("*").alias("n")
    )


def bi_default_matrix(star: Star) -> DataFrame:
    """Default rate by risk tier and category, one row per cell: categories are
    data, so that a new one makes new rows and none is left out."""
    products = star.product.select("product_key", "category")
    cells = _default_counts(star, "risk_tier", "product_key").join(products, "product_key")
    return (
        cells.groupBy("risk_tier", "category")
        .agg(
            F.sum("bad").alias("defaults"),
            F.sum("n").alias("total_loans"),
            percent(F.sum("bad"), F.sum("n"), 4).alias("default_rate_pct"),
        )
        .orderBy("risk_tier", "category")
    )


def bi_top_states(star: Star, n: int = 10) -> DataFrame:
    places = star.region.select("region_key", "country", "state")
    return (
        _default_counts(star, "region_key")
        .join(places, "region_key")
        .groupBy("state")
        .agg(
            F.sum("bad").alias("defaults"),
            F.sum("n").alias("total_loans"),
            percent(F.sum("bad"), F.sum("n"), 4).alias("default_rate_pct"),
        )
        .orderBy(F.desc("default_rate_pct"), "state")
        .limit(n)
    )


def bi_txn_daily_by_type(star: Star) -> DataFrame:
    return (
        star.txn_unscored.groupBy(F.col("txn_date").alias("full_date"), "transaction_type")
        .agg(F.count("*").alias("txn_count"), money(F.sum("amount")).alias("total_volume"))
        .orderBy("full_date", "transaction_type")
    )


def bi_txn_by_region(star: Star) -> DataFrame:
    by_key = star.txn_unscored.groupBy("region_key").agg(F.sum("amount").alias("v"), F.count("*").alias("n"))
    return (
        by_key.join(star.region, "region_key")
        .groupBy("country", "state", "city")
        .agg(F.sum("n").alias("txn_count"), money(F.sum("v")).alias("total_volume"))
        .orderBy("country", "state", "city")
    )


def bi_anomaly_scatter(star: Star, fraction: float | None = None, seed: int = 42) -> DataFrame:
    """Amount against score: the flagged transactions, or with ``fraction`` a
    seeded sample of all (the chart's sampling option)."""
    rows = star.txn.filter("is_anomaly") if fraction is None else star.txn.sample(False, fraction, seed)
    return rows.select(
        "transaction_id", money(F.col("amount")).alias("amount"), money(F.col("anomaly_score")).alias("anomaly_score")
    )


def bi_dpd_transitions(day2: DataFrame) -> DataFrame:
    """Loans and balance by old and new bucket. ``day2`` has ``days_past_due``
    and ``new_dpd``."""
    by_days = day2.groupBy("days_past_due", "new_dpd").agg(
        F.count("*").alias("n"), F.sum("outstanding_balance").alias("b")
    )
    return (
        by_days.groupBy(
            dpd_bucket(F.col("days_past_due")).alias("old_bucket"), dpd_bucket(F.col("new_dpd")).alias("new_bucket")
        )
        .agg(F.sum("n").alias("loans"), money(F.sum("b")).alias("balance"))
        .orderBy("old_bucket", "new_bucket")
    )


def bi_par_region_month(star: Star) -> DataFrame:
    """At-risk share by state and year (rows) and month of issue (columns)."""
    by_key = star.loan.groupBy("region_key", month_start(F.col("issue_date")).alias("_month")).agg(
        F.sum("outstanding_balance").alias("total"), sum_if(at_risk(), "outstanding_balance").alias("risky")
    )
    cells = by_key.join(star.region.select("region_key", "state"), "region_key").select(
        "state", F.year("_month").alias("year"), F.month("_month").alias("_m"), "total", "risky"
    )
    wide = (
        cells.groupBy("state", "year")
        .pivot("_m", list(MONTHS))
        .agg(F.sum("risky").alias("risky"), F.sum("total").alias("total"))
    )
    return wide.select(
        "state", "year", *[percent(F.col(f"{m}_risky"), F.col(f"{m}_total"), 4).alias(f"m{m:02d}") for m in MONTHS]
    ).orderBy("state", "year")


def bi_top20_at_risk(star: Star, n: int = 20) -> DataFrame:
    """The largest balances in the at-risk band, cut before the joins."""
    top = star.loan.filter("is_par30").orderBy(F.desc("outstanding_balance"), "loan_id").limit(n)
    return (
        star.with_customer(top)
        .join(star.product.select("product_key", "category"), "product_key")
        .join(star.region.select("region_key", "state"), "region_key")
        .select(
            "loan_id", "customer_id", "risk_tier", "category", "state", "days_past_due",
            money(F.col("outstanding_balance")).alias("outstanding"),
        )
        .orderBy(F.desc("outstanding"), "loan_id")
    )


# --- dashboard panels --------------------------------------------------------


def _book_at(day: Column, tag: str) -> list[Column]:
    """Aggregates over the loans issued up to ``day``."""
    known = F.col("issue_date") <= day
    in_month = known & (F.col("issue_date") >= month_start(day))
    active = known & (F.col("loan_status") == "ACTIVE")
    return [
        percent(count_if(in_month & (F.col("loan_status") == "DEFAULTED")), count_if(in_month), 4).alias(f"default_{tag}"),
        percent(count_if(known & F.col("is_npl")), count_if(known), 4).alias(f"npl_{tag}"),
        money(sum_if(active, "outstanding_balance")).alias(f"portfolio_{tag}"),
        count_if(active).cast("double").alias(f"loans_{tag}"),
    ]


def dash_cards(star: Star, as_of, thresholds: tuple[Threshold, ...] = THRESHOLDS) -> DataFrame:
    """Six cards: value, value one period before, change, share of the limit.

    The period is a day for the flag count and a month otherwise. Both values
    use the loans issued up to their day; status is the current one.
    """
    now = date_lit(as_of)
    before = F.add_months(now, -1)
    issued = F.col("issue_date")
    span = star.loan.filter(issued.between(F.date_sub(before, 30), now))
    daily = span.groupBy("issue_date").agg(
        F.sum("outstanding_balance").alias("t"), sum_if(at_risk(), "outstanding_balance").alias("r")
    )
    shares = daily.select("issue_date", half_up(ratio(F.col("r"), F.col("t")) * 100.0, 4).alias("p"))

    def mean_to(day: Column) -> Column:
        return half_up(F.avg(F.when(issued.between(F.date_sub(day, 30), day), F.col("p"))), 4)

    par = shares.agg(F.struct(mean_to(now).alias("now"), mean_to(before).alias("before")).alias("s"))
    flagged = star.txn_between(F.date_sub(now, 2), F.date_sub(now, 1)).filter("is_anomaly")
    flags = flagged.agg(
        F.struct(
            count_if(F.col("txn_date") == F.date_sub(now, 1)).cast("double").alias("now"),
            count_if(F.col("txn_date") == F.date_sub(now, 2)).cast("double").alias("before"),
        ).alias("s")
    )
    book = star.loan.agg(*_book_at(now, "now"), *_book_at(before, "before"))
    wide = book.withColumns({"_par": par.scalar(), "_flags": flags.scalar()})

    def card(name: str, value: str, previous: str) -> Column:
        return F.struct(F.lit(name).alias("kpi"), F.col(value).alias("value"), F.col(previous).alias("previous_value"))

    cards = F.array(
        card("par30_30d_avg", "_par.now", "_par.before"),
        card("current_month_default_rate", "default_now", "default_before"),
        card("anomaly_count_yesterday", "_flags.now", "_flags.before"),
        card("overall_npl_ratio", "npl_now", "npl_before"),
        card("total_active_portfolio", "portfolio_now", "portfolio_before"),
        card("active_loan_count", "loans_now", "loans_before"),
    )
    limits = F.broadcast(threshold_table(star.loan.sparkSession, thresholds).select("kpi", "threshold"))
    return (
        wide.select(F.explode(cards).alias("c"))
        .select("c.*")
        .join(limits, "kpi", "left")
        .select(
            "kpi",
            "value",
            "previous_value",
            half_up(F.col("value") - F.col("previous_value"), 4).alias("delta"),
            "threshold",
            percent(F.col("value"), F.col("threshold"), 2).alias("pct_of_threshold"),
        )
    )


def dash_default_quarterly(star: Star) -> DataFrame:
    monthly = star.loan.groupBy(F.trunc("issue_date", "quarter").alias("q")).agg(
        count_if(F.col("loan_status") == "DEFAULTED").alias("defaults"), F.count("*").alias("total_loans")
    )
    return monthly.select(
        F.concat(F.lit("Q"), F.quarter("q").cast("string"), F.lit(" "), F.year("q").cast("string")).alias("quarter"),
        F.col("q").alias("quarter_start"),
        "defaults",
        "total_loans",
        percent(F.col("defaults"), F.col("total_loans"), 4).alias("default_rate_pct"),
    ).orderBy("quarter_start")


def dash_risk_mix(star: Star) -> DataFrame:
    return (
        star.with_customer(star.loan)
        .groupBy("risk_tier")
        .agg(F.count("*").alias("loans"), F.sum("outstanding_balance").alias("b"))
        .select("risk_tier", "loans", money(F.col("b")).alias("portfolio"), _share("b").alias("pct_of_portfolio"))
        .orderBy("risk_tier")
    )


def dash_par_bucket_share(star: Star) -> DataFrame:
    by_days = star.loan.groupBy("days_past_due").agg(F.sum("outstanding_balance").alias("b"))
    return (
        by_days.groupBy(dpd_bucket(F.col("days_past_due")).alias("dpd_bucket"))
        .agg(F.sum("b").alias("b"))
        .select("dpd_bucket", money(F.col("b")).alias("portfolio"), _share("b").alias("pct_of_portfolio"))
    )


def dash_daily_anomalies(star: Star, as_of, days: int = 30, limit: float | None = None) -> DataFrame:
    """Flags of the last ``days`` days next to the limit; days without
    transactions show 0."""
    end = date_lit(as_of)
    start = F.date_sub(end, days)
    if limit is None:
        limit = next(t.limit for t in THRESHOLDS if t.kpi == "anomaly_count_yesterday")
    spark = star.txn.sparkSession
    calendar = spark.range(1).select(F.explode(F.sequence(start, F.date_sub(end, 1))).alias("full_date"))
    counts = (
        star.txn_between(start, F.date_sub(end, 1))
        .groupBy(F.col("txn_date").alias("full_date"))
        .agg(count_if(F.col("is_anomaly")).alias("n"))
    )
    return calendar.join(counts, "full_date", "left").select(
        "full_date", F.coalesce("n", F.lit(0)).alias("anomaly_count"), F.lit(float(limit)).alias("threshold")
    )


def dash_loan_status(star: Star) -> DataFrame:
    return star.loan.groupBy("loan_status").agg(F.count("*").alias("loans")).orderBy("loan_status")


# The columns the region table can be ranked by.
HEATMAP_METRICS = {"default": "default_rate_pct", "par30": "par30_pct", "anomaly": "anomaly_count"}
TIMEFRAMES = (30, 60, 90, 180, 365)


def dash_region_heatmap(
    star: Star, as_of, metric: str = "default", country: str | None = None, days: int | None = 90
) -> DataFrame:
    """Country and state rows over the trailing ``days`` (None: all dates)."""
    end = date_lit(as_of)
    risky = at_risk()
    loans, txns = star.loan, star.txn
    if days is not None:
        loans = loans.filter(F.col("issue_date").between(F.date_sub(end, days), end))
        txns = star.txn_between(F.date_sub(end, days), end)
    book = loans.groupBy("region_key").agg(
        count_if(F.col("loan_status") == "ACTIVE").alias("active"),
        F.sum("outstanding_balance").alias("total"),
        sum_if(risky, "outstanding_balance").alias("risky"),
        count_if(F.col("loan_status") == "DEFAULTED").alias("bad"),
        F.count("*").alias("n"),
    )
    flags = txns.groupBy("region_key").agg(count_if(F.col("is_anomaly")).alias("flags"))
    places = star.region.select("region_key", "country", "state")
    if country is not None:
        places = places.filter(F.lower("country") == country.lower())
    rows = (
        places.join(book, "region_key", "left")
        .join(flags, "region_key", "left")
        .groupBy("country", "state")
        .agg(
            F.coalesce(F.sum("active"), F.lit(0)).alias("active_loans"),
            half_up(F.coalesce(F.sum("total"), F.lit(0)).cast("double") / 1e6, 2).alias("portfolio_millions"),
            percent(F.sum("bad"), F.sum("n"), 4).alias("default_rate_pct"),
            percent(F.sum("risky"), F.sum("total"), 4).alias("par30_pct"),
            F.coalesce(F.sum("flags"), F.lit(0)).alias("anomaly_count"),
        )
    )
    rate = F.col("default_rate_pct")
    score = F.when(rate > 5, "HIGH").when(rate > 3, "MEDIUM").otherwise("LOW")
    return rows.withColumn("score", score).orderBy(
        F.desc_nulls_last(HEATMAP_METRICS[metric]), "country", "state"
    )
