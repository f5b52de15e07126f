"""Portfolio indicators.

Every job aggregates the facts first and joins or windows the small result.
Windows without a partition run over day or month rows only; their number is
bounded by the calendar, not by the data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lendscope.functions.credit import at_risk
from lendscope.functions.dates import date_lit, day_number, month_start
from lendscope.functions.numbers import count_if, half_up, money, percent, ratio, sum_if
from lendscope.operators.rolling import rolling_rows_sum
from lendscope.sources.star import Star
from lendscope.sources.workspace import stored


def _daily_portfolio(loan: DataFrame, rule: str) -> DataFrame:
    risky = at_risk(rule)
    return loan.groupBy(F.col("issue_date").alias("full_date")).agg(
        F.sum("outstanding_balance").alias("total"),
        sum_if(risky, "outstanding_balance").alias("risky"),
        F.count("loan_key").alias("total_loans"),
        count_if(risky).alias("at_risk_loans"),
    )


def par30(star: Star, rule: str = "par_or_npl", zero_fill: bool = False) -> DataFrame:
    """Portfolio at risk per issue date, with 7- and 30-row means.

    A date without a risky loan has a NULL share, which the means skip;
    ``zero_fill`` makes it 0.
    """
    daily = _daily_portfolio(star.loan, rule)
    risky = F.coalesce(F.col("risky"), F.lit(0)) if zero_fill else F.col("risky")
    daily = daily.withColumn("_share", ratio(risky, F.col("total")) * 100.0)
    ordered = Window.orderBy("full_date")
    return daily.select(
        "full_date",
        money(F.col("total")).alias("total_portfolio"),
        money(risky).alias("at_risk_balance"),
        "total_loans",
        "at_risk_loans",
        half_up(F.col("_share"), 4).alias("par30_pct"),
        half_up(F.avg("_share").over(ordered.rowsBetween(-6, 0)), 4).alias("par30_7d_avg"),
        half_up(F.avg("_share").over(ordered.rowsBetween(-29, 0)), 4).alias("par30_30d_avg"),
    ).orderBy("full_date")


def _monthly_defaults(loan: DataFrame) -> DataFrame:
    defaulted = F.col("loan_status") == "DEFAULTED"
    return loan.groupBy(month_start(F.col("issue_date")).alias("month_start")).agg(
        F.count("loan_key").alias("total_loans_issued"),
        count_if(defaulted).alias("defaults"),
        F.sum("principal_amount").alias("principal"),
        sum_if(defaulted, "principal_amount").alias("lost"),
    )


def default_rate(star: Star) -> DataFrame:
    """Default rate by month of issue, with quarter- and year-to-date counts."""
    month = F.col("month_start")
    named = _monthly_defaults(star.loan).withColumns(
        {
            "year": F.year(month),
            "month_num": F.month(month),
            "month_name": F.date_format(month, "MMMM"),
            "_quarter": F.quarter(month),
        }
    )
    in_year = Window.partitionBy("year").orderBy("month_num")
    in_quarter = Window.partitionBy("year", "_quarter").orderBy("month_num")
    return named.select(
        "year",
        "month_num",
        "month_name",
        "month_start",
        "total_loans_issued",
        "defaults",
        percent(F.col("defaults"), F.col("total_loans_issued"), 4).alias("default_rate_pct"),
        money(F.col("lost")).alias("defaulted_principal"),
        percent(F.col("lost"), F.col("principal"), 4).alias("default_amount_pct"),
        F.sum("defaults").over(in_quarter).alias("qtd_defaults"),
        F.sum("defaults").over(in_year).alias("ytd_defaults"),
    ).orderBy("year", "month_num")


VOLUME_GRAIN = ("country", "state", "city", "region_tier", "transaction_type")


def txn_volume(star: Star, calendar: bool = False) -> DataFrame:
    """Daily volume by region and type with the change to the previous row.

    Transactions are summed by region key before the region join. ``calendar``
    adds empty days of each series, so that "previous" is the previous day.
    """
    daily = star.txn.groupBy("txn_date", "region_key", "transaction_type").agg(
        F.count("txn_key").alias("txn_count"),
        F.sum("amount").alias("volume"),
        F.count("amount").alias("_amounts"),
        count_if(F.col("is_anomaly")).alias("anomaly_count"),
    )
    if calendar:
        series = daily.groupBy("region_key", "transaction_type").agg(
            F.min("txn_date").alias("_from"), F.max("txn_date").alias("_to")
        )
        days = series.select(
            "region_key", "transaction_type", F.explode(F.sequence("_from", "_to")).alias("txn_date")
        )
        grain = ["txn_date", "region_key", "transaction_type"]
        daily = days.join(daily, grain, "left").na.fill(0, ["txn_count", "volume", "_amounts", "anomaly_count"])
    placed = daily.join(star.region, "region_key")
    previous = F.lag("volume").over(Window.partitionBy(*VOLUME_GRAIN).orderBy("txn_date"))
    return (
        placed.withColumn("_previous", previous)
        .select(
            F.col("txn_date").alias("full_date"),
            F.year("txn_date").alias("year"),
            F.month("txn_date").alias("month_num"),
            F.weekofyear("txn_date").alias("week_of_year"),
            *VOLUME_GRAIN,
            "txn_count",
            money(F.col("volume")).alias("total_volume"),
            half_up(ratio(F.col("volume"), F.col("_amounts")), 2).alias("avg_amount"),
            "anomaly_count",
            money(F.col("_previous")).alias("prev_day_volume"),
            percent(F.col("volume") - F.col("_previous"), F.col("_previous"), 2).alias("dod_pct_change"),
        )
        .orderBy("full_date", "country", "state", "city", "region_tier", "transaction_type")
    )


def _daily_anomalies(star: Star) -> DataFrame:
    flagged = F.col("is_anomaly")
    by_key = star.txn.groupBy("txn_date", "transaction_type", "region_key").agg(
        count_if(flagged).alias("n"),
        F.count("*").alias("total"),
        sum_if(flagged, "anomaly_score").alias("scores"),
        sum_if(flagged, "amount").alias("volume"),
    )
    places = star.region.select("region_key", "country", "state")
    # one partitioning by day serves this aggregate, the windows within a day
    # and the daily totals; the rows are aggregates already
    return (
        by_key.join(places, "region_key")
        .withColumnRenamed("txn_date", "full_date")
        .repartition("full_date")
        .groupBy("full_date", "transaction_type", "country", "state")
        .agg(
            F.sum("n").alias("anomaly_count"),
            F.sum("total").alias("total_txns"),
            F.sum("scores").alias("_scores"),
            F.sum("volume").alias("_volume"),
        )
    )


def anomaly_summary(star: Star, rolling: bool = True, store: bool = True) -> DataFrame:
    """Flags per date, type, country and state.

    ``anomaly_7d_rolling`` is the total of the seven calendar days up to the
    date; ``anomaly_7row_rolling`` sums the last seven rows of the table in
    the order (date, type, country, state). ``rolling=False`` leaves both out.

    For the sums the grouped rows are stored first: three branches use them,
    and the facts are still read once. ``store=False`` keeps all lazy.
    """
    rows, sums = _daily_anomalies(star), []
    if rolling:
        rows = stored(rows, "daily-anomalies") if store else rows
        sums = ["anomaly_7d_rolling", "anomaly_7row_rolling"]
        days = rows.groupBy("full_date").agg(F.sum("anomaly_count").alias("_day"))
        week = Window.orderBy(day_number(F.col("full_date"))).rangeBetween(-6, 0)
        weekly = days.select("full_date", F.sum("_day").over(week).alias(sums[0]))
        order = [F.col("transaction_type"), F.col("country"), F.col("state")]
        rows = rolling_rows_sum(rows, "full_date", order, "anomaly_count", sums[1]).join(weekly, "full_date")
    return rows.select(
        "full_date",
        "transaction_type",
        "country",
        "state",
        "anomaly_count",
        "total_txns",
        half_up(ratio(F.col("_scores"), F.col("anomaly_count")), 4).alias("avg_anomaly_score"),
        money(F.col("_volume")).alias("anomalous_volume"),
        percent(F.col("anomaly_count"), F.col("total_txns"), 4).alias("anomaly_rate_pct"),
        *sums,
    ).orderBy(F.desc("full_date"), F.desc("anomaly_count"), "transaction_type", "country", "state")


def npl_ratio(star: Star) -> DataFrame:
    """Non-performing share by month of issue, risk tier and category."""
    bad = F.col("is_npl")
    by_product = star.with_customer(star.loan).groupBy(
        month_start(F.col("issue_date")).alias("_month"), "risk_tier", "product_key"
    ).agg(
        F.count("loan_key").alias("n"),
        count_if(bad).alias("n_bad"),
        F.sum("outstanding_balance").alias("owed"),
        sum_if(bad, "outstanding_balance").alias("owed_bad"),
    )
    return (
        by_product.join(star.product.select("product_key", "category"), "product_key")
        .groupBy("_month", "risk_tier", F.col("category").alias("product_category"))
        .agg(
            F.sum("n").alias("total_loans"),
            F.sum("n_bad").alias("npl_loans"),
            money(F.sum("owed")).alias("total_outstanding"),
            money(F.sum("owed_bad")).alias("npl_outstanding"),
        )
        .select(
            F.year("_month").alias("year"),
            F.month("_month").alias("month_num"),
            F.date_format("_month", "MMMM").alias("month_name"),
            "risk_tier",
            "product_category",
            "total_loans",
            "npl_loans",
            "total_outstanding",
            "npl_outstanding",
            percent(F.col("npl_loans"), F.col("total_loans"), 4).alias("npl_ratio_pct"),
        )
        .orderBy("year", "month_num", F.desc("npl_ratio_pct"), "risk_tier", "product_category")
    )


SNAPSHOT_KPIS = (
    "par30_30d_avg",
    "current_month_default_rate",
    "anomaly_count_yesterday",
    "active_loan_count",
    "overall_npl_ratio",
    "total_active_portfolio",
)


def _book_totals(loan: DataFrame, in_month: Column) -> DataFrame:
    """One conditional pass over all loans."""
    active = F.col("loan_status") == "ACTIVE"
    defaulted = F.col("loan_status") == "DEFAULTED"
    return loan.agg(
        percent(count_if(in_month & defaulted), count_if(in_month), 4).alias("current_month_default_rate"),
        count_if(active).alias("active_loan_count"),
        percent(count_if(F.col("is_npl")), F.count("loan_key"), 4).alias("overall_npl_ratio"),
        money(sum_if(active, "outstanding_balance")).alias("total_active_portfolio"),
    )


def kpi_snapshot(star: Star, as_of, rule: str = "par_or_npl", known_only: bool = False) -> DataFrame:
    """The indicators at ``as_of`` as one row.

    The 30-day mean takes issue dates from ``as_of - 30`` on, the rate the
    month of ``as_of``, the flags the day before. Rows dated after ``as_of``
    count as in the plain table; ``known_only`` leaves them out of the mean
    and the rate, as a replay for a past day needs.
    """
    day = date_lit(as_of)
    issued = F.col("issue_date")
    in_month = (issued >= month_start(day)) & (issued <= F.last_day(day))
    if known_only:
        in_month = in_month & (issued <= day)
    recent = star.loan_between(F.date_sub(day, 30), day if known_only else None)
    shares = _daily_portfolio(recent, rule).select(
        half_up(ratio(F.col("risky"), F.col("total")) * 100.0, 4).alias("pct")
    )
    yesterday = F.date_sub(day, 1)
    flags = star.txn_between(yesterday, yesterday).agg(count_if(F.col("is_anomaly")).alias("n"))
    return _book_totals(star.loan, in_month).select(
        day.alias("snapshot_ts"),
        shares.agg(half_up(F.avg("pct"), 4).alias("v")).scalar().alias("par30_30d_avg"),
        "current_month_default_rate",
        flags.scalar().alias("anomaly_count_yesterday"),
        "active_loan_count",
        "overall_npl_ratio",
        "total_active_portfolio",
    )


def kpi_history(star: Star, start, end, rule: str = "par_or_npl") -> DataFrame:
    """The snapshot for every day of ``[start, end]``.

    One grouped pass per fact gives day rows; calendar windows over them give
    each day's indicators. Status is not kept by date, so the three terms that
    read current status are the same on all days.
    """
    active = F.col("loan_status") == "ACTIVE"
    loan_days = star.loan.groupBy(F.col("issue_date").alias("d")).agg(
        F.sum("outstanding_balance").alias("_total"),
        sum_if(at_risk(rule), "outstanding_balance").alias("_risky"),
        F.count("loan_key").alias("_issued"),
        count_if(F.col("loan_status") == "DEFAULTED").alias("_defaults"),
        count_if(active).alias("_active"),
        count_if(F.col("is_npl")).alias("_npl"),
        sum_if(active, "outstanding_balance").alias("_active_balance"),
    )
    loan_days = loan_days.withColumn("_pct", half_up(ratio(F.col("_risky"), F.col("_total")) * 100.0, 4))
    flag_days = (
        star.txn_between(F.date_sub(date_lit(start), 1), F.date_sub(date_lit(end), 1))
        .groupBy(F.date_add("txn_date", 1).alias("d"))
        .agg(count_if(F.col("is_anomaly")).alias("_flags"))
    )
    calendar = star.loan.sparkSession.range(1).select(
        F.explode(F.sequence(date_lit(start), date_lit(end))).alias("d")
    )
    last30 = Window.orderBy(day_number(F.col("d"))).rangeBetween(-30, 0)
    to_date = Window.partitionBy(month_start(F.col("d"))).orderBy("d")
    whole = Window.partitionBy()

    def total(column: str) -> Column:
        return F.sum(column).over(whole)

    return (
        calendar.join(loan_days, "d", "full_outer")
        .join(flag_days, "d", "left")
        .select(
            F.col("d").alias("snapshot_ts"),
            half_up(F.avg("_pct").over(last30), 4).alias("par30_30d_avg"),
            percent(F.sum("_defaults").over(to_date), F.sum("_issued").over(to_date), 4).alias(
                "current_month_default_rate"
            ),
            F.coalesce("_flags", F.lit(0)).alias("anomaly_count_yesterday"),
            F.coalesce(total("_active"), F.lit(0)).alias("active_loan_count"),
            percent(total("_npl"), total("_issued"), 4).alias("overall_npl_ratio"),
            money(total("_active_balance")).alias("total_active_portfolio"),
        )
        .filter(F.col("snapshot_ts").between(date_lit(start), date_lit(end)))
        .orderBy("snapshot_ts")
    )
