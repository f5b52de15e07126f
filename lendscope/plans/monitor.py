"""Threshold checks, alert life cycle, messages and root-cause rows.

Inputs are indicator rows: one per poll, from ``kpi_snapshot`` or
``kpi_history``. Their number is polls, not facts.
"""

from __future__ import annotations

from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lendscope.functions.dates import date_lit, month_start
from lendscope.functions.numbers import count_if, money, percent
from lendscope.plans import investigate
from lendscope.sources.star import Star

ABOVE, BELOW = "above", "below"


@dataclass(frozen=True)
class Threshold:
    kpi: str
    label: str
    limit: float
    direction: str = ABOVE


# The monitored indicators, their names and limits.
THRESHOLDS = (
    Threshold("par30_30d_avg", "PAR-30 Rate (%)", 5.0),
    Threshold("current_month_default_rate", "Default Rate (%)", 3.0),
    Threshold("anomaly_count_yesterday", "Anomaly Count (Yesterday)", 50.0),
    Threshold("overall_npl_ratio", "NPL Ratio (%)", 8.0),
)
CRITICAL_FACTOR = 1.5
BODY_LIMIT = 2900
LOG_LIMIT = 100


def with_limit(kpi: str, limit: float, thresholds: tuple[Threshold, ...] = THRESHOLDS) -> tuple[Threshold, ...]:
    return tuple(replace(t, limit=float(limit)) if t.kpi == kpi else t for t in thresholds)


def threshold_table(spark, thresholds: tuple[Threshold, ...] = THRESHOLDS) -> DataFrame:
    """One row per monitored indicator."""
    rows = ", ".join(f"('{t.kpi}', '{t.label}', {t.limit!r}D, '{t.direction}')" for t in thresholds)
    return spark.sql(f"SELECT * FROM VALUES {rows} AS t(kpi, kpi_name, threshold, direction)")


def evaluate(snapshots: DataFrame, thresholds: tuple[Threshold, ...] = THRESHOLDS) -> DataFrame:
    """(as_of, kpi) rows with value, limit, breach flag and severity.

    A missing value counts as 0. Above: critical beyond 1.5 times the limit;
    below: critical under the limit divided by 1.5.
    """
    kpis = [t.kpi for t in thresholds]
    values = snapshots.select(
        F.col("snapshot_ts").alias("as_of"), *[F.coalesce(F.col(k).cast("double"), F.lit(0.0)).alias(k) for k in kpis]
    ).unpivot("as_of", kpis, "kpi", "value")
    # one row per monitored indicator
    limits = F.broadcast(threshold_table(snapshots.sparkSession, thresholds))
    return judged(values.join(limits, "kpi"))


def judged(rows: DataFrame) -> DataFrame:
    """Add ``breached`` and ``severity`` to (value, threshold, direction) rows."""
    value, limit = F.col("value"), F.col("threshold")
    above = F.col("direction") == ABOVE
    breached = F.when(above, value > limit).otherwise(value < limit)
    critical = F.when(above, value > limit * CRITICAL_FACTOR).otherwise(value < limit / CRITICAL_FACTOR)
    return rows.withColumns(
        {
            "breached": breached,
            "severity": F.when(breached & critical, "CRITICAL").when(breached, "WARNING"),
        }
    )


def breaches(snapshots: DataFrame, thresholds: tuple[Threshold, ...] = THRESHOLDS) -> DataFrame:
    return (
        evaluate(snapshots, thresholds)
        .filter("breached")
        .select("as_of", "kpi", "kpi_name", "value", "threshold", "direction", "severity")
    )


def with_events(evaluated: DataFrame) -> DataFrame:
    """Add FIRE, SUPPRESS, RESOLVE or NULL per poll, and ``alert_no``, the
    number of alerts the indicator fired so far.

    Every poll checks every indicator, so "alert active" equals "breached at
    the previous poll". A poll that is missing from the input is skipped.
    """
    line = Window.partitionBy("kpi").orderBy("as_of")
    before = F.coalesce(F.lag("breached").over(line), F.lit(False))
    event = (
        F.when(F.col("breached") & ~before, "FIRE")
        .when(F.col("breached"), "SUPPRESS")
        .when(before, "RESOLVE")
    )
    fired = F.count(F.when(F.col("event") == "FIRE", 1)).over(line)
    return evaluated.withColumn("event", event).withColumn("alert_no", fired)


def events(evaluated: DataFrame) -> DataFrame:
    """The polls with an event."""
    return with_events(evaluated).filter(F.col("event").isNotNull())


def alerts(event_rows: DataFrame) -> DataFrame:
    """One row per alert, with its values at trigger time."""
    fired = F.col("event") == "FIRE"

    def at_trigger(column: str) -> Column:
        return F.max(F.when(fired, F.col(column))).alias(column)

    return (
        event_rows.groupBy("kpi", "kpi_name", "alert_no")
        .agg(
            F.max(F.when(fired, F.col("as_of"))).alias("triggered_at"),
            F.max(F.when(F.col("event") == "RESOLVE", F.col("as_of"))).alias("resolved_at"),
            at_trigger("value"),
            at_trigger("threshold"),
            at_trigger("severity"),
            count_if(F.col("event") == "SUPPRESS").alias("suppressed_polls"),
        )
        .withColumnRenamed("value", "trigger_value")
        .orderBy("kpi", "alert_no")
    )


def alert_lifecycle(snapshots: DataFrame, thresholds: tuple[Threshold, ...] = THRESHOLDS) -> DataFrame:
    return alerts(events(evaluate(snapshots, thresholds)))


def alert_counts(snapshots: DataFrame, thresholds: tuple[Threshold, ...] = THRESHOLDS) -> DataFrame:
    """Polls with a snapshot and alerts fired."""
    fired = events(evaluate(snapshots, thresholds)).agg(count_if(F.col("event") == "FIRE").alias("n"))
    return snapshots.agg(F.count("*").alias("total_polls")).select(
        "total_polls", fired.scalar().alias("total_alerts_fired")
    )


# --- messages ----------------------------------------------------------------

# Message colours.
COLORS = {"WARNING": "#F0A500", "CRITICAL": "#E53E3E", "RESOLVE": "#38A169"}


def _fixed(value: Column) -> Column:
    return F.format_string("%.4f", value)


def alert_payload(event_rows: DataFrame, findings: DataFrame, channel: str = "#portfolio-alerts") -> DataFrame:
    """One message row per FIRE and RESOLVE, with its JSON form.

    ``findings`` (kpi, body) is the root-cause text; the body is cut to what a
    message block holds. A resolution names the value at trigger time.
    """
    per_alert = Window.partitionBy("kpi", "alert_no")
    trigger = F.max(F.when(F.col("event") == "FIRE", F.col("value"))).over(per_alert)
    rows = (
        event_rows.withColumn("shown_value", trigger)
        .filter(F.col("event").isin("FIRE", "RESOLVE"))
        .join(findings, "kpi", "left")
    )
    fires = F.col("event") == "FIRE"
    header = F.when(
        fires, F.concat(F.lit("Portfolio alert: "), F.col("severity"), F.lit(" – "), F.col("kpi_name"))
    ).otherwise(F.concat(F.lit("Resolved – "), F.col("kpi_name")))
    body = F.left(F.coalesce(F.col("body"), F.lit("No data found.")), F.lit(BODY_LIMIT))
    flat = rows.select(
        "as_of",
        "kpi",
        "event",
        F.lit(channel).alias("channel"),
        F.when(fires, F.when(F.col("severity") == "CRITICAL", COLORS["CRITICAL"]).otherwise(COLORS["WARNING"]))
        .otherwise(COLORS["RESOLVE"])
        .alias("color"),
        header.alias("header"),
        F.concat(F.lit("*KPI:*\n"), "kpi_name").alias("field_kpi"),
        F.when(fires, F.concat(F.lit("*Severity:*\n"), "severity")).alias("field_severity"),
        F.concat(F.lit("*Current Value:*\n`"), _fixed(F.col("shown_value")), F.lit("`")).alias("field_value"),
        F.concat(F.lit("*Threshold:*\n`"), _fixed(F.col("threshold")), F.lit("`")).alias("field_threshold"),
        F.concat(
            F.when(fires, F.lit("*Detected At:*\n")).otherwise(F.lit("*Resolved At:*\n")), F.col("as_of").cast("string")
        ).alias("field_time"),
        F.when(fires, F.concat(F.lit("*Direction:*\n"), F.upper("direction"))).alias("field_direction"),
        F.when(fires, body).alias("body"),
    )
    fields = ("field_kpi", "field_severity", "field_value", "field_threshold", "field_time", "field_direction")
    texts = F.filter(F.array(*fields), lambda f: f.isNotNull())
    blocks = F.struct("channel", "color", "header", texts.alias("fields"), "body")
    return flat.withColumn("payload", F.to_json(blocks))


# Colours of free messages by severity.
MESSAGE_COLORS = {"INFO": "#3182CE", "WARNING": "#F0A500", "CRITICAL": "#E53E3E"}


def message_payload(messages: DataFrame, channel: str = "#portfolio-alerts") -> DataFrame:
    """Free messages (message, severity) as message rows; an unknown severity
    gets the warning colour."""
    level = F.upper("severity")
    color = F.lit(MESSAGE_COLORS["WARNING"])
    for name, value in MESSAGE_COLORS.items():
        color = F.when(level == name, value).otherwise(color)
    flat = messages.select(
        F.lit(channel).alias("channel"),
        color.alias("color"),
        F.concat(F.lit("Portfolio message ["), level, F.lit("]")).alias("header"),
        F.left("message", F.lit(BODY_LIMIT)).alias("body"),
    )
    return flat.withColumn("payload", F.to_json(F.struct(*flat.columns)))


# --- root cause --------------------------------------------------------------


def _ranked(frame: DataFrame, kpi: str, segment: Column, measure: str, order: list[Column], n: int) -> DataFrame:
    """The first ``n`` rows as (kpi, rank, segment, measure, value)."""
    top = frame.orderBy(*order).limit(n)
    return top.select(
        F.lit(kpi).alias("kpi"),
        F.row_number().over(Window.orderBy(*order)).alias("rank"),
        segment.alias("segment"),
        F.lit(measure).alias("measure"),
        F.col(measure).cast("double").alias("value"),
    )


def _segments(star: Star, day: Column, n: int) -> DataFrame:
    order = [F.desc("default_rate_pct"), F.asc("risk_tier"), F.asc("product_category"), F.asc("region_state")]
    rows = investigate.default_spike(star, F.date_sub(day, 30), day)
    segment = F.concat_ws(" / ", "risk_tier", "product_category", "region_state")
    return _ranked(rows, "current_month_default_rate", segment, "default_rate_pct", order, n)


def _late_loans(star: Star, day: Column, n: int) -> DataFrame:
    order = [F.desc("outstanding"), F.asc("loan_id")]
    rows = investigate.par30_spike(star, n=n)
    return _ranked(rows, "par30_30d_avg", F.concat_ws(" / ", "loan_id", "customer_id"), "outstanding", order, n)


def _flagged(star: Star, day: Column, n: int) -> DataFrame:
    order = [F.desc("anomaly_score"), F.asc("transaction_id")]
    rows = investigate.anomaly_spike(star, F.date_sub(day, 1))
    segment = F.concat_ws(" / ", "transaction_id", "customer_id")
    return _ranked(rows, "anomaly_count_yesterday", segment, "anomaly_score", order, n)


def _bad_segments(star: Star, as_of, n: int) -> DataFrame:
    order = [F.desc("avg_npl_pct"), F.asc("risk_tier"), F.asc("product_category")]
    rows = investigate.npl_segments(star, as_of.year, n)
    return _ranked(rows, "overall_npl_ratio", F.concat_ws(" / ", "risk_tier", "product_category"), "avg_npl_pct", order, n)


def investigation(star: Star, breached: DataFrame, as_of, n: int = 10) -> DataFrame:
    """For each breached indicator the first ``n`` rows of its drill-down; the
    drill-downs of the others are not run."""
    day = date_lit(as_of)
    drill_downs = {
        "current_month_default_rate": lambda: _segments(star, day, n),
        "par30_30d_avg": lambda: _late_loans(star, day, n),
        "anomaly_count_yesterday": lambda: _flagged(star, day, n),
        "overall_npl_ratio": lambda: _bad_segments(star, as_of, n),
    }
    # at most one row per monitored indicator
    hit = {row.kpi for row in breached.select("kpi").distinct().collect()}
    parts = [rows() for kpi, rows in drill_downs.items() if kpi in hit]
    if not parts:
        layout = "kpi string, rank int, segment string, measure string, value double"
        return breached.sparkSession.createDataFrame([], layout)
    return reduce(DataFrame.unionByName, parts).orderBy("kpi", "rank")


def findings_text(investigated: DataFrame) -> DataFrame:
    """Root-cause rows as one text per indicator (at most ``n`` lines each)."""
    line = F.concat(
        F.col("rank").cast("string"), F.lit(". "), "segment", F.lit(": "), "measure", F.lit(" = "), _fixed(F.col("value"))
    )
    lines = F.array_sort(F.collect_list(F.struct("rank", line.alias("line"))))
    return investigated.groupBy("kpi").agg(
        F.array_join(F.transform(lines, lambda x: x["line"]), "\n").alias("body")
    )


def investigation_log(log: DataFrame, new: DataFrame, keep: int = LOG_LIMIT) -> DataFrame:
    """The log (kpi, summary, logged_at) with new entries, the last ``keep``."""
    return log.unionByName(new).orderBy(F.desc("logged_at"), "kpi").limit(keep)


def volume_drop(star: Star, limit_pct: float = -20.0, period: str = "day") -> DataFrame:
    """States whose volume fell by more than ``limit_pct`` percent against the
    previous period with transactions (``day`` or ``month``)."""
    bucket = month_start(F.col("txn_date")) if period == "month" else F.col("txn_date")
    by_key = star.txn_unscored.groupBy(bucket.alias("period_start"), "region_key").agg(F.sum("amount").alias("v"))
    volume = (
        by_key.join(star.region.select("region_key", "country", "state"), "region_key")
        .groupBy("period_start", "country", "state")
        .agg(F.sum("v").alias("volume"))
    )
    previous = F.lag("volume").over(Window.partitionBy("country", "state").orderBy("period_start"))
    return (
        volume.withColumn("previous", previous)
        .withColumn("change_pct", percent(F.col("volume") - F.col("previous"), F.col("previous"), 2))
        .filter(F.col("change_pct") < limit_pct)
        .select(
            "period_start",
            "country",
            "state",
            money(F.col("volume")).alias("volume"),
            money(F.col("previous")).alias("previous_volume"),
            "change_pct",
        )
        .orderBy("period_start", "country", "state")
    )
