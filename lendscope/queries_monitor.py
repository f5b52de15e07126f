"""Registered queries of monitoring, reports, dashboard and streams."""

from __future__ import annotations

import datetime as dt
from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lendscope.functions.numbers import half_up, money
from lendscope.plans import eda, kpi, monitor, reports
from lendscope.plans.cache import CACHE, refresh_kpi_cache
from lendscope.sources import bridge
from lendscope.sources.bridge import AS_OF, bridge_star
from lendscope.sources.schemas import STAGING_COLUMNS
from lendscope.sources.staging import write_staging
from lendscope.sources.store import TableStore
from lendscope.sources.workspace import fresh_path, stored
from lendscope.streaming import jobs, keyed
from lendscope.streaming.alerts import AlertLedger
from lendscope.streaming.ledgers import BaselineLedger, DailyLedger, follow

POLLS_FROM = dt.date(2000, 7, 31)
# The default limit of 50 flags a day is not reached on the small scales.
LIMITS = monitor.with_limit("anomaly_count_yesterday", 6)
SNAPSHOT_LIMITS = monitor.with_limit("anomaly_count_yesterday", 2)


def _star(job, *args, **params):
    return lambda spark, sf_dir: job(bridge_star(spark, sf_dir), *args, **params)


def _history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kpi.kpi_history(bridge_star(spark, sf_dir), POLLS_FROM, AS_OF)


def kpi_cache(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two refreshes; the reader sees the second."""
    store, star = TableStore(spark, fresh_path(spark, "reporting")), bridge_star(spark, sf_dir)
    refresh_kpi_cache(store, star, AS_OF - dt.timedelta(days=1))
    refresh_kpi_cache(store, star, AS_OF)
    return store.read(CACHE)


def mon_breaches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return monitor.breaches(kpi.kpi_snapshot(bridge_star(spark, sf_dir), AS_OF), SNAPSHOT_LIMITS)


def mon_alert_lifecycle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return monitor.alert_lifecycle(_history(spark, sf_dir), LIMITS)


def mon_alert_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return monitor.alert_counts(_history(spark, sf_dir), LIMITS)


def mon_investigate(spark: SparkSession, sf_dir: str) -> DataFrame:
    star = bridge_star(spark, sf_dir)
    breached = monitor.breaches(kpi.kpi_snapshot(star, AS_OF), SNAPSHOT_LIMITS)
    return monitor.investigation(star, breached, AS_OF)


def alert_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    findings = monitor.findings_text(mon_investigate(spark, sf_dir))
    return monitor.alert_payload(monitor.events(monitor.evaluate(_history(spark, sf_dir), LIMITS)), findings)


def mon_breaches_below(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The non-performing share watched from below."""
    limits = tuple(
        replace(t, limit=90.0, direction=monitor.BELOW) if t.kpi == "overall_npl_ratio" else t for t in SNAPSHOT_LIMITS
    )
    return monitor.breaches(kpi.kpi_snapshot(bridge_star(spark, sf_dir), AS_OF), limits)


def mon_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each fired alert of the history as a free message."""
    fired = monitor.alert_lifecycle(_history(spark, sf_dir), LIMITS)
    text = F.concat("kpi_name", F.lit(" fired, alert "), F.col("alert_no").cast("string"))
    return monitor.message_payload(fired.select(text.alias("message"), "severity"))


def report_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two extracts written as a report and one of them read back."""
    star, path = bridge_star(spark, sf_dir), fresh_path(spark, "report")
    trend = reports.default_trend(star)
    reports.write_report({"default_trend": trend, "npl": reports.npl_top(star)}, path)
    return spark.read.schema(trend.schema).parquet(f"{path}/default_trend")


# --- streams -----------------------------------------------------------------


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jobs.event_stream(spark, f"{sf_dir}/events*.parquet")


def _to_files(spark: SparkSession, stream: DataFrame, name: str, **options: str) -> DataFrame:
    root = fresh_path(spark, name)
    return jobs.run_to_files(stream, f"{root}/table", f"{root}/checkpoint", **options)


def stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    landed = bridge.transactions_of(_events(spark, sf_dir)).select(
        "transaction_id", "customer_key", "txn_date", "transaction_type", money(F.col("amount")).alias("amount"), "currency"
    )
    return _to_files(spark, landed, "stream-ingest")


def stream_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer files as they land, one CSV file per batch."""
    path = fresh_path(spark, "landing-stream")
    write_staging(bridge.raw_customers(spark, sf_dir).repartition(3, "customer_id"), path, "raw_customers")
    rows = jobs.staging_stream(spark, path, "raw_customers", max_files=1)
    return _to_files(spark, rows.select(*STAGING_COLUMNS["raw_customers"]), "stream-landing")


def stream_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = bridge.table(spark, sf_dir, "lineitem").schema
    lines = jobs.file_stream(spark, f"{sf_dir}/lineitem*.parquet", schema)
    keyed = lines.select(
        F.concat(F.col("l_orderkey").cast("string"), F.lit("-"), F.col("l_linenumber").cast("string")).alias("transaction_id"),
        "l_shipdate",
    )
    return _to_files(spark, jobs.dedup(keyed, "transaction_id", "l_shipdate", "7 days").select("transaction_id"), "stream-dedup")


def _in_disorder(spark: SparkSession, sf_dir: str, name: str, key: str, files: int = 4, columns: list[str] | None = None) -> str:
    """The table in files that each span all dates; the stream reads one per batch. ``columns``: those
    that the stream reads, if not all."""
    path = fresh_path(spark, f"disorder-{name}")
    rows = bridge.table(spark, sf_dir, name)
    rows = rows.select(*(columns or rows.columns), F.pmod(F.col(key), F.lit(files)).alias("slice"))
    rows.repartition(files, "slice").write.partitionBy("slice").parquet(path)
    return path


def stream_daily_disorder(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily counts of events that come in any date order: on time and late together."""
    path, root = _in_disorder(spark, sf_dir, "events", "event_id"), fresh_path(spark, "stream-daily-ledger")
    ledger = DailyLedger(spark, root)
    rows = jobs.event_stream(spark, f"{path}/slice=*", max_files=1)
    profile = fresh_path(spark, "baseline")
    bridge.stored_baseline(spark, sf_dir).write.parquet(profile)
    follow(rows, jobs.score_latest(profile, ledger.of(f"{root}/checkpoint")), f"{root}/checkpoint")
    on_time = F.col("total_txns") - F.col("late_txns")
    late = ledger.late().groupBy(F.col("txn_date").alias("full_date"), "transaction_type").agg(F.count("*").alias("n"))
    both = ledger.daily().join(late, ["full_date", "transaction_type"], "left")
    return both.select("full_date", "transaction_type", (on_time + F.coalesce("n", F.lit(0))).alias("total_txns"), "anomaly_count")


def stream_dedup_disorder(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items that come twice in any date order and once more 60 days later, where a repeat
    is one within seven days; those of the seventh line have no id and stay, each of them."""
    needed = ["l_orderkey", "l_linenumber", "l_shipdate"]
    day = F.col("l_shipdate").cast("date")
    key = F.concat_ws("-", "l_orderkey", "l_linenumber", day.cast("string"))
    with keyed.state_settings(spark):
        path = _in_disorder(spark, sf_dir, "lineitem", "l_suppkey", columns=needed)
        schema = bridge.table(spark, sf_dir, "lineitem").select(*needed).schema
        lines = [
            jobs.file_stream(spark, f"{path}/slice=*", schema, max_files=files).select(
                F.when(F.col("l_linenumber") != 7, key).alias("transaction_id"), F.date_add(day, later).alias("ship_date")
            )
            for files, later in ((1, 0), (2, 0), (2, 60))
        ]
        kept = keyed.first_per_key(reduce(DataFrame.unionByName, lines), "transaction_id", "ship_date", days=7)
        return _to_files(spark, kept, "stream-dedup-keyed", compression="zstd")


def stream_baseline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean and deviation per customer, kept up batch by batch in any date order."""
    path, root = _in_disorder(spark, sf_dir, "events", "event_id"), fresh_path(spark, "stream-baseline")
    ledger = BaselineLedger(spark, f"{root}/ledger")
    rows = bridge.transactions_of(jobs.event_stream(spark, f"{path}/slice=*", max_files=1))
    ledger.follow(rows.select(F.col("customer_key").cast("string").alias("customer_id"), "amount"), f"{root}/checkpoint")
    mean, deviation = half_up(F.col("avg_amount"), 6), half_up(F.col("sd_amount"), 6)
    return ledger.baseline().select("customer_id", mean.alias("avg_amount"), deviation.alias("sd_amount"), "n_txn")


def stream_zscore_partial(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores where only the customers with an even key have statistics; the others score 0."""
    stats = bridge.customer_stats(bridge.table(spark, sf_dir, "events")).filter("customer_key % 2 = 0")
    profile = stored(bridge.baseline(stats, bridge.customer(spark, sf_dir)), "baseline")
    rows = jobs.score(_events(spark, sf_dir), profile).select(
        "transaction_id", half_up(F.col("z_score"), 6).alias("z_score"), "is_anomaly"
    )
    return _to_files(spark, rows, "stream-zscore-partial")


def stream_zscore(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = jobs.score(_events(spark, sf_dir), bridge.stored_baseline(spark, sf_dir)).select(
        "transaction_id",
        "customer_id",
        money(F.col("amount")).alias("amount"),
        half_up(F.col("z_score"), 6).alias("z_score"),
        money(F.col("anomaly_score")).alias("anomaly_score"),
        "is_anomaly",
        "anomaly_reason",
    )
    return _to_files(spark, rows, "stream-zscore")


def stream_anomaly_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = jobs.score(_events(spark, sf_dir), bridge.stored_baseline(spark, sf_dir))
    return _to_files(spark, jobs.daily_anomalies(rows), "stream-daily")


def stream_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The indicator history as a stream through the alert ledger."""
    root = fresh_path(spark, "stream-alerts")
    history = _history(spark, sf_dir)
    history.write.parquet(f"{root}/polls")
    ledger = AlertLedger(spark, f"{root}/ledger", LIMITS)
    ledger.follow(jobs.file_stream(spark, f"{root}/polls", history.schema), f"{root}/checkpoint")
    return ledger.alerts()


def stream_alerts_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same history with the polls of odd days delivered after all others."""
    root = fresh_path(spark, "stream-alerts-late")
    history = stored(_history(spark, sf_dir), "polls")
    ledger = AlertLedger(spark, f"{root}/ledger", LIMITS)
    odd = F.day("snapshot_ts") % 2 == 1
    for name, polls in (("even", history.filter(~odd)), ("odd", history.filter(odd))):
        polls.write.parquet(f"{root}/{name}")
        stream = jobs.file_stream(spark, f"{root}/{name}", history.schema)
        ledger.follow(stream, f"{root}/checkpoint-{name}")
    return ledger.alerts()


def _new_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The matrix with a category nobody listed."""
    star = bridge_star(spark, sf_dir)
    renamed = star.product.replace("AUTO", "BOAT", "category")
    return reports.bi_default_matrix(star.replaced(product=renamed))


def _transitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.bi_dpd_transitions(bridge.loan_day2(bridge.loan(spark, sf_dir)))


QUERIES = {
    "kpi_cache": kpi_cache,
    "mon_kpi_history": _history,
    "mon_breaches": mon_breaches,
    "mon_alert_lifecycle": mon_alert_lifecycle,
    "mon_alert_counts": mon_alert_counts,
    "mon_breaches_below": mon_breaches_below,
    "mon_messages": mon_messages,
    "mon_investigate": mon_investigate,
    "alert_payload": alert_payload,
    "mon_volume_drop": _star(monitor.volume_drop),
    "stream_ingest": stream_ingest,
    "stream_landing": stream_landing,
    "stream_dedup": stream_dedup,
    "stream_zscore": stream_zscore,
    "stream_anomaly_daily": stream_anomaly_daily,
    "stream_alerts": stream_alerts,
    "stream_alerts_late": stream_alerts_late,
    "stream_daily_disorder": stream_daily_disorder,
    "stream_dedup_disorder": stream_dedup_disorder,
    "stream_zscore_partial": stream_zscore_partial,
    "stream_baseline": stream_baseline,
    "rpt_kpi_summary": _star(reports.kpi_summary, AS_OF),
    "rpt_default_trend": _star(reports.default_trend),
    "rpt_par30_90d": _star(reports.par30_recent),
    "rpt_anomaly_500": _star(reports.anomaly_top),
    "rpt_sink": report_sink,
    "rpt_npl_200": _star(reports.npl_top),
    "bi_par30": _star(reports.bi_par30),
    "bi_default_mom": _star(reports.bi_default_mom, AS_OF),
    "bi_npl": _star(reports.bi_npl),
    "bi_default_matrix": _star(reports.bi_default_matrix),
    "bi_default_matrix_new_category": _new_category,
    "bi_top_states": _star(reports.bi_top_states),
    "bi_txn_daily_by_type": _star(reports.bi_txn_daily_by_type),
    "bi_txn_by_region": _star(reports.bi_txn_by_region),
    "bi_anomaly_scatter": _star(reports.bi_anomaly_scatter),
    "bi_dpd_transitions": _transitions,
    "bi_par_region_month": _star(reports.bi_par_region_month),
    "bi_top20_at_risk": _star(reports.bi_top20_at_risk),
    "dash_cards": _star(reports.dash_cards, AS_OF),
    "dash_default_quarterly": _star(reports.dash_default_quarterly),
    "dash_risk_mix": _star(reports.dash_risk_mix),
    "dash_par_bucket_share": _star(reports.dash_par_bucket_share),
    "dash_daily_anomalies": _star(reports.dash_daily_anomalies, AS_OF),
    "dash_loan_status": _star(reports.dash_loan_status),
    "dash_region_heatmap": _star(reports.dash_region_heatmap, AS_OF, "default", None, 365),
    "dash_region_heatmap_country": _star(reports.dash_region_heatmap, AS_OF, "par30", "europe", None),
    "slicer_status_mix": lambda spark, d: eda.status_mix(
        bridge_star(spark, d).sliced(end="1999-06-30", category="SME", risk_tier="LOW")
    ),
    "slicer_volume": lambda spark, d: reports.bi_txn_daily_by_type(
        bridge_star(spark, d).sliced(start="2001-07-05", end="2001-07-20", state="State_4")
    ),
    "slicer_default_rate": lambda spark, d: kpi.default_rate(
        bridge_star(spark, d).sliced(start="1997-01-01", end="2000-12-31", risk_tier="HIGH", category="AUTO", state="State_3")
    ),
}
