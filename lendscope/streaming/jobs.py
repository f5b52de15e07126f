"""Ingest, deduplicate, score and count transactions as streams."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType, TimestampNTZType

from lendscope.functions.dates import utc_date, utc_instant
from lendscope.functions.numbers import count_if
from lendscope.sources.bridge import EVENT_SHIFT_DAYS, scored, transactions_of
from lendscope.sources.staging import landing_options, landing_schema, stamped

EVENTS = StructType(
    [
        StructField("event_id", LongType()),
        StructField("ts", TimestampNTZType()),
        StructField("user_id", LongType()),
        StructField("event_type", StringType()),
        StructField("value", DoubleType()),
        StructField("props", StringType()),
    ]
)


def file_stream(
    spark: SparkSession, path: str, schema: StructType, fmt: str = "parquet", max_files: int | None = None, **options: str
) -> DataFrame:
    """Files of a folder or glob as a stream; ``max_files`` per micro-batch."""
    reader = spark.readStream.schema(schema).format(fmt).options(**options)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path)


def staging_stream(spark: SparkSession, path: str, table: str, max_files: int | None = None) -> DataFrame:
    """A landing table as a stream of CSV files, stamped like the batch read; malformed lines do not stop it."""
    return stamped(file_stream(spark, path, landing_schema(table), "csv", max_files, **landing_options()))


def event_stream(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    return file_stream(spark, path, EVENTS, max_files=max_files)


def dedup(stream: DataFrame, key: str, time: str, delay: str, spread: bool = False) -> DataFrame:
    """One row of each key; a repeat within ``delay`` of event time is dropped
    and the key's state is freed after it. For rows in rough time order: those
    behind the watermark are dropped; ``ledgers.DedupLedger`` loses none.

    With ``spread`` repeats are first dropped per (key, input task), so that a
    key repeated very often reaches the state partition of its key a few times
    only. It keeps the state twice; leave it off where repeats are rare.
    """
    timed = stream.withColumn("_event_time", F.col(time).cast("timestamp")).withWatermark("_event_time", delay)
    if spread:
        timed = timed.withColumn("_task", F.spark_partition_id()).dropDuplicatesWithinWatermark([key, "_task"]).drop("_task")
    return timed.dropDuplicatesWithinWatermark([key]).drop("_event_time")


def score(stream: DataFrame, profile: DataFrame) -> DataFrame:
    """Event rows scored against the stored baseline (stream-static join).

    ``profile`` is the table written by ``baseline``. A running query keeps the
    files it began with; use ``score_latest`` where a batch job refreshes them.
    """
    return scored(transactions_of(stream), profile)


def score_latest(path: str, apply: Callable[[DataFrame, int], None]) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that scores each micro-batch against the
    baseline then lying at ``path`` and hands it to ``apply``; a baseline that is
    written anew holds from the next batch on."""

    def scored_batch(batch: DataFrame, batch_id: int) -> None:
        apply(scored(transactions_of(batch), batch.sparkSession.read.parquet(path)), batch_id)

    return scored_batch


def daily_anomalies(scored_stream: DataFrame, delay: str = "1 hour") -> DataFrame:
    """Transactions and flags per day and type, emitted when the day is closed
    (its end lies ``delay`` behind the latest event). For rows in rough time
    order: later rows are dropped; ``ledgers.DailyLedger`` counts them too."""
    timed = scored_stream.withColumn("_event_time", utc_instant(F.col("ts")))
    return (
        timed.withWatermark("_event_time", delay)
        .groupBy(F.window("_event_time", "1 day").alias("w"), "transaction_type")
        .agg(F.count("*").alias("total_txns"), count_if(F.col("is_anomaly")).alias("anomaly_count"))
        .select(
            F.date_sub(utc_date(F.col("w.start")), EVENT_SHIFT_DAYS).alias("full_date"),
            "transaction_type",
            "total_txns",
            "anomaly_count",
        )
    )


def run_to_files(stream: DataFrame, path: str, checkpoint: str, **options: str) -> DataFrame:
    """Process everything available, append to parquet files exactly once, and
    return the table written. A rerun goes on from the checkpoint. ``options`` of the files."""
    query = (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .options(**options)
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(path)
