"""Daily figures and baselines from a stream whose rows come in any order, without losing the late ones.

The ledgers process micro-batches with ``foreachBatch`` and keep their state as tables
on shared storage. Nothing is dropped behind a watermark: a late row is marked, kept
aside and still counted.
"""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Callable
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lendscope.functions.numbers import count_if
from lendscope.operators.moments import merged, moments, spread

SUMS = ("total_txns", "anomaly_count", "late_txns")
STATE = "full_date date, transaction_type string, total_txns long, anomaly_count long, late_txns long, event_time timestamp_ntz, batch long, run string, slot int"
#: Batches whose late rows lie in folders of their own before they are merged into one.
CYCLE = 16


def read_or_none(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame | None:
    """The table at ``path``, or None where nothing was written yet."""
    try:
        reader = spark.read if schema is None else spark.read.schema(schema)
        return reader.parquet(path)
    except AnalysisException as problem:
        if problem.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None


def run_of(spark: SparkSession, checkpoint: str) -> str:
    """The id that a stream keeps as long as its checkpoint: a new checkpoint is a new run, also at an old path."""
    return json.loads(spark.read.text(f"{checkpoint}/metadata").first()[0])["id"]


def follow(stream: DataFrame, apply: Callable[[DataFrame, int], None], checkpoint: str) -> None:
    """Process everything available, batch by batch."""
    writer = stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
    writer.trigger(availableNow=True).start().awaitTermination()


def cycle_of(batch: int) -> int:
    return batch // CYCLE


class BatchFolders:
    """Rows of micro-batches: a folder for each batch of a run, until the ``CYCLE`` batches of a closed cycle are
    merged into one. A repeated batch replaces its own folder and repeats the merge before it.

    Folders of open cycles are used again in turn, so readers name the last batch that counts of each run.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def write(self, frame: DataFrame, run: str, batch: int, *by: str) -> None:
        writer = frame.withColumn("batch", F.lit(batch).cast("long")).hint("rebalance", *by).write.mode("overwrite")
        (writer.partitionBy(*by) if by else writer).parquet(f"{self.path}/fresh/run={run}/slot={batch % (2 * CYCLE)}")

    def merge(self, run: str, cycle: int, *by: str) -> None:
        rows = read_or_none(self.spark, f"{self.path}/fresh")
        if rows is not None:
            own = rows.filter((F.col("run").cast("string") == run) & F.col("batch").between(cycle * CYCLE, (cycle + 1) * CYCLE - 1)).drop("run", "slot")
            if own.head(1):
                writer = own.hint("rebalance", *by).write.mode("overwrite")
                (writer.partitionBy(*by) if by else writer).parquet(f"{self.path}/merged/run={run}/cycle={cycle}")

    def read(self, last: dict[str, int]) -> DataFrame | None:
        """The rows of all batches up to the last ones, with run and batch; None where there is none."""
        parts = []
        for part in ("fresh", "merged"):
            rows = read_or_none(self.spark, f"{self.path}/{part}")
            if rows is not None:
                rows = rows.withColumn("run", F.col("run").cast("string")).drop("slot", "cycle")
                held = F.lit(False)
                for run, batch in last.items():
                    start = cycle_of(batch) * CYCLE
                    held = held | ((F.col("run") == run) & (F.col("batch").between(start, batch) if part == "fresh" else F.col("batch") < start))
                parts.append(rows.filter(held))
        return reduce(DataFrame.unionByName, parts) if parts else None


class DailyLedger:
    """Transactions and flags per day and type from scored rows in any order.

    Rows more than ``delay`` behind the latest event of earlier batches are late: they are
    counted with the others, and also apart, and kept in the folder ``late``.

    A run (a checkpoint) owns its folders, so a second stream over the same ledger adds to
    it. Its state is one small file, the sums of all its batches so far, written in turn
    to two slots; each batch reads that of the batch before. A repeated batch does
    so again and replaces its own. What a failed batch left counts for nothing, since readers go by
    the last state. Late rows lie in a folder per batch for ``CYCLE`` batches; the
    first batch after those merges them into one.
    """

    def __init__(self, spark: SparkSession, root: str, delay: dt.timedelta = dt.timedelta(hours=1), run: str = "0"):
        self.spark, self.root, self.delay, self.run = spark, root.rstrip("/"), delay, run
        self._late_rows = BatchFolders(spark, f"{self.root}/late")

    def apply(self, batch: DataFrame, batch_id: int) -> None:
        states = self._states(before=batch_id)
        mark = states.agg(F.max("event_time").alias("latest"), F.max(F.when(F.col("run") == self.run, F.col("batch"))).alias("last")).first()
        if mark.last is not None and cycle_of(mark.last) < cycle_of(batch_id):
            self._late_rows.merge(self.run, cycle_of(mark.last))
        is_late = F.lit(False) if mark.latest is None else F.coalesce(F.col("ts") < F.lit(mark.latest - self.delay).cast("timestamp_ntz"), F.lit(False))
        batch = batch.withColumn("is_late", is_late)
        late = batch.filter("is_late")
        if late.head(1):
            self._late_rows.write(late, self.run, batch_id)
        counts = batch.groupBy(F.col("txn_date").alias("full_date"), "transaction_type").agg(
            F.count("*").alias("total_txns"),
            count_if(F.col("is_anomaly")).alias("anomaly_count"),
            count_if(F.col("is_late")).alias("late_txns"),
            F.max("ts").cast("timestamp_ntz").alias("event_time"),
        )
        # one row says that there was a batch, also where it had no rows
        none = self.spark.createDataFrame([(None, None, 0, 0, 0, None)], STATE.partition(", batch")[0])
        own = states.filter(F.col("run") == self.run).select(*counts.columns)
        sums = [F.sum(c).alias(c) for c in SUMS]
        state = own.unionByName(counts).unionByName(none).groupBy("full_date", "transaction_type").agg(*sums, F.max("event_time").alias("event_time"))
        state = state.withColumn("batch", F.lit(batch_id).cast("long")).coalesce(1)
        state.write.mode("overwrite").parquet(f"{self.root}/state/run={self.run}/slot={batch_id % 2}")

    def _states(self, before: int | None = None) -> DataFrame:
        """The last state of every run; of this one the last before a batch."""
        states = read_or_none(self.spark, f"{self.root}/state", STATE)
        if states is None:
            return self.spark.createDataFrame([], STATE)
        if before is not None:
            states = states.filter((F.col("run") != self.run) | (F.col("batch") < before))
        last = F.broadcast(states.groupBy("run").agg(F.max("batch").alias("batch")))  # a row per checkpoint
        return states.join(last, ["run", "batch"])

    def daily(self) -> DataFrame:
        """A row per day and type: late rows are in ``total_txns`` as well."""
        return self._states().filter("total_txns > 0").groupBy("full_date", "transaction_type").agg(*[F.sum(c).alias(c) for c in SUMS])

    def late(self) -> DataFrame:
        """The late rows, with their run and batch."""
        last = {r.run: r.batch for r in self._states().select("run", "batch").distinct().collect()}
        rows = self._late_rows.read(last)
        if rows is None:
            raise ValueError(f"no row of {self.root} has been late")
        return rows

    def follow(self, scored: DataFrame, checkpoint: str) -> None:
        """Process all available rows of a stream, as the run of that checkpoint."""
        follow(scored, self.of(checkpoint), checkpoint)

    def of(self, checkpoint: str) -> Callable[[DataFrame, int], None]:
        """``apply`` for the stream of a checkpoint."""

        def apply(batch: DataFrame, batch_id: int) -> None:
            self.run = run_of(self.spark, checkpoint)
            self.apply(batch, batch_id)

        return apply


BASELINE = "customer_id string, rows long, n long, mean double, m2 double, low double, high double, batch long, run string, slot int"


class BaselineLedger:
    """The moments of the amounts per customer, kept up with a stream.

    A batch is summed up by itself and merged into the moments of the batch before; no old
    row is read. Runs and slots are those of ``DailyLedger``; a batch counts once its mark is
    written, which is the last file it writes.
    """

    def __init__(self, spark: SparkSession, root: str, run: str = "0"):
        self.spark, self.root, self.run = spark, root.rstrip("/"), run

    def apply(self, batch: DataFrame, batch_id: int) -> None:
        """``batch`` has customer_id and amount."""
        own = self._moments(before=batch_id).filter(F.col("run") == self.run)
        slot = f"run={self.run}/slot={batch_id % 2}"
        number = F.lit(batch_id).cast("long").alias("batch")
        both = merged(own, moments(batch, "customer_id", F.col("amount")), "customer_id")
        both.select("*", number).write.mode("overwrite").parquet(f"{self.root}/moments/{slot}")
        self.spark.range(1).select(number).coalesce(1).write.mode("overwrite").parquet(f"{self.root}/marks/{slot}")

    def _moments(self, before: int | None = None) -> DataFrame:
        marks = read_or_none(self.spark, f"{self.root}/marks", "batch long, run string, slot int")
        rows = read_or_none(self.spark, f"{self.root}/moments", BASELINE)
        if marks is None or rows is None:
            return self.spark.createDataFrame([], BASELINE)
        if before is not None:
            marks = marks.filter((F.col("run") != self.run) | (F.col("batch") < before))
        last = F.broadcast(marks.groupBy("run").agg(F.max("batch").alias("batch")))  # a row per checkpoint
        return rows.join(last, ["run", "batch"])

    def baseline(self) -> DataFrame:
        """(customer_id, avg_amount, sd_amount, n_txn) of all runs. One after the other: a run is a checkpoint, so they are few."""
        rows = self._moments()
        runs = sorted(r.run for r in rows.select("run").distinct().collect())
        parts = [rows.filter(F.col("run") == run) for run in runs] or [rows]
        whole = reduce(lambda a, b: merged(a, b, "customer_id"), parts)
        return whole.select("customer_id", F.col("mean").alias("avg_amount"), spread().alias("sd_amount"), F.col("rows").alias("n_txn"))

    def follow(self, stream: DataFrame, checkpoint: str) -> None:
        """Process all available rows of a stream, as the run of that checkpoint."""

        def apply(batch: DataFrame, batch_id: int) -> None:
            self.run = run_of(self.spark, checkpoint)
            self.apply(batch, batch_id)

        follow(stream, apply, checkpoint)
