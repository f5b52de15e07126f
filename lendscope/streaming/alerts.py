"""The alert loop as a stream of indicator rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lendscope.operators.dedup import newest_per_key
from lendscope.plans.monitor import THRESHOLDS, Threshold, alerts, evaluate, with_events
from lendscope.streaming.ledgers import BatchFolders, cycle_of, follow, read_or_none, run_of

MARKS = "batch long, seq long, run string, slot int"
PARTS = ("history", "checks", "events", "state", "late", "replays")


class AlertLedger:
    """Tables below ``root``: ``history`` (indicator rows), ``checks`` (each indicator of a poll against its
    threshold), ``events`` (fire, suppress, resolve), ``state`` (the last poll per indicator after each batch),
    ``late`` and ``replays``.

    Rows lie in ``BatchFolders``, so a repeated batch replaces its own, files stay bounded, and a new
    checkpoint over an old ledger goes on behind it. A batch counts once its mark is written, which is the
    last file it writes. It reads the newest state, a row per indicator, and not the history.

    A poll older than the state is late. Then its indicators, and no others, are judged anew from
    the last state before it: their later checks are read again, and the events they gave are replaced. Of
    several polls of one time the last delivered one counts.
    """

    def __init__(self, spark: SparkSession, root: str, thresholds: tuple[Threshold, ...] = THRESHOLDS, run: str = "0"):
        self.spark, self.root, self.thresholds, self.run = spark, root.rstrip("/"), thresholds, run
        self._parts = {part: BatchFolders(spark, f"{self.root}/{part}") for part in PARTS}

    def _marks(self, before: int | None = None) -> dict[str, tuple[int, int]]:
        """Last batch and its number over all runs, by run; of this one the last before a batch."""
        marks = read_or_none(self.spark, f"{self.root}/marks", MARKS)
        if marks is None:
            return {}
        if before is not None:
            marks = marks.filter((F.col("run") != self.run) | (F.col("batch") < before))
        rows = marks.groupBy("run").agg(F.max(F.struct("batch", "seq")).alias("m")).collect()  # a row per checkpoint
        return {r.run: (r.m.batch, r.m.seq) for r in rows}

    def _read(self, part: str, marks: dict[str, tuple[int, int]]) -> DataFrame | None:
        return self._parts[part].read({run: batch for run, (batch, _) in marks.items()})

    def _write(self, frame: DataFrame, part: str, batch_id: int) -> None:
        self._parts[part].write(frame, self.run, batch_id, *self._by(part))

    def _by(self, part: str) -> tuple[str, ...]:
        return ("kpi",) if part == "checks" else ()

    def apply(self, batch: DataFrame, batch_id: int) -> None:
        marks = self._marks(before=batch_id)
        if self.run in marks and cycle_of(marks[self.run][0]) < cycle_of(batch_id):
            for part in PARTS:
                self._parts[part].merge(self.run, cycle_of(marks[self.run][0]), *self._by(part))
        seq = max((seq for _, seq in marks.values()), default=-1) + 1
        rows = evaluate(batch, self.thresholds)
        self._write(batch.withColumn("seq", F.lit(seq).cast("long")), "history", batch_id)
        self._write(rows.withColumn("seq", F.lit(seq).cast("long")), "checks", batch_id)
        columns = rows.columns
        base = self._state(marks)
        late, first = None, {}
        if base is not None:
            last = F.broadcast(base.select("kpi", F.col("as_of").alias("_last")))  # a row per indicator
            late = rows.join(last, "kpi").filter(F.col("as_of") < F.col("_last")).drop("_last")
            first = {r.kpi: r.day for r in late.groupBy("kpi").agg(F.min("as_of").alias("day")).collect()}
        if first:
            self._write(late, "late", batch_id)
            base, rows = self._before(first, base, rows, marks, batch_id)
        line = rows if base is None else base.select(*columns).unionByName(rows.select(*columns))
        if base is None:
            line = line.withColumns({"_last": F.lit(None).cast("date"), "_base": F.lit(0)})
        else:
            fired = F.col("alert_no") - F.col("breached").cast("int")
            line = line.join(F.broadcast(base.select("kpi", F.col("as_of").alias("_last"), fired.alias("_base"))), "kpi", "left")
        numbered = with_events(line).withColumn("alert_no", F.col("alert_no") + F.coalesce("_base", F.lit(0)))
        fresh = numbered.filter(F.col("event").isNotNull() & (F.col("_last").isNull() | (F.col("as_of") > F.col("_last"))))
        mark = F.lit(seq).cast("long").alias("seq")
        self._write(fresh.drop("_last", "_base").select("*", mark), "events", batch_id)
        self._write(newest_per_key(numbered.drop("_last", "_base", "event"), ["kpi"], ["as_of"]).select("*", mark), "state", batch_id)
        self.spark.range(1).select(F.lit(batch_id).cast("long").alias("batch"), mark).coalesce(1).write.mode("overwrite").parquet(
            f"{self.root}/marks/run={self.run}/slot={batch_id % 2}"
        )

    def _state(self, marks: dict[str, tuple[int, int]]) -> DataFrame | None:
        """The newest state, a row per indicator."""
        states = self._read("state", marks)
        newest = max((seq for _, seq in marks.values()), default=None)
        return None if states is None or newest is None else states.filter(F.col("seq") == newest).drop("run", "batch", "seq")

    def _before(self, first: dict, base: DataFrame, rows: DataFrame, marks: dict[str, tuple[int, int]], batch_id: int) -> tuple[DataFrame, DataFrame]:
        """State and checks to go on from: of the indicators of ``first`` the last state before that day and all
        checks after it, of the others the newest state and the batch."""
        kpis = sorted(first)
        earlier = reduce(lambda a, b: a | b, [(F.col("kpi") == k) & (F.col("as_of") < F.lit(day)) for k, day in first.items()])
        states = self._read("state", marks).filter(earlier)
        found = newest_per_key(states, ["kpi"], ["as_of", "seq"]).select(*base.columns)
        start = {r.kpi: r.as_of for r in found.select("kpi", "as_of").collect()}
        seq = max(seq for _, seq in marks.values()) + 1
        replays = [(k, start.get(k), seq) for k in kpis]
        self._write(self.spark.createDataFrame(replays, "kpi string, after date, seq long"), "replays", batch_id)
        wanted = reduce(lambda a, b: a | b, [(F.col("kpi") == k) & ((F.col("as_of") > F.lit(start[k])) if k in start else F.lit(True)) for k in kpis])
        checks = self._read("checks", {**marks, self.run: (batch_id, seq)}).filter(wanted)
        again = newest_per_key(checks, ["kpi", "as_of"], ["seq"]).select(*rows.columns)
        others = ~F.col("kpi").isin(kpis)
        return base.filter(others).unionByName(found), rows.filter(others).unionByName(again)

    def history(self) -> DataFrame:
        """The polls; of several of one time the last delivered one."""
        polls = self._read("history", self._marks()).drop("run", "batch")
        return newest_per_key(polls, ["snapshot_ts"], ["seq"]).drop("seq")

    def late(self) -> DataFrame | None:
        return self._read("late", self._marks())

    def events(self) -> DataFrame:
        """All events but those that a replay of their indicator replaced."""
        marks = self._marks()
        rows = self._read("events", marks).drop("run", "batch")
        replays = self._read("replays", marks)
        if replays is not None:
            gone = F.broadcast(replays.select(F.col("kpi").alias("_kpi"), "after", F.col("seq").alias("_seq")))  # a row per late batch and indicator
            replaced = (F.col("kpi") == F.col("_kpi")) & (F.col("seq") < F.col("_seq")) & (F.col("after").isNull() | (F.col("as_of") > F.col("after")))
            rows = rows.join(gone, replaced, "left_anti")
        return rows.drop("seq")

    def alerts(self) -> DataFrame:
        return alerts(self.events())

    def follow(self, snapshots: DataFrame, checkpoint: str) -> None:
        """Process all available indicator rows of a stream."""

        def apply(batch: DataFrame, batch_id: int) -> None:
            self.run = run_of(self.spark, checkpoint)
            self.apply(batch, batch_id)

        follow(snapshots, apply, checkpoint)
