from __future__ import annotations

import datetime as dt
import os
import time
from decimal import Decimal
from random import Random
from types import SimpleNamespace

import pyarrow as pa
import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from lendscope.plans import kpi, monitor
from lendscope.sources import bridge
from lendscope.sources.bridge import AS_OF, bridge_star
from lendscope.streaming import jobs, keyed
from lendscope.streaming.alerts import AlertLedger
from lendscope.sources.workspace import stored
from lendscope.streaming.ledgers import CYCLE, DailyLedger

HEADER = "customer_id,first_name,last_name,date_of_birth,gender,email,phone,employment_status,annual_income,credit_score,city,state,country\n"


def put(frame, folder: str, name: str) -> None:
    """One parquet file with a growing time stamp, so that streams keep order."""
    frame.coalesce(1).write.mode("overwrite").parquet(f"{folder}/_tmp_{name}")
    (part,) = [f for f in os.listdir(f"{folder}/_tmp_{name}") if f.startswith("part-")]
    os.makedirs(f"{folder}/in", exist_ok=True)
    target = f"{folder}/in/{name}.parquet"
    os.link(f"{folder}/_tmp_{name}/{part}", target)
    at = time.time() - 10_000 + 10 * len(os.listdir(f"{folder}/in"))
    os.utime(target, (at, at))


@pytest.fixture
def folder(tmp_path):
    return str(tmp_path)


def in_slices(spark, small, folder, n=4):
    """Events cut by day into ``n`` files in time order."""
    events = bridge.table(spark, small, "events")
    day = F.day("ts")
    for i in range(n):
        put(events.filter(F.floor((day - 1) * n / 30) == i), folder, f"f{i}")
    return events


def profile_of(spark, small, folder):
    stats = bridge.customer_stats(bridge.table(spark, small, "events"))
    profile = bridge.baseline(stats, bridge.customer(spark, small))
    profile.write.parquet(f"{folder}/baseline")
    return spark.read.parquet(f"{folder}/baseline")


def test_daily_counts_in_batches_equal_batch_on_closed_days(spark, small, folder):
    in_slices(spark, small, folder)
    stream = jobs.event_stream(spark, f"{folder}/in", max_files=1)
    table = jobs.run_to_files(
        jobs.daily_anomalies(jobs.score(stream, profile_of(spark, small, folder))), f"{folder}/out", f"{folder}/cp"
    )
    batch = (
        bridge_star(spark, small)
        .txn.groupBy(F.col("txn_date").alias("full_date"), "transaction_type")
        .agg(F.count("*").alias("total_txns"), F.sum(F.col("is_anomaly").cast("bigint")).alias("anomaly_count"))
        .filter(F.col("full_date") < dt.date(2001, 7, 30))
    )
    assert sorted(map(tuple, table.collect())) == sorted(map(tuple, batch.collect())) != []


def test_late_rows_are_kept_apart_and_counted(spark, small, folder):
    events = in_slices(spark, small, folder)
    first = events.filter(F.day("ts") == 1)
    put(first.limit(20), folder, "late")
    ledger = DailyLedger(spark, f"{folder}/ledger")
    stream = jobs.event_stream(spark, f"{folder}/in", max_files=1)
    ledger.follow(jobs.score(stream, profile_of(spark, small, folder)), f"{folder}/cp")
    day = ledger.daily().filter("full_date = DATE '2001-07-01'").agg(F.sum("total_txns"), F.sum("late_txns")).first()
    assert tuple(day) == (first.count() + 20, 20) and ledger.late().count() == 20


def test_a_repeated_batch_counts_once(spark, small, folder):
    rows = bridge_star(spark, small).txn.withColumn("ts", F.col("txn_date").cast("timestamp_ntz"))
    ledger = DailyLedger(spark, f"{folder}/ledger")
    for batch in (0, 1, 1):
        ledger.apply(rows, batch)
    assert ledger.daily().agg(F.sum("total_txns")).first()[0] == 2 * rows.count()


def test_a_new_baseline_holds_from_the_next_batch_on(spark, small, folder):
    profile = profile_of(spark, small, folder)
    events, seen = bridge.table(spark, small, "events"), []
    apply = jobs.score_latest(f"{folder}/baseline", lambda batch, _: seen.append(batch.filter("z_score > 0").count()))
    apply(events, 0)
    blank = profile.withColumns({"avg_amount": F.lit(0.0), "sd_amount": F.lit(None).cast("double")}).collect()
    spark.createDataFrame(blank, profile.schema).write.mode("overwrite").parquet(f"{folder}/baseline")
    apply(events, 1)
    assert seen[0] > 0 and seen[1] == 0


@pytest.mark.parametrize("spread", [False, True])
def test_repeats_by_keyed_state_do_not_depend_on_batches(spark, folder, spread):
    rows = [("a", "2001-01-01"), ("a", "2001-01-05"), ("a", "2001-01-09"), (None, "2001-01-09"), (None, "2001-01-09"), ("b", "2001-01-10"), ("b", "2001-01-10"), ("a", "2001-03-01"), ("b", "2001-03-11"), ("c", None), ("c", None)]
    frame = spark.createDataFrame([(k, dt.date.fromisoformat(d) if d else None, n) for n, (k, d) in enumerate(rows)], "k string, day date, n int")
    for n in range(len(rows)):
        put(frame.filter(F.col("n") == n), folder, f"f{n:02}")
    got = {}
    for files in (1, 3, 100):
        stream = jobs.file_stream(spark, f"{folder}/in", frame.schema, max_files=files)
        with keyed.state_settings(spark):
            kept = keyed.first_per_key(stream, "k", "day", 7, spread=spread)
            table = jobs.run_to_files(kept, f"{folder}/out{files}", f"{folder}/cp{files}")
        assert table.columns == ["k", "day", "n"]
        got[files] = sorted((r.k or "", str(r.day), r.n) for r in table.collect())
    first_c = [r for r in got[100] if r[0] == "c"]
    assert len(first_c) == 1
    for found in got.values():
        assert [r[:2] for r in found] == [("", "2001-01-09")] * 2 + [("a", "2001-01-01"), ("a", "2001-01-09"), ("a", "2001-03-01"), ("b", "2001-01-10"), ("b", "2001-03-11"), ("c", "None")]


def test_keyed_state_is_freed_and_survives_a_restart(spark, folder):
    frame = spark.createDataFrame([("a", dt.date(2001, 1, 1), 1)], "k string, day date, n int")
    settings = spark.conf.get(keyed.PROVIDER, None)
    for keep, want in ((dt.timedelta(days=1), 1), (dt.timedelta(milliseconds=1), 2)):
        root = f"{folder}/{want}"
        for n in range(2):
            put(frame, root, f"f{n}")
            with keyed.state_settings(spark):
                kept = keyed.first_per_key(jobs.file_stream(spark, f"{root}/in", frame.schema), "k", "day", 7, keep)
                table = jobs.run_to_files(kept, f"{root}/out", f"{root}/cp")
            time.sleep(0.1)
        assert table.count() == want
    assert spark.conf.get(keyed.PROVIDER, None) == settings


def test_keyed_state_is_asked_once_for_a_bucket_of_keys():
    class Kept:
        def __init__(self):
            self.values, self.calls = [], 0

        def get(self):
            self.calls += 1
            return iter(self.values)

        def appendValue(self, value):
            self.calls += 1
            self.values.append(value)

    judge, state = keyed._FirstOfDays(7, dt.timedelta(days=1)), Kept()
    judge.kept = state
    row = lambda k, day, order: Row(_key=f"k{k}", _day=day, _order=order, _row=(k, order))
    first = list(judge.handleInputRows((0,), iter([row(k, 10, o) for k in range(500) for o in ("b", "a", "c")]), None))
    again = list(judge.handleInputRows((0,), iter([row(k, day, "d") for k in range(500) for day in (18, 17, 40)]), None))
    assert sorted(r["_row"] for r in first) == [(k, "a") for k in range(500)]
    assert sorted(r["_row"] for r in again) == sorted((k, "d") for k in range(500) for _ in range(2))
    assert state.calls == 4


@pytest.mark.parametrize("kind, keys", [("binary", [b"a", b"a", b"b"]), ("double", [0.0, -0.0, float("nan")]), ("timestamp", [dt.datetime(2001, 1, 1, 0, 0, 0, 1)] * 2 + [dt.datetime(2001, 1, 1, 0, 0, 0, 2)]), ("struct<x:int,y:string>", [(1, None), (1, None), (None, "1")]), ("decimal(9,2)", [Decimal("1.50"), Decimal("1.5"), Decimal("1.51")])])
def test_keys_of_any_type_are_held_apart(spark, folder, kind, keys):
    frame = spark.createDataFrame([(k, dt.date(2001, 1, 1), n) for n, k in enumerate(keys)], f"k {kind}, day date, n int")
    for n in range(len(keys)):
        put(frame.filter(F.col("n") == n), folder, f"f{n}")
    for files in (1, 9):
        with keyed.state_settings(spark):
            kept = keyed.first_per_key(jobs.file_stream(spark, f"{folder}/in", frame.schema, max_files=files), "k", "day", 7, buckets=2)
            table = jobs.run_to_files(kept, f"{folder}/out{files}", f"{folder}/cp{files}")
        assert table.schema["k"] == frame.schema["k"]
        assert table.filter("n < 2").count() == 1 and table.filter("n = 2").count() == 1


def shuffle_files(spark) -> set[str]:
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {f.getName() for f in (files.apply(k) for k in range(files.size())) if f.getName().startswith("shuffle_")}


def test_rows_that_key_and_day_tell_move_in_few_bytes(spark, folder):
    """Keys of some 19 bytes: each row moves in less, and its shuffle files go with its batch."""
    day = F.date_add(F.lit("1992-01-01"), (F.col("id") * 7919 % 2500).cast("int"))
    frame = spark.range(60_000).select(F.concat_ws("-", F.col("id") * 104_729 % 900_001, F.col("id") % 6, day).alias("k"), day.alias("day"))
    for n in range(2):
        put(frame, folder, f"f{n}")
    stream = jobs.file_stream(spark, f"{folder}/in", frame.schema, max_files=1)
    before = shuffle_files(spark)
    with keyed.state_settings(spark):
        kept = keyed.first_per_key(stream, "k", "day", 7, buckets=64)
        assert "sha2" not in str(kept._jdf.queryExecution().analyzed())
        table = jobs.run_to_files(kept, f"{folder}/out", f"{folder}/cp")
    assert sorted(table.collect()) == sorted(frame.collect())
    state = sum(os.path.getsize(f"{d}/{f}") for d, _, names in os.walk(f"{folder}/cp/state") for f in names)
    assert state < 14 * 60_000
    for _ in range(50):
        if shuffle_files(spark) <= before:
            break
        time.sleep(0.1)
    assert shuffle_files(spark) <= before


def test_blocks_give_their_rows_back():
    days = [keyed.NO_DAY, 9000, 9000, -5, 9100]
    plain = pa.table({"_key": ["", "a", "a", "b\u00e9", "a"], "_day": pa.array(days, pa.int32())})
    wide = plain.append_column("_order", pa.array([b"1", b"", b"3", b"4", b"5"])).append_column("_row", pa.array([{"x": n, "y": [None, n]} for n in range(5)]))
    for rows in (plain, wide):
        for starts in ([0, 5], [0, 2, 5], [0, 1, 2, 3, 4, 5]):
            blocks = list(keyed._blocks(rows, starts))
            assert len(blocks) == len(starts) - 1
            assert pa.concat_tables([keyed._read(b) for b in blocks]).to_pylist() == rows.to_pylist()


@pytest.mark.parametrize("blocks", [1, 3])
def test_blocks_of_a_bucket_are_judged_as_its_rows(monkeypatch, blocks):
    """Against a loop over the rows, with blocks folded as they come."""
    monkeypatch.setattr(keyed, "BLOCK_ROWS", 50)
    random = Random(blocks)
    rows = [(f"k{random.randrange(9)}", random.choice([keyed.NO_DAY, *range(9000, 9060)]), random.randrange(999)) for _ in range(400)]
    kept, want = {}, []
    for key, day, n in sorted(rows, key=lambda r: (r[1], r[2])):
        if all(abs(day - other) > 7 for other in kept.setdefault(key, [])):
            kept[key].append(day)
            want.append((key, day, n))
    table = pa.table({"_key": [r[0] for r in rows], "_day": pa.array([r[1] for r in rows], pa.int32()), "_order": [b"%03d" % r[2] for r in rows], "_row": [{"n": r[2]} for r in rows]})
    judge = keyed._FirstOfBlocks(7, dt.timedelta(days=1))
    judge.kept = SimpleNamespace(get=lambda: iter(()), appendValue=lambda value: None)
    parts = [Row(_block=b) for b in keyed._blocks(table, [400 * k // blocks for k in range(blocks + 1)])]
    out = [keyed._read(r["_block"]).to_pylist() for r in judge.handleInputRows((0,), iter(parts), None)]
    assert sorted((r["_key"], r["_day"], r["_row"]["n"]) for part in out for r in part) == sorted(want)


def scored_rows(spark, small):
    return bridge_star(spark, small).txn.select("transaction_type", "is_anomaly", "txn_date", F.col("txn_date").cast("timestamp_ntz").alias("ts")).limit(500)


def test_two_checkpoints_add_up_in_one_ledger(spark, small, folder):
    rows = stored(scored_rows(spark, small), "rows")
    put(rows, folder, "a")
    for run in ("one", "two"):
        ledger = DailyLedger(spark, f"{folder}/ledger")
        ledger.follow(jobs.file_stream(spark, f"{folder}/in", rows.schema), f"{folder}/cp-{run}")
        ledger.follow(jobs.file_stream(spark, f"{folder}/in", rows.schema), f"{folder}/cp-{run}")
    assert ledger.daily().agg(F.sum("total_txns")).first()[0] == 2 * rows.count()
    assert ledger._states().select("run").distinct().count() == 2


def test_files_of_the_ledger_stay_bounded(spark, folder):
    day = "timestamp_ntz'2001-07-01 00:00:00' + make_interval(0, 0, 0, id)"
    newest = stored(spark.range(60).selectExpr("'SALE' AS transaction_type", "id % 2 = 0 AS is_anomaly", f"cast({day} as date) AS txn_date", f"{day} AS ts", "id"), "rows")
    ledger, batches = DailyLedger(spark, f"{folder}/ledger"), 2 * CYCLE + 3
    for b in range(batches):
        # the second row of each batch is two days behind the first batch's
        own = newest.filter(F.col("id") == 10 + b % 40).unionByName(newest.filter("id = 1")) if b else newest.filter("id = 59")
        ledger.apply(own.drop("id"), b)
        if b in (5, CYCLE, CYCLE + 1):
            ledger.apply(own.drop("id"), b)
    sums = ledger.daily().agg(F.sum("total_txns"), F.sum("late_txns")).first()
    assert tuple(sums) == (1 + 2 * (batches - 1), 2 * (batches - 1))
    assert ledger.late().count() == 2 * (batches - 1) and ledger.late().select("batch").distinct().count() == batches - 1
    files = [f for _, _, names in os.walk(f"{folder}/ledger") for f in names if f.endswith(".parquet")]
    assert len([f for _, _, names in os.walk(f"{folder}/ledger/state") for f in names if f.endswith(".parquet")]) == 2
    assert len(files) <= 2 + 2 * CYCLE + batches // CYCLE


def test_an_unfinished_batch_counts_for_nothing(spark, folder):
    rows = spark.range(4).selectExpr("'SALE' AS transaction_type", "true AS is_anomaly", "DATE '2001-07-01' AS txn_date", "timestamp_ntz'2001-07-01 10:00:00' AS ts")
    old = rows.withColumn("ts", F.expr("timestamp_ntz'2001-06-01 10:00:00'"))
    ledger = DailyLedger(spark, f"{folder}/ledger")
    ledger.apply(rows, 0)
    ledger.apply(old, 1)
    # the late rows of a third batch are written, its state is not
    shown = ledger.late().count()
    old.withColumns({"is_late": F.lit(True), "batch": F.lit(2).cast("long")}).write.parquet(f"{folder}/ledger/late/fresh/run=0/slot=2")
    assert ledger.late().count() == shown == 4
    ledger.apply(old, 2)
    assert ledger.late().count() == 8 and ledger.daily().agg(F.sum("total_txns")).first()[0] == 12


def test_restart_goes_on_without_repeats(spark, small, folder):
    events = in_slices(spark, small, folder)
    profile = profile_of(spark, small, folder)

    def run():
        stream = jobs.event_stream(spark, f"{folder}/in", max_files=2)
        return jobs.run_to_files(
            jobs.score(stream, profile).select("transaction_id", "is_anomaly"), f"{folder}/out", f"{folder}/cp"
        )

    assert run().count() == events.count()
    assert run().count() == events.count()
    put(events.limit(5), folder, "more")
    assert run().count() == events.count() + 5


def test_dedup_over_batches(spark, small, folder):
    events = bridge.table(spark, small, "events")
    first = events.filter(F.day("ts") <= 2)
    for name in ("a", "b"):
        put(first, folder, name)
    put(events.filter(F.day("ts") == 3), folder, "c")
    stream = jobs.event_stream(spark, f"{folder}/in", max_files=1)
    table = jobs.run_to_files(jobs.dedup(stream, "event_id", "ts", "5 days"), f"{folder}/out", f"{folder}/cp")
    assert table.count() == table.select("event_id").distinct().count() == events.filter(F.day("ts") <= 3).count()


def test_scored_stream_equals_batch(spark, small, folder):
    in_slices(spark, small, folder)
    columns = ["transaction_id", "is_anomaly", "anomaly_score", "anomaly_reason"]
    stream = jobs.event_stream(spark, f"{folder}/in", max_files=1)
    table = jobs.run_to_files(
        jobs.score(stream, profile_of(spark, small, folder)).select(*columns), f"{folder}/out", f"{folder}/cp"
    )
    batch = bridge_star(spark, small).txn.select(*columns)
    assert sorted(map(str, table.collect())) == sorted(map(str, batch.collect()))


def test_csv_landing_stream(spark, folder):
    os.makedirs(f"{folder}/csv")
    for i in range(2):
        with open(f"{folder}/csv/{i}.csv", "w") as f:
            f.write(HEADER + f' C{i} ,ann,"lee, jr",,"",e,p,s,"$1,000",700,c,s,k\n')
    stream = jobs.staging_stream(spark, f"{folder}/csv", "raw_customers", max_files=1)
    table = jobs.run_to_files(stream, f"{folder}/out", f"{folder}/cp")
    got = sorted(table.select("customer_id", "last_name", "date_of_birth", "gender", "annual_income").collect())
    # an unquoted empty field is NULL, a quoted one is empty
    assert [tuple(r) for r in got] == [(f" C{i} ", "lee, jr", None, "", "$1,000") for i in range(2)]
    assert table.filter("_source_file IS NULL OR _ingested_at IS NULL").count() == 0


LIMITS = monitor.with_limit("anomaly_count_yesterday", 0)


def history_slices(spark, small, folder, cuts):
    history = kpi.kpi_history(bridge_star(spark, small), dt.date(2001, 7, 2), AS_OF)
    for i, (a, b) in enumerate(zip(cuts, cuts[1:])):
        put(history.filter(F.day("snapshot_ts").between(a, b - 1)), folder, f"h{i}")
    return history


def test_alert_ledger_equals_batch(spark, small, folder):
    history = history_slices(spark, small, folder, [2, 5, 6, 14, 32])
    ledger = AlertLedger(spark, f"{folder}/ledger", LIMITS)
    ledger.follow(jobs.file_stream(spark, f"{folder}/in", history.schema, max_files=1), f"{folder}/cp")
    want = monitor.alert_lifecycle(history, LIMITS)
    assert want.count() > 3
    assert list(map(tuple, ledger.alerts().collect())) == list(map(tuple, want.collect()))
    assert ledger.history().count() == history.count()


def test_repeated_micro_batch_adds_nothing(spark, small, folder):
    history = kpi.kpi_history(bridge_star(spark, small), dt.date(2001, 7, 2), AS_OF)
    ledger = AlertLedger(spark, f"{folder}/ledger", LIMITS)
    early, late = history.filter("day(snapshot_ts) < 12"), history.filter("day(snapshot_ts) >= 12")
    ledger.apply(early, 0)
    ledger.apply(late, 1)
    once = sorted(map(str, ledger.events().collect()))
    ledger.apply(late, 1)
    assert sorted(map(str, ledger.events().collect())) == once
    # older polls are kept and the life cycle is judged anew, to the same end
    ledger.apply(early, 2)
    assert sorted(map(str, ledger.events().collect())) == once
    assert ledger.late().filter("batch = 2").count() == 4 * early.count()


def test_late_polls_change_the_life_cycle(spark, small, folder):
    history = kpi.kpi_history(bridge_star(spark, small), dt.date(2001, 7, 2), AS_OF)
    ledger = AlertLedger(spark, f"{folder}/ledger", LIMITS)
    ledger.apply(history.filter("day(snapshot_ts) <> 10"), 0)
    ledger.apply(history.filter("day(snapshot_ts) = 10"), 1)
    want = monitor.alert_lifecycle(history, LIMITS)
    assert list(map(tuple, ledger.alerts().collect())) == list(map(tuple, want.collect()))


def test_a_new_checkpoint_goes_on_behind_the_old_one(spark, small, folder):
    history = history_slices(spark, small, folder, [2, 14])
    rest = kpi.kpi_history(bridge_star(spark, small), dt.date(2001, 7, 14), AS_OF)
    ledger = AlertLedger(spark, f"{folder}/ledger", LIMITS)
    ledger.follow(jobs.file_stream(spark, f"{folder}/in", history.schema), f"{folder}/cp1")
    rest.write.parquet(f"{folder}/more")
    ledger.follow(jobs.file_stream(spark, f"{folder}/more", history.schema), f"{folder}/cp2")
    whole = kpi.kpi_history(bridge_star(spark, small), dt.date(2001, 7, 2), AS_OF)
    assert list(map(tuple, ledger.alerts().collect())) == list(map(tuple, monitor.alert_lifecycle(whole, LIMITS).collect()))


def test_a_late_poll_replays_its_indicator_only(spark, small, folder):
    """From the last state before it; the events of the others are those written before."""
    history = stored(kpi.kpi_history(bridge_star(spark, small), dt.date(2001, 7, 2), AS_OF), "polls")
    one = LIMITS[:1]
    ledger = AlertLedger(spark, f"{folder}/ledger", LIMITS)
    for b, (a, z) in enumerate([(2, 8), (8, 16), (16, 24), (24, 32)]):
        ledger.apply(history.filter(F.day("snapshot_ts").between(a, z - 1) & (F.day("snapshot_ts") != 18)), b)
    before = {(r.kpi, r.seq) for r in ledger._read("events", ledger._marks()).collect()}
    name = one[0].kpi
    ledger.thresholds = one  # the late poll has this indicator only
    ledger.apply(history.filter(F.day("snapshot_ts") == 18), 4)
    assert [(r.kpi, str(r.after)) for r in ledger._read("replays", ledger._marks()).collect()] == [(name, "2001-07-15")]
    after = {(r.kpi, r.seq) for r in ledger._read("events", ledger._marks()).filter("seq = 4").collect()}
    assert {k for k, _ in after} <= {name} and before <= {(r.kpi, r.seq) for r in ledger._read("events", ledger._marks()).collect()}
    want = {tuple(r) for r in monitor.alert_lifecycle(history, LIMITS).filter(F.col("kpi") == name).collect()}
    assert {tuple(r) for r in ledger.alerts().filter(F.col("kpi") == name).collect()} == want
    rest = history.filter(F.day("snapshot_ts") != 18)
    want = {tuple(r) for r in monitor.alert_lifecycle(rest, LIMITS).filter(F.col("kpi") != name).collect()}
    assert {tuple(r) for r in ledger.alerts().filter(F.col("kpi") != name).collect()} == want


def test_the_alert_history_is_merged(spark, small, folder, monkeypatch):
    from lendscope.streaming import ledgers

    monkeypatch.setattr(ledgers, "CYCLE", 3)
    history = stored(kpi.kpi_history(bridge_star(spark, small), dt.date(2001, 7, 2), AS_OF), "polls")
    ledger = AlertLedger(spark, f"{folder}/ledger", LIMITS)
    days = [d for d in range(2, 15) if d != 6] + [6]
    for b, day in enumerate(days):
        ledger.apply(history.filter(F.day("snapshot_ts") == day), b)
        if b in (3, 12):
            ledger.apply(history.filter(F.day("snapshot_ts") == day), b)
    want = monitor.alert_lifecycle(history.filter(F.day("snapshot_ts") < 15), LIMITS)
    assert list(map(tuple, ledger.alerts().collect())) == list(map(tuple, want.collect()))
    assert ledger.history().count() == 13
    folders = os.listdir(f"{folder}/ledger/history/fresh/run=0")
    assert len([f for f in folders if f.startswith("slot=")]) == 6 and len(os.listdir(f"{folder}/ledger/history/merged/run=0")) == 4
