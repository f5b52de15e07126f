"""What moves and is written where tables grow: as few passes over whole rows as the work needs."""

from __future__ import annotations

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from lendscope import queries_etl
from lendscope.operators import dedup, upsert
from lendscope.operators.dedup import chosen_per_key
from lendscope.operators.keys import assign_keys
from lendscope.operators.upsert import new_rows, upsert_folders
from lendscope.plans import etl
from lendscope.plans.load import Load
from lendscope.sources.schemas import WAREHOUSE
from lendscope.sources.store import TableStore
from lendscope.sources.workspace import fresh_path, shared_dir, stored


def plan(frame) -> str:
    return str(frame._jdf.queryExecution().optimizedPlan())


def folders(spark) -> set[str]:
    root = f"{shared_dir(spark)}/lendscope".removeprefix("file://")
    return set(os.listdir(root)) if os.path.isdir(root) else set()


@pytest.mark.parametrize("limit", [None, -1])
@pytest.mark.parametrize("latest", [True, False])
def test_only_repeated_keys_are_ranked(spark, monkeypatch, limit, latest):
    if limit is not None:
        monkeypatch.setattr(dedup, "BROADCAST_BYTES", limit)
    rows = [("a", 1, "x"), ("a", 2, "y"), ("a", 2, None), ("b", 1, "z"), (None, 5, "n"), (None, 5, "n"), ("", 1, "e"), ("", 1, "e"), ("c", None, "p"), ("c", None, "p")]
    frame = spark.createDataFrame(rows, "k string, at int, v string")
    keyless = F.col("k").isNull() | (F.col("k") == "")
    chosen = chosen_per_key(frame, "k", ["at"], latest, keyless)
    a = ("a", 2, "y", 3) if latest else ("a", 1, "x", 3)
    want = [a, ("b", 1, "z", 1), (None, 5, "n", 1), (None, 5, "n", 1), ("", 1, "e", 1), ("", 1, "e", 1), ("c", None, "p", 2)]
    assert sorted(map(tuple, chosen.collect()), key=str) == sorted(want, key=str)
    assert chosen.columns == ["k", "at", "v", "_rows"]
    assert ("LeftAnti" in plan(chosen)) == (limit is None)


def test_stored_rows_are_not_written_again_for_their_numbers(spark):
    rows = stored(spark.range(500).select(F.concat(F.lit("id"), "id").alias("name"), "id"), "rows")
    before = folders(spark)
    held = assign_keys(rows, "name", "key", start=7, held=True)
    assert folders(spark) == before
    want = assign_keys(rows, "name", "key", start=7)
    assert sorted(held.collect()) == sorted(want.collect())


def test_an_empty_target_is_left_out_of_the_plan(spark):
    store = TableStore(spark, f"{shared_dir(spark)}/none-published")
    empty = store.read_or_empty("nothing", spark.range(0).schema)
    assert empty.join(spark.range(9), "id", "left").count() == 0
    assert "Join" not in plan(empty.join(spark.range(9), "id", "left"))


def test_new_rows_of_folders_are_written_once(spark):
    schema = "key bigint, id string, day int, state string, month int"
    target = stored(spark.createDataFrame([(1, "a", 101, "old", 1), (2, "b", 201, "old", 2), (3, "c", 301, "old", 3)], schema), "target")
    batch = stored(spark.createDataFrame([("a", 101, "new"), ("d", 202, "new")], "id string, day int, state string"), "batch")
    before = folders(spark)
    state, months = upsert_folders(target, batch, ["id"], ["state"], "month", F.floor(F.col("day") / 100).cast("int"), surrogate="key")
    assert months == [1, 2]
    assert sorted(map(tuple, state.collect())) == [(1, "a", 101, "new", 1), (2, "b", 201, "old", 2), (4, "d", 202, "new", 2)]
    written = sorted(name.rsplit("-", 1)[0] for name in folders(spark) - before)
    assert written == ["kept-rows", "known-keys", "new-rows"]


def test_landing_tables_made_by_joins_are_written_once(spark, small):
    for name, rows in queries_etl._landing(spark, small).items():
        files = rows.inputFiles()
        if name != "raw_loan_products":
            assert files and all(f"/lendscope/{name}-" in f for f in files)
        made = queries_etl.LANDING[name](spark, small)
        assert rows.schema.simpleString() == made.schema.simpleString()
        assert rows.exceptAll(made).isEmpty() and made.exceptAll(rows).isEmpty()


def test_folders_whose_rows_come_again_as_they_are_stay(spark):
    schema = "key bigint, id string, day int, state string, at int, month int"
    target = stored(spark.createDataFrame([(1, "a", 101, "x", 7, 1), (2, "b", 201, None, 7, 2), (3, "c", 301, "x", 7, 3), (4, "d", 401, "x", 6, 4)], schema), "target")
    month = F.floor(F.col("day") / 100).cast("int")

    def months(*rows, at=7):
        batch = stored(spark.createDataFrame(list(rows), "id string, day int, state string"), "batch")
        state, names = upsert_folders(target, batch, ["id"], ["state"], "month", month, surrogate="key", touched={"at": F.lit(at)}, defaults={"at": F.lit(at)})
        assert {r.month for r in state.collect()} <= set(names)
        return names

    same = [("a", 101, "x"), ("b", 201, None), ("c", 301, "x")]
    assert months(*same) == []
    assert months(*same, at=8) == [1, 2, 3]
    assert months(("a", 101, None), ("b", 201, None)) == [1]
    assert months(("b", 201, "x"), ("c", 301, "x")) == [2]
    assert months(("d", 401, "x")) == [4]
    assert months(*same, ("e", 105, "x"), ("f", 901, "x")) == [1, 9]


def test_a_delivery_of_the_same_day_leaves_the_files_of_its_loans(spark, small):
    store, landing = TableStore(spark, fresh_path(spark, "wh")), queries_etl._landing(spark, small)
    seen = []
    for day in (dt.date(2001, 7, 30), dt.date(2001, 7, 31), dt.date(2001, 7, 31)):
        Load(store, landing, day).run()
        loans = store.read("fact_loan").select(*WAREHOUSE["fact_loan"].names)
        seen.append((sorted(loans.inputFiles()), sorted(map(str, loans.collect())), loans.agg(F.min("updated_at")).first()[0]))
    assert [day for _, _, day in seen] == [dt.datetime(2001, 7, d) for d in (30, 31, 31)]
    assert seen[2] == seen[1] and not set(seen[1][0]) & set(seen[0][0])


@pytest.mark.parametrize("known, left", [("small", None), ("large", "small"), ("large", "large")])
def test_new_rows_are_the_same_however_many_are_known(spark, monkeypatch, known, left):
    sizes = iter({"small": 0, "large": upsert.BROADCAST_BYTES + 1}[size] for size in (known, left) if size)
    monkeypatch.setattr(upsert, "estimated_bytes", lambda frame: next(sizes))
    target = spark.createDataFrame([("a", 1, "old"), ("b", None, "old"), (None, 1, "old")], "k string, n int, v string")
    source = spark.createDataFrame([("a", 1, "x"), ("a", 2, "x"), ("b", None, "x"), ("b", None, "x"), (None, 1, "x"), (None, None, "x")], "k string, n int, v string")
    got = new_rows(target, source, ["k", "n"], None, {})
    want = [("a", 2, "x"), ("b", None, "x"), ("b", None, "x"), (None, 1, "x"), (None, None, "x")]
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, want))
    assert ("LeftSemi" in plan(got)) == (left == "small")


def test_loans_are_not_moved_for_the_products_that_they_name(spark, small):
    """Few products of many, each with very many loans."""
    dims = queries_etl._Dims(spark, small)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        checked = etl.checked_loans(dims.raw["raw_loans"], etl.customer_places(dims.customer, dims.region), dims.product)
        steps = checked._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin [product_code" in steps and "SortMergeJoin [product_code" not in steps
        assert checked.filter("product_key IS NULL").count() > 0 and checked.filter("product_key IS NOT NULL").count() > 1000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
