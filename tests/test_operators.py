from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from lendscope.operators import quality
from lendscope.operators.dedup import first_per_key, newest_per_key
from lendscope.operators.keys import assign_keys
from lendscope.operators.quantiles import exact_percentiles
from lendscope.operators.rolling import rolling_rows_sum
from lendscope.operators.skew import key_parts, salted_join
from lendscope.operators.upsert import insert_ignore, upsert


def rows(frame, *columns):
    return sorted(tuple(r) for r in frame.select(*columns).collect())


# --- skew --------------------------------------------------------------------


@pytest.mark.parametrize("how", ["inner", "left"])
def test_salted_join_equals_plain_join(spark, how):
    # key 1 holds a third of the rows; some keys are NULL, some unknown
    fact = spark.range(9000).select(
        F.col("id").alias("row"),
        F.when(F.col("id") % 3 == 0, 1).when(F.col("id") % 50 == 1, None).otherwise(F.col("id") % 700).alias("k"),
    )
    table = spark.range(600).select(F.col("id").alias("k"), (F.col("id") * 10).alias("v"))
    counts = fact.groupBy("k").agg(F.count("*").alias("n"))
    parts = key_parts(counts, "k", "n", rows_per_task=500)
    assert [tuple(r) for r in parts.collect()] == [(1, 6)]  # 3 000 rows and a few by chance
    got = salted_join(fact, table, "k", parts, F.col("row"), how)
    want = fact.join(table, "k", how)
    assert rows(got.na.fill(-1), "row", "k", "v") == rows(want.na.fill(-1), "row", "k", "v")


def test_parts_follow_from_the_rows_of_a_key(spark):
    counts = spark.createDataFrame([(1, 500), (2, 3), (3, 100_001), (None, 10**9)], "k int, n bigint")
    assert rows(key_parts(counts, "k", "n", rows_per_task=500), "k", "parts") == [(3, 201)]
    assert key_parts(counts, "k", "n").count() == 0


def test_hot_key_spreads_over_its_parts(spark):
    """A key with 30 % of the rows: no part is far above the mean."""
    fact = spark.range(30_000).select(F.col("id").alias("row"), F.when(F.col("id") % 10 < 3, 7).otherwise(F.col("id")).alias("k"))
    parts = key_parts(fact.groupBy("k").agg(F.count("*").alias("n")), "k", "n", rows_per_task=500).first()
    salts = fact.filter("k = 7").groupBy(F.pmod(F.xxhash64("row"), F.lit(parts.parts)).alias("s")).count().collect()
    assert len(salts) == parts.parts == 19 and max(r["count"] for r in salts) < 1.3 * 9001 / 19


def test_salted_join_rejects_other_joins(spark):
    frame = spark.range(1).withColumnRenamed("id", "k")
    with pytest.raises(ValueError):
        salted_join(frame, frame, "k", frame.withColumn("parts", F.lit(2)), F.col("k"), "full_outer")


# --- dedup and keys ----------------------------------------------------------


def test_dedup_picks_by_order_then_columns(spark):
    data = [("a", 1, "x"), ("a", 2, "y"), ("a", 2, "z"), ("b", 5, None)]
    frame = spark.createDataFrame(data, "k string, t int, v string")
    assert rows(newest_per_key(frame, ["k"], ["t"]), "k", "t", "v") == [("a", 2, "z"), ("b", 5, None)]
    assert rows(first_per_key(frame, ["k"], ["t"]), "k", "t", "v") == [("a", 1, "x"), ("b", 5, None)]


def test_keys_are_dense_stable_and_follow_start(spark):
    frame = spark.range(5000).select(F.concat(F.lit("id"), "id").alias("name"))
    one = assign_keys(frame, "name", "key", start=100)
    two = assign_keys(frame.repartition(7), "name", "key", start=100, digits=1)
    keys = [r.key for r in one.collect()]
    assert sorted(keys) == list(range(101, 5101))
    assert sorted(r.key for r in two.collect()) == list(range(101, 5101))
    again = assign_keys(frame.repartition(3), "name", "key", start=100)
    assert rows(one, "name", "key") == rows(again, "name", "key")


# --- upsert ------------------------------------------------------------------

TARGET = [(1, "a", "old a", 10), (2, "b", "old b", 20)]
SCHEMA = "sk int, k string, name string, amount int"


def test_upsert_changes_listed_columns_and_numbers_new_rows(spark):
    target = spark.createDataFrame(TARGET, SCHEMA)
    source = spark.createDataFrame([("b", "new b", 99), ("c", "new c", 30)], "k string, name string, amount int")
    state = upsert(target, source, ["k"], ["name"], surrogate="sk")
    assert rows(state, "sk", "k", "name", "amount") == [(1, "a", "old a", 10), (2, "b", "new b", 20), (3, "c", "new c", 30)]


def test_upsert_writes_null_over_a_value(spark):
    target = spark.createDataFrame(TARGET, SCHEMA)
    source = spark.createDataFrame([("a", None, 1)], "k string, name string, amount int")
    assert (1, "a", None, 10) in [tuple(r) for r in upsert(target, source, ["k"], ["name"], surrogate="sk").collect()]


def test_upsert_twice_is_once(spark):
    target = spark.createDataFrame(TARGET, SCHEMA)
    source = spark.createDataFrame([("b", "nb", 1), ("c", "nc", 2), ("d", "nd", 3)], "k string, name string, amount int")
    once = upsert(target, source, ["k"], ["name", "amount"], surrogate="sk")
    twice = upsert(once, source, ["k"], ["name", "amount"], surrogate="sk")
    assert rows(once, *once.columns) == rows(twice, *once.columns)


def test_upsert_takes_the_newest_of_repeated_keys(spark):
    target = spark.createDataFrame(TARGET, SCHEMA)
    source = spark.createDataFrame(
        [("a", "first", 1, 1), ("a", "last", 1, 2)], "k string, name string, amount int, at int"
    )
    state = upsert(target, source, ["k"], ["name"], surrogate="sk", order=["at"])
    assert ("a", "last") in rows(state, "k", "name")


def test_upsert_touches_updated_rows_only(spark):
    target = spark.createDataFrame(TARGET, SCHEMA).withColumn("seen", F.lit("before"))
    source = spark.createDataFrame([("b", "nb", 1), ("c", "nc", 2)], "k string, name string, amount int")
    state = upsert(
        target, source, ["k"], ["name"], surrogate="sk", touched={"seen": F.lit("now")}, defaults={"seen": F.lit("new")}
    )
    assert rows(state, "k", "seen") == [("a", "before"), ("b", "now"), ("c", "new")]


def test_insert_ignore_twice_is_once(spark):
    target = spark.createDataFrame([("t1", 1)], "id string, v int")
    source = spark.createDataFrame([("t1", 9), ("t2", 5), ("t2", 3), ("t3", 7)], "id string, v int")
    added = insert_ignore(target, source, ["id"], ["v"])
    assert rows(added, "id", "v") == [("t2", 3), ("t3", 7)]
    assert insert_ignore(target.unionByName(added), source, ["id"], ["v"]).count() == 0


# --- percentiles and rolling sums -------------------------------------------


def test_percentiles_equal_numpy(spark):
    rng = random.Random(3)
    data = [(g, round(rng.lognormvariate(10, 2) * (1 if g else 0.001), 2)) for g in (0, 1) for _ in range(2001 + g)]
    data += [(2, 5.0)] * 40 + [(3, -7.25), (3, 7.25), (None, 1.0), (None, 2.0), (1, None)]
    frame = spark.createDataFrame(data, "g int, v double").withColumn("v", F.col("v").cast("decimal(18,2)"))
    points = {"lo": 0.0, "q1": 0.25, "mid": 0.5, "p95": 0.95, "hi": 1.0}
    got = {r.g: r for r in exact_percentiles(frame, ["g"], "v", points, small=100).collect()}
    assert set(got) == {0, 1, 2, 3, None}
    for g, row in got.items():
        values = [v for k, v in data if k == g and v is not None]
        for name, p in points.items():
            assert row[name] == pytest.approx(np.quantile(values, p), abs=1e-6), (g, name)


def test_percentiles_of_the_whole_table_and_of_nothing(spark):
    frame = spark.range(101).select(F.col("id").cast("decimal(18,2)").alias("v"))
    assert exact_percentiles(frame, [], "v", {"m": 0.5}).collect()[0].m == 50.0
    empty = exact_percentiles(frame.filter("v < 0"), [], "v", {"m": 0.5}).collect()
    assert [r.m for r in empty] in ([], [None])


def test_rolling_rows_equal_brute_force(spark):
    rng = random.Random(5)
    # days of one, few and many rows
    data = [(d, i, rng.randint(0, 9)) for d in range(30) for i in range(rng.choice([1, 1, 2, 5, 6, 7, 20]))]
    frame = spark.createDataFrame(data, "d int, i int, v int").repartition(5)
    got = rows(rolling_rows_sum(frame, "d", [F.col("i")], "v", "s"), "d", "i", "s")
    line = sorted(data)
    want = [(d, i, sum(v for _, _, v in line[max(0, n - 6) : n + 1])) for n, (d, i, _) in enumerate(line)]
    assert got == want


# --- quality -----------------------------------------------------------------


def test_quality_rules(spark):
    child = spark.createDataFrame([(1, "a"), (2, "x"), (3, "x"), (3, None)], "id int, ref string")
    parent = spark.createDataFrame([("a",)], "ref string")
    assert rows(quality.unique_violations(child, "c", ["id"]), "key", "rows") == [("3", 2)]
    assert rows(quality.reference_violations(child, "c", "ref", parent, "p", "ref"), "key", "rows") == [("x", 2)]
    assert rows(quality.null_violations(child, "c", ["id", "ref"]), "key", "rows") == [("ref", 1)]


def test_results_do_not_depend_on_partitions(spark, small):
    from lendscope.plans import kpi
    from lendscope.sources.bridge import bridge_star

    star = bridge_star(spark, small)
    spread = star.replaced(loan=star.loan.repartition(13), txn=star.txn.repartition(11))
    for job in (kpi.par30, kpi.npl_ratio, kpi.txn_volume, kpi.anomaly_summary):
        one, two = job(star), job(spread)
        assert Counter(map(str, one.collect())) == Counter(map(str, two.collect()))
