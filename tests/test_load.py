from __future__ import annotations

import datetime as dt

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from lendscope.plans import kpi
from lendscope.plans.load import STEPS, Load, run_log
from lendscope.queries_etl import _landing
from lendscope.plans.cache import refresh_kpi_cache
from lendscope.sources.bridge import AS_OF, bridge_star
from lendscope.sources.schemas import WAREHOUSE
from lendscope.sources.star import warehouse_star
from lendscope.sources.store import TableStore, WriterBusy
from lendscope.sources.workspace import fresh_path, shared_dir, stored


@pytest.fixture(scope="module")
def loaded(spark, small):
    store = TableStore(spark, fresh_path(spark, "wh"))
    Load(store, _landing(spark, small), dt.date(2001, 7, 31)).run()
    return store


def test_tables_have_their_layout_and_unique_keys(loaded):
    surrogate = {"dim_region": "region_key", "dim_loan_product": "product_key", "dim_customer": "customer_key", "fact_loan": "loan_key", "fact_transaction": "txn_key"}
    business = {"dim_region": "region_id", "dim_loan_product": "product_code", "dim_customer": "customer_id", "fact_loan": "loan_id", "fact_transaction": "transaction_id"}
    for table, schema in WAREHOUSE.items():
        frame = loaded.read(table)
        if table == "dim_date":
            continue
        assert [(f.name, f.dataType) for f in frame.select(*schema.names).schema] == [(f.name, f.dataType) for f in schema], table
        n = frame.count()
        assert n > 0 and frame.select(surrogate[table]).distinct().count() == n == frame.select(business[table]).distinct().count()
        assert frame.agg(F.max(surrogate[table])).first()[0] == n


def test_second_load_of_the_same_batch_changes_nothing_but_the_audit(spark, small, loaded):
    before = {t: sorted(map(str, loaded.read(t).select(*[c for c in WAREHOUSE[t].names if c != "updated_at"]).collect())) for t in STEPS}
    Load(loaded, _landing(spark, small), dt.date(2001, 8, 1)).run()
    for t in STEPS:
        after = loaded.read(t).select(*[c for c in WAREHOUSE[t].names if c != "updated_at"])
        assert sorted(map(str, after.collect())) == before[t], t
    assert loaded.read("fact_loan").agg(F.min("updated_at")).first()[0] == dt.datetime(2001, 8, 1)
    assert run_log(loaded).count() == 2 * len(STEPS)


def test_month_folders_and_pruning(loaded):
    star = warehouse_star(loaded.read)
    plan = star.txn_between("2001-07-03", "2001-07-03")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(txn_month" in plan


def test_failed_load_publishes_nothing_and_is_logged(spark, small):
    store = TableStore(spark, fresh_path(spark, "wh"))
    landing = _landing(spark, small)
    landing["raw_loans"] = landing["raw_loans"].withColumn("principal_amount", F.lit("many"))
    with pytest.raises(PySparkException):
        Load(store, landing, AS_OF, strict=True).run()
    assert not any(store.exists(t) for t in WAREHOUSE)
    log = {r.step_name: r.status for r in run_log(store).collect()}
    assert log["dim_customer"] == "SUCCESS" and log["fact_loan"] == "FAILED" and "fact_transaction" not in log
    # tolerant mode rejects every loan instead
    Load(store, landing, AS_OF).run()
    assert store.read("fact_loan").count() == 0
    assert store.read("etl_rejects").filter("step_name = 'fact_loan' AND reason = 'bad number'").count() > 1400


def test_indicators_run_on_the_published_tables(spark, loaded):
    star = warehouse_star(loaded.read)
    assert kpi.npl_ratio(star).count() > 0 and kpi.txn_volume(star).count() > 0
    assert kpi.kpi_snapshot(star, AS_OF).first().active_loan_count > 0


def test_store_shows_old_until_the_view_is_switched(spark):
    store = TableStore(spark, fresh_path(spark, "st"))
    first, folder = store.stage(spark.range(3), "t")
    assert not store.exists("t")
    store.show("t", folder, first.schema)
    second, folder = store.stage(spark.range(5), "t")
    old = store.read("t")
    assert old.count() == 3
    store.show("t", folder, second.schema)
    assert store.read("t").count() == 5 and old.count() == 3
    store.append("a", spark.range(2))
    store.append("a", spark.range(2))
    assert store.read("a").count() == 4
    with pytest.raises(ValueError):
        store.read("unknown")


def test_kpi_cache_is_replaced(spark, small):
    store, star = TableStore(spark, fresh_path(spark, "cache")), bridge_star(spark, small)
    refresh_kpi_cache(store, star, dt.date(2001, 7, 30))
    old = store.read("kpi_cache")
    refresh_kpi_cache(store, star, AS_OF)
    assert store.read("kpi_cache").first().snapshot_ts == AS_OF
    # a reader of the old version still sees it
    assert old.first().snapshot_ts == dt.date(2001, 7, 30)
    refresh_kpi_cache(store, star, AS_OF)
    days = [r.snapshot_ts.day for r in store.read("kpi_history").orderBy("snapshot_ts").collect()]
    assert days == [30, 31]


def test_shared_dir_is_the_sessions(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")


def test_newer_file_wins(spark, tmp_path):
    """Two deliveries of one customer in CSV files, through the whole load."""
    import os

    from lendscope.plans import etl
    from lendscope.sources.schemas import STAGING_COLUMNS
    from lendscope.sources.staging import read_staging

    header = ",".join(STAGING_COLUMNS["raw_customers"])
    for name, income, at in (("z.csv", "$900", 1_700_000_000), ("a.csv", "$100", 1_700_009_000)):
        path = tmp_path / name
        path.write_text(f"{header}\nC1,ann,lee,1990-01-01,f,e,p,retired,{income},700,Paris,S1,France\n")
        os.utime(path, (at, at))
    raw = read_staging(spark, f"file://{tmp_path}", "raw_customers")
    (row,) = etl.accepted(etl.checked_customers(raw)).collect()
    assert float(row.annual_income) == 100.0


def test_untouched_months_keep_their_files(spark, small):
    """A second batch with loans of one month rewrites that month only."""
    store = TableStore(spark, fresh_path(spark, "wh"))
    landing = _landing(spark, small)
    Load(store, landing, dt.date(2001, 7, 31)).run()
    before = {r.issue_month: r.f for r in files_by_month(store)}
    batch = landing["raw_loans"].filter("issue_date LIKE '2000-05-%'").withColumn("loan_status", F.lit("closed"))
    Load(store, {**landing, "raw_loans": batch}, dt.date(2001, 8, 1)).run()
    after = {r.issue_month: r.f for r in files_by_month(store)}
    assert [m for m in before if before[m] != after[m]] == [200005]
    loans = store.read("fact_loan")
    assert loans.count() == loans.select("loan_id").distinct().count() == 1471
    changed = loans.filter("updated_at > TIMESTAMP '2001-07-31'")
    assert changed.count() > 0 and {r.loan_status for r in changed.select("loan_status").distinct().collect()} == {"CLOSED"}
    assert changed.filter("issue_month <> 200005").count() == 0


def files_by_month(store):
    rows = store.read("fact_loan").select("issue_month", F.input_file_name().alias("p"))
    return rows.groupBy("issue_month").agg(F.sort_array(F.collect_set("p")).alias("f")).collect()


def test_an_upsert_reads_the_target_once_beside_its_keys(spark, tmp_path):
    from lendscope.operators.upsert import upsert

    spark.range(1000).selectExpr("id AS k", "id AS v", "'x' AS wide").write.parquet(f"{tmp_path}/target")
    target = spark.read.parquet(f"{tmp_path}/target")
    batch = stored(spark.range(990, 1010).selectExpr("id AS k", "-id AS v", "'y' AS wide"), "batch")
    plan = upsert(target, batch, ["k"], ["v"])._jdf.queryExecution().executedPlan().toString()
    wide = [line for line in plan.splitlines() if "FileScan" in line and str(tmp_path) in line]
    assert len(wide) == 1


def test_the_second_of_two_writers_fails_and_nothing_is_lost(spark, small):
    root = fresh_path(spark, "st")
    one, two = TableStore(spark, root), TableStore(spark, root)
    with one.writing():
        with pytest.raises(WriterBusy):
            Load(two, _landing(spark, small), AS_OF).run()
        with pytest.raises(WriterBusy):
            refresh_kpi_cache(two, bridge_star(spark, small), AS_OF)
        one.append("t", spark.range(5))
    assert two.read("t").count() == 5 and not two.exists("dim_region")
    with two.writing():
        two.append("t", spark.range(2))
    assert one.read("t").count() == 7
    # the mark of a writer that died is taken away by hand
    spark.sql(f"CREATE VIEW {one._view('writer')} AS SELECT 'gone' AS run")
    with pytest.raises(WriterBusy), one.writing():
        pass
    two.unlock()
    with one.writing():
        pass


def test_folders_without_new_rows_stay(spark):
    store = TableStore(spark, fresh_path(spark, "st"))
    rows = spark.range(12).selectExpr("id", "cast(id % 3 as int) AS m")
    store.overwrite_folders("t", rows.limit(0), "m")
    assert store.read("t").count() == 0 and store.read("t").dtypes == rows.dtypes
    store.overwrite_folders("t", rows, "m")
    store.overwrite_folders("t", rows.filter("m = 1").withColumn("id", F.col("id") + 100), "m")
    store.overwrite_folders("t", rows.filter("m = 2").limit(1), "m")
    got = sorted((r.m, r.id) for r in store.read("t").select("m", "id").collect())
    assert got == [(0, 0), (0, 3), (0, 6), (0, 9), (1, 101), (1, 104), (1, 107), (1, 110), (2, 2)]


def test_a_load_broken_off_while_publishing_is_completed_by_the_next(spark, small, monkeypatch):
    store, landing = TableStore(spark, fresh_path(spark, "wh")), _landing(spark, small)
    with monkeypatch.context() as patch:
        patch.setattr(TableStore, "append", lambda *_: (_ for _ in ()).throw(OSError("gone")))
        with pytest.raises(OSError):
            Load(store, landing, AS_OF).run()
    assert store.read("fact_loan").count() == 1471 and not store.exists("fact_transaction")
    Load(store, landing, AS_OF).run()
    star = warehouse_star(store.read)
    assert store.read("fact_loan").count() == 1471 and kpi.kpi_snapshot(star, AS_OF).first().active_loan_count > 0
    keys = store.read("fact_transaction").join(store.read("dim_customer"), "customer_key", "left_anti")
    assert keys.count() == 0 < store.read("fact_transaction").count()


def test_region_of_a_customer_of_an_earlier_load(spark, small):
    store = TableStore(spark, fresh_path(spark, "wh"))
    landing = _landing(spark, small)
    Load(store, {**landing, "raw_loans": landing["raw_loans"].limit(0)}, dt.date(2001, 7, 1)).run()
    one = landing["raw_customers"].limit(1)
    Load(store, {**landing, "raw_customers": one}, dt.date(2001, 7, 2)).run()
    log = run_log(store).filter("step_name = 'fact_loan'").orderBy("run_ts").collect()
    assert log[-1].rows_defaulted == 0 and log[-1].rows_loaded == 1471
    assert store.read("fact_loan").groupBy("region_key").count().count() == 25


def test_counts_add_up(loaded):
    for row in run_log(loaded).collect():
        assert row.rows_extracted == row.rows_rejected + row.rows_loaded, row.step_name


def test_a_malformed_row_fails_a_strict_read_whatever_is_read(spark, tmp_path):
    from lendscope.sources.schemas import STAGING_COLUMNS
    from lendscope.sources.staging import read_staging

    header = ",".join(STAGING_COLUMNS["raw_customers"])
    (tmp_path / "a.csv").write_text(f"{header}\nC1,ann\n")
    with pytest.raises((PySparkException, Py4JJavaError)):
        read_staging(spark, f"file://{tmp_path}", "raw_customers", strict=True).select("customer_id").collect()


def customer_files(folder, n=3):
    from lendscope.sources.schemas import STAGING_COLUMNS

    header = ",".join(STAGING_COLUMNS["raw_customers"])
    good = [f"C{k},ann,lee,1990-01-01,f,e,p,retired,$9,700,Paris,S1,France" for k in range(n)]
    (folder / "a.csv").write_text("\n".join([header, good[0], "C0,short", *good[1:], good[1] + ",one,too many", ""]))
    return f"file://{folder}"


@pytest.mark.parametrize("line_breaks", [True, False])
def test_malformed_rows_are_reported_and_the_others_read(spark, tmp_path, line_breaks):
    from lendscope.plans import etl
    from lendscope.sources.staging import MALFORMED, read_staging

    raw = read_staging(spark, customer_files(tmp_path), "raw_customers", line_breaks=line_breaks)
    assert raw.count() == 5 and raw.select("customer_id").count() == 5
    good = etl.accepted(etl.checked_customers(etl.well_formed(raw)))
    assert sorted(r.customer_id for r in good.collect()) == ["C0", "C1", "C2"]
    got = sorted((r.row_id.strip(), r.reason, r.rows) for r in etl.malformed(raw, "dim_customer").collect())
    assert [r[0].split(",")[:2] for r in got] == [["C0", "short"], ["C1", "ann"]] and {r[1:] for r in got} == {("malformed row", 1)}
    assert raw.filter(f"{MALFORMED} IS NULL").select("customer_id").distinct().count() == 3


def test_a_load_survives_malformed_rows_unless_it_is_strict(spark, small, tmp_path):
    from lendscope.sources.staging import read_staging

    landing = {**_landing(spark, small), "raw_customers": read_staging(spark, customer_files(tmp_path), "raw_customers")}
    landing = {name: rows if name == "raw_customers" else rows.limit(0) for name, rows in landing.items()}
    store = TableStore(spark, fresh_path(spark, "wh"))
    Load(store, landing, AS_OF).run()
    assert store.read("dim_customer").count() == 3
    assert store.read("etl_rejects").filter("reason = 'malformed row'").agg(F.sum("rows")).first()[0] == 2
    log = {r.step_name: r for r in run_log(store).collect()}
    assert (log["dim_customer"].rows_extracted, log["dim_customer"].rows_rejected, log["dim_customer"].rows_loaded) == (5, 2, 3)
    with pytest.raises(ValueError):
        Load(TableStore(spark, fresh_path(spark, "wh")), landing, AS_OF, strict=True).run()


def test_a_large_file_without_line_breaks_is_read_by_several_tasks(spark, tmp_path):
    from lendscope.sources.staging import read_staging

    path = customer_files(tmp_path, 20_000)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "200k")
    try:
        whole, split = (read_staging(spark, path, "raw_customers", line_breaks=b) for b in (True, False))
        assert whole.rdd.getNumPartitions() == 1 < split.rdd.getNumPartitions()
        assert whole.count() == split.count() == 20_002
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_moments_of_parts_are_those_of_the_whole(spark):
    from lendscope.operators.moments import merged, moments, spread

    rows = spark.range(3000).selectExpr("id % 7 AS k", "CASE WHEN id % 7 = 3 THEN 5.55 WHEN id % 11 = 0 THEN NULL ELSE 1e6 + rand(1) END AS v", "id")
    rows = stored(rows.unionByName(spark.createDataFrame([(8, None, 0), (9, 1.5, 0), (None, 2.0, 0)], "k long, v double, id long")), "values")
    parts = [moments(rows.filter(F.col("id") % 3 == p), "k", F.col("v")) for p in range(3)]
    whole = merged(merged(parts[2], parts[0], "k"), parts[1], "k").select("k", "rows", "n", "mean", spread().alias("sd"))
    plain = rows.filter("k IS NOT NULL").groupBy("k").agg(F.count("*"), F.count("v"), F.avg("v"), F.stddev_samp("v"))
    got, want = ({r[0]: tuple(r)[1:] for r in frame.collect()} for frame in (whole, plain))
    assert set(got) == set(want) and got[3][3] == 0.0
    for k, values in got.items():
        assert values == pytest.approx(want[k], rel=1e-9, abs=1e-12) if None not in values else values == want[k]
    empty = merged(parts[0].limit(0), parts[0], "k").select(*parts[0].columns)
    assert {tuple(r) for r in empty.collect()} == {tuple(r) for r in parts[0].collect()}


def test_loans_keep_the_customer_version_of_their_day(spark):
    """Two loads between which a score falls: old loans keep the old tier, also when they come late."""
    from lendscope.sources.schemas import staging_schema

    def rows(table, *values):
        schema = staging_schema(table).add("_ingested_at", "timestamp_ntz")
        return spark.createDataFrame([(*v, dt.datetime(2020, 1, 1)) for v in values], schema)

    def person(score, income="9"):
        return ("C1", "ann", "lee", "1990-01-01", "f", "e", "p", "retired", income, str(score), "Paris", "S1", "France")

    def loan(lid, day):
        return (lid, "C1", "P1", day, "", "1200", "12.0", "12", "active", "", "10.5")

    def payment(tid, day):
        return (tid, "C1", "L1", day, "repayment", "10", "USD", "", "Paris", "S1", "France")

    product = rows("raw_loan_products", ("P1", "n", "auto", "x", "1", "2", "3", "4", "no", "Car"))
    store = TableStore(spark, fresh_path(spark, "wh"))
    loads = [
        (dt.date(2020, 1, 1), person(800), [loan("L1", "2019-05-05"), loan("L2", "2020-02-02")], [payment("T1", "2020-02-02")]),
        (dt.date(2020, 6, 1), person(500), [loan("L2", "2020-02-02"), loan("L3", "2020-03-03"), loan("L4", "2020-06-01")], [payment("T2", "2020-03-03"), payment("T3", "2020-07-07")]),
        (dt.date(2020, 9, 1), person(500), [loan("L5", "2020-12-12")], []),
    ]
    for day, who, loans, payments in loads:
        batch = {"raw_customers": rows("raw_customers", who), "raw_loans": rows("raw_loans", *loans), "raw_transactions": rows("raw_transactions", *payments), "raw_loan_products": product}
        Load(store, batch, day, batch=str(day), versions=True).run()
    star = warehouse_star(store.read, versions=True)
    people = store.read("dim_customer")
    tiers = {r.loan_id: (r.risk_tier, r.is_current) for r in star.loan.select("loan_id", "customer_key").join(people, "customer_key").collect()}
    low, high = ("LOW", False), ("CRITICAL", True)
    assert tiers == {"L1": low, "L2": low, "L3": low, "L4": high, "L5": high}
    paid = {r.transaction_id: r.risk_tier for r in store.read("fact_transaction").join(people, "customer_key").collect()}
    assert paid == {"T1": "LOW", "T2": "LOW", "T3": "CRITICAL"}
    assert sorted((str(r.effective_date), str(r.expiry_date), r.customer_key) for r in people.collect()) == [("2020-01-01", "2020-06-01", 1), ("2020-06-01", "9999-12-31", 2)]
