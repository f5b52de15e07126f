"""The whole load: six tables and the rejects, prepared aside and then published in the order of their references."""

from __future__ import annotations

import datetime as dt
import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lendscope.functions.dates import calendar_columns
from lendscope.functions.numbers import count_if
from lendscope.functions.text import to_type
from lendscope.operators.keys import assign_keys
from lendscope.operators.moments import merged
from lendscope.operators.upsert import insert_ignore, upsert, upsert_folders
from lendscope.plans import etl
from lendscope.sources.schemas import RUN_LOG, WAREHOUSE
from lendscope.sources.store import TableStore
from lendscope.sources.workspace import stored

# Load order follows the references between the tables.
STEPS = ("dim_region", "dim_loan_product", "dim_customer", "fact_loan", "fact_transaction", "dim_date")
# The stored baseline of the transaction scores, and the deliveries that are in it.
MOMENTS = "amount_moments"
MOMENTS_SCHEMA = "customer_id string, rows long, n long, mean double, m2 double, low double, high double, batch string"
# The month folders of the facts, and the flag that sorts them.
MONTHS = {"fact_loan": ("issue_month", "is_npl"), "fact_transaction": ("txn_month", "is_anomaly")}


def _audit(at: Column, *names: str) -> dict[str, Column]:
    return {name: at for name in names}


def calendar(landing: dict[str, DataFrame]) -> DataFrame:
    """One row per day from the first loan or transaction to the last."""
    days = [("raw_loans", "issue_date"), ("raw_transactions", "transaction_date")]
    spans = [
        landing[t].select(to_type(F.col(c), "date", strict=False).alias("d")).agg(F.min("d").alias("lo"), F.max("d").alias("hi"))
        for t, c in days
    ]
    span = spans[0].unionByName(spans[1]).agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    rows = span.filter("lo IS NOT NULL").select(F.explode(F.sequence("lo", "hi")).alias("d"))
    return rows.select(*[c.alias(n) for n, c in calendar_columns(F.col("d")).items()])


@dataclass
class Counts:
    """Landing rows read, those rejected or repeated, those loaded, and loaded
    ones whose region had to be defaulted: read = rejected + loaded."""

    read: int | None = None
    rejected: int | None = None
    loaded: int | None = None
    defaulted: int | None = None


class Load:
    """One run over the landing tables ``raw_customers``, ``raw_loans``,
    ``raw_transactions`` and ``raw_loan_products``.

    A batch may hold new rows only; customers, products and regions of earlier
    loads are read from the published tables. With ``batch``, the name of this
    delivery, its transactions are new ones as well: they are scored against the published
    moments of all earlier deliveries, merged with their own, and no old landing
    row is read. A delivery of one name is merged once, however often it is
    loaded. Without a name transactions are the accumulated landing table (see
    ``etl.checked_transactions``). Stay with one of the two.

    With ``versions`` a customer whose tracked columns change gets a new row with a key of its own, valid
    from ``as_of`` on, and the old one is closed; loans and transactions meet the version valid on their day and
    keep it. Read such tables with ``warehouse_star(store.read, versions=True)``.

    Every batch is written once after cleansing and read back: the upsert, the
    reject report and the run log use the same stored rows, and a lost executor
    repeats a read, not the cleansing.
    """

    def __init__(self, store: TableStore, landing: dict[str, DataFrame], as_of: dt.date, strict: bool = False, batch: str | None = None, versions: bool = False):
        self.store, self.as_of, self.strict, self.batch = store, as_of, strict, batch
        self.delivered, self.landing = landing, {name: etl.well_formed(rows) for name, rows in landing.items()}
        self.moments: tuple[DataFrame, str] | None = None
        self.versions = versions
        self.run_id = uuid.uuid4().hex
        self.at = F.lit(str(as_of)).cast("timestamp")
        self.folders: dict[str, str] = {}
        self.staged: dict[str, DataFrame] = {}
        self.fresh: dict[str, DataFrame] = {}
        self.reject_parts: list[DataFrame] = []

    def run(self) -> str:
        """All steps, then all tables are published. Returns the run's id."""
        with self.store.writing():
            for step in STEPS:
                self._logged(step, getattr(self, f"_{step}"))
            dropped = stored(reduce(DataFrame.unionByName, self.reject_parts), "rejects")
            self._publish()
            self.store.append("etl_rejects", dropped)
        return self.run_id

    def _publish(self) -> None:
        """Dimensions, then loans, then transactions: at any moment all references hold. A load that
        is broken off here is completed by running it again: what is published already stays as it is."""
        for table, folder in self.folders.items():
            self.store.show(table, folder, self.staged[table].schema)
        loans, rows = self.fresh["fact_loan"], self.fresh["fact_transaction"]
        self.store.overwrite_folders("fact_loan", self._laid_out(loans, "fact_loan"), MONTHS["fact_loan"][0])
        self.store.append("fact_transaction", self._laid_out(rows, "fact_transaction"), MONTHS["fact_transaction"][0])
        if self.moments is not None:
            self.store.show(MOMENTS, self.moments[1], self.moments[0].schema)

    # -- steps

    def _dim_region(self) -> Counts:
        checked = stored(etl.checked_regions(self.landing["raw_customers"]), "batch-dim_region")
        dropped = etl.region_rejects(checked)
        batch = etl.accepted(checked).drop("rows")
        read, loaded = checked.agg(F.sum("rows")).first()[0] or 0, batch.count()
        self.reject_parts.append(dropped)
        target = self._target("dim_region")
        self._full("dim_region", upsert(target, batch, ["region_id"], etl.REGION_UPDATES, surrogate="region_key"))
        return Counts(read, dropped.agg(F.sum("rows")).first()[0] or 0, loaded)

    def _dim_loan_product(self) -> Counts:
        checked = etl.checked_products(self.landing["raw_loan_products"], self.strict)
        batch, counts = self._batch("dim_loan_product", checked, "product_code", "raw_loan_products")
        target = self._target("dim_loan_product")
        self._full(
            "dim_loan_product", upsert(target, batch, ["product_code"], etl.PRODUCT_UPDATES, surrogate="product_key")
        )
        return counts

    def _dim_customer(self) -> Counts:
        checked = etl.checked_customers(self.landing["raw_customers"], self.strict)
        batch, counts = self._batch("dim_customer", checked, "customer_id", "raw_customers")
        if self.versions:
            self._full("dim_customer", self._customer_versions(batch))
            return counts
        state = upsert(
            self._target("dim_customer"),
            batch,
            ["customer_id"],
            etl.PLACED_UPDATES,
            surrogate="customer_key",
            touched=_audit(self.at, "updated_at"),
            defaults={**etl.open_version(self.as_of), **_audit(self.at, "created_at", "updated_at")},
        )
        self._full("dim_customer", state)
        return counts

    def _customer_versions(self, batch: DataFrame) -> DataFrame:
        target = self._target("dim_customer")
        last = target.agg(F.max("customer_key")).first()[0] or 0
        state = stored(etl.scd2(target, batch, "customer_id", etl.PLACED_UPDATES, self.as_of), "customer-versions")
        opened = assign_keys(state.filter("customer_key IS NULL").drop("customer_key"), "customer_id", "customer_key", last)
        opened = opened.withColumns(_audit(self.at, "created_at", "updated_at"))
        # of the kept ones those that were closed today have changed
        closed = ~F.col("is_current") & (F.col("expiry_date") == F.lit(str(self.as_of)).cast("date"))
        kept = state.filter("customer_key IS NOT NULL").withColumn("updated_at", F.when(closed, self.at).otherwise(F.col("updated_at")))
        return kept.unionByName(opened.select(*kept.columns))

    def _fact_loan(self) -> Counts:
        find = etl.customer_versions if self.versions else etl.customer_places
        places = find(self.staged["dim_customer"], self.staged["dim_region"])
        checked = etl.checked_loans(
            self.landing["raw_loans"], places, self.staged["dim_loan_product"], self.strict
        )
        batch, counts = self._batch("fact_loan", checked, "loan_id", "raw_loans")
        counts.defaulted = batch.agg(count_if(F.col("region_defaulted"))).first()[0]
        batch = batch.drop("region_defaulted")
        month = F.floor(F.col("issue_date_key") / 100).cast("int")
        target = self._target("fact_loan", "issue_month", month)
        audit = {"touched": _audit(self.at, "updated_at"), "defaults": _audit(self.at, "created_at", "updated_at")}
        state, months = upsert_folders(
            target, batch, ["loan_id"], etl.LOAN_UPDATES, "issue_month", month, surrogate="loan_key", **audit
        )
        self.fresh["fact_loan"] = state
        untouched = target.filter(~F.col("issue_month").isin(*months)) if months else target
        self.staged["fact_loan"] = untouched.unionByName(self.fresh["fact_loan"].select(*target.columns))
        return counts

    def _baseline(self) -> DataFrame | None:
        """The moments of all deliveries so far and this one. The table names the merged ones in
        rows without a customer, so it and its list are published by one view."""
        if self.batch is None:
            return None
        known = self.store.read_or_empty(MOMENTS, T.StructType.fromDDL(MOMENTS_SCHEMA))
        own, done = known.filter("batch IS NULL").drop("batch"), known.filter("batch IS NOT NULL")
        if done.filter(F.col("batch") == self.batch).head(1):
            return own
        fresh = stored(etl.amount_moments(self.landing["raw_transactions"], self.strict), "batch-moments")
        rows = merged(own, fresh, "customer_id").withColumn("batch", F.lit(None).cast("string"))
        mark = self.store.spark.createDataFrame([(None,) * len(known.columns[:-1]) + (self.batch,)], known.schema)
        self.moments = self.store.stage(rows.unionByName(done).unionByName(mark), MOMENTS)
        return self.moments[0].filter("batch IS NULL").drop("batch")

    def _fact_transaction(self) -> Counts:
        checked = etl.checked_transactions(
            self.landing["raw_transactions"],
            self.staged["dim_customer"],
            self.staged["dim_region"],
            self.staged["fact_loan"],
            self.strict,
            self._baseline(),
            etl.customer_versions(self.staged["dim_customer"], self.staged["dim_region"]) if self.versions else None,
        )
        batch, counts = self._batch("fact_transaction", checked, "transaction_id", "raw_transactions")
        target = self._target("fact_transaction")
        # the checked batch has one row per id
        new = insert_ignore(target, batch, ["transaction_id"], None, "txn_key", _audit(self.at, "created_at"))
        month = F.floor(F.col("txn_date_key") / 100).cast("int")
        self.fresh["fact_transaction"] = stored(new.withColumn("txn_month", month), "fact_transaction")
        return counts

    def _dim_date(self) -> Counts:
        """The days published so far and those of this batch, without gaps."""
        both = self._target("dim_date").select("full_date").unionByName(calendar(self.landing).select("full_date"))
        span = both.agg(F.min("full_date").alias("lo"), F.max("full_date").alias("hi")).filter("lo IS NOT NULL")
        days = span.select(F.explode(F.sequence("lo", "hi")).alias("d"))
        self._full("dim_date", days.select(*[c.alias(n) for n, c in calendar_columns(F.col("d")).items()]))
        rows = self.staged["dim_date"].count()
        return Counts(rows, 0, rows)

    # -- helpers

    def _target(self, table: str, folder: str | None = None, folder_of: Column | None = None) -> DataFrame:
        rows = self.store.read_or_empty(table, WAREHOUSE[table])
        if folder and folder not in rows.columns:
            rows = rows.withColumn(folder, folder_of)
        return rows.select(*WAREHOUSE[table].names, *([folder] if folder else []))

    def _batch(self, step: str, checked: DataFrame, row_id: str, source: str) -> tuple[DataFrame, Counts]:
        """Store the checked batch; return its good rows and the counts, which
        come from one column of the stored rows. Every landing row is one of
        them, so read = rejected + loaded; malformed lines are among the rejected."""
        held = stored(checked, f"batch-{step}")
        seen = held.agg(F.sum("_rows").alias("n"), F.count("*").alias("kept"), count_if(F.col("reject_reason").isNotNull()).alias("bad")).first()
        rows, kept, lines = seen.n or 0, seen.kept - seen.bad, 0
        if etl.MALFORMED in self.delivered[source].columns:
            broken = stored(etl.malformed(self.delivered[source], step), "malformed")
            lines = broken.agg(F.sum("rows")).first()[0] or 0
            if lines and self.strict:
                raise ValueError(f"{step}: {lines} malformed lines in {source}")
            self.reject_parts.append(broken)
        read = self.delivered[source].agg(F.count("*")).first()[0]
        if read != rows + lines:
            raise ValueError(f"{step}: {read} landing rows, {rows} checked ones and {lines} malformed lines")
        self.reject_parts.append(etl.rejects(held, step, row_id))
        return etl.accepted(held), Counts(read, read - kept, kept)

    def _laid_out(self, frame: DataFrame, table: str) -> DataFrame:
        """Facts go to month folders, sorted by their flag so that readers of
        flagged rows skip row groups. Rebalancing by month gives few files per
        folder and splits a month that is too large for one task."""
        month, flag = MONTHS[table]
        return frame.hint("rebalance", month).sortWithinPartitions(month, flag)

    def _full(self, table: str, state: DataFrame) -> None:
        self.staged[table], self.folders[table] = self.store.stage(state, table)

    def _logged(self, step: str, work: Callable[[], Counts]) -> None:
        started = time.monotonic()
        counts = Counts()
        status, error = "SUCCESS", None
        try:
            counts = work()
        except Exception as problem:
            status, error = "FAILED", str(problem)
            raise
        finally:
            took = int((time.monotonic() - started) * 1000)
            row = (
                self.run_id, None, step, counts.read, counts.rejected, counts.loaded, counts.defaulted, took, status, error
            )
            (
                self.store.spark.createDataFrame([row], RUN_LOG)
                .withColumn("run_ts", F.current_timestamp())
                .coalesce(1)
                .write.mode("append")
                .parquet(f"{self.store.root}/etl_run_log")
            )


def run_log(store: TableStore) -> DataFrame:
    return store.spark.read.schema(RUN_LOG).parquet(f"{store.root}/etl_run_log")
