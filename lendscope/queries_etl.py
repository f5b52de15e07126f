"""Registered queries of the load tier: cleansing, keys, upserts, checks."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lendscope.functions.credit import is_npl, is_par30, monthly_installment, total_interest
from lendscope.functions.dates import calendar_columns, whole_years
from lendscope.functions.numbers import money
from lendscope.operators import quality
from lendscope.operators.dedup import first_per_key
from lendscope.operators.keys import assign_keys
from lendscope.operators.upsert import insert_ignore, upsert
from lendscope.plans import etl, kpi
from lendscope.plans.load import Load, run_log
from lendscope.sources import bridge
from lendscope.sources.bridge import AS_OF
from lendscope.sources.schemas import REFERENCES, REQUIRED, STAGING_COLUMNS, UNIQUE
from lendscope.sources.staging import MALFORMED, read_staging, write_staging
from lendscope.sources.star import warehouse_star
from lendscope.sources.store import TableStore
from lendscope.sources.workspace import fresh_path, stored

DAY1, DAY2 = dt.date(2001, 7, 1), dt.date(2001, 7, 2)


def for_output(frame: DataFrame) -> DataFrame:
    """DECIMAL as DOUBLE and SMALLINT as INT, the types the checks compare."""
    columns = []
    for field in frame.schema.fields:
        kind = field.dataType.typeName()
        target = {"decimal": "double", "short": "int"}.get(kind)
        columns.append(F.col(field.name).cast(target).alias(field.name) if target else F.col(field.name))
    return frame.select(*columns)


# --- sources -----------------------------------------------------------------


LANDING = {
    "raw_customers": bridge.raw_customers,
    "raw_loans": bridge.raw_loans,
    "raw_transactions": bridge.raw_transactions,
    "raw_loan_products": bridge.raw_products,
}


def through_files(name: str, broken: str | None = None):
    """A landing table through CSV files and back; ``broken`` is a column that
    gets a line break and a quote in every value."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        path = fresh_path(spark, "landing")
        rows = LANDING[name](spark, sf_dir)
        if broken:
            rows = rows.withColumn(broken, F.concat(F.col(broken), F.lit('\n"jr", '), F.col(broken)))
        write_staging(rows, path, name)
        return read_staging(spark, path, name).select(*STAGING_COLUMNS[name])

    return query


def read_staging_malformed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loan files with broken lines among them: the good rows by their id, the others by their text."""
    path, loans = fresh_path(spark, "landing"), LANDING["raw_loans"](spark, sf_dir)
    write_staging(loans, path, "raw_loans")
    broken = loans.filter(F.right("loan_id", F.lit(6)).cast("int") % 97 == 0)
    lines = broken.select(F.concat(F.lit("broken,"), "loan_id").alias("line"), F.lit(1).alias("at"))
    header = spark.createDataFrame([(",".join(STAGING_COLUMNS["raw_loans"]), 0)], "line string, at int")
    header.unionByName(lines).coalesce(1).sortWithinPartitions("at").select("line").write.mode("append").text(path)
    rows = read_staging(spark, path, "raw_loans", line_breaks=False)
    return rows.select(F.when(F.col(MALFORMED).isNull(), F.col("loan_id")).alias("loan_id"), F.col(MALFORMED).alias("malformed"))


def dim_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per day from the first loan or transaction to the last."""
    loans = bridge.loan(spark, sf_dir).agg(F.min("issue_date").alias("lo"), F.max("issue_date").alias("hi"))
    txns = bridge.raw_events(spark, sf_dir).agg(F.min("txn_date").alias("lo"), F.max("txn_date").alias("hi"))
    span = loans.unionByName(txns).agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    days = span.select(F.explode(F.sequence("lo", "hi")).alias("d"))
    return for_output(days.select(*[c.alias(n) for n, c in calendar_columns(F.col("d")).items()]))


# --- loads -------------------------------------------------------------------


def _landing(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The landing tables. Those that the bridge makes by joins are written once: a load reads each of
    them several times."""
    return {name: rows(spark, sf_dir) if name == "raw_loan_products" else stored(rows(spark, sf_dir), name) for name, rows in LANDING.items()}


def _dim_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assign_keys(etl.regions(bridge.raw_customers(spark, sf_dir)), "region_id", "region_key", key_type="int")


def _dim_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = etl.accepted(etl.checked_products(bridge.raw_products(spark, sf_dir)))
    return assign_keys(rows, "product_code", "product_key", key_type="int")


def _customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return etl.accepted(etl.checked_customers(bridge.raw_customers(spark, sf_dir)))


def _dim_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    keyed = assign_keys(_customers(spark, sf_dir), "customer_id", "customer_key")
    return keyed.withColumns(etl.open_version(AS_OF))


class _Dims:
    """The landing tables, the checked dimensions and the dimensions, stored once per query."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.raw = _landing(spark, sf_dir)
        self.checked_regions = stored(etl.checked_regions(self.raw["raw_customers"]), "checked-regions")
        self.checked_products = stored(etl.checked_products(self.raw["raw_loan_products"]), "checked-products")
        self.checked_customers = stored(etl.checked_customers(self.raw["raw_customers"]), "checked-customers")
        region, product, customer = (etl.accepted(c) for c in (self.checked_regions, self.checked_products, self.checked_customers))
        self.region = stored(assign_keys(region.drop("rows"), "region_id", "region_key", key_type="int", held=True), "dim-region")
        self.product = stored(assign_keys(product, "product_code", "product_key", key_type="int", held=True), "dim-product")
        keyed = assign_keys(customer, "customer_id", "customer_key", held=True)
        self.customer = stored(keyed.withColumns(etl.open_version(AS_OF)), "dim-customer")

    def checked_loans(self) -> DataFrame:
        places = etl.customer_places(self.customer, self.region)
        return stored(etl.checked_loans(self.raw["raw_loans"], places, self.product), "checked-loans")

    def checked_transactions(self, loans: DataFrame) -> DataFrame:
        checked = etl.checked_transactions(self.raw["raw_transactions"], self.customer, self.region, loans)
        return stored(checked, "checked-transactions")


def _keyed_loans(checked: DataFrame) -> DataFrame:
    return assign_keys(etl.accepted(checked).drop("region_defaulted"), "loan_id", "loan_key", held=True)


def etl_dim_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _dim_region(spark, sf_dir)


def etl_dim_loan_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    return for_output(_dim_product(spark, sf_dir))


def etl_dim_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return for_output(_dim_customer(spark, sf_dir).drop("region_id"))


def etl_fact_loan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return for_output(_keyed_loans(_Dims(spark, sf_dir).checked_loans()))


def etl_fact_transaction(spark: SparkSession, sf_dir: str) -> DataFrame:
    dims = _Dims(spark, sf_dir)
    rows = etl.accepted(dims.checked_transactions(_keyed_loans(dims.checked_loans())))
    return for_output(assign_keys(rows, "transaction_id", "txn_key", held=True))


def etl_dim_customer_scd2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First landing day loaded as versions, then the newest rows applied."""
    raw = bridge.raw_customers(spark, sf_dir)
    first_day = raw.filter(F.col("_ingested_at") < F.lit(str(DAY2)).cast("timestamp_ntz"))
    columns = ["customer_id", "employment_status", "annual_income", "credit_score", "risk_tier"]
    old = etl.accepted(etl.checked_customers(first_day)).select(*columns).withColumns(etl.open_version(DAY1))
    new = _customers(spark, sf_dir).select(*columns)
    return for_output(etl.scd2(old, new, "customer_id", columns[1:], DAY2))


def etl_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    dims = _Dims(spark, sf_dir)
    loans = dims.checked_loans()
    parts = [
        etl.region_rejects(dims.checked_regions),
        etl.rejects(dims.checked_products, "dim_loan_product", "product_code"),
        etl.rejects(dims.checked_customers, "dim_customer", "customer_id"),
        etl.rejects(loans, "fact_loan", "loan_id"),
        etl.rejects(dims.checked_transactions(_keyed_loans(loans)), "fact_transaction", "transaction_id"),
    ]
    return reduce(DataFrame.unionByName, parts)


_STORES: dict[tuple[str, str], TableStore] = {}


def _loaded(spark: SparkSession, sf_dir: str) -> TableStore:
    """One whole load of a data folder, kept for the session; readers only read it."""
    name = (spark.sparkContext.applicationId, sf_dir)
    if name not in _STORES:
        store = TableStore(spark, fresh_path(spark, "warehouse"))
        # one load: what it would save is less than the landing tables take
        Load(store, {name: rows(spark, sf_dir) for name, rows in LANDING.items()}, AS_OF).run()
        _STORES[name] = store
    return _STORES[name]


def warehouse_dim_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The calendar as published by a load."""
    return for_output(_loaded(spark, sf_dir).read("dim_date"))


def warehouse_two_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The loans after two loads: the first day brings the first rows of all
    customers and the loans with an even last digit; the second only the newer
    customer rows, the other loans and the transactions."""
    store, landing = TableStore(spark, fresh_path(spark, "warehouse")), _landing(spark, sf_dir)
    later = F.col("_ingested_at") >= F.lit(str(DAY2)).cast("timestamp_ntz")
    odd = F.right("loan_id", F.lit(1)).cast("int") % 2 == 1
    parts = {"raw_customers": later, "raw_loans": odd, "raw_transactions": F.lit(True)}
    for day, wanted in ((DAY1, False), (DAY2, True)):
        batch = {t: rows.filter(parts[t] == wanted) if t in parts else rows for t, rows in landing.items()}
        Load(store, batch, day).run()
    loans = store.read("fact_loan").select("loan_id", "customer_key", "product_key", "region_key", "days_past_due", "loan_status")
    people = store.read("dim_customer").select("customer_key", "customer_id", "credit_score")
    goods = store.read("dim_loan_product").select("product_key", "product_code")
    places = store.read("dim_region").select("region_key", "city", "state")
    placed = loans.join(people, "customer_key").join(goods, "product_key").join(places, "region_key")
    return for_output(placed.drop("customer_key", "product_key", "region_key"))


def warehouse_deliveries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The scores after two deliveries of transactions, the odd and then the even ones, each scored against
    the customer's history up to it; the second is loaded twice."""
    store, landing = TableStore(spark, fresh_path(spark, "warehouse")), _landing(spark, sf_dir)
    odd = F.right(F.trim("transaction_id"), F.lit(1)).cast("int") % 2 == 1
    rows = landing["raw_transactions"]
    for name, part in (("odd", rows.filter(odd)), ("even", rows.filter(~odd)), ("even", rows.filter(~odd))):
        Load(store, {**landing, "raw_transactions": part}, AS_OF, batch=name).run()
    scored = store.read("fact_transaction").select("transaction_id", "is_anomaly", "anomaly_score", "anomaly_reason")
    return for_output(scored)


def warehouse_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loans with the customer version that was valid on their issue date: two loads, of the
    first customer rows with the even loans of the time before, and of the newer rows with all other loans, old ones too."""
    store, landing = TableStore(spark, fresh_path(spark, "warehouse")), _landing(spark, sf_dir)
    later = F.col("_ingested_at") >= F.lit(str(DAY2)).cast("timestamp_ntz")
    rest = (F.right("loan_id", F.lit(1)).cast("int") % 2 == 1) | (F.col("issue_date") >= "1998-01-01")
    for day, second in ((dt.date(1996, 1, 1), False), (dt.date(1998, 1, 1), True)):
        batch = {**landing, "raw_customers": landing["raw_customers"].filter(later == second), "raw_loans": landing["raw_loans"].filter(rest == second)}
        Load(store, batch, day, versions=True).run()
    star = warehouse_star(store.read, versions=True)
    people = store.read("dim_customer").select("customer_key", "customer_id", "annual_income", "is_current")
    loans = star.loan.select("loan_id", "customer_key", "issue_date")
    return for_output(loans.join(people, "customer_key").drop("customer_key"))


def warehouse_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every declared key, reference and required column of the published tables,
    with the rows that were checked and those that break the rule."""
    store = _loaded(spark, sf_dir)
    return quality.rule_report({t: store.read(t) for t in (*UNIQUE, *REQUIRED)}, UNIQUE, REFERENCES, REQUIRED)


def etl_run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log of a whole load (the counts; times and ids differ by run)."""
    return run_log(_loaded(spark, sf_dir)).select(
        "step_name", "rows_extracted", "rows_rejected", "rows_loaded", "status"
    )


def warehouse_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A whole load, then the snapshot over the published tables."""
    star = warehouse_star(_loaded(spark, sf_dir).read)
    return kpi.kpi_snapshot(star, AS_OF)


# --- upserts -----------------------------------------------------------------


def upsert_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Target: the urban regions under old names; batch: all landing regions."""
    target = (
        bridge.region(spark, sf_dir)
        .filter("region_tier = 'URBAN'")
        .selectExpr("region_key", "region_id", "upper(city) AS city", "upper(state) AS state", "country", "region_tier")
    )
    batch = stored(etl.regions(bridge.raw_customers(spark, sf_dir)), "batch")
    return upsert(target, batch, ["region_id"], etl.REGION_UPDATES, surrogate="region_key")


def upsert_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Target: the secured products with stale text and rates."""
    batch = stored(etl.accepted(etl.checked_products(bridge.raw_products(spark, sf_dir))), "batch")
    stale = batch.filter("is_secured").withColumns(
        {
            "product_name": F.lit("Old Name"),
            "sub_category": F.lit("Old Rate"),
            "interest_rate_max": F.lit(1).cast("decimal(5,2)"),
            "min_tenure_months": F.lit(1).cast("smallint"),
        }
    )
    target = stored(assign_keys(stale, "product_code", "product_key", key_type="int"), "target")
    return for_output(upsert(target, batch, ["product_code"], etl.PRODUCT_UPDATES, surrogate="product_key"))


def upsert_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Target: first landing day, customers with a birth date; batch: newest rows."""
    raw = bridge.raw_customers(spark, sf_dir)
    first_day = raw.filter(F.col("_ingested_at") < F.lit(str(DAY2)).cast("timestamp_ntz"))
    columns = [
        "customer_id", "first_name", "last_name", "date_of_birth", "gender", "email", "phone",
        "employment_status", "annual_income", "credit_score", "risk_tier",
    ]
    old = etl.accepted(etl.checked_customers(first_day)).filter("date_of_birth IS NOT NULL").select(*columns)
    stale = old.withColumns({"email": F.lit("old@mail.test"), "employment_status": F.lit("Unknown")})
    target = stored(stale.withColumn("updated_on", F.lit(str(DAY1)).cast("date")), "target")
    touched = {"updated_on": F.lit(str(DAY2)).cast("date")}
    new = stored(_customers(spark, sf_dir).select(*columns), "batch")
    return for_output(
        upsert(target, new, ["customer_id"], etl.CUSTOMER_UPDATES, touched=touched, defaults=touched)
    )


def upsert_loan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Target: loans issued before July 2001; batch: next day's state of all."""
    loans = bridge.loan(spark, sf_dir)
    fixed = [
        "loan_id", "customer_key", "product_key", "region_key", "issue_date", "principal_amount",
        "interest_rate", "tenure_months",
    ]
    target = loans.filter(F.col("issue_date") < F.lit(str(DAY1)).cast("date")).select(*fixed, *etl.LOAN_UPDATES)
    batch = bridge.loan_day2(loans).select(
        *fixed,
        (F.col("outstanding_balance") * F.lit("0.99").cast("decimal(3,2)")).cast("decimal(18,2)").alias("outstanding_balance"),
        F.col("new_status").alias("loan_status"),
        F.col("new_dpd").alias("days_past_due"),
        is_npl(F.col("new_dpd")).alias("is_npl"),
        is_par30(F.col("new_dpd")).alias("is_par30"),
    )
    return for_output(upsert(stored(target, "target"), stored(batch, "batch"), ["loan_id"], etl.LOAN_UPDATES))


def insert_ignore_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line transactions; those shipped before 1998 are loaded already."""
    rows = bridge.line_transactions(spark, sf_dir)
    order = ["txn_date", "amount", "part_key", "supplier_key"]
    loaded = first_per_key(rows.filter("txn_date < DATE '1998-01-01'"), ["transaction_id"], order)
    loaded = stored(loaded, "target")
    return for_output(loaded.unionByName(insert_ignore(loaded, rows, ["transaction_id"], order)))


# --- quality -----------------------------------------------------------------


def dq_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    check = quality.unique_violations
    return quality.all_violations(
        [
            check(bridge.region(spark, sf_dir), "region", ["region_id"]),
            check(bridge.region(spark, sf_dir), "region", ["country", "state"]),
            check(bridge.customer(spark, sf_dir), "customer", ["customer_id"]),
            check(bridge.raw_customers(spark, sf_dir), "raw_customers", ["customer_id"]),
            check(bridge.raw_loans(spark, sf_dir), "raw_loans", ["loan_id"]),
            check(bridge.line_transactions(spark, sf_dir), "line_transactions", ["transaction_id"]),
        ]
    )


def dq_fk(spark: SparkSession, sf_dir: str) -> DataFrame:
    check = quality.reference_violations
    loans = bridge.raw_loans(spark, sf_dir).withColumns(
        {"customer_id": F.trim("customer_id"), "product_code": F.upper(F.trim("product_code"))}
    )
    txns = bridge.raw_transactions(spark, sf_dir).withColumn("place", F.concat("city", F.lit("|"), "state"))
    places = bridge.region(spark, sf_dir).withColumn("place", F.concat("city", F.lit("|"), "state"))
    people = bridge.customer(spark, sf_dir)
    return quality.all_violations(
        [
            check(loans, "raw_loans", "customer_id", people, "customer", "customer_id"),
            check(loans, "raw_loans", "product_code", bridge.product(spark), "product", "product_code"),
            check(txns, "raw_transactions", "place", places, "region", "place"),
            check(txns, "raw_transactions", "loan_id", bridge.loan(spark, sf_dir), "loan", "loan_id"),
        ]
    )


def dq_notnull(spark: SparkSession, sf_dir: str) -> DataFrame:
    check = quality.null_violations
    return quality.all_violations(
        [
            check(bridge.customer(spark, sf_dir), "customer", ["customer_id", "credit_score", "date_of_birth"]),
            check(bridge.raw_events(spark, sf_dir), "transaction", ["transaction_id", "amount", "currency"]),
            check(bridge.loan(spark, sf_dir), "loan", ["principal_amount", "interest_rate", "loan_status"]),
        ]
    )


# --- derived columns ---------------------------------------------------------


def monthly_installment_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    due = monthly_installment(F.col("principal_amount"), F.col("interest_rate"), F.col("tenure_months"))
    return bridge.loan(spark, sf_dir).select("loan_id", due.alias("monthly_installment"))


def total_interest_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    due = monthly_installment(F.col("principal_amount"), F.col("interest_rate"), F.col("tenure_months"))
    paid = total_interest(due, F.col("tenure_months"), F.col("principal_amount"))
    return bridge.loan(spark, sf_dir).select("loan_id", paid.alias("total_interest"))


def customer_age(spark: SparkSession, sf_dir: str) -> DataFrame:
    age = whole_years(F.col("date_of_birth"), F.lit(str(AS_OF)).cast("date"))
    return bridge.customer(spark, sf_dir).select(
        "customer_id", "date_of_birth", age.alias("age"), money(F.col("annual_income")).alias("annual_income")
    )


QUERIES = {
    "read_staging": through_files("raw_customers"),
    "read_staging_loans": through_files("raw_loans"),
    "read_staging_transactions": through_files("raw_transactions"),
    "read_staging_products": through_files("raw_loan_products"),
    "read_staging_malformed": read_staging_malformed,
    "read_staging_line_breaks": through_files("raw_customers", "last_name"),
    "dim_date": dim_date,
    "etl_dim_region": etl_dim_region,
    "etl_dim_loan_product": etl_dim_loan_product,
    "etl_dim_customer": etl_dim_customer,
    "etl_dim_customer_scd2": etl_dim_customer_scd2,
    "etl_fact_loan": etl_fact_loan,
    "etl_fact_transaction": etl_fact_transaction,
    "etl_rejects": etl_rejects,
    "etl_run_log": etl_run_log,
    "warehouse_snapshot": warehouse_snapshot,
    "warehouse_dim_date": warehouse_dim_date,
    "warehouse_two_days": warehouse_two_days,
    "warehouse_versions": warehouse_versions,
    "warehouse_deliveries": warehouse_deliveries,
    "warehouse_rules": warehouse_rules,
    "upsert_region": upsert_region,
    "upsert_product": upsert_product,
    "upsert_customer": upsert_customer,
    "upsert_loan": upsert_loan,
    "insert_ignore": insert_ignore_query,
    "dq_unique": dq_unique,
    "dq_fk": dq_fk,
    "dq_notnull": dq_notnull,
    "monthly_installment": monthly_installment_query,
    "total_interest": total_interest_query,
    "customer_age": customer_age,
}
