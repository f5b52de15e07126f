"""The star and landing shapes derived from order, event and part tables.

Orders stand for loans, events for transactions, parts for loan products.
Constants (modulo rules, the date shift) are fixed values of the fixture.
"""

from __future__ import annotations

import datetime as dt
from functools import cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lendscope.functions.credit import anomaly_columns, is_npl, is_par30, risk_tier, z_score
from lendscope.operators.skew import key_parts, salted_join
from lendscope.sources.star import Star, fact_star, month_key
from lendscope.sources.workspace import stored

# Events are moved back this many days; their last day is then 2001-07-30.
EVENT_SHIFT_DAYS = 8219
AS_OF = dt.date(2001, 7, 31)

# The product dimension.
PRODUCTS = ((1, "PERSONAL"), (2, "MORTGAGE"), (3, "AUTO"), (4, "SME"), (5, "STUDENT"), (6, "PERSONAL"))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def region(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation, world = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    return nation.join(world, nation.n_regionkey == world.r_regionkey).selectExpr(
        "cast(n_nationkey + 1 as int) AS region_key",
        "md5(lower(n_name) || '|' || 'state_' || cast(n_nationkey % 10 as string)) AS region_id",
        "n_name AS city",
        "'State_' || cast(n_nationkey % 10 as string) AS state",
        "r_name AS country",
        "CASE WHEN n_nationkey % 5 = 0 THEN 'URBAN' ELSE 'SEMI-URBAN' END AS region_tier",
    )


def customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "customer")
        .selectExpr(
            "c_custkey + 1 AS customer_key",
            "'CUST' || lpad(cast(c_custkey as string), 10, '0') AS customer_id",
            "cast(c_nationkey + 1 as int) AS region_key",
            "c_mktsegment AS employment_status",
            "cast(abs(c_acctbal) * 12 as decimal(15,2)) AS annual_income",
            "CASE WHEN c_custkey % 50 = 7 THEN NULL ELSE cast(300 + (c_custkey * 37) % 551 as int) END AS credit_score",
            "CASE WHEN c_custkey % 37 = 0 THEN NULL"
            " ELSE date_add(DATE '1950-01-01', cast((c_custkey * 17) % 18000 as int)) END AS date_of_birth",
            "true AS is_current",
        )
        .withColumn("risk_tier", risk_tier(F.col("credit_score")))
    )


def product(spark: SparkSession) -> DataFrame:
    rows = ", ".join(f"({key}, 'P{key}', '{category}')" for key, category in PRODUCTS)
    return spark.sql(f"SELECT * FROM VALUES {rows} AS p(product_key, product_code, category)")


def loan(spark: SparkSession, sf_dir: str, people: DataFrame | None = None) -> DataFrame:
    """Loans with their customer's attributes; one join on the customer key."""
    people = customer(spark, sf_dir) if people is None else people
    facts = table(spark, sf_dir, "orders").selectExpr(
        "o_custkey + 1 AS customer_key",
        "o_orderkey AS loan_key",
        "'LOAN' || lpad(cast(o_orderkey as string), 12, '0') AS loan_id",
        "cast(o_orderkey % 6 + 1 as int) AS product_key",
        "cast(o_orderdate as date) AS issue_date",
        "cast(CASE WHEN o_orderkey % 97 = 0 THEN cast(o_totalprice as decimal(18,2)) * 10.0"
        " WHEN o_orderkey % 89 = 0 THEN cast(o_totalprice as decimal(18,2)) * 0.01"
        " ELSE 200000.0 + cast(o_totalprice as decimal(18,2)) * 0.2 END as decimal(18,2)) AS principal_amount",
        "CASE WHEN o_orderkey % 211 = 0 THEN cast(0 as decimal(5,2))"
        " ELSE cast(3 + (o_orderkey % 1500) / 100.0 as decimal(5,2)) END AS interest_rate",
        "cast(12 + o_orderkey % 49 as int) AS tenure_months",
        "CASE o_orderstatus WHEN 'F' THEN 'CLOSED' WHEN 'O' THEN 'ACTIVE' ELSE"
        " CASE o_orderkey % 3 WHEN 0 THEN 'DEFAULTED' WHEN 1 THEN 'RESTRUCTURED' ELSE 'ACTIVE' END END AS loan_status",
    )
    aged = facts.selectExpr(
        "*",
        "cast(CASE loan_status WHEN 'DEFAULTED' THEN 90 + (loan_key * 7) % 276"
        " WHEN 'ACTIVE' THEN CASE WHEN loan_key % 20 < 17 THEN 0 ELSE (loan_key * 13) % 90 END"
        " ELSE 0 END as int) AS days_past_due",
        "CASE WHEN loan_status = 'CLOSED' THEN cast(0 as decimal(18,2)) ELSE"
        " cast(principal_amount * cast(10 + loan_key % 91 as int) * 0.01 as decimal(18,2)) END AS outstanding_balance",
    )
    flagged = aged.withColumns(
        {"is_npl": is_npl(F.col("days_past_due")), "is_par30": is_par30(F.col("days_past_due"))}
    )
    attributes = people.select("customer_key", "customer_id", "region_key", "risk_tier", "credit_score")
    return flagged.join(attributes, "customer_key")


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transactions_of(table(spark, sf_dir, "events"))


def transactions_of(events: DataFrame) -> DataFrame:
    """Event rows (batch or stream) in transaction shape, before any join."""
    return events.selectExpr(
        "event_id AS txn_key",
        "'TXN' || lpad(cast(event_id as string), 14, '0') AS transaction_id",
        "user_id + 1 AS customer_key",
        f"date_sub(cast(ts as date), {EVENT_SHIFT_DAYS}) AS txn_date",
        "event_id * 2 AS loan_key_raw",
        "CASE event_type WHEN 'purchase' THEN 'REPAYMENT' WHEN 'view' THEN 'TRANSFER' WHEN 'click' THEN 'WITHDRAWAL'"
        " WHEN 'signup' THEN 'DEPOSIT' ELSE 'DISBURSEMENT' END AS transaction_type",
        "cast(value as decimal(18,2)) AS amount",
        "CASE WHEN event_id % 10 = 0 THEN NULL ELSE 'USD' END AS currency",
        "ts",
    )


def customer_stats(events: DataFrame) -> DataFrame:
    """Per-customer mean, deviation and row count over the whole history."""
    return (
        transactions_of(events)
        .filter(F.col("customer_key").isNotNull())
        .groupBy("customer_key")
        .agg(
            F.avg(F.col("amount").cast("double")).alias("avg_amount"),
            F.stddev_samp(F.col("amount").cast("double")).alias("sd_amount"),
            F.count("*").alias("n_txn"),
        )
    )


def baseline(stats: DataFrame, people: DataFrame) -> DataFrame:
    """The customers with their statistics, one row each. A customer without
    statistics stays, with NULLs: such rows score 0."""
    attributes = people.select("customer_key", "customer_id", "region_key", "risk_tier", "credit_score")
    return attributes.join(stats, "customer_key", "left")


def scored(facts: DataFrame, profile: DataFrame) -> DataFrame:
    """Score transaction rows (batch or stream) against the profile, a stored
    table as from ``baseline``. Rows of unknown customers fall out, as the
    inner join to the customer dimension asks."""
    parts = key_parts(profile, "customer_key", "n_txn")
    joined = salted_join(facts, profile.drop("n_txn"), "customer_key", parts, F.col("txn_key"))
    z = z_score(F.col("amount"), F.col("avg_amount"), F.col("sd_amount"))
    with_z = joined.withColumn("z_score", z).drop("avg_amount", "sd_amount")
    return with_z.withColumns(anomaly_columns(F.col("z_score")))


def stored_baseline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Written once: the salting and the join read it, the facts are not grouped again."""
    stats = customer_stats(table(spark, sf_dir, "events"))
    return stored(baseline(stats, customer(spark, sf_dir)), "baseline")


def scored_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scored(transactions_of(table(spark, sf_dir, "events")).drop("ts"), stored_baseline(spark, sf_dir))


# Attributes that a query takes from the customer dimension where it needs them.
CUSTOMER_SIDE = ("customer_id", "risk_tier", "credit_score")


def published(facts: DataFrame, day: str, month: str, flag: str, purpose: str) -> DataFrame:
    """A fact written in month folders, sorted by its flag within them."""
    kept = facts.drop(*CUSTOMER_SIDE).withColumn(month, month_key(F.col(day)))
    return stored(kept.hint("rebalance", month).sortWithinPartitions(month, flag), purpose, month)


_STARS: dict[tuple[str, str], Star] = {}


def bridge_star(spark: SparkSession, sf_dir: str) -> Star:
    """The star of a data folder, its facts published on first use and kept for
    the session: loans with the region of their customer (those of unknown
    customers fall out once, here), transactions with their score."""
    name = (spark.sparkContext.applicationId, sf_dir)
    if name not in _STARS:

        @cache
        def loans() -> DataFrame:
            return published(loan(spark, sf_dir), "issue_date", "issue_month", "is_npl", "fact-loan")

        @cache
        def txns() -> DataFrame:
            return published(scored_events(spark, sf_dir), "txn_date", "txn_month", "is_anomaly", "fact-transaction")

        _STARS[name] = fact_star(
            region=lambda: region(spark, sf_dir),
            customer=lambda: customer(spark, sf_dir),
            product=lambda: product(spark),
            loan=loans,
            txn=txns,
        )
    return _STARS[name]


def loan_day2(loans: DataFrame) -> DataFrame:
    """The loans with their days past due and status one day later."""
    return loans.selectExpr(
        "*",
        "CASE WHEN loan_status <> 'ACTIVE' THEN days_past_due"
        " WHEN loan_key % 20 IN (3, 17, 18) THEN days_past_due + 30"
        " WHEN loan_key % 20 = 19 THEN 0 ELSE days_past_due END AS new_dpd",
        "CASE WHEN loan_key % 40 = 0 AND loan_status = 'ACTIVE' THEN 'CLOSED' ELSE loan_status END AS new_status",
    )


# --- landing tier: the same rows as text, with dirt -------------------------


def raw_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every 13th customer has a second, newer row."""
    nation, world = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    versions = table(spark, sf_dir, "customer").selectExpr(
        "*",
        "'CUST' || lpad(cast(c_custkey as string), 10, '0') AS id",
        "explode(CASE WHEN c_custkey % 13 = 0 THEN array(1, 2) ELSE array(1) END) AS ver",
    )
    places = nation.join(world, nation.n_regionkey == world.r_regionkey)
    return versions.join(places, versions.c_nationkey == places.n_nationkey).selectExpr(
        "CASE WHEN c_custkey % 11 = 0 THEN '  ' || id || ' ' ELSE id END AS customer_id",
        "' ann' AS first_name",
        "'o''neil-' || c_mktsegment AS last_name",
        "CASE WHEN c_custkey % 37 = 0 THEN ''"
        " ELSE cast(date_add(DATE '1950-01-01', cast((c_custkey * 17) % 18000 as int)) as string) END AS date_of_birth",
        "CASE c_custkey % 4 WHEN 0 THEN 'male' WHEN 1 THEN 'F ' WHEN 2 THEN ' o' ELSE 'm' END AS gender",
        "upper(id) || '@MAIL.TEST ' AS email",
        "'+1-200' AS phone",
        "CASE c_custkey % 3 WHEN 0 THEN 'self-employed' WHEN 1 THEN 'Full-time' ELSE ' retired' END AS employment_status",
        "CASE WHEN c_custkey % 41 = 0 THEN ''"
        " ELSE '$' || cast(cast(abs(c_acctbal) * 12 * ver as decimal(15,2)) as string) END AS annual_income",
        "CASE WHEN c_custkey % 50 = 7 THEN '' ELSE cast(300 + (c_custkey * 37) % 551 as string) END AS credit_score",
        "' ' || n_name AS city",
        "'State_' || cast(n_nationkey % 10 as string) AS state",
        "r_name AS country",
        "CASE ver WHEN 1 THEN TIMESTAMP_NTZ '2001-07-01 00:00:00' ELSE TIMESTAMP_NTZ '2001-07-02 00:00:00' END AS _ingested_at",
    )


def raw_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The catalogue comes from the part table; loans use codes P1..P6."""
    return table(spark, sf_dir, "part").selectExpr(
        "' p' || cast(p_partkey as string) AS product_code",
        "' ' || replace(p_name, ' ', '-') || ' plan ' AS product_name",
        "CASE p_partkey % 6 WHEN 2 THEN 'mortgage ' WHEN 3 THEN ' auto' WHEN 4 THEN 'sme' WHEN 5 THEN 'Student'"
        " ELSE 'personal ' END AS category",
        "lower(p_type) || ' rate' AS sub_category",
        "CASE p_partkey % 7 WHEN 2 THEN '' ELSE cast(p_size as string) || '.25' END AS interest_rate_min",
        "cast(p_size + 15 as string) || '.99' AS interest_rate_max",
        "'12' AS min_tenure_months",
        "CASE p_partkey % 5 WHEN 3 THEN '' ELSE cast(24 + p_partkey % 100 as string) END AS max_tenure_months",
        "CASE p_partkey % 5 WHEN 0 THEN 'Yes' WHEN 1 THEN 'true' WHEN 2 THEN '1' WHEN 3 THEN 'no' END AS is_secured",
        "CASE WHEN p_partkey % 2 = 0 THEN ' Vehicle' ELSE '  ' END AS collateral_type",
        "TIMESTAMP_NTZ '2001-07-01 00:00:00' AS _ingested_at",
    )


def raw_loans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return loan(spark, sf_dir).selectExpr(
        "loan_id",
        "CASE WHEN loan_key % 101 = 0 THEN 'CUST9999999999'"
        " ELSE ' CUST' || lpad(cast(customer_key - 1 as string), 10, '0') END AS customer_id",
        "CASE WHEN loan_key % 103 = 0 THEN 'nope' ELSE 'p' || cast(product_key as string) || ' ' END AS product_code",
        "cast(issue_date as string) AS issue_date",
        "CASE WHEN loan_key % 59 = 0 THEN ''"
        " ELSE cast(date_add(issue_date, tenure_months * 30) as string) END AS maturity_date",
        "cast(principal_amount as string) AS principal_amount",
        "cast(interest_rate as string) AS interest_rate",
        "cast(tenure_months as string) AS tenure_months",
        "lower(loan_status) AS loan_status",
        "CASE WHEN days_past_due = 0 AND loan_key % 2 = 0 THEN '' ELSE cast(days_past_due as string) END AS days_past_due",
        "cast(outstanding_balance as string) AS outstanding_balance",
        "TIMESTAMP_NTZ '2001-07-01 00:00:00' AS _ingested_at",
    )


def raw_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    people = customer(spark, sf_dir).select("customer_key", "region_key")
    places = region(spark, sf_dir).select("region_key", "city", "state", "country")
    return raw_events(spark, sf_dir).join(people, "customer_key").join(places, "region_key").selectExpr(
        "transaction_id",
        "'CUST' || lpad(cast(customer_key - 1 as string), 10, '0') || ' ' AS customer_id",
        "'LOAN' || lpad(cast(loan_key_raw as string), 12, '0') AS loan_id",
        "cast(txn_date as string) AS transaction_date",
        "lower(transaction_type) AS transaction_type",
        "cast(amount as string) AS amount",
        "currency",
        "'' AS fee_amount",
        "CASE WHEN txn_key % 71 = 0 THEN 'nowhere' ELSE city END AS city",
        "state",
        "country",
        "TIMESTAMP_NTZ '2001-07-01 00:00:00' AS _ingested_at",
    )


def line_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transactions with naturally repeated ids."""
    return table(spark, sf_dir, "lineitem").selectExpr(
        "cast(l_orderkey as string) || '-' || cast(l_linenumber as string) AS transaction_id",
        "cast(l_shipdate as date) AS txn_date",
        "cast(l_extendedprice as decimal(18,2)) AS amount",
        "l_partkey AS part_key",
        "l_suppkey AS supplier_key",
    )
