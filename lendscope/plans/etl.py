"""Landing tables to star schema.

Each load has a *checked* form: the cleansed rows with a ``reject_reason``
(NULL for a good row). The load takes the good rows, the reject report the
others.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lendscope.functions.credit import (
    anomaly_columns,
    is_npl,
    is_par30,
    monthly_installment,
    risk_tier,
    total_interest,
    z_score,
)
from lendscope.functions.dates import date_key, date_lit
from lendscope.functions.text import (
    TRUE_WORDS,
    blank_to_null,
    digits_and_dot,
    is_bad,
    region_id,
    title_case,
    to_type,
)
from lendscope.operators.dedup import chosen_per_key
from lendscope.operators.moments import moments, spread
from lendscope.operators.sizes import broadcast_if_small
from lendscope.operators.skew import key_parts, salted_join
from lendscope.sources.staging import MALFORMED
from lendscope.sources.workspace import stored

# Cities of the top region tier (lower case).
URBAN_CITIES = ("new york", "los angeles", "chicago", "houston", "london", "mumbai", "delhi")

OPEN_END = dt.date(9999, 12, 31)
LOADED_AT = "_ingested_at"


def _reason(*rules: tuple[str, Column]) -> Column:
    """The first rule that holds."""
    return F.coalesce(*[F.when(condition, F.lit(text)) for text, condition in rules])


def _any(*conditions: Column) -> Column:
    return reduce(lambda a, b: a | b, conditions)


def _no_key(column: str) -> Column:
    return F.col(column).isNull() | (F.col(column) == "")


REPEATED, NO_KEY = "repeated key", "no key"


def _chosen(raw: DataFrame, key: str, latest: bool = True) -> DataFrame:
    """One row of each trimmed key, the newest or the first, with the number of its landing rows;
    rows without a key stay, to be rejected."""
    return chosen_per_key(raw.withColumn(key, F.trim(key)), key, [LOADED_AT], latest, _no_key(key))


def accepted(checked: DataFrame) -> DataFrame:
    return checked.filter(F.col("reject_reason").isNull()).drop("reject_reason", "_rows")


def rejects(checked: DataFrame, step: str, row_id: str) -> DataFrame:
    """Dropped landing rows as (step, row_id, reason, rows): the chosen ones that a rule rejects, and all others of their key."""
    keyless = F.coalesce(F.col("reject_reason") == NO_KEY, F.lit(False))
    entry = lambda reason, rows: F.struct(reason.alias("reason"), rows.alias("rows"))
    own = F.when(F.col("reject_reason").isNotNull(), entry(F.col("reject_reason"), F.when(keyless, F.col("_rows")).otherwise(F.lit(1).cast("long"))))
    others = F.when((F.col("_rows") > 1) & ~keyless, entry(F.lit(REPEATED), F.col("_rows") - 1))
    found = checked.select(F.col(row_id).alias("row_id"), F.explode(F.filter(F.array(own, others), lambda e: e.isNotNull())).alias("e"))
    return found.groupBy(F.lit(step).alias("step_name"), "row_id", F.col("e.reason").alias("reason")).agg(F.sum("e.rows").alias("rows"))


def malformed(raw: DataFrame, step: str) -> DataFrame:
    """Landing lines that do not have the columns of their table, as ``rejects``; row_id is the line."""
    lines = raw.filter(F.col(MALFORMED).isNotNull())
    return lines.groupBy(F.lit(step).alias("step_name"), F.col(MALFORMED).alias("row_id"), F.lit("malformed row").alias("reason")).agg(F.count("*").alias("rows"))


def well_formed(raw: DataFrame) -> DataFrame:
    return raw.filter(F.col(MALFORMED).isNull()).drop(MALFORMED) if MALFORMED in raw.columns else raw


# --- dimensions --------------------------------------------------------------


def checked_regions(raw_customers: DataFrame) -> DataFrame:
    """A row per (city, state, country) found, with the number of landing rows.
    The first country by name stays, other ones and NULL parts are reasons."""
    parts = raw_customers.select(
        F.lower(F.trim("city")).alias("city"),
        F.lower(F.trim("state")).alias("state"),
        F.lower(F.trim("country")).alias("country"),
    )
    found = parts.groupBy("city", "state", "country").agg(F.count("*").alias("rows"))
    missing = _any(*[F.col(c).isNull() for c in ("city", "state", "country")])
    # NULL parts sort last, so they win against no country
    first = F.row_number().over(Window.partitionBy("city", "state").orderBy(F.asc_nulls_last("country"))) == 1
    tier = F.when(F.col("city").isin(*URBAN_CITIES), "URBAN").otherwise("SEMI-URBAN")
    return found.select(
        F.when(~missing, region_id(F.col("city"), F.col("state"))).alias("region_id"),
        title_case(F.col("city")).alias("city"),
        title_case(F.col("state")).alias("state"),
        title_case(F.col("country")).alias("country"),
        tier.alias("region_tier"),
        "rows",
        _reason(("missing value", missing), (REPEATED, ~first)).alias("reject_reason"),
    )


def regions(raw_customers: DataFrame) -> DataFrame:
    """One row per (city, state); of several countries the first by name."""
    return accepted(checked_regions(raw_customers)).drop("rows")


def region_rejects(checked: DataFrame) -> DataFrame:
    """As ``rejects``: rows with a NULL part, and of each region all rows but one."""
    bad = F.col("reject_reason")
    dropped = F.when(bad.isNull(), F.col("rows") - 1).otherwise(F.col("rows"))
    return (
        checked.select("region_id", F.coalesce(bad, F.lit(REPEATED)).alias("reason"), dropped.alias("rows"))
        .filter("rows > 0")
        .groupBy(F.lit("dim_region").alias("step_name"), F.col("region_id").alias("row_id"), "reason")
        .agg(F.sum("rows").alias("rows"))
    )


REGION_UPDATES = ["city", "state", "country", "region_tier"]


def checked_products(raw: DataFrame, strict: bool = False) -> DataFrame:
    newest = _chosen(raw.withColumn("product_code", F.upper("product_code")), "product_code")
    rates = ("interest_rate_min", "interest_rate_max")
    tenures = ("min_tenure_months", "max_tenure_months")
    return newest.select(
        "product_code",
        title_case(F.trim("product_name")).alias("product_name"),
        F.upper(F.trim("category")).alias("category"),
        title_case(F.trim("sub_category")).alias("sub_category"),
        *[to_type(F.col(c), "decimal(5,2)", strict).alias(c) for c in rates],
        *[to_type(F.col(c), "smallint", strict).alias(c) for c in tenures],
        F.coalesce(F.lower("is_secured").isin(*TRUE_WORDS), F.lit(False)).alias("is_secured"),
        blank_to_null(F.trim("collateral_type")).alias("collateral_type"),
        "_rows",
        _reason(
            (NO_KEY, _no_key("product_code")),
            ("bad number", _any(*[is_bad(F.col(c), "decimal(5,2)") for c in rates], *[is_bad(F.col(c), "smallint") for c in tenures])),
        ).alias("reject_reason"),
    )


PRODUCT_UPDATES = ["product_name", "category", "interest_rate_min", "interest_rate_max"]


def checked_customers(raw: DataFrame, strict: bool = False) -> DataFrame:
    """The newest row per trimmed id, cleansed; ``region_id`` is that of the
    same row, so a customer has one region."""
    newest = _chosen(raw, "customer_id")
    income = digits_and_dot(F.col("annual_income"))
    score = to_type(F.col("credit_score"), "smallint", strict)
    return newest.select(
        "customer_id",
        title_case(F.trim("first_name")).alias("first_name"),
        title_case(F.trim("last_name")).alias("last_name"),
        to_type(F.col("date_of_birth"), "date", strict).alias("date_of_birth"),
        F.upper(F.left(F.trim("gender"), F.lit(1))).alias("gender"),
        F.lower(F.trim("email")).alias("email"),
        F.trim("phone").alias("phone"),
        title_case(F.trim("employment_status")).alias("employment_status"),
        to_type(income, "decimal(15,2)", strict).alias("annual_income"),
        score.alias("credit_score"),
        risk_tier(score).alias("risk_tier"),
        region_id(F.col("city"), F.col("state")).alias("region_id"),
        "_rows",
        _reason(
            (NO_KEY, _no_key("customer_id")),
            ("bad date", is_bad(F.col("date_of_birth"), "date")),
            ("bad number", is_bad(income, "decimal(15,2)") | is_bad(F.col("credit_score"), "smallint")),
        ).alias("reject_reason"),
    )


# The tier is derived from the score, so it changes with it.
CUSTOMER_UPDATES = ["first_name", "last_name", "employment_status", "annual_income", "credit_score", "risk_tier"]
# The region follows the newest row too; loans of later batches take it from the published customer.
PLACED_UPDATES = [*CUSTOMER_UPDATES, "region_id"]


def open_version(as_of) -> dict[str, Column]:
    """Version columns of a row that is current from ``as_of`` on."""
    return {
        "effective_date": date_lit(as_of),
        "expiry_date": date_lit(OPEN_END),
        "is_current": F.lit(True),
    }


def scd2(target: DataFrame, source: DataFrame, key: str, tracked: list[str], as_of) -> DataFrame:
    """Versioned history: a changed row closes at ``as_of`` and a new one opens.

    ``target`` has the version columns of ``open_version``; closed versions
    pass through. Columns that the source lacks, such as a surrogate key, are NULL in new versions. Unchanged rows keep their version. One full outer join on
    the key, which is unique among current rows on both sides.
    """
    digest = lambda prefix: F.xxhash64(*[F.col(f"{prefix}.{c}") for c in tracked])
    day = date_lit(as_of)
    current = target.filter("is_current").select(F.struct("*").alias("old"), F.col(key).alias("_old_key"))
    incoming = source.select(F.struct("*").alias("new"), F.col(key).alias("_new_key"))
    both = current.join(incoming, F.col("_old_key") == F.col("_new_key"), "full_outer")
    # equal digests are confirmed column by column
    same = reduce(lambda a, b: a & b, [F.col(f"old.{c}").eqNullSafe(F.col(f"new.{c}")) for c in tracked])
    changed = F.col("_new_key").isNotNull() & (
        F.col("_old_key").isNull() | (digest("old") != digest("new")) | ~same
    )
    closes = changed & F.col("_old_key").isNotNull()
    payload = [c for c in target.columns if c not in ("effective_date", "expiry_date", "is_current")]
    incoming_columns = set(source.columns)

    def version(prefix: str, start: Column, end: Column, live: Column) -> Column:
        return F.struct(
            *[
                (F.col(f"{prefix}.{c}") if prefix == "old" or c in incoming_columns else F.lit(None)).cast(target.schema[c].dataType).alias(c)
                for c in payload
            ],
            start.alias("effective_date"),
            end.alias("expiry_date"),
            live.alias("is_current"),
        )

    kept = version(
        "old", F.col("old.effective_date"), F.when(closes, day).otherwise(F.col("old.expiry_date")), ~closes
    )
    opened = version("new", day, date_lit(OPEN_END), F.lit(True))
    versions = F.filter(
        F.array(F.when(F.col("_old_key").isNotNull(), kept), F.when(changed, opened)), lambda v: v.isNotNull()
    )
    live = both.select(F.explode(versions).alias("v")).select("v.*")
    return live.unionByName(target.filter(~F.col("is_current")).select(*live.columns))


# --- facts -------------------------------------------------------------------

LOAN_UPDATES = ["outstanding_balance", "loan_status", "days_past_due", "is_npl", "is_par30"]


def customer_places(dim_customer: DataFrame, dim_region: DataFrame) -> DataFrame:
    """customer_id -> customer_key and the region of the published customer,
    whichever batch brought the row."""
    keys = dim_customer.filter("is_current").select("customer_id", "customer_key", "region_id")
    places = dim_region.select("region_id", "region_key")
    return keys.join(places, "region_id", "left").select("customer_id", "customer_key", "region_key")


VERSIONS = "versions"


def customer_versions(dim_customer: DataFrame, dim_region: DataFrame) -> DataFrame:
    """customer_id -> all versions by their first day, newest first: (from_key, customer_key, region_key).

    One row per customer, so facts meet it as they do ``customer_places``. A customer's first
    version holds for all days before it as well: nothing older is known.
    """
    places = dim_region.select("region_id", "region_key")
    rows = dim_customer.select("customer_id", date_key(F.col("effective_date")).alias("from_key"), "customer_key", "region_id")
    listed = rows.join(places, "region_id", "left").groupBy("customer_id")
    return listed.agg(F.reverse(F.sort_array(F.collect_list(F.struct("from_key", "customer_key", "region_key")))).alias(VERSIONS))


def valid_version(day_key: Column) -> Column:
    """The version that is valid on a day; the newest where the day is not known."""
    versions = F.col(VERSIONS)
    held = F.filter(versions, lambda v: v["from_key"] <= day_key)
    return F.when(day_key.isNull(), F.get(versions, F.lit(0))).otherwise(F.coalesce(F.get(held, F.lit(0)), F.get(versions, F.size(versions) - 1)))


def _placed(facts: DataFrame, day_key: Column) -> DataFrame:
    """customer_key and region_key of the version that a fact meets, where versions were joined."""
    if VERSIONS not in facts.columns:
        return facts
    found = facts.withColumn("_version", valid_version(day_key))
    return found.withColumns({"customer_key": F.col("_version.customer_key"), "region_key": F.col("_version.region_key")}).drop("_version", VERSIONS)


def _row_counts(raw: DataFrame, key: str) -> DataFrame:
    """Rows per trimmed key, from a scan of that column alone."""
    return raw.groupBy(F.trim(key).alias(key)).agg(F.count("*").alias("n"))


def _named_products(raw: DataFrame, dim_product: DataFrame) -> DataFrame:
    """product_code -> product_key of the products that the loans name. These may be few of many, each
    with very many loans: then they are broadcast, and no loan is moved for its product."""
    named = raw.select(F.upper(F.trim("product_code")).alias("product_code")).distinct()
    found = stored(dim_product.select("product_code", "product_key").join(named, "product_code", "left_semi"), "named-products")
    return broadcast_if_small(found, found)


def checked_loans(
    raw: DataFrame,
    places: DataFrame,
    dim_product: DataFrame,
    strict: bool = False,
    default_region_key: int = 1,
) -> DataFrame:
    """``places`` as from ``customer_places``, or ``customer_versions``: then a loan meets the version valid on its issue date."""
    newest = _chosen(raw, "loan_id")
    text = newest.withColumns(
        {"customer_id": F.trim("customer_id"), "product_code": F.upper(F.trim("product_code"))}
    )
    numbers = {
        "principal_amount": "decimal(18,2)",
        "interest_rate": "decimal(5,2)",
        "tenure_months": "smallint",
        "outstanding_balance": "decimal(18,2)",
    }
    dates = {"issue_date": "issue_date_key", "maturity_date": "maturity_date_key"}
    # each text is converted once: a bad one is one that is not blank and has become NULL
    kinds = {**numbers, "days_past_due": "smallint", **dict.fromkeys(dates, "date")}
    converted = text.withColumns({f"_{c}": to_type(F.col(c), t, strict) for c, t in kinds.items()})
    bad = {c: blank_to_null(F.col(c)).isNotNull() & F.col(f"_{c}").isNull() for c in kinds}
    typed = converted.select(
        "loan_id",
        "customer_id",
        "product_code",
        *[date_key(F.col(f"_{c}")).alias(k) for c, k in dates.items()],
        *[F.col(f"_{c}").alias(c) for c in numbers],
        F.upper(F.trim("loan_status")).alias("loan_status"),
        F.coalesce("_days_past_due", F.lit(0).cast("smallint")).alias("days_past_due"),
        _any(*[bad[c] for c in kinds if c not in dates]).alias("_bad_number"),
        _any(*[bad[c] for c in dates]).alias("_bad_date"),
        "_rows",
    )
    parts = key_parts(_row_counts(raw, "customer_id"), "customer_id", "n")
    products = _named_products(raw, dim_product)
    known = salted_join(typed, places, "customer_id", parts, F.col("loan_id"), "left")
    joined = _placed(known, F.col("issue_date_key")).join(products, "product_code", "left")
    required = ("issue_date_key", "principal_amount", "interest_rate", "tenure_months", "loan_status")
    installment = monthly_installment(
        F.col("principal_amount"), F.col("interest_rate"), F.col("tenure_months")
    ).cast("decimal(15,2)")
    return joined.select(
        "loan_id",
        "customer_key",
        "product_key",
        F.coalesce("region_key", F.lit(default_region_key)).alias("region_key"),
        *dates.values(),
        *[c for c in numbers if c != "outstanding_balance"],
        installment.alias("monthly_installment"),
        "outstanding_balance",
        total_interest(installment, F.col("tenure_months"), F.col("principal_amount"))
        .cast("decimal(18,2)")
        .alias("total_interest"),
        "loan_status",
        "days_past_due",
        is_npl(F.col("days_past_due")).alias("is_npl"),
        is_par30(F.col("days_past_due")).alias("is_par30"),
        F.col("region_key").isNull().alias("region_defaulted"),
        "_rows",
        _reason(
            (NO_KEY, _no_key("loan_id")),
            ("unknown customer", F.col("customer_key").isNull()),
            ("unknown product", F.col("product_key").isNull()),
            ("bad number", F.col("_bad_number")),
            ("bad date", F.col("_bad_date")),
            ("missing value", _any(*[F.col(c).isNull() for c in required])),
        ).alias("reject_reason"),
    )


def amount_moments(raw: DataFrame, strict: bool = False) -> DataFrame:
    """Count, mean and spread of the amounts per trimmed customer id, of all landing rows."""
    amount = to_type(F.col("amount"), "decimal(18,2)", strict)
    return moments(raw.withColumn("customer_id", F.trim("customer_id")), "customer_id", amount)


def checked_transactions(
    raw: DataFrame,
    dim_customer: DataFrame,
    dim_region: DataFrame,
    fact_loan: DataFrame,
    strict: bool = False,
    baseline: DataFrame | None = None,
    versions: DataFrame | None = None,
) -> DataFrame:
    """Scored transactions. With ``versions`` (as from ``customer_versions``) a row meets the
    version valid on its day; its region is that of its own place.

    The baseline of a row's score is its customer's history, the scored row included.
    ``baseline`` has it as ``amount_moments``, of old batches and this one; then ``raw`` may be
    a batch by itself. Without one it is taken from ``raw``, which is then the accumulated
    landing table. Rows loaded before keep their score.
    """
    first = _chosen(raw, "transaction_id", latest=False)
    typed = first.select(
        "transaction_id",
        F.trim("customer_id").alias("customer_id"),
        F.trim("loan_id").alias("loan_id"),
        region_id(F.col("city"), F.col("state")).alias("region_id"),
        date_key(to_type(F.col("transaction_date"), "date", strict)).alias("txn_date_key"),
        F.upper(F.trim("transaction_type")).alias("transaction_type"),
        to_type(F.col("amount"), "decimal(18,2)", strict).alias("amount"),
        F.coalesce("currency", F.lit("USD")).alias("currency"),
        F.coalesce(to_type(F.col("fee_amount"), "decimal(10,2)", strict), F.lit(0).cast("decimal(10,2)")).alias("fee_amount"),
        (is_bad(F.col("amount"), "decimal(18,2)") | is_bad(F.col("fee_amount"), "decimal(10,2)")).alias("_bad_number"),
        is_bad(F.col("transaction_date"), "date").alias("_bad_date"),
        "_rows",
    )
    # written once: the salting and the join read it
    own = stored(amount_moments(raw, strict), "amount-moments")
    stats = own if baseline is None else baseline.join(own.select("customer_id"), "customer_id", "left_semi")
    stats = stats.select("customer_id", F.col("mean").alias("avg_amount"), spread().alias("sd_amount"))
    if versions is None:
        known = dim_customer.filter("is_current").select("customer_id", "customer_key")
    else:
        known = versions
    # unknown customers stay in, so that their rows are rejected, not lost
    profile = stats.join(known, "customer_id", "left")
    parts = key_parts(own, "customer_id", "rows")
    known = _placed(salted_join(typed, profile, "customer_id", parts, F.col("transaction_id"), "left"), F.col("txn_date_key"))
    joined = (
        known.drop("region_key")
        .join(dim_region.select("region_id", "region_key"), "region_id", "left")
        .join(fact_loan.select("loan_id", "loan_key"), "loan_id", "left")
    )
    scored = joined.withColumn("_z", z_score(F.col("amount"), F.col("avg_amount"), F.col("sd_amount")))
    required = ("txn_date_key", "transaction_type", "amount")
    flags = anomaly_columns(F.col("_z"))
    return scored.select(
        "transaction_id",
        "customer_key",
        "region_key",
        "txn_date_key",
        "loan_key",
        "transaction_type",
        "amount",
        "currency",
        "fee_amount",
        *[column.alias(name) for name, column in flags.items()],
        "_rows",
        _reason(
            (NO_KEY, _no_key("transaction_id")),
            ("unknown customer", F.col("customer_key").isNull()),
            ("unknown region", F.col("region_key").isNull()),
            ("bad number", F.col("_bad_number")),
            ("bad date", F.col("_bad_date")),
            ("missing value", _any(*[F.col(c).isNull() for c in required])),
        ).alias("reject_reason"),
    )
