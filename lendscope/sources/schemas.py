"""Column layouts of the landing and star tables."""

from __future__ import annotations

from pyspark.sql.types import (
    BooleanType,
    DateType,
    DecimalType,
    IntegerType,
    LongType,
    ShortType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

# Business columns of the four landing tables, in file order.
STAGING_COLUMNS = {
    "raw_customers": (
        "customer_id", "first_name", "last_name", "date_of_birth", "gender", "email", "phone",
        "employment_status", "annual_income", "credit_score", "city", "state", "country",
    ),
    "raw_loans": (
        "loan_id", "customer_id", "product_code", "issue_date", "maturity_date", "principal_amount",
        "interest_rate", "tenure_months", "loan_status", "days_past_due", "outstanding_balance",
    ),
    "raw_transactions": (
        "transaction_id", "customer_id", "loan_id", "transaction_date", "transaction_type", "amount",
        "currency", "fee_amount", "city", "state", "country",
    ),
    "raw_loan_products": (
        "product_code", "product_name", "category", "sub_category", "interest_rate_min",
        "interest_rate_max", "min_tenure_months", "max_tenure_months", "is_secured", "collateral_type",
    ),
}


def staging_schema(table: str) -> StructType:
    """Landing tables are all text; conversion is the loaders' work."""
    return StructType([StructField(c, StringType()) for c in STAGING_COLUMNS[table]])


RUN_LOG = StructType(
    [
        StructField("run_id", StringType()),
        StructField("run_ts", TimestampType()),
        StructField("step_name", StringType()),
        StructField("rows_extracted", LongType()),
        StructField("rows_rejected", LongType()),
        StructField("rows_loaded", LongType()),
        StructField("rows_defaulted", LongType()),
        StructField("duration_ms", LongType()),
        StructField("status", StringType()),
        StructField("error_msg", StringType()),
    ]
)

DIM_REGION = StructType(
    [
        StructField("region_key", IntegerType()),
        StructField("region_id", StringType()),
        StructField("city", StringType()),
        StructField("state", StringType()),
        StructField("country", StringType()),
        StructField("country_code", StringType()),
        StructField("latitude", DecimalType(9, 6)),
        StructField("longitude", DecimalType(9, 6)),
        StructField("region_tier", StringType()),
    ]
)

DIM_PRODUCT = StructType(
    [
        StructField("product_key", IntegerType()),
        StructField("product_code", StringType()),
        StructField("product_name", StringType()),
        StructField("category", StringType()),
        StructField("sub_category", StringType()),
        StructField("interest_rate_min", DecimalType(5, 2)),
        StructField("interest_rate_max", DecimalType(5, 2)),
        StructField("min_tenure_months", ShortType()),
        StructField("max_tenure_months", ShortType()),
        StructField("is_secured", BooleanType()),
        StructField("collateral_type", StringType()),
    ]
)

DIM_CUSTOMER = StructType(
    [
        StructField("customer_key", LongType()),
        StructField("customer_id", StringType()),
        StructField("first_name", StringType()),
        StructField("last_name", StringType()),
        StructField("date_of_birth", DateType()),
        StructField("gender", StringType()),
        StructField("email", StringType()),
        StructField("phone", StringType()),
        StructField("employment_status", StringType()),
        StructField("annual_income", DecimalType(15, 2)),
        StructField("credit_score", ShortType()),
        StructField("risk_tier", StringType()),
        StructField("region_id", StringType()),
        StructField("effective_date", DateType()),
        StructField("expiry_date", DateType()),
        StructField("is_current", BooleanType()),
        StructField("created_at", TimestampType()),
        StructField("updated_at", TimestampType()),
    ]
)

FACT_LOAN = StructType(
    [
        StructField("loan_key", LongType()),
        StructField("loan_id", StringType()),
        StructField("customer_key", LongType()),
        StructField("product_key", IntegerType()),
        StructField("region_key", IntegerType()),
        StructField("issue_date_key", IntegerType()),
        StructField("maturity_date_key", IntegerType()),
        StructField("principal_amount", DecimalType(18, 2)),
        StructField("interest_rate", DecimalType(5, 2)),
        StructField("tenure_months", ShortType()),
        StructField("monthly_installment", DecimalType(15, 2)),
        StructField("outstanding_balance", DecimalType(18, 2)),
        StructField("total_interest", DecimalType(18, 2)),
        StructField("loan_status", StringType()),
        StructField("days_past_due", ShortType()),
        StructField("is_npl", BooleanType()),
        StructField("is_par30", BooleanType()),
        StructField("created_at", TimestampType()),
        StructField("updated_at", TimestampType()),
    ]
)

FACT_TRANSACTION = StructType(
    [
        StructField("txn_key", LongType()),
        StructField("transaction_id", StringType()),
        StructField("customer_key", LongType()),
        StructField("region_key", IntegerType()),
        StructField("txn_date_key", IntegerType()),
        StructField("loan_key", LongType()),
        StructField("transaction_type", StringType()),
        StructField("amount", DecimalType(18, 2)),
        StructField("currency", StringType()),
        StructField("fee_amount", DecimalType(10, 2)),
        StructField("is_anomaly", BooleanType()),
        StructField("anomaly_score", DecimalType(5, 4)),
        StructField("anomaly_reason", StringType()),
        StructField("created_at", TimestampType()),
    ]
)

DIM_DATE = StructType(
    [
        StructField("date_key", IntegerType()),
        StructField("full_date", DateType()),
        StructField("day_of_week", ShortType()),
        StructField("day_name", StringType()),
        StructField("day_of_month", ShortType()),
        StructField("day_of_year", ShortType()),
        StructField("week_of_year", ShortType()),
        StructField("month_num", ShortType()),
        StructField("month_name", StringType()),
        StructField("quarter", ShortType()),
        StructField("year", ShortType()),
        StructField("is_weekend", BooleanType()),
        StructField("is_holiday", BooleanType()),
        StructField("fiscal_period", StringType()),
    ]
)

# The published tables and their columns.
WAREHOUSE = {
    "dim_date": DIM_DATE,
    "dim_region": DIM_REGION,
    "dim_loan_product": DIM_PRODUCT,
    "dim_customer": DIM_CUSTOMER,
    "fact_loan": FACT_LOAN,
    "fact_transaction": FACT_TRANSACTION,
}

# Declared keys, references (column, table, column) and required
# columns of the published tables.
UNIQUE = {
    "dim_date": ("date_key", "full_date"),
    "dim_region": ("region_key", "region_id"),
    "dim_loan_product": ("product_key", "product_code"),
    "dim_customer": ("customer_key",),
    "fact_loan": ("loan_key", "loan_id"),
    "fact_transaction": ("txn_key", "transaction_id"),
}
REFERENCES = {
    "fact_loan": (
        ("customer_key", "dim_customer", "customer_key"), ("product_key", "dim_loan_product", "product_key"),
        ("region_key", "dim_region", "region_key"), ("issue_date_key", "dim_date", "date_key"),
    ),
    "fact_transaction": (
        ("customer_key", "dim_customer", "customer_key"), ("region_key", "dim_region", "region_key"),
        ("txn_date_key", "dim_date", "date_key"), ("loan_key", "fact_loan", "loan_key"),
    ),
}
REQUIRED = {
    "dim_customer": ("customer_id", "is_current"),
    "fact_loan": (
        "loan_id", "customer_key", "product_key", "region_key", "issue_date_key", "principal_amount", "interest_rate",
        "tenure_months", "loan_status", "days_past_due", "is_npl", "is_par30",
    ),
    "fact_transaction": ("transaction_id", "customer_key", "region_key", "txn_date_key", "transaction_type", "amount", "is_anomaly"),
}
