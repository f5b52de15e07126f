"""Load-tier texts."""

from __future__ import annotations

from lendscope.oracle.kpi_texts import SNAPSHOT
from lendscope.oracle.views import AS_OF, dbl, rnd, with_views
from lendscope.sources.schemas import REFERENCES, REQUIRED, STAGING_COLUMNS, UNIQUE


def title(x: str) -> str:
    return (
        f"array_to_string(list_transform(regexp_extract_all({x}, '([\\p{{L}}\\p{{N}}]+|[^\\p{{L}}\\p{{N}}])'), "
        "lambda p: upper(p[1]) || lower(p[2:])), '')"
    )


def key(business: str, name: str, type_name: str = "BIGINT") -> str:
    return f"CAST(row_number() OVER (ORDER BY left(md5({business}), 4), {business}) AS {type_name}) AS {name}"


def rid(city: str, state: str) -> str:
    return f"md5(lower(trim({city})) || '|' || lower(trim({state})))"


TIER = """CASE WHEN credit_score >= 750 THEN 'LOW' WHEN credit_score >= 650 THEN 'MEDIUM'
  WHEN credit_score >= 550 THEN 'HIGH' ELSE 'CRITICAL' END"""

REGIONS = f"""regions AS (
  SELECT region_id, {title('c')} AS city, {title('s')} AS state, {title('min(k)')} AS country,
         CASE WHEN c IN ('new york','los angeles','chicago','houston','london','mumbai','delhi') THEN 'URBAN' ELSE 'SEMI-URBAN' END AS region_tier
  FROM (SELECT lower(trim(city)) AS c, lower(trim(state)) AS s, lower(trim(country)) AS k, {rid('city', 'state')} AS region_id
        FROM r_customers WHERE city IS NOT NULL AND state IS NOT NULL AND country IS NOT NULL)
  GROUP BY region_id, c, s)"""

PRODUCTS = f"""products AS (
  SELECT upper(trim(product_code)) AS product_code, {title('trim(product_name)')} AS product_name, upper(trim(category)) AS category,
         {title('trim(sub_category)')} AS sub_category, CAST(nullif(interest_rate_min, '') AS DECIMAL(5,2)) AS interest_rate_min,
         CAST(nullif(interest_rate_max, '') AS DECIMAL(5,2)) AS interest_rate_max,
         CAST(nullif(min_tenure_months, '') AS INT) AS min_tenure_months, CAST(nullif(max_tenure_months, '') AS INT) AS max_tenure_months,
         coalesce(lower(is_secured) IN ('true', 'yes', '1'), FALSE) AS is_secured, nullif(trim(collateral_type), '') AS collateral_type
  FROM r_products)"""


def customers(name: str, where: str = "TRUE") -> str:
    return f"""{name} AS (
  SELECT *, {TIER} AS risk_tier FROM (
    SELECT trim(customer_id) AS customer_id, {title('trim(first_name)')} AS first_name, {title('trim(last_name)')} AS last_name,
           CAST(nullif(date_of_birth, '') AS DATE) AS date_of_birth, upper(left(trim(gender), 1)) AS gender, lower(trim(email)) AS email,
           trim(phone) AS phone, {title('trim(employment_status)')} AS employment_status,
           CAST(nullif(regexp_replace(annual_income, '[^0-9.]', '', 'g'), '') AS DECIMAL(15,2)) AS annual_income,
           CAST(nullif(credit_score, '') AS INT) AS credit_score, {rid('city', 'state')} AS region_id,
           row_number() OVER (PARTITION BY trim(customer_id) ORDER BY ingested_at DESC) AS rn
    FROM r_customers WHERE trim(customer_id) <> '' AND {where}) WHERE rn = 1)"""


FIRST_DAY = "ingested_at < TIMESTAMP '2001-07-02'"
CUSTOMERS = customers("customers")

KEYED = f"""{REGIONS}, {PRODUCTS}, {CUSTOMERS},
dim_region AS (SELECT {key('region_id', 'region_key', 'INT')}, * FROM regions),
dim_product AS (SELECT {key('product_code', 'product_key', 'INT')}, * FROM products),
dim_customer AS (SELECT {key('customer_id', 'customer_key')}, * FROM customers)"""


def date_key(x: str) -> str:
    return f"CAST(strftime(CAST(nullif({x}, '') AS DATE), '%Y%m%d') AS INT)"


EMI = rnd(
    """CASE WHEN interest_rate > 0 AND tenure_months > 0
  THEN CAST(principal_amount AS DOUBLE) * (CAST(interest_rate AS DOUBLE) / 1200) * pow(1 + CAST(interest_rate AS DOUBLE) / 1200, tenure_months)
       / (pow(1 + CAST(interest_rate AS DOUBLE) / 1200, tenure_months) - 1)
  ELSE CAST(principal_amount AS DOUBLE) / nullif(tenure_months, 0) END""", 2)

LOANS = f"""loan_rows AS (
  SELECT trim(l.loan_id) AS loan_id, c.customer_key, p.product_key, coalesce(r.region_key, 1) AS region_key,
         {date_key('l.issue_date')} AS issue_date_key, {date_key('l.maturity_date')} AS maturity_date_key,
         CAST(nullif(l.principal_amount, '') AS DECIMAL(18,2)) AS principal_amount, CAST(nullif(l.interest_rate, '') AS DECIMAL(5,2)) AS interest_rate,
         CAST(nullif(l.tenure_months, '') AS INT) AS tenure_months, CAST(nullif(l.outstanding_balance, '') AS DECIMAL(18,2)) AS outstanding_balance,
         upper(trim(l.loan_status)) AS loan_status, coalesce(CAST(nullif(l.days_past_due, '') AS INT), 0) AS days_past_due
  FROM r_loans l JOIN dim_customer c ON c.customer_id = trim(l.customer_id)
  JOIN dim_product p ON p.product_code = upper(trim(l.product_code)) LEFT JOIN dim_region r ON r.region_id = c.region_id),
loan_emi AS (SELECT *, {EMI} AS monthly_installment, days_past_due > 90 AS is_npl, days_past_due BETWEEN 30 AND 89 AS is_par30 FROM loan_rows),
fact_loan AS (SELECT {key('loan_id', 'loan_key')}, *, {rnd('monthly_installment * tenure_months - CAST(principal_amount AS DOUBLE)', 2)} AS total_interest FROM loan_emi)"""

TXNS = f"""stats AS (SELECT trim(customer_id) AS cid, avg(CAST(nullif(amount, '') AS DOUBLE)) AS av, stddev_samp(CAST(nullif(amount, '') AS DOUBLE)) AS sd
          FROM r_transactions GROUP BY 1),
txn_rows AS (
  SELECT trim(t.transaction_id) AS transaction_id, c.customer_key, r.region_key, {date_key('t.transaction_date')} AS txn_date_key, f.loan_key,
         upper(trim(t.transaction_type)) AS transaction_type, CAST(nullif(t.amount, '') AS DECIMAL(18,2)) AS amount,
         coalesce(t.currency, 'USD') AS currency, coalesce(CAST(nullif(t.fee_amount, '') AS DECIMAL(10,2)), 0) AS fee_amount,
         CASE WHEN sd > 0 THEN abs(CAST(nullif(t.amount, '') AS DOUBLE) - av) / sd ELSE 0 END AS z
  FROM r_transactions t JOIN dim_customer c ON c.customer_id = trim(t.customer_id)
  JOIN dim_region r ON r.region_id = {rid('t.city', 't.state')}
  LEFT JOIN fact_loan f ON f.loan_id = trim(t.loan_id) LEFT JOIN stats ON cid = trim(t.customer_id)),
fact_txn AS (SELECT {key('transaction_id', 'txn_key')}, *, z > 3.0 AS is_anomaly, CAST(round(1 - exp(-z / 3.0), 4) AS DECIMAL(5,4)) AS anomaly_score,
       CASE WHEN z > 3.0 THEN 'High-value outlier (Z > 3σ)' END AS anomaly_reason FROM txn_rows)"""

PRODUCT_COLUMNS = f"""product_key, product_code, product_name, category, sub_category, {dbl('interest_rate_min')} AS interest_rate_min,
  {dbl('interest_rate_max')} AS interest_rate_max, min_tenure_months, max_tenure_months, is_secured, collateral_type"""

CUSTOMER_COLUMNS = f"""customer_id, first_name, last_name, date_of_birth, gender, email, phone, employment_status,
  {dbl('annual_income')} AS annual_income, credit_score, risk_tier"""

RAW = ("r_customers", "r_products")
FACTS = (*RAW, "r_loans", "r_transactions")

SPAN = """span AS (SELECT min(d) AS lo, max(d) AS hi FROM (SELECT CAST(issue_date AS DATE) AS d FROM r_loans
  UNION ALL SELECT CAST(transaction_date AS DATE) FROM r_transactions))"""

RULES = ", ".join(
    [f"('{t}', 'unique({c})')" for t, columns in UNIQUE.items() for c in columns]
    + [f"('{t}', '{c} -> {parent}.{to}')" for t, links in REFERENCES.items() for c, parent, to in links]
    + [f"('{t}', 'not null {c}')" for t, columns in REQUIRED.items() for c in columns]
)

LINES = """lines AS (SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS transaction_id, CAST(l_shipdate AS DATE) AS txn_date,
         CAST(l_extendedprice AS DECIMAL(18,2)) AS amount, l_partkey AS part_key, l_suppkey AS supplier_key FROM lineitem)"""


def first_line(where: str) -> str:
    return f"""SELECT transaction_id, txn_date, {dbl('amount')} AS amount, part_key, supplier_key FROM (
  SELECT *, row_number() OVER (PARTITION BY transaction_id ORDER BY txn_date, amount, part_key, supplier_key) AS rn
  FROM lines WHERE {where}) WHERE rn = 1"""


def landed(view: str, table: str, broken: str | None = None) -> str:
    columns = [f"{c} || chr(10) || '\"jr\", ' || {c} AS {c}" if c == broken else c for c in STAGING_COLUMNS[table]]
    return with_views(f"SELECT {', '.join(columns)} FROM {view}", view)


DAYS = """days AS (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS d FROM span)
SELECT CAST(strftime(d, '%Y%m%d') AS INT) AS date_key, d AS full_date, CAST(isodow(d) AS INT) AS day_of_week, dayname(d) AS day_name,
       CAST(day(d) AS INT) AS day_of_month, CAST(dayofyear(d) AS INT) AS day_of_year, CAST(weekofyear(d) AS INT) AS week_of_year,
       CAST(month(d) AS INT) AS month_num, monthname(d) AS month_name, CAST(quarter(d) AS INT) AS quarter, CAST(year(d) AS INT) AS year,
       isodow(d) IN (6, 7) AS is_weekend, FALSE AS is_holiday, 'FY' || strftime(d, '%y') || 'Q' || CAST(quarter(d) AS VARCHAR) AS fiscal_period
FROM days"""

TEXTS = {
    "read_staging": landed("r_customers", "raw_customers"),
    "read_staging_loans": landed("r_loans", "raw_loans"),
    "read_staging_malformed": with_views("""SELECT loan_id, NULL AS malformed FROM r_loans
UNION ALL SELECT NULL, 'broken,' || loan_id FROM r_loans WHERE CAST(right(loan_id, 6) AS INT) % 97 = 0""", "r_loans"),
    "read_staging_transactions": landed("r_transactions", "raw_transactions"),
    "read_staging_products": landed("r_products", "raw_loan_products"),
    "read_staging_line_breaks": landed("r_customers", "raw_customers", "last_name"),
    "dim_date": with_views(f"""WITH span AS (SELECT min(d) AS lo, max(d) AS hi FROM (SELECT issue_date AS d FROM w_loan
  UNION ALL SELECT CAST(ts AS DATE) - 8219 FROM events)),
{DAYS}""", "w_loan"),
    "warehouse_dim_date": with_views(f"WITH {SPAN}, {DAYS}", "r_loans", "r_transactions"),
    "etl_dim_region": with_views(
        f"WITH {REGIONS} SELECT {key('region_id', 'region_key', 'INT')}, * FROM regions", "r_customers"),
    "etl_dim_loan_product": with_views(
        f"WITH {PRODUCTS}, dim_product AS (SELECT {key('product_code', 'product_key', 'INT')}, * FROM products) "
        f"SELECT {PRODUCT_COLUMNS} FROM dim_product", "r_products"),
    "etl_dim_customer": with_views(
        f"WITH {CUSTOMERS}, dim_customer AS (SELECT {key('customer_id', 'customer_key')}, * FROM customers) "
        f"SELECT customer_key, {CUSTOMER_COLUMNS}, {AS_OF} AS effective_date, DATE '9999-12-31' AS expiry_date, "
        "TRUE AS is_current FROM dim_customer", "r_customers"),
    "etl_dim_customer_scd2": with_views(f"""WITH {customers('old', FIRST_DAY)}, {customers('fresh')},
j AS (SELECT o.customer_id, o.employment_status AS oe, o.annual_income AS oi, o.credit_score AS oc, o.risk_tier AS ot,
             n.employment_status AS ne, n.annual_income AS ni, n.credit_score AS nc, n.risk_tier AS nt,
             (o.employment_status, o.annual_income, o.credit_score, o.risk_tier)
             IS DISTINCT FROM (n.employment_status, n.annual_income, n.credit_score, n.risk_tier) AS changed
      FROM old o JOIN fresh n ON n.customer_id = o.customer_id)
SELECT customer_id, oe AS employment_status, {dbl('oi')} AS annual_income, oc AS credit_score, ot AS risk_tier, DATE '2001-07-01' AS effective_date,
       CASE WHEN changed THEN DATE '2001-07-02' ELSE DATE '9999-12-31' END AS expiry_date, NOT changed AS is_current FROM j
UNION ALL SELECT customer_id, ne, {dbl('ni')}, nc, nt, DATE '2001-07-02', DATE '9999-12-31', TRUE FROM j WHERE changed""", "r_customers"),
    "etl_fact_loan": with_views(f"""WITH {KEYED}, {LOANS}
SELECT loan_key, loan_id, customer_key, product_key, region_key, issue_date_key, maturity_date_key, {dbl('principal_amount')} AS principal_amount,
       {dbl('interest_rate')} AS interest_rate, tenure_months, monthly_installment, {dbl('outstanding_balance')} AS outstanding_balance,
       total_interest, loan_status, days_past_due, is_npl, is_par30 FROM fact_loan""", *RAW, "r_loans"),
    "etl_fact_transaction": with_views(f"""WITH {KEYED}, {LOANS}, {TXNS}
SELECT txn_key, transaction_id, customer_key, region_key, txn_date_key, loan_key, transaction_type, {dbl('amount')} AS amount, currency,
       {dbl('fee_amount')} AS fee_amount, is_anomaly, {dbl('anomaly_score')} AS anomaly_score, anomaly_reason FROM fact_txn""", *FACTS),
    "etl_rejects": with_views(f"""WITH {KEYED}
SELECT 'dim_region' AS step_name, {rid('city', 'state')} AS row_id, 'repeated key' AS reason, count(*) - 1 AS rows FROM r_customers GROUP BY 2 HAVING count(*) > 1
UNION ALL SELECT 'dim_customer', trim(customer_id) AS k, 'repeated key', count(*) - 1 FROM r_customers GROUP BY k HAVING count(*) > 1
UNION ALL
SELECT 'fact_loan', trim(l.loan_id),
       CASE WHEN c.customer_id IS NULL THEN 'unknown customer' ELSE 'unknown product' END, 1
FROM r_loans l LEFT JOIN customers c ON c.customer_id = trim(l.customer_id) LEFT JOIN products p ON p.product_code = upper(trim(l.product_code))
WHERE c.customer_id IS NULL OR p.product_code IS NULL
UNION ALL
SELECT 'fact_transaction', trim(t.transaction_id), CASE WHEN c.customer_id IS NULL THEN 'unknown customer' ELSE 'unknown region' END, 1
FROM r_transactions t LEFT JOIN customers c ON c.customer_id = trim(t.customer_id) LEFT JOIN regions r ON r.region_id = {rid('t.city', 't.state')}
WHERE c.customer_id IS NULL OR r.region_id IS NULL""", *FACTS),
    "etl_run_log": with_views(f"""WITH {KEYED}, {LOANS}, {TXNS}, {SPAN}, landed(step_name, rows_extracted, rows_loaded) AS (
SELECT 'dim_region', (SELECT count(*) FROM r_customers), (SELECT count(*) FROM regions)
UNION ALL SELECT 'dim_loan_product', (SELECT count(*) FROM r_products), (SELECT count(*) FROM products)
UNION ALL SELECT 'dim_customer', (SELECT count(*) FROM r_customers), (SELECT count(*) FROM customers)
UNION ALL SELECT 'fact_loan', (SELECT count(*) FROM r_loans), (SELECT count(*) FROM fact_loan)
UNION ALL SELECT 'fact_transaction', (SELECT count(*) FROM r_transactions), (SELECT count(*) FROM fact_txn)
UNION ALL SELECT 'dim_date', (SELECT hi - lo + 1 FROM span), (SELECT hi - lo + 1 FROM span))
SELECT step_name, rows_extracted, rows_extracted - rows_loaded AS rows_rejected, rows_loaded, 'SUCCESS' AS status FROM landed""", *FACTS),
    "warehouse_two_days": with_views(f"""WITH {KEYED}, {LOANS}
SELECT f.loan_id, c.customer_id, c.credit_score, p.product_code, r.city, r.state, days_past_due, loan_status
FROM fact_loan f JOIN dim_customer c USING (customer_key) JOIN dim_product p USING (product_key) JOIN dim_region r ON r.region_key = f.region_key""", *RAW, "r_loans"),
    "warehouse_versions": with_views(f"""WITH {KEYED}, {LOANS}, {customers('first_rows', FIRST_DAY)},
v AS (SELECT c.customer_key, c.customer_id, c.annual_income AS new_income, o.annual_income AS old_income, c.annual_income IS DISTINCT FROM o.annual_income AS changed
      FROM dim_customer c JOIN first_rows o USING (customer_id)),
l AS (SELECT loan_id, customer_key, CAST(strptime(CAST(issue_date_key AS VARCHAR), '%Y%m%d') AS DATE) AS issue_date FROM fact_loan)
SELECT loan_id, customer_id, issue_date, {dbl("CASE WHEN issue_date >= DATE '1998-01-01' THEN new_income ELSE old_income END")} AS annual_income,
       NOT changed OR issue_date >= DATE '1998-01-01' AS is_current
FROM l JOIN v USING (customer_key)""", *RAW, "r_loans"),
    "warehouse_deliveries": with_views(f"""WITH {KEYED}, {LOANS}, t AS (SELECT *, CAST(right(trim(transaction_id), 1) AS INT) % 2 = 1 AS odd FROM r_transactions),
h AS (SELECT true AS odd, trim(customer_id) AS cid, CAST(nullif(amount, '') AS DOUBLE) AS v FROM t WHERE t.odd
      UNION ALL SELECT false, trim(customer_id), CAST(nullif(amount, '') AS DOUBLE) FROM t),
s AS (SELECT odd, cid, avg(v) AS av, stddev_samp(v) AS sd FROM h GROUP BY ALL),
z AS (SELECT trim(t.transaction_id) AS transaction_id, CASE WHEN sd > 0 THEN abs(CAST(nullif(t.amount, '') AS DOUBLE) - av) / sd ELSE 0 END AS z
      FROM t JOIN dim_customer c ON c.customer_id = trim(t.customer_id) JOIN dim_region r ON r.region_id = {rid('t.city', 't.state')}
      LEFT JOIN s ON cid = trim(t.customer_id) AND s.odd = t.odd)
SELECT transaction_id, z > 3.0 AS is_anomaly, {dbl('CAST(round(1 - exp(-z / 3.0), 4) AS DECIMAL(5,4))')} AS anomaly_score,
       CASE WHEN z > 3.0 THEN 'High-value outlier (Z > 3σ)' END AS anomaly_reason FROM z""", *FACTS),
    "warehouse_rules": with_views(f"""WITH {KEYED}, {LOANS}, {TXNS}, {SPAN},
n AS (SELECT (SELECT hi - lo + 1 FROM span) AS dim_date, (SELECT count(*) FROM dim_region) AS dim_region, (SELECT count(*) FROM dim_product) AS dim_loan_product,
             (SELECT count(*) FROM dim_customer) AS dim_customer, (SELECT count(*) FROM fact_loan) AS fact_loan, (SELECT count(*) FROM fact_txn) AS fact_transaction),
sizes AS (UNPIVOT n ON COLUMNS(*) INTO NAME table_name VALUE rows_checked)
SELECT table_name, rule, rows_checked, 0 AS violations FROM sizes JOIN (VALUES {RULES}) v(table_name, rule) USING (table_name)""", *FACTS),
    "upsert_region": with_views(f"""WITH {REGIONS}, target AS (SELECT * FROM w_region WHERE region_tier = 'URBAN'),
fresh AS (SELECT * FROM regions WHERE region_id NOT IN (SELECT region_id FROM target))
SELECT t.region_key, t.region_id, coalesce(s.city, upper(t.city)) AS city, coalesce(s.state, upper(t.state)) AS state,
       coalesce(s.country, t.country) AS country, coalesce(s.region_tier, t.region_tier) AS region_tier
FROM target t LEFT JOIN regions s ON s.region_id = t.region_id
UNION ALL SELECT CAST((SELECT max(region_key) FROM target) + row_number() OVER (ORDER BY left(md5(region_id), 4), region_id) AS INT), * FROM fresh""",
        "r_customers", "w_region"),
    "upsert_product": with_views(f"""WITH {PRODUCTS}, target AS (SELECT {key('product_code', 'product_key', 'INT')}, * FROM products WHERE is_secured),
fresh AS (SELECT * FROM products WHERE NOT is_secured),
merged AS (SELECT product_key, product_code, product_name, category, 'Old Rate' AS sub_category, interest_rate_min, interest_rate_max,
       1 AS min_tenure_months, max_tenure_months, is_secured, collateral_type FROM target
UNION ALL SELECT (SELECT max(product_key) FROM target) + row_number() OVER (ORDER BY left(md5(product_code), 4), product_code), * FROM fresh)
SELECT {PRODUCT_COLUMNS.replace('product_key,', 'CAST(product_key AS INT) AS product_key,', 1)} FROM merged""", "r_products"),
    "upsert_customer": with_views(f"""WITH {customers('old', FIRST_DAY)}, {customers('fresh')}
SELECT f.customer_id, f.first_name, f.last_name, f.date_of_birth, f.gender,
       CASE WHEN o.date_of_birth IS NOT NULL THEN 'old@mail.test' ELSE f.email END AS email, f.phone, f.employment_status,
       {dbl('f.annual_income')} AS annual_income, f.credit_score, f.risk_tier, DATE '2001-07-02' AS updated_on
FROM fresh f JOIN old o ON o.customer_id = f.customer_id""", "r_customers"),
    "upsert_loan": with_views(f"""SELECT l.loan_id, customer_key, product_key, region_key, issue_date, {dbl('principal_amount')} AS principal_amount,
       {dbl('interest_rate')} AS interest_rate, tenure_months,
       {dbl('CAST(l.outstanding_balance * 0.99 AS DECIMAL(18,2))')} AS outstanding_balance, new_status AS loan_status,
       CAST(new_dpd AS INT) AS days_past_due, new_dpd > 90 AS is_npl, new_dpd BETWEEN 30 AND 89 AS is_par30
FROM w_loan l JOIN w_loan_day2 d ON d.loan_key = l.loan_key""", "w_loan", "w_loan_day2"),
    "insert_ignore": f"""WITH {LINES}, loaded AS ({first_line("txn_date < DATE '1998-01-01'")}), fresh AS ({first_line('TRUE')})
SELECT * FROM loaded UNION ALL SELECT * FROM fresh WHERE transaction_id NOT IN (SELECT transaction_id FROM loaded)""",
    "dq_unique": with_views(f"""WITH {LINES}
SELECT 'region' AS table_name, 'unique(region_id)' AS rule, region_id AS key, count(*) AS rows FROM w_region GROUP BY region_id HAVING count(*) > 1
UNION ALL SELECT 'region', 'unique(country,state)', country || '|' || state, count(*) FROM w_region GROUP BY country, state HAVING count(*) > 1
UNION ALL SELECT 'customer', 'unique(customer_id)', customer_id, count(*) FROM w_customer GROUP BY customer_id HAVING count(*) > 1
UNION ALL SELECT 'raw_customers', 'unique(customer_id)', customer_id, count(*) FROM r_customers GROUP BY customer_id HAVING count(*) > 1
UNION ALL SELECT 'raw_loans', 'unique(loan_id)', loan_id, count(*) FROM r_loans GROUP BY loan_id HAVING count(*) > 1
UNION ALL SELECT 'line_transactions', 'unique(transaction_id)', transaction_id, count(*) FROM lines GROUP BY transaction_id HAVING count(*) > 1""",
        "w_region", "w_customer", "r_customers", "r_loans"),
    "dq_fk": with_views("""SELECT 'raw_loans' AS table_name, 'customer_id -> customer.customer_id' AS rule, trim(customer_id) AS key, count(*) AS rows
FROM r_loans WHERE trim(customer_id) NOT IN (SELECT customer_id FROM w_customer) GROUP BY ALL
UNION ALL SELECT 'raw_loans', 'product_code -> product.product_code', upper(trim(product_code)) AS k, count(*)
FROM r_loans WHERE upper(trim(product_code)) NOT IN (SELECT product_code FROM w_product) GROUP BY k
UNION ALL SELECT 'raw_transactions', 'place -> region.place', city || '|' || state AS k, count(*)
FROM r_transactions WHERE city || '|' || state NOT IN (SELECT city || '|' || state FROM w_region) GROUP BY k
UNION ALL SELECT 'raw_transactions', 'loan_id -> loan.loan_id', loan_id, count(*)
FROM r_transactions WHERE loan_id NOT IN (SELECT loan_id FROM w_loan) GROUP BY loan_id""",
        "r_loans", "r_transactions", "w_customer", "w_product", "w_region", "w_loan"),
    "dq_notnull": with_views("""SELECT * FROM (
SELECT 'customer' AS table_name, 'not null' AS rule, 'customer_id' AS key, count(*) FILTER (WHERE customer_id IS NULL) AS rows FROM w_customer
UNION ALL SELECT 'customer', 'not null', 'credit_score', count(*) FILTER (WHERE credit_score IS NULL) FROM w_customer
UNION ALL SELECT 'customer', 'not null', 'date_of_birth', count(*) FILTER (WHERE date_of_birth IS NULL) FROM w_customer
UNION ALL SELECT 'transaction', 'not null', 'transaction_id', count(*) FILTER (WHERE event_id IS NULL) FROM events
UNION ALL SELECT 'transaction', 'not null', 'amount', count(*) FILTER (WHERE value IS NULL) FROM events
UNION ALL SELECT 'transaction', 'not null', 'currency', count(*) FILTER (WHERE event_id % 10 = 0) FROM events
UNION ALL SELECT 'loan', 'not null', 'principal_amount', count(*) FILTER (WHERE principal_amount IS NULL) FROM w_loan
UNION ALL SELECT 'loan', 'not null', 'interest_rate', count(*) FILTER (WHERE interest_rate IS NULL) FROM w_loan
UNION ALL SELECT 'loan', 'not null', 'loan_status', count(*) FILTER (WHERE loan_status IS NULL) FROM w_loan) WHERE rows > 0""",
        "w_customer", "w_loan"),
    "monthly_installment": with_views(f"SELECT loan_id, {EMI} AS monthly_installment FROM w_loan", "w_loan"),
    "total_interest": with_views(f"""WITH e AS (SELECT *, {EMI} AS due FROM w_loan)
SELECT loan_id, {rnd('due * tenure_months - CAST(principal_amount AS DOUBLE)', 2)} AS total_interest FROM e""", "w_loan"),
    "customer_age": with_views(f"""SELECT customer_id, date_of_birth,
       CAST(year({AS_OF}) - year(date_of_birth) - CASE WHEN (month({AS_OF}), day({AS_OF})) < (month(date_of_birth), day(date_of_birth)) THEN 1 ELSE 0 END AS INT) AS age,
       {dbl('annual_income')} AS annual_income FROM w_customer""", "w_customer"),
}

# The snapshot over the published tables: without the rejected rows.
PUBLISHED = f"""pub_loan AS (SELECT *, CAST(strptime(CAST(issue_date_key AS VARCHAR), '%Y%m%d') AS DATE) AS issue_date FROM fact_loan),
pub_txn AS (SELECT *, CAST(strptime(CAST(txn_date_key AS VARCHAR), '%Y%m%d') AS DATE) AS txn_date FROM fact_txn)"""
TEXTS["warehouse_snapshot"] = with_views(
    f"WITH {KEYED}, {LOANS}, {TXNS}, {PUBLISHED}, "
    + SNAPSHOT.replace("w_loan", "pub_loan").replace("w_txn", "pub_txn").removeprefix("WITH "),
    *FACTS,
)
