"""Fixture views in DuckDB SQL and the helper that puts them before a query."""

from __future__ import annotations

AS_OF = "DATE '2001-07-31'"
REASON = "High-value outlier (Z > 3σ)"

VIEWS: dict[str, tuple[tuple[str, ...], str]] = {
    "w_region": ((), """
SELECT CAST(n_nationkey + 1 AS INT) AS region_key,
       md5(lower(n_name) || '|' || 'state_' || CAST(n_nationkey % 10 AS VARCHAR)) AS region_id,
       n_name AS city, 'State_' || CAST(n_nationkey % 10 AS VARCHAR) AS state, r_name AS country,
       CASE WHEN n_nationkey % 5 = 0 THEN 'URBAN' ELSE 'SEMI-URBAN' END AS region_tier
FROM nation JOIN region ON n_regionkey = r_regionkey"""),
    "w_customer": ((), """
SELECT t.*, CASE WHEN credit_score >= 750 THEN 'LOW' WHEN credit_score >= 650 THEN 'MEDIUM'
                 WHEN credit_score >= 550 THEN 'HIGH' ELSE 'CRITICAL' END AS risk_tier
FROM (SELECT c_custkey + 1 AS customer_key, 'CUST' || lpad(CAST(c_custkey AS VARCHAR), 10, '0') AS customer_id,
             CAST(c_nationkey + 1 AS INT) AS region_key, c_mktsegment AS employment_status,
             CAST(abs(c_acctbal) * 12 AS DECIMAL(15,2)) AS annual_income,
             CASE WHEN c_custkey % 50 = 7 THEN NULL ELSE CAST(300 + (c_custkey * 37) % 551 AS INT) END AS credit_score,
             CASE WHEN c_custkey % 37 = 0 THEN NULL
                  ELSE DATE '1950-01-01' + CAST((c_custkey * 17) % 18000 AS INT) END AS date_of_birth,
             TRUE AS is_current
      FROM customer) t"""),
    "w_product": ((), """
SELECT CAST(k AS INT) AS product_key, 'P' || CAST(k AS VARCHAR) AS product_code, category
FROM (VALUES (1,'PERSONAL'),(2,'MORTGAGE'),(3,'AUTO'),(4,'SME'),(5,'STUDENT'),(6,'PERSONAL')) v(k, category)"""),
    "w_loan": ((), """
SELECT b.*, CASE WHEN loan_status = 'CLOSED' THEN CAST(0 AS DECIMAL(18,2))
                 ELSE CAST(principal_amount * CAST(10 + loan_key % 91 AS INT) * 0.01 AS DECIMAL(18,2)) END AS outstanding_balance,
       days_past_due > 90 AS is_npl, days_past_due BETWEEN 30 AND 89 AS is_par30
FROM (SELECT a.*, CAST(CASE loan_status WHEN 'DEFAULTED' THEN 90 + (loan_key * 7) % 276
                            WHEN 'ACTIVE' THEN CASE WHEN loan_key % 20 < 17 THEN 0 ELSE (loan_key * 13) % 90 END
                            ELSE 0 END AS INT) AS days_past_due
      FROM (SELECT o_orderkey AS loan_key, 'LOAN' || lpad(CAST(o_orderkey AS VARCHAR), 12, '0') AS loan_id,
                   c_custkey + 1 AS customer_key, CAST(o_orderkey % 6 + 1 AS INT) AS product_key,
                   CAST(c_nationkey + 1 AS INT) AS region_key, CAST(o_orderdate AS DATE) AS issue_date,
                   CAST(CASE WHEN o_orderkey % 97 = 0 THEN CAST(o_totalprice AS DECIMAL(18,2)) * 10.0
                             WHEN o_orderkey % 89 = 0 THEN CAST(o_totalprice AS DECIMAL(18,2)) * 0.01
                             ELSE 200000.0 + CAST(o_totalprice AS DECIMAL(18,2)) * 0.2 END AS DECIMAL(18,2)) AS principal_amount,
                   CASE WHEN o_orderkey % 211 = 0 THEN CAST(0 AS DECIMAL(5,2))
                        ELSE CAST(3 + (o_orderkey % 1500) / 100.0 AS DECIMAL(5,2)) END AS interest_rate,
                   CAST(12 + o_orderkey % 49 AS INT) AS tenure_months,
                   CASE o_orderstatus WHEN 'F' THEN 'CLOSED' WHEN 'O' THEN 'ACTIVE'
                        ELSE CASE o_orderkey % 3 WHEN 0 THEN 'DEFAULTED' WHEN 1 THEN 'RESTRUCTURED' ELSE 'ACTIVE' END END AS loan_status
            FROM orders JOIN customer ON o_custkey = c_custkey) a) b"""),
    "w_loanx": (("w_loan", "w_customer", "w_product", "w_region"), """
SELECT l.*, c.customer_id, c.risk_tier, c.credit_score, p.category, r.city, r.state, r.country
FROM w_loan l JOIN w_customer c ON c.customer_key = l.customer_key
JOIN w_product p ON p.product_key = l.product_key JOIN w_region r ON r.region_key = l.region_key"""),
    "w_txn_base": ((), """
SELECT event_id AS txn_key, 'TXN' || lpad(CAST(event_id AS VARCHAR), 14, '0') AS transaction_id,
       user_id + 1 AS customer_key, CAST(c_nationkey + 1 AS INT) AS region_key,
       CAST(ts AS DATE) - 8219 AS txn_date, event_id * 2 AS loan_key_raw,
       CASE event_type WHEN 'purchase' THEN 'REPAYMENT' WHEN 'view' THEN 'TRANSFER' WHEN 'click' THEN 'WITHDRAWAL'
                       WHEN 'signup' THEN 'DEPOSIT' ELSE 'DISBURSEMENT' END AS transaction_type,
       CAST(value AS DECIMAL(18,2)) AS amount,
       CASE WHEN event_id % 10 = 0 THEN NULL ELSE 'USD' END AS currency
FROM events JOIN customer ON user_id = c_custkey"""),
    "w_txn": (("w_txn_base",), f"""
SELECT t.*, z_score > 3.0 AS is_anomaly, CAST(round(1 - exp(-z_score / 3.0), 4) AS DECIMAL(5,4)) AS anomaly_score,
       CASE WHEN z_score > 3.0 THEN '{REASON}' END AS anomaly_reason
FROM (SELECT b.*, CASE WHEN sd > 0 THEN abs(CAST(amount AS DOUBLE) - av) / sd ELSE CAST(0 AS DOUBLE) END AS z_score
      FROM w_txn_base b
      LEFT JOIN (SELECT customer_key AS ck, avg(CAST(amount AS DOUBLE)) AS av, stddev(CAST(amount AS DOUBLE)) AS sd
                 FROM w_txn_base GROUP BY customer_key) st ON ck = customer_key) t"""),
    "w_txnx": (("w_txn", "w_customer", "w_region"), """
SELECT t.*, c.customer_id, c.risk_tier, r.city, r.state, r.country, r.region_tier
FROM w_txn t JOIN w_customer c ON c.customer_key = t.customer_key JOIN w_region r ON r.region_key = t.region_key"""),
    "w_loan_day2": (("w_loan",), """
SELECT loan_key, loan_id, outstanding_balance, loan_status AS old_status, days_past_due AS old_dpd,
       CASE WHEN loan_status <> 'ACTIVE' THEN days_past_due WHEN loan_key % 20 IN (3, 17, 18) THEN days_past_due + 30
            WHEN loan_key % 20 = 19 THEN 0 ELSE days_past_due END AS new_dpd,
       CASE WHEN loan_key % 40 = 0 AND loan_status = 'ACTIVE' THEN 'CLOSED' ELSE loan_status END AS new_status
FROM w_loan"""),
    "r_customers": ((), """
SELECT CASE WHEN c_custkey % 11 = 0 THEN '  ' || id || ' ' ELSE id END AS customer_id,
       ' ann' AS first_name, 'o''neil-' || c_mktsegment AS last_name,
       CASE WHEN c_custkey % 37 = 0 THEN '' ELSE CAST(DATE '1950-01-01' + CAST((c_custkey * 17) % 18000 AS INT) AS VARCHAR) END AS date_of_birth,
       CASE c_custkey % 4 WHEN 0 THEN 'male' WHEN 1 THEN 'F ' WHEN 2 THEN ' o' ELSE 'm' END AS gender,
       upper(id) || '@MAIL.TEST ' AS email, '+1-200' AS phone,
       CASE c_custkey % 3 WHEN 0 THEN 'self-employed' WHEN 1 THEN 'Full-time' ELSE ' retired' END AS employment_status,
       CASE WHEN c_custkey % 41 = 0 THEN '' ELSE '$' || CAST(CAST(abs(c_acctbal) * 12 * ver AS DECIMAL(15,2)) AS VARCHAR) END AS annual_income,
       CASE WHEN c_custkey % 50 = 7 THEN '' ELSE CAST(300 + (c_custkey * 37) % 551 AS VARCHAR) END AS credit_score,
       ' ' || n_name AS city, 'State_' || CAST(n_nationkey % 10 AS VARCHAR) AS state, r_name AS country,
       CASE ver WHEN 1 THEN TIMESTAMP '2001-07-01 00:00:00' ELSE TIMESTAMP '2001-07-02 00:00:00' END AS ingested_at
FROM (SELECT c.*, 'CUST' || lpad(CAST(c_custkey AS VARCHAR), 10, '0') AS id, v.ver
      FROM customer c CROSS JOIN (VALUES (1),(2)) v(ver) WHERE v.ver = 1 OR c_custkey % 13 = 0) c
JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"""),
    "r_products": ((), """
SELECT ' p' || CAST(p_partkey AS VARCHAR) AS product_code, ' ' || replace(p_name, ' ', '-') || ' plan ' AS product_name,
       CASE p_partkey % 6 WHEN 2 THEN 'mortgage ' WHEN 3 THEN ' auto' WHEN 4 THEN 'sme' WHEN 5 THEN 'Student' ELSE 'personal ' END AS category,
       lower(p_type) || ' rate' AS sub_category,
       CASE p_partkey % 7 WHEN 2 THEN '' ELSE CAST(p_size AS VARCHAR) || '.25' END AS interest_rate_min,
       CAST(p_size + 15 AS VARCHAR) || '.99' AS interest_rate_max,
       '12' AS min_tenure_months,
       CASE p_partkey % 5 WHEN 3 THEN '' ELSE CAST(24 + p_partkey % 100 AS VARCHAR) END AS max_tenure_months,
       CASE p_partkey % 5 WHEN 0 THEN 'Yes' WHEN 1 THEN 'true' WHEN 2 THEN '1' WHEN 3 THEN 'no' END AS is_secured,
       CASE WHEN p_partkey % 2 = 0 THEN ' Vehicle' ELSE '  ' END AS collateral_type
FROM part"""),
    "r_loans": (("w_loan",), """
SELECT loan_id, CASE WHEN loan_key % 101 = 0 THEN 'CUST9999999999'
                     ELSE ' CUST' || lpad(CAST(customer_key - 1 AS VARCHAR), 10, '0') END AS customer_id,
       CASE WHEN loan_key % 103 = 0 THEN 'nope' ELSE 'p' || CAST(product_key AS VARCHAR) || ' ' END AS product_code,
       CAST(issue_date AS VARCHAR) AS issue_date,
       CASE WHEN loan_key % 59 = 0 THEN '' ELSE CAST(issue_date + tenure_months * 30 AS VARCHAR) END AS maturity_date,
       CAST(principal_amount AS VARCHAR) AS principal_amount, CAST(interest_rate AS VARCHAR) AS interest_rate,
       CAST(tenure_months AS VARCHAR) AS tenure_months, lower(loan_status) AS loan_status,
       CASE WHEN days_past_due = 0 AND loan_key % 2 = 0 THEN '' ELSE CAST(days_past_due AS VARCHAR) END AS days_past_due,
       CAST(outstanding_balance AS VARCHAR) AS outstanding_balance
FROM w_loan"""),
    "r_transactions": (("w_txn_base", "w_region"), """
SELECT transaction_id, 'CUST' || lpad(CAST(t.customer_key - 1 AS VARCHAR), 10, '0') || ' ' AS customer_id,
       'LOAN' || lpad(CAST(loan_key_raw AS VARCHAR), 12, '0') AS loan_id,
       CAST(txn_date AS VARCHAR) AS transaction_date, lower(transaction_type) AS transaction_type,
       CAST(amount AS VARCHAR) AS amount, currency, '' AS fee_amount,
       CASE WHEN txn_key % 71 = 0 THEN 'nowhere' ELSE city END AS city, state, country
FROM w_txn_base t JOIN w_region r ON t.region_key = r.region_key"""),
}


def with_views(sql: str, *names: str) -> str:
    """``sql`` with the named views, and what they use, as leading CTEs."""
    ordered: list[str] = []

    def add(name: str) -> None:
        for parent in VIEWS[name][0]:
            add(parent)
        if name not in ordered:
            ordered.append(name)

    for name in names:
        add(name)
    ctes = ",\n".join(f"{name} AS ({VIEWS[name][1]})" for name in ordered)
    body = sql.strip()
    if body[:5].upper() == "WITH ":
        return f"WITH {ctes},\n{body[5:]}"
    return f"WITH {ctes}\n{body}"


def rnd(x: str, digits: int) -> str:
    """Half-up rounding of a DOUBLE expression."""
    return f"round(({x}) + sign({x}) * 1e-9, {digits})"


def pct(numerator: str, denominator: str, digits: int) -> str:
    return rnd(f"CAST({numerator} AS DOUBLE) / nullif(CAST({denominator} AS DOUBLE), 0) * 100", digits)


def dbl(x: str) -> str:
    return f"CAST({x} AS DOUBLE)"


def mean(x: str, digits: int) -> str:
    return rnd(f"CAST(sum({x}) AS DOUBLE) / nullif(count({x}), 0)", digits)
