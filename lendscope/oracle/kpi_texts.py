"""KPI, exploratory and drill-down texts."""

from __future__ import annotations

from lendscope.oracle.views import AS_OF, dbl, mean, pct, rnd, with_views

RISKY = "(is_par30 OR is_npl)"

DAILY = f"""daily AS (
  SELECT issue_date AS full_date, sum(outstanding_balance) AS total,
         sum(outstanding_balance) FILTER (WHERE {RISKY}) AS risky,
         count(*) AS total_loans, count(*) FILTER (WHERE {RISKY}) AS at_risk_loans
  FROM w_loan GROUP BY issue_date)"""

PAR30 = f"""WITH {DAILY}, s AS (
  SELECT *, CAST(risky AS DOUBLE) / nullif(CAST(total AS DOUBLE), 0) * 100 AS share FROM daily)
SELECT full_date, {dbl('total')} AS total_portfolio, {dbl('risky')} AS at_risk_balance, total_loans, at_risk_loans,
       {rnd('share', 4)} AS par30_pct,
       {rnd('avg(share) OVER w7', 4)} AS par30_7d_avg, {rnd('avg(share) OVER w30', 4)} AS par30_30d_avg
FROM s WINDOW w7 AS (ORDER BY full_date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW),
              w30 AS (ORDER BY full_date ROWS BETWEEN 29 PRECEDING AND CURRENT ROW)"""

DEFAULT_RATE = f"""WITH m AS (
  SELECT CAST(date_trunc('month', issue_date) AS DATE) AS month_start, count(*) AS total_loans_issued,
         count(*) FILTER (WHERE loan_status = 'DEFAULTED') AS defaults, sum(principal_amount) AS total,
         sum(principal_amount) FILTER (WHERE loan_status = 'DEFAULTED') AS lost
  FROM w_loan GROUP BY 1)
SELECT CAST(year(month_start) AS INT) AS year, CAST(month(month_start) AS INT) AS month_num, monthname(month_start) AS month_name,
       month_start, total_loans_issued, defaults, {pct('defaults', 'total_loans_issued', 4)} AS default_rate_pct,
       {dbl('lost')} AS defaulted_principal, {pct('lost', 'total', 4)} AS default_amount_pct,
       CAST(sum(defaults) OVER (PARTITION BY year(month_start), quarter(month_start) ORDER BY month_start) AS BIGINT) AS qtd_defaults,
       CAST(sum(defaults) OVER (PARTITION BY year(month_start) ORDER BY month_start) AS BIGINT) AS ytd_defaults
FROM m"""

TXN_VOLUME = f"""WITH v AS (
  SELECT txn_date AS full_date, country, state, city, region_tier, transaction_type, count(*) AS txn_count,
         sum(amount) AS volume, {mean('amount', 2)} AS avg_amount, count(*) FILTER (WHERE is_anomaly) AS anomaly_count
  FROM w_txnx GROUP BY ALL),
p AS (SELECT *, lag(volume) OVER (PARTITION BY country, state, city, region_tier, transaction_type ORDER BY full_date) AS prev FROM v)
SELECT full_date, CAST(year(full_date) AS INT) AS year, CAST(month(full_date) AS INT) AS month_num,
       CAST(weekofyear(full_date) AS INT) AS week_of_year, country, state, city, region_tier, transaction_type,
       txn_count, {dbl('volume')} AS total_volume, avg_amount, anomaly_count, {dbl('prev')} AS prev_day_volume,
       {pct('(volume - prev)', 'prev', 2)} AS dod_pct_change
FROM p"""

SERIES = "country, state, city, region_tier, transaction_type"
TXN_VOLUME_CALENDAR = f"""WITH span AS (SELECT {SERIES}, min(txn_date) AS lo, max(txn_date) AS hi FROM w_txnx GROUP BY ALL),
days AS (SELECT {SERIES}, CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS full_date FROM span),
v AS (SELECT d.full_date, d.country, d.state, d.city, d.region_tier, d.transaction_type, count(amount) AS txn_count, coalesce(sum(amount), 0) AS volume,
             {mean('amount', 2)} AS avg_amount, count(*) FILTER (WHERE is_anomaly) AS anomaly_count
      FROM days d LEFT JOIN w_txnx t ON t.txn_date = d.full_date AND t.city = d.city AND t.state = d.state AND t.country = d.country
           AND t.transaction_type = d.transaction_type GROUP BY ALL),
{TXN_VOLUME[TXN_VOLUME.index('p AS (SELECT'):]}"""

ANOMALY_SUMMARY = f"""WITH d AS (
  SELECT txn_date AS full_date, transaction_type, country, state, count(*) FILTER (WHERE is_anomaly) AS anomaly_count,
         count(*) AS total_txns, sum(anomaly_score) FILTER (WHERE is_anomaly) AS scores,
         sum(amount) FILTER (WHERE is_anomaly) AS volume
  FROM w_txnx GROUP BY ALL),
days AS (SELECT full_date, sum(anomaly_count) AS n FROM d GROUP BY full_date),
week AS (SELECT full_date, sum(n) OVER (ORDER BY full_date RANGE BETWEEN INTERVAL 6 DAYS PRECEDING AND CURRENT ROW) AS n7 FROM days)
SELECT d.full_date, transaction_type, country, state, anomaly_count, total_txns,
       {rnd('CAST(scores AS DOUBLE) / nullif(anomaly_count, 0)', 4)} AS avg_anomaly_score, {dbl('volume')} AS anomalous_volume,
       {pct('anomaly_count', 'total_txns', 4)} AS anomaly_rate_pct, CAST(n7 AS BIGINT) AS anomaly_7d_rolling,
       CAST(sum(anomaly_count) OVER (ORDER BY d.full_date, transaction_type, country, state
            ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS BIGINT) AS anomaly_7row_rolling
FROM d JOIN week ON week.full_date = d.full_date"""

NPL_RATIO = f"""SELECT CAST(year(issue_date) AS INT) AS year, CAST(month(issue_date) AS INT) AS month_num,
       monthname(issue_date) AS month_name, risk_tier, category AS product_category, count(*) AS total_loans,
       count(*) FILTER (WHERE is_npl) AS npl_loans, {dbl('sum(outstanding_balance)')} AS total_outstanding,
       {dbl('sum(outstanding_balance) FILTER (WHERE is_npl)')} AS npl_outstanding,
       {pct('count(*) FILTER (WHERE is_npl)', 'count(*)', 4)} AS npl_ratio_pct
FROM w_loanx GROUP BY 1, 2, 3, 4, 5"""

SNAPSHOT = f"""WITH {DAILY}
SELECT {AS_OF} AS snapshot_ts,
  (SELECT {rnd('avg(p)', 4)} FROM (SELECT {pct('risky', 'total', 4)} AS p FROM daily WHERE full_date >= {AS_OF} - 30)) AS par30_30d_avg,
  (SELECT {pct("count(*) FILTER (WHERE loan_status = 'DEFAULTED')", 'count(*)', 4)} FROM w_loan
   WHERE year(issue_date) = year({AS_OF}) AND month(issue_date) = month({AS_OF})) AS current_month_default_rate,
  (SELECT count(*) FROM w_txn WHERE is_anomaly AND txn_date = {AS_OF} - 1) AS anomaly_count_yesterday,
  (SELECT count(*) FROM w_loan WHERE loan_status = 'ACTIVE') AS active_loan_count,
  (SELECT {pct('count(*) FILTER (WHERE is_npl)', 'count(*)', 4)} FROM w_loan) AS overall_npl_ratio,
  (SELECT {dbl('sum(outstanding_balance)')} FROM w_loan WHERE loan_status = 'ACTIVE') AS total_active_portfolio"""

EDA = {
    "eda_row_counts": with_views("""SELECT * FROM (
SELECT 'staging.raw_customers' AS table_name, count(*) AS row_count FROM r_customers
UNION ALL SELECT 'staging.raw_loans', count(*) FROM r_loans
UNION ALL SELECT 'staging.raw_transactions', count(*) FROM r_transactions
UNION ALL SELECT 'warehouse.dim_customer', count(*) FROM w_customer
UNION ALL SELECT 'warehouse.fact_loan', count(*) FROM w_loan
UNION ALL SELECT 'warehouse.fact_transaction', count(*) FROM w_txn)""",
        "r_customers", "r_loans", "r_transactions", "w_customer", "w_loan", "w_txn"),
    "eda_null_profile": with_views(" UNION ALL ".join(
        f"SELECT '{c}' AS field, count(*) FILTER (WHERE {c} IS NULL) AS nulls, "
        f"{pct(f'count(*) FILTER (WHERE {c} IS NULL)', 'count(*)', 2)} AS null_pct FROM w_customer"
        for c in ("credit_score", "annual_income", "date_of_birth")), "w_customer"),
    "eda_credit_score_hist": with_views(f"""SELECT bucket, min(credit_score) AS bucket_floor, max(credit_score) AS bucket_ceil,
       count(*) AS customers, {pct('count(*)', 'sum(count(*)) OVER ()', 2)} AS pct
FROM (SELECT credit_score, CAST(CASE WHEN credit_score < 300 THEN 0 WHEN credit_score >= 850 THEN 12
             ELSE floor((credit_score - 300) * 11 / 550.0) + 1 END AS BIGINT) AS bucket FROM w_customer WHERE credit_score IS NOT NULL)
GROUP BY bucket""", "w_customer"),
    "eda_loan_stats": with_views(f"""SELECT count(*) AS total_loans, {dbl('min(principal_amount)')} AS min_amount,
       {dbl('max(principal_amount)')} AS max_amount, {mean('principal_amount', 2)} AS mean_amount,
       {', '.join(rnd(f'quantile_cont(CAST(principal_amount AS DOUBLE), {p})', 4) + f' AS {n}'
                  for n, p in (('p25', 0.25), ('median', 0.5), ('p75', 0.75), ('p95', 0.95)))},
       {rnd('stddev_samp(CAST(principal_amount AS DOUBLE))', 2)} AS stddev FROM w_loan""", "w_loan"),
    "eda_status_mix": with_views(f"""SELECT loan_status, count(*) AS loan_count, {dbl('sum(principal_amount)')} AS total_principal,
       {mean('principal_amount', 2)} AS avg_principal, {pct('count(*)', 'sum(count(*)) OVER ()', 2)} AS pct_of_portfolio
FROM w_loan GROUP BY loan_status""", "w_loan"),
    "eda_monthly_origination": with_views(f"""WITH m AS (SELECT date_trunc('month', issue_date) AS mon, count(*) AS n,
         {dbl('sum(principal_amount)')} AS total FROM w_loan GROUP BY 1),
p AS (SELECT *, lag(n) OVER (ORDER BY mon) AS prev FROM m)
SELECT CAST(year(mon) AS INT) AS year, CAST(month(mon) AS INT) AS month_num, monthname(mon) AS month_name, n AS loans_issued,
       total AS total_disbursed, prev AS prev_month_count, {pct('(n - prev)', 'prev', 2)} AS mom_growth_pct FROM p""", "w_loan"),
    "eda_txn_rollup": with_views(f"""SELECT country, state, transaction_type,
       CAST(grouping(country, state, transaction_type) AS INT) AS level, count(*) AS txn_count,
       {dbl('sum(amount)')} AS total_volume, {mean('amount', 2)} AS avg_amount
FROM w_txn_base t JOIN w_region r ON r.region_key = t.region_key GROUP BY ROLLUP (country, state, transaction_type)""",
        "w_txn_base", "w_region"),
    "eda_top_anomalies": with_views(f"""SELECT transaction_id, customer_id, risk_tier, transaction_type, {dbl('amount')} AS amount,
       {dbl('anomaly_score')} AS anomaly_score, anomaly_reason, txn_date AS transaction_date, city, state
FROM w_txnx t WHERE is_anomaly ORDER BY t.anomaly_score DESC, transaction_id LIMIT 10""", "w_txnx"),
    "eda_risk_tier": with_views(f"""SELECT risk_tier, count(*) AS customers, {mean('credit_score', 1)} AS avg_credit_score,
       {mean('annual_income', 2)} AS avg_income, {pct('count(*)', 'sum(count(*)) OVER ()', 2)} AS pct
FROM w_customer WHERE is_current GROUP BY risk_tier""", "w_customer"),
    "eda_dpd_buckets": with_views(f"""SELECT dpd_bucket, count(*) AS loan_count, {dbl('sum(principal_amount)')} AS outstanding_principal,
       {pct('count(*)', 'sum(count(*)) OVER ()', 2)} AS pct_count
FROM (SELECT *, CASE WHEN days_past_due = 0 THEN 'Current (0 days)' WHEN days_past_due < 30 THEN 'PAR 1-29'
      WHEN days_past_due < 60 THEN 'PAR 30-59' WHEN days_past_due < 90 THEN 'PAR 60-89' ELSE 'NPL (90+ days)' END AS dpd_bucket
      FROM w_loan) GROUP BY dpd_bucket""", "w_loan"),
    "eda_dpd_write_off": with_views(f"""SELECT dpd_bucket, count(*) AS loan_count, {dbl('sum(principal_amount)')} AS outstanding_principal,
       {pct('count(*)', 'sum(count(*)) OVER ()', 2)} AS pct_count
FROM (SELECT *, CASE WHEN days_past_due = 0 THEN 'Current (0 days)' WHEN days_past_due < 30 THEN 'PAR 1-29'
      WHEN days_past_due < 60 THEN 'PAR 30-59' WHEN days_past_due < 90 THEN 'PAR 60-89' WHEN days_past_due < 180 THEN 'NPL (90+ days)'
      ELSE 'Write-off (180+ days)' END AS dpd_bucket
      FROM w_loan) GROUP BY dpd_bucket""", "w_loan"),
}

KPI = {
    "kpi_par30": with_views(PAR30, "w_loan"),
    "kpi_par30_zero_fill": with_views(
        PAR30.replace("CAST(risky AS DOUBLE)", "CAST(coalesce(risky, 0) AS DOUBLE)"), "w_loan"),
    "kpi_par30_dpd30": with_views(PAR30.replace(RISKY, "days_past_due >= 30"), "w_loan"),
    "kpi_par30_par_only": with_views(PAR30.replace(RISKY, "is_par30"), "w_loan"),
    "kpi_default_rate": with_views(DEFAULT_RATE, "w_loan"),
    "kpi_txn_volume": with_views(TXN_VOLUME, "w_txnx"),
    "kpi_txn_volume_calendar": with_views(TXN_VOLUME_CALENDAR, "w_txnx"),
    "kpi_anomaly_summary": with_views(ANOMALY_SUMMARY, "w_txnx"),
    "kpi_npl_ratio": with_views(NPL_RATIO, "w_loanx"),
    "kpi_npl_ratio_from_90": with_views(NPL_RATIO.replace("is_npl", "days_past_due >= 90"), "w_loanx"),
    "kpi_snapshot": with_views(SNAPSHOT, "w_loan", "w_txn"),
}

FENCES = """q AS (SELECT category, quantile_cont(CAST(principal_amount AS DOUBLE), 0.25) AS q1,
                 quantile_cont(CAST(principal_amount AS DOUBLE), 0.75) AS q3 FROM w_loanx GROUP BY category)"""

DRILL = {
    "inv_default_spike": with_views(f"""SELECT risk_tier, category AS product_category, state AS region_state,
       count(*) FILTER (WHERE loan_status = 'DEFAULTED') AS defaulted_loans, count(*) AS total_loans,
       {pct("count(*) FILTER (WHERE loan_status = 'DEFAULTED')", 'count(*)', 4)} AS default_rate_pct,
       {mean('credit_score', 1)} AS avg_credit_score, {mean('principal_amount', 2)} AS avg_loan_amount
FROM w_loanx WHERE issue_date BETWEEN {AS_OF} - 365 AND {AS_OF} GROUP BY 1, 2, 3""", "w_loanx"),
    "inv_par30_spike": with_views(f"""SELECT loan_id, customer_id, risk_tier, days_past_due, {dbl('outstanding_balance')} AS outstanding,
       category AS product_category, state, days_past_due - 30 AS days_in_par30
FROM w_loanx WHERE days_past_due BETWEEN 30 AND 89""", "w_loanx"),
    "inv_anomaly_spike": with_views(f"""SELECT transaction_id, customer_id, risk_tier, transaction_type, {dbl('amount')} AS amount,
       {dbl('anomaly_score')} AS anomaly_score, anomaly_reason, city || ', ' || state AS region
FROM w_txnx t WHERE is_anomaly AND txn_date = {AS_OF} - 1 ORDER BY t.anomaly_score DESC, transaction_id LIMIT 50""", "w_txnx"),
    "inv_npl": with_views(f"""WITH v AS ({NPL_RATIO})
SELECT risk_tier, product_category, CAST(sum(npl_loans) AS BIGINT) AS npl_total, {rnd('avg(npl_ratio_pct)', 4)} AS avg_npl_pct
FROM v WHERE year = 2001 GROUP BY 1, 2 ORDER BY avg_npl_pct DESC, 1, 2 LIMIT 10""", "w_loanx"),
    "loan_outliers": with_views(f"""WITH {FENCES},
f AS (SELECT category, {rnd('q1 - 1.5 * (q3 - q1)', 6)} AS lower_fence, {rnd('q3 + 1.5 * (q3 - q1)', 6)} AS upper_fence FROM q)
SELECT loan_id, customer_id, risk_tier, l.category, {dbl('principal_amount')} AS principal_amount, lower_fence, upper_fence,
       CASE WHEN principal_amount < lower_fence THEN 'LOW_OUTLIER' ELSE 'HIGH_OUTLIER' END AS outlier_type
FROM w_loanx l JOIN f ON f.category = l.category
WHERE CAST(l.principal_amount AS DOUBLE) < lower_fence OR CAST(l.principal_amount AS DOUBLE) > upper_fence""", "w_loanx"),
    "sql_functions": with_views(f"""SELECT 'default' AS source, risk_tier || '/' || category || '/' || state AS item,
       {pct("count(*) FILTER (WHERE loan_status = 'DEFAULTED')", 'count(*)', 4)} AS value
FROM w_loanx WHERE issue_date BETWEEN {AS_OF} - 30 AND {AS_OF} GROUP BY risk_tier, category, state
UNION ALL SELECT 'par30', loan_id, {dbl('outstanding_balance')} FROM w_loanx WHERE days_past_due BETWEEN 30 AND 59
UNION ALL SELECT 'anomaly', transaction_id, s FROM (SELECT transaction_id, {dbl('anomaly_score')} AS s FROM w_txnx
  WHERE is_anomaly AND txn_date = DATE '2001-07-20' ORDER BY anomaly_score DESC, transaction_id LIMIT 50)""", "w_loanx", "w_txnx"),
    "txn_zscore": with_views(f"""SELECT transaction_id, customer_id, txn_date AS transaction_date, {dbl('amount')} AS amount,
       {rnd('z_score', 6)} AS z_score, {dbl('anomaly_score')} AS anomaly_score, is_anomaly, anomaly_reason FROM w_txnx""", "w_txnx"),
}

TEXTS = {**EDA, **KPI, **DRILL}
