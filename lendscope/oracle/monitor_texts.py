"""Monitor, stream, report and dashboard texts."""

from __future__ import annotations

from lendscope.oracle.kpi_texts import ANOMALY_SUMMARY, DAILY, DEFAULT_RATE, NPL_RATIO, PAR30, RISKY, SNAPSHOT
from lendscope.oracle.views import AS_OF, dbl, mean, pct, rnd, with_views

SNAP = f"snap AS (SELECT * FROM ({SNAPSHOT}))"

# Every poll day with its indicators, by scalar look-ups.
HISTORY = f"""{DAILY}, shares AS (SELECT full_date, {pct('risky', 'total', 4)} AS p FROM daily),
issued AS (SELECT issue_date AS d, count(*) AS n, count(*) FILTER (WHERE loan_status = 'DEFAULTED') AS bad FROM w_loan GROUP BY 1),
flags AS (SELECT txn_date AS d, count(*) AS n FROM w_txn WHERE is_anomaly GROUP BY 1),
polls AS (SELECT CAST(unnest(generate_series(DATE '2000-07-31', {AS_OF}, INTERVAL 1 DAY)) AS DATE) AS d),
par AS (SELECT polls.d, {rnd('avg(p)', 4)} AS v FROM polls LEFT JOIN shares ON full_date BETWEEN polls.d - 30 AND polls.d GROUP BY polls.d),
def AS (SELECT polls.d, {pct('sum(bad)', 'sum(n)', 4)} AS v FROM polls LEFT JOIN issued i
        ON i.d <= polls.d AND date_trunc('month', i.d) = date_trunc('month', polls.d) GROUP BY polls.d),
book AS (SELECT count(*) FILTER (WHERE loan_status = 'ACTIVE') AS active, {pct('count(*) FILTER (WHERE is_npl)', 'count(*)', 4)} AS npl,
                {dbl("sum(outstanding_balance) FILTER (WHERE loan_status = 'ACTIVE')")} AS total FROM w_loan),
history AS (SELECT polls.d AS snapshot_ts, par.v AS par30_30d_avg, def.v AS current_month_default_rate, coalesce(flags.n, 0) AS anomaly_count_yesterday,
                   active AS active_loan_count, npl AS overall_npl_ratio, total AS total_active_portfolio
            FROM polls JOIN par ON par.d = polls.d JOIN def ON def.d = polls.d LEFT JOIN flags ON flags.d = polls.d - 1, book)"""


def limits(anomalies: float) -> str:
    return f"""limits AS (SELECT * FROM (VALUES ('par30_30d_avg', 'PAR-30 Rate (%)', CAST(5 AS DOUBLE)),
  ('current_month_default_rate', 'Default Rate (%)', CAST(3 AS DOUBLE)), ('anomaly_count_yesterday', 'Anomaly Count (Yesterday)', CAST({anomalies} AS DOUBLE)),
  ('overall_npl_ratio', 'NPL Ratio (%)', CAST(8 AS DOUBLE))) v(kpi, kpi_name, threshold))"""


def checked(source: str, anomalies: float) -> str:
    kpis = ("par30_30d_avg", "current_month_default_rate", "anomaly_count_yesterday", "overall_npl_ratio")
    parts = " UNION ALL ".join(
        f"SELECT snapshot_ts AS as_of, '{k}' AS kpi, coalesce(CAST({k} AS DOUBLE), 0) AS value FROM {source}" for k in kpis
    )
    return f"""{limits(anomalies)}, vals AS ({parts}),
checked AS (SELECT as_of, v.kpi, kpi_name, value, threshold, value > threshold AS breached,
                   CASE WHEN value > threshold * 1.5 THEN 'CRITICAL' WHEN value > threshold THEN 'WARNING' END AS severity
            FROM vals v JOIN limits l ON l.kpi = v.kpi)"""


EVENTS = """marked AS (SELECT *, coalesce(lag(breached) OVER (PARTITION BY kpi ORDER BY as_of), FALSE) AS was FROM checked),
ev AS (SELECT *, CASE WHEN breached AND NOT was THEN 'FIRE' WHEN breached THEN 'SUPPRESS' WHEN was THEN 'RESOLVE' END AS event,
              count(*) FILTER (WHERE breached AND NOT was) OVER (PARTITION BY kpi ORDER BY as_of) AS alert_no FROM marked)"""

LIFECYCLE = f"""WITH {HISTORY}, {checked('history', 6)}, {EVENTS}
SELECT f.kpi, f.kpi_name, f.alert_no, f.as_of AS triggered_at,
       (SELECT min(r.as_of) FROM ev r WHERE r.kpi = f.kpi AND r.event = 'RESOLVE' AND r.alert_no = f.alert_no) AS resolved_at,
       f.value AS trigger_value, f.threshold, f.severity,
       (SELECT count(*) FROM ev s WHERE s.kpi = f.kpi AND s.event = 'SUPPRESS' AND s.alert_no = f.alert_no) AS suppressed_polls
FROM ev f WHERE f.event = 'FIRE'"""

SEGMENTS = f"""seg AS (
  SELECT 'current_month_default_rate' AS kpi, row_number() OVER (ORDER BY v DESC, risk_tier, category, state) AS rank,
         risk_tier || ' / ' || category || ' / ' || state AS segment, 'default_rate_pct' AS measure, v AS value
  FROM (SELECT risk_tier, category, state, {pct("count(*) FILTER (WHERE loan_status = 'DEFAULTED')", 'count(*)', 4)} AS v
        FROM w_loanx WHERE issue_date BETWEEN {AS_OF} - 30 AND {AS_OF} GROUP BY 1, 2, 3)
  UNION ALL
  SELECT 'par30_30d_avg', row_number() OVER (ORDER BY outstanding_balance DESC, loan_id), loan_id || ' / ' || customer_id, 'outstanding',
         {dbl('outstanding_balance')} FROM w_loanx WHERE days_past_due BETWEEN 30 AND 89
  UNION ALL
  SELECT 'anomaly_count_yesterday', row_number() OVER (ORDER BY anomaly_score DESC, transaction_id), transaction_id || ' / ' || customer_id,
         'anomaly_score', {dbl('anomaly_score')} FROM w_txnx WHERE is_anomaly AND txn_date = {AS_OF} - 1
  UNION ALL
  SELECT 'overall_npl_ratio', row_number() OVER (ORDER BY v DESC, risk_tier, category), risk_tier || ' / ' || category, 'avg_npl_pct', v
  FROM (SELECT risk_tier, product_category AS category, {rnd('avg(npl_ratio_pct)', 4)} AS v FROM ({NPL_RATIO}) WHERE year = 2001 GROUP BY 1, 2)),
found AS (SELECT CAST(kpi AS VARCHAR) AS kpi, CAST(rank AS INT) AS rank, segment, measure, value FROM seg
          WHERE rank <= 10 AND kpi IN (SELECT kpi FROM snap_checked WHERE breached))"""

SNAP_CHECKED = (
    f"{SNAP}, " + checked("snap", 2).replace("limits AS", "snap_limits AS").replace("JOIN limits l", "JOIN snap_limits l")
    .replace("vals AS", "snap_vals AS").replace("FROM vals v", "FROM snap_vals v").replace("checked AS", "snap_checked AS")
)

PAYLOAD = f"""WITH {SNAP_CHECKED}, {SEGMENTS}, {HISTORY}, {checked('history', 6)}, {EVENTS},
bodies AS (SELECT kpi, string_agg(CAST(rank AS VARCHAR) || '. ' || segment || ': ' || measure || ' = ' || printf('%.4f', value), chr(10) ORDER BY rank) AS body
           FROM found GROUP BY kpi),
shown AS (SELECT ev.*, max(CASE WHEN event = 'FIRE' THEN value END) OVER (PARTITION BY kpi, alert_no) AS shown_value FROM ev),
flat AS (SELECT as_of, s.kpi, event, '#portfolio-alerts' AS channel,
  CASE WHEN event = 'RESOLVE' THEN '#38A169' WHEN severity = 'CRITICAL' THEN '#E53E3E' ELSE '#F0A500' END AS color,
  CASE WHEN event = 'FIRE' THEN 'Portfolio alert: ' || severity || ' – ' || kpi_name ELSE 'Resolved – ' || kpi_name END AS header,
  '*KPI:*' || chr(10) || kpi_name AS field_kpi,
  CASE WHEN event = 'FIRE' THEN '*Severity:*' || chr(10) || severity END AS field_severity,
  '*Current Value:*' || chr(10) || '`' || printf('%.4f', shown_value) || '`' AS field_value,
  '*Threshold:*' || chr(10) || '`' || printf('%.4f', threshold) || '`' AS field_threshold,
  CASE WHEN event = 'FIRE' THEN '*Detected At:*' ELSE '*Resolved At:*' END || chr(10) || CAST(as_of AS VARCHAR) AS field_time,
  CASE WHEN event = 'FIRE' THEN '*Direction:*' || chr(10) || 'ABOVE' END AS field_direction,
  CASE WHEN event = 'FIRE' THEN left(coalesce(body, 'No data found.'), 2900) END AS body
 FROM shown s LEFT JOIN bodies b ON b.kpi = s.kpi WHERE event IN ('FIRE', 'RESOLVE'))
SELECT *, CAST(CASE WHEN event = 'FIRE'
  THEN to_json({{'channel': channel, 'color': color, 'header': header,
       'fields': [field_kpi, field_severity, field_value, field_threshold, field_time, field_direction], 'body': body}})
  ELSE to_json({{'channel': channel, 'color': color, 'header': header, 'fields': [field_kpi, field_value, field_threshold, field_time]}}) END AS VARCHAR) AS payload
FROM flat"""

DPD = """CASE WHEN {0} = 0 THEN 'Current (0 days)' WHEN {0} < 30 THEN 'PAR 1-29' WHEN {0} < 60 THEN 'PAR 30-59'
 WHEN {0} < 90 THEN 'PAR 60-89' ELSE 'NPL (90+ days)' END"""

BAD = "count(*) FILTER (WHERE loan_status = 'DEFAULTED')"


def book_at(day: str) -> str:
    return f"""SELECT {pct(f"count(*) FILTER (WHERE loan_status = 'DEFAULTED' AND issue_date >= date_trunc('month', {day}))",
      f"count(*) FILTER (WHERE issue_date >= date_trunc('month', {day}))", 4)} AS d,
  {pct('count(*) FILTER (WHERE is_npl)', 'count(*)', 4)} AS n, {dbl("sum(outstanding_balance) FILTER (WHERE loan_status = 'ACTIVE')")} AS p,
  {dbl("count(*) FILTER (WHERE loan_status = 'ACTIVE')")} AS l,
  (SELECT {rnd('avg(s)', 4)} FROM (SELECT {pct('risky', 'total', 4)} AS s FROM daily WHERE full_date BETWEEN {day} - 30 AND {day})) AS r
  FROM w_loan WHERE issue_date <= {day}"""


BEFORE = "DATE '2001-06-30'"
CARDS = f"""WITH {DAILY}, a AS ({book_at(AS_OF)}), b AS ({book_at(BEFORE)}),
fl AS (SELECT {dbl(f'count(*) FILTER (WHERE txn_date = {AS_OF} - 1)')} AS now, {dbl(f'count(*) FILTER (WHERE txn_date = {AS_OF} - 2)')} AS before
       FROM w_txn WHERE is_anomaly),
c AS (SELECT 'par30_30d_avg' AS kpi, a.r AS value, b.r AS previous_value, CAST(5 AS DOUBLE) AS threshold FROM a, b
 UNION ALL SELECT 'current_month_default_rate', a.d, b.d, 3 FROM a, b
 UNION ALL SELECT 'anomaly_count_yesterday', now, before, 50 FROM fl
 UNION ALL SELECT 'overall_npl_ratio', a.n, b.n, 8 FROM a, b
 UNION ALL SELECT 'total_active_portfolio', a.p, b.p, NULL FROM a, b
 UNION ALL SELECT 'active_loan_count', a.l, b.l, NULL FROM a, b)
SELECT kpi, value, previous_value, {rnd('value - previous_value', 4)} AS delta, threshold, {pct('value', 'threshold', 2)} AS pct_of_threshold FROM c"""


def heatmap(loans: str, txns: str, places: str) -> str:
    return f"""WITH places AS (SELECT DISTINCT country, state FROM w_region WHERE {places}),
b AS (SELECT country, state, count(*) FILTER (WHERE loan_status = 'ACTIVE') AS active, sum(outstanding_balance) AS total,
             sum(outstanding_balance) FILTER (WHERE {RISKY}) AS risky, {BAD} AS bad, count(*) AS n FROM w_loanx WHERE {loans} GROUP BY 1, 2),
f AS (SELECT country, state, count(*) AS flags FROM w_txnx WHERE is_anomaly AND {txns} GROUP BY 1, 2),
r AS (SELECT p.country, p.state, coalesce(active, 0) AS active_loans, {rnd('coalesce(CAST(total AS DOUBLE), 0) / 1e6', 2)} AS portfolio_millions,
             {pct('bad', 'n', 4)} AS default_rate_pct, {pct('risky', 'total', 4)} AS par30_pct, coalesce(flags, 0) AS anomaly_count
      FROM places p LEFT JOIN b ON b.country = p.country AND b.state = p.state LEFT JOIN f ON f.country = p.country AND f.state = p.state)
SELECT *, CASE WHEN default_rate_pct > 5 THEN 'HIGH' WHEN default_rate_pct > 3 THEN 'MEDIUM' ELSE 'LOW' END AS score FROM r"""


ZROWS = f"""SELECT transaction_id, customer_id, {dbl('amount')} AS amount, {rnd('z_score', 6)} AS z_score,
 {dbl('anomaly_score')} AS anomaly_score, is_anomaly, anomaly_reason FROM w_txnx"""

TEXTS = {
    "kpi_cache": with_views(SNAPSHOT, "w_loan", "w_txn"),
    "mon_kpi_history": with_views(f"WITH {HISTORY} SELECT * FROM history", "w_loan", "w_txn"),
    "mon_breaches": with_views(f"""WITH {SNAP}, {checked('snap', 2)}
SELECT as_of, kpi, kpi_name, value, threshold, 'above' AS direction, severity FROM checked WHERE breached""", "w_loan", "w_txn"),
    "mon_alert_lifecycle": with_views(LIFECYCLE, "w_loan", "w_txn"),
    "stream_alerts": with_views(LIFECYCLE, "w_loan", "w_txn"),
    "mon_breaches_below": with_views(f"""WITH {SNAP}, {checked('snap', 2)}
SELECT as_of, kpi, kpi_name, value, threshold, 'above' AS direction, severity FROM checked WHERE breached AND kpi <> 'overall_npl_ratio'
UNION ALL SELECT as_of, kpi, kpi_name, value, 90.0, 'below', CASE WHEN value < 60 THEN 'CRITICAL' ELSE 'WARNING' END
FROM checked WHERE kpi = 'overall_npl_ratio' AND value < 90""", "w_loan", "w_txn"),
    "mon_messages": with_views(f"""WITH m AS (SELECT kpi_name || ' fired, alert ' || CAST(alert_no AS VARCHAR) AS body, severity FROM ({LIFECYCLE})),
f AS (SELECT '#portfolio-alerts' AS channel, CASE severity WHEN 'CRITICAL' THEN '#E53E3E' ELSE '#F0A500' END AS color,
             'Portfolio message [' || severity || ']' AS header, body FROM m)
SELECT *, CAST(to_json({{'channel': channel, 'color': color, 'header': header, 'body': body}}) AS VARCHAR) AS payload FROM f""", "w_loan", "w_txn"),
    "stream_landing": with_views("""SELECT customer_id, first_name, last_name, date_of_birth, gender, email, phone, employment_status,
       annual_income, credit_score, city, state, country FROM r_customers""", "r_customers"),
    "slicer_status_mix": with_views(f"""SELECT loan_status, count(*) AS loan_count, {dbl('sum(principal_amount)')} AS total_principal,
       {mean('principal_amount', 2)} AS avg_principal, {pct('count(*)', 'sum(count(*)) OVER ()', 2)} AS pct_of_portfolio
FROM w_loanx WHERE issue_date <= DATE '1999-06-30' AND category = 'SME' AND risk_tier = 'LOW' GROUP BY loan_status""", "w_loanx"),
    "slicer_volume": with_views(f"""SELECT txn_date AS full_date, transaction_type, count(*) AS txn_count, {dbl('sum(amount)')} AS total_volume
FROM w_txnx WHERE txn_date BETWEEN DATE '2001-07-05' AND DATE '2001-07-20' AND state = 'State_4' GROUP BY 1, 2""", "w_txnx"),
    "stream_alerts_late": with_views(LIFECYCLE, "w_loan", "w_txn"),
    "stream_daily_disorder": with_views("""SELECT txn_date AS full_date, transaction_type, count(*) AS total_txns,
       count(*) FILTER (WHERE is_anomaly) AS anomaly_count FROM w_txn GROUP BY 1, 2""", "w_txn"),
    "stream_dedup_disorder": """WITH l AS (SELECT CAST(l_shipdate AS DATE) AS d, CASE WHEN l_linenumber <> 7 THEN
       CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) || '-' || CAST(CAST(l_shipdate AS DATE) AS VARCHAR) END AS transaction_id FROM lineitem),
came AS (SELECT transaction_id, d FROM l UNION ALL SELECT transaction_id, d FROM l UNION ALL SELECT transaction_id, d + 60 FROM l),
judged AS (SELECT *, d - lag(d) OVER (PARTITION BY transaction_id ORDER BY d) AS since FROM came)
SELECT transaction_id, d AS ship_date FROM judged WHERE transaction_id IS NULL OR since IS NULL OR since > 7""",
    "stream_baseline": with_views(f"""SELECT CAST(customer_key AS VARCHAR) AS customer_id, {rnd('avg(CAST(amount AS DOUBLE))', 6)} AS avg_amount,
       {rnd('stddev_samp(CAST(amount AS DOUBLE))', 6)} AS sd_amount, count(*) AS n_txn FROM w_txn_base WHERE customer_key IS NOT NULL GROUP BY 1""", "w_txn_base"),
    "stream_zscore_partial": with_views(f"""SELECT transaction_id, CASE WHEN customer_key % 2 = 0 THEN {rnd('z_score', 6)} ELSE 0 END AS z_score,
       customer_key % 2 = 0 AND z_score > 3.0 AS is_anomaly FROM w_txnx""", "w_txnx"),
    "mon_alert_counts": with_views(f"""WITH {HISTORY}, {checked('history', 6)}, {EVENTS}
SELECT (SELECT count(*) FROM history) AS total_polls, (SELECT count(*) FROM ev WHERE event = 'FIRE') AS total_alerts_fired""", "w_loan", "w_txn"),
    "mon_investigate": with_views(f"WITH {SNAP_CHECKED}, {SEGMENTS} SELECT * FROM found", "w_loanx", "w_txnx"),
    "alert_payload": with_views(PAYLOAD, "w_loanx", "w_txnx"),
    "mon_volume_drop": with_views(f"""WITH v AS (SELECT txn_date AS period_start, country, state, sum(amount) AS volume FROM w_txnx GROUP BY 1, 2, 3),
p AS (SELECT *, lag(volume) OVER (PARTITION BY country, state ORDER BY period_start) AS prev FROM v),
c AS (SELECT *, {pct('(volume - prev)', 'prev', 2)} AS change_pct FROM p)
SELECT period_start, country, state, {dbl('volume')} AS volume, {dbl('prev')} AS previous_volume, change_pct FROM c WHERE change_pct < -20""", "w_txnx"),
    "stream_ingest": """SELECT 'TXN' || lpad(CAST(event_id AS VARCHAR), 14, '0') AS transaction_id, user_id + 1 AS customer_key,
       CAST(ts AS DATE) - 8219 AS txn_date, CASE event_type WHEN 'purchase' THEN 'REPAYMENT' WHEN 'view' THEN 'TRANSFER' WHEN 'click' THEN 'WITHDRAWAL'
         WHEN 'signup' THEN 'DEPOSIT' ELSE 'DISBURSEMENT' END AS transaction_type, CAST(CAST(value AS DECIMAL(18,2)) AS DOUBLE) AS amount,
       CASE WHEN event_id % 10 = 0 THEN NULL ELSE 'USD' END AS currency FROM events""",
    "stream_dedup": "SELECT DISTINCT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS transaction_id FROM lineitem",
    "stream_zscore": with_views(ZROWS, "w_txnx"),
    "stream_anomaly_daily": with_views("""SELECT txn_date AS full_date, transaction_type, count(*) AS total_txns,
       count(*) FILTER (WHERE is_anomaly) AS anomaly_count FROM w_txn
WHERE CAST(txn_date + 8219 + 1 AS TIMESTAMP) <= (SELECT max(ts) - INTERVAL 1 HOUR FROM events) GROUP BY 1, 2""", "w_txn"),
    "rpt_kpi_summary": with_views(f"""WITH {SNAP}, {limits(50)}, v AS ({' UNION ALL '.join(
        f"SELECT '{k}' AS kpi, CAST({k} AS DOUBLE) AS value FROM snap" for k in
        ('par30_30d_avg', 'current_month_default_rate', 'anomaly_count_yesterday', 'active_loan_count', 'overall_npl_ratio', 'total_active_portfolio'))})
SELECT v.kpi, coalesce(value, 0) AS value, threshold, CASE WHEN threshold IS NULL OR value IS NULL THEN NULL
       WHEN value > threshold * 1.5 THEN 'CRITICAL' WHEN value > threshold THEN 'WARNING' ELSE 'OK' END AS status
FROM v LEFT JOIN limits l ON l.kpi = v.kpi""", "w_loan", "w_txn"),
    "rpt_default_trend": with_views(f"""WITH v AS ({DEFAULT_RATE})
SELECT year, month_num, month_name, total_loans_issued, defaults, {rnd('default_rate_pct / 100.0', 6)} AS default_rate, ytd_defaults FROM v""", "w_loan"),
    "rpt_sink": with_views(f"""WITH v AS ({DEFAULT_RATE})
SELECT year, month_num, month_name, total_loans_issued, defaults, {rnd('default_rate_pct / 100.0', 6)} AS default_rate, ytd_defaults FROM v""", "w_loan"),
    "rpt_par30_90d": with_views(f"""WITH v AS ({PAR30})
SELECT full_date, par30_pct, par30_7d_avg, par30_30d_avg FROM v ORDER BY full_date DESC LIMIT 90""", "w_loan"),
    "rpt_anomaly_500": with_views(f"""WITH v AS ({ANOMALY_SUMMARY})
SELECT full_date, transaction_type, country, anomaly_count, total_txns, anomaly_rate_pct, anomalous_volume
FROM (SELECT * FROM v ORDER BY full_date DESC, anomaly_count DESC, transaction_type, country, state LIMIT 500)""", "w_txnx"),
    "rpt_npl_200": with_views(f"""WITH v AS ({NPL_RATIO})
SELECT year, month_name, risk_tier, product_category, total_loans, npl_loans, npl_ratio_pct
FROM (SELECT * FROM v ORDER BY year DESC, npl_ratio_pct DESC, month_num, risk_tier, product_category LIMIT 200)""", "w_loanx"),
    "bi_par30": with_views(f"SELECT coalesce({pct('sum(outstanding_balance) FILTER (WHERE is_par30)', 'sum(outstanding_balance)', 4)}, 0) AS par30_rate FROM w_loan", "w_loan"),
    "bi_npl": with_views(f"SELECT coalesce({pct('count(*) FILTER (WHERE is_npl)', 'count(*)', 4)}, 0) AS npl_ratio FROM w_loan", "w_loan"),
    "bi_default_mom": with_views(f"""WITH c AS (SELECT
  count(*) FILTER (WHERE loan_status = 'DEFAULTED' AND issue_date BETWEEN DATE '2001-07-01' AND {AS_OF}) AS current_month,
  count(*) FILTER (WHERE loan_status = 'DEFAULTED' AND issue_date BETWEEN DATE '2001-06-01' AND DATE '2001-06-30') AS previous_month FROM w_loan)
SELECT *, coalesce({pct('(current_month - previous_month)', 'previous_month', 2)}, 0) AS default_rate_mom FROM c""", "w_loan"),
    "bi_default_matrix": with_views(f"""SELECT risk_tier, category, {BAD} AS defaults, count(*) AS total_loans, {pct(BAD, 'count(*)', 4)} AS default_rate_pct
FROM w_loanx GROUP BY 1, 2""", "w_loanx"),
    "bi_default_matrix_new_category": with_views(f"""SELECT risk_tier, CASE category WHEN 'AUTO' THEN 'BOAT' ELSE category END AS category,
       {BAD} AS defaults, count(*) AS total_loans, {pct(BAD, 'count(*)', 4)} AS default_rate_pct FROM w_loanx GROUP BY 1, 2""", "w_loanx"),
    "bi_top_states": with_views(f"""SELECT state, {BAD} AS defaults, count(*) AS total_loans, {pct(BAD, 'count(*)', 4)} AS default_rate_pct
FROM w_loanx GROUP BY state ORDER BY default_rate_pct DESC, state LIMIT 10""", "w_loanx"),
    "bi_txn_daily_by_type": with_views(f"""SELECT txn_date AS full_date, transaction_type, count(*) AS txn_count, {dbl('sum(amount)')} AS total_volume
FROM w_txn_base GROUP BY 1, 2""", "w_txn_base"),
    "bi_txn_by_region": with_views(f"""SELECT country, state, city, count(*) AS txn_count, {dbl('sum(amount)')} AS total_volume
FROM w_txn_base t JOIN w_region r ON r.region_key = t.region_key GROUP BY 1, 2, 3""", "w_txn_base", "w_region"),
    "bi_anomaly_scatter": with_views(f"""SELECT transaction_id, {dbl('amount')} AS amount, {dbl('anomaly_score')} AS anomaly_score
FROM w_txn WHERE is_anomaly""", "w_txn"),
    "bi_dpd_transitions": with_views(f"""SELECT {DPD.format('old_dpd')} AS old_bucket, {DPD.format('new_dpd')} AS new_bucket,
       count(*) AS loans, {dbl('sum(outstanding_balance)')} AS balance FROM w_loan_day2 GROUP BY 1, 2""", "w_loan_day2"),
    "bi_par_region_month": with_views(f"""SELECT state, CAST(year(issue_date) AS INT) AS year, {', '.join(
        pct(f'sum(outstanding_balance) FILTER (WHERE {RISKY} AND month(issue_date) = {m})',
            f'sum(outstanding_balance) FILTER (WHERE month(issue_date) = {m})', 4) + f' AS m{m:02d}' for m in range(1, 13))}
FROM w_loanx GROUP BY 1, 2""", "w_loanx"),
    "bi_top20_at_risk": with_views(f"""SELECT loan_id, customer_id, risk_tier, category, state, days_past_due, {dbl('outstanding_balance')} AS outstanding
FROM w_loanx WHERE is_par30 ORDER BY outstanding_balance DESC, loan_id LIMIT 20""", "w_loanx"),
    "dash_cards": with_views(CARDS, "w_loan", "w_txn"),
    "dash_default_quarterly": with_views(f"""SELECT 'Q' || CAST(quarter(q) AS VARCHAR) || ' ' || CAST(year(q) AS VARCHAR) AS quarter, q AS quarter_start,
       defaults, total_loans, {pct('defaults', 'total_loans', 4)} AS default_rate_pct
FROM (SELECT CAST(date_trunc('quarter', issue_date) AS DATE) AS q, {BAD} AS defaults, count(*) AS total_loans FROM w_loan GROUP BY 1)""", "w_loan"),
    "dash_risk_mix": with_views(f"""SELECT risk_tier, count(*) AS loans, {dbl('sum(outstanding_balance)')} AS portfolio,
       {pct('sum(outstanding_balance)', 'sum(sum(outstanding_balance)) OVER ()', 2)} AS pct_of_portfolio FROM w_loanx GROUP BY 1""", "w_loanx"),
    "dash_par_bucket_share": with_views(f"""SELECT {DPD.format('days_past_due')} AS dpd_bucket, {dbl('sum(outstanding_balance)')} AS portfolio,
       {pct('sum(outstanding_balance)', 'sum(sum(outstanding_balance)) OVER ()', 2)} AS pct_of_portfolio FROM w_loan GROUP BY 1""", "w_loan"),
    "dash_daily_anomalies": with_views(f"""WITH d AS (SELECT CAST(unnest(generate_series({AS_OF} - 30, {AS_OF} - 1, INTERVAL 1 DAY)) AS DATE) AS full_date)
SELECT full_date, count(t.txn_date) AS anomaly_count, CAST(50 AS DOUBLE) AS threshold
FROM d LEFT JOIN (SELECT txn_date FROM w_txn WHERE is_anomaly) t ON t.txn_date = full_date GROUP BY full_date""", "w_txn"),
    "dash_loan_status": with_views("SELECT loan_status, count(*) AS loans FROM w_loan GROUP BY 1", "w_loan"),
    "dash_region_heatmap": with_views(
        heatmap(f"issue_date BETWEEN {AS_OF} - 365 AND {AS_OF}", f"txn_date BETWEEN {AS_OF} - 365 AND {AS_OF}", "TRUE"), "w_loanx", "w_txnx"),
    "dash_region_heatmap_country": with_views(heatmap("TRUE", "TRUE", "lower(country) = 'europe'"), "w_loanx", "w_txnx"),
    "slicer_default_rate": with_views(DEFAULT_RATE.replace("FROM w_loan GROUP", """FROM w_loanx WHERE issue_date BETWEEN DATE '1997-01-01'
  AND DATE '2000-12-31' AND risk_tier = 'HIGH' AND category = 'AUTO' AND state = 'State_3' GROUP"""), "w_loanx"),
}
