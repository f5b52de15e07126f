"""Hand rows for the edges of every rule."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from lendscope.functions import credit, dates, numbers, text
from lendscope.plans import eda, etl, kpi, monitor, reports
from lendscope.sources.bridge import AS_OF, bridge_star

D = dt.date
T1, T2 = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2)


def one(spark, column, **values):
    """Evaluate ``column`` over one row."""
    types = ", ".join(f"{n} {t}" for n, (t, _) in values.items())
    frame = spark.createDataFrame([tuple(v for _, v in values.values())], types)
    return frame.select(column.alias("out")).first().out


@pytest.mark.parametrize(
    "x, digits, want", [(2.675, 2, 2.68), (-2.675, 2, -2.68), (0.5, 0, 1.0), (1.00005, 4, 1.0001), (0.0, 2, 0.0), (None, 2, None)]
)
def test_half_up(spark, x, digits, want):
    assert one(spark, numbers.half_up(F.col("x"), digits), x=("double", x)) == want


def test_percent_of_nothing_is_null(spark):
    assert one(spark, numbers.percent(F.col("a"), F.col("b"), 2), a=("int", 5), b=("int", 0)) is None


@pytest.mark.parametrize(
    "raw, want",
    [
        ("self-employed", "Self-Employed"), ("o'neil-BUILDING", "O'Neil-Building"), ("new york", "New York"),
        ("état d'été", "État D'Été"), ("a1b 2c", "A1b 2c"), ("", ""), (None, None),
    ],
)
def test_title_case(spark, raw, want):
    assert one(spark, text.title_case(F.col("x")), x=("string", raw)) == want


@pytest.mark.parametrize(
    "score, tier",
    [(850, "LOW"), (849, "LOW"), (750, "LOW"), (749, "MEDIUM"), (650, "MEDIUM"), (649, "HIGH"), (550, "HIGH"), (549, "CRITICAL"),
     (300, "CRITICAL"), (299, "CRITICAL"), (None, "CRITICAL")],
)
def test_risk_tier(spark, score, tier):
    assert one(spark, credit.risk_tier(F.col("x")), x=("int", score)) == tier


@pytest.mark.parametrize(
    "days, bucket, npl, par",
    [(0, "Current (0 days)", False, False), (1, "PAR 1-29", False, False), (29, "PAR 1-29", False, False), (30, "PAR 30-59", False, True),
     (59, "PAR 30-59", False, True), (60, "PAR 60-89", False, True), (89, "PAR 60-89", False, True), (90, "NPL (90+ days)", False, False),
     (91, "NPL (90+ days)", True, False), (180, "NPL (90+ days)", True, False)],
)
def test_delinquency(spark, days, bucket, npl, par):
    d = F.col("x")
    assert one(spark, credit.dpd_bucket(d), x=("int", days)) == bucket
    assert one(spark, credit.is_npl(d), x=("int", days)) is npl
    assert one(spark, credit.is_par30(d), x=("int", days)) is par


def test_npl_from_day_90_and_write_off(spark):
    assert one(spark, credit.is_npl(F.col("x"), 90), x=("int", 90)) is True
    assert one(spark, credit.dpd_bucket(F.col("x"), True), x=("int", 180)) == "Write-off (180+ days)"
    assert one(spark, credit.dpd_bucket(F.col("x"), True), x=("int", 179)) == "NPL (90+ days)"


@pytest.mark.parametrize(
    "p, r, n, want", [("1200.00", "0.00", 12, 100.0), ("1200.00", "12.00", 12, 106.62), ("1000.00", "5.00", 0, None), ("1000.00", "0.00", 0, None)]
)
def test_installment(spark, p, r, n, want):
    from decimal import Decimal

    col = credit.monthly_installment(F.col("p"), F.col("r"), F.col("n"))
    got = one(spark, col, p=("decimal(18,2)", Decimal(p)), r=("decimal(5,2)", Decimal(r)), n=("int", n))
    assert got == want


@pytest.mark.parametrize("born, age", [(D(1990, 6, 15), 34), (D(1990, 6, 16), 33), (D(1990, 6, 14), 34), (None, None)])
def test_age_at_the_birthday(spark, born, age):
    assert one(spark, dates.whole_years(F.col("b"), F.lit("2024-06-15").cast("date")), b=("date", born)) == age


def test_calendar_of_a_sunday(spark):
    frame = spark.createDataFrame([(D(2023, 1, 1),)], "d date")
    row = frame.select(*[c.alias(n) for n, c in dates.calendar_columns(F.col("d")).items()]).first()
    assert (row.date_key, row.day_of_week, row.week_of_year, row.is_weekend) == (20230101, 7, 52, True)
    assert (row.day_name, row.month_name, row.fiscal_period) == ("Sunday", "January", "FY23Q1")


def test_full_calendar_size(spark):
    days = spark.sql("SELECT explode(sequence(DATE '2018-01-01', DATE '2030-12-31')) AS d")
    assert days.select(*[c.alias(n) for n, c in dates.calendar_columns(F.col("d")).items()]).count() == 4748


def test_key_to_date_inverts_date_key(spark):
    day = D(2024, 2, 29)
    assert one(spark, dates.key_to_date(dates.date_key(F.col("d"))), d=("date", day)) == day


def test_histogram_edges(spark, small):
    star = bridge_star(spark, small)
    scores = [299, 300, 349, 350, 849, 850, None]
    people = spark.createDataFrame([(s,) for s in scores], "credit_score int")
    got = {r.bucket: r.customers for r in eda.credit_score_hist(star.replaced(customer=people)).collect()}
    assert got == {0: 1, 1: 2, 2: 1, 11: 1, 12: 1}


# --- loads -------------------------------------------------------------------

CUSTOMER = "customer_id string, first_name string, last_name string, date_of_birth string, gender string, email string, phone string, employment_status string, annual_income string, credit_score string, city string, state string, country string, _ingested_at timestamp"
LOAN = "loan_id string, customer_id string, product_code string, issue_date string, maturity_date string, principal_amount string, interest_rate string, tenure_months string, loan_status string, days_past_due string, outstanding_balance string, _ingested_at timestamp"
TXN = "transaction_id string, customer_id string, loan_id string, transaction_date string, transaction_type string, amount string, currency string, fee_amount string, city string, state string, country string, _ingested_at timestamp"
PRODUCT = "product_code string, product_name string, category string, sub_category string, interest_rate_min string, interest_rate_max string, min_tenure_months string, max_tenure_months string, is_secured string, collateral_type string, _ingested_at timestamp"


def person(cid, city="Paris", country="France", income="$1,234.50", score="700", at=T1, born="1990-01-02"):
    return (cid, " ann", "lee", born, "female", "A@B.C ", "1", "self-employed", income, score, city, "S1", country, at)


@pytest.fixture(scope="module")
def people(spark):
    return spark.createDataFrame(
        [
            person("C1"),
            person(" C1 ", city="Rome", income="$9", at=T2),
            person("C2", score=""),
            person("C3", score="bad"),
            person("C4", born="not a day"),
            person("  "),
            person(None),
            person("C5", city="London", country="Wales"),
            person("C6", city=" london ", country="england"),
            person("C7", city=None),
        ],
        CUSTOMER,
    )


def test_newest_customer_row_wins_and_rejects_are_told(spark, people):
    checked = etl.checked_customers(people).collect()
    by_id = {}
    for r in checked:
        by_id.setdefault(r.customer_id, []).append(r)
    assert sum(r._rows for r in checked) == people.count()  # every landing row is accounted for
    (c1,) = by_id["C1"]
    told = {(r.row_id, r.reason): r.rows for r in etl.rejects(etl.checked_customers(people), "s", "customer_id").collect()}
    assert told["C1", etl.REPEATED] == c1._rows - 1 > 0
    assert float(c1.annual_income) == 9.0 and c1.first_name == "Ann" and c1.gender == "F" and c1.email == "a@b.c"
    assert c1.employment_status == "Self-Employed" and c1.reject_reason is None
    assert by_id["C2"][0].credit_score is None and by_id["C2"][0].risk_tier == "CRITICAL"
    assert by_id["C3"][0].reject_reason == "bad number"
    assert by_id["C4"][0].reject_reason == "bad date"
    # two rows without a key stay two rejects
    assert [r.reject_reason for k in (None, "") for r in by_id[k]] == ["no key", "no key"]


def test_strict_mode_raises_on_a_bad_value(spark, people):
    with pytest.raises(PySparkException):
        etl.checked_customers(people, strict=True).collect()


def test_regions_of_two_countries_share_an_id(spark, people):
    got = {(r.city, r.state): (r.country, r.region_tier) for r in etl.regions(people).collect()}
    assert got == {("Paris", "S1"): ("France", "SEMI-URBAN"), ("Rome", "S1"): ("France", "SEMI-URBAN"), ("London", "S1"): ("England", "URBAN")}


@pytest.fixture(scope="module")
def dims(spark, people):
    customers = etl.accepted(etl.checked_customers(people))
    regions = etl.regions(people).withColumn("region_key", F.when(F.col("city") == "Rome", 7).otherwise(8))
    keyed = customers.withColumns({"customer_key": F.substr("customer_id", F.lit(2)).cast("bigint"), "is_current": F.lit(True)})
    products = spark.createDataFrame([("P1", 1)], "product_code string, product_key int")
    return keyed, regions, products


def loan_row(lid, cid="C1", code="p1 ", rate="12.0", tenure="12", dpd="", issue="2024-01-05", principal="1200"):
    return (lid, cid, code, issue, "", principal, rate, tenure, " active", dpd, "10.5", T1)


def test_loans(spark, dims):
    customers, regions, products = dims
    raw = spark.createDataFrame(
        [
            loan_row("L1"), loan_row(" L1 ", dpd="95"), loan_row("L2", cid="C9"), loan_row("L3", code="zz"), loan_row("L4", rate="x"),
            loan_row("L5", issue="2024-13-01"), loan_row("L6", principal=""), loan_row("L7", cid="C7"), loan_row("L8", rate="0", tenure="0"),
            loan_row(None), loan_row("L9", dpd="90"),
        ],
        LOAN,
    )
    places = etl.customer_places(customers, regions)
    checked = etl.checked_loans(raw, places, products, default_region_key=1)
    rows, told = checked.collect(), etl.rejects(checked, "s", "loan_id").collect()
    assert [(r.row_id, r.rows) for r in told if r.reason == etl.REPEATED] == [("L1", 1)] and sum(r._rows for r in rows) == raw.count()
    got = {r.loan_id: r for r in rows}
    assert got["L7"].region_defaulted and not got["L1"].region_defaulted
    reasons = {k: r.reject_reason for k, r in got.items()}
    assert reasons == {
        "L1": None, "L2": "unknown customer", "L3": "unknown product", "L4": "bad number", "L5": "bad date", "L6": "missing value",
        "L7": None, "L8": None, None: "no key", "L9": None,
    }
    # the customer moved to Rome in the newest row: one region, no second loan
    assert got["L1"].region_key == 7 and got["L1"].days_past_due == 95 and got["L1"].is_npl
    assert got["L7"].region_key == 1
    assert got["L8"].monthly_installment is None and got["L8"].total_interest is None
    assert float(got["L7"].monthly_installment) == 106.62 and got["L7"].issue_date_key == 20240105
    assert got["L7"].maturity_date_key is None and got["L7"].loan_status == "ACTIVE"
    assert not got["L9"].is_npl and not got["L9"].is_par30


def txn_row(tid, cid="C1", amount="10", loan="L1", city="rome", cur="EUR", day="2024-02-01"):
    return (tid, cid, loan, day, "transfer ", amount, cur, "", city, "S1", "x", T1)


def test_transactions(spark, dims):
    customers, regions, _ = dims
    usual = [txn_row(f"U{i}", amount="10") for i in range(30)]
    raw = spark.createDataFrame(
        usual
        + [
            txn_row("BIG", cid=" C1", amount="5000"), txn_row("SOLO", cid="C2", amount="77", loan="nope"), txn_row("E1", cid="C5", amount="4"),
            txn_row("E2", cid="C5", amount="4"), txn_row("UC", cid="C99"), txn_row("UR", city="nowhere"), txn_row("BN", cid="C6", amount="x"),
            txn_row("MV", cid="C6", amount=""), txn_row("BD", cid="C6", day="1/2/2024"), txn_row("CU", cid="C6", cur=None), txn_row(" U1", amount="11"),
        ],
        TXN,
    )
    loans = spark.createDataFrame([("L1", 55)], "loan_id string, loan_key bigint")
    got = {r.transaction_id: r for r in etl.checked_transactions(raw, customers, regions, loans).collect()}
    assert len(got) == 40
    assert got["BIG"].is_anomaly and got["BIG"].anomaly_reason == credit.ANOMALY_REASON and got["BIG"].loan_key == 55
    # one row: no deviation; equal amounts: deviation 0; both score 0
    for tid in ("SOLO", "E1", "E2"):
        assert float(got[tid].anomaly_score) == 0.0 and not got[tid].is_anomaly and got[tid].reject_reason is None
    assert got["SOLO"].loan_key is None and got["CU"].currency == "USD" and float(got["CU"].fee_amount) == 0.0
    assert {t: got[t].reject_reason for t in ("UC", "UR", "BN", "MV", "BD")} == {
        "UC": "unknown customer", "UR": "unknown region", "BN": "bad number", "MV": "missing value", "BD": "bad date",
    }


def test_products(spark):
    raw = spark.createDataFrame(
        [(" p1", "home-loan plan", " auto", "fixed rate", "", "9.5", "", "60", "YES", "  ", T1), ("P1 ", "new name", "auto", "x", "1", "2", "3", "4", None, "Car", T2),
         ("p2", "n", "sme", "x", "abc", "2", "3", "4", "no", "Car", T1)],
        PRODUCT,
    )
    got = {r.product_code: r for r in etl.checked_products(raw).filter(f"reject_reason IS DISTINCT FROM '{etl.REPEATED}'").collect()}
    assert got["P1"].product_name == "New Name" and got["P1"].is_secured is False and got["P1"].reject_reason is None
    assert got["P2"].reject_reason == "bad number"


def test_scd2_history(spark):
    start = spark.createDataFrame([("a", 1), ("b", 2), ("n", None)], "id string, v int").withColumns(etl.open_version(D(2024, 1, 1)))
    batch = spark.createDataFrame([("a", 1), ("b", 3), ("c", 4), ("n", None)], "id string, v int")
    once = etl.scd2(start, batch, "id", ["v"], D(2024, 2, 1))
    history = sorted((r.id, r.v, r.effective_date, r.is_current) for r in once.collect() if r.id != "n")
    assert history == [
        ("a", 1, D(2024, 1, 1), True), ("b", 2, D(2024, 1, 1), False), ("b", 3, D(2024, 2, 1), True), ("c", 4, D(2024, 2, 1), True),
    ]
    twice = etl.scd2(once, batch, "id", ["v"], D(2024, 3, 1))
    assert sorted(map(str, once.collect())) == sorted(map(str, twice.collect()))


# --- indicators --------------------------------------------------------------


def star_of(spark, small, loans):
    """A star over hand-made loans: (key, day, balance, dpd, status)."""
    frame = spark.createDataFrame(loans, "loan_key bigint, issue_date date, balance int, days_past_due int, loan_status string").select(
        "*",
        F.col("balance").cast("decimal(18,2)").alias("outstanding_balance"),
        F.col("balance").cast("decimal(18,2)").alias("principal_amount"),
        credit.is_npl(F.col("days_past_due")).alias("is_npl"),
        credit.is_par30(F.col("days_past_due")).alias("is_par30"),
    )
    return bridge_star(spark, small).replaced(loan=frame)


LOANS = [
    (1, D(2024, 1, 1), 100, 0, "ACTIVE"), (2, D(2024, 1, 1), 100, 45, "ACTIVE"), (3, D(2024, 1, 2), 50, 0, "ACTIVE"),
    (4, D(2024, 1, 3), 80, 90, "DEFAULTED"), (5, D(2024, 2, 3), 20, 95, "DEFAULTED"), (6, D(2024, 2, 4), 0, 0, "CLOSED"),
]


def test_par30_keeps_null_and_zero_fills(spark, small):
    star = star_of(spark, small, LOANS)
    got = {r.full_date: r for r in kpi.par30(star).collect()}
    assert got[D(2024, 1, 1)].par30_pct == 50.0 and got[D(2024, 1, 2)].par30_pct is None
    # the mean skips the NULL day
    assert got[D(2024, 1, 2)].par30_7d_avg == 50.0
    # zero portfolio: no share even when filled
    filled = {r.full_date: r for r in kpi.par30(star, zero_fill=True).collect()}
    assert filled[D(2024, 1, 2)].par30_pct == 0.0 and filled[D(2024, 1, 2)].par30_7d_avg == 25.0
    assert filled[D(2024, 2, 4)].par30_pct is None


def test_three_at_risk_rules(spark, small):
    star = star_of(spark, small, LOANS)

    def total(rule):
        return sum(r.at_risk_loans for r in kpi.par30(star, rule).collect())

    # day 90 is in neither flag but past 30 days
    assert (total("par_or_npl"), total("par_only"), total("dpd30")) == (2, 1, 3)


def test_default_rate_to_date_counts(spark, small):
    got = kpi.default_rate(star_of(spark, small, LOANS)).collect()
    assert [(r.month_num, r.defaults, r.default_rate_pct, r.qtd_defaults, r.ytd_defaults) for r in got] == [(1, 1, 25.0, 1, 1), (2, 1, 50.0, 2, 2)]


def test_npl_from_another_day(spark, small):
    star = star_of(spark, small, LOANS).with_npl_from(90)
    assert reports.bi_npl(star).first().npl_ratio == 33.3333


def test_empty_book_gives_zero_not_null(spark, small):
    star = star_of(spark, small, [(1, D(2024, 1, 1), 0, 0, "CLOSED")])
    none = star.replaced(loan=star.loan.filter("loan_key < 0"))
    assert reports.bi_par30(none).first().par30_rate == 0.0 and reports.bi_npl(none).first().npl_ratio == 0.0


def test_history_row_is_the_snapshot_of_its_day(spark, small):
    star = bridge_star(spark, small)
    history = {r.snapshot_ts: r for r in kpi.kpi_history(star, D(2001, 7, 10), AS_OF).collect()}
    for day in (D(2001, 7, 10), D(2001, 7, 21), AS_OF):
        assert kpi.kpi_snapshot(star, day, known_only=True).first() == history[day]


def test_calendar_option_fills_days(spark, small):
    star = bridge_star(spark, small)
    plain, dense = kpi.txn_volume(star), kpi.txn_volume(star, calendar=True)
    grain = ["country", "state", "city", "transaction_type"]
    spans = dense.groupBy(*grain).agg(F.count("*").alias("n"), (F.datediff(F.max("full_date"), F.min("full_date")) + 1).alias("d"))
    assert spans.filter("n <> d").count() == 0
    assert dense.count() > plain.count() and dense.agg(F.sum("txn_count")).first()[0] == plain.agg(F.sum("txn_count")).first()[0]


def test_shares_and_rollup_add_up(spark, small):
    star = bridge_star(spark, small)
    assert abs(sum(r.pct_of_portfolio for r in eda.status_mix(star).collect()) - 100) < 0.05
    assert abs(sum(r.pct_count for r in eda.dpd_buckets(star).collect()) - 100) < 0.05
    rolled = eda.txn_rollup(star).collect()
    total = next(r for r in rolled if r.level == 7)
    for level in (0, 1, 3):
        assert sum(r.txn_count for r in rolled if r.level == level) == total.txn_count


def test_approximate_percentiles_are_near(spark, small):
    star = bridge_star(spark, small)
    exact, near = eda.loan_stats(star).first(), eda.loan_stats(star, approximate=True).first()
    assert near.median == pytest.approx(exact.median, rel=0.01) and near.p95 == pytest.approx(exact.p95, rel=0.01)


# --- alerts ------------------------------------------------------------------


def polls(spark, values):
    """Snapshots with the flag count of each poll; None skips the poll."""
    rows = [(D(2024, 1, 1) + dt.timedelta(days=i), None, None, v, None) for i, v in enumerate(values) if v != "skip"]
    return spark.createDataFrame(
        rows,
        "snapshot_ts date, par30_30d_avg double, current_month_default_rate double, anomaly_count_yesterday bigint, overall_npl_ratio double",
    )


def test_lifecycle(spark):
    got = monitor.alert_lifecycle(polls(spark, [10, 60, 80, "skip", 70, 50, 51, None])).collect()
    assert [(r.alert_no, r.triggered_at.day, r.resolved_at.day, r.trigger_value, r.severity, r.suppressed_polls) for r in got] == [
        (1, 2, 6, 60.0, "WARNING", 2), (2, 7, 8, 51.0, "WARNING", 0),
    ]


def test_open_alert_has_no_end(spark):
    (alert,) = monitor.alert_lifecycle(polls(spark, [76, 90])).collect()
    assert alert.resolved_at is None and alert.severity == "CRITICAL"
    counts = monitor.alert_counts(polls(spark, [76, 90, 1, 99])).first()
    assert (counts.total_polls, counts.total_alerts_fired) == (4, 2)


def test_threshold_below(spark):
    limits = (monitor.Threshold("anomaly_count_yesterday", "Flags", 30.0, monitor.BELOW),)
    got = {r.as_of.day: (r.breached, r.severity) for r in monitor.evaluate(polls(spark, [30, 29, 20, 19]), limits).collect()}
    assert got == {1: (False, None), 2: (True, "WARNING"), 3: (True, "WARNING"), 4: (True, "CRITICAL")}


def test_fire_and_resolve_alternate(spark):
    import random

    rng = random.Random(1)
    rows = monitor.events(monitor.evaluate(polls(spark, [rng.randint(30, 70) for _ in range(200)]))).filter("event <> 'SUPPRESS'")
    names = [r.event for r in rows.orderBy("as_of").collect()]
    assert names and all(a != b for a, b in zip(names, names[1:])) and names[0] == "FIRE"


def test_payload_body_is_cut_and_resolution_names_trigger_value(spark):
    evaluated = monitor.events(monitor.evaluate(polls(spark, [60, 90, 10])))
    findings = spark.createDataFrame([("anomaly_count_yesterday", "x" * 5000)], "kpi string, body string")
    fire, done = monitor.alert_payload(evaluated, findings).orderBy("as_of").collect()
    assert len(fire.body) == 2900 and fire.color == "#F0A500" and "60.0000" in fire.field_value
    assert done.event == "RESOLVE" and "60.0000" in done.field_value and done.body is None


def test_investigation_log_keeps_the_last(spark):
    log = spark.createDataFrame([("k", f"s{i}", i) for i in range(100)], "kpi string, summary string, logged_at int")
    new = spark.createDataFrame([("k", "new", 500)], "kpi string, summary string, logged_at int")
    kept = monitor.investigation_log(log, new).collect()
    assert len(kept) == 100 and kept[0].summary == "new" and "s0" not in [r.summary for r in kept]


def test_monthly_volume_drop(spark, small):
    star = bridge_star(spark, small)
    rows = [(1, D(2024, 1, 5), 100), (1, D(2024, 1, 9), 100), (1, D(2024, 2, 1), 150), (2, D(2024, 1, 1), 10), (2, D(2024, 2, 1), 9)]
    txns = spark.createDataFrame(rows, "region_key int, txn_date date, amount int").withColumn("amount", F.col("amount").cast("decimal(18,2)"))
    got = monitor.volume_drop(star.replaced(txn_unscored=txns), period="month").collect()
    assert [(r.period_start, r.previous_volume, r.change_pct) for r in got] == [(D(2024, 2, 1), 200.0, -25.0)]


@pytest.mark.parametrize("metric", sorted(reports.HEATMAP_METRICS))
@pytest.mark.parametrize("days", [30, 365, None])
def test_heatmap_is_ranked_by_its_metric(spark, small, metric, days):
    rows = reports.dash_region_heatmap(bridge_star(spark, small), AS_OF, metric, None, days).collect()
    values = [r[reports.HEATMAP_METRICS[metric]] for r in rows]
    present = [v for v in values if v is not None]
    assert present == sorted(present, reverse=True) and values[: len(present)] == present


def test_sampled_scatter_is_repeatable(spark, small):
    star = bridge_star(spark, small)
    one_, two = (sorted(r.transaction_id for r in reports.bi_anomaly_scatter(star, 0.2).collect()) for _ in range(2))
    assert one_ == two and 0 < len(one_) < 1000


def test_report_files(spark, small, tmp_path):
    star = bridge_star(spark, small)
    extracts = {"trend": reports.default_trend(star), "status": reports.dash_loan_status(star)}
    reports.write_report(extracts, f"file://{tmp_path}/r", "csv")
    reports.write_report(extracts, f"file://{tmp_path}/p")
    back = spark.read.option("header", True).csv(f"file://{tmp_path}/r/trend")
    assert back.count() == extracts["trend"].count() and back.columns == extracts["trend"].columns
    assert spark.read.parquet(f"file://{tmp_path}/p/status").count() == extracts["status"].count()


def test_free_message(spark):
    rows = spark.createDataFrame([("m" * 3000, "info"), ("x", "odd")], "message string, severity string")
    one_, two = monitor.message_payload(rows).collect()
    assert (one_.color, len(one_.body), two.color) == ("#3182CE", 2900, "#F0A500")
    assert '"header":"Portfolio message [INFO]"' in one_.payload


def test_lazy_and_stored_anomaly_summary_agree(spark, small):
    star = bridge_star(spark, small)
    lazy, kept = kpi.anomaly_summary(star, store=False), kpi.anomaly_summary(star)
    assert lazy.collect() == kept.collect()
    assert kpi.anomaly_summary(star, rolling=False).count() == kept.count()


def test_sql_views_equal_the_jobs(spark, small):
    from lendscope.sql import register_sql

    star = bridge_star(spark, small)
    names = register_sql(star, AS_OF)
    assert {"vw_par30", "vw_kpi_snapshot", "fact_loan", "dim_customer"} <= set(names)
    assert spark.table("vw_default_rate").collect() == kpi.default_rate(star).collect()
    from lendscope.plans import investigate

    spike = spark.sql("SELECT * FROM fn_investigate_default_spike(DATE '2000-01-01', DATE '2000-12-31')")
    assert sorted(map(str, spike.collect())) == sorted(
        map(str, investigate.default_spike(star, "2000-01-01", "2000-12-31").toDF(*spike.columns).collect())
    )


def test_slicers(spark, small):
    star = bridge_star(spark, small)
    cut = star.sliced(start="2001-07-10", end="2001-07-12", risk_tier="LOW", state="State_1", loan_status="ACTIVE", category="AUTO")
    days = [r.txn_date for r in cut.txn.select("txn_date").distinct().collect()]
    assert all(D(2001, 7, 10) <= d <= D(2001, 7, 12) for d in days)
    assert cut.txn.count() == cut.txn_between("2001-01-01", "2001-12-31").count() == cut.txn_unscored.count()
    got = star.sliced(loan_status="CLOSED").loan.select("loan_status").distinct().collect()
    assert [r.loan_status for r in got] == ["CLOSED"]


@pytest.mark.parametrize("zone", ["UTC", "America/Los_Angeles", "Asia/Kolkata"])
def test_utc_instant_in_any_session_zone(spark, zone):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        row = spark.sql("SELECT TIMESTAMP_NTZ '2024-03-10 02:30:15.250001' AS t").select(
            F.unix_micros(dates.utc_instant(F.col("t"))).alias("m"), dates.utc_date(dates.utc_instant(F.col("t"))).alias("d")
        ).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert row.d == D(2024, 3, 10)
    assert row.m == 1710037815250001
