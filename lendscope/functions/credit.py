"""Credit-risk rules: tiers, delinquency flags and buckets, instalments, scores."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from lendscope.functions.numbers import half_up

# Lowest credit score of each tier; below the last is CRITICAL.
RISK_TIERS = (("LOW", 750), ("MEDIUM", 650), ("HIGH", 550))
LOWEST_TIER = "CRITICAL"

# Delinquency buckets by days past due.
DPD_BUCKETS = (
    ("Current (0 days)", 0, 0),
    ("PAR 1-29", 1, 29),
    ("PAR 30-59", 30, 59),
    ("PAR 60-89", 60, 89),
    ("NPL (90+ days)", 90, None),
)
WRITE_OFF = ("Write-off (180+ days)", 180)

# Days past due of the at-risk band, and the first
# non-performing day. Day 90 belongs to neither.
PAR_MIN_DPD, PAR_MAX_DPD = 30, 89
NPL_MIN_DPD = 91

# Fixed values of the transaction score.
Z_LIMIT = 3.0
ANOMALY_REASON = "High-value outlier (Z > 3σ)"


def risk_tier(score: Column) -> Column:
    """NULL scores fall to the lowest tier."""
    first, *rest = RISK_TIERS
    tier = F.when(score >= first[1], first[0])
    tier = reduce(lambda c, t: c.when(score >= t[1], t[0]), rest, tier)
    return tier.otherwise(LOWEST_TIER)


def dpd_bucket(days: Column, write_off: bool = False) -> Column:
    """Bucket label; with ``write_off`` days 180+ get their own bucket."""
    label, floor = WRITE_OFF
    bucket = F.when(days >= floor, label) if write_off else None
    for name, low, high in DPD_BUCKETS:
        hit = days >= low if high is None else days.between(low, high)
        bucket = F.when(hit, name) if bucket is None else bucket.when(hit, name)
    return bucket


def is_npl(days: Column, npl_min_dpd: int = NPL_MIN_DPD) -> Column:
    return days >= npl_min_dpd


def is_par30(days: Column) -> Column:
    return days.between(PAR_MIN_DPD, PAR_MAX_DPD)


AT_RISK_RULES = ("par_or_npl", "par_only", "dpd30")


def at_risk(rule: str = "par_or_npl") -> Column:
    """The three definitions in use: flag PAR or NPL (KPI view), PAR only (BI
    measure), days past due >= 30 (definition text)."""
    rules = {
        "par_or_npl": F.col("is_par30") | F.col("is_npl"),
        "par_only": F.col("is_par30"),
        "dpd30": F.col("days_past_due") >= PAR_MIN_DPD,
    }
    return rules[rule]


def monthly_installment(principal: Column, rate_pct: Column, months: Column) -> Column:
    """Annuity instalment; straight-line when the rate is 0, NULL when the
    tenure is 0."""
    p, n = principal.cast("double"), months.cast("double")
    r = rate_pct.cast("double") / 1200.0
    growth = F.pow(1.0 + r, n)
    annuity = p * r * growth / F.nullif(growth - 1.0, F.lit(0.0))
    return half_up(
        F.when((rate_pct > 0) & (months > 0), annuity).otherwise(p / F.nullif(n, F.lit(0.0))), 2
    )


def total_interest(installment: Column, months: Column, principal: Column) -> Column:
    return half_up(installment.cast("double") * months - principal.cast("double"), 2)


def z_score(amount: Column, avg: Column, sd: Column) -> Column:
    """Distance from the customer's mean in deviations; 0 without a spread."""
    return F.when(sd > 0, F.abs(amount.cast("double") - avg) / sd).otherwise(F.lit(0.0))


def anomaly_columns(z: Column) -> dict[str, Column]:
    return {
        "is_anomaly": z > Z_LIMIT,
        "anomaly_score": F.round(1 - F.exp(-z / 3.0), 4).cast("decimal(5,4)"),
        "anomaly_reason": F.when(z > Z_LIMIT, ANOMALY_REASON),
    }
