"""Count, mean and spread per key as rows that can be merged.

A batch is summed up by itself and merged into what is known (Chan, Golub and LeVeque's
formula for two parts), so a new batch needs no row of the old ones.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: n counts values, rows also those without one; m2 is the sum of squared distances from the mean.
PARTS = ("rows", "n", "mean", "m2", "low", "high")


def moments(frame: DataFrame, key: str, value: Column) -> DataFrame:
    """(key, *PARTS) of the rows with a key."""
    own = frame.filter(F.col(key).isNotNull()).select(key, value.cast("double").alias("_value"))
    n = F.count("_value")
    return own.groupBy(key).agg(
        F.count("*").alias("rows"),
        n.alias("n"),
        F.avg("_value").alias("mean"),
        (F.var_pop("_value") * n).alias("m2"),
        F.min("_value").alias("low"),
        F.max("_value").alias("high"),
    )


def merged(one: DataFrame, other: DataFrame, key: str) -> DataFrame:
    """The moments of both; each has one row per key. One shuffle of both on the key."""
    both = one.select(key, *PARTS, F.lit(0).alias("_side")).unionByName(other.select(key, *PARTS, F.lit(1).alias("_side")))
    side = lambda s, c: F.max(F.when(F.col("_side") == s, F.col(c))).alias(f"{c}{s}")
    found = both.groupBy(key).agg(*[side(s, c) for s in (0, 1) for c in PARTS])
    zero = F.lit(0).cast("long")
    n0, n1 = (F.coalesce(F.col(f"n{s}"), zero) for s in (0, 1))
    n = n0 + n1
    apart = F.col("mean1") - F.col("mean0")
    # a part without values has no mean
    mean = F.when(n1 == 0, F.col("mean0")).when(n0 == 0, F.col("mean1")).otherwise(F.col("mean0") + apart * n1 / n)
    m2 = F.when(n1 == 0, F.col("m20")).when(n0 == 0, F.col("m21")).otherwise(F.col("m20") + F.col("m21") + apart * apart * n0 * n1 / n)
    return found.select(
        key,
        (F.coalesce(F.col("rows0"), zero) + F.coalesce(F.col("rows1"), zero)).alias("rows"),
        n.alias("n"),
        mean.alias("mean"),
        m2.alias("m2"),
        F.least("low0", "low1").alias("low"),
        F.greatest("high0", "high1").alias("high"),
    )


def spread() -> Column:
    """The sample deviation; exactly 0 where all values are the same, NULL below two."""
    same = F.col("low") == F.col("high")
    return F.when(F.col("n") < 2, F.lit(None).cast("double")).when(same, 0.0).otherwise(F.sqrt(F.col("m2") / (F.col("n") - 1)))
