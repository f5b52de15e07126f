"""Surrogate keys without one global sort."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lendscope.sources.workspace import stored

# Buckets are the leading hex digits of md5(business key): 16 ** DIGITS of them.
DIGITS = 4


def assign_keys(
    rows: DataFrame,
    business_key: str,
    key_name: str,
    start: Column | int = 0,
    key_type: str = "bigint",
    digits: int = DIGITS,
    held: bool = False,
) -> DataFrame:
    """Number rows ``start + 1, start + 2, …`` by (md5 prefix, business key).

    ``business_key`` is unique in ``rows``. Rows are numbered inside each md5
    bucket, and bucket offsets come from a count per bucket, so only the
    ``16 ** digits`` (65 536) counts meet in one task. Numbers are dense and the same on
    every run. Raise ``digits`` so that one bucket fits a task. Rows that are read from stored
    files (``held``) are read twice, of the first time their key; others are written once for it.
    """
    base = start if isinstance(start, Column) else F.lit(start)
    bucketed = rows.withColumn("_bucket", F.left(F.md5(F.col(business_key)), F.lit(digits)))
    if not held:
        bucketed = stored(bucketed, "unnumbered")
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        bucketed.groupBy("_bucket")
        .agg(F.count("*").alias("_n"))
        .select("_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    )
    within = Window.partitionBy("_bucket").orderBy(business_key)
    key = (F.coalesce(base, F.lit(0)) + F.col("_offset") + F.row_number().over(within)).cast(key_type)
    return (
        bucketed.join(F.broadcast(offsets), "_bucket").select(key.alias(key_name), *rows.columns)
    )
