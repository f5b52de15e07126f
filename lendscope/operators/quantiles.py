"""Exact interpolated percentiles of a decimal column, per group, in two passes."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from lendscope.operators.sizes import broadcast_if_small

#: The sketch knows ranks to a share of 1 / ACCURACY of the rows; a bracket is MARGIN times as wide to each side.
ACCURACY, MARGIN = 10_000, 5
#: Groups of up to this many rows need no bracket: all their values are counted.
SMALL_GROUP = 10 * ACCURACY


def exact_percentiles(
    rows: DataFrame,
    group: list[str],
    value: str,
    points: dict[str, float],
    groups: DataFrame | None = None,
    also: dict[str, Column] | None = None,
    small: int = SMALL_GROUP,
) -> DataFrame:
    """One row per group with a DOUBLE column per entry of ``points``
    (name -> fraction), interpolated linearly between neighbours, and one per
    aggregate of ``also``, which the first pass computes.

    The built-in exact percentile keeps every distinct value of a group in one
    task. Here the first pass takes a mergeable quantile sketch, whose error is bounded: so
    two of its values hold each wanted rank between them. The second pass counts, per task
    before the shuffle, the rows below each such bracket and the single values within
    it, at most a share of 2 * MARGIN / ACCURACY of the rows.

    Without a group there is one row, also of no rows. ``groups`` is a table with at least a row
    per group: if it is small, so are the brackets, which are then broadcast. The
    smallest unit follows from the column, which must be a DECIMAL.
    """
    kind = rows.schema[value].dataType
    if not isinstance(kind, DecimalType):
        raise TypeError(f"{value} is {kind.simpleString()}; exact percentiles take a DECIMAL")
    unit = (F.col(value) * F.lit(10**kind.scale)).cast(f"decimal({kind.precision}, 0)").cast("bigint")
    valued = rows.withColumn("_v", unit)
    shares = list(points.values())
    around = [min(1.0, max(0.0, p + side * MARGIN / ACCURACY)) for p in shares for side in (-1, 1)]
    also = also or {}
    sketch = valued.groupBy(*group).agg(
        F.count("_v").alias("_total"), F.min("_v").alias("_min"), F.max("_v").alias("_max"),
        F.percentile_approx("_v", around, ACCURACY).alias("_at"),
        *[aggregate.alias(name) for name, aggregate in also.items()],
    )
    few = F.col("_total") <= small
    brackets = [(F.when(few, F.col("_min")).otherwise(F.col("_at")[2 * i]), F.when(few, F.col("_max")).otherwise(F.col("_at")[2 * i + 1])) for i in range(len(shares))]
    bounds = F.array(*[F.struct(F.lit(i).alias("point"), low.alias("low"), high.alias("high")) for i, (low, high) in enumerate(brackets)])
    side = sketch.select(*group, "_total", *also, bounds.alias("_bounds"))
    if groups is not None:
        side = broadcast_if_small(side, groups)
    own = valued.select(*[F.col(c).alias(f"_g{k}") for k, c in enumerate(group)], "_v")
    same = reduce(lambda a, b: a & b, [F.col(f"_g{k}").eqNullSafe(F.col(c)) for k, c in enumerate(group)], F.lit(True))
    if group:
        met = own.join(side, same)
    else:
        one_row = side.select(F.struct(*side.columns)).scalar()
        met = own.withColumn("_side", one_row).select("_v", "_side.*")
    # of a value below a bracket only that it is below counts; one entry more says that the group is there
    reached = F.filter("_bounds", lambda b: F.col("_v") <= b["high"])
    entries = F.transform(reached, lambda b: F.struct(b["point"].alias("point"), F.when(F.col("_v") >= b["low"], F.col("_v")).alias("v")))
    there = F.array(F.struct(F.lit(-1).alias("point"), F.lit(None).cast("bigint").alias("v")))
    carried = ["_total", *also]
    counted = (
        met.select(*group, *carried, F.explode(F.concat(there, entries)).alias("e"))
        .groupBy(*group, F.col("e.point").alias("_point"), F.col("e.v").alias("_v"))
        .agg(F.count("*").alias("_n"), *[F.max(c).alias(c) for c in carried])
    )
    by_value = Window.partitionBy(*group, "_point").orderBy(F.asc_nulls_first("_v"))
    after = F.sum("_n").over(by_value)
    ranked = counted.withColumn("_after", after)
    share = F.element_at(F.array(*[F.lit(float(p)) for p in shares]), F.greatest(F.col("_point") + 1, F.lit(1)))
    place = (F.col("_total") - 1) * share
    within = lambda rank: (rank >= F.col("_after") - F.col("_n")) & (rank < F.col("_after")) & (F.col("_point") >= 0)
    at = lambda rank: F.max(F.when(within(rank), F.col("_v").cast("double") / 10**kind.scale))
    found = ranked.groupBy(*group, "_point").agg(
        at(F.floor(place)).alias("_low"), at(F.ceil(place)).alias("_high"), F.max(place - F.floor(place)).alias("_part"), *[F.max(c).alias(c) for c in carried]
    )
    missed = F.raise_error(F.lit(f"a percentile of {value} lies outside its bracket"))
    exact = F.when(F.col("_low").isNull() | F.col("_high").isNull(), missed.cast("double")).otherwise(F.col("_low") + F.col("_part") * (F.col("_high") - F.col("_low")))
    named = [F.max(F.when((F.col("_point") == i) & (F.col("_total") > 0), exact)).alias(name) for i, name in enumerate(points)]
    return found.groupBy(*group).agg(*named, *[F.max(c).alias(c) for c in also])
