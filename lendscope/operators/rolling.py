"""Rolling sums over an order that spans the whole table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def rolling_rows_sum(
    rows: DataFrame, day: str, order: list[Column], value: str, output: str, width: int = 7
) -> DataFrame:
    """Sum of ``value`` over the current and ``width - 1`` preceding rows in
    the order (``day``, ``order``), without sorting the table in one task.

    Each day is summed on its own; what its first rows miss comes from the last
    ``width - 1`` rows of each earlier day. Only those few rows per day meet in
    one ordered window, so its input is bounded by the calendar.
    """
    back = width - 1
    ahead = Window.partitionBy(day).orderBy(*order)
    placed = rows.withColumns(
        {
            "_pos": F.row_number().over(ahead),
            "_size": F.count("*").over(Window.partitionBy(day)),
            "_own": F.sum(value).over(ahead.rowsBetween(-back, 0)),
        }
    )
    tails = placed.filter(F.col("_pos") > F.col("_size") - back).select(day, "_pos", "_size", F.col(value).alias("_v"))
    line = Window.orderBy(day, "_pos")
    # at a day's last row: the sums of the last 1 .. width-1 rows up to it
    ends = tails.withColumn(
        "_sums",
        F.array(*[F.coalesce(F.sum("_v").over(line.rowsBetween(-(k - 1), 0)), F.lit(0)) for k in range(1, back + 1)]),
    ).filter(F.col("_pos") == F.col("_size"))
    carried = ends.select(day, F.lag("_sums").over(Window.orderBy(day)).alias("_carry"))
    missing = F.lit(width) - F.col("_pos")
    extra = F.when(F.col("_carry").isNotNull() & (missing > 0), F.get(F.col("_carry"), missing - 1))
    total = F.coalesce(F.col("_own"), F.lit(0)) + F.coalesce(extra, F.lit(0))
    return placed.join(carried, day).withColumn(output, total).drop("_pos", "_size", "_own", "_carry")
