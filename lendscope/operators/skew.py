"""Joins of a fact to a per-key table when few keys hold many rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Rows of one key that a single task may get.
ROWS_PER_TASK = 1_000_000


def key_parts(counts: DataFrame, key: str, n: str, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """(key, parts): into how many parts the rows of a key are dealt, for the
    keys that need more than one.

    ``counts`` has one row per key. The number of parts follows from the key's
    own rows, so no part exceeds ``rows_per_task``. There are at most total
    rows / ``rows_per_task`` such keys, which bounds the broadcast: a million
    keys, some 20 MB, for 10 ** 12 rows.
    """
    parts = F.ceil(F.col(n) / rows_per_task).cast("int")
    return counts.filter((F.col(n) > rows_per_task) & F.col(key).isNotNull()).select(key, parts.alias("parts"))


def salted_join(
    fact: DataFrame, table: DataFrame, key: str, parts: DataFrame, row_id: Column, how: str = "inner"
) -> DataFrame:
    """Join ``fact`` to ``table`` (one row per ``key``) on ``key``.

    Rows of a key with several parts spread over them by a hash of ``row_id``,
    and only the table rows of such keys are repeated. Needed where the table
    side is an aggregate: run-time skew splitting then sees no plain shuffle to
    split and leaves a hot key to one task.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"salted_join supports inner and left, not {how}")
    marked = F.broadcast(parts.select(key, F.col("parts").alias("_parts")))
    spread = F.xxhash64(row_id)
    # a NULL key matches nothing, so its rows may go anywhere
    salt = F.when(F.col(key).isNull(), spread).otherwise(F.coalesce(F.pmod(spread, F.col("_parts")), F.lit(0).cast("bigint")))
    left = fact.join(marked, key, "left").withColumn("_salt", salt).drop("_parts")
    last = F.coalesce(F.col("_parts"), F.lit(1)).cast("bigint") - 1
    right = table.join(marked, key, "left").withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("bigint"), last))).drop("_parts")
    return left.join(right, [key, "_salt"], how).drop("_salt")
