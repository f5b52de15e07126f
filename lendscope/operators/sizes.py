"""Broadcast behind a size check."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BROADCAST_BYTES = 8 << 20


def estimated_bytes(frame: DataFrame) -> int:
    """The optimizer's estimate, from file sizes; very large where it knows nothing. Runs no job."""
    return int(str(frame._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def broadcast_if_small(side: DataFrame, bound: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """``side`` marked for broadcast when ``bound`` is estimated at ``limit`` bytes or less.

    For a small aggregate over a fact the optimizer knows no size before it
    runs, and would shuffle the whole fact on a key of few values first.
    ``bound`` is a table (a dimension) with at least as many rows as ``side``. Beyond the limit
    the join is left to the optimizer.
    """
    return F.broadcast(side) if estimated_bytes(bound) <= limit else side
