"""One row per key, chosen by an order over columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lendscope.operators.sizes import BROADCAST_BYTES, estimated_bytes
from lendscope.sources.workspace import stored


def _rank(frame: DataFrame, keys: list[str], order: list[str], latest: bool, apart: Column | None) -> Column:
    order = [c for c in order if c not in keys]
    rest = [c for c in frame.columns if c not in keys and c not in order]
    ranking = [F.desc_nulls_last(c) if latest else F.asc_nulls_first(c) for c in order + rest]
    groups = [F.col(c) for c in keys] if apart is None else [*[F.col(c) for c in keys], apart]
    return F.row_number().over(Window.partitionBy(*groups).orderBy(*(ranking or [F.lit(1)])))


def _pick(frame: DataFrame, keys: list[str], order: list[str], latest: bool) -> DataFrame:
    ranked = frame.withColumn("_rank", _rank(frame, keys, order, latest, None))
    return ranked.filter(F.col("_rank") == 1).drop("_rank")


def newest_per_key(frame: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The row with the largest ``order`` per key; the remaining columns, in
    order, break ties (NULL smallest).

    Only the first rank is kept, which Spark also applies within each input task
    before the shuffle: repeats of a key collapse there, so a key with a third of
    all rows never meets in one sort.
    """
    return _pick(frame, keys, order, latest=True)


def first_per_key(frame: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The row with the smallest ``order`` per key; ties as above."""
    return _pick(frame, keys, order, latest=False)


def chosen_per_key(frame: DataFrame, key: str, order: list[str], latest: bool, keyless: Column) -> DataFrame:
    """The row that ``newest_per_key`` (or ``first_per_key``) keeps, with ``_rows``: how many rows its key has.

    The keys are counted first, from their column alone, and those that repeat are written. If they are few enough
    to be broadcast, the rows of all other keys are neither ranked nor moved; if not, all keys are
    ranked. The others of a key are counted, not ranked: each task sends one row of a key, also of one with a
    third of all rows. Rows without a key (``keyless``) all stay, each with ``_rows`` 1.
    """
    pick, one = newest_per_key if latest else first_per_key, F.lit(1).cast("long")
    keyed = frame.filter(~keyless)
    repeated = stored(keyed.groupBy(key).agg(F.count("*").alias("_rows")).filter(F.col("_rows") > 1), "repeated-keys")
    if estimated_bytes(repeated) > BROADCAST_BYTES:
        single, several = frame.filter(keyless), keyed
    else:
        names = F.broadcast(repeated.select(F.col(key).alias("_repeated")))
        same = F.col(key) == F.col("_repeated")
        single, several = frame.join(names, same & ~keyless, "left_anti"), keyed.join(names, same, "left_semi")
    kept = pick(several, [key], order).join(repeated, key, "left").withColumn("_rows", F.coalesce("_rows", one))
    single = single.withColumn("_rows", one)
    return kept.select(*single.columns).unionByName(single)
