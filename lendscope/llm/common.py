"""Helpers that several operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Of the five parts of the labelled rows, part 0 is held out.
FOLDS = 5


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo ``FOLDS``; 0 for a NULL id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS, F.lit(0)).cast("int")


def whole(text: Column) -> Column:
    """The text, empty where it is NULL."""
    return F.coalesce(text.cast("string"), F.lit(""))


def sha256(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def packed(frame: DataFrame, *apart: str) -> DataFrame:
    """All columns but those of ``apart`` as one struct ``_row``, so that names used beside it clash with none."""
    kept = [F.col(f"`{c}`") for c in frame.columns if c not in apart]
    return frame.select(F.struct(F.lit(0).alias("_"), *kept).alias("_row"), *[F.col(f"`{c}`").alias(f"_{k}") for k, c in enumerate(apart)])


def unpacked(columns: list[str], **computed: Column) -> list[Column]:
    """Columns of a packed frame in the old order; computed ones replace those of their name or come last."""
    old = [computed[c].alias(c) if c in computed else F.col("_row").getField(c).alias(c) for c in columns]
    return old + [value.alias(c) for c, value in computed.items() if c not in columns]
