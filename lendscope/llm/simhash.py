"""Operator 9: near-duplicates by 64-bit SimHash and a multi-index over its segments."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lendscope.llm.common import packed, unpacked
from lendscope.llm.components import components
from lendscope.sources.workspace import stored

BITS = 64
#: The fingerprint is looked up by two segments of 32 bits.
SEGMENT_BITS = 32
#: Seed of the shingle hash.
SEED = 42
#: Shingles whose bits are summed at once; bounds the memory of a huge text.
BLOCK = 1 << 16


def shingle_hashes(text: str | None, shingle: int) -> Iterator[np.ndarray]:
    """Blocks of XXH64 values of the word shingles, repeats included."""
    import xxhash

    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # ASCII letters and white space only
    if not words:
        return
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    if len(words) > shingle:
        starts, ends = starts[: 1 - shingle or None], ends[shingle - 1 :]
    else:
        starts, ends = starts[:1], ends[-1:]
    digest = xxhash.xxh64_intdigest
    for at in range(0, len(starts), BLOCK):
        pairs = zip(starts[at : at + BLOCK].tolist(), ends[at : at + BLOCK].tolist(), strict=True)
        yield np.fromiter((digest(joined[s:e], SEED) for s, e in pairs), dtype="<u8")


def fingerprint(text: str | None, shingle: int) -> int:
    """As a signed 64-bit number; 0 for a text without words."""
    ones, total = np.zeros(BITS, dtype=np.int64), 0
    for hashes in shingle_hashes(text, shingle):
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.uint32)
        total += len(hashes)
    return int(np.packbits(2 * ones > total, bitorder="little").view("<i8")[0])


def simhash(text: Column, shingle: int = 3) -> Column:
    """Column of fingerprints (long)."""

    @F.arrow_udf("long")
    def of(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in texts:
            yield pa.array([fingerprint(t.as_py(), shingle) for t in batch], pa.int64())

    return of(text)


def ball(prints: DataFrame, radius: int) -> DataFrame:
    """(fp, z): every z that differs from fp by at most ``radius`` bits within one segment.

    Segment by segment: the segment takes each value of its small ball while the
    other one stays, and both together are the key of the table.
    """
    if radius == 0:
        return prints.select("fp", F.col("fp").alias("z"))
    flips = [
        F.transform(F.sequence(F.lit(low), F.lit(low + SEGMENT_BITS - 1)), lambda bit: F.col("fp").bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("long"), bit)))
        for low in range(0, BITS, SEGMENT_BITS)
    ]
    return prints.select("fp", F.explode(F.concat(F.array("fp"), *flips)).alias("z"))


def links(prints: DataFrame, max_bits: int = 2) -> DataFrame:
    """Edges (a, b) that connect all fingerprints at most ``max_bits`` apart.

    Two fingerprints differ by at most two bits exactly if a value exists that is
    one flip at most away from either. Values met by several fingerprints are
    found by grouping on the whole value, so a group holds 65 fingerprints at
    most, however many copies there are, and no pairs are listed: each member is
    linked to the least one, after their whole distance has been checked.
    """
    if max_bits not in (0, 2):
        raise ValueError("max_bits is 0 or 2")
    if max_bits == 0:
        return prints.select(F.col("fp").alias("a"), F.col("fp").alias("b")).limit(0)
    met = ball(prints, 1).withColumn("least", F.min("fp").over(Window.partitionBy("z")))
    near = F.bit_count(F.col("fp").bitwiseXOR(F.col("least"))) <= max_bits
    return met.filter((F.col("fp") != F.col("least")) & near).select(F.col("fp").alias("a"), F.col("least").alias("b"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, max_bits: int = 2) -> DataFrame:
    """One row per row of ``docs``: doc_id, fp (long), component_id, component (the group's least fp).

    component_id is the least id among all documents that a chain of links of at
    most ``max_bits`` differing bits reaches; NULL only if every id there is NULL.
    NULL and empty texts have fingerprint 0 and are linked like any other.
    Repeated rows come out as often as they came in; other columns are not read.
    """
    base = stored(docs.select(F.col(id_col).alias("doc_id"), simhash(F.col(text_col).cast("string"), shingle).alias("fp")), "simhash")
    prints = stored(base.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "simhash-prints")
    found = components(links(prints.select("fp"), max_bits))
    placed = prints.join(found.withColumnRenamed("node", "fp"), "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    placed = stored(placed, "simhash-placed")
    least = placed.groupBy("component").agg(F.min("first_id").alias("component_id"))
    ids = stored(placed.join(least, "component").select("fp", "component_id", "component"), "simhash-ids")
    return base.join(ids, "fp").select("doc_id", "fp", "component_id", "component")


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, max_bits: int = 2) -> DataFrame:
    """``docs`` with one row of each component: the one with the least id.

    Of rows that repeat this id one stays, and one of a component without any id.
    Columns pass through, whatever their names. Ids given to several rows, and
    NULL ones, are no key: such rows are looked up by their fingerprints.
    """
    found = stored(near_duplicates(docs, id_col, text_col, shingle, max_bits), "simhash-found")
    unkeyed = stored(found.groupBy("doc_id").agg(F.count("*").alias("n")).filter("n > 1 or doc_id is null").select("doc_id"), "simhash-unkeyed")
    gone = found.filter("doc_id <> component_id")
    rows = packed(docs).withColumn("_id", F.col("_row").getField(id_col))
    if not unkeyed.head(1):
        gone = gone.select(F.col("doc_id").alias("_id"))
        # a shuffle join at every size: how many copies there are should not choose the plan
        return rows.join(gone.hint("merge"), "_id", "left_anti").select(*unpacked(docs.columns))
    apart = unkeyed.select(F.col("doc_id").alias("_key"))
    same = rows["_id"].eqNullSafe(apart["_key"])
    gone = gone.select(F.col("doc_id").alias("_id")).join(apart, F.col("_id").eqNullSafe(F.col("_key")), "left_anti")
    keyed = rows.join(apart, same, "left_anti").join(gone, "_id", "left_anti")
    others = rows.join(apart, same, "left_semi").withColumn("_fp", simhash(F.col("_row").getField(text_col).cast("string"), shingle))
    groups = found.select(F.col("fp").alias("_fp"), F.col("component_id").alias("_least"), F.col("component").alias("_component")).distinct()
    stay = others.join(groups, "_fp").filter(F.col("_least").isNull() | (F.col("_id") == F.col("_least"))).dropDuplicates(["_component"])
    return keyed.select(*unpacked(docs.columns)).unionByName(stay.select(*unpacked(docs.columns)))


def hex_of(fp: Column) -> Column:
    """16 lowercase hex digits."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
