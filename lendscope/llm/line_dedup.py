"""Operator 4: repeated passages, found by overlapping windows of three lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendscope.llm.common import packed, unpacked, whole
from lendscope.sources.workspace import stored

#: Lines of a window.
WINDOW = 3


def lines_of(text: Column) -> Column:
    return F.split(whole(text), "\n", -1)


def _print(text: str) -> Column:
    """With the id it names a document, also where ids are NULL or used twice."""
    return F.xxhash64(whole(F.col(text)))


def _windows(docs: DataFrame, window: int) -> DataFrame:
    """(doc_id, t, at, h1, h2): each run of ``window`` consecutive lines by a hash of 128 bits."""
    lines = docs.select("doc_id", _print("text").alias("t"), lines_of(F.col("text")).alias("lines")).filter(F.size("lines") >= window)
    rows = lines.select("doc_id", "t", "lines", F.explode(F.sequence(F.lit(0), F.size("lines") - window)).alias("at"))
    parts = [F.get("lines", F.col("at") + k) for k in range(window)]
    return rows.select("doc_id", "t", "at", F.xxhash64(*parts).alias("h1"), F.xxhash64(F.lit("second"), *parts).alias("h2"))


def covered_lines(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc_id, t, removed): for each document that repeats an earlier window, the line numbers to remove."""
    hashes = ["h1", "h2"]
    seen = stored(_windows(docs, window), "line-windows")
    repeated = stored(
        seen.groupBy(*hashes).agg(F.min("doc_id").alias("first_doc"), F.count("*").alias("n")).filter("n > 1").drop("n"),
        "line-repeats",
    )
    hits = stored(seen.join(repeated, hashes), "line-hits")
    own = F.col("doc_id").eqNullSafe(F.col("first_doc"))
    firsts = stored(hits.filter(own).groupBy(*hashes).agg(F.min(F.struct("t", "at")).alias("first")), "line-firsts")
    elsewhere = hits.filter(~own).select("doc_id", "t", "at", F.lit(None).cast("int").alias("home"))
    at_home = hits.filter(own).join(firsts, hashes).filter(F.struct("t", "at") != F.col("first"))
    at_home = at_home.select("doc_id", "t", "at", F.when(F.col("t") == F.col("first.t"), F.col("first.at")).alias("home"))
    covered = elsewhere.unionByName(at_home).select("doc_id", "t", "home", F.explode(F.sequence(F.col("at"), F.col("at") + window - 1)).alias("line"))
    covered = covered.filter(F.col("home").isNull() | (F.col("line") >= F.col("home") + window))
    return covered.groupBy("doc_id", "t").agg(F.collect_set("line").alias("removed"))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """``docs`` with later repeats removed from the text, plus n_lines and n_removed.

    Lines end at a line feed. A window of three consecutive lines that occurs more
    than once anywhere stays where it occurs first, by document id, then line
    number; every other occurrence covers its lines, and covered lines go. In the
    document that holds the first occurrence, an occurrence that overlaps it
    covers only the lines beyond it. Texts of fewer lines than a window stay as
    they are, NULL texts stay NULL with one (empty) line. Rows of one id and one
    text are one document and treated alike; of several texts of one id the order
    is that of their hashes, and a NULL id comes after all others. A text that loses all its lines becomes empty.
    Other columns pass through, also those named like a column used inside;
    n_lines and n_removed replace columns of that name.
    """
    own = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    gone = covered_lines(own, window).select(F.col("doc_id").alias("_gone_id"), F.col("t").alias("_gone_t"), F.col("removed").alias("_gone"))
    gone = stored(gone, "line-covered")
    rows = packed(docs, text_col).withColumn("_id", F.col("_row").getField(id_col))
    # the lines travel through the join instead of the text, so that they can be picked by number
    rows = rows.select("_row", "_id", _print("_0").alias("_t"), F.col("_0").isNull().alias("_none"), lines_of(F.col("_0")).alias("_lines"))
    # a shuffle join at every size: how much is removed should not choose the plan
    joined = rows.join(gone.hint("merge"), rows["_id"].eqNullSafe(gone["_gone_id"]) & (rows["_t"] == gone["_gone_t"]), "left")
    numbers = F.sequence(F.lit(0), F.size("_lines") - 1)
    left = F.transform(F.array_except(numbers, F.col("_gone")), lambda i: F.get(F.col("_lines"), i))
    kept = F.when(F.col("_gone").isNull(), F.col("_lines")).otherwise(left)
    text = F.when(~F.col("_none"), F.array_join(kept, "\n"))
    removed = F.coalesce(F.size("_gone"), F.lit(0)).cast("long")
    return joined.select(*unpacked(docs.columns, **{text_col: text}, n_lines=F.size("_lines").cast("long"), n_removed=removed))
