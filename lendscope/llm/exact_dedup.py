"""Operator 10: exact duplicates by composable polynomial fingerprints."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendscope.llm.common import sha256, whole
from lendscope.sources.workspace import stored

#: Fingerprint arithmetic: two primes below 2**31 and a base for each.
PRIMES = (2147483647, 2147483629)
BASES = (911382323, 972663749)
#: A chunk is 32 symbols of four bytes; chunks are hashed side by side.
SYMBOLS, WIDTH = 32, 4
CHUNK_BYTES = SYMBOLS * WIDTH
#: Characters of a chunk in the comparison of equal fingerprints.
COMPARE_CHARS = 1 << 16
#: Lanes in which the chunks that tasks send for one place meet first.
LANES = 64


def powers(base: int, count: int, prime: int) -> np.ndarray:
    """base**0 .. base**(count-1) modulo prime, by doubling."""
    out = np.ones(1, dtype=np.uint64)
    while len(out) < count:
        step = pow(base, len(out), prime)
        out = np.concatenate((out, out * np.uint64(step) % np.uint64(prime)))
    return out[:count]


def chunk_hashes(symbols: np.ndarray, base: int, prime: int) -> np.ndarray:
    """One hash per row of 32 symbols."""
    weights = powers(base, SYMBOLS, prime)[::-1]
    return (symbols.astype(np.uint64) * weights % np.uint64(prime)).sum(axis=1) % np.uint64(prime)


def combine(left: int, right: int, right_chunks: int, base: int, prime: int) -> int:
    """Hash of the concatenation: the left hash shifted by the length of the right part."""
    return (left * pow(base, SYMBOLS * right_chunks, prime) + right) % prime


def fingerprints(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """(texts, 2) fingerprints of the texts data[offsets[i]:offsets[i + 1]].

    Chunks of all texts are hashed side by side; the chunk hashes of a text are
    then combined, each shifted by the length of what follows it.
    """
    sizes = np.diff(offsets)
    chunks = np.maximum(1, -(-sizes // CHUNK_BYTES))
    firsts = np.concatenate(([0], np.cumsum(chunks)[:-1])).astype(np.int64)
    padded = np.zeros(int(chunks.sum()) * CHUNK_BYTES, dtype=np.uint8)
    for size, start, at in zip(sizes.tolist(), offsets[:-1].tolist(), (firsts * CHUNK_BYTES).tolist(), strict=True):
        padded[at : at + size] = data[start : start + size]
    symbols = padded.view("<u4").reshape(-1, SYMBOLS)
    after = np.repeat(firsts + chunks - 1, chunks) - np.arange(len(symbols))
    out = np.empty((len(sizes), 2), dtype=np.int64)
    for k, (base, prime) in enumerate(zip(BASES, PRIMES, strict=True)):
        hashes = np.empty(len(symbols), dtype=np.uint64)
        for at in range(0, len(symbols), 1 << 16):
            hashes[at : at + (1 << 16)] = chunk_hashes(symbols[at : at + (1 << 16)], base, prime)
        shift = powers(pow(base, SYMBOLS, prime), int(chunks.max()), prime)
        out[:, k] = np.add.reduceat(hashes * shift[after] % np.uint64(prime), firsts) % np.uint64(prime)
    return out


def normalised(text: Column) -> Column:
    """Every run of white space as one space; NULL as the empty text."""
    return F.regexp_replace(whole(text), r"[ \t-\r]{2,}|[\t-\r]", " ")


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column("text").cast(pa.large_binary())
        if not len(texts):
            continue
        _, offsets, data = texts.buffers()
        offsets = np.frombuffer(offsets, dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
        data = np.frombuffer(data, dtype=np.uint8) if data else np.zeros(0, dtype=np.uint8)
        prints = fingerprints(data, offsets)
        view = memoryview(data)
        digests = [hashlib.sha256(view[s:e]).hexdigest() for s, e in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
        columns = [batch.column("doc_id"), pa.array(digests), pa.array(prints[:, 0]), pa.array(prints[:, 1]), pa.array(np.diff(offsets))]
        yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "text_sha256", "f1", "f2", "n_bytes"])


KEY = ["f1", "f2", "n_bytes"]


def _members(docs: DataFrame, prints: DataFrame, shared: DataFrame) -> DataFrame:
    """The texts of shared keys, a row per row of ``docs`` (doc_id, text, text_sha256). By the digest a
    row meets its own key only, whatever ids it shares with others."""
    held = prints.join(shared.select(*KEY), KEY).select("doc_id", "text_sha256", *KEY).distinct()
    mine = held.select(F.col("doc_id").alias("_id"), F.col("text_sha256").alias("_digest"), *KEY)
    return docs.join(mine, docs["doc_id"].eqNullSafe(mine["_id"]) & (docs["text_sha256"] == mine["_digest"])).select(*KEY, "text")


def _collided(docs: DataFrame, prints: DataFrame, shared: DataFrame) -> DataFrame:
    """Keys whose texts are not all equal, by comparing the texts chunk by chunk.

    The least and the greatest chunk at each place are kept per task
    before the shuffle, so a group of copies sends one chunk per place and task; these meet in
    ``LANES`` lanes by task before they meet at their place. The two differ exactly if two texts differ there.
    """
    texts = _members(docs, prints, shared)
    count = F.greatest(F.lit(1), F.ceil(F.length("text") / COMPARE_CHARS)).cast("int")
    lane = F.pmod(F.spark_partition_id(), F.lit(LANES)).alias("lane")
    places = texts.select(*KEY, "text", lane, F.explode(F.sequence(F.lit(0), count - 1)).alias("place"))
    chunk = F.substring(F.col("text"), F.col("place") * COMPARE_CHARS + 1, F.lit(COMPARE_CHARS))
    parts = places.select(*KEY, "place", "lane", chunk.alias("chunk"))
    lanes = parts.groupBy(*KEY, "place", "lane").agg(F.min("chunk").alias("low"), F.max("chunk").alias("high"))
    spans = lanes.groupBy(*KEY, "place").agg(F.min("low").alias("low"), F.max("high").alias("high"))
    return spans.filter("low <> high").select(*KEY).distinct()


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal if they are the same after every run of white space became
    one space; NULL is the empty text. keep_id is the least id of the group, and
    kept says that a row has it. Rows that repeat an id and its text are one
    document written twice: they count twice in group_size and share ``kept``.
    NULL ids are never the least unless the whole group has none; kept then says
    true. Equal fingerprints are compared as texts; should unequal texts share a
    fingerprint, their groups are formed by the digest of the whole text.
    """
    texts = docs.select(F.col(id_col).alias("doc_id"), normalised(F.col(text_col)).alias("text"))
    id_type = texts.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {id_type}, text_sha256 string, f1 long, f2 long, n_bytes long"
    prints = stored(texts.mapInArrow(_measure, schema), "prints")
    shared = stored(prints.groupBy(*KEY).agg(F.count("*").alias("rows")).filter("rows > 1"), "shared-prints")
    keyed = texts.withColumn("text_sha256", sha256(F.col("text")))
    collided = stored(_collided(keyed, prints, shared).withColumn("collided", F.lit(True)), "collided-prints")
    marked = shared.join(collided, KEY, "left").select(*KEY, F.coalesce("collided", F.lit(False)).alias("collided"))
    parted = prints.join(marked, KEY, "left").withColumn("part", F.when(F.col("collided"), F.col("text_sha256")))
    grouped = stored(parted.select("doc_id", "text_sha256", *KEY, "part"), "parted-prints") if collided.head(1) else prints.withColumn("part", F.lit(None).cast("string"))
    groups = grouped.groupBy(*KEY, "part").agg(F.min("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
    groups = stored(groups.filter("group_size > 1"), "print-groups").withColumnRenamed("part", "its_part")
    same = [grouped[k] == groups[k] for k in KEY] + [F.coalesce(grouped["part"], F.lit("")) == F.coalesce(groups["its_part"], F.lit(""))]
    out = grouped.join(groups, same, "left")
    keep = F.when(groups["group_size"].isNull(), grouped["doc_id"]).otherwise(groups["keep_id"])
    return out.select(
        grouped["doc_id"],
        keep.alias("keep_id"),
        F.coalesce(groups["group_size"], F.lit(1)).cast("long").alias("group_size"),
        grouped["doc_id"].eqNullSafe(keep).alias("kept"),
        grouped["text_sha256"],
    )
