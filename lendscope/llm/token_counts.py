"""Operator 8: token counts through a cache keyed by content and tokenizer digests."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lendscope.llm.common import whole
from lendscope.sources.workspace import stored

CACHE = "digest binary, tokenizer string, n_tokens long"
#: Characters that go through the tokenizer at once; bounds the ids held in memory.
SLICE_CHARS = 1_000_000


def digest(text: Column) -> Column:
    """SHA-256 of the normalised content: the text itself, NULL as the empty text."""
    return F.unhex(F.sha2(whole(text).cast("binary"), 256))


def tokenizer_version(model: bytes) -> str:
    """Digest of the vocabulary file and of the library that reads it."""
    import sentencepiece

    return hashlib.sha256(model + f"|sentencepiece {sentencepiece.__version__}".encode()).hexdigest()


def read_cache(spark: SparkSession, path: str) -> DataFrame:
    """The stored counts; empty where nothing has been stored yet."""
    try:
        return spark.read.schema(CACHE).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], CACHE)


def _counter(model: bytes) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        for batch in batches:
            numbers, held, size = [], [], 0
            for text in batch.column("text"):
                held.append(text.as_py())
                size += len(held[-1])
                if size > SLICE_CHARS:
                    numbers += map(len, sp.encode(held, num_threads=1))
                    held, size = [], 0
            if held:
                numbers += map(len, sp.encode(held, num_threads=1))
            yield pa.RecordBatch.from_arrays([batch.column("digest"), pa.array(numbers, pa.int64())], names=["digest", "n_tokens"])

    return count


def token_counts(docs: DataFrame, model: bytes, cache: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes (UTF-8), n_tokens (as the sentencepiece library counts).

    Digests of the contents are looked up in the table at ``cache``; texts whose
    digest is not stored for this tokenizer version are encoded, one document per
    distinct digest (the one with the least id), and their counts are appended.
    Two runs at a time may both append a count; equal counts are read as one.
    NULL counts as the empty text, which has no tokens. Repeated rows and ids
    come out as they came in. Other columns are not read.
    """
    spark, version = docs.sparkSession, tokenizer_version(model)
    own = docs.select(F.col(id_col).alias("doc_id"), whole(F.col(text_col)).alias("text"))
    keyed = stored(own.select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"), digest(F.col("text")).alias("digest")), "token-digests")
    distinct = keyed.groupBy("digest").agg(F.min("doc_id").alias("holder"))
    known = read_cache(spark, cache).filter(F.col("tokenizer") == version).groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))
    looked_up = stored(distinct.join(known, "digest", "left"), "token-lookup")
    misses = looked_up.filter("n_tokens is null").select("holder", F.col("digest").alias("missing"))
    texts = own.join(misses, own["doc_id"].eqNullSafe(misses["holder"])).withColumn("digest", digest(F.col("text")))
    texts = texts.filter(F.col("digest") == F.col("missing")).select("digest", "text")
    fresh = texts.mapInArrow(_counter(model), "digest binary, n_tokens long").groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))
    fresh = stored(fresh, "token-counts")
    fresh.select("digest", F.lit(version).alias("tokenizer"), "n_tokens").write.mode("append").parquet(cache)
    counts = looked_up.filter("n_tokens is not null").select("digest", "n_tokens").unionByName(fresh)
    return keyed.join(counts, "digest").select("doc_id", "n_bytes", "n_tokens")
