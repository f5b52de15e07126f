"""The corpus pipeline: five operators in a row over the documents.

Every stage takes and returns all columns of its documents, whatever their names
(the last returns the encoded texts). Rows without an id are documents like any
other. NULL and empty texts pass the toxicity, line and benchmark stages unchanged;
the near-copy stage groups them with each other, and one stays. Repeated rows are
near copies of each other. Of an empty table every stage makes an empty one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lendscope.llm import decontaminate, line_dedup, pieces, simhash, toxicity
from lendscope.llm.common import packed, table, unpacked
from lendscope.llm.queries import SIMHASH_BITS, SIMHASH_WORDS, TOXIC_FROM, encoded_digests, model_bytes
from lendscope.sources.workspace import fresh_path

# The stages share their Python workers, so the last one takes smaller blocks.
PIECE_BLOCK_CHARS = 10_000_000


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score at least ``TOXIC_FROM`` go; the model is learned from the labelled ones."""
    model = toxicity.fit(docs.select("doc_id", "text"), table(spark, sf_dir, "labels"))
    scored = packed(docs).withColumn("_score", toxicity.score(F.col("_row").getField("text"), model))
    return scored.filter(F.col("_score") < TOXIC_FROM).select(*unpacked(docs.columns))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later occurrences of three-line windows go; n_chars follows the text."""
    own = [c for c in docs.columns if c not in ("doc_id", "text")]
    out = line_dedup.dedup_lines(docs.select("doc_id", "text", F.struct(F.lit(0).alias("_"), *[F.col(f"`{c}`") for c in own]).alias("own")))
    return _counted(out.select(*[F.col(c) if c in ("doc_id", "text") else F.col("own").getField(c).alias(c) for c in docs.columns]))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group stays, the one with the least id."""
    return simhash.one_of_each(docs, shingle=SIMHASH_WORDS, max_bits=SIMHASH_BITS)


def drop_benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of test items go, and documents that mostly consist of them."""
    return _counted(decontaminate.decontaminated(docs, table(spark, sf_dir, "benchmark")))


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of the texts that are left, with digests of the ids and of the text they decode to."""
    return encoded_digests(pieces.encode_decode(docs, model_bytes(), block_chars=PIECE_BLOCK_CHARS))


def _counted(docs: DataFrame) -> DataFrame:
    """n_chars, where there is one, is the length of the text."""
    return docs.withColumn("n_chars", F.coalesce(F.length("text").cast("long"), F.lit(0))) if "n_chars" in docs.columns else docs


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("simhash_near_dedup", drop_near_copies),
    ("benchmark_decontamination", drop_benchmark_passages),
    ("sentencepiece", encode_pieces),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each stage's rows are written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = fresh_path(spark, f"corpus-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)


#: SQL cannot learn the toxicity grammar; tests hold the result against a brute-force version.
ORACLE_SQL = None
