"""The registered queries: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lendscope.llm import conversations, decontaminate, exact_dedup, licenses, line_dedup, periodic, pieces, quality, secrets, simhash, token_counts, toxicity, url_filter
from lendscope.llm.common import fold, sha256, table
from lendscope.llm.oracles import ORACLES  # noqa: F401
from lendscope.sources.workspace import fresh_path

#: Production parameters.
PIECE_MODEL = "piece_bpe_32k.model"
TOXIC_FROM = 0.5
GOOD_FROM = 0.3
TOKEN_LIMIT = 4096
SIMHASH_WORDS, SIMHASH_BITS = 3, 2


def model_bytes(name: str = PIECE_MODEL) -> bytes:
    """A public vocabulary file; half a megabyte, read by the driver and sent with the tasks."""
    import public_tokenizers

    with open(public_tokenizers.path(name), "rb") as file:
        return file.read()


def quality_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = quality.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    held_out = (fold(F.col("doc_id")) == 0).alias("held_out")
    return scored.select("doc_id", held_out, "score", (F.col("score") >= GOOD_FROM).cast("int").alias("predicted"))


def licenses_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents as files: a folder per source, one per language in it."""
    parts = [F.coalesce(c, F.lit("_")) for c in ("source", "lang", F.col("doc_id").cast("string"))]
    docs = table(spark, sf_dir, "documents").select("doc_id", F.concat_ws("/", *parts).alias("path"), "text")
    return licenses.license_scan(docs)


def toxicity_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    scored = toxicity.with_toxicity(docs, model, to="score")
    held_out = (fold(F.col("doc_id")) == 0).alias("held_out")
    return scored.select("doc_id", held_out, "score", (F.col("score") >= TOXIC_FROM).cast("int").alias("predicted"))


def line_dedup_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.dedup_lines(docs).select("doc_id", "n_lines", "n_removed", "text")


def decontaminate_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.matches(docs, table(spark, sf_dir, "benchmark"))
    n_hit = decontaminate.hit_words(F.col("spans"))
    return found.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        sha256(F.array_join("items", ",")).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


def pieces_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = pieces.encode_decode(table(spark, sf_dir, "documents"), model_bytes())
    return encoded_digests(out).drop("ids")


def encoded_digests(encoded: DataFrame) -> DataFrame:
    return encoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        "ids",
        sha256(F.array_join(F.col("ids").cast("array<string>"), ",")).alias("ids_sha256"),
        sha256(F.col("decoded")).alias("decoded_sha256"),
    )


def url_filter_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return url_filter.judged(pages, url_filter.fit(spark)).drop("url")


def token_counts_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With a cache of its own, so that the figures are those of a first run."""
    counted = token_counts.token_counts(table(spark, sf_dir, "documents"), model_bytes(), fresh_path(spark, "token-cache"))
    return counted.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


def simhash_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=SIMHASH_WORDS, max_bits=SIMHASH_BITS)
    return found.select("doc_id", simhash.hex_of(F.col("fp")).alias("fingerprint"), "component_id")


def exact_dedup_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(table(spark, sf_dir, "documents"))


def damaged(conversations: DataFrame) -> DataFrame:
    """Conversations with faults, chosen by a hash of conversation and turn."""
    said = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fault = F.crc32(F.concat(said("conv_id"), F.lit(":"), said("turn")).cast("binary")) % 20
    text = F.when(fault == 1, F.lit("")).when(fault == 2, F.regexp_replace(said("text"), "[.!?]", "")).otherwise(said("text"))
    role = F.when(fault == 4, F.lit("user")).otherwise(said("role"))
    copies = F.when(fault == 0, 0).when(fault == 3, 2).otherwise(1)
    return conversations.select("conv_id", "turn", role.alias("role"), text.alias("text"), copies.alias("copies"))


def conversations_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.report(*conversations.repair(damaged(table(spark, sf_dir, "conversations"))))


def secrets_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A source is an owner, each of its languages a repository."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "lang", "text")
    found = secrets.secrets(docs, owner_col="source", repository=F.col("lang"))
    spans = F.col("secrets")
    number = lambda *kinds: F.size(secrets.of_kind(spans, *kinds)).cast("long")
    return found.select(
        "doc_id",
        *[number(kind).alias(f"n_{kind}") for kind in secrets.BASE],
        sha256(secrets.spelled(secrets.of_kind(spans, *secrets.BASE))).alias("base_sha256"),
        secrets.spelled(spans).alias("spans"),
        F.size(F.filter(spans, lambda s: s["live"])).cast("long").alias("n_live"),
        F.size(F.filter(spans, lambda s: s["owners"] > secrets.MOST_OWNERS)).cast("long").alias("n_copied"),
    )


def with_periods(docs: DataFrame) -> DataFrame:
    """Documents of which a tenth, chosen by a hash of the id, repeat a stretch of their words to the end; NULL ids are left."""
    words = F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    hashed = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    chosen = F.coalesce(hashed % 10 == 0, F.lit(False))
    split = docs.withColumn("_words", F.when(chosen, words)).withColumn("_g", F.floor(hashed / 10))
    n = F.size("_words")
    start = (F.col("_g") % n).cast("int")
    split = split.withColumn("_a", F.when(n > 0, start)).withColumn("_p", F.when(n > 0, F.floor((n - start) / (3 + F.col("_g") % 8)).cast("int") + 1))
    a, p = F.col("_a"), F.col("_p")
    place = lambda i: F.when(i < a, i).otherwise(a + (i - a) % p)
    repeated = F.array_join(F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.get("_words", place(i))), " ")
    return split.withColumn("text", F.when(chosen & (n > 0), repeated).otherwise(F.col("text"))).drop("_words", "_g", "_a", "_p")


def periodic_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic.periodic_runs(with_periods(table(spark, sf_dir, "documents").select("doc_id", "text")))
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("back"), (-r["period"]).alias("period"))))
    line = lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))
    found = found.withColumn("longest", longest)
    length, period = F.col("longest.length"), -F.col("longest.period")
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("longest.back")).alias("start"),
        length.alias("length"),
        period.alias("period"),
        F.floor(1000 * length / period).alias("exponent_milli"),
        sha256(F.array_join(F.transform("runs", line), "")).alias("runs_sha256"),
        sha256(F.col("collapsed")).alias("collapsed_sha256"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality": quality_query,
    "op2_licenses": licenses_query,
    "op3_pieces": pieces_query,
    "op4_line_dedup": line_dedup_query,
    "op5_toxicity": toxicity_query,
    "op6_decontaminate": decontaminate_query,
    "op7_url_filter": url_filter_query,
    "op8_token_counts": token_counts_query,
    "op9_simhash": simhash_query,
    "op10_exact_dedup": exact_dedup_query,
    "op11_conversations": conversations_query,
    "op12_secrets": secrets_query,
    "op13_periodic_runs": periodic_query,
}


