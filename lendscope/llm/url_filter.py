"""Operator 7: URL rules, and for the rest a logistic regression on hashed character n-grams.

DataFrame functions throughout: parsing, rules, training and scoring.
"""

from __future__ import annotations

import json
import math
from dataclasses import dataclass
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lendscope.llm.common import packed, unpacked

#: Lengths of the character n-grams, and buckets that they are hashed to.
GRAMS, BUCKETS = (3, 4, 5), 1 << 12
#: Steps of gradient descent, their size, and the pull of weights towards 0.
STEPS, RATE, RIDGE = 30, 0.4, 1e-3
#: Score from which the method blocks.
BLOCK_FROM = 0.5

# Rules as (verdict, host, path).
RULES = (
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
)

# The labelled URLs, (host, path), 1 for those to block.
LABELLED = tuple(
    [(host, path, 1) for host, path in (
        ("spam-farm.example.org", "/en/12"), ("www.spam-farm.test", "/offers/"), ("cheap-pills.example.com", "/en/450"), ("buy-cheap-pills.test", "/order.html"),
        ("casino-bonus.example.org", "/play/1"), ("online-casino.test", "/slots/free-spins"), ("free-poker-chips.test", "/casino/bonus"), ("xxx-videos.test", "/adult/7"),
        ("adult-cams.example.com", "/live/xxx"), ("win-big-lottery.test", "/claim-prize"), ("fake-watches.test", "/replica/rolex"), ("replica-bags.example.com", "/cheap/"),
        ("payday-loans.test", "/apply-now"), ("fast-cash-loans.example.org", "/payday"), ("click-here-now.test", "/free-gift"), ("free-iphone-winner.test", "/claim"),
        ("seo-link-farm.test", "/backlinks/3"), ("link-farm.example.com", "/spam/9"), ("malware-download.test", "/crack/keygen.exe"), ("warez-cracks.example.org", "/keygen"),
        ("phishing-login.test", "/verify-account"), ("secure-bank-verify.test", "/login.php?x"), ("viagra-shop.example.com", "/pills/buy"), ("weightloss-pills.test", "/cheap"),
        ("ads.tracker.test", "/pixel/1"), ("ad-track.test", "/click?banner"), ("track-ads.example.com", "/en/9"), ("popup-ads.test", "/banner"),
    )]
    + [(host, path, 0) for host, path in (
        ("www.example.org", "/en/12"), ("example.com", "/"), ("blog.example.com", "/en/450"), ("news.example.org", "/2020/05/story.html"),
        ("m.example.com", "/fr/825"), ("docs.example.org", "/guide/install"), ("wiki.example.org", "/page/History"), ("www.library.test", "/catalogue/books"),
        ("university.test", "/research/papers/3"), ("blog.garden.test", "/posts/roses"), ("recipes.example.com", "/es/533/"), ("museum.test", "/exhibits/1"),
        ("weather.example.org", "/de/252"), ("city-council.test", "/minutes/2021"), ("www.theatre.test", "/en/148.html"), ("school.example.com", "/en/671"),
        ("thering.example.com", "/en/334/"), ("blog.thertion.example.org", "/es/978"), ("m.therou.example.com", "/en/474.html"), ("www.ththen.example.com", "/en/777"),
        ("forum.example.org", "/thread/889"), ("maps.test", "/places/park"), ("journal.example.com", "/articles/physics"), ("science.test", "/en/762"),
        ("podcast.test", "/episodes/40"), ("travel.example.org", "/fr/77/"), ("archive.example.com", "/de/19.html"), ("choir.test", "/concerts/spring"),
    )]
)


def lower_ascii(text: Column) -> Column:
    """A-Z lower-cased, other letters as they are."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end; path: from there up to ``?``,
    ``#`` or the end. Both empty for NULL or without ``://``. Line feeds are ordinary characters."""
    url = F.coalesce(url.cast("string"), F.lit(""))
    parts = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    return lower_ascii(F.regexp_extract(url, parts, 1)), F.regexp_extract(url, parts, 2)


def rule_for(host: Column, path: Column, rules: tuple[tuple[str, str, str], ...]) -> tuple[Column, Column]:
    """The longest fitting rule as text (host and path), and its verdict; NULL where none fits.

    A rule fits its host and all subdomains if the path starts with its path. Of
    rules of one length the first listed wins. The list is a parameter, so short.
    """
    longest = sorted(rules, key=lambda r: -len(r[1] + r[2]))
    rule = verdict = F.lit(None).cast("string")
    for kind, its_host, its_path in reversed(longest):
        fits = ((host == its_host) | host.endswith("." + its_host)) & path.startswith(its_path)
        rule, verdict = F.when(fits, its_host + its_path).otherwise(rule), F.when(fits, kind).otherwise(verdict)
    return rule, verdict


def _bucket(mark: str, text: Column, n: int, i: Column) -> Column:
    return F.pmod(F.xxhash64(F.lit(mark), F.substring(text, i, F.lit(n))), F.lit(BUCKETS)).cast("int")


def buckets_of(host: Column, path: Column) -> Column:
    """Buckets of the n-grams of host and path; those of the host and of the path are told apart."""
    texts = {"h": F.concat(F.lit("^"), host, F.lit("$")), "p": F.concat(path, F.lit("$"))}
    grams = []
    for mark, text in texts.items():
        for n in GRAMS:
            starts = F.when(F.length(text) >= n, F.sequence(F.lit(1), F.length(text) - (n - 1))).otherwise(F.array().cast("array<int>"))
            grams.append(F.transform(starts, partial(_bucket, mark, text, n)))
    return F.concat(*grams)


@dataclass(frozen=True)
class Model:
    bias: float
    weights: dict[int, float]


def fit(spark: SparkSession, labelled: tuple[tuple[str, str, int], ...] = LABELLED) -> Model:
    """Gradient descent over the labelled table; the value of a gram is its count over the root of all counts.

    The table is small, so are the weights: one per bucket that occurs in it.
    Each step sums gradients per bucket in Spark.
    """
    rows = spark.createDataFrame([(k, *r) for k, r in enumerate(labelled)], "row int, host string, path string, y int")
    grams = rows.select("row", "y", buckets_of(F.col("host"), F.col("path")).alias("g"))
    values = grams.select("row", "y", (1 / F.sqrt(F.size("g"))).alias("unit"), F.explode("g").alias("bucket")).groupBy("row", "y", "bucket").agg(F.sum("unit").alias("x"))
    values = values.coalesce(1).cache()
    positive, total = sum(r[2] for r in labelled), len(labelled)
    bias, weights = math.log(positive / (total - positive)), {}
    for _ in range(STEPS):
        margins = values.groupBy("row", "y").agg(F.sum(F.col("x") * weight_of(weights, F.col("bucket"))).alias("margin"))
        errors = margins.select("row", (1 / (1 + F.exp(-(F.col("margin") + bias))) - F.col("y")).alias("error"))
        gradient = values.join(F.broadcast(errors), "row").groupBy("bucket").agg(F.sum(F.col("x") * F.col("error")).alias("g")).collect()
        weights = {r.bucket: weights.get(r.bucket, 0.0) * (1 - RATE * RIDGE) - RATE * r.g for r in gradient}
    values.unpersist()
    return Model(bias, weights)


def weight_of(weights: dict[int, float], bucket: Column) -> Column:
    """Weight of a bucket, 0 if unseen, from a constant array of all buckets."""
    dense = [0.0] * BUCKETS
    for k, w in weights.items():
        dense[k] = w
    return F.element_at(F.from_json(F.lit(json.dumps(dense)), "array<double>"), bucket + 1)


def block_score(host: Column, path: Column, model: Model) -> Column:
    """Probability, 0 to 1, that a URL is to be blocked; empty host and path score like any other."""
    grams = buckets_of(host, path)
    total = F.aggregate(grams, F.lit(0.0), lambda s, g: s + weight_of(model.weights, g))
    margin = total / F.sqrt(F.greatest(F.size(grams), F.lit(1))) + F.lit(model.bias)
    return 1 / (1 + F.exp(-margin))


def judged(pages: DataFrame, model: Model, rules: tuple[tuple[str, str, str], ...] = RULES, url_col: str = "url") -> DataFrame:
    """``pages`` with host, path, rule, score and verdict; row by row, without a shuffle.

    The longest fitting rule decides; where none fits, rule is NULL and the
    verdict is block from a score of ``BLOCK_FROM``. A NULL, empty or malformed
    URL has an empty host and path, which no rule fits and of which no score says
    anything: it is blocked, whatever its score. Columns of
    those five names are replaced, all others pass through.
    """
    host, path = host_and_path(F.col("_0"))
    parsed = packed(pages, url_col).withColumns({"_host": host, "_path": path})
    rule, said = rule_for(F.col("_host"), F.col("_path"), rules)
    found = parsed.withColumns({"_rule": rule, "_said": said, "_score": block_score(F.col("_host"), F.col("_path"), model)})
    nowhere = (F.col("_host") == "") & (F.col("_path") == "")
    verdict = F.coalesce("_said", F.when(nowhere | (F.col("_score") >= BLOCK_FROM), "block").otherwise("allow"))
    names = {"host": F.col("_host"), "path": F.col("_path"), "rule": F.col("_rule"), "score": F.col("_score"), "verdict": verdict}
    return found.select(*unpacked(pages.columns, **{url_col: F.col("_0")}, **names))
