"""Operator 12: secrets, told from examples by how many owners hold them.

Every text is searched for assignments, access keys, hexadecimal keys and further
token formats. What they hold is kept as a digest only. Over the whole corpus each
digest is counted by distinct repositories and distinct owners: a value that many
owners hold is an example copied around, one that few hold and that looks drawn at
random is a live credential.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendscope.llm.common import unpacked, whole
from lendscope.sources.workspace import stored

#: A value that more owners than this hold is a copied example.
MOST_OWNERS = 2
#: Bits per character from which a value looks drawn at random.
LEAST_BITS = 3.0

# The base kinds, in their order. An assignment holds its second group.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")
HEX = re.compile(r"[0-9a-f]{32,}")
LEAST_ASSIGNED = 8
BASE = ("assign", "access", "hex")

# Further formats that the method searches, in their order, each with words one of which a text must hold.
FURTHER = (
    ("pem", ("PRIVATE KEY-----",), re.compile(r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----([A-Za-z0-9+/=\s]{32,})-----END [A-Z ]{0,40}PRIVATE KEY-----")),
    ("github", ("ghp_", "gho_", "ghu_", "ghs_", "ghr_"), re.compile(r"(gh[pousr]_[A-Za-z0-9]{36,})")),
    ("slack", ("xoxa-", "xoxb-", "xoxp-", "xoxr-", "xoxs-"), re.compile(r"(xox[abprs]-[A-Za-z0-9-]{10,})")),
    ("google", ("AIza",), re.compile(r"(AIza[A-Za-z0-9_-]{35})")),
    ("jwt", ("eyJ",), re.compile(r"(?<![A-Za-z0-9_-])(eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,})")),
    ("url", ("://",), re.compile(r"://[^\s/:@]{1,64}:([^\s/:@]{6,64})@")),
    ("bearer", ("earer",), re.compile(r"[Bb]earer\x20+([A-Za-z0-9._~+/=-]{20,})")),
    # a long token of capitals, small letters and digits
    ("random", ("",), re.compile(r"(?<![A-Za-z0-9+/_=-])((?=[A-Za-z0-9+/_=-]*[0-9])(?=[a-z0-9+/_=-]*[A-Z])(?=[A-Z0-9+/_=-]*[a-z])[A-Za-z0-9+/_=-]{24,})")),
)
KINDS = (*BASE, *(kind for kind, _, _ in FURTHER))
KEYWORDS = ("password", "passwd", "secret", "token", "api_key", "apikey")
#: Words that only placeholders hold.
PLACEHOLDER = re.compile(r"example|sample|dummy|changeme|placeholder|your[_-]?|xxxx|1234567|abcdef", re.IGNORECASE | re.ASCII)

FOUND = "array<struct<kind:int,start:int,end:int,digest:binary,random:boolean>>"


def looks_random(value: str) -> bool:
    """Whether the characters of a value are spread like random ones, and no word says that it is none."""
    n = len(value)
    bits = -sum(c / n * math.log2(c / n) for c in Counter(value).values())
    return bits >= LEAST_BITS and not PLACEHOLDER.search(value)


def candidates(text: str) -> list[tuple[int, int, int, str]]:
    """(kind, start, end, value) by start, then kind: all base matches, and further ones that touch none before them."""
    out = []
    lower = text.lower()
    if any(k in lower for k in KEYWORDS):
        out += [(0, m.start(), m.end(), m[2]) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST_ASSIGNED]
    del lower
    if "AKIA" in text:
        out += [(1, m.start(), m.end(), m[0]) for m in ACCESS.finditer(text)]
    out += [(2, m.start(), m.end(), m[0]) for m in HEX.finditer(text)]
    taken = sorted((s, e) for _, s, e, _ in out)
    for kind, (_, hints, pattern) in enumerate(FURTHER, len(BASE)):
        if any(h in text for h in hints):
            fresh = [(kind, m.start(), m.end(), m[1]) for m in pattern.finditer(text)]
            if fresh:
                fresh = _untouched(fresh, taken)
                out += fresh
                taken = sorted(taken + [(s, e) for _, s, e, _ in fresh])
    return sorted(out, key=lambda c: (c[1], c[0]))


def _untouched(fresh: list[tuple[int, int, int, str]], taken: list[tuple[int, int]]) -> list[tuple[int, int, int, str]]:
    """Those of ``fresh`` that overlap none of ``taken``; both rise."""
    out, k, far = [], 0, 0
    for c in fresh:
        while k < len(taken) and taken[k][0] < c[2]:
            far = max(far, taken[k][1])
            k += 1
        if far <= c[1]:
            out.append(c)
    return out


def _scan(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    kind = pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32()), ("digest", pa.binary()), ("random", pa.bool_())]))
    for texts in batches:
        rows = []
        for text in texts:
            rows.append([
                {"kind": k, "start": s, "end": e, "digest": hashlib.sha256(v.encode()).digest()[:16], "random": looks_random(v)}
                for k, s, e, v in candidates(text.as_py())
            ])
        yield pa.array(rows, kind)


def found_in(text: Column) -> Column:
    """All candidates of a text; places count code points, ends are exclusive, values are digests."""
    return F.arrow_udf(_scan, FOUND)(whole(text))


def ownership(spans: DataFrame) -> DataFrame:
    """(digest, owners, repositories): distinct ones that hold each value.

    ``spans`` has digest, owner and repository. Counted in two steps, so that a value
    that stands everywhere is added up by owner before it meets in one task. NULL owners
    and repositories count as one each.
    """
    per_owner = spans.select("digest", "owner", "repository").distinct().groupBy("digest", "owner").agg(F.count("*").alias("repositories"))
    return per_owner.groupBy("digest").agg(F.count("*").alias("owners"), F.sum("repositories").alias("repositories"))


def secrets(docs: DataFrame, text_col: str = "text", owner_col: str = "source", repository: Column | None = None, most_owners: int = MOST_OWNERS) -> DataFrame:
    """``docs`` without its text, with secrets: array of (kind, start, end, live, owners, repositories), by start, then
    kind as in ``KINDS``.

    Base kinds are always listed. Of the further ones those stay that are live: held by at
    most ``most_owners`` distinct owners of the whole corpus, and random to look at. For a
    base match live says the same. ``repository`` names a document's repository within its
    owner (default: the owner's only one). A further match that overlaps a base match or one of
    an earlier kind is not listed. A column named secrets is replaced, all others pass
    through, row by row: repeated rows, NULL or shared ids and clashing names change
    nothing. A NULL or empty text has none; an empty table gives an empty one.
    """
    names = [c for c in docs.columns if c != text_col]
    owner = F.col(f"`{owner_col}`").cast("string") if owner_col in docs.columns else F.lit(None).cast("string")
    scanned = docs.select(
        F.monotonically_increasing_id().alias("_n"),
        F.struct(F.lit(0).alias("_"), *[F.col(f"`{c}`") for c in names]).alias("_row"),
        owner.alias("_owner"),
        (F.lit(None) if repository is None else repository).cast("string").alias("_repository"),
        found_in(F.col(f"`{text_col}`")).alias("_found"),
    )
    scanned = stored(scanned, "secret-spans")  # the row numbers are fixed from here on
    spans = scanned.filter(F.size("_found") > 0).select("_n", F.col("_owner").alias("owner"), F.col("_repository").alias("repository"), F.explode("_found").alias("f"))
    spans = spans.select("_n", "owner", "repository", "f.*")
    judged = spans.drop("owner", "repository").join(stored(ownership(spans), "secret-owners"), "digest")
    judged = judged.withColumn("live", F.col("random") & (F.col("owners") <= most_owners)).filter((F.col("kind") < len(BASE)) | F.col("live"))
    listed = judged.groupBy("_n").agg(F.sort_array(F.collect_list(F.struct("start", "kind", "end", "live", "owners", "repositories"))).alias("_spans"))
    kinds = F.array(*map(F.lit, KINDS))
    named = F.transform("_spans", lambda s: s.withField("kind", kinds[s["kind"]]))
    none = F.array().cast("array<struct<start:int,kind:string,end:int,live:boolean,owners:long,repositories:long>>")
    return scanned.drop("_found").join(listed, "_n", "left").select(*unpacked(names, secrets=F.coalesce(named, none)))


def spelled(spans: Column) -> Column:
    """``kind:start:end`` of each span, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def of_kind(spans: Column, *kinds: str) -> Column:
    return F.filter(spans, lambda s: s["kind"].isin(*kinds))
