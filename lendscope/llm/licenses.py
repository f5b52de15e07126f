"""Operator 2: licences by sparse TF-IDF cosine, and by the nearest directory that has one.

Single notice lines, whole notice blocks and SPDX identifiers. DataFrame functions throughout.
"""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendscope.llm.common import whole
from lendscope.sources.workspace import stored

#: Cosine from which a notice counts.
LEAST_COSINE = 0.5
#: A file whose notices make up this share of its text is a licence file; so is one with such a name.
FILE_SHARE = 0.5
FILE_NAME = r"(?i)(^|/)(licen[cs]e|copying|notice)[^/]*$"
#: What a line must hold to be compared.
NOTICE = r"(?i)licen[cs]|copyright|spdx|public domain|all rights reserved|permission is hereby granted"
TOKEN = r"[a-z0-9]+(?:[.-][a-z0-9]+)*"

# Short notices of well-known licences.
TEMPLATES = (
    ("AGPL-3.0", "Licensed under the GNU Affero General Public License, version 3."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("BSD-2-Clause", "Licensed under the BSD 2-Clause Simplified License."),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause New or Revised License."),
    ("CC-BY-4.0", "This work is licensed under the Creative Commons Attribution License CC BY 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under the Creative Commons Attribution-NonCommercial License 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC0-1.0", "Dedicated to the public domain under CC0 1.0."),
    ("GPL-2.0", "This program is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("ISC", "Released under the ISC License."),
    ("LGPL-3.0", "Licensed under the GNU Lesser General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, version 2.0."),
    ("Proprietary", "Copyright. All rights reserved."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
)


# Further licences that SPDX lines name.
SPDX_NAMES = (
    "0BSD", "AFL-3.0", "AGPL-1.0", "Apache-1.1", "Artistic-1.0", "Artistic-2.0", "BSD-1-Clause", "BSD-3-Clause-Clear", "BSD-4-Clause", "BSL-1.0", "BUSL-1.1",
    "CC-BY-3.0", "CC-BY-ND-4.0", "CC-BY-NC-ND-4.0", "CC-BY-NC-SA-4.0", "CC-BY-SA-3.0", "CDDL-1.0", "CECILL-2.1", "CPL-1.0", "ECL-2.0", "EPL-1.0", "EPL-2.0",
    "EUPL-1.1", "EUPL-1.2", "FTL", "GFDL-1.3", "GPL-1.0", "HPND", "IJG", "ICU", "LGPL-2.0", "Libpng", "LPPL-1.3c", "MIT-0", "MPL-1.1", "MS-PL", "MS-RL",
    "MulanPSL-2.0", "NCSA", "OFL-1.1", "OpenSSL", "OSL-3.0", "PHP-3.01", "PostgreSQL", "PSF-2.0", "Python-2.0", "QPL-1.0", "Ruby", "SSPL-1.0", "Unicode-DFS-2016",
    "UPL-1.0", "Vim", "W3C", "WTFPL", "X11", "Zlib", "ZPL-2.1",
)

#: Comment lines; with the notice lines they make blocks.
COMMENT = r"(?i)^\s*(#|//|/?\*|--|;|%|<!--|\.\.\s|rem\b|dnl\b|\"\"\"|''')"
#: Words and version numbers, which identifiers such as apache-2.0 are split into.
PART = r"[a-z]+|[0-9]+(?:\.[0-9]+)*"
SPDX = r"(?i)spdx-license-identifier:([^\n]*)"
_BREAK, _NUMBER = "\u0000", "\u0001"

_GNU = """This {it} is free software: you can redistribute it and/or modify it under the terms of the GNU {name}
as published by the Free Software Foundation, {version}.
This {it} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied
warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {name} for more details.
You should have received a copy of the GNU {name} along with this {it}. If not, see <https://www.gnu.org/licenses/>."""
_VERSIONS = ("either version {} of the License, or (at your option) any later version", "version {} of the License")


def known_licenses() -> list[str]:
    """Licences that SPDX lines may name."""
    return sorted({*SPDX_NAMES, *(k for k, _ in block_templates())} - {"Proprietary"})


def block_templates() -> list[tuple[str, str]]:
    """Licence and text: short notices, headers of several lines, first parts of headers, full texts."""
    full = [(p.stem, p.read_text()) for p in sorted((Path(__file__).parent / "license_texts").glob("*.txt"))]
    # that licence is the GNU one of version 3 under its own name, with another section 13
    affero = next(t for k, t in full if k == "GPL-3.0").replace("GENERAL PUBLIC", "AFFERO GENERAL PUBLIC").replace("GNU General Public", "GNU Affero General Public")
    gnu = [("GPL-2.0", "General Public License", "2"), ("GPL-3.0", "General Public License", "3"), ("LGPL-2.1", "Lesser General Public License", "2.1"), ("LGPL-3.0", "Lesser General Public License", "3"), ("AGPL-3.0", "Affero General Public License", "3")]
    headers = [(k, _GNU.format(it=it, name=name, version=v.format(n))) for k, name, n in gnu for v in _VERSIONS for it in ("program", "library")]
    headers += [(k, h.partition("\nThis")[0]) for k, h in headers]
    apache = """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.
You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"""
    rest = """
Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."""
    mozilla = """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file,
You can obtain one at https://mozilla.org/MPL/2.0/."""
    return [*TEMPLATES, *headers, ("Apache-2.0", apache), ("Apache-2.0", apache + rest), ("MPL-2.0", mozilla), *full, ("AGPL-3.0", affero)]


def tokens_of(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(TOKEN), F.lit(0))


def parts_of(text: Column) -> Column:
    """Tokens of blocks; 2.0 is the version 2."""
    return F.transform(F.regexp_extract_all(F.lower(text), F.lit(PART), F.lit(0)), lambda t: F.regexp_replace(t, r"(\.0)+$", ""))


def _places(first: Column, size: Column, line: Column) -> Column:
    """A notice and the lines it stands on."""
    return F.struct(first.cast("int").alias("first"), size.cast("int").alias("size"), line.alias("line"))


def _no_places() -> Column:
    return F.array().cast("array<struct<first:int,size:int,line:string>>")


def lines_of(text: Column) -> Column:
    """Single lines that hold licence wording."""
    lines = F.transform(F.split(text, "\n", -1), lambda x, k: _places(k, F.lit(1), F.trim(x)))
    return F.filter(lines, lambda x: x["line"].rlike(NOTICE))


def blocks_of(text: Column, path: Column) -> Column:
    """Notice blocks of several lines: runs of comment and notice lines, paragraphs, and the whole of a licence file.

    Every line carries its number through the cuts, so a block knows where it stands.
    """
    lines = F.transform(F.split(text, "\n", -1), lambda x: F.rtrim(F.regexp_replace(x, "[\r\u0000\u0001]", " ")))
    numbered = lambda keep: F.array_join(F.transform(lines, lambda x, k: F.when(keep(x), F.concat(k.cast("string"), F.lit(_NUMBER), x)).otherwise(_BREAK)), "\n")
    cut = lambda keep: F.split(numbered(keep), _BREAK)
    whole_file = F.when(path.rlike(FILE_NAME), F.array(numbered(lambda x: F.lit(True)))).otherwise(F.array().cast("array<string>"))
    found = F.concat(cut(lambda x: x.rlike(COMMENT) | x.rlike(NOTICE)), cut(lambda x: x != ""), whole_file)
    found = F.filter(F.transform(found, lambda x: F.trim(x, F.lit("\n"))), lambda x: x.contains("\n") & x.rlike(NOTICE))
    placed = lambda x: _places(F.regexp_extract(x, rf"^(\d+){_NUMBER}", 1), F.size(F.split(x, "\n", -1)), F.regexp_replace(x, rf"(?m)^\d+{_NUMBER}", ""))
    return F.array_distinct(F.transform(found, placed))


def expression_of(line: Column) -> Column:
    """The licence expression behind an SPDX tag in the usual spelling; NULL where there is none, or where it
    names anything but known licences. Exceptions (WITH) and the endings of versions are left out."""
    usual = F.create_map(*[F.lit(x) for k in known_licenses() for x in (k.lower(), k)])
    said = F.regexp_replace(F.regexp_extract(line, SPDX, 1), r"(?i)\bwith\s+[A-Za-z0-9.-]+", " ")
    said = F.regexp_replace(said, r"[^A-Za-z0-9.+)]+$", "")
    shaped = said.rlike(r"(?i)^\s*[(\s]*[a-z0-9.+-]+[)\s]*(\s(and|or)\s[(\s]*[a-z0-9.+-]+[)\s]*)*$")
    name = lambda x: F.try_element_at(usual, F.lower(F.regexp_replace(x, r"(?i)(-only|-or-later|\+)$", "")))
    parts = F.transform(F.regexp_extract_all(said, F.lit(r"[()]|[A-Za-z0-9.+-]+"), F.lit(0)), lambda x: F.when(F.lower(x).isin("and", "or"), F.upper(x)).when(x.isin("(", ")"), x).otherwise(name(x)))
    known = F.size(parts) > 0
    spelled = F.regexp_replace(F.regexp_replace(F.array_join(parts, " "), r"\( ", "("), r" \)", ")")
    single = F.filter(parts, lambda x: ~x.isin("(", ")"))
    return F.when(shaped & known & ~F.exists(parts, lambda x: x.isNull()), F.when(F.size(single) == 1, single[0]).otherwise(spelled))


def identifiers_of(text: Column) -> Column:
    """SPDX lines: their place, their expression, and each licence that it names."""
    lines = F.transform(F.split(text, "\n", -1), lambda x, k: F.struct(k.cast("int").alias("first"), F.when(x.rlike(SPDX), expression_of(x)).alias("expression")))
    lines = F.filter(lines, lambda x: x["expression"].isNotNull())
    names = lambda x: F.filter(F.split(x["expression"], "[() ]+"), lambda n: (n != "") & ~n.isin("AND", "OR"))
    return F.flatten(F.transform(lines, lambda x: F.transform(names(x), lambda n: F.struct(x["first"].alias("first"), x["expression"].alias("expression"), n.alias("line")))))


def parent(path: Column) -> Column:
    """The directory of a path; empty at the top."""
    return F.regexp_extract(path, r"(?s)^(.*)/[^/]*$", 1)


def ancestors(directory: Column) -> Column:
    """A directory and all directories above it, the empty top included."""
    parts = F.split(directory, "/")
    above = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda n: F.array_join(F.slice(parts, F.lit(1), n), "/"))
    return F.array_distinct(F.concat(F.array(F.lit("")), above))


def _vectors(lines: DataFrame, frequency: DataFrame, total: Column) -> DataFrame:
    """(key, token, weight) with tf times idf; ``lines`` is (key, line)."""
    counted = lines.select("key", F.explode(tokens_of(F.col("line"))).alias("token")).groupBy("key", "token").agg(F.count("*").alias("tf"))
    idf = F.log((total + 1) / (F.col("df") + 1)) + 1
    return counted.join(frequency, "token").select("key", "token", (F.col("tf") * idf).alias("weight"))


def matched_lines(lines: DataFrame) -> DataFrame:
    """(key, license, cosine): the best template of each distinct line, if close enough.

    ``lines`` is (key, line, n): distinct lines with their digest and the number of files that hold
    them, which is what document frequencies count. Ties go to the first licence by name.
    """
    spark = lines.sparkSession
    templates = spark.createDataFrame([(k, name, text) for k, (name, text) in enumerate(TEMPLATES)], "key int, license string, line string")
    held = stored(lines.select("key", "line", "n"), "license-lines")
    tokens = held.select("n", F.explode(F.array_distinct(tokens_of(F.col("line")))).alias("token"))
    known = templates.select(F.lit(1).cast("long").alias("n"), F.explode(F.array_distinct(tokens_of(F.col("line")))).alias("token"))
    frequency = stored(tokens.unionByName(known).groupBy("token").agg(F.sum("n").alias("df")), "license-terms")
    total = F.lit(float((held.agg(F.sum("n")).first()[0] or 0) + len(TEMPLATES)))
    vectors = stored(_vectors(held.select("key", "line"), frequency, total), "license-vectors")
    wanted = _vectors(templates.select("key", "line"), frequency, total)
    sizes = wanted.groupBy("key").agg(F.sqrt(F.sum(F.col("weight") ** 2)).alias("size"))
    wanted = wanted.join(sizes, "key").join(templates.drop("line"), "key").select("key", "license", "token", (F.col("weight") / F.col("size")).alias("part"))
    norms = vectors.groupBy("key").agg(F.sqrt(F.sum(F.col("weight") ** 2)).alias("norm"))
    wanted = F.broadcast(wanted.withColumnRenamed("key", "template"))  # as many rows as the templates have tokens
    dots = vectors.join(wanted, "token").groupBy("key", "template", "license").agg(F.sum(F.col("weight") * F.col("part")).alias("dot"))
    scored = dots.join(norms, "key").withColumn("cosine", F.round(F.col("dot") / F.col("norm"), 6)).filter(F.col("cosine") >= LEAST_COSINE)
    best = scored.groupBy("key").agg(F.min(F.struct((-F.col("cosine")).alias("c"), F.col("license"))).alias("b"))
    return best.select("key", F.col("b.license").alias("license"), (-F.col("b.c")).alias("cosine"))


def matched_blocks(blocks: DataFrame, known: list[tuple[str, str]]) -> DataFrame:
    """(key, license, cosine): the best template of each distinct block, if close enough.

    ``blocks`` is (key, line): distinct blocks with their digest; ``known`` are the templates. Document frequencies are those of the templates, and a word of none of them has the
    frequency 0. So a block's vector needs no other block: blocks are dealt out once, as
    texts, and their words stay in the task.
    """
    spark = blocks.sparkSession
    templates = spark.createDataFrame([(k, name, text) for k, (name, text) in enumerate(known)], "key int, license string, line string")
    counted = lambda frame: frame.select("key", F.explode(parts_of(F.col("line"))).alias("token")).groupBy("key", "token").agg(F.count("*").alias("tf"))
    idf = lambda df: F.log((len(known) + 1) / (df + 1)) + 1
    frequency = stored(counted(templates).groupBy("token").agg(idf(F.count("*")).alias("idf")), "license-block-terms")
    weighted = lambda frame: counted(frame).join(F.broadcast(frequency), "token", "left").select("key", "token", (F.col("tf") * F.coalesce("idf", idf(F.lit(0)))).alias("weight"))
    wanted = weighted(templates)
    sizes = wanted.groupBy("key").agg(F.sqrt(F.sum(F.col("weight") ** 2)).alias("size"))
    wanted = wanted.join(sizes, "key").join(templates.drop("line"), "key").select(F.col("key").alias("template"), "license", "token", (F.col("weight") / F.col("size")).alias("part"))
    wanted = F.broadcast(stored(wanted, "license-block-templates"))  # as many rows as the templates have words
    vectors = weighted(blocks.select("key", "line"))
    norms = vectors.groupBy("key").agg(F.sqrt(F.sum(F.col("weight") ** 2)).alias("norm"))
    dots = vectors.join(wanted, "token").groupBy("key", "template", "license").agg(F.sum(F.col("weight") * F.col("part")).alias("dot"))
    scored = dots.join(norms, "key").withColumn("cosine", F.round(F.col("dot") / F.col("norm"), 6)).filter(F.col("cosine") >= LEAST_COSINE)
    best = scored.groupBy("key").agg(F.min(F.struct((-F.col("cosine")).alias("c"), F.col("license"))).alias("b"))
    return best.select("key", F.col("b.license").alias("license"), (-F.col("b.c")).alias("cosine"))


def license_scan(files: DataFrame, id_col: str = "doc_id", path_col: str = "path", text_col: str = "text") -> DataFrame:
    """One row per row of ``files``: doc_id, path, license, cosine, origin, from_path.

    Every line that holds licence wording is compared with the short templates; every
    notice block of several lines (``blocks_of``) with those of headers and full texts;
    and every licence that an SPDX line names with those of identifiers, where the line
    names known licences only. An SPDX expression is the licence as a whole. The closest of
    them all decides; ties by licence name. A block with a line that matches more closely than
    the block is text around a notice and does not count. origin is ``header`` where a file's own
    notice decides, ``file`` if that file is a licence file by its name or by the share of
    its text that matched lines and blocks stand on (each line once), ``inherited`` where the nearest
    directory above a file without a notice holds a licence file (of several in one
    directory the closest, then the one with the least path, then by licence name); else all
    four are NULL. A NULL path lies at the top and inherits from there only; NULL texts have
    no notice. Every row is judged by itself, whatever ids, paths and texts it shares with
    others, and comes out once; other columns are not read.
    """
    own = files.select(F.col(id_col).alias("doc_id"), F.col(path_col).cast("string").alias("path"), whole(F.col(text_col)).alias("text"))
    has_notice = F.col("text").rlike(NOTICE)
    marked = own.select(
        F.monotonically_increasing_id().alias("row"), "doc_id", "path", F.length("text").alias("chars"),
        F.when(has_notice, lines_of(F.col("text"))).otherwise(_no_places()).alias("notices"),
        F.when(has_notice, blocks_of(F.col("text"), F.coalesce("path", F.lit("")))).otherwise(_no_places()).alias("blocks"),
        F.when(has_notice, identifiers_of(F.col("text"))).alias("identifiers"),
        F.when(has_notice, F.transform(F.split("text", "\n", -1), lambda x: F.length(F.trim(x)))).alias("lengths"),
    )
    marked = stored(marked, "license-files")  # the row numbers are fixed from here on
    digest = F.sha2(F.col("line").cast("binary"), 256).alias("key")
    placed = lambda column: marked.filter(F.size(column) > 0).select("row", F.explode(column).alias("p")).select("row", "p.*").select("*", digest)
    lines, blocks, names = placed("notices"), placed("blocks"), placed("identifiers")
    texts = marked.filter(F.size("notices") > 0).select(F.explode(F.array_distinct(F.transform("notices", lambda x: x["line"]))).alias("line")).select(digest, "line")
    matched = stored(matched_lines(texts.groupBy("key").agg(F.first("line").alias("line"), F.count("*").alias("n"))), "license-matches")
    distinct = lambda frame: frame.groupBy("key").agg(F.first("line").alias("line"))
    whole_blocks = stored(matched_blocks(distinct(blocks), block_templates()), "license-blocks")
    whole_names = stored(matched_blocks(distinct(names), [(k, k) for k in known_licenses()]), "license-names")
    named = names.drop("line").join(whole_names.drop("license"), "key").select("row", "first", F.lit(1).alias("size"), F.col("expression").alias("license"), "cosine")
    single = stored(lines.drop("line").join(matched, "key").drop("key"), "license-found-lines")
    several = stored(blocks.drop("line").join(whole_blocks, "key").drop("key"), "license-found-blocks")
    inside = several.select("row", "first", "size", "license", "cosine", F.explode(F.sequence(F.col("first"), F.col("first") + F.col("size") - 1)).alias("at"))
    closest = single.groupBy("row", F.col("first").alias("at")).agg(F.max("cosine").alias("line_cosine"))
    several = inside.join(closest, ["row", "at"], "left").groupBy("row", "first", "size", "license", "cosine").agg(F.max("line_cosine").alias("line_cosine"))
    several = several.filter(F.col("line_cosine").isNull() | (F.col("cosine") >= F.col("line_cosine"))).drop("line_cosine")
    found = single.unionByName(several).unionByName(named)
    order = F.struct((-F.col("cosine")).alias("c"), F.col("license"))
    per_file = found.groupBy("row").agg(F.min(order).alias("b"), F.array_distinct(F.flatten(F.collect_list(F.sequence(F.col("first"), F.col("first") + F.col("size") - 1)))).alias("covered"))
    covered = F.aggregate("covered", F.lit(0).cast("long"), lambda total, k: total + F.col("lengths")[k])
    is_file = F.coalesce(F.col("path").rlike(FILE_NAME), F.lit(False)) | (covered >= FILE_SHARE * F.col("chars"))
    licensed = per_file.join(marked.select("row", "path", "chars", "lengths"), "row")
    licensed = stored(licensed.select("row", "path", F.struct("b.c", "b.license", (~is_file).alias("plain")).alias("b")), "license-own")
    directory = F.coalesce(parent(F.col("path")), F.lit(""))
    sources = licensed.filter("not b.plain").groupBy(directory.alias("above")).agg(F.min(F.struct(F.col("b.c").alias("c"), F.col("path"), F.col("b.license").alias("license"))).alias("s"))
    directories = marked.select(directory.alias("directory")).distinct()
    steps = directories.select("directory", F.posexplode(ancestors(F.col("directory"))).alias("depth", "above"))
    nearest = steps.join(sources, "above").groupBy("directory").agg(F.max_by("s", "depth").alias("s"))
    nearest = stored(nearest.select("directory", F.col("s.license").alias("near"), F.col("s.path").alias("near_path"), (-F.col("s.c")).alias("near_cosine")), "license-directories")
    rows = marked.select("row", "doc_id", "path", directory.alias("directory"))
    rows = rows.join(licensed.select("row", "b"), "row", "left").join(nearest, "directory", "left")
    has = F.col("b").isNotNull()
    origin = F.when(has & F.col("b.plain"), "header").when(has, "file").when(F.col("near").isNotNull(), "inherited")
    return rows.select(
        "doc_id", "path",
        F.when(has, F.col("b.license")).otherwise(F.col("near")).alias("license"),
        F.when(has, -F.col("b.c")).otherwise(F.col("near_cosine")).alias("cosine"),
        origin.alias("origin"),
        F.when(~has, F.col("near_path")).alias("from_path"),
    )
