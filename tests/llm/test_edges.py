"""Every operator on NULLs, empty and very long texts, ties, repeated rows, empty tables and clashing names."""

from __future__ import annotations

import re
from collections import Counter, defaultdict

import brute
import pytest

from lendscope.llm import decontaminate, exact_dedup, licenses, line_dedup, pieces, quality, simhash, token_counts, toxicity, url_filter
from lendscope.llm.queries import model_bytes
from lendscope.sources.workspace import fresh_path

LABELS = "doc_id long, quality int, toxic int"


def bag(rows) -> Counter:
    return Counter(tuple(r) for r in rows)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(i, i % 2, int(i % 3 == 0)) for i in range(1, 18)] + [(None, 1, 1), (3, None, None), (4, 0, 0)], LABELS)


@pytest.fixture(scope="module")
def sp():
    return pieces.processor(model_bytes())


def test_quality(spark, messy, empty, labels, texts):
    rows = quality.quality_scores(messy, labels).collect()
    assert Counter(r.doc_id for r in rows) == Counter(i for i, _ in texts)
    assert all(0 <= r.score <= 1 for r in rows)
    assert quality.quality_scores(empty, labels).collect() == []
    assert {r.score for r in quality.quality_scores(messy, labels.limit(0)).collect()} == {0.5}


def test_isotonic_rises_and_keeps_the_order():
    import numpy as np

    x, y = np.arange(6.0), np.array([0, 0.5, 0.2, 0.1, 1, 0.9])
    points, values = quality.isotonic(x, y, np.ones(6))
    assert (np.diff(points) >= 0).all() and (np.diff(values) >= 0).all() and points[0] == 0 and points[-1] == 5


def test_fourier_features_approximate_the_kernel():
    import numpy as np

    n = len(quality.STATISTICS)
    x = np.random.default_rng(1).normal(size=(2, n)) / 3
    z = quality.Fourier(np.zeros(n), np.ones(n)).features(x)[:, :-1]
    assert abs(z[0] @ z[1] - np.exp(-((x[0] - x[1]) ** 2).sum() / (2 * quality.WIDTH**2))) < 0.2


def test_licenses(spark, empty):
    files = [
        (1, "a/LICENSE", "Released under the MIT License."), (2, "a/b/x.txt", "no notice\nat all"), (3, "a/b/c/y.txt", "Licensed under the Apache License, Version 2.0.\n" + "code " * 40),
        (4, "d/z.txt", "nothing"), (5, None, None), (6, "a/b/COPYING", "This work is licensed under the GNU General Public License, version 3."), (7, "a/b/c/d/e.txt", ""),
        (8, "top.txt", "plain"), (None, "a/n.txt", "plain"), (2, "a/b/x.txt", "no notice\nat all"), (9, "ab/q.txt", "plain"), (10, "d/w.txt", "a license of nobody known, " * 3),
    ]
    frame = spark.createDataFrame([(*f, 1, "k") for f in files], "doc_id long, path string, text string, n int, key string")
    got = {(r.doc_id, r.path): (r.license, r.origin, r.from_path) for r in licenses.license_scan(frame).collect()}
    assert got[1, "a/LICENSE"] == ("MIT", "file", None)
    assert got[2, "a/b/x.txt"] == ("GPL-3.0", "inherited", "a/b/COPYING")
    assert got[3, "a/b/c/y.txt"] == ("Apache-2.0", "header", None)
    assert got[7, "a/b/c/d/e.txt"] == ("GPL-3.0", "inherited", "a/b/COPYING")
    assert got[None, "a/n.txt"] == ("MIT", "inherited", "a/LICENSE")
    for key in ((4, "d/z.txt"), (5, None), (8, "top.txt"), (9, "ab/q.txt"), (10, "d/w.txt")):
        assert got[key] == (None, None, None)
    assert licenses.license_scan(frame).count() == len(files)
    assert licenses.license_scan(frame.limit(0)).collect() == []


def test_licenses_by_rows_and_positions(spark):
    mit, header = "Released under the MIT License.", "# Licensed under the Apache License, Version 2.0.\n# plain remark\n"
    source = header + "\n" + "x = 1\n" * 28
    assert 0.25 < (len(header) - 2) / len(source) < 0.35
    files = [
        (None, "n/a.py", mit), (None, "n/b.py", "Licensed under the Apache License, Version 2.0."), (None, "n/c.py", "nothing"),
        (1, "h/x.py", source), (2, "h/y.py", "nothing"), (1, "h/x.py", source),
        (3, "r/x.py", mit + "\n" + "y" * 45), (3, "r/x.py", mit + "\n" + "y" * 45), (4, "r/y.py", "nothing"),
        (5, "p/z.py", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software.\n" + "long " * 10_000),
        (6, "q/z.py", (mit + "\n") * 3_000),
    ]
    frame = spark.createDataFrame([(*f, "x", "y") for f in files], "doc_id long, path string, text string, line string, license string")
    got = bag((r.doc_id, r.path, r.license, r.origin) for r in licenses.license_scan(frame).collect())
    assert got == Counter(
        [(None, "n/a.py", "MIT", "file"), (None, "n/b.py", "Apache-2.0", "file"), (None, "n/c.py", "MIT", "inherited")]
        + 2 * [(1, "h/x.py", "Apache-2.0", "header")] + [(2, "h/y.py", None, None)]
        + 2 * [(3, "r/x.py", "MIT", "header")] + [(4, "r/y.py", None, None), (5, "p/z.py", "MIT", "header"), (6, "q/z.py", "MIT", "file")]
    )


def test_licenses_named_by_spdx_lines(spark):
    said = {
        "MIT": "MIT", "(MIT OR GPL-2.0-only)": "(MIT OR GPL-2.0)", "Apache-2.0 AND (mit or BSD-3-Clause)": "Apache-2.0 AND (MIT OR BSD-3-Clause)",
        "GPL-2.0-or-later WITH Classpath-exception-2.0": "GPL-2.0", "MIT */": "MIT", "epl-2.0": "EPL-2.0", "see docs": None, "docs": None, "MIT OR LicenseRef-own": None, "": None,
    }
    files = [(k, f"f{k}/x.c", f"/* SPDX-License-Identifier: {v}\n" + "int x;\n" * 30) for k, v in enumerate(said)]
    files.append((99, "f99/x.c", 'print("SPDX-License-Identifier: see docs")'))
    got = {r.doc_id: (r.license, r.cosine) for r in licenses.license_scan(spark.createDataFrame(files, "doc_id long, path string, text string")).collect()}
    assert got == {k: (v, 1.0 if v else None) for k, v in [*enumerate(said.values()), (99, None)]}


def test_licenses_of_blocks_full_texts_and_identifiers(spark):
    from pathlib import Path

    gnu = "# This program is free software: you can redistribute it and/or modify\n# it under the terms of the GNU General Public License as published by\n# the Free Software Foundation, either version {} of the License, or\n# (at your option) any later version.\n\n" + "code = 1\n" * 90
    full = {p.stem: p.read_text() for p in (Path(licenses.__file__).parent / "license_texts").glob("*.txt")}
    names = ["Apache-2.0", "GPL-3.0-only", "BSD-3-Clause", "CC-BY-4.0", "LGPL-2.1+", "Zlib", "mit", "GPL-2.0-only WITH Classpath-exception-2.0"]
    usual = ["Apache-2.0", "GPL-3.0", "BSD-3-Clause", "CC-BY-4.0", "LGPL-2.1", "Zlib", "MIT", "GPL-2.0"]
    files = [(k, f"s{k}/a.c", f"/* SPDX-License-Identifier: {n} */\nint x;\n" + "x = 2;\n" * 50) for k, n in enumerate(names)]
    files += [(20, "g2/a.py", gnu.format(2)), (21, "g3/a.py", gnu.format(3)), (22, "g3/b.c", gnu.format(3).replace("# ", "// ")), (23, "p/a.txt", gnu.format(3).replace("# ", ""))]
    files += [(100 + k, f"f{k}/LICENSE", f"Copyright (c) 2020 Someone\n\n{t}") for k, t in enumerate(full.values())] + [(200 + k, f"f{k}/sub/x.py", "x = 1") for k in range(len(full))]
    files += [(300, "n/a.c", "// a license of nobody known\n// at all, in several lines\nint x;")]
    got = {r.doc_id: (r.license, r.origin) for r in licenses.license_scan(spark.createDataFrame(files, "doc_id long, path string, text string")).collect()}
    assert [got[k] for k in range(len(names))] == [(n, "header") for n in usual]
    assert [got[k] for k in range(20, 24)] == [("GPL-2.0", "header")] + [("GPL-3.0", "header")] * 3
    assert [got[100 + k] for k in range(len(full))] == [(n, "file") for n in full] and [got[200 + k] for k in range(len(full))] == [(n, "inherited") for n in full]
    assert got[300] == (None, None) and len(got) == len(files)


def test_pieces(messy, empty, texts, sp):
    rows = pieces.encode_decode(messy, model_bytes()).collect()
    expected = [(i, tuple(sp.encode(t or "")), sp.decode(sp.encode(t or "")) if t else "") for i, t in texts]
    assert Counter((r.doc_id, tuple(r.ids), r.decoded) for r in rows) == Counter(expected)
    assert pieces.encode_decode(empty, model_bytes()).collect() == []


def test_packed_numbers_come_back():
    import numpy as np

    values = np.array([0, 1, 127, 128, 383, 384, pieces.LARGE - 1, pieces.LARGE, pieces.LARGE + 1, 2**31, 2**32 - 1] * 3)
    assert (pieces._unpack(pieces._pack(values)) == values).all()
    assert len(pieces._unpack(pieces._pack(values[:0]))) == 0


def test_pieces_of_many_blocks(messy, texts, sp):
    rows = pieces.encode_decode(messy.repartition(3), model_bytes(), buckets=7, block_chars=50).collect()
    assert Counter((r.doc_id, tuple(r.ids)) for r in rows) == Counter((i, tuple(sp.encode(t or ""))) for i, t in texts)


def test_line_dedup(messy, empty, texts):
    rows = line_dedup.dedup_lines(messy).collect()
    assert bag((r.doc_id, r.text, r.n_removed) for r in rows) == bag(brute.dedup_lines(texts))
    assert rows[0]._row == 3 and rows[0].line == "l" and set(messy.columns) <= set(rows[0].asDict())
    assert line_dedup.dedup_lines(empty).collect() == []


def test_line_dedup_keeps_the_first_of_overlapping_windows(spark):
    frame = spark.createDataFrame([(1, "a\na\na\na\na\na"), (2, "x\na\na\na\ny")], "doc_id long, text string")
    assert {r.doc_id: r.text for r in line_dedup.dedup_lines(frame).collect()} == {1: "a\na\na", 2: "x\ny"}


def test_toxicity(spark, messy, empty, labels, texts):
    model = toxicity.fit(messy, labels)
    out = toxicity.with_toxicity(messy, model, to="score")
    rows = out.collect()
    assert bag((r.doc_id, r.text) for r in rows) == bag(texts) and out.columns.count("score") == 1
    assert all(0 <= r.score <= 1 for r in rows)
    assert toxicity.with_toxicity(empty, toxicity.fit(empty, labels)).collect() == []
    assert toxicity.fit(messy, labels.limit(0)).weights == {}


def test_toxicity_grammar_reads_clauses():
    lexicon = toxicity.Lexicon({"idio": 2.0})
    kinds = lambda text: [{k for k, v in c.items() if v} for c in toxicity.scored_clauses(text, lexicon)]
    assert kinds("an idiot. plain words") == [{"plain"}]
    assert kinds("You are an idiot!") == [{"targeted"}]
    assert kinds("he is not an idiot") == [{"negated"}]
    assert kinds("not now. an idiot") == [{"plain"}]
    assert kinds("she said idiot") == [{"reported"}]
    assert kinds("I will kill you") == [{"threat"}]
    assert kinds("you, I will kill") == [{"threat"}]


def test_toxicity_threats_before_and_after_their_target():
    lexicon = toxicity.Lexicon({"idio": 2.0, "burn": 3.0})
    sums = lambda text: [{k: v for k, v in c.items() if v} for c in toxicity.scored_clauses(text, lexicon)]
    for text in ("I will kill you", "we will hurt them", "he killed", "stabbing you", "te mataré", "Voy a matarte", "ich werde dich töten", "on va vous tuer", "they shot"):
        assert sums(text) == [{"threat": 1.0}], text
    assert sums("burn her") == sums("you will burn") == [{"threat": 3.0}] and sums("burn it") == [{"plain": 3.0}]
    assert sums("kill and hurt you") == [{"threat": 2.0}]
    assert sums("never kill you") == [{"negated": 1.0}] and sums("quote: kill") == sums("the kill. you") == sums("kill it") == []
    assert sums("reportedly kill idiot you") == [{"reported": 3.0}]
    for text in ("your skill", "you mate", "bless you", "your stability", "hier sie", "blessed them"):
        assert sums(text) == [], text


def test_toxicity_drops_only_near_copies_of_the_same_class(spark):
    import random

    draw = random.Random(1)
    prose = lambda n: [f"w{draw.randrange(10**6)}".translate(str.maketrans("0123456789", "abcdefghij")) for _ in range(n)]
    boiler, base = prose(60), prose(200)
    one_word = [*base[:100], "other", *base[101:]]
    insulted = [w for k, x in enumerate(base) for w in ((x, "insult") if k % 4 == 0 else (x,))]
    rows = [(1, base, 0), (2, base, 0), (3, one_word, 0), (4, base, 1), (5, insulted, 1), (6, insulted, 1)]
    rows += [(10 + k, boiler + prose(60), k % 2) for k in range(8)] + [(20, base[:3], 0), (21, base[:3], 0), (22, [], 0), (23, [], 1)]
    frame = spark.createDataFrame([(i, " ".join(words), y, i % 2) for i, words, y in rows], "doc_id long, text string, y int, half int")
    kept = toxicity.without_copies(frame)
    assert kept.columns == frame.columns and sorted(r.doc_id for r in kept.collect()) == [1, 4, 5, *range(10, 18), 20, 22, 23]
    assert toxicity.without_copies(frame.limit(0)).collect() == []


def test_toxicity_learns_many_rare_and_short_insults(spark):
    import random
    from zlib import crc32

    draw = random.Random(2)
    word = lambda n: "".join(draw.choice("bcdfghklmnprstvwz") for _ in range(n))
    common, insults = [word(7) for _ in range(400)], [word(3) for _ in range(40)] + [word(7) for _ in range(80)]
    ids = [i for i in range(1, 8000) if crc32(str(i).encode()) % 5][:5400]
    rows = [(i, draw.choices(common, k=15) + ([insults[k % 120]] if k < 600 else []), int(k < 600)) for k, i in enumerate(ids)]
    docs = spark.createDataFrame([(i, " ".join(["you", *words])) for i, words, _ in rows], "doc_id long, text string")
    model = toxicity.fit(docs, spark.createDataFrame([(i, 0, y) for i, _, y in rows], LABELS))
    lexicon = toxicity.Lexicon(model.weights)
    assert [w for w in insults if not lexicon.weight(w)] == []
    assert sum(lexicon.weight(w) > 0 for w in common) <= 2 and not lexicon.weight("you")


def test_toxicity_evidence(spark):
    import math

    from pyspark.sql import functions as F

    cases = [(17, 0, 0.11), (3, 0, 0.5), (30, 20, 0.11), (5, 45, 0.1), (4, 45, 0.1), (0, 9, 0.1), (9, 0, 1.0)]
    frame = spark.createDataFrame([(i, *c) for i, c in enumerate(cases)], "i int, t long, c long, base double")
    for i, (t, c, base) in enumerate(cases):
        own = toxicity.evidence(t, c, base)
        tail = sum(math.comb(t + c, k) * base**k * (1 - base) ** (t + c - k) for k in range(t, t + c + 1))
        assert 0 <= own <= -math.log(tail) + 1e-9 and (c or base == 1 or math.isclose(own, -math.log(tail)))
        assert math.isclose(frame.filter(f"i = {i}").select(toxicity._evidence(F.col("t"), F.col("c"), base)).first()[0], own, abs_tol=1e-9)


def test_toxicity_stem_rules():
    lexicon = toxicity.Lexicon({"lowe": 3.0, "lower$": 0.0})
    assert lexicon.weight("loweisch") == 3.0 and lexicon.weight("lower") == 0.0 and lexicon.weight("low") == 0.0


ITEMS = [(1, "alpha beta gamma"), (2, " ".join(f"word{i} x{i % 7}" for i in range(100, 110))), (3, None), (4, ""), (5, "no ID at"), (5, "one two three four five six seven eight nine ten eleven"), (None, "leading and")]


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame(ITEMS, "item_id long, text string")


@pytest.mark.parametrize("block", [decontaminate.BLOCK_CHARS, 40])
def test_decontaminate(messy, empty, items, texts, monkeypatch, block):
    monkeypatch.setattr(decontaminate, "BLOCK_CHARS", block)
    rows = decontaminate.matches(messy, items).collect()
    table = brute.windows(ITEMS)
    expected = []
    for doc, text in texts:
        n, hit, found = brute.hits(text, table)
        expected.append((doc, n, len(hit), tuple(found)))
    assert Counter((r.doc_id, r.n_words, sum(s["after"] - s["first"] for s in r.spans), tuple(r["items"])) for r in rows) == Counter(expected)
    clean = decontaminate.decontaminated(messy, items)
    assert clean.columns == messy.columns
    kept = [(doc, brute.without_hits(text, table)) for doc, text in texts]
    assert bag((r.doc_id, r.text) for r in clean.collect()) == bag(k for k in kept if k[1] is not ...)
    assert decontaminate.decontaminated(empty, items).collect() == []
    assert decontaminate.decontaminated(messy, items.limit(0)).count() == len(texts)


def test_automaton_against_brute_force():
    import random

    draw = random.Random(5)
    for _ in range(60):
        items = {str(k): [draw.choice("abc") for _ in range(draw.randint(1, 9))] for k in range(draw.randint(1, 5))}
        machine = decontaminate.Matcher(decontaminate.SuffixAutomaton({k: [w.encode() for w in v] for k, v in items.items()}, 4).packed())
        table = brute.windows([(k, " ".join(v)) for k, v in items.items()], 4)
        doc = [draw.choice("abcd") for _ in range(40)]
        _, hit, found = brute.hits(" ".join(doc), table)
        spans, names = machine.find([w.encode() for w in doc])
        assert {i for a, b in spans for i in range(a, b)} == hit and sorted(names) == found
        assert all(x[1] < y[0] for x, y in zip(spans, spans[1:], strict=False))


def test_packed_automaton_takes_few_bytes():
    import random

    draw = random.Random(6)
    items = {str(k): [b"%x" % draw.randrange(20_000) for _ in range(100)] for k in range(400)}
    machine = decontaminate.SuffixAutomaton(items, 10)
    packed = machine.packed()
    size = sum(len(v) for v in packed.values() if isinstance(v, bytes))
    assert size < 64 * sum(map(len, items.values())) and len(machine.link) < 2 * 40_000
    matcher = decontaminate.Matcher(packed)
    assert matcher.find(items["7"][20:60]) == ([(0, 40)], {"7"}) and matcher.find(items["7"][:9]) == ([], set())


def test_url_filter(spark):
    urls = [
        None, "", "no scheme", "http://Example.NET/en/25?x", "http://a.example.net/fr/1", "https://example.com/de/1#top", "http://x.org/fr/", "http://xorg/fr/", "http://spam-farm.example.org/en/1",
        "http://net", "http://foo.net?x/y", "http://h/p://q/r", "ftp://ÄB.org/fr/\nx", "http://net", "http://www.example.org/en/5", "http://" + "long" * 5000 + ".org/en/",
    ]
    pages = spark.createDataFrame([(i, u, "mine", "theirs", 1) for i, u in enumerate(urls)], "page_id long, url string, host string, rule string, _0 int")
    out = url_filter.judged(pages, url_filter.fit(spark))
    rows = {r.page_id: r for r in out.collect()}
    assert len(rows) == len(urls)
    for i, url in enumerate(urls):
        m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in m[1]) if m else ""
        path = m[2] if m else ""
        fits = [(len(h + p), h + p, v) for v, h, p in url_filter.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
        best = max(fits, default=(0, None, None))
        assert (rows[i].host, rows[i].path, rows[i].rule) == (host, path, best[1])
        assert rows[i].verdict == (best[2] or ("block" if rows[i].score >= url_filter.BLOCK_FROM or not host + path else "allow"))
    assert rows[8].verdict == "block" and rows[14].verdict == "allow" and rows[3].rule == "example.net/en/"
    assert url_filter.judged(pages.limit(0), url_filter.Model(0.0, {})).collect() == []


def test_url_filter_learns_its_table(spark):
    frame = spark.createDataFrame([(h, p, y) for h, p, y in url_filter.LABELLED], "h string, p string, y int")
    from pyspark.sql import functions as F

    scored = frame.select("y", url_filter.block_score(F.col("h"), F.col("p"), url_filter.fit(spark)).alias("s")).collect()
    assert sum((r.s >= 0.5) == bool(r.y) for r in scored) >= 0.95 * len(scored)


def test_token_counts(spark, messy, empty, texts, sp):
    cache = fresh_path(spark, "test-token-cache")
    expected = bag((i, len((t or "").encode()), len(sp.encode(t or ""))) for i, t in texts)
    assert bag(token_counts.token_counts(messy, model_bytes(), cache).collect()) == expected
    stored = token_counts.read_cache(spark, cache).count()
    assert stored == len({t or "" for _, t in texts})
    assert bag(token_counts.token_counts(messy, model_bytes(), cache).collect()) == expected
    assert token_counts.read_cache(spark, cache).count() == stored  # nothing was encoded twice
    assert token_counts.token_counts(empty, model_bytes(), fresh_path(spark, "test-token-cache")).collect() == []


def test_token_counts_append_only_misses(spark, sp):
    cache = fresh_path(spark, "test-token-cache")
    first = spark.createDataFrame([(1, "aa bb"), (2, "cc")], "doc_id long, text string")
    second = spark.createDataFrame([(7, "cc"), (8, "dd ee ff")], "doc_id long, text string")
    token_counts.token_counts(first, model_bytes(), cache).collect()
    got = bag((r.doc_id, r.n_tokens) for r in token_counts.token_counts(second, model_bytes(), cache).collect())
    assert got == bag([(7, len(sp.encode("cc"))), (8, len(sp.encode("dd ee ff")))])
    assert token_counts.read_cache(spark, cache).count() == 3


def test_simhash(messy, empty, texts):
    rows = simhash.near_duplicates(messy).collect()
    prints = [(i, brute.simhash(t)) for i, t in texts]
    expected = Counter((i, f, c) for (i, f), c in zip(prints, brute.component_ids(prints), strict=True))
    assert Counter((r.doc_id, r.fp % 2**64, r.component_id) for r in rows) == expected
    assert simhash.near_duplicates(empty).collect() == []


def test_simhash_links_at_two_bits(spark):
    import random

    draw = random.Random(3)
    prints = {draw.getrandbits(64) for _ in range(40)}
    for base in list(prints)[:20]:
        for bits in ([5], [1, 2], [1, 40], [33, 63], [0, 31, 32], [0, 1, 2, 3]):
            prints.add(base ^ sum(1 << b for b in bits))
    signed = [p - 2**64 if p >= 2**63 else p for p in prints]
    edges = simhash.links(spark.createDataFrame([(p,) for p in signed], "fp long")).collect()
    assert all(((r.a ^ r.b) % 2**64).bit_count() <= 2 for r in edges)
    from lendscope.llm.components import components

    found = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    expected = brute.component_ids([(p, p % 2**64) for p in signed])
    assert [found.get(p, p) for p in signed] == expected


def test_one_of_each_near_copy(messy, texts):
    out = simhash.one_of_each(messy)
    assert out.columns == messy.columns
    prints = [(i, brute.simhash(t)) for i, t in texts]
    members = defaultdict(list)
    for print_, least, group in zip(prints, brute.component_ids(prints), brute.groups(prints), strict=True):
        if print_[0] == least:
            members[group].append(print_)
    rows = [(r.doc_id, brute.simhash(r.text)) for r in out.collect()]
    assert len(rows) == len(members) and all(sum(r in own for r in rows) == 1 for own in members.values())


def test_components_of_a_long_chain(spark):
    from lendscope.llm.components import components

    edges = [(i, i + 1) for i in range(200)] + [(1000, 1001), (1001, 1000), (5, 5), (None, 3)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**dict.fromkeys(range(201), 0), 1000: 1000, 1001: 1000}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_exact_dedup(messy, empty, texts):
    body = [(i, re.sub(r"[\x20\x09-\x0D]+", " ", t or "")) for i, t in texts]
    size = Counter(b for _, b in body)
    least = {b: min((i for i, x in body if x == b and i is not None), default=None) for b in size}
    expected = bag((i, least[b], size[b], i == least[b], brute.sha(b)) for i, b in body)
    rows = exact_dedup.exact_duplicates(messy)
    assert rows.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"] and bag(rows.collect()) == expected
    assert exact_dedup.exact_duplicates(empty).collect() == []


def test_exact_dedup_joins_each_row_once(spark):
    """400 rows without an id in 200 groups, compared as 400 texts."""
    frame = spark.createDataFrame([(None, f"text of group {k // 2}") for k in range(400)], "doc_id long, text string")
    rows = exact_dedup.exact_duplicates(frame).collect()
    assert len(rows) == 400 and {r.group_size for r in rows} == {2}
    keyed = frame.withColumn("text_sha256", exact_dedup.sha256(frame["text"]))
    prints = keyed.selectExpr("doc_id", "text_sha256", "xxhash64(text) AS f1", "0L AS f2", "length(text) AS n_bytes")
    assert exact_dedup._members(keyed, prints, prints.select(*exact_dedup.KEY).distinct()).count() == 400


def test_exact_dedup_of_colliding_fingerprints(spark, texts, messy, monkeypatch):
    import numpy as np

    expected = bag(exact_dedup.exact_duplicates(messy).collect())
    monkeypatch.setattr(exact_dedup, "fingerprints", lambda data, offsets: np.zeros((len(offsets) - 1, 2), dtype=np.int64))
    assert bag(exact_dedup.exact_duplicates(messy).collect()) == expected


def test_fingerprints_combine():
    import numpy as np

    data = np.frombuffer(bytes(range(256)) * 8, dtype=np.uint8)
    cut = 5 * exact_dedup.CHUNK_BYTES
    of = lambda part: exact_dedup.fingerprints(part, np.array([0, len(part)]))[0]
    whole, left, right = of(data), of(data[:cut]), of(data[cut:])
    chunks = len(data[cut:]) // exact_dedup.CHUNK_BYTES
    for k, (base, prime) in enumerate(zip(exact_dedup.BASES, exact_dedup.PRIMES, strict=True)):
        assert whole[k] == exact_dedup.combine(int(left[k]), int(right[k]), chunks, base, prime)
