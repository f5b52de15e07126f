"""The trained models against plain numpy and plain loops over the same rows."""

from __future__ import annotations

import math
import zlib

import duckdb
import numpy as np
import pytest

from lendscope.llm import quality, url_filter
from lendscope.llm.queries import QUERIES


def rising(y: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Isotonic regression by its min-max formula."""
    n = len(y)
    mean = [[np.dot(y[j : k + 1], w[j : k + 1]) / w[j : k + 1].sum() if k >= j else 0.0 for k in range(n)] for j in range(n)]
    return np.array([max(min(mean[j][k] for k in range(i, n)) for j in range(i + 1)) for i in range(n)])


def test_isotonic_steps_against_the_min_max_formula():
    draw = np.random.default_rng(3)
    for n in (1, 2, 7, 40):
        x, y, w = np.arange(n, dtype=float), draw.random(n).round(1), draw.integers(1, 9, n).astype(float)
        points, values = quality.isotonic(x, y, w)
        plain, base = rising(y, w), np.dot(y, w) / w.sum()
        wanted = np.empty(n)
        for level in np.unique(plain.round(12)):
            own = np.isclose(plain, level)
            wanted[own] = (np.dot(y[own], w[own]) + base) / (w[own].sum() + 1)
        assert np.interp(x, points, values) == pytest.approx(np.maximum.accumulate(wanted), abs=1e-9)


def test_quality_against_numpy(spark):
    """Features, normal equations, ridge and calibration once more, over all rows in one place."""
    sf_dir = "/root/testdata/sf0.01"
    docs = duckdb.sql(f"SELECT doc_id, text FROM '{sf_dir}/documents.parquet'").fetchall()
    labels = dict(duckdb.sql(f"SELECT doc_id, quality FROM '{sf_dir}/labels.parquet' WHERE quality IS NOT NULL").fetchall())
    x = {i: np.array(quality.statistics(t)) for i, t in docs}
    part = {i: zlib.crc32(str(i).encode()) % 5 for i in x}
    train = [i for i in x if i in labels and part[i] not in (0, quality.CALIBRATION_FOLD)]
    held = [i for i in x if i in labels and part[i] == quality.CALIBRATION_FOLD]
    design = np.array([x[i] for i in train])
    mean, scale = design.mean(axis=0), np.maximum(design.std(axis=0), 1e-6)
    draw = np.random.default_rng(quality.SEED)
    directions, phases = draw.normal(size=(design.shape[1], quality.FEATURES)) / quality.WIDTH, draw.uniform(0, 2 * np.pi, quality.FEATURES)

    def features(rows):
        z = np.sqrt(2 / quality.FEATURES) * np.cos(np.clip((np.array(rows) - mean) / scale, -6, 6) @ directions + phases)
        return np.hstack([z, np.ones((len(rows), 1))])

    z = features([x[i] for i in train])
    penalty = np.diag([quality.RIDGE] * quality.FEATURES + [1e-6])
    weights = np.linalg.solve(z.T @ z + penalty, z.T @ np.array([labels[i] for i in train], dtype=float))
    raw = {i: float(features([x[i]])[0] @ weights) for i in x}
    bins: dict[int, list[int]] = {}
    for i in held:
        bins.setdefault(math.floor(max(-0.5, min(1.5, raw[i])) * quality.BINS / 2), []).append(labels[i])
    at = np.array([(b + 0.5) * 2 / quality.BINS for b in sorted(bins)])
    y, w = np.array([np.mean(bins[b]) for b in sorted(bins)]), np.array([float(len(bins[b])) for b in sorted(bins)])
    plain, base = rising(y, w), np.dot(y, w) / w.sum()
    level = np.array([(np.dot(y[own], w[own]) + base) / (w[own].sum() + 1) for own in (np.isclose(plain, v) for v in plain)])
    edges = [(at[np.isclose(plain, v)].min(), at[np.isclose(plain, v)].max()) for v in plain]
    points = sorted({(e, lv) for (a, b), lv in zip(edges, np.maximum.accumulate(level), strict=True) for e in (a, b)})
    got = {r.doc_id: r.score for r in QUERIES["op1_quality"](spark, sf_dir).collect()}
    wanted = {i: float(np.interp(raw[i], [p for p, _ in points], [v for _, v in points])) for i in x}
    apart = [abs(got[i] - wanted[i]) for i in x]
    # a raw score on the edge of a calibration bin may fall to either side of it
    assert set(got) == set(wanted) and np.quantile(apart, 0.99) < 1e-6 and max(apart) < 0.05


def grams(host: str, path: str) -> list[int]:
    import xxhash

    out = []
    for mark, text in (("h", f"^{host}$"), ("p", f"{path}$")):
        seed = xxhash.xxh64_intdigest(mark.encode(), 42)
        for n in url_filter.GRAMS:
            for k in range(len(text) - n + 1):
                hashed = xxhash.xxh64_intdigest(text[k : k + n].encode(), seed)
                out.append((hashed - 2**64 if hashed >= 2**63 else hashed) % url_filter.BUCKETS)
    return out


def test_url_scores_against_a_plain_loop(spark, small):
    """Gradient descent over the labelled table, gram by gram, and the score of every page."""
    rows = []
    for host, path, y in url_filter.LABELLED:
        g = grams(host, path)
        x: dict[int, float] = {}
        for b in g:
            x[b] = x.get(b, 0.0) + 1 / math.sqrt(len(g))
        rows.append((x, y))
    positive = sum(y for _, y in rows)
    bias, weights = math.log(positive / (len(rows) - positive)), dict.fromkeys({b for x, _ in rows for b in x}, 0.0)
    for _ in range(url_filter.STEPS):
        gradient = dict.fromkeys(weights, 0.0)
        for x, y in rows:
            error = 1 / (1 + math.exp(-bias - sum(v * weights[b] for b, v in x.items()))) - y
            for b, v in x.items():
                gradient[b] += v * error
        weights = {b: w * (1 - url_filter.RATE * url_filter.RIDGE) - url_filter.RATE * gradient[b] for b, w in weights.items()}
    checked = 0
    for r in QUERIES["op7_url_filter"](spark, small).collect():
        g = grams(r.host, r.path)
        margin = bias + sum(weights.get(b, 0.0) for b in g) / math.sqrt(max(1, len(g)))
        assert r.score == pytest.approx(1 / (1 + math.exp(-margin)), abs=1e-9)
        wanted = "block" if r.score >= url_filter.BLOCK_FROM or not r.host + r.path else "allow"
        assert r.rule is not None or r.verdict == wanted
        checked += 1
    assert checked > 20
