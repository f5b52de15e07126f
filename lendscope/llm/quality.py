"""Operator 1: quality by random Fourier features, ridge scores and isotonic calibration."""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendscope.llm.common import fold
from lendscope.sources.workspace import stored

#: Random features, the kernel's width in standard deviations, and the ridge.
FEATURES, WIDTH, RIDGE, SEED = 256, 3.0, 1.0, 20240229
#: The fold of the labelled rows that calibrates; the others but the held-out one are for the ridge.
CALIBRATION_FOLD = 1
#: Groups of tasks whose sums are added first.
LANES = 64
#: Bins of raw scores that the calibration sees; their number bounds what goes to the driver.
BINS = 2000

_KINDS = np.zeros(256, dtype=np.uint8)
_KINDS[[*range(97, 123)]] = 1
_KINDS[[*range(65, 91)]] = 2
_KINDS[[*range(48, 58)]] = 3
_KINDS[[ord(c) for c in " \t\n\r\v\f"]] = 4
_KINDS[[ord(c) for c in ".,;:'\"()-"]] = 5
_KINDS[[ord(c) for c in "!?"]] = 6
_KINDS[[ord(c) for c in "#$%&*+/<=>@[\\]^_`{|}~"]] = 7
_KINDS[128:] = 8

STATISTICS = (
    "log_bytes", "log_words", "word_bytes", "upper", "digits", "spaces", "points", "shouts", "symbols", "wide",
    "distinct_words", "top_word", "distinct_runs", "distinct_lines", "log_line", "ends_odd", "all_caps",
)


def statistics(text: str | None) -> list[float]:
    """Numbers about the whole text; all 0 for an empty one."""
    data = (text or "").encode("utf-8", "surrogatepass")
    words = data.split()
    if not words:
        return [0.0] * len(STATISTICS)
    kinds = np.bincount(_KINDS[np.frombuffer(data, dtype=np.uint8)], minlength=9)
    n, letters = len(words), max(1, int(kinds[1] + kinds[2] + kinds[8]))
    share = kinds / len(data)
    counted = Counter(words)
    runs = max(1, n - 2)
    distinct_runs = len(set(zip(words, words[1:], words[2:], strict=False))) / runs if n > 2 else 1.0
    lines = [x for x in data.split(b"\n") if x]
    odd = sum(w[-1] in b"!?#$%&*+/<=>@[\\]^_`{|}~" for w in words) / n
    caps = sum(w.isupper() and len(w) > 1 for w in words) / n
    return [
        float(np.log1p(len(data))), float(np.log1p(n)), sum(map(len, words)) / n, float(kinds[2]) / letters, float(share[3]), float(share[4]),
        float(share[5]), float(share[6]), float(share[7]), float(share[8]), len(counted) / n, max(counted.values()) / n, distinct_runs,
        len(set(lines)) / max(1, len(lines)), float(np.log1p(len(data) / max(1, len(lines)))), odd, caps,
    ]


def _statistics(text: Column) -> Column:
    @F.arrow_udf("array<double>")
    def measure(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in texts:
            yield pa.array([statistics(t.as_py()) for t in batch], pa.list_(pa.float64()))

    return measure(text)


def measured(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, x): the statistics of every whole text."""
    return docs.select(F.col(id_col).alias("doc_id"), _statistics(F.col(text_col).cast("string")).alias("x"))


@dataclass
class Fourier:
    """Random cosines whose products approximate a Gaussian kernel of standardised statistics."""

    mean: np.ndarray
    scale: np.ndarray

    def features(self, x: np.ndarray) -> np.ndarray:
        draw = np.random.default_rng(SEED)
        directions = draw.normal(size=(len(STATISTICS), FEATURES)) / WIDTH
        phases = draw.uniform(0, 2 * np.pi, FEATURES)
        standard = np.clip((x - self.mean) / self.scale, -6, 6)
        return np.hstack([np.sqrt(2 / FEATURES) * np.cos(standard @ directions + phases), np.ones((len(x), 1))])


@dataclass
class Model:
    """Ridge weights over Fourier features; ``steps``: raw scores and the calibrated ones, both rising."""

    fourier: Fourier
    weights: np.ndarray
    steps: tuple[np.ndarray, np.ndarray]

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.fourier.features(x) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        return np.interp(self.raw(x), *self.steps)


def _matrix(column: pa.Array) -> np.ndarray:
    return np.asarray(column.flatten().to_numpy(zero_copy_only=False)).reshape(len(column), len(STATISTICS))


def _sums(fourier: Fourier) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A partition's part of the normal equations, a row per feature."""

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((FEATURES + 1, FEATURES + 2))
        for batch in batches:
            for at in range(0, len(batch), 4096):
                part = batch.slice(at, 4096)
                z = fourier.features(_matrix(part.column("x")))
                y = part.column("y").to_numpy(zero_copy_only=False).astype(float)
                total += z.T @ np.hstack([z, y[:, None]])
        lane = pa.array([TaskContext.get().partitionId() % LANES] * len(total), pa.int32())
        columns = [pa.array(range(len(total)), pa.int32()), lane, pa.array(list(total), pa.list_(pa.float64()))]
        yield pa.RecordBatch.from_arrays(columns, names=["i", "lane", "row"])

    return summed


def _added(group: pd.DataFrame) -> pd.DataFrame:
    first = group[["i", "lane"]].iloc[:1].reset_index(drop=True)
    return first.assign(row=[np.sum(np.vstack(group["row"].to_numpy()), axis=0)])


def normal_equations(rows: DataFrame, fourier: Fourier) -> np.ndarray:
    """Z'Z and Z'y, summed within tasks, then lanes of tasks, then over all; the
    result's size does not depend on the data."""
    schema = "i int, lane int, row array<double>"
    parts = rows.mapInArrow(_sums(fourier), schema)
    for keys in (["i", "lane"], ["i"]):
        parts = parts.groupBy(*keys).applyInPandas(_added, schema)
    out = np.zeros((FEATURES + 1, FEATURES + 2))
    for row in parts.collect():
        out[row.i] = row.row
    return out


def isotonic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators: points (x, calibrated y), both rising; x must rise."""
    blocks: list[list[float]] = []  # sum of y, weight, first x, last x
    for xi, yi, wi in zip(x, y * weight, weight, strict=True):
        blocks.append([yi, wi, xi, xi])
        while len(blocks) > 1 and blocks[-2][0] / blocks[-2][1] >= blocks[-1][0] / blocks[-1][1]:
            last = blocks.pop()
            blocks[-1] = [blocks[-1][0] + last[0], blocks[-1][1] + last[1], blocks[-1][2], last[3]]
    base = y @ weight / weight.sum()
    value = [(b[0] + base) / (b[1] + 1) for b in blocks]  # a block leans on the mean by one row
    value = np.maximum.accumulate(value)
    return np.array([e for b in blocks for e in b[2:]]), np.repeat(value, 2)


def fit(stats: DataFrame, labels: DataFrame, label: str = "quality") -> Model:
    """Ridge on all labelled rows outside the held-out fold, but for the fold that calibrates it.

    ``stats`` is (doc_id, x). Rows with a NULL id or label are left out; without
    labelled rows every score is 0.5.
    """
    own = labels.select("doc_id", F.col(label).cast("int").alias("y")).filter("doc_id is not null and y in (0, 1)")
    own = own.groupBy("doc_id").agg(F.max("y").alias("y")).withColumn("part", fold(F.col("doc_id"))).filter("part <> 0")
    rows = stored(stats.join(own, "doc_id").select("x", "y", "part"), "quality-rows")
    train = rows.filter(F.col("part") != CALIBRATION_FOLD)
    value = [F.col("x")[i] for i in range(len(STATISTICS))]
    moments = train.agg(F.count("*").alias("n"), F.array(*[F.avg(v) for v in value]).alias("mean"), F.array(*[F.stddev_pop(v) for v in value]).alias("scale")).first()
    if not moments.n:
        flat = Fourier(np.zeros(len(STATISTICS)), np.ones(len(STATISTICS)))
        return Model(flat, np.zeros(FEATURES + 1), (np.array([0.0, 1.0]), np.array([0.5, 0.5])))
    fourier = Fourier(np.array(moments.mean), np.maximum(np.array(moments.scale), 1e-6))
    sums = normal_equations(train, fourier)
    ridge = np.full(FEATURES + 1, RIDGE)
    ridge[-1] = 1e-6
    weights = np.linalg.solve(sums[:, :-1] + np.diag(ridge), sums[:, -1])
    model = Model(fourier, weights, (np.array([0.0, 1.0]), np.array([0.0, 1.0])))
    held = rows.filter(F.col("part") == CALIBRATION_FOLD) if rows.filter(F.col("part") == CALIBRATION_FOLD).head(1) else train
    bins = F.floor(F.greatest(F.lit(-0.5), F.least(F.lit(1.5), _applied(F.col("x"), model.raw))) * BINS / 2).cast("int")
    counted = held.select(bins.alias("bin"), "y").groupBy("bin").agg(F.avg("y").alias("y"), F.count("*").alias("n")).orderBy("bin").collect()
    at = np.array([(r.bin + 0.5) * 2 / BINS for r in counted])
    model.steps = isotonic(at, np.array([r.y for r in counted]), np.array([r.n for r in counted], dtype=float))
    return model


def _applied(x: Column, function: Callable[[np.ndarray], np.ndarray]) -> Column:
    @F.pandas_udf("double")
    def apply(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series(function(np.vstack(batch.to_numpy())) if len(batch) else np.zeros(0))

    return apply(x)


def score(x: Column, model: Model) -> Column:
    """Column of calibrated scores between 0 and 1 for a column of statistics."""
    return _applied(x, model.score)


def quality_scores(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label: str = "quality") -> DataFrame:
    """One row per row of ``docs``: doc_id, score; higher means that label 1 is likelier.

    NULL and empty texts have all statistics 0 and are scored by them. Repeated
    rows come out as they came in (a repeated labelled id trains as often); other
    columns are not read. The statistics are written once, for the fit and the
    scores.
    """
    stats = stored(measured(docs, id_col, text_col), "quality-statistics")
    model = fit(stats, labels, label)
    return stats.select("doc_id", score(F.col("x"), model).alias("score"))
