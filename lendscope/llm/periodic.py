"""Operator 13: periodic runs of words, by block convolution.

A run of period q makes some block of its words occur again q words later. At every
dyadic scale B the aligned blocks of B words are searched for in the window behind
them: the sums of squared differences for all distances at once are a convolution,
computed by a number-theoretic transform in exact integers. Distances without a
mismatch are extended to both sides.

Every run is met: one of period q in [2B, 4B) has q words or more that recur q
words later, and so holds an aligned block of B of them. The smallest scale, of two
words, takes the periods 1 to 7, whose runs of twelve words hold such a block as well.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendscope.llm.common import packed, unpacked, whole

#: A run has at least this many words, and at least two periods.
LEAST_WORDS, LEAST_PERIODS = 12, 2
WORD = re.compile(r"[^\x20\x09-\x0D]+")
SMALLEST_BLOCK = 2

#: 15 * 2**27 + 1, with 31 as a primitive root; products of two residues fit 64 bits.
PRIME, ROOT = 2013265921, 31
#: Numbers transformed at once, unless a single block needs more.
SLICE = 1 << 16
#: Characters of texts whose results are held together.
HELD_CHARS = 2_000_000

RUN = "array<struct<start:long,length:long,period:long>>"


def _powers(base: int, count: int) -> np.ndarray:
    """base**0, base**1, ... modulo the prime."""
    out = np.ones(count, np.uint64)
    done = 1
    while done < count:
        step = min(done, count - done)
        out[done : done + step] = out[:step] * np.uint64(pow(base, done, PRIME)) % PRIME
        done += step
    return out


_TWIDDLES: dict[tuple[int, bool], np.ndarray] = {}


def _twiddles(size: int, inverse: bool) -> np.ndarray:
    if (size, inverse) not in _TWIDDLES:
        root = pow(ROOT, (PRIME - 1) // size, PRIME)
        _TWIDDLES[size, inverse] = _powers(pow(root, PRIME - 2, PRIME) if inverse else root, size // 2)
    return _TWIDDLES[size, inverse]


def _forward(rows: np.ndarray) -> np.ndarray:
    """Transform of each row, in bit-reversed order (decimation in frequency)."""
    count, size = rows.shape
    half = size // 2
    while half:
        parts = rows.reshape(count, -1, 2, half)
        low, high = parts[:, :, 0], parts[:, :, 1]
        turned = (low + (PRIME - high)) % PRIME * _twiddles(2 * half, False) % PRIME
        rows = np.stack(((low + high) % PRIME, turned), axis=2).reshape(count, size)
        half //= 2
    return rows


def _backward(rows: np.ndarray) -> np.ndarray:
    """Inverse of ``_forward`` (decimation in time, from bit-reversed order)."""
    count, size = rows.shape
    half = 1
    while half < size:
        parts = rows.reshape(count, -1, 2, half)
        low, high = parts[:, :, 0], parts[:, :, 1] * _twiddles(2 * half, True) % PRIME
        rows = np.stack(((low + high) % PRIME, (low + (PRIME - high)) % PRIME), axis=2).reshape(count, size)
        half *= 2
    return rows * np.uint64(pow(size, PRIME - 2, PRIME)) % PRIME


def mismatches(blocks: np.ndarray, windows: np.ndarray) -> np.ndarray:
    """For each block and each place in its window the sum of squared differences, modulo the prime.

    ``blocks`` is (count, B) and ``windows`` (count, W), residues; the result has W - B + 1 columns.
    """
    count, b = blocks.shape
    w = windows.shape[1]
    size = 1 << (w - 1).bit_length()
    one, two = np.zeros((count, size), np.uint64), np.zeros((count, size), np.uint64)
    one[:, :b], two[:, :w] = blocks[:, ::-1], windows
    cross = _backward(_forward(one) * _forward(two) % PRIME)[:, b - 1 : w]
    squares = np.zeros((count, w + 1), np.uint64)
    np.cumsum(windows * windows % PRIME, axis=1, out=squares[:, 1:])
    moving = (squares[:, b:] - squares[:, : w - b + 1]) % PRIME
    own = (blocks * blocks % PRIME).sum(axis=1, dtype=np.uint64)[:, None] % PRIME
    return (own + moving + 2 * (PRIME - cross)) % PRIME


class _Found:
    """Runs found so far; says whether a stretch lies within one of a smaller period."""

    def __init__(self, n: int):
        self.runs: list[tuple[int, int, int]] = []
        self.far = [0] * (n + 1)

    def add(self, start: int, end: int, period: int) -> None:
        self.runs.append((start, end, period))
        k = start + 1
        while k < len(self.far):
            self.far[k] = max(self.far[k], end)
            k += k & -k

    def within(self, start: int, end: int) -> bool:
        k = start + 1
        while k:
            if self.far[k] >= end:
                return True
            k -= k & -k
        return False

    def reach(self, longest: int, starts: np.ndarray) -> np.ndarray:
        """For each start the furthest end of a run that begins there or before, of period ``longest`` or less."""
        own = sorted((s, e) for s, e, q in self.runs if q <= longest)
        if not own:
            return np.zeros(len(starts), np.int64)
        begins = np.array([s for s, _ in own])
        ends = np.maximum.accumulate(np.array([e for _, e in own]))
        at = np.searchsorted(begins, starts, "right")
        return np.where(at > 0, ends[np.maximum(at, 1) - 1], 0)


def _hits(codes: np.ndarray, blocks: np.ndarray, b: int, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    """(start, distance) of blocks that occur again, without a mismatch modulo the prime, ``low`` to ``high`` - 1 words later."""
    n = len(codes)
    width = high - 1 - low + b
    padded = np.concatenate((codes, np.zeros(high + b, np.uint64)))  # 0 is no word
    at, far = [], []
    per_slice = max(1, SLICE // (1 << (width - 1).bit_length()))
    for k in range(0, len(blocks), per_slice):
        starts = blocks[k : k + per_slice]
        sums = mismatches(padded[starts[:, None] + np.arange(b)], padded[starts[:, None] + low + np.arange(width)])
        row, column = np.nonzero(sums == 0)
        fits = starts[row] + low + column + b <= n
        at.append(starts[row[fits]])
        far.append(column[fits] + low)
    return np.concatenate(at), np.concatenate(far)


def runs_of(words: list[str]) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run, by start, then period.

    A run is a stretch of words of smallest period q, of ``LEAST_WORDS`` and two
    periods at least, that cannot be extended to either side.
    """
    n = len(words)
    if n < LEAST_WORDS:
        return []
    known: dict[str, int] = {}
    codes = np.fromiter((known.setdefault(w, len(known) + 1) for w in words), np.int64, n)
    order = np.argsort(codes, kind="stable")
    again = np.flatnonzero(codes[order[1:]] == codes[order[:-1]])
    following = np.full(n, n, np.int64)  # distance to the next occurrence
    following[order[again]] = order[again + 1] - order[again]
    residues = codes.astype(np.uint64)
    found = _Found(n)
    b = SMALLEST_BLOCK
    while b == SMALLEST_BLOCK or 2 * b * LEAST_PERIODS <= n:
        low, high = (1 if b == SMALLEST_BLOCK else 2 * b), min(4 * b, n // LEAST_PERIODS + 1)
        # a block can only occur again if each of its words does
        near = following[: n - n % b].reshape(-1, b).max(axis=1) < high
        starts = np.flatnonzero(near) * b
        if len(starts):
            # within a run of a period up to b, all that is found has that period
            starts = starts[found.reach(b, starts) < np.minimum(starts + high - 1 + b, n)]
        if len(starts):
            at, far = _hits(residues, starts, b, low, high)
            open_ = found.reach(b, at) < at + far + b
            at, far = at[open_], far[open_]
            for q in np.unique(far).tolist():
                _extend(codes, at[far == q], b, q, found)
        b *= 2
    return sorted((s, e - s, q) for s, e, q in found.runs)


def _extend(codes: np.ndarray, at: np.ndarray, b: int, q: int, found: _Found) -> None:
    """Extend the blocks at ``at``, which seem to occur again q words later, as far as words do."""
    n = len(codes)
    apart = np.concatenate(([-1], np.flatnonzero(codes[:-q] != codes[q:]), [n - q]))
    right = np.searchsorted(apart, at)
    sure = apart[right] >= at + b  # a zero of the convolution may be a multiple of the prime
    right = np.unique(right[sure])
    starts, ends = apart[right - 1] + 1, apart[right] + q
    for s, e in zip(starts.tolist(), ends.tolist(), strict=True):
        if e - s >= max(LEAST_WORDS, LEAST_PERIODS * q) and not found.within(s, e):
            found.add(s, e, q)


def kept_words(words: list[str], runs: list[tuple[int, int, int]]) -> list[str]:
    """The words that no run contains after its first period."""
    if not runs:
        return words
    change = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    return [words[i] for i in np.flatnonzero(np.cumsum(change[:-1]) == 0).tolist()]


def _scan(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    run = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
    for texts in batches:
        parts, held, size = [], [], 0
        for k, text in enumerate(texts):
            words = WORD.findall(text.as_py())
            own = runs_of(words)
            collapsed = " ".join(kept_words(words, own))
            held.append((len(words), [{"start": s, "length": n, "period": q} for s, n, q in own], collapsed))
            size += len(collapsed)
            if size > HELD_CHARS or k == len(texts) - 1:
                sizes, runs, collapsed = zip(*held, strict=True)
                parts.append(pa.StructArray.from_arrays([pa.array(sizes, pa.int64()), pa.array(runs, run), pa.array(collapsed, pa.string())], names=["n_words", "runs", "collapsed"]))
                held, size = [], 0
        kind = pa.struct([("n_words", pa.int64()), ("runs", run), ("collapsed", pa.string())])
        yield pa.concat_arrays(parts) if parts else pa.array([], kind)


def periodic_runs(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with n_words, runs (start, length, period in words, by start, then period) and collapsed: the words,
    joined by one space, without those that repeat a run's first period.

    Columns of these names are replaced; all others pass through. Every row is read by
    itself, so repeated rows, NULL or shared ids and clashing names change nothing. A NULL or
    empty text has no words and no runs. A long text costs n log^2 n steps where all words recur,
    and about one pass where they do not; an empty table gives an empty one.
    """
    scan = F.arrow_udf(_scan, f"struct<n_words:long,runs:{RUN},collapsed:string>")
    rows = packed(docs)
    found = rows.withColumn("_found", scan(whole(F.col("_row").getField(text_col))))
    parts = {c: F.col("_found").getField(c) for c in ("n_words", "runs", "collapsed")}
    return found.select(*unpacked(docs.columns, **parts))
