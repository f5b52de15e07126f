"""Operator 6: benchmark passages, found by a generalised suffix automaton over words."""

from __future__ import annotations

import re
from array import array
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lendscope.llm.common import packed, unpacked, whole
from lendscope.sources.workspace import stored

#: Words of a window.
WINDOW = 10
#: Characters of test items that one automaton holds; more items make more automata.
BLOCK_CHARS = 16_000_000

WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
#: UTF-8 bytes: A-Z become a-z, other ASCII but digits and a-z becomes a space.
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(_FOLD).split()


class SuffixAutomaton:
    """All runs of words of the test items, in flat arrays over word numbers.

    A state stands for runs that end at the same places; ``length`` is its
    longest run and ``link`` the state of the next shorter ones. Nearly all states
    have one edge, which lies in ``word`` and ``target``; further ones lie in ``more``.
    """

    def __init__(self, items: dict[str, list[bytes]], window: int) -> None:
        self.window, self.numbers = window, {}
        self.word, self.target = array("i", [-1]), array("i", [0])
        self.more: dict[int, dict[int, int]] = {}
        self.link, self.length = array("i", [-1]), array("i", [0])
        self.names = list(items)
        ends: list[tuple[int, int]] = []  # the state after the last word of each item that is shorter than a window
        starts, after = array("q"), array("i")  # for each item its first place in ``after``, the states after its words
        for k, words in enumerate(items.values()):
            starts.append(len(after))
            state = 0
            for word in words:
                state = self._extend(state, self.numbers.setdefault(word, len(self.numbers)))
                after.append(state)
            if 0 < len(words) < window:
                ends.append((state, k))
        self._mark(starts, after, ends)

    def _get(self, state: int, word: int) -> int:
        if self.word[state] == word:
            return self.target[state]
        return self.more[state].get(word, 0) if state in self.more else 0

    def _set(self, state: int, word: int, target: int) -> None:
        if self.word[state] in (-1, word):
            self.word[state], self.target[state] = word, target
        else:
            self.more.setdefault(state, {})[word] = target

    def _add(self, length: int, link: int, like: int | None = None) -> int:
        state = len(self.link)
        self.word.append(-1 if like is None else self.word[like])
        self.target.append(0 if like is None else self.target[like])
        if like in self.more:
            self.more[state] = dict(self.more[like])
        self.length.append(length)
        self.link.append(link)
        return state

    def _split(self, state: int, word: int, target: int) -> int:
        """A copy of ``target`` for the shorter runs that reach it from ``state``."""
        copy = self._add(self.length[state] + 1, self.link[target], target)
        self.link[target] = copy
        while state >= 0 and self._get(state, word) == target:
            self._set(state, word, copy)
            state = self.link[state]
        return copy

    def _extend(self, last: int, word: int) -> int:
        known = self._get(last, word)
        if known:
            return known if self.length[known] == self.length[last] + 1 else self._split(last, word, known)
        state = self._add(self.length[last] + 1, 0)
        while last >= 0 and not self._get(last, word):
            self._set(last, word, state)
            last = self.link[last]
        if last >= 0:
            target = self._get(last, word)
            self.link[state] = target if self.length[target] == self.length[last] + 1 else self._split(last, word, target)
        return state

    def _mark(self, starts: array, after: array, ends: list[tuple[int, int]]) -> None:
        """``of_window``: state -> the state of its last ``window`` words; ``holders``: the items of each
        such state; ``short_at``: state -> its longest run that is a whole short item."""
        length, link = np.array(self.length), np.array(self.link)
        self.of_window, self.short_at = array("i", bytes(4 * len(length))), array("i", bytes(4 * len(length)))
        self.short: dict[int, list[tuple[int, int]]] = {}
        for state, item in ends:
            self.short.setdefault(state, []).append((self.length[state], item))
        for state in np.argsort(length, kind="stable")[1:].tolist():
            up = self.link[state]
            if self.length[state] >= self.window:
                self.of_window[state] = state if self.length[up] < self.window else self.of_window[up]
            self.short_at[state] = state if state in self.short else self.short_at[up]
        places = np.array(self.of_window)[np.array(after, np.int64)] if len(after) else np.zeros(0, np.int64)
        item = np.repeat(np.arange(len(starts)), np.diff(np.append(np.array(starts, np.int64), len(after))))
        pairs = np.unique(np.stack((places, item), axis=1)[places > 0], axis=0)
        self.holders = (pairs[:, 0].astype(np.int32), pairs[:, 1].astype(np.int32))

    def packed(self) -> dict:
        """Everything a task needs, as bytes: about 45 for a word of the items, at most some 64."""
        more = np.array(sorted((s << 32) | w for s, edges in self.more.items() for w in edges), np.int64)
        to = np.array([self.more[k >> 32][k & 0xFFFFFFFF] for k in more.tolist()], np.int32)
        flat = {"word": self.word, "target": self.target, "link": self.link, "length": self.length, "of_window": self.of_window, "short_at": self.short_at}
        out = {name: values.tobytes() for name, values in flat.items()}
        out |= {"more": more.tobytes(), "to": to.tobytes(), "held_by": self.holders[0].tobytes(), "holder": self.holders[1].tobytes()}
        return {**out, "words": b" ".join(self.numbers), "names": self.names, "short": self.short, "window": self.window}


class Matcher:
    """A packed automaton, read in place."""

    def __init__(self, packed: dict) -> None:
        for name in ("word", "target", "link", "length", "of_window", "short_at", "to", "held_by", "holder"):
            setattr(self, name, memoryview(packed[name]).cast("i"))
        self.more = memoryview(packed["more"]).cast("q")
        self.numbers = {w: k for k, w in enumerate(packed["words"].split())}
        self.names, self.short, self.window = packed["names"], packed["short"], packed["window"]
        # the edges of the empty run are looked up most
        self.root = array("i", bytes(4 * len(self.numbers)))
        if len(self.numbers):
            self.root[self.word[0]] = self.target[0]
        for k in range(bisect_left(self.more, 1 << 32)):
            self.root[self.more[k] & 0xFFFFFFFF] = self.to[k]

    def _branch(self, state: int, word: int) -> int:
        key = (state << 32) | word
        k = bisect_left(self.more, key)
        return self.to[k] if k < len(self.more) and self.more[k] == key else 0

    def find(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Merged spans (first word, after the last) of the words inside an occurrence, and the items found."""
        first, target, link, length, root = self.word, self.target, self.link, self.length, self.root
        of_window, short_at, window, branch = self.of_window, self.short_at, self.window, self._branch
        state = run = 0
        spans: list[list[int]] = []
        states: set[int] = set()
        found: set[int] = set()
        for i, number in enumerate(map(self.numbers.get, words)):
            if number is None:
                state = run = 0
                continue
            while state:
                following = target[state] if first[state] == number else branch(state, number)
                if following:
                    break
                state = link[state]
                run = length[state]
            if not state:
                following, run = root[number], 0
            state = following
            run += 1
            reach = 0
            if run >= window:
                reach = window
                states.add(of_window[state])
            short = short_at[state]
            while short:
                for size, item in self.short[short]:
                    if size <= run:
                        reach = max(reach, size)
                        found.add(item)
                short = short_at[link[short]]
            if reach:
                start = i + 1 - reach
                while spans and spans[-1][0] >= start:
                    spans.pop()
                if spans and start <= spans[-1][1]:
                    spans[-1][1] = i + 1
                else:
                    spans.append([start, i + 1])
        for state in states:
            found.update(self.holder[bisect_left(self.held_by, state) : bisect_right(self.held_by, state)])
        return [(a, b) for a, b in spans], {self.names[k] for k in found}


def automata(items: DataFrame, id_col: str, text_col: str, window: int) -> Iterator[SuffixAutomaton]:
    """One automaton per block of items; a block is bounded by ``BLOCK_CHARS``, so is what goes to the driver and,
    packed, to the executors."""
    held = items.select(F.col(id_col).cast("string").alias("item"), whole(F.col(text_col)).alias("text")).filter("text <> ''")
    held = held.groupBy("item", "text").count()
    total = held.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = 2 * total // BLOCK_CHARS + 1
    for block in range(blocks):
        rows = held.filter(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == block).collect()
        yield SuffixAutomaton({f"{row.item or ''}\0{k}": words_of(row.text) for k, row in enumerate(sorted(rows, key=lambda r: (r.item or "", r.text)))}, window)


SPANS = "array<struct<first:int,after:int>>"
MATCH = f"n_words long, spans {SPANS}, items array<string>, clean string"
_MATCH = pa.struct(
    [
        ("n_words", pa.int64()),
        ("spans", pa.list_(pa.struct([("first", pa.int32()), ("after", pa.int32())]))),
        ("items", pa.list_(pa.string())),
        ("clean", pa.string()),
    ]
)


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans in order, overlapping and touching ones as one."""
    out: list[tuple[int, int]] = []
    for first, after in sorted(spans):
        if out and first <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], after))
        else:
            out.append((first, after))
    return out


def without(text: str, spans: list[tuple[int, int]]) -> str:
    """The text without its spans, from the first to the last character of their words."""
    places = [m.span() for m in WORD.finditer(text)]
    kept, at = [], 0
    for first, after in spans:
        kept.append(text[at : places[first][0]])
        at = places[after - 1][1]
    return "".join([*kept, text[at:]])


def _matcher(spark: SparkSession, machine: SuffixAutomaton, text: Column, before: Column) -> Column:
    """What ``machine`` finds, together with what was found before."""
    packed = spark.sparkContext.broadcast(machine.packed())

    @F.arrow_udf(MATCH)
    def match(texts: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        machine = Matcher(packed.value)
        for batch, earlier in texts:
            rows = []
            for value, known in zip(batch, earlier, strict=True):
                value, known = value.as_py(), known.as_py()
                words = words_of(value)
                spans, found = machine.find(words)
                found = {x.rpartition("\0")[0] for x in found}
                if known:
                    spans = merged([*spans, *((s["first"], s["after"]) for s in known["spans"])])
                    found |= set(known["items"])
                clean = without(value, spans) if spans else None
                rows.append({"n_words": len(words), "spans": [{"first": a, "after": b} for a, b in spans], "items": sorted(found), "clean": clean})
            yield pa.array(rows, _MATCH)

    # else a filter on what was found would run the automaton a second time
    return match.asNondeterministic()(text, before)


def _matched(docs: DataFrame, items: DataFrame, text_col: str, item_id: str, item_text: str, window: int) -> DataFrame:
    """Packed rows with ``_match``. One pass over the documents per automaton;
    between passes the rows are written, so that a task runs one Python worker."""
    found = packed(docs, text_col).withColumn("_match", F.lit(None).cast(f"struct<{MATCH}>"))
    for k, machine in enumerate(automata(items, item_id, item_text, window)):
        found = found if k == 0 else stored(found, "benchmark-matches")
        found = found.withColumn("_match", _matcher(docs.sparkSession, machine, F.col("_0").cast("string"), F.col("_match")))
    return found


def matches(docs: DataFrame, items: DataFrame, text_col: str = "text", item_id: str = "item_id", item_text: str = "text", window: int = WINDOW) -> DataFrame:
    """``docs`` with n_words, spans and items.

    Words are runs of letters, digits and non-ASCII characters, A-Z lower-cased.
    A document word is in a span if it lies inside an occurrence of ``window``
    consecutive words of an item, or of a whole item of fewer words. items: the
    sorted ids, as strings, of the items with an occurrence (an id given to
    several texts counts once, a NULL id as the empty string). A NULL or empty
    document has no words and no spans; items without words match nothing, and no
    items at all match nothing. Rows keep their number and all other columns;
    columns named n_words, spans or items are replaced.
    """
    found = _matched(docs, items, text_col, item_id, item_text, window)
    part = {c: F.col("_match")[c] for c in ("n_words", "spans", "items")}
    return found.select(*unpacked(docs.columns, **{text_col: F.col("_0")}, **part))


def hit_words(spans: Column) -> Column:
    return F.aggregate(spans, F.lit(0).cast("long"), lambda n, s: n + (s["after"] - s["first"]))


def decontaminated(docs: DataFrame, items: DataFrame, text_col: str = "text", max_words: int = 0, max_coverage: float = 0.5, window: int = WINDOW) -> DataFrame:
    """``docs`` without benchmark passages; columns as they were.

    A document with more than ``max_words`` hit words loses its spans, from the
    first to the last character of their words; one of whose words more than
    ``max_coverage`` are hit goes as a whole. All others stay untouched.
    """
    found = _matched(docs, items, text_col, "item_id", "text", window).withColumn("_hit", hit_words(F.col("_match")["spans"]))
    kept = found.filter(F.col("_hit") <= max_coverage * F.col("_match")["n_words"])
    cut = F.when(F.col("_hit") > max_words, F.col("_match")["clean"]).otherwise(F.col("_0"))
    return kept.select(*unpacked(docs.columns, **{text_col: cut}))
