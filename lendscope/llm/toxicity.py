"""Operator 5: toxicity by a weighted finite-state grammar over clauses.

A lexicon transducer turns words into tags with weights. Small machines follow
target, negation and reported speech through a clause; their product, composed
with the insult and threat machine, writes one scored match per insult or threat.
Insult stems and the weights of the kinds of matches are learned from labels.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendscope.llm.common import fold

# Closed word classes of the grammar (English, German, French, Spanish).
TARGETS = "you your yours yourself u he him she her they them their du dich dir ihr euch sie er tu toi te vous ils elles tú usted ustedes ellos ellas".split()
NEGATORS = "not no never nor neither isn't aren't don't doesn't nicht kein keine keinen nie niemals pas jamais aucun ni nunca jamás ningún ninguna".split()
REPORTERS = "said says saying quoted quote quotes reported reportedly alleged allegedly wrote writes called sagte sagt schrieb zitiert dit écrit cité dijo dice escribió citó".split()
# Threat verbs as stems with the endings of their language; Spanish forms may end in the target.
_FRENCH = "er|e|ez|ons|ent|ant|ai[st]?|aient|ions|iez|a|èrent|ée?s?|er(?:ai[st]?|as|a|ons|ez|ont|aient|ions|iez)"
_SPANISH = "ar(?:é|ás|á|emos|éis|án|ía[sn]?)?|o|as?|amos|áis|an|en|é|ó|aste|aron|aba[sn]?|ando|ándo|ad[oa]s?"
THREATS = re.compile(
    "(?:(?:kill|hurt|murder|destroy|stabb?|shoot|beat|burn)(?:s|ed|t|en|ing?)?|shot"
    "|(?:ge)?t(?:ö|oe)t(?:en?|es?t|eten?|etes?t|end)|umbring(?:en?|s?t|end)|umgebracht|umzubringen|umbrachten?|verletz(?:en?|s?t|ten?|tes?t|end)"
    f"|(?:tu|frapp|bless)(?:{_FRENCH})"
    f"|(?:(?:mat|golpe)(?:{_SPANISH})|h(?:er|ir)ir(?:é|ás|á|emos|éis|án|ía[sn]?)?|herir|hier(?:o|as?|an|es?|en)|her(?:imos|ís|í|iste|id[oa]s?)|hir(?:ió|ieron|iendo|iéndo))"
    "(?P<target>te|os|l[aeo]s?)?)"
)

#: Labelled rows that the fit may use; beyond it, those with the least hashes are taken.
MAX_LABELLED = 16_000
#: Letters of the shortest and the longest stem; whole words count at any length.
SHORTEST, LONGEST = 4, 9
#: Toxic documents that must hold a stem, and the odds that it must raise.
MIN_DOCS, MIN_LIFT = 3, 6.0
#: Stems that may pass for clear by chance, of all that are tested.
CHANCE_STEMS = 1.0
#: Pseudo-documents by which a stem leans on the next shorter one.
LEAN = 1.0
#: Most that one stem weighs, in log odds.
MOST = 6.0
#: Words whose weights a task remembers at once.
MEMO_WORDS = 100_000
#: Near copies among the labelled rows share this part of their runs of so many words.
RUN_WORDS, COPY_SHARE = 5, 0.8
#: Bands of min-hashes that find them: at that share, one copy in 500 has no band in common.
BANDS, BAND_HASHES = 12, 4
#: Words after a negator that it governs.
NEGATION_REACH = 3

#: What the machine writes where a target comes after threats: they count from there.
RELEASE = "release"

PLAIN, TARGETED, NEGATED, REPORTED, THREAT = KINDS = ("plain", "targeted", "negated", "reported", "threat")
OTHER, TARGET, NEGATOR, REPORTER, INSULT, MENACE = range(6)
TAGS = {**dict.fromkeys(TARGETS, TARGET), **dict.fromkeys(NEGATORS, NEGATOR), **dict.fromkeys(REPORTERS, REPORTER)}

WORD = re.compile(r"[^\W\d_]+(?:'[^\W\d_]+)?")
CLAUSE = re.compile(r"[^.!?;:\n]+")


@dataclass(frozen=True)
class Machine:
    """A finite-state machine over tags; ``step[state][tag]`` is the next state, 0 the first."""

    step: tuple[tuple[int, ...], ...]


def _latch(tag: int) -> Machine:
    """Remembers that ``tag`` has come."""
    return Machine((tuple(int(t == tag) for t in range(6)), (1,) * 6))


def _countdown(tag: int, reach: int) -> Machine:
    """Remembers ``tag`` for ``reach`` further words; the state is the number of words left."""
    return Machine(tuple(tuple(reach if t == tag else max(0, left - 1) for t in range(6)) for left in range(reach + 1)))


def _pending() -> Machine:
    """Remembers that a threat waits for its target."""
    return Machine((tuple(int(t == MENACE) for t in range(6)), tuple(int(t != TARGET) for t in range(6))))


def compose() -> tuple[list[list[int]], list[list[str | None]], list[bool]]:
    """Next states and outputs of the product of the machines, and whether a state holds a target.

    The output of an insult or threat depends on what the other machines hold
    when it comes. That of a threat counts once the clause has a target, before or
    after it: a target that finds threats waiting writes ``RELEASE``.
    """
    machines = (_latch(TARGET), _countdown(NEGATOR, NEGATION_REACH), _latch(REPORTER), _pending())
    states: dict[tuple[int, ...], int] = {(0, 0, 0, 0): 0}
    steps, outs = [], []
    queue = [(0, 0, 0, 0)]
    for state in queue:
        target, negated, reported, waiting = state
        row, out = [], []
        for tag in range(6):
            after = tuple(m.step[s][tag] for m, s in zip(machines, state, strict=True))
            if after not in states:
                states[after] = len(states)
                queue.append(after)
            row.append(states[after])
            kind = None
            if tag == TARGET and waiting and not target:
                kind = RELEASE
            elif tag in (INSULT, MENACE):
                kind = NEGATED if negated else REPORTED if reported else THREAT if tag == MENACE else TARGETED if target else PLAIN
            out.append(kind)
        steps.append(row)
        outs.append(out)
    return steps, outs, [bool(s[0]) for s in queue]


def tags_of(word: str) -> tuple[int, ...]:
    """What the grammar reads in a word: one class, or a threat and its target."""
    if word in TAGS:
        return (TAGS[word],)
    threat = THREATS.fullmatch(word)
    return (OTHER,) if not threat else (MENACE, TARGET) if threat["target"] else (MENACE,)


def words_of(text: str) -> list[str]:
    return WORD.findall(text.lower())


def stems_of(word: str) -> list[str]:
    """The beginnings of a word, and the whole word with an end mark."""
    return [word[:k] for k in range(SHORTEST, min(LONGEST, len(word)) + 1)] + [word + "$"]


@dataclass
class Lexicon:
    """Weights of stems; the longest known stem of a word decides."""

    weights: dict[str, float]
    memo: dict[str, float] = field(default_factory=dict)
    tag_memo: dict[str, tuple[int, ...]] = field(default_factory=dict)

    def tags(self, word: str) -> tuple[int, ...]:
        known = self.tag_memo.get(word)
        if known is None:
            if len(self.tag_memo) > MEMO_WORDS:
                self.tag_memo.clear()
            known = self.tag_memo[word] = tags_of(word)
        return known

    def weight(self, word: str) -> float:
        known = self.memo.get(word)
        if known is None:
            known = 0.0
            for stem in reversed(stems_of(word)):
                if stem in self.weights:
                    known = max(0.0, self.weights[stem])
                    break
            if len(self.memo) > MEMO_WORDS:
                self.memo.clear()
            self.memo[word] = known
        return known


GRAMMAR = compose()


def scored_clauses(text: str, lexicon: Lexicon) -> Iterator[dict[str, float]]:
    """For each clause with a match: summed weights by kind.

    A threat word stays one where a learned stem covers it; without a target in its
    clause it counts as the insult that it was learned as, or not at all.
    """
    steps, outs, targeted = GRAMMAR
    for clause in CLAUSE.findall(text.lower()):
        state, total, waiting = 0, None, []
        for word in WORD.findall(clause):
            weight, tags = lexicon.weight(word), lexicon.tags(word)
            if weight and tags[0] == OTHER:
                tags = (INSULT,)
            for tag in tags:
                kind = outs[state][tag]
                if kind == RELEASE:
                    total = total or dict.fromkeys(KINDS, 0.0)
                    for held, heavy in waiting:
                        total[held] += heavy or 1.0
                    waiting = []
                elif kind and tag == MENACE and not targeted[state]:
                    waiting.append((kind, weight))
                elif kind:
                    total = total or dict.fromkeys(KINDS, 0.0)
                    total[kind] += weight or 1.0
                state = steps[state][tag]
        for held, heavy in waiting:
            if heavy:
                total = total or dict.fromkeys(KINDS, 0.0)
                total[PLAIN if held == THREAT else held] += heavy
        if total:
            yield total


FEATURES = ("clauses", "share", "heaviest", *KINDS)


def features(text: str | None, lexicon: Lexicon) -> list[float]:
    """What the grammar finds: number and share of matched clauses, the heaviest one, and log sums by kind."""
    text = text or ""
    vocabulary = set(words_of(text))
    if not any(lexicon.weight(w) or lexicon.tags(w)[0] == MENACE for w in vocabulary):
        return [0.0] * len(FEATURES)
    found = list(scored_clauses(text, lexicon))
    if not found:
        return [0.0] * len(FEATURES)
    sums = {k: sum(c[k] for c in found) for k in KINDS}
    words = len(WORD.findall(text))
    heaviest = max(sum(c.values()) for c in found)
    return [np.log1p(len(found)), 10 * float(np.sqrt(sum(sums.values()) / words / 10)), np.log1p(heaviest), *(np.log1p(sums[k]) for k in KINDS)]


# What each kind of match weighs before any label is seen: a negated or a reported insult speaks less.
PRIOR = np.array([0.0, 0.0, 0.0, 0.5, 1.0, 0.0, 0.0, 1.0])
PRIOR_STRENGTH = 0.5


def fit_logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, np.ndarray]:
    """Newton steps towards the most likely weights, drawn to ``PRIOR``."""
    design = np.hstack([np.ones((len(x), 1)), x])
    centre = np.concatenate(([-3.0], PRIOR))
    pull = np.concatenate(([1e-3], np.full(len(PRIOR), PRIOR_STRENGTH)))
    w = centre.copy()
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
        gradient = design.T @ (p - y) + pull * (w - centre)
        hessian = (design * (p * (1 - p))[:, None]).T @ design + np.diag(pull)
        move = np.linalg.solve(hessian, gradient)
        w -= move * min(1.0, 5.0 / max(1e-9, np.abs(move).max()))
        if np.abs(move).max() < 1e-8:
            break
    return float(w[0]), w[1:]


@dataclass
class Model:
    weights: dict[str, float]
    bias: float
    coefficients: np.ndarray


def labelled_rows(docs: DataFrame, labels: DataFrame, label: str, limit: int = MAX_LABELLED) -> DataFrame:
    """(doc_id, text, y, half) of at most ``limit`` labelled rows outside the held-out fold.

    Rows with a NULL label or id are left out. The sample is bounded, so it is
    broadcast, and the documents are not shuffled.
    """
    own = labels.select(F.col("doc_id"), F.col(label).cast("int").alias("y")).filter("doc_id is not null and y in (0, 1)")
    own = own.filter(fold(F.col("doc_id")) != 0).groupBy("doc_id").agg(F.max("y").alias("y"))
    sample = own.orderBy(F.xxhash64(F.col("doc_id").cast("string")), "doc_id").limit(limit)
    sample = sample.withColumn("half", F.pmod(F.xxhash64(F.lit("half"), F.col("doc_id").cast("string")), F.lit(2)).cast("int"))
    return docs.select("doc_id", F.col("text").cast("string").alias("text")).join(F.broadcast(sample), "doc_id")


def runs_of(text: str | None) -> set[str]:
    """Its runs of ``RUN_WORDS`` words; a shorter text is one run, an empty one has none."""
    words = words_of(text or "")
    return {" ".join(words[i : i + RUN_WORDS]) for i in range(max(1, len(words) - RUN_WORDS + 1))} if words else set()


def _bands(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, doc_id, y, band): the min-hashes of a text's runs, ``BAND_HASHES`` to a band."""
    import xxhash

    draw = np.random.default_rng(5)
    flips, odd = (draw.integers(0, 2**64, BANDS * BAND_HASHES, dtype=np.uint64) for _ in range(2))
    odd |= np.uint64(1)
    for batch in batches:
        rows, bands = [], []
        for k, text in enumerate(batch.column("text")):
            runs = np.fromiter(map(xxhash.xxh64_intdigest, runs_of(text.as_py())), dtype=np.uint64)
            if len(runs):
                least = np.array([((runs ^ f) * o).min() for f, o in zip(flips, odd, strict=True)]).reshape(BANDS, BAND_HASHES)
                rows += [k] * BANDS
                bands += [f"{n} {xxhash.xxh3_128_hexdigest(x.tobytes())}" for n, x in enumerate(least)]
        yield pa.RecordBatch.from_arrays([*(batch.column(c).take(pa.array(rows, pa.int64())) for c in ("key", "doc_id", "y")), pa.array(bands, pa.string())], names=["key", "doc_id", "y", "band"])


def similar(a: pa.Array, b: pa.Array) -> pa.Array:
    """Whether two texts share ``COPY_SHARE`` of the runs that either has."""
    out = []
    for x, y in zip(a, b, strict=True):
        one, two = runs_of(x.as_py()), runs_of(y.as_py())
        out.append(len(one & two) >= COPY_SHARE * len(one | two))
    return pa.array(out, pa.bool_())


def without_copies(rows: DataFrame) -> DataFrame:
    """Labelled rows without near copies of others of their class: the words of a text that was
    copied often would else look like words of its class.

    A row goes only if a row of the same class that stays is ``similar`` to it. Rows that share
    a band are compared with the one of them with the least id.
    """
    from lendscope.sources.workspace import stored

    key = F.sha2(F.concat_ws(" ", F.col("doc_id").cast("string"), F.coalesce("text", F.lit(""))).cast("binary"), 256)
    keyed = stored(rows.withColumn("key", key).dropDuplicates(["key"]), "toxicity-keyed")
    types = dict(keyed.dtypes)
    bands = stored(keyed.select("key", "doc_id", "y", "text").mapInArrow(_bands, f"key string, doc_id {types['doc_id']}, y {types['y']}, band string"), "toxicity-bands")
    first = bands.groupBy("band", "y").agg(F.min(F.struct("doc_id", "key")).alias("f"), F.count("*").alias("n")).filter("n > 1")
    first = first.select("band", "y", F.col("f.key").alias("first"))
    pairs = bands.join(F.broadcast(first), ["band", "y"]).filter(F.col("key") != F.col("first")).select("key", "first").distinct()
    pairs = stored(pairs, "toxicity-pairs")
    text = keyed.select("key", "text")
    both = pairs.join(text.withColumnsRenamed({"key": "first", "text": "other"}), "first").join(text, "key")
    copies = stored(both.filter(F.arrow_udf(similar, "boolean")("text", "other")).select("key", "first"), "toxicity-copies")
    # at most as many keys as labelled rows
    gone = copies.join(F.broadcast(copies.select(F.col("key").alias("first")).distinct()), "first", "left_anti").select("key").distinct()
    return keyed.join(F.broadcast(gone), "key", "left_anti").select(*rows.columns)


def _counted(counts: dict[int, Counter]) -> Iterator[pa.RecordBatch]:
    for part, counted in counts.items():
        columns = [pa.array(counted.keys(), pa.string()), pa.array([part] * len(counted), pa.int32()), pa.array(counted.values(), pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, names=["stem", "part", "n"])
    counts.clear()


def _count_stems(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents by stem, class and half, added up as far as ``MEMO_WORDS`` stems fit."""
    counts: dict[int, Counter] = {}
    for batch in batches:
        for text, y, half in zip(batch.column("text"), batch.column("y").to_pylist(), batch.column("half").to_pylist(), strict=True):
            stems = {s for w in set(words_of(text.as_py() or "")) if w not in TAGS for s in stems_of(w)}
            counts.setdefault(2 * half + y, Counter()).update(stems)
            if sum(map(len, counts.values())) > MEMO_WORDS:
                yield from _counted(counts)
    yield from _counted(counts)


def evidence(t: float, c: float, base: float) -> float:
    """Minus the log of how likely a stem in t toxic and c clean documents has at least t toxic
    ones by chance (Chernoff's bound; exact where c is 0); 0 where the share is ``base`` or less."""
    n = t + c
    if not n or t <= n * base or base >= 1:
        return 0.0
    return t * np.log(t / (n * base)) + (c * np.log(c / (n * (1 - base))) if c else 0.0)


def _evidence(t: Column, c: Column, base: float) -> Column:
    """``evidence`` over counts."""
    n = t + c
    if base >= 1:
        return F.lit(0.0)
    rest = F.when(c > 0, c * F.log(c / (n * (1 - base)))).otherwise(0.0)
    return F.when(t > n * base, t * F.log(t / (n * base)) + rest).otherwise(0.0)


def _weights(counted: pd.DataFrame, toxic: str, clean: str, n_toxic: int, n_clean: int, tested: int) -> dict[str, float]:
    """Log odds of stems, each leaning on the next shorter one; only what lies under a clear stem is kept.

    A clear stem raises the odds by more than chance does among ``tested`` stems.
    """
    out: dict[str, float] = {}
    rates: dict[str, float] = {}
    base = n_toxic / max(1, n_toxic + n_clean)
    offset = np.log(max(base, 1e-6) / max(1 - base, 1e-6))
    rows = sorted(zip(counted["stem"], counted[toxic], counted[clean], strict=True), key=lambda r: (len(r[0].rstrip("$")), r[0]))
    for stem, t, c in rows:
        bare = stem.rstrip("$")
        parent = next((rates[bare[:k]] for k in range(len(bare) if stem != bare else len(bare) - 1, SHORTEST - 1, -1) if bare[:k] in rates), None)
        rate = (t + LEAN * (base if parent is None else parent)) / (t + c + LEAN)
        lift = np.log(max(rate, 1e-9) / max(1 - rate, 1e-9)) - offset
        clear = t >= MIN_DOCS and lift >= np.log(MIN_LIFT) and evidence(t, c, base) >= np.log(max(1, tested) / CHANCE_STEMS)
        if clear or parent is not None:
            rates[stem] = rate
            out[stem] = min(float(lift), MOST) if lift >= np.log(MIN_LIFT) else 0.0
    return out


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", limit: int = MAX_LABELLED) -> Model:
    """Stems and weights from labelled rows; ``docs`` has doc_id and text.

    Stems are counted in two halves; the grammar's weights are fitted on matches
    that the stems of the other half find. Without labelled rows of both classes
    the model knows no stems and says what the prior says.
    """
    from lendscope.sources.workspace import stored

    rows = stored(without_copies(labelled_rows(docs, labels, label, limit)), "toxicity-rows")
    sizes = {(r.half, r.y): r.n for r in rows.groupBy("half", "y").agg(F.count("*").alias("n")).collect()}
    n = [[sizes.get((h, y), 0) for y in (0, 1)] for h in (0, 1)]
    if not (n[0][1] + n[1][1] and n[0][0] + n[1][0]):
        return Model({}, -3.0, PRIOR)
    parts = [F.sum(F.when(F.col("part") == p, F.col("n")).otherwise(0)).alias(f"p{p}") for p in range(4)]
    counted = rows.mapInArrow(_count_stems, "stem string, part int, n long").groupBy("stem").agg(*parts)
    toxic = F.col("p1") + F.col("p3")
    lift = (toxic + 0.5) / (F.col("p0") + F.col("p2") + 0.5) * ((n[0][0] + n[1][0]) / (n[0][1] + n[1][1]))
    counted = stored(counted.filter(toxic + F.col("p0") + F.col("p2") >= MIN_DOCS), "toxicity-stems")
    tested = counted.count()
    clean, base = F.col("p0") + F.col("p2"), (n[0][1] + n[1][1]) / sum(map(sum, n))
    sure = _evidence(toxic, clean, base) >= float(np.log(max(1, tested) / CHANCE_STEMS))
    clear = counted.filter((toxic >= MIN_DOCS) & (lift >= MIN_LIFT) & sure).select(F.substring("stem", 1, SHORTEST).alias("root")).distinct()
    kept = counted.withColumn("root", F.substring("stem", 1, SHORTEST)).join(clear, "root", "left_semi")
    # each is in MIN_DOCS of at most ``limit`` texts
    kept = kept.drop("root").toPandas()
    kept["toxic"], kept["clean"] = kept.p1 + kept.p3, kept.p0 + kept.p2
    halves = [_weights(kept, f"p{2 * h + 1}", f"p{2 * h}", n[h][1], n[h][0], tested) for h in (0, 1)]
    # each half is measured with the stems of the other
    measured = rows.select("y", _features(F.col("text"), F.col("half"), halves[::-1]).alias("x")).collect()
    bias, coefficients = fit_logistic(np.array([r.x for r in measured]), np.array([r.y for r in measured], dtype=float))
    return Model(_weights(kept, "toxic", "clean", n[0][1] + n[1][1], n[0][0] + n[1][0], tested), bias, coefficients)


def _features(text: Column, which: Column, weights: list[dict[str, float]]) -> Column:
    """Features by the lexicon that ``which`` numbers."""

    @F.arrow_udf("array<double>")
    def measure(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        lexicons = [Lexicon(w) for w in weights]
        for texts, numbers in batches:
            rows = zip(texts, numbers.to_pylist(), strict=True)
            yield pa.array([features(t.as_py(), lexicons[k]) for t, k in rows], pa.list_(pa.float64()))

    return measure(text, which)


def score(text: Column, model: Model) -> Column:
    """Column of scores between 0 and 1; a NULL or empty text has no match and scores the bias alone."""
    weights, bias, coefficients = model.weights, model.bias, model.coefficients

    @F.arrow_udf("double")
    def scored(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        lexicon = Lexicon(weights)
        for batch in texts:
            x = np.array([features(t.as_py(), lexicon) for t in batch]).reshape(-1, len(FEATURES))
            yield pa.array(1 / (1 + np.exp(-np.clip(x @ coefficients + bias, -30, 30))))

    return scored(text.cast("string"))


def with_toxicity(docs: DataFrame, model: Model, text_col: str = "text", to: str = "toxicity") -> DataFrame:
    """``docs`` with the score; a column named ``to`` is replaced, all else passes through, row by row."""
    return docs.withColumn(to, score(F.col(text_col), model))
