"""Operator 11: repair of the structure of conversations, by a run-length DP.

A conversation is to read ``system? (user assistant)+`` or to be empty. Its rows
become symbols of role and fault; equal consecutive symbols make a run. A row moves
the least cost between the four states of the reading by a min-plus matrix; a run of
n rows moves it by the n-th power, put together from cached binary powers. From the
costs the cheapest edits are unrolled, row by row, the first letter by name among equals.

Min-plus products are associative, so a conversation of any length is worked on in
pieces: rows are dealt out by range of (conversation, turn), every task cuts its part
into pieces, and what spans tasks is put together from a matrix per piece.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendscope.sources.workspace import stored

#: Rows of one piece of a conversation.
PIECE_ROWS = 4096
#: Remembered steps of runs per task.
MEMO = 100_000

SPACE = " \t\n\x0b\x0c\r"
# What edits cost.
RETYPE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
LETTERS = "DIKR"

#: States of the reading: nothing yet, after the system row, after a user row, after an assistant row.
START, SYSTEM, USER, ASSISTANT = range(4)
STATES = range(4)
FAR = 1 << 60
#: Symbols: a row that must go; else 1 + 2 * role + truncated, with roles system, user, assistant, other.
GONE = 0
SYMBOLS = 9
ROLES = "sua"
LEGAL = {(0, 1), (1, 2), (2, 1)}

Vector = tuple[int, ...]
Matrix = tuple[Vector, ...]


def after_insert(state: int) -> int:
    """An empty row is put in with the role that is due."""
    return ASSISTANT if state == USER else USER


def after_keep(state: int, role: int) -> int | None:
    """The state after a row of a role, None where it may not stand."""
    if role == 0:
        return SYSTEM if state == START else None
    if role == 1:
        return USER if state != USER else None
    return ASSISTANT if role == 2 and state == USER else None


def moves(state: int, symbol: int) -> Iterator[tuple[str, int, int]]:
    """(letter, cost, next state) of the edits of a row, by letter."""
    yield "D", DELETE, state
    if symbol != GONE:
        role, cut = divmod(symbol - 1, 2)
        kept = after_keep(state, role)
        if kept is not None:
            yield "K", TRUNCATED * cut, kept
        yield "R", RETYPE + TRUNCATED * cut, after_insert(state)


def times(a: Matrix, b: Matrix) -> Matrix:
    """The min-plus product."""
    return tuple(tuple(min(FAR, *(a[i][k] + b[k][j] for k in STATES)) for j in STATES) for i in STATES)


def apply(a: Matrix, v: Vector) -> Vector:
    return tuple(min(a[i][k] + v[k] for k in STATES) for i in STATES)


def _unit() -> Matrix:
    return tuple(tuple(0 if i == j else FAR for j in STATES) for i in STATES)


def _inserts() -> Matrix:
    """Any number of inserted rows: more than three lead nowhere new."""
    one = tuple(tuple(0 if i == j else INSERT if j == after_insert(i) else FAR for j in STATES) for i in STATES)
    return times(times(one, one), one)


def _row(symbol: int) -> Matrix:
    """Rows put in before a row, and its own edit."""
    out = [[FAR] * len(STATES) for _ in STATES]
    for i in STATES:
        for _, cost, j in moves(i, symbol):
            out[i][j] = min(out[i][j], cost)
    return times(_inserts(), tuple(map(tuple, out)))


class Powers:
    """The binary powers of each symbol's matrix, made when they are asked for, and remembered steps."""

    def __init__(self) -> None:
        self.powers = [[_row(s)] for s in range(SYMBOLS)]
        self.steps: dict[tuple, Vector] = {}

    def power(self, symbol: int, k: int) -> Matrix:
        """The matrix of 2**k rows."""
        own = self.powers[symbol]
        while len(own) <= k:
            own.append(times(own[-1], own[-1]))
        return own[k]

    def back(self, symbol: int, length: int, after: Vector) -> Vector:
        """Costs to go before a run, from those after it."""
        least = min(after)
        key = (symbol, length, *[x - least for x in after])
        known = self.steps.get(key)
        if known is None:
            known = key[2:]
            for k in range(length.bit_length()):
                if length >> k & 1:
                    known = apply(self.power(symbol, k), known)
            if len(self.steps) >= MEMO:
                self.steps.clear()
            self.steps[key] = known
        return tuple(x + least for x in known)

    def matrix(self, runs: list[list[int]]) -> Matrix:
        out = _unit()
        for symbol, length in runs:
            for k in range(length.bit_length()):
                if length >> k & 1:
                    out = times(out, self.power(symbol, k))
        return out

    def unroll(self, runs: list[list[int]], state: int, after: Vector) -> tuple[str, int]:
        """The letters of the cheapest edits of some runs, the least by name, and the state they end in."""
        costs = [after]
        for symbol, length in reversed(runs):
            costs.append(self.back(symbol, length, costs[-1]))
        out: list[str] = []
        for (symbol, length), before, behind in zip(runs, costs[:0:-1], costs[-2::-1], strict=True):
            state = self._unroll(symbol, length, state, before, behind, out)
        return "".join(out), state

    def _unroll(self, symbol: int, length: int, state: int, before: Vector, after: Vector, out: list[str]) -> int:
        """Halves a run until single rows are left, so that a run of n rows holds log n cost vectors."""
        if length > 1:
            half = length // 2
            middle = self.back(symbol, length - half, after)
            state = self._unroll(symbol, half, state, before, middle, out)
            return self._unroll(symbol, length - half, state, middle, after, out)
        while True:
            cheapest = [(letter, then) for letter, cost, then in moves(state, symbol) if cost + after[then] == before[state]]
            due = after_insert(state)
            if INSERT + before[due] == before[state]:
                cheapest.append(("I", due))
            letter, state = min(cheapest)
            out.append(letter)
            if letter != "I":
                return state


#: Costs to go after the last row: what has to be put in to end well.
END: Vector = apply(_inserts(), (0, FAR, FAR, 0))


def ending(state: int) -> str:
    return "I" * (END[state] // INSERT)


KEY = ("turn", "role", "digest")
COUNTS = ("blank", "duplicate", "truncated")
REPORT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long"


class _Piece:
    """What is known of consecutive rows of a conversation."""

    def __init__(self, conv: object, key: tuple):
        self.conv, self.key, self.rows = conv, key, 0
        self.runs: list[list[int]] = []
        self.faults = [0, 0, 0]
        self.illegal = self.turns = 0
        self.low = self.high = self.first = self.last = None

    def add(self, turn: int | None, symbol: int, role: int, fault: int, copies: int) -> None:
        if not copies:
            return
        self.rows += 1
        if turn is not None:
            if self.low is None:
                self.low = turn
            self.turns += turn != self.high
            self.high = turn
        if self.first is None:
            self.first = role
        else:
            self.illegal += (self.last, role) not in LEGAL
        self.illegal += (copies - 1) * ((role, role) not in LEGAL)
        self.last = role
        # copies of a row are duplicates of it, or as blank as it is
        for s, f, n in ((symbol, fault, 1), (GONE, 1 if fault == 1 else 2, copies - 1)):
            if n:
                if f:
                    self.faults[f - 1] += n
                if self.runs and self.runs[-1][0] == s:
                    self.runs[-1][1] += n
                else:
                    self.runs.append([s, n])

    def gaps(self) -> int:
        return 0 if self.low is None else self.high - self.low + 1 - self.turns


PIECE = "conv_id {conv}, turn {turn}, role string, digest binary, part int, seq long, symbols array<int>, lengths array<long>, matrix array<long>, audit string, low {turn}, high {turn}, turns long, first int, last int, " + REPORT


def _pieces(schema: pa.Schema, piece_rows: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, seq, powers = TaskContext.get().partitionId(), 0, Powers()
        out: list[dict] = []

        def closed(piece: _Piece, is_whole: bool) -> None:
            nonlocal seq
            row = {"conv_id": piece.conv, **dict(zip(KEY, piece.key, strict=True)), "part": part, "seq": seq, **dict(zip(COUNTS, piece.faults, strict=True))}
            row |= {"low": piece.low, "high": piece.high, "turns": piece.turns, "first": piece.first, "last": piece.last, "illegal": piece.illegal, "gaps": piece.gaps()}
            if is_whole:
                letters, state = powers.unroll(piece.runs, START, END)
                before = END
                for symbol, length in reversed(piece.runs):
                    before = powers.back(symbol, length, before)
                row |= {"audit": letters + ending(state), "cost": before[START]}
            else:
                row |= {"symbols": [s for s, _ in piece.runs], "lengths": [n for _, n in piece.runs], "matrix": [x for line in powers.matrix(piece.runs) for x in line]}
            seq += 1
            out.append(row)

        piece, is_whole = None, False
        for batch in batches:
            for conv, turn, role, digest, initial, fault, copies in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if piece is None or piece.conv != conv:
                    if piece is not None:
                        closed(piece, is_whole)
                    # the first and the last conversation of a task may have rows in others
                    is_whole = piece is not None
                    piece = _Piece(conv, (turn, role, digest))
                elif piece.rows >= piece_rows:
                    closed(piece, False)
                    is_whole = False
                    piece = _Piece(conv, (turn, role, digest))
                piece.add(turn, GONE if fault in (1, 2) else 1 + 2 * initial + (fault == 3), initial, fault, copies)
                if len(out) >= 2000:
                    yield pa.RecordBatch.from_pylist(out, schema)
                    out.clear()
        if piece is not None:
            closed(piece, False)
        yield pa.RecordBatch.from_pylist(out, schema)

    return cut


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        yield from batch.to_pylist()


def _conversations(rows: Iterator[dict]) -> Iterator[list[dict]]:
    """Consecutive rows of one conversation. For pieces only, of which a conversation has few."""
    held: list[dict] = []
    for row in rows:
        if held and held[0]["conv_id"] != row["conv_id"]:
            yield held
            held = []
        held.append(row)
    if held:
        yield held


def _batched(rows: Iterator[dict], schema: pa.Schema, size: int = 2000) -> Iterator[pa.RecordBatch]:
    held: list[dict] = []
    for row in rows:
        held.append(row)
        if len(held) >= size:
            yield pa.RecordBatch.from_pylist(held, schema)
            held = []
    yield pa.RecordBatch.from_pylist(held, schema)


def _costs_behind(schema: pa.Schema) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """For each piece of a conversation the costs to go behind it; the first one has the sums of all."""

    def totals(own: list[dict], cost: int) -> dict:
        sums = {c: sum(r[c] for r in own) for c in (*COUNTS, "illegal")}
        turns, low, high, last = 0, None, None, None
        for r in own:
            if r["low"] is not None:
                turns += r["turns"] - (r["low"] == high)
                low, high = r["low"] if low is None else low, r["high"]
            if r["first"] is not None:
                sums["illegal"] += last is not None and (last, r["first"]) not in LEGAL
                last = r["last"]
        return {**sums, "gaps": 0 if low is None else high - low + 1 - turns, "cost": cost}

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for own in _conversations(_rows(batches)):
            costs = [END]
            for r in reversed(own):
                m = r["matrix"]
                costs.append(apply(tuple(tuple(m[4 * i : 4 * i + 4]) for i in STATES), costs[-1]))
            for k, (r, after) in enumerate(zip(own, costs[-2::-1], strict=True)):
                yield {"part": r["part"], "seq": r["seq"], "place": k, "is_last": k == len(own) - 1, "after": after, **(totals(own, costs[-1][START]) if k == 0 else {})}

    return lambda batches: _batched(walk(batches), schema)


def _walks(schema: pa.Schema) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """For each piece the letters and the last state from each state it may begin in."""

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        powers = Powers()
        for r in _rows(batches):
            runs = [list(x) for x in zip(r.pop("symbols"), r.pop("lengths"), strict=True)]
            after = tuple(r.pop("after"))
            found = [powers.unroll(runs, s, after) for s in STATES]
            if r["is_last"]:
                found = [(letters + ending(s), s) for letters, s in found]
            yield {**r, "letters": [x for x, _ in found], "ends": [s for _, s in found]}

    return lambda batches: _batched(walk(batches), schema, 16)


def _chosen(schema: pa.Schema) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        state = START
        for r in _rows(batches):
            if r["place"] == 0:
                state = START
            letters, ends = r.pop("letters"), r.pop("ends")
            yield {**r, "audit": letters[state]}
            state = ends[state]

    return lambda batches: _batched(walk(batches), schema, 16)


def ordered(rows: DataFrame) -> DataFrame:
    """Rows as (conv_id, turn, role, text, copies, digest), NULL roles and texts as one space."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("role", "text"))
    copies = F.col("copies").cast("long") if "copies" in rows.columns else F.lit(1).cast("long")
    own = rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), copies.alias("copies"))
    return own.withColumn("digest", F.unhex(F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text").cast("binary"))))


def faults(rows: DataFrame) -> DataFrame:
    """Without texts: (conv_id, turn, role, digest, initial, fault, copies).

    initial is 0, 1, 2 for roles that begin with s, u, a, else 3; fault is 0 for none, else
    1 blank, 2 duplicate, 3 truncated, the first that holds. Identical rows are one with their
    number of copies. A duplicate's earlier row is found by the least turn of each distinct
    content, counted per task before it moves.
    """
    end = F.rtrim(F.col("text"), F.lit(SPACE))
    bare = rows.select(
        "conv_id", "turn", "role", "digest", "copies",
        (end == "").alias("blank"),
        (~F.substring(end, -1, 1).isin(".", "!", "?")).alias("cut"),
    )
    distinct = bare.groupBy("conv_id", "turn", "role", "digest").agg(F.sum("copies").alias("copies"), F.first("blank").alias("blank"), F.first("cut").alias("cut"))
    distinct = stored(distinct, "conversation-rows")
    # a content at several turns is a duplicate at all but the least
    place = F.struct(F.col("turn").isNotNull().alias("known"), F.col("turn").alias("turn"))
    firsts = distinct.filter("copies > 0").groupBy("conv_id", "digest").agg(F.min(place).alias("home"), F.count("*").alias("n")).filter("n > 1")
    firsts = stored(firsts.select(F.col("conv_id").alias("_conv"), F.col("digest").alias("_digest"), "home"), "conversation-repeats")
    joined = distinct.join(firsts, F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("digest") == F.col("_digest")), "left")
    repeated = F.col("home").isNotNull() & ~F.col("home").eqNullSafe(place)
    initial = F.substring("role", 1, 1)
    number = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    fault = F.when(F.col("blank"), 1).when(repeated, 2).when(F.col("cut"), 3).otherwise(0)
    return joined.select("conv_id", "turn", "role", "digest", number.alias("initial"), fault.alias("fault"), "copies")


def plan(rows: DataFrame, piece_rows: int = PIECE_ROWS) -> DataFrame:
    """The cheapest edits of every conversation of ``ordered`` rows, in pieces: conv_id, the key of the piece's first row,
    audit (its letters), and in a conversation's first piece (place 0) the counts and costs of the whole.

    Tasks sort ranges of (conv_id, turn, role, digest), so a conversation of any size is dealt
    out. One within a task and ``piece_rows`` is done there. Of the others each piece gives its matrix; a conversation's
    matrices meet in one task, one for ``piece_rows`` rows; each piece then unrolls its letters for the four states it may
    begin in, and a last pass over the pieces picks one.
    """
    types = dict(rows.dtypes)
    schema = PIECE.format(conv=types["conv_id"], turn=types["turn"])
    own = stored(faults(rows), "conversation-faults")
    key = ["conv_id", "turn", "role", "digest"]
    dealt = own.repartitionByRange(*key).sortWithinPartitions(*key)
    pieces = stored(dealt.mapInArrow(_pieces(_arrow(schema), piece_rows), schema), "conversation-pieces")
    whole = pieces.filter("audit is not null").select("conv_id", *KEY, F.lit(0).alias("place"), "audit", *_report_names())
    split = pieces.filter("audit is null")
    behind = f"part int, seq long, place int, is_last boolean, after array<long>, {REPORT}"
    summaries = split.drop("symbols", "lengths", "audit", "cost").repartition("conv_id").sortWithinPartitions("conv_id", "part", "seq")
    costs = summaries.mapInArrow(_costs_behind(_arrow(behind)), behind)
    carried = f"conv_id {types['conv_id']}, turn {types['turn']}, role string, digest binary, place int, is_last boolean, {REPORT}"
    joined = split.drop(*_report_names()).join(costs, ["part", "seq"]).select("conv_id", *KEY, "place", "is_last", *_report_names(), "symbols", "lengths", "after")
    walked = f"{carried}, letters array<string>, ends array<int>"
    walks = joined.mapInArrow(_walks(_arrow(walked)), walked).repartition("conv_id").sortWithinPartitions("conv_id", "place")
    picked = f"{carried}, audit string"
    chosen = walks.mapInArrow(_chosen(_arrow(picked)), picked).drop("is_last")
    return stored(whole.unionByName(chosen.select(*whole.columns)), "conversation-edits")


class _Reader:
    """Applies the letters of pieces to the rows that follow them."""

    def __init__(self) -> None:
        self.letters, self.at, self.state = "", 0, START

    def begin(self, letters: str, is_first: bool) -> Iterator[tuple[str, str, str]]:
        yield from self.end()
        self.letters, self.at = letters, 0
        if is_first:
            self.state = START

    def _inserted(self) -> Iterator[tuple[str, str, str]]:
        while self.at < len(self.letters) and self.letters[self.at] == "I":
            self.at += 1
            self.state = after_insert(self.state)
            yield "I", "assistant" if self.state == ASSISTANT else "user", ""

    def row(self, role: str, text: str) -> Iterator[tuple[str, str, str]]:
        """(letter, role, text) of the repaired rows up to this one."""
        yield from self._inserted()
        letter = self.letters[self.at]
        self.at += 1
        if letter == "K":
            self.state = after_keep(self.state, ROLES.index(role[0]))
            yield letter, role, text
        elif letter == "R":
            self.state = after_insert(self.state)
            yield letter, "assistant" if self.state == ASSISTANT else "user", text

    def end(self) -> Iterator[tuple[str, str, str]]:
        yield from self._inserted()


def _followed(rows: DataFrame, pieces: DataFrame) -> DataFrame:
    """Pieces before their rows, the conversations of a task one after the other.

    The rows of a conversation are read in order, so they go to one task, which holds none
    of them but the one it reads.
    """
    own = rows.filter("copies > 0").select("conv_id", *KEY, F.lit(1).alias("kind"), "text", "copies", F.lit(None).cast("int").alias("place"), F.lit(None).cast(f"struct<{REPORT.replace(' ', ':').replace(',:', ',')}>").alias("report"))
    edits = pieces.select("conv_id", *KEY, F.lit(0).alias("kind"), F.col("audit").alias("text"), F.lit(0).cast("long").alias("copies"), "place", F.struct(*_report_names()).alias("report"))
    every = own.unionByName(edits).repartition("conv_id").sortWithinPartitions("conv_id", *KEY, "kind")
    return every.select("conv_id", "role", "kind", "text", "copies", "place", "report")


def _columns(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*[c.to_pylist() for c in batch.columns], strict=True)


def _messages(schema: pa.Schema) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        reader, conv, n = _Reader(), None, 0

        def numbered(found: Iterator[tuple[str, str, str]]) -> Iterator[dict]:
            nonlocal n
            for letter, role, text in found:
                yield {"conv_id": conv, "position": n, "role": role, "text": text, "edit": letter}
                n += 1

        for key, role, kind, text, copies, place, _ in _columns(batches):
            if kind == 0:
                yield from numbered(reader.end())
                if place == 0:
                    conv, n = key, 0
                yield from numbered(reader.begin(text, place == 0))
            for _ in range(copies):
                yield from numbered(reader.row(role, text))
        yield from numbered(reader.end())

    return lambda batches: _batched(walk(batches), schema, 500)


def messages(rows: DataFrame, pieces: DataFrame) -> DataFrame:
    """The repaired conversations: (conv_id, position, role, text, edit), edit being the letter of what was done."""
    schema = f"conv_id {dict(rows.dtypes)['conv_id']}, position long, role string, text string, edit string"
    return _followed(rows, pieces).mapInArrow(_messages(_arrow(schema)), schema)


def _reports(schema: pa.Schema) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        reader, own, audit, digest, n = _Reader(), None, [], None, 0

        def read(found: Iterator[tuple[str, str, str]]) -> None:
            nonlocal n
            for _, role, text in found:
                digest.update(f"{chr(10) if n else ''}{role}:{text}".encode())
                n += 1

        def finished() -> dict:
            read(reader.end())
            return {**own, "audit": "".join(audit), "repaired_sha256": digest.hexdigest()}

        for key, role, kind, text, copies, place, report in _columns(batches):
            if kind == 0:
                if place == 0:
                    if own is not None:
                        yield finished()
                    own, audit, digest, n = {"conv_id": key, **report}, [], hashlib.sha256(), 0
                read(reader.begin(text, place == 0))
                audit.append(text)
            for _ in range(copies):
                read(reader.row(role, text))
        if own is not None:
            yield finished()

    return lambda batches: _batched(walk(batches), schema)


def report(rows: DataFrame, pieces: DataFrame) -> DataFrame:
    """One row per conversation: gaps, counts of faults, cost, audit, and the digest of the repaired rows, ``role:text`` by line."""
    schema = f"conv_id {dict(rows.dtypes)['conv_id']}, {REPORT}, audit string, repaired_sha256 string"
    return _followed(rows, pieces).mapInArrow(_reports(_arrow(schema)), schema)


def repair(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(``ordered`` rows, their ``plan``), for ``messages`` and ``report``.

    ``conversations`` has conv_id, turn, role, text and, where a row stands for several or for
    none, copies; other columns are not read, whatever their names. Rows go by turn, NULL
    turns first; those of one turn by role, then by content. NULL roles and texts count as one
    space; a NULL conv_id is a conversation of its own. Repeated rows are duplicates. A conversation whose
    rows all have no copies has an empty audit and zeros. An empty table gives empty ones.
    """
    rows = ordered(conversations)
    return rows, plan(rows)


def _arrow(schema: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    return to_arrow_schema(_parse_datatype_string(schema))


def _report_names() -> list[str]:
    return [part.split()[0] for part in REPORT.split(",")]
