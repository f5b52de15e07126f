"""Repeats found by keyed state: one rule for all rows, however they fall into batches."""

from __future__ import annotations

import datetime as dt
import struct
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
EMPTY_BATCHES = "spark.sql.streaming.noDataMicroBatches.enabled"
SHUFFLES_GO = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: The day of rows without a time: near to each other and to no other day.
NO_DAY = -(10**8)


#: Groups that the keys are dealt into; each is one state.
BUCKETS = 1 << 12
#: What a task gathers before it deals rows into blocks, and the rows of a block that leaves.
BLOCK_BYTES, BLOCK_ROWS = 32 << 20, 1 << 16


def _key_text(key: Column, kind: T.DataType) -> Column:
    """The key as text: equal for equal keys and for no others."""
    match kind.typeName():
        case "string":
            return key
        case "float" | "double":
            return (key + F.lit(0.0)).cast("string")  # 0.0 and -0.0 are one key
        case "timestamp":
            return F.unix_micros(key).cast("string")
        case "binary":
            return F.hex(key)
        case "array" | "struct" | "map":
            return F.to_json(key, {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "ignoreNullFields": "false"})
        case _:
            return key.cast("string")


class _FirstOfDays(StatefulProcessor):
    """Keeps a row of a key unless one was kept within ``days`` of its day. The state of a bucket of keys is the
    kept days, one element a batch; each is forgotten ``keep`` after it was written."""

    def __init__(self, days: int, keep: dt.timedelta):
        self.reach, self.keep_ms = min(days, (1 << 31) - 1), int(keep.total_seconds() * 1000)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.kept = handle.getListState("kept", "block binary", ttlDurationMs=self.keep_ms)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        rows = list(rows)
        columns = {c: [row[c] for row in rows] for c in ("_key", "_day", "_order")}
        fresh = self._fresh(pa.table({**columns, "_at": list(range(len(rows)))}))
        for at in fresh.column("_at").to_pylist():
            yield Row(**{"_row": rows[at]["_row"]})

    def _fresh(self, rows: pa.Table) -> pa.Table:
        """Those of the rows that are no repeats, by key and day; from now on they are known."""
        names, places = _places(rows)
        at = _first(rows, places)
        places = places[at]
        known = [np.empty(0, np.int64)]
        for (block,) in self.kept.get():
            kept = _read(block)
            codes = pc.index_in(kept.column("_key"), value_set=names)
            own = codes.is_valid()
            known.append(_place(codes.filter(own), kept.column("_day").filter(own)))
        known = np.sort(np.concatenate(known))
        near = np.searchsorted(known, places + self.reach, "right") > np.searchsorted(known, places - self.reach, "left")
        at, places = at[~near], places[~near]
        # of each key the first of those that are left stays, and those near to it go, until none is left
        stays, left = [], np.arange(len(at))
        while len(left):
            own = places[left] >> 32
            first = np.append(True, own[1:] != own[:-1])
            stays.append(left[first])
            last = places[left[first]][np.cumsum(first) - 1]
            left = left[~first & (places[left] - last > self.reach)]
        fresh = rows.take(at[np.sort(np.concatenate(stays))]) if stays else rows.slice(0, 0)
        if fresh.num_rows:
            self.kept.appendValue(tuple(_blocks(fresh.select(["_key", "_day"]), [0, fresh.num_rows])))
        return fresh

    def close(self) -> None:
        pass


class _FirstOfBlocks(_FirstOfDays):
    """The same for rows that come and go in blocks."""

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        held, size, most = [], 0, BLOCK_ROWS
        for row in rows:
            held.append(_read(row["_block"]))
            size += held[-1].num_rows
            if size > most:
                held = [_first_of(pa.concat_tables(held))]
                size, most = held[0].num_rows, 2 * held[0].num_rows + BLOCK_ROWS
        fresh = self._fresh(pa.concat_tables(held))
        for block in _blocks(fresh, [*range(0, fresh.num_rows, BLOCK_ROWS), fresh.num_rows]):
            yield Row(**{"_block": block})


def _place(codes: pa.ChunkedArray, days: pa.ChunkedArray) -> np.ndarray:
    """The number of a key and its day as one; days of two keys are never near to each other."""
    return (codes.to_numpy().astype(np.int64) << 32) + days.to_numpy().astype(np.int64) + (1 << 31)


def _places(rows: pa.Table) -> tuple[pa.Array, np.ndarray]:
    """The keys, and the place of each row."""
    coded = rows.column("_key").combine_chunks().dictionary_encode()
    return coded.dictionary, _place(coded.indices, rows.column("_day"))


def _first(rows: pa.Table, places: np.ndarray) -> np.ndarray:
    """Of the rows of a key and day only the first can be kept. Without ``_order`` they are equal."""
    by = pc.sort_indices(rows.column("_order")).to_numpy() if "_order" in rows.column_names else np.arange(len(places))
    return by[np.unique(places[by], return_index=True)[1]]


def _first_of(rows: pa.Table) -> pa.Table:
    return rows.take(np.sort(_first(rows, _places(rows)[1])))


# A block is the rows of one bucket, or a part of them, in few bytes: what moves and what is state would take
# several times as many as plain rows. It has each key that is next to itself once.
_HEAD = struct.Struct("<IIII")
_RANGE = struct.Struct("<qB")


def _ints(values: np.ndarray) -> bytes:
    """Whole numbers in as many bits as their range asks for."""
    low = int(values.min())
    width = (int(values.max()) - low).bit_length()
    bits = (values - low)[:, None] >> np.arange(width) & 1
    return _RANGE.pack(low, width) + np.packbits(bits.astype(np.uint8)).tobytes()


def _read_ints(block: memoryview, n: int) -> tuple[np.ndarray, memoryview]:
    """The numbers, and what follows them."""
    low, width = _RANGE.unpack_from(block)
    end = _RANGE.size + -(-n * width // 8)
    bits = np.unpackbits(np.frombuffer(block[_RANGE.size : end], np.uint8), count=n * width).reshape(n, width)
    return low + bits @ (np.int64(1) << np.arange(width, dtype=np.int64)), block[end:]


def _blocks(rows: pa.Table, starts: Sequence[int]) -> Iterator[bytes]:
    """A block of the rows from each start to the next."""
    if not rows.num_rows:
        return
    rows = rows.combine_chunks()
    keys, days = rows.column("_key").combine_chunks(), rows.column("_day").to_numpy().astype(np.int64)
    head = np.append(True, pc.not_equal(keys.slice(1), keys.slice(0, len(keys) - 1)).to_numpy(zero_copy_only=False))
    head[np.asarray(starts[:-1])] = True
    heads = np.flatnonzero(head)
    counts, of = np.diff(heads, append=len(keys)), np.searchsorted(heads, starts)
    names = keys.take(pa.array(heads)).cast(pa.large_binary())
    ends, text = np.frombuffer(names.buffers()[1], np.int64)[: len(names) + 1], names.buffers()[2] or pa.py_buffer(b"")
    lengths = np.diff(ends)
    rest = rows.drop_columns(["_key", "_day"])
    for (start, end), (a, b) in zip(pairwise(starts), pairwise(of), strict=True):
        raw = text.slice(int(ends[a]), int(ends[b] - ends[a]))
        packed = pa.compress(raw, codec="zstd", asbytes=True)
        parts = _HEAD.pack(b - a, end - start, len(packed), raw.size), _ints(lengths[a:b]), _ints(counts[a:b]), _ints(days[start:end]), packed
        yield b"".join((*parts, _ipc(rest.slice(start, end - start))))


def _ipc(rows: pa.Table) -> bytes:
    if not rows.num_columns:
        return b""
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, rows.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_table(rows)
    return sink.getvalue().to_pybytes()


def _read(block: bytes) -> pa.Table:
    n, size, packed, raw = _HEAD.unpack_from(block)
    lengths, left = _read_ints(memoryview(block)[_HEAD.size :], n)
    counts, left = _read_ints(left, n)
    days, left = _read_ints(left, size)
    ends = pa.py_buffer(np.append(0, np.cumsum(lengths)).astype(np.int32))
    text = pa.decompress(left[:packed], raw, codec="zstd") if raw else pa.py_buffer(b"")
    names = pa.Array.from_buffers(pa.string(), n, [None, ends, text])
    keys = names if n == size else names.take(pa.array(np.repeat(np.arange(n), counts)))
    rows = {"_key": keys, "_day": days.astype(np.int32)}
    if len(left) > packed:
        rest = pa.ipc.open_stream(left[packed:]).read_all()
        rows.update(zip(rest.column_names, rest.columns, strict=True))
    return pa.table(rows)


def _into_blocks(spread: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows gathered to some 32 MB and dealt into a block for each bucket; with ``spread`` only the first of
    the gathered rows of a key and day."""

    def dealt(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
        rows = pa.Table.from_batches(batches)
        rows = rows.set_column(rows.column_names.index("_key"), "_key", rows.column("_key").cast(pa.string()))
        rows = _first_of(rows) if spread else rows
        buckets = rows.column("_bucket").to_numpy()
        by = np.argsort(buckets, kind="stable")
        found, starts = np.unique(buckets[by], return_index=True)
        blocks = list(_blocks(rows.drop_columns(["_bucket"]).take(by), [*starts.tolist(), len(by)]))
        return pa.record_batch({"_bucket": pa.array(found, pa.int32()), "_block": pa.array(blocks, pa.binary())})

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                size += batch.nbytes
            if size >= BLOCK_BYTES:
                yield dealt(held)
                held, size = [], 0
        if held:
            yield dealt(held)

    return packed


def _out_of_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for block in batch.column(0):
            rows = _read(block.as_py())
            yield from rows.select([c for c in rows.column_names if c != "_order"]).combine_chunks().to_batches()


def first_per_key(stream: DataFrame, key: str, time: str, days: int, keep: dt.timedelta = dt.timedelta(days=400), spread: bool = False, buckets: int = BUCKETS) -> DataFrame:
    """The rows of a stream without repeats: a row is one if a row of its key was kept whose event
    day lies within ``days`` of its own, before or after.

    Rows of one key in one micro-batch are judged in the order of their time (then of
    their content), and against all kept before; so rows that come in time order give the same
    whether they come in one batch or one by one. Nothing is dropped behind a watermark.
    Kept days are state of the key and are freed ``keep`` of processing time after they were
    written, so the state is bounded by the keys of that span. Rows with a NULL key are no
    repeats of anything; rows without a time are repeats of each other.

    Keys are dealt into ``buckets`` by their hash, and a bucket's state is read once a micro-batch: a
    call for each key would cost more than its rows. More buckets read less state for a batch that
    is small beside it. A query that goes on from a checkpoint needs the same number.

    Rows move and are kept in blocks, so that a row takes about as many bytes as its key, compressed. The key and the
    time are no second time in them where the block's own key (text) and day (a date) are the same.

    The rows of a key go to one task. With ``spread`` each task first keeps one row per
    key and day of the rows that it gathers, so that a key repeated very often reaches its state
    some hundred thousand times less often.

    Start the query within ``state_settings``.
    """
    kinds = {f.name: f.dataType for f in stream.schema.fields}
    value = lambda c: F.col(f"`{c}`")
    text = _key_text(value(key), kinds[key])
    day = F.coalesce(F.unix_date(value(time).cast("date")), F.lit(NO_DAY))
    told = {c: again for c, again, kind in ((key, F.col("_key"), "string"), (time, F.when(F.col("_day") != NO_DAY, F.date_from_unix_date("_day")), "date")) if kinds[c].simpleString() == kind}
    own = [c for c in stream.columns if c not in told]
    columns = [text.alias("_key"), day.alias("_day")]
    if own:
        at = F.unhex(F.lpad(F.hex(F.unix_micros(value(time).cast("timestamp")) + F.lit(1 << 62)), 16, "0"))
        content = F.unhex(F.sha2(F.to_json(F.struct(*[value(c) for c in stream.columns])), 256))
        columns += [F.concat(F.coalesce(at, F.lit(bytes(8))), content).alias("_order"), F.struct(*[value(c) for c in own]).alias("_row")]
    known = stream.filter(text.isNotNull()).select(*columns)
    dealt = known.withColumn("_bucket", F.pmod(F.xxhash64("_key"), F.lit(buckets)).cast("int")).mapInArrow(_into_blocks(spread), "_bucket int, _block binary")
    kept = dealt.groupBy("_bucket").transformWithState(_FirstOfBlocks(days, keep), "_block binary", "Append", "ProcessingTime").select("_block")
    rows = kept.mapInArrow(_out_of_blocks, T.StructType([f for f in known.schema.fields if f.name != "_order"]))
    back = [(told[c] if c in told else F.col("_row").getField(c)).alias(c) for c in stream.columns]
    return rows.select(*back).unionByName(stream.filter(text.isNull()))


@contextmanager
def state_settings(spark: SparkSession) -> Iterator[None]:
    """What a query with such state needs when it starts: the state store that knows expiry,
    no batches without rows, of which a run over all available files would make endlessly many,
    and shuffle files that go with their batch, not when the driver happens to collect its garbage."""
    wanted = {PROVIDER: ROCKS, EMPTY_BATCHES: "false", SHUFFLES_GO: "true"}
    before = {name: spark.conf.get(name, None) for name in wanted}
    for name, value in wanted.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)
