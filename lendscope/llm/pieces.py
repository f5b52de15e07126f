"""Operator 3: SentencePiece encoding and decoding by a table of distinct chunks.

Pieces of the model never run over a white-space marker or a line feed, so a text
falls into chunks that are segmented alike wherever they stand. Each distinct
chunk is segmented once; its ids go back to every place that has it.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendscope.sources.workspace import stored

MARK = "▁"
#: A line feed, a word with the markers before it, or markers alone.
CHUNK = re.compile(rf"\n|{MARK}*[^{MARK}\n]+|{MARK}+")
#: Characters of a block of documents; a longer document is a block of its own. Larger
#: blocks share more chunks, smaller ones take less memory (some ten bytes a character).
BLOCK_CHARS = 32_000_000
#: Numbers below it take one byte when packed, those below ``LARGE`` two.
SMALL = 128
LARGE = SMALL + (255 - SMALL) * 256
#: Compression level of packed columns: disk is scarcer here than CPU time.
LEVEL = 15
#: Tables that chunks of a block are dealt to.
BUCKETS = 64


def chunks_of(text: str) -> list[str]:
    """The marked text (a marker in front, markers for spaces) cut into chunks; none for an empty text."""
    return CHUNK.findall(MARK + text.replace(" ", MARK)) if text else []


def processor(model: bytes):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_proto=model)


def check_model(model: bytes) -> None:
    """Raise unless chunks may be segmented apart: no piece but bytes holds a line feed, none a
    marker after another character, and the normalizer does nothing but mark spaces."""
    from sentencepiece import sentencepiece_model_pb2

    proto = sentencepiece_model_pb2.ModelProto()
    proto.ParseFromString(model)
    spec = proto.normalizer_spec
    plain = spec.name == "identity" and not spec.precompiled_charsmap and spec.add_dummy_prefix and spec.escape_whitespaces
    crossing = any("\n" in p.piece or re.search(f"[^{MARK}]{MARK}", p.piece) for p in proto.pieces)
    if not plain or spec.remove_extra_whitespaces or proto.trainer_spec.treat_whitespace_as_suffix or crossing or not proto.trainer_spec.byte_fallback:
        raise ValueError("pieces of this model may cross chunks")


def segmenter(model: bytes) -> Callable[[list[str]], list[list[int]]]:
    """Ids of chunks as they come inside a text: encoded behind a line feed, whose ids are cut off."""
    sp = processor(model)
    lead = len(sp.encode("\n"))
    return lambda chunks: [ids[lead:] for ids in sp.encode(["\n" + c for c in chunks], num_threads=1)]


def _streams(values: np.ndarray) -> list[np.ndarray]:
    """Unsigned numbers as byte streams: small ones take a byte, middling ones two, others one and four planes."""
    values = values.astype(np.uint32, copy=False)
    rest = values[values >= LARGE] - np.uint32(LARGE)
    middling = values[(values >= SMALL) & (values < LARGE)] - np.uint32(SMALL)
    first = np.minimum(values, SMALL).astype(np.uint8)
    first[values >= LARGE] = 255
    first[(values >= SMALL) & (values < LARGE)] += (middling >> 8).astype(np.uint8)
    return [first, (middling & 255).astype(np.uint8), *np.ascontiguousarray(rest.view(np.uint8).reshape(-1, 4).T)]


def _pack(values: np.ndarray) -> bytes:
    """Numbers of 0 to 2**32 - 1, compressed; frequent numbers are best small."""
    press = zstandard.ZstdCompressor(level=LEVEL)
    parts = [press.compress(s.tobytes()) for s in _streams(values)]
    return np.array([len(p) for p in parts], dtype="<u4").tobytes() + b"".join(parts)


def _unpack(data: bytes) -> np.ndarray:
    """What ``_pack`` was given, as int64."""
    sizes = np.frombuffer(data[:24], dtype="<u4").tolist()
    starts = np.cumsum([24, *sizes]).tolist()
    opened = [zstandard.ZstdDecompressor().decompress(data[s : s + n]) for s, n in zip(starts, sizes, strict=False)]
    first, second, *planes = [np.frombuffer(o, dtype=np.uint8) for o in opened]
    out = first.astype(np.int64)
    middling = (first >= SMALL) & (first < 255)
    out[middling] = SMALL + ((out[middling] - SMALL) << 8) + second
    out[first == 255] = LARGE + sum(p.astype(np.int64) << (8 * k) for k, p in enumerate(planes))
    return out


def _pack_words(words: list[str]) -> bytes:
    """Joined by line feeds; the chunk that is a line feed goes as an empty string."""
    return zstandard.ZstdCompressor(level=LEVEL).compress("\n".join("" if w == "\n" else w for w in words).encode("utf-8", "surrogatepass"))


def _unpack_words(data: bytes) -> list[str]:
    text = zstandard.ZstdDecompressor().decompress(data).decode("utf-8", "surrogatepass")
    return [w or "\n" for w in text.split("\n")]


#: Rows of one block: its documents (bucket -1) and one list of distinct chunks per bucket.
_BLOCK = "block string, bucket int, size int, doc_ids array<{id}>, a binary, b binary, c binary"
_ROW = pa.schema([("block", pa.string()), ("bucket", pa.int32()), ("size", pa.int32()), ("a", pa.binary()), ("b", pa.binary()), ("c", pa.binary())])


def _rows(rows: list[dict], ids: pa.Array | None, id_type: pa.DataType) -> pa.RecordBatch:
    """``ids`` belong to the first row."""
    held = pa.Table.from_pylist(rows, schema=_ROW).combine_chunks()
    size = len(ids) if ids is not None else 0
    offsets = [0] + [size] * len(rows)
    lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), ids if ids is not None else pa.array([], id_type))
    columns = {n: held.column(n).combine_chunks() for n in _ROW.names}
    return pa.RecordBatch.from_arrays([columns["block"], columns["bucket"], columns["size"], lists, columns["a"], columns["b"], columns["c"]], names=["block", "bucket", "size", "doc_ids", "a", "b", "c"])


def _index(buckets: int, block_chars: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Documents to blocks of chunk numbers and their tables of distinct chunks."""

    def finish(ids: list, places: list[np.ndarray], table: dict[str, int], id_type: pa.DataType) -> pa.RecordBatch:
        import uuid
        import zlib

        block = uuid.uuid4().hex
        flat = np.concatenate(places) if places else np.zeros(0, dtype=np.uint32)
        words = list(table)
        order = np.argsort(-np.bincount(flat, minlength=len(words)), kind="stable")
        rank = np.empty(len(words), dtype=np.uint32)
        rank[order] = np.arange(len(words), dtype=np.uint32)
        ranked = [words[i] for i in order.tolist()]
        bucket = np.fromiter((zlib.crc32(w.encode("utf-8", "surrogatepass")) % buckets for w in ranked), dtype=np.uint32, count=len(ranked))
        counts = np.array([len(p) for p in places], dtype=np.uint32)
        rows = [{"block": block, "bucket": -1, "size": len(places), "a": _pack(counts), "b": _pack(rank[flat]), "c": _pack(bucket)}]
        for b in np.unique(bucket).tolist():
            own = [ranked[i] for i in np.flatnonzero(bucket == b).tolist()]
            rows.append({"block": block, "bucket": b, "size": len(own), "a": _pack_words(own), "b": b"", "c": b""})
        return _rows(rows, pa.array(ids, id_type), id_type)

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, places, table, size, id_type = [], [], {}, 0, None
        for batch in batches:
            id_type = batch.column("doc_id").type
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                text = text.as_py() or ""
                if ids and size + len(text) > block_chars:
                    yield finish(ids, places, table, id_type)
                    ids, places, table, size = [], [], {}, 0
                number = table.setdefault
                chunks = chunks_of(text)
                places.append(np.fromiter((number(c, len(table)) for c in chunks), dtype=np.uint32, count=len(chunks)))
                ids.append(doc_id)
                size += len(text)
        if ids:
            yield finish(ids, places, table, id_type)

    return index


def _segment(model: bytes) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Ids for the chunks of each (block, bucket); a bucket comes whole, so a chunk is segmented once."""

    def segment(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = segmenter(model)
        known: dict[str, np.ndarray] = {}
        current = None
        for batch in batches:
            id_type = batch.schema.field("doc_ids").type.value_type
            for row in range(len(batch)):
                block, bucket, size, data = (batch.column(n)[row].as_py() for n in ("block", "bucket", "size", "a"))
                if bucket != current:
                    known, current = {}, bucket
                words = _unpack_words(data)
                new = [w for w in words if w not in known]
                known.update(zip(new, map(lambda x: np.array(x, dtype=np.uint32), ids_of(new)), strict=True))
                lists = [known[w] for w in words]
                lengths = np.fromiter(map(len, lists), dtype=np.uint32, count=len(lists))
                flat = np.concatenate(lists)
                yield _rows([{"block": block, "bucket": bucket, "size": size, "a": _pack(lengths), "b": _pack(flat), "c": b""}], None, id_type)

    return segment


def _spread(lengths: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Positions start .. start + length - 1 of each pair, one after the other."""
    ends = np.cumsum(lengths)
    return np.arange(int(ends[-1]) if len(ends) else 0) - np.repeat(ends - lengths - starts, lengths)


def _assemble(model: bytes) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows of a block come together, its documents first: ids back to their places, then decoded."""

    def finish(head: dict, packs: list[tuple[int, bytes, bytes]], sp, id_type: pa.DataType) -> Iterator[pa.RecordBatch]:
        counts, flat, bucket = (_unpack(head[k]) for k in ("a", "b", "c"))
        lengths = np.zeros(len(bucket), dtype=np.int64)
        starts = np.zeros(len(bucket), dtype=np.int64)
        pieces, at = [], 0
        for number, packed_lengths, packed_ids in packs:
            own = np.flatnonzero(bucket == number)
            lengths[own] = _unpack(packed_lengths)
            pieces.append(_unpack(packed_ids))
            starts[own] = at + np.cumsum(lengths[own]) - lengths[own]
            at += len(pieces[-1])
        pieces = np.concatenate(pieces).astype(np.int32) if pieces else np.zeros(0, dtype=np.int32)
        first = 0
        ends = np.cumsum(counts)
        while first < len(counts):
            begin = ends[first] - counts[first]
            after = max(first + 1, int(np.searchsorted(ends, begin + 500_000, side="right")))
            words = flat[begin : ends[after - 1]]
            ids = pieces[_spread(lengths[words], starts[words])]
            sums = np.concatenate(([0], np.cumsum(lengths[words])))
            bounds = sums[np.concatenate(([0], ends[first:after] - begin))].astype(np.int64)
            decoded = [sp.decode(ids[s:e].tolist()) if e > s else "" for s, e in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]
            lists = pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(ids))
            yield pa.RecordBatch.from_arrays([pa.array(head["doc_ids"][first:after], id_type), lists, pa.array(decoded, pa.string())], names=["doc_id", "ids", "decoded"])
            first = after

    def assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sp = processor(model)
        head, packs, id_type = None, [], None
        for batch in batches:
            id_type = batch.schema.field("doc_ids").type.value_type
            for row in range(len(batch)):
                part = {n: batch.column(n)[row].as_py() for n in ("block", "bucket", "a", "b", "c")}
                if part["bucket"] < 0:
                    if head is not None:
                        yield from finish(head, packs, sp, id_type)
                    head, packs = part | {"doc_ids": batch.column("doc_ids")[row].as_py()}, []
                else:
                    packs.append((part["bucket"], part["a"], part["b"]))
        if head is not None:
            yield from finish(head, packs, sp, id_type)

    return assemble


def encode_decode(
    docs: DataFrame,
    model: bytes,
    id_col: str = "doc_id",
    text_col: str = "text",
    buckets: int | None = None,
    block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, ids (the model's ids of the whole text) and decoded (the text that the ids give back).

    The ids are those of the sentencepiece library without begin or end ids and
    without sampling. NULL and empty texts have no ids and decode to the empty
    text. Repeated rows and ids come out as they came in; other columns are not
    read. A model whose pieces may cross chunks raises ``ValueError``.

    Three steps. Blocks of documents are written as chunk numbers with a table of
    the block's distinct chunks. These tables meet by chunk bucket, so that a
    chunk of any number of blocks is segmented once. Its ids return to the block.
    Rows that move are one per block and bucket; a frequent chunk moves once per
    block, not once per place.
    """
    check_model(model)
    buckets = buckets or min(4096, max(BUCKETS, 2 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    own = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    id_type = own.schema["doc_id"].dataType.simpleString()
    schema = _BLOCK.format(id=id_type)
    blocks = stored(own.mapInArrow(_index(buckets, block_chars), schema), "piece-blocks")
    tables = blocks.filter("bucket >= 0").repartition("bucket").sortWithinPartitions("bucket")
    answers = tables.mapInArrow(_segment(model), schema)
    met = blocks.filter("bucket < 0").unionByName(answers).repartition("block").sortWithinPartitions("block", "bucket")
    return met.mapInArrow(_assemble(model), f"doc_id {id_type}, ids array<int>, decoded string")
