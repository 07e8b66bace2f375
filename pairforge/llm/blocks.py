"""Token ids as files of patched frame-of-reference blocks.

A file row (page) holds whole documents in key order.  Its payload is

    uint32 ids, uint32 blocks, uint32 x blocks: byte start of each block
    per block: uint32 minimum, uint8 width, uint16 exceptions,
               packed low bits of (id - minimum), uint16 places and uint32
               values (id - minimum) of the exceptions

The width of a block is the one that a percentile of its values needs; the few
larger ones are its exceptions.  Any block can be opened by its start alone.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairforge.llm.common import raw_texts, slices, stored
from pairforge.llm.tokens import kept_encoder

BLOCK = 256
#: Share of a block's values that its width must hold.
PERCENTILE = 0.9
#: A page ends with the document that brings it to this many ids.
PAGE_IDS = 1 << 16

_HEAD = np.dtype([("low", "<u4"), ("width", "u1"), ("exceptions", "<u2")])


def pack(ids: np.ndarray, percentile: float = PERCENTILE) -> bytes:
    """Encode unsigned 32-bit ids; an empty array gives a payload without blocks."""
    blocks = -(-len(ids) // BLOCK)
    grid = np.empty(blocks * BLOCK, np.uint32)
    grid[: len(ids)] = ids
    grid[len(ids) :] = ids[-1] if len(ids) else 0
    grid = grid.reshape(blocks, BLOCK)
    low = grid.min(axis=1, initial=0xFFFFFFFF)
    grid = grid - low[:, None]
    typical = np.partition(grid, int(percentile * (BLOCK - 1)), axis=1)[:, int(percentile * (BLOCK - 1))] if blocks else low
    width = np.frexp(typical.astype(np.float64))[1].astype(np.uint8)  # bits of the value
    over = grid >> width.astype(np.uint64)[:, None] > 0
    bodies: list[bytes] = [b""] * blocks
    for w in np.unique(width):
        rows = np.flatnonzero(width == w)
        # the upper bits of an exception are in its list
        short = grid[rows].astype("<u2" if w <= 16 else "<u4")
        bits = np.unpackbits(short.view(np.uint8), axis=1, bitorder="little").reshape(len(rows), BLOCK, 8 * short.itemsize)
        packed, size = np.packbits(bits[:, :, :w].reshape(-1), bitorder="little").tobytes(), int(w) * BLOCK // 8
        for at, row in enumerate(rows.tolist()):
            bodies[row] = packed[at * size : (at + 1) * size]
    heads = np.zeros(blocks, _HEAD)
    heads["low"], heads["width"], heads["exceptions"] = low, width, over.sum(axis=1)
    head, step = heads.tobytes(), _HEAD.itemsize
    places = np.nonzero(over)[1].astype("<u2").tobytes()
    values = grid[over].astype("<u4").tobytes()
    last = np.cumsum(over.sum(axis=1)).tolist()
    out, e = [], 0
    for row, f in enumerate(last):
        out.append(head[row * step : (row + 1) * step] + bodies[row] + places[2 * e : 2 * f] + values[4 * e : 4 * f])
        e = f
    sizes = np.array([len(x) for x in out], np.int64)
    starts = 8 + 4 * blocks + np.concatenate([[0], np.cumsum(sizes)[:-1]]) if blocks else np.zeros(0)
    return np.array([len(ids), blocks], "<u4").tobytes() + starts.astype("<u4").tobytes() + b"".join(out)


def block_starts(payload: bytes) -> np.ndarray:
    return np.frombuffer(payload, "<u4", int(np.frombuffer(payload, "<u4", 1, 4)[0]), 8)


def _wide(bodies: np.ndarray, width: int) -> np.ndarray:
    """Values of packed blocks of one width: bytes of a block a row."""
    room = 16 if width <= 16 else 32
    bits = np.zeros((len(bodies), BLOCK, room), np.uint8)
    bits[:, :, :width] = np.unpackbits(bodies, axis=1, bitorder="little").reshape(len(bodies), BLOCK, width)
    return np.packbits(bits.reshape(len(bodies), -1), axis=1, bitorder="little").view(f"<u{room // 8}")


def open_blocks(payload: bytes, starts: np.ndarray) -> np.ndarray:
    """The ids of some blocks, a block a row (the last one of a payload is filled up)."""
    raw = np.frombuffer(payload, np.uint8)
    starts = np.asarray(starts, np.int64)
    heads = raw[starts[:, None] + np.arange(_HEAD.itemsize)].view(_HEAD).ravel()
    values = np.empty((len(starts), BLOCK), np.uint32)
    bodies = starts + _HEAD.itemsize
    sizes = heads["width"].astype(np.int64) * BLOCK // 8
    for width in np.unique(heads["width"]):
        rows = np.flatnonzero(heads["width"] == width)
        size = int(width) * BLOCK // 8
        values[rows] = _wide(raw[bodies[rows][:, None] + np.arange(size)], int(width)) if size else 0
    for row in np.flatnonzero(heads["exceptions"]):
        at, n = int(bodies[row] + sizes[row]), int(heads["exceptions"][row])
        values[row, np.frombuffer(payload, "<u2", n, at)] = np.frombuffer(payload, "<u4", n, at + 2 * n)
    return values + heads["low"].astype(np.uint32)[:, None]


def open_block(payload: bytes, start: int) -> np.ndarray:
    """The ids of one block (the last one of a payload is filled up)."""
    return open_blocks(payload, np.array([start]))[0]


def unpack(payload: bytes) -> np.ndarray:
    n = int(np.frombuffer(payload, "<u4", 1)[0])
    return open_blocks(payload, block_starts(payload)).ravel()[:n]


def write_token_blocks(documents: DataFrame, tokenizer: str, end_id: int = 0, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Encode every document, append ``end_id`` and write the pages.

    Documents are in ascending key order (null keys first; rows of equal keys by
    a hash of their text).  Null text is the end id alone.  The result is the
    written table: part, page, first (ids of the part before the page), keys,
    lengths, payload.
    """
    source = documents.select(F.col(key).cast("long").alias("k"), F.coalesce(F.col(text), F.lit("")).alias("t"))
    ordered = source.repartitionByRange("k", F.xxhash64("t")).sortWithinPartitions("k", F.xxhash64("t"))
    schema = "part int, page int, first long, keys array<long>, lengths array<long>, payload binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part = kept_encoder(tokenizer), TaskContext.get().partitionId()
        page, first, end = 0, 0, end_id.to_bytes(4, "little")
        keys: list[int | None] = []
        held: list[bytes] = []
        size = 0

        def written() -> pa.RecordBatch:
            ids = np.frombuffer(b"".join(held), "<u4")
            row = [[part], [page], [first], [list(keys)], [[len(x) // 4 for x in held]], [pack(ids)]]
            kinds = [pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(row, kinds, strict=True)], names=["part", "page", "first", "keys", "lengths", "payload"])

        for batch in slices(batches, "t", 1 << 22):
            for k, ids in zip(batch.column("k").to_pylist(), encoder.encode([t.decode() for t in raw_texts(batch.column("t"))]), strict=True):
                keys.append(k)
                held.append(ids + end)
                size += len(ids) // 4 + 1
                if size >= PAGE_IDS:
                    yield written()
                    page, first, size = page + 1, first + size, 0
                    keys.clear()
                    held.clear()
        if keys:
            yield written()

    return stored(ordered.mapInArrow(run, schema))


def read_token_blocks(pages: DataFrame, key: str = "doc_id", with_ids: bool = True) -> DataFrame:
    """One row per document, from the payloads: key, start (ids of all documents
    before it), n_tokens, ids_crc32 and, if asked for, ids (array of long).

    The totals of the parts, one number per file part, give where each begins.
    """
    totals = pages.select("part", F.expr("aggregate(lengths, 0L, (a, n) -> a + n)").alias("n")).groupBy("part").agg(F.sum("n").alias("n")).orderBy("part").collect()
    before, total = {}, 0
    for row in totals:
        before[row["part"]] = total
        total += row["n"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                part, first, keys, lengths, payload = (batch.column(c)[row].as_py() for c in ("part", "first", "keys", "lengths", "payload"))
                ids = unpack(payload).astype("<u4")
                ends = np.cumsum(np.array(lengths, np.int64))
                starts = ends - lengths
                crc = [zlib.crc32(ids[a:b].tobytes()) for a, b in zip(starts, ends, strict=True)]
                listed = [pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]), pa.int32()), pa.array(ids.astype(np.int64)))] if with_ids else []
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(keys, pa.int64()),
                        pa.array(starts + before[part] + first, pa.int64()),
                        pa.array(lengths, pa.int64()),
                        pa.array(crc, pa.int64()),
                        *listed,
                    ],
                    names=["k", "start", "n_tokens", "ids_crc32", "ids"][: 4 + with_ids],
                )

    opened = pages.select("part", "first", "keys", "lengths", "payload").mapInArrow(run, "k long, start long, n_tokens long, ids_crc32 long" + ", ids array<long>" * with_ids)
    return opened.withColumnRenamed("k", key)
