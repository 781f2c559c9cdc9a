"""Token ids in binary segments of patched frame-of-reference blocks.

A file set is a Parquet folder; every row is one segment with the columns
``shard`` (write task, in key order), ``segment`` (place in the shard), ``first``
(ids of the shard before it), ``n_docs``, ``n_ids`` and ``payload``. A payload is self-contained, little endian:

    magic "PFR1", block size u32, documents u32, ids u64, blocks u32
    document numbers i64[], 1 for a null number u8[], ids per document u64[]
    block starts u64[] (byte place of each block after this header)
    blocks: minimum u32, width u8, exceptions u16, packed differences,
            places u8[] and high bits u32[] of the exceptions

A block holds up to 128 ids across document ends: the block minimum is taken off,
the width fits the chosen percentile of the differences, and the bits above the
width of the few larger ones are stored as exceptions.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ferrolith.llm.encoder import TEXTS, piece_encoder

MAGIC = b"PFR1"
BLOCK = 128
HEAD = struct.Struct("<4sIIQI")
BLOCK_HEAD = np.dtype([("low", "<u4"), ("width", "u1"), ("more", "<u2")])


def _pack(values: np.ndarray, width: int) -> np.ndarray:
    """(blocks, 128) values of ``width`` bits to (blocks, 2 * width) words."""
    words = np.zeros((len(values), 2 * width), np.uint64)
    for k in range(BLOCK):
        word, shift = divmod(k * width, 64)
        words[:, word] |= values[:, k] << np.uint64(shift)
        if shift + width > 64:
            words[:, word + 1] |= values[:, k] >> np.uint64(64 - shift)
    return words


def _unpack(words: np.ndarray, width: int) -> np.ndarray:
    mask = np.uint64((1 << width) - 1)
    values = np.zeros((len(words), BLOCK), np.uint64)
    for k in range(BLOCK):
        word, shift = divmod(k * width, 64)
        x = words[:, word] >> np.uint64(shift)
        if shift + width > 64:
            x = x | (words[:, word + 1] << np.uint64(64 - shift))
        values[:, k] = x & mask
    return values


def _bits(values: np.ndarray) -> np.ndarray:
    """Bits that each value needs (0 for 0); exact, as values stay below 2**32."""
    return np.frexp(values.astype(np.float64))[1].astype(np.int64)


def encode_blocks(ids: np.ndarray, percentile: float = 0.9) -> tuple[np.ndarray, bytes]:
    """(place of each block, bytes of all blocks). The last block is filled with its minimum."""
    n = -(-len(ids) // BLOCK)
    if not n:
        return np.zeros(0, np.uint64), b""
    grid = np.full(n * BLOCK, ids[(n - 1) * BLOCK:].min(), np.uint64)
    grid[:len(ids)] = ids
    grid = grid.reshape(n, BLOCK)
    low = grid.min(axis=1)
    grid -= low[:, None]
    rank = min(BLOCK - 1, int(np.ceil(percentile * BLOCK)) - 1)
    width = _bits(np.partition(grid, rank, axis=1)[:, rank])
    high = grid >> width[:, None].astype(np.uint64)
    over = high > 0
    more = over.sum(axis=1)
    heads = np.zeros(n, BLOCK_HEAD)
    heads["low"], heads["width"], heads["more"] = low, width, more
    sizes = BLOCK_HEAD.itemsize + 16 * width + 5 * more
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]]).astype(np.uint64)
    packed: list[bytes] = [b""] * n
    for w in np.unique(width[width > 0]).tolist():
        at = np.flatnonzero(width == w)
        raw, step = _pack(grid[at] & np.uint64((1 << w) - 1), w).tobytes(), 16 * w
        for j, k in enumerate(at.tolist()):
            packed[k] = raw[j * step:(j + 1) * step]
    places = np.nonzero(over)[1].astype(np.uint8).tobytes()
    highs = high[over].astype("<u4").tobytes()
    raw_heads, size, out, e = heads.tobytes(), BLOCK_HEAD.itemsize, [], 0
    for k, m in enumerate(more.tolist()):
        out += (raw_heads[k * size:(k + 1) * size], packed[k], places[e:e + m], highs[4 * e:4 * (e + m)])
        e += m
    return starts, b"".join(out)


def decode_blocks(starts: np.ndarray, data: bytes, n_ids: int) -> np.ndarray:
    """The ids of consecutive blocks; blocks can be read from any entry of the index."""
    n, size = len(starts), BLOCK_HEAD.itemsize
    raw = np.frombuffer(data, np.uint8)
    at = starts.astype(np.int64)
    heads = raw[at[:, None] + np.arange(size)].reshape(-1).view(BLOCK_HEAD) if n else np.zeros(0, BLOCK_HEAD)
    width, more = heads["width"].astype(np.int64), heads["more"].astype(np.int64)
    grid = np.zeros((n, BLOCK), np.uint64)
    for w in np.unique(width[width > 0]).tolist():
        k = np.flatnonzero(width == w)
        words = raw[at[k][:, None] + size + np.arange(16 * w)].reshape(-1).view("<u8").reshape(len(k), 2 * w)
        grid[k] = _unpack(words, w)
    k = np.repeat(np.arange(n), more)
    if len(k):
        turn = np.arange(len(k)) - np.repeat(np.cumsum(more) - more, more)
        base = at[k] + size + 16 * width[k]
        place = raw[base + turn]
        high = raw[(base + more[k] + 4 * turn)[:, None] + np.arange(4)].reshape(-1).view("<u4").astype(np.uint64)
        grid[k, place] |= high << width[k].astype(np.uint64)
    grid += heads["low"].astype(np.uint64)[:, None]
    return grid.reshape(-1)[:n_ids].astype("<u4")


def encode_segment(numbers: list[int | None], pieces: list[bytes], percentile: float = 0.9) -> bytes:
    """One payload of whole documents."""
    ids = np.frombuffer(b"".join(pieces), "<u4")
    starts, blocks = encode_blocks(ids, percentile)
    return b"".join([
        HEAD.pack(MAGIC, BLOCK, len(numbers), len(ids), len(starts)),
        np.array([x or 0 for x in numbers], "<i8").tobytes(), bytes(x is None for x in numbers),
        np.array([len(p) // 4 for p in pieces], "<u8").tobytes(), starts.astype("<u8").tobytes(), blocks])


def decode_segment(payload: bytes) -> tuple[list[int | None], np.ndarray, np.ndarray]:
    """(document numbers, ids per document, all ids)."""
    magic, block, docs, n_ids, blocks = HEAD.unpack_from(payload)
    if magic != MAGIC or block != BLOCK:
        raise ValueError("not a token segment of this format")
    at = HEAD.size
    numbers = np.frombuffer(payload, "<i8", docs, at).tolist()
    missing = np.frombuffer(payload, np.uint8, docs, at := at + 8 * docs)
    counts = np.frombuffer(payload, "<u8", docs, at := at + docs).astype(np.int64)
    starts = np.frombuffer(payload, "<u8", blocks, at := at + 8 * docs)
    return ([None if m else x for x, m in zip(numbers, missing, strict=True)], counts,
            decode_blocks(starts, payload[at + 8 * blocks:], n_ids))


SEGMENTS = "shard int, segment int, first long, n_docs long, n_ids long, payload binary"


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end_id: int, doc_id: str = "doc_id", text: str = "text",
                 percentile: float = 0.9, segment_ids: int = 1 << 18) -> None:
    """Encode whole texts and write them in ascending ``doc_id`` order to the folder ``path``.

    A null text is empty; every document gets ``end_id``. A null ``doc_id``
    comes first; rows with the same number follow each other, ordered by text.
    An empty table writes an empty folder. Other columns are not read. The order
    is a range partitioning: each task sorts its range and packs segments of
    about ``segment_ids`` ids (whole documents) while the rows stream by.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, segment = TaskContext.get().partitionId(), 0
        encoder, end = piece_encoder(tokenizer), np.array([end_id], "<u4").tobytes()
        numbers: list[int | None] = []
        pieces: list[bytes] = []
        held = first = 0

        def flush():
            return pa.RecordBatch.from_arrays([
                pa.array([shard], pa.int32()), pa.array([segment], pa.int32()), pa.array([first], pa.int64()),
                pa.array([len(numbers)], pa.int64()), pa.array([held], pa.int64()),
                pa.array([encode_segment(numbers, pieces, percentile)], pa.binary()),
            ], names=["shard", "segment", "first", "n_docs", "n_ids", "payload"])

        for batch in batches:
            for i in range(0, batch.num_rows, TEXTS):
                part = batch.slice(i, TEXTS)
                encoded = encoder.encode_all([t or "" for t in part.column(1).to_pylist()])
                for number, ids in zip(part.column(0).to_pylist(), encoded, strict=True):
                    numbers.append(number)
                    pieces.append(ids + end)
                    held += len(ids) // 4 + 1
                    if held >= segment_ids:
                        yield flush()
                        numbers, pieces, held, first, segment = [], [], 0, first + held, segment + 1
        if numbers:
            yield flush()

    ordered = (docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
               .repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text"))
    ordered.mapInArrow(encode, SEGMENTS).write.parquet(path)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids) of every document of a token folder.

    ``start`` counts the ids of all documents before it; ``ids`` are the
    little-endian unsigned 32-bit values as binary. Only the totals of the write
    tasks, one row each, are running-summed and broadcast.
    """
    segments = spark.read.schema(SEGMENTS).parquet(path)
    shards = segments.groupBy("shard").agg(F.sum("n_ids").alias("_ids"))
    before = shards.select("shard", (F.sum("_ids").over(Window.orderBy("shard")) - F.col("_ids")).alias("_before"))

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for payload, first in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
                numbers, counts, ids = decode_segment(payload.as_py())
                ends = np.cumsum(counts)
                raw = ids.tobytes()
                yield pa.RecordBatch.from_arrays([
                    pa.array(numbers, pa.int64()), pa.array(first + ends - counts, pa.int64()), pa.array(counts, pa.int64()),
                    pa.array([raw[4 * (e - c):4 * e] for e, c in zip(ends.tolist(), counts.tolist(), strict=True)], pa.binary()),
                ], names=["doc_id", "start", "n_tokens", "ids"])

    return segments.join(F.broadcast(before), "shard").select(
        "payload", (F.col("_before") + F.col("first")).alias("_start")).mapInArrow(
        decode, "doc_id long, start long, n_tokens long, ids binary")
