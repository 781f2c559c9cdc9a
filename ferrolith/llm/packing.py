"""Best-fit packing planned on the histogram of piece lengths."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ferrolith.llm.encoder import piece_encoder
from ferrolith.llm.workers import frugal
from ferrolith.session import settle

PIECES = "doc_id long, piece int, start long, length long, ids binary"
#: Each task numbers its full pieces in a range of this many sequence ids.
TASK_RANGE = 1 << 40


def token_pieces(docs: DataFrame, tokenizer: str, end_id: int, capacity: int, doc_id: str = "doc_id", text: str = "text",
                 keep: bool = True) -> DataFrame:
    """(doc_id, piece, start, length, ids): whole texts as ids, cut only when longer than ``capacity``.

    A null text is empty (one piece with the end id); the first piece of a cut
    document takes the remainder. ``ids`` are little-endian unsigned 32-bit
    values as binary. A null ``doc_id`` and repeated rows are kept as they are.
    With ``keep`` a worker's store of known pieces serves its later tasks;
    without, it is emptied after each task.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, end = piece_encoder(tokenizer), np.array([end_id], "<u4").tobytes()
        for part in batches:
            rows = []
            encoded = encoder.encode_all([t or "" for t in part.column(1).to_pylist()])
            for number, raw in zip(part.column(0).to_pylist(), encoded, strict=True):
                raw += end
                n = len(raw) // 4
                cuts = [0, *range(n % capacity or capacity, n + 1, capacity)]
                rows += [(number, k, a, b - a, raw[4 * a:4 * b]) for k, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False))]
            columns = list(zip(*rows, strict=True))
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                                             names=["doc_id", "piece", "start", "length", "ids"])
        if not keep:
            encoder.empty()

    return docs.select(F.col(doc_id).cast("long"), F.col(text)).mapInArrow(frugal(cut), PIECES)


def plan_slots(counts: dict[int, int], capacity: int) -> np.ndarray:
    """Best fit over counts: rows (length, first rank, pieces, first sequence, offset).

    Lengths go from long to short. Sequences with the same room are one group, so
    a length is placed group by group, the tightest first; a group splits at most
    once for each length. The work depends on ``capacity`` alone, not on counts.
    """
    room: dict[int, list[tuple[int, int]]] = {}  # room left -> runs of sequences (first, how many)
    slots: list[tuple[int, int, int, int, int]] = []
    opened = 0
    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        while left:
            fit = next((r for r in range(length, capacity) if room.get(r)), None)
            if fit is None:
                each = capacity // length  # of these a new sequence takes so many
                fresh = left // each if left >= each else 1
                takes = [each] * 1 if left >= each else [left]
                for k in range(takes[0]):
                    slots.append((length, rank + k * fresh, fresh, opened, k * length))
                placed = fresh * takes[0]
                room.setdefault(capacity - takes[0] * length, []).append((opened, fresh))
                opened += fresh
            else:
                first, many = room[fit].pop()
                placed = min(many, left)
                if placed < many:
                    room[fit].append((first + placed, many - placed))
                slots.append((length, rank, placed, first, capacity - fit))
                room.setdefault(fit - length, []).append((first, placed))
            rank += placed
            left -= placed
    return np.array(slots, np.int64).reshape(-1, 5)


def pack(pieces: DataFrame, capacity: int, length: str = "length") -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``: gapless sequences of at most ``capacity``.

    Every length must be from 1 to ``capacity``. A full piece is a sequence by itself;
    it is numbered from -1 down, by write task. For the rest a task counts its pieces of each
    length while it reads, the counts are summed over tasks, best fit is planned on
    the total counts (at most ``capacity - 1`` numbers, the only thing the driver
    sees), and each piece takes the slot of its rank within its length. Ties take
    ranks in reading order. All columns are kept; an empty table stays empty.
    """
    columns = pieces.columns

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, seen = TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64)
        for batch in batches:
            lengths = batch.column(batch.schema.get_field_index(length)).to_numpy()
            order = np.argsort(lengths, kind="stable")
            kinds, first, many = np.unique(lengths[order], return_index=True, return_counts=True)
            rank = np.empty(len(lengths), np.int64)
            rank[order] = np.arange(len(lengths)) - np.repeat(first, many) + np.repeat(seen[kinds], many)
            seen[kinds] += many
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(np.full(len(lengths), task), pa.int64()), pa.array(rank)],
                names=[*columns, "_task", "_rank"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema)
    numbered = settle(pieces.mapInArrow(number, f"{kinds}, _task long, _rank long"), "packing")
    full = numbered.filter(F.col(length) == capacity).select(
        *columns, (-1 - F.col("_task") * TASK_RANGE - F.col("_rank")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    rest = numbered.filter(F.col(length) < capacity)

    by_task = rest.groupBy("_task", length).agg(F.count("*").alias("_n"))
    before = by_task.select("_task", length, (
        F.sum("_n").over(Window.partitionBy(length).orderBy("_task")) - F.col("_n")).alias("_before"))
    counts = {r[length]: r["n"] for r in rest.groupBy(length).agg(F.count("*").alias("n")).collect()}
    slots = plan_slots(counts, capacity)
    plan = pieces.sparkSession.sparkContext.broadcast(slots[np.lexsort((slots[:, 1], slots[:, 0]))])

    def take(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = plan.value
        keys = (table[:, 0].astype(np.uint64) << np.uint64(48)) + table[:, 1].astype(np.uint64)
        for batch in batches:
            lengths, rank = (batch.column(batch.schema.get_field_index(c)).to_numpy() for c in (length, "_rank"))
            at = np.searchsorted(keys, (lengths.astype(np.uint64) << np.uint64(48)) + rank.astype(np.uint64), "right") - 1
            slot = table[at]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(batch.schema.get_field_index(c)) for c in columns),
                 pa.array(slot[:, 3] + rank - slot[:, 1]), pa.array(slot[:, 4])], names=[*columns, "sequence_id", "offset"])

    ranked = rest.join(before, ["_task", length]).select(
        *columns, (F.col("_rank") + F.col("_before")).alias("_rank"))
    return full.unionByName(ranked.mapInArrow(take, f"{kinds}, sequence_id long, offset long"))
