"""Hard-negative mining: segment summaries bound inner products, exact scores decide what is left."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ferrolith.session import settle

#: Lengths of the segments, coarse to fine; vectors are padded with zeros to a multiple of the first. The summaries
#: of all but the finest are stored with the vectors, those of the finest are made when a pair of blocks gets there.
SEGMENTS = (32, 8, 2)
#: Vectors and anchors of a block, pairs that are gathered at a time, and scores beyond this size count as it.
BLOCK_ROWS, BLOCK_ANCHORS, CHUNK, MOST = 1024, 256, 1 << 17, 1 << 56
BLOCK = "dim int, kind string, lo long, hi long, ids binary, labels binary, x binary, sums binary"


def summaries(x: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Mean and deviation of each segment of ``length`` components, both times the root of the length."""
    cut = x.reshape(len(x), -1, length)
    mean = cut.mean(axis=2)
    deviation = np.sqrt(((cut - mean[:, :, None]) ** 2).mean(axis=2))
    return mean * math.sqrt(length), deviation * math.sqrt(length)


def _padded(x: np.ndarray) -> np.ndarray:
    return np.pad(x.astype(float), ((0, 0), (0, max(1, -(-x.shape[1] // SEGMENTS[0])) * SEGMENTS[0] - x.shape[1])))


def _narrow(x: np.ndarray) -> np.ndarray:
    """Whether products of such rows are exact in double precision."""
    limit = math.isqrt((1 << 53) // max(1, x.shape[1]))
    return ((x <= limit) & (x >= -limit)).all(axis=1)


def _pack(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """Blocks of at most ``rows`` vectors of one length, side by side by label; vectors with huge components apart."""
    for batch in batches:
        ids, labels = (batch.column(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in (0, 1))
        lists = batch.column(2)
        sizes = lists.value_lengths().to_numpy(zero_copy_only=False)
        flat, ends = lists.flatten().to_numpy(zero_copy_only=False), np.cumsum(sizes)
        extra = [batch.column(k).to_pylist() for k in range(3, batch.num_columns)]
        for dim in np.unique(sizes):
            of = np.flatnonzero(sizes == dim)
            x = flat[(ends[of] - dim)[:, None] + np.arange(dim)].reshape(len(of), dim)
            narrow = _narrow(x)
            order = np.lexsort((ids[of], labels[of], ~narrow))
            edges = sorted({*range(0, int(narrow.sum()), rows), *range(int(narrow.sum()), len(of), rows), len(of)})
            for a, b in zip(edges, edges[1:], strict=False):
                pick = order[a:b]
                own = x[pick]
                kind = next(t for t in ("i1", "i2", "i4", "i8") if b > a and own.min(initial=0) >= np.iinfo(t).min and own.max(
                    initial=0) <= np.iinfo(t).max)
                padded = _padded(own)
                sums = np.concatenate([part for length in SEGMENTS[:-1] for part in summaries(padded, length)], axis=1)
                at = of[pick]
                columns = [int(dim), kind, int(labels[at].min()), int(labels[at].max()), ids[at].tobytes(), labels[at].tobytes(),
                           own.astype(kind).tobytes(), sums.astype("f4").tobytes()]
                names = [field.split()[0] for field in BLOCK.split(", ")]
                fields = dict(zip(names, columns, strict=True))
                for k, values in enumerate(extra):
                    fields[f"goal{k}"] = np.array([values[i] for i in at], np.int64).tobytes()
                yield pa.RecordBatch.from_pylist([fields], schema=pa.schema([
                    ("dim", pa.int32()), ("kind", pa.string()), ("lo", pa.int64()), ("hi", pa.int64()),
                    *((name, pa.binary()) for name in list(fields)[4:])]))


class Block:
    """Vectors of a packed row, with their summaries by level."""

    def __init__(self, row: dict, side: str):
        self.dim = row[f"{side}dim"]
        self.ids, self.labels = (np.frombuffer(row[side + name], np.int64) for name in ("ids", "labels"))
        n = len(self.ids)
        self.x = np.frombuffer(row[f"{side}x"], row[f"{side}kind"]).reshape(n, self.dim).astype(np.int64)
        self.exact = bool(_narrow(self.x).all())
        self.floats = _padded(self.x)
        self.norm = float(np.sqrt((self.floats**2).sum(axis=1)).max(initial=0.0))
        self.levels, place = [], 0
        stored = np.frombuffer(row[f"{side}sums"], "f4").reshape(n, -1).astype(float)
        for length in SEGMENTS[:-1]:
            count = self.floats.shape[1] // length
            self.levels.append((stored[:, place:place + count], stored[:, place + count:place + 2 * count]))
            place += 2 * count

    def level(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        if k == len(self.levels):
            self.levels.append(summaries(self.floats, SEGMENTS[-1]))
        return self.levels[k]


def _products(p: np.ndarray, q: np.ndarray, i: np.ndarray, j: np.ndarray, dense: bool) -> np.ndarray:
    """Products of the rows i of p and j of q, through the whole product where most pairs are asked for."""
    if dense:
        return (p @ q.T)[i, j]
    return np.concatenate([np.einsum("ij,ij->i", p[i[a:a + CHUNK]], q[j[a:a + CHUNK]]) for a in range(0, len(i), CHUNK)] or [np.empty(0)])


def scores(a: Block, b: Block, i: np.ndarray, j: np.ndarray, dense: bool) -> np.ndarray:
    """Exact inner products; beyond ``MOST`` they count as that."""
    if a.exact and b.exact:
        return np.clip(_products(a.floats, b.floats, i, j, dense).astype(np.int64), -MOST, MOST)
    wide = [sum(int(u) * int(v) for u, v in zip(a.x[k], b.x[m], strict=True)) for k, m in zip(i, j, strict=True)]
    return np.array([max(-MOST, min(MOST, s)) for s in wide], np.int64)


def refine(a: Block, b: Block, i: np.ndarray, j: np.ndarray, needed: Callable) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(i, j, score) of the pairs that no level rules out; ``needed(i, j, low, high)`` says which may still count.

    Product of means plus or minus product of deviations, summed over segments,
    encloses the inner product, level by level more closely.
    """
    slack = 1e-5 * a.norm * b.norm + 1.0  # the stored summaries are rounded to single precision
    for k in range(len(SEGMENTS)):
        if not len(i):
            break
        dense = 4 * len(i) > len(a.ids) * len(b.ids)
        (am, ad), (bm, bd) = a.level(k), b.level(k)
        middle, width = _products(am, bm, i, j, dense), _products(ad, bd, i, j, dense) + slack
        stay = needed(i, j, np.clip(middle - width, -MOST, MOST), np.clip(middle + width, -MOST, MOST))
        i, j = i[stay], j[stay]
    return i, j, scores(a, b, i, j, 4 * len(i) > len(a.ids) * len(b.ids))


class Best:
    """The ``most`` best (score, then smaller id) of each group so far."""

    def __init__(self, groups: int, most: int):
        self.groups, self.most = groups, most
        self.group, self.score, self.id = (np.empty(0, np.int64) for _ in range(3))
        self.last = np.full(groups, -MOST - 1, np.int64)  # score a newcomer must reach

    def add(self, group: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        if not len(group):
            return
        group, score, ids = (np.concatenate(x) for x in ((self.group, group), (self.score, score), (self.id, ids)))
        order = np.lexsort((ids, -score, group))
        sorted_group = group[order]
        first = np.searchsorted(sorted_group, sorted_group)
        rank = np.arange(len(order)) - first
        kept = order[rank < self.most]
        self.group, self.score, self.id = group[kept], score[kept], ids[kept]
        full = order[rank == self.most - 1]
        self.last[group[full]] = score[full]


def _meet(batches: Iterator[pa.RecordBatch], most: int, positives: int) -> Iterator[pa.RecordBatch]:
    """Best partners of the anchors among the blocks that follow one another with the same anchors.

    Without ``positives`` partners have the anchor's label, else another label
    and a score in the band below each of the anchor's positive scores.
    """
    anchors: Block | None = None
    best, goals, now = Best(0, most), np.empty((0, 1), np.int64), None

    def result() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([
            pa.array(anchors.ids[best.group // goals.shape[1]]), pa.array(best.group % goals.shape[1], pa.int32()), pa.array(best.id),
            pa.array(best.score)], names=["anchor_id", "goal", "other_id", "score"])

    for batch in batches:
        for k in range(batch.num_rows):
            row = batch.slice(k, 1).to_pylist()[0]
            if (row["a_block"], row["part"]) != now:
                if anchors is not None and len(best.group):
                    yield result()
                now, anchors = (row["a_block"], row["part"]), Block(row, "a_")
                goals = np.frombuffer(row["a_goal0"], np.int64).reshape(len(anchors.ids), positives) if positives else np.zeros(
                    (len(anchors.ids), 1), np.int64)
                best = Best(goals.size, most)
            others = Block(row, "b_")
            same = anchors.labels[:, None] == others.labels[None, :]
            i, j = np.nonzero(~same if positives else same & (anchors.ids[:, None] != others.ids[None, :]))
            if positives:
                least = np.maximum(-(-80 * goals // 100), best.last.reshape(goals.shape))

                def needed(i, j, low, high, least=least):
                    hit = np.zeros(len(i), bool)
                    for g in range(positives):
                        hit |= (high >= least[i, g]) & (low <= goals[i, g])
                    return hit

                i, j, score = refine(anchors, others, i, j, needed)
                for g in range(positives):
                    goal = goals[i, g]
                    inside = (80 * goal <= 100 * score) & (100 * score <= 100 * goal)
                    best.add(i[inside] * positives + g, score[inside], others.ids[j[inside]])
            else:
                i, j, score = refine(anchors, others, i, j, lambda i, j, low, high: high >= np.maximum(
                    best.last, _sure(i, low, most, len(anchors.ids)))[i])
                best.add(i, score, others.ids[j])
    if anchors is not None and len(best.group):
        yield result()


def _sure(group: np.ndarray, low: np.ndarray, most: int, groups: int) -> np.ndarray:
    """For each group the ``most``-th largest lower bound: at least that many partners score as much."""
    order = np.lexsort((-low, group))
    place = np.arange(len(order)) - np.searchsorted(group[order], group[order])
    out = np.full(groups, -float(MOST) - 1)
    at = order[place == most - 1]
    out[group[at]] = low[at]
    return out


def usable_vectors(rows: DataFrame, vec_id: str, vector: str, label: Column) -> DataFrame:
    """(id, label, x) of the rows that take part: x holds floor(256 * component), of several rows with one id the least."""
    plain = rows.select(F.col(vec_id).cast("long").alias("id"), label.cast("long").alias("label"), F.col(vector).cast("array<double>").alias("x"))
    finite = F.forall("x", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    whole = plain.filter("id is not null and label is not null and x is not null").filter(finite).withColumn(
        "x", F.transform("x", lambda c: F.floor(c * 256)))
    twice = whole.groupBy("id").agg(F.count("*").alias("n")).filter("n > 1").select("id")
    if twice.isEmpty():
        return whole
    least = whole.join(twice, "id", "left_semi").groupBy("id").agg(F.min(F.struct("label", "x")).alias("s")).select("id", "s.*")
    return whole.join(twice, "id", "left_anti").unionByName(least)


def _blocks(rows: DataFrame, size: int) -> DataFrame:
    """``rows`` (id, label, x, and the columns to carry) packed, with a number per block."""
    extra = "".join(f", goal{k} binary" for k in range(len(rows.columns) - 3))
    packed = rows.mapInArrow(lambda batches: _pack(batches, size), BLOCK + extra)
    return packed.withColumn("block", F.monotonically_increasing_id())


def _matches(anchors: DataFrame, vectors: DataFrame, parts: int, most: int, positives: int = 0) -> DataFrame:
    """(anchor_id, goal, other_id, score): per block of anchors and part of the vectors the best partners.

    Blocks of anchors are copied to each part; the vectors move once. Blocks
    that can't hold partners, by the range of their labels, don't meet. The
    planner judges the anchors by their size before they are copied, so it is
    told not to send all copies through the driver to all tasks.
    """
    theirs = vectors.select(F.pmod(F.xxhash64("block"), F.lit(parts)).alias("part"), *(F.col(c).alias(f"b_{c}") for c in vectors.columns if c != "block"))
    ours = anchors.select(F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"), *(F.col(c).alias(f"a_{c}") for c in anchors.columns))
    overlap = (F.col("a_lo") <= F.col("b_hi")) & (F.col("b_lo") <= F.col("a_hi"))
    apart = ~((F.col("a_lo") == F.col("b_hi")) & (F.col("b_lo") == F.col("a_hi")) & (F.col("a_lo") == F.col("b_lo")))
    left, right = ours.repartition(parts, "part").alias("l"), theirs.repartition(parts, "part").alias("r")
    met = left.join(right.hint("merge"), (F.col("l.part") == F.col("r.part")) & (F.col("a_dim") == F.col("b_dim")) & (apart if positives else overlap))
    return met.select("l.part", *(c for c in (*left.columns, *right.columns) if c != "part")).mapInArrow(
        lambda batches: _meet(batches, most, positives), "anchor_id long, goal int, other_id long, score long")


def _first(found: DataFrame, most: int) -> DataFrame:
    order = Window.partitionBy("anchor_id", "goal").orderBy(F.desc("score"), "other_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= most)


def hard_negatives(rows: DataFrame, anchor: Column, positives: int = 5, negatives: int = 5, vec_id: str = "vec_id",
                   vector: str = "embedding", label: Column | str = "label") -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``anchor`` says by the column ``id`` which rows are anchors; ``label`` may be
    an expression. Each component becomes floor(256 * x), and a score is the
    inner product of such vectors. An anchor's positives are its ``positives``
    best rows of its label; for each, the ``negatives`` best rows of other labels
    with 0.8 to 1 times the positive's score. Higher scores come first, ties by
    smaller id. All rows are compared with all anchors, block by block.

    Rows with a null id, label or vector, or a null or non-finite component take
    no part; of rows that share an id the least (label, vector) does. Vectors of
    different length don't meet. Components that leave 64 bits count as the
    nearest of them, scores beyond 2**56 as that. An anchor without positives or
    negatives has no row; without vectors there are none.
    """
    whole = settle(usable_vectors(rows, vec_id, vector, F.col(label) if isinstance(label, str) else label), "vectors")
    vectors = settle(_blocks(whole, BLOCK_ROWS), "blocks")
    chosen = settle(whole.filter(anchor), "anchors")
    n = chosen.count()
    heaps = max(1, -(-n // BLOCK_ANCHORS))
    # at most about 2**36 pairs a part, however many there are
    parts = max(2 * int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), n * whole.count() >> 36)
    near = _first(_matches(settle(_blocks(chosen.repartition(heaps), BLOCK_ANCHORS), "anchor-blocks"), vectors, parts, positives), positives)
    near = settle(near.select("anchor_id", F.col("rank").alias("place"), F.col("other_id").alias("positive_id"), F.col("score").alias("positive_score")), "positives")
    # a place without a positive gets a score below every other: its band is empty
    goals = near.groupBy("anchor_id").agg(F.map_from_entries(F.collect_list(F.struct("place", "positive_score"))).alias("m")).select(
        F.col("anchor_id").alias("id"), F.transform(F.sequence(F.lit(1), F.lit(positives)), lambda k: F.coalesce(
            F.try_element_at("m", k), F.lit(-MOST))).alias("goals"))
    aimed = settle(_blocks(chosen.join(goals.hint("merge"), "id").repartition(heaps), BLOCK_ANCHORS), "aimed")
    far = _first(_matches(aimed, vectors, parts, negatives, positives), negatives).withColumn("place", F.col("goal") + 1)
    return far.join(near, ["anchor_id", "place"]).select(
        "anchor_id", "positive_id", "rank", F.col("other_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))


SQL = """
WITH v AS (SELECT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS x FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x)))),
s AS (SELECT a.id AS anchor_id, o.id AS other_id, a.label = o.label AS same, list_dot_product(a.x, o.x)::BIGINT AS score
  FROM v a JOIN v o ON a.id % 100 = 0 AND a.id <> o.id),
p AS (SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5),
r AS (SELECT p.*, s.other_id AS negative_id, s.score AS negative_score,
    row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.other_id)::INT AS rank
  FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same AND 80 * p.positive_score <= 100 * s.score AND s.score <= p.positive_score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM r WHERE rank <= 5
"""
