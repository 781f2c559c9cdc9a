"""Near-duplicate vectors by a forest of random-projection trees with spill overlap.

Each tree projects on a subspace of its own; the subspaces are orthogonal and
fill the space. Linked vectors are at most ``reach`` apart, so in one of the
``t`` subspaces they are at most ``reach / sqrt(t)`` apart, and there no
direction parts them further. With half of that as the half width of the overlap
they meet in a leaf of that tree: no link is lost.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ferrolith.operators.components import connected_components
from ferrolith.session import settle

#: Defaults: trees, and most distinct vectors of a leaf that is not split further.
TREES, LEAF = 8, 2048
#: A node is cut only if the pairs of both sides, overlap included, are at most this share of its own.
WORTH = 0.9
#: Added to the half width of the overlap for rounding.
SLACK = 1e-7
#: Vectors of a leaf that meet in one task; larger leaves are compared block by block.
BLOCK = 2048


def _unit_vectors(rows: DataFrame, vec_id: str, vector: str, label: str) -> DataFrame:
    """(label, v, id, n, ids) of distinct comparable vectors: smallest id, number and ids of the rows that share it.

    ``v`` holds the bytes of the components in double precision, scaled by the
    largest of them, so that neither huge nor tiny ones leave the range of double.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(2)
            values = lists.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)  # a null component reads as nan
            ends = np.cumsum([0, *lists.value_lengths().fill_null(0).to_pylist()])
            out: list[bytes | None] = []
            for a, b in zip(ends, ends[1:], strict=False):
                x = values[a:b]
                top = np.abs(x).max(initial=0.0)
                # adding 0 turns -0 into 0, so that equal vectors have equal bytes
                out.append((x / top + 0.0).tobytes() if top > 0 and np.isfinite(x).all() else None)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.binary())], names=["id", "label", "v"])

    plain = rows.select(F.col(vec_id).cast("long").alias("id"), F.col(label).alias("label"), F.col(vector).cast("array<double>").alias("v"))
    kind = plain.schema["label"].dataType.simpleString()
    scaled = plain.filter("id is not null and label is not null and v is not null").mapInArrow(
        run, f"id long, label {kind}, v binary").filter("v is not null")
    return scaled.groupBy("label", "v").agg(F.min("id").alias("id"), F.count("*").alias("n"), F.collect_list("id").alias("ids"))


def _directions(length: int, trees: int, depth: int, seed: int) -> np.ndarray:
    """Unit directions (tree, depth, component): those of a tree lie in its subspace, which is orthogonal to all others.

    Vectors shorter than the number of trees have one tree a component.
    """
    rng = np.random.default_rng([seed, length])
    axes, _ = np.linalg.qr(rng.normal(size=(length, length)))
    mixed = [rng.normal(size=(depth, len(part))) @ part for part in np.array_split(axes.T, min(trees, length))]
    return np.stack([d / np.linalg.norm(d, axis=1, keepdims=True) for d in mixed])


def _projections(vectors: DataFrame, trees: int, depth: int, seed: int) -> DataFrame:
    """``vectors`` with ``unit`` and ``p``: for each tree the projections on its random direction of each depth."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        directions: dict[int, np.ndarray] = {}
        for batch in batches:
            values = batch.column(0)
            units, out = [], []
            for v in values:
                x = np.frombuffer(v.as_py(), float).copy()
                x /= np.linalg.norm(x)
                if len(x) not in directions:
                    directions[len(x)] = _directions(len(x), trees, depth, seed)
                units.append(x)
                out.append((directions[len(x)] @ x).tolist())
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(units, pa.list_(pa.float64())), pa.array(
                out, pa.list_(pa.list_(pa.float64())))], names=["id", "label", "n", "unit", "p"])

    kind = vectors.schema["label"].dataType.simpleString()
    return vectors.select("v", "id", "label", "n").mapInArrow(
        run, f"id long, label {kind}, n long, unit array<double>, p array<array<double>>")


def _grow(points: DataFrame, depth: int, leaf: int, reach: float) -> DataFrame:
    """(id, leaf): the leaves of each vector in all trees.

    One level of all trees at a time: a node with more than ``leaf`` vectors is
    cut along the level's direction, at the twentieth that leaves the fewest pairs
    on both sides, and vectors within the half width of the overlap go to both. A
    node too dense to be cut is a leaf. Up to ``leaf`` vectors a tree stay one leaf
    of a single tree: the leaves of all trees would hold more pairs.
    """
    placed = points.select("id", F.xxhash64("label", F.size("unit")).alias("root"), "p")
    small = placed.groupBy("root").agg((F.count("*") <= leaf * F.max(F.size("p"))).alias("small"))
    grown = placed.join(small, "root").withColumn("half", F.lit(reach / 2) / F.sqrt(F.size("p")) + SLACK)
    spread = grown.select("id", "root", "small", "half", F.posexplode(F.when(F.col("small"), F.slice("p", 1, 1)).otherwise(F.col("p"))).alias("tree", "p"))
    nodes = settle(spread.select("id", F.xxhash64("root", "tree").alias("node"), "p", "half", "small"), "nodes")
    leaves = None
    grid = [k / 20 for k in range(1, 20)]
    q, half = F.col("q"), F.col("half")
    share = lambda inside: F.least(F.lit(1.0), (F.size(F.filter(q, inside)) + 1) / (len(grid) + 1))
    pairs = lambda cut: F.pow(share(lambda x: x <= cut + half), 2.0) + F.pow(share(lambda x: x >= cut - half), 2.0)
    for level in range(depth):
        at = F.get("p", F.lit(level))
        cuts = nodes.groupBy("node").agg(
            F.count("*").alias("n"), F.max("half").alias("half"), F.max("small").alias("small"), F.percentile_approx(at, grid, 1000).alias("q")).withColumn(
            "best", F.array_min(F.transform("q", lambda x: F.struct(pairs(x).alias("pairs"), x.alias("cut")))))
        open_ = (F.col("n") > leaf) & (F.col("best.pairs") <= WORTH) & ~F.col("small")
        placed = nodes.join(cuts.select("node", open_.alias("open"), F.col("best.cut").alias("cut")), "node")
        ended = placed.filter(~F.col("open")).select("id", F.col("node").alias("leaf"))
        leaves = ended if leaves is None else leaves.unionByName(ended)
        sides = F.filter(F.array(F.when(at <= F.col("cut") + half, 0), F.when(at >= F.col("cut") - half, 1)), lambda s: s.isNotNull())
        nodes = settle(placed.filter("open").select("id", "p", "half", "small", "node", F.explode(sides).alias("side")).select(
            "id", F.xxhash64("node", F.lit(level), "side").alias("node"), "p", "half", "small"), "nodes")
        if nodes.isEmpty():
            return leaves
    return leaves.unionByName(nodes.select("id", F.col("node").alias("leaf")))


def _compare(members: DataFrame, least: float) -> DataFrame:
    """(id, n_links, low): per block of a leaf, the rows linked to each vector and the smallest id its links connect it to.

    A pair counts in the smallest leaf that both vectors share, so meeting in
    several trees counts once. Nothing is listed by pairs: (id, low) connect
    just what the links of the block do. The smallest neighbour alone would not,
    as a vector without a smaller neighbour would leave its links out.
    """
    sizes = members.groupBy("leaf").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    dealt = members.join(sizes, "leaf").withColumn("block", F.pmod(F.xxhash64("id", "leaf"), F.col("blocks")).cast("int"))
    met = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "leaf", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "id", "n", "unit", "leaves")

    def links(rows: pd.DataFrame) -> pd.DataFrame:
        i, j, leaf = int(rows["i"].iloc[0]), int(rows["j"].iloc[0]), rows["leaf"].iloc[0]
        rows = rows.sort_values("id", ignore_index=True)
        first = rows[rows["block"] == i]
        second = rows[rows["block"] == j] if j != i else first
        ids = rows["id"].to_numpy()
        unit = np.stack(rows["unit"].to_numpy())
        width = max(map(len, rows["leaves"]))
        shared = np.stack([np.pad(np.array(x, np.int64), (0, width - len(x)), mode="edge") for x in rows["leaves"]])
        count, home = np.zeros(len(rows), np.int64), np.arange(len(rows))
        weight = rows["n"].to_numpy()
        at2 = second.index.to_numpy()
        at1 = first.index.to_numpy()
        for k, row in ((k, row) for at in np.array_split(at1, len(at1) // 256 + 1) for k, row in zip(at, unit[at] @ unit[at2].T, strict=True)):
            close = np.flatnonzero(row >= least - 1e-9)
            near, dot = at2[close], row[close]
            if j == i:
                near, dot = near[near > k], dot[near > k]
            if not len(near):
                continue
            near = near[[d > least + 1e-9 or float(np.dot(unit[k], unit[x])) >= least for d, x in zip(dot, near, strict=True)]]
            common = np.isin(shared[near], shared[k])
            smallest = np.where(common, shared[near], np.iinfo(np.int64).max).min(axis=1) if len(near) else near
            near = near[smallest == leaf]
            count[k] += weight[near].sum()
            count[near] += weight[k]
            homes = np.unique(np.append(home[near], home[k]))
            if len(homes) > 1:
                home[np.isin(home, homes)] = homes[0]
        some = count > 0
        return pd.DataFrame({"id": ids[some], "n_links": count[some], "low": ids[home[some]]})

    return met.groupBy("leaf", "i", "j").applyInPandas(links, "id long, n_links long, low long")


def near_vectors(rows: DataFrame, least: float = 0.98, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label",
                 trees: int = TREES, leaf: int = LEAF, seed: int = 7) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row.

    Vectors with equal, not null labels whose cosine is ``least`` or more are
    linked, none below is: they share a leaf of some tree. Vectors that are
    null, zero, or hold null or non-finite components, and rows without label,
    link with nothing; neither do vectors of different length. Equal vectors (up
    to a factor that leaves their scaled components equal) are one point with a
    weight: they count as links but are never compared. Repeated ids count as
    vectors of their own and share a component. A null id has no component.
    """
    reach = float(np.sqrt(max(0.0, 2 - 2 * least)))
    points = settle(_unit_vectors(rows, vec_id, vector, label), "vectors")
    most = points.groupBy("label").agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 0
    depth = max(1, int(np.ceil(np.log2(max(2, most) / leaf) * 1.6)) + 2) if most > leaf else 1
    units = settle(_projections(points, trees, depth, seed), "units")
    leaves = settle(_grow(units, depth, leaf, reach), "leaves")
    lists = leaves.groupBy("id").agg(F.sort_array(F.collect_set("leaf")).alias("leaves"))
    members = leaves.distinct().join(units.select("id", "n", "unit"), "id").join(lists, "id")
    found = settle(_compare(members, least), "links")
    copies = points.select("id", F.explode("ids").alias("_copy"), "n")
    counts = found.groupBy("id").agg(F.sum("n_links").alias("n_links"))
    edges = found.filter("low < id").select(F.col("id").alias("a"), F.col("low").alias("b")).unionByName(
        copies.filter("id != _copy").select(F.col("_copy").alias("a"), F.col("id").alias("b")))
    nodes = rows.select(F.col(vec_id).cast("long").alias("node")).filter("node is not null").distinct()
    groups = connected_components(nodes, edges)
    linked = copies.join(counts, "id", "left").groupBy("_copy").agg(
        F.sum(F.coalesce("n_links", F.lit(0)) + F.col("n") - 1).alias("n_links"))
    return rows.select(F.col(vec_id).cast("long").alias("vec_id")).join(linked.withColumnRenamed("_copy", "vec_id"), "vec_id", "left").join(
        groups.select(F.col("node").alias("vec_id"), F.col("component").alias("component_id")), "vec_id", "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), "component_id",
        (F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True))).alias("kept"))
