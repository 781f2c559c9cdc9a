"""Density clustering of points in the plane or on the globe.

Points are put in cubic cells whose diagonal is ``eps``: points of one cell
are always neighbours, so a cell with enough rows needs no pairs at all.
Cells are compared through their bounding boxes. A pair of boxes that is
surely near or surely far is settled at once; otherwise both boxes are cut
in half along each axis and compared again, until few enough points are left
to look at one by one. Results are exact and no task ever lists all pairs of
a dense area.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ferrolith.operators.components import connected_components
from ferrolith.session import settle

MAX_DEPTH = 40
EARTH_KM = 6371.0088


def dbscan(points: DataFrame, row_id: str, x: str, y: str, eps: float, min_points: int, budget: int = 4096) -> DataFrame:
    """(``row_id``, ``cluster``, ``kind``): kind is core, border or noise; noise has cluster -1.

    A point is core when at least ``min_points`` rows, itself included, lie
    within ``eps``. A cluster is named by its smallest core row id; a border
    point goes to the smallest cluster it touches. Rows without a position
    are noise. ``budget`` is the number of point pairs two boxes may have
    before they are cut further.
    """
    return _clusters(points, row_id, {"x": F.col(x).cast("double"), "y": F.col(y).cast("double")}, eps, min_points, budget)


def dbscan_globe(points: DataFrame, row_id: str, lat: str, lon: str, eps_km: float, min_points: int, budget: int = 4096) -> DataFrame:
    """The same by great-circle distance in kilometres between degrees of latitude and longitude.

    Positions become points in space, where the straight distance grows with
    the one along the surface: nothing special happens at the poles, at the
    date line, or for longitudes a full turn apart. Latitudes beyond 90 degrees
    are no position.
    """
    north, east = F.radians(F.col(lat).cast("double")), F.radians(F.col(lon).cast("double"))
    valid = F.abs(F.col(lat).cast("double")) <= 90
    axes = {"x": F.cos(north) * F.cos(east), "y": F.cos(north) * F.sin(east), "z": F.sin(north)}
    chord = 2 * math.sin(min(eps_km / EARTH_KM, math.pi) / 2)
    return _clusters(points, row_id, {a: F.when(valid, F.round(v, 12)) for a, v in axes.items()}, chord, min_points, budget)


def _clusters(points: DataFrame, row_id: str, axes: dict[str, Column], eps: float, min_points: int, budget: int) -> DataFrame:
    """Clustering by straight distance along any number of axes."""
    names_of = list(axes)
    cell = _cell(names_of)
    side = eps / len(axes)**0.5 * (1 - 1e-9)
    positions = points.select(F.col(row_id).alias("row_id"), *[v.alias(a) for a, v in axes.items()])
    placed = positions.dropna(subset=names_of)
    places = placed.groupBy(*names_of).agg(F.count("*").alias("n"), F.min("row_id").alias("first_id"))
    places = settle(places.withColumns({f"c{a}": F.floor(F.col(a) / side) for a in names_of}).withColumns(
        {f"f{a}": F.col(a) / side - F.col(f"c{a}") for a in names_of}))

    weights = places.groupBy(*cell).agg(F.sum("n").alias("weight"))
    sized = places.join(weights, cell)
    sparse = sized.filter(F.col("weight") < min_points)
    reach = _reach(sparse, places, names_of, eps, budget)
    near = reach.groupBy(*_probe(names_of)).agg(F.sum("near").alias("near")).select(*[F.col(f"p{a}").alias(a) for a in names_of], "near")
    lone_core = sparse.join(near, names_of, "left").filter(F.col("weight") + F.coalesce("near", F.lit(0)) >= min_points)
    kept = places.columns
    core = settle(sized.filter(F.col("weight") >= min_points).select(*kept).unionByName(lone_core.select(*kept)))

    cells = core.groupBy(*cell).agg(F.min("first_id").alias("first_id")).withColumn("node", F.struct(*cell))
    linked = connected_components(cells, _cell_links(core, names_of, eps, budget))
    named = linked.join(cells.select("node", "first_id", *cell), "node")
    names = named.groupBy("component").agg(F.min("first_id").alias("cluster"))
    cell_names = settle(named.join(names, "component").select(*cell, "cluster"))

    core_places = core.join(cell_names, cell).select(*names_of, "cluster", F.lit("core").alias("kind"))
    others = sparse.join(core.select(*names_of), names_of, "left_anti")
    touched = _reach(others, core, names_of, eps, budget).filter(F.col("near") > 0).select(
        *[F.col(f"p{a}").alias(a) for a in names_of], *cell)
    at_home = others.select(*names_of, *cell)  # core points of the own cell are always in reach
    border = touched.unionByName(at_home).join(cell_names, cell).groupBy(*names_of).agg(
        F.min("cluster").alias("cluster")).withColumn("kind", F.lit("border"))
    labels = core_places.unionByName(border)
    found = placed.join(labels, names_of, "left").select(F.col("row_id").alias(row_id), "cluster", "kind")
    return points.select(row_id).join(found, row_id, "left").select(
        row_id, F.coalesce("cluster", F.lit(-1)).alias("cluster"), F.coalesce("kind", F.lit("noise")).alias("kind"))


def _cell(axes: Sequence[str]) -> list[str]:
    return [f"c{a}" for a in axes]


def _sub(axes: Sequence[str], side: str = "") -> list[str]:
    return [f"{side}s{a}" for a in axes]


def _probe(axes: Sequence[str]) -> list[str]:
    return [f"p{a}" for a in axes]


def _boxes(places: DataFrame, axes: Sequence[str], depth: int) -> DataFrame:
    """Bounding boxes of the sub-cells at a depth (2^depth per side)."""
    cuts = float(2**depth)
    return places.groupBy(*_cell(axes), *[F.floor(F.col(f"f{a}") * cuts).alias(f"s{a}") for a in axes]).agg(
        F.sum("n").alias("n"), F.count("*").alias("places"), *[f(a).alias(f"{a}{k}") for a in axes for k, f in ((1, F.min), (2, F.max))])


def _gap(low_a: Column, high_a: Column, low_b: Column, high_b: Column) -> Column:
    return F.greatest(F.lit(0.0), low_a - high_b, low_b - high_a)


def _span(low_a: Column, high_a: Column, low_b: Column, high_b: Column) -> Column:
    return F.greatest(high_a - low_b, high_b - low_a)


def _squares(terms: Sequence[Column]) -> Column:
    return sum((t ** 2 for t in terms[1:]), terms[0] ** 2)


def _neighbours(axes: Sequence[str], forward: bool = False) -> Column:
    """The cell offsets within reach, or one of each opposite pair of them."""
    none = (0,) * len(axes)
    steps = [s for s in product(range(-2, 3), repeat=len(axes)) if (s > none if forward else s != none)]
    return F.array(*[F.struct(*[F.lit(k).alias(a) for a, k in zip(axes, s, strict=True)]) for s in steps])


def _reach(probes: DataFrame, places: DataFrame, axes: Sequence[str], eps: float, budget: int) -> DataFrame:
    """(probe position, cell, near): rows of each other cell within ``eps`` of each probe.

    Probes come from cells with fewer than ``min_points`` rows, so a cell
    meets a bounded number of them.
    """
    reach = F.lit(eps * eps)
    cell, sub, probe = _cell(axes), _sub(axes), _probe(axes)
    zero = F.lit(0).cast("bigint")
    open_pairs = probes.select(*[F.col(a).alias(f"p{a}") for a in axes], *cell, F.explode(_neighbours(axes)).alias("o")).select(
        *probe, *[(F.col(f"c{a}") + F.col("o")[a]).alias(f"c{a}") for a in axes], *[zero.alias(s) for s in sub])
    settled, depth = [], 0
    while True:
        sides = [(F.col(f"p{a}"), F.col(f"p{a}"), F.col(f"{a}1"), F.col(f"{a}2")) for a in axes]
        judged = open_pairs.join(_boxes(places, axes, depth), [*cell, *sub]).withColumns({
            "near2": _squares([_gap(*s) for s in sides]), "far2": _squares([_span(*s) for s in sides])})
        judged = settle(judged.filter(F.col("near2") <= reach))
        settled.append(judged.filter(F.col("far2") <= reach).select(*probe, *cell, F.col("n").alias("near")))
        unsure = judged.filter(F.col("far2") > reach)
        small = F.col("places") <= (budget if depth < MAX_DEPTH else 2**62)
        inside = _in_box(places, axes, depth).select(*cell, *sub, *axes, F.col("n").alias("m"))
        hits = unsure.filter(small).select(*probe, *cell, *sub).join(inside, [*cell, *sub]).filter(
            _squares([F.col(f"p{a}") - F.col(a) for a in axes]) <= reach)
        settled.append(hits.select(*probe, *cell, F.col("m").alias("near")))
        large = unsure.filter(~small)
        if large.isEmpty():
            break
        open_pairs = large.select(*probe, *cell, _children(axes).alias("c")).select(
            *probe, *cell, *[F.col("c")[a].alias(f"s{a}") for a in axes])
        depth += 1
    found = settled[0]
    for part in settled[1:]:
        found = found.unionByName(part)
    return found.groupBy(*probe, *cell).agg(F.sum("near").alias("near"))


def _in_box(places: DataFrame, axes: Sequence[str], depth: int) -> DataFrame:
    cuts = float(2**depth)
    return places.withColumns({f"s{a}": F.floor(F.col(f"f{a}") * cuts) for a in axes})


def _children(axes: Sequence[str], side: str = "") -> Column:
    """The halves of a box along each axis."""
    return F.explode(F.array(*[F.struct(*[(F.col(f"{side}s{a}") * 2 + k).alias(a) for a, k in zip(axes, half, strict=True)])
                               for half in product((0, 1), repeat=len(axes))]))


def _cell_links(core: DataFrame, axes: Sequence[str], eps: float, budget: int) -> DataFrame:
    """(a, b): pairs of core cells with two core points within ``eps``."""
    reach = F.lit(eps * eps)
    cell = _cell(axes)
    sub_a, sub_b = _sub(axes, "a"), _sub(axes, "b")
    zero = F.lit(0).cast("bigint")
    cells = core.select(*cell).distinct()
    open_pairs = cells.select(F.struct(*cell).alias("a"), F.explode(_neighbours(axes, forward=True)).alias("o"), *cell).select(
        "a", F.struct(*[(F.col(f"c{x}") + F.col("o")[x]).alias(f"c{x}") for x in axes]).alias("b"), *[zero.alias(s) for s in (*sub_a, *sub_b)])
    links, depth = None, 0
    while True:
        judged = open_pairs.join(_side(_boxes(core, axes, depth), axes, "a"), ["a", *sub_a]).join(
            _side(_boxes(core, axes, depth), axes, "b"), ["b", *sub_b])
        sides = [tuple(F.col(f"{s}{x}{k}") for s in "ab" for k in (1, 2)) for x in axes]
        judged = settle(judged.withColumns({
            "near2": _squares([_gap(*s) for s in sides]), "far2": _squares([_span(*s) for s in sides])}).filter(F.col("near2") <= reach))
        sure = judged.filter(F.col("far2") <= reach).select("a", "b").distinct()
        links = sure if links is None else links.unionByName(sure)
        unsure = judged.join(links.distinct(), ["a", "b"], "left_anti")
        small = F.col("aplaces") * F.col("bplaces") <= (budget if depth < MAX_DEPTH else 2**62)
        points = _in_box(core, axes, depth)
        hits = unsure.filter(small).select("a", "b", *sub_a, *sub_b).join(
            _ends(points, axes, "a"), ["a", *sub_a]).join(_ends(points, axes, "b"), ["b", *sub_b]).filter(
            _squares([F.col(f"a{x}") - F.col(f"b{x}") for x in axes]) <= reach)
        links = settle(links.unionByName(hits.select("a", "b").distinct()).distinct())
        large = unsure.filter(~small).join(links, ["a", "b"], "left_anti")
        if large.isEmpty():
            return links
        halves = large.select("a", "b", *sub_b, _children(axes, "a").alias("c")).select(
            "a", "b", *sub_b, *[F.col("c")[x].alias(f"as{x}") for x in axes])
        open_pairs = halves.select("a", "b", *sub_a, _children(axes, "b").alias("c")).select(
            "a", "b", *sub_a, *[F.col("c")[x].alias(f"bs{x}") for x in axes])
        depth += 1


def _side(boxes: DataFrame, axes: Sequence[str], side: str) -> DataFrame:
    return boxes.select(
        F.struct(*_cell(axes)).alias(side), *[F.col(f"s{x}").alias(f"{side}s{x}") for x in axes],
        *[F.col(c).alias(f"{side}{c}") for c in ("places", *[f"{x}{k}" for x in axes for k in (1, 2)])])


def _ends(points: DataFrame, axes: Sequence[str], side: str) -> DataFrame:
    return points.select(
        F.struct(*_cell(axes)).alias(side), *[F.col(f"s{x}").alias(f"{side}s{x}") for x in axes], *[F.col(x).alias(f"{side}{x}") for x in axes])
