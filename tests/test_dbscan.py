"""Density clustering against brute force."""

import math
import random

import pytest

from ferrolith.operators.components import connected_components
from ferrolith.operators.dbscan import EARTH_KM, dbscan, dbscan_globe


def brute_force(points, near, min_points):
    """points: {id: item}; near(a, b) -> bool. Returns {id: (cluster, kind)}."""
    ids = sorted(points)
    around = {i: [j for j in ids if near(points[i], points[j])] for i in ids}
    core = {i for i in ids if len(around[i]) >= min_points}
    label = {}
    for start in ids:
        if start in core and start not in label:
            stack = [start]
            label[start] = start
            while stack:
                for j in around[stack.pop()]:
                    if j in core and j not in label:
                        label[j] = start
                        stack.append(j)
    result = {}
    for i in ids:
        touching = [label[j] for j in around[i] if j in core]
        if i in core:
            result[i] = (label[i], "core")
        elif touching:
            result[i] = (min(touching), "border")
        else:
            result[i] = (-1, "noise")
    return result


def plane_points():
    rng = random.Random(7)
    points = []
    for cx, cy, n, spread in ((0, 0, 120, 0.6), (5, 5, 60, 0.5), (-4, 3, 40, 0.4)):
        points += [(rng.gauss(cx, spread), rng.gauss(cy, spread)) for _ in range(n)]
    points += [(rng.uniform(-8, 8), rng.uniform(-8, 8)) for _ in range(60)]
    points += [(x / 10, -6.0) for x in range(60)]  # a long chain
    points += [(1.5, 1.5)] * 80  # copies of one position
    return dict(enumerate(points))


@pytest.mark.parametrize("budget", [4096, 6])
@pytest.mark.parametrize("eps,min_points", [(0.35, 5), (0.12, 3)])
def test_same_as_brute_force(spark, eps, min_points, budget):
    points = plane_points()
    near = lambda a, b: (a[0] - b[0]) ** 2 + (a[1] - b[1]) ** 2 <= eps * eps
    df = spark.createDataFrame([(i, x, y) for i, (x, y) in points.items()], "id int, x double, y double")
    found = {r["id"]: (r["cluster"], r["kind"]) for r in dbscan(df, "id", "x", "y", eps, min_points, budget).collect()}
    assert found == brute_force(points, near, min_points)


def test_rows_without_position_are_noise(spark):
    df = spark.createDataFrame([(1, None, 1.0), (2, 0.0, 0.0), (3, 0.0, 0.0)], "id int, x double, y double")
    found = {r["id"]: r["cluster"] for r in dbscan(df, "id", "x", "y", 1.0, 2).collect()}
    assert found == {1: -1, 2: 2, 3: 2}


def test_components_of_chain_and_hub(spark):
    edges = [(i, i + 1) for i in range(1, 60)] + [(100, j) for j in range(101, 160)] + [(200, 201)]
    nodes = spark.createDataFrame([(i,) for i in [*range(1, 61), *range(100, 160), 200, 201, 300]], "node int")
    got = {r["node"]: r["component"] for r in
           connected_components(nodes, spark.createDataFrame(edges, "a int, b int")).collect()}
    expected = {i: 1 for i in range(1, 61)} | {i: 100 for i in range(100, 160)} | {200: 200, 201: 200, 300: 300}
    assert got == expected


def kilometres(a, b):
    """Great-circle distance by the haversine formula."""
    (la, lo), (lb, mo) = ([math.radians(v) for v in p] for p in (a, b))
    h = math.sin((lb - la) / 2) ** 2 + math.cos(la) * math.cos(lb) * math.sin((mo - lo) / 2) ** 2
    return 2 * EARTH_KM * math.asin(min(1.0, math.sqrt(h)))


@pytest.mark.parametrize("budget", [4096, 6])
@pytest.mark.parametrize("eps,min_points", [(60.0, 4), (400.0, 6)])
def test_globe(spark, eps, min_points, budget):
    """Clusters across the date line, around both poles and over the equator, with copies and odd positions."""
    rng = random.Random(5)
    points = [(rng.gauss(10, 0.5), 180 + rng.gauss(0, 0.5)) for _ in range(30)]
    points = [(a, b - 360 if b > 180 else b) for a, b in points]
    points += [(90 - abs(rng.gauss(0, 0.4)), rng.uniform(-180, 180)) for _ in range(20)]
    points += [(-90 + abs(rng.gauss(0, 0.4)), rng.uniform(-180, 540)) for _ in range(20)]
    points += [(rng.gauss(0, 0.3), rng.gauss(20, 0.3)) for _ in range(30)] + [(rng.uniform(-80, 80), rng.uniform(-180, 180)) for _ in range(40)]
    points += [(48.5, 2.3)] * 7 + [(48.5, 362.3)]
    points = dict(enumerate(points))
    df = spark.createDataFrame([*((i, a, b) for i, (a, b) in points.items()), (900, None, 1.0), (901, 91.0, 1.0), (902, float("nan"), 1.0)],
                               "id int, lat double, lon double")
    found = {r["id"]: (r["cluster"], r["kind"]) for r in dbscan_globe(df, "id", "lat", "lon", eps, min_points, budget).collect()}
    want = brute_force(points, lambda a, b: kilometres(a, b) <= eps, min_points)
    assert found == want | dict.fromkeys((900, 901, 902), (-1, "noise"))
    assert len({c for c, _ in want.values()}) > 4
