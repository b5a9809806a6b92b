import random

import pytest
from pyspark.sql import functions as F

from doorstep.operators import contains
from doorstep.operators.contains import (
    contains_join,
    contains_lists,
    cover,
    measure_cover,
)

from conftest import rows_of


def inside(rings, x, y):
    """Strict interior by even-odd crossings, written apart from the operator."""
    parity = False
    for ring in rings:
        for (x1, y1), (x2, y2) in zip(ring, ring[1:]):
            cross = (x2 - x1) * (y - y1) - (x - x1) * (y2 - y1)
            if (
                cross == 0
                and min(x1, x2) <= x <= max(x1, x2)
                and min(y1, y2) <= y <= max(y1, y2)
            ):
                return False
            if (y1 > y) != (y2 > y) and (cross > 0) == (y2 > y1):
                parity = not parity
    return parity


def text(rings, gap=","):
    body = gap.join(
        "(" + gap.join(f"{x!r} {y!r}" for x, y in ring) + ")" for ring in rings
    )
    return f"POLYGON ({body})"


def random_polygon(rng):
    """A star around a centre on eighths, so that many coordinates coincide."""
    cx, cy = rng.randrange(-40, 40) / 8, rng.randrange(-40, 40) / 8
    n = rng.randrange(3, 14)
    offsets = sorted(
        {(rng.randrange(-16, 17), rng.randrange(-16, 17)) for _ in range(n)},
        key=lambda p: __import__("math").atan2(p[1], p[0]),
    )
    ring = [(cx + dx / 8, cy + dy / 8) for dx, dy in offsets if (dx, dy) != (0, 0)]
    if len(ring) < 3:
        return random_polygon(rng)
    rings = [ring + ring[:1]]
    if rng.random() < 0.4:
        hole = [(cx - 0.25, cy - 0.25), (cx + 0.25, cy - 0.25), (cx, cy + 0.375)]
        rings.append(hole + hole[:1])
    return rings


@pytest.fixture(scope="module")
def case(spark):
    rng = random.Random(7)
    shapes = {k: random_polygon(rng) for k in range(60)}
    points = [
        (i, rng.randrange(-60, 61) / 8, rng.randrange(-60, 61) / 8) for i in range(500)
    ]
    points += [(500 + i, rng.uniform(-8, 8), rng.uniform(-8, 8)) for i in range(500)]
    points += [(1000 + i, 0.125, 0.25) for i in range(400)]  # one crowded spot
    points += [(1400, None, 1.0), (1401, 1.0, None), (1402, None, None)]
    expected = sorted(
        (i, k)
        for i, x, y in points
        for k, rings in shapes.items()
        if x is not None and y is not None and inside(rings, x, y)
    )
    p = spark.createDataFrame(points, "id long, longitude double, latitude double")
    a = spark.createDataFrame(
        [(k, text(r, ", " if k % 2 else ",")) for k, r in shapes.items()]
        + [(900, None), (901, "POLYGON EMPTY")],
        "k long, geometry string",
    )
    return p.repartition(4), a, expected


@pytest.mark.parametrize("level", [None, -2, 3])
@pytest.mark.parametrize("limit", [contains.BROADCAST_BYTES, 0])
def test_equals_brute_force(case, level, limit):
    points, areas, expected = case
    found = contains_join(
        points, areas, how="inner", level=level, broadcast_bytes=limit
    )
    assert rows_of(found.select("id", "k")) == sorted(expected, key=repr)


@pytest.mark.parametrize("limit", [contains.BROADCAST_BYTES, 0])
def test_left_keeps_points_without_area(case, limit):
    points, areas, expected = case
    found = contains_join(points, areas, broadcast_bytes=limit)
    got = rows_of(found.select("id", "k"))
    hit = {i for i, _ in expected}
    lonely = [(r["id"], None) for r in points.collect() if r["id"] not in hit]
    assert got == sorted(expected + lonely, key=repr)
    assert found.columns == ["id", "longitude", "latitude", "k"]


@pytest.mark.parametrize("level", [None, 1])
def test_lists_equal_the_join(case, level):
    points, areas, expected = case
    found = contains_lists(points, areas, "k", level=level)
    got = {r["id"]: sorted(r["k"]) for r in found.collect()}
    want = {r["id"]: [] for r in points.collect()}
    for i, k in expected:
        want[i].append(k)
    assert got == {i: sorted(v) for i, v in want.items()}
    assert contains_lists(points, areas, "k", broadcast_bytes=0) is None


def test_extra_key(spark, case):
    points, areas, expected = case
    points = points.withColumn("g", F.col("id") % 3)
    areas = areas.withColumn("g", F.col("k") % 3)
    found = contains_join(points, areas, how="inner", on=["g"])
    want = [(i, k) for i, k in expected if i % 3 == k % 3]
    assert rows_of(found.select("id", "k")) == sorted(want, key=repr)
    assert found.columns == ["id", "longitude", "latitude", "g", "k"]


def test_points_on_the_boundary_are_outside(spark):
    square = spark.createDataFrame(
        [("POLYGON((0 0,2 0,2 2,0 2,0 0))",)], "geometry string"
    ).withColumn("k", F.lit(1))
    points = spark.createDataFrame(
        [(0.0, 0.0), (1.0, 0.0), (2.0, 1.0), (1.0, 2.0), (1.0, 1.0), (2.5, 1.0)],
        "longitude double, latitude double",
    )
    for level in (-1, 1):
        found = contains_join(points, square, how="inner", level=level)
        assert rows_of(found) == [(1.0, 1.0, 1)]


def test_seam_between_pieces_belongs_to_neither(spark):
    halves = spark.createDataFrame(
        [("a", "POLYGON((0 0,1 0,1 2,0 2,0 0))"), ("a", "POLYGON((1 0,2 0,2 2,1 2,1 0))")],
        "k string, geometry string",
    )
    points = spark.createDataFrame([(1.0, 1.0)], "longitude double, latitude double")
    assert rows_of(contains_join(points, halves)) == [(1.0, 1.0, None)]


def test_cover_is_exact_once_per_cell_and_within_its_bound(case):
    _, areas, _ = case
    size = measure_cover(areas)
    for level in (0, 3):
        cells = cover(areas, level)
        n = cells.count()
        assert n == cells.select("k", "_cx", "_cy").distinct().count()
        assert n <= size.rows(level)
        assert rows_of(cover(areas, level, tasks=3)) == rows_of(cells)
        held = cells.agg(
            F.sum(F.when(~F.col("_full"), F.size("_edges"))),
            F.sum(F.when(~F.col("_full"), F.size("_far_ys"))),
        ).first()
        assert held[1] <= 2 * held[0]


def test_large_cover_is_not_broadcast(case):
    points, areas, _ = case
    plan = lambda limit: contains_join(
        points, areas, broadcast_bytes=limit
    )._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan(contains.BROADCAST_BYTES)
    assert "NestedLoop" not in plan(0) and "Cartesian" not in plan(0)
