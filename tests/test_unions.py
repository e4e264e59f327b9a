"""Unions of polygons: against fine points, against plain areas where nothing overlaps, nested rings and holes."""

import math
import random

import numpy as np
import pytest

from gridprep.functions.geo import EARTH_RADIUS, GridSpec
from gridprep.operators.overlay import polygon_cell_area
from gridprep.operators.unions import polygon_cell_union

SPEC = GridSpec(-3.0, 3.0, 1.0, 1.0, 6, 6)
KIND = "poly_id int, part int, ring int, code int, points array<struct<lon:double,lat:double>>"


def cells(df):
    return {(r["code"], r["gcol"], r["grow"]): r["area"] for r in df.collect()}


def inside(ring, x, y):
    """Even-odd, for arrays of points."""
    found = np.zeros(x.shape, bool)
    for (x1, y1), (x2, y2) in zip(ring, ring[1:] + ring[:1], strict=True):
        if y1 != y2:
            found ^= ((y1 > y) != (y2 > y)) & (x < (x2 - x1) * (y - y1) / (y2 - y1) + x1)
    return found


def star(rng, cx, cy, n):
    # less than half a turn between neighbours, so the ring doesn't cross itself
    angles = [(k + rng.uniform(0.1, 0.9)) * 2 * math.pi / n for k in range(n)]
    ring = [(cx + radius * math.cos(a), cy + radius * math.sin(a)) for a in angles for radius in [rng.uniform(0.4, 1.8)]]
    return ring if rng.random() < 0.5 else ring[::-1]


def test_overlapping_stars_against_points(spark):
    rng = random.Random(5)
    rings = [(c, star(rng, rng.uniform(-2, 2), rng.uniform(-2, 2), rng.randint(4, 9))) for c in (1, 2) for _ in range(6)]
    # a polygon with a hole, half of which another covers
    rings.append((3, [(-2.5, -2.5), (2.5, -2.5), (2.5, 2.5), (-2.5, 2.5)]))
    hole, cover = [(-1.2, -1.3), (1.4, -1.1), (1.1, 1.2), (-1.3, 1.4)], (3, [(0.0, -1.0), (4.0, -1.0), (4.0, 0.5), (0.1, 0.5)])
    rows = [(k, 0, 0, c, ring) for k, (c, ring) in enumerate([*rings, cover])] + [(len(rings) - 1, 0, 1, 3, hole)]
    got = cells(polygon_cell_union(spark.createDataFrame(rows, KIND), SPEC))
    n = 400
    x, y = np.meshgrid(-3 + (np.arange(6 * n) + 0.5) / n, 3 - (np.arange(6 * n) + 0.5) / n)
    for code in (1, 2, 3):
        covered = np.zeros(x.shape, bool)
        for c, ring in rings:
            if c == code:
                own = inside(ring, x, y)
                covered |= own & ~inside(hole, x, y) if code == 3 else own
        if code == 3:
            covered |= inside(cover[1], x, y)
        weight = covered * np.cos(np.radians(y)) * math.radians(1 / n) ** 2 * EARTH_RADIUS**2
        whole = weight.reshape(6, n, 6, n).sum(axis=(1, 3))
        for r in range(6):
            for c in range(6):
                assert got.get((code, c, r), 0.0) == pytest.approx(whole[r, c], abs=0.004 * 1.24e10), (code, c, r)


def test_disjoint_ones_are_as_before(spark):
    rng = random.Random(9)
    rows = [(k, 0, 0, k, star(rng, rng.uniform(-4, 4), rng.uniform(-4, 4), rng.randint(4, 9))) for k in range(12)]
    df = spark.createDataFrame(rows, KIND)
    # stars of a code each: a ring that doesn't cross itself covers nothing twice
    plain, union = cells(polygon_cell_area(df, SPEC)), cells(polygon_cell_union(df, SPEC))
    assert set(plain) == set(union)
    # the other way loses digits on edges that are nearly level
    assert max(abs(union[k] - v) for k, v in plain.items()) < 1e-7 * 1.24e10


def test_copies_nested_and_empty_rings(spark):
    square = [(-1.5, -1.5), (1.5, -1.5), (1.5, 1.5), (-1.5, 1.5)]
    small = [(-0.5, -0.5), (0.5, -0.5), (0.5, 0.5), (-0.5, 0.5)]
    one = cells(polygon_cell_area(spark.createDataFrame([(0, 0, 0, 1, square)], KIND), SPEC))
    many = spark.createDataFrame([(0, 0, 0, 1, square), (1, 0, 0, 1, square[::-1]), (2, 0, 0, 1, small), (3, 0, 0, 1, small[:2]), (4, 0, 0, 1, [])], KIND)
    got = cells(polygon_cell_union(many, SPEC))
    assert got.keys() == one.keys() and all(got[k] == pytest.approx(v, rel=1e-9) for k, v in one.items())
    assert polygon_cell_union(many.filter("false"), SPEC).count() == 0
