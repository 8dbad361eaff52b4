"""Overlaps of polygons of any shape, beside overlaps of the cells of a fine raster."""

import random

import numpy as np
import pytest

from geoquilt.operators import polygons


def covered(rings, n, step):
    """Which cell centres of an n by n raster lie inside rings, by parity."""
    y, x = np.mgrid[0:n, 0:n] * step + step / 2
    out = np.zeros((n, n), bool)
    for ring in rings:
        for (ax, ay), (bx, by) in zip(ring, [*ring[1:], ring[0]], strict=True):
            if ay != by:
                out ^= ((ay > y) != (by > y)) & (x < ax + (y - ay) / (by - ay) * (bx - ax))
    return out


def area(ring):
    return sum(ax * by - bx * ay for (ax, ay), (bx, by) in zip(ring, [*ring[1:], ring[0]], strict=True)) / 2


def blob(rng):
    """A star-shaped outline of random radii with, sometimes, a hole and an island in it."""
    cx, cy, k = rng.uniform(4, 8), rng.uniform(4, 8), rng.randrange(5, 14)
    at = lambda r, a: (cx + r * np.cos(a), cy + r * np.sin(a))
    turns = [2 * np.pi * i / k for i in range(k)]
    rings = [[at(rng.uniform(2, 4), a) for a in turns]]
    if rng.random() < 0.6:
        rings.append([at(1.2, a) for a in reversed(turns)])
        rings.append([at(0.5, a) for a in turns])
    return rings


CORNERED = [
    [[(0, 0), (4, 0), (4, 4), (0, 4)]],
    [[(0, 0), (4, 0), (4, 4), (0, 4)]],  # the same again
    [[(4, 0), (8, 0), (8, 4), (4, 4)]],  # beside it
    [[(2, 0), (6, 0), (6, 2), (2, 2)]],  # along one side
    [[(0, 0), (8, 0), (8, 8), (0, 8)], [(1, 1), (1, 3), (3, 3), (3, 1)], [(3, 3), (3, 5), (5, 5), (5, 3)]],  # holes that touch
    [[(4, 4), (8, 4), (8, 8), (4, 8)]],  # corner to corner
    [[(1, 1), (3, 1), (3, 3), (1, 3)]],  # fills a hole
    [[(0, 2), (2, 0), (4, 2), (2, 4)]],  # its corners on others' sides
    [[(0, 0), (8, 0), (8, 3), (2, 3), (2, 5), (8, 5), (8, 8), (0, 8)]],  # a C
    [[(5, 1), (7, 1), (7, 7), (5, 7)]],  # over both arms of it
]


@pytest.mark.parametrize("kind", ["cornered", "random"])
def test_overlap_equals_that_of_rasters(spark, kind):
    rng = random.Random(4)
    shapes = CORNERED if kind == "cornered" else [blob(rng) for _ in range(9)]
    rows = [(i, [[{"x": float(x), "y": float(y)} for x, y in ring] for ring in rings]) for i, rings in enumerate(shapes)]
    df = spark.createDataFrame(rows, "id long, rings array<array<struct<x:double,y:double>>>")
    pairs = spark.createDataFrame([(a, b) for a in range(len(shapes)) for b in range(a)], "id_a long, id_b long")
    n, step = (64, 0.125) if kind == "cornered" else (600, 0.02)
    cells = [covered(rings, n, step) for rings in shapes]
    found = {}
    for r in polygons.overlaps(pairs, df, 1.5).collect():
        rings = [[(v.x, v.y) for v in ring] for ring in r.rings]
        assert area(rings[0]) > 0 and all(area(h) < 0 for h in rings[1:])
        assert abs(sum(map(area, rings)) - r.area) < 1e-9
        found.setdefault((r.id_a, r.id_b), []).append(rings)
    for a in range(len(shapes)):
        for b in range(a):
            want = cells[a] & cells[b]
            parts = found.get((a, b), [])
            got = covered([ring for rings in parts for ring in rings], n, step)
            if kind == "cornered":
                off = abs(sum(area(ring) for rings in parts for ring in rings) - want.sum() * step**2)
                assert (got == want).all() and off < (0.3 if 7 in (a, b) else 1e-9)  # a slanted one cuts cells
            else:
                assert (got != want).sum() <= 2
            assert sum(covered(rings, n, step).sum() for rings in parts) == got.sum()  # parts don't lie in each other
    if kind == "cornered":
        assert len(found[9, 8]) == 2 and (2, 0) not in found and (5, 0) not in found and (6, 4) not in found


def test_no_pairs(spark):
    df = spark.createDataFrame([], "id long, rings array<array<struct<x:double,y:double>>>")
    assert polygons.overlaps(spark.createDataFrame([], "id_a long, id_b long"), df, 1.0).count() == 0
