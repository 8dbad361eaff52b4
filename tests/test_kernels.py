"""Operators that SQL can't express, against numpy or plain Python, and invariants."""

import math
import os

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from geoquilt.functions import grid, sensors
from geoquilt.functions import timeorbit as to
from geoquilt.operators import points as pc
from geoquilt.operators import raster as rs
from geoquilt.operators import spatial
from geoquilt.operators import tiepoints as tp
from geoquilt.operators.graph import components
from geoquilt.sources import features as vf
from geoquilt.sources import pyramid

SF = "/root/testdata/sf0.001"


def image(seed=0, side=32, share=0.8):
    rng = np.random.default_rng(seed)
    a = rng.integers(0, 50, (side, side)).astype(float)
    a[rng.random((side, side)) > share] = np.nan
    return a


def pixels(spark, a, image_id=0):
    ys, xs = np.nonzero(~np.isnan(a))
    return spark.createDataFrame([(image_id, int(x), int(y), int(a[y, x])) for x, y in zip(xs, ys)], "image_id int, x int, y int, v int")


# plain versions of the sequential filters, written from their rules


def plain_without(points, s):
    points = [(tp_id, list(ms)) for tp_id, ms in sorted(points.items())]
    i = 0
    while i < len(points):
        a = points[i][1][0]
        agree = 0
        for j, (_, ms) in enumerate(points):
            if j == i:
                continue
            b = ms[0]
            r0, r1 = math.hypot(a[1], a[2]), math.hypot(b[1], b[2])
            if math.hypot(a[1] - b[1], a[2] - b[2]) < s.min_vector_difference:
                agree += 1
            elif r0 + r1 > 0 and 2 * abs(r1 - r0) / (r0 + r1) < s.max_magnitude_ratio and (1.0 if r0 == 0 or r1 == 0 else (a[1] * b[1] + a[2] * b[2]) / (r0 * r1)) > math.cos(math.radians(s.max_angle)):
                agree += 1
        if agree >= max(math.ceil(s.percent_consistent * (len(points) - 1) / 100), s.min_consistent):
            i += 1
        elif len(points[i][1]) > 1:
            points[i][1].pop(0)
        else:
            points.pop(i)
    return {t: ms[0] for t, ms in points}


def plain_with(points, gx, gy, s):
    points, slope, rounds = {t: list(ms) for t, ms in points.items()}, gy / gx, 0
    while True:
        if len(points) < 2:
            return {}
        off = sum(ms[0][2] - slope * ms[0][1] for ms in points.values()) / len(points)
        far = lambda m: abs(off + slope * m[1] - m[2]) / math.sqrt(slope**2 + 1)  # noqa: E731, B023
        limit = max(s.max_parallax_deviations * math.sqrt(sum(far(ms[0]) ** 2 for ms in points.values()) / (len(points) - 1)), s.max_parallax_pixels)
        if rounds == s.max_rounds and limit > s.max_parallax_pixels:
            return {}
        changed = False
        for t in list(points):
            while points[t] and far(points[t][0]) > limit:
                points[t].pop(0)
                changed = True
            if not points[t]:
                del points[t]
        if not changed:
            return {t: ms[0] for t, ms in points.items()}
        rounds = min(rounds + 1, s.max_rounds)


def candidates(seed):
    rng = np.random.default_rng(seed)
    tiles = {}
    for tile in range(12):
        base = rng.normal(0, 15, 2)
        tiles[tile] = {}
        for t in range(int(rng.integers(1, 10))):
            ms = [(r, *(base + rng.normal(0, 2 if rng.random() < 0.6 else 25, 2)), float(rng.random())) for r in range(int(rng.integers(1, 4)))]
            tiles[tile][tile * 100 + t] = ms
    return tiles


@pytest.mark.parametrize("seed", [1, 2])
def test_sequential_filters(spark, seed):
    tiles, s = candidates(seed), tp.FilterSettings()
    rows = [(tile, t, r, float(x), float(y), c) for tile, pts in tiles.items() for t, ms in pts.items() for r, x, y, c in ms]
    df = spark.createDataFrame(rows, tp.SCHEMA)
    want = {t: m[0] for pts in tiles.values() for t, m in plain_without(pts, s).items()}
    got = {r.tp_id: r.match_rank for r in tp.filter_without_parallax(df, s).collect()}
    assert got == want and set(got) <= {r[1] for r in rows}
    want = {t: m[0] for pts in tiles.values() for t, m in plain_with(pts, 2.0, 1.0, s).items()}
    assert {r.tp_id: r.match_rank for r in tp.filter_with_parallax(df, 2.0, 1.0, s).collect()} == want
    # small rates fall back to the other filter; a limit of 0 neighbours checks nothing
    assert tp.filter_with_parallax(df, 0.5, 0.5, s).count() == len(got)
    assert tp.filter_without_parallax(df, s.with_overrides({"min_consistent": 0})).count() == len({r[1] for r in rows})


@pytest.mark.parametrize("cells", [1, 300, 1 << 21])
def test_filters_over_batches_and_parts(spark, monkeypatch, cells):
    """Tiles that are cut by batches, and parts of any size, give what tiles on their own give."""
    monkeypatch.setattr(tp, "CELLS", cells)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        s = tp.FilterSettings()
        every, want, line = [], {}, {}
        for seed in range(3, 9):
            tiles = candidates(seed)
            every += [(tile + 100 * seed, t + 1000 * seed, r, float(x), float(y), c) for tile, pts in tiles.items() for t, ms in pts.items() for r, x, y, c in ms]
            want |= {t + 1000 * seed: m[0] for pts in tiles.values() for t, m in plain_without(pts, s).items()}
            line |= {t + 1000 * seed: m[0] for pts in tiles.values() for t, m in plain_with(pts, 2.0, 1.0, s).items()}
        df = spark.createDataFrame(every, tp.SCHEMA).repartition(3)
        assert {r.tp_id: r.match_rank for r in tp.filter_without_parallax(df, s).collect()} == want
        assert {r.tp_id: r.match_rank for r in tp.filter_with_parallax(df, 2.0, 1.0, s).collect()} == line
        assert tp.filter_without_parallax(df.limit(0), s).count() == 0
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_frames_meet_by_bins(spark):
    frames = spark.createDataFrame([(i, c, r, 700 + 100 * c, 300 + 50 * r) for i in (0, 1) for c in range(5) for r in range(6)], "image_id int, col int, row int, w int, h int")
    rects = spark.createDataFrame([(0, 650, 290, 900, 1200), (0, 0, 0, 1, 1), (1, 100, 100, 0, 9), (1, 3300, 100, 5, 5)], "image_id int, x0 int, y0 int, width int, height int")
    found = pyramid.frames_for_rect(frames, rects)
    want = set()
    for i, x0, y0, w, h in [tuple(r) for r in rects.collect()]:
        for c in range(5):
            for r in range(6):
                px, py = sum(700 + 100 * k for k in range(c)), sum(300 + 50 * k for k in range(r))
                if w and h and px < x0 + w and px + 700 + 100 * c > x0 and py < y0 + h and py + 300 + 50 * r > y0:
                    want.add((i, c, r, x0, y0))
    got = [(r.image_id, r.col, r.row, r.x0, r.y0) for r in found.collect()]
    assert len(got) == len(set(got)) and set(got) == want
    joins = [x for x in found._jdf.queryExecution().optimizedPlan().toString().split("\n") if "Join Inner" in x]
    assert len(joins) == 1 and "_bx" in joins[0] and "_by" in joins[0]


def test_levels_are_written_by_as_many_tasks_as_they_need(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(pyramid, "TILES_PER_FILE", 10)
    rows = [("t", z, c, r, z) for z in range(5) for c in range(1 << z) for r in range(1 << z)]
    df = spark.createDataFrame(rows, "table_name string, zoom_level int, tile_column int, tile_row int, v int")
    pyramid.write_pyramid(df, str(tmp_path / "p"))
    files = {z: len(list((tmp_path / "p" / "table_name=t" / f"zoom_level={z}").glob("*.parquet"))) for z in range(5)}
    assert files[0] == files[1] == 1 and 8 <= files[4] <= 26 and spark.read.parquet(str(tmp_path / "p")).count() == len(rows)
    with pytest.raises(ValueError):
        pyramid.write_pyramid(df.unionByName(df.limit(1)), str(tmp_path / "q"))


def test_settings_layers():
    s = tp.FilterSettings().with_overrides({"points_per_tile": 3, "max_angle": 5.0}, {"points_per_tile": 4})
    assert (s.points_per_tile, s.max_angle, s.features_per_tile) == (4, 5.0, 10)
    with pytest.raises(TypeError):
        tp.FilterSettings().with_overrides({"no_such": 1})


def test_lsh_recall(spark):
    rng = np.random.default_rng(5)
    centre = rng.normal(size=(40, 16))
    vec = lambda i, im: (i + 1000 * im, im, int(i % 4), [float(v) for v in centre[i % 40] + 0.2 * rng.normal(size=16)])
    d = spark.createDataFrame([vec(i, im) for im in (0, 1) for i in range(160)], "vec_id long, image_id int, tile_id int, embedding array<float>")
    a, b = d.filter("image_id = 0"), d.filter("image_id = 1")
    exact = {(r.id_a, r.id_b) for r in tp.descriptor_matches(a, b, 3).collect()}
    near = {(r.id_a, r.id_b) for r in tp.approximate_matches(a, b, 3, 4.0, 6, 1e9).collect()}
    assert len(exact & near) / len(exact) >= 0.9


def test_hermite_and_lagrange(spark):
    w, r = 0.00104, 7178137.0
    nodes = spark.createDataFrame([(0, 10.0 * i, r * math.cos(w * 10 * i), -r * w * math.sin(w * 10 * i)) for i in range(25)], "k int, t double, p double, v double")
    arrays = to.node_arrays(nodes, "k", "t", ["p", "v"])
    at = spark.createDataFrame([(0, float(t)) for t in (50.0, 55.3, 101.7, 120.0, 133.33, 3.0, 500.0)], "k int, q double").join(arrays, "k")
    rows = at.select("q", to.hermite(F.col("nodes"), F.col("q"), {"p": "v"}).alias("h"), to.lagrange(F.col("nodes"), F.col("q"), "p", 0.01).alias("l"), to.bracket(F.col("nodes"), F.col("q"), "p").alias("b")).collect()
    for x in rows:
        if 40 <= x.q <= 200:
            assert abs(x.h["p"] - r * math.cos(w * x.q)) < 1e-2 and abs(x.h["v"] + r * w * math.sin(w * x.q)) < 1e-2
            assert abs(x.l - r * math.cos(w * x.q)) < 1e-2
            assert abs(x.b - r * math.cos(w * x.q)) < r * w * w * 100 / 8 * 1.01
        else:
            assert x.l is None
    assert {x.q: x.h["p"] for x in rows}[50.0] == r * math.cos(w * 50.0)
    one = at.filter("q = 3.0").withColumn("nodes", F.slice("nodes", 1, 1))
    assert one.select(to.hermite(F.col("nodes"), F.col("q"), {"p": "v"}).alias("h")).first().h is None


def test_sar_location_fits_its_surfaces():
    rng = np.random.default_rng(0)
    n = 200
    angle = rng.random(n)
    p = 7178137.0 * np.stack([np.cos(angle), np.sin(angle), np.zeros(n)], 1)
    v = 7000.0 * np.stack([-np.sin(angle) * 0.5, np.cos(angle) * 0.5, np.full(n, 0.8)], 1)
    dist, h = 850e3 + 1e5 * rng.random(n), 3000 * rng.random(n)
    x, status = sensors.sar_locate(p, v, dist, np.zeros(n), h, 0.0566)
    assert (status == 0).all()
    assert np.allclose(np.linalg.norm(x - p, axis=1), dist, rtol=1e-7)
    assert np.abs(((x - p) * v).sum(1)).max() / (850e3 * 7000) < 1e-7
    s = np.stack([sensors.A + h, sensors.A + h, sensors.B + h], 1)
    assert np.allclose(((x / s) ** 2).sum(1), 1, atol=1e-9)
    left, _ = sensors.sar_locate(p, v, dist, np.zeros(n), h, 0.0566, right=False)
    assert (np.linalg.norm(left - x, axis=1) > 1e5).all()
    _, none = sensors.sar_locate(p, v, np.full(n, 10e3), np.zeros(n), h, 0.0566)
    assert (none == 2).all()


def test_sar_location_round_trip():
    """Range and Doppler frequency of known ground points, seen with squint from slant orbits, lead back to them."""
    rng = np.random.default_rng(3)
    n, wavelength = 500, 0.0566
    lat, lon, h = rng.uniform(-1.2, 1.2, n), rng.uniform(-3, 3, n), rng.uniform(0, 5000, n)
    g = np.stack([np.cos(lat) * np.cos(lon) * (sensors.A + h), np.cos(lat) * np.sin(lon) * (sensors.A + h), np.sin(lat) * (sensors.B + h)], 1)
    up = g / np.linalg.norm(g, axis=1, keepdims=True)
    east = np.stack([-np.sin(lon), np.cos(lon), 0 * lon], 1)
    heading = rng.uniform(0, 6.28, n)[:, None]
    ahead = np.cos(heading) * np.cross(up, east) + np.sin(heading) * east
    p = g + up * 700e3 - np.cross(ahead, up) * rng.uniform(1e5, 6e5, n)[:, None] + ahead * rng.uniform(-5e4, 5e4, n)[:, None]
    v = 7500 * ahead + 100 * up
    dist = np.linalg.norm(g - p, axis=1)
    doppler = 2 * ((g - p) * v).sum(1) / (wavelength * dist)
    x, status = sensors.sar_locate(p, v, dist, doppler, h, wavelength)
    assert (status == 0).all() and np.abs(x - g).max() < 1e-4
    other, _ = sensors.sar_locate(p, v, dist, doppler, h, wavelength, right=False)
    assert np.nanmin(np.linalg.norm(other - g, axis=1)) > 1e5
    assert (sensors.sar_locate(p, v, np.full(n, 1e3), np.full(n, 1e9), h, wavelength)[1] == 2).all()  # a cone that the sphere doesn't meet


def test_rays():
    p = np.array([[7e6, 0.0, 1e5], [0, 7e6, 2e5]])
    v = np.array([[0, 7e3, 1e3], [-7e3, 0, 1e3]])
    u = sensors.pushbroom_ray(p, v, np.zeros((2, 3)), np.zeros(2), np.zeros(2))
    assert np.allclose(u, -p / np.linalg.norm(p, axis=1, keepdims=True))  # straight down
    g = sensors.meet_ellipsoid(p, u, np.array([100.0, 0.0]))
    assert np.allclose((g**2 / (np.array([[sensors.A + 100] * 2 + [sensors.B + 100], [sensors.A] * 2 + [sensors.B]]) ** 2)).sum(1), 1)
    assert np.isnan(sensors.meet_ellipsoid(p, -u, np.zeros(2))).all()
    q = p + np.array([[0, 5e5, 0], [5e5, 0, 0]])
    w = (g - q) / np.linalg.norm(g - q, axis=1, keepdims=True)
    mid, miss = sensors.two_ray_point(p, u, q, w)
    assert np.allclose(mid, g, atol=1e-3) and miss.max() < 1e-3
    assert np.isnan(sensors.two_ray_point(p, u, q, u)[1]).all()


def test_inversion_gives_up():
    rows = pd.DataFrame({"a": [0, 0]})
    at, _ = sensors.invert(lambda r, x, y: (x * 2 + y, y - x), rows, np.array([[5.0, 1.0], [7.0, 2.0]]), np.zeros((2, 2)), 1e-3, 1e-9, 5)
    assert np.allclose(at, [[4 / 3, 7 / 3], [5 / 3, 11 / 3]])
    bad, _ = sensors.invert(lambda r, x, y: (x * 0, y * 0), rows, np.ones((2, 2)), np.zeros((2, 2)), 1e-3, 1e-9, 5)
    assert np.isnan(bad).all()


def test_earth_frames_return(spark):
    df = spark.createDataFrame([(0.3, 7e6, 1e5, 2e6, 10.0, 7e3, -3.0)], "a double, x double, y double, z double, u double, v double, w double")
    p, v = to.earth_to_inertial(F.col("a"), [F.col(c) for c in "xyz"], [F.col(c) for c in "uvw"])
    bp, bv = to.inertial_to_earth(F.col("a"), p, v)
    row = df.select(*[c.alias(n) for n, c in zip("xyzuvw", [*bp, *bv])]).first()
    assert np.allclose(list(row), [7e6, 1e5, 2e6, 10.0, 7e3, -3.0])


def test_geodetic_return_and_poles(spark):
    b = sensors.B
    df = spark.createDataFrame([(0.0, 0.0, b + 5.0), (0.0, 0.0, -b), (sensors.A + 7.0, 0.0, 0.0)], "x double, y double, z double")
    rows = df.select(*to.ecef_to_geodetic(F.col("x"), F.col("y"), F.col("z"))).collect()
    assert np.allclose([list(r) for r in rows], [[0, math.pi / 2, 5], [0, -math.pi / 2, 0], [0, 0, 7]], atol=1e-6)


def test_dates(spark):
    days = [(1582, 10, 4), (1582, 10, 10), (1582, 10, 15), (2000, 1, 1)]
    df = spark.createDataFrame(days, "y int, m int, d int")
    assert [r[0] for r in df.select(to.julian_day(F.col("y"), F.col("m"), F.col("d"), F.lit(0.0))).collect()] == [2299159.5, None, 2299160.5, 2451544.5]
    texts = spark.createDataFrame([("20000101",), ("19491231",), ("2000010",), ("20001301",), (None,)], "t string")
    assert [r[0] for r in texts.select(to.parse_ymd(F.col("t"))).collect()] == [2451544.5, None, None, None, None]


def test_pixel_and_place_agree(spark):
    df = spark.range(500).select((F.col("id") * 2 % 1024 + 0.5).alias("s"), (F.col("id") * 7 % 1024 + 0.5).alias("l"))
    lon, lat = grid.pixel_to_lonlat(F.col("s"), F.col("l"), 2)
    back = df.select("s", "l", lon.alias("lon"), lat.alias("lat"))
    s, line = grid.lonlat_to_pixel(F.col("lon"), F.col("lat"), 2)
    assert back.filter((s != F.floor("s")) | (line != F.floor("l"))).count() == 0


def test_zoom_errors(spark):
    with pytest.raises(ValueError):
        grid.zoom_gsd(1234, F.lit(0))
    df = spark.createDataFrame([([3, 1, 2],), ([1, -1],)], "z array<int>")
    assert [r[0] for r in df.select(grid.user_levels(F.col("z"))).collect()] == [[1, 2, 3], []]


def test_fourier_returns(spark):
    a = image(3, 16)
    f = rs.fourier(pixels(spark, a), 16, 16)
    got = np.zeros((16, 16), complex)
    for r in f.collect():
        got[r.y, r.x] = r.re + 1j * r.im
    assert np.allclose(got, np.fft.fft2(np.nan_to_num(a)) / 256)
    back = {(r.x, r.y): r.re for r in rs.fourier(f, 16, 16, inverse=True).collect()}
    assert all(abs(back[x, y] - np.nan_to_num(a)[y, x]) < 1e-9 for x in range(16) for y in range(16))


def plain_regions(mask):
    label, out = {}, 0
    for y, x in zip(*np.nonzero(mask)):
        if (x, y) in label:
            continue
        todo, out = [(x, y)], out + 1
        while todo:
            p = todo.pop()
            if p in label or not (0 <= p[0] < mask.shape[1] and 0 <= p[1] < mask.shape[0]) or not mask[p[1], p[0]]:
                continue
            label[p] = out
            todo += [(p[0] + 1, p[1]), (p[0] - 1, p[1]), (p[0], p[1] + 1), (p[0], p[1] - 1)]
    return label


def test_regions_and_speckles(spark):
    a = image(4, 24, 0.5)
    mask = ~np.isnan(a)
    want = plain_regions(mask)
    df = pixels(spark, a).select("image_id", "x", "y")
    got = {(r.x, r.y): r.region for r in rs.regions(df).collect()}
    assert set(got) == {(int(x), int(y)) for x, y in want}
    assert len(set(got.values())) == len(set(want.values())) == len({(got[int(x), int(y)], n) for (x, y), n in want.items()})
    size = pd.Series(list(want.values())).value_counts()
    kept = {(r.x, r.y) for r in rs.remove_speckles(df, 4).collect()}
    assert kept == {(int(x), int(y)) for (x, y), n in want.items() if size[n] > 4}
    rings = [(x, y) for x in range(4) for y in range(4) if x in (0, 3) or y in (0, 3)]  # 12 pixels around 4
    rings += [(10 + x, y) for x, y in [(0, 0), (1, 0), (2, 0), (0, 1), (2, 1), (0, 2), (1, 2)]]  # 7 pixels, open at a corner
    rings += [(20 + i, 0) for i in range(15)]
    ring = spark.createDataFrame([(0, x, y) for x, y in rings], "image_id int, x int, y int")
    left = lambda most: {(r.x, r.y) for r in rs.remove_speckles(ring, most).collect()}
    assert left(15) == {p for p in rings if p[0] < 10} and left(16) == set() and left(14) == {p for p in rings if p[0] < 10 or p[0] >= 20}


def test_geometries_of_all_types(spark):
    from geoquilt.sources import features

    geometries = [
        '{"type": "Point", "coordinates": [1, 2]}', '{"type": "MultiPoint", "coordinates": [[1, 2], [3, 4.5]]}', '{"type": "LineString", "coordinates": [[0, 0], [1, 1]]}',
        '{"type": "MultiLineString", "coordinates": [[[0, 0], [1, 1]], [[2, 2], [3, 3]]]}', '{"type": "Polygon", "coordinates": [[[0, 0], [1, 0], [0, 1], [0, 0]]]}',
        '{"type": "MultiPolygon", "coordinates": [[[[0, 0], [1, 0], [0, 1], [0, 0]]], [[[5, 5], [6, 5], [5, 6], [5, 5]]]]}',
        '{"type": "GeometryCollection", "geometries": [{"type": "Point", "coordinates": [9, 9]}, {"type": "LineString", "coordinates": [[0, 0], [1, 1]]}]}',
    ]
    lines = spark.createDataFrame([(f'{{"type": "Feature", "properties": {{"n": {i}}}, "geometry": {g}}}',) for i, g in enumerate(geometries)] + [('{"type": "Feature", "geometry": null}',)], "value string")
    rows = features.vertices(features.parse_features(lines)).collect()
    parts = {}
    for r in sorted(rows, key=lambda r: (r.properties["n"], r.geom_type, r.part, r.vertex)):
        parts.setdefault((int(r.properties["n"]), r.geom_type, r.part), []).append((r.x, r.y))
    square = [(0, 0), (1, 0), (0, 1), (0, 0)]
    assert parts == {
        (0, "Point", 0): [(1, 2)], (1, "MultiPoint", 0): [(1, 2)], (1, "MultiPoint", 1): [(3, 4.5)], (2, "LineString", 0): [(0, 0), (1, 1)], (3, "MultiLineString", 0): [(0, 0), (1, 1)],
        (3, "MultiLineString", 1): [(2, 2), (3, 3)], (4, "Polygon", 0): square, (5, "MultiPolygon", 0): square, (5, "MultiPolygon", 1): [(5, 5), (6, 5), (5, 6), (5, 5)],
        (6, "Point", 0): [(9, 9)], (6, "LineString", 0): [(0, 0), (1, 1)],
    }


def test_descriptor_blocks(spark, monkeypatch):
    monkeypatch.setattr(tp, "BLOCK", 7)
    rng = np.random.default_rng(8)
    rows = [(int(rng.integers(0, 3)), i, rng.integers(0, 4, 5).astype(float).tolist()) for i in range(90)]
    df = spark.createDataFrame(rows, "tile_id int, vec_id long, embedding array<double>")
    a, b = df.filter("vec_id % 2 = 0"), df.filter("vec_id % 2 = 1")
    got = {(r.id_a, r["rank"]): (r.id_b, round(r.distance, 9)) for r in tp.descriptor_matches(a, b, 3).collect()}
    want = {}
    for t, i, e in rows:
        if i % 2 == 0:
            near = sorted((round(float(np.sqrt(((np.array(e) - np.array(f)) ** 2).sum())), 9), j) for u, j, f in rows if u == t and j % 2)
            want |= {(i, n + 1): (j, d) for n, (d, j) in enumerate(near[:3])}
    assert got == want


def test_components_of_a_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(100)] + [(200, 300), (300, 250)], "a long, b long")
    roots = {r.node: r.root for r in components(edges, "a", "b").collect()}
    assert roots == {**{i: 0 for i in range(101)}, 200: 200, 250: 200, 300: 200}


def test_boundary_closes(spark):
    edges = rs.boundary_edges(pixels(spark, image(5, 12)).select("image_id", "x", "y")).collect()
    starts, ends = sorted((e.x0, e.y0) for e in edges), sorted((e.x1, e.y1) for e in edges)
    assert starts == ends
    one = rs.boundary_edges(spark.createDataFrame([(0, 2, 3)], "image_id int, x int, y int")).collect()
    assert len(one) == 4


def test_corners_find_a_square(spark):
    a = np.zeros((64, 64))
    a[20:40, 24:44] = 50
    found = {(r.x, r.y) for r in rs.detect(pixels(spark, a), "min_eigen", tile=32, most=4).collect()}
    for cx, cy in ((24, 20), (43, 20), (24, 39), (43, 39)):
        assert any(abs(x - cx) <= 2 and abs(y - cy) <= 2 for x, y in found)
    with pytest.raises(ValueError):
        rs.detect(pixels(spark, a), "no such")
    rs.register_detector("mine", lambda px, **o: px.limit(1))
    assert rs.detect(pixels(spark, a), "mine").count() == 1


def test_overview_means(spark):
    a = image(6, 32, 1.0)
    top = {(r.x, r.y): r.v for r in rs.overviews(pixels(spark, a), 32, 32, 8).filter("level = 2").collect()}
    assert all(abs(top[x, y] - a[4 * y : 4 * y + 4, 4 * x : 4 * x + 4].mean()) < 1e-9 for x in range(8) for y in range(8))


def test_polygon_distance(spark):
    tri = [(0.0, 0.0), (4.0, 0.0), (0.0, 3.0), (0.0, 0.0)]
    ring = F.array(*[F.struct(F.lit(x).alias("x"), F.lit(y).alias("y")) for x, y in tri])
    df = spark.createDataFrame([(1.0, 1.0), (5.0, 0.0), (2.0, -3.0), (4.0, 3.0)], "x double, y double")
    got = [r[0] for r in df.select(spatial.ring_distance(F.col("x"), F.col("y"), ring)).collect()]
    assert np.allclose(got, [0, 1, 3, 12 / 5])


def test_pair_once_per_overlap(spark):
    boxes = spark.createDataFrame([(1, 0.0, 0.0, 35.0, 35.0), (2, 5.0, 5.0, 33.0, 33.0), (3, 35.0, 0.0, 40.0, 9.0)], "id int, min_x double, min_y double, max_x double, max_y double")
    pairs = sorted((r.id_a, r.id_b) for r in spatial.box_pairs(boxes, boxes, 10.0).filter("id_a < id_b").collect())
    assert pairs == [(1, 2)]
    assert sorted((r.id_a, r.id_b) for r in spatial.box_pairs(boxes, boxes, 10.0, strict=False).filter("id_a < id_b").collect()) == [(1, 2), (1, 3)]


def test_geojson_round_trip(spark, tmp_path):
    boxes = spark.createDataFrame([(7, 1.123456789, 2.0, 3.0, 4.0)], "cell_id long, min_lon double, min_lat double, max_lon double, max_lat double")
    rings = spatial.rings_of_boxes(boxes).withColumn("rings", F.array("ring"))
    vf.write_geojson(rings, "rings", ["cell_id"], str(tmp_path / "g"))
    back = vf.scan_features(spark, str(tmp_path / "g")).first()
    assert back.properties == {"cell_id": "7"} and back.geom_type == "Polygon" and back.rings[0][0] == (1.12345679, 2.0) and len(back.rings[0]) == 5
    with pytest.raises(ValueError):
        vf.layer(spark, {"a": boxes})
    assert vf.layer(spark, {"a": boxes}, name="a").count() == 1


def test_pyramid_files(spark, tmp_path):
    tiles = spark.createDataFrame([("t", 1, 0, 0, 5), ("t", 1, 1, 0, 6)], "table_name string, zoom_level int, tile_column int, tile_row int, v int")
    path = str(tmp_path / "p")
    pyramid.write_pyramid(tiles, path)
    plan = pyramid.tile_lookup(spark.read.parquet(path), 1, 1, 0)._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(zoom_level" in plan and "EqualTo(tile_column,1)" in plan
    pyramid.append_levels(spark, path, tiles.drop("table_name").withColumn("zoom_level", F.lit(2)), "t")
    assert spark.read.parquet(path).count() == 4
    for zoom in (1, 0):
        with pytest.raises(ValueError):
            pyramid.append_levels(spark, path, tiles.drop("table_name").withColumn("zoom_level", F.lit(zoom)), "t")
    with pytest.raises(ValueError):
        pyramid.write_pyramid(tiles.unionByName(tiles), str(tmp_path / "q"))


def test_point_fields(spark):
    df = spark.createDataFrame([(1, 0.0, 1.0, 2.0, 3, 9)], "point_id long, x double, y double, z double, intensity int, red int")
    assert pc.scan_points(df, ["intensity", "gps_time"]).columns == ["point_id", "x", "y", "z", "intensity"]
    assert pc.available_fields(df, ["intensity", "gps_time", "red"]) == 0b101
    assert pc.normalise(df, ["red"]).first().red == 0.0


def test_dateline_cases(spark):
    lines = {0: [178.5, 179.5, -179.9, -178.0], 1: [179.2, 178.3, -179.1], 2: [-178.2, -179.3, 179.9, 178.0], 3: [-179.5, -178.4, 179.0], 4: [10.0, 20.0]}
    df = spark.createDataFrame([(k, i, v) for k, vs in lines.items() for i, v in enumerate(vs)], "k int, i int, lon double")
    from geoquilt.operators.swath import crosses_dateline

    assert {r.k: r.crosses for r in crosses_dateline(df, "k", "i").collect()} == {0: True, 1: False, 2: True, 3: False, 4: False}


@pytest.mark.skipif(not os.path.exists(SF), reason="needs the test tables")
@pytest.mark.parametrize("name", ["tie_point_quality", "a9_overviews", "j3_point_in_cell", "w10_filter_with_parallax"])
def test_partitions_do_not_matter(spark, name):
    from geoquilt import registry

    results = []
    for n in ("1", "8"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        results.append(sorted(map(str, registry.queries()[name](spark, SF).collect())))
    assert results[0] == results[1]


def test_components_without_sending(spark, monkeypatch):
    from geoquilt.operators import graph

    monkeypatch.setattr(graph, "SENT", 0)
    rng = np.random.default_rng(7)
    pairs = [(int(a), int(b)) for a, b in rng.integers(0, 300, (260, 2))]
    root = list(range(300))
    for _ in range(300):
        for a, b in pairs:
            root[a] = root[b] = min(root[a], root[b])
    want = {n: root[n] for p in pairs for n in p if p[0] != p[1]}
    assert {r.node: r.root for r in components(spark.createDataFrame(pairs, "a long, b long"), "a", "b").collect()} == want


def test_convex_overlap_and_tiles_inside(spark):
    v = lambda *points: [(float(x), float(y)) for x, y in points]
    square, corner = v((0, 0), (100, 0), (100, 100), (0, 100)), v((0, 0), (200, 0), (0, 200))
    df = spark.createDataFrame([(1, square), (2, corner), (3, v((100, 0), (150, 0), (150, 50))), (4, v((300, 300), (301, 300), (300, 301)))], "id int, ring array<struct<x double, y double>>")
    pairs = spark.createDataFrame([(1, 2), (1, 3), (1, 4), (2, 2)], "id_a int, id_b int")
    found = {(r.id_a, r.id_b): r for r in spatial.footprint_overlaps(pairs, df).collect()}
    assert set(found) == {(1, 2), (2, 2)}  # one side in common is no area
    assert found[1, 2].area == 10_000 and found[2, 2].area == 20_000 and found[1, 2].max_x == 100
    o = spark.createDataFrame([(7, 0, 0, 200, 200, corner)], "image_id int, x0 int, y0 int, width int, height int, ring array<struct<x double, y double>>")
    tiles = {(r.x, r.y) for r in spatial.search_tiles(o, 50, 0).collect()}
    assert tiles == {(x, y) for x in (0, 50, 100) for y in (0, 50, 100) if x + y + 100 <= 200}
    assert spatial.search_tiles(o.drop("ring"), 50, 0).count() == 9


def test_templates_on_any_tile(spark):
    a = image(8, 48, 0.9)
    b = np.roll(a, (1, -2), (0, 1))
    features = spark.createDataFrame([(1, 15, 16), (2, 16, 31), (3, 30, 20)], "feature_id long, x int, y int")
    got = [{(r.feature_id, r.dx, r.dy): (r.n, round(r.ncc, 9)) for r in rs.template_matches(pixels(spark, a), pixels(spark, b), features, 2, 3, 9, tile=tile).collect()} for tile in (8, 16, 64)]
    assert got[0] == got[1] == got[2] and all(got[0][f, -2, 1][1] == 1.0 for f in (1, 2, 3))


def test_overviews_share_an_exchange(spark):
    a = image(6, 64, 0.8)
    plan = rs.overviews(pixels(spark, a), 64, 64, 8)._jdf.queryExecution().optimizedPlan().toString()
    assert len(set(line.split("RepartitionByExpression")[1] for line in plan.splitlines() if "RepartitionByExpression" in line)) <= 3
    deep = {(r.level, r.x, r.y): r.v for r in rs.overviews(pixels(spark, a), 64, 64, 1).collect()}
    now, level = a, 0
    while len(now) > 1:
        now, level = np.nanmean(np.stack([now[::2, ::2], now[1::2, ::2], now[::2, 1::2], now[1::2, 1::2]]), 0), level + 1
        want = {(level, x, y): now[y, x] for y in range(len(now)) for x in range(len(now)) if not np.isnan(now[y, x])}
        assert want.keys() == {k for k in deep if k[0] == level} and all(abs(deep[k] - want[k]) < 1e-9 for k in want)


def test_rings_bound_their_regions(spark):
    """Corners of a ring follow one another, areas and holes equal a flood fill, and pixels that touch at a corner part."""
    rng = np.random.default_rng(11)
    a = rng.random((24, 24)) < 0.62
    a[2:12, 2:12] = True
    a[4:10, 4:10] = False
    a[6, 6] = True  # an island in a hole
    ys, xs = np.nonzero(a)
    mask = spark.createDataFrame([(0, int(x), int(y)) for x, y in zip(xs, ys)], "image_id int, x int, y int")
    rings = rs.rings(mask).toPandas().sort_values(["ring", "seq"])
    assert len(rings) == rs.straight_sides(rs.boundary_edges(mask)).count()
    for _, r in rings.groupby("ring"):
        assert list(r["seq"]) == list(range(len(r)))
        assert list(zip(r["x1"], r["y1"])) == list(zip(np.roll(r["x"], -1), np.roll(r["y"], -1)))
        assert (r["dx"] * np.roll(r["dx"], 1) + r["dy"] * np.roll(r["dy"], 1) == 0).all()
    areas = rs.ring_areas(rs.rings(mask)).toPandas()
    label = plain_regions(a)
    region = [label[x, y] for x, y in zip(areas["px"], areas["py"])]
    sizes = pd.Series(list(label.values())).value_counts()
    assert areas.groupby(region)["area"].sum().to_dict() == sizes.to_dict()  # the outline less the holes
    assert (areas[areas["area"] > 0].groupby([r for r, n in zip(region, areas["area"]) if n > 0]).size() == 1).all() and (areas["area"] < 0).any()


def test_nutation_frames_return(spark):
    df = spark.createDataFrame([(0.3, 2451600.25, 7e6, 1e5, 2e6, 10.0, 7e3, -3.0)], "a double, jd double, x double, y double, z double, u double, v double, w double")
    df = df.withColumns(dict(zip(("psi", "eps"), to.nutation(F.col("jd")), strict=True)))
    p, v = to.mean_inertial_to_earth(F.col("a"), F.col("psi"), F.col("eps"), [F.col(c) for c in "xyz"], [F.col(c) for c in "uvw"])
    there = df.select("a", "psi", "eps", *[c.alias(n) for n, c in zip("xyzuvw", [*p, *v], strict=True)])
    bp, bv = to.earth_to_mean_inertial(F.col("a"), F.col("psi"), F.col("eps"), [F.col(c) for c in "xyz"], [F.col(c) for c in "uvw"])
    assert np.allclose(list(there.select(*bp, *bv).first()), [7e6, 1e5, 2e6, 10.0, 7e3, -3.0])
    plain, _ = to.inertial_to_earth(F.col("a"), [F.col(c) for c in "xyz"], [F.col(c) for c in "uvw"])
    apart = np.array(list(df.select(*plain).first())) - np.array(list(there.select("x", "y", "z").first()))
    assert 1 < np.linalg.norm(apart) < 7.3e6 * 1.2e-4  # the nutation turns the frame, by 24 seconds of arc at most


def test_grid_search_over_a_curved_grid(spark):
    where = lambda u, v: (179.0 + 0.2 * u + 0.02 * v + 0.003 * u * v, 10.0 + 0.15 * v - 0.01 * u + 0.002 * v * v)
    wrap = lambda lon: lon - 360 if lon > 180 else lon
    nodes = [(1, u, v, wrap(where(u, v)[0]), where(u, v)[1]) for u in range(9) for v in range(7)]
    grids = spark.createDataFrame([*nodes, (2, 0, 0, 1.0, 1.0)], "image_id int, gx int, gy int, lon double, lat double")
    rng = np.random.default_rng(5)
    grid = np.array([[where(u, v) for u in range(9)] for v in range(7)])
    truth = {i: (float(rng.uniform(0.01, 7.99)), float(rng.uniform(0.01, 5.99))) for i in range(300)}
    rows = []
    for i, (u, v) in truth.items():
        lon, lat = sensors.bilinear(grid, np.array([u]), np.array([v]))[0]
        rows.append((1, i, wrap(float(lon)), float(lat)))
    odd = [(1, 900, 100.0, 10.0), (1, 901, None, 10.0), (2, 902, 1.0, 1.0), (3, 903, 1.0, 1.0)]
    places = spark.createDataFrame(rows + odd, "image_id int, point_id long, lon double, lat double")
    got = {r.point_id: (r.samp, r.line) for r in sensors.place_in_grids(places, grids, tolerance=1e-9, block=64).collect()}
    assert set(got) == set(truth) | {900, 901, 902, 903}
    assert all(np.allclose(got[i], truth[i], atol=1e-6) for i in truth)
    assert all(got[i] == (None, None) for i in (900, 901, 902, 903))


def test_layer_info(spark):
    lines = ['{"type":"Feature","properties":{"layer":"a"},"geometry":{"type":"Point","coordinates":[1,2]}}', '{"type":"Feature","properties":{"layer":"a"},"geometry":{"type":"LineString","coordinates":[[0,5],[3,4]]}}', '{"type":"Feature","properties":{"layer":"b"},"geometry":{"type":"Polygon","coordinates":[]}}']
    f = vf.parse_features(spark.createDataFrame([(x,) for x in lines], "value string")).withColumn("layer", F.col("properties")["layer"])
    got = {r.layer: tuple(r)[1:] for r in vf.layer_info(f).collect()}
    assert got == {"a": (2, ["LineString", "Point"], 3, 0.0, 2.0, 3.0, 5.0), "b": (1, ["Polygon"], 0, None, None, None, None)}


def test_descriptors_and_matchers_by_name(spark):
    a = image(3, 24, 0.9)
    pixels = spark.createDataFrame([(0, x, y, float(a[y, x])) for y in range(24) for x in range(24) if not np.isnan(a[y, x])], "image_id int, x int, y int, v double")
    features = spark.createDataFrame([(0, x, y) for x in (0, 5, 12, 23) for y in (3, 11, 20)], "image_id int, x int, y int")
    found = rs.describe(pixels, features, "census", radius=2)
    bits = {}
    for r in found.collect():
        around = np.full((5, 5), np.nan)
        for j in range(5):
            for i in range(5):
                x, y = r.x + i - 2, r.y + j - 2
                if 0 <= x < 24 and 0 <= y < 24:
                    around[j, i] = a[y, x]
        want = (np.nan_to_num(around - np.nanmean(around)) > 1e-9).ravel()
        got = np.unpackbits(np.array(r.embedding, np.uint8), bitorder="little")[:25].astype(bool)
        assert len(r.embedding) == 4 and (got == want).all()
        bits[r.x * 100 + r.y] = want
    left = found.select(F.lit(0).alias("tile_id"), (F.col("x") * 100 + F.col("y")).cast("long").alias("vec_id"), "embedding")
    for r in tp.match(left, left, 2, "hamming").filter("rank = 2").collect():
        others = sorted((int((bits[r.id_a] != b).sum()), k) for k, b in bits.items())
        assert r.distance == others[1][0]
    near = tp.match(left, left, 1, "lsh").collect()
    assert len(near) == len(bits) and all(r.distance == 0 for r in near)
    rs.register_descriptor("plain", lambda pixels, features: rs.patch_descriptors(pixels, features, 1))
    assert len(rs.describe(pixels, features, "plain").first().embedding) == 9
    for call in (lambda: rs.describe(pixels, features, "none"), lambda: tp.match(left, left, 1, "none")):
        with pytest.raises(ValueError):
            call()


def test_raster_steps_and_probed_defaults(spark):
    tiles = spark.createDataFrame([(7, 2, 3, 5, 4), (8, 0, 0, 1, 1), (9, 0, 0, 0, 4)], "tile_id int, x int, y int, w int, h int")
    got = sorted((r.tile_id, r.x, r.y) for r in rs.raster_steps(tiles, 2).collect())
    assert got == [(7, x, y) for x in (2, 4, 6) for y in (3, 5)] + [(8, 0, 0)]
    shape = "table_name string, zoom_level int, tile_id long, bands int, scalar string, tile_width int, tile_height int"
    rows = spark.createDataFrame([("a", 1, 5, 4, "u16", 128, None), ("a", 0, 1, 1, "u8", 64, 64), ("a", 1, 9, 2, "u8", 64, 64)], shape)
    names = spark.createDataFrame([("a",), ("b",)], "table_name string")
    assert sorted(tuple(r) for r in pyramid.probe_shapes(rows, names).collect()) == [("a", 1, 4, "u16", 128, 256), ("b", None, 3, "u8", 256, 256)]


def test_regions_and_rings_far_out(spark):
    """Places beyond 2 ** 20, and large image numbers, don't clash: in packed numbers (2 ** 20 + 5, 0) would be (5, 1)."""
    far = [(7, (1 << 20) + 5, 0), (7, 5, 1), (7, 6, 1), (7, (1 << 30) + 1, (1 << 30)), (7, (1 << 30) + 2, (1 << 30)), (2_000_000_000, 5, 1)]
    df = spark.createDataFrame(far, "image_id int, x int, y int")
    groups = {}
    for r in rs.regions(df).collect():
        groups.setdefault(r.region, set()).add((r.image_id, r.x, r.y))
    assert sorted(map(sorted, groups.values())) == [[far[1], far[2]], [far[0]], [far[3], far[4]], [far[5]]]
    assert {(r.image_id, r.x, r.y) for r in rs.remove_speckles(df, 1).collect()} == {far[1], far[2], far[3], far[4]}
    rings = rs.rings(df)
    assert sorted((r.image_id, abs(r.area)) for r in rs.ring_areas(rings).collect()) == [(7, 1), (7, 2), (7, 2), (2_000_000_000, 1)]
    assert rings.count() == 16 and rings.select("ring").distinct().count() == 4


def test_collections_and_files_of_one_document(spark, tmp_path):
    one = '{"type":"Feature","properties":{"a":"%s"},"geometry":{"type":"Point","coordinates":[%s,2]}}'
    both = '{"type":"FeatureCollection","name":"layer","features":[' + one % ("x", 1) + ",\n" + one % ("y", 2) + ',{"type":"Feature","properties":null,"geometry":null}]}'
    (tmp_path / "lines").mkdir()
    (tmp_path / "lines" / "a.json").write_text("\n" + one % ("p", 3) + "\n" + both.replace("\n", "") + "\nnonsense\n" + '{"type":"Point","coordinates":[9,2]}\n')
    (tmp_path / "whole").mkdir()
    (tmp_path / "whole" / "b.geojson").write_text("\n  " + both.replace("[", "[\n"))
    (tmp_path / "whole" / "c.geojson").write_text(one % ("z", 4))
    got = lambda df: sorted(((r.properties or {}).get("a", "-"), r.rings[0][0].x) for r in df.collect())
    assert got(vf.scan_features(spark, str(tmp_path / "lines"))) == [("-", 9.0), ("p", 3.0), ("x", 1.0), ("y", 2.0)]
    assert got(vf.scan_features(spark, str(tmp_path / "whole"))) == [("x", 1.0), ("y", 2.0), ("z", 4.0)]
    assert got(vf.scan_features(spark, str(tmp_path / "lines"), by_line=True)) == [("-", 9.0), ("p", 3.0), ("x", 1.0), ("y", 2.0)]
    assert tuple(vf.unread_documents(vf.documents(spark, str(tmp_path / "lines"))).first()) == (4, 1)
    assert tuple(vf.unread_documents(vf.documents(spark, str(tmp_path / "whole"))).first()) == (2, 0)


def test_dense_correlation_is_that_of_steps(spark):
    rng = np.random.default_rng(8)
    rows = [(i, x, y, float(rng.integers(0, 9))) for i in (0, 1) for x in range(70) for y in range(20) if rng.random() < 0.7]
    px = spark.createDataFrame(rows, "image_id int, x int, y int, v double")
    a, b = (px.filter(f"image_id = {i}").select(F.lit(3).alias("pair"), "x", "y", "v") for i in (0, 1))
    tiles = spark.createDataFrame([(3, 0, 0, 30, 20), (3, 30, 5, 40, 10)], "pair int, x int, y int, w int, h int")
    steps = rs.raster_steps(tiles, 1)
    x, y = rs.pixel_of(F.col("feature_id"))
    want = rs.template_matches(a, b, steps, 2, 1, 6, ("pair",), 16).select("pair", x.alias("x"), y.alias("y"), "dx", "dy", "n", F.round("ncc", 9).alias("ncc"))
    got = rs.dense_matches(a, b, tiles, 2, 1, 6, ("pair",), None, 16).withColumn("ncc", F.round("ncc", 9))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect())) and got.count() > 5000
    best = {}
    for r in got.collect():
        best.setdefault((r.x, r.y), []).append((-r.ncc, r.dy, r.dx))
    top = rs.dense_matches(a, b, tiles, 2, 1, 6, ("pair",), 1, 16).collect()
    assert len(top) == len(best) and all(abs(-r.ncc - min(best[r.x, r.y])[0]) < 1e-8 for r in top)


def test_voids_of_any_size(spark):
    from geoquilt.operators import points as pc

    known = [(-3, 5, 1.0), (60, 5, 3.0), (0, 40, 2.0)]
    out = pc.fill_all_voids(spark.createDataFrame(known, "cx int, cy int, z double")).collect()
    assert len(out) == 64 * 36 and {(r.cx, r.cy) for r in out} == {(x, y) for x in range(-3, 61) for y in range(5, 41)}
    assert {(r.cx, r.cy, r.z) for r in out if not r.filled} == set(known) and all(1.0 <= r.z <= 3.0 for r in out)
    full = spark.createDataFrame([(0, 0, 1.0), (1, 0, 2.0)], "cx int, cy int, z double")
    assert sorted(map(tuple, pc.fill_all_voids(full).collect())) == [(0, 0, 1.0, False), (1, 0, 2.0, False)]
    assert pc.fill_all_voids(full.limit(0)).count() == 0


def test_clustered_points_prune_files(spark, tmp_path):
    """A rectangle reads few files and row groups, and gives what a filter of all points gives."""
    from geoquilt.operators import points as pc

    rng = np.random.default_rng(2)
    pdf = pd.DataFrame({"point_id": np.arange(40_000), "x": rng.uniform(-180, 180, 40_000), "y": rng.uniform(-90, 90, 40_000)})
    pdf.loc[:15_000, ["x", "y"]] = (12.5, 7.25)  # one place has many
    df = spark.createDataFrame(pdf)
    path = str(tmp_path / "c")
    layout = pc.write_clustered(df, path)
    for box in [(10.0, 5.0, 14.0, 9.0), (-180.0, -90.0, 180.0, 90.0), (100.0, 40.0, 100.5, 40.5), (12.5, 7.25, 12.5, 7.25), (200.0, 0.0, 300.0, 1.0), (5.0, 5.0, 4.0, 4.0)]:
        inside = (pdf["x"] >= box[0]) & (pdf["x"] <= box[2]) & (pdf["y"] >= box[1]) & (pdf["y"] <= box[3])
        assert sorted(r.point_id for r in pc.clustered_in_bounds(spark, path, *box).collect()) == list(pdf["point_id"][inside])
        assert len(layout.key_ranges(*box)) <= 32
    small = pc.clustered_in_bounds(spark, path, 100.0, 40.0, 100.5, 40.5)
    small.collect()
    leaf = small._jdf.queryExecution().executedPlan().collectLeaves().apply(0)
    files = lambda d: leaf.metrics().apply("numFiles").value()
    total = len(list((tmp_path / "c").glob("zone=*/*.parquet")))
    assert files(small) < total / 4
    plan = leaf.verboseStringWithOperatorId()
    assert "GreaterThanOrEqual(key" in plan and "PartitionFilters: [" in plan and "zone" in plan.split("PartitionFilters: [")[1].split("]")[0]
    ids = [r.point_id for r in spark.read.parquet(path).select("point_id").collect()]
    assert sorted(ids) == list(range(40_000))
    assert pc.clustered_in_bounds(spark, str(tmp_path / "d"), 0, 0, 1, 1).count() == 0 if pc.write_clustered(df.limit(0), str(tmp_path / "d")) else False


def test_hot_cells_are_cut(spark):
    """All points in one cell: both sides go one level deeper, and the answer is that of no cut."""
    rng = np.random.default_rng(4)
    pts = spark.createDataFrame([(i, float(rng.uniform(0, 10)), float(rng.uniform(0, 10)), 0.0) for i in range(4000)] + [(9000, -5.0, 3.0, 0.0), (9001, 10.0, 10.0, 0.0)], "gp_id long, lon double, lat double, h double")
    boxes = spark.createDataFrame([(k, float(x), float(y), float(x + w), float(y + w)) for k in range(60) for x, y, w in [(rng.uniform(-12, 10), rng.uniform(-12, 10), rng.uniform(0, 9))]] + [(99, 10.0, 10.0, 10.0, 10.0)], "cell_id long, min_lon double, min_lat double, max_lon double, max_lat double")
    rows = lambda df: sorted(map(tuple, df.select("gp_id", "cell_id").collect()))
    want = rows(spatial.points_in_boxes(pts, boxes, 10.0))
    assert rows(spatial.points_in_boxes(pts, boxes, 10.0, hot=500)) == want and len(want) == 4002
    known = [tuple(b) for b in boxes.collect()]
    plain = {i: max((k for k, a, b, c, d in known if a <= x <= c and b <= y <= d), default=None) for i, x, y, _ in pts.collect()}
    assert dict(want) == plain
