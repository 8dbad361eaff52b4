"""Queries do their whole job: every row of the input is met."""

import math
import os

import pytest
from pyspark.sql import functions as F

from geoquilt import registry
from geoquilt.operators import tiepoints as tp
from geoquilt.plans import tiepoint_queries as tq
from geoquilt.plans.catalog import Inputs

SF = "/root/testdata/sf0.001"
QUERIES = registry.queries()
pytestmark = pytest.mark.skipif(not os.path.exists(SF), reason="needs the test tables")


@pytest.mark.parametrize("name", ["w9_filter_without_parallax", "w10_filter_with_parallax", "a8_consistency_all"])
def test_filters_meet_every_tie_point(spark, name):
    points = spark.read.parquet(f"{SF}/lineitem.parquet").select("l_orderkey").distinct().count()
    tiles = tp.active(tq.spread(Inputs(spark, SF))).groupBy("tile_id").count().agg(F.sum("count").alias("n"), F.max("count").alias("most")).first()
    assert tiles.n == points and tiles.most <= 40
    n = QUERIES[name](spark, SF).count()
    assert n == points if name.startswith("a8") else 1000 < n <= points


def test_written_pyramid_has_every_pixel(spark):
    from geoquilt.plans import jobs

    t = Inputs(spark, SF)
    full = jobs.pyramid_tiles(t).filter("zoom_level = 3").agg(F.sum(F.size("data")).alias("n")).first()
    assert full.n == t.pixels.count()


def test_surface_from_independent_looks(spark):
    """Points of a known surface, seen by two looks with their own states and found in the second to a tenth of a pixel."""
    import numpy as np
    import pandas as pd

    from geoquilt.functions import sensors
    from geoquilt.plans import jobs

    rng = np.random.default_rng(3)
    x, y = (c.ravel().astype(float) for c in np.meshgrid(np.arange(0, 256, 16), np.arange(0, 256, 16)))
    height = 60 * np.sin(x / 40) + 40 * np.cos(y / 30)

    def ray(column, line, start, pitch):
        w = 0.00104
        turn, zero = w * (start + line * jobs.LINE), np.zeros(len(line))
        p = 7178137.0 * np.stack([np.cos(turn), np.sin(turn), zero], 1)
        v = 7178137.0 * w * np.stack([-np.sin(turn), np.cos(turn), zero], 1)
        return p, sensors.pushbroom_ray(p, v, np.zeros((len(line), 3)), zero + pitch, (column - jobs.MIDDLE) * jobs.COLUMN)

    place = lambda g: (np.arctan2(g[:, 1], g[:, 0]) * 1e6, g[:, 2])
    ground = sensors.meet_ellipsoid(*ray(x, y, jobs.FIRST, 0.0), height)
    rows = pd.DataFrame({"h": height})
    seen = lambda part, c, r: place(sensors.meet_ellipsoid(*ray(c, r, jobs.SECOND, jobs.PITCH), part["h"].to_numpy()))
    at, _ = sensors.invert(seen, rows, np.stack(place(ground), 1), np.stack([x, y], 1), 0.5, 1e-6, 30)
    assert np.isfinite(at).all() and np.abs(at - np.stack([x, y], 1)).max() > 2
    at += rng.normal(0, 0.1, at.shape)
    m = spark.createDataFrame(pd.DataFrame({"feature_id": np.arange(len(x)), "x": x.astype(int), "y": y.astype(int), "dx": at[:, 0] - x, "dy": at[:, 1] - y}))
    found = jobs.surface_points(Inputs(spark, SF), m).toPandas().sort_values("feature_id")
    assert len(found) == len(x)
    off = found["h"].to_numpy() - height
    assert np.sqrt((off**2).mean()) < 12 and np.corrcoef(found["h"], height)[0, 1] > 0.95 and found["miss"].max() > 1e-3


@pytest.fixture(scope="module")
def shifted(spark):
    """Two images of one scene, the second two pixels to the right and one up."""
    from types import SimpleNamespace

    import numpy as np
    import pandas as pd

    rng = np.random.default_rng(5)
    scene = rng.uniform(0, 200, (300, 300))
    for _ in range(2):
        scene = (scene + np.roll(scene, 1, 0) + np.roll(scene, 1, 1) + np.roll(scene, (1, 1), (0, 1))) / 4
    parts = []
    for image, (dx, dy) in enumerate(((0, 0), (2, -1))):
        part = scene[20 - dy : 276 - dy, 20 - dx : 276 - dx]
        y, x = (c.ravel() for c in np.mgrid[0:256, 0:256])
        parts.append(pd.DataFrame({"image_id": image, "x": x, "y": y, "v": part.ravel()}).sample(frac=0.97, random_state=image))
    pixels = spark.createDataFrame(pd.concat(parts), "image_id int, x int, y int, v double")
    return SimpleNamespace(spark=spark, pixels=pixels, images=spark.createDataFrame([(0,), (1,)], "image_id int"))


def test_correlation_finds_the_shift(shifted):
    from geoquilt.plans import jobs

    found = jobs.p1(shifted).toPandas()
    tiles = found.groupby(["image_a", "image_b"])["tile_id"].nunique()
    assert dict(tiles) == {(0, 1): 9, (1, 0): 9} and len(found) == 36
    sign = found["image_b"] - found["image_a"]
    assert (found["dx"] == 2 * sign).all() and (found["dy"] == -sign).all() and (found["confidence"] > 0.8).all()


def test_descriptors_find_the_shift(shifted):
    from geoquilt.plans import jobs

    found = jobs.p2(shifted).toPandas()
    assert found["tile_id"].nunique() == 9 and set(found["image_a"]) == {0} and set(found["image_b"]) == {1}
    assert ((found["dx"] == 2) & (found["dy"] == -1)).mean() > 0.9


def test_scaled_pyramid_keeps_a_plane(spark):
    """A plane of values stays one at every scale, so each target pixel's value is that of its centre's place."""
    from geoquilt.plans import jobs

    gsd, lon, lat = 0.004, 12.0, 47.0
    pixels = spark.range(64 * 64).select(F.lit(0).alias("image_id"), (F.col("id") % 64).cast("int").alias("x"), F.floor(F.col("id") / 64).cast("int").alias("y"))
    pixels = pixels.withColumn("v", 3.0 * F.col("x") - 2.0 * F.col("y") + 500.0)
    images = spark.createDataFrame([(0, 64, 64, gsd, lon, lat)], "image_id int, width int, height int, gsd double, ul_lon double, ul_lat double")
    tiles = jobs.scaled_pyramid(pixels, images, 16).collect()
    assert len({t.zoom_level for t in tiles}) > 3 and {t.status for t in tiles} == {"FULL", "PARTIAL"}
    seen = 0
    for t in tiles:
        g = 180.0 / 16 / 2**t.zoom_level
        level = max(0, math.floor(math.log2(g / gsd)))
        margin = 2**level  # at the image's border, neighbours that aren't there lend their weight
        for p in t.data:
            x = (-180 + (t.tile_column * 16 + p.px + 0.5) * g - lon) / gsd - 0.5
            y = (lat - (90 - (t.tile_row * 16 + p.py + 0.5) * g)) / gsd - 0.5
            if margin <= x <= 63 - margin and margin <= y <= 63 - margin:
                assert abs(p.v - (3 * x - 2 * y + 500)) < 1e-6
                seen += 1
    assert seen > 1000
    none = jobs.scaled_pyramid(pixels.limit(0), images.limit(0), 16)
    assert none.count() == 0


def test_scaled_pyramid_reads_by_address(spark):
    from geoquilt.plans import jobs

    got = jobs.p3_scaled(Inputs(spark, SF)).filter("table_name = 'image0' AND zoom_level = 10 AND tile_column = 1082")
    plan = got._jdf.queryExecution().toString()
    assert "EqualTo(tile_column,1082)" in plan and "zoom_level#" in plan[plan.index("PartitionFilters") :]


def test_far_images_and_pairs_without_overlap(spark):
    """Large image numbers and far positions keep their pairs, and a pair without overlap moves no pixel."""
    import numpy as np

    from geoquilt.operators import tiepoints as tp
    from geoquilt.plans import jobs

    rng = np.random.default_rng(1)
    x0, scene = 70_000, rng.uniform(0, 255, (128, 128))
    rows = [(image, x0 + at + x, y, float(scene[y, x])) for image, at in ((5000, 0), (5001, 0), (9000, 500)) for x in range(128) for y in range(128)]
    images = spark.createDataFrame(rows, "image_id int, x int, y int, v double")
    tiles = jobs.search_tiles(images, tp.FilterSettings())
    got = tiles.collect()
    assert {(r.image_a, r.image_b) for r in got} == {(5000, 5001)} and all(x0 <= r.x < x0 + 128 for r in got)
    ends = tiles.select("image_a", "image_b", "x", "y")
    assert {(r.image_a, r.image_b) for r in jobs.pixels_around(images, ends, "image_b", 64).select("image_a", "image_b").distinct().collect()} == {(5000, 5001)}
    features = tiles.select("image_a", "image_b", "tile_id", F.col("x") + 20, F.col("y") + 20).toDF("image_a", "image_b", "tile_id", "x", "y")
    features = features.withColumn("feature_id", jobs.rs.pixel_number(F.col("x"), F.col("y")))
    found = jobs.of_pairs(jobs.correlate(images, features, tp.FilterSettings(), 2).filter("match_rank = 1"), tiles).collect()
    assert len(found) == len(got) and all((r.image_a, r.image_b, r.dx, r.dy) == (5000, 5001, 0.0, 0.0) and r.x >= x0 for r in found)
