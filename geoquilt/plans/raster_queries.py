"""Queries on rasters."""

from __future__ import annotations

from pyspark.sql import functions as F

from geoquilt.operators import raster as rs
from geoquilt.operators import tiepoints as tp
from geoquilt.plans.catalog import INPUTS, query
from geoquilt.sources.shared import materialize

SIDE = 256
INPUTS["images"] = "SELECT DISTINCT CAST(l_suppkey % 2 AS INT) AS image_id FROM lineitem"
INPUTS["paths"] = "SELECT o_custkey AS path, o_orderkey AS seq, o_orderkey % 5 = 0 AS masked FROM orders"
GRID = "g AS (SELECT image_id, x, y FROM images, range(0, 256) a(x), range(0, 256) b(y))"


@query("s4_tile_status", """SELECT i.image_id, CAST(a.tx AS INT) AS tile_x, CAST(b.ty AS INT) AS tile_y, count(v) AS n, CASE WHEN count(v) = 0 THEN 'EMPTY' WHEN count(v) < 16 THEN 'PARTIAL' ELSE 'FULL' END AS status
FROM images i CROSS JOIN range(0, 64) a(tx) CROSS JOIN range(0, 64) b(ty) LEFT JOIN pixels p ON p.image_id = i.image_id AND p.x // 4 = a.tx AND p.y // 4 = b.ty GROUP BY 1, 2, 3""")
def s4(t):
    return rs.tile_status(t.pixels, t.images, SIDE, SIDE, 4)


@query("s10_expand_palette", "SELECT image_id, x, y, coalesce(r, 0) AS r, coalesce(g, 0) AS g, coalesce(b, 0) AS b FROM pixels LEFT JOIN (SELECT * FROM palette WHERE idx <> 7) q ON v = idx")
def s10(t):
    return rs.expand_palette(t.pixels, t.palette.filter("idx <> 7"))


@query("s11_palette_null", "SELECT min(CASE WHEN idx % 11 = 5 THEN idx END) AS null_index, 'preserve' AS mode FROM palette UNION ALL SELECT min(CASE WHEN r - g = 0 AND b % 4 = 0 THEN idx END), 'black' FROM palette")
def s11(t):
    lut = t.palette.select("idx", (F.col("r") - F.col("g")).alias("r"), F.lit(0).alias("g"), (F.col("b") % 4).alias("b"), F.when(F.col("idx") % 11 == 5, 0).otherwise(255).alias("a"))
    return rs.palette_null_index(lut, True).withColumn("mode", F.lit("preserve")).unionByName(rs.palette_null_index(lut, False).withColumn("mode", F.lit("black")))


@query("s12_stretch", "WITH s AS (SELECT image_id, min(v) AS a, max(v) AS b FROM pixels GROUP BY 1) SELECT image_id, x, y, CAST(floor((v - a) / CAST(b - a AS DOUBLE) * 255 + 0.5) AS INT) AS v FROM pixels JOIN s USING (image_id)")
def s12(t):
    return rs.stretch(t.pixels, rs.band_stats(t.pixels, t.images.filter("image_id < 0")))


@query("s14_alpha", f"WITH {GRID} SELECT image_id, CAST(x AS INT) AS x, CAST(y AS INT) AS y, CASE WHEN v IS NULL THEN 0 ELSE 255 END AS alpha FROM g LEFT JOIN pixels USING (image_id, x, y)")
def s14(t):
    return rs.alpha_channel(t.pixels, t.images, SIDE, SIDE)


@query("s15_ycc_to_rgb", """WITH c AS (SELECT image_id, x // 2 AS cx, y // 2 AS cy, CAST(max(v)*5 % 256 AS INT) - 128 AS cb, CAST(min(v)*3 % 256 AS INT) - 128 AS cr FROM pixels GROUP BY 1, 2, 3), j AS (SELECT p.image_id, x, y, v*4 AS l, cb, cr FROM pixels p JOIN c ON p.image_id = c.image_id AND x // 2 = cx AND y // 2 = cy)
SELECT image_id, x, y, least(255, greatest(0, l + CAST(trunc(CAST(1.402 AS DOUBLE)*cr) AS INT))) AS r, least(255, greatest(0, l - CAST(trunc(CAST(0.344 AS DOUBLE)*cb + CAST(0.714 AS DOUBLE)*cr) AS INT))) AS g, least(255, greatest(0, l + CAST(trunc(CAST(1.772 AS DOUBLE)*cb) AS INT))) AS b FROM j""")
def s15(t):
    chroma = t.pixels.groupBy("image_id", F.floor(F.col("x") / 2).cast("int").alias("x"), F.floor(F.col("y") / 2).cast("int").alias("y")).agg((F.max("v") * 5 % 256).alias("cb"), (F.min("v") * 3 % 256).alias("cr"))
    j = rs.upsample_chroma(t.pixels, chroma, 2, 2)
    r, g, b = rs.ycc_to_rgb(F.col("v") * 4, F.col("cb"), F.col("cr"), 128, 255)
    return j.select("image_id", "x", "y", r.alias("r"), g.alias("g"), b.alias("b"))


@query("s31_full_patches", "SELECT image_id, x // 2 AS tile_x, y // 2 AS tile_y FROM pixels GROUP BY 1, 2, 3 HAVING count(*) = 4")
def s31(t):
    return rs.tile_status(t.pixels, t.images, SIDE, SIDE, 2).filter("status = 'FULL'").select("image_id", "tile_x", "tile_y")


@query("s31b_split_complex", "SELECT image_id, x, y, 0 AS band, v FROM pixels UNION ALL SELECT image_id, x, y, 1, x - y FROM pixels")
def s31b(t):
    return rs.split_complex(t.pixels.select("image_id", "x", "y", F.lit(0).alias("band"), F.col("v").alias("re"), (F.col("x") - F.col("y")).alias("im")))


@query("r16_select_bands", "SELECT image_id AS band, x, y, v, p.position FROM pixels JOIN (VALUES (0, 1), (1, 0), (2, 0)) p(position, b) ON image_id = b")
def r16(t):
    bands = t.pixels.select((F.col("image_id") + 1).alias("band"), "x", "y", "v")
    return rs.select_bands(bands, [2, 1, 9], 2).select((F.col("band") - 1).alias("band"), "x", "y", "v", "position")


@query("a1_band_stats", "SELECT image_id, count(v) AS n, CASE WHEN image_id = 1 THEN 1.0::DOUBLE ELSE min(v)::DOUBLE END AS min_px, CASE WHEN image_id = 1 THEN 255.0::DOUBLE ELSE max(v)::DOUBLE END AS max_px, 0.0::DOUBLE AS null_px FROM pixels GROUP BY image_id")
def a1(t):
    return rs.band_stats(t.pixels, t.images.filter("image_id = 1"), "u8", 300.0)


@query("a3_valid_rect", "SELECT image_id, CAST(min(y*1000+x) % 1000 AS INT) AS ul_x, CAST(min(y*1000+x) // 1000 AS INT) AS ul_y, CAST(max(y*1000+x) % 1000 AS INT) AS lr_x, CAST(max(y*1000+x) // 1000 AS INT) AS lr_y FROM pixels GROUP BY image_id")
def a3(t):
    return rs.valid_rect(t.pixels)


A9 = "WITH a AS (SELECT image_id, x // 2 AS x, y // 2 AS y, avg(v) AS v FROM pixels GROUP BY 1, 2, 3), b AS (SELECT image_id, x // 2 AS x, y // 2 AS y, avg(v) AS v FROM a GROUP BY 1, 2, 3), c AS (SELECT image_id, x // 2 AS x, y // 2 AS y, avg(v) AS v FROM b GROUP BY 1, 2, 3)"


@query("a9_overviews", f"{A9} SELECT 1 AS level, image_id, x, y, round(v, 9) AS v FROM a UNION ALL SELECT 2, image_id, x, y, round(v, 9) FROM b UNION ALL SELECT 3, image_id, x, y, round(v, 9) FROM c")
def a9(t):
    return rs.overviews(t.pixels, SIDE, SIDE, 32).withColumn("v", F.round("v", 9))


@query("a9_overviews_nearest", "SELECT l AS level, image_id, x // m AS x, y // m AS y, CAST(v AS DOUBLE) AS v FROM pixels, (VALUES (1, 2), (2, 4), (3, 8)) s(l, m) WHERE x % m = 0 AND y % m = 0")
def a9_nearest(t):
    return rs.overviews(t.pixels, SIDE, SIDE, 32, "nearest")


@query("a14_histogram", "SELECT image_id, v, count(*) AS n FROM pixels GROUP BY 1, 2")
def a14(t):
    return rs.histogram(t.pixels)


@query("a21_palette_of_inputs", "SELECT n_regionkey, bool_and(n_nationkey % 7 <> 3) AS use_lut, CASE WHEN bool_and(n_nationkey % 7 <> 3) THEN max(n_nationkey) END AS lut FROM nation GROUP BY 1")
def a21(t):
    return rs.palette_of_inputs(t.nation.select("n_regionkey", (F.col("n_nationkey") % 7 != 3).alias("has_lut"), F.col("n_nationkey").alias("lut_id"), F.col("n_nationkey").alias("position")), "n_regionkey")


def targets(t):
    return rs.full_grid(t.images, 128, 128).select("image_id", F.col("x").alias("tx"), F.col("y").alias("ty"), (F.col("x") * 1.75 + 3.25).alias("sx"), (F.col("y") * 1.5 + 2.125).alias("sy"))


@query("k5_resample", """WITH g AS (SELECT image_id, tx, ty, tx*CAST(1.75 AS DOUBLE) + 3.25 AS sx, ty*CAST(1.5 AS DOUBLE) + 2.125 AS sy FROM images, range(0, 128) a(tx), range(0, 128) b(ty)),
c AS (SELECT image_id, tx, ty, floor(sx) + dx AS x, floor(sy) + dy AS y, (CASE WHEN dx = 1 THEN sx - floor(sx) ELSE 1 - (sx - floor(sx)) END) * (CASE WHEN dy = 1 THEN sy - floor(sy) ELSE 1 - (sy - floor(sy)) END) AS w FROM g, (VALUES (0), (1)) q(dx), (VALUES (0), (1)) r(dy))
SELECT c.image_id, CAST(tx AS INT) AS tx, CAST(ty AS INT) AS ty, round(sum(w*v)/sum(w), 9) AS v FROM c JOIN pixels p ON c.image_id = p.image_id AND c.x = p.x AND c.y = p.y WHERE w > 0 GROUP BY 1, 2, 3""")
def k5(t):
    return rs.resample(t.pixels, targets(t)).withColumn("v", F.round("v", 9))


@query("j12_outside_mask", "SELECT image_id, x, y, v FROM pixels WHERE v % 3 <> 0")
def j12(t):
    return rs.outside_mask(t.pixels, t.pixels.filter("v % 3 = 0")).select("image_id", "x", "y", "v")


@query("a18_boundary_edges", """WITH m AS (SELECT image_id, x, y FROM pixels WHERE v > 10), s AS (SELECT m.*, dx, dy, x+a AS x0, y+b AS y0, x+c AS x1, y+d AS y1 FROM m, (VALUES (0,-1,1,0,0,0), (-1,0,0,0,0,1), (0,1,0,1,1,1), (1,0,1,1,1,0)) q(dx, dy, a, b, c, d))
SELECT image_id, x0, y0, x1, y1 FROM s WHERE NOT EXISTS (SELECT 1 FROM m WHERE m.image_id = s.image_id AND m.x = s.x + s.dx AND m.y = s.y + s.dy)""")
def a18(t):
    return rs.boundary_edges(t.pixels.filter("v > 10").select("image_id", "x", "y"))


@query("a17_remove_speckles", """WITH m AS MATERIALIZED (SELECT image_id, x, y FROM pixels WHERE v > 10), o AS (SELECT image_id, x, y, x + dx AS bx, y + dy AS yy FROM m, (VALUES (1, 0), (-1, 0), (0, 1), (0, -1)) q(dx, dy)),
n AS MATERIALIZED (SELECT o.image_id, o.x, o.y, bx, yy FROM o JOIN m ON m.image_id = o.image_id AND m.x = bx AND m.y = yy), d AS MATERIALIZED (SELECT image_id, x, y, count(*) AS c FROM n GROUP BY 1, 2, 3)
SELECT image_id, x, y FROM d WHERE c >= 2 UNION SELECT n.image_id, n.x, n.y FROM n JOIN d ON d.image_id = n.image_id AND d.x = bx AND d.y = yy AND d.c >= 2""")
def a17(t):
    return rs.remove_speckles(t.pixels.filter("v > 10").select("image_id", "x", "y"))


def region_sql(joined: str) -> str:
    """Regions of the mask by closure: r with image_id, x, y and the first pixel py, px; j are further links."""
    return f"""m AS MATERIALIZED (SELECT image_id, x, y FROM pixels WHERE v > 10), {joined}
l AS MATERIALIZED (SELECT m.image_id, m.x, m.y, o.x AS bx, o.y AS yy FROM m JOIN m o ON o.image_id = m.image_id AND o.x = m.x + 1 AND o.y = m.y UNION ALL SELECT m.image_id, m.x, m.y, o.x, o.y FROM m JOIN m o ON o.image_id = m.image_id AND o.x = m.x AND o.y = m.y + 1 UNION ALL SELECT image_id, x, y, bx, yy FROM j),
b AS MATERIALIZED (SELECT * FROM l UNION ALL SELECT image_id, bx, yy, x, y FROM l),
c(image_id, x, y, bx, yy) AS (SELECT image_id, x, y, x, y FROM m UNION SELECT c.image_id, c.x, c.y, b.bx, b.yy FROM c JOIN b ON b.image_id = c.image_id AND b.x = c.bx AND b.y = c.yy),
r AS MATERIALIZED (SELECT image_id, x, y, min(yy * 1000 + bx) // 1000 AS py, min(yy * 1000 + bx) % 1000 AS px FROM c GROUP BY 1, 2, 3)"""


#: Corners at which two pixels touch alone, and of these those at which the foreground is the minority.
MINORITY = """k AS MATERIALIZED (SELECT m.image_id, m.x + 1 AS x, m.y + 1 AS y, true AS falling FROM m JOIN m o ON o.image_id = m.image_id AND o.x = m.x + 1 AND o.y = m.y + 1 WHERE NOT EXISTS (SELECT 1 FROM m q WHERE q.image_id = m.image_id AND q.x = m.x + 1 AND q.y = m.y) AND NOT EXISTS (SELECT 1 FROM m q WHERE q.image_id = m.image_id AND q.x = m.x AND q.y = m.y + 1)
UNION ALL SELECT m.image_id, m.x, m.y + 1, false FROM m JOIN m o ON o.image_id = m.image_id AND o.x = m.x - 1 AND o.y = m.y + 1 WHERE NOT EXISTS (SELECT 1 FROM m q WHERE q.image_id = m.image_id AND q.x = m.x - 1 AND q.y = m.y) AND NOT EXISTS (SELECT 1 FROM m q WHERE q.image_id = m.image_id AND q.x = m.x AND q.y = m.y + 1)),
w AS (SELECT k.image_id, k.x, k.y, falling, greatest(abs(2 * (m.x - k.x) + 1), abs(2 * (m.y - k.y) + 1)) AS ring, count(*) AS n FROM k JOIN m ON m.image_id = k.image_id AND m.x BETWEEN k.x - 4 AND k.x + 3 AND m.y BETWEEN k.y - 4 AND k.y + 3 GROUP BY ALL),
n AS (SELECT k.image_id, k.x, k.y, k.falling, coalesce(sum(n) FILTER (ring = 3), 0) - 6 AS a, coalesce(sum(n) FILTER (ring = 5), 0) - 10 AS b, coalesce(sum(n) FILTER (ring = 7), 0) - 14 AS c FROM k LEFT JOIN w ON w.image_id = k.image_id AND w.x = k.x AND w.y = k.y AND w.falling = k.falling GROUP BY ALL),
j AS (SELECT image_id, CASE WHEN falling THEN x - 1 ELSE x END AS x, y - 1 AS y, CASE WHEN falling THEN x ELSE x - 1 END AS bx, y AS yy FROM n WHERE CASE WHEN a <> 0 THEN a WHEN b <> 0 THEN b WHEN c <> 0 THEN c ELSE -1 END < 0),"""
NO_LINKS = "j AS (SELECT image_id, x, y, x AS bx, y AS yy FROM m WHERE false),"


def masked(t):
    return materialize(t.pixels.filter("v > 10").select("image_id", "x", "y"), "mask")


@query("a17_minority", f"WITH RECURSIVE {region_sql(MINORITY)} SELECT image_id, CAST(px AS INT) AS px, CAST(py AS INT) AS py, count(*) AS n_pixels FROM r GROUP BY ALL")
def a17_minority(t):
    """Regions that are joined at corners where the foreground is the minority: their first pixel and size."""
    mask = masked(t)
    first = F.min(F.struct("y", "x"))
    found = rs.regions(mask, materialize(rs.minority_contacts(mask), "joined")).groupBy("image_id", "region").agg(first.alias("f"), F.count(F.lit(1)).alias("n_pixels"))
    return found.select("image_id", F.col("f.x").alias("px"), F.col("f.y").alias("py"), "n_pixels")


#: Regions with their holes: one less the Euler number of their pixels, neighbouring pairs and full squares.
HOLES = """SELECT image_id, CAST(px AS INT) AS px, CAST(py AS INT) AS py, count(*) AS n_pixels, CAST(1 - count(*) + sum(side) - sum(four) AS INT) AS n_holes FROM (
SELECT r.*, (SELECT count(*) FROM m WHERE m.image_id = r.image_id AND ((m.x = r.x + 1 AND m.y = r.y) OR (m.x = r.x AND m.y = r.y + 1))) AS side,
(SELECT CAST(count(*) = 3 AS INT) FROM m WHERE m.image_id = r.image_id AND ((m.x = r.x + 1 AND m.y = r.y) OR (m.x = r.x AND m.y = r.y + 1) OR (m.x = r.x + 1 AND m.y = r.y + 1))) AS four FROM r) GROUP BY ALL"""


@query("p6_polygons", f"WITH RECURSIVE {region_sql(NO_LINKS)} {HOLES}")
def p6_polygons(t):
    """A polygon for each region, its outline and holes: the first pixel, pixels and number of holes."""
    found = rs.ring_polygons(materialize(rs.rings(masked(t)), "rings"))
    return found.select("image_id", "px", "py", "n_pixels", "n_holes")


@query("w4_split_paths", """WITH p AS (SELECT *, sum(masked::INT) OVER (PARTITION BY path ORDER BY seq) AS piece FROM paths), q AS (SELECT path, seq, piece, count(*) OVER (PARTITION BY path, piece) AS n FROM p WHERE NOT masked) SELECT path, seq, CAST(piece AS BIGINT) AS piece FROM q WHERE n >= 3""")
def w4(t):
    return rs.split_paths(t.paths)


def filled(t):
    """The images at full size, resampled half a pixel on, so that a null pixel is filled from its neighbours."""
    at = rs.full_grid(t.images, SIDE, SIDE).select("image_id", F.col("x").alias("tx"), F.col("y").alias("ty"), (F.col("x") + 0.5).alias("sx"), (F.col("y") + 0.5).alias("sy"))
    return rs.resample(t.pixels, at).select("image_id", F.col("tx").alias("x"), F.col("ty").alias("y"), "v")


@query("k2_corners")
def k2(t):
    return rs.detect_corners(filled(t), tile=32, quality=0.01)


@query("k3_named_detector")
def k3(t):
    image = filled(t)
    return rs.patch_descriptors(image, rs.detect(image, "harris", tile=32, quality=0.01, most=5))


@query("k3_named_matcher")
def k3_matcher(t):
    """Corners of both images by a detector, a descriptor and a matcher that are given by name, over the whole images."""
    image = filled(t)
    found = rs.describe(image, rs.detect(image, "harris", tile=32, quality=0.01, most=5), "census")
    named = found.select("image_id", F.lit(0).alias("tile_id"), (F.col("x").cast("long") * 65536 + F.col("y")).alias("vec_id"), "embedding")
    return tp.match(named.filter("image_id = 0"), named.filter("image_id = 1"), 2, "hamming")


PATCH = """WITH f AS (SELECT a*256 + b AS feature_id, a AS x, b AS y FROM range(16, 256, 32) p(a), range(16, 256, 32) q(b)), o AS (SELECT d FROM range(-2, 3) r(d)), px AS MATERIALIZED (SELECT * FROM pixels),
fp AS MATERIALIZED (SELECT feature_id, x + a.d AS x, y + b.d AS y FROM f, o a, o b), r AS MATERIALIZED (SELECT feature_id, fp.x, fp.y, CAST(v AS DOUBLE) AS a FROM fp JOIN px ON image_id = 0 AND px.x = fp.x AND px.y = fp.y),
m AS MATERIALIZED (SELECT feature_id, CAST(e.d AS INT) AS dx, CAST(g.d AS INT) AS dy, a, x + e.d AS x, y + g.d AS y FROM r, o e, o g), j AS (SELECT feature_id, dx, dy, a, CAST(v AS DOUBLE) AS b FROM m JOIN px ON image_id = 1 AND px.x = m.x AND px.y = m.y),
n AS (SELECT feature_id, dx, dy, count(*) AS n, round(corr(a, b), 9) AS ncc FROM j GROUP BY 1, 2, 3 HAVING count(*) >= 4 AND var_pop(a) > 0 AND var_pop(b) > 0)"""


def correlations(t):
    f = t.images.filter("image_id = 0").withColumn("x", F.explode(F.sequence(F.lit(16), F.lit(255), F.lit(32)))).withColumn("y", F.explode(F.sequence(F.lit(16), F.lit(255), F.lit(32))))
    f = f.select((F.col("x") * 256 + F.col("y")).cast("long").alias("feature_id"), "x", "y")
    return rs.template_matches(t.pixels.filter("image_id = 0"), t.pixels.filter("image_id = 1"), f, 2, 2, 4)


@query("j11_template_matches", f"{PATCH} SELECT * FROM n")
def j11(t):
    return correlations(t).withColumn("ncc", F.round("ncc", 9))


@query("j11_raster_step", PATCH.replace("a*256 + b AS", "a*65536 + b AS").replace("range(16, 256, 32)", "range(0, 256, 16)") + " SELECT * FROM n")
def j11_step(t):
    """Correlation at every 16th pixel of the tiles of an image, without a detector."""
    cell = F.explode(F.sequence(F.lit(0), F.lit(SIDE - 1), F.lit(64)))
    tiles = t.images.filter("image_id = 0").withColumn("x", cell).withColumn("y", cell).select("x", "y", F.lit(64).alias("w"), F.lit(64).alias("h"))
    steps = rs.raster_steps(tiles, 16).withColumn("feature_id", F.col("x").cast("long") * 65536 + F.col("y"))
    found = rs.template_matches(t.pixels.filter("image_id = 0"), t.pixels.filter("image_id = 1"), steps, 2, 2, 4)
    return found.withColumn("ncc", F.round("ncc", 9))


@query("j11_dense", PATCH.replace("a*256 + b AS", "a*65536 + b AS").replace("range(16, 256, 32)", "range(0, 256)") + " SELECT CAST(feature_id // 65536 AS INT) AS x, CAST(feature_id % 65536 AS INT) AS y, dx, dy, n, ncc FROM n")
def j11_dense(t):
    """Correlation at every pixel of an image and every offset, from summed-area tables."""
    whole = t.images.filter("image_id = 0").select(F.lit(0).alias("x"), F.lit(0).alias("y"), F.lit(SIDE).alias("w"), F.lit(SIDE).alias("h"))
    found = rs.dense_matches(t.pixels.filter("image_id = 0"), t.pixels.filter("image_id = 1"), whole, 2, 2, 4)
    return found.withColumn("ncc", F.round("ncc", 9))


#: Rows first, then columns, as sums of cosines and sines; what rounding leaves of nothing is nothing.
FOURIER = """WITH w AS MATERIALIZED (SELECT k, cos(2*pi()*k/256) AS c, sin(2*pi()*k/256) AS s FROM range(0, 256) r(k)), u AS MATERIALIZED (SELECT u FROM range(0, 256) r(u)),
a AS MATERIALIZED (SELECT image_id, y, u, sum(v*c)/256 AS re, -sum(v*s)/256 AS im FROM pixels, u, w WHERE k = (x*u) % 256 GROUP BY 1, 2, 3),
b AS (SELECT image_id, a.u AS x, n.u AS y, sum(re*c + im*s)/256 AS re, sum(im*c - re*s)/256 AS im FROM a, u n, w WHERE k = (y*n.u) % 256 GROUP BY 1, 2, 3)
SELECT image_id, CAST(x AS INT) AS x, CAST(y AS INT) AS y, CASE WHEN abs(re) < 0.0000005 THEN 0 ELSE round(re, 6) END AS re, CASE WHEN abs(im) < 0.0000005 THEN 0 ELSE round(im, 6) END AS im FROM b"""


@query("k4_fourier", FOURIER)
def k4(t):
    part = lambda c: F.when(F.abs(c) < 0.0000005, 0.0).otherwise(F.round(c, 6)).alias(c)
    return rs.fourier(t.pixels, SIDE, SIDE).select("image_id", "x", "y", part("re"), part("im"))
