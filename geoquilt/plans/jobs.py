"""Whole jobs: tie points, pyramids, surfaces, vectors, and streams of tiles."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from geoquilt.functions import grid, sensors
from geoquilt.functions import timeorbit as to
from geoquilt.operators import coarse
from geoquilt.operators import points as pc
from geoquilt.operators import raster as rs
from geoquilt.operators import spatial
from geoquilt.operators import tiepoints as tp
from geoquilt.plans.catalog import query
from geoquilt.plans.raster_queries import SIDE, filled
from geoquilt.plans.time_queries import states
from geoquilt.sources import pyramid
from geoquilt.sources.shared import materialize, new_path
from geoquilt.streaming import tiles as st


#: The tie-point jobs: patch radius and search tile in pixels, least part of a patch that both images have, and the
#: positional error of an image and the size of a pixel in metres, which give the search.
PATCH, TILE, SHARE, ERROR, GSD = 3, 64, 0.4, 50.0, 25.0


def search_radius(error_a: float, error_b: float, gsd: float) -> int:
    """Pixels by which the errors of two images can shift a feature."""
    return math.ceil((error_a + error_b) / gsd)


def stretched(t) -> DataFrame:
    """All images at the working scale and in 8 bits, written once, as every later step reads them."""
    return eight_bits(materialize(filled(t), "resampled"))


def image_boxes(images: DataFrame) -> DataFrame:
    """(id, min_x, min_y, max_x, max_y) of the pixels of each image."""
    ends = [f(c).cast("double").alias(f"{n}_{c}") for n, f in (("min", F.min), ("max", F.max)) for c in "xy"]
    return images.groupBy(F.col("image_id").alias("id")).agg(*ends).select("id", "min_x", "min_y", "max_x", "max_y")


def overlapping_pairs(boxes: DataFrame, reverse: bool = False, cell: float = 4096.0) -> DataFrame:
    """(image_a, image_b) of images whose boxes overlap, the smaller number first; with ``reverse`` both ways."""
    pairs = spatial.box_pairs(boxes, boxes, cell).filter("id_a < id_b").select(F.col("id_a").alias("image_a"), F.col("id_b").alias("image_b"))
    if reverse:
        pairs = pairs.unionByName(pairs.select(F.col("image_b").alias("image_a"), F.col("image_a").alias("image_b")))
    return pairs


def search_tiles(images: DataFrame, settings: tp.FilterSettings, reverse: bool = False) -> DataFrame:
    """Search tiles over what the footprints of pairs of images have in common: image_a, image_b, tile_id, x, y, w, h.

    Pairs come from the grid join of the images' boxes. Tiles are numbered as they are written, the smaller image of a pair
    first; the numbers have no meaning."""
    boxes = materialize(image_boxes(images), "image-boxes")
    corner = lambda x, y: F.struct(F.col(x).alias("x"), F.col(y).alias("y"))
    outlines = boxes.select("id", F.array(corner("min_x", "min_y"), corner("max_x", "min_y"), corner("max_x", "max_y"), corner("min_x", "max_y")).alias("ring"))
    asked = overlapping_pairs(boxes, reverse).select(F.col("image_a").alias("id_a"), F.col("image_b").alias("id_b"))
    shared = spatial.footprint_overlaps(asked, outlines, settings.features_per_tile * (2 * PATCH + 1) ** 2 / 2)
    whole = lambda c: F.col(c).cast("int")
    pair = F.struct(F.col("id_a").alias("image_a"), F.col("id_b").alias("image_b"))
    overlaps = shared.select(pair.alias("image_id"), whole("min_x").alias("x0"), whole("min_y").alias("y0"), (whole("max_x") - whole("min_x") + 1).alias("width"), (whole("max_y") - whole("min_y") + 1).alias("height"), F.col("overlap").alias("ring"))
    tiles = spatial.search_tiles(overlaps, TILE, 0).select("image_id.*", "x", "y", "w", "h")
    return materialize(tiles.withColumn("tile_id", F.monotonically_increasing_id()), "search-tiles")


def on_tiles(corners: DataFrame, tiles: DataFrame, image: str, most: int, cell: int = 32) -> DataFrame:
    """The strongest corners of an image of each pair in each of the pair's search tiles: image_a, image_b, tile_id,
    feature_id, x, y. Tiles meet the corners by the cells that these were found in."""
    cells = lambda at, length: F.explode(F.sequence(F.floor(F.col(at) / cell).cast("int"), F.floor((F.col(at) + F.col(length) - 1) / cell).cast("int")))
    t = tiles.withColumn("tile_x", cells("x", "w")).withColumn("tile_y", cells("y", "h")).withColumnsRenamed({"x": "x0", "y": "y0"}).withColumn("image_id", F.col(image))
    inside = (F.col("x") >= F.col("x0")) & (F.col("x") < F.col("x0") + F.col("w")) & (F.col("y") >= F.col("y0")) & (F.col("y") < F.col("y0") + F.col("h"))
    found = t.join(corners, ["image_id", "tile_x", "tile_y"]).filter(inside).withColumn("feature_id", rs.pixel_number(F.col("x"), F.col("y")))
    return tp.cap_features(found, "response", most, "feature_id").select("image_a", "image_b", "tile_id", "feature_id", "x", "y")


def pixels_around(images: DataFrame, features: DataFrame, image: str, reach: int, cell: int = 64) -> DataFrame:
    """(image_a, image_b, x, y, v): pixels of an image of each pair, in the cells of a grid that the pair's features reach."""
    span = lambda c: F.explode(F.sequence(F.floor((F.col(c) - reach) / cell).cast("int"), F.floor((F.col(c) + reach) / cell).cast("int")))
    cells = features.select("image_a", "image_b", F.col(image).alias("image_id"), "x", "y").withColumn("cell_x", span("x")).withColumn("cell_y", span("y"))
    cells = cells.select("image_a", "image_b", "image_id", "cell_x", "cell_y").distinct()
    placed = images.withColumns({"cell_x": F.floor(F.col("x") / cell).cast("int"), "cell_y": F.floor(F.col("y") / cell).cast("int")})
    return placed.join(cells, ["image_id", "cell_x", "cell_y"]).select("image_a", "image_b", "x", "y", "v")


def correlate(images: DataFrame, features: DataFrame, settings: tp.FilterSettings, search: int) -> DataFrame:
    """The best places of each feature (image_a, image_b, tile_id, feature_id, x, y) in the other image of its pair:
    tile_id, tp_id, match_rank, dx, dy, confidence. Only pixels that features reach are copied to pairs."""
    once = features.select("image_a", "image_b", "feature_id", "x", "y").distinct()
    of = lambda image, reach: pixels_around(images, once, image, reach)
    found = rs.template_matches(of("image_a", PATCH), of("image_b", PATCH + search), once, PATCH, search, math.ceil(SHARE * (2 * PATCH + 1) ** 2), ("image_a", "image_b"))
    order = Window.partitionBy("image_a", "image_b", "feature_id").orderBy(F.desc("ncc"), "dy", "dx")
    m = found.filter("ncc >= 0.1").withColumn("match_rank", F.row_number().over(order)).filter(F.col("match_rank") <= settings.matches_per_feature)
    m = m.join(features.drop("x", "y"), ["image_a", "image_b", "feature_id"])
    return m.select("tile_id", F.col("feature_id").alias("tp_id"), "match_rank", F.col("dx").cast("double").alias("dx"), F.col("dy").cast("double").alias("dy"), F.col("ncc").alias("confidence"))


def of_pairs(points: DataFrame, tiles: DataFrame) -> DataFrame:
    """Tie points with the images of their tile and their place in the first of them."""
    x, y = rs.pixel_of(F.col("tp_id"))
    found = points.join(tiles.select("tile_id", "image_a", "image_b"), "tile_id")
    return found.select("image_a", "image_b", x.alias("x"), y.alias("y"), *points.columns)


def eight_bits(images: DataFrame) -> DataFrame:
    """Images with values from 0 to 255, written once, as every later step reads them."""
    none = images.select("image_id").limit(0)
    return materialize(rs.stretch(images, rs.band_stats(images, none)), "stretched")


@query("p1_tie_points_correlation")
def p1(t):
    """Tie points of all pairs of images, both ways, by correlation of patches around corners."""
    return correlated(stretched(t))


def correlated(images: DataFrame) -> DataFrame:
    """Tie points of all pairs of images of one raster that overlap, both ways: image_a, image_b, x, y, and the columns of
    matches."""
    settings = tp.FilterSettings()
    tiles = search_tiles(images, settings, reverse=True)
    corners = rs.detect(images, "min_eigen", tile=32, quality=0.01, most=settings.features_per_tile)
    features = materialize(on_tiles(corners, tiles, "image_a", settings.features_per_tile), "features")
    candidates = correlate(images, features, settings, search_radius(ERROR, ERROR, GSD))
    return of_pairs(tp.top_points(tp.filter_without_parallax(candidates, settings), settings.points_per_tile), tiles)


@query("p2_tie_points_descriptor")
def p2(t):
    """Tie points of all pairs of images by descriptors that are each other's nearest in a search tile."""
    settings, images = tp.FilterSettings(), stretched(t)
    corners = materialize(rs.detect(images, "min_eigen", tile=32, quality=0.01, most=settings.features_per_tile), "corners")
    described = materialize(rs.patch_descriptors(images, corners), "descriptors")
    tiles = search_tiles(images, settings)

    def side(image: str) -> DataFrame:
        f = on_tiles(corners, tiles, image, 8 * settings.features_per_tile).withColumn("image_id", F.col(image))
        return f.join(described, ["image_id", "x", "y"]).select("tile_id", F.col("feature_id").alias("vec_id"), "embedding")

    a, b = materialize(side("image_a"), "left"), materialize(side("image_b"), "right")
    both = tp.strengths(tp.cross_check(tp.descriptor_matches(a, b, 1), tp.descriptor_matches(b, a, 1)))
    (ax, ay), (bx, by) = rs.pixel_of(F.col("id_a")), rs.pixel_of(F.col("id_b"))
    m = both.select("tile_id", F.col("id_a").alias("tp_id"), F.lit(1).alias("match_rank"), (bx - ax).cast("double").alias("dx"), (by - ay).cast("double").alias("dy"), F.col("strength").alias("confidence"))
    m = tp.cap_features(m, "confidence", settings.features_per_tile, "tp_id")
    return of_pairs(tp.top_points(tp.filter_without_parallax(m, tp.FilterSettings(min_vector_difference=30.0)), settings.points_per_tile), tiles)


#: Where the test images lie when they are turned and scaled: degrees a pixel, turn in radians, place of the first pixel.
TURNED = {0: (0.001, 0.0, 10.0, 50.0), 1: (0.0014, 0.3, 10.02, 50.01)}
VIEW = (9.99937, 50.00063, 0.0013)


def turned(points: DataFrame) -> DataFrame:
    """Places of pixels of the turned and scaled test images."""
    of = lambda i: F.when(F.col("image_id") % 2 == 0, TURNED[0][i]).otherwise(TURNED[1][i])
    x, y, c, s = F.col("x") * of(0), F.col("y") * of(0), F.cos(of(1)), F.sin(of(1))
    return points.withColumns({"lon": of(2) + x * c - y * s, "lat": of(3) - x * s - y * c})


def in_view(t, model: coarse.Model, view: tuple[float, float, float]) -> DataFrame:
    """The images of a request in one common raster, through coarse grids of their models."""
    sizes = t.pixels.groupBy("image_id").agg((F.max("x") + 1).alias("width"), (F.max("y") + 1).alias("height"))
    cells = materialize(coarse.coarse_cells(materialize(sizes, "image-sizes"), model), "coarse-cells")
    return coarse.common_view(t.pixels, cells, *view)


def view_sql() -> str:
    rows = ", ".join(f"({i}, {', '.join(f'{v!r}::DOUBLE' for v in r)})" for i, r in TURNED.items())
    lon0, lat0, gsd = (f"{v!r}::DOUBLE" for v in VIEW)
    return f"""WITH m(image_id, size, turn, lon, lat) AS (VALUES {rows}), n AS (SELECT image_id, max(x) AS mx, max(y) AS my FROM pixels GROUP BY 1), f AS (SELECT *, 256.0 * ceil(mx / 256.0) AS w, 256.0 * ceil(my / 256.0) AS h FROM n),
g AS (SELECT image_id, tx, ty, {lon0} + tx * {gsd} - lon AS e, lat - ({lat0} - ty * {gsd}) AS s, size, turn, w, h FROM m JOIN f USING (image_id), range(-400, 600) a(tx), range(-400, 600) b(ty)),
q AS (SELECT image_id, tx, ty, (e * cos(turn) + s * sin(turn)) / size AS sx, (s * cos(turn) - e * sin(turn)) / size AS sy, w, h FROM g),
k AS MATERIALIZED (SELECT * FROM q WHERE sx BETWEEN 0 AND w AND sy BETWEEN 0 AND h),
c AS (SELECT image_id, tx, ty, floor(sx) + dx AS x, floor(sy) + dy AS y, (CASE WHEN dx = 1 THEN sx - floor(sx) ELSE 1 - (sx - floor(sx)) END) * (CASE WHEN dy = 1 THEN sy - floor(sy) ELSE 1 - (sy - floor(sy)) END) AS w FROM k, (VALUES (0), (1)) q(dx), (VALUES (0), (1)) r(dy))
SELECT c.image_id, CAST(tx AS INT) AS x, CAST(ty AS INT) AS y, round(sum(w * v) / sum(w), 4) AS v FROM c JOIN pixels p ON c.image_id = p.image_id AND c.x = p.x AND c.y = p.y GROUP BY 1, 2, 3"""


@query("k5_common_view", view_sql())
def k5_view(t):
    """Two images of other scale and turn on one common raster."""
    return in_view(t, turned, VIEW).withColumn("v", F.round("v", 4))


@query("p1_common_view")
def p1_view(t):
    """Tie points between images of other scale and turn, by correlation in their common view."""
    return correlated(eight_bits(materialize(in_view(t, turned, VIEW), "common-view")))


def pyramid_tiles(t, tile: int = 32) -> DataFrame:
    """Tiles of the full level and the three below, the coarsest at zoom 0; blank tiles are absent."""
    full = t.pixels.select(F.lit(0).alias("level"), "image_id", "x", "y", F.col("v").cast("double").alias("v"))
    levels = full.unionByName(rs.overviews(t.pixels, SIDE, SIDE, 32))
    rows = levels.select((3 - F.col("level")).alias("zoom_level"), "image_id", F.floor(F.col("x") / tile).cast("int").alias("tile_column"), F.floor(F.col("y") / tile).cast("int").alias("tile_row"), (F.col("x") % tile).alias("px"), (F.col("y") % tile).alias("py"), "v")
    packed = rows.groupBy("image_id", "zoom_level", "tile_column", "tile_row").agg(F.sort_array(F.collect_list(F.struct("py", "px", "v"))).alias("data"))
    return packed.select(F.concat(F.lit("image"), F.col("image_id")).alias("table_name"), "zoom_level", "tile_column", "tile_row", "data")


P3 = "WITH a AS (SELECT image_id, x // 2 AS x, y // 2 AS y, avg(v) AS v FROM pixels GROUP BY 1, 2, 3), b AS (SELECT image_id, x // 2 AS x, y // 2 AS y, avg(v) AS v FROM a GROUP BY 1, 2, 3), c AS (SELECT image_id, x // 2 AS x, y // 2 AS y, avg(v) AS v FROM b GROUP BY 1, 2, 3), l AS (SELECT 2 AS z, * FROM a UNION ALL SELECT 1, * FROM b UNION ALL SELECT 0, * FROM c)"


@query("p3_pyramid_build", f"{P3} SELECT 'image' || image_id AS table_name, z AS zoom_level, CAST(x // 32 AS INT) AS tile_column, CAST(y // 32 AS INT) AS tile_row, CAST(count(*) AS INT) AS n, round(sum(v), 6) AS total FROM l GROUP BY 1, 2, 3, 4")
def p3(t):
    """The levels that this query's SQL lists, of a pyramid that has the full one too."""
    return tile_sums(written(t)).filter("zoom_level < 3")


@query("p3_pyramid_build_all", f"{P3}, m AS (SELECT * FROM l UNION ALL SELECT 3, * FROM pixels) SELECT 'image' || image_id AS table_name, z AS zoom_level, CAST(x // 32 AS INT) AS tile_column, CAST(y // 32 AS INT) AS tile_row, CAST(count(*) AS INT) AS n, round(sum(v), 6) AS total FROM m GROUP BY 1, 2, 3, 4")
def p3_all(t):
    return tile_sums(written(t))


def written(t) -> DataFrame:
    path = new_path(t.spark, "pyramid")
    pyramid.write_pyramid(pyramid_tiles(t), path)
    return t.spark.read.parquet(path)


def tile_sums(tiles: DataFrame) -> DataFrame:
    return tiles.select("table_name", "zoom_level", "tile_column", "tile_row", F.size("data").alias("n"), F.round(F.aggregate("data", F.lit(0.0), lambda s, p: s + p["v"]), 6).alias("total"))


def scaled_pyramid(pixels: DataFrame, images: DataFrame, tile: int, epsg: int = 4326) -> DataFrame:
    """Tiles of a world pyramid in degrees: table_name, zoom_level, tile_column, tile_row, data, n_pixels, status.

    ``images``: image_id, width, height, gsd (degrees a pixel), ul_lon, ul_lat. Levels are those that the size and the gsd
    of each image ask for (S5), their pixels those whose centres lie in its rectangle (S6, S7). A target pixel is
    interpolated (K5) in the overview (A9) whose pixels are the next finer ones, so that coarse levels use every source
    pixel. Pixels without a source are absent, which is their alpha; a tile is FULL or PARTIAL by them, and empty tiles are
    not stored. Target tiles are dealt out by address before they become pixels."""
    size = images.agg(F.coalesce(F.max("width"), F.lit(0)).alias("w"), F.coalesce(F.max("height"), F.lit(0)).alias("h")).first()
    sources = pixels.select(F.lit(0).alias("level"), "image_id", "x", "y", F.col("v").cast("double").alias("v"))
    if min(size) > 1:
        sources = sources.unionByName(rs.overviews(pixels, size.w, size.h, 1))
    zoomed = images.withColumn("zoom_level", F.explode(grid.zoom_levels(F.col("width"), F.col("height"), F.col("gsd"), epsg, tile=tile)))
    g = F.col("g")
    zoomed = zoomed.withColumn("g", grid.zoom_gsd(epsg, F.col("zoom_level"), tile, tile)[0])
    zoomed = zoomed.withColumns({"level": F.greatest(F.lit(0), F.floor(F.log2(g / F.col("gsd")))).cast("int"), "min_x": F.col("ul_lon"), "max_x": F.col("ul_lon") + F.col("width") * F.col("gsd"), "min_y": F.col("ul_lat") - F.col("height") * F.col("gsd"), "max_y": F.col("ul_lat")})
    zoomed = grid.aoi_from_rect(zoomed, g)
    tiles = zoomed
    for name, lo, hi in (("tile_column", "ul_x", "lr_x"), ("tile_row", "ul_y", "lr_y")):
        tiles = tiles.filter(F.col(lo) <= F.col(hi)).withColumn(name, F.explode(F.sequence(F.floor(F.col(lo) / tile).cast("int"), F.floor(F.col(hi) / tile).cast("int"))))
    tasks = int(images.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tiles = tiles.repartition(tasks, "image_id", "zoom_level", "tile_column", "tile_row")
    inside = lambda at, lo, hi: F.explode(F.sequence(F.greatest(F.col(at).cast("long") * tile, F.col(lo)), F.least((F.col(at).cast("long") + 1) * tile - 1, F.col(hi))))
    targets = tiles.withColumn("tx", inside("tile_column", "ul_x", "lr_x")).withColumn("ty", inside("tile_row", "ul_y", "lr_y"))
    power = F.pow(F.lit(2.0), F.col("level"))
    sx = (F.lit(-180.0) + (F.col("tx") + 0.5) * g - F.col("ul_lon")) / F.col("gsd") / power - 0.5
    sy = (F.col("ul_lat") - (F.lit(90.0) - (F.col("ty") + 0.5) * g)) / F.col("gsd") / power - 0.5
    values = rs.resample(sources, targets.select("image_id", "level", "zoom_level", "tx", "ty", sx.alias("sx"), sy.alias("sy")), ("image_id", "level"), ("image_id", "zoom_level"))
    placed = values.withColumns({"tile_column": F.floor(F.col("tx") / tile).cast("int"), "tile_row": F.floor(F.col("ty") / tile).cast("int")})
    point = F.struct((F.col("ty") % tile).cast("int").alias("py"), (F.col("tx") % tile).cast("int").alias("px"), "v")
    packed = placed.groupBy("image_id", "zoom_level", "tile_column", "tile_row").agg(F.sort_array(F.collect_list(point)).alias("data")).withColumn("n_pixels", F.size("data"))
    status = F.when(F.col("n_pixels") == tile * tile, "FULL").otherwise("PARTIAL")
    return packed.select(F.concat(F.lit("image"), F.col("image_id")).alias("table_name"), "zoom_level", "tile_column", "tile_row", "data", "n_pixels", status.alias("status"))


def located_images(t) -> DataFrame:
    return t.images.select("image_id", F.lit(SIDE).alias("width"), F.lit(SIDE).alias("height"), (F.lit(0.003) + F.col("image_id") * F.lit(0.004)).alias("gsd"), (F.lit(10.1) + F.col("image_id")).alias("ul_lon"), F.lit(50.2).alias("ul_lat"))


def scaled_sql() -> str:
    """Rows of the pyramid that scaled_pyramid makes of the test images."""
    means = ["SELECT 0 AS level, image_id, x, y, CAST(v AS DOUBLE) AS v FROM pixels"]
    steps = [f"o0 AS MATERIALIZED ({means[0]})"] + [f"o{k} AS MATERIALIZED (SELECT {k} AS level, image_id, x // 2 AS x, y // 2 AS y, avg(v) AS v FROM o{k - 1} GROUP BY image_id, x // 2, y // 2)" for k in range(1, 6)]
    source = " UNION ALL ".join(f"SELECT * FROM o{k}" for k in range(6))
    d = lambda x: f"CAST({x} AS DOUBLE)"
    return f"""WITH {", ".join(steps)}, o AS MATERIALIZED ({source}),
i AS (SELECT image_id, {d(0.003)} + image_id*{d(0.004)} AS gsd, {d(10.1)} + image_id AS lo, {d(50.2)} AS la FROM images),
s AS (SELECT i.*, (SELECT min(q) FROM range(0, 40) r(q) WHERE {d(5.625)}/pow(2, q) <= gsd*1.5) AS top FROM i),
z AS (SELECT s.*, q AS z, {d(5.625)}/pow(2, q) AS g FROM s, range(0, 40) r(q) WHERE q BETWEEN top - 5 AND top),
w AS (SELECT *, CAST(greatest(0, floor(log2(g/gsd))) AS INT) AS level, floor((lo + 180)/g + 0.5) AS x0, floor((lo + 256*gsd - g + 180)/g + 0.5) AS x1, floor((90 - la)/g + 0.5) AS y0, floor((90 - (la - 256*gsd) - g)/g + 0.5) AS y1 FROM z),
t AS (SELECT *, x0 + a AS tx, y0 + b AS ty FROM w, range(0, 700) p(a), range(0, 700) q(b) WHERE x0 + a <= x1 AND y0 + b <= y1),
p AS (SELECT image_id, z, level, tx, ty, (-180 + (tx + 0.5)*g - lo)/gsd/pow(2, level) - 0.5 AS sx, (la - (90 - (ty + 0.5)*g))/gsd/pow(2, level) - 0.5 AS sy FROM t),
c AS (SELECT image_id, z, level, tx, ty, floor(sx) + dx AS x, floor(sy) + dy AS y, (CASE WHEN dx = 1 THEN sx - floor(sx) ELSE 1 - (sx - floor(sx)) END) * (CASE WHEN dy = 1 THEN sy - floor(sy) ELSE 1 - (sy - floor(sy)) END) AS k FROM p, (VALUES (0), (1)) q(dx), (VALUES (0), (1)) r(dy)),
v AS (SELECT c.image_id, z, tx, ty, sum(k*v)/sum(k) AS v FROM c JOIN o ON c.image_id = o.image_id AND c.level = o.level AND c.x = o.x AND c.y = o.y WHERE k > 0 GROUP BY 1, 2, 3, 4)
SELECT 'image' || image_id AS table_name, CAST(z AS INT) AS zoom_level, CAST(floor(tx/32) AS INT) AS tile_column, CAST(floor(ty/32) AS INT) AS tile_row, CAST(count(*) AS INT) AS n, round(sum(v), 3) AS total, CASE WHEN count(*) = 1024 THEN 'FULL' ELSE 'PARTIAL' END AS status FROM v GROUP BY 1, 2, 3, 4"""


@query("p3_scaled_pyramid", scaled_sql())
def p3_scaled(t):
    """A written world pyramid at the scales of the images, read again."""
    path = new_path(t.spark, "scaled")
    pyramid.write_pyramid(scaled_pyramid(t.pixels, located_images(t), 32), path)
    total = F.round(F.aggregate("data", F.lit(0.0), lambda s, p: s + p["v"]), 3)
    return t.spark.read.parquet(path).select("table_name", "zoom_level", "tile_column", "tile_row", F.col("n_pixels").alias("n"), total.alias("total"), "status")


@query("p4_pyramid_read", "SELECT w.image_id AS view_id, count(*) AS n, CAST(sum(v) AS BIGINT) AS total FROM views w JOIN pixels p ON p.image_id = w.image_id % 2 AND p.x BETWEEN w.x0 AND w.x0 + w.width - 1 AND p.y BETWEEN w.y0 AND w.y0 + w.height - 1 GROUP BY 1")
def p4(t):
    """Pixels of arbitrary views, through the tiles that hold them: an equi-join on addresses, then a clip."""
    placed = F.transform("data", lambda p: F.struct((F.col("tile_column") * 32 + p["px"]).alias("x"), (F.col("tile_row") * 32 + p["py"]).alias("y"), p["v"].alias("v")))
    tiles = written(t).filter("zoom_level = 3").select(F.substring("table_name", 6, 9).cast("int").alias("image_id"), "tile_column", "tile_row", placed.alias("data"))
    views = pyramid.tiles_for_rect(t.views.withColumns({"offset_x": F.lit(0), "offset_y": F.lit(0)}), 32, 32).withColumn("view_id", F.col("image_id")).withColumn("image_id", (F.col("image_id") % 2).cast("int"))
    j = views.join(tiles, ["image_id", "tile_column", "tile_row"])
    p = j.select("view_id", "clip_x0", "clip_x1", "clip_y0", "clip_y1", F.explode("data").alias("p")).filter("p.x >= clip_x0 AND p.x <= clip_x1 AND p.y >= clip_y0 AND p.y <= clip_y1")
    return p.groupBy("view_id").agg(F.count(F.lit(1)).alias("n"), F.sum("p.v").cast("long").alias("total"))


#: Two looks of a push-broom sensor: seconds of the first line of each, seconds a line, radians a column, the middle column,
#: and the pitch with which the second looks back to what the first saw from above.
FIRST, SECOND, LINE, COLUMN, MIDDLE = 60.0, 80.0, 1e-3, 1e-5, SIDE / 2
_W = 0.00104 * (SECOND - FIRST)
PITCH = -math.atan2(sensors.A * math.sin(_W), 7178137.0 - sensors.A * math.cos(_W))


def surface_points(t, matches: DataFrame, most: float = 25.0) -> DataFrame:
    """Matches (feature_id, x, y in the first look, dx, dy to the second) as points in space: feature_id, lon, lat, h, miss.

    Each look has the platform's state at the time of its own line and the ray of its own column. The point lies midway
    between the rays where they pass nearest; matches whose rays miss each other by more than ``most`` metres have none."""
    own = ["feature_id", "x", "y", "dx", "dy"]
    one = states(t, matches.select(*own).withColumn("t", FIRST + F.col("y") * LINE)).withColumnsRenamed({c: f"{c}_a" for c in ("px", "py", "vx", "vy")})
    two = states(t, one.withColumn("t", SECOND + (F.col("y") + F.col("dy")) * LINE))

    def compute(pdf):
        zero = np.zeros(len(pdf))
        at = lambda x, y, z: np.stack([pdf[x].to_numpy(float), pdf[y].to_numpy(float), z], 1)
        level = np.zeros((len(pdf), 3))
        aside = (pdf["x"].to_numpy(float) - MIDDLE) * COLUMN
        p1, v1, p2, v2 = at("px_a", "py_a", zero), at("vx_a", "vy_a", zero), at("px", "py", zero), at("vx", "vy", zero)
        u1 = sensors.pushbroom_ray(p1, v1, level, zero, aside)
        u2 = sensors.pushbroom_ray(p2, v2, level, zero + PITCH, aside + pdf["dx"].to_numpy(float) * COLUMN)
        middle, miss = sensors.two_ray_point(p1, u1, p2, u2)
        return {"mx": middle[:, 0], "my": middle[:, 1], "mz": middle[:, 2], "miss": miss}

    met = sensors.over_batches(two, {c: "double" for c in ("mx", "my", "mz", "miss")}, compute, ["feature_id"]).filter(F.col("miss") <= most)
    lon, lat, h = to.ecef_to_geodetic(F.col("mx"), F.col("my"), F.col("mz"))
    return met.select("feature_id", F.degrees(lon).alias("lon"), F.degrees(lat).alias("lat"), h.alias("h"), "miss")


@query("p5_surface_model")
def p5(t):
    """A surface from matches at every pixel that pairs of images have in common: points in space, the highest of each cell,
    and voids of any size filled from coarser cells."""
    settings, images = tp.FilterSettings(), stretched(t)
    tiles, search = search_tiles(images, settings), search_radius(ERROR, ERROR, GSD)
    corners = tiles.withColumn("places", F.array(*[F.struct((F.col("x") + dx).alias("x"), (F.col("y") + dy).alias("y")) for dx in (F.lit(0), F.col("w") - 1) for dy in (F.lit(0), F.col("h") - 1)]))
    ends = corners.select("image_a", "image_b", F.inline("places"))
    of = lambda image, reach: pixels_around(images, ends, image, TILE + reach)  # noqa: E731  a tile's corners reach all of it
    found = rs.dense_matches(of("image_a", PATCH), of("image_b", PATCH + search), tiles, PATCH, search, math.ceil(SHARE * (2 * PATCH + 1) ** 2), ("image_a", "image_b"), 1)
    found = materialize(found.filter("ncc >= 0.1"), "dense-matches")
    matches = found.select(F.monotonically_increasing_id().alias("feature_id"), "x", "y", "dx", "dy")
    cloud = surface_points(t, matches).select(F.col("feature_id").alias("point_id"), F.col("lon").alias("x"), F.col("lat").alias("y"), F.col("h").alias("z"))
    return pc.fill_all_voids(pc.rasterise(cloud, 0.0, -1.0, 0.0005, "highest"))


def outlined(t) -> tuple[DataFrame, DataFrame]:
    """Foreground without speckles, and its rings."""
    mask = materialize(rs.remove_speckles(t.pixels.filter("v > 10").select("image_id", "x", "y"), 4), "mask")
    return mask, materialize(rs.rings(mask), "rings")


@query("p6_raster_to_vectors")
def p6(t):
    """Outlines of regions without speckles as rings in degrees, first corner repeated at the end: image_id, region, ring,
    hole, pixels inside, and GeoJSON coordinates."""
    mask, rings = outlined(t)
    named = rs.ring_areas(rings).join(rs.regions(mask).withColumnsRenamed({"x": "px", "y": "py"}), ["image_id", "px", "py"])
    lon, lat = grid.pixel_to_lonlat(F.col("x"), F.col("y"), 0)
    corners = rings.select("ring", F.struct("seq", F.array(F.round(lon, 8), F.round(lat, 8)).alias("c")).alias("v")).groupBy("ring").agg(F.sort_array(F.collect_list("v")).alias("v"))
    closed = F.to_json(F.transform(F.concat("v", F.slice("v", 1, 1)), lambda v: v["c"]))
    return named.join(corners, "ring").select("image_id", "region", "ring", (F.col("area") < 0).alias("hole"), F.abs("area").alias("n_pixels"), closed.alias("coordinates"))


@query("p6_masked_lines")
def p6_lines(t):
    """Outlines cut where their corners lie on masked pixels, as open lines of at least three corners."""
    _, rings = outlined(t)
    masked = t.pixels.filter("v % 7 = 0").select("image_id", "x", "y", F.lit(True).alias("hit"))
    path = rings.select("image_id", F.col("ring").alias("path"), "seq", "x", "y").join(masked, ["image_id", "x", "y"], "left")
    return rs.split_paths(path.withColumn("masked", F.coalesce("hit", F.lit(False))).drop("hit")).select("image_id", "path", "piece", "seq", "x", "y")


def levels(t) -> DataFrame:
    return t.levels.filter("table_name = 'AFRICA'").select("zoom_level", "matrix_width", "matrix_height")


@query("x1_stream_ingest", "SELECT zoom_level, tile_column, tile_row, min(event_id) AS event_id, arg_min(value, event_id) AS value FROM tile_stream t JOIN (SELECT zoom_level, matrix_width, matrix_height FROM levels WHERE table_name = 'AFRICA') l USING (zoom_level) WHERE tile_column < matrix_width AND tile_row < matrix_height AND value IS NOT NULL GROUP BY 1, 2, 3")
def x1(t):
    path = new_path(t.spark, "ingested")
    for _ in range(2):  # the second run goes on where the first ended, and adds nothing
        st.ingest(st.read_stream(t.spark, t.sf_dir, "events.parquet"), levels(t), path).awaitTermination()
    return st.stored(t.spark, path)


@query("x2_stream_progress", "SELECT zoom_level, count(DISTINCT (tile_column, tile_row)) AS written, CAST(any_value(matrix_width * matrix_height) AS BIGINT) AS total FROM tile_stream JOIN (SELECT zoom_level, matrix_width, matrix_height FROM levels WHERE table_name = 'AFRICA') l USING (zoom_level) WHERE tile_column < matrix_width AND tile_row < matrix_height AND value IS NOT NULL GROUP BY zoom_level")
def x2(t):
    tiles, path = new_path(t.spark, "ingested"), new_path(t.spark, "progress")
    totals = levels(t).select("zoom_level", (F.col("matrix_width") * F.col("matrix_height")).cast("long").alias("total"))
    st.ingest(st.read_stream(t.spark, t.sf_dir, "events.parquet"), levels(t), tiles).awaitTermination()
    st.progress(t.spark, tiles, totals, path, new_path(t.spark, "offsets")).awaitTermination()
    return t.spark.read.parquet(path)
