"""Queries on pyramids, their metadata and grids."""

from __future__ import annotations

from pyspark.sql import functions as F

from geoquilt.functions import grid
from geoquilt.plans.catalog import INPUTS, query
from geoquilt.sources import pyramid
from geoquilt.sources.shared import new_path

INPUTS["frames"] = "SELECT image_id, c AS col, r AS row, CAST(100 + (image_id*7 + c*13) % 90 AS INT) AS w, CAST(80 + (image_id*5 + r*11) % 70 AS INT) AS h FROM (SELECT s_suppkey AS image_id FROM supplier) i CROSS JOIN (VALUES (0), (1), (2), (3)) AS cs(c) CROSS JOIN (VALUES (0), (1), (2)) AS rs(r)"
INPUTS["views"] = "SELECT s_suppkey AS image_id, CAST(s_suppkey*91 % 300 AS INT) AS x0, CAST(s_suppkey*53 % 200 AS INT) AS y0, 180 AS width, 130 AS height FROM supplier"
KEY = ("zoom_level", "tile_column", "tile_row")


@query("r1_pyramid_entries", """SELECT s.table_name, s.srs_id, r.code, l.zooms, coalesce(e.zooms, []) AS extent_zooms FROM sets s JOIN (SELECT table_name, list(zoom_level ORDER BY zoom_level DESC) AS zooms FROM levels GROUP BY 1) l USING (table_name)
LEFT JOIN (SELECT table_name, list(zoom_level ORDER BY zoom_level DESC) AS zooms FROM extents GROUP BY 1) e USING (table_name) LEFT JOIN srs r ON s.srs_id = r.srs_id""")
def r1(t):
    return pyramid.entries(t.sets, t.levels, t.extents, t.srs).select("table_name", "srs_id", "code", F.col("levels.zoom_level").alias("zooms"), F.coalesce(F.col("extents.zoom_level"), F.array().cast("array<int>")).alias("extent_zooms"))


@query("r1b_pyramid_entry_strict", """SELECT s.table_name, r.code, l.n AS n_levels, coalesce(e.n, 0) AS n_extents, l.n <> coalesce(e.n, 0) AS count_mismatch FROM sets s JOIN (SELECT table_name, CAST(count(*) AS INT) AS n FROM levels GROUP BY 1) l USING (table_name)
LEFT JOIN (SELECT table_name, CAST(count(*) AS INT) AS n FROM extents GROUP BY 1) e USING (table_name) JOIN srs r ON s.srs_id = r.srs_id""")
def r1b(t):
    return pyramid.strict_entries(t.sets, t.levels, t.extents, t.srs).select("table_name", "code", F.size("levels").alias("n_levels"), F.coalesce(F.size("extents"), F.lit(0)).alias("n_extents"), "count_mismatch")


@query("r2_tile_lookup", "SELECT event_id, value FROM tile_stream WHERE zoom_level = 4 AND tile_column = 3 AND tile_row = 5")
def r2(t):
    return pyramid.tile_lookup(t.tile_stream, 4, 3, 5).select("event_id", "value")


@query("r3_tiles_for_rect", """WITH r AS (SELECT image_id, x0 + 17 AS a, y0 + 5 AS b, x0 + 17 + width - 1 AS c, y0 + 5 + height - 1 AS d FROM rects),
x AS (SELECT *, unnest(range(a // 256, c // 256 + 1)) AS tile_column FROM r), y AS (SELECT *, unnest(range(b // 256, d // 256 + 1)) AS tile_row FROM x)
SELECT image_id, tile_column, tile_row, greatest(a, tile_column*256) AS clip_x0, least(c, tile_column*256 + 255) AS clip_x1, greatest(b, tile_row*256) AS clip_y0, least(d, tile_row*256 + 255) AS clip_y1 FROM y""")
def r3(t):
    r = t.rects.withColumns({"offset_x": F.lit(17), "offset_y": F.lit(5)})
    return pyramid.tiles_for_rect(r, 256, 256).select("image_id", "tile_column", "tile_row", "clip_x0", "clip_x1", "clip_y0", "clip_y1")


@query("r3b_frames_for_rect", """WITH p AS (SELECT *, coalesce(sum(w) OVER (PARTITION BY image_id, row ORDER BY col ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS px, coalesce(sum(h) OVER (PARTITION BY image_id, col ORDER BY row ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS py FROM frames)
SELECT image_id, col, row, CAST(px AS BIGINT) AS px, CAST(py AS BIGINT) AS py FROM p JOIN views v USING (image_id) WHERE px < x0 + width AND px + w > x0 AND py < y0 + height AND py + h > y0""")
def r3b(t):
    return pyramid.frames_for_rect(t.frames, t.views).select("image_id", "col", "row", "px", "py")


@query("r4_payload_type", """SELECT event_id, CASE event_id % 5 WHEN 0 THEN 'image/jpeg' WHEN 1 THEN 'image/jpeg' WHEN 2 THEN 'image/png' ELSE 'unknown' END AS kind FROM events""")
def r4(t):
    heads = F.array(*[F.lit(h) for h in ("FFD8FFE000104A46", "FFD8FFDB00430001", "89504E470D0A1A0A", "FFD8FFE0", "4749463839610100")])
    data = F.unhex(F.concat(F.get(heads, (F.col("event_id") % 5).cast("int")), F.when(F.col("event_id") % 5 == 3, F.lit("")).otherwise(F.lpad(F.hex("event_id"), 16, "0"))))
    return t.events.select("event_id", pyramid.payload_type(data).alias("kind"))


@query("r6_append_rect", """SELECT s.table_name, r.code, greatest(s.min_x, -180.0 + zoom_level*30) AS min_x, greatest(s.min_y, -100.0) AS min_y, least(s.max_x, 200.0) AS max_x, least(s.max_y, 45.0) AS max_y FROM sets s JOIN srs r USING (srs_id) JOIN levels l USING (table_name) WHERE r.code = 4326""")
def r6(t):
    have = pyramid.strict_entries(t.sets, t.levels, t.extents, t.srs)
    wanted = t.levels.select("table_name", F.lit(4326).alias("code"), (F.lit(-180.0) + F.col("zoom_level") * 30).alias("min_x"), F.lit(-100.0).alias("min_y"), F.lit(200.0).alias("max_x"), F.lit(45.0).alias("max_y"))
    return pyramid.output_rect(have, wanted)


@query("r13_overlay_regions", """WITH a AS (SELECT image_id, width, height, CAST(greatest(0, ceil(log2(greatest(width, height) / 400.0))) AS INT) AS max_zoom FROM rects),
b AS (SELECT *, greatest(width, height) / pow(2.0, max_zoom) AS side FROM a),
c AS (SELECT *, CAST(trunc(CASE WHEN width >= height THEN side ELSE side*width/height END) AS INT) AS tile_x, CAST(trunc(CASE WHEN width >= height THEN side*height/width ELSE side END) AS INT) AS tile_y FROM b),
d AS (SELECT *, unnest(range(0, max_zoom + 1)) AS zoom FROM c), e AS (SELECT *, greatest(1, CAST(floor(width / (pow(2.0, max_zoom - zoom) * tile_x)) AS INT)) AS nx, greatest(1, CAST(floor(height / (pow(2.0, max_zoom - zoom) * tile_y)) AS INT)) AS ny FROM d),
f AS (SELECT *, unnest(range(0, nx)) AS ix FROM e), g AS (SELECT *, unnest(range(0, ny)) AS iy FROM f)
SELECT image_id, CAST(zoom AS INT) AS zoom, CAST(ix AS INT) AS ix, CAST(iy AS INT) AS iy, CAST(ny - iy - 1 AS INT) AS row_index, CASE WHEN zoom = max_zoom THEN 0 ELSE (CASE WHEN ix*2+1 < ceil(width / (pow(2.0, max_zoom-zoom-1)*tile_x)) THEN 2 ELSE 1 END) * (CASE WHEN iy*2+1 < ceil(height / (pow(2.0, max_zoom-zoom-1)*tile_y)) THEN 2 ELSE 1 END) END AS children,
CASE WHEN zoom = max_zoom THEN -1 ELSE 2048 END AS max_lod FROM g""")
def r13(t):
    return grid.overlay_regions(t.rects).select("image_id", "zoom", "ix", "iy", "row_index", "children", "max_lod")


@query("r14_list_entries", "SELECT table_name, CAST(row_number() OVER (ORDER BY table_name) - 1 AS INT) AS entry FROM sets")
def r14(t):
    return pyramid.numbered_entries(t.sets.select("table_name"), "table_name")


@query("r15_renderable", """SELECT p_partkey AS dataset FROM part WHERE p_partkey % 4 < 2 AND p_size % 4 >= 2 AND p_size > 1 AND p_partkey % 3 > 0 AND p_brand IN (SELECT DISTINCT p_brand FROM part WHERE p_size = 7)""")
def r15(t):
    kinds = F.array(F.lit("integer"), F.lit("float"), F.lit("string"), F.lit("compound"))
    d = t.part.select(F.col("p_partkey").alias("dataset"), F.col("p_brand").alias("name"), F.get(kinds, (F.col("p_partkey") % 4).cast("int")).alias("class"), F.slice(F.array(F.col("p_size").cast("long"), F.col("p_partkey") % 3 + 1, F.lit(9).cast("long")), 1, F.greatest(F.lit(1), F.col("p_size") % 4)).alias("extents"))
    return pyramid.renderable(d, t.part.filter("p_size = 7").select(F.col("p_brand").alias("name"))).select("dataset")


@query("s1_lonlat_to_pixel", """SELECT gp_id, CAST(floor((lon + 180) / 360 * 1024) AS BIGINT) AS samp, CAST(floor((0.5*ln((1+sin(-radians(lat)))/(1-sin(-radians(lat))))/(2*pi()) + 0.5) * 1024) AS BIGINT) AS line FROM ground_points""")
def s1(t):
    samp, line = grid.lonlat_to_pixel(F.col("lon"), F.col("lat"), 2)
    return t.ground_points.select("gp_id", samp.alias("samp"), line.alias("line"))


@query("s2_pixel_to_lonlat", """SELECT image_id, round(x0 / 4096.0 * 360 - 180, 9) AS lon, round(-degrees(asin((exp(4*pi()*(y0/4096.0 - 0.5)) - 1) / (exp(4*pi()*(y0/4096.0 - 0.5)) + 1))), 9) AS lat FROM rects""")
def s2(t):
    lon, lat = grid.pixel_to_lonlat(F.col("x0"), F.col("y0"), 4)
    return t.rects.select("image_id", F.round(lon, 9).alias("lon"), F.round(lat, 9).alias("lat"))


@query("s3_zoom_gsd", """SELECT table_name, zoom_level, 180.0/256/pow(2, zoom_level) AS geo_x, 180.0/256/pow(2, zoom_level) AS geo_y, round(40075016.68557849/256/pow(2, zoom_level), 9) AS metre_x, 0.5*pow(2.0, 3 - zoom_level) AS from_full FROM levels""")
def s3(t):
    gx, gy = grid.zoom_gsd(4326, F.col("zoom_level"))
    mx, _ = grid.zoom_gsd(3857, F.col("zoom_level"))
    return t.levels.select("table_name", "zoom_level", gx.alias("geo_x"), gy.alias("geo_y"), F.round(mx, 9).alias("metre_x"), grid.gsd_at(F.lit(0.5), F.lit(3), F.col("zoom_level")).alias("from_full"))


@query("s5_zoom_levels", """WITH n AS (SELECT image_id, gsd_deg, 1 + len(list_filter(range(0, 63), lambda k : width/pow(2.0,k) > 64 AND height/pow(2.0,k) > 64)) AS n, len(list_filter(range(0, 63), lambda k : 180.0/256/pow(2.0,k) > gsd_deg*1.5)) AS start FROM rects)
SELECT image_id, range(0, n) AS plain, range(greatest(0, start - (n - 1)), start + 1) AS aligned FROM n""")
def s5(t):
    w, h = F.col("width"), F.col("height")
    return t.rects.select("image_id", grid.zoom_levels(w, h, F.col("gsd_deg"), 4326, False).cast("array<long>").alias("plain"), grid.zoom_levels(w, h, F.col("gsd_deg"), 4326).cast("array<long>").alias("aligned"))


@query("s6_matrix_size", "SELECT image_id, CAST(ceil(width/256.0) AS INT) AS matrix_width, CAST(ceil(height/256.0) AS INT) AS matrix_height, CAST(x0 // 256 * 256 AS BIGINT) AS lo, CAST(((x0 + width - 1) // 256 + 1) * 256 - 1 AS BIGINT) AS hi FROM rects")
def s6(t):
    lo, hi = grid.expand_to_tiles(F.col("x0"), F.col("x0") + F.col("width") - 1, 256)
    return t.rects.select("image_id", grid.matrix_size(F.col("width"), 256).alias("matrix_width"), grid.matrix_size(F.col("height"), 256).alias("matrix_height"), lo.alias("lo"), hi.alias("hi"))


@query("s7_aoi_from_rect", """WITH a AS (SELECT cell_id, CAST(floor((min_lon + 180)/0.01 + 0.5) AS BIGINT) AS ul_x, CAST(floor((90 - max_lat)/0.01 + 0.5) AS BIGINT) AS ul_y, CAST(floor((max_lon - 0.01 + 180)/0.01 + 0.5) AS BIGINT) AS lr_x, CAST(floor((90 - min_lat - 0.01)/0.01 + 0.5) AS BIGINT) AS lr_y FROM footprints)
SELECT *, CAST(round(least(180, greatest(-180, -180 + ul_x*0.01)), 9) AS DOUBLE) AS min_lon, CAST(round(least(180, greatest(-180, -180 + (lr_x + 1)*0.01)), 9) AS DOUBLE) AS max_lon FROM a""")
def s7(t):
    f = t.footprints.select("cell_id", F.col("min_lon").alias("min_x"), F.col("min_lat").alias("min_y"), F.col("max_lon").alias("max_x"), F.col("max_lat").alias("max_y"))
    back = grid.rect_from_aoi(grid.aoi_from_rect(f, F.lit(0.01)), F.lit(0.01))
    return back.select("cell_id", "ul_x", "ul_y", "lr_x", "lr_y", F.round("min_lon", 9).alias("min_lon"), F.round("max_lon", 9).alias("max_lon"))


@query("s8_lines_samples", """SELECT l.table_name, l.zoom_level, CAST(coalesce(max_row - min_row + 1, floor((max_y - min_y)/pixel_y_size + 0.5)) AS BIGINT) AS lines, CAST(coalesce(max_column - min_column + 1, floor((max_x - min_x)/pixel_x_size + 0.5)) AS BIGINT) AS samples, coalesce(min_column, 0) AS offset_x, coalesce(min_row, 0) AS offset_y
FROM levels l LEFT JOIN extents e USING (table_name, zoom_level) JOIN sets s USING (table_name)""")
def s8(t):
    return pyramid.lines_samples(t.levels, t.extents, t.sets).select("table_name", "zoom_level", "lines", "samples", "offset_x", "offset_y")


@query("s9_valid_tile_address", "SELECT event_id FROM tile_stream t WHERE EXISTS (SELECT 1 FROM levels l WHERE l.table_name = 'AFRICA' AND l.zoom_level = t.zoom_level AND tile_column < matrix_width AND tile_row < matrix_height)")
def s9(t):
    return pyramid.valid_addresses(t.tile_stream, t.levels.filter("table_name = 'AFRICA'")).select("event_id")


@query("s26_wrap_lon", "SELECT gx, gy, CASE WHEN lon < 0 THEN lon + 360 ELSE lon END AS lon FROM swath_grid")
def s26(t):
    return t.swath_grid.select("gx", "gy", grid.wrap_lon(F.col("lon"), F.lit(True)).alias("lon"))


@query("s29_decimation", "SELECT l.table_name, l.zoom_level, coalesce((max_row - min_row + 1) / CAST(first(max_row - min_row + 1) OVER (PARTITION BY l.table_name ORDER BY l.zoom_level DESC) AS DOUBLE), pow(2.0, -(max(l.zoom_level) OVER (PARTITION BY l.table_name) - l.zoom_level))) AS scale FROM levels l LEFT JOIN extents e USING (table_name, zoom_level)")
def s29(t):
    from pyspark.sql.window import Window

    w = Window.partitionBy("table_name")
    j = t.levels.join(t.extents, ["table_name", "zoom_level"], "left").withColumn("lines", F.col("max_row") - F.col("min_row") + 1)
    j = j.withColumns({"full": F.first("lines").over(w.orderBy(F.desc("zoom_level"))), "level": F.max("zoom_level").over(w) - F.col("zoom_level")})
    return j.select("table_name", "zoom_level", grid.decimation(F.col("lines"), F.col("full"), F.col("level")).alias("scale"))


@query("w8_level_order", "SELECT table_name, zoom_level, CAST(row_number() OVER (PARTITION BY table_name ORDER BY zoom_level DESC) - 1 AS INT) AS res_level FROM levels")
def w8(t):
    from pyspark.sql.window import Window

    return t.levels.select("table_name", "zoom_level", (F.row_number().over(Window.partitionBy("table_name").orderBy(F.desc("zoom_level"))) - 1).alias("res_level"))


@query("a10_pyramid_totals", "WITH b AS (SELECT image_id, ceil(width/256.0)*ceil(height/256.0) AS base FROM rects) SELECT CAST(sum(base) AS BIGINT) AS base_tiles, CAST(sum(base*(1+4+16)) AS BIGINT) AS all_tiles FROM b")
def a10(t):
    base = (grid.matrix_size(F.col("width"), 256) * grid.matrix_size(F.col("height"), 256)).cast("long")
    return t.rects.agg(F.sum(base).alias("base_tiles"), F.sum(base * sum(4**k for k in range(3))).alias("all_tiles"))


@query("a16_validate", "SELECT table_name, zoom_level, round((max_x-min_x)/matrix_width/tile_width, 12) AS computed_x, round(pixel_x_size - (max_x-min_x)/matrix_width/tile_width, 12) + 0.0 AS off_x, round(pixel_y_size - (max_y-min_y)/matrix_height/tile_height, 12) + 0.0 AS off_y FROM levels JOIN sets USING (table_name)")
def a16(t):
    return pyramid.validate(t.sets, t.levels).select("table_name", "zoom_level", *[(F.round(c, 12) + 0.0).alias(c) for c in ("computed_x", "off_x", "off_y")])


@query("a19_info", "SELECT 'sets' AS name, count(*) AS n FROM sets UNION ALL SELECT 'levels', count(*) FROM levels UNION ALL SELECT 'extents', count(*) FROM extents UNION ALL SELECT 'srs', count(*) FROM srs UNION ALL SELECT 'footprints', count(*) FROM footprints UNION ALL SELECT 'tiles', count(*) FROM tile_stream")
def a19(t):
    parts = [d.agg(F.count(F.lit(1)).alias("n")).select(F.lit(n).alias("name"), "n") for n, d in (("sets", t.sets), ("levels", t.levels), ("extents", t.extents), ("srs", t.srs), ("footprints", t.footprints), ("tiles", t.tile_stream))]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@query("t3_next_srs", """SELECT 'EPSG' AS organization, n_nationkey * 163 + 1 AS code, CAST(CASE WHEN n_nationkey * 163 + 1 = 1 THEN 3 ELSE 2 + row_number() OVER (ORDER BY n_nationkey*163+1) END AS INT) AS srs_id FROM nation UNION ALL SELECT 'EPSG', 4326, 1""")
def t3(t):
    wanted = t.nation.select(F.lit("EPSG").alias("organization"), (F.col("n_nationkey") * 163 + 1).alias("code")).unionByName(t.srs.filter("code = 4326").select("organization", "code"))
    return pyramid.next_srs_ids(t.srs, wanted)


@query("t4_probe", "SELECT zoom_level, tile_column, tile_row, event_id FROM tile_stream WHERE zoom_level = (SELECT max(zoom_level) FROM tile_stream) ORDER BY event_id LIMIT 1")
def t4(t):
    return pyramid.probe(t.tile_stream)


@query("t4_probe_shapes", """WITH w AS (SELECT 'table' || (tile_column * 8 + tile_row) AS table_name, * FROM tile_stream), f AS (SELECT * FROM w QUALIFY row_number() OVER (PARTITION BY table_name ORDER BY zoom_level DESC, event_id) = 1)
SELECT n.table_name, f.zoom_level, coalesce(CASE WHEN event_id % 3 > 0 THEN CAST(event_id % 3 AS INT) END, 3) AS bands, coalesce(CASE WHEN event_id % 2 = 1 THEN 'u16' END, 'u8') AS scalar, coalesce(CAST(64 + event_id % 4 * 64 AS INT), 256) AS tile_width, coalesce(CASE WHEN event_id % 4 > 0 THEN CAST(event_id % 4 * 128 AS INT) END, 256) AS tile_height FROM (SELECT DISTINCT table_name FROM w UNION ALL SELECT 'empty') n LEFT JOIN f USING (table_name)""")
def t4_shapes(t):
    e = F.col("event_id")
    w = t.tile_stream.withColumn("table_name", F.concat(F.lit("table"), F.col("tile_column") * 8 + F.col("tile_row")))
    shape = {"bands": F.when(e % 3 > 0, (e % 3).cast("int")), "scalar": F.when(e % 2 == 1, "u16"), "tile_width": (64 + e % 4 * 64).cast("int"), "tile_height": F.when(e % 4 > 0, (e % 4 * 128).cast("int"))}
    names = w.select("table_name").distinct().unionByName(t.spark.range(1).select(F.lit("empty").alias("table_name")))
    return pyramid.probe_shapes(w.withColumns(shape).withColumn("tile_id", e), names)


@query("u2_disjoint_levels", "SELECT zoom_level FROM levels WHERE table_name = 'ASIA' INTERSECT SELECT zoom_level FROM levels WHERE table_name = 'AFRICA' AND zoom_level > 2")
def u2(t):
    return t.levels.filter("table_name = 'ASIA'").select("zoom_level").intersect(t.levels.filter("table_name = 'AFRICA' AND zoom_level > 2").select("zoom_level"))


@query("u3_unique_tiles", "SELECT DISTINCT zoom_level, tile_column, tile_row FROM tile_stream")
def u3(t):
    return t.tile_stream.select(*KEY).dropDuplicates(list(KEY))


@query("u4_missing_tiles", """WITH l AS (SELECT * FROM levels WHERE table_name = 'AFRICA' AND zoom_level >= 3), x AS (SELECT *, unnest(range(0, matrix_width)) AS c FROM l), y AS (SELECT *, unnest(range(0, matrix_height)) AS r FROM x)
SELECT zoom_level, CAST(c AS INT) AS tile_column, CAST(r AS INT) AS tile_row FROM y EXCEPT SELECT zoom_level, tile_column, tile_row FROM tile_stream""")
def u4(t):
    return pyramid.missing_tiles(t.levels.filter("table_name = 'AFRICA' AND zoom_level >= 3"), t.tile_stream)


@query("j14_level_extent", "SELECT l.table_name, l.zoom_level, e.zoom_level IS NOT NULL AS matched FROM levels l LEFT JOIN extents e ON l.table_name = e.table_name AND l.zoom_level = e.zoom_level")
def j14(t):
    return pyramid.lines_samples(t.levels, t.extents, t.sets).select("table_name", "zoom_level", "matched")


@query("r5_write_pyramid", "SELECT 'stream' AS table_name, zoom_level, tile_column, tile_row, min(event_id) AS event_id FROM tile_stream GROUP BY zoom_level, tile_column, tile_row")
def r5(t):
    path = new_path(t.spark, "pyramid")
    pyramid.write_pyramid(t.tile_stream.groupBy(*KEY).agg(F.min("event_id").alias("event_id")).withColumn("table_name", F.lit("stream")), path)
    return t.spark.read.parquet(path).select("table_name", *KEY, "event_id")
