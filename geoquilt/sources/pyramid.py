"""Tile pyramids as partitioned Parquet tables and their metadata tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from geoquilt.sources.shared import materialize


def entries(sets: DataFrame, levels: DataFrame, extents: DataFrame, srs: DataFrame) -> DataFrame:
    """One row for each pyramid that has levels: levels and extents as lists, finest first; reference system and extents may be missing."""
    lv = levels.groupBy("table_name").agg(F.sort_array(F.collect_list(F.struct("zoom_level", *[c for c in levels.columns if c not in ("table_name", "zoom_level")])), False).alias("levels"))
    ex = extents.groupBy("table_name").agg(F.sort_array(F.collect_list(F.struct("zoom_level", *[c for c in extents.columns if c not in ("table_name", "zoom_level")])), False).alias("extents"))
    return sets.join(lv, "table_name").join(ex, "table_name", "left").join(srs, "srs_id", "left")


def strict_entries(sets: DataFrame, levels: DataFrame, extents: DataFrame, srs: DataFrame) -> DataFrame:
    """As entries, but the reference system must be there; tells whether the numbers of levels and extents differ."""
    found = entries(sets, levels, extents, srs).filter(F.col("code").isNotNull())
    return found.withColumn("count_mismatch", F.size("levels") != F.coalesce(F.size("extents"), F.lit(0)))


def tile_lookup(tiles: DataFrame, zoom: int, column: int, row: int) -> DataFrame:
    """A tile by its address; zoom_level is a partition column of written pyramids, the others are pushed down."""
    return tiles.filter((F.col("zoom_level") == zoom) & (F.col("tile_column") == column) & (F.col("tile_row") == row))


def tiles_for_rect(rects: DataFrame, tile_w: int, tile_h: int) -> DataFrame:
    """Addresses of the tiles that each rectangle (x0, y0, width, height, offset_x, offset_y) meets, with the part that it covers."""
    x0, y0 = F.col("x0") + F.col("offset_x"), F.col("y0") + F.col("offset_y")
    r = rects.withColumns({"_x0": x0, "_y0": y0, "_x1": x0 + F.col("width") - 1, "_y1": y0 + F.col("height") - 1})
    r = r.withColumn("tile_column", F.explode(F.sequence(F.floor(F.col("_x0") / tile_w), F.floor(F.col("_x1") / tile_w))))
    r = r.withColumn("tile_row", F.explode(F.sequence(F.floor(F.col("_y0") / tile_h), F.floor(F.col("_y1") / tile_h))))
    clip = {
        "clip_x0": F.greatest(F.col("_x0"), F.col("tile_column") * tile_w), "clip_x1": F.least(F.col("_x1"), (F.col("tile_column") + 1) * tile_w - 1),
        "clip_y0": F.greatest(F.col("_y0"), F.col("tile_row") * tile_h), "clip_y1": F.least(F.col("_y1"), (F.col("tile_row") + 1) * tile_h - 1),
    }
    return r.withColumns(clip).drop("_x0", "_y0", "_x1", "_y1")


def frames_for_rect(frames: DataFrame, rects: DataFrame, size: int = 1024) -> DataFrame:
    """Frames (image_id, col, row, w, h) of uneven sizes that each rectangle meets; a frame starts where those before it end.

    Frames and rectangles meet in bins of ``size`` pixels on both axes, and a pair is kept in the first bin that both are in."""
    before = lambda part, order, size: F.coalesce(F.sum(size).over(Window.partitionBy("image_id", part).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = frames.withColumns({"px": before("row", "col", "w"), "py": before("col", "row", "h")}).filter("w > 0 AND h > 0")
    r = rects.select("image_id", "x0", "y0", "width", "height").filter("width > 0 AND height > 0")
    bins = lambda at, length: F.explode(F.sequence(F.floor(F.col(at) / size), F.floor((F.col(at) + F.col(length) - 1) / size)))
    a = placed.withColumn("_bx", bins("px", "w")).withColumn("_by", bins("py", "h"))
    b = r.withColumn("_bx", bins("x0", "width")).withColumn("_by", bins("y0", "height"))
    meets = (F.col("px") < F.col("x0") + F.col("width")) & (F.col("px") + F.col("w") > F.col("x0")) & (F.col("py") < F.col("y0") + F.col("height")) & (F.col("py") + F.col("h") > F.col("y0"))
    here = (F.col("_bx") == F.floor(F.greatest("px", "x0") / size)) & (F.col("_by") == F.floor(F.greatest("py", "y0") / size))
    return a.join(b, ["image_id", "_bx", "_by"]).filter(meets & here).drop("_bx", "_by")


def payload_type(data: Column) -> Column:
    """Media type of a tile's bytes by their first ones."""
    head = F.hex(F.substring(data, 1, 8))
    long_enough = F.octet_length(data) > 7
    return F.when(long_enough & head.rlike("^FFD8FF(E0|DB)"), "image/jpeg").when(long_enough & (head == "89504E470D0A1A0A"), "image/png").otherwise("unknown")


#: Tiles that a task writes into one file.
TILES_PER_FILE = 4096


def write_pyramid(tiles: DataFrame, path: str) -> None:
    """Write tiles partitioned by table and zoom; an address that occurs twice is an error.

    The input is worked out once. A level is dealt to as many tasks as its counted tiles ask for, so the finest one, which
    has most of them, isn't held up by a few."""
    address = ["table_name", "zoom_level", "tile_column", "tile_row"]
    tiles = materialize(tiles, "tiles")
    if tiles.groupBy(*address).count().filter("count > 1").limit(1).count():
        raise ValueError("a tile address occurs more than once")
    parts = tiles.groupBy("table_name", "zoom_level").agg(F.ceil(F.count(F.lit(1)) / F.lit(TILES_PER_FILE)).cast("int").alias("_parts"))
    parts = materialize(parts, "level-parts")
    most = parts.agg(F.coalesce(F.sum("_parts"), F.lit(1)).cast("int")).first()[0]
    placed = tiles.join(F.broadcast(parts), ["table_name", "zoom_level"]).withColumn("_part", F.pmod(F.xxhash64("tile_column", "tile_row"), F.col("_parts")))  # a row for each level
    placed.repartition(max(1, most), "table_name", "zoom_level", "_part").drop("_parts", "_part").write.partitionBy("table_name", "zoom_level").parquet(path)


def append_levels(spark: SparkSession, path: str, tiles: DataFrame, table: str) -> None:
    """Add coarser or finer levels to a written pyramid; a level that is there, or one below its lowest, is an error."""
    have = {r.zoom_level for r in spark.read.parquet(path).filter(F.col("table_name") == table).select("zoom_level").distinct().collect()}
    new = {r.zoom_level for r in tiles.select("zoom_level").distinct().collect()}
    if have & new:
        raise ValueError(f"levels {sorted(have & new)} are there already")
    if have and new and min(new) < min(have):
        raise ValueError(f"level {min(new)} lies below the lowest, {min(have)}")
    tiles.withColumn("table_name", F.lit(table)).write.mode("append").partitionBy("table_name", "zoom_level").parquet(path)


def output_rect(existing: DataFrame, wanted: DataFrame) -> DataFrame:
    """Rectangles for new levels: those wanted, clipped to the rectangle of the entry, whose EPSG code must be the same."""
    e = existing.select("table_name", F.col("code").alias("code_e"), *[F.col(c).alias(f"{c}_e") for c in ("min_x", "min_y", "max_x", "max_y")])
    j = wanted.join(e, "table_name").filter(F.col("code") == F.col("code_e"))
    clip = {c: (F.greatest if c.startswith("min") else F.least)(c, f"{c}_e") for c in ("min_x", "min_y", "max_x", "max_y")}
    return j.withColumns(clip).filter("min_x < max_x AND min_y < max_y").select("table_name", "code", *clip)


def numbered_entries(catalogue: DataFrame, order: str) -> DataFrame:
    """Sub-datasets with their index from 0."""
    return catalogue.withColumn("entry", F.row_number().over(Window.orderBy(order)) - 1)


def renderable(datasets: DataFrame, enabled: DataFrame) -> DataFrame:
    """Datasets of numbers with two or more dimensions, the first two longer than 1, whose name is enabled."""
    ok = F.col("class").isin("integer", "float") & (F.size("extents") >= 2) & (F.get("extents", F.lit(0)) > 1) & (F.get("extents", F.lit(1)) > 1)
    return datasets.filter(ok).join(enabled, "name", "left_semi")


def lines_samples(levels: DataFrame, extents: DataFrame, sets: DataFrame) -> DataFrame:
    """Lines and samples of each level, from its extent where one is there, else from the set's size; offset and tie point too."""
    e = extents.withColumn("has_extent", F.lit(True))
    j = levels.join(e, ["table_name", "zoom_level"], "left").join(sets.select("table_name", "min_x", "min_y", "max_x", "max_y"), "table_name")
    return j.withColumns(
        {
            "lines": F.coalesce(F.col("max_row") - F.col("min_row") + 1, F.floor((F.col("max_y") - F.col("min_y")) / F.col("pixel_y_size") + 0.5)).cast("long"),
            "samples": F.coalesce(F.col("max_column") - F.col("min_column") + 1, F.floor((F.col("max_x") - F.col("min_x")) / F.col("pixel_x_size") + 0.5)).cast("long"),
            "offset_x": F.coalesce("min_column", F.lit(0)), "offset_y": F.coalesce("min_row", F.lit(0)), "matched": F.coalesce("has_extent", F.lit(False)),
        }
    )


def valid_addresses(tiles: DataFrame, levels: DataFrame) -> DataFrame:
    """Tiles whose address lies in the matrix of their level."""
    m = levels.select("zoom_level", "matrix_width", "matrix_height")
    inside = (F.col("tile_column") >= 0) & (F.col("tile_row") >= 0) & (F.col("tile_column") < F.col("matrix_width")) & (F.col("tile_row") < F.col("matrix_height"))
    return tiles.join(m, "zoom_level").filter(inside).drop("matrix_width", "matrix_height")


def missing_tiles(levels: DataFrame, tiles: DataFrame) -> DataFrame:
    """Addresses of the full matrices that aren't stored."""
    full = levels.withColumn("tile_column", F.explode(F.sequence(F.lit(0), F.col("matrix_width") - 1))).withColumn("tile_row", F.explode(F.sequence(F.lit(0), F.col("matrix_height") - 1)))
    key = ["zoom_level", "tile_column", "tile_row"]
    return full.select(*key).join(tiles.select(*key), key, "left_anti")


def validate(sets: DataFrame, levels: DataFrame) -> DataFrame:
    """Stored pixel sizes beside those that the set's extent, the matrix and the tiles give."""
    j = levels.join(sets, "table_name")
    x = (F.col("max_x") - F.col("min_x")) / F.col("matrix_width") / F.col("tile_width")
    y = (F.col("max_y") - F.col("min_y")) / F.col("matrix_height") / F.col("tile_height")
    return j.withColumns({"computed_x": x, "computed_y": y, "off_x": F.col("pixel_x_size") - x, "off_y": F.col("pixel_y_size") - y})


def next_srs_ids(srs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(organization, code, srs_id): known ones keep their id, new ones follow the largest, 2 at least."""
    known = wanted.join(srs, ["organization", "code"], "left")
    most = srs.agg(F.greatest(F.coalesce(F.max("srs_id"), F.lit(1)), F.lit(1)).alias("most"))
    rank = F.dense_rank().over(Window.partitionBy(F.col("srs_id").isNull()).orderBy("organization", "code"))
    return known.join(F.broadcast(most)).withColumn("srs_id", F.when(F.col("srs_id").isNull(), F.col("most") + rank).otherwise(F.col("srs_id"))).drop("most")


def probe(tiles: DataFrame) -> DataFrame:
    """The first tile of the finest level, as what a reader learns a pyramid's bands and sizes from."""
    best = tiles.agg(F.max("zoom_level").alias("zoom_level"))
    return tiles.join(F.broadcast(best), "zoom_level").agg(F.min_by(F.struct("zoom_level", "tile_column", "tile_row", "event_id"), "event_id").alias("t")).select("t.*")


#: What a reader takes a pyramid's tiles to be where none tells. Fixed values.
TILE_DEFAULTS = {"bands": 3, "scalar": "u8", "tile_width": 256, "tile_height": 256}


def probe_shapes(tiles: DataFrame, tables: DataFrame) -> DataFrame:
    """(table_name, zoom_level, bands, scalar, tile_width, tile_height) of each of ``tables`` (table_name): what the first
    tile, by tile_id, of its finest level has, and the defaults for what that lacks or where a table has no tile."""
    shape = F.struct("zoom_level", *TILE_DEFAULTS)
    first = tiles.groupBy("table_name").agg(F.min_by(shape, F.struct(-F.col("zoom_level"), F.col("tile_id"))).alias("t"))
    return tables.join(first, "table_name", "left").select("table_name", "t.zoom_level", *[F.coalesce(F.col(f"t.{c}"), F.lit(v)).alias(c) for c, v in TILE_DEFAULTS.items()])
