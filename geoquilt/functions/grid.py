"""Tile grids, zoom levels and map coordinates as column expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Extent in metres of the world in a reference system, as (width, height). Fixed values.
WORLD_METRES = {4326: (40030220.0, 20015110.0), 3395: (40075016.68557849, 40075016.68557849), 3857: (40075016.68557849, 40075016.68557849)}


def lonlat_to_pixel(lon: Column, lat: Column, depth: int, tile: int = 256) -> tuple[Column, Column]:
    """(sample, line) of the pixel of a web-mercator pyramid level."""
    size = float(tile * 2**depth)
    s = F.sin(-F.radians(lat))
    y = F.lit(0.5) * F.log((1 + s) / (1 - s)) / (2 * math.pi) + 0.5
    return F.floor((lon + 180.0) / 360.0 * size), F.floor(y * size)


def pixel_to_lonlat(samp: Column, line: Column, depth: int, tile: int = 256) -> tuple[Column, Column]:
    """(lon, lat) of a pixel position."""
    size = float(tile * 2**depth)
    e = F.exp(F.lit(4 * math.pi) * (line / size - 0.5))
    return samp / size * 360.0 - 180.0, -F.degrees(F.asin((e - 1) / (e + 1)))


def zoom_gsd(epsg: int, zoom: Column, tile_x: int = 256, tile_y: int = 256) -> tuple[Column, Column]:
    """Ground sample distance of a grid-aligned level: degrees for 4326, which has two tiles side by side at level 0, else metres."""
    if epsg not in WORLD_METRES:
        raise ValueError(f"no grid for EPSG {epsg}")
    w, h = (180.0, 180.0) if epsg == 4326 else WORLD_METRES[epsg]
    scale = F.pow(F.lit(2.0), zoom)
    return F.lit(w / tile_x) / scale, F.lit(h / tile_y) / scale


def gsd_at(full: Column, full_zoom: Column, zoom: Column) -> Column:
    """Ground sample distance of another level than the full-resolution one."""
    return full * F.pow(F.lit(2.0), (full_zoom - zoom).cast("double"))


def level_count(width: Column, height: Column, tile_x: int = 256, tile_y: int = 256) -> Column:
    """One level, and one more as long as both sides are longer than a quarter tile; 0 for an empty area."""
    halvings = F.filter(F.sequence(F.lit(0), F.lit(62)), lambda k: (width / F.pow(F.lit(2.0), k) > tile_x / 4) & (height / F.pow(F.lit(2.0), k) > tile_y / 4))
    return F.when((width > 0) & (height > 0), F.size(halvings) + 1).otherwise(F.lit(0))


def zoom_levels(width: Column, height: Column, gsd: Column, epsg: int, aligned: bool = True, tile: int = 256) -> Column:
    """Levels to build, ascending. Aligned: the finest is the first whose distance is at most 1.5 times the source's."""
    n = level_count(width, height, tile, tile)
    if not aligned:
        return F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))
    zx, zy = zoom_gsd(epsg, F.lit(0), tile, tile)
    start = F.size(F.filter(F.sequence(F.lit(0), F.lit(62)), lambda k: (zx / F.pow(F.lit(2.0), k) > gsd * 1.5) & (zy / F.pow(F.lit(2.0), k) > gsd * 1.5)))
    return F.when(n > 0, F.sequence(F.greatest(F.lit(0), start - (n - 1)), start)).otherwise(F.array().cast("array<int>"))


def user_levels(levels: Column) -> Column:
    """A requested list of levels, sorted; none if any is negative."""
    return F.when(F.exists(levels, lambda z: z < 0), F.array().cast("array<int>")).otherwise(F.sort_array(levels))


def matrix_size(length: Column, tile: int) -> Column:
    return F.ceil(length / F.lit(tile)).cast("int")


def expand_to_tiles(lo: Column, hi: Column, tile: int) -> tuple[Column, Column]:
    """A closed pixel range stretched to tile boundaries."""
    return F.floor(lo / tile) * tile, (F.floor(hi / tile) + 1) * tile - 1


def aoi_from_rect(df: DataFrame, gsd: Column, origin_x: float = -180.0, origin_y: float = 90.0) -> DataFrame:
    """Pixel range of a rectangle given by its edges: pixel centres lie half a distance inside."""
    at = lambda v: F.floor(v / gsd + 0.5).cast("long")
    return df.withColumns({"ul_x": at(F.col("min_x") - origin_x), "ul_y": at(F.lit(origin_y) - F.col("max_y")), "lr_x": at(F.col("max_x") - gsd - origin_x), "lr_y": at(F.lit(origin_y) - F.col("min_y") - gsd)})


def rect_from_aoi(df: DataFrame, gsd: Column, origin_x: float = -180.0, origin_y: float = 90.0) -> DataFrame:
    """Edges of a pixel range, kept within the world."""
    x = lambda c, add: F.least(F.lit(180.0), F.greatest(F.lit(-180.0), F.lit(origin_x) + (F.col(c) + add) * gsd))
    y = lambda c, add: F.least(F.lit(90.0), F.greatest(F.lit(-90.0), F.lit(origin_y) - (F.col(c) + add) * gsd))
    return df.withColumns({"min_lon": x("ul_x", 0), "max_lon": x("lr_x", 1), "max_lat": y("ul_y", 0), "min_lat": y("lr_y", 1)})


def wrap_lon(lon: Column, crosses: Column) -> Column:
    """Longitudes of a swath over the date line, on one side of it."""
    return F.when(crosses & (lon < 0), lon + 360.0).otherwise(lon)


def decimation(lines: Column, lines_full: Column, level: Column) -> Column:
    """Scale of a level: its lines over those of level 0, or else a power of two."""
    return F.coalesce(lines / lines_full, F.pow(F.lit(2.0), -level))


def overlay_regions(images: DataFrame, limit: int = 400) -> DataFrame:
    """Region tree of each image (image_id, width, height): tiles of each zoom, the children that exist, and pixel limits.

    The longer side is halved until it is at most ``limit``. Whole tiles only: what remains at the right and at the top is
    left out. Rows count from the bottom; row_index counts from the top."""
    longer = F.greatest("width", "height")
    halvings = F.size(F.filter(F.sequence(F.lit(0), F.lit(40)), lambda k: longer / F.pow(F.lit(2.0), k) > limit))
    side = longer / F.pow(F.lit(2.0), F.col("max_zoom"))
    sized = images.withColumn("max_zoom", halvings)
    wide = F.col("width") >= F.col("height")
    sized = sized.withColumns({"tile_x": F.when(wide, side).otherwise(side * F.col("width") / F.col("height")).cast("int"), "tile_y": F.when(wide, side * F.col("height") / F.col("width")).otherwise(side).cast("int")})
    zooms = sized.withColumn("zoom", F.explode(F.sequence(F.lit(0), F.col("max_zoom"))))
    scale = F.pow(F.lit(2.0), F.col("max_zoom") - F.col("zoom"))
    loops = zooms.withColumns({"nx": F.greatest(F.lit(1), F.floor(F.col("width") / (scale * F.col("tile_x"))).cast("int")), "ny": F.greatest(F.lit(1), F.floor(F.col("height") / (scale * F.col("tile_y"))).cast("int"))})
    tiles = loops.withColumn("ix", F.explode(F.sequence(F.lit(0), F.col("nx") - 1))).withColumn("iy", F.explode(F.sequence(F.lit(0), F.col("ny") - 1)))
    finer = F.pow(F.lit(2.0), F.col("max_zoom") - F.col("zoom") - 1)
    more = lambda i, length, tile: F.when(F.col("zoom") == F.col("max_zoom"), F.lit(0)).when(F.col(i) * 2 + 1 < F.ceil(F.col(length) / (finer * F.col(tile))), F.lit(2)).otherwise(F.lit(1))
    return tiles.withColumns({"row_index": F.col("ny") - F.col("iy") - 1, "children": more("ix", "width", "tile_x") * more("iy", "height", "tile_y"), "min_lod": F.lit(128), "max_lod": F.when(F.col("zoom") == F.col("max_zoom"), F.lit(-1)).otherwise(F.lit(2048))})
