"""Latitude and longitude grids of swaths."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def extrapolate_edges(grid: DataFrame) -> DataFrame:
    """The grid (gx, gy, lat, lon) with one more column and row, each going on by the last difference, over the date line too.
    A grid row is a few thousand nodes at most, so rows and columns are windows."""

    def longer(g: DataFrame, along: str, across: str) -> DataFrame:
        w = Window.partitionBy(across).orderBy(along)
        east = F.when(F.col("lon") < 0, F.col("lon") + 360.0).otherwise(F.col("lon"))
        g2 = g.withColumns({"_e": east, "_last": F.max(along).over(Window.partitionBy(across))})
        g2 = g2.withColumns({"_pe": F.lag("_e").over(w), "_plat": F.lag("lat").over(w), "_plon": F.lag("lon").over(w)}).filter((F.col(along) == F.col("_last")) & F.col("_plat").isNotNull())
        wraps = F.abs(F.col("lon") - F.col("_plon")) > 180.0
        lon = F.when(wraps, 2 * F.col("_e") - F.col("_pe")).otherwise(2 * F.col("lon") - F.col("_plon"))
        lon = F.when(lon > 180.0, lon - 360.0).when(lon < -180.0, lon + 360.0).otherwise(lon)
        more = g2.select((F.col(along) + 1).alias(along), across, (2 * F.col("lat") - F.col("_plat")).alias("lat"), lon.alias("lon"))
        return g.select("gx", "gy", "lat", "lon").unionByName(more)

    return longer(longer(grid, "gx", "gy"), "gy", "gx")


def crosses_dateline(lines: DataFrame, key: str, order: str) -> DataFrame:
    """Whether each scan line passes from 179 to -179 before it turns back to 178, or the mirror of it; degrees are truncated."""
    degree = F.col("lon").cast("int")
    letter = F.when(degree == 179, "a").when(degree == 178, "b").when(degree == -179, "c").when(degree == -178, "d").otherwise("x")
    path = lines.groupBy(key).agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct(order, letter.alias("l")))), lambda s: s["l"]), "").alias("path"))
    return path.select(key, F.col("path").rlike("^[^ac]*(a[^bc]*c|c[^ad]*a)").alias("crosses"))


def footprint_wkt(grid: DataFrame, step: int = 128) -> DataFrame:
    """The border of the grid as WKT: every ``step`` nodes and the corners, clockwise from node (0, 0) back to it; null if a
    node lacks its position."""
    size = grid.agg(F.max("gx").alias("w"), F.max("gy").alias("h"))
    g = grid.join(F.broadcast(size))
    x, y, w, h = (F.col(c) for c in ("gx", "gy", "w", "h"))
    side = lambda n, on, at, end: F.when(on & ((at % step == 0) | end), F.struct(F.lit(n).alias("side"), at.alias("at")))
    keys = F.array(side(0, y == 0, x, x == w), side(1, (x == w) & (y > 0), y, y == h), side(2, (y == h) & (x < w), w - x, x == 0), side(3, (x == 0) & (y < h), h - y, y == 0))
    point = F.concat(F.round("lon", 8).cast("string"), F.lit(" "), F.round("lat", 8).cast("string"))
    border = g.select(F.explode(F.filter(keys, lambda k: k.isNotNull())).alias("key"), point.alias("p"))
    lists = border.agg(F.sort_array(F.collect_list(F.struct("key", "p"))).alias("ps"))
    text = F.concat(F.lit("MULTIPOLYGON((("), F.array_join(F.transform("ps", lambda s: s["p"]), ","), F.lit(")))"))
    return lists.select(F.when(~F.exists("ps", lambda s: s["p"].isNull()), text).alias("wkt"))
