"""Rasters as long tables (image_id, x, y, v), where a null pixel is an absent row."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from geoquilt.operators.graph import components, cycles
from geoquilt.sources.shared import materialize

#: Largest values of scalar types. Fixed values.
TYPE_MAX = {"u8": 255.0, "s8": 127.0, "u16": 65535.0, "s16": 32767.0, "u32": 4294967295.0, "s32": 2147483647.0, "f32": 3.4028234663852886e38, "f64": 1.7976931348623157e308}


def full_grid(images: DataFrame, width: int, height: int, block: int = 256) -> DataFrame:
    """Every position of each image. Addresses of blocks are dealt to tasks first, so no task makes a whole image."""
    whole = lambda length: F.sequence(F.lit(0), F.lit((length - 1) // block))
    inside = lambda at, length: F.sequence(F.col(at) * block, F.least(F.lit(length), (F.col(at) + 1) * block) - 1)
    blocks = images.withColumn("_bx", F.explode(whole(width))).withColumn("_by", F.explode(whole(height)))
    tasks = int(images.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # a given number is not coalesced by bytes
    blocks = blocks.repartition(tasks, "image_id", "_bx", "_by")
    return blocks.withColumn("x", F.explode(inside("_bx", width))).withColumn("y", F.explode(inside("_by", height))).drop("_bx", "_by")


def tile_status(pixels: DataFrame, images: DataFrame, width: int, height: int, tile: int) -> DataFrame:
    """EMPTY, PARTIAL or FULL for each tile of each image, by its number of non-null pixels."""
    grid = images.withColumn("tile_x", F.explode(F.sequence(F.lit(0), F.lit((width - 1) // tile)))).withColumn("tile_y", F.explode(F.sequence(F.lit(0), F.lit((height - 1) // tile))))
    have = pixels.groupBy("image_id", F.floor(F.col("x") / tile).cast("int").alias("tile_x"), F.floor(F.col("y") / tile).cast("int").alias("tile_y")).agg(F.count("v").alias("n"))
    size = lambda c, whole: F.least(F.lit(tile), F.lit(whole) - F.col(c) * tile)
    j = grid.join(have, ["image_id", "tile_x", "tile_y"], "left").withColumn("n", F.coalesce("n", F.lit(0).cast("long")))
    return j.withColumn("status", F.when(F.col("n") == 0, "EMPTY").when(F.col("n") < size("tile_x", width) * size("tile_y", height), "PARTIAL").otherwise("FULL"))


def band_stats(pixels: DataFrame, palette_images: DataFrame, scalar: str = "u8", null_value: float | None = None, default_null: float = 0.0) -> DataFrame:
    """(image_id, n, min_px, max_px, null_px); palette images are 1..255 with null 0, and a null above the type's largest value is the default."""
    null_px = default_null if null_value is None or null_value > TYPE_MAX[scalar] else null_value
    s = pixels.groupBy("image_id").agg(F.count("v").alias("n"), F.min("v").cast("double").alias("lo"), F.max("v").cast("double").alias("hi"))
    s = s.join(palette_images.select("image_id", F.lit(True).alias("palette")), "image_id", "left")
    return s.select("image_id", "n", F.when(F.col("palette"), 1.0).otherwise(F.col("lo")).alias("min_px"), F.when(F.col("palette"), 255.0).otherwise(F.col("hi")).alias("max_px"), F.when(F.col("palette"), 0.0).otherwise(F.lit(null_px)).alias("null_px"))


def expand_palette(pixels: DataFrame, lut: DataFrame) -> DataFrame:
    """Colours of palette indices; unknown ones are black. The palette of an image has at most some thousand entries."""
    c = lut.select("idx", "r", "g", "b").withColumnRenamed("idx", "v")
    return pixels.join(F.broadcast(c), "v", "left").select("image_id", "x", "y", *[F.coalesce(k, F.lit(0)).alias(k) for k in "rgb"])


def palette_null_index(lut: DataFrame, preserve: bool) -> DataFrame:
    """The first index that is transparent (preserve), or else black."""
    cond = (F.col("a") == 0) if preserve else (F.col("r") == 0) & (F.col("g") == 0) & (F.col("b") == 0)
    return lut.agg(F.min(F.when(cond, F.col("idx"))).alias("null_index"))


def palette_of_inputs(inputs: DataFrame, group: str) -> DataFrame:
    """Whether a mosaic keeps a palette: only if every input has one; then the last one's is used."""
    return inputs.groupBy(group).agg(F.bool_and("has_lut").alias("use_lut"), F.max_by("lut_id", F.struct("position")).alias("last_lut")).withColumn("lut", F.when(F.col("use_lut"), F.col("last_lut"))).drop("last_lut")


def stretch(pixels: DataFrame, stats: DataFrame, top: int = 255) -> DataFrame:
    """Values mapped from their band's range to 0..top; stats have a row for each image."""
    width = F.col("max_px") - F.col("min_px")
    scaled = F.when(width > 0, F.floor((F.col("v") - F.col("min_px")) / width * top + 0.5)).otherwise(F.lit(0))
    return pixels.join(stats, "image_id").select("image_id", "x", "y", F.least(F.lit(top), F.greatest(F.lit(0), scaled)).cast("int").alias("v"))


def alpha_channel(pixels: DataFrame, images: DataFrame, width: int, height: int) -> DataFrame:
    """255 where there is a pixel, 0 where it is null."""
    return full_grid(images, width, height).join(pixels, ["image_id", "x", "y"], "left").select("image_id", "x", "y", F.when(F.col("v").isNull(), 0).otherwise(255).alias("alpha"))


def ycc_to_rgb(y: Column, cb: Column, cr: Column, offset: int, top: int) -> tuple[Column, Column, Column]:
    """RGB of luma and chroma: products are truncated, results kept in 0..top."""
    cb, cr = cb - offset, cr - offset
    keep = lambda c: F.least(F.lit(top), F.greatest(F.lit(0), c))
    return keep(y + (F.lit(1.402) * cr).cast("int")), keep(y - (F.lit(0.344) * cb + F.lit(0.714) * cr).cast("int")), keep(y + (F.lit(1.772) * cb).cast("int"))


def upsample_chroma(luma: DataFrame, chroma: DataFrame, fx: int, fy: int) -> DataFrame:
    """Chroma of a coarser grid beside each luma pixel."""
    c = chroma.withColumnsRenamed({"x": "cx", "y": "cy"})
    j = luma.withColumns({"cx": F.floor(F.col("x") / fx).cast("int"), "cy": F.floor(F.col("y") / fy).cast("int")})
    return j.join(c, ["image_id", "cx", "cy"]).drop("cx", "cy")


def split_complex(pixels: DataFrame) -> DataFrame:
    """The real part of band b as band 2b, the imaginary one as 2b + 1."""
    parts = F.array(F.struct((F.col("band") * 2).alias("band"), F.col("re").alias("v")), F.struct((F.col("band") * 2 + 1).alias("band"), F.col("im").alias("v")))
    return pixels.select("image_id", "x", "y", F.explode(parts).alias("p")).select("image_id", "x", "y", "p.band", "p.v")


def select_bands(tiles: DataFrame, bands: list[int], count: int) -> DataFrame:
    """Bands in the order asked for, counted from 1; one out of range means the first."""
    order = F.array(*[F.lit(b if 1 <= b <= count else 1) for b in bands])
    want = tiles.sparkSession.range(1).select(F.posexplode(order).alias("position", "band"))
    return tiles.join(F.broadcast(want), "band")


def valid_rect(pixels: DataFrame) -> DataFrame:
    """Upper left: the first valid pixel in raster order; lower right: the last. Not a bounding box."""
    r = pixels.groupBy("image_id").agg(F.min(F.struct("y", "x")).alias("a"), F.max(F.struct("y", "x")).alias("b"))
    return r.select("image_id", F.col("a.x").alias("ul_x"), F.col("a.y").alias("ul_y"), F.col("b.x").alias("lr_x"), F.col("b.y").alias("lr_y"))


def histogram(pixels: DataFrame) -> DataFrame:
    return pixels.groupBy("image_id", "v").agg(F.count(F.lit(1)).alias("n"))


#: Overview levels that share an exchange: pixels go to the task of the block that is one pixel of the last of them.
LEVELS_TOGETHER = 3


def overviews(pixels: DataFrame, width: int, height: int, stop: int, method: str = "average") -> DataFrame:
    """Levels 1, 2, ... (level, image_id, x, y, v), each half the one before and made from it, until the shorter side is at
    most ``stop``. Averages of LEVELS_TOGETHER levels are made where one exchange by block puts their pixels; the next ones
    start from the last of these, a 64th of the pixels."""
    now, out, level = pixels.select("image_id", "x", "y", F.col("v").cast("double").alias("v")), None, 0
    half = lambda c: F.floor(F.col(c) / 2).cast("int").alias(c)
    while min(width, height) >> level > stop:
        if method == "average":
            if level % LEVELS_TOGETHER == 0:
                block = lambda c: F.floor(F.col(c) / 2**LEVELS_TOGETHER).cast("int")
                now = now.select("image_id", "x", "y", "v", block("x").alias("bx"), block("y").alias("by")).repartition("image_id", "bx", "by")
            now = now.groupBy("image_id", "bx", "by", half("x"), half("y")).agg(F.avg("v").alias("v"))
        else:
            now = now.filter((F.col("x") % 2 == 0) & (F.col("y") % 2 == 0)).select("image_id", (F.col("x") / 2).cast("int").alias("x"), (F.col("y") / 2).cast("int").alias("y"), "v")
        level += 1
        part = now.select(F.lit(level).alias("level"), "image_id", "x", "y", "v")
        out = part if out is None else out.unionByName(part)
    if out is None:
        raise ValueError("the image is no larger than the stop size")
    return out


def resample(pixels: DataFrame, targets: DataFrame, source: tuple[str, ...] = ("image_id",), keys: tuple[str, ...] = ("image_id",)) -> DataFrame:
    """Bilinear values at source positions (sx, sy) of target pixels; null neighbours lend their weight to the others.

    ``source``: columns by which targets find their pixels; ``keys``: columns of targets that tell the results apart."""
    fx, fy = F.floor("sx"), F.floor("sy")
    wx, wy = F.col("sx") - fx, F.col("sy") - fy
    corner = lambda dx, dy: F.struct((fx + dx).cast("int").alias("x"), (fy + dy).cast("int").alias("y"), ((wx if dx else 1 - wx) * (wy if dy else 1 - wy)).alias("w"))
    own = list(dict.fromkeys([*source, *keys, "tx", "ty"]))
    near = targets.select(*own, F.explode(F.array(*[corner(dx, dy) for dy in (0, 1) for dx in (0, 1)])).alias("c")).select(*own, "c.*").filter("w > 0")
    j = near.join(pixels, [*source, "x", "y"])
    return j.groupBy(*keys, "tx", "ty").agg((F.sum(F.col("w") * F.col("v")) / F.sum("w")).alias("v"))


def outside_mask(vertices: DataFrame, mask: DataFrame) -> DataFrame:
    """Vertices that lie on no masked pixel."""
    return vertices.join(mask.select("image_id", "x", "y"), ["image_id", "x", "y"], "left_anti")


def boundary_edges(mask: DataFrame) -> DataFrame:
    """Directed unit edges around the foreground, which lies at their left hand (y grows downwards): image_id, x0, y0, x1, y1."""
    e = lambda dx, dy, a, b, c, d: F.struct(F.lit(dx).alias("dx"), F.lit(dy).alias("dy"), *[F.lit(v).alias(n) for v, n in ((a, "a"), (b, "b"), (c, "c"), (d, "d"))])
    sides = F.array(e(0, -1, 1, 0, 0, 0), e(-1, 0, 0, 0, 0, 1), e(0, 1, 0, 1, 1, 1), e(1, 0, 1, 1, 1, 0))
    s = mask.select("image_id", "x", "y", F.explode(sides).alias("s")).select("image_id", (F.col("x") + F.col("s.dx")).alias("nx"), (F.col("y") + F.col("s.dy")).alias("ny"), *[(F.col(p) + F.col(f"s.{q}")).alias(n) for p, q, n in (("x", "a", "x0"), ("y", "b", "y0"), ("x", "c", "x1"), ("y", "d", "y1"))])
    m = mask.select("image_id", F.col("x").alias("nx"), F.col("y").alias("ny"))
    return s.join(m, ["image_id", "nx", "ny"], "left_anti").select("image_id", "x0", "y0", "x1", "y1")


#: Type of the names of regions, rings and places.
NAME = "decimal(38,0)"


def place_name(image: Column, y: Column, x: Column) -> Column:
    """A number for a place of an image, in the order of image, y, x; places of any 32-bit numbers have different ones."""
    part = lambda c: c.cast("decimal(11,0)") + F.lit(1 << 31)
    width = F.lit(10**10).cast("decimal(11,0)")  # more than there are 32-bit numbers
    return ((part(image) * width + part(y)) * width + part(x)).cast(NAME)


def corner_contacts(mask: DataFrame) -> DataFrame:
    """(image_id, x, y, falling) of corners at which two pixels touch and their other two neighbours are not there; falling:
    the upper left and the lower right one touch."""
    around = F.array(*[F.struct(F.lit(1 - dx).alias("dx"), F.lit(1 - dy).alias("dy"), F.lit(1 << (2 * dy + dx)).alias("bit")) for dy in (0, 1) for dx in (0, 1)])
    s = mask.select("image_id", "x", "y", F.explode(around).alias("s")).select("image_id", (F.col("x") + F.col("s.dx")).alias("x"), (F.col("y") + F.col("s.dy")).alias("y"), "s.bit")
    met = s.groupBy("image_id", "x", "y").agg(F.sum("bit").alias("bits"))
    return met.filter(F.col("bits").isin(9, 6)).select("image_id", "x", "y", (F.col("bits") == 9).alias("falling"))


#: Half sides of the windows around a corner whose borders are counted. Fixed values.
WINDOWS = (2, 3, 4)


def minority_contacts(mask: DataFrame) -> DataFrame:
    """The corner contacts at which the foreground is joined, as it is the minority there: of the borders of growing windows
    around the corner, the first on which foreground and background aren't equally many decides; if none does, it is joined."""
    contacts = corner_contacts(mask)
    border = [(dx, dy, w) for w in WINDOWS for dx in range(-w, w) for dy in range(-w, w) if max(abs(2 * dx + 1), abs(2 * dy + 1)) == 2 * w - 1]
    places = F.array(*[F.struct(F.lit(dx).alias("dx"), F.lit(dy).alias("dy"), F.lit(w).alias("w")) for dx, dy, w in border])
    at = contacts.select("image_id", F.col("x").alias("cx"), F.col("y").alias("cy"), "falling", F.explode(places).alias("p"))
    at = at.select("image_id", "cx", "cy", "falling", (F.col("cx") + F.col("p.dx")).alias("x"), (F.col("cy") + F.col("p.dy")).alias("y"), "p.w")
    seen = at.join(mask.select("image_id", "x", "y", F.lit(1).alias("there")), ["image_id", "x", "y"], "left")
    more = {w: F.sum(F.when(F.col("w") == w, F.when(F.col("there").isNull(), -1).otherwise(1))) for w in WINDOWS}
    counted = seen.groupBy("image_id", "cx", "cy", "falling").agg(*[more[w].alias(f"m{w}") for w in WINDOWS])
    first = F.coalesce(*[F.when(F.col(f"m{w}") != 0, F.col(f"m{w}")) for w in WINDOWS], F.lit(-1))
    return counted.filter(first < 0).select("image_id", F.col("cx").alias("x"), F.col("cy").alias("y"), "falling")


def regions(mask: DataFrame, joined: DataFrame | None = None) -> DataFrame:
    """(image_id, x, y, region): 4-connected foreground, named by the first run in it in raster order; at the corner contacts
    of ``joined`` it is connected too. Rows become runs first, so the graph has a node for each run and an edge where runs
    of neighbouring rows overlap, or end and begin at a contact."""
    row = Window.partitionBy("image_id", "y").orderBy("x")
    runs = mask.withColumn("_g", F.col("x") - F.row_number().over(row)).groupBy("image_id", "y", "_g").agg(F.min("x").alias("a"), F.max("x").alias("b"))
    runs = runs.withColumn("run", place_name(F.col("image_id"), F.col("y"), F.col("a"))).drop("_g")
    up = runs.select("image_id", (F.col("y") + 1).alias("y"), F.col("a").alias("ua"), F.col("b").alias("ub"), F.col("run").alias("up"))
    touching = runs.join(up, ["image_id", "y"]).filter((F.col("a") <= F.col("ub")) & (F.col("b") >= F.col("ua"))).select("run", "up")
    if joined is not None:
        for falling, own, above in ((True, F.col("a"), F.col("ub") + 1), (False, F.col("b") + 1, F.col("ua"))):
            at = joined.filter(F.col("falling") == falling).select("image_id", "y", F.col("x").alias("corner"))
            met = runs.withColumn("corner", own).join(at, ["image_id", "y", "corner"]).join(up.withColumn("corner", above), ["image_id", "y", "corner"])
            touching = touching.unionByName(met.select("run", "up"))
    roots = components(touching, "run", "up")
    named = runs.join(roots, F.col("run") == F.col("node"), "left").withColumn("region", F.coalesce("root", "run"))
    return named.select("image_id", F.explode(F.sequence("a", "b")).alias("x"), "y", "region")


def straight_sides(edges: DataFrame) -> DataFrame:
    """Unit edges of a boundary joined where they go straight on: image_id, x0, y0, x1, y1, the direction dx, dy, and side, a
    number of its own."""
    flat = F.col("y0") == F.col("y1")
    e = edges.withColumns({"dx": F.col("x1") - F.col("x0"), "dy": F.col("y1") - F.col("y0"), "line": F.when(flat, F.col("y0")).otherwise(F.col("x0")), "at": F.when(flat, F.least("x0", "x1")).otherwise(F.least("y0", "y1"))})
    along = ("image_id", "dx", "dy", "line")
    e = e.withColumn("run", F.col("at") - F.row_number().over(Window.partitionBy(*along).orderBy("at")))
    s = e.groupBy(*along, "run").agg(F.min("at").alias("a"), (F.max("at") + 1).alias("b"))
    first, last = F.when(F.col("dx") + F.col("dy") > 0, F.col("a")).otherwise(F.col("b")), F.when(F.col("dx") + F.col("dy") > 0, F.col("b")).otherwise(F.col("a"))
    spot = lambda at: (F.when(F.col("dy") == 0, at).otherwise(F.col("line")).cast("int"), F.when(F.col("dy") == 0, F.col("line")).otherwise(at).cast("int"))
    (x0, y0), (x1, y1) = spot(first), spot(last)
    s = s.select("image_id", x0.alias("x0"), y0.alias("y0"), x1.alias("x1"), y1.alias("y1"), "dx", "dy")
    forward = (F.col("dx") + F.col("dy") > 0).cast("int")  # two sides that begin at one corner go opposite ways
    return s.withColumn("side", (place_name(F.col("image_id"), F.col("y0"), F.col("x0")) * F.lit(2).cast("decimal(1,0)") + forward).cast(NAME))


def rings(mask: DataFrame, joined: DataFrame | None = None) -> DataFrame:
    """Closed outlines of foreground that is 4-connected, and connected at the corner contacts of ``joined``: image_id, ring, seq from 0, x, y (a corner), and of the side that begins
    there x1, y1, dx, dy. The foreground is at the left hand, so holes run the other way round than outlines.

    Where two pixels touch at a corner only, a ring turns left and stays with its pixel, or right, to the other one, where
    they are joined. A ring is named by its smallest
    side, at which it begins; no ring is gathered (see ``cycles``)."""
    sides = materialize(straight_sides(boundary_edges(mask)), "sides")
    left = (F.col("n.dx") == F.col("s.dy")) & (F.col("n.dy") == -F.col("s.dx"))
    meet = sides.alias("s").join(sides.alias("n"), (F.col("s.image_id") == F.col("n.image_id")) & (F.col("s.x1") == F.col("n.x0")) & (F.col("s.y1") == F.col("n.y0")))
    after = meet.select(F.col("s.side").alias("side"), F.col("n.side").alias("next"), F.col("s.image_id").alias("image_id"), F.col("s.x1").alias("x"), F.col("s.y1").alias("y"), F.when(left, 0).otherwise(1).alias("turn"))
    if joined is not None:
        at = joined.select("image_id", "x", "y", F.lit(1).alias("joined"))
        after = after.join(at, ["image_id", "x", "y"], "left").withColumn("turn", F.col("turn").bitwiseXOR(F.coalesce("joined", F.lit(0))))
    after = after.groupBy("side").agg(F.min_by("next", "turn").alias("next"))
    now = cycles(after.select(F.col("side").alias("node"), "next")).withColumnRenamed("node", "side")
    return sides.join(now, "side").select("image_id", "ring", "seq", F.col("x0").alias("x"), F.col("y0").alias("y"), "x1", "y1", "dx", "dy")


def ring_areas(outlines: DataFrame) -> DataFrame:
    """(image_id, ring, area, px, py): pixels in each ring, negative for holes, and a pixel of the region that it bounds, the
    one to the left of the ring's first side."""
    left = lambda c, d: F.min_by(F.col(c) + d, "seq").cast("int")
    dx, dy = F.col("dx"), F.col("dy")
    return outlines.groupBy("image_id", "ring").agg((F.sum(F.col("x1").cast("long") * F.col("y") - F.col("x").cast("long") * F.col("y1")) / 2).cast("long").alias("area"), left("x", F.when((dx < 0) | (dy < 0), -1).otherwise(0)).alias("px"), left("y", F.when((dx > 0) | (dy < 0), -1).otherwise(0)).alias("py"))


def nest_rings(outlines: DataFrame) -> DataFrame:
    """(image_id, ring, hole, parent, outline) of rings: the ring right around each, null where there is none, and the outline of
    the region that it bounds, for an outline itself.

    A ring's leftmost upright side looks to the left along its row of pixels: what it meets first is the other bound of one
    piece of foreground or background, so that ring is around it, or they have the ring around them in common; chains of
    the latter kind shorten by doubling jumps. Only rows with a leftmost side are looked at, and no ring is gathered."""
    upright = outlines.filter("dx = 0").select("image_id", "ring", "x", "dy", F.least("y", "y1").alias("top"), F.greatest("y", "y1").alias("bottom"))
    upright = materialize(upright, "upright-sides")
    first = upright.groupBy("image_id", "ring").agg(F.min(F.struct("x", F.col("top").alias("row"), "dy")).alias("f"))
    # foreground to the right of the leftmost side is an outline's, to the left a hole's
    first = materialize(first.select("image_id", "ring", "f.x", "f.row", (F.col("f.dy") < 0).alias("hole")), "leftmost-sides")
    cells = upright.select("image_id", "ring", "x", F.explode(F.sequence(F.col("top"), F.col("bottom") - 1)).alias("row"))
    cells = cells.join(first.select("image_id", "row").distinct(), ["image_id", "row"], "left_semi")
    before = F.lag("ring").over(Window.partitionBy("image_id", "row").orderBy("x"))
    looked = cells.withColumn("met", before).join(first, ["image_id", "ring", "row", "x"]).select("image_id", "ring", "hole", "met")
    kinds = first.select(F.col("ring").alias("met"), F.col("hole").alias("met_hole"))
    linked = looked.join(kinds, "met", "left").select("image_id", "ring", "hole", F.col("met").alias("parent"), (F.col("met").isNotNull() & (F.col("hole") == F.col("met_hole"))).alias("beside"))
    now = materialize(linked, "ring-links")
    while now.filter("beside").limit(1).count():
        there = now.select(F.col("ring").alias("parent"), F.col("parent").alias("_up"), F.col("beside").alias("_beside"))
        jumped = now.filter("beside").join(there, "parent").select("image_id", "ring", "hole", F.col("_up").alias("parent"), F.col("_beside").alias("beside"))
        now = materialize(now.filter("NOT beside").unionByName(jumped), "ring-links")
    return now.select("image_id", "ring", "hole", "parent", F.when(F.col("hole"), F.col("parent")).otherwise(F.col("ring")).alias("outline"))


def ring_polygons(outlines: DataFrame) -> DataFrame:
    """A polygon for each outline: image_id, outline, px, py (the region's first pixel in raster order), n_pixels, n_holes, and
    rings, the outline's first and then its holes', as arrays of corners (x, y), the first repeated at the end."""
    tree = nest_rings(outlines)
    area = F.sum(F.col("x1").cast("long") * F.col("y") - F.col("x").cast("long") * F.col("y1")) / 2
    corner = F.min(F.struct("y", "x"))
    each = outlines.groupBy("image_id", "ring").agg(area.cast("long").alias("area"), corner.alias("first"), F.sort_array(F.collect_list(F.struct("seq", "x", "y"))).alias("c"))
    closed = F.transform(F.concat("c", F.slice("c", 1, 1)), lambda v: F.struct(v["x"].cast("double").alias("x"), v["y"].cast("double").alias("y")))
    each = each.join(tree, ["image_id", "ring"]).select("image_id", "outline", "area", F.struct("hole", "first", closed.alias("v")).alias("r"))
    parts = each.groupBy("image_id", "outline").agg(F.sort_array(F.collect_list("r")).alias("r"), F.sum("area").alias("n_pixels"))
    return parts.select("image_id", "outline", F.get("r", F.lit(0))["first"]["x"].alias("px"), F.get("r", F.lit(0))["first"]["y"].alias("py"), "n_pixels", (F.size("r") - 1).alias("n_holes"), F.col("r.v").alias("rings"))


def enclosed(x: np.ndarray, y: np.ndarray) -> int:
    """Pixels of a 4-connected region and of its holes: all that can't be reached from outside around it, corners included."""
    grid = np.zeros((int(y.max() - y.min()) + 3, int(x.max() - x.min()) + 3), bool)
    grid[y - y.min() + 1, x - x.min() + 1] = True
    outside = np.zeros_like(grid)
    front = np.array([[0, 0]])
    outside[0, 0] = True
    steps = np.array([(dy, dx) for dy in (-1, 0, 1) for dx in (-1, 0, 1) if dy or dx])
    while len(front):
        near = (front[:, None] + steps).reshape(-1, 2)
        near = near[((near >= 0) & (near < grid.shape)).all(1)]
        near = near[~grid[near[:, 0], near[:, 1]] & ~outside[near[:, 0], near[:, 1]]]
        front = np.unique(near, axis=0)
        outside[front[:, 0], front[:, 1]] = True
    return int((~outside).sum())


def remove_speckles(mask: DataFrame, most: int = 2) -> DataFrame:
    """Foreground without regions whose enclosed area, holes included, is at most ``most`` pixels. Regions of more pixels than
    that stay whatever they enclose; of the others, a hole needs at least 8 pixels around it, and those that may have one are
    filled, each in a task that sees no more than ``most`` pixels of it."""
    r = regions(mask)
    sizes = r.groupBy("region").agg(F.count(F.lit(1)).alias("n"))
    large = sizes.filter(F.col("n") > most).select("region")
    if most >= 8:
        fill = lambda pdf: pd.DataFrame({"region": pdf["region"].iloc[:1], "n": [enclosed(pdf["x"].to_numpy(), pdf["y"].to_numpy())]})
        ringed = r.join(sizes.filter((F.col("n") >= 8) & (F.col("n") <= most)).select("region"), "region", "left_semi").groupBy("region").applyInPandas(fill, f"region {NAME}, n long")
        large = large.unionByName(ringed.filter(F.col("n") > most).select("region"))
    return r.join(large, "region", "left_semi").select("image_id", "x", "y")


def split_paths(path: DataFrame) -> DataFrame:
    """Paths (path, seq, masked) cut at masked vertices; pieces of fewer than 3 vertices go."""
    order = Window.partitionBy("path").orderBy("seq")
    pieces = path.withColumn("piece", F.sum(F.col("masked").cast("int")).over(order)).filter(~F.col("masked"))
    n = F.count(F.lit(1)).over(Window.partitionBy("path", "piece"))
    return pieces.withColumn("_n", n).filter("_n >= 3").drop("_n", "masked")


def with_halo(pixels: DataFrame, tile: int, halo: int) -> DataFrame:
    """Pixels for each tile that they lie in or near: tile_x, tile_y; border pixels go to the neighbours too."""
    span = lambda c: F.sequence(F.floor((F.col(c) - halo) / tile).cast("int"), F.floor((F.col(c) + halo) / tile).cast("int"))
    out = pixels.withColumn("tile_x", F.explode(span("x"))).withColumn("tile_y", F.explode(span("y")))
    return out.filter("tile_x >= 0 AND tile_y >= 0")


def dense(pdf: pd.DataFrame, x0: int, y0: int, width: int, height: int) -> np.ndarray:
    """An array with NaN where a pixel is null."""
    a = np.full((height, width), np.nan)
    x, y = pdf["x"].to_numpy() - x0, pdf["y"].to_numpy() - y0
    ok = (x >= 0) & (y >= 0) & (x < width) & (y < height)
    a[y[ok], x[ok]] = pdf["v"].to_numpy(float)[ok]
    return a


def box_sum(a: np.ndarray, r: int) -> np.ndarray:
    """Sums over windows of 2r + 1 squared; the border sees zeros."""
    s = np.cumsum(np.cumsum(np.pad(a, ((r + 1, r), (r + 1, r))), 0), 1)
    n = 2 * r + 1
    return s[n:, n:] - s[:-n, n:] - s[n:, :-n] + s[:-n, :-n]


def corner_response(a: np.ndarray, method: str, r: int = 1, k: float = 0.04) -> np.ndarray:
    """Smaller eigenvalue or Harris measure of the gradient tensor; NaN where a window meets a null pixel."""
    null = np.isnan(a)
    v = np.pad(np.where(null, 0.0, a), 1, mode="edge")
    gx = (v[:-2, 2:] + 2 * v[1:-1, 2:] + v[2:, 2:] - v[:-2, :-2] - 2 * v[1:-1, :-2] - v[2:, :-2]) / 8
    gy = (v[2:, :-2] + 2 * v[2:, 1:-1] + v[2:, 2:] - v[:-2, :-2] - 2 * v[:-2, 1:-1] - v[:-2, 2:]) / 8
    xx, yy, xy = box_sum(gx * gx, r), box_sum(gy * gy, r), box_sum(gx * gy, r)
    if method == "harris":
        out = xx * yy - xy * xy - k * (xx + yy) ** 2
    elif method == "min_eigen":
        out = (xx + yy - np.sqrt((xx - yy) ** 2 + 4 * xy * xy)) / 2
    else:
        raise ValueError(f"unknown method {method}")
    out[box_sum(null.astype(float), r + 1) > 0.5] = np.nan
    return out


def pick_corners(response: np.ndarray, inner: slice, quality: float, spacing: float, most: int) -> list[tuple[int, int, float]]:
    """(x, y, response) of the strongest pixels of at least ``quality`` times the best, at least ``spacing`` apart."""
    best = np.nanmax(response) if not np.isnan(response).all() else 0.0
    if best <= 0:
        return []
    ys, xs = np.nonzero(np.nan_to_num(response[inner, inner], nan=-1.0) >= quality * best)
    values = response[inner, inner][ys, xs]
    out: list[tuple[int, int, float]] = []
    for i in np.lexsort((xs, ys, -values)):
        if all((xs[i] - x) ** 2 + (ys[i] - y) ** 2 >= spacing**2 for x, y, _ in out):
            out.append((int(xs[i]), int(ys[i]), float(values[i])))
            if len(out) == most:
                break
    return out


def detect_corners(pixels: DataFrame, tile: int = 64, most: int = 10, method: str = "min_eigen", quality: float = 0.05, spacing: float = 5.0) -> DataFrame:
    """(image_id, tile_x, tile_y, x, y, response): corners inside each tile, whose windows see a halo of its neighbours."""
    halo = 4

    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        image, tx, ty = (int(k) for k in key)
        a = dense(pdf, tx * tile - halo, ty * tile - halo, tile + 2 * halo, tile + 2 * halo)
        found = pick_corners(corner_response(a, method), slice(halo, halo + tile), quality, spacing, most)
        rows = [(image, tx, ty, tx * tile + x, ty * tile + y, r) for x, y, r in found]
        return pd.DataFrame(rows, columns=["image_id", "tile_x", "tile_y", "x", "y", "response"])

    schema = "image_id int, tile_x int, tile_y int, x int, y int, response double"
    return with_halo(pixels, tile, halo).groupBy("image_id", "tile_x", "tile_y").applyInPandas(run, schema)


def correlations(patch: np.ndarray, window: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(pixels that both have, normalised correlation) of a patch at every place in a larger window, where NaN is null."""
    views = np.lib.stride_tricks.sliding_window_view(window, patch.shape)
    both = ~np.isnan(views) & ~np.isnan(patch)
    a, b = np.where(both, patch, 0.0), np.where(both, views, 0.0)
    total = lambda z: z.sum((2, 3))
    n, sa, sb = total(both), total(a), total(b)
    va, vb = n * total(a * a) - sa * sa, n * total(b * b) - sb * sb
    with np.errstate(divide="ignore", invalid="ignore"):
        ncc = np.where((va > 0) & (vb > 0), (n * total(a * b) - sa * sb) / np.sqrt(va * vb), np.nan)
    return n, ncc


def template_matches(ref: DataFrame, cmp: DataFrame, features: DataFrame, radius: int, search: int, least: int, keys: tuple[str, ...] = (), tile: int = 64) -> DataFrame:
    """Normalised correlation of the patch around each feature (feature_id, x, y) at every offset: feature_id, dx, dy, n, ncc.

    ``keys``: columns that all three have, such as a pair of images; they come first in the result. Features and the pixels
    of both images around them meet by tile, so a pixel travels once or, at borders, up to four times, whatever the patch,
    the search and the number of features. Offsets at which fewer than ``least`` pixels are in both images, or either is
    flat, have no row."""
    keys, reach = list(keys), radius + search
    rows = lambda df, kind, name, v: df.select(*keys, F.lit(kind).alias("kind"), name.cast("long").alias("feature_id"), F.col("x").cast("int").alias("x"), F.col("y").cast("int").alias("y"), v.cast("double").alias("v"))
    none = F.lit(None)
    images = rows(ref, 0, none, F.col("v")).unionByName(rows(cmp, 1, none, F.col("v")))
    placed = with_halo(images, tile, reach).unionByName(with_halo(rows(features, 2, F.col("feature_id"), none), tile, 0))

    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        wanted = pdf[pdf["kind"] == 2].sort_values("feature_id")
        x0, y0 = int(key[-2]) * tile - reach, int(key[-1]) * tile - reach
        side = tile + 2 * reach
        a, b = (dense(pdf[pdf["kind"] == k], x0, y0, side, side) for k in (0, 1)) if len(wanted) else (None, None)
        dy, dx = np.mgrid[-search : search + 1, -search : search + 1]
        parts = []
        for f, x, y in zip(wanted["feature_id"], wanted["x"] - x0, wanted["y"] - y0, strict=True):
            around = lambda z, r: z[y - r : y + r + 1, x - r : x + r + 1]  # noqa: B023, E731
            n, ncc = correlations(around(a, radius), around(b, reach))
            ok = (n >= least) & ~np.isnan(ncc)
            parts.append(pd.DataFrame({"feature_id": f, "dx": dx[ok], "dy": dy[ok], "n": n[ok], "ncc": ncc[ok]}))
        found = pd.concat(parts) if parts else pd.DataFrame({c: [] for c in ("feature_id", "dx", "dy", "n", "ncc")})
        for i, c in enumerate(keys):
            found.insert(i, c, key[i])
        return found

    kinds = "".join(f"{c} {ref.schema[c].dataType.simpleString()}, " for c in keys)
    return placed.groupBy(*keys, "tile_x", "tile_y").applyInPandas(run, f"{kinds}feature_id long, dx int, dy int, n long, ncc double")


def window_sums(a: np.ndarray, r: int) -> np.ndarray:
    """Sums over the windows of 2r + 1 squared that lie inside, from a summed-area table."""
    s = np.zeros((a.shape[0] + 1, a.shape[1] + 1))
    np.cumsum(np.cumsum(a, 0), 1, out=s[1:, 1:])
    n = 2 * r + 1
    return s[n:, n:] - s[:-n, n:] - s[n:, :-n] + s[:-n, :-n]


def dense_correlations(a: np.ndarray, b: np.ndarray, radius: int, search: int) -> tuple[np.ndarray, np.ndarray]:
    """(pixels that both have, normalised correlation) of the patch around every inner pixel of ``a`` at every offset into
    ``b``: arrays offset (dy, then dx), y, x. Both arrays reach radius + search beyond the inner pixels; NaN is null."""
    middle = np.round(np.nanmean(a)) if not np.isnan(a).all() else 0.0  # correlation doesn't change, sums stay small
    have_a, have_b = ~np.isnan(a), ~np.isnan(b)
    va, vb = np.where(have_a, a - middle, 0.0), np.where(have_b, b - middle, 0.0)
    inner = slice(search, a.shape[0] - search)
    n_all, ncc_all = [], []
    for dy in range(-search, search + 1):
        for dx in range(-search, search + 1):
            at = slice(search + dy, a.shape[0] - search + dy), slice(search + dx, a.shape[1] - search + dx)
            both = have_a[inner, inner] & have_b[at]
            x, y = va[inner, inner] * both, vb[at] * both
            n, sx, sy, sxx, syy, sxy = (window_sums(z, radius) for z in (both.astype(float), x, y, x * x, y * y, x * y))
            px, py = n * sxx - sx * sx, n * syy - sy * sy
            ok = (px > 1e-9 * n * sxx) & (py > 1e-9 * n * syy)  # what rounding leaves of a flat patch isn't a slope
            with np.errstate(divide="ignore", invalid="ignore"):
                ncc_all.append(np.where(ok, (n * sxy - sx * sy) / np.sqrt(px * py), np.nan))
            n_all.append(n)
    return np.round(np.stack(n_all)).astype(np.int64), np.stack(ncc_all)


def dense_matches(ref: DataFrame, cmp: DataFrame, tiles: DataFrame, radius: int, search: int, least: int, keys: tuple[str, ...] = (), most: int | None = None, tile: int = 64) -> DataFrame:
    """Correlation of the patch around every pixel of search tiles (x, y, w, h) at every offset, or at the ``most`` best ones
    (ties: smallest dy, then dx): x, y, dx, dy, n, ncc, as ``template_matches`` gives for ``raster_steps`` of 1.

    Tiles of a pair don't overlap. A pixel travels as there; in a task all patches are correlated at once, an offset at a
    time, from summed-area tables, so the work doesn't grow with the size of the patch."""
    keys, reach = list(keys), radius + search
    number = lambda v, kind="int": v.cast(kind)
    none = F.lit(None)
    rows = lambda df, kind, v, w, h: df.select(*keys, F.lit(kind).alias("kind"), number(F.col("x")).alias("x"), number(F.col("y")).alias("y"), number(v, "double").alias("v"), number(w).alias("w"), number(h).alias("h"))
    placed = with_halo(rows(ref, 0, F.col("v"), none, none).unionByName(rows(cmp, 1, F.col("v"), none, none)), tile, reach)
    span = lambda at, size: F.explode(F.sequence(F.floor(F.col(at) / tile).cast("int"), F.floor((F.col(at) + F.col(size) - 1) / tile).cast("int")))
    wanted = rows(tiles.filter("w > 0 AND h > 0"), 2, none, F.col("w"), F.col("h")).withColumn("tile_x", span("x", "w")).withColumn("tile_y", span("y", "h"))
    names = ["x", "y", "dx", "dy", "n", "ncc"]

    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        x0, y0 = int(key[-2]) * tile, int(key[-1]) * tile
        asked = np.zeros((tile, tile), bool)
        for r in pdf[pdf["kind"] == 2].itertuples():
            asked[max(0, r.y - y0) : max(0, int(r.y + r.h) - y0), max(0, r.x - x0) : max(0, int(r.x + r.w) - x0)] = True
        found = pd.DataFrame({c: [] for c in names})
        if asked.any():
            side = tile + 2 * reach
            n, ncc = dense_correlations(*(dense(pdf[pdf["kind"] == k], x0 - reach, y0 - reach, side, side) for k in (0, 1)), radius, search)
            ok = (n >= least) & ~np.isnan(ncc) & asked
            order = np.argsort(np.where(ok, -ncc, np.inf), axis=0, kind="stable")[:most]
            good = np.take_along_axis(ok, order, 0)
            _, y, x = np.nonzero(good)
            at = order[good]
            dy, dx = at // (2 * search + 1) - search, at % (2 * search + 1) - search
            found = pd.DataFrame({"x": x + x0, "y": y + y0, "dx": dx, "dy": dy, "n": n[at, y, x], "ncc": ncc[at, y, x]})
        for i, c in enumerate(keys):
            found.insert(i, c, key[i])
        return found

    kinds = "".join(f"{c} {ref.schema[c].dataType.simpleString()}, " for c in keys)
    return placed.unionByName(wanted).groupBy(*keys, "tile_x", "tile_y").applyInPandas(run, f"{kinds}x int, y int, dx int, dy int, n long, ncc double")


def fourier(pixels: DataFrame, width: int, height: int, inverse: bool = False) -> DataFrame:
    """(image_id, x, y, re, im): the 2-D transform, rows first, then columns; forward over width * height, inverse unscaled.
    Null pixels count as 0. Input: re and im, or v."""
    z = pixels if "re" in pixels.columns else pixels.select("image_id", "x", "y", F.col("v").cast("double").alias("re"), F.lit(0.0).alias("im"))

    def along(axis: str, other: str, n: int) -> Callable[[tuple, pd.DataFrame], pd.DataFrame]:
        def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
            line = np.zeros(n, complex)
            line[pdf[axis].to_numpy()] = pdf["re"].to_numpy() + 1j * pdf["im"].to_numpy()
            f = np.fft.ifft(line) * n if inverse else np.fft.fft(line) / n
            return pd.DataFrame({"image_id": int(key[0]), axis: np.arange(n), other: int(key[1]), "re": f.real, "im": f.imag})[["image_id", "x", "y", "re", "im"]]

        return run

    schema = "image_id int, x int, y int, re double, im double"
    rows = z.groupBy("image_id", "y").applyInPandas(along("x", "y", width), schema)
    return rows.groupBy("image_id", "x").applyInPandas(along("y", "x", height), schema)


#: Detectors by name, as functions of pixels; users add their own.
DETECTORS: dict[str, Callable[..., DataFrame]] = {
    "min_eigen": lambda pixels, **options: detect_corners(pixels, method="min_eigen", **options),
    "harris": lambda pixels, **options: detect_corners(pixels, method="harris", **options),
}


def register_detector(name: str, detector: Callable[..., DataFrame]) -> None:
    DETECTORS[name] = detector


def detect(pixels: DataFrame, name: str, **options) -> DataFrame:
    if name not in DETECTORS:
        raise ValueError(f"unknown detector {name}; there are {sorted(DETECTORS)}")
    return DETECTORS[name](pixels, **options)


def patch_descriptors(pixels: DataFrame, features: DataFrame, radius: int = 3) -> DataFrame:
    """(image_id, x, y, embedding): the pixels around each feature, less their mean, in raster order; null pixels are 0."""
    side = F.sequence(F.lit(-radius), F.lit(radius))
    around = features.select("image_id", F.col("x").alias("fx"), F.col("y").alias("fy")).withColumn("dy", F.explode(side)).withColumn("dx", F.explode(side))
    around = around.withColumns({"x": F.col("fx") + F.col("dx"), "y": F.col("fy") + F.col("dy")}).join(pixels, ["image_id", "x", "y"], "left")
    lists = around.groupBy("image_id", "fx", "fy").agg(F.avg("v").alias("m"), F.sort_array(F.collect_list(F.struct("dy", "dx", "v"))).alias("p"))
    return lists.select("image_id", F.col("fx").alias("x"), F.col("fy").alias("y"), F.transform("p", lambda s: F.coalesce(s["v"] - F.col("m"), F.lit(0.0)).cast("float")).alias("embedding"))


def census_descriptors(pixels: DataFrame, features: DataFrame, radius: int = 3) -> DataFrame:
    """(image_id, x, y, embedding): a bit for each pixel around a feature, in raster order, that is brighter than the mean of
    them, eight to a number from 0 to 255; null pixels give 0. For matchers that count differing bits."""
    p, n = patch_descriptors(pixels, features, radius), (2 * radius + 1) ** 2
    byte = lambda at: sum((F.when(F.get("embedding", F.lit(at + i)) > 0, 1 << i).otherwise(0) for i in range(min(8, n - at))), F.lit(0))
    return p.select("image_id", "x", "y", F.array(*[byte(at).cast("int") for at in range(0, n, 8)]).alias("embedding"))


#: Descriptors by name, as functions of pixels and features; users add their own.
DESCRIPTORS: dict[str, Callable[..., DataFrame]] = {"patch": patch_descriptors, "census": census_descriptors}


def register_descriptor(name: str, descriptor: Callable[..., DataFrame]) -> None:
    DESCRIPTORS[name] = descriptor


def describe(pixels: DataFrame, features: DataFrame, name: str, **options) -> DataFrame:
    if name not in DESCRIPTORS:
        raise ValueError(f"unknown descriptor {name}; there are {sorted(DESCRIPTORS)}")
    return DESCRIPTORS[name](pixels, features, **options)


def pixel_number(x: Column, y: Column) -> Column:
    """A number for a pixel of an image; pixels are at 31-bit positions, so x is its upper part and y its lower one."""
    return F.shiftleft(x.cast("long"), 31).bitwiseOR(y.cast("long"))


def pixel_of(number: Column) -> tuple[Column, Column]:
    return F.shiftright(number, 31).cast("int"), number.bitwiseAND(F.lit((1 << 31) - 1)).cast("int")


def raster_steps(tiles: DataFrame, step: int = 1) -> DataFrame:
    """Every ``step``-th pixel of each search tile (x, y, w, h), from its upper left corner, as a feature to correlate where
    no detector is asked: the other columns of ``tiles``, feature_id (see ``pixel_number``), x, y."""
    along = lambda at, length: F.explode(F.sequence(F.col(at), F.col(at) + F.col(length) - 1, F.lit(step)))
    keep = [c for c in tiles.columns if c not in ("x", "y", "w", "h")]
    at = tiles.filter("w > 0 AND h > 0").withColumn("px", along("x", "w")).withColumn("py", along("y", "h"))
    return at.select(*keep, pixel_number(F.col("px"), F.col("py")).alias("feature_id"), F.col("px").cast("int").alias("x"), F.col("py").cast("int").alias("y"))
