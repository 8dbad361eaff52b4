"""Point clouds: statistics, gridding, thinning and scaling."""

from __future__ import annotations

import json
import math
from dataclasses import astuple, dataclass, fields

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from geoquilt.sources.shared import materialize

COLOURS = ("red", "green", "blue")


def scan_points(points: DataFrame, fields: list[str], offset: int | None = None, count: int | None = None) -> DataFrame:
    """Position and the fields that are asked for and there; a block by running point_id. Other columns are never read."""
    out = points.select("point_id", "x", "y", "z", *[f for f in fields if f in points.columns and f not in ("point_id", "x", "y", "z")])
    if offset is not None:
        out = out.filter(F.col("point_id") >= offset)
    if count is not None:
        out = out.filter(F.col("point_id") < (offset or 0) + count)
    return out


def available_fields(points: DataFrame, known: list[str]) -> int:
    """Bit mask of the known fields that a table has."""
    return sum(1 << i for i, f in enumerate(known) if f in points.columns)


def in_bounds(points: DataFrame, min_x: float, min_y: float, max_x: float, max_y: float) -> DataFrame:
    return points.filter((F.col("x") >= min_x) & (F.col("x") <= max_x) & (F.col("y") >= min_y) & (F.col("y") <= max_y))


@dataclass(frozen=True)
class Layout:
    """A space-filling order of places in an extent: keys interleave ``bits`` bits of x and of y, leading bits make zones."""

    min_x: float
    min_y: float
    max_x: float
    max_y: float
    bits: int = 20
    zone_bits: int = 3

    def step(self, c: Column | float, axis: str):
        """The cell of a coordinate along an axis, 0 to 2 ** bits - 1; what lies beyond the extent is in the outer cell."""
        lo, hi, n = getattr(self, f"min_{axis}"), getattr(self, f"max_{axis}"), 1 << self.bits
        width = (hi - lo) or 1.0
        if isinstance(c, Column):
            return F.least(F.lit(n - 1), F.greatest(F.lit(0), F.floor((c - lo) / width * n))).cast("long")
        return min(n - 1, max(0, math.floor((c - lo) / width * n)))

    def key(self, x: Column, y: Column) -> Column:
        """The Morton key: bit 2i is bit i of x, bit 2i + 1 that of y."""

        def apart(v: Column) -> Column:
            for shift, mask in ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333), (1, 0x5555555555555555)):
                v = v.bitwiseOR(F.shiftleft(v, shift)).bitwiseAND(F.lit(mask))
            return v

        return apart(self.step(x, "x")).bitwiseOR(F.shiftleft(apart(self.step(y, "y")), 1))

    def key_ranges(self, min_x: float, min_y: float, max_x: float, max_y: float, most: int = 32) -> list[tuple[int, int]]:
        """At most ``most`` ranges of keys (ends included) that hold every place of a rectangle, and few others: squares that the
        rectangle cuts are halved as long as there are few enough ranges."""
        want = (self.step(min_x, "x"), self.step(max_x, "x"), self.step(min_y, "y"), self.step(max_y, "y"))
        if want[0] > want[1] or want[2] > want[3]:
            return []
        ranges, open_squares = [], [(0, 0, 0)]  # level, x, y
        for level in range(self.bits + 1):
            nearer = []
            for _, x, y in open_squares:
                size = 1 << (self.bits - level)
                if x * size > want[1] or (x + 1) * size - 1 < want[0] or y * size > want[3] or (y + 1) * size - 1 < want[2]:
                    continue
                first = sum(((x >> i & 1) << 2 * i) | ((y >> i & 1) << 2 * i + 1) for i in range(level)) * size * size
                inside = x * size >= want[0] and (x + 1) * size - 1 <= want[1] and y * size >= want[2] and (y + 1) * size - 1 <= want[3]
                (ranges if inside else nearer).append((first, first + size * size - 1, x, y))
            if level == self.bits or not nearer or len(ranges) + 4 * len(nearer) > most:
                break
            open_squares = [(level + 1, 2 * x + dx, 2 * y + dy) for _, _, x, y in nearer for dy in (0, 1) for dx in (0, 1)]
        merged: list[tuple[int, int]] = []
        for first, last, *_ in sorted(ranges + nearer):
            if merged and first <= merged[-1][1] + 1:
                merged[-1] = (merged[-1][0], max(last, merged[-1][1]))
            else:
                merged.append((first, last))
        return merged


def write_clustered(points: DataFrame, path: str, bits: int = 20, zone_bits: int = 3) -> Layout:
    """Write points in a space-filling order: folders by zone, files and row groups by ranges of keys. Returns the layout, which
    is stored beside them.

    Ranges come from a sample; points of one place are cut by their other columns, so no place is too large for a task."""
    spark = points.sparkSession
    e = points.agg(*[f(c).cast("double").alias(f"{n}_{c}") for c in "xy" for n, f in (("min", F.min), ("max", F.max))]).first()
    none = e.min_x is None
    layout = Layout(*([0.0, 0.0, 1.0, 1.0] if none else [e.min_x, e.min_y, e.max_x, e.max_y]), bits, zone_bits)
    keyed = points.withColumn("key", layout.key(F.col("x"), F.col("y"))).withColumn("zone", F.shiftright("key", 2 * (bits - zone_bits)).cast("int"))
    order = ["zone", "key", "x", "y", *[c for c in ("point_id",) if c in points.columns]]
    keyed.repartitionByRange(*order).sortWithinPartitions(*order).write.partitionBy("zone").parquet(path)
    kinds = ", ".join(f"{f.name} {'int' if f.name.endswith('bits') else 'double'}" for f in fields(Layout))
    spark.createDataFrame([(*astuple(layout), keyed.schema.json())], f"{kinds}, table_schema string").coalesce(1).write.parquet(f"{path}/_layout")
    return layout


def clustered_in_bounds(spark: SparkSession, path: str, min_x: float, min_y: float, max_x: float, max_y: float) -> DataFrame:
    """Points of a clustered table in a rectangle, its border included: zones choose folders, key ranges are pushed down to the
    row groups of the files, and the coordinates decide."""
    *values, schema = spark.read.parquet(f"{path}/_layout").first()
    layout = Layout(*values)
    found = layout.key_ranges(min_x, min_y, max_x, max_y)
    zones = sorted({z for a, b in found for z in range(a >> 2 * (layout.bits - layout.zone_bits), (b >> 2 * (layout.bits - layout.zone_bits)) + 1)})
    keys = F.lit(False)
    for a, b in found:
        keys = keys | F.col("key").between(a, b)
    table = spark.read.schema(T.StructType.fromJson(json.loads(schema))).parquet(path)
    return in_bounds(table.filter(F.col("zone").isin(zones) & keys), min_x, min_y, max_x, max_y).drop("key", "zone")


def ranges(points: DataFrame, fields: list[str]) -> DataFrame:
    """One row with min_ and max_ of each field; the colours share one range."""
    rgb = [c for c in COLOURS if c in fields]
    own = [f for f in fields if f not in rgb]
    aggs = [f(c).cast("double").alias(f"{n}_{c}") for c in own for n, f in (("min", F.min), ("max", F.max))]
    if rgb:
        both = lambda f, of: of(*[f(c) for c in rgb]) if len(rgb) > 1 else f(rgb[0])
        aggs += [both(F.min, F.least).cast("double").alias("min_rgb"), both(F.max, F.greatest).cast("double").alias("max_rgb")]
    return points.agg(*aggs)


def dimension_summary(points: DataFrame, fields: list[str]) -> DataFrame:
    """(name, minimum, maximum) of each field, from one pass."""
    r = ranges(points, fields)
    names = sorted({c[4:] for c in r.columns})
    return r.select(F.expr("stack(" + str(len(names)) + ", " + ", ".join(f"'{n}', min_{n}, max_{n}" for n in names) + ") AS (name, minimum, maximum)"))


def normalise(points: DataFrame, fields: list[str]) -> DataFrame:
    """Fields scaled to 0..1 by their range, colours by the shared one; a range of no width gives 0."""
    r = ranges(points, fields)

    def scaled(c: str) -> Column:
        n = "rgb" if c in COLOURS else c
        width = F.col(f"max_{n}") - F.col(f"min_{n}")
        return F.when(width > 0, (F.col(c) - F.col(f"min_{n}")) / width).otherwise(F.lit(0.0))

    return points.join(F.broadcast(r)).withColumns({c: scaled(c) for c in fields}).select(*points.columns)


def rasterise(points: DataFrame, x0: float, y0: float, cell: float, rule: str) -> DataFrame:
    """(cx, cy, z) of each cell that has points: the last one's height, or the highest. Other cells are absent."""
    how = {"last": F.max_by("z", "point_id"), "highest": F.max("z")}[rule]
    at = lambda c, o: ((F.col(c) - o) / cell).cast("int")
    return points.filter((F.col("x") >= x0) & (F.col("y") >= y0)).groupBy(at("x", x0).alias("cx"), at("y", y0).alias("cy")).agg(how.alias("z"))


def fill_voids(cells: DataFrame) -> DataFrame:
    """(cx, cy, z, filled) with absent cells that touch at least two present ones added, at the mean height of these."""
    near = F.array(*[F.struct(F.lit(dx).alias("dx"), F.lit(dy).alias("dy")) for dx in (-1, 0, 1) for dy in (-1, 0, 1)])
    sent = cells.select("cx", "cy", "z", F.explode(near).alias("d")).select((F.col("cx") + F.col("d.dx")).alias("cx"), (F.col("cy") + F.col("d.dy")).alias("cy"), "z", ((F.col("d.dx") == 0) & (F.col("d.dy") == 0)).alias("own"))
    inside = F.col("_z").isNotNull() | (F.col("_n") > 1)
    met = sent.groupBy("cx", "cy").agg(F.max(F.when(F.col("own"), F.col("z"))).alias("_z"), F.avg("z").alias("_mean"), F.count(F.lit(1)).alias("_n"))
    return met.filter(inside).select("cx", "cy", F.coalesce("_z", "_mean").alias("z"), F.col("_z").isNull().alias("filled"))


def fill_all_voids(cells: DataFrame) -> DataFrame:
    """(cx, cy, z, filled) of every cell of the extent: absent ones are filled from coarser levels, however large the void.

    Push: levels halve, a cell being the mean of the present ones of its four, until a level has no void (three levels share
    an exchange by block). Pull: from there down, an absent cell is interpolated between the four nearest cells of the level
    above, of those that are inside the extent (weights 9, 3, 3, 1). Present cells stay as they are. Each level going down is
    one exchange; coarse levels are small. No cells give none."""
    e = cells.agg(*[f(c).alias(f"{n}_{c}") for n, f in (("lo", F.min), ("hi", F.max)) for c in ("cx", "cy")]).first()
    if e.lo_cx is None:
        return cells.select("cx", "cy", "z", F.lit(False).alias("filled"))
    bounds = lambda k: (e.lo_cx >> k, e.hi_cx >> k, e.lo_cy >> k, e.hi_cy >> k)
    whole = lambda k: (bounds(k)[1] - bounds(k)[0] + 1) * (bounds(k)[3] - bounds(k)[2] + 1)
    half = lambda c: F.shiftright(c, 1).alias(c)
    known, together = [materialize(cells.select("cx", "cy", F.col("z").cast("double").alias("z")), "cells")], 3
    while known[-1].count() < whole(len(known) - 1):
        now = known[-1].select("cx", "cy", "z", F.shiftright("cx", together).alias("bx"), F.shiftright("cy", together).alias("by")).repartition("bx", "by")
        for _ in range(together):
            now = now.groupBy("bx", "by", half("cx"), half("cy")).agg(F.avg("z").alias("z"))
            known.append(now.select("cx", "cy", "z"))
        known[-1] = materialize(known[-1], "coarse-cells")
    none = F.lit(None).cast("double")
    around = F.array(*[F.struct(F.lit(dx).alias("dx"), F.lit(dy).alias("dy"), F.lit(float((3 if dx in (0, 1) else 1) * (3 if dy in (0, 1) else 1))).alias("w")) for dx in range(-1, 3) for dy in range(-1, 3)])
    full = next(k for k in range(len(known)) if known[k].count() == whole(k))
    out = known[full].select("cx", "cy", "z", F.lit(False).alias("filled"))
    for k in range(full - 1, -1, -1):
        x0, x1, y0, y1 = bounds(k)
        sent = out.select("z", "cx", "cy", F.explode(around).alias("a")).select((F.col("cx") * 2 + F.col("a.dx")).alias("cx"), (F.col("cy") * 2 + F.col("a.dy")).alias("cy"), (F.col("z") * F.col("a.w")).alias("wz"), F.col("a.w").alias("w"), none.alias("own"))
        sent = sent.filter(F.col("cx").between(x0, x1) & F.col("cy").between(y0, y1))
        met = sent.unionByName(known[k].select("cx", "cy", none.alias("wz"), none.alias("w"), F.col("z").alias("own"))).groupBy("cx", "cy")
        met = met.agg(F.max("own").alias("own"), (F.sum("wz") / F.sum("w")).alias("between"))
        out = materialize(met.select("cx", "cy", F.coalesce("own", "between").alias("z"), F.col("own").isNull().alias("filled")), "filled-cells")
    return out


def natural_cell(points: DataFrame) -> DataFrame:
    """Number of points, area, the cell size at which a cell holds one point, and the raster's size at it."""
    s = points.agg(F.count(F.lit(1)).alias("n"), F.min("x").alias("x0"), F.max("x").alias("x1"), F.min("y").alias("y0"), F.max("y").alias("y1"))
    s = s.withColumn("area", (F.col("x1") - F.col("x0")) * (F.col("y1") - F.col("y0"))).withColumn("cell", F.sqrt(F.lit(1.0) / (F.col("n") / F.col("area"))))
    return s.select("n", "area", "cell", ((F.col("x1") - F.col("x0")) / F.col("cell") + 0.5).cast("int").alias("samples"), ((F.col("y1") - F.col("y0")) / F.col("cell") + 0.5).cast("int").alias("lines"))


def thin(points: DataFrame, level: int) -> DataFrame:
    """One of 2 ** level points, by id, so levels are nested and repeatable."""
    return points.filter(F.col("point_id") % (1 << level) == 0)


def with_ids(points: DataFrame, order: list[str], name: str = "id", rows_per_range: int = 250_000) -> DataFrame:
    """Running ids from 0 in the given order, without gathering all rows: the order is cut into ranges, each is numbered
    on its own, and the rows of the ranges before it are added. ``order`` should be a key. The ranges come from a sample, so
    they are written once, and counting and numbering see the same. The number of ranges follows the counted rows."""
    buckets = max(8, math.ceil(points.count() / rows_per_range))
    ranged = materialize(points.repartitionByRange(buckets, *order).withColumn("_p", F.spark_partition_id()), "ranges")
    counts = ranged.groupBy("_p").agg(F.count(F.lit(1)).alias("_n"))
    starts = counts.withColumn("_start", F.sum("_n").over(Window.orderBy("_p")) - F.col("_n")).select("_p", "_start")
    own = F.row_number().over(Window.partitionBy("_p").orderBy(*order)) - 1
    return ranged.withColumn("_own", own).join(F.broadcast(starts), "_p").withColumn(name, F.col("_start") + F.col("_own")).drop("_p", "_own", "_start")
