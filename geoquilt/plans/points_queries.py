"""Queries on point clouds."""

from __future__ import annotations

from pyspark.sql import functions as F

from geoquilt.operators import points as pc
from geoquilt.plans.catalog import query
from geoquilt.sources.shared import new_path

FIELDS = ["x", "y", "z", "intensity", "return_number"]


def coloured(t):
    return t.points.withColumns({"red": F.col("intensity"), "green": F.col("return_number"), "blue": F.col("intensity") % 7})


@query("r7_scan_points", "SELECT point_id, x, y, z, intensity FROM points WHERE point_id >= 1000 AND point_id < 9000")
def r7(t):
    return pc.scan_points(t.points, ["intensity", "gps_time"], 1000, 8000)


@query("r8_points_in_bounds", "SELECT point_id FROM points WHERE x BETWEEN 10 AND 40 AND y BETWEEN 20 AND 70")
def r8(t):
    return pc.in_bounds(t.points, 10, 20, 40, 70).select("point_id")


@query("r9_dimension_summary", " UNION ALL ".join(f"SELECT '{c}' AS name, CAST(min({c}) AS DOUBLE) AS minimum, CAST(max({c}) AS DOUBLE) AS maximum FROM points" for c in FIELDS))
def r9(t):
    return pc.dimension_summary(t.points, FIELDS)


@query("a2_point_ranges", "SELECT min(z) AS min_z, max(z) AS max_z, CAST(least(min(intensity), min(return_number), min(intensity % 7)) AS DOUBLE) AS min_rgb, CAST(greatest(max(intensity), max(return_number), max(intensity % 7)) AS DOUBLE) AS max_rgb FROM points")
def a2(t):
    return pc.ranges(coloured(t), ["z", "red", "green", "blue"])


@query("s13_normalise_points", """WITH s AS (SELECT min(intensity) AS a, max(intensity) AS b, least(min(intensity), min(return_number), min(intensity % 7)) AS c, greatest(max(intensity), max(return_number), max(intensity % 7)) AS d FROM points)
SELECT point_id, round((intensity - a) / (b - a), 9) AS intensity, round((intensity - c) / (d - c), 9) AS red, round((return_number - c) / (d - c), 9) AS green FROM points, s""")
def s13(t):
    return pc.normalise(coloured(t), ["intensity", "red", "green", "blue"]).select("point_id", *[F.round(c, 9).alias(c) for c in ("intensity", "red", "green")])


@query("a11_rasterise_last", "SELECT CAST(trunc(x/2) AS INT) AS cx, CAST(trunc(y/2) AS INT) AS cy, arg_max(z, point_id) AS z FROM points GROUP BY 1, 2")
def a11_last(t):
    return pc.rasterise(t.points, 0, 0, 2.0, "last")


@query("a11_rasterise_highest", "SELECT CAST(trunc(x/2) AS INT) AS cx, CAST(trunc(y/2) AS INT) AS cy, max(z) AS z FROM points GROUP BY 1, 2")
def a11_highest(t):
    return pc.rasterise(t.points, 0, 0, 2.0, "highest")


@query("a12_natural_cell", """WITH s AS (SELECT count(*) AS n, min(x) AS x0, max(x) AS x1, min(y) AS y0, max(y) AS y1 FROM points), c AS (SELECT *, (x1-x0)*(y1-y0) AS area, sqrt(1.0/(n/((x1-x0)*(y1-y0)))) AS cell FROM s)
SELECT n, round(area, 9) AS area, round(cell, 9) AS cell, CAST(trunc((x1-x0)/cell + 0.5) AS INT) AS samples, CAST(trunc((y1-y0)/cell + 0.5) AS INT) AS lines FROM c""")
def a12(t):
    return pc.natural_cell(t.points).withColumns({"area": F.round("area", 9), "cell": F.round("cell", 9)})


@query("a13_thin", "SELECT point_id FROM points WHERE point_id % 4 = 0")
def a13(t):
    return pc.thin(t.points, 2).select("point_id")


@query("w7_point_ids", "SELECT point_id, row_number() OVER (ORDER BY point_id) - 1 AS id FROM points")
def w7(t):
    return pc.with_ids(t.points.select("point_id"), ["point_id"])


@query("r8_clustered", "SELECT point_id, x, y, z FROM points WHERE x BETWEEN 10 AND 40 AND y BETWEEN 20 AND 70")
def r8_clustered(t):
    """Points of a rectangle, out of a table that is written in a space-filling order."""
    path = new_path(t.spark, "clustered")
    pc.write_clustered(t.points, path)
    return pc.clustered_in_bounds(t.spark, path, 10, 20, 40, 70).select("point_id", "x", "y", "z")


def voids_sql(levels: int = 9) -> str:
    """Rows of fill_all_voids of the test points: means up over more levels than are needed, then down again."""
    up = ["k0 AS MATERIALIZED (SELECT CAST(trunc(x/0.25) AS INT) AS cx, CAST(trunc(y/0.25) AS INT) AS cy, max(z) AS z FROM points GROUP BY 1, 2)", "e AS (SELECT min(cx) AS x0, max(cx) AS x1, min(cy) AS y0, max(cy) AS y1 FROM k0)"]
    up += [f"k{k} AS MATERIALIZED (SELECT cx >> 1 AS cx, cy >> 1 AS cy, avg(z) AS z FROM k{k - 1} GROUP BY 1, 2)" for k in range(1, levels + 1)]
    down = [f"f{levels} AS (SELECT cx, cy, z, false AS filled FROM k{levels})"]
    for k in range(levels - 1, -1, -1):
        down.append(f"""f{k} AS MATERIALIZED (SELECT cx, cy, coalesce(max(own), sum(wz)/sum(w)) AS z, max(own) IS NULL AS filled FROM (
SELECT cx*2 + d.a AS cx, cy*2 + g.a AS cy, z*d.w*g.w AS wz, d.w*g.w AS w, CAST(NULL AS DOUBLE) AS own FROM f{k + 1}, wts d, wts g UNION ALL SELECT cx, cy, NULL, NULL, z FROM k{k}) q, e
WHERE cx BETWEEN x0 >> {k} AND x1 >> {k} AND cy BETWEEN y0 >> {k} AND y1 >> {k} GROUP BY 1, 2)""")
    wts = "wts(a, w) AS (VALUES (-1, CAST(1 AS DOUBLE)), (0, 3), (1, 3), (2, 1))"
    return f"WITH {', '.join([wts, *up, *down])} SELECT CAST(cx AS INT) AS cx, CAST(cy AS INT) AS cy, round(z + 0.00000001, 6) AS z, filled FROM f0"


@query("p5_filled_voids", voids_sql())
def p5_voids(t):
    """A raster of the points in which three cells of four are void, with all voids filled."""
    return pc.fill_all_voids(pc.rasterise(t.points, 0.0, 0.0, 0.25, "highest")).withColumn("z", F.round(F.col("z") + 0.00000001, 6))  # a hair, as many means end in a five
