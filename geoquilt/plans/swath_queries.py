"""Queries on swath grids."""

from __future__ import annotations

from pyspark.sql import functions as F

from geoquilt.operators import swath
from geoquilt.plans.catalog import query


@query("w5_extrapolate_edges", """WITH e AS (SELECT gx, gy, lat, CASE WHEN lon < 0 THEN lon + 360 ELSE lon END AS e FROM swath_grid), m AS (SELECT gy, max(gx) AS m FROM e GROUP BY gy),
c AS (SELECT a.gx + 1 AS gx, a.gy, 2*a.lat - b.lat AS lat, 2*a.e - b.e AS e FROM m JOIN e a ON a.gy = m.gy AND a.gx = m.m JOIN e b ON b.gy = m.gy AND b.gx = m.m - 1), x AS (SELECT * FROM e UNION ALL SELECT * FROM c),
n AS (SELECT gx, max(gy) AS m FROM x GROUP BY gx), r AS (SELECT a.gx, a.gy + 1 AS gy, 2*a.lat - b.lat AS lat, 2*a.e - b.e AS e FROM n JOIN x a ON a.gx = n.gx AND a.gy = n.m JOIN x b ON b.gx = n.gx AND b.gy = n.m - 1)
SELECT gx, gy, round(lat, 9) AS lat, round(CASE WHEN e > 180 THEN e - 360 ELSE e END, 9) AS lon FROM (SELECT * FROM x UNION ALL SELECT * FROM r)""")
def w5(t):
    return swath.extrapolate_edges(t.swath_grid).select("gx", "gy", F.round("lat", 9).alias("lat"), F.round("lon", 9).alias("lon"))


@query("w6_crosses_dateline", "SELECT gy, regexp_matches(string_agg(CASE trunc(lon) WHEN 179 THEN 'a' WHEN 178 THEN 'b' WHEN -179 THEN 'c' WHEN -178 THEN 'd' ELSE 'x' END, '' ORDER BY gx), '^[^ac]*(a[^bc]*c|c[^ad]*a)') AS crosses FROM swath_grid GROUP BY gy")
def w6(t):
    return swath.crosses_dateline(t.swath_grid, "gy", "gx")


@query("a15_footprint_wkt", """WITH s AS (SELECT max(gx) AS w, max(gy) AS h FROM swath_grid), g AS (SELECT *, round(lon, 8)::VARCHAR || ' ' || round(lat, 8)::VARCHAR AS p FROM swath_grid, s),
k AS (SELECT 0 AS side, gx AS i, p FROM g WHERE gy = 0 AND (gx % 8 = 0 OR gx = w) UNION ALL SELECT 1, gy, p FROM g WHERE gx = w AND gy > 0 AND (gy % 8 = 0 OR gy = h) UNION ALL SELECT 2, w - gx, p FROM g WHERE gy = h AND gx < w AND ((w - gx) % 8 = 0 OR gx = 0) UNION ALL SELECT 3, h - gy, p FROM g WHERE gx = 0 AND gy < h AND ((h - gy) % 8 = 0 OR gy = 0))
SELECT 'MULTIPOLYGON(((' || string_agg(p, ',' ORDER BY side, i) || ')))' AS wkt FROM k""")
def a15(t):
    return swath.footprint_wkt(t.swath_grid, 8)
