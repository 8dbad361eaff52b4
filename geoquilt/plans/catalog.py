"""Named queries, the inputs that they derive from the tables, and their SQL in DuckDB.

An input is SQL that both engines run unchanged; a query gets it as a DataFrame, its SQL as a common table expression.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

TABLES = tuple("region nation customer supplier part orders lineitem events embeddings".split())

INPUTS = {
    # banded tiles with null holes (absent pixels)
    "pixels": "SELECT CAST(l_suppkey % 2 AS INT) AS image_id, CAST(l_orderkey % 256 AS INT) AS x, CAST(l_partkey % 256 AS INT) AS y, CAST(max(l_quantity) AS INT) AS v FROM lineitem GROUP BY 1, 2, 3",
    # point records
    "points": "SELECT l_orderkey*8+l_linenumber AS point_id, CAST(min(l_partkey) * 7919 % 10000 AS DOUBLE)/100.0 AS x, CAST(min(l_suppkey) * 104729 + l_orderkey * 31 % 10000 AS DOUBLE) % 10000.0 / 100.0 AS y, min(l_extendedprice)/1000.0 AS z, CAST(max(l_quantity) AS INT) AS intensity, l_linenumber AS return_number FROM lineitem GROUP BY l_orderkey, l_linenumber",
    # platform positions on a circular orbit
    "ephemeris": "SELECT CAST(n_nationkey*10.0 AS DOUBLE) AS t, 7178137.0*cos(0.00104*n_nationkey*10.0) AS px, 7178137.0*sin(0.00104*n_nationkey*10.0) AS py, -7178137.0*0.00104*sin(0.00104*n_nationkey*10.0) AS vx, 7178137.0*0.00104*cos(0.00104*n_nationkey*10.0) AS vy FROM nation",
    # key-point descriptors
    "descriptors": "SELECT vec_id, CAST(vec_id % 2 AS INT) AS image_id, label AS tile_id, embedding FROM embeddings",
    # tie points with ranked candidates
    "matches": "SELECT l_orderkey % 100 AS tile_id, l_orderkey AS tp_id, l_linenumber AS match_rank, 10.0 + (min(l_quantity)-25.0)/10.0 AS dx, 5.0 + min(l_discount)*20.0 AS dy, 1.0 - min(l_tax) AS confidence FROM lineitem GROUP BY l_orderkey, l_linenumber",
    # boxes of elevation cells or features
    "footprints": "SELECT s_suppkey AS cell_id, CAST(s_suppkey*37 % 350 AS DOUBLE) - 180.0 AS min_lon, CAST(s_suppkey*17 % 160 AS DOUBLE) - 90.0 AS min_lat, CAST(s_suppkey*37 % 350 AS DOUBLE) - 170.0 AS max_lon, CAST(s_suppkey*17 % 160 AS DOUBLE) - 80.0 AS max_lat FROM supplier",
    # places to look up
    "ground_points": "SELECT c_custkey AS gp_id, CAST(c_custkey*7919 % 360000 AS DOUBLE)/1000.0 - 180.0 AS lon, CAST(c_custkey*104729 % 170000 AS DOUBLE)/1000.0 - 85.0 AS lat, c_acctbal AS h FROM customer",
    # polynomials from ground range to slant range
    "srgr_sets": "SELECT n_regionkey AS image_id, n_nationkey AS set_id, CAST(n_nationkey*3600 AS DOUBLE) AS update_sec, CAST(800000 + n_nationkey AS DOUBLE) AS c0, CAST(0.3 AS DOUBLE) AS c1, CAST(0.0000001 AS DOUBLE) AS c2 FROM nation",
    # a colour table
    "palette": "SELECT CAST(p_partkey % 256 AS INT) AS idx, CAST(max(p_size) AS INT) AS r, CAST(min(p_size) AS INT) AS g, CAST(count(*) AS INT) AS b FROM part GROUP BY 1",
    # ground control points
    "gcps": "SELECT o_orderkey AS gcp_id, CAST(o_custkey % 5 AS INT) AS image_id, CAST(o_orderkey % 4096 AS DOUBLE) AS act_x, CAST(o_custkey % 4096 AS DOUBLE) AS act_y, CAST(o_orderkey % 4096 AS DOUBLE)*0.999 - 2.5 AS est_x, CAST(o_custkey % 4096 AS DOUBLE)*1.001 + 1.25 AS est_y FROM orders",
    # tiles as they arrive
    "tile_stream": "SELECT event_id, ts, CAST(3 + user_id % 3 AS INT) AS zoom_level, CAST(event_id % 8 AS INT) AS tile_column, CAST(user_id % 8 AS INT) AS tile_row, value FROM events",
    # pyramid metadata; one set lacks its reference system, one its levels
    "sets": "SELECT r_name AS table_name, CAST(CASE WHEN r_regionkey = 4 THEN 99 ELSE 1 END AS INT) AS srs_id, CAST(-180 AS DOUBLE) AS min_x, CAST(-90 AS DOUBLE) AS min_y, CAST(180 AS DOUBLE) AS max_x, CAST(90 AS DOUBLE) AS max_y FROM region",
    "levels": "SELECT table_name, zoom_level, CAST(2*pow(2, zoom_level) AS INT) AS matrix_width, CAST(pow(2, zoom_level) AS INT) AS matrix_height, 256 AS tile_width, 256 AS tile_height, 360.0/(512*pow(2, zoom_level)) AS pixel_x_size, 180.0/(256*pow(2, zoom_level)) AS pixel_y_size FROM (SELECT r_name AS table_name, CAST(row_number() OVER (PARTITION BY n_regionkey ORDER BY n_nationkey) - 1 AS INT) AS zoom_level FROM nation JOIN region ON n_regionkey = r_regionkey WHERE n_regionkey <> 3) q",
    "extents": "SELECT table_name, zoom_level, 10 AS min_column, 20 AS min_row, 10 + 100*(zoom_level+1) AS max_column, 20 + 50*(zoom_level+1) AS max_row FROM (SELECT r_name AS table_name, CAST(row_number() OVER (PARTITION BY n_regionkey ORDER BY n_nationkey) - 1 AS INT) AS zoom_level FROM nation JOIN region ON n_regionkey = r_regionkey WHERE n_regionkey <> 3) q WHERE zoom_level <> 2",
    "srs": "SELECT * FROM (VALUES (-1, 'NONE', -1), (0, 'NONE', 0), (1, 'EPSG', 4326), (2, 'EPSG', 3857)) AS v(srs_id, organization, code)",
    # image sizes and view rectangles
    "rects": "SELECT s_suppkey AS image_id, CAST(500 + s_suppkey*137 % 5000 AS INT) AS width, CAST(300 + s_suppkey*211 % 4000 AS INT) AS height, CAST(s_suppkey*91 % 3000 AS INT) AS x0, CAST(s_suppkey*53 % 2000 AS INT) AS y0, CAST(1 + s_suppkey % 30 AS DOUBLE)*0.00001 AS gsd_deg FROM supplier",
    # a latitude and longitude grid over the date line
    "swath_grid": "SELECT gx, gy, 10.0 + gy*CAST(0.05 AS DOUBLE) + gx*CAST(0.001 AS DOUBLE) AS lat, CASE WHEN l > 180.0 THEN l - 360.0 ELSE l END AS lon FROM (SELECT CAST(c_custkey % 40 AS INT) AS gx, CAST(floor(c_custkey/40.0) AS INT) AS gy, 178.5 + (c_custkey % 40)*CAST(0.05 AS DOUBLE) + floor(c_custkey/40.0)*CAST(0.002 AS DOUBLE) AS l FROM customer) q",
}

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


class Inputs:
    """Tables and inputs of a folder by name: ``inputs.pixels``, ``inputs.events``."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        if name in TABLES:
            return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        if name not in INPUTS:
            raise AttributeError(name)
        used = [t for t in TABLES if re.search(rf"\b(FROM|JOIN) {t}\b", INPUTS[name])]
        sql = re.sub(rf"\b(FROM|JOIN) ({'|'.join(TABLES)})\b", r"\1 {\2}", INPUTS[name])
        return self.spark.sql(sql, **{t: getattr(self, t) for t in used})


def with_inputs(sql: str) -> str:
    """``sql`` with the inputs that it names before it."""
    ctes = [f"{name} AS ({text})" for name, text in INPUTS.items() if re.search(rf"\b(FROM|JOIN|,) {name}\b", sql)]
    if not ctes:
        return sql
    body = sql.strip()
    recursive = "RECURSIVE " if body.upper().startswith("WITH RECURSIVE") else ""
    if body.upper().startswith("WITH "):
        return f"WITH {recursive}{', '.join(ctes)}, {re.sub(r'^WITH (RECURSIVE )?', '', body, flags=re.I)}"
    return f"WITH {', '.join(ctes)} {body}"


def query(name: str, sql: str | None = None) -> Callable:
    """Register a function of Inputs as a query, with its SQL where SQL can express it."""

    def register(f: Callable[[Inputs], DataFrame]) -> Callable[[Inputs], DataFrame]:
        if name in QUERIES:
            raise ValueError(f"query {name} is there already")
        QUERIES[name] = lambda spark, sf_dir: f(Inputs(spark, sf_dir))
        if sql is not None:
            ORACLES[name] = sql
        return f

    return register
