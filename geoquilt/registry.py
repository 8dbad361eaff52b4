"""All queries of the library by name, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from geoquilt.plans import catalog, jobs, points_queries, pyramid_queries, raster_queries, spatial_queries, swath_queries, tiepoint_queries, time_queries  # noqa: F401  each registers its queries


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(catalog.QUERIES)


def oracle_sql() -> dict[str, str]:
    return {name: catalog.with_inputs(sql) for name, sql in catalog.ORACLES.items()}
