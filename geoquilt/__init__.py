"""Geospatial raster, point-cloud and tie-point analytics as Spark jobs."""
