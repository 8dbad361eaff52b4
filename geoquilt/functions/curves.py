"""Curves as vertices."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def flatten_curves(curves: Column, n: int = 8) -> Column:
    """The n points after the start of each cubic Bezier curve (structs a, b, c, d of x, y) of an array, end to end."""

    def at(s: Column, i: Column) -> Column:
        t = i / F.lit(float(n))
        u = F.lit(1.0) - t
        part = lambda k: u * u * u * s["a"][k] + 3 * u * u * t * s["b"][k] + 3 * u * t * t * s["c"][k] + t * t * t * s["d"][k]
        return F.struct(part("x").alias("x"), part("y").alias("y"))

    return F.flatten(F.transform(curves, lambda s: F.transform(F.sequence(F.lit(1), F.lit(n)), lambda i: at(s, i))))
