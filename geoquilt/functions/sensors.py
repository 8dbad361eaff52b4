"""Sensor models over batches of image points, in numpy: every function takes and gives arrays with a row for each point."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

A, B = 6378137.0, 6356752.3142


def sar_locate(p: np.ndarray, v: np.ndarray, dist: np.ndarray, doppler: np.ndarray, h: np.ndarray, wavelength: float, right: bool = True, a: float = A, b: float = B) -> tuple[np.ndarray, np.ndarray]:
    """(position, status): where the range sphere, the Doppler cone and the ellipsoid raised by h meet, on the look side.

    Sphere and cone meet in a circle about the line of flight. A point of it is told by its angle from straight down, from 0
    to pi on the look side, and its height over the raised ellipsoid grows with the angle from the lowest point on, so the
    angle is found between bounds by Newton's method.
    Status 0: found; 1: the circle reaches the surface on the other side alone; 2: it doesn't reach it."""
    unit = lambda x: x / np.linalg.norm(x, axis=1, keepdims=True)
    dot = lambda x, y: (x * y).sum(1)
    ahead = unit(v)
    down = unit(ahead * dot(p, ahead)[:, None] - p)
    aside = unit(np.cross(v, p)) * (1 if right else -1)
    axial = doppler * wavelength * dist / (2 * np.linalg.norm(v, axis=1))
    radius = np.sqrt(np.where(np.abs(axial) <= dist, dist**2 - axial**2, np.nan))[:, None]
    # in units of the raised ellipsoid, which is a unit sphere there
    scale = 1 / np.stack([a + h, a + h, b + h], 1)
    centre, to_down, to_side = (p + axial[:, None] * ahead) * scale, radius * down * scale, radius * aside * scale

    def above(angle: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Squared distance from the centre less 1, and its two derivatives by the angle."""
        c, s = np.cos(angle)[:, None], np.sin(angle)[:, None]
        x, dx = centre + c * to_down + s * to_side, c * to_side - s * to_down
        return dot(x, x) - 1, 2 * dot(x, dx), 2 * (dot(dx, dx) - dot(x, x - centre))

    lowest = np.arctan2(-dot(centre, to_side), -dot(centre, to_down))
    for _ in range(6):
        _, slope, bend = above(lowest)
        lowest = lowest - np.where(bend > 0, slope / np.where(bend > 0, bend, 1.0), 0.0)
    low, high = np.maximum(lowest, 0.0), np.full(len(p), np.pi)
    found = (above(low)[0] <= 0) & (above(high)[0] > 0)
    angle = (low + high) / 2
    for _ in range(50):
        value, slope, _ = above(angle)
        low, high = np.where(value < 0, angle, low), np.where(value < 0, high, angle)
        step = angle - value / np.where(slope == 0, np.nan, slope)
        angle = np.where((step > low) & (step < high), step, (low + high) / 2)
    c, s = np.cos(angle)[:, None], np.sin(angle)[:, None]
    out = np.where(found[:, None], p + axial[:, None] * ahead + radius * (c * down + s * aside), np.nan)
    return out, np.where(found, 0, np.where(above(lowest)[0] <= 0, 1, 2))


def pushbroom_ray(p: np.ndarray, v: np.ndarray, attitude: np.ndarray, psi_x: np.ndarray, psi_y: np.ndarray) -> np.ndarray:
    """Unit look directions in the Earth's frame, from pitch, roll and yaw and the look angles of the column."""
    unit = lambda a: a / np.linalg.norm(a, axis=1, keepdims=True)
    look = np.stack([-np.tan(psi_y), np.tan(psi_x), -np.ones(len(p))], 1)
    (cp, cr, cy), (sp, sr, sy) = np.cos(attitude.T), np.sin(attitude.T)
    turn = np.stack([np.stack([cr * cy, -cr * sy, -sr], 1), np.stack([cp * sy + sp * sr * cy, cp * cy - sp * sr * sy, sp * cr], 1), np.stack([-sp * sy + cp * sr * cy, -sp * cy - cp * sr * sy, cp * cr], 1)], 1)
    orbital = unit(np.einsum("nij,nj->ni", turn, look))
    z = unit(p)
    x = unit(np.cross(v, z))
    axes = np.stack([x, np.cross(z, x), z], 2)
    return np.einsum("nij,nj->ni", axes, orbital)


def meet_ellipsoid(p: np.ndarray, u: np.ndarray, h: np.ndarray, a: float = A, b: float = B) -> np.ndarray:
    """Where rays first meet the ellipsoid raised by h; NaN where they don't."""
    s = 1 / np.stack([a + h, a + h, b + h], 1)
    ps, us = p * s, u * s
    qa, qb, qc = (us**2).sum(1), 2 * (ps * us).sum(1), (ps**2).sum(1) - 1
    disc = qb**2 - 4 * qa * qc
    t = np.where(disc >= 0, (-qb - np.sqrt(np.maximum(disc, 0))) / (2 * qa), np.nan)
    return p + np.where(t >= 0, t, np.nan)[:, None] * u


def two_ray_point(p1: np.ndarray, u1: np.ndarray, p2: np.ndarray, u2: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(midpoint of the shortest line between two rays, its length); NaN for parallel rays."""
    w, b = p1 - p2, (u1 * u2).sum(1)
    d, e, den = (u1 * w).sum(1), (u2 * w).sum(1), 1 - b**2
    with np.errstate(divide="ignore", invalid="ignore"):
        s, t = np.where(den > 1e-15, (b * e - d) / den, np.nan), np.where(den > 1e-15, (e - b * d) / den, np.nan)
    q1, q2 = p1 + s[:, None] * u1, p2 + t[:, None] * u2
    return (q1 + q2) / 2, np.linalg.norm(q1 - q2, axis=1)


Forward = Callable[[pd.DataFrame, np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]


def invert(forward: Forward, rows: pd.DataFrame, target: np.ndarray, start: np.ndarray, step: float, tolerance: float, rounds: int) -> tuple[np.ndarray, np.ndarray]:
    """(position, rounds taken) at which ``forward`` gives the targets, by Newton's method with differences, all rows
    together; rows that don't get there within the rounds, or whose slopes vanish, are NaN."""
    at, used = start.astype(float).copy(), np.zeros(len(rows), int)
    open_rows = np.ones(len(rows), bool)
    for n in range(1, rounds + 1):
        i = np.flatnonzero(open_rows)
        if not len(i):
            break
        part = rows.iloc[i]
        f = np.stack(forward(part, at[i, 0], at[i, 1]), 1)
        miss = target[i] - f
        gx = (np.stack(forward(part, at[i, 0] + step, at[i, 1]), 1) - f) / step
        gy = (np.stack(forward(part, at[i, 0], at[i, 1] + step), 1) - f) / step
        det = gx[:, 0] * gy[:, 1] - gx[:, 1] * gy[:, 0]
        with np.errstate(divide="ignore", invalid="ignore"):
            move = np.stack([(miss[:, 0] * gy[:, 1] - miss[:, 1] * gy[:, 0]) / det, (gx[:, 0] * miss[:, 1] - gx[:, 1] * miss[:, 0]) / det], 1)
        at[i] += move
        used[i] = n
        open_rows[i] = ~((np.abs(move).max(1) < tolerance) | ~np.isfinite(move).all(1))
    at[open_rows | ~np.isfinite(at).all(1)] = np.nan
    return at, used


def over_batches(df: DataFrame, columns: dict[str, str], compute: Callable[[pd.DataFrame], dict[str, np.ndarray]], keep: list[str]) -> DataFrame:
    """``keep`` and new columns (name: type) that ``compute`` makes of each batch; NaN becomes null."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pdf[keep].assign(**compute(pdf))

    schema = df.select(*keep).schema
    for name, kind in columns.items():
        schema = schema.add(name, T.DataType.fromDDL(kind))
    out = df.mapInPandas(run, schema)
    return out.select(*keep, *[F.when(~F.isnan(c), F.col(c)).alias(c) if k == "double" else F.col(c) for c, k in columns.items()])


def bilinear(grid: np.ndarray, u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Values (n, 2) of a grid (rows, columns, 2) at columns u and rows v; beyond its edge the outer cell goes on as a plane."""
    i = np.clip(np.floor(u), 0, grid.shape[1] - 2).astype(int)
    j = np.clip(np.floor(v), 0, grid.shape[0] - 2).astype(int)
    a, b = (u - i)[:, None], (v - j)[:, None]
    return (grid[j, i] * (1 - a) + grid[j, i + 1] * a) * (1 - b) + (grid[j + 1, i] * (1 - a) + grid[j + 1, i + 1] * a) * b


def in_outline(outline: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Whether points lie in a polygon (n, 2), by the parity of the sides to their right; on a side either may be."""
    inside = np.zeros(len(x), bool)
    for (x0, y0), (x1, y1) in zip(outline, np.roll(outline, -1, 0), strict=True):
        if y0 != y1:
            inside ^= ((y0 > y) != (y1 > y)) & (x < x0 + (y - y0) / (y1 - y0) * (x1 - x0))
    return inside


def place_in_grids(places: DataFrame, grids: DataFrame, tolerance: float = 0.1, rounds: int = 20, block: int = 65_536) -> DataFrame:
    """(image_id, point_id, samp, line) at which the grid model of an image gives each place (image_id, point_id, lon, lat).

    ``grids`` has a node of every column gx and row gy of an image from 0 on, a few thousand by contract: image_id, gx, gy,
    lon, lat. The search starts at the middle, steps by one cell and ends within the tolerance. Places outside the image's
    outline, null places and those not found within the rounds have nulls; an image whose grid crosses the date line counts
    longitudes from 0 to 360. Images without a grid of two rows and columns give nulls. Places of an image are dealt out by
    blocks, each with a copy of the grid, so no image meets in one task."""
    counts = places.groupBy("image_id").agg(F.ceil(F.count(F.lit(1)) / F.lit(block)).cast("int").alias("blocks"))
    dealt = places.join(counts, "image_id").select("image_id", "point_id", F.col("lon").cast("double").alias("lon"), F.col("lat").cast("double").alias("lat"), F.pmod(F.xxhash64("point_id"), F.col("blocks")).cast("int").alias("block"))
    copies = grids.join(counts, "image_id").withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select("image_id", "block", "gx", "gy", "lon", "lat")

    def run(key: tuple, asked: pd.DataFrame, nodes: pd.DataFrame) -> pd.DataFrame:
        found = np.full((len(asked), 2), np.nan)
        if len(asked) and len(nodes) and nodes["gx"].max() > 0 and nodes["gy"].max() > 0:
            grid = np.full((int(nodes["gy"].max()) + 1, int(nodes["gx"].max()) + 1, 2), np.nan)
            grid[nodes["gy"], nodes["gx"]] = nodes[["lon", "lat"]].to_numpy(float)
            target = asked[["lon", "lat"]].to_numpy(float)
            if np.nanmax(grid[..., 0]) - np.nanmin(grid[..., 0]) > 180:
                for lon in (grid[..., 0], target[:, 0]):
                    lon[lon < 0] += 360
            outline = np.concatenate([grid[0], grid[1:, -1], grid[-1, -2::-1], grid[-2:0:-1, 0]])
            ok = np.flatnonzero(in_outline(outline, target[:, 0], target[:, 1]))
            start = np.tile((np.array(grid.shape[1::-1]) - 1) / 2, (len(ok), 1))
            found[ok], _ = invert(lambda part, u, v: tuple(bilinear(grid, u, v).T), asked.iloc[ok], target[ok], start, 1.0, tolerance, rounds)
        return asked[["image_id", "point_id"]].assign(samp=found[:, 0], line=found[:, 1])

    kind = lambda c: places.schema[c].dataType.simpleString()
    out = dealt.groupBy("image_id", "block").cogroup(copies.groupBy("image_id", "block")).applyInPandas(run, f"image_id {kind('image_id')}, point_id {kind('point_id')}, samp double, line double")
    return out.select("image_id", "point_id", *[F.when(~F.isnan(c), F.col(c)).alias(c) for c in ("samp", "line")])
