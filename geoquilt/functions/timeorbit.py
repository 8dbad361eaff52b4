"""Dates, orbit interpolation and sensor polynomials as column expressions.

Nodes of an orbit come as one array of structs (t, and values) for each image, sorted by t: tens of entries, made once."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DAY = 86400.0
#: Radians per second of the Earth's rotation, and metres per second of light. Fixed values.
EARTH_RATE = 2 * math.pi / 86164.09054
LIGHT = 2.99792458e8


def truncated(c: Column) -> Column:
    return c.cast("long")


def julian_day(year: Column, month: Column, day: Column, seconds: Column) -> Column:
    """Julian day of a civil date; null for the days that the Gregorian reform left out."""
    late = month > 2
    y, m = F.when(late, year).otherwise(year - 1), F.when(late, month).otherwise(month + 12)
    stamp = year * 10000 + month * 100 + day
    century = truncated(y / 100)
    b = F.when(stamp >= 15821015, (2 - century + truncated(century / 4)).cast("double")).otherwise(F.lit(0.0)) + 1720994.5
    days = truncated(F.lit(365.25) * y - F.when(y < 0, 0.75).otherwise(0.0)) + truncated(F.lit(30.6001) * (m + 1))
    return F.when((stamp <= 15821004) | (stamp >= 15821015), days.cast("double") + day + seconds / DAY + b)


def split_julian(jd: Column) -> tuple[Column, Column, Column]:
    """(Julian day of 0 h, whole second, decimal of a second)."""
    day0 = truncated(jd - 0.5).cast("double") + 0.5
    seconds = (jd - day0) * DAY
    return day0, F.floor(seconds), seconds - F.floor(seconds)


def mjd2000(day: Column, second: Column, micro: Column) -> Column:
    """Julian day of days, seconds and microseconds since 2000-01-01."""
    return F.lit(2451544.5) + day + (second + micro * 1e-6) / DAY


def gmst(jd: Column, epoch: int = 1950) -> Column:
    """Greenwich mean sidereal angle in radians, 0 to two pi, by the formula of an epoch."""
    day0, second, rest = split_julian(jd)
    if epoch == 1900:
        t = (day0 - 2415020.0) / 36525.0
        at0 = (F.lit(23925.836) + t * (F.lit(8640184.542) + t * 0.0929)) * (2 * math.pi / DAY)
    elif epoch == 1950:
        at0 = F.lit(1.72944494) + (day0 - 2433281.5) * 6.3003880987
    elif epoch == 2000:
        t = (day0 - 2451545.0) / 36525.0
        at0 = (F.lit(24110.54841) + t * (F.lit(8640184.812866) + t * (F.lit(0.093103) - t * 6.210e-6))) * (2 * math.pi / DAY)
    else:
        raise ValueError(f"unknown epoch {epoch}")
    return F.pmod(at0 + (second + rest) * EARTH_RATE, F.lit(2 * math.pi))


def parse_ymd(text: Column, first_year: int = 1950, last_year: int = 2050) -> Column:
    """Julian day of a text yyyymmdd; null where it isn't one or the year is out of range."""
    part = lambda a, n: F.substring(text, a, n).try_cast("int")
    y, m, d = part(1, 4), part(5, 2), part(7, 2)
    ok = text.rlike("^[0-9]{8}$") & y.between(first_year, last_year) & m.between(1, 12) & d.between(1, 31)
    return F.when(ok, julian_day(y, m, d, F.lit(0.0)))


def parse_day_of_year(text: Column) -> Column:
    """Seconds of the day of a text YYYY-DDD-HH:MM:SS.SSS."""
    get = lambda i: F.regexp_extract(text, r"^(\d{4})-(\d{3})-(\d{2}):(\d{2}):(\d{2}(?:\.\d+)?)$", i)
    return F.when(get(1) != "", get(3).cast("double") * 3600 + get(4).cast("double") * 60 + get(5).cast("double"))


def horner(coefficients: Column, x: Column) -> Column:
    """The polynomial with ascending coefficients at x; null without any."""
    return F.when(F.size(coefficients) > 0, F.aggregate(F.reverse(coefficients), F.lit(0.0), lambda s, c: s * x + c))


def slant_range(col: Column, ref_range: Column, ref_col: Column, direction: Column, looks: Column, rate: Column) -> Column:
    """Range of a column: linear, half a light second over the sampling rate for each look."""
    return ref_range + direction * (col - ref_col) * (LIGHT / 2) * looks / rate


def azimuth_time(line: Column, ref_time: Column, ref_line: Column, direction: Column, looks: Column, prf: Column) -> Column:
    return ref_time + direction * (line - ref_line) * looks / prf


def line_rate(lines: Column, first: Column, last: Column) -> Column:
    return lines / (last - first)


def srgr_slant_range(coefficients: Column, ground_range: Column, origin: Column | None = None) -> Column:
    """Slant range of a ground range, relative to an origin where there is one; -1 without a set."""
    return F.coalesce(horner(coefficients, ground_range if origin is None else ground_range - origin), F.lit(-1.0))


def nearest_set(points: DataFrame, sets: DataFrame, same_day: bool = False) -> DataFrame:
    """Each point (point_id, image_id, t) with the set (set_id, update_sec, coefs) of its image nearest in time, the first of
    equals; same_day compares times of day alone. An image has tens of sets, so they come to the points as one array."""
    lists = sets.groupBy("image_id").agg(F.sort_array(F.collect_list(F.struct("set_id", "update_sec", "coefs"))).alias("sets"))
    time = lambda c: F.pmod(c, F.lit(DAY)) if same_day else c
    ranked = F.transform("sets", lambda s: F.struct(F.abs(time(s["update_sec"]) - time(F.col("t"))).alias("far"), s["set_id"].alias("set_id"), s["coefs"].alias("coefs")))
    best = F.array_min(ranked)
    return points.join(lists, "image_id", "left").withColumns({"set_id": best["set_id"], "coefs": best["coefs"]}).drop("sets")


def node_arrays(nodes: DataFrame, key: str, time: str, values: list[str]) -> DataFrame:
    """One row for each image: its nodes sorted by time, with the constants of Hermite interpolation."""
    lists = nodes.groupBy(key).agg(F.sort_array(F.collect_list(F.struct(F.col(time).alias("t"), *values))).alias("raw"))
    prod = lambda n: F.aggregate(F.filter("raw", lambda m: m["t"] != n["t"]), F.lit(1.0), lambda s, m: s / (n["t"] - m["t"]))
    total = lambda n: F.aggregate(F.filter("raw", lambda m: m["t"] != n["t"]), F.lit(0.0), lambda s, m: s + F.lit(1.0) / (n["t"] - m["t"]))
    return lists.select(key, F.transform("raw", lambda n: F.struct(n["t"].alias("t"), *[n[v].alias(v) for v in values], prod(n).alias("prod"), total(n).alias("sum"))).alias("nodes"))


def hermite(nodes: Column, t: Column, pairs: dict[str, str]) -> Column:
    """A struct of values and rates at t of the polynomials through all nodes' values and rates (``pairs``: value to rate);
    exact at nodes; null below two nodes. What all nodes share is computed once, and one pass over the nodes makes all."""
    names = [n for pair in pairs.items() for n in pair]
    zero = F.struct(*[F.lit(0.0).alias(n) for n in names])

    def add(s: Column, n: Column, shared: Column) -> Column:
        r = t - n["t"]
        h = shared["whole"] / r * n["prod"]
        u = (shared["inverse"] - F.lit(1.0) / r) * h
        sums = []
        for value, rate in pairs.items():
            sums.append((s[value] + (n[value] * (1 - 2 * r * n["sum"]) + n[rate] * r) * h * h).alias(value))
            sums.append((s[rate] + 2 * h * (u * (1 - 2 * n["sum"] * r) - h * n["sum"]) * n[value] + h * (h + 2 * r * u) * n[rate]).alias(rate))
        return F.struct(*sums)

    shared = F.aggregate(nodes, F.struct(F.lit(1.0).alias("whole"), F.lit(0.0).alias("inverse")), lambda s, n: F.struct((s["whole"] * (t - n["t"])).alias("whole"), (s["inverse"] + F.lit(1.0) / (t - n["t"])).alias("inverse")))
    between = F.transform(F.array(shared), lambda w: F.aggregate(nodes, zero, lambda s, n: add(s, n, w)))[0]
    at = F.get(F.filter(nodes, lambda n: F.abs(t - n["t"]) < 1e-12), F.lit(0))
    return F.when(F.size(nodes) >= 2, F.when(at.isNotNull(), F.struct(*[at[n].alias(n) for n in names])).otherwise(between))


def lagrange(nodes: Column, t: Column, value: str, period: float) -> Column:
    """Value at t through 8 nodes around it (fewer where the image has 8 or less); null outside. A node within half a line
    period is left out for the one after the window."""
    n = F.size(nodes)
    half = F.when(n <= 8, F.floor(F.floor(n / 2) / 2)).otherwise(F.lit(4)).cast("int")
    wide = F.when(n <= 8, F.floor(n / 2)).otherwise(F.lit(8)).cast("int")
    at = lambda i: F.get(nodes, i)
    first = F.greatest(half, F.size(F.filter(nodes, lambda m: m["t"] < t)))
    close = F.abs(at(first)["t"] - t) < period / 2
    window = F.slice(nodes, first - half + 1, wide + close.cast("int"))
    used = F.when(close, F.filter(window, lambda m, i: i != half)).otherwise(window)
    weight = lambda m: F.aggregate(F.filter(used, lambda k: k["t"] != m["t"]), F.lit(1.0), lambda s, k: s * (t - k["t"]) / (m["t"] - k["t"]))
    inside = (t >= at(half)["t"]) & (t < at(n - half)["t"])
    return F.when(inside, F.aggregate(used, F.lit(0.0), lambda s, m: s + m[value] * weight(m)))


def bracket(nodes: Column, t: Column, value: str, clamp: bool = False) -> Column:
    """Linear value between the two nodes around t. Outside [first, last): null, or with ``clamp`` the end's value."""
    i = F.size(F.filter(nodes, lambda m: m["t"] <= t))
    a, b = F.get(nodes, i - 1), F.get(nodes, i)
    inside = (i > 0) & (i < F.size(nodes))
    mid = a[value] + (b[value] - a[value]) * (t - a["t"]) / (b["t"] - a["t"])
    if not clamp:
        return F.when(inside, mid)
    return F.when(inside, mid).when(i == 0, F.get(nodes, F.lit(0))[value]).otherwise(F.element_at(nodes, -1)[value])


def earth_to_inertial(angle: Column, p: list[Column], v: list[Column]) -> tuple[list[Column], list[Column]]:
    """Position and velocity of the rotating Earth's frame in the inertial one, at a sidereal angle."""
    c, s = F.cos(angle), F.sin(angle)
    x, y = p[0] * c - p[1] * s, p[0] * s + p[1] * c
    return [x, y, p[2]], [v[0] * c - v[1] * s - EARTH_RATE * y, v[0] * s + v[1] * c + EARTH_RATE * x, v[2]]


def inertial_to_earth(angle: Column, p: list[Column], v: list[Column]) -> tuple[list[Column], list[Column]]:
    c, s = F.cos(angle), F.sin(angle)
    wx, wy = v[0] + EARTH_RATE * p[1], v[1] - EARTH_RATE * p[0]
    return [p[0] * c + p[1] * s, -p[0] * s + p[1] * c, p[2]], [wx * c + wy * s, -wx * s + wy * c, v[2]]


#: Nutation of 1980, its nine largest terms. Multiples of the Moon's and the Sun's mean anomaly, the Moon's
#: distance from its node, its elongation and the node's longitude; then radians of longitude (sine) and obliquity (cosine).
NUTATION = (
    (0, 0, 0, 0, 1, -0.8338601e-4, 0.4461498e-4),
    (0, 0, 2, -2, 2, -0.6393238e-5, 0.2780891e-5),
    (0, 0, 2, 0, 2, -0.1102466e-5, 0.4736630e-6),
    (0, 0, 0, 0, 2, 0.9996858e-6, -0.4339082e-6),
    (0, 1, 0, 0, 0, 0.6913443e-6, 0.2617994e-7),
    (1, 0, 0, 0, 0, 0.3451873e-6, -0.3393696e-8),
    (0, 1, 2, -2, 2, -0.2506487e-6, 0.1085983e-6),
    (0, 0, 2, 0, 1, -0.1871381e-6, 0.9696274e-7),
    (1, 0, 2, 0, 2, -0.1459289e-6, 0.6254096e-7),
)
#: The five angles as polynomials in days, the day that these count from, and the obliquity. Fixed values.
ANGLES = (
    (2.355548394, 0.2280271437, 0.1137830e-12),
    (6.240035939, 0.01720197005, -0.2096864e-14),
    (1.627901934, 0.2308957196, -0.4817699e-13),
    (5.198469514, 0.2127687104, -0.2504244e-13),
    (2.182438624, -0.9242175478e-3, 0.2709206e-13),
)
NUTATION_DAY, OBLIQUITY = 2451540.5, math.radians(23 + (26 + 21.4119 / 60) / 60)


def nutation(jd: Column) -> tuple[Column, Column]:
    """(longitude, obliquity): how far the true equinox of a Julian day lies from the mean one, in radians."""
    t = jd - NUTATION_DAY
    angles = [F.lit(a) + t * (F.lit(b) + t * c) for a, b, c in ANGLES]
    psi = eps = F.lit(0.0)
    for *multiples, sine, cosine in NUTATION:
        arg = sum((m * angle for m, angle in zip(multiples, angles, strict=True) if m), F.lit(0.0))
        psi, eps = psi + F.sin(arg) * sine, eps + F.cos(arg) * cosine
    return psi, eps


def turned(angle: Column, a: Column, b: Column) -> tuple[Column, Column]:
    """The coordinates of a point of a plane after its axes turn by an angle from the first to the second."""
    return a * F.cos(angle) + b * F.sin(angle), b * F.cos(angle) - a * F.sin(angle)


def mean_inertial_to_earth(angle: Column, psi: Column, eps: Column, p: list[Column], v: list[Column]) -> tuple[list[Column], list[Column]]:
    """Position and velocity of the mean inertial frame of a day in the rotating Earth's frame, at a supplied sidereal angle:
    the axes follow the nutation of the day, then the Earth's turn. Let psi and eps be columns made before, as both occur often."""
    tilt = psi * math.sin(OBLIQUITY)

    def true(q: list[Column]) -> list[Column]:
        z, x = turned(tilt, q[2], q[0])
        z, y = turned(eps, z, q[1])
        return [x, y, z]

    (px, py, pz), (vx, vy, vz) = true(p), true(v)
    (px, py), (vx, vy) = turned(angle, px, py), turned(angle, vx, vy)
    return [px, py, pz], [vx + EARTH_RATE * py, vy - EARTH_RATE * px, vz]


def earth_to_mean_inertial(angle: Column, psi: Column, eps: Column, p: list[Column], v: list[Column]) -> tuple[list[Column], list[Column]]:
    """The way back from ``mean_inertial_to_earth``."""
    tilt = psi * math.sin(OBLIQUITY)

    def back(q: list[Column]) -> list[Column]:
        x, y = turned(-angle, q[0], q[1])
        z, y = turned(-eps, q[2], y)
        z, x = turned(-tilt, z, x)
        return [x, y, z]

    return back(p), back([v[0] - EARTH_RATE * p[1], v[1] + EARTH_RATE * p[0], v[2]])


def ecef_to_geodetic(x: Column, y: Column, z: Column, a: float = 6378137.0, b: float = 6356752.3142, rounds: int = 8) -> tuple[Column, Column, Column]:
    """(lon, lat, height) in radians and metres, by Newton's method on the reduced latitude; the rounds are more than it needs."""
    u, k = F.sqrt(x * x + y * y), a * a - b * b

    def step(e: Column) -> Column:
        c, s = F.cos(e), F.sin(e)
        return e - (a * u * s - b * z * c - k * s * c) / (a * u * c + b * z * s - k * (c * c - s * s))

    e = F.aggregate(F.sequence(F.lit(1), F.lit(rounds)), F.atan(z / u), lambda e, _: step(e))
    polar = u < 1e-6
    lat = F.atan(F.tan(e) * (a / b))
    return F.when(polar, 0.0).otherwise(F.atan2(y, x)), F.when(polar, F.when(z >= 0, math.pi / 2).otherwise(-math.pi / 2)).otherwise(lat), F.when(polar, F.abs(z) - b).otherwise((u - a * F.cos(e)) / F.cos(lat))


def look_angle(coefficients: Column, col: Column) -> Column:
    """Cubic in the truncated column; null unless there are 4 coefficients."""
    return F.when(F.size(coefficients) == 4, horner(coefficients, F.floor(col)))


def bias_fit(gcps: DataFrame) -> DataFrame:
    """(image_id, factor_x, bias_x, factor_y, bias_y): the error of estimated positions as a line in the actual ones; no slope where those don't vary."""

    def fit(axis: str) -> list[Column]:
        actual, error = F.col(f"act_{axis}"), F.col(f"act_{axis}") - F.col(f"est_{axis}")
        varies = F.var_pop(actual) > 1.1920929e-07
        factor = F.when(varies, F.covar_pop(error, actual) / F.var_pop(actual)).otherwise(F.lit(0.0))
        return [factor.alias(f"factor_{axis}"), (F.avg(error) - factor * F.avg(actual)).alias(f"bias_{axis}")]

    return gcps.groupBy("image_id").agg(*fit("x"), *fit("y"))


def unbias(position: Column, factor: Column, bias: Column) -> Column:
    return position - (position * factor + bias)


def rpc_decimate(position: Column, factor: float, outward: bool = True) -> Column:
    """Image positions of a decimated product: multiplied on the way out, divided on the way in."""
    return position * factor if outward else position / factor


def rational(numerator: Column, denominator: Column, terms: Column) -> Column:
    """Ratio of two polynomials given by coefficients of the same terms."""
    dot = lambda c: F.aggregate(F.zip_with(c, terms, lambda a, b: a * b), F.lit(0.0), lambda s, v: s + v)
    return dot(numerator) / dot(denominator)


def rpc_terms(p: Column, lon: Column, h: Column) -> Column:
    """The 20 terms of a cubic in normalised latitude, longitude and height, in the usual order."""
    one = F.lit(1.0)
    return F.array(one, lon, p, h, lon * p, lon * h, p * h, lon * lon, p * p, h * h, p * lon * h, lon**3, lon * p * p, lon * h * h, lon * lon * p, p**3, p * h * h, lon * lon * h, p * p * h, h**3)
