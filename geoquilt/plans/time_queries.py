"""Queries on dates, orbits and sensor models."""

from __future__ import annotations


import numpy as np
from pyspark.sql import functions as F

from geoquilt.functions import sensors
from geoquilt.functions import timeorbit as to
from geoquilt.operators import coarse
from geoquilt.plans.catalog import INPUTS, query
from geoquilt.sources.shared import materialize

INPUTS["image_points"] = "SELECT o_orderkey AS point_id, CAST(o_custkey % 5 AS INT) AS image_id, CAST(o_orderkey % 4096 AS DOUBLE) AS col, CAST(o_custkey % 4096 AS DOUBLE) AS line, CAST(o_orderkey % 2400 AS DOUBLE) / 10.0 + 0.03 AS t, CAST(o_custkey % 5000 AS DOUBLE) AS h FROM orders"
Q = lambda c, n=9: F.round(c, n).alias(c)
MODEL = {"ref_range": 850000.0, "ref_col": 100.0, "ref_time": 30000.0, "ref_line": 50.0, "rate": 19207680.0, "prf": 1652.4}


def orbit(t):
    return to.node_arrays(t.ephemeris.select(F.lit(0).alias("orbit"), "*"), "orbit", "t", ["px", "py", "vx", "vy"])


def on_orbit(t):
    return t.image_points.withColumn("orbit", F.lit(0)).join(F.broadcast(orbit(t)), "orbit")


@query("s16_dates", """WITH e AS (SELECT event_id, CAST(1400 + event_id % 700 AS INT) AS y, CAST(1 + event_id % 12 AS INT) AS m, CAST(1 + event_id % 28 AS INT) AS d, CAST(event_id % 86400 AS DOUBLE) + 0.25 AS s FROM events),
a AS (SELECT *, CASE WHEN m > 2 THEN y ELSE y - 1 END AS a, CASE WHEN m > 2 THEN m ELSE m + 12 END AS b, y*10000 + m*100 + d AS stamp FROM e),
j AS (SELECT event_id, y, m, d, stamp, CASE WHEN stamp > 15821004 AND stamp < 15821015 THEN NULL ELSE trunc(365.25*a) + trunc(30.6001*(b+1)) + d + s/86400.0 + 1720994.5 + (CASE WHEN stamp >= 15821015 THEN 2 - a//100 + (a//100)//4 ELSE 0 END) END AS jd FROM a),
k AS (SELECT *, floor(jd - 0.5) + 0.5 AS day0, (jd - (floor(jd - 0.5) + 0.5))*86400.0 AS sec FROM j)
SELECT event_id, CAST(jd AS DOUBLE) AS jd, CAST(day0 AS DOUBLE) AS day0, CAST(round(sec, 3) AS DOUBLE) AS seconds, round(fmod(1.72944494 + (day0 - 2433281.5)*6.3003880987 + sec*(2*pi()/86164.09054), 2*pi()) + CASE WHEN fmod(1.72944494 + (day0 - 2433281.5)*6.3003880987 + sec*(2*pi()/86164.09054), 2*pi()) < 0 THEN 2*pi() ELSE 0 END, 6) AS gmst1950 FROM k""")
def s16(t):
    i = F.col("event_id")
    e = t.events.select("event_id", to.julian_day((1400 + i % 700).cast("int"), (1 + i % 12).cast("int"), (1 + i % 28).cast("int"), (i % 86400).cast("double") + 0.25).alias("jd"))
    day0, second, rest = to.split_julian(F.col("jd"))
    return e.select("event_id", "jd", day0.alias("day0"), F.round(second + rest, 3).alias("seconds"), F.round(to.gmst(F.col("jd"), 1950), 6).alias("gmst1950"))


@query("s16_parse", """SELECT event_id, CAST(2451544.5 AS DOUBLE) + event_id % 28 AS jd, CAST((event_id % 24)*3600 + (event_id % 60)*60 AS DOUBLE) + 30.5 AS seconds, round(CAST(2451544.5 + event_id AS DOUBLE) + CAST(43200.5 AS DOUBLE)/86400, 6) AS mjd FROM events""")
def s16_parse(t):
    i = F.col("event_id")
    two = lambda c: F.lpad(c.cast("string"), 2, "0")
    ymd, doy = F.concat(F.lit("200001"), two(1 + i % 28)), F.concat(F.lit("2001-010-"), two(i % 24), F.lit(":"), two(i % 60), F.lit(":30.5"))
    return t.events.select("event_id", to.parse_ymd(ymd).alias("jd"), to.parse_day_of_year(doy).alias("seconds"), F.round(to.mjd2000(i, F.lit(43200), F.lit(500000)), 6).alias("mjd"))


@query("s17_slant_range", "SELECT point_id, round(850000.0 + (col - 100.0)*(2.99792458e8/2)*1/19207680.0, 6) AS slant FROM image_points")
def s17(t):
    one, m = F.lit(1.0), {k: F.lit(v) for k, v in MODEL.items()}
    return t.image_points.select("point_id", F.round(to.slant_range(F.col("col"), m["ref_range"], m["ref_col"], one, one, m["rate"]), 6).alias("slant"))


@query("s18_azimuth_time", "SELECT point_id, round(30000.0 - (line - 50.0)*2/(4096/(100.0 - 97.5)), 9) AS time FROM image_points")
def s18(t):
    rate = to.line_rate(F.lit(4096.0), F.lit(97.5), F.lit(100.0))
    return t.image_points.select("point_id", F.round(to.azimuth_time(F.col("line"), F.lit(30000.0), F.lit(50.0), F.lit(-1.0), F.lit(2.0), rate), 9).alias("time"))


def coefficient_sets(t):
    return t.srgr_sets.select("image_id", "set_id", "update_sec", F.array("c0", "c1", "c2").alias("coefs"))


def dated(t):
    return t.image_points.select("point_id", "image_id", "col", (F.col("t") * 360.0).alias("t"))


NEAREST = "s AS (SELECT point_id, col, p.t*360.0 AS t, set_id, c0, c1, c2 FROM image_points p LEFT JOIN srgr_sets r USING (image_id) QUALIFY row_number() OVER (PARTITION BY point_id ORDER BY abs(update_sec - p.t*360.0), set_id) = 1)"


@query("j5_nearest_set", f"WITH {NEAREST} SELECT point_id, set_id FROM s")
def j5(t):
    return to.nearest_set(dated(t), coefficient_sets(t)).select("point_id", "set_id")


@query("j5_nearest_set_same_day", "SELECT point_id, set_id FROM image_points p LEFT JOIN srgr_sets r USING (image_id) QUALIFY row_number() OVER (PARTITION BY point_id ORDER BY abs(fmod(update_sec, 86400) - fmod(p.t*360.0, 86400)), set_id) = 1")
def j5_same_day(t):
    return to.nearest_set(dated(t), coefficient_sets(t), same_day=True).select("point_id", "set_id")


@query("s19_srgr_slant_range", f"WITH {NEAREST} SELECT point_id, round(coalesce(c0 + c1*(col*12.5 + 0.1234) + c2*pow((col*12.5 + 0.1234), 2), -1.0), 4) AS slant, round(coalesce(c0 + c1*(col*12.5 + 0.1234 - 5000) + c2*pow((col*12.5 + 0.1234) - 5000, 2), -1.0), 4) AS relative FROM s")
def s19(t):
    p, g = to.nearest_set(dated(t), coefficient_sets(t)), F.col("col") * 12.5 + 0.1234
    return p.select("point_id", F.round(to.srgr_slant_range(F.col("coefs"), g), 4).alias("slant"), F.round(to.srgr_slant_range(F.col("coefs"), g, F.lit(5000.0)), 4).alias("relative"))


@query("s20_ecef_to_geodetic", """WITH p AS (SELECT gp_id, radians(lon) AS lo, radians(lat) AS la, h, 6378137.0/sqrt(1 - (1 - pow(6356752.3142/6378137.0, 2))*pow(sin(radians(lat)), 2)) AS n FROM ground_points) SELECT gp_id, round(degrees(lo), 8) AS lon, round(degrees(la), 8) AS lat, round(h, 4) AS h FROM p""")
def s20(t):
    n = F.lit(sensors.A) / F.sqrt(1 - (1 - (sensors.B / sensors.A) ** 2) * F.sin(F.radians("lat")) ** 2)
    x, y = (n + F.col("h")) * F.cos(F.radians("lat")) * F.cos(F.radians("lon")), (n + F.col("h")) * F.cos(F.radians("lat")) * F.sin(F.radians("lon"))
    z = (n * (sensors.B / sensors.A) ** 2 + F.col("h")) * F.sin(F.radians("lat"))
    p = t.ground_points.select("gp_id", x.alias("x"), y.alias("y"), z.alias("z"))
    lon, lat, h = to.ecef_to_geodetic(F.col("x"), F.col("y"), F.col("z"))
    return p.select("gp_id", F.round(F.degrees(lon), 8).alias("lon"), F.round(F.degrees(lat), 8).alias("lat"), F.round(h, 4).alias("h"))


@query("s21_earth_to_inertial", """WITH e AS (SELECT *, t*0.01 AS a FROM ephemeris) SELECT t, round(px*cos(a) - py*sin(a), 5) AS x, round(px*sin(a) + py*cos(a), 5) AS y, round(vx*cos(a) - vy*sin(a) - (2*pi()/86164.09054)*(px*sin(a) + py*cos(a)), 5) AS u, round(vx*sin(a) + vy*cos(a) + (2*pi()/86164.09054)*(px*cos(a) - py*sin(a)), 5) AS v, round(px, 5) AS back_x, round(vy, 5) AS back_v FROM e""")
def s21(t):
    zero, angle = F.lit(0.0), F.col("t") * 0.01
    p, v = to.earth_to_inertial(angle, [F.col("px"), F.col("py"), zero], [F.col("vx"), F.col("vy"), zero])
    bp, bv = to.inertial_to_earth(angle, p, v)
    return t.ephemeris.select("t", *[F.round(c, 5).alias(n) for n, c in (("x", p[0]), ("y", p[1]), ("u", v[0]), ("v", v[1]), ("back_x", bp[0]), ("back_v", bv[1]))])


@query("s24b_look_angle", "SELECT point_id, round(0.01 + floor(col + 0.7)*1e-5 + pow(floor(col + 0.7), 2)*1e-9 - pow(floor(col + 0.7), 3)*1e-13, 12) AS psi FROM image_points")
def s24b(t):
    return t.image_points.select("point_id", F.round(to.look_angle(F.array(*[F.lit(c) for c in (0.01, 1e-5, 1e-9, -1e-13)]), F.col("col") + 0.7), 12).alias("psi"))


@query("s25_rpc", """SELECT gcp_id, round(0.5*(1 + 2*y + 3*x + x*x)/(1 + 0.1*x*y), 9) AS samp, round(act_x/0.5, 9) AS full_x FROM (SELECT gcp_id, act_x, act_x/4096 AS x, act_y/4096 AS y FROM gcps)""")
def s25(t):
    unit = lambda *at: F.array(*[F.lit(float(dict(at).get(i, 0.0))) for i in range(20)])
    lat, lon = F.col("act_x") / 4096, F.col("act_y") / 4096
    ratio = to.rational(unit((0, 1), (1, 2), (2, 3), (8, 1)), unit((0, 1), (4, 0.1)), to.rpc_terms(lat, lon, F.lit(0.0)))
    return t.gcps.select("gcp_id", F.round(to.rpc_decimate(ratio, 0.5), 9).alias("samp"), F.round(to.rpc_decimate(F.col("act_x"), 0.5, outward=False), 9).alias("full_x"))


@query("a5_bias_fit", """SELECT image_id, round(regr_slope(act_x - est_x, act_x), 9) AS factor_x, round(regr_intercept(act_x - est_x, act_x), 6) AS bias_x, round(regr_slope(act_y - est_y, act_y), 9) AS factor_y, round(regr_intercept(act_y - est_y, act_y), 6) AS bias_y FROM gcps GROUP BY image_id""")
def a5(t):
    return to.bias_fit(t.gcps).select("image_id", Q("factor_x"), Q("bias_x", 6), Q("factor_y"), Q("bias_y", 6))


@query("j6_bracket", """WITH n AS (SELECT *, lead(t) OVER (ORDER BY t) AS t1, lead(px) OVER (ORDER BY t) AS px1 FROM ephemeris), l AS (SELECT max(t) AS t FROM ephemeris)
SELECT p.point_id, round(n.px + (n.px1 - n.px)*(p.t*1.05 - n.t)/(n.t1 - n.t), 6) AS px, round(coalesce(n.px + (n.px1 - n.px)*(p.t*1.05 - n.t)/(n.t1 - n.t), (SELECT px FROM ephemeris e JOIN l ON e.t = l.t)), 6) AS clamped FROM image_points p LEFT JOIN n ON p.t*1.05 >= n.t AND p.t*1.05 < n.t1""")
def j6(t):
    at = F.col("t") * 1.05
    return on_orbit(t).select("point_id", F.round(to.bracket(F.col("nodes"), at, "px"), 6).alias("px"), F.round(to.bracket(F.col("nodes"), at, "px", clamp=True), 6).alias("clamped"))


@query("j7_lagrange", """WITH n AS (SELECT *, row_number() OVER (ORDER BY t) - 1 AS i FROM ephemeris), c AS (SELECT count(*) AS c FROM n),
p AS (SELECT point_id, t, (SELECT count(*) FROM n WHERE n.t < q.t) AS s FROM image_points q), v AS (SELECT p.* FROM p, c WHERE p.t >= (SELECT t FROM n WHERE i = 4) AND p.t < (SELECT t FROM n, c WHERE i = c.c - 4)),
w AS (SELECT point_id, v.t, a.px, a.i, product(CASE WHEN b.i = a.i THEN 1 ELSE (v.t - b.t)/(CASE WHEN b.i = a.i THEN 1 ELSE a.t - b.t END) END) AS k FROM v JOIN n a ON a.i BETWEEN v.s - 4 AND v.s + 3 JOIN n b ON b.i BETWEEN v.s - 4 AND v.s + 3 GROUP BY 1, 2, 3, 4),
r AS (SELECT point_id, round(sum(px*k), 4) AS px FROM w GROUP BY 1) SELECT point_id, r.px FROM image_points LEFT JOIN r USING (point_id)""")
def j7(t):
    return on_orbit(t).select("point_id", F.round(to.lagrange(F.col("nodes"), F.col("t"), "px", 0.001), 4).alias("px"))


@query("j8_hermite")
def j8(t):
    return states(t).select("point_id", "t", "px", "vx", "py", "vy")


def states(t, points=None):
    """Points (t and others; image points, if none are given) with the platform's position and velocity at their time."""
    points = t.image_points if points is None else points
    state = to.hermite(F.col("nodes"), F.col("t"), {"px": "vx", "py": "vy"})
    on = points.withColumn("orbit", F.lit(0)).join(F.broadcast(orbit(t)), "orbit")
    return on.select(*points.columns, state.alias("s")).select(*points.columns, "s.*")


def _vectors(pdf):
    zero = np.zeros(len(pdf))
    return np.stack([pdf["px"], pdf["py"], zero], 1).astype(float), np.stack([pdf["vx"], pdf["vy"], zero + 7.0], 1).astype(float)


def located(df):
    """Ground positions of points with a range."""

    def compute(pdf):
        p, v = _vectors(pdf)
        xyz, status = sensors.sar_locate(p, v, pdf["slant"].to_numpy(float), np.zeros(len(pdf)), pdf["h"].to_numpy(float), 0.0566)
        return {"gx": xyz[:, 0], "gy": xyz[:, 1], "gz": xyz[:, 2], "status": status.astype(np.int32)}

    return sensors.over_batches(df, {"gx": "double", "gy": "double", "gz": "double", "status": "int"}, compute, [c for c in df.columns])


def nutated(t: str) -> str:
    """SQL of both nutation angles of the days in a table."""
    angle = lambda k: f"({to.ANGLES[k][0]} + d*({to.ANGLES[k][1]} + d*({to.ANGLES[k][2]})))"
    args = [" + ".join(f"{m}*{angle(k)}" for k, m in enumerate(row[:5]) if m) for row in to.NUTATION]
    psi = " + ".join(f"({row[5]})*sin({arg})" for row, arg in zip(to.NUTATION, args, strict=True))
    eps = " + ".join(f"({row[6]})*cos({arg})" for row, arg in zip(to.NUTATION, args, strict=True))
    return f"SELECT *, ({psi})*sin({to.OBLIQUITY}) AS n, {eps} AS e FROM {t}"


@query("s21_nutation", f"""WITH g AS (SELECT *, t*CAST(0.01 AS DOUBLE) AS a, CAST(2451545.0 - 2451540.5 AS DOUBLE) + t AS d FROM ephemeris), m AS ({nutated("g")}),
r AS (SELECT *, cos(a)*cos(n) - sin(a)*sin(e)*sin(n) AS p11, sin(a)*cos(e) AS p12, -sin(a)*cos(n) - cos(a)*sin(e)*sin(n) AS p21, cos(a)*cos(e) AS p22, cos(e)*sin(n) AS p31, sin(e) AS p32 FROM m),
k AS (SELECT *, p11*px + p12*py AS x, p21*px + p22*py AS y FROM r)
SELECT t, round(x, 5) AS x, round(y, 5) AS y, round(p31*px + p32*py, 5) AS z, round(p11*vx + p12*vy + 2*pi()/86164.09054*y, 5) AS u, round(p21*vx + p22*vy - 2*pi()/86164.09054*x, 5) AS v, round(p31*vx + p32*vy, 5) AS w, round(px, 5) AS back_x, round(vy, 5) AS back_v FROM k""")
def s21_nutation(t):
    zero, angle, psi, eps = F.lit(0.0), F.col("t") * 0.01, F.col("psi"), F.col("eps")
    days = t.ephemeris.withColumns(dict(zip(("psi", "eps"), to.nutation(F.col("t") + 2451545.0), strict=True)))
    p, v = to.mean_inertial_to_earth(angle, psi, eps, [F.col("px"), F.col("py"), zero], [F.col("vx"), F.col("vy"), zero])
    e = days.select("t", "psi", "eps", *[c.alias(n) for n, c in zip("xyzuvw", [*p, *v], strict=True)])
    bp, bv = to.earth_to_mean_inertial(angle, psi, eps, [F.col(c) for c in "xyz"], [F.col(c) for c in "uvw"])
    return e.select("t", *[F.round(c, 5).alias(c) for c in "xyzuvw"], F.round(bp[0], 5).alias("back_x"), F.round(bv[1], 5).alias("back_v"))


@query("s22_sar_locate")
def s22(t):
    one = F.lit(1.0)
    slant = to.slant_range(F.col("col"), F.lit(MODEL["ref_range"]), F.lit(MODEL["ref_col"]), one, one, F.lit(MODEL["rate"]))
    return located(states(t).withColumn("slant", slant)).select("point_id", "gx", "gy", "gz", "status")


def model_forward(pdf, s, l):
    """A sensor's longitude and latitude: a quadratic in sample and line, different for each image."""
    k = pdf["image_id"].to_numpy(float)
    return 10 + k + 1e-4 * s + 2e-6 * l + 1e-10 * s * l, 40 - k + 3e-6 * s - 1.1e-4 * l + 2e-10 * s * s


@query("s23_ground_to_image", "SELECT point_id, round(col, 3) AS samp, round(line, 3) AS line FROM image_points")
def s23(t):
    def compute(pdf):
        target = np.stack(model_forward(pdf, pdf["col"].to_numpy(float), pdf["line"].to_numpy(float)), 1)
        at, _ = sensors.invert(model_forward, pdf, target, np.full((len(pdf), 2), 2048.0), 1.0, 1e-6, 30)
        return {"samp": at[:, 0], "found_line": at[:, 1]}

    out = sensors.over_batches(t.image_points, {"samp": "double", "found_line": "double"}, compute, ["point_id"])
    return out.select("point_id", F.round("samp", 3).alias("samp"), F.round("found_line", 3).alias("line"))


GRIDS = "SELECT CAST(floor((gy - 1)/50) AS INT) AS image_id, CAST(gx AS INT) AS gx, CAST((gy - 1) % 50 AS INT) AS gy, lon, lat FROM swath_grid WHERE gy IN (SELECT gy FROM swath_grid GROUP BY gy HAVING count(*) = 40)"


@query("s23_grid_search", f"""WITH g AS ({GRIDS}), s AS (SELECT image_id, max(gy) AS n FROM g GROUP BY 1 HAVING max(gy) > 0),
p AS (SELECT point_id, CAST(point_id % 8 AS INT) AS image_id, col/4096*50 - 5 + 0.0123456 AS u, line/4096*(n + 4) - 2 + 0.0171456 AS v, n FROM image_points JOIN s ON s.image_id = point_id % 8)
SELECT image_id, point_id, CASE WHEN u > 0 AND u < 39 AND v > 0 AND v < n THEN round(u, 4) END AS samp, CASE WHEN u > 0 AND u < 39 AND v > 0 AND v < n THEN round(v, 4) END AS line FROM p""")
def s23_grid(t):
    """Places in and around grids of positions over the date line, 50 rows an image, as the cell that each lies in."""
    full = t.swath_grid.groupBy("gy").agg(F.count(F.lit(1)).alias("n")).filter("n = 40").select("gy")
    grids = t.swath_grid.join(full, "gy").select(F.floor((F.col("gy") - 1) / 50).cast("int").alias("image_id"), "gx", ((F.col("gy") - 1) % 50).cast("int").alias("gy"), "lon", "lat")
    sizes = grids.groupBy("image_id").agg(F.max("gy").alias("last")).filter("last > 0")
    at = t.image_points.withColumn("image_id", (F.col("point_id") % 8).cast("int")).join(sizes, "image_id")
    u, v = F.col("col") / 4096 * 50 - 5 + 0.0123456, F.col("line") / 4096 * (F.col("last") + 4) - 2 + 0.0171456
    row = v + 1 + F.col("image_id") * 50
    lon, lat = F.lit(178.5) + u * 0.05 + row * 0.002, F.lit(10.0) + row * 0.05 + u * 0.001
    places = at.select("image_id", "point_id", F.when(lon > 180, lon - 360).otherwise(lon).alias("lon"), lat.alias("lat"))
    return sensors.place_in_grids(places, grids).select("image_id", "point_id", F.round("samp", 4).alias("samp"), F.round("line", 4).alias("line"))


def pushed(df):
    """Ground positions by a push-broom sensor with small attitude angles and column look angles psi."""

    def compute(pdf):
        p, v = _vectors(pdf)
        att = np.stack([1e-3 * np.sin(pdf["t"]), 1e-3 * np.cos(pdf["t"]), np.full(len(pdf), 1e-4)], 1)
        u = sensors.pushbroom_ray(p, v, att, pdf["psi"].to_numpy(float), 0.1 * pdf["psi"].to_numpy(float))
        g = sensors.meet_ellipsoid(p, u, pdf["h"].to_numpy(float))
        return {"gx": g[:, 0], "gy": g[:, 1], "gz": g[:, 2], "ux": u[:, 0], "uy": u[:, 1], "uz": u[:, 2]}

    return sensors.over_batches(df, {c: "double" for c in ("gx", "gy", "gz", "ux", "uy", "uz")}, compute, list(df.columns))


def looks(t):
    return states(t).withColumn("psi", to.look_angle(F.array(*[F.lit(c) for c in (-0.02, 1e-5, 0.0, 0.0)]), F.col("col")))


@query("s24_pushbroom")
def s24(t):
    return pushed(looks(t)).select("point_id", "gx", "gy", "gz")


@coarse.Formula
def bent(image_id, x, y):
    """Places by a model with a ripple whose strength goes with the image."""
    k = (image_id % 5).cast("double")
    lon = F.lit(20.0) + x * 0.0005 + F.sin(x / 400.0) * k * 0.002 + y * 0.00005
    return lon, F.lit(45.0) - y * 0.0005 + F.cos(y / 300.0) * k * 0.001 + x * 0.00002


def coarse_sql() -> str:
    """The cells of the coarse grids of ``bent`` by recursion."""
    lon = lambda x, y: f"(20.0::DOUBLE + {x} * 0.0005::DOUBLE + sin({x} / 400.0::DOUBLE) * k * 0.002::DOUBLE + {y} * 0.00005::DOUBLE)"
    lat = lambda x, y: f"(45.0::DOUBLE - {y} * 0.0005::DOUBLE + cos({y} / 300.0::DOUBLE) * k * 0.001::DOUBLE + {x} * 0.00002::DOUBLE)"
    at = {n: (f"(x0 + {dx / 2}::DOUBLE * side)", f"(y0 + {dy / 2}::DOUBLE * side)") for n, (dx, dy) in (coarse.CORNERS | coarse.TESTS).items()}
    points = ", ".join(f"{lon(*xy)} AS p_{n}, {lat(*xy)} AS q_{n}" for n, xy in at.items())
    between = {"c": ("00", "10", "01", "11"), "n": ("00", "10"), "s": ("01", "11"), "w": ("00", "01"), "e": ("10", "11")}
    mean = lambda c, n: f"(({' + '.join(f'{c}_{k}' for k in between[n])}) / {len(between[n])})"
    slopes = ", ".join(f"({mean(c, hi)} - {mean(c, lo)}) / side AS {c}{d}" for c in "pq" for d, lo, hi in (("x", "w", "e"), ("y", "n", "s")))
    off = lambda n: f"sqrt(pow((p_{n} - {mean('p', n)}) * qy - (q_{n} - {mean('q', n)}) * py, 2) + pow(px * (q_{n} - {mean('q', n)}) - qx * (p_{n} - {mean('p', n)}), 2)) / abs(px * qy - qx * py)"
    error = lambda source: f"SELECT *, greatest({', '.join(map(off, coarse.TESTS))}) AS error FROM (SELECT *, {slopes} FROM (SELECT *, {points} FROM {source}))"
    return f"""WITH RECURSIVE i AS (SELECT image_id, width, height, CAST(image_id % 5 AS DOUBLE) AS k FROM rects),
c(image_id, width, height, k, x0, y0, side) AS (SELECT image_id, width, height, k, 256.0::DOUBLE * p, 256.0::DOUBLE * q, 256.0::DOUBLE FROM i, range(0, 40) a(p), range(0, 40) b(q) WHERE p < greatest(1, ceil((width - 1) / 256.0)) AND q < greatest(1, ceil((height - 1) / 256.0))
UNION ALL SELECT image_id, width, height, k, x0 + dx * side / 2, y0 + dy * side / 2, side / 2 FROM ({error("c")}) e, (VALUES (0, 0), (1, 0), (0, 1), (1, 1)) s(dx, dy) WHERE error > 0.1 AND side > 1 AND x0 + dx * side / 2 <= greatest(width - 1, 1) AND y0 + dy * side / 2 <= greatest(height - 1, 1))
SELECT image_id, CAST(side AS INT) AS side, count(*) AS n_cells, round(max(error), 6) AS largest_error FROM ({error("c")}) WHERE error <= 0.1 GROUP BY 1, 2"""


@query("s23_coarse_grid", coarse_sql())
def s23_coarse(t):
    """Coarse grids of images with models of their own: cells by size, and the largest error of each size in pixels."""
    cells = coarse.coarse_cells(t.rects.select("image_id", "width", "height"), bent)
    return cells.groupBy("image_id", F.col("side").cast("int").alias("side")).agg(F.count(F.lit(1)).alias("n_cells"), F.round(F.max("error"), 6).alias("largest_error"))


@query("s23_coarse_inversion", """SELECT point_id, image_id, round(x, 1) AS x, round(y, 1) AS y FROM (SELECT o_orderkey AS point_id, s_suppkey AS image_id, CAST(o_orderkey * 7919 % (width - 1) AS DOUBLE) AS x, CAST(o_orderkey * 104729 % (height - 1) AS DOUBLE) AS y
FROM orders JOIN supplier ON s_suppkey = o_orderkey % 100 + 1 JOIN rects ON image_id = s_suppkey WHERE s_suppkey % 5 = 0)""")
def s23_inversion(t):
    """Places of pixels, found again through the coarse grids; those of models without a ripple, which interpolation meets."""
    sizes = t.rects.select("image_id", "width", "height").filter("image_id % 5 = 0")
    cells = materialize(coarse.coarse_cells(sizes, bent), "coarse-cells")
    at = t.orders.withColumn("image_id", (F.col("o_orderkey") % 100 + 1).cast("long")).join(sizes, "image_id")
    at = at.select(F.col("o_orderkey").alias("point_id"), "image_id", (F.col("o_orderkey") * 7919 % (F.col("width") - 1)).cast("double").alias("x"), (F.col("o_orderkey") * 104729 % (F.col("height") - 1)).cast("double").alias("y"))
    places = bent(at).select("point_id", "image_id", "lon", "lat")
    return coarse.pixels_of(places, cells, ["point_id", "image_id"], 0.125).select("point_id", "image_id", F.round("x", 1).alias("x"), F.round("y", 1).alias("y"))


@query("p7_sar_geolocation")
def p7(t):
    b = to.bias_fit(t.gcps)
    s = states(t).join(F.broadcast(b), "image_id", "left")  # a row for each image
    col = to.unbias(F.col("col"), F.coalesce("factor_x", F.lit(0.0)), F.coalesce("bias_x", F.lit(0.0)))
    one = F.lit(1.0)
    linear = to.slant_range(col, F.lit(MODEL["ref_range"]), F.lit(MODEL["ref_col"]), one, one, F.lit(MODEL["rate"]))
    sets = to.nearest_set(dated(t), coefficient_sets(t)).select("point_id", "coefs")
    s = s.withColumn("c", col).withColumn("linear", linear).join(sets, "point_id")
    s = s.withColumn("slant", F.when(F.col("image_id") % 2 == 0, F.col("linear")).otherwise(to.srgr_slant_range(F.col("coefs"), F.col("c") * 12.5)))
    g = located(s.select("point_id", "image_id", "px", "py", "vx", "vy", "slant", "h"))
    lon, lat, h = to.ecef_to_geodetic(F.col("gx"), F.col("gy"), F.col("gz"))
    return g.select("point_id", "image_id", F.degrees(lon).alias("lon"), F.degrees(lat).alias("lat"), F.round(h, 3).alias("height"), "status")


