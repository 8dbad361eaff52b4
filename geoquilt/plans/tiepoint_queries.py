"""Queries on tie points and descriptors."""

from __future__ import annotations

from pyspark.sql import functions as F

from geoquilt.operators import tiepoints as tp
from geoquilt.plans.catalog import query

SETTINGS = tp.FilterSettings()
ACTIVE = "a AS (SELECT tile_id, tp_id, match_rank, dx, dy, confidence FROM matches QUALIFY row_number() OVER (PARTITION BY tp_id ORDER BY match_rank) = 1)"
TOP10 = "c AS (SELECT * FROM a QUALIFY row_number() OVER (PARTITION BY tile_id ORDER BY confidence DESC, tp_id) <= 10)"
STATS = """
o AS (SELECT tile_id, avg(dy - 0.5 * dx) AS o FROM a GROUP BY tile_id),
d AS (SELECT a.*, abs(o + 0.5 * dx - dy) / sqrt(1.25) AS distance FROM a JOIN o USING (tile_id)),
s AS (SELECT tile_id, count(*) AS n, sqrt(sum(distance * distance) / (count(*) - 1)) AS sigma FROM d GROUP BY tile_id),
l AS (SELECT s.*, o, greatest(coalesce(sigma, 0), 2.0) AS max_distance FROM s JOIN o USING (tile_id))"""
NEAREST = """
p AS (SELECT a.tile_id, a.vec_id AS id_a, b.vec_id AS id_b, list_sum(list_transform(range(1, 65), lambda i : pow(CAST(a.embedding[i] AS DOUBLE) - CAST(b.embedding[i] AS DOUBLE), 2))) AS d2
  FROM descriptors a JOIN descriptors b ON a.tile_id = b.tile_id AND a.image_id = 0 AND b.image_id = 1),
n AS (SELECT tile_id, id_a, id_b, sqrt(d2) AS distance FROM p)"""


def actives(t):
    return tp.active(t.matches)


def spread(t):
    """All candidates, in tiles that grow in number with the table and hold 40 points at most."""
    return t.matches.withColumn("tile_id", F.floor(F.col("tp_id") / 40).cast("long"))


def sides(t):
    d = t.descriptors
    return d.filter("image_id = 0"), d.filter("image_id = 1")


@query("tie_point_quality", f"""WITH {ACTIVE}, {STATS},
k AS (SELECT d.* FROM d JOIN l USING (tile_id) WHERE distance <= max_distance QUALIFY row_number() OVER (PARTITION BY tile_id ORDER BY confidence DESC, tp_id) <= 2)
SELECT tile_id, count(*) AS n, round(avg(dx), 9) AS mean_dx, round(avg(dy), 9) AS mean_dy, round(stddev_pop(dx), 9) AS sigma_dx, round(stddev_pop(dy), 9) AS sigma_dy FROM k GROUP BY tile_id""")
def flagship(t):
    kept = tp.top_points(tp.within_parallax(actives(t), 2.0, 1.0, 1.0, 2.0), 2)
    stats = [F.round(f(c), 9).alias(f"{n}_{c}") for n, f in (("mean", F.avg), ("sigma", F.stddev_pop)) for c in ("dx", "dy")]
    return kept.groupBy("tile_id").agg(F.count(F.lit(1)).alias("n"), *stats)


@query("s27_residual", """SELECT tp_id, match_rank, round(sqrt(dx*dx + dy*dy), 9) AS length, round(CASE WHEN degrees(atan2(dx, -dy)) < 0 THEN degrees(atan2(dx, -dy)) + 360 ELSE degrees(atan2(dx, -dy)) END, 9) AS azimuth FROM matches""")
def s27(t):
    return tp.residuals(t.matches).select("tp_id", "match_rank", F.round("length", 9).alias("length"), F.round("azimuth", 9).alias("azimuth"))


@query("s30_drop_unmatched", "SELECT tp_id, count(*) AS n_matches FROM matches WHERE confidence >= 0.95 GROUP BY tp_id")
def s30(t):
    lists = t.matches.groupBy("tp_id").agg(F.expr("collect_list(match_rank) FILTER (WHERE confidence >= 0.95)").alias("matches"))
    return tp.drop_unmatched(lists).select("tp_id", F.size("matches").cast("long").alias("n_matches"))


@query("a6_residual_stats", "SELECT count(*) AS n, round(avg(dx), 9) AS mean_dx, round(stddev_pop(dx), 9) AS sigma_dx, round(avg(dy), 9) AS mean_dy, round(stddev_pop(dy), 9) AS sigma_dy FROM matches")
def a6(t):
    return t.matches.agg(F.count(F.lit(1)).alias("n"), *[F.round(f(c), 9).alias(f"{n}_{c}") for c in ("dx", "dy") for n, f in (("mean", F.avg), ("sigma", F.stddev_pop))])


@query("a7_parallax_stats", f"WITH {ACTIVE}, {STATS} SELECT tile_id, n, round(o, 9) AS line_offset, round(sigma, 9) AS sigma, round(max_distance, 9) AS max_distance FROM l")
def a7(t):
    out = tp.parallax_statistics(actives(t), 2.0, 1.0, 1.0, 2.0)
    return out.select("tile_id", "n", *[F.round(c, 9).alias(c) for c in ("line_offset", "sigma", "max_distance")])


CONSISTENT = """
p AS (SELECT x.tile_id, x.tp_id, y.tp_id AS tp2, sqrt(x.dx*x.dx + x.dy*x.dy) AS r0, sqrt(y.dx*y.dx + y.dy*y.dy) AS r1, sqrt(pow(y.dx - x.dx, 2) + pow(y.dy - x.dy, 2)) AS diff, x.dx*y.dx + x.dy*y.dy AS dot FROM c x LEFT JOIN c y ON x.tile_id = y.tile_id AND x.tp_id <> y.tp_id),
q AS (SELECT tile_id, tp_id, count(*) FILTER (diff < 3.0 OR (2*abs(r1-r0)/(r0+r1) < 0.1 AND (CASE WHEN r0 > 0 AND r1 > 0 THEN dot/(r0*r1) ELSE 1.0 END) > cos(radians(10)))) AS consistent, count(tp2) AS neighbours FROM p GROUP BY tile_id, tp_id)
SELECT *, CAST(greatest(ceil(50.0*neighbours/100), 1) AS BIGINT) AS needed, consistent >= greatest(ceil(50.0*neighbours/100), 1) AS passes FROM q"""


@query("a8_consistency", f"WITH {ACTIVE}, {TOP10},{CONSISTENT}")
def a8(t):
    return tp.consistency(tp.top_points(actives(t), SETTINGS.features_per_tile), SETTINGS)


@query("a8_consistency_all", f"WITH {ACTIVE}, c AS (SELECT * REPLACE (tp_id // 40 AS tile_id) FROM a),{CONSISTENT}")
def a8_all(t):
    """Every tie point is tested; a8_consistency keeps the cap that its SQL has."""
    return tp.consistency(tp.active(spread(t)), SETTINGS)


@query("a20_strength", f"""WITH {NEAREST}, b AS (SELECT * FROM n QUALIFY row_number() OVER (PARTITION BY id_a ORDER BY distance, id_b) <= 1),
m AS (SELECT tile_id, max(distance) AS m FROM b GROUP BY tile_id) SELECT tile_id, id_a, id_b, round(CASE WHEN m > 0 THEN 1 - distance/m ELSE 1.0 END, 9) AS strength FROM b JOIN m USING (tile_id)""")
def a20(t):
    return tp.strengths(tp.descriptor_matches(*sides(t), 1)).select("tile_id", "id_a", "id_b", F.round("strength", 9).alias("strength"))


@query("w1_prune", f"WITH {ACTIVE} SELECT * FROM a QUALIFY row_number() OVER (PARTITION BY tile_id ORDER BY confidence DESC, tp_id) <= 2")
def w1(t):
    return tp.top_points(actives(t), SETTINGS.points_per_tile)


@query("w2_bump", f"WITH {ACTIVE} SELECT m.tile_id, m.tp_id, m.match_rank, m.dx, m.dy, m.confidence FROM matches m JOIN a USING (tp_id) WHERE a.confidence >= 0.97 OR m.match_rank > a.match_rank QUALIFY row_number() OVER (PARTITION BY m.tp_id ORDER BY m.match_rank) = 1")
def w2(t):
    given_up = actives(t).filter("confidence < 0.97").select("tp_id", F.col("match_rank").alias("given_up"))
    return tp.active(t.matches, given_up)


@query("w3_best_matches", "SELECT tile_id, tp_id, dx, dy, confidence, CAST(rn AS INT) AS match_rank FROM (SELECT *, row_number() OVER (PARTITION BY tile_id, tp_id ORDER BY confidence DESC, match_rank) AS rn FROM matches WHERE confidence >= 0.95) WHERE rn <= 3")
def w3(t):
    return tp.best_matches(t.matches, 0.95, SETTINGS.matches_per_feature)


@query("w9_filter_without_parallax")
def w9(t):
    return tp.filter_without_parallax(spread(t), SETTINGS)


@query("w10_filter_with_parallax")
def w10(t):
    return tp.filter_with_parallax(spread(t), 2.0, 1.0, SETTINGS)


@query("u1_append", "SELECT tp_id, dx, dy, false AS is_reverse FROM matches UNION ALL SELECT tp_id, -dx, -dy, true FROM matches")
def u1(t):
    m = t.matches.select("tp_id", "dx", "dy", F.lit(False).alias("is_reverse"))
    return m.unionByName(m.select("tp_id", (-F.col("dx")).alias("dx"), (-F.col("dy")).alias("dy"), F.lit(True).alias("is_reverse")))


def located(t):
    """Active points with the ground positions that two image geometries give them."""
    geometry = t.rects.select(F.col("image_id"), (F.col("gsd_deg") * 10.0).alias("gsd"), (F.col("y0") / 100.0).alias("lat0"), (F.col("x0") / 100.0).alias("lon0"))
    images = geometry.agg(F.count(F.lit(1)).alias("images"))
    p = actives(t).join(F.broadcast(images)).withColumn("image_a", F.col("tp_id") % F.col("images") + 1)
    a = geometry.select(*[F.col(c).alias(f"{c}_a") for c in geometry.columns]).withColumnRenamed("image_id_a", "image_a")
    return p.join(a, "image_a").select(
        "tp_id", "image_a", F.col("lat0_a").alias("lat_a"), F.col("lon0_a").alias("lon_a"), (F.col("lat0_a") - F.col("dy") * F.col("gsd_a")).alias("lat_b"), (F.col("lon0_a") + F.col("dx") * F.col("gsd_a")).alias("lon_b")
    )


J13 = f"""WITH {ACTIVE}, g AS (SELECT image_id, gsd_deg * 10.0 AS gsd, y0 / 100.0 AS la, x0 / 100.0 AS lo FROM rects),
p AS (SELECT a.*, a.tp_id % (SELECT count(*) FROM rects) + 1 AS image_a FROM a),
q AS (SELECT tp_id, image_a, la, lo, la - dy*gsd AS lb, lo + dx*gsd AS ob FROM p JOIN g ON image_a = image_id),
r AS (SELECT *, pow(sin(radians(lb-la)/2), 2) + cos(radians(la))*cos(radians(lb))*pow(sin(radians(ob-lo)/2), 2) AS h FROM q)"""


@query("j13_ground_distance", f"{J13} SELECT tp_id, image_a, round(2*6371000.0*asin(sqrt(least(1.0, h))), 6) AS distance FROM r")
def j13(t):
    return tp.ground_residual(located(t)).select("tp_id", "image_a", F.round("distance", 6).alias("distance"))


@query("p8_quality_report", f"{J13} SELECT image_a, count(*) AS n, round(avg(2*6371000.0*asin(sqrt(least(1.0, h)))), 6) AS mean, round(stddev_pop(2*6371000.0*asin(sqrt(least(1.0, h)))), 6) AS sigma FROM r GROUP BY image_a")
def p8(t):
    return tp.ground_residual(located(t)).groupBy("image_a").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("distance"), 6).alias("mean"), F.round(F.stddev_pop("distance"), 6).alias("sigma"))


@query("j9_descriptor_knn", f"WITH {NEAREST} SELECT tile_id, id_a, id_b, round(distance, 9) AS distance, CAST(rank AS INT) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY id_a ORDER BY distance, id_b) AS rank FROM n) WHERE rank <= 3")
def j9(t):
    return tp.descriptor_matches(*sides(t), 3).withColumn("distance", F.round("distance", 9))


@query("j9_descriptor_knn_l1", """WITH p AS (SELECT a.tile_id, a.vec_id AS id_a, b.vec_id AS id_b, list_sum(list_transform(range(1, 65), lambda i : abs(CAST(a.embedding[i] AS DOUBLE) - CAST(b.embedding[i] AS DOUBLE)))) AS distance
  FROM descriptors a JOIN descriptors b ON a.tile_id = b.tile_id AND a.image_id = 0 AND b.image_id = 1)
SELECT tile_id, id_a, id_b, round(distance, 9) AS distance FROM p QUALIFY row_number() OVER (PARTITION BY id_a ORDER BY distance, id_b) = 1""")
def j9_l1(t):
    return tp.descriptor_matches(*sides(t), 1, "l1").select("tile_id", "id_a", "id_b", F.round("distance", 9).alias("distance"))


@query("j9_descriptor_knn_hamming", """WITH p AS (SELECT a.tile_id, a.vec_id AS id_a, b.vec_id AS id_b, list_sum(list_transform(range(1, 65), lambda i : CASE WHEN (a.embedding[i] > 0) <> (b.embedding[i] > 0) THEN 1 ELSE 0 END)) AS distance
  FROM descriptors a JOIN descriptors b ON a.tile_id = b.tile_id AND a.image_id = 0 AND b.image_id = 1)
SELECT tile_id, id_a, id_b, CAST(distance AS INT) AS distance FROM p QUALIFY row_number() OVER (PARTITION BY id_a ORDER BY distance, id_b) = 1""")
def j9_hamming(t):
    bits = lambda d: d.withColumn("embedding", F.transform("embedding", lambda v: (v > 0).cast("int")))
    a, b = sides(t)
    return tp.descriptor_matches(bits(a), bits(b), 1, "hamming").select("tile_id", "id_a", "id_b", F.col("distance").cast("int").alias("distance"))


@query("j9_descriptor_lsh")
def j9_lsh(t):
    a, b = sides(t)
    return tp.approximate_matches(a, b, 3, 4.0, 8, 1e9)


CROSS = f"""WITH {NEAREST}, f AS (SELECT * FROM n QUALIFY row_number() OVER (PARTITION BY id_a ORDER BY distance, id_b) = 1), g AS (SELECT * FROM n QUALIFY row_number() OVER (PARTITION BY id_b ORDER BY distance, id_a) = 1),
x AS (SELECT f.* FROM f JOIN g ON f.id_a = g.id_a AND f.id_b = g.id_b)"""


def crossed(t):
    a, b = sides(t)
    return tp.cross_check(tp.descriptor_matches(a, b, 1), tp.descriptor_matches(b, a, 1))


@query("j10_mutual_nearest", f"{CROSS} SELECT tile_id, id_a, id_b, round(distance, 9) AS distance FROM x")
def j10(t):
    return crossed(t).select("tile_id", "id_a", "id_b", F.round("distance", 9).alias("distance"))


@query("t1_cap_features", f"{CROSS} SELECT tile_id, id_a, id_b FROM x QUALIFY row_number() OVER (PARTITION BY tile_id ORDER BY distance, id_a) <= 10")
def t1(t):
    return tp.cap_features(tp.strengths(crossed(t)), "strength", SETTINGS.features_per_tile, "id_a").select("tile_id", "id_a", "id_b")


@query("t2_global_best", f"{CROSS} SELECT id_a, id_b, round(distance, 9) AS distance FROM x WHERE distance < 3 * (SELECT min(distance) FROM x) ORDER BY distance, id_a, id_b LIMIT 30")
def t2(t):
    return tp.global_best(crossed(t), 3.0, 30).select("id_a", "id_b", F.round("distance", 9).alias("distance"))


@query("k6_layered_settings", f"WITH {ACTIVE} SELECT tile_id, tp_id FROM a WHERE confidence >= 0.93 QUALIFY row_number() OVER (PARTITION BY tile_id ORDER BY confidence DESC, tp_id) <= 3")
def k6(t):
    algorithm, request = {"points_per_tile": 5, "features_per_tile": 20}, {"points_per_tile": 3}
    settings = tp.FilterSettings().with_overrides(algorithm, request)
    return tp.top_points(actives(t).filter("confidence >= 0.93"), settings.points_per_tile).select("tile_id", "tp_id")
