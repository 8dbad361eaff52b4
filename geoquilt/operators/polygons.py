"""Polygons of any shape: what two have in common, rings in order, and which ring lies in which.

A polygon is an array of rings, each an array of vertices (x, y), the first not repeated at the end. The inside is at the left
hand of every edge (y upwards): outlines run counterclockwise, holes clockwise. A polygon may have several outlines; rings of
one polygon may touch in corners but don't cross. All pairs are worked on in one job; edges meet through cells of a grid
and through lines of it, never each with each, so a polygon's edges are spread over tasks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from geoquilt.operators.graph import cycles
from geoquilt.sources.shared import materialize

#: What counts as nothing of an edge's length, or of the product of two lengths.
NEAR = 1e-12
END = ("ax", "ay", "bx", "by")


def edges_of(polygons: DataFrame, rings: str = "rings") -> DataFrame:
    """The other columns, and ring, edge (its place in the ring), ax, ay, bx, by; edges without a length are left out."""
    keep = [c for c in polygons.columns if c != rings]
    r = polygons.select(*keep, F.posexplode(rings).alias("ring", "_v"))
    after = F.concat(F.slice("_v", 2, F.greatest(F.size("_v") - 1, F.lit(0))), F.slice("_v", 1, 1))
    e = r.select(*keep, "ring", F.posexplode(F.arrays_zip(F.col("_v").alias("a"), after.alias("b"))).alias("edge", "e"))
    e = e.select(*keep, "ring", "edge", F.col("e.a.x").alias("ax"), F.col("e.a.y").alias("ay"), F.col("e.b.x").alias("bx"), F.col("e.b.y").alias("by"))
    return e.filter("ax <> bx OR ay <> by")


def bins(lo: Column, hi: Column, size: float) -> Column:
    return F.sequence(F.floor(lo / size), F.floor(hi / size))


def crossings(a: DataFrame, b: DataFrame, keys: list[str], size: float) -> DataFrame:
    """Where edges of ``a`` and ``b`` (keys, ring, edge, END) meet: keys, side (0 or 1), ring, edge, at (from 0 to 1), x, y.

    Both edges of a crossing get the same coordinates; an edge's end that lies on the other edge is the point itself. Edges
    that run along each other meet in their ends."""

    def celled(df: DataFrame, s: str) -> DataFrame:
        own = df.select(*keys, *[F.col(c).alias(f"{c}_{s}") for c in ("ring", "edge", *END)])
        ends = {c: (F.least(f"a{c}_{s}", f"b{c}_{s}"), F.greatest(f"a{c}_{s}", f"b{c}_{s}")) for c in "xy"}
        own = own.withColumns({f"c{c}_{s}": F.floor(ends[c][0] / size) for c in "xy"})
        return own.withColumn("cell_x", F.explode(bins(*ends["x"], size))).withColumn("cell_y", F.explode(bins(*ends["y"], size)))

    j = celled(a, "0").join(celled(b, "1"), [*keys, "cell_x", "cell_y"])
    j = j.filter((F.col("cell_x") == F.greatest("cx_0", "cx_1")) & (F.col("cell_y") == F.greatest("cy_0", "cy_1")))
    p = lambda s, e, c: F.col(f"{e}{c}_{s}")
    d = {(s, c): p(s, "b", c) - p(s, "a", c) for s in "01" for c in "xy"}
    apart = {c: p("1", "a", c) - p("0", "a", c) for c in "xy"}
    cross = lambda ux, uy, vx, vy: ux * vy - uy * vx
    length = {s: F.sqrt(d[s, "x"] ** 2 + d[s, "y"] ** 2) for s in "01"}
    j = j.withColumn("_det", cross(d["0", "x"], d["0", "y"], d["1", "x"], d["1", "y"]))
    slanted = F.abs("_det") > NEAR * length["0"] * length["1"]
    along = lambda s: F.when(slanted, cross(apart["x"], apart["y"], d[s, "x"], d[s, "y"]) / F.col("_det"))
    snap = lambda t: F.when(F.abs(t) < NEAR, 0.0).when(F.abs(t - 1) < NEAR, 1.0).otherwise(t)
    j = j.withColumns({"_t": snap(along("1")), "_u": snap(along("0"))})
    meets = F.col("_t").between(0.0, 1.0) & F.col("_u").between(0.0, 1.0)

    def point(c: str) -> Column:
        exact = F.when(F.col("_t") == 0, p("0", "a", c)).when(F.col("_t") == 1, p("0", "b", c)).when(F.col("_u") == 0, p("1", "a", c)).when(F.col("_u") == 1, p("1", "b", c))
        return exact.otherwise(p("0", "a", c) + F.col("_t") * d["0", c])

    one = lambda side, at, x, y: F.struct(F.lit(int(side)).alias("side"), F.col(f"ring_{side}").alias("ring"), F.col(f"edge_{side}").alias("edge"), at.alias("at"), x.alias("x"), y.alias("y"))
    both = F.when(meets, F.array(one("0", F.col("_t"), point("x"), point("y")), one("1", F.col("_u"), point("x"), point("y"))))
    off = F.abs(cross(apart["x"], apart["y"], d["0", "x"], d["0", "y"])) <= NEAR * length["0"] * F.greatest(length["0"], length["1"])

    def on(side: str, other: str) -> Column:
        """Ends of the other edge on this one, where both lie on one line."""
        place = lambda e: ((p(other, e, "x") - p(side, "a", "x")) * d[side, "x"] + (p(other, e, "y") - p(side, "a", "y")) * d[side, "y"]) / length[side] ** 2
        return F.filter(F.array(*[one(side, place(e), p(other, e, "x"), p(other, e, "y")) for e in "ab"]), lambda s: s["at"].between(0.0, 1.0))

    found = F.when(slanted, both).when(off, F.concat(on("0", "1"), on("1", "0")))
    return j.select(*keys, F.inline(found))


def cut_edges(edges: DataFrame, points: DataFrame, keys: list[str]) -> DataFrame:
    """Edges (keys, side, ring, edge, END) cut at points (at, x, y) on them: keys, side, ring, END of each piece."""
    at = lambda t, x, y: F.struct(F.lit(t).alias("at"), F.col(x).alias("x"), F.col(y).alias("y"))
    own = [*keys, "side", "ring", "edge"]
    ends = edges.select(*own, F.inline(F.array(at(0.0, "ax", "ay"), at(1.0, "bx", "by"))))
    lists = ends.unionByName(points.select(*own, "at", "x", "y")).groupBy(*own).agg(F.sort_array(F.collect_set(F.struct("at", "x", "y"))).alias("p"))
    pieces = F.arrays_zip(F.slice("p", 1, F.size("p") - 1).alias("a"), F.slice("p", 2, F.size("p") - 1).alias("b"))
    out = lists.select(*keys, "side", "ring", F.explode(pieces).alias("e"))
    return out.select(*keys, "side", "ring", F.col("e.a.x").alias("ax"), F.col("e.a.y").alias("ay"), F.col("e.b.x").alias("bx"), F.col("e.b.y").alias("by")).filter("ax <> bx OR ay <> by")


def inside(points: DataFrame, edges: DataFrame, keys: list[str], own: list[str], size: float, by: list[str] | None = None) -> DataFrame:
    """The ``own`` columns of points (keys, x, y) that lie inside the polygons of ``edges`` (keys, END): a line from the point
    to the right crosses an odd number of edges. ``by``: columns of edges, such as a ring, that are asked each for itself."""
    by = list(by or [])
    e = edges.filter("ay <> by").select(*keys, *by, *[F.col(c).alias(f"_{c}") for c in END])
    e = e.withColumn("bin", F.explode(bins(F.least("_ay", "_by"), F.greatest("_ay", "_by"), size)))
    p = points.select(*dict.fromkeys([*keys, *own]), F.col("x").alias("_x"), F.col("y").alias("_y")).withColumn("bin", F.floor(F.col("_y") / size))
    at = F.col("_ax") + (F.col("_y") - F.col("_ay")) / (F.col("_by") - F.col("_ay")) * (F.col("_bx") - F.col("_ax"))
    crosses = ((F.col("_ay") > F.col("_y")) != (F.col("_by") > F.col("_y"))) & (F.col("_x") < at)
    hits = p.join(e, [*keys, "bin"]).filter(crosses).groupBy(*dict.fromkeys([*keys, *own]), *by).agg(F.count(F.lit(1)).alias("_n"))
    return hits.filter("_n % 2 = 1").drop("_n")


def overlap_edges(pairs: DataFrame, polygons: DataFrame, size: float) -> DataFrame:
    """The outline of what the polygons (id, rings) of each pair (id_a, id_b) have in common, as edges id_a, id_b, END, the
    inside at their left hand. ``size``: the grid's cells, about the length of an edge."""
    keys = ["id_a", "id_b"]
    rings = polygons.select("id", "rings")
    sides = [edges_of(pairs.select(*keys).join(rings, F.col(f"id_{s}") == F.col("id")).select(*keys, "rings")) for s in "ab"]
    edges = materialize(sides[0].withColumn("side", F.lit(0)).unionByName(sides[1].withColumn("side", F.lit(1))), "polygon-edges")
    a, b = (edges.filter(F.col("side") == s).drop("side") for s in (0, 1))
    pieces = cut_edges(edges, crossings(a, b, keys, size), keys)
    # pieces that both have go both one way, and stay once, or go opposite ways, and bound nothing
    first, last = (F.struct(F.col(x).alias("x"), F.col(y).alias("y")) for x, y in (("ax", "ay"), ("bx", "by")))
    pieces = pieces.withColumns({"low": F.least(first, last), "high": F.greatest(first, last), "forward": first < last})
    same = pieces.groupBy(*keys, "low", "high").agg(F.min("side").alias("least"), F.max("side").alias("most"), F.min("forward").alias("f0"), F.max("forward").alias("f1"))
    one, two = F.when(F.col("f1"), F.col("low")).otherwise(F.col("high")), F.when(F.col("f1"), F.col("high")).otherwise(F.col("low"))
    same = materialize(same, "pieces").withColumns({"ax": one["x"], "ay": one["y"], "bx": two["x"], "by": two["y"]})
    shared = same.filter("least <> most AND f0 = f1").select(*keys, *END)
    alone = same.filter("least = most")
    out = shared
    for side, other in ((0, b), (1, a)):
        mine = alone.filter(F.col("least") == side).withColumns({"x": (F.col("ax") + F.col("bx")) / 2, "y": (F.col("ay") + F.col("by")) / 2})
        out = out.unionByName(inside(mine, other, keys, list(END), size).select(*keys, *END))
    return out


def overlap_areas(pairs: DataFrame, polygons: DataFrame, size: float) -> DataFrame:
    """(id_a, id_b, area) of what the polygons of a pair have in common, from the edges of its outline alone: no rings are walked."""
    return overlap_edges(pairs, polygons, size).groupBy("id_a", "id_b").agg(F.sum(signed_area()).alias("area"))


def ring_walks(edges: DataFrame, keys: list[str]) -> DataFrame:
    """Edges (keys, END) with the inside at their left as closed rings: keys, ring, seq from 0, x, y, and the edge's other end
    bx, by. Where rings touch, an edge goes on by the sharpest turn to the left, so each stays with its own inside. A ring begins at
    its smallest vertex by y, then x; its number has no meaning."""
    e = materialize(edges.select(*keys, *END).distinct().withColumn("node", F.monotonically_increasing_id()), "outline-edges")
    n = e.select(*keys, F.col("ax").alias("bx"), F.col("ay").alias("by"), F.col("bx").alias("nx"), F.col("by").alias("ny"), F.col("node").alias("next"))
    ux, uy, vx, vy = F.col("bx") - F.col("ax"), F.col("by") - F.col("ay"), F.col("nx") - F.col("bx"), F.col("ny") - F.col("by")
    turn = F.atan2(ux * vy - uy * vx, ux * vx + uy * vy)
    turn = F.when(turn > 3.141592, -turn).otherwise(turn)  # straight back is the last choice
    after = e.join(n, [*keys, "bx", "by"]).groupBy("node").agg(F.max_by("next", turn).alias("next"))
    placed = materialize(e.join(cycles(after), "node").select(*keys, "ring", "seq", F.col("ax").alias("x"), F.col("ay").alias("y"), "bx", "by"), "ring-walks")
    start = placed.groupBy("ring").agg(F.min_by("seq", F.struct("y", "x")).alias("_start"), F.count(F.lit(1)).alias("_n"))
    return placed.join(start, "ring").select(*keys, "ring", F.pmod(F.col("seq") - F.col("_start"), F.col("_n")).alias("seq"), "x", "y", "bx", "by")


def signed_area(ax: str = "ax", ay: str = "ay", bx: str = "bx", by: str = "by") -> Column:
    """An edge's share of the area that a ring encloses; sums are negative for holes."""
    return (F.col(ax) * F.col(by) - F.col(bx) * F.col(ay)) / 2


def nested(walks: DataFrame, keys: list[str], size: float) -> DataFrame:
    """(keys, ring, area, outer): for each hole of ``walks`` the smallest outline around it; ``outer`` of an outline is itself."""
    rings = materialize(walks.groupBy(*keys, "ring").agg(F.sum(signed_area("x", "y")).alias("area"), F.min_by(F.struct(((F.col("x") + F.col("bx")) / 2).alias("x"), ((F.col("y") + F.col("by")) / 2).alias("y")), "seq").alias("p")), "rings")
    holes = rings.filter("area < 0").select(*keys, F.col("ring").alias("hole"), "area", "p.x", "p.y")
    outlines = rings.filter("area >= 0").select("ring", F.col("area").alias("_area"))
    e = walks.withColumnsRenamed({"x": "ax", "y": "ay"}).join(outlines, "ring")
    around = inside(holes, e, keys, ["hole", "area"], size, ["ring", "_area"]).groupBy(*keys, "hole", "area").agg(F.min_by("ring", F.struct("_area", "ring")).alias("outer"))
    return rings.filter("area >= 0").select(*keys, "ring", "area", F.col("ring").alias("outer")).unionByName(around.select(*keys, F.col("hole").alias("ring"), "area", "outer"))


def overlaps(pairs: DataFrame, polygons: DataFrame, size: float) -> DataFrame:
    """(id_a, id_b, rings, area): a polygon for each outline of what a pair has in common, its first ring, then its holes."""
    keys = ["id_a", "id_b"]
    walks = materialize(ring_walks(overlap_edges(pairs, polygons, size), keys), "overlap-rings")
    tree = nested(walks, keys, size)
    lists = walks.groupBy("ring").agg(F.transform(F.sort_array(F.collect_list(F.struct("seq", "x", "y"))), lambda v: F.struct(v["x"].alias("x"), v["y"].alias("y"))).alias("v"))
    parts = tree.join(lists, "ring").groupBy(*keys, "outer")
    return parts.agg(F.sort_array(F.collect_list(F.struct((F.col("ring") != F.col("outer")).alias("hole"), "v"))).alias("r"), F.sum("area").alias("area")).select(*keys, F.col("r.v").alias("rings"), "area")
