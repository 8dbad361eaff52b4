"""Connected components of a graph by alternating stars: no group is gathered, only minima and joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geoquilt.sources.shared import materialize

#: Nodes whose minima (two numbers each) are sent to all tasks at most.
SENT = 300_000


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("x", "y").cast("decimal(38,0)"))).first())


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root) for every node of an edge, root being the smallest node that is connected to it.

    Each round lets a node's larger neighbours, then its smaller ones, hang on to its smallest; it ends when all hang on
    to roots. Rounds go with the logarithm of the longest chain. Minima are combined before they are shuffled. They are
    sent to all tasks while the counted nodes are few; beyond that the joins meet written tables, so a node with very
    many neighbours is split.
    """
    lo, hi = F.least(a, b).alias("y"), F.greatest(a, b).alias("x")
    now = materialize(edges.select(hi, lo).filter("x <> y").distinct(), "edges")
    state, nodes = _state(now), None
    while state[0]:
        both = now.unionByName(now.select(F.col("y").alias("x"), F.col("x").alias("y")))
        least = materialize(both.groupBy("x").agg(F.least(F.min("y"), F.first("x")).alias("m")), "least")
        if nodes is None:
            nodes = least.count()  # later rounds have the same ones
        sent = F.broadcast if nodes <= SENT else lambda df: df
        large = both.join(sent(least), "x").filter("y > x").select(F.col("y").alias("x"), F.col("m").alias("y"))
        large = materialize(large, "large")
        least = materialize(large.groupBy("x").agg(F.min("y").alias("m")), "least")
        small = large.join(sent(least), "x").filter("y <> m").select(F.col("y").alias("x"), F.col("m").alias("y"))
        new = materialize(small.unionByName(least.select("x", F.col("m").alias("y"))).distinct(), "edges")
        was, state = state, _state(new)
        now = new
        if state == was:
            break
    return now.select(F.col("x").alias("node"), F.col("y").alias("root")).unionByName(now.select(F.col("y").alias("node"), F.col("y").alias("root")).distinct())


def cycles(after: DataFrame) -> DataFrame:
    """(node, ring, seq) of nodes on closed paths, given as (node, next), each node being the next of one: ``ring`` is the
    smallest node of a path, ``seq`` counts from it. Places come from jumps of doubling length back to the start, so there are as many
    rounds as the longest path has binary digits and no path is gathered."""
    after = materialize(after.select("node", "next"), "next-nodes")
    # a path of one node has no edge between two, so it is no component
    roots = components(after, "node", "next").select("node", F.col("root").alias("ring"))
    back = after.select(F.col("next").alias("node"), F.col("node").alias("to")).join(roots, "node", "left").withColumn("ring", F.coalesce("ring", "node"))
    first = F.col("node") == F.col("ring")
    now = materialize(back.select("node", "ring", F.when(first, F.col("node")).otherwise(F.col("to")).alias("to"), F.when(first, 0).otherwise(1).cast("long").alias("seq")), "places")
    while now.filter("to <> ring").limit(1).count():
        there = now.select(F.col("node").alias("to"), F.col("to").alias("to2"), F.col("seq").alias("seq2"))
        now = materialize(now.join(there, "to").select("node", "ring", F.col("to2").alias("to"), (F.col("seq") + F.col("seq2")).alias("seq")), "places")
    return now.select("node", "ring", "seq")
