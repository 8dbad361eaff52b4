"""Approximate nearest neighbours with a hierarchical navigable small-world graph for each shard.

Equal vectors collapse to one node with its smallest ids, as more than the answer's length of them can't be in an answer.
Distinct vectors are dealt to shards by a hash; a task builds a shard's graph: every node gets a random level, nodes are
inserted in batches that search the graph so far together, and links are chosen so that no linked neighbour is nearer to
another than to the node. A shard is stored as one row of flat arrays: vectors, neighbours of each layer, levels, ids.
Queries go to every shard in blocks; a shard answers with exact distances in double precision on the original vectors,
and a window keeps the nearest over all shards.

Vectors that are null, empty, zero, or hold null or non-finite components take no part; vectors meet those of their own
length alone. Ties go to the smaller id. Rows with a null id take no part; rows that repeat id and vector count once. An id
with several vectors is a candidate with each, and as a query gets an answer for each, never with its own id. Graphs are
of single precision, scores of the vectors as they came. Column names of the input don't matter but for the two that are
named. An empty table gives an empty table. Recall against brute force is measured in the tests.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from geoquilt.llm.common import materialize

LINKS, BUILD_BEAM, SEARCH_BEAM, BATCH, STEP = 16, 64, 96, 128, 4
QUERIES_PER_BLOCK = 8192
#: Rows of a shard: a 1024th of all, within these bounds, so that shards grow with the input until they fill a task's memory.
LEAST_ROWS, MOST_ROWS = 4096, 65_536


def squared(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Squared distances of the rows x[i, j] to q[i]."""
    return np.maximum((x * x).sum(-1) - 2 * np.einsum("ijd,id->ij", x, q) + (q * q).sum(-1)[:, None], 0)


def beam(x: np.ndarray, links: np.ndarray, q: np.ndarray, start: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(nodes, squared distances), nearest first, that a search of one layer from ``start`` finds for each query; -1: none."""
    n, rows = len(q), np.arange(len(q))[:, None]
    width = max(width, start.shape[1])
    ids = np.full((n, width), -1, np.int64)
    ids[:, : start.shape[1]] = start
    dist = np.full((n, width), np.inf, np.float32)
    dist[:, : start.shape[1]] = np.where(start >= 0, squared(x[start], q), np.inf)
    opened = ids < 0
    seen = np.zeros((n, len(x) + 1), bool)  # the last column takes the -1
    seen[rows, ids] = True
    go = np.arange(n)
    while len(go):
        ranked = np.where(opened[go], np.inf, dist[go])
        best = np.argpartition(ranked, STEP - 1, axis=1)[:, :STEP] if width > STEP else np.argsort(ranked, axis=1)[:, :STEP]
        open_now = np.take_along_axis(ranked, best, 1) < np.inf
        some = open_now.any(axis=1)
        go, best, open_now = go[some], best[some], open_now[some]
        if not len(go):
            break
        nodes = np.where(open_now, ids[go[:, None], best], -1)
        opened[go[:, None], best] = True
        near = np.where(nodes[:, :, None] >= 0, links[nodes], -1).reshape(len(go), -1)
        near[seen[go[:, None], near]] = -1
        # a node that two opened ones share is taken once
        near = np.sort(near, axis=1)
        near[:, 1:][near[:, 1:] == near[:, :-1]] = -1
        seen[go[:, None], near] = True
        far = np.where(near >= 0, squared(x[near], q[go]), np.inf).astype(np.float32)
        all_ids, all_dist = np.concatenate([ids[go], near], 1), np.concatenate([dist[go], far], 1)
        all_open = np.concatenate([opened[go], near < 0], 1)
        keep = np.argpartition(all_dist, width - 1, axis=1)[:, :width]
        ids[go], dist[go], opened[go] = (np.take_along_axis(a, keep, 1) for a in (all_ids, all_dist, all_open))
    order = np.lexsort((ids, dist), axis=1)
    ids, dist = np.take_along_axis(ids, order, 1), np.take_along_axis(dist, order, 1)
    ids[np.isinf(dist)] = -1
    return ids, dist


def choose(x: np.ndarray, ids: np.ndarray, dist: np.ndarray, most: int) -> np.ndarray:
    """Of each row's candidates, nearest first, those that are nearer to the row's node than to any chosen before; then the nearest others."""
    n, c = ids.shape
    v = x[ids]
    norms = (v * v).sum(-1)
    between = norms[:, :, None] + norms[:, None, :] - 2 * (v @ v.transpose(0, 2, 1))
    taken, count = np.zeros((n, c), bool), np.zeros(n, np.int64)
    closest = np.full((n, c), np.inf, np.float32)  # distance of each candidate to the nearest that was taken
    for j in range(c):
        good = (ids[:, j] >= 0) & (dist[:, j] < closest[:, j]) & (count < most)
        taken[good, j] = True
        count += good
        closest = np.where(good[:, None], np.minimum(closest, between[:, :, j]), closest)
    rank = np.where(ids < 0, 2 * c, np.where(taken, 0, c) + np.arange(c))
    order = np.argsort(rank, axis=1, kind="stable")[:, :most]
    out = np.take_along_axis(ids, order, 1)
    if out.shape[1] < most:
        out = np.concatenate([out, np.full((n, most - out.shape[1]), -1, np.int64)], 1)
    return out


def connect(x: np.ndarray, links: np.ndarray, new: np.ndarray, ids: np.ndarray, dist: np.ndarray) -> None:
    """Link new nodes to the best of their candidates, and these back, at most as many as the layer's arrays hold."""
    most = links.shape[1]
    links[new] = choose(x, ids, dist, most)
    a, b = np.repeat(new, most), links[new].ravel()
    a, b = a[b >= 0], b[b >= 0]
    order = np.argsort(b, kind="stable")
    a, b = a[order], b[order]
    nodes, first, counts = np.unique(b, return_index=True, return_counts=True)
    for at in range(0, len(nodes), 1024):
        us, fs, cs = nodes[at : at + 1024], first[at : at + 1024], counts[at : at + 1024]
        width = int(cs.max())
        extra = np.full((len(us), width), -1, np.int64)
        column = np.arange(width)[None] < cs[:, None]
        extra[column] = a[(fs[:, None] + np.arange(width)[None])[column]]
        every = np.sort(np.concatenate([links[us], extra], 1), axis=1)
        every[:, 1:][every[:, 1:] == every[:, :-1]] = -1
        far = np.where(every >= 0, squared(x[every], x[us]), np.inf).astype(np.float32)
        order = np.argsort(far, axis=1, kind="stable")
        links[us] = choose(x, np.take_along_axis(every, order, 1), np.take_along_axis(far, order, 1), most)


def build(x: np.ndarray, seed: int) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """(neighbours of each layer from 0 up, level of each node, nodes to start from)."""
    n = len(x)
    rng = np.random.default_rng(seed)
    level = np.minimum((-np.log(1 - rng.random(n)) / math.log(LINKS)).astype(np.int64), 6)
    order = np.concatenate([[int(level.argmax())], np.delete(np.arange(n), level.argmax())])  # the top node first
    top = int(level[order[0]])
    layers = [np.full((n, LINKS * (2 if k == 0 else 1)), -1, np.int64) for k in range(top + 1)]
    done = 1
    while done < n:
        new = order[done : done + min(BATCH, max(1, done))]
        q, start = x[new], np.full((len(new), 1), order[0], np.int64)
        for k in range(top, -1, -1):
            here = level[new] >= k
            if not here.any():
                start = beam(x, layers[k], q, start, 1)[0][:, :1]
                continue
            ids, dist = beam(x, layers[k], q, start, BUILD_BEAM)
            start = ids[:, :8] if k else ids
            peers = new[here]
            mates = np.broadcast_to(peers, (len(peers), len(peers))).copy()
            np.fill_diagonal(mates, -1)
            mate_dist = np.where(mates >= 0, squared(x[mates], q[here]), np.inf).astype(np.float32)
            all_ids, all_dist = np.concatenate([ids[here], mates], 1), np.concatenate([dist[here], mate_dist], 1)
            best = np.argsort(all_dist, axis=1, kind="stable")[:, :BUILD_BEAM]
            connect(x, layers[k], peers, np.take_along_axis(all_ids, best, 1), np.take_along_axis(all_dist, best, 1))
        done += len(new)
    # a part of layer 0 that nothing leads to gets a starting node of its own
    reached, starts = np.zeros(n, bool), []
    for root in order:
        if not reached[root]:
            starts.append(root)
            front = np.array([root])
            reached[root] = True
            while len(front):
                near = np.unique(layers[0][front])
                front = near[(near >= 0)]
                front = front[~reached[front]]
                reached[front] = True
    return layers, level, np.array(starts, np.int64)


def search(x: np.ndarray, layers: list[np.ndarray], starts: np.ndarray, q: np.ndarray, width: int) -> np.ndarray:
    """Nodes near each query."""
    start = np.full((len(q), 1), starts[0], np.int64)
    for k in range(len(layers) - 1, 0, -1):
        start = beam(x, layers[k], q, start, 4)[0]
    first = np.concatenate([start, np.broadcast_to(starts[1:], (len(q), len(starts) - 1))], 1)
    first = np.sort(first, axis=1)
    first[:, 1:][first[:, 1:] == first[:, :-1]] = -1
    return beam(x, layers[0], q, first, width)[0]


def usable(vec: Column) -> Column:
    finite = F.forall(vec, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    return vec.isNotNull() & F.coalesce(finite & F.exists(vec, lambda v: v != 0), F.lit(False))


INDEX = "dim int, shard int, vectors binary, layers array<binary>, starts binary, ids binary"


def index(vectors: DataFrame, most_ids: int, rows_per_shard: int | None = None) -> DataFrame:
    """One row for each shard; ``vectors``: vec_id, vec, usable ones."""
    kind = kind_of(vectors)
    same = Window.partitionBy("vec").orderBy("vec_id")
    kept = vectors.withColumn("rank", F.row_number().over(same)).filter(F.col("rank") <= most_ids)
    nodes = kept.groupBy("vec").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
    nodes = materialize(nodes.withColumn("dim", F.size("vec")), "nodes")
    rows = F.lit(rows_per_shard) if rows_per_shard else F.least(F.lit(MOST_ROWS), F.greatest(F.lit(LEAST_ROWS), F.ceil(F.count(F.lit(1)) / 1024)))
    shards = materialize(nodes.groupBy("dim").agg(F.ceil(F.count(F.lit(1)) / rows).cast("int").alias("shards")), "shards")
    tasks = int(shards.agg(F.sum("shards")).first()[0] or 1)
    dealt = nodes.join(shards, "dim").select("dim", F.pmod(F.xxhash64("vec"), F.col("shards")).cast("int").alias("shard"), "vec", "ids")

    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("ids", key=lambda s: s.map(lambda v: v[0]))  # whichever way the rows came
        vectors = np.stack(pdf["vec"].to_numpy()).astype(kind)
        x = vectors.astype(np.float32)
        ids = np.full((len(x), most_ids), -1, np.int64)
        for i, v in enumerate(pdf["ids"]):
            ids[i, : len(v)] = v
        layers, _, starts = build(x, int(key[1]))
        return pd.DataFrame([[int(key[0]), int(key[1]), vectors.tobytes(), [a.astype(np.int32).tobytes() for a in layers], starts.tobytes(), ids.tobytes()]], columns=["dim", "shard", "vectors", "layers", "starts", "ids"])

    # building takes far longer than reading, so there are as many tasks as shards
    return materialize(dealt.repartition(tasks, "dim", "shard").groupBy("dim", "shard").applyInPandas(run, INDEX), "index")


def kind_of(vectors: DataFrame) -> type:
    """The numpy type of the elements of ``vec``."""
    return np.float32 if isinstance(vectors.schema["vec"].dataType.elementType, T.FloatType) else np.float64


def answers(x: np.ndarray, ids: np.ndarray, found: np.ndarray, q: np.ndarray, own: np.ndarray, asked: np.ndarray, k: int) -> Iterator[tuple[int, int, int, float]]:
    """(query's id, query, id, distance) of the k nearest rows of the found nodes, other than the query's own."""
    for i, nodes in enumerate(found):
        nodes = nodes[nodes >= 0]
        dist = np.sqrt(((x[nodes].astype(np.float64) - q[i].astype(np.float64)) ** 2).sum(1))
        rows, far = ids[nodes].ravel(), np.repeat(dist, ids.shape[1])
        good = (rows >= 0) & (rows != own[i])
        rows, far = rows[good], far[good]
        for j in np.lexsort((rows, far))[:k]:
            yield int(own[i]), int(asked[i]), int(rows[j]), float(far[j])


def nearest(vectors: DataFrame, queries: DataFrame, vec_id: str = "vec_id", vec: str = "embedding", k: int = 10, rows_per_shard: int | None = None, width: int = SEARCH_BEAM) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row of ``queries`` its k nearest rows of ``vectors`` by Euclidean distance."""
    single = all(isinstance(df.schema[vec].dataType.elementType, T.FloatType) for df in (vectors, queries))
    cast = "array<float>" if single else "array<double>"
    plain = lambda df: df.select(df[vec_id].cast("long").alias("vec_id"), df[vec].cast(cast).alias("vec")).filter(F.col("vec_id").isNotNull() & usable(F.col("vec"))).distinct()
    kind = np.float32 if single else np.float64
    graph = index(plain(vectors), k + 1, rows_per_shard)
    asked = materialize(plain(queries).withColumn("dim", F.size("vec")).withColumn("query", F.monotonically_increasing_id()), "queries")
    blocks = max(1, math.ceil(asked.count() / QUERIES_PER_BLOCK))
    shards = graph.select(F.col("dim").alias("of_dim"), F.col("shard").alias("to_shard"))
    tasks = max(1, graph.count() * blocks)
    by_block = graph.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))).repartition(tasks, "dim", "shard", "block")
    sent = asked.select("*", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int").alias("to_block")).join(F.broadcast(shards), F.col("dim") == F.col("of_dim"))  # a row for each shard
    sent = sent.repartition(tasks, "of_dim", "to_shard", "to_block")

    def run(key: tuple, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out: list[tuple[int, int, int, float]] = []
        if len(left) and len(right):
            g, dim = left.iloc[0], int(left.iloc[0]["dim"])
            exact = np.frombuffer(g["vectors"], kind).reshape(-1, dim)
            x = exact.astype(np.float32)
            ids = np.frombuffer(g["ids"], np.int64).reshape(len(x), -1)
            layers = [np.frombuffer(a, np.int32).reshape(len(x), -1).astype(np.int64) for a in g["layers"]]
            starts = np.frombuffer(g["starts"], np.int64)
            for at in range(0, len(right), BATCH):
                part = right.iloc[at : at + BATCH]
                q, own = np.stack(part["vec"].to_numpy()).astype(kind), part["vec_id"].to_numpy()
                out += answers(exact, ids, search(x, layers, starts, q.astype(np.float32), width), q, own, part["query"].to_numpy(), k)
        return pd.DataFrame(out, columns=["query_id", "query", "vec_id", "score"])

    found = by_block.groupBy("dim", "shard", "block").cogroup(sent.groupBy("of_dim", "to_shard", "to_block")).applyInPandas(run, "query_id long, query long, vec_id long, score double")
    rank = F.row_number().over(Window.partitionBy("query_id", "query").orderBy("score", "vec_id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
