"""Near duplicates by fast similarity sketching, banding and exact verification.

A sketch has ``bins`` coordinates, filled in rounds: in round i below ``bins``, every shingle hashes to one bin and a
value, and a bin that earlier rounds left empty takes the smallest value that lands in it; rounds from ``bins`` on visit
one bin each with all shingles. So every coordinate is filled by the shingles themselves after at most ``2 * bins``
rounds, usually two or three, coordinates of two sketches agree with the probability of the sets' Jaccard similarity, and
their number concentrates as with independent samples.

Texts with equal sets collapse to one class first. Classes whose sketches agree in a whole band belong to one family;
families are cut into blocks, and each pair of blocks of a family is compared on full sets by products of incidence
matrices, from which only a spanning forest of the links leaves the task. Every link is confirmed on the full sets, whose
members are 64-bit hashes of shingles (see ``shingles``). A pair above the threshold is with the probability that no band agrees, ``(1 - s**rows) ** bands``, unless its family meets otherwise. A family of n
different texts costs n * n / 2 set comparisons, spread over tasks by pairs of blocks; copies cost nothing.

Null and empty texts, or texts without words, have no shingles and stand alone. Rows that repeat an id and text are
answered each; different texts of one id are linked each for itself. Null ids are answered with a null component and kept.
Of a component whose smallest id stands at several texts, the one with the smallest hash is chosen. Very long texts are
sketched and compared whole. An empty table gives an empty table; column names of the input don't matter.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geoquilt.llm.common import broadcast_if_small, materialize, slices
from geoquilt.operators.graph import components
from geoquilt.llm.shingles import mix, shingle_sets

#: Texts of a block, its bytes of text, the matrix columns that are multiplied at a time, and rows of a task.
BLOCK, BLOCK_BYTES, COLUMNS, ROWS_PER_TASK = 128, 2 << 20, 1 << 15, 512
SALTS = mix(np.arange(1, 4097, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def sketches(sets: list[np.ndarray], bins: int) -> np.ndarray:
    """A row of ``bins`` 64-bit coordinates for each set; the empty set has none filled."""
    n = len(sets)
    out = np.full(n * bins, np.iinfo(np.uint64).max, np.uint64)
    sizes = np.array([len(s) for s in sets], np.int64)
    items, owner = (np.concatenate(sets) if n else np.zeros(0, np.uint64)), np.repeat(np.arange(n), sizes)
    for i in range(2 * bins):
        if not len(items):
            break
        h = mix(items ^ SALTS[i])
        at = ((h >> np.uint64(32)) * np.uint64(bins) >> np.uint64(32)).astype(np.int64) if i < bins else np.full(len(items), i - bins)
        # the round stands in the leading bits, so bins that earlier rounds filled stay as they are
        np.minimum.at(out, owner * bins + at, (np.uint64(i) << np.uint64(53)) | (mix(h) >> np.uint64(11)))
        open_sets = (out.reshape(n, bins) == np.iinfo(np.uint64).max).any(axis=1)
        go = open_sets[owner]
        items, owner = items[go], owner[go]
    return out.reshape(n, bins)


def band_keys(sketch: np.ndarray, bands: int, rows: int) -> np.ndarray:
    keys = np.repeat(np.arange(1, bands + 1, dtype=np.uint64)[None], len(sketch), 0)
    cut = sketch.reshape(len(sketch), bands, rows)
    for j in range(rows):
        keys = mix(keys * np.uint64(0x9E3779B97F4A7C15) + cut[:, :, j])
    return keys.view(np.int64)


def features(docs: DataFrame, doc_id: str, text: str, k: int, bands: int, rows: int) -> DataFrame:
    """(id, text_hash, n_shingles, digest of the set, a key for each band)."""
    names = ["id", "text_hash", "n_shingles", "digest", "keys"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, n in slices(batch.column(2), 1 << 20):
                part = batch.slice(at, n)
                sets = shingle_sets(part.column(2), k)
                keys = band_keys(sketches(sets, bands * rows), bands, rows)
                digests = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets]
                flat = pa.ListArray.from_arrays(pa.array(np.arange(len(sets) + 1, dtype=np.int32) * bands), pa.array(keys.ravel()))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array([len(s) for s in sets], pa.int64()), pa.array(digests, pa.binary()), flat], names=names)

    return with_hash(docs, doc_id, text).mapInArrow(run, "id long, text_hash long, n_shingles long, digest binary, keys array<long>")


def with_hash(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(id, text_hash, text)"""
    rows = docs.select(docs[doc_id].cast("long").alias("id"), docs[text].cast("string").alias("text"))
    return rows.select("id", F.xxhash64("text").alias("text_hash"), "text")


def linked(left: list[np.ndarray], right: list[np.ndarray] | None, percent: int) -> np.ndarray:
    """Which sets of ``left`` have 100 * intersection >= percent * union with which of ``right`` (None: of left)."""
    sets = left + (right or [])
    sizes = np.array([len(s) for s in sets], np.int64)
    values, at = np.unique(np.concatenate(sets), return_inverse=True)
    seen = np.bincount(at, minlength=len(values))
    shared = seen > 1  # what one set alone has is in no intersection
    column = np.cumsum(shared) - 1
    owner = np.repeat(np.arange(len(sets)), sizes)
    keep = shared[at]
    owner, at = owner[keep], column[at[keep]]
    order = np.argsort(at, kind="stable")
    owner, at = owner[order], at[order]
    n, total = len(left), np.zeros((len(left), len(right) if right is not None else len(left)), np.int64)
    for c in range(0, int(shared.sum()), COLUMNS):
        a, b = np.searchsorted(at, [c, c + COLUMNS])
        matrix = np.zeros((len(sets), min(COLUMNS, int(shared.sum()) - c)), np.float32)
        matrix[owner[a:b], at[a:b] - c] = 1
        total += (matrix[:n] @ (matrix[:n] if right is None else matrix[n:]).T).astype(np.int64)
    other = sizes[:n] if right is None else sizes[n:]
    return 100 * total >= percent * (sizes[:n, None] + other[None] - total)


def forest(link: np.ndarray, rows: np.ndarray, cols: np.ndarray) -> list[tuple[int, int]]:
    """Edges that connect what the links between ``rows`` and ``cols`` connect."""
    out, todo = [], np.ones(len(rows), bool)
    free = np.ones(len(cols), bool)
    for i in range(len(rows)):
        if not todo[i]:
            continue
        todo[i] = False
        front = np.array([i])
        while len(front):
            hit = np.flatnonzero(link[front].any(axis=0) & free)
            free[hit] = False
            out += [(int(rows[i]), int(cols[j])) for j in hit if rows[i] != cols[j]]
            front = np.flatnonzero(link[:, hit].any(axis=1) & todo) if len(hit) else hit
            todo[front] = False
            out += [(int(rows[i]), int(rows[j])) for j in front]
    return out


def links_within(family: DataFrame, k: int, percent: int) -> DataFrame:
    """(a, b): links that connect each family's texts as all its links do. ``family``: family, node, text."""
    sized = family.withColumn("bytes", F.octet_length("text"))
    sizes = sized.groupBy("family").agg(F.count(F.lit(1)).alias("n"), F.greatest(F.ceil(F.count(F.lit(1)) / F.lit(BLOCK)), F.ceil(F.sum("bytes") / F.lit(BLOCK_BYTES))).cast("int").alias("blocks"))
    sizes = materialize(sizes.withColumn("blocks", F.greatest("blocks", F.lit(1))), "family-blocks")
    tasks = max(1, math.ceil((sizes.agg(F.sum(F.col("n") * F.col("blocks"))).first()[0] or 0) / ROWS_PER_TASK))
    placed = family.join(sizes.drop("n"), "family").withColumn("block", F.pmod(F.xxhash64("node", F.lit(3)), F.col("blocks")).cast("int"))
    pairs = placed.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    pairs = pairs.select("family", "node", "text", "block", F.least("block", "with").alias("i"), F.greatest("block", "with").alias("j"))

    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        _, i, j = key
        sides = [pdf] if i == j else [pdf[pdf["block"] == i], pdf[pdf["block"] == j]]
        if not all(len(s) for s in sides) or len(pdf) < 2:
            return pd.DataFrame({"a": [], "b": []}, dtype="int64")
        sets = [shingle_sets(pa.array(s["text"], pa.large_string()), k) for s in sides]
        nodes = [s["node"].to_numpy() for s in sides]
        edges = forest(linked(sets[0], sets[1] if i != j else None, percent), nodes[0], nodes[-1])
        return pd.DataFrame(edges, columns=["a", "b"], dtype="int64")

    # comparing takes far longer than reading, so tasks go by rows, not by bytes
    return pairs.repartition(tasks, "family", "i", "j").groupBy("family", "i", "j").applyInPandas(run, "a long, b long")


def cluster(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", k: int = 3, percent: int = 85, bands: int = 36, rows: int = 7) -> DataFrame:
    """(id, n_shingles, component_id, kept, text_hash, chosen), one row for each row of ``docs``; component_id is the smallest
    id reachable. ``chosen`` holds for the rows of one id and text of each component, and for rows that are in none."""
    feats = materialize(features(docs, doc_id, text, k, bands, rows), "sketches")
    have = feats.filter("n_shingles > 0 AND id IS NOT NULL")
    least = F.min(F.struct("id", "text_hash", "keys"))
    classes = have.groupBy("digest").agg(least.alias("m")).select("digest", F.col("m.id").alias("rep"), F.col("m.text_hash").alias("rep_hash"), F.col("m.keys").alias("keys"))
    # sets are told apart by numbers that are written once, as ids may repeat
    classes = materialize(classes.withColumn("node", F.monotonically_increasing_id()), "classes")
    member = materialize(classes.select(F.explode("keys").alias("key"), "node"), "bands")
    pivots = materialize(member.groupBy("key").agg(F.min("node").alias("pivot"), F.max("node").alias("other")).filter("pivot <> other").select("key", "pivot"), "pivots")
    near = member.join(pivots, "key").filter("node <> pivot").select("pivot", "node").distinct()
    families = components(near, "pivot", "node").select("node", F.col("root").alias("family"))
    families = materialize(families.join(classes.select("node", "rep", "rep_hash"), "node"), "families")
    sent = broadcast_if_small(families, families.count(), 300_000)
    texts = with_hash(docs, doc_id, text).join(sent, (F.col("id") == F.col("rep")) & (F.col("text_hash") == F.col("rep_hash")))
    texts = materialize(texts.select("family", "node", "text").dropDuplicates(["node"]), "family-texts")
    links = materialize(links_within(texts, k, percent), "links")
    roots = materialize(components(links, "a", "b").join(classes.select("node", "rep", "rep_hash"), "node"), "roots")
    firsts = roots.groupBy("root").agg(F.min(F.struct("rep", "rep_hash")).alias("first")).select("root", "first")
    joined = roots.join(firsts, "root").select("node", "first")
    own = F.struct("rep", "rep_hash")
    by_class = classes.join(joined, "node", "left").select("digest", F.coalesce("first", own).alias("first"))
    by_class = materialize(by_class.select("digest", F.col("first.rep").alias("component_id"), F.col("first.rep_hash").alias("first_hash")), "class-roots")
    answered = have.select("id", "n_shingles", "text_hash", "digest").join(by_class, "digest")
    answered = answered.select("id", "n_shingles", "component_id", "text_hash", ((F.col("id") == F.col("component_id")) & (F.col("text_hash") == F.col("first_hash"))).alias("chosen"))
    alone = feats.filter("n_shingles = 0 OR id IS NULL").select("id", "n_shingles", F.col("id").alias("component_id"), "text_hash", F.lit(True).alias("chosen"))
    kept = F.coalesce(F.col("id") == F.col("component_id"), F.lit(True)).alias("kept")
    return answered.unionByName(alone).select("id", "n_shingles", "component_id", kept, "text_hash", "chosen")
