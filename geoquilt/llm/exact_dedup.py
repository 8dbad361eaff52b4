"""Exact duplicates by a sort of the contents.

Rows are range-partitioned by splitters that Spark samples, sorted inside each partition (spilling to disk), and each row
is compared in full with the one before it. The sort key is (first LEAD bytes of the normalised content, a 64-bit hash of
all of it, the content, the id): equal contents stand side by side, splitters stay small however long the texts are, and
long common beginnings don't meet in one partition. As the id is part of the key, a content that very many rows share is
cut over as many partitions as its size asks for. What touches a partition's first or last row is an edge run; the edge
runs, two a partition at most, are compared in full among each other afterwards, so such a content is one group again.

Null contents count as empty ones, and empty ones are equal to each other. Very long texts are compared whole. Of rows that
repeat an id and a content, one stays. Null ids lose against others; a group of null ids alone keeps one row, its
``keep_id`` null. An empty table gives an empty table. Columns of the input don't matter, as only own ones are returned.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geoquilt.llm.common import broadcast_if_small, materialize

#: Leading bytes of a content that take part in the splitters.
LEAD = 32
RUNS = "id long, part int, run long, n long, best long, chosen boolean, sha binary, edge boolean, content binary"


def folded(text: Column) -> Column:
    """A normalisation: a-z for A-Z, runs of white space as one space, none at the ends."""
    lower = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.trim(F.regexp_replace(lower, r"[\x20\x09-\x0D]+", " "))


class Runs:
    """Runs of equal neighbours of one sorted partition: the rows of RUNS, run by run. Of an open run only its ids are held."""

    def __init__(self, part: int, last_stays: bool):
        self.part, self.last_stays, self.run, self.open, self.ids = part, last_stays, 0, None, []

    def close(self, at_end: bool) -> pa.RecordBatch:
        ids = pa.concat_arrays(self.ids)
        n, edge = len(ids), at_end or self.run == 0
        keeper = n - 1 if self.last_stays else 0
        same = lambda v, kind: pa.repeat(pa.scalar(v, kind), n)
        content = pa.concat_arrays([pa.array([self.open if edge else None], pa.binary()), pa.nulls(n - 1, pa.binary())])
        sha = hashlib.sha256(self.open).digest()
        columns = [ids, same(self.part, pa.int32()), same(self.run, pa.int64()), same(n, pa.int64()), same(ids[keeper].as_py(), pa.int64())]
        columns += [pa.array(np.arange(n) == keeper), same(sha, pa.binary()), same(edge, pa.bool_()), content]
        self.run, self.ids = self.run + 1, []
        return pa.RecordBatch.from_arrays(columns, names=["id", "part", "run", "n", "best", "chosen", "sha", "edge", "content"])

    def of(self, batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        ids, content = batch.column(0), batch.column(1)
        changes = np.flatnonzero(pc.not_equal(content[1:], content[:-1]).to_numpy(zero_copy_only=False)) + 1
        starts = [0, *changes.tolist(), len(content)]
        for a, b in zip(starts[:-1], starts[1:], strict=True):
            now = content[a].as_py()
            if self.ids and now != self.open:
                yield self.close(False)
            self.open = now
            self.ids.append(ids[a:b])


def runs(docs: DataFrame, doc_id: str, text: str, last_stays: bool, normalise: Callable[[Column], Column] | None) -> DataFrame:
    """The rows of RUNS: each row of ``docs`` with its run of equal neighbours inside its partition."""
    content = F.coalesce(docs[text].cast("string"), F.lit(""))
    content = F.encode(normalise(content) if normalise else content, "utf-8")
    rows = docs.select(docs[doc_id].cast("long").alias("id"), content.alias("content"))
    rows = rows.withColumns({"lead": F.expr(f"substring(content, 1, {LEAD})"), "hash": F.xxhash64("content")})
    by_id = F.asc_nulls_first("id") if last_stays else F.asc_nulls_last("id")
    placed = rows.repartitionByRange("lead", "hash", by_id).sortWithinPartitions("lead", "hash", "content", by_id)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, out, rows = Runs(TaskContext.get().partitionId(), last_stays), [], 0
        for batch in batches:
            if batch.num_rows:
                for done in found.of(batch):
                    out.append(done)
                    rows += done.num_rows
                if rows > 4096:
                    yield from pa.Table.from_batches(out).combine_chunks().to_batches()
                    out, rows = [], 0
        if found.ids:
            out.append(found.close(True))
        if out:
            yield from pa.Table.from_batches(out).combine_chunks().to_batches()

    return placed.select("id", "content").mapInArrow(run, RUNS)


def groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", keep: str = "smallest", normalise: Callable[[Column], Column] | None = None) -> DataFrame:
    """(id, keep_id, group_size, kept, text_sha256) of each row; of a group the row with the smallest, or largest, id stays."""
    if keep not in ("smallest", "largest"):
        raise ValueError("keep is smallest or largest")
    found = materialize(runs(docs, doc_id, text, keep == "largest", normalise), "sorted-runs")
    of_group = F.max("best") if keep == "largest" else F.min("best")
    edges = found.filter("edge AND content IS NOT NULL").groupBy("content")
    edges = edges.agg(of_group.alias("keep_id"), F.sum("n").alias("size"), F.collect_list(F.struct("part", "run", "best")).alias("runs"))
    edges = edges.select("keep_id", "size", F.inline("runs"))
    # no id stands in two runs of one content, as the range partitioner deals equal keys to one partition
    edges = materialize(edges.select("part", "run", "keep_id", "size", F.col("best").eqNullSafe(F.col("keep_id")).alias("here")), "edge-runs")
    joined = found.filter("edge").join(broadcast_if_small(edges, edges.count()), ["part", "run"])
    sha = F.lower(F.hex("sha")).alias("text_sha256")
    inner = found.filter("NOT edge").select("id", F.col("best").alias("keep_id"), F.col("n").alias("group_size"), F.col("chosen").alias("kept"), sha)
    return inner.unionByName(joined.select("id", "keep_id", F.col("size").alias("group_size"), (F.col("chosen") & F.col("here")).alias("kept"), sha))
