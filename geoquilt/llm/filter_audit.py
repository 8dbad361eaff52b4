"""How five filters of documents interact, in every order in which they can be applied.

A and B read a sparse document-term matrix over all documents. Tasks build shards of it, compressed sparse rows with a
dictionary of their own; only these dictionaries are shuffled, as a shard names each of its words once. The distinct words
get global numbers, every shard's columns are renumbered, and row sums and numbers of nonzeros are words and distinct words
of a document. Shards are written a document a row and their dictionaries in short lists, as what writers, readers and
shuffles hold at once goes by rows. C and D are told from the bytes of the text, E compares digests (SHA-256) of whole texts with the smallest id that
has them. A document is then a set of failed filters; documents are counted by part and set (32 sets a part at most), and
all orders follow from the counts, as what a filter removes depends on which filters came before it, not on their order.

Null texts count as empty, so they fail A only (and E if an earlier text is null or empty). Null parts and empty ones are
one part, the empty string. Null ids neither fail E nor make others fail it; rows that repeat an id and text don't make
each other fail. A document is good, or toxic, if a label of its id says so; labels may repeat, and null ids have none. Very long texts are read
whole, each a shard of its own. An empty table gives an empty table. Only columns that are named are read.
"""

from __future__ import annotations

import itertools
import json
import math
import re
from collections.abc import Callable, Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from geoquilt.llm.common import materialize, slices

# Fixed values
FILTERS = "ABCDE"
MARKS = "#$%&*|"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

#: Bytes of UTF-8 that carry on a code point.
CARRYING = bytes(range(0x80, 0xC0))
#: Bytes of text of a shard. The larger, the fewer words are named by more than one shard.
SHARD_BYTES = 16 << 20
#: Words of a dictionary, and entries of a matrix, that are written as one value.
LISTED, ENTRIES = 256, 1 << 16
LOCAL = "part int, piece int, doc {}, columns array<int>, counts array<int>, first int, words array<binary>"
STEP = "struct<filter: int, before: int, filter_order: string, step: int>"


def local_shards(docs: DataFrame, keep: Sequence[str], text: str, flags: Mapping[str, Callable[[bytes], bool]]) -> DataFrame:
    """Shards (LOCAL). A document has a row: ``doc``, the ``keep`` columns and flags of its text (UTF-8), has ``counts`` of the
    words in these ``columns`` of its shard's dictionary. Other rows, without a document, have this dictionary: ``words`` from
    column ``first`` on."""

    def coded(texts: pa.Array) -> tuple[pa.DictionaryArray, list[int], list[list[bool]]]:
        raw = [(t or "").encode() for t in texts.to_pylist()]
        found = [t.split() for t in raw]  # at \x20 and \x09-\x0D
        words = pa.array([w for ws in found for w in ws], pa.binary()).dictionary_encode()
        return words, [len(ws) for ws in found], [[f(t) for t in raw] for f in flags.values()]

    def shard(part: int, piece: int, batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        pieces = [coded(batch.column(0)[at : at + n]) for at, n in slices(batch.column(0))]
        whole = pa.chunked_array([p[0] for p in pieces]).unify_dictionaries()  # exact, so a word has one number
        codes = np.concatenate([c.indices.to_numpy() for c in whole.chunks]) if whole.num_chunks else np.zeros(0, np.int64)
        words = whole.chunk(0).dictionary if whole.num_chunks else pa.array([], pa.binary())
        sizes = np.array([n for p in pieces for n in p[1]], np.int64)
        width = max(1, len(words))
        cells, counts = np.unique(np.repeat(np.arange(len(sizes)), sizes) * width + codes, return_counts=True)
        starts = pa.array(np.searchsorted(cells, np.arange(len(sizes) + 1) * width), pa.int32())
        told = [pa.array([x for p in pieces for x in p[2][i]], pa.bool_()) for i in range(len(flags))]
        kept = pa.StructArray.from_arrays([*batch.columns[1:], *told], names=[*keep, *flags])
        columns, numbers = (pa.ListArray.from_arrays(starts, pa.array(x, pa.int32())) for x in (cells % width, counts))
        first = np.arange(0, len(words), LISTED)
        listed = pa.ListArray.from_arrays(pa.array(np.append(first, len(words)), pa.int32()), words)

        def rows(n: int, **values: pa.Array) -> pa.RecordBatch:
            of = {"part": pa.repeat(pa.scalar(part, pa.int32()), n), "piece": pa.repeat(pa.scalar(piece, pa.int32()), n)} | values
            return pa.RecordBatch.from_arrays([of[c] if c in of else pa.nulls(n, kind) for c, kind in kinds.items()], names=list(kinds))

        kinds = {"part": None, "piece": None, "doc": kept.type, "columns": columns.type, "counts": columns.type, "first": pa.int32(), "words": listed.type}
        yield rows(len(kept), doc=kept, columns=columns, counts=numbers)
        yield rows(len(listed), first=pa.array(first, pa.int32()), words=listed)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, piece = TaskContext.get().partitionId(), 0
        for batch in batches:
            for at, n in slices(batch.column(0), SHARD_BYTES):
                yield from shard(part, piece, batch.slice(at, n))
                piece += 1

    rows = docs.select(docs[text].cast("string").alias("_text"), *[docs[c] for c in keep])
    schema = docs.select(*keep).schema
    for name in flags:
        schema = schema.add(name, "boolean")
    return rows.mapInArrow(run, LOCAL.format(schema.simpleString()))


class TermMatrix:
    """A sparse document-term matrix: ``dictionary`` (word, term), shards with dictionaries of their own, and for each of these
    the global numbers of its words. A shard and its numbers meet in a task of their own."""

    def __init__(self, docs: DataFrame, keep: Sequence[str], text: str, flags: Mapping[str, Callable[[bytes], bool]] | None = None):
        self.local = materialize(local_shards(docs, keep, text, flags or {}), "local-shards")
        # a word comes once from each shard; all its rows meet in one task, which takes the number of one of them for all
        named = self.local.filter("words IS NOT NULL").select("part", "piece", "first", F.posexplode("words").alias("at", "word"))
        named = named.select("part", "piece", (F.col("first") + F.col("at")).alias("pos"), "word").repartition("word")
        term = F.min("id").over(Window.partitionBy("word"))
        named = named.withColumn("id", F.monotonically_increasing_id()).withColumn("term", term)
        self.named = materialize(named.select("part", "piece", "pos", "term", F.when(F.col("id") == F.col("term"), F.col("word")).alias("word")), "dictionary")
        self.dictionary = self.named.filter("word IS NOT NULL").select("word", "term")
        self.docs = self.local.schema["doc"].dataType

    def by_shard(self, of: Callable[[pa.Table, np.ndarray, np.ndarray, np.ndarray], pa.Table], schema: str) -> DataFrame:
        """What ``of`` makes of each shard's rows of documents, where their entries start, and these entries' global numbers and counts."""

        def run(shard: pa.Table, named: pa.Table) -> pa.Table:
            own = np.zeros(named.num_rows, np.int64)
            own[named.column("pos").to_numpy()] = named.column("term").to_numpy()
            lists, counts = (shard.column(c).combine_chunks() for c in ("columns", "counts"))
            starts = np.concatenate([[0], np.cumsum(pc.list_value_length(lists).to_numpy(), dtype=np.int64)])
            return of(shard, starts, own[lists.flatten().to_numpy()], counts.flatten().to_numpy())

        shards = self.local.filter("doc IS NOT NULL").select("part", "piece", "doc", "columns", "counts")
        named = self.named.select("part", "piece", "pos", "term")
        return shards.groupBy("part", "piece").cogroup(named.groupBy("part", "piece")).applyInArrow(run, schema)

    def shards(self) -> DataFrame:
        """(part, piece, docs, starts, terms, counts): compressed sparse rows in global numbers, about ENTRIES entries a row of the table."""

        def of(shard: pa.Table, starts: np.ndarray, terms: np.ndarray, counts: np.ndarray) -> pa.Table:
            cuts = np.append(np.flatnonzero(np.diff(starts[:-1] // ENTRIES, prepend=-1)), len(starts) - 1)
            begun = pa.ListArray.from_arrays(np.append(0, np.cumsum(np.diff(cuts) + 1)).astype(np.int32), pa.array(np.concatenate([starts[a : b + 1] - starts[a] for a, b in itertools.pairwise(cuts)]), pa.int32()))
            docs = pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), shard.column("doc").combine_chunks())
            flat = [pa.ListArray.from_arrays(pa.array(starts[cuts], pa.int32()), pa.array(x)) for x in (terms, counts)]
            at = [shard.column(c).slice(0, len(cuts) - 1) for c in ("part", "piece")]
            return pa.table([*at, docs, begun, *flat], names=["part", "piece", "docs", "starts", "terms", "counts"])

        return self.by_shard(of, f"part int, piece int, docs array<{self.docs.simpleString()}>, starts array<int>, terms array<long>, counts array<int>")

    def row_sums(self) -> DataFrame:
        """The documents with the sum of a row's counts and the number of its different terms: total, nonzero."""

        def of(shard: pa.Table, starts: np.ndarray, terms: np.ndarray, counts: np.ndarray) -> pa.Table:
            docs = shard.column("doc").combine_chunks()
            total = np.diff(np.concatenate([[0], np.cumsum(counts, dtype=np.int64)])[starts])
            row = np.repeat(np.arange(len(docs)), np.diff(starts))
            order = np.lexsort((terms, row))
            first = np.ones(len(terms), bool)
            first[1:] = (terms[order][1:] != terms[order][:-1]) | (row[order][1:] != row[order][:-1])
            nonzero = np.bincount(row[order][first], minlength=len(docs))
            return pa.table([*docs.flatten(), pa.array(total), pa.array(nonzero.astype(np.int64))], names=[*docs.type.names, "total", "nonzero"])

        names = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self.docs.fields)
        return self.by_shard(of, f"{names}, total long, nonzero long")


def failed_filters(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", part: str = "source") -> DataFrame:
    """(id, part, failed) of each document: ``failed`` is a sum of 1, 2, 4, 8, 16 for A to E."""
    t = F.coalesce(docs[text].cast("string"), F.lit(""))
    rows = docs.select(docs[doc_id].cast("long").alias("id"), F.coalesce(docs[part].cast("string"), F.lit("")).alias("part"), F.unhex(F.sha2(t, 256)).alias("digest"), t.alias("_text"))
    many, marked = UPPER.encode(), re.compile(f"[{MARKS}]".encode())
    # letters A-Z are single bytes; code points are the bytes that don't carry on another one
    flags = {
        "c": lambda b: 100 * (len(b) - len(b.translate(None, many))) > 5 * len(b.translate(None, CARRYING)),
        "d": lambda b: marked.search(b) is not None,
    }
    rows = materialize(TermMatrix(rows, ["id", "part", "digest"], "_text", flags).row_sums(), "row-sums")
    # both sides are written tables, so a digest that very many documents share is split
    first = materialize(rows.groupBy("digest").agg(F.min("id").alias("first")), "first-ids")
    a, b = F.col("total") < 50, F.lit(100) * F.col("nonzero") < F.lit(65) * F.col("total")
    e = F.coalesce(F.col("id") > F.col("first"), F.lit(False))
    failed = sum(F.when(fails, 1 << k).otherwise(0) for k, fails in enumerate((a, b, F.col("c"), F.col("d"), e)))
    return rows.join(first, "digest").select("id", "part", failed.cast("int").alias("failed"))


def by_set(failed: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, failed, n, good, toxic): documents of each part and set of failed filters, and how many are labelled so."""
    labels = labels.groupBy(F.col("doc_id").cast("long").alias("id")).agg(F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic"))
    count = lambda flag: F.sum(F.coalesce(F.col(flag).cast("long"), F.lit(0).cast("long"))).alias(flag)
    return failed.join(labels, "id", "left").groupBy("part", "failed").agg(F.count(F.lit(1)).alias("n"), count("good"), count("toxic"))


def in_all_orders(sets: DataFrame) -> DataFrame:
    """One row for each part, order of the filters and step, from counts by set of failed filters."""
    bits = [1 << k for k in range(len(FILTERS))]
    pairs = [(f, before) for f in bits for before in range(1 << len(FILTERS)) if not before & f]
    alone = F.from_json(F.lit(json.dumps([{"filter": f, "before": b} for f, b in pairs])), "array<struct<filter: int, before: int>>")
    cut = sets.withColumn("s", F.explode(alone)).select("*", "s.*")
    f, before, failed = F.col("filter"), F.col("before"), F.col("failed")
    fails, earlier = failed.bitwiseAND(f) != 0, failed.bitwiseAND(before) != 0
    count = lambda when, of="n": F.sum(F.when(when, F.col(of)).otherwise(F.lit(0).cast("long")))
    counts = cut.groupBy("part", "filter", "before").agg(
        count(~fails & ~earlier).alias("kept"),
        count(fails & ~earlier).alias("removed"),
        count(fails & earlier).alias("redundant"),
        count(failed == f).alias("unique_fails"),
        count(fails & ~earlier, "good").alias("good_lost"),
        count(fails & ~earlier, "toxic").alias("toxic_lost"),
    )
    # as often as an order has these filters before this one
    times = [math.factorial(k) * math.factorial(len(FILTERS) - 1 - k) for k in range(len(FILTERS))]
    weight = F.element_at(F.array(*[F.lit(t).cast("long") for t in times]), F.bit_count("before") + 1)
    counts = counts.withColumn("shapley", F.sum(F.col("removed") * weight).over(Window.partitionBy("part", "filter")))
    steps = []
    for order in itertools.permutations(range(len(FILTERS))):
        name = "".join(FILTERS[k] for k in order)
        steps += [{"filter": bits[k], "before": sum(bits[j] for j in order[:i]), "filter_order": name, "step": i + 1} for i, k in enumerate(order)]
    steps = sets.sparkSession.range(1).select(F.inline(F.from_json(F.lit(json.dumps(steps)), f"array<{STEP}>")))
    out = counts.join(F.broadcast(steps), ["filter", "before"])  # 600 rows
    return out.select("part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def audit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", part: str = "source") -> DataFrame:
    """What each step of each order keeps and removes, by part. ``labels``: doc_id, quality, toxic."""
    sets = materialize(by_set(failed_filters(docs, doc_id, text, part), labels), "failed-sets")
    return in_all_orders(sets)
