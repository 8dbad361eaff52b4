"""Token counts with a cache of digests.

The cache is a table (version, digest, n_tokens) in a folder: version is the SHA-256 of the vocabulary file, digest that
of the normalised content, as 32 bytes. Contents are joined to the cache by both; distinct contents that it lacks are
encoded once each and appended; then every document is joined to its count. Vocabularies without a normaliser count
each byte of the content, so normalising here only makes a null text the empty one.

Copies are combined before they are shuffled. The last join meets two written tables, so a digest that very many
documents share is split. Writers that overlap may store a digest twice; it is read once. Repeated rows are answered each; an empty table
gives an empty table and leaves the cache as it is; column names of the input can't clash, as only ``keep`` is returned.
A very long text is encoded whole, alone in its slice.
"""

from __future__ import annotations

import functools
import hashlib
import os
from collections.abc import Iterator

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geoquilt.llm.common import materialize, slices

CACHE = "version string, digest binary, n_tokens long"


def version_of(path: str) -> str:
    with open(path, "rb") as f:
        return hashlib.sha256(f.read()).hexdigest()


@functools.lru_cache(4)
def _library(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs the tasks side by side
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def count_each(texts: DataFrame, path: str) -> DataFrame:
    """(digest, n_tokens) of (digest, text): every whole text is encoded."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _library(path)
        for batch in batches:
            for at, n in slices(batch.column(1), 1 << 18):
                part = batch.slice(at, n)
                found = encoder.encode_batch_fast(part.column(1).to_pylist(), add_special_tokens=False)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([len(x.ids) for x in found], pa.int64())], names=["digest", "n_tokens"])

    return texts.select("digest", "text").mapInArrow(run, "digest binary, n_tokens long")


def read_cache(spark: SparkSession, cache: str, version: str) -> DataFrame:
    """The counts of one version, one row a digest; none if the cache isn't there yet."""
    try:
        found = spark.read.schema(CACHE).parquet(cache)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        found = spark.createDataFrame([], CACHE)
    # overlapping writers, or a job that is run again, may have stored a digest more than once
    return found.filter(F.col("version") == version).groupBy("digest").agg(F.min("n_tokens").alias("n_tokens"))


def count_tokens(docs: DataFrame, text: str, path: str, cache: str, keep: list[str]) -> DataFrame:
    """The ``keep`` columns of ``docs``, n_bytes and n_tokens of each whole text; ``cache`` gains what it lacked."""
    spark, version = docs.sparkSession, version_of(path)
    content = F.coalesce(docs[text].cast("string"), F.lit(""))
    keyed = docs.select(*[docs[c] for c in keep], content.alias("_text"), F.unhex(F.sha2(content, 256)).alias("_digest"))
    rows = materialize(keyed.select(*keep, "_digest", F.octet_length("_text").cast("long").alias("n_bytes")), "digests")
    contents = keyed.groupBy(F.col("_digest").alias("digest")).agg(F.first("_text").alias("text"))
    misses = contents.join(read_cache(spark, cache, version), "digest", "left_anti")
    count_each(misses, path).select(F.lit(version).alias("version"), "digest", "n_tokens").write.mode("append").parquet(cache)
    known = read_cache(spark, cache, version)
    return rows.join(known, rows["_digest"] == known["digest"]).select(*[rows[c] for c in keep], "n_bytes", "n_tokens")
