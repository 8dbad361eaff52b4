"""A training corpus from raw documents: five stages, each written as Parquet and read again as the next one's input.

Every stage but the last returns the columns of its input, whatever further ones there are, and an empty table for an empty
one. Columns that are named like those an operator adds are left as they are; names that begin with _ are the stages' own.
Very long texts go through whole, as the operators' docstrings say.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geoquilt.llm import bpe, minhash, mixing, pii, quality
from geoquilt.llm.common import broadcast_if_small, materialize

#: Five-word shingles at a similarity of 0.8: a pair at the threshold misses all bands with a probability of 3e-6.
NEAR = {"k": 5, "percent": 80, "bands": 42, "rows": 6}


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail no base rule and whose host isn't rejected; repeated rows are judged each, null and empty texts go."""
    return quality.judge(docs).filter("kept").select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates, the document with the smallest id; of rows that repeat an id and text, one.

    Documents without words, and those without an id, all stay but for such repeats of an id and text."""
    found = materialize(minhash.cluster(docs, **NEAR), "near-duplicates")
    rows = docs.withColumn("_hash", F.xxhash64(docs["text"].cast("string")))
    key = [F.col("id").alias("_id"), F.col("text_hash").alias("_of")]
    same = (F.col("doc_id") == F.col("_id")) & (F.col("_hash") == F.col("_of"))
    drop = found.filter(~F.col("chosen")).select(*key).distinct()
    rest = rows.join(broadcast_if_small(drop, drop.count(), 300_000), same, "left_anti")
    often = found.filter("chosen AND id IS NOT NULL").groupBy(*key).count().filter("count > 1").select("_id", "_of")
    if not (n := often.count()):
        return rest.select(*docs.columns)
    often = broadcast_if_small(often, n, 300_000)
    once = rest.join(often, same, "left_anti").select(*docs.columns)
    return once.unionByName(rest.join(often, same, "left_semi").dropDuplicates(["doc_id", "_hash"]).select(*docs.columns))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data and terms that disclose it replaced or removed; n_chars follows. Null texts stay null."""
    found = pii.sanitise(docs).withColumn("text", F.col("clean"))
    if "n_chars" in docs.columns:
        found = found.withColumn("n_chars", F.when(F.size("spans") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars")))
    return found.select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated or left out so that sources, the null one too, approach their target weights; equal ids draw equal counts."""
    return mixing.mix(docs).select(*docs.columns)


def encode_and_decode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids of every document, and a digest of what they decode to; null and empty texts have no ids."""
    found = bpe.encode(docs, "text", public_tokenizers.path("word_bpe_49k.json"), ["doc_id", "source"], decoded="decoded")
    return found.select("doc_id", "source", F.size("ids").cast("long").alias("n_tokens"), "ids", F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("quality rules", quality_rules),
    ("near duplicates", near_duplicates),
    ("personal data", personal_data),
    ("mix sources", mix_sources),
    ("bpe", encode_and_decode),
]

#: Near duplicates, disclosing terms and BPE have no SQL; the tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
