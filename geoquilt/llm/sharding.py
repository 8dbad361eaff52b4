"""Rendezvous hashing of stable record keys over weighted shards.

Every key draws one number in (0, 1) for each shard; the shard with the largest ``-weight / ln(u)`` gets the record.
A shard's draws don't depend on the other shards, so a new shard only takes records into itself, and a changed weight
only moves records from or to that shard.

Null keys count as the text ``null``; an empty text is a key like any other. Repeated rows go to the same shard and get slots
of their own; rows whose digests tie stand in the order of their columns. Very long texts are only hashed, never compared or
gathered, if they are in the numbered columns. An empty table gives an empty table. A column of the input that is named like
an added one is replaced.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from geoquilt.llm.common import uniform


def shard_of(key: Column | str, weights: Sequence[float], seed: int = 0) -> Column:
    """The shard of a key, 0 to ``len(weights) - 1``; ties go to the smaller shard. A weight of 0 takes no records."""
    if not weights or min(weights) < 0 or max(weights) <= 0:
        raise ValueError("weights must be at least 0, and one must be above 0")
    key = F.col(key) if isinstance(key, str) else key
    scores = [
        F.struct((F.lit(-float(w)) / F.ln(uniform(key, F.lit(j), F.lit(seed)))).alias("score"), F.lit(-j).alias("least"))
        for j, w in enumerate(weights)
        if w > 0
    ]
    return (-F.array_max(F.array(*scores))["least"]).cast("int")


def assign(df: DataFrame, key: str, weights: Sequence[float], seed: int = 0, out: str = "shard") -> DataFrame:
    """``df`` with the shard of each row; one projection, no shuffle. A column of that name is replaced, the key's too."""
    return df.withColumn(out, shard_of(df[key], weights, seed))


def write_shards(df: DataFrame, key: str, weights: Sequence[float], path: str, seed: int = 0) -> None:
    """Write each shard to a folder of its own; hot shards are spread over several tasks and files."""
    assign(df, key, weights, seed).hint("rebalance", "shard").write.partitionBy("shard").parquet(path)


def number(df: DataFrame, shard: str, columns: Sequence[str], rows_per_bucket: int = 20_000) -> DataFrame:
    """Rows of ``columns`` numbered from 0 without gaps in each shard, in the order of a digest of the row.

    No shard is gathered in one task: a shard is cut into buckets by leading hex digits of the digest, each bucket is
    numbered on its own, and the rows before it in its shard are added. Equal rows travel once, with their count. Rows
    without a shard are numbered as one more shard.
    """
    spark_rows = df.select(shard, *columns)
    keys = [shard, *columns]
    digest = F.md5(F.to_json(F.struct(*columns)))
    counted = spark_rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).withColumn("_digest", digest)
    total = df.select(F.lit(1).alias("one")).count()
    digits = 2
    while 16**digits * rows_per_bucket < total:
        digits += 1
    counted = counted.withColumn("_bucket", F.substring("_digest", 1, digits))
    before = (
        counted.groupBy(shard, "_bucket")
        .agg(F.sum("_n").alias("_rows"))
        .withColumn("_start", F.sum("_rows").over(Window.partitionBy(shard).orderBy("_bucket")) - F.col("_rows"))
        .select(F.col(shard).alias("_of_shard"), F.col("_bucket").alias("_of_bucket"), "_start")
    )
    running = Window.partitionBy(shard, "_bucket").orderBy("_digest", *columns).rowsBetween(Window.unboundedPreceding, 0)
    placed = counted.withColumn("_end", F.sum("_n").over(running)).join(before, F.col(shard).eqNullSafe(F.col("_of_shard")) & (F.col("_bucket") == F.col("_of_bucket")))
    first = F.col("_start") + F.col("_end") - F.col("_n")
    # a row that repeats very often is laid out in pieces, which are dealt anew before they become rows
    pieces = placed.select(*keys, first.alias("_first"), "_n", F.explode(F.expr("sequence(0L, (_n - 1) div 4096)")).alias("_piece"))
    pieces = pieces.repartition("_first", "_piece")
    inside = F.expr("sequence(_first + _piece * 4096, _first + least(_n, (_piece + 1) * 4096) - 1)")
    return pieces.select(*keys, F.explode(inside).alias("slot"))
