"""Mixing sources to target weights by Poisson replication.

A source of mass ``m`` that shall hold the share ``w`` of ``epochs`` times the whole mass gets the mean repetition rate
``w * epochs * total / m``. Each document inverts a Poisson distribution of that mean at a number drawn from a hash of
its id, is repeated by the count, and all copies are dealt out anew by a hash. Rows never meet: there is no sort over
all, no sampling pass and no count to hold exactly; shares hold in expectation, with a relative error of about
``1 / sqrt(copies)``.

Null sources form a source of their own; its key in ``weights`` is None. Null or empty texts count as mass 1, as every
text counts its code points plus 1. Repeated rows draw the same count. A source of which ``weights`` has nothing gets
weight 0 and so no copies. Equal shuffle keys stay in any order; very long texts travel as they are, once for each copy. An
empty table gives an empty table. Only DataFrame functions are used.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geoquilt.llm.common import broadcast_if_small, materialize, uniform

#: A mean above this is split into equal parts whose draws add up, so exp(-mean) never underflows.
PART = 32.0


def rates(docs: DataFrame, source: str = "source", text: str = "text", weights: Mapping[str | None, float] | None = None, temperature: float = 0.7, epochs: float = 1.0) -> DataFrame:
    """(source, mass, rate): each source's mean repetition rate. Without ``weights``, shares go with mass ** temperature."""
    per = docs.groupBy(docs[source].alias("source")).agg(F.sum(F.coalesce(F.length(docs[text]), F.lit(0)) + F.lit(1)).cast("double").alias("mass"))
    if weights is None:
        wanted = F.pow("mass", F.lit(float(temperature)))
    else:
        wanted = F.lit(0.0)
        for name, w in weights.items():
            wanted = F.when(F.col("source").eqNullSafe(F.lit(name)), F.lit(float(w))).otherwise(wanted)
    per = materialize(per.withColumn("wanted", wanted), "source-mass")
    total, all_wanted = per.agg(F.sum("mass"), F.sum("wanted")).first()
    share = F.col("wanted") / F.lit(float(all_wanted or 1.0))
    return per.select("source", "mass", (share * F.lit(float(epochs) * float(total or 0.0)) / F.col("mass")).alias("rate"))


def with_distribution(table: DataFrame) -> DataFrame:
    """Adds the number of parts and the cumulative probabilities of one part, once for each source."""
    parts = F.greatest(F.lit(1), F.ceil(F.col("rate") / F.lit(PART))).cast("int")
    table = table.withColumn("parts", parts).withColumn("mean", F.col("rate") / F.col("parts"))
    last = F.ceil(F.col("mean") + F.lit(12.0) * F.sqrt("mean") + F.lit(20.0)).cast("int")
    cumulative = F.aggregate(
        F.sequence(F.lit(1), last),
        F.struct(F.exp(-F.col("mean")).alias("p"), F.array(F.exp(-F.col("mean"))).alias("c")),
        lambda s, k: F.struct((s["p"] * F.col("mean") / k).alias("p"), F.concat(s["c"], F.array(F.element_at(s["c"], -1) + s["p"] * F.col("mean") / k)).alias("c")),
        lambda s: s["c"],
    )
    return table.withColumn("cumulative", cumulative)


def copies(doc_id: Column, seed: int) -> Column:
    """The Poisson draw of a document: in each part, how many cumulative probabilities lie at or below its number."""
    one = lambda part: F.size(F.filter(F.col("_cumulative"), lambda c: c <= uniform(doc_id, part, F.lit(seed))))
    several = F.aggregate(F.sequence(F.lit(1), F.col("_parts")), F.lit(0), lambda n, part: n + one(part))
    # the number of the only part is drawn once, not once for each comparison
    single = F.size(F.filter(F.col("_cumulative"), lambda c: c <= F.col("_u")))
    return F.when(F.col("_parts") == 1, single).otherwise(several)


def mix(docs: DataFrame, doc_id: str = "doc_id", source: str = "source", text: str = "text", weights: Mapping[str | None, float] | None = None, temperature: float = 0.7, epochs: float = 1.0, seed: int = 17) -> DataFrame:
    """All columns of ``docs`` with copy (from 1), n_copies and shuffle_key; rows dealt out and sorted by shuffle_key.

    Columns of ``docs`` with one of these names are replaced.
    """
    added = {"copy", "n_copies", "shuffle_key"}
    docs = docs.select(*[docs[c] for c in docs.columns if c not in added])
    table = with_distribution(rates(docs, source, text, weights, temperature, epochs))
    table = table.select(F.col("source").alias("_source"), F.col("parts").alias("_parts"), F.col("cumulative").alias("_cumulative"))
    table = materialize(table, "source-rates")
    rows = docs.join(broadcast_if_small(table, table.count()), docs[source].eqNullSafe(F.col("_source")))
    drawn = rows.withColumn("_u", uniform(rows[doc_id], F.lit(1), F.lit(seed))).withColumn("n_copies", copies(F.col(doc_id), seed))
    drawn = drawn.filter(F.col("n_copies") > 0)
    out = drawn.select(*docs.columns, "n_copies", F.explode(F.sequence(F.lit(1), F.col("n_copies"))).alias("copy"))
    null = F.lit("null")
    key = F.md5(F.concat_ws(":", F.lit(seed), F.coalesce(F.col(doc_id).cast("string"), null), F.col("copy"), F.coalesce(F.md5(F.col(text)), null)))
    return out.withColumn("shuffle_key", key).hint("rebalance", "shuffle_key").sortWithinPartitions("shuffle_key")
