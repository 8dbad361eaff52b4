import hashlib
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from geoquilt.llm import exact_dedup
from geoquilt.llm.queries import op12_content_sort, oracle_sql
from tools.verify import compare

SF = "/root/testdata/sf0.001"


def brute(rows, keep):
    by = defaultdict(list)
    for i, t in rows:
        by[t or ""].append(i)
    out = []
    for t, ids in by.items():
        known = [i for i in ids if i is not None]
        best = (max if keep == "largest" else min)(known) if known else None
        ids.sort(key=lambda i: i != best)
        out += [(i, best, len(ids), k == 0, hashlib.sha256(t.encode()).hexdigest()) for k, i in enumerate(ids)]
    return sorted(out, key=str)


@pytest.mark.parametrize("keep", ["largest", "smallest"])
def test_against_brute_force(spark, keep):
    rng = random.Random(3)
    long = "w " * 200_000
    rows = [(rng.randrange(4000), rng.choice(["", "a", "A", "a ", "the same long beginning of many texts " + str(rng.randrange(300)), long, long + "x", "é"])) for _ in range(3000)]
    rows += [(None, "a"), (None, "nobody's"), (None, "nobody's"), (7, None), (7, None), (8, ""), (9, "alone"), (-1, "a\x00"), (-2, "a\x00")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"content": F.lit(1), "kept": F.lit("x")}).repartition(5)
    got = exact_dedup.groups(df, keep=keep)
    assert got.columns == ["id", "keep_id", "group_size", "kept", "text_sha256"]
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows, keep)
    assert exact_dedup.groups(df.limit(0), keep=keep).count() == 0


def test_a_group_over_many_partitions(spark):
    """One text with most rows is cut over partitions, and is one group all the same."""
    rows = spark.range(40_000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 10 < 9, "hot").otherwise(F.concat(F.lit("t"), "id")).alias("text"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        runs = exact_dedup.runs(rows, "doc_id", "text", True, None).collect()
        parts = [sum(r["part"] == p for r in runs) for p in {r["part"] for r in runs}]
        assert len(parts) >= 7 and max(parts) < 10_000
        out = exact_dedup.groups(rows, keep="largest").groupBy("group_size", "kept").agg(F.count(F.lit(1)), F.max("keep_id"))
        assert sorted(map(tuple, out.collect())) == [(1, True, 4000, 39_999), (36_000, False, 35_999, 39_998), (36_000, True, 1, 39_998)]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_normalisation(spark):
    df = spark.createDataFrame([(1, " A  b\n"), (2, "a b"), (3, "ab")], "doc_id long, text string")
    got = {r.id: (r.keep_id, r.kept) for r in exact_dedup.groups(df, normalise=exact_dedup.folded).collect()}
    assert got == {1: (1, True), 2: (1, False), 3: (3, True)}
    with pytest.raises(ValueError):
        exact_dedup.groups(df, keep="any")


def test_sql(spark):
    assert compare(spark, "op12", op12_content_sort, oracle_sql()["op12_content_sort"], SF).startswith("ok")
