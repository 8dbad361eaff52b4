"""Quality rules, mixing and sharding, which use DataFrame functions alone."""

import hashlib
import math
import os
import zlib
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

from geoquilt.llm import mixing, quality, sharding
from geoquilt.llm.queries import op2_host_quality, op9_rendezvous, oracle_sql, queries
from tests.llm.test_pipeline import good, measures
from tools.verify import compare

SF = "/root/testdata/sf0.001"
WORDS = " ".join(f"w{i}" for i in range(40))
ODD = [None, "", " \n\t", "a b c", WORDS, WORDS + "\n" + WORDS, "x y z q r " * 3000, "a b c d e a b c d e f g h i j k l m", "#*$%&|<>" * 5 + WORDS, "one\x0btwo\x0cthree four\rfive six seven eight nine ten eleven\x1ctwelve\xa0thirteen", "l\nl\n\nl \nm\n", "é ü\n" * 20]


def no_python(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return not any(x in plan for x in ("Python", "Pandas", "Arrow"))


def test_measures_match_python(spark):
    df = spark.createDataFrame([(i, t, 7) for i, t in enumerate(ODD)], "doc_id long, text string, n_words int")
    got = quality.measure(df)
    assert no_python(got)
    assert {r.doc_id: tuple(r[c] for c in quality.MEASURES) for r in got.collect()} == {i: measures(t) for i, t in enumerate(ODD)}


def test_host_verdicts(spark):
    rows = [{"doc_id": i, "text": WORDS if i % 40 else "short", "source": f"good{i % 5}"} for i in range(400)]
    rows += [{"doc_id": 1000 + i, "text": "too short" if i % 20 else WORDS, "source": "bad"} for i in range(200)]
    rows += [{"doc_id": 2000 + i, "text": None, "source": None} for i in range(2)] + [{"doc_id": 3000, "text": WORDS, "source": None}]
    rows += rows[:3]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("kept", F.lit("x"))
    out = quality.judge(df)
    assert set(out.columns) == {"doc_id", "text", "source", *quality.MEASURES, "base_failed", "host_rate", "host_failed", "kept"}
    kept = Counter(r.doc_id for r in out.collect() if r.kept)
    assert kept == Counter(r["doc_id"] for r in good([dict(r) for r in rows]))
    assert not any(1000 <= i < 2000 for i in kept) and sum(kept.values()) > 380
    assert quality.judge(df.limit(0)).count() == 0


def test_query_rejects_a_host(spark, tmp_path):
    """Of two hosts with the same share of failures only the one with many documents is surely bad; its good documents go too."""
    rows = [(i, WORDS + f" d{i}", "fr", f"host{i % 8}") for i in range(800)]
    rows += [(1000 + i, WORDS + f" e{i}" if i % 5 > 1 else "# | # | # | # | " + WORDS, "fr", "bad") for i in range(200)]
    rows += [(2000 + i, WORDS + f" f{i}" if i else "# | # | # | # | " + WORDS, "fr", "few") for i in range(2)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").withColumn("n_chars", F.length("text").cast("long"))
    df.coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    out = {r.doc_id: r for r in op2_host_quality(spark, str(tmp_path)).collect()}
    assert not any(r.base_failed for r in out.values())
    assert sorted(i for i, r in out.items() if not r.kept) == list(range(1000, 1200))
    want = {r[0]: r[1] for r in duckdb.sql(oracle_sql()["op2_host_quality"].replace("FROM documents", f"FROM '{tmp_path}/documents.parquet/*.parquet'") + "").project("doc_id, kept").fetchall()}
    assert want == {i: r.kept for i, r in out.items()}


def test_mixing_reaches_its_targets(spark):
    rows = [(i, "x" * (i % 50), "big" if i % 10 else "small", i) for i in range(20_000)] + [(None, None, None, 0), (5, "x" * 5, "big", 5), (30_000, "tail", "unwanted", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, copy int")
    out = mixing.mix(df, weights={"big": 1.0, "small": 1.0}, epochs=2.0)
    assert out.columns == ["doc_id", "text", "source", "n_copies", "copy", "shuffle_key"] and no_python(out)
    mass = {r.source: r.m for r in out.groupBy("source").agg(F.sum(F.length("text") + 1).alias("m")).collect()}
    total = sum(len(t or "") + 1 for _, t, *_ in rows)
    assert set(mass) == {"big", "small"}
    for s in mass:
        assert abs(mass[s] / total - 1) < 0.05  # half of two epochs each
    copies = {(r.doc_id, r.copy) for r in out.select("doc_id", "copy").collect()}
    assert all((d, c - 1) in copies for d, c in copies if c > 1)
    again = {r.shuffle_key for r in mixing.mix(df, weights={"big": 1.0, "small": 1.0}, epochs=2.0).collect()}
    assert again == {r.shuffle_key for r in out.collect()}
    other = mixing.mix(df, weights={"big": 1.0, "small": 1.0}, epochs=2.0, seed=18)
    assert {r.shuffle_key for r in other.collect()} != again
    assert mixing.mix(df.limit(0)).count() == 0
    only_null = mixing.mix(df.filter("source IS NULL"), weights={None: 1.0}, epochs=50.0)
    assert {(r.doc_id, r.text) for r in only_null.collect()} == {(None, None)}


def test_poisson_draws(spark):
    df = spark.createDataFrame([("a", 1.5), ("b", 40.0), ("c", 900.0), ("d", 0.0)], "source string, rate double")
    t = mixing.with_distribution(df).select("source", F.col("parts").alias("_parts"), F.col("cumulative").alias("_cumulative"), "rate")
    docs = t.join(spark.range(2000).withColumnRenamed("id", "doc_id"))
    n = docs.withColumn("_u", mixing.uniform("doc_id", F.lit(1), F.lit(3))).withColumn("n", mixing.copies(F.col("doc_id"), 3))
    for r in n.groupBy("source", "rate").agg(F.avg("n").alias("m"), F.var_pop("n").alias("v")).collect():
        assert abs(r.m - r.rate) <= 5 * math.sqrt(r.rate / 2000) + 1e-9 and abs(r.v - r.rate) <= 0.2 * r.rate + 1e-9


def test_rendezvous_moves_little(spark):
    df = spark.range(20_000).withColumn("key", F.col("id").cast("string"))
    w = [1.0] * 8
    j = sharding.assign(df, "key", w).withColumns({"more": sharding.shard_of("key", [*w, 1.0]), "heavy": sharding.shard_of("key", [2.0, *w[1:]]), "less": sharding.shard_of("key", [0.0, *w[1:]])})
    assert no_python(j)
    rows = j.collect()
    assert all(r.more in (r.shard, 8) and r.heavy in (r.shard, 0) and (r.less == r.shard or r.shard == 0) for r in rows)
    assert abs(sum(r.more == 8 for r in rows) / 20_000 - 1 / 9) < 0.01 and abs(sum(r.heavy == 0 for r in rows) / 20_000 - 2 / 9) < 0.015 and not any(r.less == 0 for r in rows)
    with pytest.raises(ValueError):
        sharding.shard_of("key", [])
    clash = sharding.assign(df.select("id", "key", F.lit(99).alias("shard")), "key", w)
    assert clash.columns == ["id", "key", "shard"] and {(r.id, r.shard) for r in clash.collect()} == {(r.id, r.shard) for r in rows}
    by_clash = sharding.assign(df.select("id", F.col("key").alias("shard")), "shard", w)
    assert {(r.id, r.shard) for r in by_clash.collect()} == {(r.id, r.shard) for r in rows}
    nulls = spark.createDataFrame([(None,), (None,)], "key string")
    assert len({r.shard for r in sharding.assign(nulls, "key", w).collect()}) == 1
    assert sharding.assign(nulls.limit(0), "key", w).count() == 0


def test_slots_have_no_gaps(spark):
    rows = [(i % 3, i % 50, "t") for i in range(500)] + [(1, 7, "same")] * 9000 + [(None, None, None)]
    df = spark.createDataFrame(rows, "shard int, a long, b string")
    got = sharding.number(df, "shard", ["a", "b"], rows_per_bucket=10).collect()
    assert Counter((r.shard, r.a, r.b) for r in got) == Counter(rows)
    for s in (0, 1, 2, None):
        slots = sorted(r.slot for r in got if r.shard == s)
        assert slots == list(range(len(slots)))
    assert sharding.number(df.limit(0), "shard", ["a"]).count() == 0


def test_written_shards(spark, tmp_path):
    df = spark.range(100).withColumn("key", F.col("id"))
    sharding.write_shards(df, "key", [1.0, 3.0], str(tmp_path / "s"))
    assert spark.read.parquet(str(tmp_path / "s")).count() == 100


@pytest.mark.skipif(not os.path.exists(SF), reason="needs the test tables")
def test_queries(spark):
    assert no_python(op2_host_quality(spark, SF))
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = op9_rendezvous(spark, SF).collect()
    assert {(r.doc_id, r["size"], r.text_crc32) for r in rows} == {(i, len(t.encode()) + 1, zlib.crc32(t.encode())) for i, t in docs.items()}
    for r in rows:
        u = [(int(hashlib.md5(f"{r.doc_id}:{j}:0".encode()).hexdigest()[:13], 16) + 0.5) / 2**52 for j in range(9)]
        assert r.shard == max(range(8), key=lambda j: -1 / math.log(u[j])) and r.grown_shard == max(range(9), key=lambda j: -1 / math.log(u[j]))


@pytest.mark.skipif(not os.path.exists(SF), reason="needs the test tables")
@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_sql(spark, name):
    assert compare(spark, name, queries()[name], oracle_sql()[name], SF).startswith("ok")
