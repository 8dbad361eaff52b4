import math
import os

import numpy as np
import pytest

from geoquilt.llm import hnsw
from geoquilt.llm.queries import op3_hnsw

SF = "/root/testdata/sf0.01"


def brute(vectors, queries, k=10):
    """vectors: distinct (id, vector)."""
    ids, x = np.array([i for i, _ in vectors]), np.array([v for _, v in vectors], float)
    out = {}
    for i, q in queries:
        d = np.sqrt(((x - np.array(q, float)) ** 2).sum(1))
        order = [j for j in np.lexsort((ids, d)) if ids[j] != i][:k]
        out[i] = [(int(ids[j]), float(d[j])) for j in order]
    return out


def recall(rows, want):
    got = {}
    for r in rows:
        got.setdefault(r.query_id, []).append(r.vec_id)
    return np.mean([len({i for i, _ in w} & set(got.get(q, []))) / len(w) for q, w in want.items() if w])


def test_recall_over_shards(spark):
    rng = np.random.default_rng(3)
    x = np.concatenate([rng.normal(size=(1500, 24)), rng.normal(size=(20, 1, 24)).repeat(75, 1).reshape(-1, 24) + 0.1 * rng.normal(size=(1500, 24))]).astype(np.float32)
    vectors = [(i, x[i].tolist()) for i in range(len(x))]
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<float>")
    rows = hnsw.nearest(df, df.filter("vec_id % 30 = 0"), rows_per_shard=700).collect()
    want = brute(vectors, [v for v in vectors if v[0] % 30 == 0])
    assert len(rows) == 10 * len(want) and recall(rows, want) >= 0.95
    exact = {(q, i): d for q, w in want.items() for i, d in w}
    assert all(math.isclose(r.score, exact[r.query_id, r.vec_id], rel_tol=1e-12) for r in rows if (r.query_id, r.vec_id) in exact)
    for q in want:
        own = sorted((r.rank, r.score, r.vec_id) for r in rows if r.query_id == q)
        assert [r[0] for r in own] == list(range(1, 11)) and own == sorted(own, key=lambda r: (r[1], r[2]))


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    copies = [(1000 + i, [1.0, 2.0]) for i in range(40)]
    odd = [(1, None), (2, []), (3, [0.0, 0.0]), (4, [1.0, None]), (5, [nan, 1.0]), (6, [inf, 1.0]), (None, [1.0, 1.0]), (7, [1.0, 1.0, 1.0]), (100, [3.0, 4.0]), (100, [3.0, 4.0]), (200, [0.0, 0.0])]
    df = spark.createDataFrame([(i, v, 0) for i, v in copies + odd], "vec_id long, embedding array<float>, rank int")
    rows = hnsw.nearest(df, df.filter("vec_id % 100 = 0")).collect()
    want = brute([*copies, (100, [3.0, 4.0])], [(1000, [1.0, 2.0]), (100, [3.0, 4.0])])
    assert {q: [(r.vec_id, r.score) for r in sorted(rows, key=lambda r: r.rank) if r.query_id == q] for q in want} == want
    assert {r.query_id for r in rows} == {100, 1000}
    assert hnsw.nearest(df.limit(0), df.limit(0)).count() == 0
    one = df.filter("vec_id = 7")
    assert hnsw.nearest(one, one).count() == 0


def test_doubles_and_repeated_ids(spark):
    """Scores are those of double vectors; an id with two vectors gets a list for each, without itself."""
    rng = np.random.default_rng(4)
    x = rng.normal(size=(300, 8))
    vectors = [(i, x[i].tolist()) for i in range(300)] + [(100, (x[7] + 1e-12).tolist())]
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<double>")
    rows = hnsw.nearest(df, df.filter("vec_id = 100"), rows_per_shard=100).collect()
    assert len(rows) == 20
    want = [[(r[1], r[0]) for r in sorted((float(np.sqrt(((np.array(v) - np.array(q)) ** 2).sum())), i) for i, v in vectors if i != 100)[:10]] for i, q in vectors if i == 100]
    got = sorted((r["rank"], r.vec_id, r.score) for r in rows)
    assert got == sorted((n + 1, i, d) for w in want for n, (i, d) in enumerate(w))


def test_a_task_for_each_shard(spark):
    rng = np.random.default_rng(5)
    df = spark.createDataFrame([(i, rng.normal(size=4).tolist()) for i in range(600)], "vec_id long, vec array<float>")
    files = hnsw.index(df, 11, rows_per_shard=100).inputFiles()
    assert len(files) >= 3


@pytest.mark.skipif(not os.path.exists(SF), reason="needs the test tables")
def test_query(spark):
    vectors = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    assert recall(op3_hnsw(spark, SF).collect(), brute(vectors, [v for v in vectors if v[0] % 100 == 0])) >= 0.95
