import itertools
import os
import re

import numpy as np
import pyarrow as pa
import pytest

from geoquilt.llm import minhash
from geoquilt.llm.shingles import shingle_sets

SF = "/root/testdata/sf0.001"


def brute(rows, k=3, percent=85):
    sets = {}
    for i, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets[i] = {tuple(w[j : j + k]) for j in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in itertools.combinations(sorted(sets), 2):
        x, y = sets[a], sets[b]
        if x and y and 100 * len(x & y) >= percent * len(x | y):
            p, q = sorted((find(a), find(b)))
            root[q] = p
    return {i: (len(sets[i]), find(i)) for i in sets}


def test_sets_match_python():
    texts = ["A b c d", "", None, "one", "x  y\tz\nx y z", "é É", "a b c d" * 1000, "w" * 300_000 + " b c"]
    got = shingle_sets(pa.array(texts), 3)
    assert [len(s) for s in got] == [brute([(0, t)])[0][0] for t in texts]
    assert (shingle_sets(pa.array(["a b c d"]), 3)[0] == got[0]).all()
    assert (shingle_sets(pa.array(texts).slice(4, 1), 3)[0] == got[4]).all()


def test_sketch_estimates():
    rng = np.random.default_rng(1)
    a = rng.integers(0, 2**63, 1000).astype(np.uint64)
    b = np.concatenate([a[:800], rng.integers(0, 2**63, 200).astype(np.uint64)])
    s = minhash.sketches([a, b, a[:3], a[:0]], 252)
    assert abs((s[0] == s[1]).mean() - 800 / 1200) < 0.12
    empty = np.iinfo(np.uint64).max
    assert (s[:3] != empty).all() and (s[3] == empty).all()


def test_hand_made(spark):
    base = " ".join(f"w{i}" for i in range(100))
    rows = [(5, base), (3, base.upper()), (9, base + " tail"), (11, "x y"), (12, "x y"), (13, None), (14, ""), (15, " \n"), (16, "q"), (9, base + " tail"), (None, base)]
    df = spark.createDataFrame([(i, t, "c") for i, t in rows], "doc_id long, text string, component_id string")
    got = sorted((tuple(r)[:4] for r in minhash.cluster(df).collect()), key=str)
    assert got == sorted([(5, 98, 3, False), (3, 98, 3, True), (9, 99, 3, False), (9, 99, 3, False), (11, 1, 11, True), (12, 1, 11, False), (13, 0, 13, True), (14, 0, 14, True), (15, 0, 15, True), (16, 1, 16, True), (None, 98, None, True)], key=str)
    assert minhash.cluster(df.limit(0)).count() == 0


def test_blocks_of_a_large_family(spark, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK", 8)
    rng = np.random.default_rng(2)
    rows = []
    for i in range(60):
        w = [f"w{j}" for j in range(120)]
        for j in rng.integers(0, 120, rng.integers(0, 8)):
            w[j] = f"v{i}x{j}"
        rows.append((i, " ".join(w)))
    got = {r["id"]: (r["n_shingles"], r["component_id"]) for r in minhash.cluster(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == brute(rows)


def test_texts_of_one_id(spark):
    """Two texts of one id have links of their own; one row of each group is chosen."""
    a, b = " ".join(f"a{i}" for i in range(60)), " ".join(f"b{i}" for i in range(60))
    rows = [(1, a), (1, b), (5, a + " more"), (6, b + " more"), (7, "alone in this")]
    got = minhash.cluster(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r["id"], r["component_id"]) for r in got) == [(1, 1), (1, 1), (5, 1), (6, 1), (7, 7)]
    assert sorted(r["id"] for r in got if r["chosen"]) == [1, 1, 7]


def test_words_that_fool_polynomials():
    """The Thue-Morse word and its complement, which collide in any polynomial hash of 64-bit overflow."""
    bits = [bin(i).count("1") % 2 for i in range(2048)]
    t, u = ("".join("ab"[x ^ flip] for x in bits) for flip in (0, 1))
    x, y = shingle_sets(pa.array([f"x {t} y", f"x {u} y"]), 3)
    assert len(x) == len(y) == 1 and x[0] != y[0]
    some = [f"{'w' * n}{c}" for n in range(70) for c in "abc"]
    sets = shingle_sets(pa.array(some), 3)
    assert len({int(v[0]) for v in sets}) == len(some)


@pytest.mark.skipif(not os.path.exists(SF), reason="needs the test tables")
def test_table_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = {r["id"]: (r["n_shingles"], r["component_id"]) for r in minhash.cluster(docs).collect()}
    assert got == brute(rows)
