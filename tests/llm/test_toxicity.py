import os
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from geoquilt.llm import toxicity
from geoquilt.llm.queries import op1_classifier_chain

SF, SMALL = "/root/testdata/sf0.1", "/root/testdata/sf0.001"


def test_presence_is_by_words():
    doc, word = toxicity.words_and_stems(pa.array(["Idiot, idiot! ÉTÉ", None, "", "an été", "idiot's"]))
    of = {i: set(word[doc == i].tolist()) for i in range(5)}
    assert len(of[0]) == 4 and of[1] == of[2] == set() and len(of[0] & of[3]) == 2 and len(of[0] & of[4]) == 2


def test_fit_separates():
    rng = np.random.default_rng(0)
    x = (rng.random((800, 5)) < 0.4).astype(float)
    y = (x[:, 0] + x[:, 1] > 0).astype(float)
    none = np.zeros((800, 0))
    w = toxicity.fit(x, none, y)
    assert ((toxicity.logit(x, none, w) > 0) == (y == 1)).mean() == 1 and abs(w[2:5]).max() < 0.8
    assert toxicity.fit(x, none, np.ones(800))[-1] > 10 and toxicity.fit(x[:0], none[:0], y[:0])[-1] < -10


def test_chain_feeds_earlier_categories(spark):
    """The second category can only be told through the first one's words together; the chain finds it and ignores nulls."""
    rng = np.random.default_rng(1)
    docs, labels = [], []
    for i in range(600):
        bad = i % 3 == 0
        w = [f"w{j}" for j in rng.integers(0, 200, 30)] + ([f"bad{rng.integers(0, 3)}"] if bad else [])
        docs.append((i, " ".join(rng.permutation(w)), "x"))
        if i < 500:
            labels.append((i, int(bad), int(bad) if i % 7 else None))
    docs += [(1000, None, "x"), (1001, "", "x"), (1002, "bad1 " * 3000, "x"), (0, docs[0][1], "x")]
    d = spark.createDataFrame(docs, "doc_id long, text string, p_a string")
    lab = spark.createDataFrame(labels, "doc_id long, a int, b int")
    got = toxicity.classify(d, lab, ["a", "b"])
    assert got.columns == ["doc_id", "text", "p_a", "is_a", "p_b", "is_b"] or got.columns == ["doc_id", "text", "p_a", "is_a", "p_b", "is_b"][:2] + ["p_a", "is_a", "p_b", "is_b"]
    rows = {r.doc_id: r for r in got.collect()}
    held = [i for i in range(500, 600)]
    assert all(rows[i].is_a == rows[i].is_b == (i % 3 == 0) for i in held)
    assert rows[1002].is_b and not rows[1000].is_b and rows[1000].p_b == rows[1001].p_b
    assert toxicity.classify(d.limit(0), lab, ["a"]).count() == 0
    assert toxicity.classify(d, lab.limit(0), ["a", "b"], keep=["doc_id"]).filter("is_a OR is_b").count() == 0


def brute_chain(docs, labels, folds, most=400):
    """p of each document and category: all in plain arrays, models by plain Newton steps to the end."""
    words = {i: set(toxicity.words_and_stems(pa.array([t]))[1].tolist()) for i, t in docs.items()}
    rows = [(i, y) for i, y in sorted(labels.items()) if i in docs]
    chosen = set()
    for c in range(2):
        df, ones, n, total = Counter(), Counter(), 0, 0
        for i, y in rows:
            if y[c] is not None:
                n, total = n + 1, total + y[c]
                df.update(words[i])
                ones.update(words[i] if y[c] else ())
        score = {w: (ones[w] - df[w] * total / n) ** 2 / (df[w] * total / n * (1 - df[w] / n) + 1) for w in df if df[w] >= 3}
        chosen |= set(sorted(score, key=lambda w: (-score[w], w))[: most // 2])
    chosen = sorted(chosen)
    matrix = lambda ids: np.array([[w in words[i] for w in chosen] for i in ids], float)

    def model(x, y):
        x = np.c_[x, np.ones(len(x))]
        ridge = np.r_[np.ones(x.shape[1] - 1), 1e-6]
        w = np.zeros(x.shape[1])
        for _ in range(60):
            q = 1 / (1 + np.exp(-x @ w))
            step = np.linalg.lstsq((x.T * (q * (1 - q))) @ x + np.diag(ridge), x.T @ (y - q) - ridge * w, rcond=None)[0]
            w = w + step
            if abs(step).max() < 1e-10:
                break
        return w

    of = lambda x, w: 1 / (1 + np.exp(-(np.c_[x, np.ones(len(x))] @ w)))
    ids, every = [i for i, _ in rows], list(docs)
    x, xa, fold = matrix(ids), matrix(every), np.array([folds[i] for i in ids])
    out = []
    for c in range(2):
        known = np.array([y[c] is not None for _, y in rows])
        y = np.array([y[c] or 0 for _, y in rows], float)
        unseen = np.zeros(len(ids))
        for f in range(5):
            unseen[fold == f] = of(x[fold == f], model(x[known & (fold != f)], y[known & (fold != f)]))
        p = of(xa, model(x[known], y[known]))
        out.append(p)
        x, xa = np.c_[x, unseen], np.c_[xa, p]
    return {i: (out[0][j], out[1][j]) for j, i in enumerate(every)}


@pytest.mark.skipif(not os.path.exists(SMALL), reason="needs the test tables")
def test_query_against_brute_force(spark):
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    labels = {r.doc_id: (1 - r.quality, r.toxic) for r in spark.read.parquet(f"{SMALL}/labels.parquet").collect()}
    ids = spark.createDataFrame([(i,) for i in labels], "id long")
    folds = {r.id: r.fold for r in ids.select("id", F.pmod(F.xxhash64("id", F.lit(5)), F.lit(5)).alias("fold")).collect()}
    want = brute_chain(docs, labels, folds)
    got = {r.doc_id: (r.p_unwanted, r.p_toxic) for r in op1_classifier_chain(spark, SMALL).collect()}
    assert got.keys() == want.keys()
    assert max(abs(a - b) for i in got for a, b in zip(got[i], want[i])) < 1e-4


@pytest.mark.skipif(not os.path.exists(SF), reason="needs the test tables")
def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", (1 - F.col("quality")).alias("unwanted"), "toxic")
    seen, held = labels.filter("doc_id % 4 <> 1"), labels.filter("doc_id % 4 = 1")
    rows = toxicity.classify(docs, seen, ["unwanted", "toxic"], keep=["doc_id"]).join(held.select("doc_id", "toxic"), "doc_id").collect()
    hits = sum(r.is_toxic and r.toxic == 1 for r in rows)
    print("held out", len(rows), "toxic", sum(r.toxic for r in rows), "found", hits, "called", sum(r.is_toxic for r in rows))
    called, toxic = sum(r.is_toxic for r in rows), sum(r.toxic for r in rows)
    assert hits / toxic >= 0.9 and hits / called >= 0.9  # of documents that training hasn't seen
    assert not re.search("nan", str(rows[0]))


def test_repeated_ids_are_learnt_from_once(spark, monkeypatch):
    """Ids that stand a thousand times, with other texts and labels, give no more rows to learn from than ids."""
    rows = [(i % 4, f"text {i % 7} of {i % 4}") for i in range(4000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(4)] * 3, "doc_id long, toxic int")
    seen = []
    real = toxicity.train_chain
    monkeypatch.setattr(toxicity, "train_chain", lambda x, y, fold: seen.append(len(x)) or real(x, y, fold))
    assert toxicity.classify(docs, labels, ["toxic"], most_rows=2).count() == 4000
    assert toxicity.classify(docs, labels, ["toxic"]).count() == 4000
    assert seen == [2, 4]
