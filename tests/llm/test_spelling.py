import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from geoquilt.llm import spelling
from geoquilt.llm.queries import op13_gram_variants, oracle_sql
from tools.verify import compare

SF = "/root/testdata/sf0.001"


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(a) + 1 == len(b) and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(words, ratio=10):
    near = {w: [v for v in words if one_edit(w, v)] for w in words}
    form = {}
    for w, vs in near.items():
        best = min(vs, key=lambda v: (-words[v], v), default=None)
        if best is not None and words[best] >= ratio * words[w]:
            form[w] = best
    out = []
    for w in words:
        root = w
        while root in form:
            root = form[root]
        out.append((w, form.get(w), root, words[w], len(near[w]), words[form[w]] if w in form else None))
    return sorted(out)


@pytest.mark.parametrize("block", [4096, 3])
def test_against_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(spelling, "BLOCK", block)
    monkeypatch.setattr(spelling, "FACING", block)
    monkeypatch.setattr(spelling, "ROWS", 2)
    rng = random.Random(block)
    words = {}
    for _ in range(90):
        w = "".join(rng.choice("abcÀÿé") for _ in range(rng.choice([7, 8])))
        for k in range(4):
            i, c = rng.randrange(len(w)), rng.choice("abcÀÿé")
            words[w] = rng.choice([2, 3, 30, 300, 3000])
            w = rng.choice([w[:i] + w[i + 1 :], w[:i] + c + w[i:], w[:i] + c + w[i + 1 :]])
    long = "a" * 30_000
    words |= {long: 500, long + "b": 50, long[:-1] + "b": 2, "aaaaaaa": 4, "aaaaaaaa": 40, "aaaaaaaaa": 400}
    rows = [(w, n - 1) for w, n in words.items()] + [(w, 1) for w in words] + [(None, 5)]
    df = spark.createDataFrame(rows, "word string, n long").withColumns({"block": F.lit(1), "home": F.lit("x")})
    got = spelling.variants(df)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert sorted(map(tuple, got.collect())) == brute(words)
    assert spelling.variants(df.limit(0)).count() == 0


def test_words_of_texts(spark):
    texts = ["Elephant elephant ÉLÉPHANT éléphant elephant-ELEPHANT", None, "", "short words", "elephants×elephants÷elephants", "ß" * 9, "q" * 50_000, "elephant1elephant_elephant"] * 40
    rows = [(i if i % 7 else None, t) for i, t in enumerate(texts)] + [(1, texts[0])] * 2
    want = Counter()
    for i, t in rows:
        for w in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            w = re.sub("[A-Z]", lambda m: m[0].lower(), w)
            h = zlib.crc32(f"{'null' if i is None else i}:{w}".encode())
            if h % 31 == 0:
                w = w[: h % len(w)] + w[h % len(w) + 1 :]
            if len(w) >= 7:
                want[w] += 1
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("word", F.lit("x"))
    got = spelling.count_words(spelling.with_slips(spelling.letter_runs(df, "doc_id", "text", 7)))
    assert {r.word: r.n for r in got.collect()} == {w: n for w, n in want.items() if n >= 2}


def test_forms_are_followed_to_the_last(spark):
    links = spark.createDataFrame([(f"w{i}", f"w{i + 1}") for i in range(9)] + [("x", "y")], "word string, form string")
    assert {r.word: r.root for r in spelling.roots(links).collect()} == {f"w{i}": "w9" for i in range(9)} | {"x": "y"}


def test_sql(spark):
    assert compare(spark, "op13", op13_gram_variants, oracle_sql()["op13_gram_variants"], SF).startswith("ok")
