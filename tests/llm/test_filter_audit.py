import itertools
import random
import re
from collections import Counter

from pyspark.sql import functions as F

from geoquilt.llm import filter_audit
from geoquilt.llm.queries import op11_term_matrix_audit, oracle_sql
from tools.verify import compare

SF = "/root/testdata/sf0.001"


def failed(rows):
    least = {}
    for i, t, _ in rows:
        if i is not None:
            least[t or ""] = min(least.get(t or "", i), i)
    out = []
    for i, t, part in rows:
        t = t or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = [len(w) < 50, 100 * len(set(w)) < 65 * len(w), 100 * len(re.findall("[A-Z]", t)) > 5 * len(t), bool(re.search(r"[#$%&*|]", t)), i is not None and i > least[t]]
        out.append((i, part or "", frozenset(c for c, bad in zip("ABCDE", fails, strict=True) if bad)))
    return out


def brute(rows, labels):
    docs, out = failed(rows), []
    good, toxic = ({i for i, q, x in labels if i is not None and (q, x)[k] == 1} for k in (0, 1))
    for part in {p for _, p, _ in docs}:
        mine = [(i, f) for i, p, f in docs if p == part]
        removed = Counter()
        for order in map("".join, itertools.permutations("ABCDE")):
            left = mine
            for step, c in enumerate(order, 1):
                gone = [(i, f) for i, f in left if c in f]
                redundant = sum(c in f for _, f in mine) - len(gone)
                left = [(i, f) for i, f in left if c not in f]
                removed[c] += len(gone)
                out.append([part, order, step, len(left), len(gone), redundant, sum(f == {c} for _, f in mine), sum(i in good for i, _ in gone), sum(i in toxic for i, _ in gone)])
        for row in out:
            if row[0] == part:
                row.append(removed[row[1][row[2] - 1]])
    return sorted(map(tuple, out))


def test_against_brute_force(spark):
    rng = random.Random(5)
    words = [f"w{i}" for i in range(60)] + ["HASH", "#", "É", "a&b", "x\x1cy", "z\xa0z"]
    rows = []
    for i in range(300):
        t = " ".join(rng.choice(words[: rng.choice([5, 60, 66])]) for _ in range(rng.choice([0, 3, 49, 50, 51, 90])))
        rows.append((i, rng.choice([t, t, t.replace(" ", "\n\t")]), rng.choice(["a", "b", None, ""])))
    rows += [(1000 + i, rows[i][1], "a") for i in range(40)] + rows[:5]
    rows += [(None, rows[0][1], "b"), (None, "never", None), (2000, None, None), (2001, "", "c"), (2002, None, "c"), (2003, " \n", "d"), (2004, "word " * 300_000, "d"), (2005, " ".join(map(str, range(100_000))), "d")]
    labels = [(i, i % 2, i % 3 == 0 and 1 or 0) for i in range(0, 1040, 2)] + [(2, 1, 1), (2, 1, 1), (None, 1, 1), (4, None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumns({"part": F.lit(1), "total": F.lit("x"), "words": F.lit(2)}).repartition(4)
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int").withColumn("id", F.lit(1))
    got = filter_audit.audit(df, marks)
    assert sorted(map(tuple, got.collect())) == brute(rows, labels)
    assert filter_audit.audit(df.limit(0), marks).count() == 0
    assert {r.good_lost for r in filter_audit.audit(df.limit(9), marks.limit(0)).collect()} == {0}


def test_matrix_has_one_number_for_a_word(spark, monkeypatch):
    monkeypatch.setattr(filter_audit, "SHARD_BYTES", 40)
    texts = ["b a b", None, "c b", "", "a a a d", "é b É"] * 9
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    matrix = filter_audit.TermMatrix(df, ["doc_id"], "text")
    number = {bytes(r.word).decode(): r.term for r in matrix.dictionary.collect()}
    assert len(set(number.values())) == len(number) == 6
    name = {v: k for k, v in number.items()}
    rows = {}
    for s in matrix.shards().collect():
        for k, doc in enumerate(s.docs):
            at = slice(s.starts[k], s.starts[k + 1])
            rows[doc.doc_id] = Counter({name[t]: c for t, c in zip(s.terms[at], s.counts[at], strict=True)})
    assert rows == {i: Counter((t or "").split()) for i, t in enumerate(texts)}
    assert {r.doc_id: (r.total, r.nonzero) for r in matrix.row_sums().collect()} == {i: (len((t or "").split()), len({*(t or "").split()})) for i, t in enumerate(texts)}


def test_shards_are_written_in_short_rows(spark):
    """readers and writers hold many rows at once, so no row may hold what grows with a shard."""
    rng = random.Random(3)
    texts = [" ".join(f"w{rng.randrange(30_000)}" for _ in range(120)) for _ in range(600)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    matrix = filter_audit.TermMatrix(df, ["doc_id"], "text")
    assert matrix.local.select("part", "piece").distinct().count() == 1
    assert matrix.local.agg(F.max(F.greatest(F.size("columns"), F.size("words")))).first()[0] <= 256
    assert matrix.dictionary.count() == len({w for t in texts for w in t.split()}) > 20_000
    rows = matrix.shards().collect()
    assert len(rows) == 2 and [d.doc_id for r in sorted(rows, key=lambda r: r.docs[0].doc_id) for d in r.docs] == list(range(600))
    assert {r.doc_id: (r.total, r.nonzero) for r in matrix.row_sums().collect()} == {i: (120, len({*t.split()})) for i, t in enumerate(texts)}


def test_sql(spark):
    assert compare(spark, "op11", op11_term_matrix_audit, oracle_sql()["op11_term_matrix_audit"], SF).startswith("ok")
