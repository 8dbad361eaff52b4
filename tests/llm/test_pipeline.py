import hashlib
import math
import os
import re
from collections import Counter, defaultdict

import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from tests.llm.test_minhash import brute as brute_clusters
from tests.llm.test_pii import brute as brute_spans

SF = "/root/testdata/sf0.001"


def measures(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    win = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
    n = Counter(win)
    rep = {j for i, x in enumerate(win) if n[x] > 1 for j in range(i, i + 5)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(rep), len(lines)


def good(rows):
    fails, count = defaultdict(lambda: [0] * 4), Counter()
    for r in rows:
        n, _, sym, dup, rep, lines = measures(r["text"])
        r["bad"] = [n < 10, 100 * rep > 20 * n, 10 * sym > n, 10 * dup > 3 * lines]
        count[r["source"]] += 1
        fails[r["source"]] = [a + b for a, b in zip(fails[r["source"]], r["bad"])]
    out = set()
    for rule in range(4):
        total = sum(count.values())
        mean = sum(f[rule] for f in fails.values()) / total
        spread = sum(fails[s][rule] ** 2 / count[s] for s in count) / total - mean**2 - mean * (1 - mean) * len(count) / total
        strength = min(1e6, max(1.0, mean * (1 - mean) / spread - 1)) if spread > 0 else 1e6
        for s in count:
            rate = (fails[s][rule] + mean * strength) / (count[s] + strength)
            if rate - 1.645 * math.sqrt(rate * (1 - rate) / (count[s] + strength + 1)) > min(0.5, max(0.2, 3 * mean)):
                out.add(s)
    return [r for r in rows if not r["bad"][0] and not r["bad"][1] and r["source"] not in out]


def disclosing(rows):
    near, values, everywhere, words, kinds = Counter(), defaultdict(set), Counter(), 0, Counter()
    for r in rows:
        t = r["text"] or ""
        words += (t.count(" ") + t.count("\n") + 1) if t else 0
        everywhere.update(w.lower() for w in re.findall(r"[^\W\d_]+", t))
        for kind, a, b in brute_spans(t):
            left, right = t[:a].rpartition("\n")[2], t[b:].partition("\n")[0]
            for w in re.findall(r"[^\W\d_]+", left)[-5:] + re.findall(r"[^\W\d_]+", right)[:5]:
                near[kind, w.lower()] += 1
                values[kind, w.lower()].add(t[a:b].lower())
                kinds[kind] += 1
    share = defaultdict(lambda: -9.0)
    for (kind, w), n in near.items():
        if len(values[kind, w]) >= 5:
            share[w] = max(share[w], math.log2(n * words / (max(everywhere[w], n) * kinds[kind])) / -math.log2(kinds[kind] / words))
    return share


def cleaned(t, share):
    spans = brute_spans(t)
    for m in re.finditer(r"[^\W\d_]+", t):
        if share[m[0].lower()] >= 0.8 and not any(a < m.end() and m.start() < b for _, a, b in spans):
            spans.append(("term", *m.span()))
    out, at = "", 0
    for kind, a, b in sorted(spans, key=lambda s: (s[1], -s[2])):
        if b > at:
            if a >= at:
                out += t[at:a] + (f"[{kind.upper()}]" if kind != "term" else "" if share[t[a:b].lower()] >= 0.95 else "[TERM]")
            at = b
    return out + t[at:]


def copies(rows):
    mass = Counter()
    for r in rows:
        mass[r["source"]] += len(r["text"] or "") + 1
    wanted = {s: m**0.7 for s, m in mass.items()}
    for r in rows:
        mean = wanted[r["source"]] / sum(wanted.values()) * sum(mass.values()) / mass[r["source"]]
        u = (int(hashlib.md5(f"{r['doc_id']}:1:17".encode()).hexdigest()[:13], 16) + 0.5) / 2**52
        p, total, n = math.exp(-mean), math.exp(-mean), 0
        while total <= u:
            n += 1
            p *= mean / n
            total += p
        yield from [r] * n


@pytest.mark.skipif(not os.path.exists(SF), reason="needs the test tables")
def test_run_against_brute_force(spark):
    rows = [r.asDict() for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    rows = good(rows)
    roots = brute_clusters([(r["doc_id"], r["text"]) for r in rows], 5, 80)
    rows = [r for r in rows if roots[r["doc_id"]][1] == r["doc_id"]]
    share = disclosing(rows)
    rows = [r | {"text": cleaned(r["text"], share)} for r in rows]
    lib, want = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")), Counter()
    for r in copies(rows):
        ids = lib.encode(r["text"], add_special_tokens=False).ids
        want[r["doc_id"], r["source"], len(ids), tuple(ids), hashlib.sha256(lib.decode(ids, skip_special_tokens=False).encode()).hexdigest()] += 1
    got = Counter((r.doc_id, r.source, r.n_tokens, tuple(r.ids), r.decoded_sha256) for r in corpus_pipeline.run(spark, SF).collect())
    assert got == want


def test_odd_documents(spark):
    words = " ".join(f"w{i}" for i in range(60))
    rows = [(1, words, "a"), (1, words, "a"), (2, words + " more", "a"), (3, None, "a"), (4, "", None), (None, words.replace("w", "v"), None), (5, "x " * 50, "b"), (6, " ".join(f"u{i}" for i in range(5000)), None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("kept", docs_column())
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns, name
        assert stage(spark, docs.limit(0), SF).count() == 0
        if name == "quality rules":
            assert sorted(str(r.doc_id) for r in out.collect()) == ["1", "1", "2", "6", "None"]
        if name == "near duplicates":
            assert sorted(str(r.doc_id) for r in out.collect()) == ["1", "3", "4", "5", "6", "None"]
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SF).count() == len(rows)


def test_near_duplicates_of_repeated_ids(spark):
    """A text of a repeated id that copies an earlier document goes, and the id's own other text stays."""
    a, b = " ".join(f"a{i}" for i in range(60)), " ".join(f"b{i}" for i in range(60))
    rows = [(1, a), (2, a + " more"), (2, b), (2, b), (3, b + " more")]
    out = corpus_pipeline.near_duplicates(spark, spark.createDataFrame(rows, "doc_id long, text string"), SF)
    assert sorted(map(tuple, out.collect())) == [(1, a), (2, b)]


def docs_column():
    from pyspark.sql import functions as F

    return F.lit("kept")
