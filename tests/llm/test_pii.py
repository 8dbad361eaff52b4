import hashlib
import math
import os
import random
import re
from collections import Counter, defaultdict

import pytest

from geoquilt.llm import pii
from geoquilt.llm.queries import op5_disclosure

SF = "/root/testdata/sf0.001"
PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def brute(text):
    out = []
    for kind, p in PATTERNS.items():
        for m in re.finditer(p, text or ""):
            d = re.sub(r"[^0-9]", "", m[0])
            ok = {
                "email": True,
                "ip": all(int(x) <= 255 for x in m[0].split(".")) if kind == "ip" else True,
                "card": 16 <= len(d) <= 19 and sum(int(c) if i % 2 == 0 else (2 * int(c) - 9 if c > "4" else 2 * int(c)) for i, c in enumerate(reversed(d))) % 10 == 0,
                "phone": 8 <= len(d) <= 15,
            }[kind]
            if ok:
                out.append((kind, *m.span()))
    return out


HARD = [
    "a@b.c", "@b.c x@@y.z a@b@c.de", "a@b..c a@b.c.", "q.w+e%r-t_@x-y.z1.-", "1.2.3.4.5.6.7.8 256.1.1.1 0255.1.1.1 1..2.3.4.5", "é1.2.3.4é", "4111 1111 1111 1111", "4111-1111--1111-1111 4111111111111111 5",
    "+1 (743) 555-3824 x +1+12345678 +12345678) ", "+4 ", "", "a" * 5000 + "@", "1" * 5000, "1." * 3000, "x@y.z@w.v", "١٢٣.1.1.1", "4111111111111111" * 2, "user@host user@host.com,other@host.org\nu@v.w",
]


@pytest.mark.parametrize("text", HARD)
def test_patterns(text):
    assert pii.base_spans(text) == brute(text)


def test_long_text_is_linear():
    text = "a" * 400_000 + "@ " + "7" * 400_000 + " " + "1." * 200_000 + "@" * 100_000
    assert {k for k, *_ in pii.base_spans(text)} == {"ip"}


def test_revealing_terms(spark):
    rows = [(i, f"plain words of no import. Call Hotline {'+1 555 000 %04d' % i} now") for i in range(30)]
    rows += [(100 + i, "plain words of no import or call now") for i in range(60)]
    rows += [(200 + i, "the Quokka wrote to one@same.org") for i in range(50)]  # one value: copies are no evidence
    rows += [(300, None), (301, ""), (302, "the hotline, again"), (300, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'x' AS spans", "1 AS clean")
    got = {r.doc_id: r for r in pii.sanitise(df, keep=["doc_id"]).collect()}
    found = {r.term: r for r in pii.disclosures(df).collect()}
    assert found["hotline"].share > 0.95 and found["hotline"].n_values == 30 and "quokka" not in found and found["call"].share < 0.8
    assert got[0].clean == "plain words of no import. Call  [PHONE] now"
    assert got[100].clean == "plain words of no import or call now" and got[100].spans == []
    assert got[200].clean == "the Quokka wrote to [EMAIL]"
    assert got[300].clean is None and got[301].clean == "" and got[302].clean == "the , again"
    assert [(s.kind, s.start, s.end) for s in got[0].spans] == [("phone", 39, 54), ("term", 31, 38)]
    assert pii.sanitise(df.limit(0)).count() == 0 and pii.sanitise(df).count() == len(rows)


@pytest.mark.parametrize("most", [pii.SENT, 0])
def test_name_beside_one_value(spark, monkeypatch, most):
    monkeypatch.setattr(pii, "SENT", most)  # 0: terms are joined instead of sent
    rows = [(i, f"on day {'abcdefghij'[i % 10]}{'klm'[i // 10]} Quokka wrote to one@same.org") for i in range(30)]
    rows += [(40 + i, "on a day the once seen wombat wrote to two@same.org") for i in range(30)]  # copies are no evidence
    rows += [(100 + i, f"on day {'abcdefghij'[i % 10]}{'nopqr'[i // 10]} nobody wrote to anyone") for i in range(50)]
    rows += [(200, "the quokka"), (201, None), (202, ""), (200, "the quokka")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.term: r for r in pii.disclosures(df).collect()}
    assert found["quokka"].kind == "email" and (found["quokka"].n_near, found["quokka"].n_all) == (30, 31) and found["quokka"].share >= 0.8
    assert "wombat" not in found and found["wrote"].share < 0.8
    got = {r.doc_id: r for r in pii.sanitise(df, keep=["doc_id"]).collect()}
    assert got[0].clean == "on day ak [TERM] wrote to [EMAIL]" and got[200].clean == "the [TERM]"
    assert got[40].clean == "on a day the once seen wombat wrote to [EMAIL]" and got[100].clean == rows[60][1] and got[201].clean is None
    assert pii.sanitise(df).count() == len(rows)


@pytest.mark.parametrize("close", [pii.CLOSE, 7, 0])
def test_words_near_a_span(monkeypatch, close):
    """Words of any length count, whole, however far they reach; a few or no words on a long line are found in one sweep."""
    monkeypatch.setattr(pii, "CLOSE", close)
    long = [f"{c}{'x' * 400}" for c in "abcdefghijkl"]
    texts = [" ".join([*long[:6], "a@b.cd", *long[6:]]), f"{'1 ' * 500}one{' 2' * 500} a@b.cd {'. ' * 900}two\nthree", "éa@b.cdé x\n", "no\na b c d e f g +12345678 h i j k l m\nno", " ".join(f"9.9.9.{i % 200}" for i in range(3000)) + " end"]
    for t in texts:
        words = pii.Words(t)
        for _, a, b in pii.base_spans(t):
            left, right = t[:a].rpartition("\n")[2], t[b:].partition("\n")[0]
            want = [w.lower() for w in pii.WORD.findall(left)[-5:] + pii.WORD.findall(right)[:5]]
            assert words.near(a, b) == want


def test_terms_outside_of_spans():
    text = "ann a@ann.org ann 1.2.3.4 ann@x.yz ann"
    base = pii.base_spans(text)
    assert [text[a:b] for _, a, b in pii.term_spans(text, frozenset(["ann"]), base)] == ["ann"] * 3
    many = "1.2.3.4 ann " * 30_000
    assert len(pii.term_spans(many, frozenset(["ann"]), pii.base_spans(many))) == 30_000


def test_overlaps():
    text = "a1.2.3.4@x.org tail"
    assert pii.clean(text, [("email", 0, 14), ("ip", 1, 8)], frozenset()) == "[EMAIL] tail"


@pytest.mark.skipif(not os.path.exists(SF), reason="needs the test tables")
def test_query(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = op5_disclosure(spark, SF).collect()
    assert len(rows) == len(docs)
    for r in rows:
        want = brute(docs[r.doc_id])
        text = ",".join(f"{k}:{a}:{b}" for k, a, b in want)
        assert r.base_sha256 == hashlib.sha256(text.encode()).hexdigest() and r.spans.startswith(text)
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s[0] == k for s in want) for k in PATTERNS]


def brute_disclosing(texts, min_values=5, least=0.8):
    """The terms whose pointwise mutual information with a kind, or with a single value, reaches ``least`` of it, by counting."""
    word = re.compile(r"[^\W\d_]+")
    every = [t for t in texts if t]
    all_words = sum(t.count(" ") + t.count("\n") + 1 for t in every)
    near, held, anywhere, in_texts = Counter(), defaultdict(set), Counter(), defaultdict(set)
    for t in every:
        anywhere.update(w.lower() for w in word.findall(t))
        for w in {w.lower() for w in word.findall(t)}:
            in_texts[w].add(t)
        for kind, a, b in brute(t):
            left, right = t[:a].rpartition("\n")[2], t[b:].partition("\n")[0]
            for w in word.findall(left)[-5:] + word.findall(right)[:5]:
                near[kind, w.lower(), t[a:b].lower()] += 1
                held[kind, t[a:b].lower(), w.lower()].add(t)
    of_kind = Counter()
    for (kind, _, _), n in near.items():
        of_kind[kind] += n
    best = defaultdict(float)
    by_term = defaultdict(list)
    for (kind, w, _), n in near.items():
        by_term[kind, w].append(n)
    for (kind, w), ns in by_term.items():
        information = -math.log2(of_kind[kind] / all_words)
        if len(ns) >= min_values and information > 0:
            best[w] = max(best[w], math.log2(sum(ns) * all_words / (max(anywhere[w], sum(ns)) * of_kind[kind])) / information)
    value_texts = defaultdict(set)
    for (kind, value, _), ts in held.items():
        value_texts[kind, value] |= ts
    for (kind, value, w), ts in held.items():
        n, information = len(ts), -math.log2(len(value_texts[kind, value]) / len(set(every)))
        if information > 0:
            given = -math.log2(n / len(in_texts[w]))
            best[w] = max(best[w], (information - given) / information * n / (n + 1))
    return {w for w, share in best.items() if share >= least}


def test_query_spans_against_brute_force(spark, tmp_path):
    """The full spans of the query, terms too, over documents in which names stand beside one value and words beside many."""
    rng = random.Random(9)
    words = [a + b for a in ("ka", "lo", "mi", "tu", "re", "so") for b in ("ban", "dor", "fel", "gim", "hul")]
    say = lambda n: " ".join(rng.choices(words, k=n))
    texts = [say(rng.randrange(5, 60)) for _ in range(300)]
    texts += [f"{say(7)} Hotline +1 555 000 {i:04d} {say(8)}" for i in range(40)]
    texts += [f"{say(8)} {who} {rng.choice(['of', 'at'])} {mail} {say(7)}" for who, mail in (("Wenzel", "w@one.org"), ("Ottilie", "o@two.org")) for _ in range(rng.randrange(25, 40))]
    texts += [f"{say(6)} Bertram b@three.org"] * 30 + [f"{say(9)} host 10.0.0.{i} {say(5)}\nthe hotline\nWenzel" for i in range(30)] + [None, "", "hotline wenzel ottilie bertram w@one.org"]
    rows = [(i, t, "en", "s", len(t or "")) for i, t in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").coalesce(2).write.parquet(f"{tmp_path}/documents.parquet")
    flagged = brute_disclosing(texts)
    assert {"hotline", "ottilie"} & flagged and "bertram" not in flagged and not flagged & set(words)
    got = {r.doc_id: r for r in op5_disclosure(spark, str(tmp_path)).collect()}
    found = 0
    for i, t in enumerate(texts):
        base = brute(t)
        terms = [("term", *m.span()) for m in re.finditer(r"[^\W\d_]+", t or "") if m[0].lower() in flagged and not any(a < m.end() and m.start() < b for _, a, b in base)]
        found += len(terms)
        assert got[i].spans == ",".join(f"{k}:{a}:{b}" for k, a, b in base + terms), t
        assert got[i].base_sha256 == hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in base).encode()).hexdigest()
    assert found > 60
    print("flagged", flagged, "spans", found)
