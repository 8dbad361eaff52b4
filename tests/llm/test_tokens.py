import hashlib
import os
import tempfile

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from geoquilt.llm import bpe, token_counts
from geoquilt.llm.queries import op7_pair_index_bpe, op8_cached_counts

WORD, BYTE = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.json")
SF = "/root/testdata/sf0.001"
TEXTS = ["Hello World's <|endoftext|> étude 12 ab!!", "", None, "aaaaaaaa aaaaaaa aaa", " \n\t", "ΑΣ ΌΔΟΣ İstanbul ﬁ Ǆ 日本語 😀👍🏽 é ẛ̣", "<|startoftext|><|endoftext|>x<|endoftext", "x" * 20_000, "don't DON'T we'll l'eau", "a\x1cb\x85c\xa0d e", "Ünïcödé ÀÉ ĲĲ ŉ", "the " * 5000, "٣٤ ½ ² Ⅷ"]


def test_same_as_library(spark):
    lib = Tokenizer.from_file(WORD)
    df = spark.createDataFrame([(i, t, 1) for i, t in enumerate(TEXTS)], "doc_id long, text string, ids int")
    coded = bpe.encode(df, "text", WORD, ["doc_id"])
    got = {r.doc_id: r.ids for r in coded.collect()}
    decoded = {r.doc_id: r.decoded for r in bpe.decode(coded, "ids", WORD, ["doc_id"]).collect()}
    for i, t in enumerate(TEXTS):
        want = lib.encode(t or "", add_special_tokens=False).ids
        assert got[i] == want, t
        assert decoded[i] == lib.decode(want, skip_special_tokens=False)
    assert bpe.encode(df.limit(0), "text", WORD, ["doc_id"]).count() == 0
    both = {r.doc_id: (r.ids, r.decoded) for r in bpe.encode(df, "text", WORD, ["doc_id", "ids"], decoded="decoded").collect()}
    assert both == {i: (got[i], decoded[i]) for i in got}
    odd = spark.createDataFrame([(1, [5, -1, 10**6, None, 49407]), (2, []), (3, None)], "k int, ids array<int>")
    assert [r.decoded for r in bpe.decode(odd, "ids", WORD, ["k", "ids"], "ids").withColumnRenamed("ids", "decoded").sort("k").collect()] == [lib.decode([5, 49407], skip_special_tokens=False), "", None]


def test_forgetting_changes_nothing(monkeypatch):
    words = bpe.vocabulary(WORD)
    monkeypatch.setattr(bpe, "REMEMBERED", 2)
    known = bpe.Remembered(words)
    texts = ["one two three", "two three four five", "one", "six <|endoftext|> two one", "five six seven one <|endoftext|>"]
    each = [known.encode([t])[0].tolist() for t in texts]
    flat, limits = bpe.Remembered(words).encode(texts)
    assert each == [flat[a:b].tolist() for a, b in zip(limits[:-1], limits[1:])]


@pytest.mark.parametrize("latin", [True, False])
def test_long_text_in_parts(monkeypatch, latin):
    """A text much longer than what is held at once, with runs that can't be cut, gives what the library gives."""
    import random

    from geoquilt.llm import common

    monkeypatch.setattr(bpe, "AT_ONCE", 500)
    monkeypatch.setattr(bpe, "REMEMBERED", 300)
    monkeypatch.setattr(bpe, "spans", lambda t: common.spans(t, 1000))
    rng = random.Random(5)
    syllables = [a + b for a in "bdfgklmnprst" for b in ("a", "ei", "o", "é", "'s", "1", "--")] + ["aaaa", "\n", "\t", *([] if latin else ["日本", "ΣΑΣ", "e\u0301"])]
    text = " ".join("".join(rng.choices(syllables, k=rng.randint(1, 6))) for _ in range(20_000)) + " " + "x" * 5000 + "\n" + "ab" * 3000
    lib, words = Tokenizer.from_file(WORD), bpe.vocabulary(WORD)
    flat, limits = bpe.Remembered(words).encode([None, text, "end"])
    want = lib.encode(text, add_special_tokens=False).ids
    assert flat[limits[1] : limits[2]].tolist() == want and limits[1] == 0
    assert bpe.joined_tokens(words, flat, limits)[1] == lib.decode(want, skip_special_tokens=False)


def test_cache(spark):
    lib = Tokenizer.from_file(BYTE)
    cache = tempfile.mkdtemp(prefix="spark-cache-") + "/c"
    rows = [(i, t, "x", "y") for i, t in enumerate([*TEXTS, *TEXTS, "twice", "twice"])]
    df = spark.createDataFrame(rows, "doc_id long, text string, digest string, n_tokens string")
    got = {r.doc_id: (r.n_bytes, r.n_tokens) for r in token_counts.count_tokens(df, "text", BYTE, cache, ["doc_id"]).collect()}
    assert got == {i: (len((t or "").encode()), len(lib.encode(t or "", add_special_tokens=False).ids)) for i, t, *_ in rows}
    size = spark.read.parquet(cache).count()
    assert size == len({t or "" for _, t, *_ in rows})
    # a marked count shows that known contents come from the cache, and only new ones are encoded
    other = tempfile.mkdtemp(prefix="spark-cache-") + "/c"
    known = [(token_counts.version_of(BYTE), bytearray(hashlib.sha256(b"twice").digest()), 99), ("other", bytearray(hashlib.sha256(b"new").digest()), 98)]
    spark.createDataFrame(known, token_counts.CACHE).write.parquet(other)
    two = spark.createDataFrame([(1, "twice"), (2, "new")], "doc_id long, text string")
    assert sorted(map(tuple, token_counts.count_tokens(two, "text", BYTE, other, ["doc_id"]).collect())) == [(1, 5, 99), (2, 3, 1)]
    assert spark.read.parquet(other).count() == 3
    # a cache in which all stands twice answers each row once all the same
    spark.read.parquet(other).write.parquet(other + "-copy")
    spark.read.parquet(other + "-copy").write.mode("append").parquet(other)
    assert sorted(map(tuple, token_counts.count_tokens(two, "text", BYTE, other, ["doc_id"]).collect())) == [(1, 5, 99), (2, 3, 1)]
    assert token_counts.count_tokens(two.limit(0), "text", BYTE, other, ["doc_id"]).count() == 0


@pytest.mark.skipif(not os.path.exists(SF), reason="needs the test tables")
def test_queries_against_library(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    word, byte = Tokenizer.from_file(WORD), Tokenizer.from_file(BYTE)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want, want8 = set(), set()
    for r in docs:
        ids = word.encode(r.text or "", add_special_tokens=False).ids
        want.add((r.doc_id, len(ids), sha(" ".join(map(str, ids))), sha(word.decode(ids, skip_special_tokens=False))))
        n = len(byte.encode(r.text or "", add_special_tokens=False).ids)
        want8.add((r.doc_id, len((r.text or "").encode()), n, n > 1024))
    assert {tuple(r) for r in op7_pair_index_bpe(spark, SF).collect()} == want
    assert {tuple(r) for r in op8_cached_counts(spark, SF).collect()} == want8
