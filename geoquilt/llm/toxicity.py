"""Toxicity by a chain of linear classifiers.

Categories are predicted one after the other. Each category's model is logistic regression on words and on the probabilities
of all earlier categories. For training, the earlier probabilities of a document come from models that haven't seen it: the
labelled rows are dealt into folds by a hash, and each fold is predicted by models of the others. For prediction, models of
all labelled rows are used.

Words are runs of letters and digits, lower-case, as 64-bit hashes; so are their first STEM bytes, which tell words that are
built from a known stem. A document has a word or not, however long it is. Hashes are used whole: folded into fewer
buckets, rare words of clean documents would fall on the telling ones.
Models are fitted on at most ``most_rows`` labelled ids, the first by a hash of the id, each with one text (that of the
smallest hash, where an id has several) and one row of labels (the smallest), and on the ``most_words``
words and stems whose presence tells most about a category by the chi-squared statistic. Whole texts of all documents are
scored, in one pass without a shuffle. A category is set where its probability reaches the threshold that was best on
out-of-fold predictions.

Null and empty texts have no words and get the probability that this gives. Labels that are null are left out. Without
usable labels of both kinds a category's probability is its share of ones, or 0. Words of equal statistics are taken by
their hash. Very long texts are read whole, a few megabytes of texts at a time. Repeated rows are answered each; an empty
table gives an empty table; clashing column names don't matter, as only ``keep`` is returned.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geoquilt.llm.common import materialize, slices
from geoquilt.llm.shingles import mix, words_of

STEM, FOLDS, RIDGE = 4, 5, 1.0
#: Rows of the design matrix that are multiplied at a time.
ROWS = 2048
GAPS = np.zeros(256, bool)
GAPS[[b for b in range(128) if not chr(b).isalnum()]] = True


def words_and_stems(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(document, hash) of the words and stems of each text, as often as they occur."""
    texts = pc.utf8_lower(pc.fill_null(texts.cast(pa.large_string()), ""))
    limits = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, texts.offset * 8)
    raw = texts.buffers()[2]
    data = np.frombuffer(raw, np.uint8)[limits[0] : limits[-1]] if raw is not None else np.zeros(0, np.uint8)
    words, owner = words_of(data, limits - limits[0], GAPS)
    stems, _ = words_of(data, limits - limits[0], GAPS, STEM)
    return np.concatenate([owner, owner]).astype(np.int64), np.concatenate([words, mix(stems + np.uint64(1))]).view(np.int64)


def distinct_words(docs: DataFrame, keep: Sequence[str]) -> DataFrame:
    """The ``keep`` columns and the distinct hashes of words and stems of ``text``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, n in slices(batch.column(len(keep)), 1 << 20):
                part = batch.slice(at, n)
                doc, word = words_and_stems(part.column(len(keep)))
                order = np.lexsort((word, doc))
                doc, word = doc[order], word[order]
                first = np.ones(len(doc), bool)
                first[1:] = (doc[1:] != doc[:-1]) | (word[1:] != word[:-1])
                ends = np.searchsorted(doc[first], np.arange(part.num_rows + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays([*part.columns[: len(keep)], pa.ListArray.from_arrays(pa.array(ends), pa.array(word[first]))], names=[*keep, "words"])

    rows = docs.select(*keep, "text")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.select(*keep).schema)
    return rows.mapInArrow(run, f"{schema}, words array<long>")


def fit(x: np.ndarray, earlier: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Weights of ``x`` and ``earlier`` and last the intercept of ridge logistic regression, by Newton's method."""
    d = x.shape[1] + earlier.shape[1]
    if not len(y) or y.min() == y.max():
        p = min(max(float(y.mean()) if len(y) else 0.0, 1e-6), 1 - 1e-6)
        return np.concatenate([np.zeros(d), [np.log(p / (1 - p))]])
    ridge = np.full(d + 1, RIDGE)
    ridge[-1] = 1e-6
    w = np.zeros(d + 1)
    w[-1] = np.log(y.mean() / (1 - y.mean()))
    loss, last, step = np.inf, w, w * 0
    for _ in range(60):
        now, slope, bend = 0.5 * (ridge * w * w).sum(), -ridge * w, np.diag(ridge)
        for at in range(0, len(x), ROWS):
            part = np.concatenate([x[at : at + ROWS], earlier[at : at + ROWS], np.ones((len(x[at : at + ROWS]), 1))], 1)
            own = y[at : at + ROWS]
            p = 1 / (1 + np.exp(-np.clip(part @ w, -30, 30)))
            now -= (own * np.log(p) + (1 - own) * np.log(1 - p)).sum()
            slope = slope + part.T @ (own - p)
            bend = bend + (part * np.maximum(p * (1 - p), 1e-4)[:, None]).T @ part
        if now > loss * (1 + 1e-9):  # the step went too far
            step = step / 2
            w = last + step
            continue
        loss, last, step = now, w, np.linalg.solve(bend, slope)
        w = w + step
        if abs(step).max() < 1e-7:
            break
    return w


def logit(x: np.ndarray, earlier: np.ndarray, w: np.ndarray) -> np.ndarray:
    return np.clip(x @ w[: x.shape[1]] + earlier @ w[x.shape[1] : -1] + w[-1], -30, 30)


def probability(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-z))


def best_threshold(z: np.ndarray, y: np.ndarray) -> float:
    """The probability from which on calling a category gives the largest F1; 0.5 where nothing can be told."""
    if not y.any():
        return 0.5
    order = np.argsort(-z, kind="stable")
    hits = np.cumsum(y[order])
    f1 = 2 * hits / (np.arange(1, len(y) + 1) + y.sum())
    i = int(f1.argmax())
    low = z[order[i + 1]] if i + 1 < len(z) else z[order[i]]
    return float(1 / (1 + np.exp(-(z[order[i]] + low) / 2)))


def train_chain(x: np.ndarray, labels: np.ndarray, fold: np.ndarray) -> list[tuple[np.ndarray, float]]:
    """(weights, threshold) of each category in order; labels may be NaN."""
    chain, earlier = [], np.zeros((len(x), 0))
    for c in range(labels.shape[1]):
        y, known = labels[:, c], ~np.isnan(labels[:, c])
        unseen = np.zeros(len(x))
        for f in range(FOLDS):
            inside, own = known & (fold != f), fold == f
            unseen[own] = logit(x[own], earlier[own], fit(x[inside], earlier[inside], y[inside]))
        chain.append((fit(x[known], earlier[known], y[known]), best_threshold(unseen[known], y[known])))
        earlier = np.concatenate([earlier, probability(unseen)[:, None]], 1)
    return chain


def telling_words(sample: DataFrame, categories: Sequence[str], most_words: int) -> list[int]:
    """Words and stems with the largest chi-squared statistics, as many for each category, among rows that it labels."""
    counts = lambda c: (F.count(c).cast("double").alias(f"n_{c}"), F.sum(c).cast("double").alias(f"ones_{c}"))
    totals = sample.agg(*[x for c in categories for x in counts(c)]).first()
    words = sample.select(F.explode("words").alias("word"), *categories).groupBy("word").agg(*[x for c in categories for x in counts(c)])
    out: list[int] = []
    for c in categories:
        n, ones = totals[f"n_{c}"] or 0.0, totals[f"ones_{c}"] or 0.0
        if 0 < ones < n:
            df = F.col(f"n_{c}")
            expected = df * F.lit(ones / n)
            score = (F.col(f"ones_{c}") - expected) ** 2 / (expected * (F.lit(1.0) - df / F.lit(n)) + F.lit(1.0))
            top = words.filter(df >= 3).orderBy(score.desc(), "word").limit(max(1, most_words // len(categories)))
            out += [r.word for r in top.select("word").collect()]
    return sorted(set(out))


def learn(docs: DataFrame, labels: DataFrame, doc_id: str, text: str, categories: Sequence[str], most_rows: int, most_words: int) -> tuple[list[int], list[tuple[np.ndarray, float]]]:
    """(words, chain) from labelled documents; ``labels``: doc_id and a 0/1 column for each category."""
    chosen = labels.select(F.col(doc_id).alias("id"), *[F.col(c).cast("double").alias(c) for c in categories]).filter(F.col("id").isNotNull())
    one = chosen.groupBy("id").agg(F.min(F.struct(*categories)).alias("l")).select("id", "l.*")
    chosen = one.orderBy(F.xxhash64("id", F.lit(11)), "id").limit(most_rows)
    texts = docs.select(docs[doc_id].alias("id"), docs[text].cast("string").alias("text"))
    # one text of each id, so most_rows rows at most are learnt from, however often an id stands in the documents
    texts = texts.join(F.broadcast(chosen), "id").groupBy("id", *categories).agg(F.min(F.struct(F.xxhash64("text").alias("hash"), "text")).alias("t"))
    sample = distinct_words(texts.select("id", *categories, F.col("t.text").alias("text")), ["id", *categories])
    sample = materialize(sample, "labelled")
    words = telling_words(sample, categories, most_words)
    own = F.array_intersect("words", F.lit(words).cast("array<long>")) if words else F.array().cast("array<long>")
    rows = sample.select(own.alias("own"), *categories, F.pmod(F.xxhash64("id", F.lit(5)), F.lit(FOLDS)).alias("fold")).orderBy(F.xxhash64("id", F.lit(11)), "id").collect()
    x, place = np.zeros((len(rows), len(words)), np.float32), {w: i for i, w in enumerate(words)}
    for i, r in enumerate(rows):
        x[i, [place[b] for b in r["own"]]] = 1
    y = np.array([[np.nan if r[c] is None else r[c] for c in categories] for r in rows], float).reshape(len(rows), len(categories))
    return words, train_chain(x, y, np.array([r["fold"] for r in rows], int))


def classify(docs: DataFrame, labels: DataFrame, categories: Sequence[str], doc_id: str = "doc_id", text: str = "text", keep: Sequence[str] | None = None, most_rows: int = 16_384, most_words: int = 400) -> DataFrame:
    """The ``keep`` columns (default: all), then p_<category> and is_<category> of each category in the chain's order."""
    added = [n for c in categories for n in (f"p_{c}", f"is_{c}")]
    keep = [c for c in (docs.columns if keep is None else keep) if c not in added]
    words, chain = learn(docs, labels, doc_id, text, categories, most_rows, most_words)
    telling = np.array([*words, np.iinfo(np.int64).max], np.int64)  # sorted; the last one is no word's
    weights = [w[: len(words)] for w, _ in chain]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, n in slices(batch.column(len(keep)), 1 << 20):
                part = batch.slice(at, n)
                doc, word = words_and_stems(part.column(len(keep)))
                at_word = np.searchsorted(telling, word)
                found = (telling[at_word] == word) & (at_word < len(words))
                pairs = np.unique(doc[found] * len(telling) + at_word[found])
                doc, feature = pairs // len(telling), pairs % len(telling)
                earlier: list[np.ndarray] = []
                out = []
                for (w, threshold), own in zip(chain, weights, strict=True):
                    z = np.bincount(doc, own[feature], part.num_rows) + w[-1]
                    for e, v in zip(earlier, w[len(words) : -1], strict=True):
                        z = z + v * e
                    p = probability(np.clip(z, -30, 30))
                    earlier.append(p)
                    out += [pa.array(p), pa.array(p >= threshold)]
                yield pa.RecordBatch.from_arrays([*part.columns[: len(keep)], *out], names=[*keep, *added])

    rows = docs.select(*[docs[c] for c in keep], docs[text].cast("string").alias("_text"))
    schema = rows.select(*keep).schema
    for i, name in enumerate(added):
        schema = schema.add(name, "boolean" if i % 2 else "double")
    return rows.mapInArrow(run, schema)
