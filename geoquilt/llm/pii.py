"""Personal data by patterns, and terms that reveal it by what occurs together in the corpus.

Base spans are found by patterns. Around every base span, the words within WINDOW words of its line are near it. Over all
documents, the pointwise mutual information of a term with being near a kind, divided by the information of the kind
itself, says how much of the kind's presence the term discloses: 1 means that the term occurs near that kind alone. Kinds
are scored for terms near at least ``min_values`` different values of one.

Each term is scored against each single value too, by the different texts that hold them: the information on the value that
the term gives, divided by that of the value, times n / (n + 1) for n texts with the term near the value. So a word that was
seen there once scores a half at most, and a name beside one person's number in many texts comes near 1.

A term whose larger share reaches ``generalise`` is replaced by a general word wherever it occurs, and from ``remove`` on it
is taken out. Different values or texts are counted, so copies of a document add no evidence. Base spans themselves are
replaced by their kinds.

Offsets are code points of the whole text, ends exclusive. A null text has no spans and stays null; rows that repeat are
answered each; an empty table gives an empty table. Column names of the input don't matter but for ``keep``. Very long
texts are searched whole, and their words are read in parts. Of equal shares the kind last in the alphabet is named.
"""

from __future__ import annotations

import functools
import re
from array import array
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from itertools import repeat

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from geoquilt.llm.common import materialize, slices, spans

KINDS = ("email", "ip", "card", "phone")
WINDOW = 5
#: Characters beside a span that are looked at before all words of the text are.
CLOSE = 300
#: Candidate terms that are sent to tasks at most; more are joined.
SENT = 200_000

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
# a match that starts inside a run of digits starts at the run's first digit too, so only that one is tried
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
WORD = re.compile(r"[^\W\d_]+")
NEW_LINE = re.compile("\n")


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Around each @, the run of characters before it; each character is visited a fixed number of times."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        found = DOMAIN.match(text, at + 1) if start < at else None
        if found:
            yield start, found.end()
            done = found.end()
        else:
            done = max(done, at)
        at = text.find("@", max(at + 1, done))


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2])) + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) by kind as in KINDS, then start."""
    out = [("email", a, b) for a, b in emails(text)] if "@" in text else []
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            out.append(("ip", *m.span()))
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 16 and 16 <= len(d := m[0].replace(" ", "").replace("-", "")) <= 19 and luhn(d):
            out.append(("card", *m.span()))
    if "+" in text:
        out += [("phone", *m.span()) for m in PHONE.finditer(text) if 8 <= sum(map(str.isdigit, m[0])) <= 15]
    return out


class Words:
    """Where the words and line ends of a whole text lie, found when first asked for."""

    def __init__(self, text: str):
        self.text = text

    @functools.cached_property
    def at(self) -> tuple[array, array, array]:
        starts, ends, lines = array("q"), array("q"), array("q")
        for m in WORD.finditer(self.text):
            starts.append(m.start())
            ends.append(m.end())
        lines.extend(m.start() for m in NEW_LINE.finditer(self.text))
        return starts, ends, lines

    def near(self, start: int, end: int) -> list[str]:
        """Lower-case words within WINDOW words of a span, on its line; a word that the span cuts counts with the rest of it."""
        text = self.text
        # most spans have enough words, or the ends of their line, close by
        low, high = max(0, start - CLOSE), min(len(text), end + CLOSE)
        left, cut, line = text[low:start].rpartition("\n")
        before = WORD.findall(line)
        if not (cut or low == 0 or len(before) > WINDOW):
            starts, ends, lines = self.at
            i, n = bisect_left(starts, start), bisect_left(lines, start)
            first = lines[n - 1] + 1 if n else 0
            before = [text[starts[k] : min(ends[k], start)] for k in range(max(0, i - WINDOW), i) if starts[k] >= first]
        line, cut, right = text[end:high].partition("\n")
        after = WORD.findall(line)
        if not (cut or high == len(text) or len(after) > WINDOW):
            starts, ends, lines = self.at
            j, n = bisect_right(ends, end), bisect_left(lines, end)
            last = lines[n] if n < len(lines) else len(text)
            after = [text[max(starts[k], end) : ends[k]] for k in range(j, min(j + WINDOW, len(starts))) if starts[k] < last]
        return [w.lower() for w in before[-WINDOW:] + after[:WINDOW]]


def terms_in(text: str) -> set[str]:
    """The distinct lower-case words of a text."""
    found: set[str] = set()
    for part in spans(text):
        found.update(WORD.findall(part))
    return {w.lower() for w in found}


def parts(batches: Iterator[pa.RecordBatch], text: int = 0) -> Iterator[pa.RecordBatch]:
    """Batches cut by the bytes of their texts."""
    for batch in batches:
        for at, n in slices(batch.column(text), 1 << 20):
            yield batch.slice(at, n)


def hashed(docs: DataFrame, text: str) -> DataFrame:
    """(text, digest)"""
    return docs.select(F.col(text).cast("string").alias("text")).select("text", F.xxhash64("text").alias("digest"))


def near_terms(docs: DataFrame, text: str) -> DataFrame:
    """(kind, term, value, digest, n): how often a term is near a value of a kind in a text; a null kind holds all words of a text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts(batches):
            seen: Counter = Counter()
            for t, digest in zip(*(c.to_pylist() for c in part.columns)):
                if t:
                    seen[None, None, None, digest] += t.count(" ") + t.count("\n") + 1
                    words = Words(t)
                    for kind, a, b in base_spans(t):
                        value = t[a:b].lower()
                        seen.update((kind, w, value, digest) for w in words.near(a, b))
            if seen:
                rows = [(*k, n) for k, n in seen.items()]
                types = (pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=["kind", "term", "value", "digest", "n"])

    return hashed(docs, text).mapInArrow(run, "kind string, term string, value string, digest long, n long")


def counted_once(batches: Iterator[pa.RecordBatch], words: Callable[[pa.RecordBatch], Iterable[str]], only: frozenset[str] | None) -> Iterator[pa.RecordBatch]:
    """(term, n): how often lower-case words occur in a task's batches, each word once, unless so many differ that they go out in parts."""
    total: Counter = Counter()

    def out() -> pa.RecordBatch:
        found = pa.RecordBatch.from_arrays([pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())], names=["term", "n"])
        total.clear()
        return found

    for batch in batches:
        for w, n in Counter(words(batch)).items():
            w = w.lower()
            if only is None or w in only:
                total[w] += n
        if len(total) > SENT:
            yield out()
    yield out()


def term_counts(docs: DataFrame, text: str, only: frozenset[str] | None) -> DataFrame:
    """(term, n): how often lower-case terms occur in all texts; ``only`` these, or all."""
    words = lambda part: (w for t in part.column(0).to_pylist() for span in (spans(t) if t else ()) for w in WORD.findall(span))
    run = lambda batches: counted_once(parts(batches), words, only)
    found = docs.select(F.col(text).cast("string").alias("text")).mapInArrow(run, "term string, n long")
    return found.groupBy("term").agg(F.sum("n").alias("n_all"))


def terms_of_texts(docs: DataFrame, text: str, only: frozenset[str] | None) -> DataFrame:
    """(digest, terms): the lower-case terms of each different text that has some; ``only`` these, or all."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts(batches):
            of = {d: t for t, d in zip(*(c.to_pylist() for c in part.columns)) if t}
            terms = {d: list(found if only is None else found & only) for d, found in ((d, terms_in(t)) for d, t in of.items())}
            terms = {d: found for d, found in terms.items() if found}
            yield pa.RecordBatch.from_arrays([pa.array(list(terms), pa.int64()), pa.array(list(terms.values()), pa.list_(pa.string()))], names=["digest", "terms"])

    return hashed(docs, text).mapInArrow(run, "digest long, terms array<string>").groupBy("digest").agg(F.first("terms").alias("terms"))


def text_counts(texts: DataFrame) -> DataFrame:
    """(term, n_all): how many of the rows hold a term."""
    run = lambda batches: counted_once(batches, lambda b: b.column(0).flatten().to_pylist(), None)
    return texts.select("terms").mapInArrow(run, "term string, n long").groupBy("term").agg(F.sum("n").alias("n_all"))


def few_terms(df: DataFrame) -> frozenset[str] | None:
    """The distinct terms, or None where there are more than SENT."""
    names = df.select("term").distinct()
    return frozenset(r.term for r in names.collect()) if names.count() <= SENT else None


def value_disclosures(docs: DataFrame, text: str, near: DataFrame, least: float) -> DataFrame:
    """(term, kind, n_near, n_values, n_all, share) of terms with single values, counted in different texts.

    Pairs whose share can't reach ``least`` aren't looked for in the texts: it is n / (n + 1) at most, and less where the
    term is near other values too, as all texts with the term are at least those in which it is near any."""
    held = near.filter("kind IS NOT NULL").groupBy("kind", "value", "term", "digest").agg(F.lit(1).alias("one"))
    pairs = held.groupBy("kind", "value", "term").agg(F.count(F.lit(1)).alias("n_near")).filter(F.col("n_near") / (F.col("n_near") + 1) >= least)
    texts = float(near.filter("kind IS NULL").select("digest").distinct().count())
    values = held.select("kind", "value", "digest").distinct().groupBy("kind", "value").agg(F.count(F.lit(1)).alias("n_value"))
    somewhere = held.select("term", "digest").distinct().groupBy("term").agg(F.count(F.lit(1)).alias("n_some"))

    def share(n_all: str) -> Column:
        information, given = -F.log2(F.col("n_value") / F.lit(texts)), -F.log2(F.col("n_near") / F.col(n_all))
        return F.when(information > 0, (information - given) / information) * F.col("n_near") / (F.col("n_near") + 1)

    pairs = materialize(pairs.join(values, ["kind", "value"]).join(somewhere, "term").filter(share("n_some") >= least), "value-terms")
    columns = ("term", "kind", "n_near", F.lit(1).cast("long").alias("n_values"))
    if pairs.isEmpty():
        return pairs.select(*columns, F.col("n_some").alias("n_all"), share("n_some").alias("share"))
    counted = text_counts(terms_of_texts(docs, text, few_terms(pairs)))
    return pairs.join(counted, "term").select(*columns, "n_all", share("n_all").alias("share"))


def disclosures(docs: DataFrame, text: str = "text", min_values: int = 5, least: float = 0.8) -> DataFrame:
    """(term, kind, n_near, n_values, n_all, share): for each term near enough values of a kind, or near one value in so many
    texts that its share can reach ``least``, the kind, or the kind of the value, that it discloses most of. For a single
    value, n_values is 1, and n_near and n_all count texts."""
    near = materialize(near_terms(docs, text), "near-terms")
    all_words = near.filter("kind IS NULL").agg(F.sum("n")).first()[0] or 0
    kinds = near.filter("kind IS NOT NULL").groupBy("kind").agg(F.sum("n").alias("n_kind"))
    # one row for each value first, so a frequent term's values are counted in many tasks
    values = near.filter("kind IS NOT NULL").groupBy("kind", "term", "value").agg(F.sum("n").alias("n"))
    terms = values.groupBy("kind", "term").agg(F.sum("n").alias("n_near"), F.count(F.lit(1)).alias("n_values")).filter(F.col("n_values") >= min_values)
    terms = materialize(terms.join(F.broadcast(kinds), "kind"), "terms")  # four kinds
    counted = terms.withColumn("n_all", F.col("n_near")).limit(0) if terms.isEmpty() else terms.join(term_counts(docs, text, few_terms(terms)), "term")
    information = -F.log2(F.col("n_kind") / F.lit(float(max(all_words, 1))))
    mutual = F.log2(F.col("n_near") * F.lit(float(max(all_words, 1))) / (F.greatest("n_all", "n_near") * F.col("n_kind")))
    scored = counted.withColumn("share", F.when(information > 0, mutual / information))
    scored = scored.select("term", "kind", "n_near", "n_values", "n_all", "share").unionByName(value_disclosures(docs, text, near, least))
    best = scored.groupBy("term").agg(F.max(F.struct("share", "kind", "n_near", "n_values", "n_all")).alias("b"))
    return best.select("term", "b.kind", "b.n_near", "b.n_values", "b.n_all", "b.share")


def term_spans(text: str, flagged: frozenset[str], base: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """Where flagged terms stand outside of base spans."""
    out, taken, i, reach = [], sorted((a, b) for _, a, b in base), 0, 0
    for m in WORD.finditer(text):
        if m[0].lower() in flagged:
            while i < len(taken) and taken[i][0] < m.end():
                reach = max(reach, taken[i][1])  # how far spans that begin before the word's end go
                i += 1
            if reach <= m.start():
                out.append(("term", *m.span()))
    return out


def clean(text: str, found: list[tuple[str, int, int]], removed: frozenset[str]) -> str:
    """The text with the kind of each span that was found in its place; overlapping spans share the place of the first."""
    out, at = [], 0
    for kind, a, b in sorted(found, key=lambda s: (s[1], -s[2])):
        if b <= at:
            continue
        if a >= at:
            out.append(text[at:a])
            if kind != "term":
                out.append(f"[{kind.upper()}]")
            elif text[a:b].lower() not in removed:
                out.append("[TERM]")
        at = b
    return "".join([*out, text[at:]])


SPANS = T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))
_ARROW = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))


def sanitise(docs: DataFrame, text: str = "text", keep: list[str] | None = None, generalise: float = 0.8, remove: float = 0.95, min_values: int = 5) -> DataFrame:
    """The ``keep`` columns (default: all), spans (base ones by kind, then terms) and clean, the sanitised whole text."""
    keep = [c for c in (docs.columns if keep is None else keep) if c not in ("spans", "clean")]
    told = materialize(disclosures(docs, text, min_values, generalise).filter(F.col("share") >= generalise), "disclosing")
    rows_in = docs.select(*[docs[c] for c in keep], docs[text].cast("string").alias("_text"))
    sent = told.count() <= SENT
    rows = told.collect() if sent else []
    all_flagged, all_removed = frozenset(r.term for r in rows), frozenset(r.term for r in rows if r.share >= remove)
    if not sent:  # too many for every task, so each text gets its own
        own = terms_of_texts(docs, text, None).select("digest", F.explode("terms").alias("term")).join(told.select("term", (F.col("share") >= remove).alias("removed")), "term")
        own = own.groupBy(F.col("digest").alias("_digest")).agg(F.collect_list("term").alias("_flagged"), F.expr("collect_list(term) FILTER (WHERE removed)").alias("_removed"))
        rows_in = rows_in.withColumn("_digest", F.xxhash64("_text")).join(own, "_digest", "left").select(*[F.col(f"`{c}`") for c in keep], "_text", "_flagged", "_removed")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts(batches, len(keep)):
            every, cleaned = [], []
            texts = part.column(len(keep)).to_pylist()
            own = repeat((all_flagged, all_removed)) if sent else zip(*(map(frozenset, ([] if x is None else x for x in part.column(len(keep) + i).to_pylist())) for i in (1, 2)))
            for t, (flagged, removed) in zip(texts, own):
                found = base_spans(t) if t else []
                if t and flagged and not flagged.isdisjoint(terms_in(t)):
                    found += term_spans(t, flagged, found)
                every.append([{"kind": k, "start": a, "end": b} for k, a, b in found])
                cleaned.append(clean(t, found, removed) if found else t)
            yield pa.RecordBatch.from_arrays([*part.columns[: len(keep)], pa.array(every, _ARROW), pa.array(cleaned, pa.string())], names=[*keep, "spans", "clean"])

    return rows_in.mapInArrow(run, rows_in.select(*keep).schema.add("spans", SPANS).add("clean", "string"))
