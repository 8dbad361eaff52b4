"""Spelling variants of the words of a corpus, found by blocked Gram matrices.

A word is a vector of letter counts. Products of blocks of such vectors (NumPy) give squared distances; one edit leaves
words of one length at a distance of exactly two, words of adjacent lengths at one, and pairs at such distances are then
compared letter by letter. Words are blocked by length, and inside a length by how many of their letters fall into each of
GROUPS fixed groups of letters: an insertion adds one to a single group, a replacement moves at most one from a group to
another, so only adjacent blocks are multiplied and no pair is lost. Large blocks are cut into parts of BLOCK words, parts
of adjacent blocks are multiplied each with each in tasks of their own, and what leaves a task is one row a word: how many
near words it met and the best of them. Pairs never become rows.

Null words are no words. Repeated rows of a word add up. Very long words are compared whole. Ties go to the smaller word
in code-point order. An empty table gives an empty table; columns of the input besides its two don't matter.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geoquilt.llm.common import broadcast_if_small, materialize

#: Groups of letters (code point modulo this), words of a part of a block, and words that are met by one at a time.
GROUPS, BLOCK, FACING = 5, 4096, 32768
#: Rows of a product at a time, and letters of candidates that are compared at a time.
ROWS, LETTERS = 512, 1 << 22
LETTER_RUN = "[A-Za-zÀ-ÿ]"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_ALPHABET = _LOWER + "".join(map(chr, range(0xC0, 0x100)))

#: What a block adds to the letters of each group to come to an adjacent one: (0, ..., 0), the replacements that move a
#: letter between groups, each in one direction, and the insertions.
STEPS = [(0,) * GROUPS]
STEPS += [tuple((g == a) - (g == b) for g in range(GROUPS)) for a, b in itertools.combinations(range(GROUPS), 2)]
STEPS += [tuple(int(g == a) for g in range(GROUPS)) for a in range(GROUPS)]


def letter_runs(docs: DataFrame, doc_id: str, text: str, least: int) -> DataFrame:
    """(doc, word): each maximal run of at least ``least`` letters, A-Z as a-z, once for each time it stands in a text."""
    found = F.regexp_extract_all(docs[text].cast("string"), F.lit(f"{LETTER_RUN}{{{least},}}"), F.lit(0))
    rows = docs.select(docs[doc_id].alias("doc"), F.explode(found).alias("word"))
    return rows.withColumn("word", F.translate("word", _UPPER, _LOWER))


def with_slips(rows: DataFrame, every: int = 31) -> DataFrame:
    """``rows`` with a letter left out of each word whose checksum with its document is a multiple of ``every``."""
    h = F.crc32(F.encode(F.concat_ws(":", F.coalesce(F.col("doc").cast("string"), F.lit("null")), "word"), "utf-8"))
    at = (F.col("h") % F.length("word")).cast("int")
    cut = F.concat(F.col("word").substr(F.lit(1), at), F.col("word").substr(at + 2, F.length("word")))
    return rows.withColumn("h", h).select("doc", F.when(F.col("h") % every == 0, cut).otherwise(F.col("word")).alias("word"))


def count_words(rows: DataFrame, least: int = 7, times: int = 2) -> DataFrame:
    """(word, n) of words of at least ``least`` letters that occur ``times`` or more."""
    return rows.filter(F.length("word") >= least).groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= times)


def block_of(word: Column | str) -> list[Column]:
    """How many letters of a word fall into each group; they sum to its length."""
    word = F.col(word) if isinstance(word, str) else word
    groups = ["".join(c for c in _ALPHABET if ord(c) % GROUPS == g) for g in range(1, GROUPS)]
    inner = [F.length(word) - F.length(F.translate(word, g, "")) for g in groups]
    return [F.length(word) - sum(inner[1:], inner[0]), *inner]


def key(numbers: list[Column], step: tuple[int, ...] = STEPS[0], sign: int = 1) -> Column:
    return F.concat_ws(".", *[n + sign * s if s else n for n, s in zip(numbers, step, strict=True)])


class Block:
    """Words as flat code points, and their letter counts over the letters that two blocks hold."""

    def __init__(self, words: pa.Array):
        self.words = np.array(words.to_pylist(), object)
        self.sizes = np.array([len(w) for w in self.words], np.int64)
        self.codes = np.frombuffer("".join(self.words).encode("utf-32-le"), np.uint32)
        self.starts = np.cumsum(self.sizes) - self.sizes

    def counts(self, place: np.ndarray, letters: int) -> np.ndarray:
        """Letter counts; ``place`` has the column of each code point."""
        at = np.repeat(np.arange(len(self.words)) * letters, self.sizes) + place[self.codes]
        return np.bincount(at, minlength=len(self.words) * letters).reshape(len(self.words), letters)

    def row(self, at: np.ndarray, size: int, of: np.ndarray) -> np.ndarray:
        """Code points of positions ``at`` of the words ``of``, all of ``size``."""
        return self.codes[self.starts[of][:, None] + at]


def one_edit(a: Block, i: np.ndarray, b: Block, j: np.ndarray) -> np.ndarray:
    """Which pairs differ by exactly one letter replaced (one length) or put into ``b`` (one longer)."""
    out = np.zeros(len(i), bool)
    for size in np.unique(a.sizes[i]):
        of_size = np.flatnonzero(a.sizes[i] == size)
        step = max(1, LETTERS // int(size))
        for at in range(0, len(of_size), step):
            here = of_size[at : at + step]
            p, q = i[here], j[here]
            longer = b.sizes[q] > size
            x = a.row(np.arange(size), size, p)
            y = b.row(np.arange(size), size, q)
            same = x == y
            found = (~same).sum(axis=1) == 1
            if longer.any():
                # what stands before the new letter is equal, and what stands behind it one place on
                tail = b.row(np.arange(1, size + 1), size, q[longer]) == x[longer]
                head = np.cumprod(same[longer], axis=1).sum(axis=1)
                found[longer] = head + np.cumprod(tail[:, ::-1], axis=1).sum(axis=1) >= size
            out[here] = found
    return out


def near_pairs(a: Block, b: Block) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (rows of a, rows of b) one edit apart; words of ``b`` are as long as those of ``a`` or one longer."""
    seen = np.zeros(int(max(a.codes.max(), b.codes.max())) + 1, bool)
    seen[a.codes] = seen[b.codes] = True
    place, letters = np.cumsum(seen) - 1, int(seen.sum())
    # whole numbers of up to twice a length's square, which single precision holds for words of up to 2048 letters
    kind = np.float32 if b.sizes.max() <= 2048 else np.float64
    x, y = a.counts(place, letters).astype(kind), b.counts(place, letters).astype(kind)
    wanted = 2 - (b.sizes - a.sizes[0])  # words of a block have one length
    # with two more columns the product is the squared distance itself, less what it has to be
    x = np.concatenate([-2 * x, (x * x).sum(axis=1, keepdims=True), np.ones((len(x), 1), kind)], axis=1)
    y = np.concatenate([y, np.ones((len(y), 1), kind), ((y * y).sum(axis=1) - wanted.astype(kind))[:, None]], axis=1)
    for at in range(0, len(x), ROWS):
        i, j = np.divmod(np.flatnonzero(x[at : at + ROWS] @ y.T == 0), len(y))
        good = one_edit(a, i + at, b, j)
        yield i[good] + at, j[good]


def best_near(table: pa.Table) -> pa.RecordBatch:
    """(word, n_near, best_n, best): what each word of a part met among the words that face it, and these among the part's."""
    home = table.column("home").to_numpy()
    sides = [table.filter(pa.array(home)), table.filter(pa.array(~home))]
    if not all(s.num_rows for s in sides):
        return pa.RecordBatch.from_pylist([], schema=pa.schema([("word", pa.string()), ("n_near", pa.int64()), ("best_n", pa.int64()), ("best", pa.string())]))
    a, b = (Block(s.column("word")) for s in sides)
    n = [s.column("n").to_numpy() for s in sides]
    of_home = sides[1].column("same").to_numpy()
    met: list[tuple[np.ndarray, ...]] = []
    for i, j in near_pairs(a, b):
        both = ~of_home[j]  # inside a block each word faces all others itself
        met += [(a.words[i], b.words[j], n[1][j]), (b.words[j][both], a.words[i[both]], n[0][i[both]])]
    word, other, times = (np.concatenate(c) for c in zip(*met, strict=True)) if met else (np.zeros(0, object),) * 3
    # for each word the largest n first, then the smallest word
    order = sorted(range(len(word)), key=lambda k: (word[k], -times[k], other[k]))
    word, other, times = word[order], other[order], times[order].astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]])) if len(word) else np.zeros(0, np.int64)
    count = np.diff(np.append(first, len(word)))
    return pa.RecordBatch.from_arrays([pa.array(word[first], pa.string()), pa.array(count, pa.int64()), pa.array(times[first], pa.int64()), pa.array(other[first], pa.string())], names=["word", "n_near", "best_n", "best"])


def facing(words: DataFrame) -> DataFrame:
    """(block, part, facing, home, same, word, n): the words of each part of a block, and those of adjacent blocks that face it."""
    numbers = [F.col(f"g{i}") for i in range(GROUPS)]
    keyed = words.select("word", "n", key(numbers).alias("block"), F.array(*[key(numbers, s, -1) for s in STEPS]).alias("homes"))
    weight = F.ceil(F.length("word") / F.lit(64))  # a long word counts as several, so parts stay small
    sizes = materialize(keyed.groupBy("block", "homes").agg(F.sum(weight).alias("size")), "block-sizes")
    faced = sizes.select(F.explode("homes").alias("block"), "size").groupBy("block").agg(F.sum("size").alias("faced"))
    plan = sizes.select("block", "size").join(faced, "block")
    parts = lambda c, most: F.ceil(F.col(c) / F.lit(most)).cast("int")
    plan = materialize(plan.select("block", parts("size", BLOCK).alias("parts"), parts("faced", FACING).alias("faces")), "block-parts")
    plan = broadcast_if_small(plan, plan.count())
    dealt = lambda into: F.pmod(F.xxhash64("word", F.lit(5)), F.col(into)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    home = keyed.join(plan, "block").select("block", dealt("parts").alias("part"), every("faces").alias("face"), F.lit(True).alias("home"), F.lit(True).alias("same"), "word", "n")
    copies = keyed.select("word", "n", F.col("block").alias("own"), F.explode("homes").alias("block")).join(plan, "block")
    other = copies.select("block", every("parts").alias("part"), dealt("faces").alias("face"), F.lit(False).alias("home"), (F.col("own") == F.col("block")).alias("same"), "word", "n")
    return home.unionByName(other)


def near_words(words: DataFrame) -> DataFrame:
    """(word, n_near, best_n, best): for words with near words, how many, and the one of largest n (ties: the smallest).

    ``words``: word, n, and how many letters fall into each group, g0 and so on."""

    def run(table: pa.Table) -> pa.Table:
        return pa.Table.from_batches([best_near(table.combine_chunks())])

    met = facing(words).groupBy("block", "part", "face").applyInArrow(run, "word string, n_near long, best_n long, best string")
    best = F.min(F.struct((-F.col("best_n")).alias("m"), "best"))
    met = met.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("b"))
    return met.select("word", "n_near", (-F.col("b.m")).alias("best_n"), F.col("b.best").alias("best"))


def roots(links: DataFrame) -> DataFrame:
    """(word, root) of links (word, form): forms are followed to the last, two steps becoming one in each round.

    A form is several times as frequent as its word, so chains have no circles and rounds go with the logarithm of a
    chain's length, which itself goes with the logarithm of the largest count."""
    now = materialize(links.select("word", F.col("form").alias("root")), "forms")
    while True:
        further = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        new = materialize(now.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        if not new.filter("moved").limit(1).count():
            return new.select("word", "root")
        now = new.select("word", "root")


def variants(words: DataFrame, word: str = "word", n: str = "n", ratio: int = 10) -> DataFrame:
    """(word, form, root, n, n_near, form_n): a word's form is its most frequent near word, if ``ratio`` times as frequent."""
    words = words.select(words[word].cast("string").alias("word"), words[n].cast("long").alias("n")).filter("word IS NOT NULL")
    words = words.groupBy("word").agg(F.sum("n").alias("n"))
    words = materialize(words.withColumns({f"g{i}": g for i, g in enumerate(block_of("word"))}), "words")
    found = words.join(near_words(words), "word", "left")
    is_form = F.col("best_n") >= F.lit(ratio) * F.col("n")
    found = materialize(found.select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(is_form, F.col("best")).alias("form"), F.when(is_form, F.col("best_n")).alias("form_n")), "near-words")
    ends = roots(found.filter("form IS NOT NULL"))
    return found.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
