"""Byte-pair encoding with an index of pair occurrences, and decoding.

The distinct pieces that a task hasn't met before are laid out as one chain of symbols. An index maps every pair that has a
merge rank to all its positions in the chain. Active ranks are taken in ascending order; all occurrences of a rank's pair
are merged together, and each merge adds the pairs it makes to their lists. A merge that makes a symbol ranks before all
merges that use it, so one ascending pass gives what merging piece by piece gives. Pieces seen before keep their ids in
a table of two generations: a full one becomes the older, and what is met again moves to the newer.

Works with vocabulary files that have NFC, white space and lower-case normalisation, a split pattern whose matches are
pieces and never cross white space, byte-level symbols and an end-of-word suffix. Special tokens inside a text are matched
first, as the library does. Text is read in spans that end at white space, so a very long text needs memory for its ids and
not for all its pieces; a text without white space is one span. Spans whose characters all lie below U+0250 are normalised
and split here; others by the library's own normaliser and splitter, whose Unicode tables count there.

Null and empty texts have no ids, and decode to the empty text; null lists of ids decode to null, unknown or null ids to
nothing. Rows that repeat are answered each; an empty table gives an empty table. Kept columns that clash with an added one
are replaced by it. Pairs at equal rank don't exist; equal pairs that overlap are merged from the left.
"""

from __future__ import annotations

import functools
import heapq
import json
import re
import unicodedata
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from geoquilt.llm.common import slices, spans

#: Pieces that are looked up at once, and those of a generation and their characters.
AT_ONCE, REMEMBERED, REMEMBERED_CHARS = 1 << 20, 150_000, 4 << 20
#: Occurrences of a pair from which on they are merged as arrays.
MANY = 64
LATIN = 0x250
OTHER = re.compile("[^\x00-ɏ]")


def byte_symbols() -> list[str]:
    """The character that stands for each byte: printable ones for themselves, the others from U+0100 on."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(256, 512))
    return [chr(b if b in shown else next(spare)) for b in range(256)]


def latin_class(category: str) -> str:
    """The characters below U+0250 of a general category, for use inside a set of a pattern."""
    return "".join(re.escape(chr(c)) for c in range(LATIN) if unicodedata.category(chr(c)).startswith(category))


class Vocabulary:
    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, split = spec["model"], spec["pre_tokenizer"]["pretokenizers"][0]
        if [x["type"] for x in spec["normalizer"]["normalizers"]] != ["NFC", "Replace", "Lowercase"] or not split["invert"] or spec.get("decoder"):
            raise ValueError(f"{path}: not a vocabulary of this kind")
        self.path = path
        ids = model["vocab"]
        self.special = {x["content"]: x["id"] for x in spec["added_tokens"]}
        tokens = {i: t for t, i in [*ids.items(), *self.special.items()]}
        self.tokens = np.array([tokens.get(i) for i in range(max(tokens) + 1)], object)
        suffix = model["end_of_word_suffix"]
        symbols = byte_symbols()
        self.first = np.array([ids[c] for c in symbols], np.int32)
        self.last = np.array([ids[c + suffix] for c in symbols], np.int32)
        self.by_rank = [(ids[a], ids[b], ids[a + b]) for a, b in model["merges"]]
        self.rank = {a << 20 | b: r for r, (a, b, _) in enumerate(self.by_rank)}
        self.keys = np.array(sorted(self.rank), np.int64)
        self.key_ranks = np.array([self.rank[k] for k in self.keys.tolist()], np.int32)
        pattern = split["pattern"]["Regex"]
        for category in "LN":
            pattern = pattern.replace(f"[\\p{{{category}}}]", f"[{latin_class(category)}]").replace(f"\\p{{{category}}}", latin_class(category))
        self.pattern = re.compile(pattern)  # for characters below U+0250
        self.apart = re.compile("(" + "|".join(map(re.escape, self.special)) + ")")
        self.bytes_of = {c: b for b, c in enumerate(symbols)}

    @functools.cached_property
    def library(self):
        from tokenizers import Tokenizer

        return Tokenizer.from_file(self.path)

    def pieces(self, text: str) -> Iterator[list[str]]:
        """The pieces of a text in order, span by span; a special token is a piece of its own."""
        for i, part in enumerate(self.apart.split(text) if "<|" in text else [text]):
            if i % 2:
                yield [part]
                continue
            for span in spans(part):
                if not span.isascii() and OTHER.search(span):
                    lib = self.library
                    pairs = lib.pre_tokenizer.pre_tokenize_str(lib.normalizer.normalize_str(span))
                    yield [bytes(map(self.bytes_of.__getitem__, p)).decode("utf-8") for p, _ in pairs]
                else:
                    yield self.pattern.findall(span.lower())

    def ranks_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The merge rank of each pair of symbols, or -1."""
        key = left.astype(np.int64) << 20 | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.key_ranks[at], np.int32(-1))

    def encode_pieces(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids end to end, number of ids of each piece) of pieces that are no special tokens."""
        raw = [p.encode("utf-8") for p in pieces]
        ends = np.cumsum(np.fromiter(map(len, raw), np.int64, len(raw)))
        data = np.frombuffer(b"".join(raw), np.uint8)
        del raw
        n = len(data)
        # arrays of Python and of numpy over the same numbers: the one for single merges, the other for many
        chain_, after_, before_ = (array("i", bytes(4 * n)) for _ in range(3))
        chain, after, before = (np.frombuffer(x, np.int32) for x in (chain_, after_, before_))
        chain[:] = self.first[data]
        chain[ends - 1] = self.last[data[ends - 1]]
        after[:], before[:] = np.arange(1, n + 1), np.arange(-1, n - 1)
        after[ends - 1] = -1
        before[np.concatenate([[0], ends[:-1]])] = -1
        index: dict[int, list[np.ndarray]] = {}
        singles: dict[int, list[int]] = {}
        ranks: list[int] = []
        rank_of = self.rank.get

        def note(at: np.ndarray) -> None:
            """Add the pairs that start at these positions to the lists of their ranks."""
            found = self.ranks_of(chain[at], chain[after[at]])
            good = found >= 0
            found, at = found[good], at[good]
            order = np.argsort(found, kind="stable")
            found, at = found[order], at[order]
            cuts = np.flatnonzero(np.diff(found, prepend=-1))
            for r, x, y in zip(found[cuts].tolist(), cuts.tolist(), [*cuts[1:].tolist(), len(found)]):
                if r in index:
                    index[r].append(at[x:y])
                else:
                    if r not in singles:
                        heapq.heappush(ranks, r)
                    index[r] = [at[x:y]]

        def note_one(i: int) -> None:
            r = rank_of(chain_[i] << 20 | chain_[after_[i]])
            if r is not None:
                if r in singles:
                    singles[r].append(i)
                else:
                    if r not in index:
                        heapq.heappush(ranks, r)
                    singles[r] = [i]

        note(np.flatnonzero(after >= 0).astype(np.int32))
        while ranks:
            rank = heapq.heappop(ranks)
            lists, few = index.pop(rank, []), singles.pop(rank, [])
            a, b, new = self.by_rank[rank]
            if a == b or sum(map(len, lists)) + len(few) < MANY:
                for i in sorted([*few, *(i for x in lists for i in x.tolist())]):  # left to right, where a symbol pairs with itself
                    j = after_[i]
                    if j < 0 or chain_[i] != a or chain_[j] != b:
                        continue  # a merge of lower rank took one of the two
                    chain_[i], chain_[j] = new, -1
                    after_[i] = k = after_[j]
                    if k >= 0:
                        before_[k] = i
                        note_one(i)
                    if before_[i] >= 0:
                        note_one(before_[i])
                continue
            at = np.concatenate([*lists, np.array(few, np.int32)])
            j = after[at]
            good = (j >= 0) & (chain[at] == a) & (chain[j] == b)
            at, j = at[good], j[good]
            k = after[j]
            chain[at], chain[j], after[at] = new, -1, k
            inner = k >= 0
            before[k[inner]] = at[inner]
            left = before[at]
            left = left[left >= 0]
            # a pair of two new symbols is noted once, from its left one
            note(np.concatenate([at[inner], left[chain[left] != new]]))
        cut = np.concatenate([[0], np.cumsum(chain >= 0)])
        return chain[chain >= 0], np.diff(cut[np.concatenate([[0], ends])])


@functools.lru_cache(4)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


class Grown:
    """An array that grows at its end; its room doubles."""

    def __init__(self, kind: type):
        self.room, self.n = np.empty(1024, kind), 0

    def extend(self, values: np.ndarray) -> None:
        if self.n + len(values) > len(self.room):
            room = np.empty(max(2 * len(self.room), self.n + len(values)), self.room.dtype)
            room[: self.n] = self.room[: self.n]
            self.room = room
        self.room[self.n : self.n + len(values)] = values
        self.n += len(values)


class Generation(dict):
    """Numbers of pieces; a piece that is asked for the first time gets the next number. The ids of number n lie from starts[n] on."""

    def __init__(self) -> None:
        super().__init__()
        self.fresh: list[str] = []
        self.ids, self.starts, self.lengths = Grown(np.int32), Grown(np.int64), Grown(np.int32)
        self.chars = 0

    def __missing__(self, piece: str) -> int:
        n = self[piece] = len(self)
        self.fresh.append(piece)
        self.chars += len(piece)
        return n

    def add(self, ids: np.ndarray, lengths: np.ndarray) -> None:
        self.starts.extend(self.ids.n + np.cumsum(lengths) - lengths)
        self.lengths.extend(lengths)
        self.ids.extend(ids)

    def take(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids end to end, how many of each number)"""
        lengths = self.lengths.room[numbers].astype(np.int64)
        ends = np.cumsum(lengths)
        total = int(ends[-1]) if len(ends) else 0
        return self.ids.room[np.repeat(self.starts.room[numbers] - ends + lengths, lengths) + np.arange(total)], lengths


class Remembered:
    """Encodes texts and remembers pieces, at most two generations of them."""

    def __init__(self, words: Vocabulary):
        self.words, self.newer, self.older = words, Generation(), Generation()

    def settle(self) -> None:
        """Give fresh pieces their ids: from the older generation, or by merging."""
        now, older = self.newer, self.older
        known = [p in older for p in now.fresh]
        merged, special = [p for p, k in zip(now.fresh, known) if not k], self.words.special
        if special.keys() & set(merged):
            plain, plain_lengths = self.words.encode_pieces([p for p in merged if p not in special])
            starts = iter(np.split(plain, np.cumsum(plain_lengths)[:-1]))
            each = [np.array([special[p]], np.int32) if p in special else next(starts) for p in merged]
            ids, lengths = np.concatenate(each), np.array([len(x) for x in each], np.int64)
        elif merged:
            ids, lengths = self.words.encode_pieces(merged)
        else:
            ids, lengths = np.zeros(0, np.int32), np.zeros(0, np.int64)
        if len(merged) < len(known):
            old_ids, old_lengths = older.take(np.array([older[p] for p, k in zip(now.fresh, known) if k], np.int64))
            # back in the order of fresh: numbers of the old ones follow those of the merged ones
            at = np.array(known)
            source = np.empty(len(known), np.int64)
            source[~at], source[at] = np.arange(len(merged)), len(merged) + np.arange(len(old_lengths))
            both = Generation()
            both.add(np.concatenate([ids, old_ids]), np.concatenate([lengths, old_lengths]))
            ids, lengths = both.take(source)
        now.add(ids, lengths)
        now.fresh = []

    def flush(self, asked: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        if self.newer.fresh:
            self.settle()
        out = self.newer.take(np.concatenate(asked) if asked else np.zeros(0, np.int64))
        if len(self.newer) > REMEMBERED or self.newer.chars > REMEMBERED_CHARS:
            # what a single very long text brought isn't kept
            self.older, self.newer = (self.newer if self.newer.chars <= 4 * REMEMBERED_CHARS else Generation()), Generation()
        return out

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(ids end to end, where each text's begin and the last end)."""
        ids, lengths, asked, open_pieces, counts = [], [], [], 0, np.zeros(len(texts) + 1, np.int64)
        for i, t in enumerate(texts):
            for pieces in self.words.pieces(t) if t else ():
                asked.append(np.fromiter(map(self.newer.__getitem__, pieces), np.int64, len(pieces)))
                counts[i + 1] += len(pieces)
                open_pieces += len(pieces)
                if open_pieces >= AT_ONCE:
                    for out, part in zip((ids, lengths), self.flush(asked)):
                        out.append(part)
                    asked, open_pieces = [], 0
        for out, part in zip((ids, lengths), self.flush(asked)):
            out.append(part)
        ends = np.concatenate([[0], np.cumsum(np.concatenate(lengths))])
        return np.concatenate(ids), ends[np.cumsum(counts)]


@functools.lru_cache(4)
def remembered(path: str) -> Remembered:
    """A worker's own, for all its tasks."""
    return Remembered(vocabulary(path))


def joined_tokens(words: Vocabulary, flat: np.ndarray, limits: np.ndarray) -> list[str]:
    """The tokens of each run of ids, joined by spaces."""
    known = (flat >= 0) & (flat < len(words.tokens))
    if not known.all() or (words.tokens[flat] == None).any():  # noqa: E711
        known = known & (words.tokens[np.where(known, flat, 0)] != None)  # noqa: E711
        limits = np.concatenate([[0], np.cumsum(known)])[limits]
        flat = flat[known]
    out = []
    for a, b in zip(limits[:-1].tolist(), limits[1:].tolist()):
        # the tokens of a very long list aren't held all at once
        parts = [" ".join(words.tokens[flat[i : min(i + AT_ONCE, b)]].tolist()) for i in range(a, b, AT_ONCE)]
        out.append(" ".join(parts))
    return out


def encode(df: DataFrame, text: str, path: str, keep: list[str], out: str = "ids", decoded: str | None = None) -> DataFrame:
    """The ``keep`` columns of ``df`` and the ids of each whole text; with ``decoded``, what these decode to as well, in the same pass."""
    keep = [c for c in keep if c not in (out, decoded)]
    rows = df.select(*[df[c] for c in keep], df[text].cast("string").alias("_text"))
    names = [*keep, out, *([decoded] if decoded else [])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = remembered(path)
        for batch in batches:
            for at, n in slices(batch.column(len(keep))):
                part = batch.slice(at, n)
                flat, limits = known.encode(part.column(len(keep)).to_pylist())
                columns = [*part.columns[: len(keep)], pa.ListArray.from_arrays(pa.array(limits.astype(np.int32)), pa.array(flat))]
                if decoded:
                    columns.append(pa.array(joined_tokens(known.words, flat, limits), pa.string()))
                yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = rows.select(*keep).schema.add(out, T.ArrayType(T.IntegerType()))
    return rows.mapInArrow(run, schema.add(decoded, "string") if decoded else schema)


def decode(df: DataFrame, ids: str, path: str, keep: list[str], out: str = "decoded") -> DataFrame:
    """The ``keep`` columns of ``df`` and the tokens of each list of ids, joined by spaces, as a vocabulary without a decoder has them."""
    keep = [c for c in keep if c != out]
    rows = df.select(*[df[c] for c in keep], df[ids].cast("array<int>").alias("_ids"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = vocabulary(path)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                lists = part.column(len(keep))
                flat = pa.compute.fill_null(lists.flatten(), -1).to_numpy(zero_copy_only=False)
                sizes = pa.compute.fill_null(pa.compute.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
                texts = joined_tokens(words, flat, np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)]))
                found = pa.array(texts, pa.string(), mask=lists.is_null().to_numpy(zero_copy_only=False))
                yield pa.RecordBatch.from_arrays([*part.columns[: len(keep)], found], names=[*keep, out])

    return rows.mapInArrow(run, rows.select(*keep).schema.add(out, "string"))


def joined(ids: Column) -> Column:
    """Decimal ids joined by one space."""
    return F.array_join(ids.cast("array<string>"), " ")
