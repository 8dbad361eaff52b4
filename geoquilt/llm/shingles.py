"""Word shingles of many texts at once, as 64-bit hashes, straight from Arrow's string buffers.

Words of one length up to eight bytes never share a hash; two other words, or two shingles, do with a probability of
2 ** -64. Words beyond 32 bytes are hashed by BLAKE2b.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_GAP = np.zeros(256, bool)
_GAP[[9, 10, 11, 12, 13, 32]] = True
#: Bytes of a word up to which it is hashed in lanes of eight; longer ones are hashed one by one.
_SHORT = 32

_M1, _M2, _S = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def words_of(data: np.ndarray, limits: np.ndarray, gaps: np.ndarray = _GAP, most: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each word, number of its text) for texts that lie end to end in ``data`` between ``limits``; of ``most`` leading bytes."""
    data = _LOWER[data]
    word = np.empty(len(data) + 2, bool)
    word[0] = word[-1] = False
    np.logical_not(gaps[data], out=word[1:-1])
    start = word[1:-1] & ~word[:-2]
    end = word[1:-1] & ~word[2:]
    cut = limits[1:-1]
    inner = cut[(cut > 0) & (cut < len(data))]
    start[inner] |= word[1:-1][inner]
    end[inner - 1] |= word[1:-1][inner - 1]
    first, last = np.flatnonzero(start), np.flatnonzero(end)
    size = last - first + 1
    if most is not None:
        size = np.minimum(size, most)
    # eight bytes from every position on, without copying them
    lanes = np.ndarray(len(data) + _SHORT - 7, "<u8", np.concatenate([data, np.zeros(_SHORT, np.uint8)]).tobytes(), strides=(1,))
    out = mix(size.astype(np.uint64) * _S)
    for j in range(0, _SHORT, 8):
        here = np.flatnonzero(size > j)
        if not len(here):
            break
        rest = np.minimum(size[here] - j, 8).astype(np.uint64)
        lane = lanes[first[here] + j] & (np.uint64(2**64 - 1) >> (np.uint64(64) - np.uint64(8) * rest))
        out[here] = mix(out[here] ^ mix(lane + np.uint64(j + 1)))
    for i in np.flatnonzero(size > _SHORT):
        out[i] = int.from_bytes(hashlib.blake2b(data[first[i] : first[i] + size[i]].tobytes(), digest_size=8).digest(), "little")
    return out, np.searchsorted(limits, first, side="right") - 1


def shingle_sets(texts: pa.Array, k: int) -> list[np.ndarray]:
    """The sorted distinct k-word shingles of each text; of a text with fewer words, the whole sequence; null: none."""
    texts = texts.cast(pa.large_string())
    limits = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, texts.offset * 8) if len(texts) else np.zeros(1, np.int64)
    raw = texts.buffers()[2] if len(texts) else None
    data = np.frombuffer(raw, np.uint8)[limits[0] : limits[-1]] if raw is not None else np.zeros(0, np.uint8)
    words, owner = words_of(data, limits - limits[0])
    edges = np.searchsorted(owner, np.arange(len(texts) + 1))
    rolled = words.copy()
    for j in range(1, k):
        rolled[: len(words) - j] = mix(rolled[: len(words) - j] * _M2 + words[j:]) if len(words) > j else rolled[:0]
    out = []
    for a, b in zip(edges[:-1], edges[1:], strict=True):
        if b - a >= k:
            out.append(np.unique(rolled[a : b - k + 1]))
        elif b > a:
            h = np.uint64(b - a)
            for w in words[a:b]:
                h = mix(np.array([h], np.uint64) * _M2 + w)[0]
            out.append(np.array([h], np.uint64))
        else:
            out.append(np.zeros(0, np.uint64))
    return out
