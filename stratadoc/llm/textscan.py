"""Vectorised word scanning and hashing over UTF-8 bytes (numpy, no loop over characters or words)."""

from __future__ import annotations

import hashlib

import numpy as np

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_GRAM = np.uint64(0xD6E8FEB86659FD93)
_KEPT = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)  # the first n of eight bytes


def _byte_table(words: str) -> np.ndarray:
    t = np.zeros(256, bool)
    t[[b for b in range(256) if b >= 0x80 or chr(b) in words]] = True
    return t


#: ASCII digits and letters, and every byte of a longer UTF-8 sequence.
ALNUM = _byte_table("0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ")
#: All but space and \t to \r.
NONSPACE = ~np.isin(np.arange(256), [0x20, 9, 10, 11, 12, 13])
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit (the finaliser of splitmix64)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def spans(raw: np.ndarray, offsets: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends (bytes) of the maximal runs of table bytes inside each text, and the number of runs per text."""
    n = len(raw)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets) - 1, np.int64)
    inside = table[raw]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    heads = offsets[:-1][offsets[:-1] < n]
    first[heads] = inside[heads]  # a text starts a new run
    last = inside.copy()
    last[:-1] &= ~inside[1:] | first[1:]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    counts = np.diff(np.searchsorted(starts, offsets))
    return starts, ends, counts


def eights(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each run's bytes as 64-bit words, the last filled with zeros: all words, where each run's begin, their place in the run.

    An empty run has one word, 0.  Runs of one length are equal if their words are.
    """
    lengths = ends - starts
    counts = np.maximum(1, (lengths + 7) >> 3)
    heads = np.cumsum(counts) - counts
    place = np.arange(int(counts.sum())) - np.repeat(heads, counts)
    at = np.repeat(starts, counts) + 8 * place
    padded = np.concatenate([raw, np.zeros(8, np.uint8)])
    every = np.ndarray((len(raw) + 1,), "<u8", padded, strides=(1,))[at]
    every &= _KEPT[np.minimum(8, np.repeat(ends, counts) - at)]
    return every, heads, place


def eight_hashes(every: np.ndarray, heads: np.ndarray, place: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each run of ``eights``.  Every word is mixed with its place before the words are added, so no
    pattern of equal letters (as that of a word and its complement) cancels out."""
    if not len(heads):
        return np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        mixed = mix(every ^ mix(place.astype(np.uint64) * _BASE + np.uint64(1)))
        total = np.add.reduceat(mixed, heads) if len(heads) < len(every) else mixed
        return mix(total + lengths.astype(np.uint64) * _GRAM)


def word_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each run of bytes."""
    return eight_hashes(*eights(raw, starts, ends), ends - starts)


def words_of(raw: np.ndarray, offsets: np.ndarray) -> tuple[list[np.ndarray], list[bytes | None]]:
    """Of each text the hashes of its lower-cased alphanumeric words, and an exact digest of these words (None without any)."""
    low = LOWER[raw]
    starts, ends, counts = spans(low, offsets, ALNUM)
    hashes = np.split(word_hashes(low, starts, ends), np.cumsum(counts)[:-1])
    # the words with a space after each: what is in a word, and the byte behind it
    kept = ALNUM[low]
    low = np.append(np.where(kept, low, 32).astype(np.uint8), np.uint8(32))
    kept = np.append(kept, False)
    kept[ends] = True
    inner = np.searchsorted(starts, offsets)
    out: list[bytes | None] = []
    for a, b in zip(inner[:-1].tolist(), inner[1:].tolist(), strict=True):
        if a == b:
            out.append(None)
            continue
        s, e = int(starts[a]), int(ends[b - 1])
        out.append(hashlib.blake2b(low[s:e][kept[s:e]].tobytes(), digest_size=16).digest())
    return hashes, out


def gram_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """The hash of the k words from each place on, for the len - k + 1 places that have so many."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        acc = words[:n].copy()
        for j in range(1, k):
            acc ^= acc >> np.uint64(31)
            acc *= _GRAM
            acc += words[j : j + n]
    return mix(acc)


def window_minima(values: np.ndarray, w: int) -> np.ndarray:
    """The minimum of each w neighbours (len - w + 1 values), in log w passes."""
    width, m = 1, values
    while width * 2 <= w:
        m = np.minimum(m[: len(m) - width], m[width:]) if len(m) > width else m[:0]
        width *= 2
    rest = w - width
    return np.minimum(m[: len(m) - rest], m[rest:]) if rest and len(m) > rest else (m[:0] if rest else m)


def covered(n: int, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Which of n places the ranges start .. start + length cover."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + lengths, -1)
    return np.cumsum(edge[:-1]) > 0
