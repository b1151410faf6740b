"""Per-chunk caching for tokenizers whose pre-tokens never reach across the end of a run of white space.

Texts are cut into chunks: a word with the one space before it, or white space.  Each distinct chunk is tokenized once
while it stays in the table; all else (cutting, hashing, looking up, putting together) is vectorised over bytes.  A chunk
is found by its hash and then compared byte by byte.  Texts of any length go through in slices, so that neither the
table nor the arrays depend on a text's length or on how many distinct chunks it has.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence

import numpy as np

from . import textscan

_BITS = 21
_MOST = 1_200_000
#: Chunks and bytes that one step looks up (a longer chunk has a step of its own).
_SLICE, _SLICE_BYTES = 1 << 17, 1 << 20
_ASCII_WHITE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
#: Unicode White_Space beyond ASCII, fixed values.
_WIDE_WHITE = [0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
_CODES = {n: np.array([int.from_bytes(chr(c).encode()) for c in _WIDE_WHITE if len(chr(c).encode()) == n]) for n in (2, 3)}
_LEADS = np.isin(np.arange(256), [chr(c).encode()[0] for c in _WIDE_WHITE])


def _wide_white(raw: np.ndarray) -> dict[int, np.ndarray]:
    """Where white-space characters of two and of three bytes begin."""
    at = np.flatnonzero(_LEADS[raw])
    code = np.zeros(len(at), np.int64)
    out = {}
    for n in (1, 2, 3):
        ok = at + n <= len(raw)
        code[ok] = code[ok] << 8 | raw[at[ok] + n - 1]
        if n in _CODES:
            out[n] = at[ok & np.isin(code, _CODES[n])]
    return out


def cuts(raw: np.ndarray, offsets: np.ndarray, marks: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Starts of the chunks (the end last), and of each text the number of its first chunk (the number of all last).

    Texts end, for their tokenizer, at ``marks`` too.

    White space before a word is a pre-token up to its last character; that one is one too, unless it is a space, which
    belongs to the word.
    """
    n = len(raw)
    if not n:
        return np.zeros(1, np.int64), np.zeros(len(offsets), np.int64)
    white = _ASCII_WHITE[raw]
    begins = white.copy()  # first bytes of white-space characters
    for size, at in _wide_white(raw).items():
        begins[at] = True
        for k in range(size):
            white[at + k] = True
    head = np.zeros(n + 1, bool)
    head[offsets] = True
    if marks is not None:
        head[marks] = True
    before = np.concatenate([[False], white[:-1]]) & ~head[:-1]
    runs = np.flatnonzero(white & ~before)
    after = np.concatenate([white[1:], [False]]) & ~head[1:]
    ends = np.flatnonzero(white & ~after) + 1
    word_next = ends[~head[ends]]
    places = np.flatnonzero(begins)
    last = places[np.searchsorted(places, word_next) - 1] if len(places) else word_next
    mark = np.zeros(n + 1, bool)
    mark[runs] = mark[last] = mark[word_next[raw[last] != 32]] = True
    mark |= head
    starts = np.flatnonzero(mark)
    return starts, np.searchsorted(starts, offsets)


class Chunks:
    """compute: the values of each of several chunks, as one int32 array and the number of values of each.

    ``apart``: strings that are chunks of their own, wherever they stand; what is before and after is tokenized by itself.
    """

    def __init__(self, compute: Callable[[list[str]], tuple[np.ndarray, np.ndarray]], most: int = _MOST, apart: Sequence[str] = ()):
        self.compute, self.most = compute, most
        longest_first = sorted((a.encode() for a in apart), key=len, reverse=True)
        self.apart = re.compile(b"|".join(map(re.escape, longest_first))) if longest_first else None
        self.clear()

    def clear(self) -> None:
        """An entry: hash, length, words (``eights``; the first, and where the others are) and values."""
        self.slots = np.full(1 << _BITS, -1, np.int32)
        self.keys, self.first = np.zeros(1 << 12, np.uint64), np.zeros(1 << 12, np.uint64)
        self.lengths, self.others, self.starts, self.sizes = (np.zeros(1 << 12, np.int32) for _ in range(4))
        self.rest, self.n_rest = np.zeros(1 << 12, np.uint64), 0
        self.values, self.n, self.used = np.zeros(1 << 14, np.int32), 0, 0

    def _same(self, entry: np.ndarray, at: np.ndarray, every: np.ndarray, heads: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Whether the entries hold the bytes of the chunks ``at``."""
        same = (self.lengths[entry] == lengths[at]) & (self.first[entry] == every[heads[at]])
        long = np.flatnonzero(same & (lengths[at] > 8))
        if len(long):
            more = (lengths[at[long]] - 1) >> 3  # words after the first
            ends = np.cumsum(more)
            place = np.arange(int(ends[-1])) - np.repeat(ends - more, more)
            equal = self.rest[np.repeat(self.others[entry[long]], more) + place] == every[np.repeat(heads[at[long]] + 1, more) + place]
            same[long] = np.logical_and.reduceat(equal, ends - more)
        return same

    def _find(self, at: np.ndarray, hashes: np.ndarray, words: tuple) -> np.ndarray:
        """The entry of each of the chunks ``at``; -1 where there is none."""
        slot = (hashes[at] >> np.uint64(64 - _BITS)).astype(np.int64)
        found = self.slots[slot].astype(np.int64)
        open_ = np.arange(len(at))
        while len(open_):
            entry = found[open_]
            open_ = open_[entry >= 0]
            entry = found[open_]
            wrong = self.keys[entry] != hashes[at[open_]]
            right = np.flatnonzero(~wrong)
            wrong[right] = ~self._same(entry[right], at[open_[right]], *words)
            open_ = open_[wrong]
            slot[open_] = (slot[open_] + 1) & ((1 << _BITS) - 1)
            found[open_] = self.slots[slot[open_]]
        return found

    def _add(self, at: np.ndarray, hashes: np.ndarray, words: tuple, values: np.ndarray, sizes: np.ndarray) -> None:
        """New chunks of different hashes with their values."""
        every, heads, lengths = words
        more = np.maximum(0, lengths[at] - 1) >> 3
        m, k, r = len(at), len(values), int(more.sum())
        grow = lambda a, most: np.concatenate([a, np.zeros(max(most, 2 * len(a)) - len(a), a.dtype)]) if most > len(a) else a
        for name, most in (*((x, self.n + m) for x in ("keys", "first", "lengths", "others", "starts", "sizes")), ("rest", self.n_rest + r), ("values", self.used + k)):
            setattr(self, name, grow(getattr(self, name), most))
        entry = np.arange(self.n, self.n + m)
        self.keys[entry], self.first[entry], self.lengths[entry] = hashes[at], every[heads[at]], lengths[at]
        before = np.cumsum(more) - more
        self.others[entry] = self.n_rest + before
        self.rest[self.n_rest : self.n_rest + r] = every[np.repeat(heads[at] + 1 - before, more) + np.arange(r)]
        self.sizes[entry], self.starts[entry] = sizes, self.used + np.cumsum(sizes) - sizes
        self.values[self.used : self.used + k] = values
        self.n, self.used, self.n_rest = self.n + m, self.used + k, self.n_rest + r
        slot = (hashes[at] >> np.uint64(64 - _BITS)).astype(np.int64)
        while len(entry):
            free = self.slots[slot] < 0
            self.slots[slot[free]] = entry[free]
            left = self.slots[slot] != entry
            entry, slot = entry[left], (slot[left] + 1) & ((1 << _BITS) - 1)

    def _marks(self, raw: np.ndarray, offsets: np.ndarray) -> np.ndarray | None:
        if self.apart is None:
            return None
        whole, out = raw.tobytes(), []
        for m in self.apart.finditer(whole):
            text = np.searchsorted(offsets, m.start(), side="right")
            if m.end() <= offsets[text]:  # not across two texts
                out += m.span()
        return np.array(out, np.int64)

    def _slice(self, raw: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The values of the chunks between neighbouring starts, and how many each has."""
        lengths = starts[1:] - starts[:-1]
        every, heads, place = textscan.eights(raw, starts[:-1], starts[1:])
        hashes, words = textscan.eight_hashes(every, heads, place, lengths), (every, heads, lengths)
        if self.n + len(lengths) > max(self.most, len(lengths)) or self.used > 8 * self.most or self.n_rest > 4 * self.most:
            self.clear()
        found = self._find(np.arange(len(lengths)), hashes, words)
        lost = np.flatnonzero(found < 0)
        while len(lost):  # once, but for different chunks of one hash
            where = lost[np.unique(hashes[lost], return_index=True)[1]]
            self._add(where, hashes, words, *self.compute([raw[a:b].tobytes().decode() for a, b in zip(starts[where].tolist(), starts[where + 1].tolist(), strict=True)]))
            found[lost] = self._find(lost, hashes, words)
            lost = lost[found[lost] < 0]
        size = self.sizes[found]
        before = np.cumsum(size) - size
        return self.values[np.repeat(self.starts[found] - before, size) + np.arange(int(size.sum()))], size

    def __call__(self, raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The values of all texts one after the other, and len + 1 offsets of the texts among them."""
        starts, firsts = cuts(raw, offsets, self._marks(raw, offsets))
        parts, sizes, at = [np.zeros(0, np.int32)], [np.zeros(1, np.int64)], 0
        while at + 1 < len(starts):
            to = min(at + _SLICE, max(at + 1, int(np.searchsorted(starts, starts[at] + _SLICE_BYTES, side="right")) - 1), len(starts) - 1)
            values, size = self._slice(raw[starts[at] : starts[to]], starts[at : to + 1] - starts[at])
            parts.append(values), sizes.append(size)
            at = to
        return np.concatenate(parts), np.cumsum(np.concatenate(sizes))[firsts]


def joined(parts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """What compute returns, of an array for each chunk."""
    return np.concatenate(parts).astype(np.int32) if parts else np.zeros(0, np.int32), np.array([len(p) for p in parts], np.int64)
