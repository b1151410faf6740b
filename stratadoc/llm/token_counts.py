"""Word-piece token counts by a linear longest-match automaton.

The vocabulary is a trie.  Each node has a failure link and the number of pieces that are popped when it is taken, both
computed once, so that greedy longest-match-first lengths come from one pass over a word's bytes, without pieces.
The vocabulary's word-end mark is part of the last byte, of words as of pieces: a piece with the mark matches at a word's
end only, one without it never does.  A word that the vocabulary cannot cover counts as one unknown token.

Null and empty texts have no words and no tokens; a text may have any length; every row is counted by itself, so repeated
rows repeat their counts; an empty table gives no rows; extra columns are not read, whatever their names.
"""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Iterable, Sequence
from functools import cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from . import shared
from .chunks import Chunks
from .piece_bpe import byte_characters

_END = 256  # added to the last byte of a word
_WIDE = 2 * _END


class LongestMatch:
    """initial: pieces that may begin a word; inner: those that may follow."""

    def __init__(self, initial: Iterable[Sequence[int]], inner: Iterable[Sequence[int]]):
        self.next: dict[int, int] = {}
        depth, piece, above = [0, 0], [False, False], [(-1, -1), (-1, -1)]
        for root, pieces in ((0, initial), (1, inner)):
            for p in pieces:
                v = root
                for b in p:
                    key = v * _WIDE + b
                    if key not in self.next:
                        self.next[key] = len(depth)
                        depth.append(depth[v] + 1), piece.append(False), above.append((v, b))
                    v = self.next[key]
                piece[v] = v > 1
        self.fail, self.popped = [-1] * len(depth), [0] * len(depth)
        for v in sorted(range(2, len(depth)), key=depth.__getitem__):
            if piece[v]:
                self.fail[v], self.popped[v] = 1, 1
                continue
            u, b = above[v]
            z, n = self.fail[u], self.popped[u]
            while z >= 0 and z * _WIDE + b not in self.next:
                n += self.popped[z]
                z = self.fail[z]
            if z >= 0:
                self.fail[v], self.popped[v] = self.next[z * _WIDE + b], n

    def count(self, word: Sequence[int]) -> int:
        """The number of greedy pieces; 1 if the word cannot be covered, 0 if it is empty."""
        step, fail, popped = self.next.get, self.fail, self.popped
        v = n = 0
        for b in word:
            while (to := step(v * _WIDE + b)) is None:
                n += popped[v]
                v = fail[v]
                if v < 0:
                    return 1
            v = to
        while v > 1:
            n += popped[v]
            v = fail[v]
            if v < 0:
                return 1
        return n


def marked(word: bytes) -> tuple[int, ...]:
    return (*word[:-1], word[-1] + _END) if word else ()


def read_pieces(path: str) -> tuple[set[tuple[int, ...]], str]:
    """The pieces of a word vocabulary of the tokenizers library, its word-end mark in the last byte; its word pattern."""
    with open(path) as f:
        spec = json.load(f)
    back = {c: b for b, c in enumerate(byte_characters())}
    end = spec["model"]["end_of_word_suffix"]
    special = {t["content"] for t in spec["added_tokens"]}
    words = next(p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
    plain = lambda p: bytes(back[c] for c in p)
    pieces = (p for p in spec["model"]["vocab"] if p not in special and p != end)
    return {marked(plain(p.removesuffix(end))) if p.endswith(end) else tuple(plain(p)) for p in pieces}, words


@cache
def _counter(path: str) -> Chunks:
    """One for each Python worker: the words and tokens of a chunk."""
    pieces, pattern = read_pieces(path)
    automaton, words = LongestMatch(pieces, pieces), regex.compile(pattern).findall

    def compute(chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = [words(unicodedata.normalize("NFC", c).lower()) for c in chunks]
        return np.array([n for w in found for n in (len(w), sum(automaton.count(marked(x.encode())) for x in w))], np.int32), np.full(len(chunks), 2)

    return Chunks(compute)


def token_counts(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_words, n_tokens, a row per document."""

    def run(batches):
        count = _counter(path)
        for batch in batches:
            for part in shared.pieces(batch):
                values, ends = count(*shared.utf8(part.column("text")))
                total = np.concatenate([[[0, 0]], np.cumsum(values.reshape(-1, 2), axis=0, dtype=np.int64)])[ends // 2]
                sums = total[1:] - total[:-1]
                yield pa.RecordBatch.from_pydict({"doc_id": part.column("doc_id").cast(pa.int64()), "n_words": sums[:, 0], "n_tokens": sums[:, 1]})

    return shared.id_and_text(docs).mapInArrow(run, "doc_id long, n_words long, n_tokens long")
