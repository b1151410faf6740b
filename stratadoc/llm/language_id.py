"""Language identification by prediction by partial matching over bytes.

For each language a context tree of orders 0 to ``ORDER`` counts which byte follows which context.  A byte's probability
is the longest known context's count, or that context's escape probability (its distinct followers against count plus
distinct followers, method C, without exclusions) times the next shorter context's; at the end all 256 bytes are alike.
The trees hold every context that the samples have, of whatever order.  The statistics are frozen after the fit: the code
length of every (context, byte) that some language has seen is resolved once for all languages, as is each context's
escape, so a text's exact code length is a sum of looked-up rows over all its bytes.  The language with the shortest code
wins; the score is its posterior probability under equal priors.

Fitted on at most ``DOCS`` rows a language (first by a hash of doc_id, whatever their length, of rows with text) and at
most ``CHARS`` characters of each, in pieces spread over the whole text.  ``und`` with score 0 where a text is null or
has no letter, or nothing could be learned; ties go to the language that sorts first.  A text to be identified is read
whole, however long; every row is judged by itself, so repeated rows repeat their result; an empty table gives no rows;
extra columns are not read, whatever their names.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import shared

ORDER, DOCS, CHARS = 3, 300, 20_000
_SYMBOL = 9  # bits of a symbol: a byte and one, or 0 before a text's start
_CANDIDATES = 4  # of rows as many times as are wanted are ranked
_LETTER = re.compile(r"[^\W\d_]").search


def _keys(raw: np.ndarray, offsets: np.ndarray, start: int, end: int) -> np.ndarray:
    """Of the places from start to end: the byte, and above it the bytes before, nearest first."""
    padded = np.concatenate([np.zeros(ORDER, np.uint8), raw[max(0, start - ORDER) : end]])
    first = ORDER + min(ORDER, start)
    out = raw[start:end].astype(np.int64) + 1
    heads = offsets[:-1][(offsets[:-1] > start - ORDER) & (offsets[:-1] < end) & (offsets[1:] > offsets[:-1])]
    for back in range(1, ORDER + 1):
        symbol = padded[first - back : first - back + end - start].astype(np.int64) + 1
        outside = (heads[:, None] + np.arange(back)).ravel() - start  # texts shorter than this end where the next begins
        symbol[outside[(outside >= 0) & (outside < end - start)]] = 0
        out |= symbol << (_SYMBOL * back)
    return out


def _order(keys: np.ndarray, k: int) -> np.ndarray:
    """The keys with contexts of k bytes only."""
    return keys & ((1 << _SYMBOL * (k + 1)) - 1)


def _row(names: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the wanted are among sorted names, and whether they are."""
    at = np.minimum(np.searchsorted(names, wanted), max(0, len(names) - 1))
    return at, names[at] == wanted if len(names) else np.zeros(len(wanted), bool)


def fit(samples: dict[str, list[str]]) -> dict | None:
    """By order: the (context, byte) that are known and the contexts, with code lengths and escapes (bits) by language."""
    names = sorted(n for n in samples if any(samples[n]))
    if not names:
        return None
    seen = []
    for n in names:
        raw, offsets = shared.utf8(pa.array(samples[n], pa.string()))
        seen.append(np.unique(_keys(raw, offsets, 0, len(raw)), return_counts=True))
    levels: list[tuple] = []
    for k in range(ORDER + 1):
        own = []
        for keys, n in seen:
            short, at = np.unique(_order(keys, k), return_inverse=True)
            own.append((short, np.bincount(at, n)))
        pairs = np.unique(np.concatenate([x for x, _ in own]))
        contexts = np.unique(pairs >> _SYMBOL)
        bits, escape = np.empty((len(pairs), len(names)), np.float32), np.empty((len(contexts), len(names)), np.float32)
        for j, (keys, n) in enumerate(own):
            shorter = levels[-1][1][_row(levels[-1][0], _order(pairs, k - 1))[0], j] if levels else np.full(len(pairs), 8.0)
            at = np.searchsorted(contexts, keys >> _SYMBOL)
            total, distinct = np.bincount(at, n, len(contexts)), np.bincount(at, minlength=len(contexts))
            escape[:, j] = np.where(total > 0, np.log2(np.maximum(1, total + distinct) / np.maximum(1, distinct)), 0)
            at, known = _row(keys, pairs)
            context = np.searchsorted(contexts, pairs >> _SYMBOL)
            with np.errstate(divide="ignore"):
                bits[:, j] = np.where(known, np.log2((total + distinct)[context] / np.where(known, n[at], 1)), escape[context, j] + shorter)
        levels.append((pairs, bits, contexts, escape))
    return {"names": names, "levels": levels}


class _Places:
    """Where keys are among some sorted ones, by open addressing."""

    def __init__(self, names: np.ndarray):
        self.names = np.append(names, -1)
        self.bits = max(8, (3 * len(names)).bit_length())
        self.slots = np.full(1 << self.bits, len(names), np.int32)
        entry = np.arange(len(names))
        slot = self._slot(names)
        while len(entry):
            free = self.slots[slot] == len(names)
            self.slots[slot[free]] = entry[free]
            left = self.slots[slot] != entry
            entry, slot = entry[left], (slot[left] + 1) & ((1 << self.bits) - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        """The place of each key; the number of names where there is none."""
        none = len(self.names) - 1
        slot = self._slot(keys)
        found = self.slots[slot]
        open_ = np.flatnonzero((found != none) & (self.names[found] != keys))
        while len(open_):
            slot[open_] = (slot[open_] + 1) & ((1 << self.bits) - 1)
            found[open_] = self.slots[slot[open_]]
            open_ = open_[(found[open_] != none) & (self.names[found[open_]] != keys[open_])]
        return found


class Judge:
    def __init__(self, model: dict):
        self.names = model["names"]
        zero = np.zeros((1, len(self.names)), np.float32)
        self.levels = [(_Places(p), b, _Places(c), np.concatenate([e, zero])) for p, b, c, e in model["levels"]]
        self.step = max(1 << 12, (1 << 20) // max(1, len(self.names)))

    def _costs(self, keys: np.ndarray) -> np.ndarray:
        """Bits of each place under each language."""
        out = np.empty((len(keys), len(self.names)), np.float32)
        places, more = np.arange(len(keys)), None
        for k in range(ORDER, -1, -1):
            pairs, bits, contexts, escape = self.levels[k]
            own = _order(keys[places], k)
            at = pairs(own)
            known = at < len(bits)
            out[places[known]] = bits[at[known]] if more is None else bits[at[known]] + more[known]
            places, own = places[~known], own[~known]
            left = escape[contexts(own >> _SYMBOL)]
            more = left if more is None else left + more[~known]
        out[places] = more + np.float32(8)  # all 256 bytes are alike
        return out

    def code_lengths(self, column: pa.Array) -> np.ndarray:
        """Bits of each text under each language."""
        raw, offsets = shared.utf8(column)
        out = np.zeros((len(column), len(self.names)))
        for start in range(0, len(raw), self.step):
            end = min(len(raw), start + self.step)
            cost = self._costs(_keys(raw, offsets, start, end))
            texts = np.flatnonzero((offsets[:-1] < end) & (offsets[1:] > np.maximum(start, offsets[:-1])))
            out[texts] += np.add.reduceat(cost, np.maximum(offsets[texts], start) - start, axis=0, dtype=np.float64)
        return out

    def __call__(self, column: pa.Array) -> tuple[list[str], list[float]]:
        length = self.code_lengths(column)
        best = length.argmin(axis=1)
        score = 1 / np.exp2(np.clip(length.min(axis=1, keepdims=True) - length, -1000, 0)).sum(axis=1)
        known = [bool(t and _LETTER(t)) for t in column.to_pylist()]
        return [self.names[b] if ok else "und" for b, ok in zip(best, known, strict=True)], [float(s) if ok else 0.0 for s, ok in zip(score, known, strict=True)]


def sampled(labelled: DataFrame, docs: int = DOCS, chars: int = CHARS) -> dict[str, list[str]]:
    """At most ``docs`` texts of each language of (doc_id, lang, text), at most ``chars`` characters of each.

    The rows of a language that are first by a hash of doc_id: a threshold on the hash, from the language's number of
    rows, leaves a few times as many as are wanted, whatever the size of the table, and only these are shuffled.
    """
    rows = labelled.select("doc_id", F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
    counts = rows.where("lang IS NOT NULL").groupBy("lang").agg(F.count("*").alias("n")).collect()  # a row a language, as the model has
    if not counts:
        return {}
    known = labelled.sparkSession.createDataFrame([(r["lang"], _CANDIDATES * docs / r["n"]) for r in counts], "lang string, share double")
    place = F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    near = rows.where("text <> ''").join(F.broadcast(known), "lang").where(F.pmod(place, F.lit(1 << 40)) < F.col("share") * (1 << 40))
    order = Window.partitionBy("lang").orderBy("place", "doc_id", "text")
    got = near.select("lang", "doc_id", F.pmod(place, F.lit(1 << 40)).alias("place"), shared.spread_pieces(F.col("text"), chars).alias("text")).withColumn("n", F.row_number().over(order)).where(F.col("n") <= docs).select("lang", "n", "text").collect()  # docs and chars bound it
    out: dict[str, list[str]] = {}
    for lang, _, text in sorted(got):
        out.setdefault(lang, []).append(text)
    return out


def identified(docs: DataFrame, model: dict | None) -> DataFrame:
    """doc_id, lang_pred, score, a row per document; reads doc_id and text alone."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        judge = Judge(held.value) if held.value else None
        for batch in batches:
            for part in shared.pieces(batch, step=shared.STEP_BYTES // 2):
                names, scores = judge(part.column("text")) if judge else (["und"] * part.num_rows, [0.0] * part.num_rows)
                yield pa.RecordBatch.from_pydict({"doc_id": part.column("doc_id").cast(pa.int64()), "lang_pred": pa.array(names, pa.string()), "score": pa.array(scores, pa.float64())})

    return shared.id_and_text(docs).mapInArrow(run, "doc_id long, lang_pred string, score double")
