"""Quality rules: a hashed n-gram logistic regression with calibrated probabilities, beside fixed base rules.

Features are the hashes of words, of pairs of neighbouring words and of four neighbouring characters, each in one of
``2 ** BITS`` weights; a text's score is the bias plus the mean weight of its words, of its pairs and of its character
grams.  The regression is fitted on at most ``SAMPLE_ROWS`` labelled rows (those that come first by a hash of doc_id,
whatever their length) and at most ``SAMPLE_CHARS`` characters of each, in pieces spread over the whole text; every fifth
of them is kept from the fit and calibrates the score (Platt scaling).  Scoring runs over whole texts in Arrow batches.

Null and empty texts have no words, so the base rule rejects them.  Without labels of both kinds the regression keeps
everything.  Labels that are null or contradict each other (a doc_id with both) are left out of the fit, as are those of
null doc_ids.  Every row is judged by itself: repeated rows and repeated or null doc_ids each get a row; a probability
equal to the threshold keeps; an empty table gives no rows; extra columns are not read by ``scored`` and pass through
``good_documents``, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import shared, textscan

BITS, SAMPLE_ROWS, SAMPLE_CHARS = 18, 3000, 5000
MIN_WORDS, MAX_REPEAT_PERCENT, KEEP_AT = 20, 30, 0.5
REPEAT_WINDOW, CHAR_GRAM = 8, 4
_SYMBOLS = np.isin(np.arange(256), [ord(c) for c in "#*$%&|<>"])
_SLOT = np.uint64(64 - BITS)
_SCHEMA = "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, quality_prob double, kept boolean"


def _sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sums of values between neighbouring offsets."""
    total = np.concatenate([[0], np.cumsum(values, dtype=np.float64 if values.dtype.kind == "f" else np.int64)])
    return total[offsets[1:]] - total[offsets[:-1]]


def _slots(raw: np.ndarray, offsets: np.ndarray, starts: np.ndarray, ends: np.ndarray, counts: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """For words, pairs and character grams: the weight that each has, and the offsets of the texts among them."""
    firsts = np.concatenate([[0], np.cumsum(counts)])
    text = np.repeat(np.arange(len(counts)), counts)
    words = textscan.word_hashes(textscan.LOWER[raw], starts, ends)
    pairs = textscan.gram_hashes(words, 2)
    ok = np.flatnonzero(text[1:] == text[:-1]) if len(text) else np.zeros(0, np.int64)
    lead = np.flatnonzero((raw & 0xC0) != 0x80)  # first bytes of characters
    chars = np.frombuffer(raw.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32).astype(np.uint64)
    at = np.searchsorted(lead, offsets)
    grams = textscan.gram_hashes(chars + np.uint64(1), CHAR_GRAM)
    inside = np.repeat(np.arange(len(counts)), np.diff(at))
    good = np.flatnonzero(inside[: len(grams)] == inside[CHAR_GRAM - 1 :]) if len(grams) else np.zeros(0, np.int64)
    return [
        ((textscan.mix(words) >> _SLOT).astype(np.int64), firsts),
        ((textscan.mix(pairs[ok] + np.uint64(0x51)) >> _SLOT).astype(np.int64), np.searchsorted(ok, firsts)),
        ((textscan.mix(grams[good] + np.uint64(0xA7)) >> _SLOT).astype(np.int64), np.searchsorted(good, at)),
    ]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


def fit(texts: list[str], labels: list[int], rounds: int = 120, l2: float = 1e-5) -> dict | None:
    """Weights, bias and calibration; None unless both labels occur."""
    y = np.array(labels, np.float64)
    if len(set(labels)) < 2:
        return None
    cols, rows, vals, at = [], [], [], 0
    for part in shared.pieces(pa.RecordBatch.from_pydict({"text": pa.array(texts, pa.string())})):
        raw, offsets = shared.utf8(part.column("text"))
        for slots, ends in _slots(raw, offsets, *textscan.spans(raw, offsets, textscan.NONSPACE)):
            size = np.diff(ends)
            key = np.repeat(np.arange(part.num_rows), size) << BITS | slots
            key, n = np.unique(key, return_counts=True)
            r = key >> BITS
            cols.append((key & ((1 << BITS) - 1)).astype(np.int32)), rows.append((r + at).astype(np.int32)), vals.append((n / size[r]).astype(np.float32))
        at += part.num_rows
    cols, rows, vals = map(np.concatenate, (cols, rows, vals))
    held = np.arange(len(texts)) % 5 == 4
    weight = np.where(held, 0, np.where(y > 0, 0.5 / max(1, (y[~held] > 0).sum()), 0.5 / max(1, (y[~held] <= 0).sum())))
    w, b = np.zeros(1 << BITS), 0.0
    m, v, mb, vb = np.zeros_like(w), np.zeros_like(w), 0.0, 0.0
    score = lambda: np.bincount(rows, vals * w[cols], len(texts)) + b
    for t in range(1, rounds + 1):
        g = (_sigmoid(score()) - y) * weight
        gw, gb = np.bincount(cols, vals * g[rows], 1 << BITS) + l2 * w, g.sum()
        m, v, mb, vb = 0.9 * m + 0.1 * gw, 0.99 * v + 0.01 * gw**2, 0.9 * mb + 0.1 * gb, 0.99 * vb + 0.01 * gb**2
        w -= 0.3 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-8)
        b -= 0.05 * (mb / (1 - 0.9**t)) / (np.sqrt(vb / (1 - 0.99**t)) + 1e-8)
    s = score()
    used = held if len(set(y[held])) == 2 else np.ones(len(y), bool)
    a, c = _platt(s[used], y[used])
    return {"w": w.astype(np.float32), "b": float(b), "a": a, "c": c}


def _platt(s: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """The slope and shift that make the score a probability: Newton steps on smoothed targets."""
    pos, neg = (y > 0).sum(), (y <= 0).sum()
    target = np.where(y > 0, (pos + 1) / (pos + 2), 1 / (neg + 2))
    a, c = 1.0, 0.0
    for _ in range(50):
        p = _sigmoid(a * s + c)
        g = np.array([((p - target) * s).sum(), (p - target).sum()])
        q = p * (1 - p) + 1e-9
        h = np.array([[(q * s * s).sum() + 1e-6, (q * s).sum()], [(q * s).sum(), q.sum() + 1e-6]])
        step = np.linalg.solve(h, g)
        step *= min(1, 5 / max(1e-12, np.abs(step).max()))
        a, c = a - step[0], c - step[1]
    return (float(a), float(c)) if a > 0 else (1.0, 0.0)


def measures(column: pa.Array, model: dict | None) -> dict[str, np.ndarray]:
    """The base measures and the calibrated probability of each text."""
    raw, offsets = shared.utf8(column)
    starts, ends, counts = textscan.spans(raw, offsets, textscan.NONSPACE)
    n = len(counts)
    firsts = np.concatenate([[0], np.cumsum(counts)])
    text = np.repeat(np.arange(n), counts)
    chars = _sums(((raw & 0xC0) != 0x80) & textscan.NONSPACE[raw], offsets)
    symbols = _sums(_SYMBOLS[raw], offsets)
    whole = raw.tobytes()
    lines = np.zeros(n, np.int64)
    for i in range(n):
        own = [x for x in whole[offsets[i] : offsets[i + 1]].split(b"\n") if x.strip(b" \t\x0b\x0c\r")]
        lines[i] = len(own) - len(set(own))
    repeated = np.zeros(n, np.int64)
    grams = textscan.gram_hashes(textscan.word_hashes(raw, starts, ends), REPEAT_WINDOW)
    if len(grams):
        ok = np.flatnonzero(text[: len(grams)] == text[REPEAT_WINDOW - 1 :])
        key = textscan.mix(grams[ok] ^ textscan.mix(text[ok].astype(np.uint64) + np.uint64(1)))
        order = np.argsort(key)
        same = key[order][1:] == key[order][:-1]
        twice = np.zeros(len(ok), bool)
        twice[order[1:][same]] = True
        twice[order[:-1][same]] = True
        repeated = _sums(textscan.covered(len(text), ok[twice], np.full(int(twice.sum()), REPEAT_WINDOW)), firsts)
    prob = np.ones(n)
    if model:
        score = np.full(n, model["b"])
        for slots, at in _slots(raw, offsets, starts, ends, counts):
            score += _sums(model["w"][slots].astype(np.float64), at) / np.maximum(1, np.diff(at))
        prob = _sigmoid(model["a"] * score + model["c"])
    failed = (counts < MIN_WORDS) | (100 * repeated > MAX_REPEAT_PERCENT * counts)
    return {"n_words": counts, "word_chars": chars, "n_symbols": symbols, "n_dup_lines": lines, "n_repeat_words": repeated, "base_failed": failed, "quality_prob": prob, "kept": ~failed & (prob >= KEEP_AT)}


def labelled_sample(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS, chars: int = SAMPLE_CHARS) -> tuple[list[str], list[int]]:
    """At most ``rows`` labelled texts that are not empty, first by a hash of doc_id; at most ``chars`` characters of each."""
    known = labels.where("quality IN (0, 1)").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min("quality").alias("quality"), F.max("quality").alias("other")).where("quality = other")
    chosen = known.select("doc_id", "quality").orderBy(F.xxhash64("doc_id"), "doc_id").limit(2 * rows)
    texts = shared.id_and_text(docs).where("text <> ''")
    found = texts.join(F.broadcast(chosen), "doc_id")  # 2 * rows bounds the broadcast
    got = found.orderBy(F.xxhash64("doc_id"), "doc_id", "text").limit(rows).select(shared.spread_pieces(F.col("text"), chars), "quality").collect()
    return [r[0] for r in got], [int(r[1]) for r in got]


def scored(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """doc_id, the base measures, base_failed, quality_prob and kept, a row per document."""
    held = docs.sparkSession.sparkContext.broadcast(fit(*labelled_sample(docs, labels, sample_rows)))

    def run(batches):
        model = held.value
        for batch in batches:
            for part in shared.pieces(batch):
                yield pa.RecordBatch.from_pydict({"doc_id": part.column("doc_id").cast(pa.int64()), **{k: pa.array(v) for k, v in measures(part.column("text"), model).items()}})

    return shared.id_and_text(docs).mapInArrow(run, _SCHEMA)


def good_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that base rules and regression keep, scored in place: no shuffle, all columns stay."""
    shared.small_batches(docs.sparkSession)
    held = docs.sparkSession.sparkContext.broadcast(fit(*labelled_sample(docs, labels)))

    def run(batches):
        model = held.value
        for batch in batches:
            for part in shared.pieces(batch):
                yield part.filter(pa.array(measures(part.column("text"), model)["kept"]))

    return docs.mapInArrow(run, docs.schema)
