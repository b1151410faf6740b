"""Benchmark decontamination by winnowing.

Words are the maximal runs of ASCII digits, letters (A-Z lower-cased) and all non-ASCII characters.  Of every six
neighbouring 5-word grams the least hash is kept, in documents and benchmark items alike, so a shared span of ten words
always shares a fingerprint.  Fingerprints are joined; each hit is extended left and right on the words themselves, and
counts if ten words or more agree, compared byte by byte.  An item of fewer than ten words is one window of all its
words, found by the hash of as many words, then compared in the same way.

The benchmark side is broadcast only while what is held of it (arrays of words and fingerprints) is within
``broadcast_bytes``, which is measured first; beyond that fingerprints and windows are joined by Spark.  Both ways give
the same rows.

Null and empty texts and texts without a word give n_words 0 and no hits; null items and items without a word never
hit; an item of null id hits words but is not named.  A text may have any length.  Rows are handled one by one: repeated
and null doc_ids each get a row, and are kept or dropped by their own text; an empty benchmark hits nothing, an empty
table gives no rows; extra columns are not read by ``contamination`` and pass through ``decontaminated``, whatever their
names.
"""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import shared, textscan

WINDOW, GRAM = 10, 5
_PER = WINDOW - GRAM + 1
_FAR = np.uint64(0xFFFFFFFFFFFFFFFF)
#: Bytes of items, as held, that may be broadcast.
BROADCAST_BYTES = 64 << 20
_HITS = "hit_ranges array<struct<start:long,end:long>>, item_ids array<string>"
_RANGES = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def _scan(column: pa.Array) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased bytes, word starts and ends in them, first word of each text (and the end), word hashes."""
    raw, offsets = shared.utf8(column)
    low = textscan.LOWER[raw]
    starts, ends, counts = textscan.spans(low, offsets, textscan.ALNUM)
    return low.tobytes(), starts, ends, np.concatenate([[0], np.cumsum(counts)]), textscan.word_hashes(low, starts, ends)


def _winnowed(words: np.ndarray, firsts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of the 5-word grams that are the least of some six neighbours within a text."""
    grams = textscan.gram_hashes(words, GRAM)
    text = np.repeat(np.arange(len(firsts) - 1), np.diff(firsts))
    if len(grams):
        grams[text[: len(grams)] != text[GRAM - 1 :]] = _FAR
    least = textscan.window_minima(grams, _PER)
    kept = np.zeros(len(grams), bool)
    for j in range(_PER):
        kept[j : j + len(least)] |= grams[j : j + len(least)] == least
    kept &= grams != _FAR
    at = np.flatnonzero(kept)
    return at, grams[at]


class Items:
    """Benchmark items as arrays: their words and, by fingerprint, where they hit."""

    def __init__(self, ids: list, texts: list):
        low, starts, ends, self.firsts, hashes = _scan(pa.array(texts, pa.string()))
        self.ids, self.low, self.starts, self.ends = [None if i is None else str(i) for i in ids], low, starts, ends
        lengths = np.diff(self.firsts)
        at, grams = _winnowed(hashes, self.firsts)
        owner = np.searchsorted(self.firsts, at, side="right") - 1
        kept = np.flatnonzero(lengths[owner] >= WINDOW)
        kept = kept[np.argsort(grams[kept], kind="stable")]
        self.seeds, self.places, self.owners = grams[kept], at[kept], owner[kept]
        few = np.flatnonzero((lengths > 0) & (lengths < WINDOW))
        self.short = {}
        for size in np.unique(lengths[few]).tolist():
            own = few[lengths[few] == size]
            grams = textscan.gram_hashes(hashes, size)[self.firsts[own]]
            order = np.argsort(grams, kind="stable")
            self.short[size] = grams[order], own[order]

    def held(self) -> int:
        """Bytes that the arrays take."""
        arrays = [self.firsts, self.starts, self.ends, self.seeds, self.places, self.owners, *(x for pair in self.short.values() for x in pair)]
        return len(self.low) + 64 * len(self.ids) + sum(x.nbytes for x in arrays)

    def word(self, i: int) -> bytes:
        return self.low[self.starts[i] : self.ends[i]]

    def with_seed(self, gram: int) -> list[tuple[int, int]]:
        """Item and place of its word of every fingerprint of this hash."""
        lo, hi = np.searchsorted(self.seeds, [gram, gram], side="left")[0], np.searchsorted(self.seeds, gram, side="right")
        return list(zip(self.owners[lo:hi].tolist(), self.places[lo:hi].tolist(), strict=True))

    def of_few_words(self, size: int, gram: int) -> list[int]:
        grams, own = self.short[size]
        return own[np.searchsorted(grams, gram, side="left") : np.searchsorted(grams, gram, side="right")].tolist()


class _Probe:
    """Which of many hashes are among a few: by a bitmap of their low bits, then by search."""

    def __init__(self, keys: np.ndarray):
        self.keys = np.unique(keys)
        self.bits = max(16, min(24, int(len(self.keys)).bit_length() + 6))
        self.mask = np.uint64((1 << self.bits) - 1)
        self.table = np.zeros(1 << self.bits, bool)
        self.table[(self.keys & self.mask).astype(np.int64)] = True

    def __call__(self, hashes: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return np.zeros(0, np.int64)
        at = np.flatnonzero(self.table[(hashes & self.mask).astype(np.int64)])
        found = np.minimum(np.searchsorted(self.keys, hashes[at]), len(self.keys) - 1)
        return at[self.keys[found] == hashes[at]]


def _merged(ranges: list[tuple[int, int]]) -> list[dict]:
    out: list[list[int]] = []
    for s, e in sorted(ranges):
        if out and s <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([s, e])
    return [{"start": s, "end": e} for s, e in out]


class Finder:
    """Finds items in texts."""

    def __init__(self, items: Items):
        self.items, self.probe, self.short = items, _Probe(items.seeds), {n: _Probe(x[0]) for n, x in items.short.items()}

    def __call__(self, column: pa.Array) -> tuple[list, list, list]:
        """For each text: number of words, hit word ranges, ids of the items that occur."""
        items = self.items
        low, starts, ends, firsts, hashes = _scan(column)
        n = len(firsts) - 1
        ranges: dict[int, list] = defaultdict(list)
        found: dict[int, set] = defaultdict(set)
        word = lambda i: low[starts[i] : ends[i]]
        done: dict[tuple[int, int, int], int] = {}  # text, item, diagonal: words are settled up to here
        at, grams = _winnowed(hashes, firsts)
        hit = self.probe(grams)
        for p, g in zip(at[hit].tolist(), grams[hit], strict=True):
            t = int(np.searchsorted(firsts, p, side="right")) - 1
            lo, hi = int(firsts[t]), int(firsts[t + 1])
            for o, q in items.with_seed(g):
                if done.get((t, o, p - q), -1) > p:
                    continue
                first, end = int(items.firsts[o]), int(items.firsts[o + 1])
                right = 0
                while p + right < hi and q + right < end and word(p + right) == items.word(q + right):
                    right += 1
                done[t, o, p - q] = p + max(right, 1)
                left = 0
                while right and p - left > lo and q - left > first and word(p - left - 1) == items.word(q - left - 1):
                    left += 1
                if left + right >= WINDOW:
                    ranges[t].append((p - left - lo, p + right - lo))
                    found[t].add(items.ids[o])
        text = np.repeat(np.arange(n), np.diff(firsts))
        for size, those in self.short.items():
            grams = textscan.gram_hashes(hashes, size)
            for p in those(grams).tolist():
                t = int(text[p])
                if text[p + size - 1] != t:
                    continue
                for o in items.of_few_words(size, grams[p]):
                    first = int(items.firsts[o])
                    if all(word(p + j) == items.word(first + j) for j in range(size)):
                        ranges[t].append((p - int(firsts[t]), p + size - int(firsts[t])))
                        found[t].add(items.ids[o])
        return np.diff(firsts).tolist(), [_merged(ranges.get(t, [])) for t in range(n)], [sorted(i for i in found.get(t, ()) if i is not None) for t in range(n)]


def _fingerprints(sizes: list[int]):
    """Of each text the number of words, and the distinct hashes of its winnowed grams and of all its grams of the sizes."""

    def run(batches):
        for batch in batches:
            for part in shared.pieces(batch):
                _, _, _, firsts, hashes = _scan(part.column("text"))
                at, grams = _winnowed(hashes, firsts)
                cut = np.searchsorted(at, firsts)
                text = np.repeat(np.arange(len(firsts) - 1), np.diff(firsts))
                more = []
                for size in sizes:
                    g = textscan.gram_hashes(hashes, size)
                    ok = np.flatnonzero(text[: len(g)] == text[size - 1 :]) if len(g) else np.zeros(0, np.int64)
                    more.append((g[ok], np.searchsorted(ok, firsts)))
                found = [np.unique(np.concatenate([grams[cut[t] : cut[t + 1]], *(g[c[t] : c[t + 1]] for g, c in more)])).view(np.int64) for t in range(len(firsts) - 1)]
                yield pa.RecordBatch.from_pydict({"row": part.column("row"), "n_words": np.diff(firsts), "fingerprints": pa.array(found, pa.list_(pa.int64()))})

    return run


def _item_windows(batches):
    """Of each item its fingerprints, and its windows as words with spaces between."""
    for batch in batches:
        for part in shared.pieces(batch):
            for item, text in zip(part.column("item").to_pylist(), part.column("text").to_pylist(), strict=True):
                one = Items([item], [text])
                n = len(one.starts)
                size = min(WINDOW, n)
                if size:
                    words = [one.word(i) for i in range(n)]
                    seeds = one.seeds if n >= WINDOW else one.short[size][0]
                    yield pa.RecordBatch.from_arrays([pa.array([item], pa.string()), pa.array([size], pa.int32()), pa.array([np.unique(seeds).view(np.int64)], pa.list_(pa.int64())), pa.array([sorted({b" ".join(words[i : i + size]) for i in range(n - size + 1)})], pa.list_(pa.binary()))], ["item", "size", "fingerprints", "windows"])


def _hit_windows(sizes: list[int]):
    """Of each text the windows around its hit fingerprints: place, number of words, words with spaces between."""

    def run(batches):
        for batch in batches:
            for part in shared.pieces(batch):
                low, starts, ends, firsts, hashes = _scan(part.column("text"))
                at, grams = _winnowed(hashes, firsts)
                for t, (row, hits) in enumerate(zip(part.column("row").to_pylist(), part.column("hits").to_pylist(), strict=True)):
                    lo, hi = int(firsts[t]), int(firsts[t + 1])
                    wanted = np.array(hits, np.int64).view(np.uint64)
                    own = slice(*np.searchsorted(at, [lo, hi]))
                    near = at[own][np.isin(grams[own], wanted)]
                    spans = {(int(p) - back, WINDOW) for p in near for back in range(_PER) if p - back >= lo and p - back + WINDOW <= hi}
                    for size in sizes:
                        spans |= {(lo + int(p), size) for p in np.flatnonzero(np.isin(textscan.gram_hashes(hashes[lo:hi], size), wanted))}
                    if spans:
                        every = sorted(spans)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([row] * len(every), pa.int64()), pa.array([p - lo for p, _ in every], pa.int64()), pa.array([n for _, n in every], pa.int32()), pa.array([b" ".join(low[s:e] for s, e in zip(starts[p : p + n].tolist(), ends[p : p + n].tolist(), strict=True)) for p, n in every], pa.binary())],
                            ["row", "place", "size", "window"],
                        )

    return run


def _hits_by_join(rows: DataFrame, items: DataFrame) -> DataFrame:
    """row, n_words, hit_ranges and item_ids of rows (row, text): fingerprints meet in a join, which tells what windows of a
    text are worth comparing; these meet the items' windows, words against words.  Pairs of a text and an item are formed
    where one occurs in the other only."""
    own = shared.written(items.select(F.col("item_id").cast("string").alias("item"), "text").mapInArrow(_item_windows, "item string, size int, fingerprints array<long>, windows array<binary>"), "items")
    sizes = sorted(r["size"] for r in own.where(F.col("size") < WINDOW).select("size").distinct().collect())  # nine at most
    left = shared.written(rows.mapInArrow(_fingerprints(sizes), "row long, n_words long, fingerprints array<long>"), "fingerprints")
    seeds = own.select(F.explode("fingerprints").alias("f")).distinct()
    hits = shared.salted_lookup(left.select("row", F.explode("fingerprints").alias("f")), "f", "row", seeds, "inner").groupBy("row").agg(F.collect_set("f").alias("hits"))
    windows = rows.join(hits, "row").mapInArrow(_hit_windows(sizes), "row long, place long, size int, window binary")
    named = own.select("item", F.explode("windows").alias("window"))
    found = shared.written(shared.salted_lookup(windows, "window", "row", named.select("window").distinct(), "inner"), "windows")
    spans = found.groupBy("row").agg(F.collect_list(F.struct(F.col("place").alias("start"), (F.col("place") + F.col("size")).alias("end"))).alias("spans"))
    ids = shared.salted_lookup(found.select("row", "window").distinct(), "window", "row", named, "inner").groupBy("row").agg(F.array_sort(F.collect_set("item")).alias("ids"))

    def merge(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column("row"), batch.column("n_words"), pa.array([_merged([(r["start"], r["end"]) for r in x or []]) for x in batch.column("spans").to_pylist()], _RANGES), pa.array([x or [] for x in batch.column("ids").to_pylist()], pa.list_(pa.string()))], ["row", "n_words", "hit_ranges", "item_ids"])

    return left.select("row", "n_words").join(spans, "row", "left").join(ids, "row", "left").select("row", "n_words", "spans", "ids").mapInArrow(merge, f"row long, n_words long, {_HITS}")


def _finder(docs: DataFrame, benchmark: DataFrame, broadcast_bytes: int) -> tuple[Broadcast | None, DataFrame]:
    """The items as a broadcast, if what it holds is within the limit; and the items as rows."""
    items = benchmark.select("item_id", F.col("text").cast("string").alias("text")).where("text IS NOT NULL")
    if items.agg(F.coalesce(F.sum(F.octet_length("text") + 64), F.lit(0))).head()[0] <= broadcast_bytes:
        held = Items(*zip(*rows, strict=True)) if (rows := [tuple(r) for r in items.collect()]) else Items([], [])  # within broadcast_bytes
        if held.held() <= broadcast_bytes:
            return docs.sparkSession.sparkContext.broadcast(held), items
    return None, items


def contamination(docs: DataFrame, benchmark: DataFrame, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """doc_id, n_words, hit_ranges (merged word ranges of the document) and item_ids (of the items hit), a row per document."""
    docs = shared.id_and_text(docs)
    held, items = _finder(docs, benchmark, broadcast_bytes)
    if held is None:
        rows = shared.written(shared.numbered(docs), "documents")
        return rows.select("row", "doc_id").join(_hits_by_join(rows.select("row", "text"), items), "row").drop("row")

    def run(batches):
        find = Finder(held.value)
        for batch in batches:
            for part in shared.pieces(batch):
                n, ranges, ids = find(part.column("text"))
                yield pa.RecordBatch.from_arrays([part.column("doc_id").cast(pa.int64()), pa.array(n, pa.int64()), pa.array(ranges, _RANGES), pa.array(ids, pa.list_(pa.string()))], ["doc_id", "n_words", "hit_ranges", "item_ids"])

    return docs.mapInArrow(run, f"doc_id long, n_words long, {_HITS}")


def decontaminated(docs: DataFrame, benchmark: DataFrame, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """The rows without those in whose text a benchmark window occurs; all columns stay.  With few items no row is moved."""
    shared.small_batches(docs.sparkSession)
    held, items = _finder(docs, benchmark, broadcast_bytes)
    if held is None:
        row = shared.free_name(docs, "row")
        rows = shared.written(docs.withColumn(row, F.monotonically_increasing_id()), "documents")
        hits = _hits_by_join(rows.select(F.col(row).alias("row"), F.col("text").cast("string").alias("text")), items)
        return rows.join(hits.where(F.size("hit_ranges") > 0).select(F.col("row").alias(row)), row, "left_anti").select(*docs.columns)

    def run(batches):
        find = Finder(held.value)
        for batch in batches:
            for part in shared.pieces(batch):
                yield part.filter(pa.array([not r for r in find(part.column("text"))[1]], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
