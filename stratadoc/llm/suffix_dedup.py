"""Repeated passages by a sparse suffix array.

Words are lower-cased runs of letters and digits.  A window of ``WINDOW`` words that occurs in two or more documents is
repeated; a document's spans are the unions of its repeated windows (word positions, end exclusive).  Words are compared
by 32-bit hashes, copies by a digest of all their words.

Suffixes are kept only at minimisers: the places whose 25-word gram has the least hash of some 26 neighbouring grams,
so every window holds one, at a place that its content alone determines.  Grams that one text alone has are dropped, and
of a text's suffixes with the same words around one stands for all their places.  The others go to sorted order with the
words before them; neighbours in the order of the words that follow, and in the order of the words before (read
backwards), are compared, which gives their common lengths.  A match is extended right and left by these: two suffixes
share a window that starts o words before if they share at least WINDOW - o words from there on and o words before.  That
is exact for all pairs at once, without forming pairs.

Copies (same words) are one text; copies of WINDOW words or more are repeated as a whole.  A gram that more than ``BLOCK``
suffixes share is dealt by document and place over blocks of about that size, whose windows then meet by their hashes.

Null and empty texts, and texts of fewer words than a window, have no spans; a text may have any length; an empty table
gives no rows; rows that repeat a doc_id are one document and do not repeat each other, rows of a null doc_id are a
document each; extra columns are not read, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import shared, textscan

WINDOW, GRAM = 50, 25
PER = WINDOW - GRAM + 1  # neighbouring grams of which the least is kept: those of a window
LEFT = WINDOW - GRAM  # words before a suffix that a window may hold
BLOCK = 4096


def anchors(words: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places and hashes of the minimisers of a text (32-bit words), and a hash of all words that their windows may hold."""
    padded = textscan.mix(np.concatenate([np.zeros(LEFT, np.uint32), words, np.zeros(WINDOW, np.uint32)]).astype(np.uint64) + np.uint64(1))
    every = textscan.gram_hashes(padded, GRAM)
    grams = every[LEFT : LEFT + max(0, len(words) - GRAM + 1)]
    least = textscan.window_minima(grams, PER)
    if not len(least):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    # a gram is kept if it equals the least of a window that holds it
    around = np.concatenate([np.zeros(PER - 1, np.uint64), least, np.zeros(PER - 1, np.uint64)])
    at = np.flatnonzero(_most(around) == grams)
    known = np.minimum(WINDOW, len(words) - at) * (LEFT + 1) + np.minimum(LEFT, at)
    context = textscan.mix(known.astype(np.uint64))
    for step in range(-LEFT, WINDOW - LEFT + 1, GRAM):
        context = textscan.mix(context ^ every[at + LEFT + step])
    return at, grams[at], context


def _most(values: np.ndarray) -> np.ndarray:
    """The maximum of each PER neighbours."""
    return ~textscan.window_minima(~values, PER)


_ANCHORED = "row long, doc long, doc_id long, digest binary, n_words long, words binary, grams array<struct<gram:long,n:int>>"


def _anchored(batches):
    item = pa.struct([("gram", pa.int64()), ("n", pa.int32())])
    for batch in batches:
        for part in shared.pieces(batch):
            hashes, digests = textscan.words_of(*shared.utf8(part.column("text")))
            names, counts, ends, kept = [np.zeros(0, np.int64)], [np.zeros(0, np.int32)], [0], []
            for h in hashes:
                words = (h >> np.uint64(32)).astype("<u4")
                kept.append(words.tobytes() if len(words) >= WINDOW else None)
                _, grams, context = anchors(words)
                gram, n = np.unique(grams[np.unique(context, return_index=True)[1]], return_counts=True)  # a context has one gram
                names.append(gram.view(np.int64)), counts.append(n.astype(np.int32)), ends.append(ends[-1] + len(gram))
            pairs = pa.StructArray.from_arrays([pa.array(np.concatenate(names)), pa.array(np.concatenate(counts))], fields=list(item))
            yield pa.RecordBatch.from_arrays(
                [part.column("row"), part.column("doc"), part.column("doc_id"), pa.array([d if k is not None else None for d, k in zip(digests, kept, strict=True)], pa.binary()), pa.array([len(h) for h in hashes], pa.int64()), pa.array(kept, pa.binary()), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pairs)],
                ["row", "doc", "doc_id", "digest", "n_words", "words", "grams"],
            )


_SUFFIXES = "gram long, block int, dealt boolean, row long, doc long, places array<int>, after binary, before binary, n_after int, n_before int"


def _suffixes(batches):
    """The suffixes of each text at the wanted grams, with WINDOW words from there on and LEFT words before, backwards."""
    for batch in batches:
        for i in range(batch.num_rows):
            row, doc = batch.column("row")[i].as_py(), batch.column("doc")[i].as_py()
            wanted = batch.column("wanted")[i].values
            words = np.frombuffer(batch.column("words")[i].as_py(), "<u4")
            at, grams, context = anchors(words)
            names, counts = wanted.field("gram").to_numpy(), wanted.field("n").to_numpy()
            order = np.argsort(names)
            found = order[np.minimum(np.searchsorted(names, grams.view(np.int64), sorter=order), len(names) - 1)]
            ok = names[found] == grams.view(np.int64)
            at, grams, context, count = at[ok], grams[ok], context[ok], counts[found[ok]]
            # one suffix of each content, with all its places
            order = np.argsort(context, kind="stable")
            new = np.ones(len(order), bool)
            new[1:] = context[order][1:] != context[order][:-1]
            heads = np.flatnonzero(new)
            ends = np.append(heads, len(order))[1:]
            first = order[heads]
            place = textscan.mix(np.full(len(first), row, np.int64).view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) ^ at[first].astype(np.uint64))
            block = (place >> np.uint64(1)).astype(np.int64) % -(-count[first] // BLOCK)
            padded = np.concatenate([np.zeros(LEFT, np.uint32), words, np.zeros(WINDOW, np.uint32)])
            for lo in range(0, len(first), 4096):
                f = first[lo : lo + 4096]
                p = at[f]
                after = padded[p[:, None] + LEFT + np.arange(WINDOW)]
                before = padded[p[:, None] + LEFT - 1 - np.arange(LEFT)]
                h, e = heads[lo : lo + 4096], ends[lo : lo + 4096]
                places = pa.ListArray.from_arrays(pa.array(np.append(h, e[-1]) - h[0], pa.int32()), pa.array(at[order[h[0] : e[-1]]].astype(np.int32)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(grams[f].view(np.int64)), pa.array(block[lo : lo + 4096].astype(np.int32)), pa.array(count[f] > BLOCK), pa.array(np.full(len(f), row)), pa.array(np.full(len(f), doc)), places, _rows(after), _rows(before), pa.array(np.minimum(WINDOW, len(words) - p).astype(np.int32)), pa.array(np.minimum(LEFT, p).astype(np.int32))],
                    ["gram", "block", "dealt", "row", "doc", "places", "after", "before", "n_after", "n_before"],
                )


def _rows(words: np.ndarray) -> pa.Array:
    width = words.shape[1] * 4
    return pa.Array.from_buffers(pa.binary(), len(words), [None, pa.py_buffer(np.arange(0, len(words) * width + 1, width, np.int32)), pa.py_buffer(np.ascontiguousarray(words))])


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint32).reshape(-1, width)


def _classes(group: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The sorted order of rows by group and words, and how many words each has in common with the one before (-1: another group)."""
    order = np.lexsort([*words.T[::-1], group])
    same = words[order][1:] == words[order][:-1]
    common = np.where(same.all(axis=1), words.shape[1], (~same).argmax(axis=1))
    common[group[order][1:] != group[order][:-1]] = -1
    return order, np.concatenate([[-1], common])


def shared_windows(group: np.ndarray, doc: np.ndarray, after: np.ndarray, before: np.ndarray, n_after: np.ndarray, n_before: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each suffix and each o: whether its text has a window from o words before on; whether another document shares it."""
    n = len(group)
    has, found = np.zeros((n, LEFT + 1), bool), np.zeros((n, LEFT + 1), bool)
    right, common_right = _classes(group, after)
    left, common_left = _classes(group, before)
    r, s = np.empty(n, np.int64), np.empty(n, np.int64)
    for o in range(LEFT + 1):
        has[:, o] = (n_before >= o) & (n_after >= WINDOW - o)
        rows = np.flatnonzero(has[:, o])
        if len(rows) < 2:
            continue
        r[right] = np.cumsum(common_right < WINDOW - o)
        s[left] = np.cumsum(common_left < o)
        key = r[rows] * (n + 1) + s[rows]
        order = np.lexsort((doc[rows], key))
        key, docs = key[order], doc[rows][order]
        first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        last = np.append(first[1:], len(key)) - 1
        two = np.repeat(docs[first] != docs[last], last - first + 1)
        found[rows[order[two]], o] = True
    return has, found


_FOUND = "row long, doc long, starts array<int>, size int, window long"


def _matched(batches):
    """Repeated spans of suffixes that come sorted by (gram, block); for dealt grams also windows that a block alone cannot decide."""
    held: list[pa.RecordBatch] = []

    def told(table: pa.Table, rows: np.ndarray, shift: np.ndarray, size: np.ndarray, window: pa.Array):
        taken = table.take(pa.array(rows))
        places = taken.column("places").combine_chunks()
        values = places.flatten().to_numpy()
        counts = np.diff(places.offsets.to_numpy())
        starts = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32()), pa.array((values - np.repeat(shift, counts)).astype(np.int32)))
        return pa.RecordBatch.from_arrays([taken.column("row").combine_chunks(), taken.column("doc").combine_chunks(), starts, pa.array(size.astype(np.int32)), window], ["row", "doc", "starts", "size", "window"])

    def settle(table: pa.Table):
        col = lambda c: table.column(c).to_numpy()
        gram, block, doc, dealt = col("gram"), col("block"), col("doc"), col("dealt")
        group = np.concatenate([[0], np.cumsum((gram[1:] != gram[:-1]) | (block[1:] != block[:-1]))])
        after, before = _matrix(table.column("after"), WINDOW), _matrix(table.column("before"), LEFT)
        has, found = shared_windows(group, doc, after, before, col("n_after"), col("n_before"))
        some = np.flatnonzero(found.any(axis=1))
        furthest, nearest = LEFT - found[some, ::-1].argmax(axis=1), found[some].argmax(axis=1)
        if len(some):
            yield told(table, some, furthest, furthest - nearest + WINDOW, pa.nulls(len(some), pa.int64()))
        rows = np.flatnonzero(dealt)
        if len(rows):
            with np.errstate(over="ignore"):
                ahead = [textscan.mix(after[rows, 0].astype(np.uint64))]
                for j in range(1, WINDOW):
                    ahead.append(textscan.mix(ahead[-1] * np.uint64(31) + after[rows, j]))
                back = np.zeros(len(rows), np.uint64)
                for o in range(LEFT + 1):
                    if o:
                        back = textscan.mix(back * np.uint64(37) + before[rows, o - 1] + np.uint64(1))
                    key = textscan.mix(ahead[WINDOW - o - 1] ^ (back * np.uint64(0x9E3779B97F4A7C15)) ^ textscan.mix(gram[rows].view(np.uint64) + np.uint64(o)))
                    # of windows that are known to be repeated one in the block speaks for all
                    known = np.flatnonzero(found[rows, o])
                    tell = np.concatenate([np.flatnonzero(has[rows, o] & ~found[rows, o]), known[np.unique(key[known], return_index=True)[1]]])
                    if len(tell):
                        yield told(table, rows[tell], np.full(len(tell), o), np.full(len(tell), WINDOW), pa.array(key[tell].view(np.int64)))

    n = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        n += batch.num_rows
        if n >= 8192:
            table = pa.Table.from_batches(held).combine_chunks()
            gram, block = table.column("gram").to_numpy(), table.column("block").to_numpy()
            before = np.flatnonzero((gram != gram[-1]) | (block != block[-1]))
            cut = int(before[-1]) + 1 if len(before) else 0
            if cut:
                yield from settle(table.slice(0, cut).combine_chunks())
            held = table.slice(cut).combine_chunks().to_batches()
            n = table.num_rows - cut
    if n:
        yield from settle(pa.Table.from_batches(held).combine_chunks())


def _merge(batches):
    """Neighbouring and overlapping spans of each row as one."""
    for batch in batches:
        out = []
        for spans in batch.column("spans").to_pylist():
            ends: list[list[int]] = []
            for s, e in sorted((x["start"], x["end"]) for x in spans):
                if ends and s <= ends[-1][1]:
                    ends[-1][1] = max(ends[-1][1], e)
                else:
                    ends.append([s, e])
            out.append([{"start": s, "end": e} for s, e in ends])
        yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array(out, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))], ["node", "spans"])


_SPANS = "array<struct<start:long,end:long>>"


def repeated_passages(docs: DataFrame) -> DataFrame:
    """doc_id, n_words and spans (start, end; words) that other documents repeat, a row per document row."""
    doc = F.when(F.col("doc_id").isNull(), F.xxhash64(F.lit("row"), "row")).otherwise(F.xxhash64("doc_id"))
    found = shared.written(shared.numbered(shared.id_and_text(docs)).withColumn("doc", doc).mapInArrow(_anchored, _ANCHORED), "anchors")
    long = found.where("digest IS NOT NULL").select("row", "doc", "digest")
    copies = shared.salted_join(long, "digest", "row", min_row=F.min("row"), min_doc=F.min("doc"), max_doc=F.max("doc"))
    of = shared.written(copies.select("row", F.col("min_row").alias("node"), (F.col("min_doc") < F.col("max_doc")).alias("copied")), "passage-nodes")
    grams = found.select("row", "grams").join(of.where("row = node").select("row"), "row", "left_semi").select("row", F.explode("grams").alias("g")).select("row", "g.gram", "g.n")
    often = shared.salted_join(grams, "gram", "row", "min_row < max_row", min_row=F.min("row"), max_row=F.max("row"), sum_n=F.sum("n"))
    wanted = often.groupBy("row").agg(F.collect_list(F.struct("gram", F.col("sum_n").alias("n"))).alias("wanted"))
    suffixes = found.select("row", "doc", "words").join(wanted, "row").mapInArrow(_suffixes, _SUFFIXES)
    spans = shared.written(suffixes.repartition("gram", "block").sortWithinPartitions("gram", "block").mapInArrow(_matched, _FOUND), "spans")
    open_ = spans.where("window IS NOT NULL")
    decided = open_.groupBy("window").agg(F.min("doc").alias("a"), F.max("doc").alias("b")).where("a < b").select("window")
    sure = spans.where("window IS NULL").select("row", "starts", "size").union(open_.join(decided, "window", "left_semi").select("row", "starts", "size"))
    start = F.col("start").cast("long")
    ranges = sure.select("row", "size", F.explode("starts").alias("start")).select(F.col("row").alias("node"), F.struct(start.alias("start"), (start + F.col("size")).alias("end")).alias("span"))
    merged = ranges.groupBy("node").agg(F.collect_set("span").alias("spans")).mapInArrow(_merge, f"node long, spans {_SPANS}")
    own = of.where("NOT copied").join(merged, "node").select("row", "spans")
    out = found.select("row", "doc_id", "n_words").join(of.where("copied").select("row", "copied").unionByName(own.select("row", F.lit(False).alias("copied"), "spans"), allowMissingColumns=True), "row", "left")
    whole = F.array(F.struct(F.lit(0).cast("long").alias("start"), F.col("n_words").alias("end")))
    out = shared.written(out.select("doc_id", "n_words", F.when(F.coalesce("copied", F.lit(False)), whole).otherwise(F.coalesce("spans", F.array().cast(_SPANS))).alias("spans")), "passages")
    shared.discard(found, of, spans)
    return out
