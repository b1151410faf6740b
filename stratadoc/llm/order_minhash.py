"""Near-duplicate classes by Order MinHash.

Words are lower-cased runs of letters and digits; the k-mers are five words, labelled by occurrence (a text of one to
four words is one k-mer).  Each of ``SKETCHES`` sketches takes the ``ORDER`` labelled k-mers of least hash and keeps
them in text order, so a shared sketch tells of the same k-mers in the same order.

Candidates share a sketch.  They are linked if their longest common subsequence has 0.8 or more of the longer text's
words, an edit similarity (words are compared by 32-bit hashes).  Banded alignment accepts most links of texts of more than
``SHORT`` words: the longest chain of equal labelled k-mers in the order of both texts, within the band that the similarity
allows, gives runs of aligned words; between the runs words are compared along the diagonals on both sides.  What is aligned
is a common subsequence; where it is too short, and for short texts, the longest one is found by bits.  Pairs with too few
words in common, in whatever order, are left first.

Copies (same words) are one node.  A sketch's bucket is never expanded into pairs: all members are compared to its
least one, then those left to their least one.  A bucket whose members are then in one component is done.  In the others
each member outside the largest component meets all members, in blocks of ``BLOCK`` by ``BLOCK``.  If more than ``FEW``
blocks are outside (very many unlike texts around one passage), members meet by their rarest words instead: of n words all
but 0.8 n, and one more, so that two similar texts have one of them in common, whatever the order of rarity.  Neither way
loses a link, so a bucket's size decides about work alone.  Classes are the connected components of the links.

Every row is a document of its own, rows of null or repeated doc_ids too.  Texts without a word (null, empty) are classes
of their own.  class_id is the least doc_id of the class, null only if all of them are.  A text may have any length; an
empty table gives no rows; extra columns are not read by ``classes`` and pass through ``one_of_each``, whatever their names.
"""

from __future__ import annotations

from bisect import bisect_left
from functools import cached_property, reduce
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import shared, textscan
from .components import components

K, SKETCHES, ORDER, SIMILARITY, BLOCK, FEW = 5, 24, 2, 0.8, 400, 1
SHORT = 400  # words up to which the longest common subsequence is found sooner than an alignment
BINS, SLOT = 1 << 16, 1 << 10  # by which the rarity of words is counted, and so many in a row


def labelled(values: np.ndarray) -> np.ndarray:
    """Hashes of each value with the number of equal ones before it."""
    order = np.argsort(values, kind="stable")
    held = values[order]
    new = np.ones(len(held), bool)
    new[1:] = held[1:] != held[:-1]
    place = np.arange(len(held))
    out = np.empty_like(values)
    with np.errstate(over="ignore"):
        out[order] = textscan.mix(held + np.uint64(0x632BE59BD9B4E019) * (place - place[new][np.cumsum(new) - 1]).astype(np.uint64))
    return out


def labelled_kmers(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The k-mers of a text (32-bit words) in order, and the same labelled by their occurrence."""
    if not len(words):
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    grams = textscan.gram_hashes(textscan.mix(words.astype(np.uint64) + np.uint64(1)), min(K, len(words)))
    return grams, labelled(grams)


def sketches(words: np.ndarray) -> np.ndarray:
    """The distinct sketches of a text: each one hash of its least labelled k-mers, in text order."""
    grams, labels = labelled_kmers(words)
    if not len(grams):
        return np.zeros(0, np.int64)
    n = min(ORDER, len(grams))
    seeds = textscan.mix(np.arange(1, 1 + SKETCHES, dtype=np.uint64) * np.uint64(0x2545F4914F6CDD1D))
    out = np.empty(SKETCHES, np.uint64)
    rows = max(1, (1 << 17) // len(grams))  # a long text takes its sketches a few at a time
    with np.errstate(over="ignore"):
        for at in range(0, SKETCHES, rows):
            own = seeds[at : at + rows]
            values = labels[None, :] * (own | np.uint64(1))[:, None]  # labels are mixed, so a product orders them anew
            line, least = np.arange(len(own)), []
            for _ in range(n):
                least.append(values.argmin(axis=1))
                values[line, least[-1]] = ~np.uint64(0)
            acc = own.copy()
            for j in np.sort(np.stack(least), axis=0):
                acc = textscan.mix(acc * np.uint64(31) + grams[j])
            out[at : at + rows] = acc
    return np.unique(out).view(np.int64)


def needed(a: int, b: int) -> int:
    """The fewest aligned words that make texts of a and b words similar."""
    return ceil(SIMILARITY * max(a, b) - 1e-9)


class Text:
    """The words of a text, the same labelled by occurrence and sorted, and its labelled k-mers to be searched."""

    def __init__(self, words: bytes):
        self.words = np.frombuffer(words, "<u4")
        self.bag = np.sort(labelled(self.words.astype(np.uint64)))
        self.k = min(K, len(self.words))

    @cached_property
    def labels(self) -> np.ndarray:
        return labelled_kmers(self.words)[1]

    @cached_property
    def order(self) -> np.ndarray:
        return np.argsort(self.labels)

    @cached_property
    def sorted(self) -> np.ndarray:
        return self.labels[self.order]


def _chain(j: np.ndarray) -> np.ndarray:
    """Which values form the longest rising subsequence."""
    if (np.diff(j) > 0).all():
        return np.arange(len(j))
    tails: list[int] = []
    ends: list[int] = []
    back = np.empty(len(j), np.int64)
    for at, x in enumerate(j.tolist()):
        i = bisect_left(tails, x)
        tails[i : i + 1], ends[i : i + 1] = [x], [at]
        back[at] = ends[i - 1] if i else -1
    out, at = [], ends[-1]
    while at >= 0:
        out.append(at)
        at = int(back[at])
    return np.array(out[::-1])


def _between(a: np.ndarray, b: np.ndarray) -> int:
    """Equal words along the diagonals of both ends of a gap of unequal sides."""
    n = min(len(a), len(b))
    ahead = np.concatenate([[0], np.cumsum(a[:n] == b[:n])])
    back = np.concatenate([[0], np.cumsum(a[::-1][:n] == b[::-1][:n])])
    return int((ahead + back[::-1]).max())


def alignment(a: Text, b: Text) -> int:
    """The number of aligned words; 0 if the texts share no k-mer within the band."""
    n, m = len(a.words), len(b.words)
    if a.k != b.k or not a.k:
        return 0
    found = np.minimum(np.searchsorted(b.sorted, a.labels), len(b.sorted) - 1)
    i = np.flatnonzero(b.sorted[found] == a.labels)
    j = b.order[found[i]]
    near = np.abs(i - j) <= max(n, m) - needed(n, m)
    i, j = i[near], j[near]
    if not len(i):
        return 0
    on = _chain(j)
    i, j = i[on], j[on]
    # runs of k-mers on one diagonal without a gap
    new = np.flatnonzero(np.concatenate([[True], (np.diff(i) != np.diff(j)) | (np.diff(i) > a.k)]))
    last = np.append(new[1:], len(i)) - 1
    start_a, start_b, end_a, end_b = i[new], j[new], i[last] + a.k, j[last] + a.k
    cut = np.maximum(0, np.maximum(np.append(0, np.maximum.accumulate(end_a)[:-1]) - start_a, np.append(0, np.maximum.accumulate(end_b)[:-1]) - start_b))
    start_a, start_b = start_a + cut, start_b + cut
    kept = start_a < end_a
    start_a, start_b, end_a, end_b = start_a[kept], start_b[kept], end_a[kept], end_b[kept]
    total = int((end_a - start_a).sum())
    from_a, from_b = np.append(0, end_a), np.append(0, end_b)
    gap_a, gap_b = np.append(start_a, n) - from_a, np.append(start_b, m) - from_b
    even = np.flatnonzero((gap_a == gap_b) & (gap_a > 0))
    if len(even):
        size = gap_a[even]
        within = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
        total += int((a.words[np.repeat(from_a[even], size) + within] == b.words[np.repeat(from_b[even], size) + within]).sum())
    for g in np.flatnonzero((gap_a != gap_b) & (gap_a > 0) & (gap_b > 0)).tolist():
        total += _between(a.words[from_a[g] : from_a[g] + gap_a[g]], b.words[from_b[g] : from_b[g] + gap_b[g]])
    return total


def common_words(a: Text, b: Text) -> int:
    """How many words the texts have in common, in whatever order; no alignment has more."""
    return int((b.bag[np.minimum(np.searchsorted(b.bag, a.bag), len(b.bag) - 1)] == a.bag).sum())


def common_subsequence(a: np.ndarray, b: np.ndarray, least: int) -> bool:
    """Whether the longest common subsequence of two texts has ``least`` words or more; rows of its table are whole numbers."""
    n = min(len(a), len(b))
    head = int(np.append(a[:n] != b[:n], True).argmax())
    a, b = a[head:], b[head:]
    n -= head
    tail = int(np.append(a[::-1][:n] != b[::-1][:n], True).argmax())
    a, b = a[: len(a) - tail], b[: len(b) - tail]
    least -= head + tail
    if least <= 0 or min(len(a), len(b)) < least:
        return least <= 0
    left, right = a.tolist(), b.tolist()
    held = set(right)
    a = [x for x in left if x in held]  # other words are in no common subsequence
    held = set(a)
    b = [x for x in right if x in held]
    if min(len(a), len(b)) < least:
        return False
    places: dict[int, int] = {}
    for at, x in enumerate(b):
        places[x] = places.get(x, 0) | 1 << at
    full = v = (1 << len(b)) - 1
    for at, x in enumerate(a, 1):
        p = v & places[x]
        v = ((v + p) | (v - p)) & full
        if not at % 64 and len(b) - v.bit_count() + len(a) - at < least:
            return False
    return len(b) - v.bit_count() >= least


def _alike(a: Text, b: Text, least: int) -> bool:
    """Short texts' longest common subsequence takes no longer than their alignment, which is never longer."""
    short = max(len(a.words), len(b.words)) <= SHORT
    return not short and alignment(a, b) >= least or common_subsequence(a.words, b.words, least)


def similar(a: Text, b: Text) -> bool:
    least = needed(len(a.words), len(b.words))
    return min(len(a.words), len(b.words)) >= least and common_words(a, b) >= least and _alike(a, b, least)


_SKETCHED = "row long, doc_id long, digest binary, words binary, keys array<long>"


def _sketched(batches):
    for batch in batches:
        for part in shared.pieces(batch):
            hashes, digests = textscan.words_of(*shared.utf8(part.column("text")))
            words = [(h >> np.uint64(32)).astype("<u4") for h in hashes]
            yield pa.RecordBatch.from_arrays([part.column("row"), part.column("doc_id"), pa.array(digests, pa.binary()), pa.array([w.tobytes() for w in words], pa.binary()), pa.array([sketches(w) for w in words], pa.list_(pa.int64()))], ["row", "doc_id", "digest", "words", "keys"])


def _counted(batches):
    """How often the labelled words of each bin occur in all texts of a task, as rows of ``SLOT`` bins."""
    held = np.zeros(BINS, "<i8")
    for batch in batches:
        for words in batch.column("words").to_pylist():
            held += np.bincount((Text(words).bag % np.uint64(BINS)).astype(np.int64), minlength=BINS)
    if held.any():
        yield pa.RecordBatch.from_arrays([pa.array(range(BINS // SLOT), pa.int64()), pa.array([n.tobytes() for n in held.reshape(-1, SLOT)], pa.binary())], ["slot", "n"])


def _summed(table: pa.Table) -> pa.Table:
    """One row for the rows that the tasks have counted of a slot."""
    return pa.table({"slot": table.column("slot")[:1], "n": pa.array([sum(np.frombuffer(n, "<i8") for n in table.column("n").to_pylist()).tobytes()], pa.binary())})


def occurrences(texts: DataFrame) -> np.ndarray:
    """How often the labelled words of each bin occur in all texts (words)."""
    often = np.zeros((BINS // SLOT, SLOT), np.int64)
    for r in texts.select("words").mapInArrow(_counted, "slot long, n binary").groupBy("slot").applyInArrow(_summed, "slot long, n binary").collect():
        often[r["slot"]] = np.frombuffer(r["n"], "<i8")
    return often.ravel()


def rarest(words: bytes, often: np.ndarray) -> np.ndarray:
    """The rarest labelled words of a text, so many that it shares one of them with every text similar to it, without those
    that it shares with none: a bag has a labelled word once, so a bin of one occurrence is in one text alone."""
    bag = Text(words).bag
    n = often[(bag % np.uint64(BINS)).astype(np.int64)]
    first = np.lexsort((bag, n))[: len(bag) - needed(len(bag), 0) + 1]
    return bag[first[n[first] > 1]]


def _rarest(often: np.ndarray):
    def run(batches):
        for batch in batches:
            found = [rarest(words, often) for words in batch.column("words").to_pylist()]
            sizes = [len(f) for f in found]
            nodes, parts = (np.repeat(batch.column(c).to_numpy(), sizes) for c in ("node", "part"))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(found).view(np.int64) if found else nodes), pa.array(nodes), pa.array(parts)], ["key", "node", "part"])

    return run


def _verified(batches):
    """Pairs come sorted by ``a``, so its text is made ready once."""
    for batch in batches:
        for part in shared.pieces(batch, "words"):
            name, text, ok = None, None, []
            for a, words, other in zip(part.column("a").to_pylist(), part.column("words").to_pylist(), part.column("other").to_pylist(), strict=True):
                if a != name:
                    name, text = a, Text(words)
                ok.append(min(len(words), len(other)) // 4 >= needed(len(words) // 4, len(other) // 4) and similar(text, Text(other)))
            yield pa.RecordBatch.from_arrays([part.column("a").filter(pa.array(ok)), part.column("b").filter(pa.array(ok))], ["a", "b"])


def links_between(nodes: list[int], texts: list[Text], parts: list[int], left: list[bool], keys: list[list[int]] | None = None, key: int | None = None) -> list[tuple[int, int]]:
    """Links that connect what is similar: every node of the left is compared to every node that is not connected to it.

    ``parts`` names the component that each node is known to be in.  Nodes with ``keys`` are only compared if they share
    one, and if ``key`` is given, only if it is the least that they share, so that no pair is compared in two buckets.
    """
    sizes = np.array([len(t.words) for t in texts])
    first = np.flatnonzero(left)
    names, column = np.unique(np.concatenate([t.bag for t in texts]), return_inverse=True)
    row = np.repeat(np.arange(len(texts)), sizes)
    often = np.bincount(column, minlength=len(names)) > 1
    new = np.cumsum(often) - 1
    row, column = row[often[column]], new[column[often[column]]]
    common = np.zeros((len(first), len(texts)), np.float32)  # words that two texts have in common: no alignment has more
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    for at in range(0, int(often.sum()), 2048):
        lo, hi = np.searchsorted(column, (at, at + 2048))
        slab = np.zeros((len(texts), 2048), np.float32)
        slab[row[lo:hi], column[lo:hi] - at] = 1
        common += slab[first] @ slab.T
    lead: dict[int, int] = {}
    parent = [lead.setdefault(part, i) for i, part in enumerate(parts)]

    def top(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    def meet(i: int, j: int) -> bool:
        both = set(keys[i]).intersection(keys[j])
        return bool(both) and key in (None, min(both))

    out = []
    for at, i in enumerate(first.tolist()):
        least = np.ceil(SIMILARITY * np.maximum(sizes[i], sizes) - 1e-9)
        for j in np.flatnonzero((common[at] >= least) & (np.minimum(sizes[i], sizes) >= least)).tolist():
            if (a := top(i)) != (b := top(j)) and (keys is None or meet(i, j)) and _alike(texts[i], texts[j], int(least[j])):
                parent[b] = a
                out.append((nodes[i], nodes[j]))
    return out


def _block_links(table: pa.Table) -> pa.Table:
    """Links of one block; the key of a block ``by_words`` is a word, any other's is one of its members' keys."""
    texts = [Text(w) for w in table.column("words").to_pylist()]
    key = None if table.column("by_words")[0].as_py() else table.column("key")[0].as_py()
    found = links_between(*(table.column(c).to_pylist() if c != "words" else texts for c in ("node", "words", "part", "left", "keys")), key)
    return pa.table({"a": pa.array([f[0] for f in found], pa.int64()), "b": pa.array([f[1] for f in found], pa.int64())})


def _open(members: DataFrame, known: DataFrame) -> DataFrame:
    """The members (key, node) of buckets that hold several known components, with their component (``part``) and, of the
    bucket, the most frequent one (``main``) and the numbers of its members (``n``) and of those outside it (``rest``)."""
    return _several(members.join(known, "node", "left").select("key", "node", F.coalesce("component", "node").alias("part")))


def _several(placed: DataFrame) -> DataFrame:
    """``_open`` of members (key, node, part)."""
    own = shared.salted(placed, "node")
    parts = own.groupBy("key", "part").agg(F.count("*").alias("n"), shared.salts())
    whole = parts.groupBy("key").agg(F.max(F.struct("n", "part")).alias("most"), F.sum("n").alias("n"), F.count("*").alias("parts"), F.bit_or("salts").alias("salts")).where("parts > 1")
    whole = whole.select("key", F.col("most.part").alias("main"), "n", (F.col("n") - F.col("most.n")).alias("rest"), "salts")
    return own.join(shared.dealt(whole), ["key", "salt"]).drop("salt")


def _blocks(opened: DataFrame) -> DataFrame:
    """Members of open buckets dealt into blocks (key, i, j), in which every member outside the main component (``left``)
    meets every member; a bucket of up to ``BLOCK`` members is one block, with each member once."""
    h, one = F.xxhash64("node"), F.col("n") <= BLOCK
    whole = opened.where(one).select("key", F.lit(0).cast("long").alias("i"), F.lit(0).cast("long").alias("j"), "node", "part", (F.col("part") != F.col("main")).alias("left"))
    large = opened.where(~one).withColumns({"rows": F.ceil(F.col("rest") / BLOCK), "blocks": F.ceil(F.col("n") / BLOCK)})
    i, j = F.pmod(h, "rows"), F.pmod(F.shiftright(h, 20), "blocks")
    right = large.select("key", F.explode(F.sequence(F.lit(0).cast("long"), F.col("rows") - 1)).alias("i"), j.alias("j"), "node", "part", F.lit(False).alias("left"))
    left = large.where("part <> main").select("key", i.alias("i"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("j"), "node", "part", F.lit(True).alias("left"))
    return whole.union(right).union(left)


def _led(buckets: DataFrame, words: DataFrame, tables: list[DataFrame], rounds: int = 2) -> tuple[list[DataFrame], DataFrame]:
    """Links of the members (key, node) of buckets to their least one, then of those left to theirs; and the members of
    buckets of more than two."""
    links, members, active = [], None, buckets
    for _ in range(rounds):
        dealt = shared.salted_join(active, "key", "node", "sum_n > 1", sum_n=F.sum(F.lit(1)), min_node=F.min("node"))
        led = shared.written(dealt.select("key", "node", F.col("min_node").alias("a"), (F.col("sum_n") > 2).alias("more")), "led")
        if members is None:
            members = led.where("more").select("key", "node")
        pairs = led.where("node <> a").select("a", F.col("node").alias("b")).distinct()
        texts = words.select(F.col("node").alias("b"), F.col("words").alias("other"))
        both = shared.salted_lookup(pairs.join(texts, "b"), "a", "b", words.withColumnRenamed("node", "a"), "inner", of=pairs)
        links.append(shared.written(both.sortWithinPartitions("a").mapInArrow(_verified, "a long, b long"), "links"))
        tables.append(led)
        linked = links[-1].select("a", F.col("b").alias("node"))
        active = led.where("node <> a").join(linked, ["a", "node"], "left_anti").select("key", "node")
    return links, members


def _keyed(opened: DataFrame, many: Column, words: DataFrame) -> DataFrame:
    """The members of open buckets, once, with their component and words, and the keys of their buckets: of those of
    ``many`` outsiders (``wide``) and of the others."""
    keys = (F.collect_set(F.when(c, F.col("key"))).alias(n) for c, n in ((~many, "keys"), (many, "wide")))
    return shared.written(opened.groupBy("node").agg(F.first("part").alias("part"), *keys).join(words, "node"), "keyed")


def _linked(buckets: DataFrame, words: DataFrame) -> tuple[DataFrame, list[DataFrame]]:
    """Links (a, b) that connect what all buckets (key, node) link; and the tables to be discarded when they have been used."""
    tables: list[DataFrame] = []
    links, members = _led(buckets, words, tables)
    known = components(reduce(DataFrame.union, links))
    opened = shared.written(_open(members, known), "open")
    many = F.col("rest") > FEW * BLOCK
    texts = _keyed(opened, many, words)
    tables += [known, opened, texts]
    blocks = _blocks(opened.where(~many)).withColumn("by_words", F.lit(False))
    large = texts.where("size(wide) > 0")
    if not large.isEmpty():
        rare = shared.written(large.select("node", "part", "words").mapInArrow(_rarest(occurrences(large)), "key long, node long, part long"), "rare")
        again = shared.written(_several(rare), "open")
        blocks = blocks.union(_blocks(again).withColumn("by_words", F.lit(True)))
        tables += [rare, again]
    held = blocks.join(texts.select("node", "words", F.col("keys").alias("narrow"), "wide"), "node")
    held = held.withColumn("keys", F.when(F.col("by_words"), F.col("wide")).otherwise(F.col("narrow"))).drop("narrow", "wide")
    found = shared.written(held.groupBy("by_words", "key", "i", "j").applyInArrow(_block_links, "a long, b long"), "links")
    return found.union(known.select(F.col("component").alias("a"), F.col("node").alias("b"))), [*tables, *links, found]


def _classified(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Of rows (row, doc_id, text): (row, doc_id) of those without a word; (row, doc_id, first) of the others, where first
    is (whether the doc_id is null, doc_id, row) of the first row of the class."""
    sketched = shared.written(rows.mapInArrow(_sketched, _SKETCHED), "sketches")
    first = F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "row")
    worded = sketched.where("digest IS NOT NULL").select("row", "doc_id", "digest")
    of = shared.written(shared.salted_join(worded, "digest", "row", min_first=F.min(first)).select("row", "doc_id", F.col("min_first").alias("own"), F.col("min_first.row").alias("node")), "nodes")
    nodes = of.where("row = node").select("node", "own")
    texts = sketched.withColumnRenamed("row", "node").join(nodes.select("node"), "node", "left_semi")
    buckets = shared.written(texts.select(F.explode("keys").alias("key"), "node"), "buckets")
    words = shared.bucketed(texts.select("node", "words"), "node", "words")  # joined again and again
    lone = shared.written(sketched.where("digest IS NULL").select("row", "doc_id"), "wordless")
    shared.discard(sketched)
    links, used = _linked(buckets, words)
    known = components(links)
    found = known.join(nodes, "node")
    classes = shared.salted_join(found, "component", "node", min_own=F.min("own")).select("node", F.col("min_own").alias("class"))
    out = shared.written(shared.salted_lookup(of, "node", "row", classes).select("row", "doc_id", F.coalesce("class", "own").alias("first")), "classes")
    shared.discard(of, buckets, words, known, *used)
    return lone, out


def classes(docs: DataFrame) -> DataFrame:
    """doc_id and class_id, a row per document row."""
    lone, found = _classified(shared.numbered(shared.id_and_text(docs)))
    return found.select("doc_id", F.col("first.doc_id").alias("class_id")).union(lone.select("doc_id", F.col("doc_id").alias("class_id")))


def one_of_each(docs: DataFrame) -> DataFrame:
    """The first row of each class (least doc_id, null last; of equal ones any one row), all columns as they are."""
    shared.small_batches(docs.sparkSession)
    row = shared.free_name(docs, "row")
    held = shared.written(docs.withColumn(row, F.monotonically_increasing_id()), "documents")
    rows = held.select(F.col(row).alias("row"), F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    _, found = _classified(rows)
    later = found.where("row <> first.row").select(F.col("row").alias(row))
    return held.join(later, row, "left_anti").drop(row)
