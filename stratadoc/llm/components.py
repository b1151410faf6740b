"""Connected components of a table of links; nothing is collected.

Tasks unite up to ``PART`` links at a time, which leaves one link for each node but the roots.  Up to ``PART`` links in all
are done by that; of more, alternating large and small stars connect what the tasks have left.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import shared

#: Links that a task holds at once, as a few arrays of numbers.
PART = 1 << 20


def united(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nodes of links (a, b), and for each the least one that it is connected to."""
    nodes, place = np.unique(np.concatenate([a, b]), return_inverse=True)
    a, b = place[: len(a)], place[len(a) :]
    top = np.arange(len(nodes))
    while len(a):
        np.minimum.at(top, np.maximum(a, b), np.minimum(a, b))
        while ((higher := top[top]) != top).any():
            top = higher
        a, b = top[a], top[b]
        open_ = a != b
        a, b = a[open_], b[open_]
    return nodes, nodes[top]


def _united(batches):
    """(node, component) of each ``PART`` links of a task; a task without links has no rows."""
    held: list[pa.RecordBatch] = []
    n = 0

    def out():
        nodes, tops = united(*(np.concatenate([x.column(c).to_numpy() for x in held]) for c in ("a", "b")))
        return pa.RecordBatch.from_arrays([pa.array(nodes), pa.array(tops)], ["node", "component"])

    for batch in batches:
        for at in range(0, batch.num_rows, PART):
            part = batch.slice(at, PART)
            if held and n + part.num_rows > PART:
                yield out()
                held, n = [], 0
            held.append(part)
            n += part.num_rows
    if n:
        yield out()


def _starred(pairs: DataFrame) -> DataFrame:
    """(u, v, m): every neighbour v of u, and the least of u and its neighbours; a hub's neighbours are dealt by salt."""
    return shared.salted_join(pairs, "u", "v", min_v=F.min("v")).select("u", "v", F.least("min_v", "u").alias("m"))


def _stars(edges: DataFrame) -> bool:
    """Whether the links (u, v) are stars: every u has one v, and no v is a u."""
    nodes = edges.select(F.col("u").alias("node"), F.lit(1).alias("n")).union(edges.select(F.col("v").alias("node"), F.lit(0).alias("n")))
    return nodes.groupBy("node").agg(F.sum("n").alias("n"), F.min("n").alias("least")).where("n > 1 OR n > least").agg(F.count("*")).head()[0] == 0


def components(links: DataFrame) -> DataFrame:
    """(node, component), a written table: for every node of links (a, b) the least node that it is connected to.

    Self links and repeated links do no harm; no links give no rows.  Of many links a few rounds, each written to the
    shared folder.
    """
    given = shared.written(links.where("a <> b").select("a", "b"), "links")
    tasks = max(1, -(-given.count() // PART))
    first = shared.written(given.coalesce(tasks).mapInArrow(_united, "node long, component long"), "components")
    shared.discard(given)
    if tasks == 1:
        return first
    edges = shared.written(first.where("node <> component").select(F.col("node").alias("u"), F.col("component").alias("v")).distinct(), "components")
    shared.discard(first)
    while not _stars(edges):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _starred(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        small = _starred(large)
        small = small.select(F.col("v").alias("u"), F.col("m").alias("v")).union(small.select("u", F.col("m").alias("v"))).where("u <> v").distinct()
        new = shared.written(small, "components")
        shared.discard(edges)
        edges = new
    out = shared.written(edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()), "components")
    shared.discard(edges)
    return out
