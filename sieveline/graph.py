"""Connected components of an edge table, by alternating large-star and small-star steps."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sieveline.skew import join_unique
from sieveline.storage import remove, written


def _large_star(edges: DataFrame, total: int) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    nearest = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"), F.count("*").alias("n"))
    return join_unique(both, nearest, ["u"], "n", 2 * total).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame, total: int) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n"))
    moved = join_unique(down, least, ["u"], "n", total).filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v")))


def _state(edges: DataFrame) -> tuple:
    zero = F.lit(0).cast("decimal(38,0)")
    return tuple(edges.agg(F.count("*"), F.coalesce(F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), zero)).first())


def least_of_class(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nodes of edges, and of each the least node that edges lead to."""
    nodes, at = np.unique(np.r_[u, v], return_inverse=True)
    a, b, label = at[: len(u)], at[len(u) :], np.arange(len(nodes))
    while (apart := label[a] != label[b]).any():
        a, b = a[apart], b[apart]
        x, y = label[a], label[b]
        np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
        while ((up := label[label]) != label).any():
            label = up
    return nodes, nodes[label]


def _forest(at_once: int, most: int | None = None):
    """Edges taken ``at_once`` at a time, with each node linked to the least of its class among them instead.

    What is made is taken together with the next edges, until it has more than ``most`` edges.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, count, kept = [], 0, 0

        def made() -> pa.RecordBatch:
            nodes, least = least_of_class(*(np.concatenate([h[k] for h in held]) for k in (0, 1)))
            own = nodes != least
            return pa.RecordBatch.from_arrays([pa.array(nodes[own]), pa.array(least[own])], names=["u", "v"])

        for b in batches:
            held.append((b.column("u").to_numpy(), b.column("v").to_numpy()))
            count += b.num_rows
            if count >= at_once + kept:
                forest = made()
                kept = forest.num_rows
                if kept > (at_once // 2 if most is None else most):
                    yield forest
                    held, count, kept = [], 0, 0
                else:
                    held, count = [(forest.column(0).to_numpy(), forest.column(1).to_numpy())], kept
        if count:
            yield made()

    return run


def components(edges: DataFrame, at_once: int = 1 << 17) -> DataFrame:
    """(node, root) for every node of ``edges`` (columns u, v, whole numbers).

    root is the least node of the component.  Each task first replaces its edges, ``at_once`` at a time, by a forest of
    the same components.  What is left goes to one task if it is no more than that; else rounds of large-star and
    small-star follow until one changes nothing, which takes about the square of the logarithm of the number of nodes
    at most.  Each round is written to the shared folder, so a lost executor costs no more than that round.  Edges stay
    distributed; only counters come to the driver.  A node with a large share of all edges is no task of its own
    (:func:`join_unique`).  Self-loops are kept as components of one node, null ends are ignored, repeated edges do no
    harm and an empty table gives an empty table.
    """
    edges = edges.select(F.col("u").cast("long"), F.col("v").cast("long")).filter("u is not null and v is not null")
    loops = edges.filter("u = v").select("u").distinct()
    schema = "u long, v long"
    now = written(edges.filter("u <> v").mapInArrow(_forest(at_once, 8 * at_once), schema), "edges")
    if now.count() <= at_once:
        now = written(now.coalesce(1).mapInArrow(_forest(1 << 62), schema), "edges")
    else:
        now = written(now.distinct(), "edges")
        before = _state(now)
        while before[0]:
            nxt = written(_small_star(_large_star(now, before[0]), before[0]).filter("u <> v").distinct(), "edges")
            state = _state(nxt)
            remove(now)
            now = nxt
            if state == before:
                break
            before = state
    nodes = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    roots = now.select("v").distinct().select(F.col("v").alias("node"), F.col("v").alias("root"))
    alone = loops.select(F.col("u").alias("node")).join(nodes.unionByName(roots), "node", "left_anti")
    return nodes.unionByName(roots).unionByName(alone.select("node", F.col("node").alias("root")))
