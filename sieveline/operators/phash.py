"""Near-identical images by perceptual hashes: the first of a match stays."""

from __future__ import annotations

import warnings
from collections.abc import Iterator
from itertools import combinations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sieveline.context import Context
from sieveline.functions.scalar import first_shared_band, hamming
from sieveline.functions.text import jaccard, word_set
from sieveline.operators.base import Operator, marked
from sieveline.registry import register_op
from sieveline.schema import json_text
from sieveline.sources import images
from sieveline.storage import remove, written


def block_keys(h: Column, blocks: int, agree: int) -> Column:
    """Keys of every choice of ``agree`` blocks of a 64-bit hash, as structs (choice, bits)."""
    edges = [64 * i // blocks for i in range(blocks + 1)]
    keys = []
    for n, choice in enumerate(combinations(range(blocks), agree)):
        mask = sum(((1 << (edges[b + 1] - edges[b])) - 1) << edges[b] for b in choice)
        keys.append(F.struct(F.lit(n).alias("choice"), h.bitwiseAND(F.lit(mask - (1 << 64) if mask >> 63 else mask)).alias("bits")))
    return F.array(*keys)


def matching_pairs(nodes: DataFrame, threshold: int, text_threshold: float | None) -> DataFrame:
    """Edges (i, j, band) between rows (row_idx, h[, toks]) with i < j.

    Hashes agree on one of four 16-bit bands, differ in at most ``threshold`` bits and, with a text threshold, token
    sets overlap enough.  band is the least band shared.  Up to three bits, hashes agree on two of five blocks as
    well; those keys make smaller buckets with the same pairs.
    """
    keyed = block_keys(F.col("h"), 5, 2) if threshold <= 3 else block_keys(F.col("h"), 4, 1)
    dealt = nodes.select("row_idx", "h", F.explode(keyed).alias("key"))
    a, b = (dealt.select("key", *(F.col(c).alias(f"{c}_{s}") for c in ("row_idx", "h"))) for s in "ab")
    # sizes are estimated from packed files and leave out what explode adds: without the hint, all keys may be broadcast
    pairs = a.join(b.hint("merge"), "key").filter("row_idx_a < row_idx_b").filter(hamming(F.col("h_a"), F.col("h_b")) <= threshold)
    band = first_shared_band(F.col("h_a"), F.col("h_b"))
    pairs = pairs.select(F.col("row_idx_a").alias("i"), F.col("row_idx_b").alias("j"), band.alias("band")).filter("band is not null").distinct()
    if text_threshold is not None:
        # only rows of pairs need their tokens, and each pair once
        toks = nodes.select("row_idx", "toks")
        pairs = pairs.join(toks.select(F.col("row_idx").alias("i"), F.col("toks").alias("ti")).hint("merge"), "i").join(toks.select(F.col("row_idx").alias("j"), F.col("toks").alias("tj")).hint("merge"), "j")
        pairs = pairs.filter(jaccard(F.col("ti"), F.col("tj")) >= text_threshold)
    return pairs.select("i", "j", "band")


def first_wins(edges: DataFrame, at_once: int = 1 << 17) -> DataFrame:
    """(j, kept) for all later ends of ``edges`` (i, j): whether a row stays when rows are seen in order and one goes that matches a kept row before it.

    A row with a kept row before it goes; one whose rows before it have all gone, or that has none, stays.  Each
    round decides all rows that can be decided and writes the rest to the shared folder; once no more than ``at_once``
    edges are left, one task walks through them in order.
    """
    spark = edges.sparkSession
    states = spark.createDataFrame([], "j long, kept boolean")
    open_edges = written(edges.select("i", "j"), "edges")
    owned = True
    while open_edges.count() > at_once:
        waiting = open_edges.select("j").distinct()
        firsts = open_edges.select(F.col("i").alias("j")).distinct().join(waiting, "j", "left_anti")
        lost = written(open_edges.join(firsts.withColumnRenamed("j", "i"), "i", "left_semi").select("j").distinct(), "lost")
        states = states.unionByName(lost.select("j", F.lit(False).alias("kept")))
        # what a kept row decided goes; so do edges that start at a lost row
        rest = open_edges.join(lost, "j", "left_anti").join(lost.withColumnRenamed("j", "i"), "i", "left_anti")
        left = waiting.join(lost, "j", "left_anti").join(rest.select("j").distinct(), "j", "left_anti")
        states = written(states.unionByName(left.select("j", F.lit(True).alias("kept"))), "states")
        nxt = written(rest, "edges")
        if owned:
            remove(open_edges)
        open_edges, owned = nxt, True
    return states.unionByName(open_edges.coalesce(1).sortWithinPartitions("j", "i").mapInArrow(_walk, "j long, kept boolean"))


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rule of :func:`first_wins` over edges in order of j."""
    gone: set[int] = set()
    seen: dict[int, bool] = {}
    for b in batches:
        for i, j in zip(b.column("i").to_pylist(), b.column("j").to_pylist(), strict=True):
            seen.setdefault(j, True)
            if i not in gone:
                seen[j] = False
                gone.add(j)
    yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.int64()), pa.array(list(seen.values()), pa.bool_())], names=["j", "kept"])


def first_match_dedup(rows: DataFrame, threshold: int = 3, text_threshold: float | None = 0.9) -> DataFrame:
    """(row_idx, duplicate_of_idx) of the rows (row_idx, h[, toks]) that go.

    Of rows with the same hash and tokens the first decides for all, so that large groups of copies make no pairs.
    duplicate_of_idx is the kept match of the least shared band, the first of these.
    """
    text = text_threshold is not None
    same = ["h", "toks"] if text else ["h"]
    rows = written(rows.select("row_idx", "h", *([F.array_sort("toks").alias("toks")] if text else [])), "hashes")
    groups = rows.groupBy(*same).agg(F.min("row_idx").alias("first"))
    nodes = written(groups.select(F.col("first").alias("row_idx"), *same), "nodes")
    edges = written(matching_pairs(nodes, threshold, text_threshold), "pairs")
    lost = written(first_wins(edges).filter("not kept").select(F.col("j").alias("row_idx")), "lost")
    both = edges.select("i", "j", "band").unionByName(edges.select(F.col("j").alias("i"), F.col("i").alias("j"), "band"))
    kept_side = both.join(lost.withColumnRenamed("row_idx", "i").hint("merge"), "i", "left_anti")
    members = written(rows.join(nodes.withColumnRenamed("row_idx", "first").hint("merge"), same).select("row_idx", "first"), "members")
    stays = members.filter("row_idx = first").join(lost.hint("merge"), "row_idx", "left_anti").select("first")
    # copies of a row that stays go with it; rows whose first goes look among the kept matches before them
    own = members.join(stays.hint("merge"), "first", "left_semi").filter("row_idx <> first").select("row_idx", F.lit(0).alias("band"), F.col("first").alias("i"))
    other = members.join(lost.withColumnRenamed("row_idx", "first").hint("merge"), "first", "left_semi").join(kept_side.withColumnRenamed("j", "first").hint("merge"), "first").filter("i < row_idx").select("row_idx", "band", "i")
    return own.unionByName(other).groupBy("row_idx").agg(F.min(F.struct("band", "i"))["i"].alias("duplicate_of_idx"))


@register_op("phash_dedup")
class PhashDedup(Operator):
    """Drops images whose perceptual hash, and caption, match those of a kept row before them."""

    stage, kind = "dedup", "global"

    def __init__(self, hamming_threshold: int = 3, hash_size: int = 8, text_aware: bool = True, text_sim_threshold: float = 0.90):
        if hamming_threshold > 3 or hash_size != 8:
            warnings.warn("bands find every pair only up to 3 bits of a 64-bit hash", stacklevel=2)
        self.hamming_threshold, self.hash_size, self.text_aware, self.text_sim_threshold = hamming_threshold, hash_size, text_aware, text_sim_threshold

    def hashed(self, df: DataFrame, ctx: Context) -> DataFrame:
        """``df`` with _h: a column phash of the input, or the hash of the image's pixels."""
        if "phash" in df.columns:
            return df.withColumn("_h", F.col("phash"))
        return images.with_measure(df, ctx, "_h", images.hash_measure(self.hash_size), "long")

    def apply(self, df: DataFrame, ctx: Context, stage_no: int = 0) -> DataFrame:
        names = df.columns
        df = written(self.hashed(df, ctx), "hashed")
        alive = df.filter("keep and _h is not null").select("row_idx", F.col("_h").alias("h"), word_set(F.col("text")).alias("toks"))
        gone = written(first_match_dedup(alive, self.hamming_threshold, self.text_sim_threshold if self.text_aware else None), "gone")
        ids = df.select(F.col("row_idx").alias("duplicate_of_idx"), F.col("id").alias("_dup"))
        gone = gone.join(ids, "duplicate_of_idx").select("row_idx", "_dup")
        df = df.join(gone, "row_idx", "left")
        code = F.when(F.col("_h").isNull(), F.lit("unreadable")).when(F.col("_dup").isNotNull(), F.lit("duplicate"))
        return marked(df, self, code, stage_no, meta={"duplicate_of": json_text(F.col("_dup"))}).select(*names)
