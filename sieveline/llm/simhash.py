"""SimHash fingerprints and near-duplicate classes from a Gray-order hierarchical index."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sieveline.graph import components
from sieveline.llm.arrow import ASCII_LOWER, map_arrow, map_rows, unused
from sieveline.llm.tables import documents
from sieveline.skew import join_unique
from sieveline.storage import written

BITS = 64
#: How often a group that is too large is dealt again.
_LEVELS = 4
_BYTE_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).astype(np.int64)
_COLUMN = (np.arange(8, dtype=np.int32) * 256)[None, :]


def shingle_hashes(words: list[bytes], size: int, seed: int = 42) -> np.ndarray:
    """XXH64 of every run of ``size`` words joined by a space, repeats included, as rows of 8 bytes, high byte first."""
    if not words:
        return np.empty((0, 8), np.uint8)
    joined, digest = b" ".join(words), xxhash.xxh64_digest
    if len(words) <= size:
        return np.frombuffer(digest(joined, seed), np.uint8).reshape(1, 8)
    starts = list(accumulate((len(w) + 1 for w in words), initial=0))
    found = b"".join([digest(joined[a : b - 1], seed) for a, b in zip(starts, starts[size:])])  # noqa: B905
    return np.frombuffer(found, np.uint8).reshape(-1, 8)


def majority(hashes: np.ndarray) -> int:
    """The fingerprint: a bit is 1 if set in over half of the hashes; 0 for none."""
    if not len(hashes):
        return 0
    counts = np.bincount((hashes + _COLUMN).ravel(), minlength=2048).reshape(8, 256) @ _BYTE_BITS
    return int.from_bytes(np.packbits(2 * counts.ravel() > len(hashes)).tobytes(), "big")


def simhash(text: str | None, size: int = 3) -> int:
    """Fingerprint of a text: A-Z lower-cased, words between ASCII white space, shingles of ``size`` words (fewer words: all of them)."""
    return majority(shingle_hashes((text or "").encode("utf-8", "surrogatepass").translate(ASCII_LOWER).split(), size))


def fingerprints(docs: DataFrame, size: int = 3) -> DataFrame:
    """(doc_id, fp): fp is the 64-bit fingerprint as a signed long.  Null and empty texts get 0."""

    def rows(slices: Iterator[dict]) -> Iterator[dict]:
        for x in slices:
            fps = np.array([simhash(t, size) for t in x["text"]], np.uint64).view(np.int64)
            yield {"doc_id": x["doc_id"], "fp": fps}

    return map_rows(docs.select(F.col("doc_id").cast("long"), "text"), rows, "doc_id long, fp long")


# ---------------------------------------------------------------- the index


def gray_rank(values: np.ndarray) -> np.ndarray:
    """Position of each 64-bit code in the Gray sequence."""
    out = values.astype(np.uint64)
    for shift in (1, 2, 4, 8, 16, 32):
        out = out ^ (out >> np.uint64(shift))
    return out


class GrayIndex:
    """Hierarchical index over fingerprints in Gray order, for many groups at once.

    Leaves are fingerprints sorted by (group, Gray rank).  An upper node covers ``fan`` neighbours of the level
    below and keeps what they share: a mask of the bits on which all agree, and those bits.  Two nodes differ in
    at least the bits on which both masks agree to disagree; this count only grows on the way down, so a pair of
    nodes over the radius is dropped with all pairs of leaves below it.  For components a pair of nodes is also
    dropped when all leaves below both are linked already.
    """

    def __init__(self, group: np.ndarray, value: np.ndarray, fan: int = 8):
        self.order = order = np.lexsort((gray_rank(value), group))
        self.group, self.value = group[order], value[order].astype(np.uint64)
        n = len(order)
        ends = np.flatnonzero(np.r_[self.group[1:] != self.group[:-1], True]) + 1 if n else np.empty(0, np.int64)
        sizes = np.diff(np.r_[0, ends])
        self.starts = [np.arange(n)]  # of each level: the first leaf of each node
        self.first = []  # of each level above the leaves: the first child of each node, and the end
        self.mask, self.bits = [np.full(n, ~np.uint64(0))], [self.value]
        while len(sizes) and sizes.max() > 1:
            above = -(-sizes // fan)
            at = np.repeat(np.cumsum(sizes) - sizes, above)
            inner = np.arange(above.sum()) - np.repeat(np.cumsum(above) - above, above)
            first = at + inner * fan
            both, any_ = np.bitwise_and.reduceat(self.bits[-1] & self.mask[-1], first), np.bitwise_or.reduceat(self.bits[-1] | ~self.mask[-1], first)
            agree = ~(both ^ any_)
            self.mask.append(agree)
            self.bits.append(both & agree)
            self.starts.append(self.starts[-1][first])
            self.first.append(np.r_[first, sizes.sum()])
            sizes = above
        self.label = np.arange(n)

    def _link(self, a: np.ndarray, b: np.ndarray) -> bool:
        """Join the classes of a[i] and b[i]; whether any class changed.  Labels are the least leaf of a class."""
        changed = False
        while True:
            x, y = self.label[a], self.label[b]
            apart = x != y
            if not apart.any():
                return changed
            changed, a, b = True, a[apart], b[apart]
            x, y = x[apart], y[apart]
            np.minimum.at(self.label, np.maximum(x, y), np.minimum(x, y))
            while (up := self.label[self.label]).tobytes() != self.label.tobytes():
                self.label = up

    def _uniform(self) -> list[tuple[np.ndarray, np.ndarray]]:
        return [(np.minimum.reduceat(self.label, s), np.maximum.reduceat(self.label, s)) for s in self.starts]

    def classes(self, radius: int, chunk: int = 1 << 14) -> np.ndarray:
        """The class of each leaf under links of at most ``radius`` differing bits within a group."""
        n = len(self.value)
        if n < 2 or not self.first:
            return self.label
        i = np.flatnonzero((self.group[1:] == self.group[:-1]) & (np.bitwise_count(self.value[1:] ^ self.value[:-1]) <= radius))
        self._link(i, i + 1)
        spread = self._uniform()
        top = len(self.first)
        roots = np.arange(len(self.starts[top]))
        stack = [(top, roots[k : k + chunk], roots[k : k + chunk]) for k in range(0, len(roots), chunk)]
        while stack:
            level, a, b = stack.pop()
            low, high = spread[level]
            todo = ~((low[a] == high[a]) & (low[b] == high[b]) & (low[a] == low[b]))
            a, b = a[todo], b[todo]
            if not len(a):
                continue
            first = self.first[level - 1]
            ca, cb = first[a + 1] - first[a], first[b + 1] - first[b]
            per = ca * cb
            of = np.repeat(np.arange(len(a)), per)
            k = np.arange(per.sum()) - np.repeat(np.cumsum(per) - per, per)
            x, y = first[a][of] + k // cb[of], first[b][of] + k % cb[of]
            level -= 1
            keep = (x <= y) if level else (x < y)
            x, y = x[keep], y[keep]
            near = np.bitwise_count((self.bits[level][x] ^ self.bits[level][y]) & self.mask[level][x] & self.mask[level][y]) <= radius
            x, y = x[near], y[near]
            if level == 0:
                if self._link(x, y):
                    spread = self._uniform()
            else:
                stack += [(level, x[k : k + chunk], y[k : k + chunk]) for k in range(0, len(x), chunk)]
        return self.label


# ---------------------------------------------------------------- distribution


def _dealt(rows: DataFrame, radius: int) -> DataFrame:
    """A row for each of ``radius`` + 1 blocks of the bits that are left: fingerprints within the radius agree on one of them.

    Rows have fp, g (the group so far), rest (the bits that are left, moved together) and width (how many they are).
    The new g is a hash of the old one, the block and its bits; groups that a collision joins are searched as one.
    """
    parts, count = [], radius + 1
    for i in range(count):
        at, end = f"cast(width * {i} div {count} as int)", f"cast(width * {i + 1} div {count} as int)"
        bits = f"shiftrightunsigned(rest, {at}) & (shiftleft(1L, {end} - {at}) - 1)"
        above = f"if({end} < {BITS}, shiftleft(shiftrightunsigned(rest, {end}), {at}), 0L)"
        parts.append(f"struct(xxhash64(g, {i}, {bits}) as g, (rest & (shiftleft(1L, {at}) - 1)) | {above} as rest, width - ({end} - {at}) as width)")
    return rows.select("fp", F.explode(F.expr(f"array({', '.join(parts)})")).alias("k")).select("fp", "k.*")


def _groups(fps: DataFrame, radius: int, split_rows: int) -> DataFrame:
    """(fp, g): groups in which every pair within the radius meets; groups over ``split_rows`` are dealt again while bits are left."""
    rows = _dealt(fps.select("fp", F.lit(0).cast("long").alias("g"), F.col("fp").alias("rest"), F.lit(BITS).alias("width")), radius)
    settled = []
    for _ in range(_LEVELS):
        hot = written(rows.groupBy("g").agg(F.count("*").alias("n")).filter(F.col("n") > split_rows).select("g"), "hot")
        if hot.isEmpty():
            break
        settled.append(rows.join(hot, "g", "left_anti").select("fp", "g"))
        rows = written(_dealt(rows.join(hot, "g", "left_semi"), radius), "dealt")
    return reduce(DataFrame.unionByName, settled, rows.select("fp", "g"))


def _local_links(radius: int, rows_at_once: int):
    """Streams rows sorted by group; groups are cut into runs of whole groups, each run indexed at once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def links(g: np.ndarray, fps: np.ndarray) -> pa.RecordBatch:
            index = GrayIndex(np.cumsum(np.r_[0, g[1:] != g[:-1]]), fps.view(np.uint64))
            label = index.classes(radius)
            i = np.flatnonzero(label != np.arange(len(label)))
            value = index.value.view(np.int64)
            return pa.RecordBatch.from_arrays([pa.array(value[i]), pa.array(value[label[i]])], names=["u", "v"])

        count = 0
        for batch in batches:
            held.append((batch.column("g").to_numpy(), batch.column("fp").to_numpy()))
            count += batch.num_rows
            if count < rows_at_once:
                continue
            g, fps = (np.concatenate(x) for x in zip(*held, strict=True))
            cut = np.searchsorted(g, g[-1])
            if cut:
                yield links(g[:cut], fps[:cut])
            held, count = [(g[cut:], fps[cut:])], len(g) - int(cut)
        if count:
            yield links(*(np.concatenate(x) for x in zip(*held, strict=True)))

    return run


def near_links(fps: DataFrame, radius: int = 3, split_rows: int = 2048, rows_at_once: int = 1 << 17) -> DataFrame:
    """Edges (u, v) between distinct fingerprints whose components are those of all pairs within ``radius`` bits.

    ``fps`` has a column fp of distinct values.  Rows are dealt by radius + 1 blocks of bits; a pair within the
    radius agrees on a whole block, so it meets in a group.  Groups over ``split_rows`` are dealt again by blocks
    of the bits that are left, which is exact for the same reason and spreads a dense cluster over many tasks; up to
    four times, which leaves 20 of 64 bits at a radius of 3.  Each group is searched by a :class:`GrayIndex`; a
    fingerprint gets at most one edge per group.
    """
    dealt = _groups(fps, radius, split_rows).repartition("g").sortWithinPartitions("g")
    return map_arrow(dealt, _local_links(radius, rows_at_once), "u long, v long")


def near_duplicates(docs: DataFrame, size: int = 3, radius: int = 3) -> DataFrame:
    """(doc_id, fp, component_id) for every row of ``docs`` (doc_id, text, any others).

    Rows whose fingerprints differ in at most ``radius`` bits are linked; component_id is the smallest doc_id
    that is reachable, the row's own included.  Null or empty texts have fingerprint 0 and are linked like any
    other.  Rows with a null doc_id take part and get the component's smallest known doc_id (null if none).
    Repeated rows stay repeated.  An empty table gives an empty table.
    """
    fps = written(fingerprints(docs, size), "fingerprints")
    least = written(fps.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count("*").alias("n")), "representatives")
    comps = written(components(near_links(least, radius)), "components")
    linked = least.join(comps, least.fp == comps.node).select("fp", "root", "least")
    lowest = linked.groupBy("root").agg(F.min("least").alias("component_id"))
    linked = linked.join(lowest, "root").select("fp", F.col("component_id").alias("linked_id"))
    classes = written(least.join(linked, "fp", "left").select("fp", F.coalesce("linked_id", "least").alias("component_id"), "n"), "classes")
    return join_unique(fps, classes, ["fp"], "n", fps.count()).select("doc_id", "fp", "component_id")


def only_one(rows: DataFrame) -> DataFrame:
    """One row of each doc_id that repeats: that of the least text, then of the least hash of all columns."""
    least = rows.groupBy("doc_id").agg(F.min_by(F.struct(*rows.columns), F.struct("text", F.xxhash64(*rows.columns))).alias("_row"))
    return least.select("_row.*")


def one_of_each(docs: DataFrame, size: int = 3, radius: int = 3) -> DataFrame:
    """``docs`` with one document, that of the smallest doc_id, of each class of near duplicates; columns as they were.

    Of rows that repeat a doc_id one stays (:func:`only_one`).  Rows with a null doc_id stay: nothing tells them apart.
    """
    classes = written(near_duplicates(docs, size, radius).select("doc_id", "component_id"), "near")
    first = classes.filter("doc_id = component_id").groupBy("doc_id").count()
    kept_id = unused("kept_id", docs.columns)
    keep = first.select(F.col("doc_id").alias(kept_id))
    kept = docs.join(keep.hint("shuffle_hash"), F.col("doc_id") == F.col(kept_id), "left").filter(F.col(kept_id).isNotNull() | F.col("doc_id").isNull()).select(*docs.columns)
    if first.filter("count > 1").isEmpty():
        return kept
    return only_one(kept.filter("doc_id is not null")).unionByName(kept.filter("doc_id is null"))


def hex_fingerprint(fp):
    """16 lowercase hex digits of a signed long column."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def op1_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return near_duplicates(docs, 3, 3).select("doc_id", hex_fingerprint(F.col("fp")).alias("fingerprint"), "component_id")
