"""Near copies by shingle similarity: SimHash first, then bands of min-hashes for what is alike but differs in more bits.

Every pair that meets either way is compared exactly.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sieveline.graph import components
from sieveline.llm.arrow import ASCII_LOWER, map_arrow, map_rows, unused
from sieveline.llm.simhash import majority, near_links, only_one, shingle_hashes
from sieveline.skew import join_unique
from sieveline.storage import written

SIZE = 5
SIMILARITY = 0.8
#: Bands of least hashes that two texts may meet by, and hashes in a band: 1 - (1 - 0.8^5)^20 = 0.9996 of pairs at 0.8.
BANDS, ROWS = 20, 5
#: Rounds in which the texts of a group are compared with one of it, before all pairs that are left.
_STARS = 3
_MULTIPLIERS = np.random.default_rng(20).integers(1, 1 << 62, BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def words_of(text: str | None) -> list[bytes]:
    """Words between ASCII white space, A-Z lower-cased."""
    return (text or "").encode("utf-8", "surrogatepass").translate(ASCII_LOWER).split()


def band_keys(hashes: np.ndarray, at_once: int = 1024) -> list[int]:
    """A signed 64-bit key for each band: what the least hashes under ROWS of the multipliers are.  No hashes: no keys."""
    if not len(hashes):
        return []
    values = np.ascontiguousarray(hashes).view(">u8").ravel().astype(np.uint64)
    least = np.full(len(_MULTIPLIERS), ~np.uint64(0))
    for at in range(0, len(values), at_once):
        least = np.minimum(least, (_MULTIPLIERS[:, None] * values[None, at : at + at_once]).min(axis=1))
    return [int.from_bytes(xxhash.xxh64_digest(b.tobytes(), i), "big", signed=True) for i, b in enumerate(least.reshape(BANDS, ROWS))]


def _shingles(hashes: np.ndarray) -> np.ndarray:
    """The set of the hashes, sorted."""
    return np.unique(np.ascontiguousarray(hashes).view(">u8").ravel().astype(np.uint64))


def similarity(a: str | None, b: str | None, size: int = SIZE) -> float:
    """Jaccard similarity of the sets of shingles (fewer words than ``size``: the whole sequence); two texts without words: 1."""
    x, y = (_shingles(shingle_hashes(words_of(t), size)) for t in (a, b))
    both = len(np.intersect1d(x, y, assume_unique=True))
    return both / (len(x) + len(y) - both) if len(x) + len(y) else 1.0


def signatures(docs: DataFrame, size: int = SIZE) -> DataFrame:
    """(doc_id, copy, n, fp, bands): 128 bits that equal word sequences share, the number of shingles, repeats included, the SimHash of the set of shingles, the keys of the bands."""

    def rows(slices: Iterator[dict]) -> Iterator[dict]:
        for x in slices:
            out: dict[str, list] = {"doc_id": x["doc_id"], "copy": [], "n": [], "fp": [], "bands": []}
            for text in x["text"]:
                words = words_of(text)
                hashes = shingle_hashes(words, size)
                out["copy"].append(xxhash.xxh3_128_digest(b" ".join(words)))
                out["n"].append(len(hashes))
                own = _shingles(hashes).astype(">u8").view(np.uint8).reshape(-1, 8)
                out["fp"].append(majority(own))
                out["bands"].append(band_keys(own))
            out["fp"] = np.array(out["fp"], np.uint64).view(np.int64)
            yield out

    return map_rows(docs.select(F.col("doc_id").cast("long"), "text"), rows, "doc_id long, copy binary, n long, fp long, bands array<long>")


def close(nodes: DataFrame, radius: int = 3) -> DataFrame:
    """(u, v): pairs that the SimHash index links; ``nodes`` has node, n and fp.  Texts of one fingerprint are paired with the least of them.

    A pair that fails the exact comparison hides no other: what it leaves apart meets again by bands.
    """
    own = nodes.filter("n > 0").select("node", "fp")
    leads = written(own.groupBy("fp").agg(F.min("node").alias("lead"), F.count("*").alias("n")), "fingerprints")
    total = int(leads.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0])
    same = join_unique(own, leads, ["fp"], "n", total).filter("node > lead").select(F.col("node").alias("u"), F.col("lead").alias("v"))
    edges = near_links(leads.select("fp"), radius).distinct()
    name = lambda fp, c: leads.select(F.col("fp").alias(fp), F.col("lead").alias(c))
    near = edges.join(name("_u", "a"), F.col("u") == F.col("_u")).join(name("_v", "b"), F.col("v") == F.col("_v"))
    return same.unionByName(near.select(F.col("a").alias("u"), F.col("b").alias("v")))


_GROUP = ["band", "key"]


def met(nodes: DataFrame) -> DataFrame:
    """(band, key, node, n): the groups of two or more texts; ``nodes`` has node, n, bands, a row per distinct text."""
    keys = nodes.select("node", "n", F.posexplode("bands").alias("band", "key"))
    groups = keys.groupBy(*_GROUP).agg(F.count("*").alias("rows")).filter("rows > 1")
    return join_unique(keys, groups, _GROUP, "rows", BANDS * nodes.count()).select(*_GROUP, "node", "n")


def _rooted(groups: DataFrame, classes: DataFrame) -> DataFrame:
    """``groups`` with the root of each node and the number of rows of the group; only groups of two or more classes."""
    rows = groups.join(classes.select("node", "root"), "node", "left").withColumn("root", F.coalesce("root", "node"))
    mixed = rows.groupBy(*_GROUP).agg(F.min("root").alias("low"), F.max("root").alias("high"), F.count("*").alias("rows")).filter("low < high")
    return join_unique(rows, mixed.select(*_GROUP, "rows", F.col("rows").alias("size")), _GROUP, "size", groups.count())


def star(rows: DataFrame, turn: int) -> DataFrame:
    """(u, v): for each text the one with which it shares most bands, of the texts that lead its groups in this turn."""
    lead = F.min_by(F.struct(F.col("node").alias("v"), F.col("root").alias("v_root")), F.xxhash64("node", F.lit(turn)) if turn else F.col("node"))
    leads = rows.groupBy(*_GROUP).agg(lead.alias("lead"), F.count("*").alias("size"))
    pairs = join_unique(rows, leads, _GROUP, "size", rows.count()).select(F.col("node").alias("u"), "root", "lead.*").filter("root <> v_root")
    return pairs.groupBy("u", "v").agg(F.count("*").alias("shared")).groupBy("u").agg(F.max_by("v", F.struct("shared", -F.col("v"))).alias("v"))


def blocks(rows: DataFrame, split_rows: int, rows_at_once: int) -> DataFrame:
    """(band, key, i, j, block, node, root): each row of a group in every pair (i, j) of blocks in which it has to be compared.

    A block has at most ``split_rows`` texts and, but for its last text, at most ``rows_at_once`` shingles.  Every two
    blocks of a group are paired, unless both hold only texts of one and the same class.  A large group is first dealt
    into parts by a hash of the text, and each part is cut into blocks class by class, so no group is one task.
    """
    parts = F.ceil(F.col("rows") / F.lit(4 * split_rows))
    dealt = rows.withColumn("part", F.pmod(F.xxhash64("node"), parts))
    weight = F.greatest(F.col("n") * split_rows, F.lit(rows_at_once).cast("long"))
    before = F.sum(weight).over(Window.partitionBy(*_GROUP, "part").orderBy("root", "node").rowsBetween(Window.unboundedPreceding, 0)) - weight
    cut = dealt.withColumn("block", F.floor(before / F.lit(split_rows * rows_at_once)) * F.lit(1 << 32) + F.col("part"))
    cut = written(cut.select(*_GROUP, "block", "node", "root"), "blocks")
    ends = cut.groupBy(*_GROUP, "block").agg(F.min("root").alias("low"), F.max("root").alias("high"))
    own = written(ends.select(*_GROUP, "block", F.when(F.col("low") == F.col("high"), F.col("low")).alias("pure")), "block_ends")
    other = own.select(*_GROUP, F.col("block").alias("other"), F.col("pure").alias("other_pure"))
    pairs = own.join(other, _GROUP).filter("pure is null or other_pure is null or pure <> other_pure").drop("pure", "other_pure")
    return cut.join(pairs, [*_GROUP, "block"]).select(*_GROUP, F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "node", "root")


class _Block:
    """Texts side by side: nodes, classes, sets of shingles, keys of the bands before the one they meet by."""

    def __init__(self, rows: list[tuple]):
        self.node, self.root = (np.array([r[k] for r in rows], np.int64) for k in (0, 1))
        self.sets = [r[2] for r in rows]
        self.bands = np.array([r[3] for r in rows], np.int64).reshape(len(rows), -1)
        self.n = np.array([len(s) for s in self.sets], np.int64)
        self.starts = np.cumsum(self.n) - self.n
        self.known, self.ids = np.unique(np.concatenate(self.sets), return_inverse=True)
        self.flags = np.zeros(len(self.known), bool)

    def common(self, other: np.ndarray, which: np.ndarray) -> np.ndarray:
        """How many shingles of a set the sets ``which`` hold."""
        at = np.minimum(np.searchsorted(self.known, other), len(self.known) - 1)
        at = at[self.known[at] == other]
        self.flags[at] = True
        if len(which) * 8 < len(self.n):
            out = np.array([np.count_nonzero(self.flags[self.ids[self.starts[k] : self.starts[k] + self.n[k]]]) for k in which], np.int64)
        else:
            out = np.add.reduceat(self.flags[self.ids].astype(np.int64), self.starts)[which]
        self.flags[at] = False
        return out


def _links(x: _Block, y: _Block, least: float) -> list[tuple[int, int]]:
    """Links between the blocks, or within one, that make classes meet; every pair of different classes is compared.

    Pairs that share an earlier band are compared there.
    """
    found = []
    for k in range(len(x.n)):
        fit = (y.root != x.root[k]) & (np.minimum(y.n, x.n[k]) / np.maximum(y.n, x.n[k]) >= least) & ~(y.bands == x.bands[k]).any(axis=1)
        if x is y:
            fit[: k + 1] = False
        which = np.flatnonzero(fit)
        if not len(which):
            continue
        both = y.common(x.sets[k], which)
        for m in which[both / (x.n[k] + y.n[which] - both) >= least]:
            old, new = y.root[m], x.root[k]
            if old != new:
                found.append((int(x.node[k]), int(y.node[m])))
                x.root[x.root == old] = new
                y.root[y.root == old] = new
    return found


def compared(pairs: DataFrame, texts: DataFrame, size: int = SIZE, least: float = SIMILARITY) -> DataFrame:
    """(u, v): links found in the pairs of :func:`blocks`, every pair of texts of different classes compared."""
    names = [*_GROUP, "i", "j"]
    dealt = pairs.join(texts, "node").select(*names, "block", "node", "root", "text").repartition(*names).sortWithinPartitions(*names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, ([], [])

        def done() -> pa.RecordBatch:
            x = [_Block(rows) for rows in held if rows]
            one = now is not None and now[2] == now[3]
            links = _links(x[0], x[-1], least) if x and (one or len(x) == 2) else []
            return pa.RecordBatch.from_arrays([pa.array([p[k] for p in links], pa.int64()) for k in (0, 1)], names=["u", "v"])

        for batch in batches:
            columns = (batch.column(n).to_numpy().tolist() for n in (*names, "block", "node", "root"))
            for at, (band, key, i, j, block, node, root) in enumerate(zip(*columns, strict=True)):
                if now != (band, key, i, j):
                    if (out := done()).num_rows:
                        yield out
                    now, held = (band, key, i, j), ([], [])
                hashes = shingle_hashes(words_of(batch.column("text")[at].as_py()), size)
                if len(hashes):
                    held[int(block != i)].append((node, root, _shingles(hashes), band_keys(hashes)[:band]))
        yield done()

    return map_arrow(dealt, run, "u long, v long")


def verified(pairs: DataFrame, texts: DataFrame, size: int = SIZE, least: float = SIMILARITY) -> DataFrame:
    """The (u, v) of ``pairs`` whose texts (node, text) have a Jaccard similarity of at least ``least``."""
    one = pairs.select("u", "v").join(texts.select(F.col("node").alias("u"), F.col("text").alias("a")), "u")
    two = one.join(texts.select(F.col("node").alias("v"), F.col("text").alias("b")), "v")

    def rows(slices: Iterator[dict]) -> Iterator[dict]:
        for x in slices:
            ok = [i for i, (a, b) in enumerate(zip(x["a"], x["b"], strict=True)) if similarity(a, b, size) >= least]
            yield {"u": [x["u"][i] for i in ok], "v": [x["v"][i] for i in ok]}

    return map_rows(two, rows, "u long, v long")


def near_copies(docs: DataFrame, size: int = SIZE, least: float = SIMILARITY, split_rows: int = 4096, rows_at_once: int = 1 << 19) -> DataFrame:
    """(doc_id, component_id) for every row of ``docs`` with a doc_id: classes of texts that are alike.

    Links join texts of equal words and texts whose sets of ``size``-word shingles have a Jaccard similarity of at
    least ``least``; every link is verified on whole texts, so none joins texts that are less alike.  Links of the
    SimHash index are tried first.  Then texts that share a band are compared, all of them, unless verified links have
    joined them already; a pair that shares none and differs in over three bits is missed (see BANDS).  ``split_rows`` and ``rows_at_once`` only set how much a task compares, see :func:`blocks`.
    component_id is the smallest doc_id that is reachable.  Texts that are null, empty or without words are copies of
    each other.  Rows that repeat a doc_id are one document with several texts.  An empty table gives an empty table.
    """
    known = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").filter("doc_id is not null")
    rows = written(signatures(known, size), "signatures")
    copies = rows.groupBy("copy").agg(F.min("doc_id").alias("node"), F.first("n").alias("n"), F.first("fp").alias("fp"), F.first("bands").alias("bands"), F.count("*").alias("rows"))
    nodes = written(copies, "texts")
    groups = written(met(nodes), "groups")
    pairs = written(close(nodes), "close")
    wanted = groups.select("node").unionByName(pairs.select(F.explode(F.array("u", "v")).alias("node"))).distinct()
    texts = written(known.withColumnRenamed("doc_id", "node").join(wanted, "node", "left_semi"), "candidate_texts")
    # links of the index, then each text with one of its group, which joins most; then all pairs that this has left in different classes
    links = written(verified(pairs, texts, size, least), "links")
    apart = written(_rooted(groups, written(components(links), "classes")), "apart")
    links = links.unionByName(written(verified(star(apart, 0), texts, size, least), "links"))
    classes = written(components(links), "classes")
    apart = written(_rooted(apart.drop("root", "rows"), classes), "apart")
    for turn in range(1, _STARS):
        large = apart.filter("rows > 256")
        if large.isEmpty():
            break
        links = links.unionByName(written(verified(star(large, turn), texts, size, least), "links"))
        classes = written(components(links), "classes")
        apart = written(_rooted(apart.drop("root", "rows"), classes), "apart")
    more = written(compared(blocks(apart, split_rows, rows_at_once), texts, size, least), "links")
    owners = join_unique(rows.select("doc_id", "copy"), nodes.select("copy", "node", "rows"), ["copy"], "rows", rows.count()).select("doc_id", "node")
    repeated = owners.groupBy("doc_id").agg(F.min("node").alias("v"), F.max("node").alias("most")).filter("v <> most").drop("most")
    bridges = owners.join(repeated, "doc_id").filter("node <> v").select(F.col("node").alias("u"), "v")
    links = links.unionByName(more).unionByName(bridges)
    roots = written(components(links), "classes")
    return owners.join(roots, "node", "left").select("doc_id", F.coalesce("root", "node").alias("component_id"))


def one_of_each(docs: DataFrame, size: int = SIZE, least: float = SIMILARITY) -> DataFrame:
    """``docs`` with one document, that of the smallest doc_id, of each class of near copies; columns as they were.

    Of rows that repeat a doc_id one stays (:func:`only_one`).  Rows with a null doc_id stay: nothing tells them apart.
    """
    classes = written(near_copies(docs, size, least), "near")
    first = classes.groupBy("doc_id").agg(F.min("component_id").alias("component_id"), F.count("*").alias("n")).filter("doc_id = component_id")
    kept_id = unused("kept_id", docs.columns)
    keep = first.select(F.col("doc_id").alias(kept_id))
    kept = docs.join(keep.hint("shuffle_hash"), F.col("doc_id") == F.col(kept_id), "left").filter(F.col(kept_id).isNotNull() | F.col("doc_id").isNull()).select(*docs.columns)
    if first.filter("n > 1").isEmpty():
        return kept
    return only_one(kept.filter("doc_id is not null")).unionByName(kept.filter("doc_id is null"))
