"""Benchmark passages in documents: SimHash of item-sized windows, multi-index Hamming lookup, exact verification."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sieveline.llm.arrow import map_arrow, map_rows
from sieveline.llm.simhash import majority, shingle_hashes
from sieveline.llm.tables import documents
from sieveline.storage import written

SHINGLE, RADIUS, BLOCKS = 5, 23, 8
#: The least similarity, 0.8, in whole numbers.
_PARTS = (4, 5)
#: Items, and characters of them, that are held in memory at once; more are searched for in further passes.
ITEMS_AT_ONCE, LETTERS_AT_ONCE = 50_000, 50_000_000
#: Windows that are fingerprinted at once.
_WINDOWS = 1 << 14
_POPULAR = np.bitwise_count(np.arange(256, dtype=np.uint8))
#: ASCII: letters to lower case, digits kept, all else to a space; other bytes kept.
_WORDS = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))


def words_of(text: str | None) -> list[bytes]:
    """Runs of ASCII letters, digits and non-ASCII characters, A-Z lower-cased."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_WORDS).split()


class ItemIndex:
    """Items by shingle, with their sizes in words, weights of shingles and fingerprints.

    Two fingerprints of 64 bits that differ in at most 23 bits differ in at most 2 bits of one of 8 blocks; a
    window and an item of its size that pass that test are compared as a whole, then exactly.  At this radius the
    blocks alone would let pass more pairs than there are items, so a window is looked up only among the items of
    which it has shingles enough: no other item can be found in it.
    """

    def __init__(self, items: list[tuple[int, str | None]]):
        self.ids, self.total, self.size, self.length, fps = [], [], [], [], []
        posts: dict[int, list[tuple[np.ndarray, ...]]] = defaultdict(list)
        for item_id, text in items:
            words = words_of(text)
            if not words:
                continue
            k = min(SHINGLE, len(words))
            hashes = shingle_hashes(words, k)
            own, counts = np.unique(_values(hashes), return_counts=True)
            posts[k].append((own, np.full(len(own), len(self.ids)), counts))
            self.ids.append(item_id)
            self.total.append(len(hashes))
            self.size.append(len(words))
            self.length.append(k)
            fps.append(majority(hashes))
        self.need = np.array([-(-t * _PARTS[0] // _PARTS[1]) for t in self.total], np.int64)
        self.fps = np.array(fps, np.uint64)
        self.blocks = _blocks(self.fps)
        #: For each shingle length: sorted hashes, where the items of each begin, those items, how often each has it.
        self.shingles: dict[int, tuple[np.ndarray, ...]] = {}
        #: Of each item: its shingles (places among the sorted hashes) and how often it has each.
        self.weights: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for k, of in posts.items():
            values, item, weight = (np.concatenate(x) for x in zip(*of, strict=True))
            keys, place = np.unique(values, return_inverse=True)
            order = np.lexsort((item, place))
            self.shingles[k] = (keys, np.searchsorted(place[order], np.arange(len(keys) + 1)), item[order], weight[order])
            at = 0
            for own, i, counts in of:
                self.weights[int(i[0])] = (place[at : at + len(own)], counts)
                at += len(own)

    def near(self, fps: np.ndarray, item: int) -> np.ndarray:
        """Which fingerprints are within the radius of an item's: by block first, then whole."""
        some = (_POPULAR[_blocks(fps) ^ self.blocks[item]] <= RADIUS // BLOCKS).any(axis=1)
        out = np.flatnonzero(some)
        return out[np.bitwise_count(fps[out] ^ self.fps[item]) <= RADIUS]

    def matches(self, text: str | None) -> dict[int, tuple[float, int]]:
        """Of each item (by position) found in ``text``: the greatest similarity and the first word of that window."""
        words, best = words_of(text), {}
        for k, (keys, first, items, weights) in self.shingles.items():
            if len(words) < k:
                continue
            hashes = shingle_hashes(words, k)
            values = _values(hashes)
            at = np.minimum(np.searchsorted(keys, values), len(keys) - 1)
            hits = np.flatnonzero(keys[at] == values)
            if not len(hits):
                continue
            hits = hits[np.argsort(at[hits], kind="stable")]
            known, begin, times = np.unique(at[hits], return_index=True, return_counts=True)
            # items of which the text has enough, each shingle counted as often as the item has it
            n = first[known + 1] - first[known]
            of = np.repeat(first[known] - (np.cumsum(n) - n), n) + np.arange(n.sum())
            rough = np.bincount(items[of], np.minimum(np.repeat(times, n), weights[of]), len(self.ids))
            for i in np.flatnonzero((rough >= self.need) & (self.need > 0)).tolist():
                own, weight = self.weights[i]
                there = np.minimum(np.searchsorted(known, own), len(known) - 1)
                there[known[there] != own] = -1
                held = np.flatnonzero(there >= 0)
                kind = np.repeat(held, times[there[held]])
                place = np.concatenate([hits[begin[t] : begin[t] + times[t]] for t in there[held].tolist()])
                found = self._search(hashes, place, kind, weight, i, len(words))
                if found:
                    best[i] = found
        return best

    def _search(self, hashes: np.ndarray, place: np.ndarray, kind: np.ndarray, weight: np.ndarray, i: int, n_words: int) -> tuple[float, int] | None:
        """The best window of item i, whose shingles (``kind``) stand at ``place``, sorted by kind and place.

        Of the windows that hold enough of them, those near its fingerprint, compared exactly.
        """
        count = min(self.size[i], n_words) - self.length[i] + 1
        need = int(self.need[i])
        if len(place) < need:
            return None
        line = np.sort(place)
        # a window that starts at s holds enough places if the need-th from its first one is still in it
        tight = np.flatnonzero(line[need - 1 :] - line[: len(line) - need + 1] < count)
        low = np.maximum(0, line[tight + need - 1] - count + 1)
        high = np.minimum(line[tight], len(hashes) - count)
        fit = low <= high
        if not fit.any():
            return None
        share = _Overlaps(place, kind, weight, count)
        found = None
        for a, b in _merged(low[fit], high[fit]):
            for c in range(a, b + 1, _WINDOWS):
                starts = np.arange(c, min(b, c + _WINDOWS - 1) + 1)
                near = self.near(_window_prints(hashes, starts, count), i)
                if not len(near):
                    continue
                both = share(int(starts[0]), len(starts))[near]
                top = int(np.argmax(both))
                if both[top] >= need and (found is None or both[top] > found[0]):
                    found = (int(both[top]), int(starts[near[top]]))
        return found and (found[0] / self.total[i], found[1])


def _values(hashes: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(hashes).view(">u8").ravel().astype(np.uint64)


def _blocks(fps: np.ndarray) -> np.ndarray:
    return fps[:, None].astype(">u8").view(np.uint8).reshape(-1, BLOCKS)


def _merged(low: np.ndarray, high: np.ndarray) -> Iterator[tuple[int, int]]:
    """The union of intervals whose ends both rise, as intervals apart from each other."""
    if not len(low):
        return
    cut = np.flatnonzero(low[1:] > high[:-1] + 1) + 1
    yield from zip(low[np.r_[0, cut]].tolist(), high[np.r_[cut - 1, len(high) - 1]].tolist(), strict=True)


def _window_prints(hashes: np.ndarray, starts: np.ndarray, count: int) -> np.ndarray:
    """Fingerprints of the windows of ``count`` shingles at consecutive starts, from running sums of bits."""
    a, b = int(starts[0]), int(starts[-1]) + count
    sums = np.zeros((b - a + 1, 64), np.int32)
    np.cumsum(np.unpackbits(hashes[a:b], axis=1), axis=0, out=sums[1:])
    over = 2 * (sums[starts - a + count] - sums[starts - a]) > count
    return np.packbits(over, axis=1).view(">u8").ravel().astype(np.uint64)


class _Overlaps:
    """How many shingles windows of ``count`` share with an item, each as often as both have it.

    A place counts from when it enters a window until the window also holds, behind it, as many of its shingle as the
    item has: then a later one counts instead.
    """

    def __init__(self, place: np.ndarray, kind: np.ndarray, weight: np.ndarray, count: int):
        ahead = np.arange(len(place)) + weight[kind]
        inside = np.minimum(ahead, len(place) - 1)
        other = np.where((ahead < len(place)) & (kind[inside] == kind), place[inside], np.iinfo(np.int64).max // 2)
        low, high = place - count + 1, np.minimum(place, other - count)
        self.low, self.high = np.sort(low[low <= high]), np.sort(high[low <= high])

    def __call__(self, start: int, n: int) -> np.ndarray:
        """For the ``n`` windows from ``start`` on."""
        at = np.arange(start, start + n)
        return np.searchsorted(self.low, at, side="right") - np.searchsorted(self.high, at, side="left")


def _item_chunks(benchmark: DataFrame, at_once: int, letters: int) -> Iterator[list[tuple[int, str | None]]]:
    """The items in order, so many at once, or less where their texts make up over ``letters`` characters."""
    held: list[tuple[int, str | None]] = []
    size = 0
    for r in benchmark.select(F.col("item_id").cast("long"), "text").orderBy("item_id", "text").toLocalIterator():
        if held and (len(held) == at_once or size + len(r[1] or "") > letters):
            yield held
            held, size = [], 0
        held.append((r[0], r[1]))
        size += len(r[1] or "")
    if held:
        yield held


def contaminations(docs: DataFrame, benchmark: DataFrame, at_once: int = ITEMS_AT_ONCE, letters: int = LETTERS_AT_ONCE) -> DataFrame:
    """(doc_id, item_id, similarity, first_word): every item of ``benchmark`` (item_id, text) found in a document.

    Words are runs of ASCII letters, digits and non-ASCII characters, A-Z lower-cased; shingles have five words
    (items of fewer words: one shingle of all).  An item is found if a window of as many words as it has (a
    shorter document: all of it) holds at least 0.8 of the item's shingles, each counted as often as it occurs
    there.  Windows in which fewer places hold a shingle of the item cannot, and are not fingerprinted; all others
    are, those within 23 bits of the item become candidates, and candidates are verified exactly.  similarity and
    first_word are those of the best window, the first of equals.

    Null and empty texts and items find nothing; repeated rows and items are reported each, null ids as null; columns
    of other names are not looked at; empty tables give an empty table.  The work for an item in a text grows with
    the length of the text, not with the item's length times it.  Items are broadcast ``at_once`` at a time, or as
    many as ``letters`` characters hold, in as many passes as it takes; each pass is written before the next.
    """
    found = []
    columns = docs.select(F.col("doc_id").cast("long"), "text")
    schema = "doc_id long, item_id long, similarity double, first_word long"
    for items in _item_chunks(benchmark, at_once, letters):
        index = docs.sparkSession.sparkContext.broadcast(ItemIndex(items))

        def rows(slices: Iterator[dict], index=index) -> Iterator[dict]:
            of = index.value
            for x in slices:
                out = [(d, of.ids[i], s, w) for d, t in zip(x["doc_id"], x["text"], strict=True) for i, (s, w) in of.matches(t).items()]
                yield {c: [r[k] for r in out] for k, c in enumerate(("doc_id", "item_id", "similarity", "first_word"))}

        if found:
            found[-1] = written(found[-1], "contaminations")
        found.append(map_rows(columns, rows, schema))
    return reduce(DataFrame.unionByName, found) if found else docs.sparkSession.createDataFrame([], schema)


def decontaminate(docs: DataFrame, benchmark: DataFrame, at_once: int = ITEMS_AT_ONCE, letters: int = LETTERS_AT_ONCE) -> DataFrame:
    """``docs`` without the documents in which an item of ``benchmark`` is found; columns and other rows as they were."""
    first = True
    for items in _item_chunks(benchmark, at_once, letters):
        docs = docs if first else written(docs, "decontaminated")
        first = False
        index = docs.sparkSession.sparkContext.broadcast(ItemIndex(items))

        def clean(batches: Iterator[pa.RecordBatch], index=index) -> Iterator[pa.RecordBatch]:
            for b in batches:
                yield b.filter(pa.array([not index.value.matches(t.as_py()) for t in b.column("text")], pa.bool_()))

        docs = map_arrow(docs, clean, docs.schema)
    return docs


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return contaminations(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


#: Every window of every document against every item, without fingerprints.
OP5_SQL = r"""
WITH dw AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z0-9\x{80}-\x{10FFFF}]+') AS w FROM documents
), iw AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z0-9\x{80}-\x{10FFFF}]+') AS w FROM benchmark
), ip AS (
  SELECT item_id, w, len(w) AS n, least(5, len(w)) AS k, unnest(range(1, len(w) - least(5, len(w)) + 2)) AS i FROM iw WHERE len(w) > 0
), iwt AS (
  SELECT item_id, n, k, array_to_string(w[i:i + k - 1], ' ') AS g, count(*) AS weight FROM ip GROUP BY ALL
), tot AS (
  SELECT item_id, n, k, sum(weight) AS total FROM iwt GROUP BY ALL
), dp AS (
  SELECT doc_id, w, len(w) AS nd, k, unnest(range(1, len(w) - k + 2)) AS i FROM dw, (SELECT DISTINCT k FROM tot) WHERE len(w) >= k
), ds AS (
  SELECT doc_id, nd, k, i - 1 AS p, array_to_string(w[i:i + k - 1], ' ') AS g FROM dp
), hits AS (
  SELECT doc_id, item_id, nd, p, g, weight FROM ds JOIN iwt USING (k, g)
), cand AS (
  SELECT doc_id, item_id, any_value(nd) AS nd, any_value(total) AS total, least(any_value(n), any_value(nd)) - any_value(k) + 1 AS size, any_value(nd) - any_value(k) + 1 AS places
  FROM hits JOIN tot USING (item_id) GROUP BY doc_id, item_id HAVING count(*) * 5 >= any_value(total) * 4
), starts AS (
  SELECT *, unnest(range(0, places - size + 1)) AS s FROM cand
), shares AS (
  SELECT doc_id, item_id, s, total, sum(least(weight, n)) AS share FROM (
    SELECT st.doc_id, st.item_id, st.s, st.total, h.g, h.weight, count(*) AS n FROM starts st JOIN hits h ON h.doc_id = st.doc_id AND h.item_id = st.item_id AND h.p >= st.s AND h.p < st.s + st.size GROUP BY ALL
  ) GROUP BY ALL
)
SELECT doc_id, item_id, max(share) / any_value(total) AS similarity, arg_min(s, s - share * 1000000000) AS first_word
FROM shares WHERE share * 5 >= total * 4 GROUP BY doc_id, item_id
"""
