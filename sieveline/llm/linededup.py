"""Reversible line dedup: sharded cuckoo filters in front of exact reference counts."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sieveline.llm.arrow import ASCII_LOWER, columns_of, map_arrow, map_rows, unused
from sieveline.llm.cuckoo import CuckooFilter
from sieveline.llm.tables import documents
from sieveline.skew import join_unique
from sieveline.storage import written

MIN_CHARS = 10
_KEY = ["k1", "k2"]


def line_keys(text: str | None, min_chars: int = MIN_CHARS) -> list[bytes | None]:
    """For each line: a 128-bit hash of its key (ASCII white space stripped, A-Z lower-cased), None for keys that are too short."""
    out: list[bytes | None] = []
    for line in (text or "").encode("utf-8", "surrogatepass").translate(ASCII_LOWER).split(b"\n"):
        key = line.strip()
        long = len(key) >= min_chars and (len(key) >= 4 * min_chars or len(key.decode("utf-8", "surrogatepass")) >= min_chars)
        out.append(xxhash.xxh3_128_digest(key) if long else None)
    return out


def postings(docs: DataFrame, shards: int, min_chars: int = MIN_CHARS) -> DataFrame:
    """(shard, k1, k2, doc_id): the distinct keys of every document."""

    def rows(slices: Iterator[dict]) -> Iterator[dict]:
        for x in slices:
            keys = [set(line_keys(t, min_chars)) - {None} for t in x["text"]]
            found = np.frombuffer(b"".join(b"".join(k) for k in keys), "<i8").reshape(-1, 2)
            yield {"shard": (found[:, 0] & (shards - 1)).astype(np.int32), "k1": found[:, 0], "k2": found[:, 1], "doc_id": np.repeat(np.array(x["doc_id"], np.int64), [len(k) for k in keys])}

    return map_rows(docs.select(F.col("doc_id").cast("long"), "text").filter("doc_id is not null"), rows, "shard int, k1 long, k2 long, doc_id long")


def _summed(k1, k2, n, first, last):
    """One row per key: counts added, least and greatest document."""
    order = np.lexsort((k2, k1))
    k1, k2, n, first, last = (a[order] for a in (k1, k2, n, first, last))
    at = np.flatnonzero(np.r_[True, (k1[1:] != k1[:-1]) | (k2[1:] != k2[:-1])]) if len(k1) else np.empty(0, np.int64)
    if not len(at):
        return k1, k2, n, first, last
    return k1[at], k2[at], np.add.reduceat(n, at), np.minimum.reduceat(first, at), np.maximum.reduceat(last, at)


_PARTIAL = "shard int, k1 long, k2 long, n long, first long, last long"


def _partial(batches: Iterator[pa.RecordBatch], at_once: int = 1 << 16) -> Iterator[pa.RecordBatch]:
    """Sum before the shuffle, so many rows at a time: a line that is everywhere leaves one row for each of these."""
    held, count = [], 0

    def summed() -> pa.RecordBatch:
        shard, k1, k2, doc = (np.concatenate([b.column(c).to_numpy() for b in held]) for c in ("shard", "k1", "k2", "doc_id"))
        out = _summed(k1, k2, np.ones(len(k1), np.int64), doc, doc)
        own = _shards(out[0], k1, shard) if len(shard) else np.zeros(0, np.int32)
        return pa.RecordBatch.from_arrays([pa.array(own), *map(pa.array, out)], names=["shard", "k1", "k2", "n", "first", "last"])

    for b in batches:
        held.append(b)
        count += b.num_rows
        if count >= at_once:
            yield summed()
            held, count = [], 0
    if count:
        yield summed()


def _shards(keys: np.ndarray, k1: np.ndarray, shard: np.ndarray) -> np.ndarray:
    order = np.argsort(k1, kind="stable")
    return shard[order][np.searchsorted(k1[order], keys)]


_SHARD_OUT = "shard int, k1 long, k2 long, n long, first long, seen boolean, filter binary"


def _insert_shard(new: pa.Table, old: pa.Table) -> pa.Table:
    """Keys of a batch in one shard against the shard's filter: keys it has not seen are new for certain and go in."""
    arrays = [new.column(c).to_numpy() for c in ("k1", "k2", "n", "first", "last")]
    k1, k2, n, first, last = _summed(*arrays)
    blob = old.column("filter")[0].as_py() if old.num_rows else None
    shard = (new if new.num_rows else old).column("shard")[0].as_py()
    known = CuckooFilter.from_bytes(blob) if blob else CuckooFilter(len(k1))
    seen = known.contains(k1, k2)
    known.insert(k1[~seen], k2[~seen])
    out = seen | (first != last)
    m = int(out.sum()) + 1
    cut = lambda a, kind: pa.array([*a[out].tolist(), None], kind)
    return pa.Table.from_arrays(
        [pa.array([shard] * m, pa.int32()), cut(k1, pa.int64()), cut(k2, pa.int64()), cut(n, pa.int64()), cut(first, pa.int64()), cut(seen, pa.bool_()), pa.array([None] * (m - 1) + [known.to_bytes()], pa.binary())],
        names=["shard", "k1", "k2", "n", "first", "seen", "filter"],
    )


def _delete_shard(gone: pa.Table, old: pa.Table) -> pa.Table:
    shard = (gone if gone.num_rows else old).column("shard")[0].as_py()
    known = CuckooFilter.from_bytes(old.column("filter")[0].as_py()) if old.num_rows else CuckooFilter()
    known.delete(gone.column("k1").to_numpy(), gone.column("k2").to_numpy())
    return pa.Table.from_arrays([pa.array([shard], pa.int32()), pa.array([known.to_bytes()], pa.binary())], names=["shard", "filter"])


def _add_shard(missed: pa.Table, old: pa.Table) -> pa.Table:
    """The shard's filter with keys that it seemed to know."""
    known = CuckooFilter.from_bytes(old.column("filter")[0].as_py())
    known.insert(missed.column("k1").to_numpy(), missed.column("k2").to_numpy())
    return pa.Table.from_arrays([pa.array([old.column("shard")[0].as_py()], pa.int32()), pa.array([known.to_bytes()], pa.binary())], names=["shard", "filter"])


@dataclass(frozen=True)
class LineIndex:
    """The lines of a corpus, open to insertion and deletion of documents.

    postings (shard, k1, k2, doc_id) has the keys of each document; refs (k1, k2, n, first) is the exact
    reference count, with the smallest holder, of every key that two or more documents hold; filters has a
    cuckoo filter of all present keys for each shard.  A key that its shard's filter does not know is new and
    costs no lookup; for keys that it may know the counts are taken exactly, and those that no document holds go in
    too, so that each present key has a mark of its own to delete.  A key that is present but not in refs has count 1.  All three are tables in the shared folder; an operation returns a new index and leaves
    the old one as it was.  Shards are ranges of the hash, so they are even; ``shards`` (a power of two) should
    be chosen so that one shard's keys fit a task.
    """

    spark: SparkSession
    shards: int
    postings: DataFrame
    refs: DataFrame
    filters: DataFrame
    empty: bool = True

    @classmethod
    def create(cls, spark: SparkSession, shards: int = 512) -> LineIndex:
        if shards & (shards - 1):
            raise ValueError("shards must be a power of two")
        table = lambda schema: spark.createDataFrame([], columns_of(schema))
        return cls(spark, shards, table("shard int, k1 long, k2 long, doc_id long"), table("k1 long, k2 long, n long, first long"), table("shard int, filter binary"))

    def _count(self, of: DataFrame) -> DataFrame:
        sums = of.groupBy(*_KEY).agg(F.count("*").alias("n"), F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
        return sums.filter("first <> last").drop("last")

    def insert(self, docs: DataFrame) -> LineIndex:
        """With the documents of ``docs`` (doc_id, text).

        A document that is in already, or several rows of one doc_id, is one document with all their lines: each
        key of it counts once.
        """
        new = postings(docs, self.shards)
        if not docs.filter("doc_id is not null").groupBy("doc_id").count().filter("count > 1").isEmpty():
            new = new.distinct()
        if not self.empty:
            new = new.join(self.postings.select(*_KEY, "doc_id"), [*_KEY, "doc_id"], "left_anti").select("shard", *_KEY, "doc_id")
        new = written(new, "postings")
        partial = map_arrow(new, _partial, _PARTIAL)
        out = written(partial.groupBy("shard").cogroup(self.filters.groupBy("shard")).applyInArrow(_insert_shard, _SHARD_OUT), "shards")
        filters = out.filter("filter is not null").select("shard", "filter")
        fresh = out.filter("not seen").select(*_KEY, "n", "first")
        if self.empty:
            return replace(self, postings=new, refs=fresh, filters=filters, empty=False)
        both = self.postings.unionByName(new)
        again = out.filter("seen").select(*_KEY)
        missed = written(out.filter("seen").select("shard", *_KEY).join(self.postings.select(*_KEY), _KEY, "left_anti").select("shard", *_KEY), "missed")
        filters = written(missed.groupBy("shard").cogroup(filters.groupBy("shard")).applyInArrow(_add_shard, "shard int, filter binary"), "filters")
        recounted = self._count(both.join(again, _KEY, "left_semi"))
        refs = written(self.refs.join(again, _KEY, "left_anti").unionByName(fresh).unionByName(recounted), "refs")
        return replace(self, postings=both, refs=refs, filters=filters)

    def delete(self, ids: DataFrame) -> LineIndex:
        """Without the documents in ``ids`` (doc_id): as if they had never been inserted."""
        ids = ids.select(F.col("doc_id").cast("long")).distinct()
        gone = written(self.postings.join(ids, "doc_id", "left_semi").select("shard", *_KEY).distinct(), "gone")
        rest = written(self.postings.join(ids, "doc_id", "left_anti").select("shard", *_KEY, "doc_id"), "postings")
        left = rest.join(gone.select(*_KEY), _KEY, "left_semi")
        refs = written(self.refs.join(gone.select(*_KEY), _KEY, "left_anti").unionByName(self._count(left)), "refs")
        dead = gone.join(left.select(*_KEY).distinct(), _KEY, "left_anti").select("shard", *_KEY)
        filters = written(dead.groupBy("shard").cogroup(self.filters.groupBy("shard")).applyInArrow(_delete_shard, "shard int, filter binary"), "filters")
        return replace(self, postings=rest, refs=refs, filters=filters)

    def dropped(self) -> DataFrame:
        """(doc_id, drop): the keys that each document loses, those of which another document is the first holder."""
        refs = self.refs.select(*_KEY, "first", "n")
        lost = join_unique(self.postings.select(*_KEY, "doc_id"), refs, _KEY, "n", self.postings.count()).filter("doc_id <> first")
        return lost.groupBy("doc_id").agg(F.collect_list(F.struct(*_KEY)).alias("drop"))

    def deduplicate(self, docs: DataFrame) -> DataFrame:
        """``docs`` with text replaced by the lines that stay, and n_lines, n_dropped; all other columns as they are."""
        held = [c for c in docs.columns if c not in ("n_lines", "n_dropped")]
        gone_id, lost_keys = unused("gone_id", held), unused("lost_keys", held)
        drops = self.dropped().withColumnsRenamed({"doc_id": gone_id, "drop": lost_keys})
        joined = docs.select(*held).join(drops.hint("shuffle_hash"), F.col("doc_id") == F.col(gone_id), "left").drop(gone_id)
        schema = columns_of("n_lines long, n_dropped long")
        for f in reversed(docs.select(*held).schema.fields):
            schema.fields.insert(0, f)
            schema.names.insert(0, f.name)

        def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for whole in batches:
                for at in range(0, whole.num_rows, 256):
                    b = whole.slice(at, 256)
                    texts, lines, gone = [], [], []
                    for text, drop in zip(b.column("text").to_pylist(), b.column(lost_keys).to_pylist(), strict=True):
                        own = (text or "").split("\n")
                        kept = own
                        if drop:
                            lost = {(d["k1"], d["k2"]) for d in drop}
                            keys = line_keys(text)
                            kept = [x for x, k in zip(own, keys, strict=True) if k is None or tuple(np.frombuffer(k, "<i8").tolist()) not in lost]
                        texts.append("\n".join(kept))
                        lines.append(len(own))
                        gone.append(len(own) - len(kept))
                    made = {"text": pa.array(texts, pa.string()), "n_lines": pa.array(lines, pa.int64()), "n_dropped": pa.array(gone, pa.int64())}
                    yield pa.RecordBatch.from_arrays([made[c] if c in made else b.column(c) for c in (*held, "n_lines", "n_dropped")], names=[*held, "n_lines", "n_dropped"])

        return map_arrow(joined, rows, schema)


def shards_for(docs: DataFrame, per_shard: int = 1 << 11) -> int:
    """A power of two, at least 512, that leaves about ``per_shard`` documents to a shard."""
    n = docs.count()
    return max(512, 1 << max(0, (n // per_shard)).bit_length())


def deduplicate_lines(docs: DataFrame) -> DataFrame:
    """Drop every line of at least 10 code points (stripped) that a document with a smaller doc_id holds too.

    Keys are lines stripped of ASCII white space with A-Z lower-cased.  All lines with such a key go, except in
    the smallest doc_id that holds it.  Null texts count as empty: one empty line.  Rows with a null doc_id are no
    documents: they lend no keys and lose no lines.  Repeated rows of a doc_id are one document: a line that only
    they hold stays in all of them.  Whole texts count, however long; an empty table gives an empty table.  Other columns
    are kept; columns named n_lines or n_dropped are replaced.
    """
    index = LineIndex.create(docs.sparkSession, shards_for(docs)).insert(docs)
    return index.deduplicate(docs)


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return deduplicate_lines(docs).select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


OP9_SQL = r"""
WITH lines AS (
  SELECT doc_id, unnest(range(len(parts))) AS pos, unnest(parts) AS line
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents)
), keyed AS (
  SELECT doc_id, pos, line, trim(translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS k
  FROM lines
), shared AS (
  SELECT k, min(doc_id) AS first FROM keyed WHERE length(k) >= 10 GROUP BY k HAVING count(DISTINCT doc_id) >= 2
), marked AS (
  SELECT keyed.doc_id, pos, line, coalesce(keyed.doc_id <> first, false) AS gone FROM keyed LEFT JOIN shared USING (k)
)
SELECT doc_id, count(*) AS n_lines, CAST(count(*) FILTER (gone) AS BIGINT) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""
