"""Packing of tokenised documents into sequences: shortest-pack-first over the length histogram."""

from __future__ import annotations

import os
import re
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sieveline.llm.arrow import map_arrow, map_rows
from sieveline.llm.tables import documents
from sieveline.storage import written

TOKENIZER = "word_bpe_49k.json"
END = 2
LENGTH = 4096
#: Pieces to a bucket in which ranks are given: with ids a piece takes up to 16 KB.
_ROWS, _ROWS_WITH_IDS = 50_000, 2_000


class Encoder:
    """Ids of whole texts by a word-level BPE tokenizer file, the same as the tokenizer's own, with words remembered.

    The tokenizer lower-cases, drops white space and treats every pre-token by itself.  Texts of a plain alphabet
    (printable ASCII, white space, Latin-1 letters), on which its normaliser only lower-cases, are cut into
    pre-tokens here; each new one goes to the tokenizer's BPE model.  Other texts are cut at ASCII white space,
    which no pre-token spans; chunks with other characters go to the whole tokenizer.  The memory of words is
    bounded by ``most`` entries: further words are encoded anew each time, with the same result.
    """

    PLAIN = re.compile(r"[\t-\r\x20-\x7e\xc0-\xff]*")
    PRE = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z\xdf-\xf6\xf8-\xff]+|[0-9]|[^\sa-z\xdf-\xf6\xf8-\xff0-9]+")
    CHUNK = re.compile(r"[^\t\n\r ]+")

    def __init__(self, path: str, most: int = 262_144):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.model = self.whole.model
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        others = [b for b in range(256) if b not in set(printable)]
        self.byte_names = {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(others)}
        self.most, self.words = most, {}

    def _word(self, word: str) -> bytes:
        named = "".join([self.byte_names[b] for b in word.encode()])
        ids = np.array([t.id for t in self.model.tokenize(named)], "<u4").tobytes()
        if len(self.words) < self.most:
            self.words[word] = ids
        return ids

    def _plain(self, text: str) -> bytes:
        get, word = self.words.get, self._word
        return b"".join([get(w) or word(w) for w in self.PRE.findall(text.lower())])

    def _all(self, text: str) -> bytes:
        return np.array(self.whole.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def __call__(self, text: str) -> np.ndarray:
        if "<|" in text:
            found = self._all(text)
        elif self.PLAIN.fullmatch(text):
            found = self._plain(text)
        else:
            found = b"".join([self._plain(c) if self.PLAIN.fullmatch(c) else self._all(c) for c in self.CHUNK.findall(text)])
        return np.frombuffer(found, "<u4")


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str | None = None) -> Encoder:
    """This process's encoder; kept between tasks, as Spark keeps its Python workers.  None: the public file."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path(TOKENIZER)
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def pieces(docs: DataFrame, length: int = LENGTH, end: int = END, path: str | None = None, with_ids: bool = False) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens[, ids]): each document's ids and ``end``, cut every ``length`` ids."""

    def rows(slices: Iterator[dict]) -> Iterator[dict]:
        encode = encoder(path)
        for x in slices:
            out: dict[str, list] = defaultdict(list, {k: [] for k in ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "ids")})
            for doc_id, text in zip(x["doc_id"], x["text"], strict=True):
                ids = np.append(encode(text or ""), np.uint32(end)).astype("<u4")
                for at in range(0, len(ids), length):
                    part = ids[at : at + length]
                    for k, v in (("doc_id", doc_id), ("start", at), ("length", len(part)), ("ids_crc32", zlib.crc32(part.tobytes())), ("doc_tokens", len(ids)), ("ids", part if with_ids else None)):
                        out[k].append(v)
            yield out

    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long" + ", ids array<int>" * with_ids
    return map_rows(docs.select(F.col("doc_id").cast("long"), "text"), rows, schema)


def plan_packs(histogram: dict[int, int], length: int = LENGTH) -> list[tuple[int, tuple[int, ...]]]:
    """Packing patterns (how often, lengths): shortest-pack-first over a histogram of lengths.

    Lengths are placed longest first.  Those of one length go to the open packs with the most room, pattern by
    pattern: a pattern's count is split into those that take one and those that do not.  When no open pack has
    room, new packs are opened with as many of this length as fit, so that one very common length fills its packs.
    The work depends on the number of patterns, not of documents.
    """
    room: dict[int, list[tuple[int, tuple[int, ...]]]] = defaultdict(list)
    for size in sorted(histogram, reverse=True):
        left, free = histogram[size], length
        while left:
            while free >= size and not room.get(free):
                free -= 1
            if free < size:
                each = length // size
                full, rest = divmod(left, each)
                if full:
                    room[length - each * size].append((full, (size,) * each))
                if rest:
                    room[length - rest * size].append((1, (size,) * rest))
                break
            count, pack = room[free].pop()
            take = min(count, left)
            if count > take:
                room[free].append((count - take, pack))
            room[free - size].append((take, (*pack, size)))
            left -= take
    return [x for packs in room.values() for x in packs]


def slots(packs: list[tuple[int, tuple[int, ...]]]) -> tuple[np.ndarray, ...]:
    """Where the r-th piece of a length goes: sorted keys length << 40 | first rank, with first sequence and offset.

    Also (size, first sequence, count, offset) in full; a run of ranks of one length covers one slot of a pattern.
    """
    next_rank: dict[int, int] = defaultdict(int)
    keys, sequence, offset = [], [], []
    base = 0
    for count, pack in packs:
        at = 0
        for size in pack:
            keys.append(size << 40 | next_rank[size])
            sequence.append(base)
            offset.append(at)
            next_rank[size] += count
            at += size
        base += count
    order = np.argsort(np.array(keys, np.int64), kind="stable")
    return tuple(np.array(a, np.int64)[order] for a in (keys, sequence, offset))


def ranked(parts: DataFrame, buckets: int) -> DataFrame:
    """``parts`` with rank, from 0 without gaps within each length.

    A length may hold any share of all rows, so it is dealt over ``buckets``; ranks within buckets are moved on
    by the number of rows in the buckets before.
    """
    key = F.pmod(F.xxhash64("doc_id", "start"), F.lit(buckets)).cast("int")
    within = Window.partitionBy("length", "bucket").orderBy("doc_id", "start", "ids_crc32")
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn("bucket", key)
    counts = parts.groupBy("length", "bucket").agg(F.count("*").alias("n"))
    counts = counts.select("length", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    own = parts.withColumn("within", F.row_number().over(within) - 1)
    return own.join(counts, ["length", "bucket"]).withColumn("rank", F.col("before") + F.col("within")).drop("bucket", "before", "within")


def pack(docs: DataFrame, length: int = LENGTH, end: int = END, path: str | None = None, with_ids: bool = False) -> DataFrame:
    """Every document's ids packed into sequences of at most ``length``: a row per piece.

    doc_id, start (the document's ids before it), length, ids_crc32, doc_tokens, [ids,] sequence_id, offset.
    A null text is empty: one piece with the end id alone.  Null doc_ids and repeated rows are documents like any
    other; pieces that are equal in doc_id, start and checksum may change places with each other.  Long texts are cut,
    every id of theirs lies in one piece.  Columns of other names are not looked at.  An empty table gives an empty table.  The histogram, of at most ``length`` rows, is planned on the
    driver; pieces are joined to the plan by their rank within their length.
    """
    parts = written(pieces(docs, length, end, path, with_ids), "pieces")
    histogram = {r["length"]: r["n"] for r in parts.groupBy("length").agg(F.count("*").alias("n")).collect()}
    plan = parts.sparkSession.sparkContext.broadcast(slots(plan_packs(histogram, length)))
    total = sum(histogram.values())
    names = [*parts.columns, "sequence_id", "offset"]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, sequence, offset = plan.value
        for b in batches:
            rank, size = b.column("rank").to_numpy(), b.column("length").to_numpy()
            at = np.searchsorted(keys, size << 40 | rank, side="right") - 1
            made = {"sequence_id": pa.array(sequence[at] + rank - (keys[at] & ((1 << 40) - 1))), "offset": pa.array(offset[at])}
            yield pa.RecordBatch.from_arrays([made[c] if c in made else b.column(c) for c in names], names=names)

    ranks = ranked(parts, max(16, total // (_ROWS_WITH_IDS if with_ids else _ROWS)))
    return map_arrow(ranks, place, parts.schema.add("sequence_id", "long").add("offset", "long"))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return pack(docs).select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
