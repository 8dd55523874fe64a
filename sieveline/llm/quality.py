"""Quality rules in DataFrame functions alone: counts, and a hashed n-gram log-likelihood ratio of target and corpus."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sieveline.llm.tables import documents

WHITE = " \t\n\x0b\f\r"
_GAPS = r"[\x20\x09-\x0D]+"
BUCKETS = 10_000
#: n-grams are of word endings of so many characters.
ENDING = 3
#: Documents with a lower mean log ratio are not kept.
LEAST_RATIO = -0.5
#: Trusted ids up to which they are broadcast: 32 MB.
BROADCAST_IDS = 2_000_000
#: Bits of a position within a text, in longs that hold a hash above and a position below.
_POSITION = 20


def words(text: Column) -> Column:
    """The words of a text: runs of all but ASCII white space; an empty array for none."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(WHITE))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, _GAPS))


def with_repeated_words(df: DataFrame, w: str, out: str) -> DataFrame:
    """``df`` with a column ``out``: how many words of the array ``w`` stand in a run of three that occurs there twice or more.

    Hashes of the runs are sorted with their positions in one long each (44 bits and 20); equal neighbours are
    compared word by word.  Where two different runs share 44 bits, and in texts of 2^20 words or more, the runs
    themselves are sorted with their positions instead, so the count is exact for every text.  Each step is a
    projection of its own: a column that a lambda reads must be there, not be made anew per element.
    """
    low = F.lit((1 << _POSITION) - 1).cast("long")
    run = lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2))
    at = lambda x: x.bitwiseAND(low).cast("int")
    spots = F.when(F.size(w) >= 3, F.sequence(F.lit(0), F.size(w) - 3)).otherwise(F.array().cast("array<int>"))

    def same(x: Column, y: Column) -> Column:
        i, j = at(x), at(y)
        return (F.get(w, i) == F.get(w, j)) & (F.get(w, i + 1) == F.get(w, j + 1)) & (F.get(w, i + 2) == F.get(w, j + 2))

    def neighbours(of: str, equal) -> Column:
        return F.filter(of, lambda x, k: equal(x, F.get(of, k + 1)) | equal(x, F.get(of, k - 1)))

    small = F.size(w) < (1 << _POSITION)
    names = df.columns
    df = df.select("*", F.when(small, F.sort_array(F.transform(spots, lambda i: run(i).bitwiseAND(F.bitwise_not(low)).bitwiseOR(i.cast("long"))))).alias("_packed"))
    alike = lambda x, y: F.coalesce(F.shiftright(x, _POSITION) == F.shiftright(y, _POSITION), F.lit(False))
    df = df.select(*names, neighbours("_packed", alike).alias("_alike"))
    clash = F.size(F.filter("_alike", lambda x, k: alike(x, F.get("_alike", k + 1)) & ~same(x, F.get("_alike", k + 1)))) > 0
    df = df.select(*names, "_alike", (~small | clash).alias("_whole"))
    both = F.when(~F.col("_whole"), F.transform("_alike", at))
    text_of = lambda i: F.concat_ws(" ", F.get(w, i), F.get(w, i + 1), F.get(w, i + 2))
    df = df.select(*names, both.alias("_short"), F.when(F.col("_whole"), F.array_sort(F.transform(spots, lambda i: F.struct(text_of(i).alias("h"), i.alias("p"))))).alias("_pairs"))
    twin = lambda x, y: F.coalesce(x["h"] == y["h"], F.lit(False))
    df = df.select(*names, "_short", neighbours("_pairs", twin).alias("_long"))
    positions = F.sort_array(F.coalesce("_short", F.transform("_long", lambda x: x["p"])))
    covered = F.aggregate(
        positions,
        F.struct(F.lit(0).alias("n"), F.lit(-3).alias("last")),
        lambda acc, p: F.struct((acc["n"] + F.least(F.lit(3), p - acc["last"])).alias("n"), p.alias("last")),
    )
    return df.select(*names, covered["n"].cast("long").alias(out))


def repeated_lines(text: Column) -> Column:
    """How many lines with a word equal an earlier line."""
    lines = F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    return (F.size(lines) - F.size(F.array_distinct(lines))).cast("long")


def _grams(w: Column) -> Column:
    """Rows (a, b) of each word and the next (null after the last)."""
    return F.arrays_zip(w.alias("a"), F.slice(w, 2, F.greatest(F.size(w), F.lit(1))).alias("b"))


def _bucket(*parts: Column) -> Column:
    """The bucket of an n-gram of word endings."""
    return F.pmod(F.xxhash64(*parts), F.lit(BUCKETS)).cast("int")


@dataclass(frozen=True)
class RatioModel:
    """For each bucket the log of target probability over corpus probability."""

    ratios: tuple[float, ...]

    def column(self) -> Column:
        return F.split(F.lit(",".join(map(repr, self.ratios))), ",").cast("array<double>")


def fit(docs: DataFrame, target: DataFrame, broadcast_ids: int = BROADCAST_IDS) -> RatioModel:
    """Multinomials over hashed 1- and 2-grams of word endings: of all ``docs`` (doc_id, text), and of trusted ones.

    ``target`` (doc_id) names the trusted documents; all of them count, as does every document of the corpus.  Up to
    ``broadcast_ids`` ids are broadcast, more are joined by a shuffle.  Each bucket gets one count more, so that none
    is empty; without any trusted document all ratios are 0.  Repeated rows count each; null doc_ids are not trusted;
    null and empty texts count for nothing.
    """
    trusted = target.select("doc_id").filter("doc_id is not null").distinct().withColumn("trusted", F.lit(1))
    few = trusted.limit(broadcast_ids + 1).count() <= broadcast_ids
    marked = docs.select("doc_id", "text").join(F.broadcast(trusted) if few else trusted.hint("shuffle_hash"), "doc_id", "left")
    pairs = marked.select("trusted", F.inline(_grams(words(F.col("text")))).alias("a", "b"))
    pairs = pairs.select("trusted", *(F.right(c, F.lit(ENDING)).alias(c) for c in ("a", "b")))
    grams = pairs.select("trusted", F.explode(F.array(_bucket(F.col("a")), F.when(F.col("b").isNotNull(), _bucket(F.col("a"), F.col("b"))))).alias("bucket")).filter("bucket is not null")
    counts = grams.groupBy("bucket").agg(F.count("*").alias("n"), F.count("trusted").alias("m"))
    raw, own = [1.0] * BUCKETS, [1.0] * BUCKETS
    for r in counts.collect():
        raw[r["bucket"]] += r["n"]
        own[r["bucket"]] += r["m"]
    if sum(own) == BUCKETS:
        return RatioModel((0.0,) * BUCKETS)
    from math import log

    shift = log(sum(own) / sum(raw))
    return RatioModel(tuple(round(log(a / b) - shift, 6) for a, b in zip(own, raw, strict=True)))


def _mean_ratio(ends: Column, model: RatioModel) -> Column:
    """The mean log ratio of the n-grams of an array of word endings; null for none.

    Summed up within the row: exploded and grouped again, each row would pass a shuffle, and results would be in as
    many files as that has parts.
    """
    table = model.column()

    def both(a: Column, b: Column) -> Column:
        two = F.when(b.isNotNull(), F.get(table, _bucket(a, b)))
        return F.get(table, _bucket(a)) + F.coalesce(two, F.lit(0.0))

    n = F.size(ends)
    each = F.zip_with(ends, F.slice(ends, 2, F.greatest(n, F.lit(1))), both)
    return F.when(n > 0, F.aggregate(each, F.lit(0.0), lambda total, x: total + x) / (2 * n - 1))


def rate(docs: DataFrame, model: RatioModel, least: float = LEAST_RATIO) -> DataFrame:
    """Counts and verdict of every row of ``docs`` (doc_id, text).

    doc_id, n_words, word_chars (code points in words), n_symbols (of #*$%&|<>), n_dup_lines, n_repeat_words,
    base_failed (fewer than 50 words, or over half of them in repeated runs), ratio (mean log ratio of the
    n-grams, null for none), kept (not base_failed, and a ratio of at least ``least``).  Null and empty texts have
    no words and fail.  Each row is rated by itself and by its whole text, repeated rows and null doc_ids too; columns
    of other names are not looked at; an empty table gives an empty table.
    """
    text, w = F.col("text"), F.col("w")
    counted = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", words(text).alias("w"))
    counted = with_repeated_words(counted, "w", "n_repeat_words").select(
        "doc_id",
        F.transform(w, lambda x: F.right(x, F.lit(ENDING))).alias("ends"),
        F.size(w).cast("long").alias("n_words"),
        F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
        F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
        repeated_lines(text).alias("n_dup_lines"),
        "n_repeat_words",
    )
    names = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    sums = counted.select(*names, _mean_ratio(F.col("ends"), model).alias("ratio"))
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return sums.withColumn("base_failed", failed).withColumn("kept", ~failed & F.coalesce(F.round("ratio", 9) >= least, F.lit(False)))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return rate(docs, fit(docs, labels.filter("quality = 1"))).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "ratio")
