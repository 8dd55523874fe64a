"""Toxicity from a weighted lexicon, matched by Aho-Corasick on folded text."""

from __future__ import annotations

import re
import unicodedata
import zlib
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sieveline.llm.arrow import map_arrow, map_rows
from sieveline.llm.tables import documents
from sieveline.storage import written

THRESHOLD = 0.7
#: Letters of other scripts that look like Latin ones.
HOMOGLYPHS = str.maketrans("авекмнорстухіјѕԁɡԛԝαβεικνορτυχϲ", "abekmhopctyxijsdgqwabeiknoptuxc")
#: Digits and signs that stand for letters inside a word.
SUBSTITUTES = str.maketrans("013457@$!|", "oieastasil")
#: Phrases in which a term is not meant as an insult; a hit inside one does not count.
EXCEPTIONS = ("trash can", "trash bin", "trash bag", "clown fish", "pond scum", "disgusting smell", "stupid mistake of mine")
_INNER = re.compile(r"(?<=[a-z])[013457@$!|]+(?=[a-z])|(?<![^\s\"'(])[013457@$]+(?=[a-z][a-z0-9@$!|]*[a-z])")
_BREAKS = re.compile(r"[\W\d_]+")
#: Lengths of the word beginnings that may become terms, beside whole words.
BEGINNINGS = (4, 5, 6, 7, 8)


def fold(text: str | None) -> str:
    """Words of ``text``, lower case and folded, with one space before, between and after them."""
    t = (text or "").lower()
    if not t.isascii():
        t = unicodedata.normalize("NFKC", t).translate(HOMOGLYPHS)
    t = _INNER.sub(lambda m: m[0].translate(SUBSTITUTES), t)
    return f" {_BREAKS.sub(' ', t).strip()} "


def terms_of(folded: str) -> dict[str, int]:
    """Whole words as ' word ' and beginnings of longer words as ' begin', each with the neighbours it has.

    Neighbours are a set of 63 bits, one set for each hash of the words before and after: few bits say that a
    term always stands in the same place, as words of copied passages do.
    """
    words = folded.split()
    out: dict[str, int] = {}
    for before, w, after in zip(["", *words], words, [*words[1:], ""]):  # noqa: B905
        bit = 1 << zlib.crc32(f"{before} {after}".encode("utf-8", "replace")) % 63
        whole = f" {w} "
        out[whole] = out.get(whole, 0) | bit
        for n in BEGINNINGS:
            if len(w) <= n:
                break
            t = whole[: n + 1]
            out[t] = out.get(t, 0) | bit
    return out


@dataclass(frozen=True)
class Lexicon:
    """Terms with weights, exception phrases, and a logistic curve over what they give for a text."""

    terms: dict[str, float]
    exceptions: tuple[str, ...]
    curve: tuple[float, ...]

    def automaton(self) -> ahocorasick.Automaton:
        found = ahocorasick.Automaton()
        for term, weight in self.terms.items():
            found.add_word(term, (len(term), weight))
        for phrase in self.exceptions:
            found.add_word(f" {phrase} ", (len(phrase) + 2, None))
        if len(found):
            found.make_automaton()
        return found

    @staticmethod
    def features(automaton, text: str | None) -> tuple[float, float, float]:
        """Greatest weight, log of the sum of weights, and the sum per 10 words; of all hits outside exception phrases.

        Of terms that start at one place the greatest weight counts.
        """
        folded = fold(text)
        hits: dict[int, float] = {}
        spared: list[tuple[int, int]] = []
        if len(automaton):
            for end, (size, weight) in automaton.iter(folded):
                start = end - size + 1
                if weight is None:
                    spared.append((start, end))
                else:
                    hits[start] = max(weight, hits.get(start, 0.0))
        if spared:
            free, reach = {}, -1
            phrases = iter([*sorted(spared), (len(folded), len(folded))])
            a, b = next(phrases)
            for start in sorted(hits):
                while a <= start:
                    reach = max(reach, b)
                    a, b = next(phrases)
                if start >= reach:
                    free[start] = hits[start]
            hits = free
        total = sum(hits.values())
        words = folded.count(" ") - 1
        return max(hits.values(), default=0.0), float(np.log1p(total)), 10.0 * total / max(1, words)

    def score(self, x: np.ndarray) -> np.ndarray:
        z = x @ np.array(self.curve[1:]) + self.curve[0]
        return 1.0 / (1.0 + np.exp(-np.clip(z, -30, 30)))


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, steps: int = 100) -> tuple[float, ...]:
    """Coefficients, the constant first, by Newton's method with halved steps; the ridge keeps separable rows finite."""
    a = np.c_[np.ones(len(x)), x]
    keep = np.r_[1e-3, np.full(x.shape[1], ridge)]

    def loss(w):
        z = a @ w
        return np.sum(np.logaddexp(0, z) - y * z) + 0.5 * keep @ w**2

    w = np.zeros(a.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        step = np.linalg.solve((a * (p * (1 - p))[:, None]).T @ a + np.diag(keep), a.T @ (p - y) + keep * w)
        size, now = 1.0, loss(w)
        while size > 1e-6 and loss(w - size * step) > now:
            size /= 2
        w = w - size * step
        if np.abs(size * step).max() < 1e-8:
            break
    return tuple(map(float, w))


def _log_odds(toxic: float, clean: float, n1: int, n0: int) -> float:
    return float(np.log((toxic + 0.5) / (n1 + 1.0)) - np.log((clean + 0.5) / (n0 + 1.0)))


def choose(counts: dict[str, tuple[int, int]], n1: int, n0: int, least_docs: int, least_weight: float) -> dict[str, float]:
    """Terms with weights from rows (toxic, clean) that hold them.

    A beginning that one or two longer terms explain gives way to them; else it replaces those that do not say
    more than it does, and stays only for what the others leave.
    """
    chosen: dict[str, float] = {}
    under: dict[str, set[str]] = defaultdict(set)  # the chosen terms below each beginning
    for t in sorted(counts, key=lambda t: (-len(t), t)):
        toxic, clean = counts[t]
        weight = _log_odds(toxic, clean, n1, n0)
        own = sorted(c for c in under[t] if c in chosen)
        top = [c for c in own if not any(c != o and c.startswith(o) for o in own)]
        if 0 < len(top) <= 2 and sum(counts[c][0] for c in top) >= 0.9 * toxic:
            continue
        longer = [c for c in own if chosen[c] > weight + 0.5]
        for c in longer:
            if not any(c != o and c.startswith(o) for o in longer):
                toxic, clean = toxic - counts[c][0], clean - counts[c][1]
        if toxic >= least_docs and _log_odds(toxic, max(0, clean), n1, n0) >= least_weight:
            if not longer:
                for c in own:
                    del chosen[c]
            chosen[t] = weight
            for n in BEGINNINGS:
                if n + 1 < len(t):
                    under[t[: n + 1]].add(t)
    return chosen


def learn(docs: DataFrame, labels: DataFrame, per_class: int = 6000, least_docs: int = 5, least_weight: float = 3.0, least_places: int = 5, exceptions: tuple[str, ...] = EXCEPTIONS) -> Lexicon:
    """A lexicon from labelled rows: ``docs`` (doc_id, text), ``labels`` (doc_id, toxic).

    At most ``per_class`` labelled rows of each class are used, those with the least hash of doc_id: this bounds
    the work, the terms and what is broadcast, whatever the size of the corpus.  A term is a word or the beginning of one
    that at least ``least_docs`` toxic rows of the sample hold, in at least ``least_places`` different
    neighbourhoods, with log-odds of ``least_weight`` or more.  Of a row with several labels the greatest counts;
    labels or doc_ids that are null are left out.  Without toxic rows the lexicon is empty and every score low.
    """
    own = labels.filter("toxic is not null and doc_id is not null").groupBy("doc_id").agg(F.max("toxic").alias("y"))
    picks = [own.filter(F.col("y") > 0).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class), own.filter(F.col("y") <= 0).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class)]
    sample = docs.select("doc_id", "text").join(F.broadcast(picks[0].unionByName(picks[1]).select("doc_id", (F.col("y") > 0).cast("int").alias("y"))), "doc_id")

    def count(slices: Iterator[dict]) -> Iterator[dict]:
        for x in slices:
            found: dict[str, list[int]] = {"": [0, 0, 0]}
            for text, y in zip(x["text"], x["y"], strict=True):
                found[""][1 - y] += 1
                for term, places in terms_of(fold(text)).items():
                    at = found.setdefault(term, [0, 0, 0])
                    at[1 - y] += 1
                    at[2] |= places if y else 0
            yield {"term": list(found), **{k: [v[i] for v in found.values()] for i, k in enumerate(("toxic", "clean", "places"))}}

    counted = map_rows(sample, count, "term string, toxic long, clean long, places long")
    sums = written(counted.groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"), F.bit_or("places").alias("places")), "terms")
    sizes = sums.filter("term = ''").first()
    n1, n0 = (sizes["toxic"], sizes["clean"]) if sizes else (0, 0)
    weight = F.log((F.col("toxic") + 0.5) / (n1 + 1.0)) - F.log((F.col("clean") + 0.5) / (n0 + 1.0))
    best = sums.filter((F.col("term") != "") & (F.col("toxic") >= least_docs) & (F.bit_count("places") >= least_places) & (weight >= least_weight))
    found = {r["term"]: (r["toxic"], r["clean"]) for r in best.collect()}
    terms = choose(found, n1, n0, least_docs, least_weight)
    draft = Lexicon(terms, exceptions, (0.0, 0.0, 0.0, 0.0))

    def rate(slices: Iterator[dict]) -> Iterator[dict]:
        automaton = draft.automaton()
        for x in slices:
            f = [draft.features(automaton, t) for t in x["text"]]
            yield {"y": x["y"], "a": [v[0] for v in f], "b": [v[1] for v in f], "c": [v[2] for v in f]}

    fit = map_rows(sample, rate, "y int, a double, b double, c double").collect() if terms else []
    if not fit or not 0 < sum(r["y"] for r in fit) < len(fit):
        return Lexicon(terms, exceptions, (-4.0, 1.0, 0.0, 0.0) if terms else (-4.0, 0.0, 0.0, 0.0))
    return Lexicon(terms, exceptions, _logistic(np.array([[r["a"], r["b"], r["c"]] for r in fit]), np.array([r["y"] for r in fit], float)))


def score(docs: DataFrame, lexicon: Lexicon) -> DataFrame:
    """``docs`` with toxicity (0 to 1), each row by its whole text alone.

    Null and empty texts have no hits; repeated rows and null doc_ids are rows like any; a column named toxicity is
    replaced and all others are kept; an empty table gives an empty table.
    """
    held = [c for c in docs.columns if c != "toxicity"]

    def rows(batches):
        import pyarrow as pa

        automaton = lexicon.automaton()
        for b in batches:
            x = np.array([lexicon.features(automaton, t.as_py()) for t in b.column("text")]).reshape(-1, 3)
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in held), pa.array(lexicon.score(x))], names=[*held, "toxicity"])

    schema = docs.select(*held).schema.add("toxicity", "double")
    return map_arrow(docs.select(*held), rows, schema)


def fold_of(doc_id):
    """The remainder that sets rows aside: crc32 of the doc_id's text, modulo 3."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3


def learn_from_tables(spark: SparkSession, sf_dir: str) -> Lexicon:
    """The lexicon that op10 and the pipeline use: labels of rows that are not held out, texts of all documents."""
    docs = documents(spark, sf_dir).select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    return learn(docs.filter(fold_of("doc_id") != 1), labels.filter(fold_of("doc_id") != 1))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    lexicon = learn_from_tables(spark, sf_dir)
    docs = documents(spark, sf_dir).select("doc_id", "text")
    scored = score(docs, lexicon)
    return scored.select("doc_id", (fold_of("doc_id") == 1).alias("held_out"), F.col("toxicity").alias("score"), (F.col("toxicity") >= THRESHOLD).cast("int").alias("predicted"))
