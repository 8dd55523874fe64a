"""Language identification: first the family, then one-versus-one linear support vector machines within it."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sieveline.llm.arrow import map_rows
from sieveline.llm.tables import documents

UNKNOWN = "und"
#: Language families by language code; a code that is not here is a family of its own.
FAMILIES = {
    "germanic": "en de nl af sv da no nb nn is fo fy lb yi",
    "romance": "fr es pt it ro ca gl oc la",
    "slavic": "ru uk be bg mk sr hr bs sl cs sk pl",
    "baltic": "lt lv",
    "uralic": "fi et hu",
    "turkic": "tr az kk ky uz tt",
    "indo-aryan": "hi ur bn pa gu mr ne si",
    "dravidian": "ta te kn ml",
    "semitic": "ar he mt am",
    "sinitic": "zh yue wuu",
    "austronesian": "id ms jv tl",
}
_FAMILY = {code: family for family, codes in FAMILIES.items() for code in codes.split()}


def has_letter(text: str) -> bool:
    """Whether any character is a letter; fractions, numerals and other numbers are none."""
    return any(c.isalpha() for c in text)


def family_of(lang: str) -> str:
    return _FAMILY.get(re.split(r"[-_]", lang.lower())[0], lang)


def features(text: str, size: int, step: int = 1 << 20) -> np.ndarray:
    """Hashed counts of all runs of two and three bytes of the lower-cased text, damped and of length 1."""
    data = np.frombuffer(text.lower().encode("utf-8", "replace"), np.uint8)
    counts = np.zeros(size)
    shift = np.uint32(32 - (size.bit_length() - 1))
    for at in range(0, max(1, len(data) - 1), step):
        a = data[at : at + step + 2].astype(np.uint32)
        two = a[:-1] << np.uint32(8) | a[1:]
        three = two[:-1] << np.uint32(8) | a[2:]
        for codes, salt in ((two[:step], 0x9E3779B1), (three[:step], 0x85EBCA6B)):
            hashed = (codes + np.uint32(1)) * np.uint32(salt)
            counts += np.bincount((hashed ^ hashed >> np.uint32(15)) * np.uint32(0x2C1B3C6D) >> shift, minlength=size)
    x = np.sqrt(counts)
    norm = np.linalg.norm(x)
    return x / norm if norm else x


def svm(x: np.ndarray, y: np.ndarray, cost: float = 4.0, rounds: int = 60) -> np.ndarray:
    """Weights, the constant last, of a linear support vector machine (squared hinge) by dual coordinate descent; y is 1 or -1.

    Both classes weigh the same, however many rows each has.
    """
    a = np.c_[x, np.ones(len(x))]
    c = np.where(y > 0, cost * len(y) / (2 * max(1, (y > 0).sum())), cost * len(y) / (2 * max(1, (y < 0).sum())))
    w, alpha = np.zeros(a.shape[1]), np.zeros(len(y))
    diagonal = np.einsum("ij,ij->i", a, a) + 0.5 / c
    order = np.random.default_rng(0)
    for _ in range(rounds):
        moved = 0.0
        for i in order.permutation(len(y)):
            g = y[i] * (a[i] @ w) - 1 + 0.5 / c[i] * alpha[i]
            new = max(0.0, alpha[i] - g / diagonal[i])
            if new != alpha[i]:
                w += (new - alpha[i]) * y[i] * a[i]
                moved = max(moved, abs(new - alpha[i]))
                alpha[i] = new
        if moved < 1e-4:
            break
    return w


@dataclass(frozen=True)
class LanguageModel:
    """Families with one machine each against all others; pairs of languages of one family with one machine each."""

    size: int
    members: tuple[tuple[str, ...], ...]
    family: np.ndarray | None
    pairs: tuple[dict[tuple[int, int], np.ndarray], ...]

    @classmethod
    def fit(cls, x: np.ndarray, langs: list[str]) -> LanguageModel:
        by: dict[str, list[str]] = {}
        for lang in sorted(set(langs)):
            by.setdefault(family_of(lang), []).append(lang)
        members = tuple(tuple(v) for _, v in sorted(by.items()))
        own = np.array([next(i for i, m in enumerate(members) if lang in m) for lang in langs], int)
        tags = np.array(langs, object)
        family = np.stack([svm(x, np.where(own == i, 1.0, -1.0)) for i in range(len(members))]) if len(members) > 1 else None
        pairs = []
        for m in members:
            made = {}
            for i, j in combinations(range(len(m)), 2):
                rows = np.flatnonzero((tags == m[i]) | (tags == m[j]))
                made[i, j] = svm(x[rows], np.where(tags[rows] == m[i], 1.0, -1.0))
            pairs.append(made)
        return cls(x.shape[1], members, family, tuple(pairs))

    def predict(self, text: str | None) -> tuple[str, float]:
        """The language and a score from 0 to 1: how clear the narrowest decision on the way was."""
        if not text or not self.members or not has_letter(text):
            return UNKNOWN, 0.0
        x = np.append(features(text, self.size), 1.0)
        margins, at = [], 0
        if self.family is not None:
            values = self.family @ x
            at = int(values.argmax())
            margins.append(float(values[at] - np.partition(values, -2)[-2]) / 2)
        names = self.members[at]
        votes, sums = np.zeros(len(names)), np.zeros(len(names))
        for (i, j), w in self.pairs[at].items():
            v = float(w @ x)
            votes[i if v >= 0 else j] += 1
            sums[i] += v
            sums[j] -= v
        best = max(range(len(names)), key=lambda k: (votes[k], sums[k], -k))
        if len(names) > 1:
            margins.append(min(v if i == best else -v for (i, j), v in ((p, float(w @ x)) for p, w in self.pairs[at].items()) if best in (i, j)))
        return names[best], float(1 / (1 + np.exp(-4 * min(margins, default=1.0))))


def learn(docs: DataFrame, per_lang: int = 300, most_rows: int = 6000, size: int = 1 << 12) -> LanguageModel:
    """A model from rows (doc_id, text, lang) that have a language and a letter.

    At most ``per_lang`` rows of each language, those with the least hash of doc_id and text, and at most
    ``most_rows`` in all are used: fewer of each where there are many languages.  Their whole texts count.  A language
    may hold any share of the rows: a bound on the hash thins it out before its rows are ranked.
    """
    rows = docs.filter("lang is not null and text is not null")
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return LanguageModel(size, (), None, ())
    take = max(1, min(per_lang, most_rows // len(counts)))
    share = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 40)) / float(1 << 40)
    bound = F.lit(0.0)
    for lang, n in counts.items():
        bound = F.when(F.col("lang") == lang, F.lit(min(1.0, (3 * take + 50) / n))).otherwise(bound)
    thin = rows.select("lang", "text", share.alias("share")).filter(F.col("share") <= bound)
    ranked = thin.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy("share"))).filter(F.col("rank") <= take)

    def turn(slices: Iterator[dict]) -> Iterator[dict]:
        for x in slices:
            kept = [(lang, features(text, size).astype(np.float32)) for lang, text in zip(x["lang"], x["text"], strict=True) if has_letter(text)]
            yield {"lang": [k for k, _ in kept], "at": [np.flatnonzero(v).astype(np.int32).tobytes() for _, v in kept], "x": [v[v != 0].tobytes() for _, v in kept]}

    found = sorted(map_rows(ranked.select("lang", "text"), turn, "lang string, at binary, x binary").collect())
    if not found:
        return LanguageModel(size, (), None, ())
    x = np.zeros((len(found), size))
    for row, r in zip(x, found, strict=True):
        row[np.frombuffer(r["at"], np.int32)] = np.frombuffer(r["x"], np.float32)
    return LanguageModel.fit(x, [r["lang"] for r in found])


def identify(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """(doc_id, lang_pred, score) of every row from its whole text alone; 'und' and 0 for a text that is null or has no letter.

    Repeated rows and null doc_ids are rows like any; ties of languages go to the first by name within a family and to
    the first family by name; columns of other names are not looked at; an empty table gives an empty table.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def rows(slices: Iterator[dict]) -> Iterator[dict]:
        for x in slices:
            found = [shared.value.predict(t) for t in x["text"]]
            yield {"doc_id": x["doc_id"], "lang_pred": [f[0] for f in found], "score": [f[1] for f in found]}

    return map_rows(docs.select(F.col("doc_id").cast("long"), "text"), rows, "doc_id long, lang_pred string, score double")


def fold_of(doc_id):
    """The remainder that sets rows aside: crc32 of the doc_id's text, modulo 5."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5


def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text", "lang")
    model = learn(docs.filter(fold_of("doc_id") != 0))
    found = identify(docs, model)
    return found.select("doc_id", (fold_of("doc_id") == 0).alias("held_out"), "lang_pred", "score")
