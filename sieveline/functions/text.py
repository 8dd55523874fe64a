"""Text measures as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Letters, digits and underscore: what counts as part of a word.
WORD = r"[\p{L}\p{N}_]+"
#: Fixed value: all white space, the control separators included.
SPACE = r"\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: Fixed value: punctuation that is not junk, for a character class.
PUNCTUATION = r"""\.,!\?;:'"\(\)\[\]\{\}\-\u2013\u2014/%\$&@#\*\+=<>~`\|\\"""
#: Code point ranges of scripts, in the order that breaks ties.
SCRIPTS = (
    ("zh", r"\u4e00-\u9fff"),
    ("ja", r"\u3040-\u30ff"),
    ("ko", r"\uac00-\ud7af"),
    ("ru", r"\u0400-\u04ff"),
    ("ar", r"\u0600-\u06ff"),
    ("en", r"A-Za-z"),
)


#: The characters of SPACE.
_SPACES = "".join(map(chr, (*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)))


def stripped(text: Column) -> Column:
    """The text without white space at both ends; null counts as empty.

    Only the ends are looked at: a pattern for the end of a text is tried at every space in it, each time the text is read.
    """
    return F.btrim(F.coalesce(text, F.lit("")), F.lit(_SPACES))


def words(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0))


def word_set(text: Column) -> Column:
    return F.array_distinct(words(F.coalesce(text, F.lit(""))))


def repeated_ngram_ratio(w: Column, n: int = 5) -> Column:
    """Share of n-grams of an array of words (or of their hashes, which is faster) that repeat an earlier one; 0 for n words or fewer.

    n-grams are told apart by a 64-bit hash: two of a text of 10,000 words share one with a chance of 3e-12.  The lambda
    reads nothing but its n-gram: were a filter to be pushed down with this expression in it, the words would be made
    a few times per row, not once per n-gram.
    """
    count = F.size(w) - (n - 1)
    shifted = F.arrays_zip(*(F.slice(w, F.lit(i + 1), F.greatest(count, F.lit(0))).alias(f"w{i}") for i in range(n)))
    grams = F.transform(shifted, lambda g: F.xxhash64(g))
    return F.when(count <= 1, F.lit(0.0)).otherwise((count - F.size(F.array_distinct(grams))) / count)


def word_hashes(text: Column) -> Column:
    """64-bit hashes of the words of a text, in order."""
    return F.transform(words(text), lambda w: F.xxhash64(w))


def junk_char_ratio(text: Column) -> Column:
    """Share of characters that are no letters, digits, white space or usual punctuation; 1 for an empty text.

    Runs of ASCII that is no junk go first: the class of all that is none is slow, and seldom has much left to look at.
    """
    rest = F.regexp_replace(text, r"[\x09-\x0d\x1c-\x5d\x5f-\x7e]+", "")
    junk = F.regexp_count(rest, F.lit(rf"[^\p{{L}}\p{{N}}_{SPACE}\u4e00-\u9fff{PUNCTUATION}]"))
    return F.when(F.length(text) == 0, F.lit(1.0)).otherwise(junk / F.length(text))


def script_counts(text: Column) -> dict[str, Column]:
    """Characters of each script.  All but Latin lie above U+0400: texts with nothing there are not looked through for each."""
    other = text.rlike(r"[\u0400-\u06ff\u3040-\ud7af]")
    counts = {lang: F.when(other, F.regexp_count(text, F.lit(f"[{chars}]"))).otherwise(F.lit(0)) for lang, chars in SCRIPTS if lang != "en"}
    latin = dict(SCRIPTS)["en"]
    counts["en"] = F.length(text) - F.length(F.regexp_replace(text, f"[{latin}]+", ""))
    return {lang: counts[lang] for lang, _ in SCRIPTS}


def script_language(counts: dict[str, Column]) -> tuple[Column, Column]:
    """Language of the script with most characters (the first of equals; null for none) and its share."""
    total = sum(counts.values(), F.lit(0))
    most = F.greatest(*counts.values())
    lang = F.when(total == 0, F.lit(None).cast("string"))
    for name, n in counts.items():
        lang = lang.when(n == most, F.lit(name))
    return lang, F.when(total == 0, F.lit(0.0)).otherwise(most / total)


def jaccard(a: Column, b: Column) -> Column:
    """Overlap of two arrays without repeats: 1 if both are empty, 0 if one is."""
    union = F.size(F.array_union(a, b))
    return F.when(union == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(a, b)) / union)
