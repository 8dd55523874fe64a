"""Licence scans: phrases, and an exact set-similarity join of text windows with licence templates."""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from math import ceil

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sieveline.llm.arrow import map_rows
from sieveline.llm.tables import documents

THRESHOLD = 0.9
_WORDS = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))

#: Phrases that name a licence.
PHRASES = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))

#: Statements by which texts place themselves under a licence, and the paragraphs of licence texts.
TEMPLATES = (
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction"),
    ("mit", "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software"),
    ("mit", "THE SOFTWARE IS PROVIDED AS IS, WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE"),
    ("mit", "Released under the MIT License"),
    ("apache", "Licensed under the Apache License, Version 2.0"),
    ("apache", "you may not use this file except in compliance with the License. You may obtain a copy of the License at"),
    ("apache", "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation"),
    ("gpl", "This work is licensed under the GNU General Public License, version 3"),
    ("gpl", "You should have received a copy of the GNU General Public License along with this program"),
    ("lgpl", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation"),
    ("lgpl", "You should have received a copy of the GNU Lesser General Public License along with this library"),
    ("agpl", "you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("bsd", "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer"),
    ("bsd", "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution"),
    ("bsd", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission"),
    ("bsd", "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS AS IS AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies"),
    ("zlib", "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions"),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("mpl", "If a copy of the MPL was not distributed with this file, You can obtain one at"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc-by-nc", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("cc0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work"),
    ("unlicense", "This is free and unencumbered software released into the public domain"),
    ("unlicense", "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means"),
)


def words_of(text: str | None) -> list[bytes]:
    """Runs of ASCII letters, digits and non-ASCII characters, A-Z lower-cased."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_WORDS).split()


@dataclass(frozen=True)
class Template:
    """A statement as a set of words in global order, rarest first; ``need`` of them must stand in a window."""

    label: str
    order: tuple[bytes, ...]
    need: int
    window: int

    @classmethod
    def of(cls, label: str, text: str, threshold: float, frequency: dict[bytes, int]) -> Template:
        words = words_of(text)
        order = tuple(sorted(set(words), key=lambda w: (frequency.get(w, 0), w)))
        return cls(label, order, ceil(threshold * len(order) - 1e-9), len(words) + len(words) // 4)

    def blocks(self, places: dict[bytes, list[int]], n: int) -> list[tuple[int, int, int]]:
        """(first word, last word, different words of the template) of every block of a text of ``n`` words, in order.

        Going through the text, a block ends the search for it where a window of ``window`` words first holds
        ``need`` of the words; it starts at the first word such a window needs and reaches to where the most words
        stand in the window that starts there.  The search goes on behind it, so blocks do not overlap, and every
        window that holds enough words overlaps one.  Any such window has one of the first len - need + 1 words in
        global order (prefix): only the neighbourhoods of those are looked at.  A text of fewer words than ``need``
        has no such window (length), and from the i-th word of the prefix on only the words behind it that the text
        has can count (position).
        """
        if n < self.need:
            return []
        have = [w in places for w in self.order]
        left = sum(have)
        near: list[list[int]] = []
        for i, w in enumerate(self.order[: len(self.order) - self.need + 1]):
            if left < self.need:
                break
            near += [[p - self.window + 1, p + self.window - 1] for p in places.get(w, ())]
            left -= have[i]
        merged: list[list[int]] = []
        for low, high in sorted(near):
            if merged and low <= merged[-1][1] + 1:
                merged[-1][1] = max(merged[-1][1], high)
            else:
                merged.append([low, high])
        found = []
        for low, high in merged:
            own = sorted((q, k) for k, w in enumerate(self.order) for q in _between(places.get(w, ()), low, high))
            if len({k for _, k in own}) >= self.need:
                found += self._sweep(own)
        return found

    def _sweep(self, near: list[tuple[int, int]]) -> Iterator[tuple[int, int, int]]:
        """The blocks among places (position, word of the template) in order of position."""
        low, held, i = 0, Counter(), 0
        while i < len(near):
            q, k = near[i]
            held[k] += 1
            while near[low][0] <= q - self.window or held[near[low][1]] > 1:
                held[near[low][1]] -= 1
                if not held[near[low][1]]:
                    del held[near[low][1]]
                low += 1
            i += 1
            if len(held) < self.need:
                continue
            start, words, end = near[low][0], set(held), i - 1
            for j in range(i, len(near)):
                if near[j][0] >= start + self.window or len(words) == len(self.order):
                    break
                if near[j][1] not in words:
                    words.add(near[j][1])
                    end = j
            yield start, near[end][0], len(words)
            i = low = end + 1
            held.clear()


def _between(places: list[int], low: int, high: int) -> list[int]:
    return places[bisect_left(places, low) : bisect_right(places, high)] if places else []


def vocabulary(templates=TEMPLATES) -> set[bytes]:
    return {w for _, t in templates for w in words_of(t)}


def frequencies(docs: DataFrame, templates=TEMPLATES) -> dict[bytes, int]:
    """In how many documents each word of the templates stands, over all documents; no more rows than the templates have words."""
    vocab = vocabulary(templates)

    def rows(slices: Iterator[dict]) -> Iterator[dict]:
        total: Counter = Counter()
        for x in slices:
            for t in x["text"]:
                total.update(vocab.intersection(words_of(t)))
        yield {"word": [w.decode("utf-8") for w in total], "n": list(total.values())}

    sums = map_rows(docs.select("text"), rows, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return {r["word"].encode(): r["n"] for r in sums.collect()}


def scan(docs: DataFrame, threshold: float = THRESHOLD, templates=TEMPLATES, phrases=PHRASES) -> DataFrame:
    """Licence phrases and template blocks of every text.

    doc_id, n_words, n_base (all places of phrases), first_word and last_word (least and greatest start, null if
    none), base_labels, labels (with those of templates; sorted arrays), score (the greatest share of a template's
    words found in a window, 1 for a phrase, 0 for nothing), blocks (label, first_word, last_word, share).
    A block lies in a window of a quarter more words than the template has and holds at least ``threshold`` of its
    different words; all blocks are found (:meth:`Template.blocks`).  Null and empty texts have no words.  Rows are
    independent of each other but for the order of words, which is by frequency in all of ``docs``, ties by the word;
    it changes where the search looks first, not what it finds.  Repeated rows and null doc_ids are rows like any;
    columns of other names are not looked at; whole texts are scanned; an empty table gives an empty table.
    """
    frequency = frequencies(docs, templates)
    made = [Template.of(label, text, threshold, frequency) for label, text in templates]
    sought = [(words_of(p), label) for p, label in phrases]
    prefix = {w for t in made for w in t.order[: len(t.order) - t.need + 1]} | {p[-2] for p, _ in sought}
    vocab = vocabulary(templates) | {w for p, _ in sought for w in p}

    def one(text: str | None):
        words = words_of(text)
        base, labels, base_labels, blocks = [], set(), set(), []
        if not prefix.isdisjoint(words):
            places: dict[bytes, list[int]] = {}
            for i, w in enumerate(words):
                if w in vocab:
                    places.setdefault(w, []).append(i)
            for phrase, label in sought:
                starts = [i for i in places.get(phrase[0], ()) if words[i : i + len(phrase)] == phrase]
                if starts:
                    base += starts
                    base_labels.add(label)
            for t in made:
                for a, b, n in t.blocks(places, len(words)):
                    blocks.append({"label": t.label, "first_word": a, "last_word": b, "share": n / len(t.order)})
                    labels.add(t.label)
        score = 1.0 if base else max((b["share"] for b in blocks), default=0.0)
        return len(words), len(base), min(base, default=None), max(base, default=None), sorted(base_labels), sorted(labels | base_labels), score, blocks

    names = ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "blocks")

    def rows(slices: Iterator[dict]) -> Iterator[dict]:
        for x in slices:
            found = [one(t) for t in x["text"]]
            yield {"doc_id": x["doc_id"]} | {c: [f[k] for f in found] for k, c in enumerate(names)}

    schema = "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels array<string>, labels array<string>, score double, blocks array<struct<label:string,first_word:long,last_word:long,share:double>>"
    return map_rows(docs.select(F.col("doc_id").cast("long"), "text"), rows, schema)


def op2_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan(documents(spark, sf_dir))
    joined = lambda c: F.array_join(c, ",").alias(c)
    return found.select("doc_id", "n_words", "n_base", "first_word", "last_word", joined("base_labels"), joined("labels"), "score")
