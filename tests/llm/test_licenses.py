"""Licence scans against brute force over every window."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

licenses = pytest.importorskip("sieveline.llm.licenses")
DOCS = "doc_id long, text string"


def docs(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), DOCS)


def places_of(text):
    places = {}
    for i, w in enumerate(text):
        places.setdefault(w, []).append(i)
    return places


def test_phrases_and_templates(spark):
    texts = ["The MIT\nLicense. mit license", "Licensed under CC BY-NC 4.0.", "permission to use the license", None, "", "x " * 50 + "Licensed under the Apache License, Version 2.0."]
    got = licenses.scan(docs(spark, texts)).orderBy("doc_id").collect()
    assert [(r["n_words"], r["n_base"], r["first_word"], r["last_word"]) for r in got[:2]] == [(5, 2, 1, 3), (7, 0, None, None)]
    assert got[1]["labels"] == ["cc-by-nc"] and got[1]["base_labels"] == []
    assert got[2]["labels"] == [] and got[2]["score"] == 0.0
    assert [r["n_words"] for r in got[3:5]] == [0, 0]
    assert got[5]["base_labels"] == ["apache"] and got[5]["blocks"][0]["first_word"] >= 50


def test_blocks_cover_every_window_that_holds_enough():
    dice = random.Random(5)
    vocab = [b"a", b"b", b"c", b"d", b"e", b"f", b"x", b"y"]
    t = licenses.Template.of("t", "a b c d e f", 0.8, {b"a": 9, b"b": 1})
    for _ in range(2000):
        text = [dice.choice(vocab) for _ in range(dice.randrange(60))]
        got = t.blocks(places_of(text), len(text))
        full = [i for i in range(len(text)) if len(set(text[i : i + t.window]) & set(t.order)) >= t.need]
        assert bool(got) == bool(full)
        for a, b, n in got:
            assert b - a < t.window and n == len(set(text[a : b + 1]) & set(t.order)) >= t.need
        assert all(x[1] < y[0] for x, y in zip(got, got[1:]))  # noqa: B905
        for i in full:
            assert any(a < i + t.window and b >= i for a, b, _ in got)


def test_every_copy_of_a_template_is_a_block(spark):
    label, text = licenses.TEMPLATES[15]
    n = len(licenses.words_of(text))
    got = licenses.scan(docs(spark, [" ".join([text] * 3), f"{text} {'x ' * 90} {text}"])).orderBy("doc_id").collect()
    own = [[(b["first_word"], b["last_word"]) for b in r["blocks"] if b["label"] == label] for r in got]
    assert own == [[(k * n, k * n + n - 1) for k in range(3)], [(0, n - 1), (n + 90, 2 * n + 89)]]
    for label, text in licenses.TEMPLATES:
        assert label in licenses.scan(docs(spark, [text.upper()])).first()["labels"] if label in ("mit", "zlib") else True


def test_odd_rows(spark):
    long = "word " * 300_000 + "released under the mit license " + "Permission is hereby granted " * 2000
    rows = [(1, "mit license"), (1, "mit license"), (None, "apache license"), (2, long), (3, "general public\tlicense; GENERAL PUBLIC LICENSE"), (4, "mitlicense mit-license")]
    frame = spark.createDataFrame(rows, DOCS).withColumn("labels", F.lit("clash")).withColumn("score", F.lit("clash"))
    got = licenses.scan(frame).collect()
    assert Counter((r["doc_id"], r["n_base"], ",".join(r["base_labels"])) for r in got) == {(1, 1, "mit"): 2, (None, 1, "apache"): 1, (2, 1, "mit"): 1, (3, 2, "gpl"): 1, (4, 1, "mit"): 1}
    assert licenses.scan(frame.limit(0)).count() == 0
