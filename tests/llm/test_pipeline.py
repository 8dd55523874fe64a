"""The corpus pipeline: each stage against a plain version of it, on its own input."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

corpus_pipeline = pytest.importorskip("corpus_pipeline")
pytest.importorskip("public_tokenizers")
from sieveline.llm import toxicity  # noqa: E402
from tests.llm.test_corpus_operators import lines_by_hand  # noqa: E402
from tests.llm.test_decontamination import best_window  # noqa: E402
from tests.llm.test_near_copies import classes_of  # noqa: E402
from tests.llm.test_text_operators import hits_by_hand  # noqa: E402

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("pipeline")
    dice = random.Random(1)
    text = lambda n: " ".join("".join(dice.choices("abcdefgh", k=5)) for _ in range(n))
    items = [text(40), text(25)]
    docs = [[i, text(80), "en", "s", 0] for i in range(60)]
    labels = []
    for i, d in enumerate(docs):
        if i % 4 == 0:
            d[1] += f" zugbug {text(3)} zugbug"
        labels.append((i, 1, int(i % 4 == 0)))
    docs[1][1] = f"{text(30)} {items[0]} {text(30)}"
    docs[6][1] = f"{text(30)} {' '.join(items[1].split()[:23])} other {items[1].split()[24]}"
    docs[3][1] = docs[2][1].upper()
    near = docs[5][1].split()
    docs += [[70, docs[5][1] + "\nits own line of words " + text(50), "en", "s", 0], [71, " ".join([*near[:40], "changed", *near[41:]]), "en", "s", 0]]
    docs += [[80, None, None, None, None], [81, "", "en", "s", 0], [None, text(60), "en", "s", 0], [None, docs[7][1], "en", "s", 0], [82, "same line of text\n" * 3 + text(30), "en", "s", 0], [83, text(30) + "\nSame line of text ", "en", "s", 0]]
    spark.createDataFrame(docs, DOCUMENTS).write.parquet(str(path / "documents.parquet"))
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(str(path / "labels.parquet"))
    spark.createDataFrame(list(enumerate(items)), "item_id long, text string").write.parquet(str(path / "benchmark.parquet"))
    return str(path), items


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_stages_match_brute_force_on_their_own_input(spark, folder):
    path, items = folder
    now = spark.read.parquet(f"{path}/documents.parquet")
    columns, seen = now.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        before = rows_of(now)
        now = corpus_pipeline.written(stage(spark, now, path), name)
        after = rows_of(now)
        seen[name] = {r["doc_id"] for r in now.select("doc_id").collect()}
        assert name == "packing" or now.columns == columns
        if name == "toxicity":
            lexicon = toxicity.learn_from_tables(spark, path)
            assert after == [r for r in before if lexicon.score(np.array([hits_by_hand(lexicon, r[1])]))[0] < 0.7]
        elif name == "line_dedup":
            hand = lines_by_hand([(r[0], r[1]) for r in before])
            assert sorted((str(r[0]), len((r[1] or "").split("\n"))) for r in after) == sorted((str(d), n - gone or 1) for d, n, gone, _ in hand)
            assert all(r[4] == len(r[1]) for r in after)
        elif name == "near_dedup":
            classes = classes_of([(r[0], r[1]) for r in before if r[0] is not None])
            assert after == [r for r in before if r[0] is None or classes[r[0]] == r[0]]
        elif name == "decontamination":
            assert after == [r for r in before if not any(best_window(x.split(), (r[1] or "").lower().split()) for x in items if r[1])]
        else:
            from sieveline.llm.packing import encoder

            want = sorted([*encoder()(r[1] or "").tolist(), 2] for r in before)
            pieces = sorted(now.collect(), key=lambda r: (r["sequence_id"], r["offset"]))
            assert sorted(r["ids"] for r in pieces) == want
            assert [r["offset"] for r in pieces] == [0, *(a["offset"] + a["length"] if a["sequence_id"] == b["sequence_id"] else 0 for a, b in zip(pieces, pieces[1:]))]  # noqa: B905
    assert not seen["toxicity"] & set(range(0, 60, 4)) and seen["line_dedup"] == seen["toxicity"]
    assert seen["near_dedup"] >= {2, 5, 70} and not seen["near_dedup"] & {71, 80, 81} and not seen["decontamination"] & {1, 6}
    packed = corpus_pipeline.run(spark, path)
    assert sorted(map(str, packed.select("doc_id", "length", "ids_crc32").collect())) == sorted(map(str, now.select("doc_id", "length", "ids_crc32").collect()))


def test_stages_of_empty_tables_and_clashing_columns(spark, folder):
    path, _ = folder
    docs = spark.read.parquet(f"{path}/documents.parquet")
    for extra in ("toxicity", "n_lines", "drop", "node", "item_id", "ids", "row", "keep_id"):
        docs = docs.withColumn(extra, F.lit("clash"))
    now = docs
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), path).count() == 0
        now = corpus_pipeline.written(stage(spark, now, path), name)
        assert name == "packing" or now.columns == docs.columns
    assert now.count() > 30
