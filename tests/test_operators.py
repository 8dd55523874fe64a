"""Operators, one behaviour a test."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from sieveline.context import Context
from sieveline.functions import scalar as S
from sieveline.functions.text import junk_char_ratio, repeated_ngram_ratio, word_hashes, words
from sieveline.graph import components
from sieveline.operators.perception import collapsed
from sieveline.operators.phash import first_match_dedup, first_wins, matching_pairs
from sieveline.operators.semantic import _plan, cosine_pairs
from sieveline.plans.pipeline import Pipeline
from sieveline.registry import build_op, get_op, list_ops, register_op
from sieveline.schema import as_samples, meta_text
from sieveline.sources import images


def rows(spark, texts, **more):
    made = spark.createDataFrame([(i, f"s{i}", t) for i, t in enumerate(texts)], "row_idx long, id string, text string")
    return as_samples(made.withColumns(more))


def reasons(df):
    return [r["drop_reason"] for r in df.orderBy("row_idx").collect()]


def test_registry_contract():
    assert len(list_ops()) >= 9
    with pytest.raises(ValueError):
        register_op("text_quality_filter")(object)
    with pytest.raises(KeyError, match="text_quality_filter"):
        get_op("no_such_op")
    with pytest.raises(TypeError):
        build_op("text_quality_filter", {"nonsense": 1})


def test_text_quality_reasons(spark):
    looped = "the same five words here " * 12
    df = build_op("text_quality_filter").apply(rows(spark, ["A perfectly natural sentence about a dog.", "hi", looped, "a" * 20 + "§¶†" * 40, None, "x" * 4001]), Context(spark))
    codes = [r and r.split(":")[1] for r in reasons(df)]
    assert codes == [None, "too_short", "repetitive", "junk_chars", "too_short", "too_long"]
    assert df.filter("scores is null or not map_contains_key(scores, 'n_chars')").count() == 0


def test_language_by_script(spark):
    df = build_op("lang_id_filter", {"backend": "heuristic"}).apply(rows(spark, ["plain English", "河边有一座古老的石桥", "  ", "1234"]), Context(spark))
    assert reasons(df) == [None, "lang_id_filter:wrong_lang", "lang_id_filter:empty", "lang_id_filter:wrong_lang"]
    with pytest.raises(RuntimeError):
        build_op("lang_id_filter", {"backend": "fasttext"}).apply(rows(spark, ["x"]), Context(spark))


def test_first_rejection_owns_the_reason(spark):
    steps = [{"name": "text_quality_filter"}, {"name": "lang_id_filter", "params": {"backend": "heuristic"}}]
    df = Pipeline({"ops": steps}).transform(rows(spark, ["短", "河边有一座古老的石桥，孩子们在桥上放风筝。"]), Context(spark))
    assert reasons(df) == ["text_quality_filter:too_short", "lang_id_filter:wrong_lang"]
    scores = [r["scores"] for r in df.orderBy("row_idx").collect()]
    assert "lang_conf" not in scores[0] and "lang_conf" in scores[1]


def test_filter_after_a_pipeline_stays_linear(spark):
    df = Pipeline({"ops": [{"name": "text_quality_filter", "params": {"max_chars": 10**6}}]}).transform(rows(spark, ["word " * 20000]), Context(spark))
    assert df.filter("not keep").count() == 1


def test_score_filter_bounds_and_nan(spark):
    op = build_op("clip_score_filter", {"threshold": 0.5})
    frame = spark.createDataFrame([(0, 0.5), (1, 0.4), (2, float("nan")), (3, None)], "row_idx long, s double")
    assert [r["c"] for r in frame.select("row_idx", op.code(F.col("s")).alias("c")).orderBy("row_idx").collect()] == [None, "below_min", None, "unscorable"]


def test_resolution_codes(spark):
    op = build_op("image_resolution_filter")
    frame = spark.createDataFrame([(400, 400), (100, 100), (2000, 250), (None, None), (0, 300), (20000, 9000)], "w int, h int")
    assert [r[0] for r in frame.select(op.codes(F.col("w"), F.col("h"))[0]).collect()] == [None, "too_small", "bad_aspect", "unreadable", "too_small", "too_large"]


def test_image_operators_read_files(spark, tmp_path):
    noise = np.random.default_rng(0).integers(0, 255, (300, 300, 3), dtype=np.uint8)
    flat = np.full((300, 300, 3), 120, np.uint8)
    for name, pixels in (("sharp.png", noise), ("copy.png", noise), ("flat.png", flat), ("tiny.png", noise[:50, :50])):
        (tmp_path / name).write_bytes(images.png(pixels))
    (tmp_path / "broken.png").write_bytes(b"not an image")
    names = ["sharp.png", "flat.png", "tiny.png", "broken.png", "gone.png", "copy.png"]
    made = as_samples(spark.createDataFrame([(i, n, n, "same words") for i, n in enumerate(names)], "row_idx long, id string, image_path string, text string"))
    ctx = Context(spark, str(tmp_path))
    df = Pipeline({"ops": [{"name": "image_resolution_filter"}, {"name": "image_blur_filter"}, {"name": "phash_dedup"}]}).transform(made, ctx)
    assert reasons(df) == [None, "image_blur_filter:below_min", "image_resolution_filter:too_small", "image_resolution_filter:unreadable", "image_resolution_filter:unreadable", "phash_dedup:duplicate"]
    assert df.filter("row_idx = 5").select(meta_text("duplicate_of")).first()[0] == "sharp.png"


def test_header_sizes():
    assert images.header_size(images.png(np.zeros((7, 9, 3), np.uint8))) == (9, 7)
    assert images.header_size(b"") is None and images.header_size(b"\xff\xd8\xff") is None


def test_laplacian_and_hash_properties():
    flat = np.full((20, 20), 7)
    assert images.laplacian_variance(flat) == 0.0 and images.laplacian_variance(flat[:2]) == 0.0
    picture = np.kron(np.random.default_rng(5).integers(0, 255, (8, 8)), np.ones((16, 16)))
    larger = np.kron(picture, np.ones((2, 2)))
    assert (images.perceptual_hash(picture) ^ images.perceptual_hash(larger)).bit_count() <= 4


def test_polygon_area_and_linear_head(spark):
    shapes = [[[0, 0], [10, 0], [10, 10], [0, 10]], [[0, 5], [5, 10], [10, 5], [5, 0]], [[0, 0], [0, 10], [10, 10], [10, 0]], [[0, 0], [1, 1]]]
    frame = spark.createDataFrame([([[float(v) for v in p] for p in s],) for s in shapes], "p array<array<double>>")
    assert [r[0] for r in frame.select(S.polygon_area(F.col("p"))).collect()] == [100.0, 50.0, 100.0, 0.0]
    draw = np.random.default_rng(1)
    layers = [(draw.normal(size=(4, 6)), draw.normal(size=4)), (draw.normal(size=(1, 4)), draw.normal(size=1))]
    weight, bias = collapsed(layers)
    x = draw.normal(size=6)
    assert np.isclose(np.dot(weight, x) + bias, (layers[1][0] @ (layers[0][0] @ x + layers[0][1]) + layers[1][1])[0])


def test_first_wins_matches_the_sequential_rule(spark):
    dice = random.Random(3)
    edges = sorted({(i, j) for _ in range(160) for i, j in [sorted(dice.sample(range(60), 2))]})
    kept = []
    for j in range(60):
        if not any((i, j) in set(edges) for i in kept):
            kept.append(j)
    found = first_wins(spark.createDataFrame(edges, "i long, j long"))
    lost = {r["j"] for r in found.filter("not kept").collect()}
    assert lost == set(range(60)) - set(kept)


def test_copies_in_a_chain_of_hashes(spark):
    # 0 ~ 1 ~ 2 but not 0 ~ 2: 2 stays, and so its copy goes to 2
    data = [(0, 0), (1, 0b111), (2, 0b111111), (3, 0b111111), (4, 0b111), (5, 0)]
    found = first_match_dedup(spark.createDataFrame(data, "row_idx long, h long"), 3, None)
    assert {tuple(r) for r in found.collect()} == {(1, 0), (3, 2), (4, 0), (5, 0)}


def test_semantic_chain_and_missing_vectors(spark):
    vec = {"s0": [1.0, 0.0, 0.0], "s1": [1.0, 0.2, 0.0], "s2": [1.0, 0.4, 0.0], "s4": [0.0, 0.0, 0.0]}
    ctx = Context(spark, embeddings=spark.createDataFrame(list(vec.items()), "key string, vec array<float>"))
    df = build_op("semantic_dedup", {"sim_threshold": 0.95, "text_aware": False, "chunk_size": 2}).apply(rows(spark, ["a", "b", "c", "d", "e"]), ctx)
    assert reasons(df) == [None, "semantic_dedup:semantic_duplicate", "semantic_dedup:semantic_duplicate", "semantic_dedup:no_embedding", None]
    assert [r[0] for r in df.filter("scores is not null").orderBy("row_idx").select(meta_text("duplicate_of")).collect()] == [None, "s0", "s0", None, None]


@pytest.mark.parametrize("at_once", [1 << 17, 8])
def test_components_take_the_least_node(spark, at_once):
    edges = [(1, 2), (2, 3), (5, 4), (9, 9), (3, 7), (None, 1)] + [(100 + i, 101 + i) for i in range(40)]
    found = {tuple(r) for r in components(spark.createDataFrame(edges, "u long, v long").repartition(3), at_once).collect()}
    assert found == {(1, 1), (2, 1), (3, 1), (7, 1), (4, 4), (5, 4), (9, 9)} | {(n, 100) for n in range(100, 141)}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_a_hub_is_split_from_its_edges(spark):
    from sieveline.skew import join_unique

    rows = spark.createDataFrame([(1, i) for i in range(300)] + [(k, k) for k in range(2, 60)] + [(None, 7)], "u long, v long")
    table = rows.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n"))
    got = sorted(tuple(r) for r in join_unique(rows, table, ["u"], "n", rows.count(), parts=100).collect())
    assert got == sorted([(1, i, 0) for i in range(300)] + [(k, k, k) for k in range(2, 60)])


@pytest.mark.parametrize("threshold", [0.95, 0.3, -1.0])
def test_cosine_pairs_match_brute_force_in_cells(spark, threshold):
    draw = np.random.default_rng(4)
    centres = draw.normal(size=(6, 8))
    mat = np.concatenate([c + 0.15 * draw.normal(size=(40, 8)) for c in centres] + [np.zeros((2, 8))])
    unit = mat / np.maximum(np.linalg.norm(mat, axis=1, keepdims=True), 1e-12)
    sim = unit @ unit.T
    want = {(i, j) for i in range(len(mat)) for j in range(i + 1, len(mat)) if sim[i, j] >= threshold}
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(mat)], "row_idx long, vec array<double>")
    got = [(r["i"], r["j"]) for r in cosine_pairs(frame, threshold, block_rows=6).collect()]
    assert len(got) == len(set(got)) and set(got) == want
    cells = _plan(frame, threshold, 6, 512)[1]
    assert len(cells) == 1 if threshold < 0 else sum(len(c[3]) for c in cells) < len(cells) ** 2 or threshold < 0.9


def test_hashes_are_not_broadcast(spark):
    # their files are small, what is made of them is not
    nodes = spark.createDataFrame([(i, i // 2 * 1023, ["a", f"b{i % 3}"]) for i in range(40)], "row_idx long, h long, toks array<string>")
    plan = matching_pairs(nodes, 3, 0.9)._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" not in plan
    dealt = [x for x in plan.splitlines() if "Generate explode" in x]
    assert dealt and not any("toks" in x for x in dealt)


@pytest.mark.parametrize("text", [None, 0.3])
def test_clusters_match_brute_force_in_passes(spark, monkeypatch, text):
    from sieveline.operators import semantic

    draw = np.random.default_rng(8)
    mat = draw.normal(size=(150, 6))
    mat[140:] = mat[:10]
    toks = [sorted({f"w{k}" for k in draw.integers(0, 12, draw.integers(0, 7))}) for _ in range(140)]
    toks += toks[:5] + [["other"]] * 5
    unit = mat / np.linalg.norm(mat, axis=1, keepdims=True)
    alike = lambda a, b: len(set(a) & set(b)) / len(set(a) | set(b)) >= text if a or b else True
    root = list(range(150))
    linked = set()
    for i in range(150):
        for j in range(i + 1, 150):
            if unit[i] @ unit[j] >= 0.9 and (text is None or alike(toks[i], toks[j])):
                linked |= {i, j}
                a, b = sorted((root[i], root[j]))
                root = [a if r == b else r for r in root]
    frame = spark.createDataFrame([(i, v.tolist(), t) for i, (v, t) in enumerate(zip(mat, toks, strict=True))], "row_idx long, vec array<double>, toks array<string>")
    monkeypatch.setattr(semantic, "AT_ONCE", 1500)
    got = {r["row_idx"]: r["root"] for r in semantic.clusters(frame, 0.9, text, block_rows=12).collect()}
    assert got == {i: root[i] for i in linked}


def test_vectors_are_shuffled_once(spark):
    # blocks read what is packed where it lies, and links are a forest: fewer than rows in one pass of one task
    from sieveline.operators import semantic

    frame = spark.createDataFrame([(i, [1.0, float(i % 7) / 100]) for i in range(120)], "row_idx long, vec array<double>").coalesce(1)
    for out in (cosine_pairs(frame, 0.5, 8), semantic.linked(frame, 0.5, None, 8)):
        assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()
    assert out.count() < 120 * 2 * 2 * spark.sparkContext.defaultParallelism < 120 * 119 // 2


def test_texts_are_measured_once_and_where_needed(spark):
    # dropped rows are not looked through for scripts, good ASCII not for junk, words not five at a time
    texts = ["a^b", "x ^ y\x7f\x00", "plain, ASCII_text (all) good ~ `q`", "é ü 漢字 ‽ — ok", "\x1c\x1f\x85 \u2028", "", "☃" * 4, "one two three four five " * 3]
    frame = rows(spark, texts)
    got = [r["j"] for r in frame.select(junk_char_ratio(F.col("text")).alias("j"), "row_idx").orderBy("row_idx").collect()]
    good = lambda c: c.isalpha() or c.isnumeric() or c.isspace() or c in ".,!?;:'\"()[]{}-–—/%$&@#*+=<>~`|\\_"
    assert got == [sum(not good(c) for c in t) / len(t) if t else 1.0 for t in texts]
    both = frame.select(repeated_ngram_ratio(words(F.col("text"))).alias("a"), repeated_ngram_ratio(word_hashes(F.col("text"))).alias("b")).collect()
    assert all(r["a"] == r["b"] for r in both) and max(r["a"] for r in both) == 6 / 11
    op = build_op("lang_id_filter", {"backend": "heuristic"})
    half = frame.withColumn("keep", F.col("row_idx") % 2 == 0).withColumn("_text", F.col("text"))
    assert all((r["_conf"] is None) == (not r["keep"]) for r in op.predicted(half, Context(spark)).collect())
