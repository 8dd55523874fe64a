"""Preflight, throughput, fetching, result files, image noise, ordered selections."""

import http.server
import json
import random
import threading
from functools import partial

import numpy as np
import pytest
from pyspark.sql import functions as F

from sieveline import catalog
from sieveline.context import Context
from sieveline.operators.phash import first_wins
from sieveline.plans import order, preflight, report, sft, throughput
from sieveline.plans.prepare import drawing, synthetic, synthetic_images
from sieveline.schema import as_samples
from sieveline.sources import embeddings, fetch, images, results
from sieveline.storage import balanced, discard, mark, read_text, written


def chats(spark, n):
    turns = [("human", "What is it?"), ("gpt", "A picture.")]
    rows = [(i, f"s{i}", "/there.png" if i % 2 else "/gone.png", turns, i % 4 != 0) for i in range(n)]
    return as_samples(spark.createDataFrame(rows, "row_idx long, id string, image_path string, conversations array<struct<`from`:string,value:string>>, keep boolean"))


@pytest.mark.parametrize("single", [False, True])
def test_training_sets_pass_their_checks(spark, tmp_path, single):
    folder = str(tmp_path / "sets")
    sets = sft.groups(chats(spark, 20))
    found = sft.write_sets(sets, folder, "", single_files=single, prefix="own_")
    assert {k: v["n"] for k, v in found["groups"].items()} == {"a_dirty": 20, "b_cleaned": 15, "c_random": 15}
    if single:
        assert [m["role"] for m in json.loads(read_text(spark, f"{folder}/a_dirty.json"))[0]["messages"]] == ["user", "assistant"]
    names = list(sets)
    checks = preflight.check(spark, folder, names, "own_", probe=5)
    status = {f.title: f.status for f in checks}
    assert status["registration"] == status["a_dirty"] == status["size control"] == status["records of a_dirty"] == "ok"
    assert status["images of a_dirty"] == "FAIL"  # neither picture exists
    counts = preflight.tallies(checks)
    assert counts["FAIL"] == 3 and counts["ok"] == 8 and preflight.to_text(checks).endswith("8 ok, 0 warn, 0 skip, 3 FAIL")
    other = {f.title: f for f in preflight.check(spark, folder, ["a_dirty", "none"], "own_")}
    assert other["registration"].status == other["none"].status == "FAIL" and other["size control"].status == "skip"


def test_preflight_finds_what_is_wrong(spark, tmp_path):
    picture = tmp_path / "p.png"
    picture.write_bytes(b"x")
    good = {"messages": [{"role": "user", "content": "<image>\nhi"}, {"role": "assistant", "content": "ho"}], "images": [str(picture)]}
    bad = {"messages": [{"role": "user", "content": "hi"}, {"role": "assistant", "content": "ho"}], "images": [str(picture)]}
    for name, rows in {"b_cleaned": [good, good], "c_random": [good, bad, good], "a_dirty": []}.items():
        (tmp_path / f"{name}.json").write_text(json.dumps(rows))
    (tmp_path / "torn.json").write_text('[{"messages": ')
    status = {f.title: f.status for f in preflight.check(spark, str(tmp_path), ["a_dirty", "b_cleaned", "c_random", "torn"])}
    assert status == {"registration": "FAIL", "a_dirty": "FAIL", "b_cleaned": "ok", "c_random": "ok", "torn": "FAIL", "size control": "warn", "images of b_cleaned": "ok", "records of b_cleaned": "ok", "images of c_random": "ok", "records of c_random": "FAIL"}


def test_throughput_is_a_median_and_grows_with_cores(spark):
    rows = written(as_samples(spark.range(50).select(F.col("id").alias("row_idx"), F.col("id").cast("string").alias("id"), F.lit("some words here").alias("text"))), "rows")
    got = throughput.rates(rows, Context(spark), [{"name": "text_quality_filter"}], repeats=3)
    assert got["text_quality_filter"] > 0
    assert throughput.speed_up({1: {"a": 10.0}, 4: {"a": 25.0}}) == {"a": {1: 1.0, 4: 2.5}}


class Quiet(http.server.SimpleHTTPRequestHandler):
    def log_message(self, *args):
        pass


def test_fetch_over_http(spark, tmp_path):
    served, kept = tmp_path / "served", tmp_path / "kept"
    (served / "a").mkdir(parents=True)
    noise = np.random.default_rng(1).integers(0, 255, (40, 40, 3))
    for name in ("one.png", "a/two.png", "three.png"):
        (served / name).write_bytes(images.png(noise))
    (served / "torn.png").write_bytes(images.png(noise)[:500])
    server = http.server.ThreadingHTTPServer(("127.0.0.1", 0), partial(Quiet, directory=str(served)))
    threading.Thread(target=server.serve_forever, daemon=True).start()
    try:
        url = f"http://127.0.0.1:{server.server_port}/"
        paths = ["one.png", "a/two.png", "one.png", "none.png", "torn.png", "three.png", None]
        rows = as_samples(spark.createDataFrame([(i, f"s{i}", p) for i, p in enumerate(paths)], "row_idx long, id string, image_path string"))
        get = lambda **more: {r["image_path"]: r["status"] for r in written(fetch.fetch(rows, url, str(kept), retries=2, wait=0.01, **more), "fetched").collect()}
        assert get(limit=2) == {"one.png": "ok", "a/two.png": "ok"}
        done = written(fetch.fetch(rows, url, str(kept), retries=2, wait=0.01), "fetched")
        assert {r["image_path"]: r["status"] for r in done.collect()} == {"one.png": "skipped", "a/two.png": "skipped", "three.png": "ok", "none.png": "missing", "torn.png": "failed"}
        assert fetch.summary(done, first=1) == ({"skipped": 2, "ok": 1, "missing": 1, "failed": 1}, ["none.png"])
        assert sorted(p.name for p in kept.rglob("*") if p.is_file()) == ["one.png", "three.png", "two.png"]
        found = {r["image_file"].rpartition("/")[2] for r in images.valid_images(Context(spark), str(kept)).collect()}
        assert found == {"one.png", "three.png", "two.png"}
    finally:
        server.shutdown()


def test_results_are_the_models_own(tmp_path):
    write = lambda path, text: ((tmp_path / path).parent.mkdir(parents=True, exist_ok=True), (tmp_path / path).write_text(text))
    write("other/other_set_acc.csv", "split,Overall\ndev,99.0\n")
    write("set_acc.csv", "split,Overall\ndev,98.0\n")
    assert results.harvest(str(tmp_path), "mine", "set") is None
    write("deep/er/mine_set_score.csv", "split, overall \ndev,71.35\n")
    assert results.harvest(str(tmp_path), "mine", "set") == 71.35
    write("mine/mine_set_acc.csv", "split,Overall\ndev,none\n")  # no number: the next file speaks
    assert results.harvest(str(tmp_path), "mine", "set") == 71.35
    assert results.harvest(str(tmp_path), "other", "set") == 99.0 and results.harvest(str(tmp_path), "mine", "else") is None


def test_image_noise_is_caught(spark, tmp_path):
    out = catalog.image_noise(spark, "/root/testdata/sf0.01").collect()
    by = lambda kind: [r for r in out if r["noise_type"] == kind]
    low, near, clean = by("lowquality_image"), by("duplicate_near"), by(None)
    assert len(low) == 20 and len(near) == 10 and len(clean) == 100
    assert {r["degrade_mode"] for r in low} == {"blur", "downscale"} and not any(r["keep"] for r in low)
    assert all(r["drop_reason"].startswith("image_resolution_filter" if r["degrade_mode"] == "downscale" else "image_blur_filter") for r in low)
    assert sum(r["keep"] for r in clean) >= 90


def test_pictures_are_sharp_and_differ(spark):
    one, two = (drawing(s, "60-degree", "dim", 128, 60, 64, 40) for s in ("triangle", "eight-pointed star"))
    assert one.shape == (128, 128, 3) and (one != two).any()
    assert images.laplacian_variance(one.mean(axis=2)) > 10 * images.laplacian_variance(images.blurred(one, 4).mean(axis=2))
    assert images.near_copy(one, 0).shape == (96, 96, 3) and images.near_copy(one, 21).shape[0] < 96
    assert images.degraded(one, 1)[1] == "downscale" and min(images.degraded(one, 1)[0].shape[:2]) == 64
    rows = synthetic(spark, 30)
    assert synthetic_images(rows, 32).select("rgb").distinct().count() == 30 and rows.select("text").distinct().count() == 30


def test_first_rows_and_running_sums(spark):
    dice = random.Random(2)
    data = [(i, dice.choice([5, 77, 1 << 31, dice.randrange(1 << 32)])) for i in range(400)]
    frame = spark.createDataFrame(data, "row_idx long, k long")
    for n in (0, 1, 7, 150, 399, 400, 500):
        got = {r["row_idx"] for r in order.first_rows(frame, n, "k", "row_idx", at_once=5, fan=4).collect()}
        assert got == {i for i, _ in sorted(data, key=lambda x: (x[1], x[0]))[:n]}, n
    values = [("a", float(v), 1 + v % 3) for v in {dice.randrange(1000) ** 2 for _ in range(200)}] + [("b", 1.0, 2), ("c", float("inf"), 1), ("c", 2.0, 5), ("c", float("nan"), 7), ("c", -1.0, 1)]
    got = {(r["key"], str(r["v"])): r["before"] for r in order.running_sums(spark.createDataFrame(values, "key string, v double, c long"), ["key"], "v", {"c": "before"}, ranges=16).collect()}
    rank = lambda v: (v != v, v)
    assert got == {(k, str(v)): sum(c for k2, v2, c in values if k2 == k and rank(v2) < rank(v)) for k, v, _ in values}


def test_first_wins_in_rounds_is_first_wins_at_once(spark):
    dice = random.Random(8)
    edges = sorted({tuple(sorted(dice.sample(range(80), 2))) for _ in range(200)})
    frame = spark.createDataFrame(edges, "i long, j long")
    both = [{tuple(r) for r in first_wins(frame, at_once).collect()} for at_once in (1 << 17, 0, 60)]
    assert both[0] == both[1] == both[2]


def test_vectors_are_made_once_and_counted(spark, tmp_path):
    calls = spark.sparkContext.accumulator(0)
    rows = as_samples(spark.createDataFrame([(i, f"s{i}", "t") for i in range(4)], "row_idx long, id string, text string"))

    def encode(todo):
        def make(batches):
            for b in batches:
                calls.add(len(b))
                b["vec"] = [[3.0, 4.0]] * len(b)
                yield b[["key", "vec"]]

        return todo.select(F.col("id").alias("key")).mapInPandas(make, "key string, vec array<double>")

    store = spark.createDataFrame([("s0", [1.0, 0.0]), ("s0", [0.0, 1.0])], embeddings.SCHEMA)
    ctx = Context(spark, embeddings=store, providers={"image_encoder": encode})
    out = embeddings.with_vectors(rows, ctx, "v", "", "image_encoder")
    for _ in range(2):
        assert {r["id"]: [round(x, 3) for x in r["v"]] for r in out.collect()} == {"s0": [0.0, 1.0]} | {f"s{i}": [0.6, 0.8] for i in (1, 2, 3)}
    assert (ctx.cache_hits, ctx.cache_misses, calls.value) == (1, 3, 3)
    for name in ("store", "store.npz"):
        embeddings.save(ctx.embeddings, str(tmp_path / name))
        assert {r["key"] for r in embeddings.load(spark, str(tmp_path / name)).collect()} == {"s0", "s1", "s2", "s3"}


def test_small_tables_are_dealt_over_all_cores(spark):
    one = spark.range(100).coalesce(1)
    assert balanced(one).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    assert balanced(one, per_task=1).rdd.getNumPartitions() == 1


def test_intermediates_are_deleted_but_for_the_result(spark):
    since = mark()
    one, two = written(spark.range(5), "one"), written(spark.range(0), "two")
    last = written(one.filter("id > 2"), "three")
    discard(spark, since, last, two)
    assert last.count() == 2 and two.count() == 0 and mark() == since + 2
    with pytest.raises(Exception, match="PATH_NOT_FOUND|does not exist|FileNotFound"):
        spark.read.parquet(one._written)
    discard(spark, since)
    assert mark() == since


def test_serving_statistics(spark):
    rows = [(1, True, 0.0, 2.0, 0.1, 0.01, 10), (1, True, 1.0, 4.0, 0.3, 0.03, 30), (1, False, 0.0, 5.0, None, None, None), (2, False, 0.0, 1.0, None, None, None)]
    frame = spark.createDataFrame(rows, "concurrency long, ok boolean, begun double, ended double, ttft double, tpot double, out_tokens long")
    one, two = report.serving_stats(frame).orderBy("concurrency").collect()
    assert (one["ok"], one["failed"], one["wall"], one["req_per_s"], one["out_tok_per_s"]) == (2, 1, 5.0, 0.4, 8.0)
    assert (one["ttft_p50"], one["ttft_p99"], round(one["tpot_p50"], 6), one["mean_out_tokens"]) == (0.1, 0.3, 0.02, 20.0)
    assert (two["ok"], two["failed"], two["req_per_s"], two["tpot_p50"]) == (0, 1, None, None)


def test_pixels_are_read_in_small_groups_and_not_shuffled(spark):
    import pyarrow.parquet as pq

    drawn = synthetic_images(synthetic(spark, 300), 8).coalesce(1)
    table = written(drawn.select(F.col("name").alias("image_file"), F.col("rgb").alias("data")), "pictures", images.PICTURES_AT_ONCE)
    groups = [m.row_group(i).num_rows for f in table.inputFiles() for m in [pq.ParquetFile(f.removeprefix("file://")).metadata] for i in range(m.num_row_groups)]
    assert sum(groups) == 300 and max(groups) <= images.PICTURES_AT_ONCE
    names = table.select("image_file", F.length("image_file").alias("n")).limit(40)
    for at_once in (500_000, 7):
        found = images.picked(table, names, at_once)
        assert "Exchange hashpartitioning" not in found._jdf.queryExecution().executedPlan().toString()
        assert sorted(r[0] for r in found.select("image_file").collect()) == sorted(r[0] for r in names.collect())
    assert spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch") == str(16 << 20)
