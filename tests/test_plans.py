"""Files, pipelines from configuration, noise, evaluation and training sets."""

import json

import pytest
from pyspark.sql import functions as F

from sieveline.context import Context
from sieveline.plans import evaluate as E
from sieveline.plans import noise as N
from sieveline.plans import report as R
from sieveline.plans import sft
from sieveline.plans.pipeline import Pipeline
from sieveline.plans.prepare import distinct_images, prepared, synthetic
from sieveline.schema import as_samples, meta_text
from sieveline.sources.jsonl import parse_line, read_jsonl, write_jsonl
from sieveline.sources.results import harvest


def lines(path, rows):
    path.write_text("\n".join(json.dumps(r, ensure_ascii=False) for r in rows) + "\n\n")
    return str(path)


SAMPLE_ROWS = [
    {"id": "a", "text": "A perfectly natural sentence about a dog.", "extra": {"k": [1, 2]}, "meta": {"n": 1}},
    {"id": "b", "text": "hi"},
    {"id": "c", "text": "河边有一座古老的石桥，孩子们在桥上放风筝。", "meta": {"is_noise": True, "noise_type": "wrong_lang"}},
    {"id": "d", "text": "Another natural sentence, about two cats.", "scores": {"old": 0.5}},
]


def test_json_lines_round_trip(spark, tmp_path):
    df = read_jsonl(spark, lines(tmp_path / "in.jsonl", SAMPLE_ROWS))
    assert [r["id"] for r in df.orderBy("row_idx").collect()] == ["a", "b", "c", "d"]
    assert read_jsonl(spark, str(tmp_path / "in.jsonl"), limit=2).count() == 2
    write_jsonl(df, str(tmp_path / "out"), files=1)
    again = read_jsonl(spark, str(tmp_path / "out"))
    assert again.orderBy("row_idx").collect() == df.orderBy("row_idx").collect()
    first = again.filter("id = 'a'").first()
    assert first["meta"] == {"n": "1", "extra": '{"k": [1, 2]}'}
    with pytest.raises(ValueError):
        parse_line('{"text": "no id"}')


def test_pipeline_runs_reports_and_resumes(spark, tmp_path):
    spec = {"name": "t", "input": lines(tmp_path / "in.jsonl", SAMPLE_ROWS), "output_dir": str(tmp_path / "out"), "ops": [{"name": "text_quality_filter"}, {"name": "lang_id_filter", "params": {"backend": "heuristic"}}]}
    report = Pipeline(spec).run(spark)
    assert (report["n_input"], report["n_output"]) == (4, 2)
    first, second = report["operators"]
    assert (first["n_in"], first["n_dropped"], second["n_in"], second["n_dropped"]) == (4, 1, 3, 1)
    assert second["dropped_by_noise"] == {"wrong_lang": 1}
    assert json.loads((tmp_path / "out/report.json").read_text())["n_output"] == 2
    assert read_jsonl(spark, str(tmp_path / "out/cleaned.jsonl")).count() == 2
    again = Pipeline(spec).run(spark, resume=True)
    assert again["operators"] == [] and again["n_output"] == 2
    other = Pipeline(spec | {"ops": [{"name": "text_quality_filter", "params": {"min_chars": 1}}]})
    assert other.latest_checkpoint(spark) == -1
    with pytest.raises(KeyError):
        Pipeline({"ops": [{"name": "unknown"}]})


def test_partitions_do_not_matter(spark):
    df = synthetic(spark, 60)
    counts = {k: 5 for k in N.DEFAULT_COUNTS}
    runs = [N.inject(df.repartition(p), counts).orderBy("row_idx").select("row_idx", "id", "text").collect() for p in (1, 7)]
    assert runs[0] == runs[1]


def test_noise_sources_are_disjoint(spark):
    df = synthetic(spark, 50)
    counts = {k: 4 for k in N.DEFAULT_COUNTS}
    src = N.dealt_sources(df, counts, 1)
    assert src.count() == 24 and src.select("row_idx").distinct().count() == 24
    ring = N.mismatched(src).select("image_path", meta_text("original_image").alias("o")).collect()
    assert {r["image_path"] for r in ring} == {r["o"] for r in ring} and all(r["image_path"] != r["o"] for r in ring)
    with pytest.raises(ValueError):
        N.plan_counts(10)


def test_evaluation_by_hand(spark):
    data = [(0, "a", True, None, False, None, None), (1, "b", False, "x:bad", True, "dup", "a"), (2, "c", False, "x:bad", False, None, None), (3, "d", True, None, True, "blur", None)]
    df = spark.createDataFrame(data, "row_idx long, id string, keep boolean, op string, is_noise boolean, noise_type string, duplicate_source string").withColumn("op", F.coalesce(F.split_part("op", F.lit(":"), F.lit(1)), F.lit("kept")))
    o = E.overall(df).first()
    assert (o["tp"], o["fp"], o["fn"], o["precision"], o["recall"]) == (1, 1, 1, 0.5, 0.5)
    assert E.dedup_groups(df).first()["collapsed_to_one"] == 1
    assert [tuple(r)[:4] for r in E.per_operator(df).collect()] == [("x", 2, 1, 1)]


def test_sweep_against_brute_force(spark):
    data = [(float(v % 7), v % 3 == 0) for v in range(50)]
    got = {r["threshold"]: (r["tp"], r["fp"], r["fn"]) for r in E.sweep(spark.createDataFrame(data, "v double, y boolean")).collect()}
    vals = sorted(v for v, _ in data)
    want = {}
    for t in {vals[min(49, int(i / 20 * 50))] for i in range(21)} | {6.06 + 1e-6}:
        want[round(t, 4)] = (sum(v < t and y for v, y in data), sum(v < t and not y for v, y in data), sum(v >= t and y for v, y in data))
    assert got == want
    assert E.sweep(spark.createDataFrame([], "v double, y boolean")).count() == 0


def test_quantile_rules(spark):
    df = spark.createDataFrame([("k", float(i)) for i in range(10)], "key string, value double")
    assert R.score_distribution(df).select("p10", "p50", "p90").first() == (1.0, 5.0, 9.0)
    assert R.latency_quantiles(df).select("p50", "p90", "p99").first() == (4.0, 8.0, 9.0)


def test_chat_conversion_rules(spark):
    said = lambda *t: [{"from": a, "value": b} for a, b in t]
    cases = [
        (said(("human", "hi"), ("gpt", "yo")), True),
        (said(("human", "<image> a <image>"), ("gpt", "b")), False),
        (said(("human", "a"), ("human", "b")), False),
        (said(("gpt", "a"), ("human", "b")), False),
        (said(("human", "a"), ("gpt", "<image>")), False),
        (said(("human", "a"), ("gpt", " ")), False),
        (said(("system", "a"), ("human", "b")), False),
        (said(("human", "a")), False),
        (None, False),
    ]
    df = as_samples(spark.createDataFrame([(i, str(i), "x.jpg", c) for i, (c, _) in enumerate(cases)], "row_idx long, id string, image_path string, conversations array<struct<`from`:string,value:string>>"))
    got = sft.with_messages(df, "/r").orderBy("row_idx").collect()
    assert [r["messages"] is not None for r in got] == [ok for _, ok in cases]
    assert got[0]["messages"][0]["content"] == "<image>\nhi" and got[0]["images"] == ["/r/x.jpg"]


def test_sets_have_the_size_of_the_kept(spark, tmp_path):
    df = synthetic(spark, 40).withColumn("keep", F.col("row_idx") % 4 != 0)
    sets = sft.groups(df)
    assert [sets[k].count() for k in ("a_dirty", "b_cleaned", "c_random")] == [40, 30, 30]
    found = sft.write_sets(sets, str(tmp_path / "sets"), "/r")
    assert found["groups"]["b_cleaned"]["n"] == 30 and not found["warnings"]
    with pytest.raises(ValueError):
        sft.groups(df.withColumn("keep", F.lit(False)))


def test_prepare_and_references(spark):
    raw = spark.createDataFrame([(0, "a", "b.jpg", [("gpt", "x")]), (1, "b", None, [("gpt", "x")]), (2, "c", "a.jpg", [("human", "x")]), (3, "d", "b.jpg", [("gpt", "y")])], "row_idx long, id string, image string, conversations array<struct<`from`:string,value:string>>")
    made, status = prepared(raw, 10)
    assert {r["status"]: r["n"] for r in status.collect()} == {"ok": 2, "no_image": 1, "no_text": 1}
    assert {tuple(r) for r in distinct_images(made).select("image_path").collect()} == {("b.jpg",)}


def test_harvest(tmp_path):
    (tmp_path / "m").mkdir()
    (tmp_path / "m/m_mmb_acc.csv").write_text("split,Overall\ndev,71.35\n")
    assert harvest(str(tmp_path), "m", "mmb") == 71.35 and harvest(str(tmp_path), "m", "other") is None


def test_narrow_pipelines_run_on_streams(spark, tmp_path):
    from sieveline.context import Context
    from sieveline.streaming import transform_stream

    rows = spark.createDataFrame([(0, "a", "A perfectly natural sentence about a dog."), (1, "b", "hi")], "row_idx long, id string, text string")
    rows.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in"))
    out = transform_stream(stream, Pipeline({"ops": [{"name": "text_quality_filter"}]}), Context(spark))
    query = out.select("id", "keep").writeStream.format("memory").queryName("annotated").start()
    query.processAllAvailable()
    query.stop()
    assert {tuple(r) for r in spark.sql("select * from annotated").collect()} == {("a", True), ("b", False)}
    with pytest.raises(ValueError):
        transform_stream(stream, Pipeline({"ops": [{"name": "phash_dedup"}]}), Context(spark))


def test_annotated_samples_are_measured_and_written_once(spark):
    from sieveline import catalog
    from sieveline.functions.text import stripped
    from sieveline.storage import _MADE, mark

    since = mark()
    rows = catalog.annotated(spark, "/root/testdata/sf0.001")
    assert "text" not in rows.columns
    sft.groups(rows)
    names = [p.rpartition("/")[2].split("-")[0] for p in _MADE[since:]]
    assert names == ["sources", "annotated"]
    ends = "\t\x0b\x1c\x85\xa0   　"
    data = spark.createDataFrame([(ends + "a 　 b\n" + ends,), (ends,), ("​x\x00",), (None,)], "t string")
    assert [r[0] for r in data.select(stripped(F.col("t"))).collect()] == ["a 　 b", "", "​x\x00", ""]
    assert "regexp_replace" not in data.select(stripped(F.col("t")))._jdf.queryExecution().optimizedPlan().toString()


def test_noise_does_not_move_texts(spark, monkeypatch):
    # texts are looked at where they lie, once for all copies of a row, and only what is found out is dealt, copied and put in order
    from sieveline import catalog

    plans = {}
    kept = lambda df, name="table", *a, f=N.written: plans.setdefault(name, df._jdf.queryExecution().optimizedPlan().toString()) and f(df, name, *a)
    monkeypatch.setattr(N, "written", kept)
    monkeypatch.setattr(catalog, "written", kept)
    for query, n in ((catalog.score_distribution, 4), (catalog.lang_id_filter, 280), (catalog.script_counts, 280)):
        plans.clear()
        out = query(spark, "/root/testdata/sf0.001")
        assert out.count() == n and "text#" not in out._jdf.queryExecution().optimizedPlan().toString()
        assert [k for k, p in plans.items() if "text#" in p] == ["sources"] and not any(w in plans["sources"] for w in ("Join", "Window", "Union", "Sort"))


def test_work_before_noise_is_work_after_noise(spark):
    texts = ["", None, "hi", "河边有一座古老的石桥，孩子们在桥上放风筝。", "one two three four five " * 9, "\x00\x01 § ¶ " * 6] + [f"A natural sentence about {i} dogs and no cat. " * (i % 5 + 1) for i in range(50)]
    df = as_samples(spark.createDataFrame([(i * 3, f"s{i}", f"{i}.jpg", t) for i, t in enumerate(texts)], "row_idx long, id string, image_path string, text string")).withColumn("text", F.when(F.col("id") != "s1", F.col("text")))
    ops, ctx = Pipeline({"ops": [{"name": "text_quality_filter"}, {"name": "lang_id_filter", "params": {"backend": "heuristic"}}]}), Context(spark)
    work = lambda rows: ops.transform(rows, ctx).drop("text", "conversations")
    seen = lambda rows: [(*r[:-1], sorted(r[-1].items()), sorted(r["scores"].items())) for r in rows.orderBy("row_idx").select("row_idx", "id", "image_path", "keep", "drop_reason", "drop_stage", "scores", "meta").collect()]
    six = dict.fromkeys(N.DEFAULT_COUNTS, 7)
    for counts in (six, six | {"mismatch": 0, "gibberish": 0}, six | {"wrong_lang": 500}, {"duplicate_exact": 1}):
        for seed in (1, 42):
            got = seen(N.inject(df, counts, seed, each=work))
            assert got == seen(work(N.inject(df, counts, seed))) and len(got) > len(texts)
