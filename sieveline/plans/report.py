"""What a pipeline did, per operator."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sieveline.functions.scalar import or_text, rate
from sieveline.plans.order import running_sums
from sieveline.schema import meta_text

QUANTILES = (("p10", 0.1), ("p50", 0.5), ("p90", 0.9))


def op_counts(annotated: DataFrame, ops: DataFrame) -> DataFrame:
    """(stage_no, op, n_in, n_dropped, n_out, drop_rate) of each operator in ``ops`` (stage_no, op).

    By drop_stage, so that two steps of one name are told apart and rows dropped before the run count for none.
    One aggregation over the samples; what follows has a row per operator.
    """
    sums = annotated.groupBy("drop_stage").agg(F.count("*").alias("n"))
    alive = annotated.agg(F.count_if("keep").alias("left"))
    per = ops.join(sums.withColumnRenamed("drop_stage", "stage_no"), "stage_no", "left").select("stage_no", "op", F.coalesce("n", F.lit(0)).alias("n_dropped"))
    after = Window.orderBy(F.desc("stage_no")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    per = per.withColumn("gone", F.sum("n_dropped").over(after)).join(F.broadcast(alive))
    n_in = F.col("left") + F.col("gone")
    return per.select("stage_no", "op", n_in.alias("n_in"), "n_dropped", (n_in - F.col("n_dropped")).alias("n_out"), F.bround(rate(F.col("n_dropped"), n_in), 4).alias("drop_rate"))


def reason_histogram(annotated: DataFrame) -> DataFrame:
    """(drop_stage, drop_reason, n)."""
    return annotated.filter("not keep").groupBy("drop_stage", "drop_reason").agg(F.count("*").alias("n"))


def noise_histogram(annotated: DataFrame) -> DataFrame:
    """(drop_stage, noise_type, n): rows without a noise type are clean."""
    return annotated.filter("not keep").groupBy("drop_stage", or_text(meta_text("noise_type"), "clean").alias("noise_type")).agg(F.count("*").alias("n"))


def _value_quantiles(rows: DataFrame, quantiles: dict[str, float], rule) -> DataFrame:
    """(key, n, lo, hi, avg, one column per quantile) of rows (key, value); ``rule`` gives an index from p and n.

    Equal values are counted first and ranked as one, so that no key is a list in one task.
    """
    counts = rows.filter("value is not null").groupBy("key", "value").agg(F.count("*").alias("c"))
    ranked = running_sums(counts, ["key"], "value", {"c": "before"}).withColumn("upto", F.col("before") + F.col("c"))
    totals = counts.groupBy("key").agg(F.sum("c").alias("n"), F.min("value").alias("lo"), F.max("value").alias("hi"), (F.sum(F.col("value") * F.col("c")) / F.sum("c")).alias("avg"))
    made = [F.min(F.when(F.col("upto") > rule(p, F.col("n")), F.col("value"))).alias(name) for name, p in quantiles.items()]
    return ranked.join(totals, "key").groupBy("key", "n", "lo", "hi", "avg").agg(*made)


def score_distribution(scores: DataFrame) -> DataFrame:
    """(key, n, min, p10, p50, p90, max, mean) of rows (key, value), rounded to 4 digits; quantiles at index min(n - 1, int(p * n))."""
    out = _value_quantiles(scores, dict(QUANTILES), lambda p, n: F.least(n - 1, F.floor(F.lit(float(p)) * n)))
    return out.select("key", "n", F.bround("lo", 4).alias("min"), *(F.bround(q, 4).alias(q) for q, _ in QUANTILES), F.bround("hi", 4).alias("max"), F.bround("avg", 4).alias("mean"))


def latency_quantiles(rows: DataFrame) -> DataFrame:
    """(key, n, p50, p90, p99) of rows (key, value); quantiles at index round(q * (n - 1)), halves to even."""
    out = _value_quantiles(rows, {"p50": 0.5, "p90": 0.9, "p99": 0.99}, lambda q, n: F.bround(F.lit(q) * (n - 1)))
    return out.select("key", "n", "p50", "p90", "p99")


def serving_stats(requests: DataFrame) -> DataFrame:
    """Of each level of concurrency: ok, failed, wall, req_per_s, out_tok_per_s, ttft_p50, ttft_p90, ttft_p99, tpot_p50, mean_out_tokens.

    ``requests`` has concurrency, ok, begun, ended (seconds), ttft, tpot and out_tokens.  wall is from the first begin
    to the last end, failed requests included; all else is of those that are ok, null where none is.  Quantiles of
    ttft are at index round(q * (n - 1)), halves to even; tpot_p50 is the median.
    """
    good = F.coalesce(F.col("ok"), F.lit(False))
    sums = requests.groupBy("concurrency").agg(F.count_if(good).alias("ok"), F.count_if(~good).alias("failed"), (F.max("ended") - F.min("begun")).alias("wall"), F.sum(F.when(good, F.col("out_tokens"))).alias("tokens"))
    of = lambda c: requests.filter(good).select(F.col("concurrency").alias("key"), F.col(c).alias("value"))
    first = _value_quantiles(of("ttft"), {"ttft_p50": 0.5, "ttft_p90": 0.9, "ttft_p99": 0.99}, lambda q, n: F.bround(F.lit(q) * (n - 1)))
    middle = _value_quantiles(of("tpot"), {"low": 0.0, "high": 1.0}, lambda q, n: F.floor((n - 1 + int(q)) / 2))
    joined = sums.join(first.withColumnRenamed("key", "concurrency").select("concurrency", "ttft_p50", "ttft_p90", "ttft_p99"), "concurrency", "left")
    joined = joined.join(middle.select(F.col("key").alias("concurrency"), ((F.col("low") + F.col("high")) / 2).alias("tpot_p50")), "concurrency", "left")
    some, wall = F.col("ok") > 0, F.nullif(F.col("wall"), F.lit(0))
    rates = [F.when(some, F.col("ok") / wall).alias("req_per_s"), F.when(some, F.col("tokens") / wall).alias("out_tok_per_s")]
    return joined.select("concurrency", "ok", "failed", "wall", *rates, "ttft_p50", "ttft_p90", "ttft_p99", "tpot_p50", (F.col("tokens") / F.nullif(F.col("ok"), F.lit(0))).alias("mean_out_tokens"))


def scores_of(annotated: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """(key, value) of the recorded scores."""
    rows = annotated.select(F.explode("scores").alias("key", "value"))
    return rows.filter(F.col("key").isin(keys)) if keys is not None else rows


def totals(annotated: DataFrame) -> DataFrame:
    """(n_input, n_output, overall_drop_rate)."""
    n, kept = F.count("*"), F.count_if("keep")
    return annotated.agg(n.alias("n_input"), kept.alias("n_output"), F.when(n == 0, F.lit(0.0)).otherwise(F.bround(1 - kept / n, 4)).alias("overall_drop_rate"))


def duplicate_ids(annotated: DataFrame) -> DataFrame:
    """(id, n) of ids that occur more than once."""
    return annotated.groupBy("id").agg(F.count("*").alias("n")).filter("n > 1")


def build_report(annotated: DataFrame, steps: list[dict], name: str, elapsed: float, cache: tuple[int, int] = (0, 0)) -> dict:
    """The report as a dictionary; ``steps`` has stage_no, name, stage, params, score_key and elapsed_s of each operator."""
    spark = annotated.sparkSession
    if not steps:
        t = totals(annotated).first()
        return {"config": name, "n_input": t["n_input"], "n_output": t["n_output"], "overall_drop_rate": t["overall_drop_rate"], "total_elapsed_s": round(elapsed, 2), "throughput_sps": round(t["n_input"] / elapsed, 2) if elapsed else 0.0, "embedding_cache": {"hits": cache[0], "misses": cache[1]}, "operators": []}
    ops = spark.createDataFrame([(s["stage_no"], s["name"]) for s in steps], "stage_no int, op string")
    counts = {r["stage_no"]: r for r in op_counts(annotated, ops).collect()}
    reasons, noise = {}, {}
    for r in reason_histogram(annotated).collect():
        reasons.setdefault(r["drop_stage"], {})[r["drop_reason"]] = r["n"]
    for r in noise_histogram(annotated).collect():
        noise.setdefault(r["drop_stage"], {})[r["noise_type"]] = r["n"]
    keys = [s["score_key"] for s in steps if s["score_key"]]
    dist = {r["key"]: r.asDict() for r in score_distribution(scores_of(annotated, keys)).collect()} if keys else {}
    t = totals(annotated).first()
    out = []
    for s in steps:
        c = counts[s["stage_no"]]
        d = dict(dist.get(s["score_key"], {}))
        d.pop("key", None)
        took = s.get("elapsed_s") or 0.0
        out.append({"name": s["name"], "stage": s["stage"], "params": s["params"], "n_in": c["n_in"], "n_dropped": c["n_dropped"], "n_out": c["n_out"], "drop_rate": c["drop_rate"], "elapsed_s": round(took, 3), "throughput_sps": round(c["n_in"] / took, 2) if took else 0.0, "drop_reasons": reasons.get(s["stage_no"], {}), "dropped_by_noise": noise.get(s["stage_no"], {}), "score_dist": d})
    return {"config": name, "n_input": t["n_input"], "n_output": t["n_output"], "overall_drop_rate": t["overall_drop_rate"], "total_elapsed_s": round(elapsed, 2), "throughput_sps": round(t["n_input"] / elapsed, 2) if elapsed else 0.0, "embedding_cache": {"hits": cache[0], "misses": cache[1]}, "operators": out}


def to_markdown(report: dict) -> str:
    lines = [f"# Run of {report['config']}", "", f"{report['n_input']} samples in, {report['n_output']} out ({report['overall_drop_rate']:.2%} dropped), {report['total_elapsed_s']} s.", "", "| operator | in | dropped | out | rate | s |", "|-|-|-|-|-|-|"]
    lines += [f"| {o['name']} | {o['n_in']} | {o['n_dropped']} | {o['n_out']} | {o['drop_rate']:.2%} | {o['elapsed_s']} |" for o in report["operators"]]
    for o in report["operators"]:
        if o["drop_reasons"]:
            lines += ["", f"## {o['name']}", ""] + [f"- {k}: {n}" for k, n in sorted(o["drop_reasons"].items(), key=lambda x: (-x[1], x[0]))]
            lines += [f"- of noise type {k}: {n}" for k, n in sorted(o["dropped_by_noise"].items(), key=lambda x: (-x[1], x[0]))]
        if o["score_dist"]:
            lines += ["", "Scores: " + ", ".join(f"{k} {v}" for k, v in o["score_dist"].items())]
    return "\n".join(lines) + "\n"


def to_json(report: dict) -> str:
    return json.dumps(report, ensure_ascii=False, indent=2)
