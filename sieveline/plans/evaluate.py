"""How well operators find labelled noise."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sieveline.functions.scalar import op_of, prf, rate
from sieveline.plans.order import running_sums
from sieveline.schema import meta_text, meta_true
from sieveline.storage import write_text


def labelled(annotated: DataFrame) -> DataFrame:
    """The columns that evaluation needs: row_idx, id, keep, op, is_noise, noise_type, duplicate_source."""
    return annotated.select("row_idx", "id", "keep", op_of(F.col("drop_reason")).alias("op"), meta_true("is_noise").alias("is_noise"), meta_text("noise_type").alias("noise_type"), meta_text("duplicate_source").alias("duplicate_source"))


def overall(rows: DataFrame) -> DataFrame:
    """(n_samples, n_noise, n_dropped, tp, fp, fn, precision, recall, f1): dropping noise is right."""
    sums = rows.agg(F.count("*").alias("n_samples"), F.count_if("is_noise").alias("n_noise"), F.count_if(~F.col("keep")).alias("n_dropped"), F.count_if(~F.col("keep") & F.col("is_noise")).alias("tp"), F.count_if(~F.col("keep") & ~F.col("is_noise")).alias("fp"), F.count_if(F.col("keep") & F.col("is_noise")).alias("fn"))
    return sums.select("*", *(c.alias(n) for n, c in prf(F.col("tp"), F.col("fp"), F.col("fn")).items()))


def per_operator(rows: DataFrame) -> DataFrame:
    """(op, dropped, true_noise, false_positives, precision, share_of_all_noise), in one pass over the rows by grouping sets."""
    cube = rows.withColumn("gone", F.when(~F.col("keep"), F.col("op"))).groupingSets([[], ["gone"]], "gone").agg(F.grouping("gone").alias("g"), F.count("*").alias("n"), F.count_if("is_noise").alias("noise"))
    total = cube.filter("g = 1").select(F.col("noise").alias("total"))
    per = cube.filter("g = 0 and gone is not null").join(F.broadcast(total))
    return per.select(F.col("gone").alias("op"), F.col("n").alias("dropped"), F.col("noise").alias("true_noise"), (F.col("n") - F.col("noise")).alias("false_positives"), F.bround(rate(F.col("noise"), F.col("n")), 4).alias("precision"), F.bround(rate(F.col("noise"), F.col("total")), 4).alias("share_of_all_noise"))


def operator_noise_types(rows: DataFrame) -> DataFrame:
    """(op, noise_type, n) of the noise that operators dropped; 'unknown' for noise without a type."""
    return rows.filter("not keep and is_noise").groupBy("op", F.coalesce("noise_type", F.lit("unknown")).alias("noise_type")).agg(F.count("*").alias("n"))


def per_noise_type(rows: DataFrame) -> DataFrame:
    """(noise_type, total, caught, recall) of rows that have a noise type, whatever is_noise says."""
    sums = rows.filter("coalesce(noise_type, '') <> ''").groupBy("noise_type").agg(F.count("*").alias("total"), F.count_if(~F.col("keep")).alias("caught"))
    return sums.select("*", F.bround(rate(F.col("caught"), F.col("total")), 4).alias("recall"))


def caught_by(rows: DataFrame) -> DataFrame:
    """(noise_type, op, n) of rows dropped."""
    return rows.filter("coalesce(noise_type, '') <> '' and not keep").groupBy("noise_type", "op").agg(F.count("*").alias("n"))


def dedup_groups(rows: DataFrame) -> DataFrame:
    """(n_groups, collapsed_to_one, under_deduplicated, over_deleted, collapse_rate): a source with its copies is right if one member is left.

    Only sources that are present count.  Of an id that occurs more than once the last row speaks, once per group.
    """
    last = rows.groupBy("id").agg(F.max_by("keep", "row_idx").alias("keep"))
    pairs = rows.filter("coalesce(duplicate_source, '') <> ''").select(F.col("duplicate_source").alias("source"), "id")
    pairs = pairs.join(last.select(F.col("id").alias("source")), "source", "left_semi")
    members = pairs.unionByName(pairs.select("source", F.col("source").alias("id"))).distinct()
    left = members.join(last, "id").groupBy("source").agg(F.count_if("keep").alias("left"))
    sums = left.agg(F.count("*").alias("n_groups"), F.count_if(F.col("left") == 1).alias("collapsed_to_one"), F.count_if(F.col("left") > 1).alias("under_deduplicated"), F.count_if(F.col("left") == 0).alias("over_deleted"))
    return sums.select("*", F.bround(rate(F.col("collapsed_to_one"), F.col("n_groups")), 4).alias("collapse_rate"))


def sweep_rows(annotated: DataFrame, score_key: str, target: str = "any") -> DataFrame:
    """(v, y): scores and labels that a sweep looks at; for one noise type, its rows and the clean ones."""
    rows = annotated.select(F.col("scores")[score_key].alias("v"), meta_true("is_noise").alias("noise"), meta_text("noise_type").alias("type")).filter("v is not null")
    if target == "any":
        return rows.select("v", F.col("noise").alias("y"))
    own = F.coalesce(F.col("type") == target, F.lit(False))
    return rows.filter(~F.col("noise") | own).select("v", own.alias("y"))


def sweep(rows: DataFrame, steps: int = 20, direction: str = "low") -> DataFrame:
    """(threshold, tp, fp, fn, precision, recall, f1) for thresholds at quantiles of the scores of ``rows`` (v, y).

    Thresholds are the values at index min(n - 1, int(i / steps * n)), and one past the greatest.  direction low:
    scores under the threshold are called noise; high: those over it.  Scores are counted by value and summed up
    once; a threshold then looks up the sums, so rows are never compared with every threshold.
    """
    counts = rows.groupBy("v").agg(F.count("*").alias("n"), F.count_if("y").alias("p"))
    sums = running_sums(counts, [], "v", {"n": "nb", "p": "pb"})
    total = counts.agg(F.sum("n").alias("tn"), F.sum("p").alias("tp_all"), F.max("v").alias("hi"))
    at = F.explode(F.array(*(F.least(F.col("tn") - 1, F.floor(F.lit(i / steps) * F.col("tn"))) for i in range(steps + 1)))).alias("at")
    wanted = total.filter("tn > 0").select("tn", "tp_all", at).distinct()
    hit = sums.join(F.broadcast(wanted), (F.col("nb") <= F.col("at")) & (F.col("at") < F.col("nb") + F.col("n")))
    past = F.col("hi") + F.abs("hi") * F.lit(0.01) + F.lit(1e-6)
    own = hit.select(F.col("v").alias("t"), "nb", "pb", (F.col("nb") + F.col("n")).alias("na"), (F.col("pb") + F.col("p")).alias("pa"), "tn", "tp_all").distinct()
    end = total.filter("tn > 0").select(past.alias("t"), F.col("tn").alias("nb"), F.col("tp_all").alias("pb"), F.col("tn").alias("na"), F.col("tp_all").alias("pa"), "tn", "tp_all")
    every = own.unionByName(end).distinct()
    called, right = (F.col("nb"), F.col("pb")) if direction == "low" else (F.col("tn") - F.col("na"), F.col("tp_all") - F.col("pa"))
    made = every.select(F.col("t").alias("threshold"), right.alias("tp"), (called - right).alias("fp"), (F.col("tp_all") - right).alias("fn"))
    return made.select(F.bround("threshold", 4).alias("threshold"), "tp", "fp", "fn", *(c.alias(n) for n, c in prf(F.col("tp"), F.col("fp"), F.col("fn")).items()))


def best_threshold(swept: DataFrame) -> DataFrame:
    """The row of the greatest F1, the lowest threshold of equals."""
    return swept.orderBy(F.desc("f1"), "threshold").limit(1)


def evaluate(annotated: DataFrame) -> dict:
    """All of the above as a dictionary."""
    rows = labelled(annotated).cache()
    try:
        o = overall(rows).first().asDict()
        ops = {r["op"]: {k: v for k, v in r.asDict().items() if k != "op"} | {"noise_types": {}} for r in per_operator(rows).collect()}
        for r in operator_noise_types(rows).collect():
            ops[r["op"]]["noise_types"][r["noise_type"]] = r["n"]
        types = {r["noise_type"]: {k: v for k, v in r.asDict().items() if k != "noise_type"} | {"caught_by": {}} for r in per_noise_type(rows).collect()}
        for r in caught_by(rows).collect():
            types[r["noise_type"]]["caught_by"][r["op"]] = r["n"]
        groups = dedup_groups(rows).first().asDict()
    finally:
        rows.unpersist()
    return {"n_samples": o.pop("n_samples"), "n_noise": o.pop("n_noise"), "n_dropped": o.pop("n_dropped"), "overall": o, "per_operator": dict(sorted(ops.items())), "per_noise_type": dict(sorted(types.items())), "dedup_groups": groups}


def to_markdown(found: dict, swept: list[dict] | None = None) -> str:
    o = found["overall"]
    lines = ["# Evaluation", "", f"{found['n_samples']} samples, {found['n_noise']} noise, {found['n_dropped']} dropped: precision {o['precision']}, recall {o['recall']}, F1 {o['f1']}.", "", "| operator | dropped | noise | false | precision | share |", "|-|-|-|-|-|-|"]
    lines += [f"| {k} | {v['dropped']} | {v['true_noise']} | {v['false_positives']} | {v['precision']} | {v['share_of_all_noise']} |" for k, v in sorted(found["per_operator"].items(), key=lambda x: (-x[1]["dropped"], x[0]))]
    lines += ["", "| noise type | total | caught | recall |", "|-|-|-|-|"] + [f"| {k} | {v['total']} | {v['caught']} | {v['recall']} |" for k, v in found["per_noise_type"].items()]
    if swept:
        best = max(swept, key=lambda r: (r["f1"], -r["threshold"]))
        lines += ["", "| threshold | precision | recall | F1 |", "|-|-|-|-|"] + [f"| {r['threshold']} | {r['precision']} | {r['recall']} | {r['f1']} |" for r in swept] + ["", f"Best: {best['threshold']} (F1 {best['f1']})."]
    return "\n".join(lines) + "\n"


def write(spark: SparkSession, found: dict, folder: str, swept: list[dict] | None = None) -> None:
    """op_eval.json and op_eval.md in a folder of any file system that the session knows."""
    write_text(spark, f"{folder}/op_eval.json", [json.dumps(found | ({"sweep": swept} if swept else {}), ensure_ascii=False, indent=2)])
    write_text(spark, f"{folder}/op_eval.md", [to_markdown(found, swept)])


__all__ = ["Column", "best_threshold", "caught_by", "dedup_groups", "evaluate", "labelled", "operator_noise_types", "overall", "per_noise_type", "per_operator", "sweep", "sweep_rows", "to_markdown", "write"]
