"""Checks of a folder of training sets before it is trained on."""

from __future__ import annotations

import json
import os
from collections import Counter
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sieveline.plans.sft import problems
from sieveline.storage import read_text, written

OK, WARN, SKIP, FAIL = "ok", "warn", "skip", "FAIL"
RECORD = "messages array<struct<role:string,content:string>>, images array<string>"


@dataclass(frozen=True)
class Finding:
    status: str
    title: str
    detail: str = ""


def records(spark: SparkSession, folder: str, name: str) -> DataFrame | None:
    """The records of a set, a folder of JSON lines or one array in a file; null records where a line is none; None if there is no set."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{name}.json")
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if fs.exists(path):
        return spark.read.schema(f"{RECORD}, broken string").option("multiLine", True).option("columnNameOfCorruptRecord", "broken").json(f"{folder}/{name}.json")
    if fs.exists(spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{name}")):
        return spark.read.schema(f"{RECORD}, broken string").option("columnNameOfCorruptRecord", "broken").json(f"{folder}/{name}")
    return None


def check(spark: SparkSession, folder: str, groups: list[str], prefix: str = "", probe: int = 50, seed: int = 0) -> list[Finding]:
    """Whether sets are registered, there and readable, of equal size where that is what they are for, with images that exist and tokens that match them.

    Of each set ``probe`` records, those of the least hash for the seed, have their images looked up on this machine.
    """
    out = []
    info = read_text(spark, f"{folder}/dataset_info.json")
    if info is None:
        out.append(Finding(FAIL, "registration", "dataset_info.json is missing"))
    else:
        lacking = [prefix + g for g in groups if prefix + g not in json.loads(info)]
        out.append(Finding(FAIL, "registration", "no entry for " + ", ".join(lacking)) if lacking else Finding(OK, "registration"))
    found: dict[str, tuple[DataFrame, int]] = {}
    for g in groups:
        rows = records(spark, folder, g)
        if rows is None:
            out.append(Finding(FAIL, g, "missing"))
            continue
        rows = written(rows, "records")
        n, broken = rows.agg(F.count("*"), F.count("broken")).first()
        if broken or not n:
            out.append(Finding(FAIL, g, f"{broken} of {n} records cannot be read" if n else "empty"))
            continue
        out.append(Finding(OK, g, f"{n} records"))
        found[g] = rows.drop("broken"), n
    if {"b_cleaned", "c_random"} <= found.keys():
        b, c = found["b_cleaned"][1], found["c_random"][1]
        out.append(Finding(OK if b == c else WARN, "size control", f"b_cleaned {b}, c_random {c}"))
    else:
        out.append(Finding(SKIP, "size control", "a set is missing"))
    for g, (rows, _) in found.items():
        some = rows.select(F.get("images", 0).alias("image"), F.xxhash64(F.to_json("images"), F.to_json("messages"), F.lit(seed)).alias("order")).orderBy("order").limit(probe).collect()
        gone = [r["image"] for r in some if r["image"] is None or not os.path.exists(r["image"])]
        out.append(Finding(FAIL if gone else OK, f"images of {g}", f"{len(gone)} of {len(some)} do not exist" + (f", as {gone[0]}" if gone else "")))
        wrong = {r["problem"]: r["n"] for r in problems(rows).collect()}
        out.append(Finding(FAIL if wrong else OK, f"records of {g}", ", ".join(f"{k}: {n}" for k, n in sorted(wrong.items()))))
    return out


def tallies(found: list[Finding]) -> dict[str, int]:
    """How many findings of each status."""
    counts = Counter(f.status for f in found)
    return {s: counts[s] for s in (OK, WARN, SKIP, FAIL)}


def to_text(found: list[Finding]) -> str:
    lines = [f"[{f.status}] {f.title}" + (f": {f.detail}" if f.detail else "") for f in found]
    return "\n".join([*lines, ", ".join(f"{n} {s}" for s, n in tallies(found).items())])
