"""Training sets from annotated samples: all, kept, and a random set of the size of the kept."""

from __future__ import annotations

import json
from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sieveline.functions.scalar import or_text
from sieveline.functions.text import stripped
from sieveline.plans.noise import composition
from sieveline.plans.order import first_rows, order_key
from sieveline.schema import meta_text
from sieveline.storage import write_text, written

IMAGE_TOKEN = "<image>"
#: Roles of turns, and what they are in a training record.
ROLES = {"human": "user", "gpt": "assistant", "user": "user", "assistant": "assistant"}


def role_of(speaker: Column) -> Column:
    out = F.lit(None).cast("string")
    for name, role in ROLES.items():
        out = F.when(speaker == name, F.lit(role)).otherwise(out)
    return out


def extract_text(turns: Column) -> Column:
    """What the assistant says: its turns, stripped, those that are not blank, one a line."""
    said = F.filter(F.coalesce(turns, F.array().cast("array<struct<`from`:string,value:string>>")), lambda t: t["from"].isin("gpt", "assistant"))
    return F.array_join(F.filter(F.transform(said, lambda t: stripped(t["value"])), lambda v: v != ""), "\n")


def with_messages(df: DataFrame, image_root: str = "") -> DataFrame:
    """``df`` with messages (array of role, content) and images; both null for rows that cannot train.

    Those have no turns or no image, an unknown role or a blank turn, fewer than two turns, turns that do not
    alternate from the user on, or an image token anywhere but once in the first turn.  Without any token the
    first turn gets one.
    """
    turns = F.transform("conversations", lambda t: F.struct(role_of(t["from"]).alias("role"), stripped(t["value"]).alias("content")))
    df = df.withColumn("_turns", turns)
    tokens = lambda text: F.floor((F.length(text) - F.length(F.replace(text, F.lit(IMAGE_TOKEN), F.lit("")))) / len(IMAGE_TOKEN))
    count = F.aggregate("_turns", F.lit(0).cast("long"), lambda acc, t: acc + tokens(t["content"]))
    regular = F.forall(F.transform("_turns", lambda t, i: F.coalesce((t["role"] == F.when(i % 2 == 0, F.lit("user")).otherwise(F.lit("assistant"))) & (t["content"] != ""), F.lit(False))), lambda ok: ok)
    df = df.withColumns({"_tokens": count, "_regular": regular})
    first = F.get("_turns", 0)["content"]
    good = (F.size("_turns") >= 2) & F.col("_regular") & (F.coalesce(F.col("image_path"), F.lit("")) != "") & ((F.col("_tokens") == 0) | ((F.col("_tokens") == 1) & first.contains(IMAGE_TOKEN)))
    made = F.transform("_turns", lambda t, i: F.struct(t["role"].alias("role"), F.when((i == 0) & (F.col("_tokens") == 0), F.concat(F.lit(IMAGE_TOKEN + "\n"), t["content"])).otherwise(t["content"]).alias("content")))
    root = image_root.rstrip("/") + "/" if image_root else ""
    path = F.when(F.col("image_path").startswith("/"), F.col("image_path")).otherwise(F.concat(F.lit(root), F.col("image_path")))
    good = F.coalesce(good, F.lit(False))
    return df.withColumn("messages", F.when(good, made)).withColumn("images", F.when(good, F.array(path))).drop("_turns", "_tokens", "_regular")


def size_matched(rows: DataFrame, n: int, seed: int = 7) -> DataFrame:
    """Exactly ``n`` rows (all if fewer), by a shuffle that depends on row_idx and seed alone."""
    return first_rows(rows.withColumn("_key", order_key(seed)), n, "_key", "row_idx").drop("_key")


def groups(annotated: DataFrame, existing: DataFrame | None = None, seed: int = 7) -> dict[str, DataFrame]:
    """The sets a_dirty, b_cleaned and c_random.

    ``existing`` (image_path) leaves rows without an image out of all of them, before anything is split off.
    Fails if nothing was kept.
    """
    pool = annotated.join(existing.select("image_path").distinct(), "image_path", "left_semi").select(*annotated.columns) if existing is not None else annotated
    if "_written" not in vars(pool):  # what is written is read again, not written anew
        pool = written(pool, "pool")
    kept = pool.filter("keep")
    n = kept.count()
    if not n:
        raise ValueError("no row was kept")
    return {"a_dirty": pool, "b_cleaned": kept, "c_random": size_matched(pool, n, seed)}


def manifest(sets: dict[str, DataFrame], image_root: str, batch: int = 2, accumulate: int = 8, epochs: float = 1.0) -> dict:
    """Of each set: records, rows that cannot train, optimiser steps, and the composition of its pool; a warning if b and c differ in size."""
    out: dict = {"groups": {}, "warnings": []}
    for name, rows in sets.items():
        made = with_messages(rows, image_root).agg(F.count("messages").alias("n"), F.count("*").alias("all")).first()
        out["groups"][name] = {"n": made["n"], "unconvertible": made["all"] - made["n"], "optimizer_steps": max(1, int(made["n"] * epochs / (batch * accumulate))), "composition": {r["noise_type"]: r["n"] for r in composition(rows).collect()}}
    b, c = (out["groups"].get(k, {}).get("n") for k in ("b_cleaned", "c_random"))
    if b != c:
        out["warnings"].append(f"b_cleaned has {b} records, c_random {c}: the comparison is not size-matched")
    return out


def write_sets(sets: dict[str, DataFrame], folder: str, image_root: str, single_files: bool = False, prefix: str = "", **training) -> dict:
    """Each set below ``folder``, with dataset_info.json and manifest.json; on any file system that Spark writes to.

    A set is a folder of JSON lines, written by all executors; with ``single_files`` it is one array in
    ``<name>.json``, as trainers on one machine read it, whose rows pass through the driver one by one.  Sets are
    registered as ``prefix`` and name.
    """
    files = {}
    for name, rows in sets.items():
        ready = with_messages(rows, image_root).filter("messages is not null")
        lines = ready.select("row_idx", F.to_json(F.struct("messages", "images")).alias("value"))
        files[name] = f"{name}.json" if single_files else name
        if single_files:
            values = (r["value"] for r in lines.orderBy("row_idx").toLocalIterator())
            pieces = (piece for i, v in enumerate(values) for piece in (",\n" if i else "", v))
            write_text(rows.sparkSession, f"{folder}/{name}.json", chain(["["], pieces, ["]"]))
        else:
            lines.select("value").write.mode("overwrite").text(f"{folder}/{name}")
    found = manifest(sets, image_root, **training)
    for name in sets:
        found["groups"][name]["file"] = files[name]
    tags = {"role_tag": "role", "content_tag": "content", "user_tag": "user", "assistant_tag": "assistant"}
    info = {prefix + name: {"file_name": files[name], "formatting": "sharegpt", "columns": {"messages": "messages", "images": "images"}, "tags": tags} for name in sets}
    spark = next(iter(sets.values())).sparkSession
    for file, data in (("dataset_info.json", info), ("manifest.json", found)):
        write_text(spark, f"{folder}/{file}", [json.dumps(data, ensure_ascii=False, indent=2)])
    return found


def problems(records: DataFrame) -> DataFrame:
    """(problem, n) over records (messages, images): empty, without user turn first, or with tokens and images that differ in number."""
    tokens = F.aggregate("messages", F.lit(0).cast("long"), lambda acc, m: acc + F.floor((F.length(m["content"]) - F.length(F.replace(m["content"], F.lit(IMAGE_TOKEN), F.lit("")))) / len(IMAGE_TOKEN)))
    problem = F.when(F.size("messages") < 2, F.lit("too_few_turns")).when(F.get("messages", 0)["role"] != "user", F.lit("wrong_first_role")).when(tokens != F.size("images"), F.lit("token_count"))
    return records.select(problem.alias("problem")).filter("problem is not null").groupBy("problem").agg(F.count("*").alias("n"))


__all__ = ["extract_text", "groups", "manifest", "meta_text", "or_text", "problems", "size_matched", "with_messages", "write_sets"]
