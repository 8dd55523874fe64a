"""Samples as JSON Lines."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from sieveline.schema import SAMPLE, as_samples
from sieveline.storage import written

_CORE = ("id", "image_path", "text", "conversations", "keep", "drop_reason", "scores", "meta")


def _compact(value) -> str:
    return json.dumps(value, ensure_ascii=False)


def parse_line(line: str) -> dict:
    """One sample from its line: defaults filled in, unknown keys folded into meta; fails without an id or on bad JSON."""
    given = json.loads(line)
    if "id" not in given:
        raise ValueError(f"sample without id: {line[:200]}")
    meta = dict(given.get("meta") or {})
    meta.update({k: v for k, v in given.items() if k not in _CORE})
    turns = given.get("conversations")
    return {
        "id": str(given["id"]),
        "image_path": given.get("image_path"),
        "text": given.get("text", "") or "",
        "conversations": [{"from": t.get("from"), "value": t.get("value")} for t in turns] if turns is not None else None,
        "keep": bool(given.get("keep", True)),
        "drop_reason": given.get("drop_reason"),
        "scores": {k: float(v) for k, v in (given.get("scores") or {}).items()},
        "meta": {k: _compact(v) for k, v in meta.items()},
    }


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = to_arrow_schema(SAMPLE)
    for b in batches:
        rows = [parse_line(x) for x in b.column("value").to_pylist()]
        for r, i in zip(rows, b.column("row_idx").to_pylist(), strict=True):
            r |= {"row_idx": i, "drop_stage": None, "scores": list(r["scores"].items()), "meta": list(r["meta"].items())}
        yield pa.RecordBatch.from_pylist(rows, schema=schema)


def with_ordinals(lines: DataFrame) -> DataFrame:
    """Rows (file, block, at, value) with row_idx, their place in file order: counted by block, then placed within."""
    lines = written(lines, "lines")
    blocks = lines.groupBy("file", "block").agg(F.count("*").alias("n"), F.min("at").alias("low"))
    before = Window.orderBy("file", "block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select("file", "block", "low", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    return lines.join(blocks, ["file", "block"]).select((F.col("before") + F.col("at") - F.col("low")).alias("row_idx"), "value")


def read_jsonl(spark: SparkSession, path: str, limit: int | None = None) -> DataFrame:
    """Samples of a JSON Lines file or folder, in file order (row_idx from 0); blank lines do not count.

    ``limit`` takes the first rows.  A malformed line fails the query.
    """
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))
    lines = lines.filter(F.trim("value") != "").withColumn("at", F.monotonically_increasing_id())
    rows = with_ordinals(lines)
    if limit is not None:
        rows = rows.filter(F.col("row_idx") < limit)
    return rows.mapInArrow(_parse, SAMPLE)


def _line(r: dict) -> str:
    out = {"id": r["id"], "image_path": r["image_path"], "text": r["text"], "conversations": r["conversations"], "keep": r["keep"], "drop_reason": r["drop_reason"], "scores": dict(r["scores"] or ()), "meta": {k: json.loads(v) for k, v in (r["meta"] or ())}}
    return _compact(out)


def to_lines(df: DataFrame) -> DataFrame:
    """(row_idx, value): each sample as a line of JSON."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column("row_idx"), pa.array([_line(r) for r in b.to_pylist()], pa.string())], names=["row_idx", "value"])

    return as_samples(df).mapInArrow(run, "row_idx long, value string")


def write_jsonl(df: DataFrame, path: str, files: int | None = None) -> None:
    """Write samples in row order as a folder of part files; ``files=1`` for a single one."""
    lines = to_lines(df)
    lines = lines.repartitionByRange(files, "row_idx") if files else lines.repartitionByRange("row_idx")
    lines.sortWithinPartitions("row_idx").select("value").write.mode("overwrite").text(path)


def read_annotations(spark: SparkSession, path: str) -> DataFrame:
    """Raw annotations: one JSON array of {id, image, conversations}, with row_idx in array order."""
    schema = "id string, image string, conversations array<struct<`from`:string,value:string>>"
    whole = spark.read.text(path, wholetext=True)
    return whole.select(F.posexplode(F.from_json("value", f"array<struct<{schema.replace('id string', 'id:string').replace('image string', 'image:string').replace('conversations array', 'conversations:array')}>>", {"mode": "FAILFAST"}))).select(F.col("pos").cast("long").alias("row_idx"), "col.*")
