"""A chain of operators over samples, from a YAML file or a dictionary."""

from __future__ import annotations

import hashlib
import json
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import sieveline.operators  # noqa: F401
from sieveline.context import Context
from sieveline.plans import report as R
from sieveline.registry import build_op
from sieveline.schema import as_samples
from sieveline.sources import embeddings
from sieveline.sources.jsonl import read_jsonl, write_jsonl
from sieveline.storage import written


def _file(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def _write_text(spark: SparkSession, path: str, text: str) -> None:
    fs, p = _file(spark, path)
    out = fs.create(p, True)
    out.write(bytearray(text.encode()))
    out.close()


class Pipeline:
    """Operators are built at once, so that an unknown name or parameter fails before any data is read.

    Their order is kept: it decides which operator owns a rejection.  Row-local operators between two global ones
    make one projection; ``per_op`` writes and times every step instead, and is implied by checkpoints.
    """

    def __init__(self, spec: dict):
        self.spec = dict(spec)
        self.name = spec.get("name", "run")
        self.ops = [build_op(o["name"], o.get("params")) for o in spec.get("ops", [])]

    @classmethod
    def from_yaml(cls, path: str) -> Pipeline:
        import yaml

        with open(path, encoding="utf-8") as f:
            return cls(yaml.safe_load(f))

    def context(self, spark: SparkSession, **more) -> Context:
        ctx = Context(spark, self.spec.get("image_root") or "", self.output_dir, **more)
        if self.spec.get("cache_embeddings") and ctx.embeddings is None:
            ctx.embeddings = embeddings.load(spark, f"{self.output_dir}/embeddings")
        return ctx

    @property
    def output_dir(self) -> str:
        return self.spec.get("output_dir") or "outputs/run"

    def transform(self, df: DataFrame, ctx: Context) -> DataFrame:
        """All operators over samples, without writing anything: the annotated samples."""
        df = as_samples(df) if "drop_stage" not in df.columns else df
        for i, op in enumerate(self.ops):
            df = op.apply(df, ctx, i)
        return df

    # ------------------------------------------------------------ checkpoints

    def _step_path(self, i: int) -> str:
        """Of the state after step i: named by a hash of the input and all steps so far, so that no other configuration's is taken."""
        so_far = json.dumps([self.spec.get("input"), [[o["name"], o.get("params")] for o in self.spec.get("ops", [])[: i + 1]]], sort_keys=True)
        return f"{self.output_dir}/checkpoints/{i:02d}_{self.ops[i].name}_{hashlib.sha256(so_far.encode()).hexdigest()[:12]}"

    def latest_checkpoint(self, spark: SparkSession) -> int:
        """The number of the last step whose state was written in full; -1 for none."""
        found = -1
        for i in range(len(self.ops)):
            fs, p = _file(spark, f"{self._step_path(i)}/_SUCCESS")
            if fs.exists(p):
                found = i
        return found

    def run(self, spark: SparkSession, limit: int | None = None, resume: bool = False, per_op: bool = True, output_dir: str | None = None, ctx: Context | None = None, single_files: bool = False) -> dict:
        """Read, run, write annotated.jsonl, cleaned.jsonl and report.{json,md}; returns the report.

        With ``resume`` the last written step of this very configuration goes on; only later steps are reported.
        Stops running operators when no row is alive.
        """
        if output_dir:
            self.spec["output_dir"] = output_dir
        ctx = ctx or self.context(spark)
        begun = time.time()
        first = self.latest_checkpoint(spark) + 1 if resume else 0
        if first:
            df = spark.read.parquet(self._step_path(first - 1))
            if limit is not None:
                df = df.filter(F.col("row_idx") < limit)
        else:
            df = as_samples(read_jsonl(spark, self.spec["input"], limit))
        steps = []
        for i in range(first, len(self.ops)):
            op, at = self.ops[i], time.time()
            if per_op and df.filter("keep").isEmpty():
                break
            df = op.apply(df, ctx, i)
            if per_op:
                df.write.mode("overwrite").parquet(self._step_path(i))
                df = spark.read.parquet(self._step_path(i))
            steps.append({"stage_no": i, "name": op.name, "stage": op.stage, "params": op.describe(), "score_key": op.score_key, "elapsed_s": time.time() - at if per_op else None})
        if not per_op:
            df = written(df, "annotated")
        result = R.build_report(df, steps, self.name, time.time() - begun, (ctx.cache_hits, ctx.cache_misses))
        files = 1 if single_files else None
        write_jsonl(df, f"{self.output_dir}/annotated.jsonl", files)
        write_jsonl(df.filter("keep"), f"{self.output_dir}/cleaned.jsonl", files)
        if self.spec.get("cache_embeddings") and ctx.embeddings is not None:
            embeddings.save(written(ctx.embeddings, "embeddings"), f"{self.output_dir}/embeddings")
        _write_text(spark, f"{self.output_dir}/report.json", R.to_json(result))
        _write_text(spark, f"{self.output_dir}/report.md", R.to_markdown(result))
        return result
