"""Row-local operators over streams.

Their plans are projections, so they run unchanged on a streaming DataFrame; operators that compare rows are
for batches (use foreachBatch).
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from sieveline.context import Context
from sieveline.plans.pipeline import Pipeline
from sieveline.schema import as_samples


def transform_stream(stream: DataFrame, pipeline: Pipeline, ctx: Context) -> DataFrame:
    """``stream`` of samples, annotated.  Fails for pipelines with other than row-local operators."""
    other = [op.name for op in pipeline.ops if op.kind != "narrow"]
    if other:
        raise ValueError(f"not row-local: {', '.join(other)}")
    return pipeline.transform(as_samples(stream), ctx)


def exact_duplicates_out(stream: DataFrame, ts: str, keys: list[str], delay: str = "10 minutes") -> DataFrame:
    """``stream`` without rows whose ``keys`` came before, within the watermark's delay."""
    return stream.withWatermark(ts, delay).dropDuplicatesWithinWatermark(keys)
