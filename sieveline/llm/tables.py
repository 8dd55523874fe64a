"""The driver's tables, as the queries of this subpackage read them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sieveline.storage import balanced


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole table of documents; one of a few megabytes a core, whose one file would be one task, is dealt over all cores."""
    return balanced(spark.read.parquet(f"{sf_dir}/documents.parquet"), 4 << 20)
