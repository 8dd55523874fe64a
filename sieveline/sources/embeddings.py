"""A table of embeddings (key, vec) that runs fill and reuse."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sieveline.context import Context
from sieveline.functions.scalar import unit
from sieveline.storage import written

#: Fixed value: keys of text vectors start with this; image vectors have the sample's id alone.
TEXT_PREFIX = "txt:"
SCHEMA = "key string, vec array<float>"


def load(spark: SparkSession, path: str) -> DataFrame:
    """The table at ``path`` (Parquet, or an .npz file with arrays keys and mat); empty if there is none."""
    if path.endswith(".npz"):
        stored = np.load(path, allow_pickle=False)
        rows = [(str(k), [float(x) for x in v]) for k, v in zip(stored["keys"], stored["mat"], strict=True)]
        return spark.createDataFrame(rows, SCHEMA)
    file = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not file.getFileSystem(spark._jsc.hadoopConfiguration()).exists(file):
        return spark.createDataFrame([], SCHEMA)
    return spark.read.schema(SCHEMA).parquet(path)


def one_each(table: DataFrame) -> DataFrame:
    """One vector for each key: the least of several."""
    return table.groupBy("key").agg(F.min("vec").alias("vec"))


def save(table: DataFrame, path: str) -> None:
    """Write the table, one vector for each key: as Parquet, or as an .npz file for other tools, which passes through the driver."""
    if not path.endswith(".npz"):
        one_each(table).write.mode("overwrite").parquet(path)
        return
    rows = [(r["key"], r["vec"]) for r in one_each(table).orderBy("key").toLocalIterator()]
    if rows:
        np.savez(path, keys=np.array([k for k, _ in rows]), mat=np.array([v for _, v in rows], np.float32))


def missing(df: DataFrame, table: DataFrame, prefix: str = "") -> DataFrame:
    """Rows alive whose vector the table lacks."""
    return df.filter("keep").join(table.select(F.col("key").alias("_key")), F.concat(F.lit(prefix), F.col("id")) == F.col("_key"), "left_anti")


def with_vectors(df: DataFrame, ctx: Context, name: str, prefix: str, encoder: str) -> DataFrame:
    """``df`` with a unit vector by id (null if there is none).  The provider ``encoder`` makes vectors that are missing.

    Made vectors are written once, so the provider does not run again for whatever reads them.  Each row alive counts
    as a hit or a miss of the store.
    """
    table = ctx.embeddings if ctx.embeddings is not None else ctx.spark.createDataFrame([], SCHEMA)
    encode = ctx.providers.get(encoder)
    if encode is not None:
        todo = written(missing(df, table, prefix), "missing")
        misses = todo.count()
        ctx.cache_misses += misses
        ctx.cache_hits += df.filter("keep").count() - misses
        if misses:
            made = encode(todo).select(F.concat(F.lit(prefix), F.col("key")).alias("key"), unit(F.col("vec")).cast("array<float>").alias("vec"))
            ctx.embeddings = table = table.select("key", "vec").unionByName(written(made, "vectors"))
    own = one_each(table.filter(F.col("key").startswith(TEXT_PREFIX) == F.lit(bool(prefix)))).withColumnsRenamed({"vec": name, "key": "_key"})
    return df.join(own, F.concat(F.lit(prefix), F.col("id")) == F.col("_key"), "left").drop("_key")
