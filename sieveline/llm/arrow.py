"""Helpers for the operators that run Python over Arrow batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType, _parse_datatype_string

ASCII_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
#: Rows handled at a time, so that a batch of very long texts is never held twice.
SLICE = 256


def unused(name: str, columns: list[str]) -> str:
    """``name``, or it with underscores in front, so that no column is called so."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def columns_of(schema: str) -> StructType:
    return _parse_datatype_string(schema)


#: Bytes of an Arrow batch, where the session does not say: JVM and Python hold a batch or two each per core.
BATCH_BYTES = 16 << 20
_BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"


def map_arrow(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str | StructType) -> DataFrame:
    """``df.mapInArrow`` with batches bounded in bytes, so that long texts do not add up."""
    spark = df.sparkSession
    if spark.conf.get(_BATCH_SETTING, str(BATCH_BYTES + 1)) == str(BATCH_BYTES + 1):
        spark.conf.set(_BATCH_SETTING, str(BATCH_BYTES))
    return df.mapInArrow(fn, schema)


def map_rows(df: DataFrame, fn: Callable[[Iterator[dict]], Iterator[dict]], schema: str) -> DataFrame:
    """``fn`` turns lists of column values into lists of column values, a slice of each Arrow batch at a time."""
    struct = columns_of(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrow = to_arrow_schema(struct)

        def slices():
            for batch in batches:
                for at in range(0, batch.num_rows, SLICE):
                    yield {k: v.to_pylist() for k, v in zip(batch.schema.names, batch.slice(at, SLICE).columns, strict=True)}

        for out in fn(slices()):
            yield pa.RecordBatch.from_arrays([pa.array(out[f.name], type=f.type) for f in arrow], schema=arrow)

    return map_arrow(df, run, struct)
