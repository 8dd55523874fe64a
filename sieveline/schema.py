"""The sample: one image-text training row and what the operators have found out about it."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SAMPLE = T.StructType(
    [
        T.StructField("row_idx", T.LongType(), False),
        T.StructField("id", T.StringType()),
        T.StructField("image_path", T.StringType()),
        T.StructField("text", T.StringType()),
        T.StructField("conversations", T.ArrayType(T.StructType([T.StructField("from", T.StringType()), T.StructField("value", T.StringType())]))),
        T.StructField("keep", T.BooleanType()),
        T.StructField("drop_reason", T.StringType()),
        T.StructField("scores", T.MapType(T.StringType(), T.DoubleType())),
        # values are JSON, so that any value survives reading and writing
        T.StructField("meta", T.MapType(T.StringType(), T.StringType())),
        # our own: number of the pipeline step that dropped the row
        T.StructField("drop_stage", T.IntegerType()),
    ]
)

_DEFAULTS = {"text": "''", "keep": "true", "scores": "cast(map() as map<string,double>)", "meta": "cast(map() as map<string,string>)"}


def as_samples(df: DataFrame) -> DataFrame:
    """``df`` with all sample columns: those that are missing or null get their defaults; further columns are dropped."""
    made = []
    for f in SAMPLE.fields:
        default = F.expr(_DEFAULTS[f.name]) if f.name in _DEFAULTS else F.lit(None)
        value = F.coalesce(F.col(f.name), default) if f.name in df.columns else default
        made.append(value.cast(f.dataType).alias(f.name))
    return df.select(*made)


def with_entry(entries: Column, key: str, value: Column) -> Column:
    """A map with one entry set."""
    return F.map_concat(F.map_filter(entries, lambda k, _: k != key), F.create_map(F.lit(key), value))


def with_entries(entries: Column, values: dict[str, Column]) -> Column:
    """A map with the entries set whose value is not null.

    The map is read once, so that chains of operators stay small; values should be columns, as they are read for
    every entry.
    """
    replaced = lambda k, _: ~reduce(lambda x, y: x | y, [(k == key) & v.isNotNull() for key, v in values.items()])
    given = F.filter(F.array(*(F.struct(F.lit(k).alias("key"), v.alias("value")) for k, v in values.items())), lambda e: e["value"].isNotNull())
    return F.map_concat(F.map_filter(entries, replaced), F.map_from_entries(given))


def meta_text(key: str, meta: str = "meta") -> Column:
    """A meta value as text: a JSON string unquoted, anything else as it is written; null if absent or null."""
    raw = F.col(meta)[key]
    return F.when(raw == "null", F.lit(None)).when(raw.startswith('"'), F.from_json(F.concat(F.lit("["), raw, F.lit("]")), "array<string>")[0]).otherwise(raw)


def meta_true(key: str, meta: str = "meta") -> Column:
    """Whether a meta value is present and neither false, null, zero nor empty."""
    raw = F.col(meta)[key]
    return F.coalesce(~raw.isin("false", "null", "0", "0.0", '""', "[]", "{}"), F.lit(False))


def json_text(value: Column) -> Column:
    """A string column as a JSON value; null stays null."""
    return F.when(value.isNotNull(), F.regexp_replace(F.regexp_replace(F.to_json(F.struct(value.alias("v"))), r'^\{"v":', ""), r"\}$", ""))
