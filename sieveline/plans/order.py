"""Shuffled orders, and the first rows in them, without one task for all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Keys lie below this.
KEYS = 1 << 32


def order_key(seed: int, key: str = "row_idx") -> Column:
    """A number that shuffles rows the same way for the same seed, whatever their partitions; ties are for the caller.

    Plain integer arithmetic, so that any SQL engine can follow it.
    """
    return F.pmod(F.pmod(F.col(key), F.lit(2147483648)) * F.lit(2654435761) + F.lit(seed), F.lit(4294967291))


def first_rows(rows: DataFrame, n: int, key: str, tie: str, at_once: int = 100_000, fan: int = 256) -> DataFrame:
    """The ``n`` rows (all if fewer) of the least ``key`` (0 to 2^32), then ``tie``, in no order.

    Rows are counted by ranges of the key, and the range in which the n-th lies again by parts of it, until it holds
    ``at_once`` rows or is a single key: only those are sorted.  The counts, at most ``fan`` at a time, are all that
    comes to the driver.
    """
    low, width, before, held = 0, KEYS, 0, None
    while held is None or (held > at_once and width > 1):
        part = -(-width // fan)
        inside = rows.filter((F.col(key) >= low) & (F.col(key) < low + width))
        counts = sorted((r["at"], r["n"]) for r in inside.groupBy(F.floor((F.col(key) - low) / part).alias("at")).agg(F.count("*").alias("n")).collect())
        if before + sum(c for _, c in counts) <= n:
            return rows.filter(F.col(key) < low + width)
        for at, held in counts:
            if before + held > n:
                break
            before += held
        low, width = low + at * part, part
    edge = rows.filter((F.col(key) >= low) & (F.col(key) < low + width)).orderBy(key, tie).limit(n - before)
    return rows.filter(F.col(key) < low).unionByName(edge)


def renumbered(rows: DataFrame, width: int = 1 << 20) -> DataFrame:
    """Rows in the order of _order (0 to 2^32), row_idx, _part with a new row_idx from 0: ranges of _order are counted, then ranked."""
    bucketed = rows.withColumn("_bucket", F.floor(F.col("_order") / width))
    counts = bucketed.groupBy("_bucket").agg(F.count("*").alias("n"))
    before = counts.select("_bucket", F.coalesce(F.sum("n").over(Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    within = F.row_number().over(Window.partitionBy("_bucket").orderBy("_order", "row_idx", "_part")) - 1
    ranked = bucketed.withColumn("_within", within).join(F.broadcast(before), "_bucket")
    return ranked.withColumn("row_idx", F.col("_before") + F.col("_within")).drop("_order", "_part", "_bucket", "_within", "_before")


def running_sums(rows: DataFrame, keys: list[str], value: str, sums: dict[str, str], ranges: int = 4096) -> DataFrame:
    """``rows`` (unique by keys and value) with the sums of columns over all rows of the same keys with a smaller value.

    Values are counted by ranges between the least and the greatest first, then summed up within a range, so that a
    key with many values is not one task.  Values that have no place between the two (infinities, NaN) are in the
    first range together with all others of their key.
    """
    ends = rows.groupBy(*keys).agg(F.min(value).alias("_lo"), F.max(value).alias("_hi"))
    joined = rows.join(ends, keys) if keys else rows.crossJoin(F.broadcast(ends))
    share = (F.col(value) - F.col("_lo")) / F.nullif(F.col("_hi") - F.col("_lo"), F.lit(0))
    at = F.when(share.isNull() | F.isnan(share), F.lit(0)).otherwise(F.floor(share * ranges)).cast("long")
    ranged = joined.withColumn("_range", at).drop("_lo", "_hi")
    totals = ranged.groupBy(*keys, "_range").agg(*(F.sum(c).alias(f"_{c}") for c in sums))
    earlier = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select(*keys, "_range", *(F.coalesce(F.sum(f"_{c}").over(earlier), F.lit(0)).alias(f"_{c}") for c in sums))
    within = Window.partitionBy(*keys, "_range").orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    made = ranged.join(totals, [*keys, "_range"])
    return made.select(*rows.columns, *((F.col(f"_{c}") + F.coalesce(F.sum(c).over(within), F.lit(0))).alias(name) for c, name in sums.items()))
