"""Joins with a table that is unique per key, whatever share of the rows one key holds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A key that holds over one part in so many of the rows is hot; there can be no more hot keys than this.
PARTS = 1000


def join_unique(rows: DataFrame, table: DataFrame, keys: list[str], n: str, total: int, parts: int = PARTS) -> DataFrame:
    """The inner join of ``rows`` with ``table``, which has one row per key and in ``n`` how many of the rows hold it.

    Keys that hold over 1 / ``parts`` of all ``total`` rows are broadcast, fewer than ``parts`` of them for any data,
    so their rows stay where they are; the other keys are shuffled, and none of them makes a large task.  Rows with
    a null key match nothing.
    """
    is_hot = F.col(n) * parts > total
    hot = F.broadcast(table.filter(is_hot))
    own = rows.join(hot, keys).drop(n)
    rest = rows.join(F.broadcast(table.filter(is_hot).select(*keys)), keys, "left_anti")
    return own.unionByName(rest.join(table.filter(~is_hot), keys).drop(n).select(*own.columns))
