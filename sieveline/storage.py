"""Intermediate tables in the folder that driver and executors share.

``spark.checkpoint.dir`` names that folder.  Where it is unset (tests, a laptop) a private temporary folder
is used, which is only right because such a session runs in one local JVM.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

_SETTING = "spark.checkpoint.dir"
#: Folders of the tables that this process has written and not removed, in order.
_MADE: list[str] = []


def shared_folder(spark: SparkSession) -> str:
    """The shared folder of this session."""
    folder = spark.conf.get(_SETTING, None)
    if not folder:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError(f"set {_SETTING} to a folder that the driver and all executors share")
        folder = tempfile.mkdtemp(prefix="sieveline-")
        spark.conf.set(_SETTING, folder)
    return folder.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing uses yet."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str = "table", group_rows: int | None = None) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back: computed once, lineage cut, survives lost executors.

    Readers decode up to 4,096 rows of a row group at once; ``group_rows`` bounds the rows of a group, for rows of many bytes.
    """
    path = new_path(df.sparkSession, name)
    out = df.write.option("compression", "zstd")
    (out.option("parquet.block.row.count.limit", group_rows) if group_rows else out).parquet(path)
    _MADE.append(path)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    table._written = path
    return table


def _delete(spark: SparkSession, folder: str) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(folder)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
    name = folder.rpartition("/")[2]
    _MADE[:] = [p for p in _MADE if p.rpartition("/")[2] != name]


def _folders(df: DataFrame) -> set[str]:
    own = vars(df).get("_written")  # a table without rows may have no files
    return {f.rpartition("/")[0] for f in df.inputFiles()} | ({own} if own else set())


def remove(df: DataFrame) -> None:
    """Delete the files of a table made by :func:`written` that nothing reads any more."""
    spark = df.sparkSession
    for folder in _folders(df):
        if folder.startswith(shared_folder(spark)) or folder.startswith("file:"):
            _delete(spark, folder)


def mark() -> int:
    """A place in the order in which tables are written, for :func:`discard`."""
    return len(_MADE)


def discard(spark: SparkSession, since: int, *kept: DataFrame) -> None:
    """Delete all tables written after a mark, but for those that ``kept`` reads; nothing else may read them any more."""
    names = {f.rpartition("/")[2] for df in kept for f in _folders(df)}
    for folder in [p for p in _MADE[since:] if p.rpartition("/")[2] not in names]:
        _delete(spark, folder)


def balanced(df: DataFrame, per_task: int = 32 << 20) -> DataFrame:
    """``df`` for work that is heavy per row: a table so small that its files give too few tasks is dealt over all cores.

    A table of over ``per_task`` bytes a core stays as it is: its splits keep all cores busy, and it is not shuffled.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return df.repartition(cores) if size <= per_task * cores else df


#: Bytes of an Arrow batch of rows with many bytes, where the session does not say.
BATCH_BYTES = 16 << 20
_BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"


def bound_batches(spark: SparkSession) -> None:
    """Arrow batches are bounded in bytes, unless the session says otherwise: 10,000 rows of pixels are more than a worker holds."""
    unset = str((1 << 31) - 1)
    if spark.conf.get(_BATCH_SETTING, unset) in (unset, "-1"):
        spark.conf.set(_BATCH_SETTING, str(BATCH_BYTES))


def write_text(spark: SparkSession, path: str, pieces: Iterable[str]) -> None:
    """Write text, piece by piece, to one file on any file system that the session knows; it replaces what is there."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = where.getFileSystem(spark._jsc.hadoopConfiguration()).create(where, True)
    try:
        for piece in pieces:
            out.write(bytearray(piece.encode("utf-8")))
    finally:
        out.close()


def read_text(spark: SparkSession, path: str) -> str | None:
    """The text of a small file on any file system that the session knows; None if it is missing."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where):
        return None
    return "\n".join(r[0] for r in spark.read.text(path, wholetext=True).collect())
