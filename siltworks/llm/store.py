"""Intermediate tables in the folder that the whole cluster shares.

A table written here cuts lineage and outlives the executors that made it.  A
query returns a frame that reads such tables, so they stay until the caller has
used it and says :func:`clear`.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..sources.scratch import folder

#: Folders taken by this process and not deleted.
_made: list[str] = []


def new_path(spark: SparkSession, name: str) -> str:
    """A folder that nothing is in yet, which :func:`clear` deletes."""
    _made.append(folder(spark, name))
    return _made[-1]


def _delete(spark: SparkSession, path: str) -> None:
    sc = spark.sparkContext
    folder = sc._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(sc._jsc.hadoopConfiguration()).delete(folder, True)
    if path in _made:
        _made.remove(path)


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._siltworks_path = path
    return out


def discard(df: DataFrame) -> None:
    """Delete a table made by :func:`cut` that nothing reads any more; other frames stay."""
    if path := getattr(df, "_siltworks_path", None):
        _delete(df.sparkSession, path)


def settled(spark: SparkSession, make: Callable[[], DataFrame], name: str) -> DataFrame:
    """``cut(make(), name)``; the tables that ``make`` has written on its way are deleted."""
    before = set(_made)
    out = cut(make(), name)
    for path in [p for p in _made if p not in before and p != out._siltworks_path]:
        _delete(spark, path)
    return out


def clear(spark: SparkSession) -> None:
    """Delete all tables that this process has made and not deleted; results that read them must have been used."""
    for path in list(_made):
        _delete(spark, path)
