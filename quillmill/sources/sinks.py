"""Sinks: Parquet and JSON, split, partitioned, swapped and resumable."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillmill.sources.readers import _fs, exists
from quillmill.staging import stage


def parquet(df: DataFrame, path: str, *, shards: int | None = None) -> None:
    """A directory of Parquet, in so many files if ``shards`` is set."""
    (df if shards is None else df.repartition(shards)).write.parquet(path)


def json_lines(df: DataFrame, path: str) -> None:
    """JSON lines; nulls are written."""
    df.write.option("ignoreNullFields", False).json(path)


def swap(df: DataFrame, path: str) -> None:
    """Writes beside ``path`` and then takes its place, so that a table may overwrite what it was read from."""
    spark = df.sparkSession
    tag = uuid.uuid4().hex[:8]
    new, old = f"{path.rstrip('/')}.new-{tag}", f"{path.rstrip('/')}.old-{tag}"
    df.write.parquet(new)
    p, fs = _fs(spark, path)
    as_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    if fs.exists(p) and not fs.rename(p, as_path(old)):
        raise OSError(f"{path} can't be moved away; the new table is in {new}")
    if not fs.rename(as_path(new), p):
        fs.rename(as_path(old), p)
        raise OSError(f"{new} can't be moved to {path}; the old table is back")
    fs.delete(as_path(old), True)


def by_column(df: DataFrame, path: str, column: str) -> None:
    """A directory for each value of a column, one pass; rows where it is null are left out."""
    df.where(F.col(column).isNotNull()).write.partitionBy(column).parquet(path)


def resume(spark: SparkSession, source: DataFrame, path: str, step, *, key: str = "file_name") -> int:
    """Applies ``step`` to the rows of files that the output hasn't got, and appends; the number of files done.

    A file counts as done when it is in the manifest beside the output, which is written last.
    """
    manifest = f"{path.rstrip('/')}.manifest"
    todo = source
    if exists(spark, manifest):
        todo = source.join(spark.read.parquet(manifest).select(key), key, "left_anti")
    # this run's files are written down before the step, and stay what they are whatever the source does meanwhile
    names = stage(todo.select(key).distinct(), "run")
    fresh = names.count()
    if fresh:
        step(todo).write.mode("append").parquet(path)
        names.write.mode("append").parquet(manifest)
    return fresh


def moved(spark: SparkSession, source: str, target: str, *, prefix: str = "", old: str = "", new: str = "") -> None:
    """The data files of a written directory moved into another, under names with a prefix and another ending."""
    jvm_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    p, fs = _fs(spark, source)
    fs.mkdirs(jvm_path(target))
    for status in fs.listStatus(p):
        name = status.getPath().getName()
        if name.startswith("part-"):
            name = name.removesuffix(old) + new if old else name
            if not fs.rename(status.getPath(), jvm_path(f"{target}/{prefix}{name}")):
                raise OSError(f"{status.getPath()} can't be moved to {target}")
