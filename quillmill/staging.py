"""Tables written part-way through a plan.

Lineage is cut by writing Parquet into the folder that the cluster shares, so
that a lost executor costs a re-read and never a recomputation of everything
before.  The folder is ``spark.checkpoint.dir``; only where that is unset (tests,
a laptop) is a temporary folder made.
"""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

FILES_A_CORE = 4
FILE_BYTES = 8 << 20

_written: list[tuple[SparkSession, str]] = []
_own_root: list[str] = []


def shared_root(spark: SparkSession) -> str:
    """The shared folder; one of our own only if the session names none and is local."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    master = spark.conf.get("spark.master", "local")
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if not _own_root:
        _own_root.append("file://" + tempfile.mkdtemp(prefix="quillmill-"))
    return _own_root[0]


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that nothing else uses; removed at exit."""
    path = f"{shared_root(spark)}/quillmill/{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex[:12]}"
    _written.append((spark, path))
    return path


def most_files(df: DataFrame) -> int:
    """How many files a staged table is given at most.

    Four for each core, or one for each FILE_BYTES of the files that its plan reads,
    whichever is more.  Thousands of partitions that hold next to nothing so become few
    files, and a table that grows with the input keeps its partitions.
    """
    leaves = df._jdf.queryExecution().analyzed().collectLeaves()
    read = sum(int(str(leaves.apply(k).stats().sizeInBytes())) for k in range(leaves.size()))
    return min(max(FILES_A_CORE * df.sparkSession.sparkContext.defaultParallelism, read // FILE_BYTES), (1 << 31) - 1)


def stage(df: DataFrame, label: str) -> DataFrame:
    """Writes ``df`` as Parquet to the shared folder and returns it read back."""
    spark = df.sparkSession
    path = fresh_path(spark, label)
    df.coalesce(most_files(df)).write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._staged_path = path
    return out


def drop(*frames: DataFrame) -> None:
    """Removes staged tables that no later plan reads."""
    for df in frames:
        path = getattr(df, "_staged_path", None)
        if path:
            _delete(df.sparkSession, path)


def _delete(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
    _written[:] = [x for x in _written if x[1] != path]


@atexit.register
def release() -> None:
    """Removes every staged table still there; called at exit."""
    for spark, path in list(_written):
        if spark.sparkContext._jsc is not None:
            _delete(spark, path)
    _written.clear()
