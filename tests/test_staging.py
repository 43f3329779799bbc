import os

import pytest

from quillmill import staging


class Session:
    """As much of a session as shared_root() asks for."""

    def __init__(self, **conf):
        self.conf = self
        self.values = {k.replace("_", "."): v for k, v in conf.items()}

    def get(self, key, default=None):
        return self.values.get(key, default)


def test_root_is_the_session_s_own():
    assert staging.shared_root(Session(spark_master="spark://x", spark_checkpoint_dir="hdfs://y/z/")) == "hdfs://y/z"
    for master in ("spark://x:7077", "yarn", "local-cluster[2,1,1024]"):
        with pytest.raises(RuntimeError):
            staging.shared_root(Session(spark_master=master))
    assert staging.shared_root(Session(spark_master="local[2]")).startswith("file://")


def test_tables_are_written_read_and_removed(spark):
    df = staging.stage(spark.range(10), "ten")
    path = df._staged_path
    assert df.count() == 10 and path.startswith(staging.shared_root(spark)) and "ten-" in path
    local = path.removeprefix("file://")
    assert os.path.isdir(local)
    staging.drop(df, spark.range(1))
    assert not os.path.exists(local) and all(p != path for _, p in staging._written)


def test_small_tables_become_few_files(spark):
    few = staging.FILES_A_CORE * spark.sparkContext.defaultParallelism
    base = staging.stage(spark.range(500), "base")
    df = staging.stage(base.repartition(100), "many")
    assert df.count() == 500 and staging.most_files(base) == few
    assert len([x for x in os.listdir(df._staged_path.removeprefix("file://")) if x.endswith(".parquet")]) <= few
    # what is not read from files has no size: its partitions stay
    assert staging.most_files(spark.createDataFrame([(1,)], "a int")) > few
    staging.drop(base, df)
