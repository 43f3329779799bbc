"""Row numbers over a whole table without bringing it into one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quillmill.staging import stage


def row_numbers(df: DataFrame, order: Sequence[str], out: str, *, start: int = 1) -> DataFrame:
    """Numbers rows in the order: dealt by range, counted by partition, numbered within each.

    The order must tell rows apart.  What is broadcast is one number for each partition.
    """
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = stage(df.repartitionByRange(n, *order).withColumn("__p", F.spark_partition_id()), "dealt")
    sizes = dealt.groupBy("__p").agg(F.count("*").alias("__n"))
    before = sizes.select("__p", (F.sum("__n").over(Window.orderBy("__p")) - F.col("__n")).alias("__before"))
    own = F.row_number().over(Window.partitionBy("__p").orderBy(*order))
    return dealt.withColumn("__r", own).join(F.broadcast(before), "__p").withColumn(out, F.col("__before") + F.col("__r") + (start - 1)).drop("__p", "__r", "__before")
