"""Dedup of a stream of files: goes beyond what batch keep-first needs, and shares its digest."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillmill.operators.dedup import digest


def new_texts(spark: SparkSession, path: str, schema: T.StructType | str, *, column: str = "text", how: str = "md5", files_per_batch: int = 100) -> DataFrame:
    """Rows of Parquet files as they arrive, without those whose text was seen before; the state is the set of digests."""
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)
    return stream.withColumn("digest", F.coalesce(digest(F.col(column), how), F.lit("null"))).dropDuplicates(["digest"])


def run_available(df: DataFrame, out: str, checkpoint: str) -> None:
    """Writes what has arrived and ends; the checkpoint remembers files and digests for the next run."""
    df.writeStream.format("parquet").option("checkpointLocation", checkpoint).trigger(availableNow=True).start(out).awaitTermination()
