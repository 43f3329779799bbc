"""Sources: sets of files with provenance and a stable order of rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillmill.functions.config import signature
from quillmill.functions.text import decoded_path
from quillmill.operators.select import score_floor


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    p, fs = _fs(spark, path)
    return fs.exists(p)


def files(spark: SparkSession, path: str, suffix: str | Sequence[str], *, recursive: bool = True, exclude: str | None = None, contains: str | None = None) -> list[str]:
    """Paths under a directory by suffix, sorted; through Hadoop's file systems, so any store that Spark reads."""
    p, fs = _fs(spark, path)
    if not fs.exists(p):
        raise FileNotFoundError(path)
    suffixes, out = tuple([suffix] if isinstance(suffix, str) else suffix), []
    found = fs.listFiles(p, recursive)
    while found.hasNext():
        f = found.next().getPath()
        name = f.getName()
        if name.endswith(suffixes) and not (exclude and name.endswith(exclude)) and (contains is None or contains in name):
            out.append(f.toString())
    return sorted(out)


def subdirectories(spark: SparkSession, path: str) -> list[str]:
    """Names of the directories directly under a directory."""
    p, fs = _fs(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory())


def file_name() -> Column:
    """The path of a row's file as it is on disk."""
    return decoded_path(F.col("_metadata.file_path"))


def row_order() -> Column:
    """A row's place within a set of Parquet files: file path, then row number."""
    return F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"))


def parquet(spark: SparkSession, paths: str | Sequence[str], *, schema: T.StructType | str | None = None, tolerant: bool = False, merge: bool = False, recursive: bool = False) -> DataFrame:
    """One file, a directory, or a list of either.

    ``tolerant`` skips files that can't be read; ``merge`` takes the union of the files'
    columns; an explicit schema gives null for columns that a file lacks.
    """
    reader = spark.read.option("ignoreCorruptFiles", tolerant).option("mergeSchema", merge).option("recursiveFileLookup", recursive)
    if recursive:
        reader = reader.option("pathGlobFilter", "*.parquet")
    if schema is not None:
        reader = reader.schema(schema)
    return reader.parquet(*([paths] if isinstance(paths, str) else paths))


def json_lines(spark: SparkSession, paths: str | Sequence[str], schema: T.StructType | str) -> DataFrame:
    """JSON lines by an explicit schema, so that text that looks like a number stays text."""
    return spark.read.schema(schema).json([paths] if isinstance(paths, str) else list(paths))


def parquet_or_json(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """All Parquet and JSON-lines files directly in a directory, as one table with the schema's columns."""
    parts = [parquet(spark, p, schema=schema) for p in [files(spark, path, ".parquet", recursive=False)] if p]
    parts += [json_lines(spark, p, schema) for p in [files(spark, path, ".jsonl", recursive=False)] if p]
    if not parts:
        raise FileNotFoundError(f"no .parquet or .jsonl in {path}")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out


def first_data(spark: SparkSession, paths: str | Sequence[str], record: T.StructType | str) -> DataFrame:
    """Files that are one JSON object {"data": [[record, ...], ...]}: the records of the first list, with the path of their file."""
    record = T._parse_datatype_string(record) if isinstance(record, str) else record
    schema = T.StructType([T.StructField("data", T.ArrayType(T.ArrayType(record)))])
    whole = spark.read.option("multiLine", True).schema(schema).json([paths] if isinstance(paths, str) else list(paths))
    return whole.select(file_name().alias("file_name"), F.inline(F.get("data", 0)))


def tagged(df: DataFrame, tag: str) -> DataFrame:
    """Rows of files whose path has the tag; needs the scan directly below, whose files it prunes."""
    return df.where(F.contains(F.col("_metadata.file_path"), F.lit(tag)))


def has_column(spark: SparkSession, path: str, column: str) -> bool:
    """Whether a Parquet file's footer has the column; no row is read."""
    return column in spark.read.parquet(path).columns


def unmarked(spark: SparkSession, paths: Sequence[str], column: str = "new") -> list[str]:
    """The files that lack the marker column and so are still to be done."""
    return [p for p in paths if not has_column(spark, p, column)]


def not_done(paths: Sequence[str], manifest: DataFrame) -> DataFrame:
    """The paths that a manifest (file_name) has not."""
    todo = manifest.sparkSession.createDataFrame([(p,) for p in paths], "file_name string")
    return todo.join(manifest.select("file_name"), "file_name", "left_anti")


SCORED = "text string, score double"


def ingest(spark: SparkSession, directories: Sequence[str], *, suffix: str = ".parquet", min_score: float = 0.4, cache_dir: str | None = None) -> DataFrame:
    """Texts and scores of all files of all directories with ``file_name`` and ``order_key``.

    Files without a score add no rows; those that can't be read are skipped.  With
    ``cache_dir`` each directory is kept there under a signature of the directory and the
    parameters, and read from there the next time.
    """
    out = None
    for k, d in enumerate(directories):
        paths = files(spark, d, suffix)
        if not paths:
            continue
        rows = score_floor(parquet(spark, paths, schema=SCORED, tolerant=True).select("text", "score", F.col("_metadata")), min_score)
        order = F.struct(F.lit(k).alias("dir"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"))
        rows = rows.select("text", "score", file_name().alias("file_name"), order.alias("order_key"))
        if cache_dir:
            spot = f"{cache_dir}/{signature({'dir': d, 'min_score': min_score, 'suffix': suffix})}"
            if not exists(spark, f"{spot}/_SUCCESS"):
                rows.write.mode("overwrite").parquet(spot)
            rows = spark.read.schema(rows.schema).parquet(spot)
        out = rows if out is None else out.unionByName(rows)
    if out is None:
        raise FileNotFoundError(f"no {suffix} in {list(directories)}")
    return out


def training_rows(spark: SparkSession, path: str | Sequence[str], *, lang: str | None = None, limit: int | None = None, clean: bool = False) -> DataFrame:
    """(text, labels as double): names normalised, the first ``limit`` rows, then those with text and a number."""
    from quillmill.functions.judge import as_number
    from quillmill.functions.text import uniform
    from quillmill.operators.select import labels_named, renamed_to

    df = parquet(spark, path)
    if lang:
        df = tagged(df, f"_{lang}")
    kept = df.columns
    df = labels_named(renamed_to(df.select(*kept, row_order().alias("__o")), "text", ("content",)))
    if limit is not None:
        df = df.orderBy("__o").limit(limit)
    df = df.select("text", as_number(F.col("labels")).alias("labels")).where("text IS NOT NULL AND labels IS NOT NULL")
    return df.withColumn("text", uniform(F.col("text"))) if clean else df


def model_of(path: Column) -> Column:
    """The model that made a file, by its path."""
    return F.when(F.contains(path, F.lit("deepseek")), "deepseek-v2.5").when(F.contains(path, F.lit("coder")), "qwen2.5-coder-32b").otherwise("qwen2.5-72b")
