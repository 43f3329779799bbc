"""Summaries: counts, means, lengths, categories."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


def counted(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """The table with its rows counted on the way, without a job of its own."""
    seen = Observation(name)
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def mean_score(df: DataFrame, by: Sequence[str] = (), col: str = "score") -> DataFrame:
    """The mean of a score that may be text; what isn't a number is left out."""
    number = F.col(col).try_cast("double")
    return df.groupBy(*by).agg(F.avg(F.when(~F.isnan(number), number)).alias("mean_score"))


def length_stats(df: DataFrame, by: Sequence[str] = (), col: str = "text") -> DataFrame:
    n = F.length(col)
    return df.groupBy(*by).agg(F.avg(n).alias("mean_len"), F.max(n).alias("max_len"), F.min(n).alias("min_len"))


def value_counts(df: DataFrame, col: str) -> DataFrame:
    """Rows for each value but null, most frequent first."""
    return df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count("*").alias("n")).orderBy(F.desc("n"), col)


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    """The values of a column, null among them."""
    return df.select(col).distinct()


def files_by_directory(df: DataFrame, path: Column) -> DataFrame:
    folder = F.regexp_replace(path, "/[^/]*$", "")
    return df.select(folder.alias("directory"), path.alias("p")).groupBy("directory").agg(F.countDistinct("p").alias("files"))


def longest_list(df: DataFrame, col: str) -> DataFrame:
    return df.agg(F.max(F.size(col)).alias("max_size"))


def legal_or_other(c: Column, legal: Sequence[str]) -> Column:
    """Values outside the legal set, null too, as "other"."""
    return F.when(c.isin(*legal), c).otherwise("other")
