"""Projections, filters, bands, samples and orders over DataFrames."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillmill.functions.judge import as_number

# Half-open score bands, named by what they hold.
BANDS = {"0.6-0.8": (0.6, 0.8), "0.8-2": (0.8, 2.0)}


def renamed_to(df: DataFrame, target: str, aliases: Sequence[str]) -> DataFrame:
    """The first alias that the table has is renamed; a table with the target already, or without alias, stays as it is."""
    if target in df.columns:
        return df
    found = next((a for a in aliases if a in df.columns), None)
    return df if found is None else df.withColumnRenamed(found, target)


def text_named(df: DataFrame) -> DataFrame:
    return renamed_to(df, "text", ("content", "md"))


def labels_named(df: DataFrame) -> DataFrame:
    return renamed_to(df, "labels", ("score", "scores"))


def score_floor(df: DataFrame, least: float = 0.4, col: str = "score") -> DataFrame:
    """Rows with a score of ``least`` or more; null and NaN are none.  The plain comparison stays apart, so that it is pushed to the scan."""
    return df.where((F.col(col) >= least) & ~F.isnan(col))


def band(score: Column, bands: dict[str, tuple[float, float]] = BANDS) -> Column:
    """The name of the half-open band that a score is in; null outside all of them and for NaN."""
    out = None
    for name, (low, high) in bands.items():
        inside = (score >= low) & (score < high) & ~F.isnan(score)
        out = F.when(inside, name) if out is None else out.when(inside, name)
    return out


def banded(df: DataFrame, col: str = "score", bands: dict[str, tuple[float, float]] = BANDS) -> DataFrame:
    """Rows in any band, with the band's name.  Bounds are plain comparisons, so that they are pushed to the scan."""
    low, high = min(b[0] for b in bands.values()), max(b[1] for b in bands.values())
    return df.where((F.col(col) >= low) & (F.col(col) < high)).withColumn("band", band(F.col(col), bands)).where("band IS NOT NULL")


def with_text(df: DataFrame) -> DataFrame:
    """Rows whose text is not null; an empty one stays."""
    return df.where(F.col("text").isNotNull())


def with_number(df: DataFrame, col: str = "labels") -> DataFrame:
    """Rows whose label reads as a number."""
    return df.where(as_number(F.col(col)).isNotNull())


def without_nulls(df: DataFrame, *cols: str) -> DataFrame:
    return df.dropna(how="any", subset=list(cols))


def at_least(df: DataFrame, col: str, least: float) -> DataFrame:
    """Rows whose value reads as a number of ``least`` or more."""
    number = F.col(col).try_cast("double")
    return df.where((number >= least) & ~F.isnan(number))


def title_ends_in_date(title: Column) -> Column:
    return title.rlike(r"\d+[年月]$")


def title_is_latin(title: Column) -> Column:
    """Latin letters and no CJK character."""
    return title.rlike("[a-zA-Z]") & ~title.rlike(r"[\x{4e00}-\x{9fff}]")


def tags_contain(tags: Column, part: str, *, whole: bool = False) -> Column:
    """Whether a tag is, or contains, ``part``."""
    return F.array_contains(tags, part) if whole else F.exists(tags, lambda t: F.contains(t, F.lit(part)))


def first_rows(df: DataFrame, n: int, *order: str) -> DataFrame:
    """The first n rows in the order, nulls first; taken before any later filter.

    ``order`` must tell rows apart: ties at the end all stay.  Only the columns of the order
    go through the top-k; whole rows are kept or not where they lie, by the last key.
    """
    key = F.struct(*[F.col(c).alias(f"o{k}") for k, c in enumerate(order)])
    last = df.select(key.alias("__k")).orderBy("__k").limit(n).agg(F.max("__k").alias("__last"))
    return df.join(F.broadcast(last), key <= F.col("__last")).drop("__last")


def shuffle_key(seed: int, *key: str | Column) -> Column:
    """A reproducible random order: the MD5 of key and seed, the same in any engine."""
    return F.md5(F.concat_ws("-", *[F.col(k).cast("string") if isinstance(k, str) else k.cast("string") for k in key], F.lit(str(seed))))


def sample_cap(df: DataFrame, cap: int = 500_000, *, seed: int = 0, key: Sequence[str] = ("doc_id",)) -> DataFrame:
    """At most ``cap`` rows, the first by a random order, the same on every run.

    ``key`` must tell rows apart; of rows with one key all stay or none.  Two passes over
    keys find where the order is cut: counts of 2**16 ranges of it first, and then the keys
    of the one range that the cut falls into.  Whole rows are kept or not where they lie,
    and a table with no more rows than ``cap`` stays as it is.
    """
    place = shuffle_key(seed, *key)
    ranges = df.groupBy(F.substring(place, 1, 4).alias("r")).agg(F.count("*").alias("n")).collect()
    if sum(x["n"] for x in ranges) <= cap:
        return df
    room, cut = cap, "0000"
    for x in sorted(ranges, key=lambda x: x["r"]):
        cut = x["r"]
        if x["n"] > room:
            break
        room -= x["n"]
    own = Window.orderBy("__o", *key).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    inside = df.where(F.substring(place, 1, 4) == cut).groupBy(place.alias("__o"), *key).agg(F.count("*").alias("__n"))
    last = inside.withColumn("__up", F.sum("__n").over(own)).where(F.col("__up") <= room).agg(F.max(F.struct("__o", *key)).alias("__last"))
    before = F.substring(place, 1, 4) < cut
    exactly = (F.substring(place, 1, 4) == cut) & (F.struct(place.alias("__o"), *key) <= F.col("__last"))
    return df.join(F.broadcast(last), before | F.coalesce(exactly, F.lit(False))).drop("__last")


def shuffled(df: DataFrame, *, seed: int = 1, key: Sequence[str] = ("doc_id",)) -> DataFrame:
    return df.orderBy(shuffle_key(seed, *key), *key)


def set_union(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.unionByName(b).distinct()


def set_difference(a: DataFrame, b: DataFrame) -> DataFrame:
    """Distinct rows of a that b has not; nulls are equal."""
    return a.subtract(b)


def bag_concat(*frames: DataFrame) -> DataFrame:
    """All rows of all tables, the union of their columns, null where a table has none."""
    out = frames[0]
    for other in frames[1:]:
        out = out.unionByName(other, allowMissingColumns=True)
    return out


def surviving(df: DataFrame, keep: DataFrame, key: str) -> DataFrame:
    return df.join(keep.select(key), key, "left_semi")


def without(df: DataFrame, gone: DataFrame, key: str) -> DataFrame:
    return df.join(gone.select(key), key, "left_anti")
