"""Documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir), works on all rows that the one before kept, and
all but the last return the columns of documents.  ``run`` writes what a stage returns
to the shared folder and hands it, read back, to the next.

Defined cases, for all stages.  A null text counts as empty: the classifier gives it the score of
its bias, all empty texts are copies of one another, and it has no tokens, so that the last stage
returns it without a sequence.  A null id is never held out, is kept by the near-duplicate stage,
and ranks last among copies.  Of rows that tie on id exactly one copy stays, and rows that share an
id and differ in text are judged each by its own.  Texts of any length are read whole.  Repeated
rows are copies.  An empty table, or one that a stage empties, gives an empty result; without labels
the classifier keeps all and mixing repeats nothing.  Other columns, whatever their names, reach
the last stage as they are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quillmill.llm import exact_dedup, mixing, near_dedup, packing, quality
from quillmill.staging import stage


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    return quality.keep_good(docs, _labels(spark, sf_dir))


def exact_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the smallest id stays."""
    return exact_dedup.keep_one(docs, keep="min")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked at 0.8 on shingles of five words, one of each group stays."""
    return near_dedup.keep_one_of_each(docs, size=5, percent=80)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are repeated until the domains have their target weights; none is dropped."""
    return mixing.mix(docs, _labels(spark, sf_dir), floor=1.0)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each piece of each document: its sequence and its place there."""
    return packing.pack(docs)


STAGES = [
    ("quality classifier", quality_classifier),
    ("exact dedup", exact_duplicates),
    ("near dedup", near_duplicates),
    ("mixing", mix_sources),
    ("packing", best_fit_packing),
]
ORACLE_SQL = None  # the classifiers are learned; tests/llm holds run() against a brute-force version


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
