"""Cleaning and packing of the documents table, stage by stage.

Each stage takes (spark, docs, sf_dir) and works on all rows it is given.  What a stage returns is
written as Parquet in the shared folder and read again as the next stage's docs.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from starmill.llm import decontaminate, packing, secrets, simhash, toxicity
from starmill.llm.common import bounded_batches, read, stage

Work = Callable[[SparkSession, DataFrame, str], DataFrame]


def over_texts(work: Work) -> Work:
    """A stage whose texts go to Python in small batches; one executor runs all stages one after another."""

    @wraps(work)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        return work(bounded_batches(spark), docs, sf_dir)

    return run


@over_texts
def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not call toxic."""
    return toxicity.keep_clean(docs, toxicity.train(docs, read(spark, sf_dir, "labels")))


@over_texts
def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return simhash.one_of_each(docs)


@over_texts
def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item."""
    return decontaminate.keep_clean(docs, read(spark, sf_dir, "benchmark"))


@over_texts
def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, each secret in them replaced by its kind."""
    return secrets.redact(docs)


@over_texts
def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' pieces with their sequences and offsets."""
    return packing.pack(packing.digest(packing.pieces(docs)))


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("secrets", redact_secrets),
    ("packing", pack),
]

#: The stages cannot be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, work in STAGES[:-1]:
        docs = stage(work(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
