"""Small helpers that the operators share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starmill.sources.tables import run_folder, stage, stage_counted

__all__ = ["ROW", "bounded_batches", "by_row", "read", "run_folder", "stage", "stage_counted", "text_of", "with_row_key"]

#: Column that names a row among others of the same doc_id.
ROW = "__row"

#: Rows and bytes of whole texts that go to Python, and come back, at a time.
BATCH_ROWS = 1000
BATCH_BYTES = 8 << 20


def bounded_batches(spark: SparkSession) -> SparkSession:
    """Small Arrow batches: each is held several times, in the executor, on its way, in Python and as a result."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return spark


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(column: str = "text") -> Column:
    """The whole text; null counts as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def with_row_key(docs: DataFrame) -> DataFrame:
    """``docs`` with a number of its own for each row, stored, so that a recomputed task gives the same."""
    return stage(docs.withColumn(ROW, F.monotonically_increasing_id()), "rows")


def by_row(work: Callable[[pd.DataFrame], Iterator[tuple]], names: list[str]) -> Callable:
    """A mapInPandas function: ``work`` turns one batch into rows, which are given in small frames."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for row in work(batch):
                rows.append(row)
                if len(rows) >= 2000:
                    yield pd.DataFrame(rows, columns=names)
                    rows = []
            if rows:
                yield pd.DataFrame(rows, columns=names)

    return run
