"""Quality reports: one aggregation pass each, long results (one row per finding)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmill.functions.text import WS


def _unpivot(one_row: DataFrame, name: str, columns: Sequence[str], **values: str) -> DataFrame:
    """One wide row of aggregates to one row per column.

    ``values`` maps an output name to the suffix of the aggregates it takes.
    """
    entries = F.array(
        *[
            F.struct(
                F.lit(c).alias(name),
                *[F.col(f"{c}{suffix}").alias(out) for out, suffix in values.items()],
            )
            for c in columns
        ]
    )
    return one_row.select(F.inline(entries))


def nulls(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Per column: rows, NULLs and their percentage."""
    columns = list(columns or df.columns)
    wide = df.agg(
        F.count(F.lit(1)).alias("__rows"),
        *[F.count_if(F.col(c).isNull()).alias(f"{c}__nulls") for c in columns],
    )
    return _unpivot(
        wide.select(
            "*",
            *[F.col("__rows").alias(f"{c}__rows") for c in columns],
        ),
        "column_name",
        columns,
        rows="__rows",
        null_count="__nulls",
    ).withColumn(
        "null_pct",
        F.when(F.col("rows") > 0, F.col("null_count") * 100.0 / F.col("rows")).cast("double"),
    )


def value_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """How often each value (NULL too) occurs in each of the columns.

    The table is read once and grouped on all columns together; the per-column counts come
    from the grouped rows.
    """
    grouped = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("n"))
    entries = F.array(
        *[
            F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value"))
            for c in columns
        ]
    )
    return (
        grouped.select("n", F.inline(entries))
        .groupBy("column_name", "value")
        .agg(F.sum("n").alias("n"))
    )


def required_checks(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """PASS or WARNING per required column, with the number of missing values."""
    wide = df.agg(*[F.count_if(F.col(c).isNull()).alias(f"{c}__bad") for c in columns])
    return _verdict(_unpivot(wide, "check_name", columns, findings="__bad"))


def _verdict(findings: DataFrame) -> DataFrame:
    return findings.withColumn(
        "status", F.when(F.col("findings") == 0, F.lit("PASS")).otherwise(F.lit("WARNING"))
    )


def duplicate_check(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    from starmill.operators.dedup import count_duplicates

    return _verdict(
        count_duplicates(df, keys).select(
            F.lit("duplicates").alias("check_name"), F.col("duplicates").alias("findings")
        )
    )


def outside_domain(df: DataFrame, column: str, domain: Sequence[str]) -> DataFrame:
    """Distinct non-NULL values that are not in ``domain``."""
    c = F.col(column)
    return df.where(c.isNotNull() & ~c.isin(*domain)).select(c.alias("value")).distinct()


def domain_checks(df: DataFrame, domains: Mapping[str, Sequence]) -> DataFrame:
    """PASS or WARNING per column, with the number of distinct values outside its domain."""
    wide = df.agg(
        *[
            F.count_distinct(F.when(~F.col(c).isin(*domain), F.col(c))).alias(f"{c}__bad")
            for c, domain in domains.items()
        ]
    )
    return _verdict(_unpivot(wide, "check_name", list(domains), findings="__bad"))


def boolean_checks(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """PASS when every non-NULL value is true or false."""
    wide = df.agg(
        *[
            F.coalesce(F.bool_and(F.col(c).isin(True, False)), F.lit(True)).alias(f"{c}__ok")
            for c in columns
        ]
    )
    return _unpivot(wide, "check_name", columns, ok="__ok").select(
        "check_name",
        F.when(F.col("ok"), F.lit("PASS")).otherwise(F.lit("WARNING")).alias("status"),
    )


def whitespace_checks(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Per column: cells that start with white space, that end with it, that hold a run.

    The status goes by ``leading_ws`` and ``repeated_ws``; ``trailing_ws`` is reported beside
    them.
    """
    wide = df.agg(
        *[
            agg
            for c in columns
            for agg in (
                F.count_if(F.col(c).rlike(f"^{WS}")).alias(f"{c}__leading"),
                F.count_if(F.col(c).rlike(f"{WS}\\z")).alias(f"{c}__trailing"),
                F.count_if(F.col(c).rlike(f"{WS}{{2,}}")).alias(f"{c}__repeated"),
            )
        ]
    )
    return _unpivot(
        wide,
        "column_name",
        columns,
        leading_ws="__leading",
        trailing_ws="__trailing",
        repeated_ws="__repeated",
    ).withColumn(
        "status",
        F.when((F.col("leading_ws") == 0) & (F.col("repeated_ws") == 0), F.lit("PASS")).otherwise(
            F.lit("WARNING")
        ),
    )


def recovered(df: DataFrame, pairs: Mapping[str, tuple[Column, Column]]) -> DataFrame:
    """Per name: NULLs before and after a recovery step, and how many it filled."""
    wide = df.agg(
        *[
            agg
            for name, (before, after) in pairs.items()
            for agg in (
                F.count_if(before.isNull()).alias(f"{name}__before"),
                F.count_if(after.isNull()).alias(f"{name}__after"),
            )
        ]
    )
    return _unpivot(
        wide, "column_name", list(pairs), missing_before="__before", missing_after="__after"
    ).withColumn("recovered", F.col("missing_before") - F.col("missing_after"))


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per table with its number of rows."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count"
        )
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def shape(df: DataFrame) -> DataFrame:
    """Number of rows and of columns."""
    return df.agg(
        F.count(F.lit(1)).alias("rows"), F.lit(len(df.columns)).cast("bigint").alias("columns")
    )
