"""Column sets: checks, alignment, renaming, typing."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class MissingColumns(ValueError):
    pass


def missing_columns(df: DataFrame, required: Iterable[str]) -> list[str]:
    present = set(df.columns)
    return [c for c in required if c not in present]


def require_columns(df: DataFrame, required: Iterable[str], what: str) -> DataFrame:
    missing = missing_columns(df, required)
    if missing:
        raise MissingColumns(f"{what} lacks required columns: {', '.join(missing)}")
    return df


def align(df: DataFrame, columns: Sequence[str], dtype: str = "string") -> DataFrame:
    """Exactly ``columns``, in that order; absent ones as NULL."""
    present = set(df.columns)
    return df.select(
        *[F.col(c) if c in present else F.lit(None).cast(dtype).alias(c) for c in columns]
    )


def upper_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.upper() for c in df.columns])


def flatten_structs(df: DataFrame) -> DataFrame:
    """Struct fields as top-level columns named ``outer.inner``, at any depth."""

    def leaves(schema, path):
        for field in schema.fields:
            here = [*path, field.name]
            if hasattr(field.dataType, "fields"):
                yield from leaves(field.dataType, here)
            else:
                yield here

    return df.select(
        *[
            F.col(".".join(f"`{p}`" for p in path)).alias(".".join(path))
            for path in leaves(df.schema, [])
        ]
    )


def try_cast_columns(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Cast the named columns; what does not fit becomes NULL.  Other columns pass through."""
    have = dict(df.dtypes)
    return df.select(
        *[
            F.col(f"`{c}`").try_cast(types[c]).alias(c)
            if c in types and have[c] != types[c]
            else F.col(f"`{c}`")
            for c in df.columns
        ]
    )


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN in floating-point columns to NULL, the one way a value is missing."""
    return df.withColumns(
        {
            name: F.when(~F.isnan(name), F.col(name))
            for name, dtype in df.dtypes
            if dtype in ("float", "double")
        }
    )


def describe(df: DataFrame) -> DataFrame:
    """One row per column: its place, name and type, and how many of its cells hold a value."""
    filled = df.agg(*[F.count(f"`{c}`").alias(f"n{i}") for i, c in enumerate(df.columns)])
    rows = [
        F.struct(
            F.lit(i + 1).alias("position"), F.lit(name).alias("column_name"), F.lit(kind).alias("data_type"),
            F.col(f"n{i}").alias("non_null"),
        )
        for i, (name, kind) in enumerate(df.dtypes)
    ]
    return filled.select(F.inline(F.array(*rows)))
