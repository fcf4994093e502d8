"""Surrogate keys, key lookups and insert-only differences.

A lookup broadcasts the dimension only after its size was measured.  A larger dimension is
joined by shuffle, and row keys that occur very often are spread over several tasks first.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StringType

# Largest dimension side sent to every executor, in bytes as measured.
BROADCAST_BYTES = 64 * 1024 * 1024
# Rows of one key that one task should handle before the key is spread.
ROWS_PER_SPLIT = 1_000_000
# Hex digits of the hash that name a numbering bucket: 16 ** 4 = 65536 buckets.
BUCKET_DIGITS = 4


# --- insert-only -----------------------------------------------------------------------


def _against(
    rows: DataFrame, existing: DataFrame, on: Sequence[str], null_safe: bool, how: str, payload: Sequence[str] = ()
) -> DataFrame:
    theirs = existing.select(*[F.col(c).alias(f"__e_{c}") for c in on], *payload)
    condition = F.lit(True)
    for name in on:
        a, b = rows[name], theirs[f"__e_{name}"]
        condition = condition & (a.eqNullSafe(b) if null_safe else a == b)
    return rows.join(theirs, condition, how).drop(*[f"__e_{c}" for c in on])


def absent(rows: DataFrame, existing: DataFrame, on: Sequence[str], null_safe: bool = False) -> DataFrame:
    """Rows whose key is not in ``existing``."""
    return _against(rows, existing, on, null_safe, "left_anti")


def present(rows: DataFrame, existing: DataFrame, on: Sequence[str], null_safe: bool = False) -> DataFrame:
    """Rows whose key is in ``existing``."""
    return _against(rows, existing, on, null_safe, "left_semi")


def marked(rows: DataFrame, existing: DataFrame, on: Sequence[str], mark: str, null_safe: bool = False) -> DataFrame:
    """All rows, and in ``mark`` whether their key is in ``existing``, which is unique by ``on``."""
    theirs = existing.select(*on, F.lit(True).alias(mark))
    return _against(rows, theirs, on, null_safe, "left", [mark]).withColumn(mark, F.col(mark).isNotNull())


# --- surrogate keys --------------------------------------------------------------------


def key_hash(columns: Sequence[str]) -> Column:
    """SHA-256 of a natural key; NULL and the empty string give different hashes."""
    parts = [
        F.coalesce(F.concat(F.lit("v"), F.col(c).cast("string")), F.lit("n")) for c in columns
    ]
    # The blank is never used; it tells the optimizer that the hash is not NULL, which keeps
    # both uses of the hashed rows equal and lets them share one shuffle.
    return F.coalesce(F.sha2(F.concat_ws("\x1f", *parts), 256), F.lit(""))


def number_keys(
    new: DataFrame,
    natural: Sequence[str],
    key: str,
    start: int = 0,
    bucket_digits: int = BUCKET_DIGITS,
) -> DataFrame:
    """Add ``key``: start + 1, start + 2, .. in the order of the natural key's hash.

    The numbering runs inside hash buckets, which hold equal shares whatever the keys look
    like; the offsets between buckets are a running total over at most 16 ** digits rows.
    The result depends on the data alone, so a lost task recomputes the same keys.
    """
    hashed = new.withColumn("__hash", key_hash(natural)).withColumn(
        "__bucket", F.substring("__hash", 1, bucket_digits)
    )
    within = Window.partitionBy("__bucket").orderBy("__hash", *natural)
    numbered = hashed.withColumn("__n", F.row_number().over(within))
    before = Window.orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        hashed.groupBy("__bucket")
        .agg(F.count(F.lit(1)).alias("__size"))
        .select(
            F.col("__bucket").alias("__b"),
            F.coalesce(F.sum("__size").over(before), F.lit(0)).alias("__offset"),
        )
    )
    return (
        numbered.join(F.broadcast(offsets), F.col("__bucket") == F.col("__b"))
        .withColumn(key, (F.lit(start) + F.col("__offset") + F.col("__n")).cast("bigint"))
        .drop("__hash", "__bucket", "__n", "__b", "__offset")
    )


def highest_key(existing: DataFrame, key: str) -> int:
    """The largest key in use, 0 for an empty table (runs one small aggregate)."""
    return existing.agg(F.max(key)).first()[0] or 0


# --- lookups ---------------------------------------------------------------------------


def measured_bytes(df: DataFrame) -> int:
    """Bytes the rows of ``df`` take, counted over all rows (runs one aggregate)."""
    row = F.lit(16)
    for field in df.schema.fields:
        if isinstance(field.dataType, StringType | BinaryType):
            row = row + F.coalesce(F.octet_length(F.col(field.name)), F.lit(0)) + 16
        else:
            row = row + 8
    return df.agg(F.sum(row)).first()[0] or 0


def frequent_keys(
    rows: DataFrame,
    on: Sequence[str],
    rows_per_split: int = ROWS_PER_SPLIT,
) -> DataFrame:
    """Keys with more rows than one task should get, and over how many tasks to spread them.

    All of them: there are fewer than rows / ``rows_per_split``.
    """
    return (
        rows.groupBy(*on)
        .agg(F.count(F.lit(1)).alias("__count"))
        .where(F.col("__count") > rows_per_split)
        .select(
            *[F.col(c).alias(f"__f_{c}") for c in on],
            F.ceil(F.col("__count") / F.lit(rows_per_split)).cast("int").alias("__splits"),
        )
    )


def _with_splits(df: DataFrame, frequent: DataFrame, on: Sequence[str]) -> DataFrame:
    condition = F.lit(True)
    for name in on:
        condition = condition & F.col(name).eqNullSafe(F.col(f"__f_{name}"))
    return df.join(frequent, condition, "left").drop(*[f"__f_{c}" for c in on])


def lookup(
    rows: DataFrame,
    dimension: DataFrame,
    on: Sequence[str],
    row_id: Sequence[str],
    how: str = "left",
    null_safe: bool = False,
    counted_in: DataFrame | None = None,
    broadcast_bytes: int = BROADCAST_BYTES,
    rows_per_split: int = ROWS_PER_SPLIT,
) -> DataFrame:
    """Add the dimension's other columns to ``rows``; ``on`` is unique in ``dimension``.

    ``row_id`` names columns that tell rows of one key apart; they spread frequent keys.
    ``counted_in`` is a table in which frequent keys show just as well and that is cheaper to
    count than ``rows``: what is frequent in ``rows`` must be at least as frequent there.
    """
    payload = [c for c in dimension.columns if c not in on]
    dim = dimension.select(*[F.col(c).alias(f"__d_{c}") for c in on], *payload)

    def matches() -> Column:
        condition = F.lit(True)
        for name in on:
            a, b = F.col(name), F.col(f"__d_{name}")
            condition = condition & (a.eqNullSafe(b) if null_safe else a == b)
        return condition

    extra = [f"__d_{c}" for c in on]
    if measured_bytes(dimension) <= broadcast_bytes:
        return rows.join(F.broadcast(dim), matches(), how).drop(*extra)

    frequent = frequent_keys(rows if counted_in is None else counted_in, on, rows_per_split)
    spread = _with_splits(rows, frequent, on).withColumn(
        "__salt",
        F.coalesce(F.pmod(F.xxhash64(*row_id), F.col("__splits")), F.lit(0)).cast("int"),
    )
    copies = (
        _with_splits(dimension, frequent, on)
        .select(
            *[F.col(c).alias(f"__d_{c}") for c in on],
            *payload,
            F.explode(
                F.sequence(F.lit(0), F.coalesce(F.col("__splits"), F.lit(1)) - 1)
            ).alias("__d_salt"),
        )
    )
    return spread.join(copies, matches() & (F.col("__salt") == F.col("__d_salt")), how).drop(
        "__splits", "__salt", "__d_salt", *extra
    )
