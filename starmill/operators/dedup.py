"""Keep one row per key, by an explicit row order.

Spark rows have no order, so "first" and "last" always mean the order columns.  All variants
are one ranked window with a ``rank = 1`` filter: the optimizer puts a group limit before the
shuffle, so each map task sends at most one row per key and a key that holds a third of the
table reaches the reducer as one row per map task.  NULL key parts are equal to each other.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starmill import rules
from starmill.functions.text import is_filled, strip

_RANK = "__rank"

Keys = Sequence[str] | Mapping[str, Column]


def _key_columns(keys: Keys) -> list[Column]:
    return list(keys.values()) if isinstance(keys, Mapping) else [F.col(k) for k in keys]


def _keep(df: DataFrame, keys: Keys, order: Sequence[Column]) -> DataFrame:
    window = Window.partitionBy(*_key_columns(keys)).orderBy(*order)
    return df.withColumn(_RANK, F.row_number().over(window)).where(F.col(_RANK) == 1).drop(_RANK)


def keep_first(df: DataFrame, keys: Keys, order: Sequence[str | Column]) -> DataFrame:
    """The first row per key; ``order`` takes column names or sort expressions."""
    return _keep(df, keys, [F.col(c).asc() if isinstance(c, str) else c for c in order])


def keep_last(df: DataFrame, keys: Keys, order: Sequence[str]) -> DataFrame:
    return _keep(df, keys, [F.col(c).desc() for c in order])


def linked(link: str = "apply_link") -> Column:
    """True for a row with a usable link; never NULL, so its negation is the complement."""
    return is_filled(F.col(link))


def batch_identity(link: str = "apply_link", fallback: Sequence[str] = rules.POSTING_KEY) -> dict[str, Column]:
    """Key within one batch: the link without case and outer blanks, else the posting key
    treated the same way."""
    has_link = linked(link)
    # A missing link part is NULL on one side and a missing posting part on the other, so
    # the two kinds of key never meet.
    key = {link: F.when(has_link, F.lower(strip(F.col(link))))}
    for name in fallback:
        key[name] = F.when(~has_link, strip(F.lower(F.coalesce(F.col(name), F.lit("None")))))
    return key


def history_identity(link: str = "apply_link", fallback: Sequence[str] = rules.POSTING_KEY) -> dict[str, Column]:
    """Key across batches: the exact link, else the exact posting key (NULL equals NULL)."""
    has_link = linked(link)
    key = {"linked": has_link, link: F.when(has_link, F.col(link))}
    for name in fallback:
        key[name] = F.when(~has_link, F.col(name))
    return key


def count_duplicates(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: total rows, distinct keys, rows beyond the first of their key.

    Two hash aggregates with map-side combine; NULL key parts count as a value.
    """
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("rows"),
        F.count(F.lit(1)).alias("distinct_keys"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("bigint").alias("duplicates"),
    )

