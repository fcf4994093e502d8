"""Merged history -> cleaned, typed, enriched postings.

Every step is a function on a DataFrame; the order of the steps is part of the result.  The
only shuffle is the de-duplication at the start.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmill import rules
from starmill.functions import classify, dates
from starmill.functions import text as T
from starmill.operators import dedup, keys
from starmill.operators.schema import require_columns, try_cast_columns


def drop_repeats(bronze: DataFrame, order: Sequence[str | Column]) -> DataFrame:
    """The first row of each raw (uncleaned) posting key."""
    return dedup.keep_first(bronze, rules.POSTING_KEY, order)


def tokens_to_null(df: DataFrame, but: Sequence[str] = ()) -> DataFrame:
    """Missing-value tokens to NULL in every text column."""
    return df.withColumns(
        {
            name: T.null_if_token(F.col(name), rules.NULL_TOKENS)
            for name, dtype in df.dtypes
            if dtype == "string" and name not in but
        }
    )


def squeeze_text(df: DataFrame) -> DataFrame:
    return df.withColumns({c: T.squeeze(F.col(c)) for c in rules.TEXT_COLUMNS if c in df.columns})


def standard_values(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "employment_type": T.map_lowered(F.col("employment_type"), rules.EMPLOYMENT_TYPES),
            "company": T.title_if_lower(F.col("company")),
            "skills": T.clean_list(F.col("skills")),
        }
    )


def plain_description(df: DataFrame) -> DataFrame:
    return T.with_plain_text(df, "description")


def times(df: DataFrame) -> DataFrame:
    fetched = df.withColumn("fetched_at", dates.fetched_time(F.col("fetched_at")))
    return dates.with_posted_time(fetched, "posted_at", "fetched_at", "posted_at")


def levels(df: DataFrame) -> DataFrame:
    return classify.with_level(df, "experience_level", "job_title", "description")


def cities(df: DataFrame) -> DataFrame:
    return df.withColumn(
        "city",
        classify.recovered_city(
            F.col("city"), F.col("location"), F.col("job_title"), F.col("description")
        ),
    )


def flags(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "is_remote": classify.is_remote(F.col("job_title"), F.col("description")),
            "has_salary": classify.has_value(F.col("salary")),
        }
    )


def date_parts(df: DataFrame) -> DataFrame:
    at = F.col("posted_at")
    return df.withColumns(
        {
            "posted_date": F.to_date(at),
            "posted_year": F.year(at).cast("bigint"),
            "posted_month": F.month(at).cast("bigint"),
            "posted_day": F.dayofmonth(at).cast("bigint"),
        }
    )


def clean(unique: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """All steps after the de-duplication, up to but not including the drop of the salary."""
    return (
        unique.transform(tokens_to_null, but=keep)
        .transform(squeeze_text)
        .transform(standard_values)
        .transform(plain_description)
        .transform(times)
        .transform(levels)
        .transform(cities)
        .transform(flags)
        .transform(date_parts)
    )


def silver(bronze: DataFrame, order: Sequence[str | Column], keep: Sequence[str] = ()) -> DataFrame:
    """The cleaned table: thirteen columns less the salary, six derived ones, typed.

    ``keep`` names row-order columns that pass through untouched.
    """
    require_columns(bronze, rules.BRONZE_COLUMNS, "the history")
    cleaned = clean(drop_repeats(bronze, order), keep).drop("salary")
    known = [*keep, *rules.SILVER_TYPES]
    others = [c for c in cleaned.columns if c not in known]
    return try_cast_columns(cleaned.select(*known, *others), rules.SILVER_TYPES)


def refresh(
    cleaned: DataFrame, before: DataFrame, after: DataFrame, came: Column, order: Sequence[str]
) -> DataFrame:
    """What :func:`silver` gives for ``after``, made from ``cleaned``, what it gave for ``before``.

    ``after`` is ``before`` with newer rows merged in; ``came`` is true for those rows.  A posting
    key is touched when one of its rows came, or went because a newer one replaced it.  Only
    touched postings are ranked and cleaned again; the others are taken from ``cleaned`` as they
    are.  ``order`` names the row-order columns, which must be distinct for each row and kept in
    ``cleaned``.
    """
    newer = after.where(came)
    named = {f"__k_{name}": column for name, column in dedup.history_identity().items()}
    identities = newer.select(*[column.alias(name) for name, column in named.items()])
    went = keys.present(before.withColumns(named), identities, list(named), null_safe=True)
    touched = newer.select(*rules.POSTING_KEY).unionByName(went.select(*rules.POSTING_KEY)).distinct()

    old = keys.present(before.select(*order, *rules.POSTING_KEY), touched, rules.POSTING_KEY, null_safe=True)
    kept = keys.absent(cleaned, drop_repeats(old, order), order, null_safe=True)
    again = keys.present(after, touched, rules.POSTING_KEY, null_safe=True)
    return kept.unionByName(silver(again, order, keep=order))


def changed_firsts(before: DataFrame, after: DataFrame, newer: DataFrame, went: DataFrame, order: Sequence[str], also: Sequence[str] = ()) -> DataFrame:
    """The posting key of each posting whose first row is another now, with ``old`` and ``new``.

    ``newer`` came and ``went`` is what it replaced; only their posting keys are looked at, in the
    narrow columns of both histories.  ``old`` and ``new`` hold the first row's order columns and
    those in ``also``, null where the posting was not there.  Nothing is ranked: the first row of a
    key is the least, so each task sends one row a key.
    """
    touched = newer.select(*rules.POSTING_KEY).unionByName(went.select(*rules.POSTING_KEY)).distinct()
    place = F.struct(*order, *also)

    def marked(history: DataFrame, name: str, other: str) -> DataFrame:
        found = keys.present(history.select(*order, *also, *rules.POSTING_KEY), touched, rules.POSTING_KEY, null_safe=True)
        shown = found.select(*rules.POSTING_KEY, place.alias(name))
        return shown.withColumn(other, F.lit(None).cast(shown.schema[name].dataType))

    both = marked(before, "old", "new").unionByName(marked(after, "new", "old"))
    firsts = both.groupBy(*rules.POSTING_KEY).agg(F.min("old").alias("old"), F.min("new").alias("new"))
    return firsts.where(~F.col("old").eqNullSafe(F.col("new")))


def changes(cleaned: DataFrame, after: DataFrame, firsts: DataFrame, order: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Rows that leave ``cleaned`` (``sign`` -1) and rows that come (1), with ``change``.

    ``firsts`` is :func:`changed_firsts`.  ``change`` is inserted, removed, or replaced, which is a
    row of each sign.  ``cleaned`` and ``after`` need only hold the rows that ``firsts`` names;
    ``keep`` names columns of both that pass through.
    """
    change = F.when(F.col("old").isNull(), "inserted").when(F.col("new").isNull(), "removed").otherwise("replaced")

    def named(side: str, rows: DataFrame) -> DataFrame:
        places = firsts.where(F.col(side).isNotNull()).select(
            *[F.col(f"{side}.{c}").alias(f"__{c}") for c in order], change.alias("change")
        )
        same = F.lit(True)
        for c in order:
            same &= F.col(c).eqNullSafe(F.col(f"__{c}"))
        return rows.join(places, same).drop(*[f"__{c}" for c in order])

    left = named("old", cleaned).withColumn("sign", F.lit(-1))
    came = silver(named("new", after), order, keep=[*order, *keep, "change"]).withColumn("sign", F.lit(1))
    return left.unionByName(came)


def apply_changes(cleaned: DataFrame, feed: DataFrame, order: Sequence[str]) -> DataFrame:
    """``cleaned`` after the ``feed`` of :func:`changes`."""
    kept = keys.absent(cleaned, feed.where("sign = -1"), order, null_safe=True)
    return kept.unionByName(feed.where("sign = 1").select(*cleaned.columns))
