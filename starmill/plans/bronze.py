"""Landing payload -> normalised batch -> merged history."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmill import rules
from starmill.functions import text as T
from starmill.operators import dedup, keys
from starmill.operators.schema import align, require_columns
from starmill.sources.landing import FILE_ORDER

# --- columns of one posting ------------------------------------------------------------


def salary_text(low: Column, high: Column, currency: Column, period: Column) -> Column:
    """``low - high CUR / PERIOD`` with absent parts left out; 0 is a salary, NULL is none."""
    amount = F.concat_ws(" - ", T.null_if_empty(T.strip(low)), T.null_if_empty(T.strip(high)))
    unit = F.coalesce(F.concat(F.lit(" "), T.null_if_empty(currency)), F.lit(""))
    span = F.coalesce(F.concat(F.lit(" / "), T.null_if_empty(period)), F.lit(""))
    return F.when(low.isNull() & high.isNull(), F.lit(rules.PLACEHOLDER)).otherwise(
        F.concat(amount, unit, span)
    )


def experience_text(none_required: Column, months: Column, mentioned: Column) -> Column:
    months = months.cast("string")
    has_months = F.coalesce(F.abs(months.try_cast("double")) > 0, T.or_blank(months) != "")
    return (
        F.when(none_required, F.lit("No experience required"))
        .when(has_months, F.concat(months, F.lit(" months experience")))
        .when(mentioned, F.lit("Experience mentioned (unspecified)"))
        .otherwise(F.lit(rules.PLACEHOLDER))
    )


def location_text(city: Column, country: Column) -> Column:
    country = T.map_exact(country, rules.COUNTRY_NAMES)
    named = F.array_compact(F.array(T.null_if_empty(city), T.null_if_empty(country)))
    return F.when(F.size(named) == 0, F.lit(rules.PLACEHOLDER)).otherwise(T.join_filled(named))


def skills_text(
    listed: Column,
    required: Column,
    title: Column,
    description: Column,
    terms: Sequence[str] = rules.SKILL_TERMS,
) -> Column:
    """The ``listed`` skills, else the given text, else the known terms named in the posting."""
    # A NULL item of a list counts as the word it prints as.
    named = T.join_filled(F.transform(listed, lambda x: F.coalesce(x, F.lit("None"))))
    return (
        F.when(F.size(listed) > 0, named)
        .when(listed.isNull() & (T.or_blank(required) != ""), required)
        .otherwise(T.terms_text(F.concat_ws(" ", title, description), terms))
    )


# --- the batch -------------------------------------------------------------------------

_RAW_SKILLS = "__required_skills"
_LISTED = "__listed_skills"


def _without_skills(postings: DataFrame, fetched_at: str | Column, order: Sequence[str]) -> DataFrame:
    c = F.col
    exp = "job_required_experience"
    na = rules.PLACEHOLDER
    return postings.select(
        *order,
        F.lit(rules.SOURCE_TAG).alias("source"),
        T.or_default(c("job_title"), na).alias("job_title"),
        T.or_default(c("employer_name"), na).alias("company"),
        T.or_default(c("job_city"), na).alias("city"),
        location_text(c("job_city"), c("job_country")).alias("location"),
        T.or_default(c("job_employment_type"), na).alias("employment_type"),
        salary_text(
            c("job_min_salary"),
            c("job_max_salary"),
            c("job_salary_currency"),
            c("job_salary_period"),
        ).alias("salary"),
        c("job_required_skills").alias(_RAW_SKILLS),
        experience_text(
            c(f"{exp}.no_experience_required"),
            c(f"{exp}.required_experience_in_months"),
            c(f"{exp}.experience_mentioned"),
        ).alias("experience_level"),
        T.first_filled(c("job_apply_link"), c("job_google_link")).alias("apply_link"),
        T.or_default(c("job_posted_at"), na).alias("posted_at"),
        (fetched_at if isinstance(fetched_at, Column) else F.lit(fetched_at)).alias("fetched_at"),
        T.or_default(c("job_description"), na).alias("description"),
    )


def _with_skills(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    # A column of its own, so that the list is parsed once.
    parsed = rows.withColumn(_LISTED, F.from_json(F.col(_RAW_SKILLS), "array<string>"))
    skills = skills_text(*[F.col(c) for c in (_LISTED, _RAW_SKILLS, "job_title", "description")])
    return parsed.withColumn("skills", skills).select(*order, *rules.BRONZE_COLUMNS)


def normalise(postings: DataFrame, fetched_at: str, order: Sequence[str]) -> DataFrame:
    """Every posting in the thirteen history columns."""
    return _with_skills(_without_skills(postings, fetched_at, order), order)


def drop_repeats(batch: DataFrame, order: Sequence[str], within: Sequence[str] = ()) -> DataFrame:
    """The first row of each identity, within each value of the ``within`` columns."""
    key = {name: F.col(name) for name in within} | dedup.batch_identity()
    return dedup.keep_first(batch, key, order)


def batch(
    postings: DataFrame,
    fetched_at: str | Column,
    order: Sequence[str],
    within: Sequence[str] = (),
) -> DataFrame:
    """Normalised postings without repeats.

    A file is one fetch.  With ``within=["ingest_file"]`` repeats go within each file, and what
    is kept does not depend on how many files are taken together.

    The identity does not use the skills, so the text search runs after repeats are gone and
    on the partitions the de-duplication spread evenly, not on one task per landing file.
    """
    unique = drop_repeats(_without_skills(postings, fetched_at, order), order, within)
    return _with_skills(unique, order)


# --- the history -----------------------------------------------------------------------


def merge(
    history: DataFrame,
    newer: DataFrame,
    order: Sequence[str] = FILE_ORDER,
    history_is_unique: bool = False,
    newer_is_unique: bool = False,
) -> DataFrame:
    """History and newer rows, the newest row of each identity kept.

    ``order`` must place all newer rows after the history.  Where the history is itself the
    result of a merge (``history_is_unique``), it is only filtered by the newer identities:
    a small batch then costs no shuffle of the history.  ``newer_is_unique`` says the same of
    the newer rows; a :func:`batch` is, since its identity is the coarser one.
    """
    key = dedup.history_identity()
    if not history_is_unique:
        both = history.unionByName(newer, allowMissingColumns=True)
        return dedup.keep_last(both, key, order)

    latest = newer if newer_is_unique else dedup.keep_last(newer, key, order)
    named = {f"__k_{name}": column for name, column in key.items()}
    replaced = latest.select(*[column.alias(name) for name, column in named.items()])
    kept = keys.absent(
        history.withColumns(named), replaced, list(named), null_safe=True
    ).drop(*named)
    return kept.unionByName(latest, allowMissingColumns=True)


def backfill(
    historical: DataFrame,
    existing: DataFrame | None,
    order: Sequence[str] = FILE_ORDER,
) -> DataFrame:
    """A historical table put under the existing history.

    The historical table must have all columns (its own ``id`` is dropped); the existing
    history is aligned, absent columns as NULL.
    """
    historical = require_columns(
        historical.drop("id"), rules.BRONZE_COLUMNS, "the historical table"
    )
    columns = [*order, *rules.BRONZE_COLUMNS]
    older = historical.select(*columns)
    if existing is None:
        return dedup.keep_last(older, dedup.history_identity(), order)
    return merge(older, align(existing, columns), order)


# Row order of a stored history: rows with a link, then rows without, each as they came.
ROW_ORDER = ["ingest_unlinked", *FILE_ORDER]


def with_row_order(history: DataFrame) -> DataFrame:
    """The history in its stored columns, with the first part of :data:`ROW_ORDER` filled in.

    It has to be kept, since cleaning may blank a link.
    """
    marked = history.withColumn("ingest_unlinked", (~dedup.linked()).cast("int"))
    return marked.select(*ROW_ORDER, *rules.BRONZE_COLUMNS)
