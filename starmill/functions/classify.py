"""Attributes derived from text by ordered rules."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmill import rules
from starmill.functions.dates import number
from starmill.functions.text import (
    NOT_AFTER_WORD,
    NOT_BEFORE_WORD,
    WS,
    first_term,
    or_blank,
    words,
)

# --- fixed values: title words -> level, in the order they are tried -------------------
# The plain words in front are what each pattern needs; looking for them costs no regex.
TITLE_LEVELS = [
    (["intern"], words("intern", "internship"), "Intern"),
    (["senior"], words(f"senior{WS}+lead"), "Senior Lead"),
    (["principal"], words("principal"), "Principal"),
    (["senior", "sr"], words("senior", "sr"), "Senior"),
    (["lead"], words("lead", "team lead", "leader"), "Lead"),
    (["manager", "manger"], words("manager", "manger"), "Manager"),
    (["director"], words("director"), "Director"),
    (["junior", "jr", "entry"], words("junior", "jr", "entry[- ]level"), "Junior"),
]

# --- fixed values: years of experience in a description, in the order they are tried ---
_N = r"(\p{Nd}+)"
YEARS_PATTERNS = [
    rf"{NOT_AFTER_WORD}{_N}{WS}*(?:-|to){WS}*\p{{Nd}}+{WS}*years?",
    rf"{NOT_AFTER_WORD}{_N}{WS}*\+{WS}*years?",
    rf"{NOT_AFTER_WORD}(?:minimum|at least){WS}+{_N}{WS}*years?",
    rf"{NOT_AFTER_WORD}{_N}{WS}*years?{WS}+(?:of{WS}+)?experience{NOT_BEFORE_WORD}",
]

# --- fixed values: upper bounds of years -> level, the last for more -------------------
YEARS_LEVELS = [(2, "Junior"), (5, "Mid Level")]
YEARS_ABOVE = "Senior"

REMOTE = words("remote")


def known_level(c: Column) -> Column:
    """The level if it is one of the known ones, else NULL."""
    return F.when(c.isin(*rules.LEVELS), c)


def _any_of(text: Column, needles: list[str]) -> Column:
    return reduce(Column.__or__, [text.contains(n) for n in needles])


def with_level(df: DataFrame, level: str, title: str, description: str) -> DataFrame:
    """Keep a known ``level``, else derive it: title first, then years in the description.

    The title is searched only where the level is unknown, and the description only where
    the title told nothing either.  Each step is a column of its own: no text is lowered
    twice, and the generated code stays in pieces small enough to be compiled.
    """
    low_title, low_text, digits = "__title", "__text", "__digits"
    known = known_level(F.col(level))
    rows = df.withColumns(
        {level: known, low_title: F.when(known.isNull(), F.lower(or_blank(F.col(title))))}
    )
    named = [
        F.when(_any_of(F.col(low_title), needles) & F.col(low_title).rlike(p), F.lit(name))
        for needles, p, name in TITLE_LEVELS
    ]
    rows = rows.withColumn(level, F.coalesce(F.col(level), *named))
    rows = rows.withColumn(
        low_text, F.when(F.col(level).isNull(), F.lower(or_blank(F.col(description))))
    )
    rows = rows.withColumn(digits, years_digits(F.col(low_text)))
    years = number(F.col(digits))
    return rows.withColumn(level, F.coalesce(F.col(level), level_from_years(years))).drop(
        low_title, low_text, digits
    )


def years_digits(low_text: Column) -> Column:
    """The years of experience named in lower-case text, as written; the first pattern that
    occurs decides."""
    found = [F.nullif(F.regexp_extract(low_text, p, 1), F.lit("")) for p in YEARS_PATTERNS]
    # All patterns need this word.
    return F.when(low_text.contains("year"), F.coalesce(*found))


def years_asked(description: Column) -> Column:
    return number(years_digits(F.lower(or_blank(description))))


def level_from_years(years: Column) -> Column:
    low = [F.when(years <= most, F.lit(level)) for most, level in YEARS_LEVELS]
    return F.coalesce(*low, F.when(years.isNotNull(), F.lit(YEARS_ABOVE)))


def recovered_city(city: Column, *texts: Column) -> Column:
    """``city``, or where it is NULL the first known city named in the texts."""
    text = F.concat_ws(" ", *[or_blank(t) for t in texts])
    return F.coalesce(city, first_term(text, rules.CITIES, strict=False))


def is_remote(title: Column, description: Column) -> Column:
    low = F.lower(F.concat_ws(" ", or_blank(title), or_blank(description)))
    return low.contains("remote") & low.rlike(REMOTE)


def has_value(c: Column) -> Column:
    return c.isNotNull()

