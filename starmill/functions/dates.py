"""Timestamps from fixed formats, relative phrases and a list of absolute spellings."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmill import rules
from starmill.functions.text import WS, strip

# Every decimal digit outside ASCII and its ASCII counterpart.
_DIGITS = [
    chr(c) for c in range(0x80, 0x110000) if unicodedata.category(chr(c)) == "Nd"
]
_ASCII_DIGITS = "".join(str(unicodedata.decimal(d)) for d in _DIGITS)

# Timestamps outside this range are not representable in the rules' nanosecond clock.
_EARLIEST, _LATEST = "1677-09-21 00:12:44", "2262-04-11 23:47:16.854775"
_LONGEST_SPAN = 585 * 366 * 86_400
_TOO_LONG = _LONGEST_SPAN + 1

# Two digits of a year are 1969 to 2068.
_FIRST_OF_NEXT = 2069


def ascii_digits(c: Column) -> Column:
    return F.translate(c, "".join(_DIGITS), _ASCII_DIGITS)


def whole_number(digits: Column, cap: int) -> Column:
    """The value of a run of digits in any script, at most ``cap``; NULL for NULL."""
    # 38 digits are the most a decimal takes; a longer run is above any cap.
    value = F.coalesce(ascii_digits(digits).try_cast("decimal(38,0)"), F.lit(cap))
    return F.when(digits.isNotNull(), F.least(value, F.lit(cap)).cast("bigint"))


def number(digits: Column) -> Column:
    """The value of a run of digits in any script; NULL for NULL and beyond 38 digits."""
    return ascii_digits(digits).try_cast("decimal(38,0)")


def fetched_time(c: Column) -> Column:
    return F.try_to_timestamp(c, F.lit(rules.FETCHED_AT_FORMAT))


# Shape of the text -> formats tried on it, in order.
_NUMERIC_SHAPES = [
    (r"\d{8}", ["yyyyMMdd"]),
    (r"\d{14}", ["yyyyMMddHHmmss"]),
    (r"\d{4}/\d{1,2}/\d{1,2}", ["yyyy/M/d"]),
    (r"\d{1,2}/\d{1,2}/\d{4}", ["M/d/yyyy", "d/M/yyyy"]),
    (r"\d{1,2}/\d{1,2}/\d{4} \d{1,2}:\d{2}", ["M/d/yyyy H:mm", "d/M/yyyy H:mm"]),
    (r"\d{4}\.\d{1,2}\.\d{1,2}", ["yyyy.M.d"]),
    (r"\d{1,2}-\d{1,2}-\d{4}", ["M-d-yyyy", "d-M-yyyy"]),
    (r"\d{1,2}\.\d{1,2}\.\d{4}", ["M.d.yyyy", "d.M.yyyy"]),
    (r"\d{1,2}/\d{1,2}/\d{2}", ["M/d/yy", "d/M/yy"]),
    (r"\d{4}-\d{1,2}-\d{1,2} \d{1,2}:\d{2} [AaPp][Mm]", ["yyyy-M-d h:mm a"]),
    (r"\d{1,2}/\d{1,2}/\d{4} \d{1,2}:\d{2} [AaPp][Mm]", ["M/d/yyyy h:mm a", "d/M/yyyy h:mm a"]),
    (r"\d{4}-\d{1,2}-\d{1,2} \d{1,2}:\d{2}:\d{2} [AaPp][Mm]", ["yyyy-M-d h:mm:ss a"]),
    (r"\d{1,2}/\d{1,2}/\d{4} \d{1,2}:\d{2}:\d{2}", ["M/d/yyyy H:mm:ss", "d/M/yyyy H:mm:ss"]),
    (
        r"\d{1,2}/\d{1,2}/\d{4} \d{1,2}:\d{2}:\d{2} [AaPp][Mm]",
        ["M/d/yyyy h:mm:ss a", "d/M/yyyy h:mm:ss a"],
    ),
    (r"\d{1,2} \p{L}{3} \d{4} \d{1,2}:\d{2}", ["d MMM yyyy H:mm"]),
    (r"\d{1,2} \p{L}{4,9} \d{4} \d{1,2}:\d{2}", ["d MMMM yyyy H:mm"]),
    (r"\d{1,2} \p{L}{3} \d{4} \d{1,2}:\d{2}:\d{2}", ["d MMM yyyy H:mm:ss"]),
    (r"\d{1,2} \p{L}{3} \d{4}", ["d MMM yyyy"]),
    (r"\d{1,2} \p{L}{4,9} \d{4}", ["d MMMM yyyy"]),
]
_NAMED_SHAPES = [
    (r"\p{L}{3} \d{1,2}, \d{4}", ["MMM d, yyyy"]),
    (r"\p{L}{3} \d{1,2}, \d{4} \d{1,2}:\d{2}", ["MMM d, yyyy H:mm"]),
    (r"\p{L}{4,9} \d{1,2}, \d{4}", ["MMMM d, yyyy"]),
    (r"\p{L}{4,9} \d{1,2}, \d{4} \d{1,2}:\d{2}", ["MMMM d, yyyy H:mm"]),
    (r"\p{L}{3} \d{1,2} \d{4}", ["MMM d yyyy"]),
    (r"\p{L}{4,9} \d{1,2} \d{4}", ["MMMM d yyyy"]),
    (r"\p{L}{3} \d{4}", ["MMM yyyy"]),
    (r"\p{L}{4,9} \d{4}", ["MMMM yyyy"]),
]
_ISO = (
    r"^\d{4}(?:-\d{1,2}(?:-\d{1,2}(?:[T ]\d{1,2}:\d{2}(?::\d{2}(?:\.\d{1,9})?)?"
    r" ?(?:Z|UTC|[+-]\d{2}(?::?\d{2})?)?)?)?)?$"
)


def _by_shape(text: Column, shapes: list[tuple[str, list[str]]]) -> Column:
    chain = None
    for shape, formats in shapes:
        parsed = F.coalesce(*[F.try_to_timestamp(F.initcap(text), F.lit(f)) for f in formats])
        if formats[0].endswith("/yy"):
            parsed = F.when(F.year(parsed) < _FIRST_OF_NEXT, parsed).otherwise(
                parsed - F.make_ym_interval(F.lit(100))
            )
        matches = text.rlike(f"^{shape}$")
        chain = F.when(matches, parsed) if chain is None else chain.when(matches, parsed)
    return chain


def absolute_time(text: Column) -> Column:
    """A date or timestamp spelled out; without a zone it is UTC.

    Only the listed spellings are read.  Spellings that depend on the wall clock ("today",
    "10:30") are NULL, so a rerun gives the same result.
    """
    # The form of mail headers: a weekday before the date, a name for UTC behind the time.
    mail = F.regexp_replace(text, r"^\p{L}{3}, (\d.*?)(?: (?:GMT|UTC|\+0000))?$", "$1")
    text = F.when(text.rlike(r"^\p{L}{3}, \d"), mail).otherwise(text)
    # A date alone also ends in "-dd"; only text with a clock time can carry a zone.
    zoned = F.regexp_replace(text, r"([+-]\d{2}):?(\d{2})$", "$1:$2")
    # The cast reads a zone only behind seconds.
    zoned = F.regexp_replace(zoned, r"([T ]\d{1,2}:\d{2})(?=$|[^:\d])", "$1:00")
    iso = F.when(text.contains(":"), zoned).otherwise(text).try_cast("timestamp")
    return (
        F.when(text.rlike(_ISO), iso)
        .when(text.rlike(r"^\d"), _by_shape(text, _NUMERIC_SHAPES))
        .when(text.rlike(r"^\p{L}"), _by_shape(text, _NAMED_SHAPES))
    )


def with_posted_time(df: DataFrame, value: str, fetched: str, out: str) -> DataFrame:
    """Add ``out``, when a posting went up: relative to the fetch, else absolute, else NULL.

    NULL whenever the fetch time is unknown, for absolute spellings too.  The steps are
    separate columns, so no pattern is matched twice on a row.
    """
    text, count, unit, back = "__text", "__count", "__unit", "__back"
    known = F.col(fetched).isNotNull()
    rows = df.withColumn(
        text, F.when(known, F.translate(strip(F.col(value)), rules.ARABIC_DIGITS, "0123456789"))
    )

    counted = F.col(text).contains(rules.RELATIVE_PREFIX)
    digits = {}
    for i, (unit_words, _) in enumerate(rules.RELATIVE_UNITS):
        pattern = rf"{rules.RELATIVE_PREFIX}{WS}+(\p{{Nd}}+){WS}+(?:{'|'.join(unit_words)})"
        digits[f"__digits{i}"] = F.when(
            counted, F.nullif(F.regexp_extract(text, pattern, 1), F.lit(""))
        )
    rows = rows.withColumns(digits)

    seconds = [F.lit(unit_seconds) for _, unit_seconds in rules.RELATIVE_UNITS]
    rows = rows.withColumns(
        {
            count: whole_number(F.coalesce(*digits), _TOO_LONG),
            unit: F.coalesce(*[F.when(F.col(d).isNotNull(), s) for d, s in zip(digits, seconds)]),
        }
    )

    phrases = F.create_map(*[F.lit(x) for p in rules.RELATIVE_PHRASES.items() for x in p])
    rows = rows.withColumn(
        back,
        F.coalesce(
            F.col(count) * F.col(unit), F.try_element_at(phrases, F.col(text)).cast("bigint")
        ),
    )

    relative = F.when(
        F.col(back) <= _LONGEST_SPAN,
        F.timestamp_micros(F.unix_micros(fetched) - F.col(back) * F.lit(1_000_000)),
    )
    rows = rows.withColumn(
        out,
        F.when(F.col(back).isNotNull(), relative).otherwise(absolute_time(F.col(text))),
    )
    # Outside the instants that the rules' clock can tell, there is no time.
    first, last = (F.lit(t).cast("timestamp") for t in (_EARLIEST, _LATEST))
    rows = rows.withColumn(out, F.when(F.col(out).between(first, last), F.col(out)))
    return rows.drop(text, count, unit, back, *digits)


def date_key(d: Column) -> Column:
    """``yyyymmdd`` as an integer."""
    return (F.year(d) * 10_000 + F.month(d) * 100 + F.day(d)).cast("int")
