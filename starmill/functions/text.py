"""Text columns: whitespace, case, lists, HTML and dictionary search.

Java's ``\\s``, ``\\w`` and ``\\b`` differ from the Unicode notion the rules use, so the classes
are spelled out once here and every pattern is built from them.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterable, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# Unicode white space, as characters (for trimming) and as a regex class (for matching).
WS_CHARS = "".join(
    chr(c)
    for first, last in [
        (0x09, 0x0D), (0x1C, 0x20), (0x85, 0x85), (0xA0, 0xA0), (0x1680, 0x1680),
        (0x2000, 0x200A), (0x2028, 0x2029), (0x202F, 0x202F), (0x205F, 0x205F),
        (0x3000, 0x3000),
    ]
    for c in range(first, last + 1)
)
_WS_SET = (
    r"\x{9}-\x{d}\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
)
WS = f"[{_WS_SET}]"

# A word character, and its edges as lookarounds.
WORD = r"[\p{L}\p{N}_]"
NOT_AFTER_WORD = f"(?<!{WORD})"
NOT_BEFORE_WORD = f"(?!{WORD})"
AFTER_WORD = f"(?<={WORD})"
BEFORE_WORD = f"(?={WORD})"

_CASED = r"\p{IsLowercase}\p{IsUppercase}\p{Lt}"

_JAVA_META = re.compile(r"([\\^$.|?*+()\[\]{}&~#-])")


def quote(literal: str) -> str:
    """``literal`` as a regex that matches just itself."""
    return _JAVA_META.sub(r"\\\1", literal)


def words(*alternatives: str) -> str:
    """Pattern for any of the given sub-patterns standing as whole words."""
    return f"{NOT_AFTER_WORD}(?:{'|'.join(alternatives)}){NOT_BEFORE_WORD}"


# --- null handling ---------------------------------------------------------------------


def null_if_token(c: Column, tokens: Sequence[str]) -> Column:
    """NULL when the whole, untrimmed cell is one of ``tokens``."""
    return F.when(~c.isin(*tokens), c)


def null_if_empty(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def or_default(c: Column, default: str) -> Column:
    """``default`` for NULL and for the empty string; blanks are kept."""
    return F.coalesce(null_if_empty(c), F.lit(default))


def first_filled(*cs: Column) -> Column:
    """The first column that is neither NULL nor empty, else the empty string."""
    return F.coalesce(*[null_if_empty(c) for c in cs], F.lit(""))


def or_blank(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


# --- whitespace and case ---------------------------------------------------------------


def strip(c: Column) -> Column:
    return F.btrim(c, F.lit(WS_CHARS))


def is_filled(c: Column) -> Column:
    """True when there is something besides white space; never NULL."""
    return F.coalesce(strip(c) != "", F.lit(False))


def squeeze(c: Column) -> Column:
    """Strip, and turn each run of white space into one space.

    Cells in plain ASCII without a double space skip the costly Unicode class; afterwards the
    plain space is the only white space left and the cheap ``trim`` does the ends.
    """
    runs = F.regexp_replace(c, f"{WS}+", " ")
    suspect = c.contains("  ") | c.rlike("[^ -~]")
    return F.trim(F.when(suspect, runs).otherwise(c))


def title_case(c: Column) -> Column:
    """Capitalise every run of cased letters (``o'reilly`` -> ``O'Reilly``)."""
    runs = F.regexp_extract_all(c, F.lit(f"([{_CASED}]+|[^{_CASED}]+)"), F.lit(1))
    return F.array_join(F.transform(runs, F.initcap), "")


def title_if_lower(c: Column) -> Column:
    """Title-case a cell that has lower-case letters only; leave mixed case alone."""
    all_lower = c.rlike(r"\p{IsLowercase}") & ~c.rlike(r"[\p{IsUppercase}\p{Lt}]")
    return F.when(all_lower, title_case(c)).otherwise(c)


def map_lowered(c: Column, mapping: dict[str, str]) -> Column:
    """Lower-case, then replace the spellings ``mapping`` knows; others stay lower-cased."""
    low = F.lower(c)
    table = F.create_map(*[F.lit(x) for pair in mapping.items() for x in pair])
    return F.coalesce(F.try_element_at(table, low), low)


def map_exact(c: Column, mapping: dict[str, str]) -> Column:
    table = F.create_map(*[F.lit(x) for pair in mapping.items() for x in pair])
    return F.coalesce(F.try_element_at(table, c), c)


# --- lists in text ---------------------------------------------------------------------


def filled_items(items: Column) -> Column:
    """Stripped items of an array, blank ones dropped."""
    return F.filter(F.transform(items, strip), lambda x: x != "")


def join_filled(items: Column, separator: str = ", ") -> Column:
    return F.array_join(filled_items(items), separator)


def parse_list(c: Column) -> Column:
    """Comma-separated text to an array of filled items, repeats kept; NULL gives no items."""
    return filled_items(F.split(or_blank(c), ","))


def clean_list(c: Column) -> Column:
    """Comma-separated text with repeats and blanks removed, order kept; NULL when empty."""
    items = F.array_distinct(filled_items(F.split(c, ",")))
    return null_if_empty(F.array_join(items, ", "))


# --- HTML ------------------------------------------------------------------------------


def _entity_decoder():
    # Defined here, not at module level, so it is shipped to the executors by value and they
    # need nothing but the standard library and pandas.
    def decode(cells: pd.Series) -> pd.Series:
        return cells.map(html.unescape, na_action="ignore")

    return F.pandas_udf(decode, StringType())


def decode_entities(c: Column) -> Column:
    """HTML5 character references to characters.

    Only cells holding ``&`` carry their text over Arrow; the others travel as NULL.
    """
    return F.coalesce(_entity_decoder()(F.when(c.contains("&"), c)), c)


def drop_tags(c: Column) -> Column:
    """Each tag to a space.

    What follows the last ``>`` holds no whole tag and is left out of the search, so a text
    full of stray ``<`` is still read once, not once per ``<``.
    """
    rest = F.substring_index(c, ">", -1)
    tagged = F.left(c, F.length(c) - F.length(rest))
    return F.concat(F.regexp_replace(tagged, "<[^>]++>", " "), rest)


def with_plain_text(df: DataFrame, column: str, out: str | None = None) -> DataFrame:
    """Add ``out``, the HTML in ``column`` as plain text, NULL when nothing is left.

    Entities go first, so escaped markup is dropped too.  The steps are columns of their own,
    because each is used more than once by the next.
    """
    out, decoded, bare = out or column, "__decoded", "__bare"
    return (
        df.withColumn(decoded, decode_entities(F.col(column)))
        .withColumn(bare, drop_tags(F.col(decoded)))
        .withColumn(out, null_if_empty(squeeze(F.col(bare))))
        .drop(decoded, bare)
    )


# --- dictionary search -----------------------------------------------------------------


def _is_word(ch: str) -> bool:
    return ch == "_" or ch.isalnum()


def _edges(term: str, strict: bool) -> tuple[str, str]:
    """Lookarounds for a term.

    ``strict`` puts a word boundary at both ends, so an end that is not a word character
    needs a word character beside it; otherwise neither neighbour may be a word character.
    """
    left = NOT_AFTER_WORD if _is_word(term[0]) or not strict else AFTER_WORD
    right = NOT_BEFORE_WORD if _is_word(term[-1]) or not strict else BEFORE_WORD
    return left, right


def _both_can_start_here(a: str, b: str, strict: bool) -> bool:
    short, long = sorted((a, b), key=len)
    if not long.startswith(short):
        return False
    _, right = _edges(short, strict)
    return _is_word(long[len(short)]) == (right == BEFORE_WORD)


def _search_patterns(terms: Sequence[str], strict: bool) -> list[str]:
    """As few patterns as find every term that occurs.

    A pattern captures inside a lookahead, so terms may overlap.  Two terms that can match
    at the same place go to different patterns.
    """
    layers: list[list[str]] = []
    for term in terms:
        for layer in layers:
            if not any(_both_can_start_here(term, other, strict) for other in layer):
                layer.append(term)
                break
        else:
            layers.append([term])

    patterns = []
    for layer in layers:
        by_left: dict[str, dict[str, dict[str, list[str]]]] = {}
        for term in layer:
            left, right = _edges(term, strict)
            by_left.setdefault(left, {}).setdefault(right, {}).setdefault(term[0], []).append(term)
        for left, by_right in by_left.items():
            # One look at the next character spares most places the lookbehind.
            firsts = "".join(sorted({quote(t) for ts in by_right.values() for t in ts}))
            ends = []
            for right, by_first in by_right.items():
                heads = [
                    quote(first) + "(?:" + "|".join(quote(t[1:]) for t in group) + ")"
                    for first, group in by_first.items()
                ]
                ends.append(f"(?:{'|'.join(heads)}){right}")
            patterns.append(f"(?=[{firsts}]){left}(?=({'|'.join(ends)}))")
    return patterns


def terms_found(c: Column, terms: Iterable[str], strict: bool) -> Column:
    """Array of the terms that occur in the text, any case, in the order of ``terms``.

    The text is scanned once, not once per term.
    """
    by_low = {t.lower(): t for t in terms}
    if len(by_low) != len(list(terms)):
        raise ValueError("terms must differ by more than case")
    low = F.lower(c)
    found = [
        F.regexp_extract_all(low, F.lit(p), F.lit(1))
        for p in _search_patterns(list(by_low), strict)
    ]
    hits = found[0] if len(found) == 1 else F.flatten(F.array(*found))
    ordered = F.array_intersect(F.array(*[F.lit(t) for t in by_low]), hits)
    names = F.create_map(*[F.lit(x) for pair in by_low.items() for x in pair])
    return F.transform(ordered, lambda t: F.element_at(names, t))


def terms_text(c: Column, terms: Iterable[str], strict: bool = True, none: str = "N/A") -> Column:
    """The found terms as one text, ``none`` when there are none (or no text)."""
    text = F.array_join(terms_found(c, list(terms), strict), ", ")
    return F.coalesce(null_if_empty(text), F.lit(none))


def first_term(c: Column, terms: Iterable[str], strict: bool = False) -> Column:
    """The first term, in the order of ``terms``, that occurs in the text, else NULL."""
    return F.get(terms_found(c, list(terms), strict), F.lit(0))
