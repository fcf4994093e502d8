"""Search for dictionaries of many terms.

:func:`starmill.functions.text.terms_found` makes one pattern of all terms, so its cost grows with
them.  Here an automaton of the terms reads each text once, whatever their number.  It runs in
Python on Arrow batches; for a few dozen terms the pattern, which stays inside the JVM, is faster.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pandas as pd
from pyspark import Broadcast
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from starmill.functions.text import _is_word, null_if_empty

# Bytes of terms that one automaton takes; a larger dictionary is searched block by block.
BLOCK_BYTES = 16 * 1024 * 1024


def _blocks(terms: Iterable[str], block_bytes: int) -> list[list[str]]:
    blocks: list[list[str]] = []
    size = 0
    for term in terms:
        size += len(term.encode())
        if not blocks or size > block_bytes:
            blocks.append([])
            size = len(term.encode())
        blocks[-1].append(term)
    return blocks


def _stands_alone(text: str, start: int, end: int, strict: bool) -> bool:
    """Whether text[start:end] has the neighbours a term needs; see ``text.terms_found``."""
    before = start > 0 and _is_word(text[start - 1])
    after = end < len(text) and _is_word(text[end])
    left_is_word = _is_word(text[start]) or not strict
    right_is_word = _is_word(text[end - 1]) or not strict
    return before != left_is_word and after != right_is_word


def _search(block: Broadcast[list[str]], strict: bool) -> Callable[[Column], Column]:
    def search(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        import ahocorasick

        automaton = ahocorasick.Automaton()
        for number, term in enumerate(block.value):
            automaton.add_word(term.lower(), (number, len(term.lower())))
        automaton.make_automaton()

        def found(text: str | None) -> list[str] | None:
            if text is None:
                return None
            hits: set[int] = set()
            for last, (number, length) in automaton.iter(text):
                if number not in hits and _stands_alone(text, last + 1 - length, last + 1, strict):
                    hits.add(number)
            return [block.value[number] for number in sorted(hits)]

        for texts in batches:
            yield texts.map(found, na_action=None)

    return F.pandas_udf(search, "array<string>")


def terms_found(
    spark: SparkSession, c: Column, terms: Iterable[str], strict: bool = True, block_bytes: int = BLOCK_BYTES
) -> Column:
    """Array of the terms that occur in the text, any case, in the order of ``terms``; NULL for NULL.

    The same result as ``text.terms_found``.
    """
    terms = list(terms)
    if not all(terms) or len({t.lower() for t in terms}) != len(terms):
        raise ValueError("terms must not be empty and must differ by more than case")
    low = F.lower(c)
    found = [
        _search(spark.sparkContext.broadcast(block), strict)(low) for block in _blocks(terms, block_bytes)
    ]
    if not found:
        return F.when(c.isNotNull(), F.array().cast("array<string>"))
    return found[0] if len(found) == 1 else F.concat(*found)


def terms_text(
    spark: SparkSession, c: Column, terms: Iterable[str], strict: bool = True, none: str = "N/A", **options
) -> Column:
    """The found terms as one text, ``none`` when there are none (or no text)."""
    text = F.array_join(terms_found(spark, c, terms, strict, **options), ", ")
    return F.coalesce(null_if_empty(text), F.lit(none))
