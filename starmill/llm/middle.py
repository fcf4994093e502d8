"""Fill-in-the-middle: whole texts cut at two units and put in the order a model learns to fill.

A text is read as fixed blocks of ``BLOCK`` UTF-8 bytes.  A Fenwick tree over the blocks holds how
many units begin and how many code points begin in each.  A cut is a number of units: the descent,
halving its step at each node, finds the block in which that unit begins and how many code points
lie before it; the place inside the block is found there.  No text is split into its units.

What comes back from Python is two numbers of code points a text; the parts are put together by
Spark's own string functions, which also rebuild the text from the result.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmill.llm.common import text_of

BLOCK = 2048
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Of 100 texts, so many stay plain; of 100 others, so many have the suffix first.
PLAIN_SHARE, SUFFIX_FIRST_SHARE = 10, 20
SEED = 1

_SPACES = np.zeros(256, dtype=bool)
_SPACES[[0x20, *range(0x09, 0x0E)]] = True


# --- units -----------------------------------------------------------------------------


def _code_points(data: np.ndarray) -> np.ndarray:
    """Bytes at which a code point begins."""
    return (data & 0xC0) != 0x80


def _words(data: np.ndarray) -> np.ndarray:
    """Bytes at which a word begins after white space; what precedes the first word belongs to it."""
    space = _SPACES[data]
    begins = ~space
    begins[1:] &= space[:-1]
    if begins.any():
        begins[begins.argmax()] = False
    begins[:1] = True
    return begins


def _lines(data: np.ndarray) -> np.ndarray:
    """Bytes after a line feed, and the first."""
    begins = np.empty(len(data), dtype=bool)
    begins[:1] = True
    begins[1:] = data[:-1] == 0x0A
    return begins


#: What a text can be cut between.  Units follow one another without a gap, from the first byte on.
UNITS: dict[str, Callable[[np.ndarray], np.ndarray]] = {
    "code_points": _code_points,
    "words": _words,
    "lines": _lines,
}


# --- blocks ----------------------------------------------------------------------------


class BlockTree:
    """A Fenwick tree over a text's blocks: begun units and code points."""

    def __init__(self, text: bytes, units: str = "code_points", block: int = BLOCK):
        data = np.frombuffer(text, dtype=np.uint8)
        self.block = block
        self.points = _code_points(data)
        self.begins = self.points if units == "code_points" else UNITS[units](data)
        edges = np.arange(0, len(data), block)
        counts = [np.add.reduceat(flags, edges, dtype=np.int64) if len(data) else np.empty(0, np.int64) for flags in (self.begins, self.points)]
        self.total, self.length = int(counts[0].sum()), int(counts[1].sum())
        self.units, self.chars = (self._tree(c) for c in counts)

    @staticmethod
    def _tree(counts: np.ndarray) -> list[int]:
        """Node i (from 1) holds the sum of the lowest-set-bit-of-i blocks that end with block i."""
        sums = np.concatenate([[0], np.cumsum(counts)])
        i = np.arange(1, len(counts) + 1)
        return [0, *(sums[i] - sums[i - (i & -i)]).tolist()]

    def _descend(self, unit: int) -> tuple[int, int, int]:
        """The block in which ``unit`` (from 0) begins, and the units and code points before the block."""
        at = units = chars = 0
        step = 1 << (len(self.units) - 1).bit_length()
        while step := step >> 1:
            here = at + step
            if here < len(self.units) and units + self.units[here] <= unit:
                at, units, chars = here, units + self.units[here], chars + self.chars[here]
        return at, units, chars

    def chars_before(self, unit: int) -> int:
        """Code points before the place where ``unit`` begins; all of them for the unit after the last."""
        if unit >= self.total:
            return self.length
        block, units, chars = self._descend(unit)
        begin = block * self.block
        inside = np.flatnonzero(self.begins[begin : begin + self.block])[unit - units]
        return chars + int(np.count_nonzero(self.points[begin : begin + inside]))


def cut(text: bytes, one: int, two: int, units: str = "code_points", block: int = BLOCK) -> tuple[int, int, int]:
    """Units, code points of the prefix and of the middle, cut after ``one`` and ``two`` modulo units + 1."""
    tree = BlockTree(text, units, block)
    low, high = sorted((one % (tree.total + 1), two % (tree.total + 1)))
    prefix = tree.chars_before(low)
    return tree.total, prefix, tree.chars_before(high) - prefix


# --- over all documents ------------------------------------------------------------------


def draws(seed: int, key: str = "doc_id") -> list[Column]:
    """Four numbers of 32 bits from the hash of seed and key; a null key counts as empty."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)]


def transform(
    docs: DataFrame,
    units: str = "code_points",
    seed: int = SEED,
    plain_share: int = PLAIN_SHARE,
    suffix_first_share: int = SUFFIX_FIRST_SHARE,
    block: int = BLOCK,
) -> DataFrame:
    """``doc_id``, ``n`` (units), ``form``, ``prefix_chars``, ``middle_chars``, ``output`` for every row of ``docs``.

    ``form`` is plain (the text as it is), psm or spm (which part comes first).  A text that is
    empty or holds one of the marks is plain; its numbers of code points are null.  A null text
    is empty, a null doc_id is drawn for as an empty one and stays null, repeated rows are cut
    alike, an empty table gives no rows; other columns play no part.
    """

    def cuts(texts: pd.Series, ones: pd.Series, twos: pd.Series) -> pd.DataFrame:
        rows = [cut(t, a, b, units, block) for t, a, b in zip(texts, ones.tolist(), twos.tolist(), strict=True)]
        return pd.DataFrame(rows, columns=["n", "prefix", "middle"], dtype="int64")

    cut_udf = F.pandas_udf(cuts, "n long, prefix long, middle long")
    one, two, three, four = draws(seed)
    marked = F.lit(False)
    for mark in (PREFIX, SUFFIX, MIDDLE):
        marked |= F.contains("__text", F.lit(mark))
    plain = (F.col("__text") == "") | marked | (three % 100 >= 100 - plain_share)
    rows = docs.select("doc_id", text_of().alias("__text"))
    # As bytes the text reaches Python without being decoded.
    rows = rows.withColumn("__cut", cut_udf(F.col("__text").cast("binary"), one, two))
    rows = rows.withColumn("form", F.when(plain, "plain").when(four % 100 < suffix_first_share, "spm").otherwise("psm"))
    shown = [F.when(F.col("form") != "plain", F.col(f"__cut.{part}")).alias(f"{part}_chars") for part in ("prefix", "middle")]
    return rows.select("doc_id", F.col("__cut.n").alias("n"), "form", *shown, _joined().alias("output"))


def _joined() -> Column:
    text, prefix, middle = F.col("__text"), F.col("__cut.prefix").cast("int"), F.col("__cut.middle").cast("int")
    front = F.substr(text, F.lit(1), prefix)
    centre = F.substr(text, prefix + 1, middle)
    back = F.substr(text, prefix + middle + 1)
    psm = F.concat(F.lit(PREFIX), front, F.lit(SUFFIX), back, F.lit(MIDDLE), centre)
    spm = F.concat(F.lit(SUFFIX), back, F.lit(PREFIX), front, F.lit(MIDDLE), centre)
    return F.when(F.col("form") == "plain", text).when(F.col("form") == "spm", spm).otherwise(psm)


def restored(output: str = "output", form: str = "form") -> Column:
    """The text that :func:`transform` was given, from its result alone."""
    # A cut text holds no mark of its own, so the marks part it exactly.
    parts = F.split(F.col(output), "<[PSM]>", -1)
    one, two, three = (F.element_at(parts, i) for i in (2, 3, 4))
    return (
        F.when(F.col(form) == "plain", F.col(output))
        .when(F.col(form) == "spm", F.concat(two, three, one))
        .otherwise(F.concat(one, three, two))
    )


def digest(cut_docs: DataFrame) -> DataFrame:
    """``cut_docs`` with SHA-256 of the output and of the restored text in the output's place."""
    return cut_docs.select(
        *[c for c in cut_docs.columns if c != "output"],
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(restored(), 256).alias("restored_sha256"),
    )
