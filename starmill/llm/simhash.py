"""SimHash fingerprints, their links and the groups that the links make.

A fingerprint has 8 positional bytes.  Two fingerprints that differ in at most two bits differ in
at most two bytes, so they share at least six of the eight: that is the guaranteed minimum the
count filter asks for.  Single bytes make posting lists that hold 1/256 of all rows, so the index
joins them: the eight bytes form four blocks of two, at least two whole blocks are shared, and a
posting is one of the six pairs of blocks (four positional bytes).  Every linked pair meets in at
least one posting list.  There its shared positional bytes are tallied, pairs with six or more are
verified bit by bit.

Lists longer than ``longest`` are not paired.  Their members get an exact other way: two
fingerprints differ in at most two bits exactly when some value is within one bit of both.  Each
member is listed under itself and under its one-bit neighbours within the bits that the list's key
leaves free, and each of these lists is a group of linked fingerprints, so one link to its
smallest member keeps the groups.  No pairs are made, and no link between groups is lost.

Groups come from alternating large-star and small-star rounds over the links between distinct
fingerprints; each round is a written table.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmill.llm.common import ROW, stage, text_of, with_row_key

MOST_BITS = 2
LEAST_BYTES = 6
LONGEST_LIST = 64
BLOCK_PAIRS = list(combinations(range(4), 2))
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_SHINGLES_AT_ONCE = 200_000


def fingerprint(text: str, words: int = 3) -> int:
    """Unsigned 64-bit SimHash of the shingles of ``words`` words, repeats included."""
    # bytes.split() takes exactly the six ASCII white space characters for separators.
    parts = text.encode("utf-8", "replace").translate(_LOWER).split()
    if not parts:
        return 0
    n = max(1, len(parts) - words + 1)
    line = b" ".join(parts)
    sizes = np.fromiter(map(len, parts), dtype=np.int64, count=len(parts)) + 1
    ends = np.cumsum(sizes) - 1
    starts = (ends + 1 - sizes)[:n].tolist()
    ends = ends[min(words, len(parts)) - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, n, _SHINGLES_AT_ONCE):
        until = min(n, at + _SHINGLES_AT_ONCE)
        hashes = np.array([digest(line[i:j], 42) for i, j in zip(starts[at:until], ends[at:until], strict=True)], dtype="<u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * ones > n, bitorder="little")
    return int(bits.view("<u8")[0])


def _fingerprints(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for texts in batches:
        values = np.fromiter((fingerprint(t) for t in texts), dtype=np.uint64, count=len(texts))
        yield pd.Series(values.view(np.int64))


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key`` and ``fp``, the fingerprint as a signed long; a null text is an empty one."""
    by_text = F.pandas_udf(_fingerprints, "long")
    return docs.select(F.col(key), by_text(text_of(text)).alias("fp"))


# --- links -----------------------------------------------------------------------------


def _block(fp: Column, block: int) -> Column:
    return F.shiftrightunsigned(fp, 16 * block).bitwiseAND(F.lit(0xFFFF))


def _free_bits(pair: tuple[int, int]) -> list[int]:
    return [bit for bit in range(64) if bit // 16 not in pair]


def _signed(value: int) -> int:
    return value - (1 << 64) if value >= 1 << 63 else value


def postings(distinct: DataFrame) -> DataFrame:
    """``list`` (which pair of blocks), ``value`` (their 32 bits) and ``fp``, six rows a fingerprint."""
    fp = F.col("fp")
    entries = [
        F.struct(
            F.lit(number).alias("list"),
            F.shiftleft(_block(fp, i), 16).bitwiseOR(_block(fp, j)).alias("value"),
        )
        for number, (i, j) in enumerate(BLOCK_PAIRS)
    ]
    return distinct.select("fp", F.explode(F.array(*entries)).alias("entry")).select("entry.list", "entry.value", "fp")


def links(distinct: DataFrame, longest: int = LONGEST_LIST) -> DataFrame:
    """``u`` < ``v``: links that join the same groups as all links at two or fewer bits.

    ``distinct`` has one row per fingerprint (``fp``).
    """
    index = postings(distinct)
    # Spark counts a list before its rows meet, so a long list costs one row per map task.
    sizes = index.groupBy("list", "value").agg(F.count("*").alias("n")).where("n > 1")
    index = stage(index.join(sizes, ["list", "value"]), "simhash-index")

    short = index.where(F.col("n") <= longest).select("list", "value", "fp")
    members = short.groupBy("list", "value").agg(F.sort_array(F.collect_list("fp")).alias("fps"))
    pairs = members.select(
        F.explode(
            F.expr(
                f"""filter(
                    flatten(transform(fps, (a, i) -> transform(slice(fps, i + 2, {longest}), b -> struct(a AS u, b AS v)))),
                    p -> {_shared('p.u', 'p.v')} >= {LEAST_BYTES} AND bit_count(p.u ^ p.v) <= {MOST_BITS})"""
            )
        ).alias("p")
    ).select("p.u", "p.v")

    long_lists = index.where(F.col("n") > longest).select("list", "fp")
    flips = F.create_map(
        *[
            part
            for number, pair in enumerate(BLOCK_PAIRS)
            for part in (F.lit(number), F.array(*[F.lit(_signed(1 << b)) for b in _free_bits(pair)], F.lit(0)))
        ]
    )
    near = long_lists.select(
        "list", "fp", F.explode(F.element_at(flips, F.col("list"))).alias("flip")
    ).select("list", "fp", F.col("fp").bitwiseXOR(F.col("flip")).alias("near"))
    least = near.groupBy("list", "near").agg(F.min("fp").alias("u"), F.collect_set("fp").alias("fps"))
    stars = least.where(F.size("fps") > 1).select("u", F.explode("fps").alias("v")).where("u < v")
    return pairs.unionByName(stars).distinct()


def _shared(a: str, b: str) -> str:
    """SQL for the tally of positional bytes that two fingerprints share."""
    return " + ".join(
        f"int((shiftrightunsigned({a} ^ {b}, {8 * i}) & 255L) = 0L)" for i in range(8)
    )


# --- groups ----------------------------------------------------------------------------


def groups(edges: DataFrame) -> DataFrame:
    """``v`` and ``u``, the smallest node that ``v`` reaches, for every node with an edge but the smallest.

    ``edges``: ``u`` < ``v``.  Alternates large stars (neighbours above a node move to the node's
    smallest neighbour) and small stars (neighbours below it do) until nothing changes.
    """
    edges = stage(edges.select("u", "v").distinct(), "stars")
    state = _state(edges)
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("m").alias("u"), "v").where("u < v").distinct()
        large = stage(large, "stars")
        down = large.groupBy("v").agg(F.min("u").alias("m"))
        moved = large.join(down, "v").select(F.col("m").alias("u"), F.col("u").alias("v")).where("u < v")
        edges = stage(moved.unionByName(down.select(F.col("m").alias("u"), "v")).distinct(), "stars")
        before, state = state, _state(edges)
        if state == before:
            return edges


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.expr("bit_xor(xxhash64(u, v))")).first())


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``key``, ``fingerprint`` (16 hex digits), ``component_id``.

    ``component_id`` is the smallest key that the document reaches over links, itself included.
    A null text is empty; texts without a word have fingerprint zero and are linked like any
    other.  A row with a null key gets the smallest key of its group, null where there is none.
    Repeated rows stay, rows of one key are linked through their texts only.  An empty table
    gives no rows.
    """
    prints = stage(fingerprints(docs, key, text).withColumnRenamed(key, "doc_id"), "simhash")
    distinct = stage(prints.groupBy("fp").agg(F.min("doc_id").alias("doc_id")), "simhash-distinct")
    of_root = groups(links(distinct.select("fp"))).select(F.col("v").alias("fp"), F.col("u").alias("root"))
    rooted = distinct.join(of_root, "fp", "left").select("fp", "doc_id", F.coalesce("root", "fp").alias("root"))
    smallest = rooted.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    classes = stage(rooted.join(smallest, "root").select("fp", "component_id"), "simhash-classes")
    return prints.join(classes, "fp", "left").select(
        F.col("doc_id").alias(key),
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id",
    )


def one_of_each(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` with one row of each group: the one with the smallest doc_id.

    Each row stands for itself: rows of one doc_id with different texts stay, one for each group.
    Rows without a doc_id come last; one stays for each group that has no doc_id at all.
    """
    rows = with_row_key(docs)
    classes = near_duplicates(rows.select(ROW, "text"), ROW).select(ROW, F.col("component_id").alias("__group"))
    order = F.struct(F.col("doc_id").isNull(), "doc_id", F.xxhash64("text"), F.col(ROW))
    named = rows.select("doc_id", ROW, order.alias("__order")).join(classes, ROW)
    kept = named.groupBy("__group").agg(F.min_by(ROW, "__order").alias(ROW)).select(ROW)
    return rows.join(kept, ROW, "left_semi").select(*docs.columns)
