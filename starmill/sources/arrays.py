"""JSON array files read by many tasks each.

Spark's own reader gives a file that is one JSON array to one task.  Here the scan splits it like
any text, at closing braces.  Whether a split begins inside a string, and how deep, follows from
the splits before it: a first pass counts quotes and brackets of each split for both cases, the
running sums over a file's splits (windows) give each its beginning, and a second pass cuts out the
elements.  Only elements that lie across a border are put together by a shuffle.  A task takes many
small splits one after the other, so tasks grow with the bytes, not with the number of splits.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from itertools import groupby

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starmill.session import configure
from starmill.sources.tables import run_folder, stage

_ESCAPED = re.compile(r"\\.", re.DOTALL)
_BRACKET = re.compile(r"[{}\[\]]")
_MARK = re.compile(r'\\.|["{}\[\]]', re.DOTALL)
_BETWEEN = " \t\r\n,[]}\ufeff"

_SUMMARY = "file string, block bigint, quotes int, depth0 bigint, low0 bigint, depth1 bigint, low1 bigint"
_PIECE = "file string, block bigint, n bigint, begun bigint, json string"
# How a split begins: in a string or not, how deep, and the split in which the element at the border began.
_START = ["inside", "depth", "begun"]
#: Bytes that a task reads where splits are smaller.
TASK_BYTES = 32 << 20


class NoArray(ValueError):
    """A file that is not one JSON array of objects."""


def _pieces(batches: Iterator[pd.DataFrame], also: list[str] | None = None) -> Iterator[tuple]:
    """File, split and text of each piece, with the brace that ended it, and the columns in ``also``.

    The last piece of a file had none: it is the text behind the last element.
    """
    for batch in batches:
        for file, block, value, *rest in zip(*[batch[c] for c in ["file", "block", "value", *(also or [])]]):
            yield file, int(block), value + "}", *rest


def _runs(text: str) -> list[str]:
    """The text between quotes, in strings and out of them by turns, without what is escaped."""
    return (_ESCAPED.sub("", text) if "\\" in text else text).split('"')


def _flat(text: str) -> int | None:
    """Where the element begins, if a piece between two elements is one without others inside."""
    runs = _runs(text)
    outside = "".join(runs[::2])
    if len(runs) % 2 and outside.count("{") == 1 and "[" not in outside and "]" not in outside:
        before, brace, _ = runs[0].partition("{")
        if brace and text.startswith(before) and not before.strip(_BETWEEN):
            return len(before)
    return None


def _summaries(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Per split: parity of its quotes; brackets opened less closed, and the lowest that gets.

    The latter two for a beginning outside of a string (0) and inside (1).
    """
    for (file, block), pieces in groupby(_pieces(batches), key=lambda p: p[:2]):
        inside, depth, low = 0, [0, 0], [0, 0]
        for _, _, text in pieces:
            runs = _runs(text)
            for case in (0, 1):
                for mark in _BRACKET.findall("".join(runs[inside ^ case :: 2])):
                    depth[case] += 1 if mark in "{[" else -1
                    low[case] = min(low[case], depth[case])
            inside ^= ~len(runs) & 1
        yield pd.DataFrame([(file, block, inside, depth[0], low[0], depth[1], low[1])])


def _beginnings(summaries: DataFrame) -> DataFrame:
    """How each split begins, stored; raises where a file is not one whole array."""
    so_far = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    inside = F.coalesce(F.sum("quotes").over(so_far), F.lit(0)) % 2
    depth = F.coalesce(F.sum("change").over(so_far), F.lit(0))
    ended = F.when(F.col("depth") + F.col("low") <= 1, F.col("block"))
    starts = (
        summaries.withColumn("inside", inside)
        .withColumn("change", F.when(F.col("inside") == 1, F.col("depth1")).otherwise(F.col("depth0")))
        .withColumn("low", F.when(F.col("inside") == 1, F.col("low1")).otherwise(F.col("low0")))
        .withColumn("depth", depth)
        .withColumn("begun", F.last(ended, ignorenulls=True).over(so_far))
    )
    starts = stage(starts.select("file", "block", *_START, "quotes", "change"), "array-splits")
    # The text behind the last element closes the array and counts one brace too many.
    whole = (F.sum("quotes") % 2 == 0) & (F.sum("change") == -1)
    torn = starts.groupBy("file").agg(whole.alias("whole")).where("NOT whole").first()
    if torn:
        raise NoArray(f"{torn.file} is not one whole JSON array")
    return starts.select("file", "block", *_START)


def _elements(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The elements of each split, or their parts in it."""

    def of_split(file: str, block: int, pieces: Iterator[tuple]) -> Iterator[tuple]:
        number, held, begun = 0, [], None
        for place, (_, _, text, *start) in enumerate(pieces):
            if place == 0:
                inside, depth = int(start[0]), int(start[1])
                begun = None if pd.isna(start[2]) else int(start[2])
            if depth == 1 and not inside and text[-1] == "}" and (begin := _flat(text)) is not None:
                yield file, block, number, None, text[begin:]
                number, begun = number + 1, None
                continue
            begin, done = (0, len(text)) if depth >= 2 else (None, 0)
            for match in _MARK.finditer(text):
                mark = match.group()
                if mark == '"':
                    inside ^= 1
                elif inside or mark[0] == "\\":
                    continue
                elif mark in "{[":
                    if depth < 2 and (mark == "{") != (depth == 1):
                        raise NoArray(f"{file} has elements that are no objects")
                    if depth == 1:
                        _nothing(file, text[done : match.start()])
                        begin, done, begun = match.start(), len(text), None
                    depth += 1
                elif depth > 0:
                    depth -= 1
                    if depth == 1:
                        held.append(text[begin : match.end()])
                        yield file, block, None if begun is not None else number, begun, "".join(held)
                        number += begun is None
                        held, begin, done, begun = [], None, match.end(), None
            if begin is not None:
                held.append(text[begin:])
            _nothing(file, text[done:])
        if held:  # begun here or before, ended in a later split
            first = begun is None
            yield file, block, number if first else None, block if first else begun, "".join(held)

    for (file, block), pieces in groupby(_pieces(batches, _START), key=lambda p: p[:2]):
        rows = []
        for row in of_split(file, block, pieces):
            rows.append(row)
            if len(rows) == 1000:
                yield _frame(rows)
                rows = []
        yield _frame(rows)


def _frame(rows: list[tuple]) -> pd.DataFrame:
    frame = pd.DataFrame(rows, columns=["file", "block", "n", "begun", "json"])
    return frame.astype({"block": "Int64", "n": "Int64", "begun": "Int64"})


def _nothing(file: str, text: str) -> None:
    if text.strip(_BETWEEN):
        raise NoArray(f"{file} has text between its elements")


def array_elements(spark: SparkSession, path: str, split_bytes: int | None = None) -> DataFrame:
    """The objects of JSON array files as text, stored, with ``file`` and the order in it (``block``, ``n``).

    ``split_bytes`` bounds a split, as ``spark.sql.files.maxPartitionBytes`` does without it.  A few
    numbers of each split go to all executors.  An empty file has no elements; one that is not an
    array of objects, UTF-8 throughout, raises.
    """
    reader = configure(spark.newSession())
    size = split_bytes or spark.conf.get("spark.sql.files.maxPartitionBytes")
    reader.conf.set("spark.sql.files.maxPartitionBytes", str(size))
    scan = reader.read.option("lineSep", "}").text(path)
    text = scan.select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value"
    )
    if split_bytes:
        # Whole splits one after the other: no shuffle, and the order within a split stays.
        wanted = -(-scan.rdd.getNumPartitions() * split_bytes // TASK_BYTES)
        text = text.coalesce(max(wanted, spark.sparkContext.defaultParallelism))
    starts = _beginnings(text.mapInPandas(_summaries, _SUMMARY))
    folder = run_folder(spark, "array")
    # A map join: each split's pieces stay together and in order.
    text.join(F.broadcast(starts), ["file", "block"]).mapInPandas(_elements, _PIECE).write.parquet(folder)
    stored = spark.read.schema(_PIECE).parquet(folder)

    parts = F.array_sort(F.collect_list(F.struct(F.col("stored_block"), F.col("json"))))
    joined = (
        stored.where("begun IS NOT NULL")
        .select("file", F.col("begun").alias("start"), F.col("block").alias("stored_block"), "n", "json")
        .groupBy("file", F.col("start").alias("block"))
        .agg(F.max("n").alias("n"), F.array_join(F.transform(parts, lambda p: p["json"]), "").alias("json"))
    )
    return stored.where("begun IS NULL").select("file", "block", "n", "json").unionByName(joined)


def read_array(spark: SparkSession, path: str, schema: str, split_bytes: int | None = None) -> DataFrame:
    """The records of JSON array files, as ``read_records(..., array_file=True)`` gives them."""
    elements = array_elements(spark, path, split_bytes)
    record = F.from_json("json", schema, {"mode": "FAILFAST"})
    return elements.select(record.alias("record")).select("record.*")
