"""Token counts of documents in flat token files that have no index.

A flat file holds the ids of documents one after the other, in a fixed width and with an
end-of-document id behind each, and nothing else.  Files are read in blocks, each block by whatever
task gets it.  A vectorised search finds the separators of a block; what remains open at its edges
is stitched by an exclusive prefix scan over the blocks: the last separator before a block tells
where its first document began, the separators before it number the document.  The scan has two
levels (spans of ``SPAN`` blocks, then the spans of a file), so one huge file is no single group.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starmill.llm.common import run_folder, stage, text_of
from starmill.llm.tokens import default_path, token_bytes

END_ID = 49407
BLOCK_BYTES = 4 << 20
SPAN = 1024
_KINDS = {2: "<u2", 4: "<u4"}


def open_store(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of ``path`` and the path in it; a path without a scheme is local."""
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


# --- writing ---------------------------------------------------------------------------


def write(
    docs: DataFrame, folder: str, width: int = 2, end_id: int = END_ID, path: str | None = None
) -> DataFrame:
    """Writes the documents' ids to flat files under ``folder``; returns which files, in a written table.

    Rows: ``file``, ``bytes`` and ``doc_ids``, the documents of the file in order, no lengths.  Each
    task attempt writes a file of its own, so what a lost attempt left is in no row.  A null text
    is empty: its end id alone.  Names of special tokens in a text are ordinary text, so no text makes
    the id of one.  ``end_id`` must be such an id and fit ``width``, as all ids must; else it raises.
    """
    path = path or default_path()
    kind = _KINDS[width]

    def save(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        name, size, of = f"{folder}/{uuid.uuid4().hex}.tokens", 0, []
        store, place = open_store(name)
        store.create_dir(place.rpartition("/")[0], recursive=True)
        out = None
        for batch in batches:
            for doc_id, ids in zip(batch["doc_id"], token_bytes(batch["text"], path, special=False), strict=True):
                numbers = np.frombuffer(ids, dtype="<u4")
                if (numbers == end_id).any() or numbers.max(initial=0) >= 1 << (8 * width):
                    raise ValueError(f"document {doc_id} holds the end id or an id wider than {width} bytes")
                out = out or store.open_output_stream(place)
                data = np.append(numbers, np.uint32(end_id)).astype(kind).tobytes()
                out.write(data)
                size += len(data)
                of.append(None if pd.isna(doc_id) else int(doc_id))
        if out is not None:
            out.close()
            yield pd.DataFrame({"file": [name], "bytes": [size], "doc_ids": [of]})

    rows = docs.select(F.col("doc_id").cast("long"), text_of().alias("text"))
    return stage(rows.mapInPandas(save, "file string, bytes long, doc_ids array<long>"), "flat-files")


# --- reading ---------------------------------------------------------------------------


def separators(files: DataFrame, width: int = 2, end_id: int = END_ID, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``file``, ``block``, ``ids`` (how many) and ``ends``: places of the end id, counted from the file's start.

    ``files`` has ``file`` and ``bytes``.  Bytes behind the last whole id are no id.
    """
    size = block_bytes - block_bytes % width
    kind = _KINDS[width]

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples(index=False):
                store, place = open_store(row.file)
                with store.open_input_file(place) as source:
                    source.seek(row.block * size)
                    data = source.read(min(size, row.bytes - row.block * size))
                ids = np.frombuffer(data, dtype=kind, count=len(data) // width)
                ends = np.flatnonzero(ids == end_id) + row.block * (size // width)
                yield pd.DataFrame({"file": [row.file], "block": [row.block], "ids": [len(ids)], "ends": [ends.astype("int64")]})

    count = F.ceil(F.col("bytes") / F.lit(size))
    blocks = files.where("bytes > 0").select("file", "bytes", F.explode(F.sequence(F.lit(0), count - 1)).alias("block"))
    return blocks.repartition("file", "block").mapInPandas(search, "file string, block long, ids long, ends array<long>")


def documents(blocks: DataFrame) -> DataFrame:
    """``file``, ``ordinal`` (from 0), ``start``, ``n_tokens`` and ``ended`` of every document.

    ``blocks`` comes from :func:`separators`, stored.  Tokens behind a file's last end id are a
    document that has not ended; a file without an id has no documents.
    """
    # -1 stands for the file's start: the place before its first id.
    sums = blocks.select(
        "file", "block", (F.col("block") / SPAN).cast("long").alias("span"),
        F.size("ends").alias("n"), F.array_max("ends").alias("last"), "ids",
    )
    inside = Window.partitionBy("file", "span").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    across = Window.partitionBy("file").orderBy("span").rowsBetween(Window.unboundedPreceding, -1)
    spans = sums.groupBy("file", "span").agg(F.sum("n").alias("n"), F.max("last").alias("last")).select(
        "file", "span", F.sum("n").over(across).alias("span_n"), F.max("last").over(across).alias("span_last")
    )
    carried = sums.select(
        "file", "block", "span", F.sum("n").over(inside).alias("own_n"), F.max("last").over(inside).alias("own_last")
    ).join(spans, ["file", "span"]).select(
        "file", "block",
        (F.coalesce("own_n", F.lit(0)) + F.coalesce("span_n", F.lit(0))).alias("first"),
        F.coalesce("own_last", "span_last", F.lit(-1)).alias("before"),
    )
    cut = blocks.join(carried, ["file", "block"]).select("file", "first", "before", "ends", F.posexplode("ends").alias("i", "end"))
    begun = F.when(F.col("i") == 0, F.col("before")).otherwise(F.try_element_at("ends", F.col("i").cast("int"))) + 1
    ended = cut.select(
        "file", (F.col("first") + F.col("i")).alias("ordinal"), begun.alias("start"),
        (F.col("end") - begun).alias("n_tokens"), F.lit(True).alias("ended"),
    )
    totals = sums.groupBy("file").agg(
        F.sum("n").alias("ordinal"), (F.coalesce(F.max("last"), F.lit(-1)) + 1).alias("start"), F.sum("ids").alias("ids")
    )
    open_ended = totals.where("ids > start").select(
        "file", "ordinal", "start", (F.col("ids") - F.col("start")).alias("n_tokens"), F.lit(False).alias("ended")
    )
    return ended.unionByName(open_ended)


def count_tokens(docs: DataFrame, path: str | None = None, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``doc_id``, ``n_tokens`` (without the end id), ``start`` and ``ordinal`` for every row of ``docs``.

    Writes flat files to the shared folder, then counts by the scan alone; the files' order of
    documents gives the doc_ids back.  Repeated rows and null ids are documents each, a null text
    has no tokens, an empty table gives no rows.
    """
    folder = run_folder(docs.sparkSession, "tokens")
    files = write(docs, folder, path=path)
    found = documents(stage(separators(files, block_bytes=block_bytes), "flat-blocks"))
    named = files.select("file", F.posexplode("doc_ids").alias("ordinal", "doc_id"))
    return named.join(found, ["file", "ordinal"]).select("doc_id", "n_tokens", "start", F.col("ordinal").cast("long").alias("ordinal"))


def list_files(spark: SparkSession, folder: str) -> DataFrame:
    """``file`` and ``bytes`` of the flat files under ``folder``; their content is not read."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", "*.tokens").load(folder)
    return found.select(F.col("path").alias("file"), F.col("length").alias("bytes"))
