"""Snapshots of tables in hash buckets, named by a commit log.

A snapshot is a list of buckets, each with the folder that holds it.  A run that touches some buckets
writes those and takes the others over from the snapshot it is based on, so it writes in proportion
to what it touches.  What no commit names is not there: a run that stops before its commit leaves
folders that nothing reads.

Every bucket's rows are counted and hashed while they are written and again as they are read back;
the order-free sums must agree, so a changed cell is found, not only a lost row.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmill.sources.commits import CommitLog, Taken
from starmill.sources.tables import CountMismatch, EmptySource

BUCKET = "bucket"


class Conflict(RuntimeError):
    """Another run changed what this one is based on."""


def content(columns: Iterable[str]) -> list[Column]:
    """Aggregates over rows that do not depend on their order: how many, and sums of their hashes."""
    columns = list(columns)
    # The hash leaves nulls out; where they stand is hashed as well.
    row = F.xxhash64(*columns, F.array(*[F.col(c).isNull() for c in columns]))
    return [
        F.count(F.lit(1)).alias("rows"),
        F.coalesce(F.sum(row.cast("decimal(38,0)")), F.lit(0)).cast("string").alias("sum"),
        F.coalesce(F.bit_xor(row), F.lit(0)).alias("xor"),
    ]


def _total(parts: Iterable[dict]) -> dict:
    total = {"rows": 0, "sum": 0, "xor": 0}
    for part in parts:
        total["rows"] += part["rows"]
        total["sum"] += int(part["sum"])
        total["xor"] ^= part["xor"]
    return total


@dataclass
class Lake:
    """The folder that holds snapshots, commits and the star.

    ``buckets`` counts for the first snapshot of a layer; those based on it keep its number.
    """

    spark: SparkSession
    folder: str
    fmt: str = "parquet"
    buckets: int = 64

    def __post_init__(self):
        self.folder = self.folder.rstrip("/")
        self.log = CommitLog(self.spark, f"{self.folder}/commits")

    # --- what there is ---------------------------------------------------------------------

    def entries(self) -> list[dict]:
        """One entry per layer and run."""
        return self.log.read()[1].get("entries", [])

    def last(self, layer: str, before: int | None = None) -> dict | None:
        """The entry of the newest run (below ``before``), None when there is none."""
        return _newest(self.entries(), layer, before)

    def last_run(self, layer: str, before: int | None = None) -> int | None:
        entry = self.last(layer, before)
        return entry and entry["run"]

    def run_of(self, source: str) -> int:
        """The run that ``source`` wrote before, or the next free number."""
        entries = self.entries()
        own = [e["run"] for e in entries if e["source"] == source]
        return own[0] if own else max((e["run"] for e in entries), default=0) + 1

    def entry(self, layer: str, run: int) -> dict:
        found = _entry(self.entries(), layer, run)
        if found is None:
            raise EmptySource(f"no {layer} of run {run}")
        return found

    def listed(self, entry: dict) -> dict:
        """The schema, the number of buckets, and per bucket its folder, rows and hashes."""
        return json.loads(self.log.text(entry["list"]))

    def read(self, layer: str, run: int, buckets: Iterable[int] | None = None, numbered: bool = False) -> DataFrame:
        """A snapshot, or the named ``buckets`` of it; ``numbered`` adds the bucket's number."""
        return self._frame(self.listed(self.entry(layer, run)), buckets, numbered)

    def _frame(self, listed: dict, buckets: Iterable[int] | None, numbered: bool) -> DataFrame:
        schema = T.StructType.fromJson(listed["schema"])
        wanted = None if buckets is None else set(buckets)
        paths = [f"{part['folder']}/{BUCKET}={number}" for number, part in listed["parts"].items() if wanted is None or int(number) in wanted]
        if not paths:
            rows = self.spark.createDataFrame([], schema)
            return rows.withColumn(BUCKET, F.lit(None).cast("int")) if numbered else rows
        rows = self.spark.read.schema(schema).format(self.fmt).load(paths)
        if not numbered:
            return rows
        number = F.regexp_extract("_metadata.file_path", rf"/{BUCKET}=(\d+)/[^/]*$", 1).cast("int")
        return rows.select("*", number.alias(BUCKET))

    def star_folder(self) -> str:
        return f"{self.folder}/star"

    # --- buckets ---------------------------------------------------------------------------

    def bucket(self, key: Iterable[Column], base: dict | None = None) -> Column:
        """The bucket of a key, counted as in the snapshot ``base``."""
        count = self.listed(base)["buckets"] if base else self.buckets
        return F.pmod(F.xxhash64(*key), F.lit(count)).cast("int")

    def touched(self, rows: DataFrame, bucket: Column) -> list[int]:
        """The buckets that ``rows`` lie in: at most as many numbers as there are buckets."""
        return sorted(r[0] for r in rows.select(bucket).distinct().collect())

    # --- writing ---------------------------------------------------------------------------

    def write(
        self,
        layer: str,
        run: int,
        rows: DataFrame,
        source: str,
        bucket: Column,
        base: dict | None = None,
        touched: Iterable[int] | None = None,
        least: int = 1,
    ) -> dict:
        """Write a snapshot, check it, commit it; returns its entry.

        With a ``base`` snapshot, ``rows`` are all rows of the ``touched`` buckets, the others are
        the base's.  Raises when another source wrote this run, when the base is no longer the
        newest, when fewer than ``least`` rows are there, or when what was written reads back
        differently.
        """
        self._refuse_others(self.entries(), layer, run, source)
        folder = f"{self.folder}/{layer}/{run:08d}-{uuid.uuid4().hex}"
        schema = T.StructType([f for f in rows.schema.fields if f.name != BUCKET])
        count, parts = self.buckets, {}
        if base is not None:
            held, gone = self.listed(base), {str(b) for b in touched}
            count, parts = held["buckets"], {n: p for n, p in held["parts"].items() if n not in gone}
        if base is None or gone:
            parts |= self._write_buckets(folder, rows.withColumn(BUCKET, bucket), schema)
        total = sum(p["rows"] for p in parts.values())
        if total < least:
            raise CountMismatch(f"{layer} run {run}: {total} rows, at least {least} were there")
        name = f"{layer}-{run:08d}-{uuid.uuid4().hex}.list"
        self.log.put(name, json.dumps({"schema": schema.jsonValue(), "buckets": count, "parts": parts}))
        return self._commit({"layer": layer, "run": run, "source": source, "rows": total, "list": name}, base)

    def mark(self, layer: str, run: int, source: str) -> dict:
        """Note that a run has done ``layer``, which holds no snapshot."""
        return self._commit({"layer": layer, "run": run, "source": source, "rows": 0, "list": None}, None)

    def _write_buckets(self, folder: str, rows: DataFrame, schema: T.StructType) -> dict[str, dict]:
        # Rebalancing puts a bucket into one file, or into several when it is large.
        dealt = rows.hint("rebalance", F.col(BUCKET))
        written = Observation()
        # Above the shuffle: the writing tasks count, and a task that ran twice counts once.
        dealt.observe(written, *content(schema.names)).write.partitionBy(BUCKET).format(self.fmt).save(folder)
        stored = self.spark.read.schema(T.StructType([*schema.fields, T.StructField(BUCKET, T.IntegerType())])).format(self.fmt).load(folder)
        found = stored.groupBy(BUCKET).agg(*content(schema.names)).collect()
        parts = {str(r[BUCKET]): {"folder": folder, "rows": r["rows"], "sum": r["sum"], "xor": r["xor"]} for r in found}
        if parts:
            reconcile(_total([written.get]), _total(parts.values()), folder)
        return parts

    def _refuse_others(self, entries: list[dict], layer: str, run: int, source: str) -> None:
        held = _entry(entries, layer, run)
        if held and held["source"] != source:
            raise RuntimeError(f"{layer} run {run} was written by {held['source']}, not by {source}")

    def _commit(self, entry: dict, base: dict | None) -> dict:
        while True:
            number, state = self.log.read()
            entries = state.get("entries", [])
            self._refuse_others(entries, entry["layer"], entry["run"], entry["source"])
            if base is not None and _newest(entries, entry["layer"], entry["run"]) != base:
                raise Conflict(f"{entry['layer']} run {entry['run']}: another run came in between")
            kept = [e for e in entries if (e["layer"], e["run"]) != (entry["layer"], entry["run"])]
            try:
                self.log.commit(number, {"entries": [*kept, entry]})
                return entry
            except Taken:
                continue  # look again at what the other writer did

    def verify(self, layer: str, run: int) -> dict:
        """Rows and hashes of a snapshot as it lies there; raises when they differ from its list."""
        listed = self.listed(self.entry(layer, run))
        rows = self._frame(listed, None, False)
        found = _total([rows.agg(*content(rows.columns)).first().asDict()])
        reconcile(_total(listed["parts"].values()), found, f"{layer} run {run}")
        return found

    def retire(self, before: int) -> list[str]:
        """Forget all runs below ``before`` but the newest of each layer; delete what only they held.

        Returns the deleted folders' buckets.  Readers of retired runs must be done.
        """
        number, state = self.log.read()
        entries = state.get("entries", [])
        layers = {e["layer"] for e in entries}
        kept = [e for e in entries if e["run"] >= before or e == _newest(entries, e["layer"], before)]
        assert {e["layer"] for e in kept} == layers
        self.log.commit(number, {"entries": kept})
        self.log.forget(1)

        def places(some: list[dict]) -> set[str]:
            return {f"{p['folder']}/{BUCKET}={n}" for e in some if e["list"] for n, p in self.listed(e)["parts"].items()}

        gone = sorted(places([e for e in entries if e not in kept]) - places(kept))
        for path in gone:
            where = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
        return gone


def reconcile(expected: dict, found: dict, what: str) -> None:
    if expected != found:
        raise CountMismatch(f"{what}: {expected} was written, {found} reads back")


def _entry(entries: list[dict], layer: str, run: int) -> dict | None:
    return next((e for e in entries if (e["layer"], e["run"]) == (layer, run)), None)


def _newest(entries: list[dict], layer: str, before: int | None) -> dict | None:
    held = [e for e in entries if e["layer"] == layer and (before is None or e["run"] < before)]
    return max(held, key=lambda e: e["run"], default=None)
