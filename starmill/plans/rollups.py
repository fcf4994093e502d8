"""Counts per dimension key, kept up by the facts that loads add.

The star only grows by whole files, so what a rollup has counted is a list of files.  A refresh
reads the files that are not on it, writes their counts as one more part, and commits parts and list
as one state: a file counts once however often a refresh is repeated, a crash before the
commit leaves a part that nothing reads, and of two writers one wins.  Counts add up, so a read sums
the parts; from ``fold`` parts on, a refresh writes the sums as the only part.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmill.plans.gold import _side_by_side
from starmill.sources.commits import CommitLog
from starmill.sources.tables import StarStore

_MEASURES = ["postings", "remote"]
_COUNTED = ["FACT_JOBS", "BRIDGE_JOB_SKILL"]
KEYS = {
    "BY_DATE": "DATE_KEY int",
    "BY_COMPANY": "COMPANY_KEY bigint",
    "BY_LOCATION": "LOCATION_KEY bigint",
    "BY_SKILL": "SKILL_KEY bigint",
    "BY_LEVEL": "EXPERIENCE_LEVEL string, EMPLOYMENT_TYPE string",
}


def _names(rollup: str) -> list[str]:
    return [field.split()[0] for field in KEYS[rollup].split(", ")]


def _levels(facts: DataFrame, jobs: DataFrame) -> DataFrame:
    """Facts with level and employment; new jobs have the highest keys, so the bounds prune files."""
    low, high = facts.agg(F.min("JOB_KEY"), F.max("JOB_KEY")).first()
    described = jobs.where(F.col("JOB_KEY").between(F.lit(low), F.lit(high)))
    return facts.select("JOB_KEY", "IS_REMOTE").join(described.select("JOB_KEY", *_names("BY_LEVEL")), "JOB_KEY")


class Rollups:
    """Rollups of the star in ``store``, kept in a folder beside its tables."""

    def __init__(self, store: StarStore, fold: int = 16):
        self.store = store
        self.spark = store.spark
        self.folder = f"{store.folder}/_ROLLUPS"
        self.fold = fold
        self.log = CommitLog(self.spark, f"{self.folder}/log")

    def _counts(self, rollup: str, new: dict[str, DataFrame], jobs: DataFrame) -> DataFrame:
        if rollup == "BY_SKILL":
            rows = new["BRIDGE_JOB_SKILL"].withColumn("IS_REMOTE", F.lit(None).cast("boolean"))
        elif rollup == "BY_LEVEL":
            rows = _levels(new["FACT_JOBS"], jobs)
        else:
            rows = new["FACT_JOBS"].dropna(subset=_names(rollup))
        return rows.groupBy(*_names(rollup)).agg(
            F.count(F.lit(1)).alias("postings"), F.count_if("IS_REMOTE").alias("remote")
        )

    def _read(self, rollup: str, parts: list[str]) -> DataFrame:
        schema = f"{KEYS[rollup]}, postings bigint, remote bigint"
        if not parts:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[f"{self.folder}/{part}/{rollup}" for part in parts])

    def refresh(self) -> int:
        """Count the facts and links of files not counted yet; returns the number of the state.

        Raises when a counted file is gone: then the star was rewritten, and the counts with
        it have to be begun anew.
        """
        number, state = self.log.read()
        parts, counted = state.get("parts", []), state.get("counted", {})
        files = {name: self.store.read(name).inputFiles() for name in _COUNTED}
        for name in _COUNTED:
            if not set(counted.get(name, [])) <= set(files[name]):
                raise RuntimeError(f"files of {name} that were counted are gone")
        fresh = {name: sorted(set(files[name]) - set(counted.get(name, []))) for name in _COUNTED}
        if not any(fresh.values()):
            return number
        new = {
            name: self.spark.read.schema(self.store.schemas[name]).parquet(*paths)
            if paths
            else self.spark.createDataFrame([], self.store.schemas[name])
            for name, paths in fresh.items()
        }
        jobs, part = self.store.read("DIM_JOB"), f"{number + 1:012d}-{uuid.uuid4().hex}"
        folds = len(parts) + 1 >= self.fold

        def write(rollup: str) -> Callable[[], None]:
            def run() -> None:
                counts = self._counts(rollup, new, jobs)
                if folds:
                    counts = self._summed(rollup, counts.unionByName(self._read(rollup, parts)))
                counts.write.parquet(f"{self.folder}/{part}/{rollup}")

            return run

        _side_by_side(self.spark, [write(rollup) for rollup in KEYS])
        state = {"parts": [part] if folds else [*parts, part], "counted": {n: sorted(files[n]) for n in _COUNTED}}
        return self.log.commit(number, state)

    @staticmethod
    def _summed(rollup: str, rows: DataFrame) -> DataFrame:
        return rows.groupBy(*_names(rollup)).agg(*[F.sum(m).alias(m) for m in _MEASURES])

    def read(self, rollup: str) -> DataFrame:
        """One row per key, with ``postings`` and ``remote`` of all facts counted so far."""
        return self._summed(rollup, self._read(rollup, self.log.read()[1].get("parts", [])))

    # --- the reads over the star, from its rollups ---------------------------------------

    def postings_per_month(self) -> DataFrame:
        dated = self.read("BY_DATE").join(self.store.read("DIM_DATE"), "DATE_KEY")
        return dated.groupBy("POSTED_YEAR", "POSTED_MONTH").agg(F.sum("postings").alias("postings"))

    def postings_per_company(self) -> DataFrame:
        named = self.read("BY_COMPANY").join(self.store.read("DIM_COMPANY"), "COMPANY_KEY")
        return named.select("COMPANY_NAME", "postings")

    def postings_per_city(self) -> DataFrame:
        placed = self.read("BY_LOCATION").join(self.store.read("DIM_LOCATION"), "LOCATION_KEY")
        return placed.groupBy("CITY").agg(
            F.sum("postings").alias("postings"), F.sum("remote").alias("remote_postings")
        )

    def postings_per_skill(self) -> DataFrame:
        named = self.read("BY_SKILL").join(self.store.read("DIM_SKILL"), "SKILL_KEY")
        return named.select("SKILL_NAME", "postings")

    def levels_by_employment(self) -> DataFrame:
        return self.read("BY_LEVEL").select("EXPERIENCE_LEVEL", "EMPLOYMENT_TYPE", "postings")
