"""Times the headline work at one scale and prints one JSON line.

Each entry runs to the end with all its columns: builds and loads are written, reads are sent
to a sink that takes every row.  The star is loaded before the reads over it, and its load is
an entry of its own.  Everything runs twice, from the source files each time: ``queries`` and
``value`` are of the second pass, ``first_pass`` is of a session that compiles as it goes.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from starmill import fixtures, local_session  # noqa: E402
from starmill.plans import analytics, gold, silver  # noqa: E402
from starmill.queries import QUERIES  # noqa: E402
from starmill.sources import tables  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")

READS = [
    "extract_skills_documents",
    "html_text_pages",
    "normalize_payload",
    "bronze_build",
    "history_merge",
    "history_merge_incremental",
    "skill_counts",
]


def drain(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def one_pass(spark) -> dict[str, float]:
    times: dict[str, float] = {}

    def timed(name, work):
        start = time.perf_counter()
        result = work()
        times[name] = round(time.perf_counter() - start, 3)
        return result

    for name in READS:
        timed(name, lambda name=name: drain(QUERIES[name](spark, SF_DIR)))

    raw = fixtures.raw_jobs(spark, SF_DIR).drop("o_orderdate")
    order = fixtures.ORDER
    cleaned = timed(
        "silver_build", lambda: tables.stage(silver.silver(raw, order, keep=order), "silver")
    )
    store = tables.StarStore(spark, tables.run_folder(spark, "star"), gold.SCHEMAS)
    timed("gold_load", lambda: gold.load(cleaned, store, order))
    timed("gold_second_load", lambda: gold.load(cleaned, store, order))

    star = store.tables()
    for name, read in [
        ("q1_postings_per_month", analytics.postings_per_month),
        ("q2_top_companies", analytics.top_companies),
        ("q3_postings_per_city", analytics.postings_per_city),
        ("q4_top_skills", analytics.top_skills),
        ("q5_levels_by_employment", analytics.levels_by_employment),
    ]:
        timed(name, lambda read=read: drain(read(star)))
    return times


def main() -> None:
    spark = local_session(CPUS, memory=os.environ.get("BENCH_MEMORY", "16g"), app="bench")
    # The first job pays for starting the session's threads, not for the work.
    drain(fixtures.read(spark, SF_DIR, "region"))
    first = one_pass(spark)
    second = one_pass(spark)
    print(
        json.dumps(
            {
                "metric": "total_time",
                "value": round(sum(second.values()), 3),
                "unit": "sec",
                "queries": second,
                "sf": os.path.basename(SF_DIR.rstrip("/")),
                "cpus": CPUS,
                "first_pass": first,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
