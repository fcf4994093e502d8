"""Pick up new landing files and run the three hops on each group of them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from starmill.plans.run import Lake, run
from starmill.sources.landing import stream_payloads


def follow(
    lake: Lake,
    landing: str,
    progress: str,
    fetched_at: str | None = None,
    files_per_run: int = 1000,
    most_rejects: int | None = None,
) -> StreamingQuery:
    """Process every file not seen before, then stop.

    ``progress`` is the folder of the stream's own record of files.  A group of files gets the
    lake's next free run number; a group repeated after a failure finds the run it began and
    replaces that alone.  Without ``fetched_at`` postings were fetched when their file landed.
    A file that is no payload stops the stream; with ``most_rejects`` a group may hold so many,
    which go to the lake's rejects.
    """
    reject = most_rejects is not None

    def one_run(payloads: DataFrame, group: int) -> None:
        source = f"stream {progress} group {group}"
        run(lake, payloads, lake.run_of(source), fetched_at, source, most_rejects=most_rejects or 0)

    return (
        stream_payloads(lake.spark, landing, files_per_run, reject)
        .writeStream.foreachBatch(one_run)
        .option("checkpointLocation", progress)
        .trigger(availableNow=True)
        .start()
    )
