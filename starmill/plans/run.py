"""One run: landing payload -> history -> cleaned table -> star, with a gate after each hop.

A run works on what its postings touch.  The history lies in buckets by identity, the cleaned table
in buckets by posting key; a run reads and writes the buckets its postings fall in, takes the others
over, stores which cleaned rows left and came, and offers only those that came to the star.  Each
layer is committed when its snapshot has been checked.  A run repeated by the same source replaces
its own snapshots and adds nothing twice to the star.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmill import rules
from starmill.operators import dedup, keys
from starmill.plans import bronze, gold, silver
from starmill.session import configure
from starmill.sources.lake import BUCKET, Lake
from starmill.sources.landing import CORRUPT, postings, split_rejects
from starmill.sources.tables import EmptySource, StarStore, require_count, stage

# Run numbers of backfilled rows are lower by this much, so they lie below all runs.
BACKFILLS = 1 << 40


def star(lake: Lake) -> StarStore:
    return StarStore(lake.spark, lake.star_folder(), gold.SCHEMAS, lake.fmt)


def _identity() -> list:
    return list(dedup.history_identity().values())


def _posting_key() -> list:
    return [F.col(c) for c in rules.POSTING_KEY]


def merge_history(lake: Lake, newer: DataFrame, run: int, source: str, order: list[str] = bronze.FILE_ORDER) -> DataFrame:
    """Commit the history with ``newer`` merged in; returns the rows of before that it replaced.

    ``newer`` is unique by identity, later than the history, and stored.  Only the buckets that
    its identities fall in are read and written.
    """
    last = lake.last("bronze", before=run)
    bucket = lake.bucket(_identity(), last)
    if last is None:
        lake.write("bronze", run, newer, source, bucket)
        return newer.limit(0)
    touched = lake.touched(newer, bucket)
    old = lake.read("bronze", last["run"], touched)
    merged = bronze.merge(old, newer, order, history_is_unique=True, newer_is_unique=True)
    # A merge replaces postings and adds some; it never loses one.
    lake.write("bronze", run, merged, source, bucket, last, touched, least=last["rows"])
    named = {f"__k_{name}": column for name, column in dedup.history_identity().items()}
    identities = newer.select(*[column.alias(name) for name, column in named.items()])
    return keys.present(old.withColumns(named), identities, list(named), null_safe=True).drop(*named)


def update_history(
    lake: Lake, payloads: DataFrame, run: int, fetched_at: str | None, source: str
) -> tuple[DataFrame, DataFrame] | None:
    """The run's postings and the rows they replaced; None, and no change, for a run without postings.

    Without ``fetched_at`` each file's postings were fetched when the file landed.
    """
    rows = postings(payloads).withColumn("ingest_run", F.lit(run).cast("bigint"))
    if rows.isEmpty():
        if lake.last("bronze", before=run) is None:
            raise EmptySource("no postings landed and there is no history")
        return None
    fetched = F.lit(fetched_at) if fetched_at else F.col("landed_at")
    batch = bronze.batch(rows, fetched, bronze.FILE_ORDER, within=["ingest_file"])
    unique = dedup.keep_last(batch, dedup.history_identity(), bronze.FILE_ORDER)
    newer = stage(bronze.with_row_order(unique), "batch")
    return newer, merge_history(lake, newer, run, source)


def _clean_everything(lake: Lake, run: int, source: str) -> None:
    order = bronze.ROW_ORDER
    history = lake.read("bronze", lake.last_run("bronze", before=run + 1))
    numbered = history.withColumn(BUCKET, lake.bucket(_posting_key()))
    lake.write("silver", run, silver.silver(numbered, order, keep=[*order, BUCKET]), source, F.col(BUCKET))


def update_cleaned(lake: Lake, landed: tuple[DataFrame, DataFrame] | None, run: int, source: str, rebuild: bool = False) -> DataFrame | None:
    """Commit the cleaned table of the newest history; returns the stored changes, where they were made.

    Where the run before it has both snapshots, only postings whose first row changed are cleaned,
    and only their buckets written.  ``rebuild`` cleans everything.
    """
    order = bronze.ROW_ORDER
    before, cleaned = lake.last("bronze", before=run), lake.last("silver", before=run)
    if rebuild or before is None or cleaned is None or before["run"] != cleaned["run"]:
        _clean_everything(lake, run, source)
        return None
    if landed is None:
        return None
    newer, went = landed
    firsts = stage(
        silver.changed_firsts(
            lake.read("bronze", before["run"], numbered=True), lake.read("bronze", run, numbered=True), newer, went, order, [BUCKET]
        ),
        "firsts",
    )
    bucket = lake.bucket(_posting_key(), cleaned)
    touched = lake.touched(firsts, bucket)
    held = lake.touched(firsts.where("new IS NOT NULL"), F.col(f"new.{BUCKET}"))
    old = lake.read("silver", cleaned["run"], touched, numbered=True)
    after = lake.read("bronze", run, held).withColumn(BUCKET, bucket)
    feed = silver.changes(old, after, firsts, order, keep=[BUCKET])
    lake.write("changes", run, feed, source, F.col(BUCKET), least=0)
    stored = lake.read("changes", run, numbered=True)
    newest = silver.apply_changes(old, stored, order)
    lake.write("silver", run, newest, source, F.col(BUCKET), cleaned, touched, least=0)
    return stored.drop(BUCKET)


def run(
    lake: Lake,
    payloads: DataFrame,
    run: int,
    fetched_at: str | None = None,
    source: str | None = None,
    rebuild: bool = False,
    most_rejects: int = 0,
) -> DataFrame:
    """All three hops; returns what was inserted and what existed, per table of the star.

    ``source`` names who runs; only the same source may repeat a run.  ``rebuild`` cleans the
    whole history again, as after a change of the rules.  The star is offered the rows that came;
    where its last load is not the run before this one, it is offered the whole cleaned table.

    Of payloads read with ``reject``, files that are none go to the layer "rejects"; more than
    ``most_rejects`` of them stop the run before anything is written.
    """
    configure(lake.spark)
    source = source or f"run {run}"
    if CORRUPT in payloads.columns:
        payloads, rejects = split_rejects(stage(payloads, "payloads"), most_rejects)
        if not rejects.isEmpty():
            lake.write("rejects", run, rejects, source, lake.bucket([F.col("ingest_file")]))
    landed = update_history(lake, payloads, run, fetched_at, source)
    cleaned, loaded = lake.last_run("silver", before=run), lake.last_run("star", before=run)
    feed = update_cleaned(lake, landed, run, source, rebuild)
    newest = lake.last_run("silver", before=run + 1)
    if feed is not None and loaded is not None and loaded >= cleaned:
        offered = feed.where("sign = 1").drop("sign", "change")
    elif loaded is not None and loaded >= newest:
        offered = lake.read("silver", newest, buckets=[])
    else:
        offered = lake.read("silver", newest)
    summary = gold.load_with_summary(offered, star(lake), bronze.ROW_ORDER)
    lake.mark("star", run, source)
    return summary


def backfill(lake: Lake, historical: DataFrame, run: int, row_number: str = "id") -> DataFrame:
    """Put a historical table under the newest history, and check the rows written.

    ``row_number`` names the column that gives the historical table its row order.
    """
    configure(lake.spark)
    last = lake.last_run("bronze", before=run)
    # Each backfill lies below all runs, and a later one above an earlier one.
    older = historical.withColumns(
        {
            "ingest_run": F.lit(run - BACKFILLS).cast("bigint"),
            "ingest_file": F.lit(""),
            "ingest_pos": F.col(row_number).cast("bigint"),
        }
    )
    existing = None if last is None else lake.read("bronze", last)
    merged = bronze.with_row_order(bronze.backfill(older, existing))
    lake.write("bronze", run, merged, f"backfill {run}", lake.bucket(_identity()))
    stored = lake.read("bronze", run)

    # Counted from the inputs, not from the write: a task that ran twice counts once here.
    inputs = older.select(*rules.BRONZE_COLUMNS)
    if existing is not None:
        inputs = inputs.unionByName(existing.select(*rules.BRONZE_COLUMNS))
    identity = dedup.history_identity()
    named = inputs.select(*[column.alias(name) for name, column in identity.items()])
    expected = dedup.count_duplicates(named, list(identity)).first()["distinct_keys"]
    return require_count(stored, expected, "the backfilled history")
