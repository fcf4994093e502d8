"""Silver -> star schema, insert-only.

Rows already loaded are never changed: a dimension row keeps what was first seen, a fact row
is written once per job, and a job's set of skills only grows.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import partial
from typing import NamedTuple, TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starmill import rules
from starmill.functions import dates
from starmill.functions import text as T
from starmill.operators import dedup, keys
from starmill.operators.schema import require_columns, upper_names
from starmill.sources.tables import StarStore, stage_counted

T_ = TypeVar("T_")

SCHEMAS = {
    "DIM_COMPANY": "COMPANY_KEY bigint, COMPANY_NAME string",
    "DIM_LOCATION": "LOCATION_KEY bigint, CITY string, LOCATION string",
    "DIM_DATE": "DATE_KEY int, POSTED_DATE date, POSTED_YEAR bigint, POSTED_MONTH bigint, "
    "POSTED_DAY bigint",
    "DIM_JOB": "JOB_KEY bigint, JOB_ID string, JOB_TITLE string, SOURCE string, "
    "EMPLOYMENT_TYPE string, EXPERIENCE_LEVEL string, APPLY_LINK string, DESCRIPTION string, "
    "POSTED_AT timestamp",
    "DIM_SKILL": "SKILL_KEY bigint, SKILL_NAME string",
    "FACT_JOBS": "JOB_KEY bigint, COMPANY_KEY bigint, LOCATION_KEY bigint, DATE_KEY int, "
    "IS_REMOTE boolean, HAS_SALARY boolean",
    "BRIDGE_JOB_SKILL": "JOB_KEY bigint, SKILL_KEY bigint",
}


def job_id(title: Column, company: Column, location: Column, link: Column) -> Column:
    """Sixteen hex digits that stay the same for the same posting, whatever its case."""
    parts = [F.lower(T.strip(T.or_blank(c))) for c in (title, company, location, link)]
    digest = F.substring(F.sha2(F.concat_ws("|", *parts), 256), 1, 16)
    # Never NULL, and said so: otherwise each join on the id hashes again to test for NULL.
    return T.or_blank(digest)


def load_input(silver: DataFrame, order: Sequence[str]) -> DataFrame:
    """Silver in upper-case names with the job id; only what the star needs.

    What this gave comes back as it is: stored, it saves hashing the id for each table that reads it.
    """
    needed = [*[o.upper() for o in order], *rules.GOLD_INPUT_COLUMNS]
    if silver.columns == [*needed, "JOB_ID"]:
        # Read back, a column may hold NULL as far as the optimizer knows.
        return silver.withColumn("JOB_ID", T.or_blank(F.col("JOB_ID")))
    upper = require_columns(upper_names(silver), rules.GOLD_INPUT_COLUMNS, "the cleaned table")
    c = F.col
    return upper.select(
        *needed, job_id(c("JOB_TITLE"), c("COMPANY"), c("LOCATION"), c("APPLY_LINK")).alias("JOB_ID")
    )


# --- natural keys and rows of the dimensions in a batch --------------------------------


def companies(rows: DataFrame) -> DataFrame:
    name = T.strip(F.col("COMPANY"))
    return rows.select(name.alias("COMPANY_NAME")).where(F.col("COMPANY_NAME") != "").distinct()


def locations(rows: DataFrame) -> DataFrame:
    known = ~(F.col("CITY").isNull() & F.col("LOCATION").isNull())
    return rows.select("CITY", "LOCATION").where(known).distinct()


def calendar(rows: DataFrame) -> DataFrame:
    # Year, month and day follow from the date, so any of them may stand for the group;
    # fixed-width aggregates keep this a hash aggregate with map-side combine.
    return (
        rows.dropna(subset=["POSTED_DATE"])
        .groupBy("POSTED_DATE")
        .agg(*[F.min(c).alias(c) for c in ("POSTED_YEAR", "POSTED_MONTH", "POSTED_DAY")])
        .select(
            dates.date_key(F.col("POSTED_DATE")).alias("DATE_KEY"),
            "POSTED_DATE",
            "POSTED_YEAR",
            "POSTED_MONTH",
            "POSTED_DAY",
        )
    )


def jobs(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """The first row of each job id."""
    first = dedup.keep_first(rows, ["JOB_ID"], [o.upper() for o in order])
    return first.select(
        "JOB_ID",
        "JOB_TITLE",
        "SOURCE",
        "EMPLOYMENT_TYPE",
        "EXPERIENCE_LEVEL",
        "APPLY_LINK",
        "DESCRIPTION",
        "POSTED_AT",
    )


def skill_mentions(rows: DataFrame) -> DataFrame:
    """One row per listed skill of each row, repeats kept."""
    return rows.select(
        "JOB_ID", F.explode(T.parse_list(F.col("SKILLS"))).alias("SKILL_NAME")
    )


def skills(rows: DataFrame) -> DataFrame:
    return skill_mentions(rows).select("SKILL_NAME").distinct()


def in_name_order(skill_names: DataFrame) -> DataFrame:
    """Sorted without regard to case."""
    return skill_names.orderBy(F.lower("SKILL_NAME"), "SKILL_NAME")


# --- fact and bridge with natural keys -------------------------------------------------


def fact_rows(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """One row per job, its first, with the natural keys of its dimensions."""
    narrow = rows.select(
        "JOB_ID",
        T.strip(F.col("COMPANY")).alias("COMPANY_NAME"),
        "CITY",
        "LOCATION",
        dates.date_key(F.col("POSTED_DATE")).alias("DATE_KEY"),
        F.coalesce("IS_REMOTE", F.lit(False)).alias("IS_REMOTE"),
        F.coalesce("HAS_SALARY", F.lit(False)).alias("HAS_SALARY"),
        *[o.upper() for o in order],
    )
    first = dedup.keep_first(narrow, ["JOB_ID"], [o.upper() for o in order])
    return first.drop(*[o.upper() for o in order])


# --- one load --------------------------------------------------------------------------

_KNOWN = "__known"


class Counts(NamedTuple):
    """What a load offered to a table, what it inserted, and what it left out for want of a key."""

    offered: int
    inserted: int
    missed: int = 0

    @property
    def existed(self) -> int:
        return self.offered - self.inserted - self.missed


class Loaded(NamedTuple):
    """Counts per table, and the rows left out: table, job, skill, and how often they were offered."""

    counts: dict[str, Counts]
    missed: DataFrame


def _rows() -> Column:
    return F.count(F.lit(1))


def new_keys(
    batch: DataFrame, existing: DataFrame, natural: Sequence[str], null_safe: bool = False
) -> tuple[DataFrame, Counts]:
    """The rows of a batch, unique by ``natural``, that are not loaded yet; stored and counted."""
    known = keys.marked(batch, existing, natural, _KNOWN, null_safe)
    fresh, n = stage_counted(
        known, "new-keys", ~F.col(_KNOWN), offered=_rows(), inserted=F.count_if(~F.col(_KNOWN))
    )
    return fresh.drop(_KNOWN), Counts(**n)


def _load_keyed(
    store: StarStore,
    name: str,
    batch: DataFrame,
    natural: Sequence[str],
    key: str | None,
    null_safe: bool = False,
    completed: Callable[[DataFrame], DataFrame] = lambda numbered: numbered,
) -> Counts:
    """Append the batch's new natural keys, numbered on from the highest key in use.

    ``completed`` adds the other columns.  Without new keys nothing is numbered or written.
    """
    existing = store.read(name)
    fresh, counts = new_keys(batch, existing, natural, null_safe)
    if not counts.inserted:
        return counts
    if key is not None:
        fresh = keys.number_keys(fresh, natural, key, start=keys.highest_key(existing, key))
    return counts._replace(inserted=store.append(name, completed(fresh)))


def offered_jobs(rows: DataFrame, star: dict[str, DataFrame]) -> tuple[DataFrame, dict[str, int]]:
    """The job ids of a batch with their keys, NULL where there is none, and whether a fact exists.

    Stored and counted.  The batch's own ids decide which jobs are looked at, so neither old jobs
    nor old facts are compared with each other.
    """
    offered = rows.groupBy("JOB_ID").agg(_rows().alias("offered"))
    keyed = keys.present(star["DIM_JOB"].select("JOB_ID", "JOB_KEY"), offered, ["JOB_ID"])
    known = keys.marked(offered.join(keyed, "JOB_ID", "left"), star["FACT_JOBS"], ["JOB_KEY"], _KNOWN)
    no_key = F.col("JOB_KEY").isNull()
    return stage_counted(
        known,
        "offered-jobs",
        F.lit(True),
        offered=F.sum("offered"),
        missed=F.sum(F.when(no_key, F.col("offered"))),
        open=F.count_if(~no_key & ~F.col(_KNOWN)),
    )


def new_facts(
    rows: DataFrame, offered: DataFrame, star: dict[str, DataFrame], order: Sequence[str], **sizes
) -> DataFrame:
    """Facts of jobs that have none yet, with the keys of their dimensions.

    Only rows of those jobs are ranked and meet the dimensions.
    """
    open_jobs = offered.where(F.col("JOB_KEY").isNotNull() & ~F.col(_KNOWN)).select("JOB_ID", "JOB_KEY")
    wanted = rows.join(open_jobs.select("JOB_ID"), "JOB_ID", "left_semi")
    fresh = fact_rows(wanted, order).join(open_jobs, "JOB_ID")
    with_company = keys.lookup(
        fresh,
        star["DIM_COMPANY"],
        ["COMPANY_NAME"],
        row_id=["JOB_ID"],
        counted_in=rows.select(T.strip(F.col("COMPANY")).alias("COMPANY_NAME")),
        **sizes,
    )
    with_place = keys.lookup(
        with_company,
        star["DIM_LOCATION"],
        ["CITY", "LOCATION"],
        row_id=["JOB_ID"],
        null_safe=True,
        counted_in=rows.select("CITY", "LOCATION"),
        **sizes,
    )
    return with_place.select(
        "JOB_KEY", "COMPANY_KEY", "LOCATION_KEY", "DATE_KEY", "IS_REMOTE", "HAS_SALARY"
    )


def new_pairs(
    rows: DataFrame, offered: DataFrame, star: dict[str, DataFrame], **sizes
) -> tuple[DataFrame, dict[str, int]]:
    """Pairs of job and skill not linked yet, a key NULL where there is none; stored and counted.

    Repeats go before the lookups.
    """
    mentions = skill_mentions(rows)
    with_skill = keys.lookup(
        mentions.groupBy("JOB_ID", "SKILL_NAME").agg(_rows().alias("offered")),
        star["DIM_SKILL"],
        ["SKILL_NAME"],
        row_id=["JOB_ID"],
        counted_in=mentions.select("SKILL_NAME"),
        **sizes,
    )
    # A job has one row per skill by now: no id is frequent enough to spread.
    with_job = with_skill.join(offered.select("JOB_ID", "JOB_KEY"), "JOB_ID")
    known = keys.marked(with_job, star["BRIDGE_JOB_SKILL"], ["JOB_KEY", "SKILL_KEY"], _KNOWN)
    no_key = _no_key()
    return stage_counted(
        known,
        "new-pairs",
        ~F.col(_KNOWN),
        offered=F.sum("offered"),
        missed=F.sum(F.when(no_key, F.col("offered"))),
        new=F.count_if(~no_key & ~F.col(_KNOWN)),
    )


def _no_key() -> Column:
    return F.col("JOB_KEY").isNull() | F.col("SKILL_KEY").isNull()


def _side_by_side(spark: SparkSession, steps: Sequence[Callable[[], T_]]) -> list[T_]:
    """Run independent writes at the same time, so a long tail of one leaves no idle cores."""
    with ThreadPoolExecutor(len(steps)) as pool:
        running = [pool.submit(inheritable_thread_target(spark)(step)) for step in steps]
    return [step.result() for step in running]


def load_dimensions(rows: DataFrame, store: StarStore, order: Sequence[str]) -> dict[str, Counts]:
    """Append what is new to the dimensions."""

    def described(ids: DataFrame) -> DataFrame:
        # Numbering runs on the ids alone, and only rows of new ids are ranked and shuffled.
        fresh = rows.join(ids.select("JOB_ID"), "JOB_ID", "left_semi")
        return jobs(fresh, order).join(ids, "JOB_ID")

    steps = {
        "DIM_JOB": lambda name: _load_keyed(
            store, name, rows.select("JOB_ID").distinct(), ["JOB_ID"], "JOB_KEY", completed=described
        ),
        "DIM_COMPANY": lambda name: _load_keyed(store, name, companies(rows), ["COMPANY_NAME"], "COMPANY_KEY"),
        "DIM_LOCATION": lambda name: _load_keyed(
            store, name, locations(rows), ["CITY", "LOCATION"], "LOCATION_KEY", null_safe=True
        ),
        "DIM_SKILL": lambda name: _load_keyed(store, name, skills(rows), ["SKILL_NAME"], "SKILL_KEY"),
        "DIM_DATE": lambda name: _load_keyed(store, name, calendar(rows), ["DATE_KEY"], None),
    }
    done = _side_by_side(store.spark, [partial(step, name) for name, step in steps.items()])
    return dict(zip(steps, done))


def load_facts(rows: DataFrame, store: StarStore, order: Sequence[str], **sizes) -> Loaded:
    """Append facts and links of which job and skill have a key; the others are counted and kept apart."""
    star = store.tables()
    offered, of_jobs = offered_jobs(rows, star)

    def facts() -> int:
        return store.append("FACT_JOBS", new_facts(rows, offered, star, order, **sizes)) if of_jobs["open"] else 0

    def links() -> tuple[DataFrame, dict[str, int], int]:
        pairs, n = new_pairs(rows, offered, star, **sizes)
        return pairs, n, store.append("BRIDGE_JOB_SKILL", pairs.where(~_no_key())) if n["new"] else 0

    new, (pairs, of_pairs, linked) = _side_by_side(store.spark, [facts, links])
    counts = {
        "FACT_JOBS": Counts(of_jobs["offered"], new, of_jobs["missed"]),
        "BRIDGE_JOB_SKILL": Counts(of_pairs["offered"], linked, of_pairs["missed"]),
    }
    left_out = ["JOB_ID", "SKILL_NAME", "offered"]
    jobs_missed = offered.where("JOB_KEY IS NULL").withColumn("SKILL_NAME", F.lit(None).cast("string"))
    missed = jobs_missed.select(F.lit("FACT_JOBS").alias("table_name"), *left_out).unionByName(
        pairs.where(_no_key()).select(F.lit("BRIDGE_JOB_SKILL").alias("table_name"), *left_out)
    )
    return Loaded(counts, missed)


def load(silver: DataFrame, store: StarStore, order: Sequence[str], **sizes) -> Loaded:
    """Append what is new: the dimensions first, then facts and links.

    Each table is written by one job that either appends all its rows or none, and a rerun
    after a failure inserts just what is missing; a table without new rows is not written.
    ``silver`` should be a stored table: every table of the star reads the columns it needs from it.
    """
    rows = load_input(silver, order)
    dimensions = load_dimensions(rows, store, order)
    facts = load_facts(rows, store, order, **sizes)
    return facts._replace(counts={**dimensions, **facts.counts})


def summary(spark: SparkSession, counts: dict[str, Counts]) -> DataFrame:
    """Per table of the star how many of the offered rows were inserted, had existed, and were missed."""
    return spark.createDataFrame(
        [(name, counts[name].inserted, counts[name].existed, counts[name].missed) for name in SCHEMAS if name in counts],
        "table_name string, inserted bigint, existed bigint, missed bigint",
    )


def load_with_summary(silver: DataFrame, store: StarStore, order: Sequence[str], **sizes) -> DataFrame:
    """:func:`load`, and the counts its writes took."""
    return summary(store.spark, load(silver, store, order, **sizes).counts)
