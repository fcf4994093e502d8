"""The registered queries: name -> function of (session, folder of the tables)."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmill import fixtures, rules
from starmill.fixtures import ORDER
from starmill.functions import classify, dates, dictionary
from starmill.functions import text as T
from starmill.operators import dedup, keys, quality
from starmill.operators.schema import align, describe, upper_names
from starmill.plans import analytics, bronze, gold, rollups, silver
from starmill.plans import run as runs
from starmill.session import configure
from starmill.sources import arrays, landing, tables
from starmill.sources.lake import Lake, content

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

RUN_ORDER = ["ingest_run", "ingest_seq"]
SHOWN = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def query(build: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return build(configure(spark), sf_dir.rstrip("/"))

    run.__name__, run.__doc__ = build.__name__, build.__doc__
    QUERIES[build.__name__] = run
    return build


def _shown(df: DataFrame) -> DataFrame:
    """Timestamps and dates as text, so results compare the same in every client."""
    formats = {"timestamp": SHOWN, "date": "yyyy-MM-dd"}
    return df.select(
        *[
            F.date_format(c, formats[t]).alias(c) if t in formats else F.col(c)
            for c, t in df.dtypes
        ]
    )


def _raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixtures.raw_jobs(spark, sf_dir).drop("o_orderdate")


def _silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.silver(_raw(spark, sf_dir), ORDER, keep=ORDER)


_STORED: dict[tuple[str, ...], DataFrame | tables.StarStore] = {}


def _place(spark: SparkSession, sf_dir: str, what: str) -> tuple[str, ...]:
    return (spark.sparkContext.applicationId, tables.shared_folder(spark), sf_dir, what)


def _silver_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cleaned postings as a written table, which is what the star and the reports read.

    Written once per application and folder, like the stage it is.  A filter on a derived
    column then reaches the scan instead of repeating the derivation.
    """
    place = _place(spark, sf_dir, "silver")
    if place not in _STORED:
        _STORED[place] = tables.stage(_silver(spark, sf_dir), "silver")
    return _STORED[place]


def _before_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cleaned rows up to, but not including, the text-derived attributes."""
    return (
        silver.drop_repeats(_raw(spark, sf_dir), ORDER)
        .transform(silver.tokens_to_null, but=ORDER)
        .transform(silver.squeeze_text)
        .transform(silver.standard_values)
        .transform(silver.plain_description)
    )


# --- landing and history ---------------------------------------------------------------


@query
def normalize_payload(spark, sf_dir):
    rows = landing.postings(fixtures.landing(spark, sf_dir))
    return bronze.normalise(rows, fixtures.FETCHED_AT, ORDER)


@query
def extract_skills_documents(spark, sf_dir):
    docs = tables.spread(fixtures.read(spark, sf_dir, "documents").select("doc_id", "text"))
    return docs.select("doc_id", T.terms_text(F.col("text"), rules.SKILL_TERMS).alias("skills"))


@query
def extract_skills_automaton(spark, sf_dir):
    docs = tables.spread(fixtures.read(spark, sf_dir, "documents").select("doc_id", "text"))
    return docs.select("doc_id", dictionary.terms_text(spark, F.col("text"), rules.SKILL_TERMS).alias("skills"))


@query
def extract_skills_postings(spark, sf_dir):
    text = F.concat_ws(" ", "job_title", "description")
    return _raw(spark, sf_dir).select(
        "ingest_seq",
        T.terms_text(text, rules.SKILL_TERMS).alias("skills"),
        T.terms_text(text, rules.SKILL_TERMS, strict=False).alias("skills_loose_edges"),
    )


@query
def array_file_split(spark, sf_dir):
    """Postings written as JSON arrays, one a file, and read back by several tasks a file."""
    columns = ["ingest_seq", "job_title", "skills", "description", "location"]
    folder = tables.run_folder(spark, "arrays")
    fixtures.write_arrays(_raw(spark, sf_dir).select(*columns), folder)
    schema = "ingest_seq bigint, job_title string, skills string, description string, location string"
    return arrays.read_array(spark, folder, schema, split_bytes=1 << 16)


@query
def batch_dedup(spark, sf_dir):
    rows = landing.postings(fixtures.landing(spark, sf_dir))
    return bronze.batch(rows, fixtures.FETCHED_AT, ORDER)


_MERGED = ["ingest_run", "ingest_seq", *rules.BRONZE_COLUMNS]


@query
def history_merge(spark, sf_dir):
    history, newer = fixtures.history_and_batch(spark, sf_dir)
    return bronze.merge(history, newer, RUN_ORDER).select(*_MERGED)


@query
def history_merge_incremental(spark, sf_dir):
    """The same result when the history is itself merged: it is filtered, not re-ranked."""
    history, newer = fixtures.history_and_batch(spark, sf_dir)
    merged = dedup.keep_last(history, dedup.history_identity(), RUN_ORDER)
    return bronze.merge(merged, newer, RUN_ORDER, history_is_unique=True).select(*_MERGED)


def _two_runs(spark: SparkSession, sf_dir: str) -> Lake:
    """A lake whose second run merged the newer postings into the buckets they touch."""
    lake = Lake(spark, tables.run_folder(spark, "lake"), buckets=16)
    for number, rows in enumerate(fixtures.history_and_batch(spark, sf_dir), 1):
        unique = dedup.keep_last(rows, dedup.history_identity(), RUN_ORDER)
        runs.merge_history(lake, tables.stage(unique, "batch"), number, "query", RUN_ORDER)
    return lake


@query
def history_buckets(spark, sf_dir):
    """The merged history read back from its buckets, those of both runs."""
    return _two_runs(spark, sf_dir).read("bronze", 2).select(*_MERGED)


@query
def reconciliation(spark, sf_dir):
    """Rows and hashes of each run's history: as written, and as they lie there."""
    lake = _two_runs(spark, sf_dir)
    parts = None
    for number in (1, 2):
        parts_written = lake.listed(lake.entry("bronze", number))["parts"].values()
        rows = lake.read("bronze", number)
        hashes = F.lit(str(sum(int(p["sum"]) for p in parts_written)))
        part = rows.agg(*content(rows.columns)).select(
            F.lit(number).cast("bigint").alias("run"),
            F.lit(sum(p["rows"] for p in parts_written)).cast("bigint").alias("written"),
            F.col("rows").alias("read_back"),
            (F.col("sum") == hashes).alias("same_content"),
        )
        parts = part if parts is None else parts.unionByName(part)
    return parts


@query
def landing_rejects(spark, sf_dir):
    """Landing files of up to 500 postings, some of them torn: what is read of each, and what is not."""
    flat = fixtures.landing(spark, sf_dir)
    each = flat.select((F.col("ingest_seq") / 500).cast("bigint").alias("file"), F.explode("data.jobs").alias("job"))
    whole = each.groupBy("file").agg(F.to_json(F.struct(F.struct(F.collect_list("job").alias("jobs")).alias("data"))).alias("value"))
    torn = F.when(F.col("file") % 3 == 1, F.expr("substr(value, 1, length(value) - 9)")).otherwise(F.col("value"))
    folder = tables.run_folder(spark, "landing")
    whole.select("file", torn.alias("value")).write.partitionBy("file").text(folder)
    payloads = landing.read_payloads(spark, f"{folder}/*/*.txt", reject=True)
    read, rejects = landing.split_rejects(tables.stage(payloads, "payloads"))
    number = F.regexp_extract("ingest_file", r"/file=(\d+)/", 1).cast("bigint").alias("file")
    found = landing.postings(read).groupBy(number).agg(F.count(F.lit(1)).alias("postings"))
    return found.withColumn("rejected", F.lit(False)).unionByName(
        rejects.select(number, F.lit(0).cast("bigint").alias("postings"), F.lit(True).alias("rejected"))
    )


@query
def history_backfill(spark, sf_dir):
    historical, existing = fixtures.history_and_batch(spark, sf_dir)
    with_id = historical.withColumn("id", F.col("ingest_seq") + 1)
    return bronze.backfill(with_id, existing.drop("salary"), RUN_ORDER).select(*_MERGED)


@query
def bronze_build(spark, sf_dir):
    """Landing payload through to the merged history, over the raw postings as history."""
    history = _raw(spark, sf_dir).withColumn("ingest_run", F.lit(1).cast("bigint"))
    rows = landing.postings(fixtures.landing(spark, sf_dir))
    newer = bronze.batch(rows, fixtures.FETCHED_AT, ORDER).withColumn(
        "ingest_run", F.lit(2).cast("bigint")
    )
    return bronze.merge(history, newer, RUN_ORDER).select(*_MERGED)


@query
def merge_summary(spark, sf_dir):
    """Rows collected, removed as duplicates, saved: for the batch and for the history."""
    rows = bronze.normalise(
        landing.postings(fixtures.landing(spark, sf_dir)), fixtures.FETCHED_AT, ORDER
    )
    history, newer = fixtures.history_and_batch(spark, sf_dir)
    both = history.unionByName(newer)
    parts = []
    for name, df, key in [
        ("batch", rows, dedup.batch_identity()),
        ("history", both, dedup.history_identity()),
    ]:
        named = df.select(*[c.alias(f"k{i}") for i, c in enumerate(key.values())])
        parts.append(
            dedup.count_duplicates(named, named.columns).select(
                F.lit(name).alias("step"),
                F.col("rows").alias("collected"),
                F.col("duplicates").alias("removed"),
                F.col("distinct_keys").alias("saved"),
            )
        )
    return parts[0].unionByName(parts[1])


@query
def align_columns(spark, sf_dir):
    history, newer = fixtures.history_and_batch(spark, sf_dir)
    columns = ["ingest_seq", *rules.BRONZE_COLUMNS]
    reduced = align(newer.drop("salary", "skills"), columns).withColumn(
        "ingest_seq", F.col("ingest_seq").cast("bigint")
    )
    return upper_names(history.select(*columns).unionByName(reduced))


# --- cleaning --------------------------------------------------------------------------


@query
def silver_dedup(spark, sf_dir):
    return silver.drop_repeats(_raw(spark, sf_dir), ORDER)


@query
def null_tokens(spark, sf_dir):
    return silver.tokens_to_null(_raw(spark, sf_dir))


@query
def clean_text(spark, sf_dir):
    cleaned = silver.squeeze_text(silver.tokens_to_null(_raw(spark, sf_dir)))
    return cleaned.select("ingest_seq", *rules.TEXT_COLUMNS)


@query
def employment_type(spark, sf_dir):
    cleaned = silver.squeeze_text(silver.tokens_to_null(_raw(spark, sf_dir)))
    return cleaned.select(
        "ingest_seq",
        T.map_lowered(F.col("employment_type"), rules.EMPLOYMENT_TYPES).alias("employment_type"),
    )


@query
def company_case(spark, sf_dir):
    cleaned = silver.squeeze_text(silver.tokens_to_null(_raw(spark, sf_dir)))
    return cleaned.select("ingest_seq", T.title_if_lower(F.col("company")).alias("company"))


@query
def skill_list(spark, sf_dir):
    cleaned = silver.squeeze_text(silver.tokens_to_null(_raw(spark, sf_dir)))
    return cleaned.select(
        "ingest_seq",
        T.clean_list(F.col("skills")).alias("skills"),
        F.size(T.parse_list(F.col("skills"))).alias("listed"),
    )


@query
def html_text_pages(spark, sf_dir):
    pages = tables.spread(fixtures.read(spark, sf_dir, "pages"))
    return T.with_plain_text(pages, "html", "page_text").drop("html")


@query
def html_text_postings(spark, sf_dir):
    rows = silver.plain_description(silver.tokens_to_null(_raw(spark, sf_dir)))
    return rows.select("ingest_seq", "description")


@query
def posted_at(spark, sf_dir):
    rows = silver.times(silver.tokens_to_null(_raw(spark, sf_dir)))
    return _shown(rows.select("ingest_seq", "fetched_at", "posted_at"))


@query
def posted_at_spellings(spark, sf_dir):
    """Absolute times read back from every spelling."""
    rows = fixtures.spelled_times(spark, sf_dir)
    read = dates.with_posted_time(rows, "spelled", "fetched_at", "posted_at")
    return _shown(read.select("o_orderkey", "posted_at"))


@query
def date_parts(spark, sf_dir):
    rows = silver.date_parts(silver.times(silver.tokens_to_null(_raw(spark, sf_dir))))
    return _shown(
        rows.select(
            "ingest_seq",
            "posted_date",
            "posted_year",
            "posted_month",
            "posted_day",
            dates.date_key(F.col("posted_date")).alias("date_key"),
        )
    )


@query
def date_parts_events(spark, sf_dir):
    at = F.col("ts").cast("timestamp")
    return _shown(
        fixtures.read(spark, sf_dir, "events").select(
            "event_id",
            F.to_date(at).alias("event_date"),
            F.year(at).cast("bigint").alias("event_year"),
            F.month(at).cast("bigint").alias("event_month"),
            F.dayofmonth(at).cast("bigint").alias("event_day"),
            dates.date_key(F.to_date(at)).alias("date_key"),
        )
    )


@query
def experience_level(spark, sf_dir):
    rows = silver.levels(_before_flags(spark, sf_dir))
    return rows.select("ingest_seq", "job_title", "experience_level")


@query
def experience_years_documents(spark, sf_dir):
    """Years of experience and the level they mean, over whole documents."""
    docs = tables.spread(fixtures.read(spark, sf_dir, "documents").select("doc_id", "text"))
    years = docs.select("doc_id", classify.years_asked(F.col("text")).alias("years"))
    return years.select(
        "doc_id",
        F.col("years").try_cast("bigint").alias("years"),
        classify.level_from_years(F.col("years")).alias("experience_level"),
    )


@query
def city_recovery(spark, sf_dir):
    rows = silver.cities(_before_flags(spark, sf_dir))
    return rows.select("ingest_seq", "location", "city")


@query
def flags(spark, sf_dir):
    rows = silver.flags(_before_flags(spark, sf_dir))
    return rows.select("ingest_seq", "is_remote", "has_salary")


@query
def remote_flag_conversations(spark, sf_dir):
    turns = fixtures.read(spark, sf_dir, "conversations")
    return turns.select(
        "conv_id", "turn", classify.is_remote(F.col("role"), F.col("text")).alias("is_remote")
    )


@query
def silver_full(spark, sf_dir):
    return _shown(_silver(spark, sf_dir))


@query
def silver_from_landing(spark, sf_dir):
    """Landing payload to cleaned rows: the cleaning's "first" is the merged history's order."""
    history = _raw(spark, sf_dir).withColumn("ingest_run", F.lit(1).cast("bigint"))
    rows = landing.postings(fixtures.landing(spark, sf_dir))
    newer = bronze.batch(rows, fixtures.FETCHED_AT, ORDER).withColumn(
        "ingest_run", F.lit(2).cast("bigint")
    )
    stored = ["ingest_unlinked", *RUN_ORDER]
    merged = bronze.merge(history, newer, RUN_ORDER).withColumn(
        "ingest_unlinked", (~dedup.linked()).cast("int")
    )
    return _shown(silver.silver(merged, stored, keep=stored))


_STORED_ORDER = ["ingest_unlinked", *RUN_ORDER]


def _stored_history(rows: DataFrame, label: str = "bronze") -> DataFrame:
    marked = rows.withColumn("ingest_unlinked", (~dedup.linked()).cast("int"))
    return tables.stage(marked.select(*_STORED_ORDER, *rules.BRONZE_COLUMNS), label)


def _landed_on_history(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """The history before a batch, what it was cleaned to, the batch, and the history after it."""
    history = _raw(spark, sf_dir).withColumn("ingest_run", F.lit(1).cast("bigint"))
    before = _stored_history(dedup.keep_last(history, dedup.history_identity(), RUN_ORDER))
    cleaned = tables.stage(silver.silver(before, _STORED_ORDER, keep=_STORED_ORDER), "silver")
    rows = landing.postings(fixtures.landing(spark, sf_dir))
    batch = bronze.batch(rows, fixtures.FETCHED_AT, ORDER).withColumn(
        "ingest_run", F.lit(2).cast("bigint")
    )
    newer = _stored_history(dedup.keep_last(batch, dedup.history_identity(), RUN_ORDER), "batch")
    after = _stored_history(bronze.merge(before, newer, RUN_ORDER, history_is_unique=True))
    return before, cleaned, newer, after


@query
def silver_incremental(spark, sf_dir):
    """The same rows when the history is cleaned already: only touched postings are again."""
    before, cleaned, _, after = _landed_on_history(spark, sf_dir)
    return _shown(silver.refresh(cleaned, before, after, F.col("ingest_run") == 2, _STORED_ORDER))


@query
def silver_changes(spark, sf_dir):
    """What a batch takes from the cleaned table (sign -1) and adds to it (1)."""
    before, cleaned, newer, after = _landed_on_history(spark, sf_dir)
    named = {f"__k_{name}": column for name, column in dedup.history_identity().items()}
    identities = newer.select(*[column.alias(name) for name, column in named.items()])
    went = keys.present(before.withColumns(named), identities, list(named), null_safe=True)
    firsts = tables.stage(silver.changed_firsts(before, after, newer, went, _STORED_ORDER), "firsts")
    return _shown(silver.changes(cleaned, after, firsts, _STORED_ORDER).drop("change"))


# --- star ------------------------------------------------------------------------------


def _rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.load_input(_silver_table(spark, sf_dir), ORDER)


@query
def job_id(spark, sf_dir):
    return _rows(spark, sf_dir).select(F.col("INGEST_SEQ").alias("ingest_seq"), "JOB_ID")


@query
def dim_company(spark, sf_dir):
    return gold.companies(_rows(spark, sf_dir))


@query
def dim_location(spark, sf_dir):
    return gold.locations(_rows(spark, sf_dir))


@query
def dim_date(spark, sf_dir):
    return _shown(gold.calendar(_rows(spark, sf_dir)))


@query
def dim_job(spark, sf_dir):
    return _shown(gold.jobs(_rows(spark, sf_dir), ORDER))


@query
def dim_skill(spark, sf_dir):
    return gold.in_name_order(gold.skills(_rows(spark, sf_dir)))


@query
def surrogate_keys(spark, sf_dir):
    """Dense keys for the companies and places of the postings, in hash order."""
    rows = _rows(spark, sf_dir)
    companies = keys.number_keys(gold.companies(rows), ["COMPANY_NAME"], "KEY")
    places = keys.number_keys(gold.locations(rows), ["CITY", "LOCATION"], "KEY")
    return companies.select(
        F.lit("company").alias("dimension"),
        F.col("COMPANY_NAME").alias("part1"),
        F.lit(None).cast("string").alias("part2"),
        "KEY",
    ).unionByName(
        places.select(
            F.lit("location").alias("dimension"),
            F.col("CITY").alias("part1"),
            F.col("LOCATION").alias("part2"),
            "KEY",
        )
    )


def _new_store(spark: SparkSession) -> tables.StarStore:
    return tables.StarStore(spark, tables.run_folder(spark, "star"), gold.SCHEMAS)


def _star(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The star of all postings, loaded once per application and folder; the reads over it
    are queries on those tables, as for any warehouse."""
    place = _place(spark, sf_dir, "star")
    if place not in _STORED:
        store = _new_store(spark)
        gold.load(_silver_table(spark, sf_dir), store, ORDER)
        _STORED[place] = store
    return _STORED[place].tables()


def _resolved_facts(star: dict[str, DataFrame]) -> DataFrame:
    """Facts with the natural keys their surrogate keys stand for."""
    return (
        star["FACT_JOBS"]
        .join(star["DIM_JOB"].select("JOB_KEY", "JOB_ID"), "JOB_KEY")
        .join(star["DIM_COMPANY"], "COMPANY_KEY", "left")
        .join(star["DIM_LOCATION"], "LOCATION_KEY", "left")
        .select(
            "JOB_ID", "COMPANY_NAME", "CITY", "LOCATION", "DATE_KEY", "IS_REMOTE", "HAS_SALARY"
        )
    )


@query
def fact_jobs(spark, sf_dir):
    return _resolved_facts(_star(spark, sf_dir))


@query
def bridge_job_skill(spark, sf_dir):
    star = _star(spark, sf_dir)
    return (
        star["BRIDGE_JOB_SKILL"]
        .join(star["DIM_JOB"].select("JOB_KEY", "JOB_ID"), "JOB_KEY")
        .join(star["DIM_SKILL"], "SKILL_KEY")
        .select("JOB_ID", "SKILL_NAME")
    )


@query
def table_counts(spark, sf_dir):
    return quality.row_counts(_star(spark, sf_dir))


def _offered(rows: DataFrame) -> DataFrame:
    """Raw postings, cleaned and stored as a load takes them, with their job ids."""
    return tables.stage(gold.load_input(silver.silver(rows, ORDER, keep=ORDER), ORDER), "silver")


def _two_loads(spark: SparkSession, sf_dir: str) -> tuple[tables.StarStore, DataFrame]:
    """First the older postings, then all of them; the summary is of the second load."""
    history, newer = fixtures.history_and_batch(spark, sf_dir)
    store = _new_store(spark)
    gold.load(_offered(history), store, ORDER)
    return store, gold.load_with_summary(_offered(history.unionByName(newer)), store, ORDER)


@query
def incremental_load(spark, sf_dir):
    """Facts after two loads: the second changes nothing the first wrote."""
    store, _ = _two_loads(spark, sf_dir)
    return _resolved_facts(store.tables())


@query
def rollups_after_loads(spark, sf_dir):
    """Rollups kept up through two loads and a repeated refresh, all in one table."""
    history, newer = fixtures.history_and_batch(spark, sf_dir)
    store = _new_store(spark)
    kept = rollups.Rollups(store)
    for postings in (history, history.unionByName(newer)):
        gold.load(_offered(postings), store, ORDER)
        kept.refresh()
    kept.refresh()
    remote = F.lit(None).cast("bigint").alias("remote_postings")

    def shown(rollup, rows, a, b, remote=remote):
        return rows.select(F.lit(rollup).alias("rollup"), a.cast("string").alias("a"), b.cast("string").alias("b"), "postings", remote)

    c, none = F.col, F.lit(None)
    return (
        shown("month", kept.postings_per_month(), c("POSTED_YEAR"), c("POSTED_MONTH"))
        .unionByName(shown("company", kept.postings_per_company(), c("COMPANY_NAME"), none))
        .unionByName(shown("city", kept.postings_per_city(), c("CITY"), none, c("remote_postings")))
        .unionByName(shown("skill", kept.postings_per_skill(), c("SKILL_NAME"), none))
        .unionByName(shown("level", kept.levels_by_employment(), c("EXPERIENCE_LEVEL"), c("EMPLOYMENT_TYPE")))
    )


@query
def load_summary(spark, sf_dir):
    return _two_loads(spark, sf_dir)[1]


def _late_dimensions(spark: SparkSession, sf_dir: str) -> gold.Loaded:
    """The facts of all postings meet dimensions of the older ones only."""
    history, newer = fixtures.history_and_batch(spark, sf_dir)
    store = _new_store(spark)
    older, everything = (
        gold.load_input(_offered(rows), ORDER)
        for rows in (history, history.unionByName(newer))
    )
    gold.load_dimensions(older, store, ORDER)
    return gold.load_facts(everything, store, ORDER)


@query
def load_summary_missed(spark, sf_dir):
    return gold.summary(spark, _late_dimensions(spark, sf_dir).counts)


@query
def load_missed(spark, sf_dir):
    """The rows and mentions that a load left out, since their job or skill has no key."""
    return _late_dimensions(spark, sf_dir).missed


# --- reads over the star ---------------------------------------------------------------


@query
def q1_postings_per_month(spark, sf_dir):
    return analytics.postings_per_month(_star(spark, sf_dir))


@query
def q2_top_companies(spark, sf_dir):
    return analytics.top_companies(_star(spark, sf_dir))


@query
def q3_postings_per_city(spark, sf_dir):
    return analytics.postings_per_city(_star(spark, sf_dir))


@query
def q4_top_skills(spark, sf_dir):
    return analytics.top_skills(_star(spark, sf_dir))


@query
def q5_levels_by_employment(spark, sf_dir):
    return analytics.levels_by_employment(_star(spark, sf_dir))


@query
def skill_counts(spark, sf_dir):
    """Postings per listed skill, straight from the raw postings."""
    rows = silver.squeeze_text(
        silver.tokens_to_null(
            silver.drop_repeats(_raw(spark, sf_dir).select(*ORDER, *rules.POSTING_KEY, "skills"), ORDER)
        )
    )
    listed = F.array_distinct(T.parse_list(F.col("skills")))
    return (
        rows.select(F.explode(listed).alias("skill"))
        .groupBy("skill")
        .agg(F.count(F.lit(1)).alias("postings"))
    )


# --- quality reports -------------------------------------------------------------------


@query
def null_report(spark, sf_dir):
    df = _silver_table(spark, sf_dir).drop(*ORDER)
    return quality.nulls(df).orderBy(F.desc("null_count"), "column_name")


@query
def null_report_cleaning(spark, sf_dir):
    """Missing values left as NULL in the columns the cleaning reports on."""
    columns = [
        "salary", "city", "employment_type", "skills", "experience_level", "posted_at",
        "fetched_at", "description",
    ]
    return quality.nulls(_before_flags(spark, sf_dir), columns).drop("null_pct")


@query
def distributions(spark, sf_dir):
    columns = ["experience_level", "is_remote", "has_salary"]
    return quality.value_counts(_silver_table(spark, sf_dir), columns).orderBy(
        "column_name", F.desc("n"), "value"
    )


@query
def dq_checks(spark, sf_dir):
    df = _silver_table(spark, sf_dir)
    flags_ok = quality.boolean_checks(df, ["is_remote", "has_salary"]).select(
        "check_name",
        F.when(F.col("status") == "PASS", F.lit(0)).otherwise(F.lit(1)).cast("bigint").alias("findings"),
        "status",
    )
    return (
        quality.required_checks(df, rules.POSTING_KEY)
        .unionByName(quality.duplicate_check(df, rules.POSTING_KEY))
        .unionByName(quality.domain_checks(df, {"experience_level": rules.LEVELS}))
        .unionByName(flags_ok)
    )


@query
def invalid_values(spark, sf_dir):
    """Distinct raw levels and employment types outside the known names."""
    rows = silver.squeeze_text(silver.tokens_to_null(_raw(spark, sf_dir)))
    levels = quality.outside_domain(rows, "experience_level", rules.LEVELS)
    types = quality.outside_domain(
        rows, "employment_type", sorted(set(rules.EMPLOYMENT_TYPES.values()))
    )
    return levels.withColumn("column_name", F.lit("experience_level")).unionByName(
        types.withColumn("column_name", F.lit("employment_type"))
    )


@query
def whitespace_check(spark, sf_dir):
    """Before cleaning, where there is something to find, and after."""
    raw = silver.tokens_to_null(_raw(spark, sf_dir))
    before = quality.whitespace_checks(raw, rules.TEXT_COLUMNS)
    after = quality.whitespace_checks(_silver_table(spark, sf_dir), rules.TEXT_COLUMNS)
    return before.withColumn("stage", F.lit("raw")).unionByName(
        after.withColumn("stage", F.lit("cleaned"))
    )


@query
def recovered_counts(spark, sf_dir):
    before = _before_flags(spark, sf_dir).withColumns(
        {
            "__city": F.col("city"),
            "__level": classify.known_level(F.col("experience_level")),
        }
    )
    after = before.transform(silver.levels).transform(silver.cities)
    return quality.recovered(
        after,
        {
            "experience_level": (F.col("__level"), F.col("experience_level")),
            "city": (F.col("__city"), F.col("city")),
        },
    )


@query
def duplicates_report(spark, sf_dir):
    """Duplicates in the raw postings and those that remain after cleaning."""
    raw = dedup.count_duplicates(_raw(spark, sf_dir), rules.POSTING_KEY)
    cleaned = dedup.count_duplicates(_silver_table(spark, sf_dir), rules.POSTING_KEY)
    return raw.withColumn("stage", F.lit("raw")).unionByName(
        cleaned.withColumn("stage", F.lit("cleaned"))
    )


@query
def silver_shape(spark, sf_dir):
    return quality.shape(_silver_table(spark, sf_dir).drop(*ORDER))


@query
def schema_dump(spark, sf_dir):
    return describe(_silver_table(spark, sf_dir).drop(*ORDER))


@query
def record_files(spark, sf_dir):
    """The cleaned table through JSON records and back, with NaN in place of some missing values."""
    folder = tables.run_folder(spark, "records")
    cleaned = _silver_table(spark, sf_dir).drop(*ORDER)
    month = F.coalesce(F.col("posted_month").cast("double"), F.lit(float("nan")))
    tables.write_records(cleaned.withColumn("posted_month", month), folder)
    read = tables.read_records(spark, folder, cleaned.withColumn("posted_month", month).schema)
    return _shown(tables.require_rows(read, "the records").withColumn("posted_month", F.col("posted_month").cast("bigint")))


@query
def published_table(spark, sf_dir):
    """A table published with the older postings, then again from itself and the newer ones."""
    history, newer = fixtures.history_and_batch(spark, sf_dir)
    folder, name = tables.run_folder(spark, "published"), f"postings_{uuid.uuid4().hex}"
    tables.publish_table(history, name, folder=folder)
    both = tables.require_table(spark, name).unionByName(newer)
    tables.publish_table(both, name, folder=folder)
    return tables.require_table(spark, name).select(*_MERGED)


@query
def first_rows(spark, sf_dir):
    """The first five cleaned postings, in row order."""
    rows = gold.load_input(_silver_table(spark, sf_dir), ORDER)
    return rows.orderBy("INGEST_SEQ").limit(5).select("JOB_ID", "JOB_TITLE", "COMPANY")
