import json
import pathlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from starmill import fixtures, rules
from starmill.operators import keys
from starmill.operators.schema import MissingColumns, require_columns, try_cast_columns
from starmill.plans import analytics, bronze, gold, silver
from starmill.plans.run import Lake, backfill, run, star
from starmill.sources import tables
from starmill.streaming.landing import follow

ORDER = fixtures.ORDER


@pytest.fixture(scope="module")
def cleaned(spark, sf_dir):
    raw = fixtures.raw_jobs(spark, sf_dir).drop("o_orderdate")
    return tables.stage(silver.silver(raw, ORDER, keep=ORDER), "test-silver")


def new_store(spark, tmp_path, name="star"):
    return tables.StarStore(spark, str(tmp_path / name), gold.SCHEMAS)


def natural(star):
    """The star without its surrogate keys."""
    facts = (
        star["FACT_JOBS"]
        .join(star["DIM_JOB"], "JOB_KEY")
        .join(star["DIM_COMPANY"], "COMPANY_KEY", "left")
        .join(star["DIM_LOCATION"], "LOCATION_KEY", "left")
        .drop("JOB_KEY", "COMPANY_KEY", "LOCATION_KEY")
    )
    pairs = (
        star["BRIDGE_JOB_SKILL"]
        .join(star["DIM_JOB"].select("JOB_KEY", "JOB_ID"), "JOB_KEY")
        .join(star["DIM_SKILL"], "SKILL_KEY")
        .select("JOB_ID", "SKILL_NAME")
    )
    return {n: sorted(map(repr, df.collect())) for n, df in {"facts": facts, "pairs": pairs}.items()}


def test_silver_schema(cleaned):
    assert dict(cleaned.dtypes) == {"ingest_seq": "bigint", **rules.SILVER_TYPES}
    assert cleaned.columns == ["ingest_seq", *rules.SILVER_TYPES]


def test_silver_needs_all_columns(spark):
    with pytest.raises(MissingColumns, match="salary, skills"):
        silver.silver(spark.range(1).select(*[
            F.lit("x").alias(c) for c in rules.BRONZE_COLUMNS if c not in ("salary", "skills")
        ]), ["job_title"])


def test_silver_keeps_other_columns(spark, sf_dir):
    raw = fixtures.raw_jobs(spark, sf_dir)
    assert silver.silver(raw, ORDER, keep=ORDER).columns[-1] == "o_orderdate"


def test_second_load_inserts_nothing(spark, cleaned, tmp_path):
    store = new_store(spark, tmp_path)
    first = {r.table_name: r for r in gold.load_with_summary(cleaned, store, ORDER).collect()}
    before = natural(store.tables())
    second = {r.table_name: r for r in gold.load_with_summary(cleaned, store, ORDER).collect()}
    assert {n: r.inserted for n, r in second.items()} == dict.fromkeys(gold.SCHEMAS, 0)
    for name, row in first.items():
        assert row.inserted == store.count(name) > 0
        assert row.inserted + row.existed == second[name].existed
    assert natural(store.tables()) == before


def parquet_files(store):
    return {str(f) for f in pathlib.Path(store.folder).rglob("part-*")}


def test_a_load_without_new_rows_writes_no_file(spark, cleaned, tmp_path):
    store = new_store(spark, tmp_path)
    first = gold.load(cleaned, store, ORDER)
    written = parquet_files(store)
    again = gold.load(cleaned, store, ORDER)
    assert parquet_files(store) == written
    assert {n: c.inserted for n, c in again.counts.items()} == dict.fromkeys(gold.SCHEMAS, 0)
    assert {n: c.offered for n, c in again.counts.items()} == {n: c.offered for n, c in first.counts.items()}
    empty = gold.load(cleaned.limit(0), new_store(spark, tmp_path, "empty"), ORDER)
    assert set(empty.counts.values()) == {gold.Counts(0, 0, 0)} and empty.missed.isEmpty()


def test_rows_without_a_key_are_counted_and_loaded_later(spark, cleaned, tmp_path):
    store, whole = new_store(spark, tmp_path), new_store(spark, tmp_path, "whole")
    rows = gold.load_input(cleaned, ORDER)
    gold.load_dimensions(rows.where("INGEST_SEQ % 3 = 0"), store, ORDER)
    known = {r.JOB_ID for r in store.read("DIM_JOB").collect()}
    loaded = gold.load_facts(rows, store, ORDER)
    ids = [r.JOB_ID for r in rows.select("JOB_ID").collect()]
    assert loaded.counts["FACT_JOBS"] == (len(ids), len(known), sum(i not in known for i in ids))
    of_facts = {r.JOB_ID: r.offered for r in loaded.missed.where("table_name = 'FACT_JOBS'").collect()}
    assert of_facts == {i: n for i, n in Counter(ids).items() if i not in known} != {}
    links = loaded.counts["BRIDGE_JOB_SKILL"]
    of_links = loaded.missed.where("table_name = 'BRIDGE_JOB_SKILL'").agg(F.sum("offered")).first()[0]
    assert links.missed == of_links > 0 and links.inserted == store.count("BRIDGE_JOB_SKILL") > 0
    gold.load(cleaned, store, ORDER)
    gold.load(cleaned, whole, ORDER)
    # Values are first-seen, so they follow what was loaded first; jobs and links do not.
    assert natural(store.tables())["pairs"] == natural(whole.tables())["pairs"]
    assert store.count("FACT_JOBS") == whole.count("FACT_JOBS") == len(set(ids))


def test_counts_of_writes_do_not_depend_on_the_plan(spark, tmp_path):
    """Counts agree with what is stored when joins, unions and empty sides lie below them."""
    rows = spark.range(1000).select((F.col("id") % 7).alias("k"), F.col("id").alias("v"))
    for other in (spark.range(3).withColumnRenamed("id", "k"), spark.range(0).withColumnRenamed("id", "k")):
        marks = keys.marked(rows.unionByName(rows), other, ["k"], "known")
        stored, n = tables.stage_counted(marks, "test", ~F.col("known"), all=F.count(F.lit(1)), held=F.sum(F.when(F.col("known"), 1)))
        assert n["all"] == 2000 and n["held"] == 2000 - stored.count()


def test_keys_are_unique_dense_and_resolve(spark, cleaned, tmp_path):
    store = new_store(spark, tmp_path)
    gold.load(cleaned.where("ingest_seq < 700"), store, ORDER)
    gold.load(cleaned, store, ORDER)
    star = store.tables()
    for name, key in [
        ("DIM_COMPANY", "COMPANY_KEY"), ("DIM_LOCATION", "LOCATION_KEY"), ("DIM_JOB", "JOB_KEY"),
        ("DIM_SKILL", "SKILL_KEY"),
    ]:
        row = star[name].agg(F.count(key).alias("n"), F.count_distinct(key).alias("d"), F.max(key).alias("m")).first()
        assert row.n == row.d == row.m
    facts = star["FACT_JOBS"]
    assert facts.count() == facts.select("JOB_KEY").distinct().count() == star["DIM_JOB"].count()
    for name, key in [("DIM_COMPANY", "COMPANY_KEY"), ("DIM_LOCATION", "LOCATION_KEY"), ("DIM_DATE", "DATE_KEY")]:
        assert facts.where(f"{key} IS NOT NULL").join(star[name], key, "left_anti").isEmpty()
    assert star["BRIDGE_JOB_SKILL"].join(facts, "JOB_KEY", "left_anti").isEmpty()


def test_two_halves_equal_one_load(spark, cleaned, tmp_path):
    whole, halves = new_store(spark, tmp_path, "whole"), new_store(spark, tmp_path, "halves")
    gold.load(cleaned, whole, ORDER)
    middle = cleaned.agg(F.percentile_approx("ingest_seq", 0.5)).first()[0]
    gold.load(cleaned.where(F.col("ingest_seq") <= middle), halves, ORDER)
    gold.load(cleaned.where(F.col("ingest_seq") > middle), halves, ORDER)
    assert natural(whole.tables()) == natural(halves.tables())


def test_large_dimensions_give_the_same_star(spark, cleaned, tmp_path):
    """No dimension may be broadcast, and every key with ten rows counts as frequent."""
    small, large = new_store(spark, tmp_path, "small"), new_store(spark, tmp_path, "large")
    gold.load(cleaned, small, ORDER)
    gold.load(cleaned, large, ORDER, broadcast_bytes=0, rows_per_split=10)
    assert natural(small.tables()) == natural(large.tables())


def test_first_seen_values_stay(spark, tmp_path):
    def batch(seq, level, skills, city):
        return spark.createDataFrame(
            [(seq, "J", "Dev", "Acme ", city, "L", None, skills, level, None, None, None, False, None, None, None, None, None)],
            "ingest_seq bigint, source string, job_title string, company string, city string, location string, "
            "employment_type string, skills string, experience_level string, apply_link string, posted_at timestamp, "
            "description string, is_remote boolean, has_salary boolean, posted_date date, posted_year bigint, "
            "posted_month bigint, posted_day bigint",
        )

    store = new_store(spark, tmp_path)
    gold.load(batch(1, "Junior", "SQL", None), store, ORDER)
    gold.load(batch(2, "Senior", "SQL, Git", ""), store, ORDER)
    star = store.tables()
    assert [r.EXPERIENCE_LEVEL for r in star["DIM_JOB"].collect()] == ["Junior"]
    assert [tuple(r) for r in star["FACT_JOBS"].collect()] == [(1, 1, 1, None, False, False)]
    assert {r.CITY for r in star["DIM_LOCATION"].collect()} == {"", None}
    assert star["DIM_LOCATION"].count() == 2
    assert star["BRIDGE_JOB_SKILL"].count() == 2
    assert [r.COMPANY_NAME for r in star["DIM_COMPANY"].collect()] == ["Acme"]


def test_job_id_of_missing_parts(spark):
    import hashlib

    row = spark.range(1).select(
        gold.job_id(F.lit(" Dev "), F.lit(None).cast("string"), F.lit("L"), F.lit(None).cast("string")).alias("i")
    ).first()
    assert row.i == hashlib.sha256(b"dev||l|").hexdigest()[:16]


def test_reads_count_each_fact_once(spark, cleaned, tmp_path):
    store = new_store(spark, tmp_path)
    gold.load(cleaned, store, ORDER)
    star = store.tables()
    facts = star["FACT_JOBS"].count()
    by_level = analytics.levels_by_employment(star)
    assert by_level.agg(F.sum("postings")).first()[0] == facts
    dated = star["FACT_JOBS"].where("DATE_KEY IS NOT NULL").count()
    assert analytics.postings_per_month(star).agg(F.sum("postings")).first()[0] == dated


# --- runs ------------------------------------------------------------------------------


def payload(folder, name, *jobs):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text(json.dumps({"data": {"jobs": list(jobs)}}))


def job(title, link=None, **more):
    return {"job_title": title, "job_apply_link": link, "employer_name": "acme", **more}


def test_runs_merge_and_load(spark, tmp_path):
    from starmill.sources.landing import read_payloads

    lake = Lake(spark, str(tmp_path / "lake"), buckets=3)
    payload(tmp_path / "one", "a.json", job("Dev", "l1"), job("Ops"), job("dev", "L1 "))
    payload(tmp_path / "two", "a.json", job("Dev II", "l1"), job("QA", "l2", job_posted_at="قبل يومين"))
    payload(tmp_path / "none", "a.json")

    run(lake, read_payloads(spark, str(tmp_path / "one")), 1, "2024-03-01 08:30:00").collect()
    second = run(lake, read_payloads(spark, str(tmp_path / "two")), 2, "2024-03-02 08:30:00")
    assert {r.table_name: r.inserted for r in second.collect()} == {
        "DIM_COMPANY": 0, "DIM_LOCATION": 0, "DIM_DATE": 1, "DIM_JOB": 2, "DIM_SKILL": 1, "FACT_JOBS": 2,
        "BRIDGE_JOB_SKILL": 1,
    }
    titles = [r.job_title for r in lake.read("bronze", 2).orderBy(*bronze.ROW_ORDER).collect()]
    assert titles == ["Dev II", "QA", "Ops"]
    assert [r.job_title for r in lake.read("bronze", 1).orderBy(*bronze.ROW_ORDER).collect()] == ["Dev", "Ops"]

    again = run(lake, read_payloads(spark, str(tmp_path / "two")), 2, "2024-03-02 08:30:00")
    assert {r.inserted for r in again.collect()} == {0}
    third = run(lake, read_payloads(spark, str(tmp_path / "none")), 3, "2024-03-03 08:30:00")
    assert {r.inserted for r in third.collect()} == {0}
    assert lake.last_run("bronze") == 2


def test_a_first_run_without_postings_stops(spark, tmp_path):
    from starmill.sources.landing import read_payloads

    payload(tmp_path / "none", "a.json")
    lake = Lake(spark, str(tmp_path / "lake"), buckets=3)
    with pytest.raises(tables.EmptySource):
        run(lake, read_payloads(spark, str(tmp_path / "none")), 1, "2024-03-01 08:30:00")


def test_backfill_goes_under_the_history(spark, tmp_path):
    from starmill.sources.landing import read_payloads

    lake = Lake(spark, str(tmp_path / "lake"), buckets=3)
    payload(tmp_path / "one", "a.json", job("Dev", "l1"))
    run(lake, read_payloads(spark, str(tmp_path / "one")), 1, "2024-03-01 08:30:00")
    old = spark.createDataFrame(
        [(i, *[("l1" if i == 1 else "l0") if c == "apply_link" else f"{c}{i}" for c in rules.BRONZE_COLUMNS]) for i in (1, 2, 3)],
        "id int, " + ", ".join(f"{c} string" for c in rules.BRONZE_COLUMNS),
    )
    stored = backfill(lake, old, 2)
    assert sorted(r.job_title for r in stored.collect()) == ["Dev", "job_title3"]


def test_landing_stream_takes_each_file_once(spark, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake"), buckets=3)
    landed = tmp_path / "landed"
    payload(landed, "a.json", job("Dev", "l1"))

    def go():
        follow(lake, str(landed), str(tmp_path / "progress"), "2024-03-01 08:30:00").awaitTermination()
        return star(lake).count("FACT_JOBS")

    assert go() == 1
    payload(landed, "b.json", job("Ops", "l2"), job("QA"))
    assert go() == 3
    assert go() == 3
    assert lake.last_run("bronze") == 2


# --- tables and gates ------------------------------------------------------------------


def test_gates(spark, tmp_path):
    df = spark.range(3)
    assert tables.require_rows(df, "x") is df
    with pytest.raises(tables.EmptySource):
        tables.require_rows(df.limit(0), "x")
    with pytest.raises(tables.EmptySource):
        tables.require_path(spark, str(tmp_path / "nothing"))
    with pytest.raises(tables.EmptySource):
        tables.require_table(spark, "no_such_table")
    with pytest.raises(tables.CountMismatch):
        tables.require_count(df, 4, "x")
    with pytest.raises(MissingColumns):
        require_columns(df, ["id", "other"], "x")


def test_records_round_trip(spark, tmp_path, cleaned):
    path = str(tmp_path / "records")
    tables.write_records(cleaned, path)
    back = tables.read_records(spark, path, cleaned.schema)
    assert sorted(map(repr, back.collect())) == sorted(map(repr, cleaned.collect()))
    texts = tables.read_records(spark, path, ", ".join(f"{c} string" for c in cleaned.columns))
    retyped = try_cast_columns(texts, dict(cleaned.dtypes))
    assert sorted(map(repr, retyped.collect())) == sorted(map(repr, cleaned.collect()))


def test_nan_is_written_as_null(spark, tmp_path):
    path = str(tmp_path / "nan")
    tables.write_records(spark.createDataFrame([(float("nan"), "x"), (1.5, None)], "d double, s string"), path)
    assert sorted(r.value for r in spark.read.text(path).collect()) == [
        '{"d":1.5,"s":null}', '{"d":null,"s":"x"}',
    ]


def test_json_array_file_with_nested_records(spark, tmp_path):
    from starmill.operators.schema import flatten_structs

    (tmp_path / "h.json").write_text('[{"a": {"b": "سلام", "c": {"d": 1}}, "e": "x"}, {"e": null}]')
    df = tables.read_records(
        spark, str(tmp_path / "h.json"), "a struct<b: string, c: struct<d: int>>, e string", array_file=True
    )
    flat = flatten_structs(df)
    assert flat.columns == ["a.b", "a.c.d", "e"]
    assert sorted(map(repr, map(tuple, flat.collect()))) == sorted(
        map(repr, [("سلام", 1, "x"), (None, None, None)])
    )


def test_publish_replaces_a_table_it_reads(spark):
    name = "published_numbers"
    tables.publish_table(spark.range(3), name)
    tables.publish_table(tables.read_table(spark, name).selectExpr("id + 10 AS id"), name)
    assert [r.id for r in tables.require_table(spark, name).orderBy("id").collect()] == [10, 11, 12]


def test_stage_reads_only_needed_columns(spark):
    staged = tables.stage(spark.range(10).withColumn("wide", F.lit("x")), "test")
    plan = staged.select("id")._jdf.queryExecution().executedPlan().toString()
    assert "struct<id:bigint>" in plan


# --- what a run must not lose ------------------------------------------------------------


def test_stream_does_not_overwrite_other_runs(spark, tmp_path):
    from starmill.sources.landing import read_payloads

    lake = Lake(spark, str(tmp_path / "lake"), buckets=3)
    payload(tmp_path / "one", "a.json", job("A", "la"), job("B", "lb"))
    run(lake, read_payloads(spark, str(tmp_path / "one")), 1, "2024-03-01 08:30:00").collect()
    payload(tmp_path / "landed", "c.json", job("C", "lc"))
    for progress in ("p1", "p2"):
        follow(lake, str(tmp_path / "landed"), str(tmp_path / progress)).awaitTermination()
    last = lake.read("bronze", lake.last_run("bronze"))
    assert sorted(r.job_title for r in last.collect()) == ["A", "B", "C"]
    assert lake.last_run("bronze") == 3
    with pytest.raises(RuntimeError):
        run(lake, read_payloads(spark, str(tmp_path / "one")), 2, "2024-03-01 08:30:00")


@pytest.mark.parametrize("files", [1, 2, 1000])
def test_grouping_of_files_does_not_change_the_history(spark, tmp_path, files):
    import os

    landed = tmp_path / "landed"
    for at, (name, title) in enumerate([("b.json", "older"), ("a.json", "newer")]):
        payload(landed, name, job(title, "l1"))
        os.utime(landed / name, (1_700_000_000 + at, 1_700_000_000 + at))
    lake = Lake(spark, str(tmp_path / "lake"), buckets=3)
    follow(lake, str(landed), str(tmp_path / "progress"), files_per_run=files).awaitTermination()
    rows = lake.read("bronze", lake.last_run("bronze")).collect()
    assert [(r.job_title, r.fetched_at) for r in rows] == [("newer", "2023-11-14 22:13:21")]


def test_a_torn_landing_file_stops_the_run(spark, tmp_path):
    from starmill.sources.landing import read_payloads

    payload(tmp_path / "in", "a.json", job("A", "la"))
    (tmp_path / "in" / "b.json").write_text('{"data": {"jobs": [{"job_title": "B"')
    lake = Lake(spark, str(tmp_path / "lake"), buckets=3)
    with pytest.raises(Exception, match="(?i)malformed"):
        run(lake, read_payloads(spark, str(tmp_path / "in")), 1, "2024-03-01 08:30:00")
    assert lake.last_run("bronze") is None


def test_only_touched_postings_are_cleaned_again(spark):
    """Rows that replace, add and repeat postings leave what cleaning everything gives."""

    def rows(run, *postings):
        named = [{"job_title": t, "apply_link": link, "company": "acme", "ingest_run": run, "ingest_pos": i}
                 for i, (t, link) in enumerate(postings)]
        columns = [*bronze.FILE_ORDER, *rules.BRONZE_COLUMNS]
        types = {"ingest_run": "bigint", "ingest_pos": "bigint"}
        return spark.createDataFrame(
            [tuple(n.get(c, "a.json" if c == "ingest_file" else None) for c in columns) for n in named],
            ", ".join(f"{c} {types.get(c, 'string')}" for c in columns),
        )

    order = bronze.ROW_ORDER
    first = rows(1, ("Dev", "l1"), ("Ops", None), (None, "l3"), ("Same", "l4"), ("Same", "l5"), ("Alone", "l8"))
    newer = rows(2, ("Dev II", "l1"), ("QA", "l2"), ("Other", "l4"), ("Ops", "l6"), (None, "l7"))
    before = tables.stage(bronze.with_row_order(first), "test-before")
    after = tables.stage(bronze.with_row_order(bronze.merge(before, newer, history_is_unique=True)), "test-after")
    cleaned = tables.stage(silver.silver(before, order, keep=order), "test-cleaned")
    marked = cleaned.withColumn("source", F.lit("as it was"))
    got = silver.refresh(marked, before, after, F.col("ingest_run") == 2, order).collect()
    whole = silver.silver(after, order, keep=order).drop("source").collect()

    def shown(found):
        return sorted(repr({k: v for k, v in r.asDict().items() if k != "source"}) for r in found)

    assert shown(got) == shown(whole)
    assert [r.job_title for r in got if r.source == "as it was"] == ["Alone"]


def test_stored_load_input_is_not_hashed_again(spark, sf_dir):
    cleaned = silver.silver(fixtures.raw_jobs(spark, sf_dir).drop("o_orderdate"), ORDER, keep=ORDER)
    once = tables.stage(gold.load_input(cleaned, ORDER), "test-load-input")
    again = gold.load_input(once, ORDER)
    assert "sha2" not in again._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(map(repr, again.collect())) == sorted(map(repr, gold.load_input(cleaned, ORDER).collect()))
