"""The commit log, buckets, change feed and rejects of a lake."""

import json
import os

import pytest
from pyspark.sql import functions as F

from starmill.plans import bronze, gold, silver
from starmill.plans.run import run, star
from starmill.sources import tables
from starmill.sources.commits import CommitLog, Taken
from starmill.sources.lake import Conflict, Lake
from starmill.sources.landing import TooManyRejects, read_payloads


def numbers(spark, start, stop, mark="a"):
    return spark.range(start, stop).select(F.col("id").alias("k"), F.concat(F.lit(mark), F.col("id")).alias("v"))


def write(lake, number, rows, base=None, touched=None, source="me", **more):
    return lake.write("t", number, rows, source, lake.bucket([F.col("k")], base), base, touched, **more)


def shown(df):
    return sorted(map(tuple, df.collect()), key=repr)


def size(folder):
    return sum(os.path.getsize(os.path.join(d, f)) for d, _, names in os.walk(folder) for f in names if f.startswith("part-"))


# --- commits ---------------------------------------------------------------------------------


def test_a_number_is_taken_once(spark, tmp_path):
    one, two = (CommitLog(spark, str(tmp_path / "log")) for _ in range(2))
    assert one.read() == (0, {})
    assert one.commit(0, {"who": "one"}) == 1
    with pytest.raises(Taken):
        two.commit(0, {"who": "two"})
    assert two.read() == (1, {"who": "one"})
    assert two.commit(1, {"who": "two"}) == 2
    one.forget(1)
    assert one.numbers() == [2] and not [f for f in os.listdir(tmp_path / "log") if f.startswith(".") and not f.endswith(".crc")]


def test_of_two_writers_of_a_run_one_wins(spark, tmp_path):
    one, two = (Lake(spark, str(tmp_path / "lake"), buckets=2) for _ in range(2))
    first = one.log.commit

    def late(after, state):  # the other writer comes between this one's look and its commit
        one.log.commit = first
        write(two, 1, numbers(spark, 0, 4, "b"), source="other")
        return first(after, state)

    one.log.commit = late
    with pytest.raises(RuntimeError, match="written by other, not by me"):
        write(one, 1, numbers(spark, 0, 9))
    assert shown(one.read("t", 1)) == [(i, f"b{i}") for i in range(4)]


def test_a_stale_base_is_refused(spark, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake"), buckets=2)
    base = write(lake, 1, numbers(spark, 0, 9))
    write(lake, 2, numbers(spark, 0, 9, "b"), source="other")
    with pytest.raises(Conflict):
        write(lake, 3, numbers(spark, 0, 9, "c"), base, [0, 1])
    assert [e["run"] for e in lake.entries()] == [1, 2]


def test_writers_of_other_layers_do_not_disturb(spark, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake"), buckets=2)
    first = lake.log.commit

    def late(after, state):
        lake.log.commit = first
        Lake(spark, lake.folder).mark("star", 1, "other")
        return first(after, state)

    lake.log.commit = late
    write(lake, 1, numbers(spark, 0, 3))
    assert sorted(e["layer"] for e in lake.entries()) == ["star", "t"]


def test_a_crash_before_the_commit_leaves_no_trace(spark, tmp_path, monkeypatch):
    lake = Lake(spark, str(tmp_path / "lake"), buckets=2)
    write(lake, 1, numbers(spark, 0, 5))
    before = lake.entries()
    monkeypatch.setattr(lake, "_commit", lambda *_: (_ for _ in ()).throw(OSError("gone")))
    with pytest.raises(OSError):
        write(lake, 2, numbers(spark, 0, 9))
    again = Lake(spark, lake.folder)
    assert again.entries() == before and shown(again.read("t", 1)) == [(i, f"a{i}") for i in range(5)]


# --- buckets ---------------------------------------------------------------------------------


def test_a_small_batch_writes_what_it_touches(spark, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake"), buckets=40)
    base = write(lake, 1, numbers(spark, 0, 20_000))
    newer = numbers(spark, 19_999, 20_001, "new")
    touched = lake.touched(newer, lake.bucket([F.col("k")], base))
    old = lake.read("t", 1, touched).where("k < 19999")
    assert old.count() < 2_000
    write(lake, 2, old.unionByName(newer), base, touched, least=20_000)
    first, second = (size(next(iter({p["folder"] for p in lake.listed(lake.entry("t", n))["parts"].values()} - done))) for n, done in ((1, set()), (2, {p["folder"] for p in lake.listed(base)["parts"].values()})))
    assert len(touched) <= 2 and second < 0.1 * first
    whole = numbers(spark, 0, 19_999).unionByName(newer)
    assert shown(lake.read("t", 2)) == shown(whole) and shown(lake.read("t", 1)) == shown(numbers(spark, 0, 20_000))
    places = lake.read("t", 2, numbered=True).where(F.col("bucket") != lake.bucket([F.col("k")], base))
    assert places.isEmpty()


def test_an_altered_cell_is_found(spark, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake"), buckets=1)
    write(lake, 1, numbers(spark, 0, 50).withColumn("v", F.when(F.col("k") != 7, F.col("v"))))
    assert lake.verify("t", 1)["rows"] == 50
    folder = next(iter(lake.listed(lake.entry("t", 1))["parts"].values()))["folder"]
    rows = lake.read("t", 1).collect()
    # The same number of rows, and two cells that changed places.
    altered = [(r.k, "a7" if r.k == 7 else None if r.k == 8 else r.v) for r in rows]
    spark.createDataFrame(altered, "k long, v string").write.mode("overwrite").parquet(f"{folder}/bucket=0")
    with pytest.raises(tables.CountMismatch):
        lake.verify("t", 1)


def test_too_few_rows_stop_a_run(spark, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake"), buckets=2)
    with pytest.raises(tables.CountMismatch):
        write(lake, 1, numbers(spark, 0, 0))
    with pytest.raises(tables.CountMismatch):
        write(lake, 1, numbers(spark, 0, 5), least=6)
    assert lake.entries() == [] and lake.last("t") is None
    with pytest.raises(tables.EmptySource):
        lake.read("t", 1)


def test_retired_runs_leave_what_others_hold(spark, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake"), buckets=4)
    base = write(lake, 1, numbers(spark, 0, 100))
    bucket = lake.bucket([F.col("k")], base)
    held = lake.read("t", 1, [2])
    second = write(lake, 2, held.withColumn("v", F.lit("second")), base, [2])
    write(lake, 3, numbers(spark, 0, 100).where(bucket == 1).withColumn("v", F.lit("third")), second, [1])
    want = shown(lake.read("t", 3))
    gone = lake.retire(before=3)
    assert [g.rsplit("/", 1)[1] for g in gone] == ["bucket=2"]  # run 2 is kept as the newest below
    assert [e["run"] for e in lake.entries()] == [2, 3] and shown(lake.read("t", 3)) == want
    assert lake.log.numbers() == [4]


# --- runs ------------------------------------------------------------------------------------


def payload(folder, name, *jobs):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text(json.dumps({"data": {"jobs": list(jobs)}}))


def job(title, link=None, **more):
    return {"job_title": title, "job_apply_link": link, "employer_name": "acme", **more}


def test_runs_with_changes_equal_cleaning_everything(spark, tmp_path):
    """Replaced, added, repeated and vanished postings; the star is offered what came alone."""
    lake = Lake(spark, str(tmp_path / "lake"), buckets=3)
    runs = [
        [job("Dev", "l1"), job("Ops"), job("Same", "l4"), job("Same", "l5"), job("Alone", "l8", job_description="SQL and Git")],
        [job("Dev II", "l1"), job("QA", "l2"), job("Other", "l4"), job("Ops", "l6"), job("Same", "l9")],
    ]
    for number, jobs in enumerate(runs, 1):
        payload(tmp_path / str(number), "a.json", *jobs)
        run(lake, read_payloads(spark, str(tmp_path / str(number))), number, f"2024-03-0{number} 08:30:00").collect()
    order = bronze.ROW_ORDER
    whole = tables.stage(silver.silver(lake.read("bronze", 2), order, keep=order), "whole")
    assert shown(lake.read("silver", 2).select(*whole.columns)) == shown(whole)
    feed = lake.read("changes", 2)
    assert sorted((r.change, r.sign, r.job_title) for r in feed.collect()) == [
        ("inserted", 1, "Dev II"), ("inserted", 1, "Other"), ("inserted", 1, "QA"), ("removed", -1, "Dev"),
        ("replaced", -1, "Ops"), ("replaced", -1, "Same"), ("replaced", 1, "Ops"), ("replaced", 1, "Same"),
    ]
    again = tables.StarStore(spark, str(tmp_path / "again"), gold.SCHEMAS)
    gold.load(lake.read("silver", 1), again, order)
    gold.load(whole, again, order)
    for name in ("DIM_JOB", "DIM_COMPANY", "DIM_SKILL", "FACT_JOBS", "BRIDGE_JOB_SKILL"):
        assert shown(star(lake).read(name)) == shown(again.read(name))


def test_files_that_are_no_payload_are_kept_apart(spark, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake"), buckets=2)
    payload(tmp_path / "in", "a.json", job("A", "la"))
    (tmp_path / "in" / "b.json").write_text('{"data": {"jobs": [{"job_title": "B"')
    with pytest.raises(TooManyRejects):
        run(lake, read_payloads(spark, str(tmp_path / "in"), reject=True), 1, "2024-03-01 08:30:00")
    assert lake.entries() == []
    run(lake, read_payloads(spark, str(tmp_path / "in"), reject=True), 1, "2024-03-01 08:30:00", most_rejects=1).collect()
    assert [r.job_title for r in lake.read("bronze", 1).collect()] == ["A"]
    rejects = lake.read("rejects", 1).collect()
    assert [(r.ingest_file.rsplit("/", 1)[1], r.corrupt) for r in rejects] == [("b.json", '{"data": {"jobs": [{"job_title": "B"')]


