import json

import pytest
from pyspark.sql import functions as F

from starmill import fixtures, rules
from starmill.plans import bronze
from starmill.sources import landing, tables


def write(folder, name, jobs):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text(json.dumps({"status": "OK", "data": {"jobs": jobs}}, indent=1))


def normalised(spark, tmp_path, jobs):
    write(tmp_path / "in", "a.json", jobs)
    rows = landing.postings(landing.read_payloads(spark, str(tmp_path / "in")))
    return bronze.normalise(rows, "2024-03-01 08:30:00", ["ingest_pos"]).orderBy("ingest_pos").collect()


def test_missing_levels_give_no_rows(spark, tmp_path):
    for i, text in enumerate(['{}', '{"data": null}', '{"data": {}}', '{"data": {"jobs": []}}']):
        (tmp_path / f"{i}.json").write_text(text)
    assert landing.postings(landing.read_payloads(spark, str(tmp_path))).count() == 0


def test_defaults_of_an_empty_posting(spark, tmp_path):
    row = normalised(spark, tmp_path, [{}, {"job_title": "", "employer_name": " "}])
    empty = row[0].asDict()
    assert empty == {
        "ingest_pos": 0, "source": "JSearch", "job_title": "N/A", "company": "N/A", "city": "N/A",
        "location": "N/A", "employment_type": "N/A", "salary": "N/A", "skills": "N/A",
        "experience_level": "N/A", "apply_link": "", "posted_at": "N/A",
        "fetched_at": "2024-03-01 08:30:00", "description": "N/A",
    }
    assert (row[1].job_title, row[1].company) == ("N/A", " ")
    assert list(empty)[1:] == rules.BRONZE_COLUMNS


@pytest.mark.parametrize(
    ("posting", "expected"),
    [
        ({"job_min_salary": 0}, "0"),
        ({"job_min_salary": 5000, "job_max_salary": 9000.5}, "5000 - 9000.5"),
        ({"job_max_salary": 9, "job_salary_currency": "SAR", "job_salary_period": "MONTH"}, "9 SAR / MONTH"),
        ({"job_min_salary": 1, "job_salary_currency": "", "job_salary_period": "HOUR"}, "1 / HOUR"),
        ({"job_salary_currency": "SAR"}, "N/A"),
    ],
)
def test_salary(spark, tmp_path, posting, expected):
    assert normalised(spark, tmp_path, [posting])[0].salary == expected


@pytest.mark.parametrize(
    ("posting", "expected"),
    [
        ({"job_required_skills": ["SQL", " Git ", ""]}, "SQL, Git"),
        ({"job_required_skills": ["SQL", "SQL"]}, "SQL, SQL"),
        ({"job_required_skills": ["  "]}, ""),
        ({"job_required_skills": [None, 3]}, "None, 3"),
        ({"job_required_skills": "Python and SQL"}, "Python and SQL"),
        ({"job_required_skills": [], "job_title": "Java dev", "job_description": "sql"}, "SQL, Java"),
        ({"job_title": "Cook"}, "N/A"),
    ],
)
def test_skills(spark, tmp_path, posting, expected):
    assert normalised(spark, tmp_path, [posting])[0].skills == expected


@pytest.mark.parametrize(
    ("experience", "expected"),
    [
        ({"no_experience_required": True, "required_experience_in_months": 5}, "No experience required"),
        ({"no_experience_required": False, "required_experience_in_months": 24}, "24 months experience"),
        ({"required_experience_in_months": 0, "experience_mentioned": True}, "Experience mentioned (unspecified)"),
        ({}, "N/A"),
        (None, "N/A"),
    ],
)
def test_experience(spark, tmp_path, experience, expected):
    assert normalised(spark, tmp_path, [{"job_required_experience": experience}])[0].experience_level == expected


@pytest.mark.parametrize(
    ("city", "country", "expected"),
    [
        (" Jeddah ", "SA", "Jeddah, Saudi Arabia"),
        (" ", None, ""),
        ("", "AE", "AE"),
        (None, None, "N/A"),
    ],
)
def test_location(spark, tmp_path, city, country, expected):
    row = normalised(spark, tmp_path, [{"job_city": city, "job_country": country}])[0]
    assert row.location == expected
    assert row.city == (city or "N/A")


def test_link_falls_back(spark, tmp_path):
    rows = normalised(
        spark, tmp_path,
        [{"job_apply_link": "", "job_google_link": "g"}, {"job_apply_link": "a", "job_google_link": "g"}, {}],
    )
    assert [r.apply_link for r in rows] == ["g", "a", ""]


def test_batch_keeps_the_first_posting_of_the_first_file(spark, tmp_path):
    write(tmp_path / "in", "b.json", [{"job_title": "second file", "job_apply_link": "L"}])
    write(
        tmp_path / "in", "a.json",
        [{"job_title": "x"}, {"job_title": "first file sql", "job_apply_link": " l"}, {"job_title": "X "}],
    )
    rows = landing.postings(landing.read_payloads(spark, str(tmp_path / "in")))
    got = bronze.batch(rows.withColumn("ingest_run", F.lit(1)), "2024-03-01 08:30:00", landing.FILE_ORDER)
    assert sorted((r.job_title, r.skills) for r in got.collect()) == [("first file sql", "SQL"), ("x", "N/A")]


@pytest.mark.parametrize("build", [fixtures.raw_jobs, fixtures.landing])
def test_a_task_widens_and_ranks_a_bounded_number_of_rows(spark, sf_dir, monkeypatch, build):
    whole = build(spark, sf_dir).select("ingest_seq").collect()
    monkeypatch.setattr(tables, "ROWS_PER_TASK", 50)
    dealt = build(spark, sf_dir)
    sizes = [r["count"] for r in dealt.groupBy(F.spark_partition_id()).count().collect()]
    assert max(sizes) < 110 < len(whole) / spark.sparkContext.defaultParallelism
    assert sorted(dealt.select("ingest_seq").collect()) == sorted(whole)
