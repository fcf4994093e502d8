"""Postings derived from the given tables, messy on purpose.

The column expressions are plain SQL that Spark and the checking engine both accept, so both
sides of a check start from the same text.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmill.sources.tables import at_most, spread

# One row per order.  A part is picked by the order number, over the whole part table.
BASE_SQL = """
SELECT o.k, o.o_orderdate, c_name, n_name, p_name, p_brand
FROM (SELECT o_orderkey AS k, o_custkey, o_orderdate,
             o_orderkey % (SELECT count(*) FROM part) AS part_ref FROM orders) o
JOIN customer ON o.o_custkey = c_custkey
JOIN nation ON c_nationkey = n_nationkey
JOIN part ON p_partkey = o.part_ref
"""

RAW_JOBS_COLUMNS = {
    "ingest_seq": "k",
    "source": "CASE k % 3 WHEN 0 THEN 'JSearch' WHEN 1 THEN ' JSearch ' ELSE 'N/A' END",
    "job_title": "CASE k % 13 WHEN 0 THEN 'Senior  Data Engineer' WHEN 1 THEN 'QA Intern' WHEN 2 THEN 'Senior Lead Developer' WHEN 3 THEN 'Team Lead - Cloud' WHEN 4 THEN 'Sales manger' WHEN 5 THEN 'Director of Data' WHEN 6 THEN 'Principal Analyst' WHEN 7 THEN 'Entry-level Tester' WHEN 8 THEN ' Data Analyst' WHEN 9 THEN 'BI Developer (Remote)' WHEN 10 THEN 'Sr. Accountant' WHEN 11 THEN 'Nurse Jeddah' ELSE 'N/A' END",
    "company": "CASE k % 7 WHEN 0 THEN lower(c_name) WHEN 1 THEN 'N/A' WHEN 2 THEN concat('  ', c_name, ' ') WHEN 3 THEN 'o''reilly  media' WHEN 4 THEN '   ' ELSE concat('Company ', cast(k % 50 AS string)) END",
    "city": "CASE k % 5 WHEN 0 THEN 'Riyadh' WHEN 1 THEN 'N/A' WHEN 2 THEN NULL WHEN 3 THEN '  ' ELSE n_name END",
    "location": "CASE k % 4 WHEN 0 THEN 'Al Khobar, Saudi Arabia' WHEN 1 THEN concat(n_name, ', Saudi Arabia') WHEN 2 THEN 'Saudi Arabia' ELSE 'N/A' END",
    "employment_type": "CASE k % 6 WHEN 0 THEN 'Full time' WHEN 1 THEN 'FULLTIME' WHEN 2 THEN ' part-time' WHEN 3 THEN 'Contractor' WHEN 4 THEN 'دوام كامل' ELSE 'NA' END",
    "salary": "CASE k % 3 WHEN 0 THEN concat(cast(k % 9000 AS string), ' SAR / MONTH') WHEN 1 THEN 'N/A' ELSE NULL END",
    "skills": "CASE k % 5 WHEN 0 THEN 'SQL, Python,  SQL ,, Git' WHEN 1 THEN concat(p_name, ',', p_brand) WHEN 2 THEN ' , ' WHEN 3 THEN 'sql,SQL' ELSE 'N/A' END",
    "experience_level": "CASE k % 4 WHEN 0 THEN 'N/A' WHEN 1 THEN '24 months experience' WHEN 2 THEN 'Senior' ELSE 'No experience required' END",
    "apply_link": "CASE WHEN k % 9 = 0 THEN '' WHEN k % 9 = 1 THEN NULL WHEN k % 9 = 2 THEN ' ' ELSE concat('https://example.com/JOB/', cast(k % 4001 AS string)) END",
    "posted_at": "CASE k % 16 WHEN 0 THEN 'اليوم' WHEN 1 THEN 'أمس' WHEN 2 THEN 'قبل يومين' WHEN 3 THEN concat('قبل ', cast(k % 59 AS string), ' دقيقة') WHEN 4 THEN concat('قبل ', cast(k % 23 AS string), ' ساعات') WHEN 5 THEN concat('قبل ', cast(k % 27 AS string), ' أيام') WHEN 6 THEN 'قبل أسبوع' WHEN 7 THEN 'قبل أسبوعين' WHEN 8 THEN 'قبل ٣ أسابيع' WHEN 9 THEN '2024-01-05' WHEN 10 THEN '2024-01-05T10:00:00Z' WHEN 11 THEN 'قبل ساعة' WHEN 12 THEN 'قبل 30+ يوم' WHEN 13 THEN 'N/A' WHEN 14 THEN '3 days ago' ELSE NULL END",
    "fetched_at": "CASE WHEN k % 31 = 0 THEN 'N/A' ELSE concat(substr(cast(o_orderdate AS string), 1, 10), ' 08:30:00') END",
    "description": "CASE k % 8 WHEN 0 THEN '<p>Needs 3-5 years with Python &amp; SQL.</p>' WHEN 1 THEN 'Minimum 7 years of experience, Remote' WHEN 2 THEN 'At least 1 year. Based in MAKKAH' WHEN 3 THEN '&lt;b&gt;10+ years&lt;/b&gt;' WHEN 4 THEN ' <br/> ' WHEN 5 THEN 'R&D team uses Git, C++ and C#' WHEN 6 THEN 'N/A' ELSE concat('Works on ', p_name, ' in Hafar Al-Batin') END",
}

LANDING_COLUMNS = {
    "ingest_seq": "k",
    "job_title": "CASE k % 7 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE concat('Python Analyst ', cast(k % 40 AS string)) END",
    "job_description": "CASE k % 6 WHEN 0 THEN NULL WHEN 1 THEN 'R&D with C++ and Node.js' WHEN 2 THEN 'CI/CD, docker, AWS and power bi' ELSE concat('Handles ', p_name) END",
    "employer_name": "CASE k % 9 WHEN 0 THEN NULL ELSE c_name END",
    "job_min_salary": "CASE k % 4 WHEN 0 THEN NULL WHEN 1 THEN '0' ELSE cast(k % 9000 AS string) END",
    "job_max_salary": "CASE k % 3 WHEN 0 THEN NULL ELSE cast(k % 9000 + 500 AS string) END",
    "job_salary_currency": "CASE k % 2 WHEN 0 THEN 'SAR' ELSE '' END",
    "job_salary_period": "CASE k % 5 WHEN 0 THEN 'MONTH' ELSE NULL END",
    "job_required_skills": "CASE k % 5 WHEN 0 THEN '[\"SQL\",\" Git \",\"\"]' WHEN 1 THEN 'Python and SQL' WHEN 2 THEN '[]' ELSE NULL END",
    "no_experience_required": "CASE k % 4 WHEN 0 THEN true WHEN 1 THEN false ELSE NULL END",
    "required_experience_in_months": "CASE k % 5 WHEN 0 THEN 0 WHEN 1 THEN 24 WHEN 2 THEN 60 ELSE NULL END",
    "experience_mentioned": "CASE k % 3 WHEN 0 THEN true ELSE false END",
    "job_city": "CASE k % 6 WHEN 0 THEN NULL WHEN 1 THEN ' ' WHEN 2 THEN ' Jeddah ' ELSE n_name END",
    "job_country": "CASE k % 4 WHEN 0 THEN NULL WHEN 1 THEN 'AE' ELSE 'SA' END",
    "job_employment_type": "CASE k % 3 WHEN 0 THEN 'Full-time' WHEN 1 THEN '' ELSE NULL END",
    "job_posted_at": "CASE k % 3 WHEN 0 THEN 'قبل يومين' WHEN 1 THEN '' ELSE NULL END",
    "job_apply_link": "CASE k % 4 WHEN 0 THEN '' WHEN 1 THEN NULL WHEN 2 THEN concat(' https://example.com/Job/', cast(k % 701 AS string)) ELSE concat('https://example.com/job/', cast(k % 701 AS string), ' ') END",
    "job_google_link": "CASE k % 8 WHEN 0 THEN concat('https://example.com/g/', cast(k % 301 AS string)) ELSE NULL END",
}

# Postings of orders before this day are the history, the others are the newer batch.
HISTORY_END = "1999-01-01"
FETCHED_AT = "2024-03-01 08:30:00"

ORDER = ["ingest_seq"]

# Spellings of a time -> what they tell of it.  "swapped": day first, which is read month first
# where that gives a date.  "none": outside the years that are read.
SPELLINGS = [
    ("yyyyMMdd", "day"),
    ("yyyyMMddHHmmss", "second"),
    ("yyyy/M/d", "day"),
    ("M/d/yyyy", "day"),
    ("d/M/yyyy", "swapped"),
    ("M/d/yyyy H:mm", "minute"),
    ("M/d/yyyy H:mm:ss", "second"),
    ("yyyy.M.d", "day"),
    ("M-d-yyyy", "day"),
    ("M.d.yyyy", "day"),
    ("M/d/yy", "day"),
    ("yyyy-M-d h:mm a", "minute"),
    ("yyyy-M-d h:mm:ss a", "second"),
    ("M/d/yyyy h:mm a", "minute"),
    ("M/d/yyyy h:mm:ss a", "second"),
    ("d MMM yyyy H:mm", "minute"),
    ("d MMMM yyyy H:mm", "minute"),
    ("d MMM yyyy H:mm:ss", "second"),
    ("d MMM yyyy", "day"),
    ("d MMMM yyyy", "day"),
    ("MMM d, yyyy", "day"),
    ("MMM d, yyyy H:mm", "minute"),
    ("MMMM d, yyyy", "day"),
    ("MMMM d, yyyy H:mm", "minute"),
    ("MMM d yyyy", "day"),
    ("MMMM d yyyy", "day"),
    ("MMM yyyy", "month"),
    ("MMMM yyyy", "month"),
    ("yyyy-MM-dd", "day"),
    ("yyyy-MM-dd HH:mm:ss", "second"),
    ("yyyy-MM-dd'T'HH:mm'Z'", "minute"),
    ("yyyy-MM", "month"),
    ("yyyy", "year"),
    ("EEE, dd MMM yyyy HH:mm:ss 'GMT'", "second"),
    ("'1500'-MM-dd", "none"),
    ("'2300'-MM-dd", "none"),
]


def select_sql(columns: dict[str, str], source: str, extra: str = "") -> str:
    listed = ",\n  ".join(f"{e} AS {n}" for n, e in columns.items())
    return f"SELECT {listed}{extra} FROM ({source}) base"


def raw_jobs_sql() -> str:
    return select_sql(RAW_JOBS_COLUMNS, BASE_SQL, ",\n  o_orderdate")


def landing_sql() -> str:
    return select_sql(LANDING_COLUMNS, BASE_SQL)


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _from_tables(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    tables = {n: read(spark, sf_dir, n) for n in ("orders", "customer", "nation", "part")}
    columns = ["o_orderkey", "o_custkey", "o_orderdate"]
    rows = tables["orders"].count()
    tables["orders"] = spread(tables["orders"].select(*columns))
    joined = BASE_SQL
    for name in tables:
        joined = joined.replace(f"FROM {name}", f"FROM {{{name}}}").replace(
            f"JOIN {name}", f"JOIN {{{name}}}"
        )
    # Joined rows are a tenth as wide as the postings made of them: dealt out while they are narrow.
    base = at_most(spark.sql(joined, **tables), rows, "k")
    return spark.sql(sql.replace(f"({BASE_SQL})", "{base}"), base=base)


def raw_jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """History-shaped rows with their row order, and the order date to split them by."""
    return _from_tables(spark, sf_dir, raw_jobs_sql())


def _as_array(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    yield pd.DataFrame({"value": ["["]})
    first = True
    for batch in batches:
        lines = [("" if first and i == 0 else ",") + line for i, line in enumerate(batch["value"])]
        first = first and not lines
        yield pd.DataFrame({"value": lines})
    yield pd.DataFrame({"value": ["]"]})


def write_arrays(rows: DataFrame, folder: str) -> None:
    """Each partition as a file that is one JSON array."""
    lines = rows.select(F.to_json(F.struct(*rows.columns), {"ignoreNullFields": "false"}).alias("value"))
    lines.mapInPandas(_as_array, "value string").write.text(folder)


def spelled_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each order's time in one of the spellings."""
    orders = spread(read(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate"))
    time = F.col("o_orderdate").cast("timestamp") + F.make_dt_interval(secs=F.col("o_orderkey") % 86_400)
    which = F.col("o_orderkey") % len(SPELLINGS)
    spelled = F.coalesce(*[F.when(which == i, F.date_format(time, f)) for i, (f, _) in enumerate(SPELLINGS)])
    fetched = F.lit(FETCHED_AT).cast("timestamp")
    return orders.select("o_orderkey", spelled.alias("spelled"), fetched.alias("fetched_at"))


def history_and_batch(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """All raw postings in two runs: older orders, then newer ones."""
    rows = raw_jobs(spark, sf_dir)
    older = F.col("o_orderdate") < F.lit(HISTORY_END).cast("timestamp")
    run = F.when(older, F.lit(1)).otherwise(F.lit(2)).cast("bigint")
    marked = rows.withColumn("ingest_run", run).drop("o_orderdate")
    return marked.where("ingest_run = 1"), marked.where("ingest_run = 2")


def landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payload-shaped rows: the postings nested in ``data.jobs``."""
    flat = _from_tables(spark, sf_dir, landing_sql())
    experience = [
        F.col("no_experience_required"),
        F.col("required_experience_in_months").cast("string").alias("required_experience_in_months"),
        F.col("experience_mentioned"),
    ]
    inside = {"no_experience_required", "required_experience_in_months", "experience_mentioned"}
    posting = F.struct(
        *[F.col(c) for c in LANDING_COLUMNS if c not in inside and c != "ingest_seq"],
        F.struct(*experience).alias("job_required_experience"),
    )
    return flat.select("ingest_seq", F.struct(F.array(posting).alias("jobs")).alias("data"))
