"""Landing files: one JSON document per file with the postings nested in ``data.jobs``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Row order of everything that came from files: run, file, place in the file.
FILE_ORDER = ["ingest_run", "ingest_file", "ingest_pos"]

POSTING = T.StructType(
    [
        T.StructField("job_title", T.StringType()),
        T.StructField("job_description", T.StringType()),
        T.StructField("employer_name", T.StringType()),
        T.StructField("job_city", T.StringType()),
        T.StructField("job_country", T.StringType()),
        T.StructField("job_employment_type", T.StringType()),
        T.StructField("job_posted_at", T.StringType()),
        T.StructField("job_apply_link", T.StringType()),
        T.StructField("job_google_link", T.StringType()),
        T.StructField("job_salary_currency", T.StringType()),
        T.StructField("job_salary_period", T.StringType()),
        # Numbers are read as text, which keeps the way they were written.
        T.StructField("job_min_salary", T.StringType()),
        T.StructField("job_max_salary", T.StringType()),
        # An array, a scalar or nothing; read as raw JSON text.
        T.StructField("job_required_skills", T.StringType()),
        T.StructField(
            "job_required_experience",
            T.StructType(
                [
                    T.StructField("no_experience_required", T.BooleanType()),
                    T.StructField("required_experience_in_months", T.StringType()),
                    T.StructField("experience_mentioned", T.BooleanType()),
                ]
            ),
        ),
    ]
)
PAYLOAD = T.StructType(
    [T.StructField("data", T.StructType([T.StructField("jobs", T.ArrayType(POSTING))]))]
)


# Files of one folder sort by when they landed, then by path.
_LANDED = "_metadata.file_modification_time"
TIME_SHOWN = "yyyy-MM-dd HH:mm:ss"


# Holds the text of a file that is no payload.
CORRUPT = "corrupt"


class TooManyRejects(ValueError):
    pass


def _from_files(reader, path: str, reject: bool) -> DataFrame:
    """A file that is no JSON document stops the read: left out, its postings would be lost.

    With ``reject`` it becomes a row of its own, its text in :data:`CORRUPT`.
    """
    schema = T.StructType([*PAYLOAD.fields, *([T.StructField(CORRUPT, T.StringType())] if reject else [])])
    reader = reader.schema(schema).option("multiLine", True).option("mode", "PERMISSIVE" if reject else "FAILFAST")
    rows = reader.option("columnNameOfCorruptRecord", CORRUPT).json(path)
    name = F.concat_ws(
        " ", F.date_format(_LANDED, "yyyyMMddHHmmss.SSSSSS"), F.col("_metadata.file_path")
    )
    shown = [F.col(f.name) for f in schema.fields]
    return rows.select(*shown, name.alias("ingest_file"), F.date_format(_LANDED, TIME_SHOWN).alias("landed_at"))


def read_payloads(spark: SparkSession, path: str, reject: bool = False) -> DataFrame:
    return _from_files(spark.read, path, reject)


def stream_payloads(spark: SparkSession, path: str, files_per_batch: int = 1000, reject: bool = False) -> DataFrame:
    return _from_files(spark.readStream.option("maxFilesPerTrigger", files_per_batch), path, reject)


def split_rejects(payloads: DataFrame, most: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Payloads that were read, and the files that were not (``ingest_file``, ``landed_at``, their text).

    ``payloads`` was read with ``reject`` and is stored, so that files are parsed once.  More than
    ``most`` such files raise.
    """
    rejects = payloads.where(F.col(CORRUPT).isNotNull()).select("ingest_file", "landed_at", CORRUPT)
    if most is not None and (found := rejects.count()) > most:
        raise TooManyRejects(f"{found} files are no payload, at most {most} may be")
    return payloads.where(F.col(CORRUPT).isNull()).drop(CORRUPT), rejects


def postings(payloads: DataFrame) -> DataFrame:
    """One row per element of ``data.jobs``; a missing level gives no rows.

    The other columns of ``payloads`` are kept, with the place in the array beside them.
    """
    keep = [c for c in payloads.columns if c != "data"]
    return payloads.select(
        *keep, F.posexplode("data.jobs").alias("ingest_pos", "posting")
    ).select(*keep, F.col("ingest_pos").cast("bigint").alias("ingest_pos"), "posting.*")
