"""Tables, record files, gates and stage results."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmill.operators.schema import nan_to_null

ISO_TIMESTAMP = "yyyy-MM-dd'T'HH:mm:ss.SSSXXX"


class EmptySource(ValueError):
    pass


class CountMismatch(ValueError):
    pass


# --- reading ---------------------------------------------------------------------------


def read_records(spark: SparkSession, path: str, schema: T.StructType | str, array_file: bool = False) -> DataFrame:
    """JSON records: one per line, or (``array_file``) one JSON array per file.

    The schema is given, so the files are read once and the columns keep their order.
    """
    return spark.read.schema(schema).option("multiLine", array_file).json(path)


def spread(scan: DataFrame) -> DataFrame:
    """A scan with fewer splits than the session has cores, dealt out to all of them.

    For small inputs ahead of heavy per-row work.  A scan with enough splits, as any large
    one has, is returned as it is and costs no shuffle.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan.repartition(cores) if scan.rdd.getNumPartitions() < cores else scan


#: Rows that one task should widen and rank; some hundreds of bytes each are held while it sorts.
ROWS_PER_TASK = 300_000


def at_most(df: DataFrame, rows: int, *by: str) -> DataFrame:
    """``df``, which has ``rows`` rows, dealt out by distinct keys so that no task gets many more than :data:`ROWS_PER_TASK`.

    For narrow rows ahead of steps that widen and sort them: a split of a well packed table or
    a merged shuffle partition holds rows by their packed bytes, in the end millions.  Tables with
    few enough rows for the session's cores are returned as they are.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    rounds = -(-rows // (ROWS_PER_TASK * cores))
    return df.repartition(rounds * cores, *by) if rounds > 1 else df


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def path_exists(spark: SparkSession, path: str) -> bool:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where)


def require_rows(df: DataFrame, what: str) -> DataFrame:
    """``df`` itself; raises when it has no rows (stops at the first row found)."""
    if df.isEmpty():
        raise EmptySource(f"{what} has no rows")
    return df


def require_table(spark: SparkSession, name: str) -> DataFrame:
    if not spark.catalog.tableExists(name):
        raise EmptySource(f"table {name} does not exist")
    return require_rows(spark.table(name), f"table {name}")


def require_path(spark: SparkSession, path: str, fmt: str = "parquet", schema=None) -> DataFrame:
    reader = spark.read.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    try:
        df = reader.load(path)
    except AnalysisException as error:
        raise EmptySource(f"cannot read {path}") from error
    return require_rows(df, path)


def require_count(df: DataFrame, expected: int, what: str) -> DataFrame:
    actual = df.count()
    if actual != expected:
        raise CountMismatch(f"{what}: wrote {expected} rows, read back {actual}")
    return df


# --- writing ---------------------------------------------------------------------------


def write_records(df: DataFrame, path: str) -> None:
    """JSON lines in UTF-8, NULL (and NaN) as null fields, timestamps in ISO form."""
    (
        nan_to_null(df)
        .write.mode("overwrite")
        .option("ignoreNullFields", False)
        .option("timestampFormat", ISO_TIMESTAMP)
        .option("dateFormat", "yyyy-MM-dd")
        .json(path)
    )


def publish_table(
    df: DataFrame, name: str, fmt: str = "parquet", version: str | None = None, folder: str | None = None
) -> str:
    """Write ``df`` as a new version of table ``name`` and point the name at it.

    The version lies in the warehouse, or under ``folder``.

    The name is a view over the newest version, so ``df`` may read the table it replaces and
    readers see either the old rows or the new ones.  A format with its own versions
    ("delta") is overwritten in place.
    """
    spark = df.sparkSession
    if fmt == "delta":
        df.write.format(fmt).mode("overwrite").option("overwriteSchema", "true").saveAsTable(name)
        return name
    stored = f"{name}__{version or uuid.uuid4().hex[:12]}"
    writer = df.write.format(fmt).mode("overwrite")
    if folder is not None:
        writer = writer.option("path", f"{folder.rstrip('/')}/{stored}")
    writer.saveAsTable(stored)
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM {stored}")
    return stored


# --- stage results ---------------------------------------------------------------------


_OWN_FOLDERS: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names for checkpoints.

    Where none is named, one is made on the local disk, which is right only for a session
    that runs on one machine; elsewhere this raises.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    application = spark.sparkContext.applicationId
    if application not in _OWN_FOLDERS:
        _OWN_FOLDERS[application] = tempfile.mkdtemp(prefix="starmill-")
    return _OWN_FOLDERS[application]


def run_folder(spark: SparkSession, label: str) -> str:
    return f"{shared_folder(spark)}/starmill/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage with a columnar table: what follows reads only the columns it needs,
    and a lost executor costs no recomputation of the stage.
    """
    spark = df.sparkSession
    path = run_folder(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def stage_counted(df: DataFrame, label: str, keep: Column, **counts: Column) -> tuple[DataFrame, dict[str, int]]:
    """The rows where ``keep``, stored as by :func:`stage`, and aggregates over all rows of ``df``.

    The writing tasks count as they write: no shuffle lies between, so of a task that ran twice
    only one result counts.  An aggregate over no rows is 0.
    """
    seen = Observation()
    observed = df.observe(seen, *[column.alias(name) for name, column in counts.items()])
    stored = stage(observed.where(keep), label)
    return stored, {name: seen.get[name] or 0 for name in counts}


class StarStore:
    """The star schema's tables under one folder; a table not yet written reads as empty."""

    def __init__(self, spark: SparkSession, folder: str, schemas: dict[str, str], fmt: str = "parquet"):
        self.spark = spark
        self.folder = folder.rstrip("/")
        self.schemas = schemas
        self.fmt = fmt

    def read(self, name: str) -> DataFrame:
        reader = self.spark.read.format(self.fmt)
        if self.fmt != "delta":
            reader = reader.schema(self.schemas[name])
        if not path_exists(self.spark, f"{self.folder}/{name}"):
            return self.spark.createDataFrame([], self.schemas[name])
        return reader.load(f"{self.folder}/{name}")

    def append(self, name: str, rows: DataFrame) -> int:
        """Append the rows; returns how many, counted by the tasks that wrote them."""
        columns, seen = T.StructType.fromDDL(self.schemas[name]).names, Observation()
        counted = rows.select(*columns).observe(seen, F.count(F.lit(1)).alias("n"))
        counted.write.format(self.fmt).mode("append").save(f"{self.folder}/{name}")
        return seen.get["n"]

    def count(self, name: str) -> int:
        return self.read(name).count()

    def tables(self) -> dict[str, DataFrame]:
        return {name: self.read(name) for name in self.schemas}
