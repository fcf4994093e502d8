"""Session settings the plans rely on.

Only runtime SQL settings are touched, so the same call works on a session that a cluster
already made.  Sizes (partitions, memory) stay with whoever owns the cluster; adaptive
execution picks the shuffle width from the measured data.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

RUNTIME_SETTINGS = {
    # Zone-less timestamps are read as UTC everywhere.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Bad input becomes NULL through the try_ functions, never through silent casts.
    "spark.sql.ansi.enabled": "true",
    # The JVM does not compile methods above 8000 bytes; above that, plain projections whose
    # code is split into small methods are faster than one large interpreted method.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Bounds one Arrow batch when a batch of pages or descriptions goes to Python.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(64 * 1024 * 1024),
}


def configure(spark: SparkSession) -> SparkSession:
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: int | str = "*", memory: str = "8g", app: str = "starmill") -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)
