import hashlib

import pytest
from pyspark.sql import functions as F

from starmill.operators import keys


def test_numbers_are_dense_and_in_hash_order(spark):
    df = spark.range(5_000).select(F.concat(F.lit("name "), "id").alias("n"))
    got = {r.n: r.k for r in keys.number_keys(df, ["n"], "k", start=100).collect()}
    by_hash = sorted(got, key=lambda n: hashlib.sha256(("v" + n).encode()).hexdigest())
    assert [got[n] for n in by_hash] == list(range(101, 5_101))
    few = keys.number_keys(df, ["n"], "k", start=100, bucket_digits=1)
    assert {r.n: r.k for r in few.collect()} == got


def test_null_and_blank_are_different_keys(spark):
    df = spark.createDataFrame([(None, "X"), ("", "X"), ("X", None), ("X", "")], "a string, b string")
    got = keys.number_keys(df, ["a", "b"], "k").collect()
    assert sorted(r.k for r in got) == [1, 2, 3, 4]
    assert df.select(keys.key_hash(["a", "b"])).distinct().count() == 4


def test_absent(spark):
    old = spark.createDataFrame([(None, "X"), ("a", "b")], "a string, b string")
    new = spark.createDataFrame([(None, "X"), ("", "X"), ("a", "b"), ("a", None)], "a string, b string")
    got = keys.absent(new, old, ["a", "b"], null_safe=True).collect()
    assert sorted((r.a, r.b or "") for r in got) == [("", "X"), ("a", "")]


@pytest.mark.parametrize("how", ["left", "inner"])
@pytest.mark.parametrize("null_safe", [False, True])
def test_spread_lookup_equals_broadcast_lookup(spark, how, null_safe):
    """A third of the rows share one key, another third have none."""
    kind = F.col("id") % 3
    rows = spark.range(30_000, numPartitions=6).select(
        "id",
        F.when(kind == 0, F.lit("hot")).when(kind == 1, F.concat(F.lit("k"), F.col("id") % 500)).alias("name"),
    )
    names = rows.select("name").distinct()
    if not null_safe:
        names = names.where("name IS NOT NULL")
    dimension = keys.number_keys(names.where("name IS NULL OR name <> 'k10'"), ["name"], "key")

    def look(limit, split):
        found = keys.lookup(
            rows, dimension, ["name"], ["id"], how, null_safe, broadcast_bytes=limit, rows_per_split=split
        )
        return found

    small, spread = look(1 << 30, 1_000), look(0, 1_000)
    assert spread.columns == small.columns == ["id", "name", "key"]
    assert sorted(map(repr, spread.collect())) == sorted(map(repr, small.collect()))


def test_frequent_keys_are_spread_however_many_they_are(spark):
    rows = spark.range(90_000).select(
        "id", F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("k")
    )
    frequent = keys.frequent_keys(rows, ["k"], rows_per_split=1_000).collect()
    assert [(r["__f_k"], r["__splits"]) for r in frequent] == [(0, 30)]
    many = spark.range(10_000).select((F.col("id") % 100).alias("k"))
    assert keys.frequent_keys(many, ["k"], rows_per_split=10).count() == many.groupBy("k").count().where("count > 10").count() > 7


def test_hot_key_does_not_meet_in_one_task(spark):
    rows = spark.range(60_000, numPartitions=4).select("id", F.lit("hot").alias("name"))
    dimension = spark.createDataFrame([("hot", 1)], "name string, key bigint")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        found = keys.lookup(
            rows, dimension, ["name"], ["id"], broadcast_bytes=0, rows_per_split=2_000
        )
        sizes = found.groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert sum(r["count"] for r in sizes) == 60_000
    assert max(r["count"] for r in sizes) < 30_000


def test_measured_bytes_counts_the_text(spark):
    df = spark.range(1000).select("id", F.repeat(F.lit("x"), 500).alias("t"))
    assert keys.measured_bytes(df) >= 500_000
    assert keys.measured_bytes(df.limit(0)) == 0
