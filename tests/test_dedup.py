import pytest
from pyspark.sql import functions as F

from starmill.operators import dedup
from starmill.plans import bronze


def rows_of(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def test_keep_first_and_last_follow_the_order_column(spark):
    df = spark.createDataFrame(
        [(3, "a", None), (1, "a", None), (2, "a", "x"), (4, None, None), (5, None, None)],
        "n int, k string, l string",
    ).repartition(5)
    assert rows_of(dedup.keep_first(df, ["k", "l"], ["n"]), "n") == [(1,), (2,), (4,)]
    assert rows_of(dedup.keep_last(df, ["k", "l"], ["n"]), "n") == [(2,), (3,), (5,)]


def test_a_hot_key_is_cut_before_the_shuffle(spark):
    df = spark.range(300_000, numPartitions=16).select(
        "id", F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("k")
    )
    first = dedup.keep_first(df, ["k"], ["id"])
    plan = first._jdf.queryExecution().executedPlan().toString()
    before_shuffle = plan[plan.index("Exchange hashpartitioning") :]
    assert "WindowGroupLimit" in before_shuffle
    assert first.count() == 200_001
    assert first.where("k = 'hot'").first().id == 0


def postings(spark, rows):
    return spark.createDataFrame(
        rows, "ingest_seq int, apply_link string, job_title string, company string, location string"
    )


def test_batch_identity(spark):
    df = postings(
        spark,
        [
            (1, " HTTP://x ", "a", "c", "l"),
            (2, "http://X", "b", "c", "l"),
            (3, "", "Dev ", "C", "L"),
            (4, "  ", "dev", "c", " l"),
            (5, None, "dev", "c", "m"),
            (6, None, None, "c", "m"),
            (7, None, "none", "c", "m"),
        ],
    )
    assert rows_of(dedup.keep_first(df, dedup.batch_identity(), ["ingest_seq"]), "ingest_seq") == [
        (1,), (3,), (5,), (6,),
    ]


@pytest.mark.parametrize("unique", [False, True])
def test_merge_keeps_the_newest(spark, unique):
    history = postings(
        spark,
        [
            (1, "A", "old", "c", "l"),
            (2, "a", "other link", "c", "l"),
            (3, None, "t", "c", "l"),
            (4, " ", "t2", None, "l"),
        ],
    )
    newer = postings(
        spark,
        [
            (5, "A", "new", "c", "l"),
            (6, "", "t", "c", "l"),
            (7, None, "t2", None, "l"),
            (8, None, "t3", "c", "l"),
            (9, None, "t3", "c", "l"),
            (10, "A ", "padded link", "c", "l"),
        ],
    )
    merged = bronze.merge(history, newer, ["ingest_seq"], history_is_unique=unique)
    assert rows_of(merged, "ingest_seq") == [(10,), (2,), (5,), (6,), (7,), (9,)]
    again = bronze.merge(merged, newer, ["ingest_seq"], history_is_unique=unique)
    assert rows_of(again, "ingest_seq") == rows_of(merged, "ingest_seq")


def test_merge_of_a_unique_history_does_not_rank_it(spark):
    history = postings(spark, [(1, "A", "t", "c", "l")])
    newer = postings(spark, [(2, "A", "t", "c", "l")])
    merged = bronze.merge(history, newer, ["ingest_seq"], history_is_unique=True, newer_is_unique=True)
    assert "Window" not in merged._jdf.queryExecution().executedPlan().toString()


def test_backfill(spark):
    from starmill import rules
    from starmill.operators.schema import MissingColumns

    def table(rows, columns):
        return spark.createDataFrame(rows, ", ".join(f"{c} string" for c in columns))

    old = table([tuple("x" if c != "apply_link" else "L" for c in rules.BRONZE_COLUMNS)], rules.BRONZE_COLUMNS)
    old = old.withColumn("id", F.lit(7)).withColumn("ingest_seq", F.lit(1))
    existing = table([("L", "new")], ["apply_link", "job_title"]).withColumn("ingest_seq", F.lit("2"))
    result = bronze.backfill(old, existing.withColumn("ingest_seq", F.lit(2)), ["ingest_seq"]).collect()
    assert [(r.job_title, r.salary) for r in result] == [("new", None)]
    assert bronze.backfill(old, None, ["ingest_seq"]).first().salary == "x"
    with pytest.raises(MissingColumns, match="salary"):
        bronze.backfill(old.drop("salary"), None, ["ingest_seq"])


def test_count_duplicates_counts_null_keys(spark):
    df = spark.createDataFrame([(None, 1), (None, 1), ("a", 2)], "k string, v int")
    assert tuple(dedup.count_duplicates(df, ["k"]).first()) == (3, 2, 1)
    assert tuple(dedup.count_duplicates(df.limit(0), ["k"]).first()) == (0, 0, 0)
