from pyspark.sql import functions as F

from starmill.operators import quality
from starmill.operators.schema import describe


def frame(spark):
    return spark.createDataFrame(
        [("a", " x", True, 1), (None, "y  z", False, 1), ("bad", "w ", None, 2), ("a", " ", True, 2)],
        "level string, text string, flag boolean, k int",
    )


def rows(df):
    return {r[0]: tuple(r)[1:] for r in df.collect()}


def test_nulls(spark):
    assert rows(quality.nulls(frame(spark), ["level", "flag", "k"])) == {
        "level": (4, 1, 25.0), "flag": (4, 1, 25.0), "k": (4, 0, 0.0),
    }
    assert rows(quality.nulls(frame(spark).limit(0), ["k"])) == {"k": (0, 0, None)}


def test_value_counts(spark):
    got = {(r.column_name, r.value): r.n for r in quality.value_counts(frame(spark), ["level", "flag"]).collect()}
    assert got == {
        ("level", "a"): 2, ("level", None): 1, ("level", "bad"): 1,
        ("flag", "true"): 2, ("flag", "false"): 1, ("flag", None): 1,
    }


def test_checks(spark):
    df = frame(spark)
    assert rows(quality.required_checks(df, ["level", "text"])) == {"level": (1, "WARNING"), "text": (0, "PASS")}
    assert rows(quality.duplicate_check(df, ["k"])) == {"duplicates": (2, "WARNING")}
    assert rows(quality.domain_checks(df, {"level": ["a"], "k": [1, 2]})) == {
        "level": (1, "WARNING"), "k": (0, "PASS"),
    }
    assert [r.value for r in quality.outside_domain(df, "level", ["a"]).collect()] == ["bad"]
    assert rows(quality.boolean_checks(df, ["flag"])) == {"flag": ("PASS",)}


def test_whitespace(spark):
    assert rows(quality.whitespace_checks(frame(spark), ["text", "level"])) == {
        "text": (2, 2, 1, "WARNING"), "level": (0, 0, 0, "PASS"),
    }


def test_recovered(spark):
    df = frame(spark).withColumn("after", F.coalesce("level", F.lit("z")))
    assert rows(quality.recovered(df, {"level": (F.col("level"), F.col("after"))})) == {"level": (1, 0, 1)}


def test_counts_and_shape(spark):
    df = frame(spark)
    assert rows(quality.row_counts({"t": df, "u": df.limit(1)})) == {"t": (4,), "u": (1,)}
    assert tuple(quality.shape(df).first()) == (4, 4)


def test_describe_counts_values_per_column(spark):
    rows = spark.createDataFrame([(1, None), (None, None), (3, "x")], "`a.b` int, c string")
    assert [tuple(r) for r in describe(rows).collect()] == [(1, "a.b", "int", 2), (2, "c", "string", 1)]
    assert [r.non_null for r in describe(rows.limit(0)).collect()] == [0, 0]
