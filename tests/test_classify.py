import pytest
from pyspark.sql import functions as F

from starmill.functions import classify as C


def level(spark, title, description, current=None):
    df = spark.createDataFrame([(title, description, current)], "t string, d string, l string")
    return C.with_level(df, "l", "t", "d").first().l


def test_known_levels_stay_and_others_are_derived(spark):
    assert level(spark, "Intern", None, "Director") == "Director"
    assert level(spark, "Intern", None, "director") == "Intern"
    assert level(spark, "X", None, "24 months experience") is None


@pytest.mark.parametrize(
    ("title", "description", "expected"),
    [
        ("Internship, summer", None, "Intern"),
        ("International", None, None),
        ("Senior  Lead Dev", None, "Senior Lead"),
        ("Lead, senior", None, "Senior"),
        ("PRINCIPAL senior", None, "Principal"),
        ("Sr. Dev", None, "Senior"),
        ("Team Lead", None, "Lead"),
        ("leader", None, "Lead"),
        ("Sales manger", None, "Manager"),
        ("Director", None, "Director"),
        ("entry level", None, "Junior"),
        ("Jr.", None, "Junior"),
        ("X", "3-5 years", "Mid Level"),
        ("X", "3 to 5 YEARS", "Mid Level"),
        ("X", "10+ years", "Senior"),
        ("X", "at least 1 year", "Junior"),
        ("X", "minimum  6 years", "Senior"),
        ("X", "2 years of experience", "Junior"),
        ("X", "2 years experiences", None),
        ("X", "over 2 years", None),
        ("X", "v3-5 years", None),
        ("X", "1+ years, 6-8 years", "Senior"),
        ("X", "99999999999999999999+ years", "Senior"),
        ("X", "٣+ years", "Mid Level"),
        (None, None, None),
    ],
)
def test_level(spark, title, description, expected):
    assert level(spark, title, description) == expected


@pytest.mark.parametrize(
    ("city", "text", "expected"),
    [
        (None, "Al Khobar, Saudi Arabia", "Khobar"),
        ("", "Riyadh", ""),
        (None, "in MAKKAH and Riyadh", "Riyadh"),
        (None, "Riyadhi", None),
        (None, "x_Taif", None),
        (None, "hafar al-batin.", "Hafar Al-Batin"),
        (None, None, None),
    ],
)
def test_city(spark, city, text, expected):
    df = spark.createDataFrame([(city, text)], "c string, t string")
    got = df.select(C.recovered_city(F.col("c"), F.lit(None).cast("string"), F.col("t")).alias("o"))
    assert got.first().o == expected


@pytest.mark.parametrize(
    ("title", "text", "expected"),
    [
        ("BI (Remote)", None, True),
        (None, "REMOTE.", True),
        ("remotely", "x_remote", False),
        (None, None, False),
        ("re", "mote", False),
    ],
)
def test_remote(spark, title, text, expected):
    df = spark.createDataFrame([(title, text)], "a string, b string")
    assert df.select(C.is_remote(F.col("a"), F.col("b")).alias("o")).first().o is expected
