from datetime import datetime

import pytest
from pyspark.sql import functions as F

from starmill.functions import dates as D

FETCHED = "2024-03-01 08:30:00"


def posted(spark, values, fetched=FETCHED):
    df = spark.createDataFrame([(i, v, fetched) for i, v in enumerate(values)], "i int, v string, f string")
    df = df.withColumn("f", D.fetched_time(F.col("f")))
    rows = D.with_posted_time(df, "v", "f", "o").orderBy("i").collect()
    return [r.o for r in rows]


def at(text):
    return datetime.fromisoformat(text) if text else None


@pytest.mark.parametrize(
    "cases",
    [
        {
            "الآن": "2024-03-01 08:30:00",
            " اليوم ": "2024-03-01 08:30:00",
            "قبل قليل": "2024-03-01 08:30:00",
            "أمس": "2024-02-29 08:30:00",
            "امس": "2024-02-29 08:30:00",
            "قبل يوم": "2024-02-29 08:30:00",
            "قبل يوم واحد": "2024-02-29 08:30:00",
            "قبل يومين": "2024-02-28 08:30:00",
            "قبل 5 دقائق": "2024-03-01 08:25:00",
            "منذ قبل  12 ساعة تقريبا": "2024-02-29 20:30:00",
            "قبل 3 أيام": "2024-02-27 08:30:00",
            "قبل ٣ أسابيع": "2024-02-09 08:30:00",
            "قبل ۳ أسابيع": "2024-02-09 08:30:00",
            "قبل أسبوع": "2024-02-23 08:30:00",
            "قبل اسبوعين": "2024-02-16 08:30:00",
            "قبل 3 أيام قبل 2 ساعة": "2024-03-01 06:30:00",
            "قبل 007 أيام": "2024-02-23 08:30:00",
        },
        {
            "قبل ساعة": None,
            "قبل 30+ يوم": None,
            "قبل شهر": None,
            "3 days ago": None,
            "قبل 99999999999999999999 يوم": None,
            "قبل 9999999 يوم": None,
            "today": None,
            "10:30": None,
            "": None,
            "2024-02-30": None,
        },
        {
            "2024-01-05": "2024-01-05",
            "٢٠٢٤-٠١-٠٥": "2024-01-05",
            "2024-1-5": "2024-01-05",
            "2024-01": "2024-01-01",
            "2024": "2024-01-01",
            "2024-01-05T10:00:00Z": "2024-01-05 10:00:00",
            "2024-01-05 10:00:00+03:00": "2024-01-05 07:00:00",
            "2024-01-05T10:00:00+0300": "2024-01-05 07:00:00",
            "2024-01-05T10:00:00.250": "2024-01-05 10:00:00.250",
            "20240105": "2024-01-05",
            "20240105103000": "2024-01-05 10:30:00",
            "2024/1/5": "2024-01-05",
            "01/02/2024": "2024-01-02",
            "13/02/2024": "2024-02-13",
            "Jan 5, 2024": "2024-01-05",
            "JANUARY 5, 2024": "2024-01-05",
            "5 january 2024": "2024-01-05",
            "Jan 2024": "2024-01-01",
            "2024-01-05T10:00Z": "2024-01-05 10:00:00",
            "2024-01-05 10:00": "2024-01-05 10:00:00",
            "2024-01-05 9:05": "2024-01-05 09:05:00",
            "2024-01-05 10:00+03:00": "2024-01-05 07:00:00",
            "2024-01-05 10:00 +0300": "2024-01-05 07:00:00",
            "2024-01-05 10:00:00 UTC": "2024-01-05 10:00:00",
            "1500-01-01": None,
            "9999-12-31": None,
            "2262-04-11": "2262-04-11",
            "2262-04-12": None,
            "1677-09-22": "1677-09-22",
            "2024-01-05 10:00:07 pm": "2024-01-05 22:00:07",
            "13/02/2024 1:02:03 AM": "2024-02-13 01:02:03",
            "2/29/72": "1972-02-29",
            "1/5/68": "2068-01-05",
        },
    ],
)
def test_posted_time(spark, cases):
    assert dict(zip(cases, posted(spark, list(cases)))) == {k: at(v) for k, v in cases.items()}


def test_unknown_fetch_time_leaves_nothing(spark):
    assert posted(spark, ["2024-01-05", "اليوم", None], fetched="N/A") == [None, None, None]


def test_fetched_time_has_one_format(spark):
    values = ["2024-03-01 08:30:00", "2024-03-01", "N/A", "2024-13-01 00:00:00", None]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    got = [r.o for r in df.select("i", D.fetched_time(F.col("v")).alias("o")).orderBy("i").collect()]
    assert got == [datetime(2024, 3, 1, 8, 30), None, None, None, None]


def test_date_key(spark):
    row = spark.range(1).select(
        D.date_key(F.lit("2024-03-01").cast("date")).alias("k"),
        D.date_key(F.lit(None).cast("date")).alias("n"),
    ).first()
    assert (row.k, row.n) == (20240301, None)


@pytest.mark.parametrize(
    "spelling,expected",
    [
        ("Jan 5 2024", "2024-01-05 00:00:00"),
        ("January 5 2024", "2024-01-05 00:00:00"),
        ("5 Jan 2024 10:00", "2024-01-05 10:00:00"),
        ("2024-01-05 10:00 PM", "2024-01-05 22:00:00"),
        ("Fri, 05 Jan 2024 10:00:00 GMT", "2024-01-05 10:00:00"),
        ("05-01-2024", "2024-05-01 00:00:00"),
        ("2024.01.05", "2024-01-05 00:00:00"),
        ("01/05/24", "2024-01-05 00:00:00"),
    ],
)
def test_more_absolute_spellings(spark, spelling, expected):
    df = spark.createDataFrame([(spelling,)], "t string")
    got = df.select(F.date_format(D.absolute_time(F.col("t")), "yyyy-MM-dd HH:mm:ss")).first()[0]
    assert got == expected
