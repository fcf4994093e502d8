"""The automaton against the pattern and against plain word look-up."""

import random

import pytest
from pyspark.sql import functions as F

from starmill import rules
from starmill.functions import dictionary
from starmill.functions import text as T

PARTS = ["sql", "c++", "c#", "java", "script", "r", " ", "_", "3", "api", " testing", "rest ", "ش", ".", "Node.js", "é", "ci/cd"]


@pytest.fixture(scope="module")
def cells(spark):
    rng = random.Random(5)
    texts = ["".join(rng.choices(PARTS, k=rng.randrange(12))) for _ in range(2000)]
    odd = [None, "", "C++", "C++x", "x.NET", "sql" * 300_000, "rest api testing " * 20_000, "İSQL", "data lake house"]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate([*texts, *odd])], "i int, t string")
    return rows.repartition(4).cache()


@pytest.mark.parametrize("strict", [True, False])
def test_equals_the_pattern(cells, spark, strict):
    terms = [*rules.SKILL_TERMS, "data", "data lake", "lake", ".NET", "+", "++"]
    both = cells.select(
        "i",
        T.terms_found(F.col("t"), terms, strict).alias("pattern"),
        dictionary.terms_found(spark, F.col("t"), terms, strict).alias("one"),
        dictionary.terms_found(spark, F.col("t"), terms, strict, block_bytes=40).alias("blocks"),
    )
    rows = both.collect()
    assert len(rows) == 2009
    assert [r for r in rows if not r.pattern == r.one == r.blocks] == []
    assert sum(bool(r.one) for r in rows) > 500


def test_a_hundred_thousand_terms(spark):
    terms = [f"Term{i}" for i in range(100_000)]
    rows = spark.range(300).select("id", F.concat_ws(" ", *[(F.col("id") * 7919 * j % 120_000).cast("string") for j in range(40)]).alias("n"))
    rows = rows.select("id", "n", F.concat(F.lit("term"), F.regexp_replace("n", " ", " TERM")).alias("t"))
    got = rows.select("n", dictionary.terms_found(spark, F.col("t"), terms).alias("found")).collect()
    for row in got:
        wanted = sorted({int(n) for n in row.n.split() if int(n) < 100_000})
        assert row.found == [f"Term{n}" for n in wanted]


def test_terms_are_checked(spark):
    for terms in (["SQL", "sql"], ["a", ""]):
        with pytest.raises(ValueError):
            dictionary.terms_found(spark, F.lit("x"), terms)
    assert spark.range(1).select(dictionary.terms_text(spark, F.lit("x"), [])).first()[0] == "N/A"
