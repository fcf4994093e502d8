import pytest
from compare import differences, duck

import __spark_entry__ as entry
from starmill.queries import QUERIES


@pytest.fixture(scope="module")
def checker(sf_dir):
    return duck(sf_dir)


def test_every_query_has_its_check():
    assert set(QUERIES) <= set(entry.oracle_sql())


def test_entry(spark):
    assert entry.entry(spark).columns == ["skill", "postings"]


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, checker, sf_dir, name):
    result = entry.queries()[name](spark, sf_dir)
    assert differences(result, checker, entry.oracle_sql()[name]) == ""
