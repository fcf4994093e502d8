import pytest
from pyspark.sql import functions as F

from starmill import fixtures
from starmill.plans import analytics, gold, silver
from starmill.plans.rollups import KEYS, Rollups
from starmill.sources import tables
from starmill.sources.commits import Taken

ORDER = fixtures.ORDER


@pytest.fixture(scope="module")
def halves(spark, sf_dir):
    raw = fixtures.raw_jobs(spark, sf_dir).drop("o_orderdate")
    cleaned = tables.stage(silver.silver(raw, ORDER, keep=ORDER), "test-silver")
    third = F.pmod(F.xxhash64("job_title", "company"), F.lit(3))
    return [cleaned.where(third == i) for i in range(3)]


def rows(df):
    return sorted(map(repr, df.collect()))


def of_all_facts(store):
    star = store.tables()
    levels = analytics.levels_by_employment(star)
    return [rows(analytics.postings_per_month(star)), rows(levels), rows(analytics.top_skills(star, 10**6)), rows(analytics.top_companies(star, 10**6))]


def kept(rollups):
    reads = (rollups.postings_per_month(), rollups.levels_by_employment(), rollups.postings_per_skill(), rollups.postings_per_company())
    return [rows(df) for df in reads]


@pytest.mark.parametrize("fold", [1, 3, 16])
def test_rollups_equal_reads_over_all_facts(spark, halves, tmp_path, fold):
    store = tables.StarStore(spark, str(tmp_path / "star"), gold.SCHEMAS)
    rollups = Rollups(store, fold)
    assert rollups.refresh() == 0 and all(rollups.read(name).count() == 0 for name in KEYS)
    for part in halves:
        gold.load(part, store, ORDER)
        rollups.refresh()
        number = rollups.log.read()[0]
        assert rollups.refresh() == number  # nothing new, nothing written
        assert kept(rollups) == of_all_facts(store)
    assert len(rollups.log.read()[1]["parts"]) == (1 if fold < 16 else 3)


def test_a_refresh_that_loses_the_race_counts_nothing(spark, halves, tmp_path):
    store = tables.StarStore(spark, str(tmp_path / "star"), gold.SCHEMAS)
    gold.load(halves[0], store, ORDER)
    first, second = Rollups(store), Rollups(store)
    commit = second.log.commit

    def late(after, state):
        first.refresh()
        return commit(after, state)

    second.log.commit = late
    with pytest.raises(Taken):
        second.refresh()
    assert kept(second) == of_all_facts(store)


def test_rewritten_facts_are_noticed(spark, halves, tmp_path):
    store = tables.StarStore(spark, str(tmp_path / "star"), gold.SCHEMAS)
    gold.load(halves[0], store, ORDER)
    rollups = Rollups(store)
    rollups.refresh()
    facts = tables.stage(store.read("FACT_JOBS"), "facts")
    facts.write.mode("overwrite").parquet(f"{store.folder}/FACT_JOBS")
    with pytest.raises(RuntimeError, match="gone"):
        rollups.refresh()
