"""Every registered query against its SQL at the smallest scale."""

import pytest

from checks import ORACLES, QUERIES
from checks.compare import compare, duck

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, con, name):
    assert name in ORACLES
    assert compare(spark, con, name, QUERIES[name], ORACLES[name], SF) is None


def test_entry_contract(spark):
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).columns == ["as_of_date", "avg_ppsqm", "growth_pct"]


def test_spread_tables_have_more_parts_not_larger_ones(spark, tmp_path, monkeypatch):
    from checks import standin

    path = str(tmp_path / "a table %20")
    spark.range(50_000).repartition(3).write.parquet(path)
    df = spark.read.parquet(path)
    assert standin.spread(df).rdd.getNumPartitions() == 8
    monkeypatch.setattr(standin, "PART_BYTES", 10_000)
    many = standin.spread(df.where("id >= 0"))
    assert many.rdd.getNumPartitions() > 15 and many.count() == 50_000
