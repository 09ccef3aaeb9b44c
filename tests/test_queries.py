"""Every registered query with SQL equals its DuckDB twin on the smallest data set."""

import pytest

import __spark_entry__ as entry
from check import rows_of
from conftest import SMALL

ORACLES = entry.oracle_sql()
# At this size no ticker has enough history or every class enough rows; the twin agrees that nothing is left.
FITTED = sorted(set(entry.queries()) - set(ORACLES))


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equals_sql(spark, duck, name):
    df = entry.queries()[name](spark, SMALL)
    cursor = duck.execute(ORACLES[name])
    names = [d[0] for d in cursor.description]
    assert sorted(df.columns) == sorted(names)
    assert rows_of(df.columns, df.collect()) == rows_of(names, cursor.fetchall())


def test_entry(spark):
    result = entry.entry(spark)
    assert result.columns == ["ticker", "label", "n"] and result.count() > 0


def test_every_query_without_sql_is_known():
    assert "dedup_greedy" in FITTED and all(n not in ORACLES for n in FITTED)
