"""Every registered query against its SQL on DuckDB."""

import pytest

import __spark_entry__ as entry
import check

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return check.oracle(SF)


@pytest.mark.parametrize("name", list(entry.queries()))
def test_query(spark, connection, name):
    df = entry.queries()[name](spark, SF)
    sql = entry.oracle_sql().get(name)
    if sql is None:
        assert df.count() > 0
    else:
        assert check.differences(df, connection, sql) is None


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["destination", "year", "month", "day", "n_events"]
    assert df.count() > 0
