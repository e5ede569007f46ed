"""Every query against its SQL on the smallest tables."""

import pytest

import __spark_entry__ as entry
from compare import diff, duck, duck_types, rows_of_duck, rows_of_spark

SF = "/root/testdata/sf0.001"
TYPES = {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "boolean": "BOOLEAN"}


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_matches_sql(spark, con, name):
    df = entry.queries()[name](spark, SF)
    sql = entry.oracle_sql()[name]
    assert {c: TYPES[t] for c, t in df.dtypes} == duck_types(con, sql)
    assert not diff(rows_of_spark(df), rows_of_duck(con, sql))


def test_entry(spark):
    assert entry.entry(spark).count() > 0


KEYED = ["enrich_table", "dedup_keep_first", "pending_rows", "key_suppression"]


@pytest.fixture(scope="module")
def con01():
    return duck("/root/testdata/sf0.01")


@pytest.mark.parametrize("name", [q for q in KEYED if q in entry.oracle_sql()])
def test_repeated_keys_at_sf001(spark, con01, name):
    """Queries whose results hang on repeated keys, on tables where keys repeat more often."""
    df = entry.queries()[name](spark, "/root/testdata/sf0.01")
    assert not diff(rows_of_spark(df), rows_of_duck(con01, entry.oracle_sql()[name]))
