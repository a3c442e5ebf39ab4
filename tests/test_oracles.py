"""Every registered query against its SQL text, over whole tables."""

import duckdb
import pytest

import __spark_entry__ as entry
from tests.conftest import SF_DIR

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages".split()
KINDS = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "float": "FLOAT", "string": "VARCHAR"}

pytestmark = pytest.mark.skipif(not SF_DIR.exists(), reason="no test data")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"create view {table} as select * from '{SF_DIR}/{table}.parquet'")
    return con


# The text queries have tests of their own.
NAMES = [name for name in entry.queries() if name not in entry.text_query_names()]


def test_every_query_has_a_check():
    assert set(NAMES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, duck, name):
    got = entry.queries()[name](spark, str(SF_DIR))
    want = duck.execute(entry.oracle_sql()[name])
    kinds = {column[0]: str(column[1]) for column in want.description}
    columns = sorted(kinds)
    assert sorted(got.columns) == columns
    assert {n: KINDS.get(t, t.upper()) for n, t in got.dtypes} == kinds

    def rows(names, values):
        order = [names.index(column) for column in columns]
        return sorted((tuple(row[i] for i in order) for row in values), key=repr)

    expected = rows(list(kinds), want.fetchall())
    assert rows(got.columns, got.collect()) == expected
    assert expected
