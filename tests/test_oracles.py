"""Every registered query against its SQL twin on the smallest data set."""

import duckdb
import pytest

import __spark_entry__ as entry_file
from pagewinnow.catalog.oracles import ORACLES
from pagewinnow.catalog.queries import REGISTERED as QUERIES
from tests.conftest import DATA

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def engine():
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{DATA}/{table}.parquet'")
    return con


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry_file.queries()) and set(ORACLES) <= set(entry_file.oracle_sql())


def rows_of(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    show = lambda v: repr(round(v, 6)) if isinstance(v, float) else str(v)
    return sorted(tuple(show(row[i]) for i in order) for row in rows)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_twin(spark, engine, name):
    df = QUERIES[name](spark, DATA)
    cursor = engine.execute(ORACLES[name])
    columns = [c[0] for c in cursor.description]
    assert sorted(df.columns) == sorted(columns)
    assert rows_of(df.collect(), df.columns) == rows_of(cursor.fetchall(), columns)


def test_entry(spark):
    df = entry_file.entry(spark)
    assert df.columns == ["page_id", "url", "title", "content_text"] and df.count() == 50
