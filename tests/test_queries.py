"""Every registered query against its SQL, over the whole of the small tables."""

import duckdb
import pytest

import __spark_entry__ as entry_points
from silofeed.queries import ORACLES, QUERIES

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


@pytest.fixture(scope="module")
def oracle(sf_dir):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def normal(names, found):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(row[i] for i in order) for row in found), key=repr)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert QUERIES.items() <= entry_points.queries().items() and ORACLES.items() <= entry_points.oracle_sql().items()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf_dir, oracle, name):
    df = QUERIES[name](spark, sf_dir)
    result = oracle.execute(ORACLES[name])
    names = [column[0] for column in result.description]
    assert sorted(df.columns) == sorted(names)
    expected = normal(names, result.fetchall())
    assert expected and normal(df.columns, df.collect()) == expected


def test_entry(spark):
    df = entry_points.entry(spark)
    assert df.columns == ["line"] and df.first()["line"].startswith("df_acme.orders <= ")
