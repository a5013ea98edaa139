"""Every query with SQL gives the rows that DuckDB gives for it."""

from __future__ import annotations

import duckdb
import pytest

from swathline.catalogue import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings".split()


def norm(value):
    return round(value, 6) if isinstance(value, float) else value


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return connection


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, duck, name):
    found = QUERIES[name](spark, FOLDER)
    columns = sorted(found.columns)
    have = sorted((tuple(norm(r[c]) for c in columns) for r in found.collect()), key=str)
    result = duck.execute(ORACLES[name])
    order = [[d[0] for d in result.description].index(c) for c in columns]
    want = sorted((tuple(norm(r[i]) for i in order) for r in result.fetchall()), key=str)
    assert have == want


def test_entry_point_without_training_data_operators_keeps_its_queries():
    import __spark_entry__

    assert set(QUERIES) <= set(__spark_entry__.queries())
