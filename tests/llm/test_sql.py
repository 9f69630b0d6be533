"""The queries that SQL can express, against DuckDB."""

import os

import duckdb
import pytest

from topicflow.llm.queries import QUERIES, SQL

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.mark.parametrize("name", list(SQL))
def test_same_rows_as_the_sql(spark, name):
    duck = duckdb.connect()
    for table in ("documents", "embeddings", "labels"):
        duck.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    result = duck.execute(SQL[name])
    names = sorted(d[0] for d in result.description)
    place = [[d[0] for d in result.description].index(n) for n in names]
    expected = sorted((tuple(row[i] for i in place) for row in result.fetchall()), key=repr)
    df = QUERIES[name](spark, SF_DIR)
    assert sorted(df.columns) == names
    assert sorted((tuple(r[n] for n in names) for r in df.collect()), key=repr) == expected
    assert expected
