"""Every registered query against its SQL, and the shape of the batch plans."""

import os
import re

import duckdb
import pytest

from __spark_entry__ import entry
from topicflow.plans.catalog import QUERIES, SQL
from topicflow.sources import topics

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()
SQL_TYPES = {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE"}
STREAMED = ("stream_", "stored_", "drained_", "resumed_", "state_", "linked_", "compacted_", "once_")
BATCH = [name for name in QUERIES if not name.startswith(STREAMED)]


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return connection


@pytest.mark.parametrize("name", list(QUERIES))
def test_same_rows_as_the_sql(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    columns = sorted(df.columns)
    found = sorted((tuple(row[c] for c in columns) for row in df.collect()), key=repr)

    result = duck.execute(SQL[name])
    names = [d[0] for d in result.description]
    types = {d[0]: str(d[1]).replace("NUMBER", "").replace("STRING", "VARCHAR") for d in result.description}
    assert sorted(names) == columns
    expected = sorted((tuple(row[names.index(c)] for c in columns) for row in result.fetchall()), key=repr)
    assert found == expected
    assert found
    for field in df.schema:
        assert types[field.name] in ("", SQL_TYPES[field.dataType.simpleString()])


def test_entry(spark):
    assert entry(spark).count() > 0


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", BATCH)
def test_batch_plans_are_built_in_and_distributed(spark, name):
    text = plan(QUERIES[name](spark, SF_DIR))
    for bad in ("Python", "ArrowEval", "MapInPandas", "CartesianProduct", "BroadcastNestedLoopJoin", "SinglePartition"):
        assert bad not in text


@pytest.mark.parametrize("name", ["running_word_count", "running_balance", "running_color_count"])
def test_windows_over_rows_are_cut_into_slots(spark, name):
    text = plan(QUERIES[name](spark, SF_DIR)).split("Initial Plan")[-1]
    windows = re.findall(r"windowspecdefinition\((.*?), _is_row#\d+ ASC NULLS FIRST, (\w+)", text)
    groups = [([re.sub(r"#\d+L?", "", k) for k in keys.split(", ")], order) for keys, order in windows]
    # rows are windowed by (key, slot), and a bare key only where the rows are slots of slots
    assert [keys for keys, _ in groups if keys[-1] == "_slot2"]
    assert all(order == "_slot1" for keys, order in groups if not keys[-1].startswith("_slot"))


def test_hot_keys_are_found_without_a_scan_of_their_own_or_a_forced_broadcast(spark):
    df = QUERIES["running_balance_split"](spark, SF_DIR)
    assert "ResolvedHint" not in df._jdf.queryExecution().analyzed().toString()
    df.collect()
    final = plan(df).split("Initial Plan")[0]
    # the rows, and the combined rows per key and slot; what else needs these reuses their exchange
    assert final.count("FileScan parquet") <= 3


def test_scans_read_only_what_is_used(spark):
    text = plan(QUERIES["word_count_unicode"](spark, SF_DIR))
    assert "ReadSchema: struct<text:string>" in text
    text = plan(QUERIES["latest_balance"](spark, SF_DIR))
    assert "o_orderpriority" not in text and "PushedFilters: [IsNotNull(o_custkey)]" in text


def test_counts_are_combined_before_the_shuffle(spark):
    for name in ("word_count_unicode", "word_count_space", "partition_progress", "latest_color", "favourite_color", "latest_balance"):
        text = plan(QUERIES[name](spark, SF_DIR))
        before_shuffle = text[text.index("Exchange hashpartitioning") :]
        assert "partial_" in before_shuffle


def test_retracting_counts_find_each_pair_first(spark):
    text = plan(QUERIES["favourite_color"](spark, SF_DIR)).split("Initial Plan")[-1]
    below = text[text.index("Expand") :]
    assert "HashAggregate" in below and "partial_max" in below and "Sort [" not in below


def test_small_inputs_are_spread_and_large_ones_are_not(spark, tmp_path):
    spark.range(100).repartition(12).write.parquet(f"{tmp_path}/many")
    spark.range(100).coalesce(1).write.parquet(f"{tmp_path}/one")
    with_conf = {"spark.sql.files.openCostInBytes": "128m"}  # a part for each file
    before = {k: spark.conf.get(k) for k in with_conf}
    try:
        for k, v in with_conf.items():
            spark.conf.set(k, v)
        many, one = (spark.read.parquet(f"{tmp_path}/{name}") for name in ("many", "one"))
        assert "Exchange" not in plan(topics.spread(many, at_least=8))
        assert "RoundRobinPartitioning(8)" in plan(topics.spread(one, at_least=8))
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
