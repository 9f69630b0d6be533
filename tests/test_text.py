import re

import fixtures
import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from topicflow.functions.text import split_literal, split_spaces, split_words
from topicflow.functions.wire import decode_long, encode_long, epoch_micros, long_hex

TEXTS = st.lists(st.text(alphabet=" ,!aB_é\n-", max_size=12), min_size=1, max_size=40)


def split_like_jvm(text, pattern):
    """Limit-0 split: trailing empties dropped, no match gives the text itself."""
    parts = re.split(pattern, text)
    if len(parts) == 1:
        return parts
    while parts and parts[-1] == "":
        parts.pop()
    return parts


def rows(spark, texts, column):
    df = spark.createDataFrame(list(enumerate(texts)), "n int, t string").select("n", column.alias("parts"))
    return [r.parts for r in df.orderBy("n").collect()]


def test_edge_texts(spark):
    texts = [t for t, _, _ in fixtures.EDGE_TEXTS]
    assert rows(spark, texts, split_spaces(F.col("t"))) == [s for _, s, _ in fixtures.EDGE_TEXTS]
    assert rows(spark, texts, split_words(F.lower("t"))) == [w for _, _, w in fixtures.EDGE_TEXTS]


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(texts=TEXTS)
def test_splits_agree_with_the_rule(spark, texts):
    assert rows(spark, texts, split_spaces(F.col("t"))) == [split_like_jvm(t, " ") for t in texts]
    assert rows(spark, texts, split_literal(F.col("t"), ",")) == [split_like_jvm(t, ",") for t in texts]
    assert rows(spark, texts, split_words(F.col("t"))) == [split_like_jvm(t, r"\W+") for t in texts]


def test_long_separator_runs_stay_linear(spark):
    text = "=" * 500_000 + "a" + " " * 500_000
    assert rows(spark, [text], split_words(F.col("t"))) == [["", "a"]]


def test_separator_must_be_one_character(spark):
    with pytest.raises(ValueError):
        split_literal(F.col("t"), "ab")


def test_regex_characters_are_plain_separators(spark):
    assert rows(spark, ["a.b|c"], split_literal(F.col("t"), ".")) == [["a", "b|c"]]
    assert rows(spark, ["a.b|c"], split_literal(F.col("t"), "|")) == [["a.b", "c"]]


def test_long_wire_form(spark):
    values = [5, 255, 0, -1, 2**63 - 1, -(2**63)]
    df = spark.createDataFrame([(v,) for v in values], "v bigint")
    found = df.select("v", long_hex(F.col("v")).alias("h"), encode_long(F.col("v")).alias("b"))
    for row in found.withColumn("back", decode_long(F.col("b"))).collect():
        assert bytes(row.b) == row.v.to_bytes(8, "big", signed=True)
        assert row.h == bytes(row.b).hex().upper()
        assert row.back == row.v


@pytest.mark.parametrize("zone", ["UTC", "Asia/Kolkata", "America/New_York"])
def test_epoch_micros_in_any_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = spark.sql(
            "SELECT * FROM VALUES (TIMESTAMP_NTZ'1970-01-01 00:00:00'), (TIMESTAMP_NTZ'2024-03-10 02:30:00.000001'),"
            " (TIMESTAMP_NTZ'1969-12-31 23:59:59.5') AS t(c)"
        )
        found = {str(r.c): r.e for r in df.select(F.col("c").cast("string").alias("c"), epoch_micros(F.col("c")).alias("e")).collect()}
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert found == {
        "1970-01-01 00:00:00": 0,
        "2024-03-10 02:30:00.000001": 1710037800000001,
        "1969-12-31 23:59:59.5": -500000,
    }
