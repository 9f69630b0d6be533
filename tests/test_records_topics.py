import json

import pytest
from pyspark.sql import Observation, functions as F, types as T

from topicflow.operators import records
from topicflow.session import work_dir
from topicflow.sources import sinks, topics

LOOSE_PAYMENT = "id string, name string, amount double, profile string, salary int"


@pytest.fixture(scope="module")
def payments(spark):
    rows = [
        ("k/4", None, -3.25, None, 0),
        ("k/9", "Tamsin", None, "", None),
        ("", None, None, "clerk", -1),
        (None, None, None, None, None),
        (None, "", 7.0, None, 12),
    ]
    return spark.createDataFrame(rows, LOOSE_PAYMENT)


@pytest.fixture(scope="module")
def topic(spark):
    rows = [("t", p, o, f"k{o}", f"v{p}{o}") for p in range(3) for o in range(p + 2)]
    return spark.createDataFrame(rows, "topic string, partition int, offset bigint, key string, value string")


def test_completion_and_rejects(payments):
    done = records.complete_records(payments, records.PAYMENT)
    assert sorted(tuple(r) for r in done.collect()) == [
        ("", "", 0.0, "clerk", -1),
        ("k/4", "", -3.25, "developer", 0),
        ("k/9", "Tamsin", 0.0, "", 100),
    ]
    assert done.columns == records.PAYMENT.fieldNames()
    rejected = [tuple(r) for r in records.rejected_records(payments, records.PAYMENT).collect()]
    assert sorted(rejected, key=str) == [(None, "", 7.0, None, 12, "id"), (None, None, None, None, None, "id")]


def test_strict_completion_stops_on_a_missing_field(payments):
    good = records.complete_records(payments.where("id is not null"), records.PAYMENT, strict=True)
    assert good.count() == 3
    with pytest.raises(Exception, match="field id is required"):
        records.complete_records(payments, records.PAYMENT, strict=True).collect()


def test_absent_fields_count_as_unset(spark):
    df = spark.createDataFrame([("hi", "m1", "g", 2), ("hi", None, None, 2)], "message string, message_id string, group_id string, partition int")
    done = records.complete_records(df, records.MESSAGE_ENVELOPE)
    assert [tuple(r) for r in done.collect()] == [("hi", "m1", "g", "{}", "", 2)]
    assert [r.missing for r in records.rejected_records(df, records.MESSAGE_ENVELOPE).collect()] == ["message_id,group_id"]
    assert records.complete_records(df.drop("partition"), records.MESSAGE_ENVELOPE).count() == 0


def test_projection_by_name(spark):
    df = spark.createDataFrame([(1, "Maren", 500.0, 100)], "id int, name string, amount double, timestamp bigint")
    assert [tuple(r) for r in records.project_records(df, records.FINAL_ACCOUNT).collect()] == [(1, 500.0, 100)]
    assert records.project_records(df.drop("name"), records.BANK_ACCOUNT).first().name == ""
    widened = records.project_records(df.withColumn("timestamp", F.lit(7)), records.FINAL_ACCOUNT)
    assert widened.schema["timestamp"].dataType == T.LongType()
    with pytest.raises(ValueError, match="timestamp"):
        records.project_records(df.drop("timestamp"), records.FINAL_ACCOUNT)
    with pytest.raises(ValueError, match="cannot read string as int"):
        records.project_records(df.withColumn("id", F.lit("1")), records.FINAL_ACCOUNT)


def test_avro_schema_text():
    schema = json.loads(records.avro_schema(records.PAYMENT, "Payment"))
    assert schema["fields"][0] == {"name": "id", "type": "string"}
    assert schema["fields"][4] == {"name": "salary", "type": "int", "default": 100}


def test_translate_and_assigned_partitions(topic):
    assert topics.translate(topic).columns == ["topic", "offset", "key", "message", "partition"]
    assert {r.partition for r in topics.assigned_partitions(topic, [0, 2]).collect()} == {0, 2}


def test_progress_and_what_is_unread(spark, topic):
    progress = topics.partition_progress(topic.where("offset < 2"))
    assert {(r.partition, r.next_offset) for r in progress.collect()} == {(0, 2), (1, 2), (2, 2)}
    rest = topics.unread(topic, progress.where("partition <> 1"))
    assert {(r.partition, r.offset) for r in rest.collect()} == {(1, 0), (1, 1), (1, 2), (2, 2), (2, 3)}
    assert json.loads(topics.starting_offsets_json(progress)) == {"t": {"0": 2, "1": 2, "2": 2}}


def test_arrival_order_is_total_and_follows_offsets(topic):
    rows = topics.with_arrival_order(topic, 3).collect()
    assert len({r.seq for r in rows}) == len(rows)
    for p in range(3):
        offsets = [r.offset for r in sorted(rows, key=lambda r: r.seq) if r.partition == p]
        assert offsets == sorted(offsets)


def test_spread(spark):
    df = spark.range(0, 100, 1, 2)
    assert topics.spread(df).rdd.getNumPartitions() == 2
    assert topics.spread(df, 3).rdd.getNumPartitions() == 3
    by_key = topics.spread(df.withColumn("k", F.col("id") % 5), 4, by=["k"])
    homes = by_key.select("k", F.spark_partition_id().alias("p")).distinct().collect()
    assert len(homes) == 5


def test_kafka_starts_cover_the_assigned_partitions_only(topic):
    progress = topics.partition_progress(topic.where("partition < 2"))
    text = topics.starting_offsets_json(progress, {"t": [1, 2], "u": [0]})
    assert json.loads(text) == {"t": {"1": 3, "2": -2}, "u": {"0": -2}}


def test_sinks_round_trip(spark, topic):
    path = work_dir(spark, "text")
    sinks.write_topic(sinks.text_records(topic), path)
    sinks.write_topic(sinks.text_records(topic.limit(1)), path)
    assert topics.read_topic(spark, path).count() == topic.count() + 1

    counts = spark.createDataFrame([("a", 5)], "word string, n bigint")
    assert bytes(sinks.count_records(counts).first().value) == (5).to_bytes(8, "big")

    path = work_dir(spark, "typed")
    rows = spark.createDataFrame([(1, 10.0), (2, 20.0)], "id int, amount double")
    sinks.write_topic(sinks.typed_records(rows, "id", F.col("id") % 2), path)
    found = topics.read_topic(spark, path, T.StructType.fromDDL("key string, id int, partition int"))
    assert {tuple(r) for r in found.collect()} == {("1", 1, 1), ("2", 2, 0)}
    assert "partition" not in sinks.typed_records(rows, "id").columns


def test_peek_counts_and_passes_on(topic):
    seen = Observation("seen")
    passed = sinks.peek(topic, seen, last=F.max("offset"))
    assert passed.count() == topic.count()
    assert seen.get == {"rows": topic.count(), "last": 3}


def test_kafka_functions_ask_for_the_package(spark, topic):
    """Where Spark's Kafka package is absent, each says so; their options are right up to there."""
    calls = [
        lambda: topics.stream_kafka(spark, "broker:9092", "t", 3),
        lambda: topics.read_kafka(spark, "broker:9092", "t", [0, 1, 2], 3),
        lambda: sinks.write_kafka(sinks.text_records(topic), "broker:9092", "t"),
    ]
    for call in calls:
        with pytest.raises(Exception, match="(?i)kafka"):
            call()
