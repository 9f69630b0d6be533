"""Bucketed tables, record files, committed reads, marked records, linked jobs and peeks."""

import random
from collections import Counter

import fixtures
import pytest
from pyspark.sql import functions as F
from test_streaming import batches, forget_last_commit, run, stream, tuples

from topicflow import files
from topicflow.operators import changelog, ordering
from topicflow.plans import flows
from topicflow.operators.tokens import unicode_tokens
from topicflow.session import work_dir
from topicflow.sources import once, progress, sinks, topics
from topicflow.streaming import changelog as live, jobs, metrics, processors, state, store

COUNTS = "word string, state bigint"


def counts(spark, path, **layout):
    return store.KeyedTable(spark, path, COUNTS, ["word"], F.sum, **layout)


def frame(spark, rows, schema=COUNTS):
    return spark.createDataFrame(rows, schema)


def dictionary(df):
    return {r.word: r.state for r in df.collect()}


def folder_count(spark, path):
    """Folders of rows in a table."""
    return sum(len(files.names(spark, f"{path}/{kind}/{name}")) for kind in ("change", "base") for name in files.names(spark, f"{path}/{kind}"))


def paths(df):
    return sorted(df.inputFiles())


# --- record files -----------------------------------------------------------------


def test_records_appear_whole_and_are_replaced(spark):
    path = work_dir(spark, "records")
    assert files.read_record(spark, f"{path}/a.json") is None and files.names(spark, path) == []
    for record in ({"a": [1, "ü"]}, {"b": None}):
        files.write_record(spark, f"{path}/a.json", record)
        assert files.read_record(spark, f"{path}/a.json") == record
    assert files.names(spark, path) == ["a.json"]
    files.remove(spark, f"{path}/a.json")
    files.remove(spark, f"{path}/a.json")
    assert files.names(spark, path) == []


# --- the bucketed table -----------------------------------------------------------


def test_a_batch_reads_the_buckets_it_touches_and_no_others(spark):
    path = work_dir(spark, "table")
    table = counts(spark, path, buckets=8)
    table.put(frame(spark, [(f"w{i}", 1) for i in range(200)]), 0)
    everything = table.manifest()["folders"]
    assert len(everything) == 8
    before = table.take(frame(spark, [("w7", 1), ("w8", 1)]), 1)
    touched = {b for b, own in table.manifest()["folders"].items() if len(own) == 2}
    assert 1 <= len(touched) <= 2
    allowed = [folder for b in touched for folder in table.manifest()["folders"][b]]
    assert all(any(folder in p for folder in allowed) for p in paths(before))
    assert dictionary(before) == {"w7": 1, "w8": 1}
    one = table.of_keys(frame(spark, [("w7", 0)]))
    assert len({p.split(f"{store.BUCKET}=")[1].split("/")[0] for p in paths(one)}) == 1
    assert dictionary(one) == {"w7": 2}


@pytest.mark.parametrize("compact_every", [1, 3, 100])
def test_the_table_is_the_sum_of_its_batches(spark, compact_every):
    draw, total = random.Random(compact_every), Counter()
    table = counts(spark, work_dir(spark, "table"), buckets=3, compact_every=compact_every)
    for i in range(7):
        rows = [(f"w{draw.randint(0, 9)}", draw.randint(1, 5)) for _ in range(6)]
        found = table.take(frame(spark, rows), i)
        keys = {w for w, _ in rows}
        assert (dictionary(found) if found is not None else {}) == {w: n for w, n in total.items() if w in keys}
        for w, n in rows:
            total[w] += n
        assert dictionary(table.read()) == total


def test_a_read_costs_the_same_however_many_batches_came_before(spark):
    path = work_dir(spark, "table")
    table = counts(spark, path, buckets=2, compact_every=2)
    sizes = []
    for i in range(14):
        table.put(frame(spark, [(w, 1) for w in "abcdefgh"]), i)
        sizes.append((len(paths(table.read())), folder_count(spark, path), len(table.batches())))
    assert dictionary(table.read()) == dict.fromkeys("abcdefgh", 14)
    read, kept, manifests = (max(column) for column in zip(*sizes))
    assert read <= 2 * 3 and manifests == store.RETAIN
    assert kept <= 2 * 3 + 2 * 3 + 2  # what two manifests name, and the batch's own rows


def test_a_crash_between_the_rows_and_the_manifest_changes_nothing(spark, monkeypatch):
    path = work_dir(spark, "table")
    table = counts(spark, path, buckets=2, compact_every=1)
    table.put(frame(spark, [("a", 1), ("b", 1)]), 0)

    def crash(*_):
        raise OSError("gone")

    with monkeypatch.context() as during:
        during.setattr(files, "write_record", crash)
        with pytest.raises(OSError):
            table.put(frame(spark, [("a", 5), ("c", 5)]), 1)
    again = counts(spark, path, buckets=2, compact_every=1)
    assert dictionary(again.read()) == {"a": 1, "b": 1}
    again.put(frame(spark, [("a", 5), ("c", 5)]), 1)
    assert dictionary(again.read()) == {"a": 6, "b": 1, "c": 5}
    own = again.put(frame(spark, [("b", 1)]), 2)
    named = {f for b in again.batches() for own in again.manifest(b)["folders"].values() for f in own}
    there = {
        f"{kind}/{name}/{part}"
        for kind in ("change", "base")
        for name in files.names(spark, f"{path}/{kind}")
        for part in files.names(spark, f"{path}/{kind}/{name}")
    }
    assert there == named | set(own.values())  # the failed attempt's files are gone


def test_a_batch_put_again_counts_once(spark):
    table = counts(spark, work_dir(spark, "table"), buckets=2, compact_every=1)
    for i in (0, 0, 1, 1, 1, 2):
        table.put(frame(spark, [("a", 1), (f"b{i}", 1)]), i)
    assert dictionary(table.read()) == {"a": 3, "b0": 1, "b1": 1, "b2": 1}


def test_the_number_of_buckets_stays_as_it_began_and_empty_batches_pass(spark):
    path = work_dir(spark, "table")
    assert counts(spark, path).read().count() == 0
    counts(spark, path, buckets=2).put(frame(spark, []), 0)
    table = counts(spark, path, buckets=9)
    assert table.take(frame(spark, [(w, 1) for w in "abcdef"]), 1) is None
    assert table.take(frame(spark, []), 2).count() == 0
    assert set(table.manifest()["folders"]) <= {"0", "1"}
    assert dictionary(table.read()) == dict.fromkeys("abcdef", 1)


@pytest.mark.parametrize("compact_every", [1, 8])
def test_tables_of_jobs_hold_each_key_once(spark, compact_every):
    root = work_dir(spark, "job")
    job = run(
        spark,
        fixtures.account_rows(),
        fixtures.ACCOUNT_SCHEMA,
        [2, 2, 3, 1],
        lambda rows: jobs.start_table(flows.latest_balance(rows), root, keys=["key"], compact_every=compact_every, buckets=2),
    )
    found = jobs.read_table(spark, job, ["key"])
    assert {r.key: (r.id, r.amount, r.timestamp) for r in found.collect()} == fixtures.ACCOUNTS
    assert found.count() == len(fixtures.ACCOUNTS) and found.columns == job.schema.names


def test_a_job_whose_batch_is_run_again_leaves_its_table_as_it_was(spark):
    root, path = work_dir(spark, "job"), work_dir(spark, "topic")

    def start():
        rows = stream(spark, path, fixtures.SENTENCE_SCHEMA)
        return jobs.start_table(flows.unicode_word_count(rows), root, keys=["word"], compact_every=1).wait()

    for piece in batches(fixtures.SENTENCES, [2, 3]):
        frame(spark, piece, fixtures.SENTENCE_SCHEMA).coalesce(1).write.mode("append").parquet(path)
        job = start()
    forget_last_commit(job)
    again = start()
    assert again.query.lastProgress is not None
    assert {r.word: r.n for r in jobs.read_table(spark, again, ["word"]).collect()} == fixtures.LOWER_COUNTS


# --- dense order ------------------------------------------------------------------


def test_dense_numbers_follow_the_order(spark):
    draw = random.Random(5)
    rows = [(draw.choice([None, 1, 2, 3, 9]), draw.randint(0, 2), i) for i in range(500)]
    df = frame(spark, rows, "time int, partition int, offset int").repartition(6)
    found = sorted(ordering.numbered(df, ["time", "partition", "offset"], start=10, ranges=5).collect(), key=lambda r: r.seq)
    assert [r.seq for r in found] == list(range(10, 510))
    expected = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    assert [tuple(r)[:3] for r in found] == expected


def test_dense_numbers_of_nothing_of_one_value_and_downwards(spark):
    assert ordering.numbered(frame(spark, []), ["word"]).collect() == []
    same = ordering.numbered(frame(spark, [("a", 1)] * 50), ["word"], ranges=4)
    assert sorted(r.seq for r in same.collect()) == list(range(50))
    down = ordering.numbered(frame(spark, [(w, 1) for w in "bca"]), [F.desc("word")], "n")
    assert {r.word: r.n for r in down.collect()} == {"c": 0, "b": 1, "a": 2}


def test_dense_numbers_need_no_one_task_window(spark):
    df = frame(spark, [(f"w{i}", i) for i in range(100)])
    plan = ordering.dealt(df, ["word"], 4)._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" in plan and "SinglePartition" not in plan and "Window" not in plan
    plan = ordering.numbered(df, ["word"])._jdf.queryExecution().executedPlan().toString()
    assert not any(bad in plan for bad in ("SinglePartition", "Window", "Exchange", "Python", "Join"))


def test_equal_broker_times_go_by_partition_and_offset(spark):
    schema = "topic string, partition int, offset bigint, key string, value string, timestamp bigint"
    rows = [("t", p, o, "k", f"{p}-{o}", (o // 3) if o != 4 else None) for p in (1, 0) for o in (5, 4, 3, 2, 1, 0)]
    found = topics.with_time_order(frame(spark, rows, schema)).orderBy("seq").collect()
    assert [r.value for r in found] == "0-4 1-4 0-0 0-1 0-2 1-0 1-1 1-2 0-3 0-5 1-3 1-5".split()
    assert [r.seq for r in found] == list(range(12))


# --- committed reads --------------------------------------------------------------

PLACES = "topic string, partition int, offset bigint, value string"


def records(first, last, partitions=(0, 1)):
    return [("t", p, o, f"{p}-{o}") for p in partitions for o in range(first, last)]


class Topic:
    def __init__(self, spark):
        self.spark, self.path, self.out = spark, work_dir(spark, "topic"), work_dir(spark, "out")
        self.log = work_dir(spark, "log")

    def append(self, rows):
        frame(self.spark, rows, PLACES).write.mode("append").parquet(self.path)

    def rows(self):
        return self.spark.read.schema(PLACES).parquet(self.path)

    def handle(self, found, number):
        found.write.mode("overwrite").parquet(f"{self.out}/read={number}")

    def reader(self):
        return progress.ReadLog(self.spark, self.log)

    def handled(self):
        return sorted(r.value for r in self.spark.read.schema(PLACES).parquet(self.out).collect())


def values(rows):
    return sorted(r[3] for r in rows)


def test_two_drains_read_everything_once(spark):
    topic = Topic(spark)
    topic.append(records(0, 4))
    assert topic.reader().drain(topic.rows, topic.handle) == 1
    assert topic.reader().drain(topic.rows, topic.handle) == 0
    topic.append(records(4, 6) + records(0, 3, [7]))
    assert topic.reader().drain(topic.rows, topic.handle) == 1
    assert topic.handled() == values(records(0, 6) + records(0, 3, [7]))
    assert tuples(topic.reader().progress()) == [("t", 0, 6), ("t", 1, 6), ("t", 7, 3)]


@pytest.mark.parametrize("written", [False, True])
def test_a_reader_killed_before_its_commit_reads_the_same_again(spark, written):
    topic = Topic(spark)
    topic.append(records(0, 4))
    topic.reader().drain(topic.rows, topic.handle)
    topic.append(records(4, 6))
    lost = topic.reader().begin(topic.rows())
    if written:
        topic.handle(lost.of(topic.rows()), lost.number)
    topic.append(records(6, 9))
    again = topic.reader().begin(topic.rows())
    assert again == lost
    assert sorted(r.value for r in again.of(topic.rows()).collect()) == values(records(4, 6))
    assert topic.reader().drain(topic.rows, topic.handle) == 2
    assert topic.handled() == values(records(0, 9))


def test_a_read_may_be_bounded_and_old_records_go(spark):
    topic = Topic(spark)
    topic.append(records(5, 12, [0]) + records(0, 2, [1]))  # a partition whose beginning is gone
    reader = topic.reader()
    first = reader.begin(topic.rows(), limit=3)
    assert first.end == {"t": {"0": 8, "1": 2}}
    assert first.kafka_options() == {
        "startingOffsets": '{"t": {"0": -2, "1": -2}}',
        "endingOffsets": '{"t": {"0": 8, "1": 2}}',
    }
    assert reader.drain(topic.rows, topic.handle, limit=3) == 3
    assert topic.handled() == values(records(5, 12, [0]) + records(0, 2, [1]))
    assert len(files.names(spark, f"{topic.log}/commit")) == 1
    assert reader.begin(topic.rows()) is None


def test_an_empty_topic_has_nothing_to_read(spark):
    topic = Topic(spark)
    topic.append([])
    assert topic.reader().drain(topic.rows, topic.handle) == 0
    assert topic.reader().committed() == (-1, {}) and topic.reader().progress().count() == 0


# --- at least once, read once -----------------------------------------------------


def test_delivered_again_read_once(spark):
    path, root = work_dir(spark, "topic"), work_dir(spark, "job")
    schema = "partition int, seq bigint, value string"
    pieces = [[(p, 10 * i + s, f"{p}-{i}-{s}") for p in (0, 1) for s in range(5)] for i in range(3)]
    marked = [once.marked(frame(spark, piece, schema), "p", i) for i, piece in enumerate(pieces)]
    other = once.marked(frame(spark, pieces[0], schema), "q", 0)
    deliveries = [marked[0], marked[1].where("seq < 13"), marked[1], marked[0], other, marked[2].unionByName(marked[1]), marked[2]]
    for df in deliveries:
        df.coalesce(1).write.mode("append").parquet(path)
        job = once.start_once(stream(spark, path, marked[0].schema), root).wait()
    expected = sorted([r for piece in pieces for r in piece] + pieces[0])
    assert tuples(jobs.read_rows(spark, job)) == expected
    assert tuples(once.seen(spark, job)) == [("p", 0, 2, 24), ("p", 1, 2, 24), ("q", 0, 0, 4), ("q", 1, 0, 4)]
    everything = spark.read.schema(marked[0].schema).parquet(path)
    assert tuples(once.once(everything)) == expected

    forget_last_commit(job)
    again = once.start_once(stream(spark, path, marked[0].schema), root).wait()
    assert tuples(jobs.read_rows(spark, again)) == expected


# --- state store ------------------------------------------------------------------


@pytest.mark.parametrize("split", [[8], [1, 2, 5]])
def test_balances_from_the_state_store(spark, split):
    root = work_dir(spark, "job")
    rows = [fixtures.account_rows()[i] for i in (1, 0, 2, 4, 3, 5, 6, 7)] if split == [8] else fixtures.account_rows()
    job = run(spark, rows, fixtures.ACCOUNT_SCHEMA, split, lambda df: jobs.start_append(processors.running_balance(df), root))
    found = {r.seq: (r.id, r.amount, r.timestamp) for r in jobs.read_rows(spark, job).collect()}
    assert found == {e[0]: e[5] for e in fixtures.ACCOUNT_EVENTS}


def test_balances_from_the_state_store_with_nulls(spark):
    rows = [(1, "1", None, 5.0, None), (2, None, 1, 5.0, 9), (3, "1", 4, None, 7), (4, "1", 5, 1.0, 7)]
    root = work_dir(spark, "job")
    job = run(spark, rows, fixtures.ACCOUNT_SCHEMA, [2, 2], lambda df: jobs.start_append(processors.running_balance(df), root))
    batch = changelog.running_balance(frame(spark, rows, fixtures.ACCOUNT_SCHEMA)).select("key", "seq", "id", "amount", "timestamp")
    assert sorted(map(tuple, jobs.read_rows(spark, job).collect())) == sorted(map(tuple, batch.collect()))


def test_the_state_store_balance_hands_a_key_rows_not_a_frame(spark):
    # a pandas frame in and out per key and batch cost about 1.6 ms of a core: 4,400 s projected over 54 million orders
    rows = spark.createDataFrame(fixtures.account_rows(), fixtures.ACCOUNT_SCHEMA)
    plan = processors.running_balance(rows)._jdf.queryExecution().executedPlan().toString()
    assert "TransformWithStateInPySpark" in plan and ", python_row," in plan


@pytest.mark.parametrize("split", [[5], [2, 1, 2]])
def test_counts_from_the_state_store(spark, split):
    root = work_dir(spark, "job")
    start = lambda df: jobs.start_append(processors.running_count(unicode_tokens(df).drop("value")), root)
    job = run(spark, fixtures.SENTENCES, fixtures.SENTENCE_SCHEMA, split, start)
    batch = changelog.running_count(unicode_tokens(frame(spark, fixtures.SENTENCES, fixtures.SENTENCE_SCHEMA)).drop("value"))
    assert tuples(jobs.read_rows(spark, job)) == tuples(batch)


UPDATES = "seq bigint, key string, value string"


@pytest.mark.parametrize("split", [[12], [3, 4, 5]])
def test_changes_from_the_state_store(spark, split):
    root = work_dir(spark, "job")
    start = lambda df: jobs.start_append(processors.value_changes(flows.colour_updates(df)), root)
    job = run(spark, fixtures.COLOUR_LINES, fixtures.COLOUR_SCHEMA, split, start)
    batch = changelog.value_changes(frame(spark, fixtures.COLOUR_UPDATES, UPDATES))
    assert tuples(jobs.read_rows(spark, job)) == tuples(batch)


def test_linked_jobs_stop_and_go_on_alone(spark):
    path, one, two = (work_dir(spark, name) for name in ("topic", "first", "second"))
    pieces = list(batches(fixtures.COLOUR_LINES, [3, 7, 2]))

    def first(piece):
        frame(spark, piece, fixtures.COLOUR_SCHEMA).coalesce(1).write.mode("append").parquet(path)
        return live.start_changes(flows.colour_updates(stream(spark, path, fixtures.COLOUR_SCHEMA)), one).wait()

    def second(changes):
        job = live.start_change_counts(spark, changes, two).wait()
        return {r.value: r.n for r in jobs.read_table(spark, job, ["value"]).collect()}

    assert second(first(pieces[0])) == {"RED": 0, "BLUE": 2}
    job = first(pieces[1])
    job = first(pieces[2])  # the second job has missed a batch
    assert second(job) == fixtures.COLOUR_COUNTS
    forget_last_commit(job)
    assert second(first([])) == fixtures.COLOUR_COUNTS  # the first job's last batch is run again


# --- change feed and peeks --------------------------------------------------------


def test_the_change_feed_is_the_difference_of_the_batches(spark):
    root = work_dir(spark, "job")
    job = run(
        spark,
        fixtures.SENTENCES,
        fixtures.SENTENCE_SCHEMA,
        [2, 1, 2],
        lambda rows: jobs.start_table(flows.unicode_word_count(rows), root, keys=["word"]),
    )
    feed = state.count_changes(spark, job, 0, 2)
    before = {}
    for i in range(3):
        now = {r.word: r.n for r in state.stored_counts(spark, job, batch_id=i).collect()}
        changed = {r.word: r.n for r in feed.where(F.col("batch_id") == i).collect()}
        assert changed == {w: n for w, n in now.items() if before.get(w) != n}
        before = now
    assert {r.change_type for r in feed.collect()} == {"update"}
    per_store = state.changes_per_store(feed)
    assert per_store.agg(F.sum("keys")).first()[0] == feed.count()
    assert {r.partition_id for r in per_store.collect()} <= set(range(3))


def test_peeks_are_kept_by_batch(spark):
    path, root, seen = (work_dir(spark, name) for name in ("topic", "job", "seen"))
    with metrics.PeekRecorder(spark, seen, "passing") as recorder:
        for piece in batches(fixtures.SENTENCES, [2, 1, 2]):
            frame(spark, piece, fixtures.SENTENCE_SCHEMA).coalesce(1).write.mode("append").parquet(path)
            rows = sinks.peek(stream(spark, path, fixtures.SENTENCE_SCHEMA), "passing", last=F.max("seq"))
            recorder.wait(jobs.start_append(rows, root).query)
    found = metrics.peeked(spark, seen, "rows bigint, last bigint").orderBy("batch_id").collect()
    assert [(r.batch_id, r.rows, r.last) for r in found] == [(0, 2, 1), (1, 1, 2), (2, 4, 6)]
    assert len({r.query_id for r in found}) == 1
