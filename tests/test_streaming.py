"""Stream = batch: several files, stop and restart, replayed batches, another split."""

import os

import fixtures
import pytest
from pyspark.sql import functions as F

from topicflow.operators import changelog, tables
from topicflow.operators.tokens import space_tokens, unicode_tokens
from topicflow.plans import catalog, flows
from topicflow.session import work_dir
from topicflow.sources import sinks, topics
from topicflow.streaming import changelog as live, jobs, state

SPLITS = [[8], [1, 2, 5]]


def batches(rows, split):
    """Consecutive pieces of the given lengths; the last takes what is left."""
    start = 0
    for i, n in enumerate(split):
        end = len(rows) if i == len(split) - 1 else start + n
        yield rows[start:end]
        start = end


def stream(spark, path, schema, files_per_trigger=1):
    return topics.stream_topic(spark, path, spark.createDataFrame([], schema).schema, files_per_trigger)


def run(spark, rows, schema, split, start, restart=True):
    """Write the pieces as files and run the job: after each piece, or once over all of them."""
    path, job = work_dir(spark, "topic"), None
    for piece in batches(rows, split):
        spark.createDataFrame(piece, schema).coalesce(1).write.mode("append").parquet(path)
        if restart:
            job = start(stream(spark, path, schema)).wait()
    return job or start(stream(spark, path, schema)).wait()


def tuples(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("split", SPLITS)
@pytest.mark.parametrize("restart", [True, False])
def test_latest_balance(spark, split, restart):
    root = work_dir(spark, "job")
    job = run(
        spark,
        fixtures.account_rows(),
        fixtures.ACCOUNT_SCHEMA,
        split,
        lambda rows: jobs.start_table(flows.latest_balance(rows), root),
        restart,
    )
    table = jobs.read_table(spark, job, ["key"])
    assert {r.key: (r.id, r.amount, r.timestamp) for r in table.collect()} == fixtures.ACCOUNTS
    stored = state.stored_balances(spark, job, overall=True).collect()
    assert {r.key: (r.id, r.amount, r.timestamp) for r in stored} == fixtures.ACCOUNTS
    assert [r.key for r in stored] == ["3", "2", "1"]
    assert {r.partition_id for r in stored} <= set(range(3))


def test_update_stream_holds_changed_keys_only(spark):
    root = work_dir(spark, "job")
    job = run(
        spark,
        fixtures.account_rows(),
        fixtures.ACCOUNT_SCHEMA,
        [4, 3, 1],
        lambda rows: jobs.start_table(flows.latest_balance(rows), root),
    )
    changed = {(r.batch_id, r.key) for r in jobs.read_updates(spark, job).collect()}
    assert changed == {(0, "1"), (1, "2"), (1, "3"), (2, "1")}
    assert state.stored_state(spark, job.folders.checkpoint, batch_id=0).count() == 1
    assert state.stores(spark, job.folders.checkpoint).first().numPartitions == 3


@pytest.mark.parametrize("flow", [flows.unicode_word_count, flows.space_word_count])
def test_word_counts(spark, flow):
    root = work_dir(spark, "job")
    job = run(
        spark,
        fixtures.SENTENCES,
        fixtures.SENTENCE_SCHEMA,
        [2, 1, 2],
        lambda rows: jobs.start_table(flow(rows), root),
    )
    assert {r.word: r.n for r in jobs.read_table(spark, job, ["word"]).collect()} == fixtures.LOWER_COUNTS
    stored = state.stored_counts(spark, job, overall=True).collect()
    assert {r.word: r.n for r in stored} == fixtures.LOWER_COUNTS
    assert [r.word for r in stored] == sorted(fixtures.LOWER_COUNTS, reverse=True)


@pytest.mark.parametrize("split", SPLITS)
def test_running_words(spark, split):
    root = work_dir(spark, "job")
    words = lambda rows: space_tokens(rows, lower=True).drop("value")
    job = run(
        spark,
        fixtures.SENTENCES,
        fixtures.SENTENCE_SCHEMA,
        split,
        lambda rows: live.start_running_count(words(rows), root),
    )
    batch = spark.createDataFrame(fixtures.SENTENCES, fixtures.SENTENCE_SCHEMA)
    assert tuples(jobs.read_rows(spark, job)) == tuples(changelog.running_count(words(batch)))


@pytest.mark.parametrize("split", SPLITS)
@pytest.mark.parametrize("restart", [True, False])
def test_running_balance(spark, split, restart):
    root = work_dir(spark, "job")
    job = run(
        spark,
        fixtures.account_rows(),
        fixtures.ACCOUNT_SCHEMA,
        split,
        lambda rows: live.start_running_balance(rows, root),
        restart,
    )
    found = jobs.read_rows(spark, job).orderBy("seq").collect()
    assert [(r.id, r.amount, r.timestamp) for r in found] == [event[5] for event in fixtures.ACCOUNT_EVENTS]


@pytest.mark.parametrize("split", [[12], [2, 3, 7]])
def test_favourite_colour(spark, split):
    root = work_dir(spark, "job")
    job = run(
        spark,
        fixtures.COLOUR_LINES,
        fixtures.COLOUR_SCHEMA,
        split,
        lambda rows: live.start_value_counts(flows.colour_updates(rows), root),
    )
    found = jobs.read_rows(spark, job).orderBy("seq", "step").collect()
    assert [(r.seq, r.value, r.n) for r in found] == fixtures.COLOUR_CHANGES
    assert {r.value: r.n for r in live.value_counts(spark, job).collect()} == fixtures.COLOUR_COUNTS


def test_favourite_colour_keeps_zero_across_a_restart(spark):
    root = work_dir(spark, "job")
    job = run(
        spark,
        [line for line in fixtures.COLOUR_LINES if line[0] <= 10],
        fixtures.COLOUR_SCHEMA,
        [4, 6],
        lambda rows: live.start_value_counts(flows.colour_updates(rows), root),
    )
    assert {r.value: r.n for r in live.value_counts(spark, job).collect()} == fixtures.COLOUR_COUNTS_AT_10


def test_colour_counts_add_up_when_batches_overlap_in_seq(spark):
    """Partitions are read at different speeds: a later batch may bring lower numbers."""
    root, schema = work_dir(spark, "job"), "seq bigint, key string, value string"
    pieces = [[(1, "u", "X"), (10, "u", "Y"), (11, "v", "Y")], [(5, "u", "Z"), (6, "u", "X"), (7, "v", "Z")]]
    job = run(
        spark, pieces[0] + pieces[1], schema, [3, 3], lambda rows: live.start_value_counts(rows, root)
    )
    found = jobs.read_updates(spark, job).where("batch_id = 1").orderBy("seq", "step").collect()
    assert [(r.seq, r.value, r.n) for r in found] == [
        (5, "Y", 1),
        (5, "Z", 1),
        (6, "Z", 0),
        (6, "X", 1),
        (7, "Y", 0),
        (7, "Z", 1),
    ]
    assert {r.value: r.n for r in live.value_counts(spark, job).collect()} == {"X": 1, "Y": 0, "Z": 1}


def forget_last_commit(job):
    """As if the process had died after the batch wrote its output and before it was recorded."""
    commits = job.folders.checkpoint.removeprefix("file:") + "/commits"
    last = max(int(name) for name in os.listdir(commits) if name.isdigit())
    for name in (str(last), f".{last}.crc"):
        if os.path.exists(f"{commits}/{name}"):
            os.remove(f"{commits}/{name}")


@pytest.mark.parametrize("kind", ["balance", "colour", "table"])
def test_a_batch_run_again_leaves_its_rows_once(spark, kind):
    root, path = work_dir(spark, "job"), work_dir(spark, "topic")
    rows, schema = {
        "balance": (fixtures.account_rows(), fixtures.ACCOUNT_SCHEMA),
        "table": (fixtures.account_rows(), fixtures.ACCOUNT_SCHEMA),
        "colour": (fixtures.COLOUR_LINES, fixtures.COLOUR_SCHEMA),
    }[kind]
    start = {
        "balance": lambda df: live.start_running_balance(df, root),
        "table": lambda df: jobs.start_table(flows.latest_balance(df), root),
        "colour": lambda df: live.start_value_counts(flows.colour_updates(df), root),
    }[kind]
    for piece in batches(rows, [3, 3, 6]):
        spark.createDataFrame(piece, schema).coalesce(1).write.mode("append").parquet(path)
        start(stream(spark, path, schema)).wait()
    first = start(stream(spark, path, schema)).wait()
    before = tuples(jobs.read_updates(spark, first))
    forget_last_commit(first)
    again = start(stream(spark, path, schema)).wait()
    assert again.query.lastProgress is not None
    assert tuples(jobs.read_updates(spark, again)) == before
    if kind == "colour":
        assert {r.value: r.n for r in live.value_counts(spark, again).collect()} == fixtures.COLOUR_COUNTS


def test_fresh_start_forgets_and_resume_does_not(spark):
    root, path = work_dir(spark, "job"), work_dir(spark, "topic")
    spark.createDataFrame(fixtures.SENTENCES, fixtures.SENTENCE_SCHEMA).coalesce(1).write.parquet(path)

    def start(fresh):
        rows = stream(spark, path, fixtures.SENTENCE_SCHEMA)
        return jobs.start_table(flows.unicode_word_count(rows), root, fresh=fresh).wait()

    first, resumed, fresh = start(False), start(False), start(True)
    assert resumed.folders == first.folders != fresh.folders
    assert jobs.read_updates(spark, resumed).count() == len(fixtures.LOWER_COUNTS)
    assert {r.word: r.n for r in jobs.read_table(spark, fresh, ["word"]).collect()} == fixtures.LOWER_COUNTS


def test_drain_resumes_where_it_stopped(spark):
    root, path = work_dir(spark, "job"), work_dir(spark, "topic")
    job = None
    for piece in batches(fixtures.SENTENCES, [2, 3]):
        spark.createDataFrame(piece, fixtures.SENTENCE_SCHEMA).coalesce(1).write.mode("append").parquet(path)
        job = jobs.start_append(stream(spark, path, fixtures.SENTENCE_SCHEMA), root).wait()
    assert tuples(jobs.read_rows(spark, job)) == fixtures.SENTENCES


def test_append_topic_by_partition(spark):
    path, out = work_dir(spark, "topic"), work_dir(spark, "out")
    schema = "key string, value string, partition int"
    rows = [("a", "x", 0), ("b", "y", 1), ("c", "z", 1)]
    spark.createDataFrame(rows, schema).write.parquet(path)
    sinks.append_topic(stream(spark, path, schema), out, work_dir(spark, "checkpoint")).awaitTermination()
    found = topics.read_topic(spark, out, spark.createDataFrame([], schema).schema)
    assert tuples(found) == rows
    assert found.where("partition = 1").count() == 2


def test_peek_reports_on_a_stream(spark):
    path = work_dir(spark, "topic")
    spark.createDataFrame(fixtures.SENTENCES, fixtures.SENTENCE_SCHEMA).write.parquet(path)
    rows = sinks.peek(stream(spark, path, fixtures.SENTENCE_SCHEMA, 10), "seen", last=F.max("seq"))
    job = jobs.start_append(rows, work_dir(spark, "job")).wait()
    seen = [p.observedMetrics["seen"] for p in job.query.recentProgress if p.observedMetrics.get("seen")]
    assert sum(m.rows for m in seen) == len(fixtures.SENTENCES)


def test_tokens_of_a_stream_are_those_of_the_batch(spark):
    path = work_dir(spark, "topic")
    spark.createDataFrame(fixtures.SENTENCES, fixtures.SENTENCE_SCHEMA).write.parquet(path)
    job = jobs.start_append(
        unicode_tokens(stream(spark, path, fixtures.SENTENCE_SCHEMA)).drop("value"), work_dir(spark, "job")
    ).wait()
    batch = unicode_tokens(spark.createDataFrame(fixtures.SENTENCES, fixtures.SENTENCE_SCHEMA)).drop("value")
    assert tuples(jobs.read_rows(spark, job)) == tuples(batch)
    assert tuples(tables.count_per_key(jobs.read_rows(spark, job))) == sorted(fixtures.LOWER_COUNTS.items())


def test_latest_value_of_a_stream(spark):
    root = work_dir(spark, "job")
    job = run(
        spark,
        fixtures.COLOUR_LINES,
        fixtures.COLOUR_SCHEMA,
        [3, 9],
        lambda rows: jobs.start_table(tables.latest_value(flows.colour_updates(rows)), root),
    )
    found = {r.key: r.value for r in jobs.read_table(spark, job, ["key"]).collect()}
    assert found == {"ALICE": "BLUE", "BOB": "BLUE", "DAVE": "GREEN", "": "RED"}


TIE = [(10, "1", 1, 500.0, 100), (5, "1", 2, 700.0, 100)]


def test_a_later_batch_loses_a_tie_whatever_its_numbers(spark):
    """The live job and the table agree: what arrived first stays, the id follows arrival."""
    root = work_dir(spark, "job")
    job = run(spark, TIE, fixtures.ACCOUNT_SCHEMA, [1, 1], lambda rows: live.start_running_balance(rows, root))
    found = jobs.read_updates(spark, job).orderBy("batch_id").collect()
    assert [(r.id, r.amount, r.timestamp) for r in found] == [(1, 500.0, 100), (2, 500.0, 100)]
    assert [tuple(r) for r in live.balances(spark, job).collect()] == [("1", 500.0, 100)]

    root = work_dir(spark, "job")
    job = run(spark, TIE, fixtures.ACCOUNT_SCHEMA, [1, 1], lambda rows: jobs.start_table(flows.latest_balance(rows), root))
    assert [tuple(r) for r in jobs.read_table(spark, job, ["key"]).collect()] == [("1", 2, 500.0, 100)]


def test_latest_value_follows_batches_before_numbers(spark):
    root, schema = work_dir(spark, "job"), "seq bigint, key string, value string"
    rows = [(10, "u", "X"), (5, "u", "Y")]
    job = run(spark, rows, schema, [1, 1], lambda df: jobs.start_table(tables.latest_value(df), root))
    assert [tuple(r) for r in jobs.read_table(spark, job, ["key"]).collect()] == [("u", "Y")]


def test_a_batch_writes_the_state_of_its_own_keys(spark):
    root, path = work_dir(spark, "job"), work_dir(spark, "topic")
    pieces = [[(i, f"k{i}", i, 1.0 * i, i + 1) for i in range(200)]] + [[(1000 + i, "k7", i, 5.0, 1000 + i)] for i in range(4)]
    for piece in pieces:
        spark.createDataFrame(piece, fixtures.ACCOUNT_SCHEMA).coalesce(1).write.mode("append").parquet(path)
        job = live.start_running_balance(stream(spark, path, fixtures.ACCOUNT_SCHEMA), root).wait()
    kept = live.CarriedState(job.folders, "balances", live.BALANCE_STATE, F.max)
    batch = F.substring_index(F.element_at(F.split(F.input_file_name(), "/change/"), 2), "-", 1).cast("int")
    changes = spark.read.option("recursiveFileLookup", True).schema(live.BALANCE_STATE).parquet(f"{kept.path}/change")
    sizes = {r.batch: r["count"] for r in changes.groupBy(batch.alias("batch")).count().collect()}
    assert sizes == {0: 200, 1: 1, 2: 1, 3: 1, 4: 1}
    few = kept.after(spark, 4, keys=spark.createDataFrame([("k7",)], "key string"))
    assert [(r.key, r.state.amount) for r in few.collect()] == [("k7", 5.0)]
    assert live.balances(spark, job).count() == 200


def test_state_is_the_same_with_and_without_compaction(spark):
    at = jobs.folders(work_dir(spark, "job"))
    kept = live.CarriedState(at, "counts", live.COUNT_STATE, F.sum, compact_every=2)
    total = {}
    for i in range(5):
        for _ in range(2):  # each batch is run twice
            change = spark.createDataFrame([("a", 1), (f"w{i}", 2)], live.COUNT_STATE)
            before = kept.take(change, i)
            found = {} if before is None else {r.word: r.state for r in before.collect()}
        assert found == {k: v for k, v in total.items() if k in ("a", f"w{i}")}
        for word, n in (("a", 1), (f"w{i}", 2)):
            total[word] = total.get(word, 0) + n
    assert {r.word: r.state for r in kept.now(spark).collect()} == total


def test_the_source_of_a_batch_is_read_once(spark):
    root, path = work_dir(spark, "job"), work_dir(spark, "topic")
    spark.createDataFrame(fixtures.COLOUR_LINES, fixtures.COLOUR_SCHEMA).write.parquet(path)
    job = live.start_value_counts(flows.colour_updates(stream(spark, path, fixtures.COLOUR_SCHEMA, 100)), root).wait()
    assert sum(p.numInputRows for p in job.query.recentProgress) == len(fixtures.COLOUR_LINES)


@pytest.mark.parametrize("name", ["resumed_word_count", "resumed_running_balance", "resumed_running_color_count"])
def test_resumed_queries_run_three_batches(spark, monkeypatch, name):
    seen = []
    wait = jobs.Job.wait
    monkeypatch.setattr(jobs.Job, "wait", lambda job: seen.append(wait(job)) or job)
    catalog.QUERIES[name](spark, "/root/testdata/sf0.001")
    assert len(seen) == 3 and len({j.query.runId for j in seen}) == 3
    assert jobs.read_updates(spark, seen[-1]).select("batch_id").distinct().count() >= 3


def test_counts_encoded_for_a_topic(spark):
    """The update stream as (string key, 8-byte value) records."""
    root = work_dir(spark, "job")
    job = run(
        spark,
        fixtures.SENTENCES,
        fixtures.SENTENCE_SCHEMA,
        [2, 3],
        lambda rows: jobs.start_table(sinks.count_records(flows.unicode_word_count(rows)), root),
    )
    table = jobs.read_table(spark, job, ["key"])
    assert {r.key: int.from_bytes(r.value, "big") for r in table.collect()} == fixtures.LOWER_COUNTS
