import random

import fixtures
import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from topicflow.operators import changelog, tables
from topicflow.operators.running import running, unordered
from topicflow.operators.tokens import space_tokens
from topicflow.plans import flows

SLOTS = [{}, {"slot_bits": 1}, {"slot_bits": (1, 2, 3)}, {"slot_bits": 1, "hot_rows": 2}, {"levels": 0}]
PROPERTY = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


@pytest.fixture(scope="module")
def lines(spark):
    return spark.createDataFrame(fixtures.COLOUR_LINES, fixtures.COLOUR_SCHEMA)


@pytest.fixture(scope="module")
def accounts(spark):
    return spark.createDataFrame(fixtures.account_rows(), fixtures.ACCOUNT_SCHEMA)


def colours(spark, rows):
    return spark.createDataFrame(rows, "seq bigint, key string, value string")


def test_latest_value(lines):
    latest = tables.latest_value(flows.colour_updates(lines))
    assert {r.key: r.value for r in latest.collect()} == {"ALICE": "BLUE", "BOB": "BLUE", "DAVE": "GREEN", "": "RED"}


def test_favourite_colour_keeps_zero(lines):
    assert {r.value: r.n for r in flows.favourite_colour(lines).collect()} == fixtures.COLOUR_COUNTS
    early = flows.favourite_colour(lines.where("seq <= 10"))
    assert {r.value: r.n for r in early.collect()} == fixtures.COLOUR_COUNTS_AT_10


def test_latest_balance(accounts):
    found = {r.key: (r.id, r.amount, r.timestamp) for r in flows.latest_balance(accounts).collect()}
    assert found == fixtures.ACCOUNTS


def test_null_keys_are_skipped(spark):
    words = spark.createDataFrame([("a",), (None,)], "word string")
    assert [tuple(r) for r in tables.count_per_key(words).collect()] == [("a", 1)]


@pytest.mark.parametrize("slots", SLOTS)
def test_running_balance(accounts, slots):
    found = changelog.running_balance(accounts, **slots).orderBy("seq").collect()
    assert [(r.id, r.amount, r.timestamp) for r in found] == [event[5] for event in fixtures.ACCOUNT_EVENTS]


@pytest.mark.parametrize("slots", SLOTS)
def test_running_colours(lines, slots):
    found = changelog.running_value_count(flows.colour_updates(lines), **slots).orderBy("seq", "step").collect()
    assert [(r.seq, r.value, r.n) for r in found] == fixtures.COLOUR_CHANGES


@pytest.mark.parametrize("slots", SLOTS)
def test_running_words(spark, slots):
    sentences = spark.createDataFrame(fixtures.SENTENCES, fixtures.SENTENCE_SCHEMA)
    counted = changelog.running_count(space_tokens(sentences, lower=True), **slots)
    assert [(r.seq, r.n) for r in counted.where("word = 'the'").orderBy("seq", "pos").collect()] == [(1, 1), (1, 2), (3, 3), (6, 4)]
    last = counted.groupBy("word").agg(F.max("n").alias("n")).collect()
    assert {r.word: r.n for r in last} == fixtures.LOWER_COUNTS


@pytest.mark.parametrize("before", [False, True])
@pytest.mark.parametrize("combine", ["sum", "max"])
def test_running_against_brute_force_with_a_hot_key(spark, before, combine):
    dice = random.Random(7)
    rows = [
        (dice.choice(["hot", "hot", "a", "b", "c"]), seq, tie, dice.randint(-9, 9))
        for seq in dice.sample(range(-500, 100_000), 400)
        for tie in range(dice.randint(1, 3))
    ]
    start = {"hot": 3, "a": -4, "unused": 1}
    df = spark.createDataFrame(rows, "k string, seq bigint, tie int, v bigint")
    initial = spark.createDataFrame(list(start.items()), "k string, state bigint")

    fold = {"sum": lambda x, y: x + y, "max": max}[combine]
    state, expected = dict(start), set()
    for k, seq, tie, v in sorted(rows, key=lambda r: r[1:3]):
        old = state.get(k)
        state[k] = v if old is None else fold(old, v)
        expected.add((k, seq, tie, v, old if before else state[k]))

    for slots in SLOTS + [
        {"slot_bits": 2, "levels": 3},
        {"slot_bits": 5},
        {"slot_bits": 0, "levels": 1},
        {"slot_bits": 5, "hot_rows": 150},
        {"slot_bits": 3, "hot_rows": 10**6},
    ]:
        found = running(
            df, ["k"], "seq", F.col("v"), getattr(F, combine), "out", ties=["tie"], before=before, initial=initial, **slots
        )
        assert {tuple(r) for r in found.collect()} == expected
        assert found.columns == ["k", "seq", "tie", "v", "out"]


@PROPERTY
@given(st.lists(st.tuples(st.sampled_from("abc"), st.integers(-3, 30), st.integers(0, 99)), min_size=1, max_size=25))
def test_balances_against_a_plain_fold(spark, events):
    rows = [(seq, key, seq + 100, float(amount), ts) for seq, (key, ts, amount) in enumerate(events)]
    state, after = {}, []
    for seq, key, id, amount, ts in rows:
        _, old_amount, old_ts = state.get(key, (0, 0.0, 0))
        state[key] = (id, amount, ts) if ts > old_ts else (id, old_amount, old_ts)
        after.append((seq, key, *state[key]))
    shuffled = random.Random(1).sample(rows, len(rows))
    df = spark.createDataFrame(shuffled, fixtures.ACCOUNT_SCHEMA)
    found = changelog.running_balance(df, slot_bits=2).select("seq", "key", "id", "amount", "timestamp")
    assert sorted(tuple(r) for r in found.collect()) == after
    assert {r.key: (r.id, r.amount, r.timestamp) for r in tables.latest_by_event_time(df).collect()} == state


@PROPERTY
@given(st.lists(st.tuples(st.sampled_from("abcd"), st.sampled_from(["X", "Y", "Z"])), min_size=1, max_size=25))
def test_colours_against_a_plain_fold(spark, updates):
    rows = [(seq, user, colour) for seq, (user, colour) in enumerate(updates)]
    latest, counts, expected = {}, {}, []
    for seq, user, colour in rows:
        if user in latest:
            counts[latest[user]] -= 1
            expected.append((seq, 0, latest[user], counts[latest[user]]))
        latest[user] = colour
        counts[colour] = counts.get(colour, 0) + 1
        expected.append((seq, 1, colour, counts[colour]))
    df = colours(spark, random.Random(2).sample(rows, len(rows)))
    found = changelog.running_value_count(df, slot_bits=2)
    assert sorted(tuple(r) for r in found.collect()) == expected
    assert {r.value: r.n for r in tables.count_by_current_value(df).collect()} == counts
    assert sum(counts.values()) == len(latest)


@pytest.mark.parametrize("before", [False, True])
@pytest.mark.parametrize("hot_rows", [None, 1])
@pytest.mark.parametrize("started", [False, True])
def test_a_row_without_a_number_is_an_error_or_set_aside(spark, before, hot_rows, started):
    df = spark.createDataFrame([("a", 1), ("a", None), ("b", 2)], "k string, seq bigint")
    initial = spark.createDataFrame([("a", 5)], "k string, state bigint") if started else None

    def run(rows):
        one = F.lit(1).cast("bigint")
        return running(rows, ["k"], "seq", one, F.sum, "n", before=before, initial=initial, hot_rows=hot_rows, slot_bits=1)

    with pytest.raises(Exception, match="has no place in the order"):
        run(df).collect()
    found = {r.k: r.n for r in run(df.where("seq IS NOT NULL")).collect()}
    first = None if before else 1
    assert found == {"a": (5 if before else 6) if started else first, "b": first}
    assert len(found) + unordered(df).count() == df.count()


def test_a_record_that_repeats_a_word_and_sparse_numbers(spark):
    rows = [(1, "w " * 300), (1 << 40, "w x"), ((1 << 62) + 5, "x w w"), (-(1 << 61), "w")]
    df = spark.createDataFrame(rows, "seq bigint, value string")
    counted = changelog.running_count(space_tokens(df))
    found = [(r.seq, r.n) for r in counted.where("word = 'w'").orderBy("seq", "pos").collect()]
    seqs = [-(1 << 61)] + [1] * 300 + [1 << 40] + [(1 << 62) + 5] * 2
    assert found == list(zip(seqs, range(1, 305)))
