import fixtures
import pytest
from pyspark.sql import functions as F

from topicflow.operators.pairs import bad_pairs, keep_allowed, parse_pairs, rekey
from topicflow.operators.tables import count_per_key
from topicflow.operators.tokens import space_tokens, unicode_tokens
from topicflow.plans import flows


@pytest.fixture(scope="module")
def sentences(spark):
    return spark.createDataFrame(fixtures.SENTENCES, fixtures.SENTENCE_SCHEMA)


@pytest.fixture(scope="module")
def lines(spark):
    return spark.createDataFrame(fixtures.COLOUR_LINES, fixtures.COLOUR_SCHEMA)


def test_counts_of_both_tokenisers(sentences):
    for flow in (flows.unicode_word_count, flows.space_word_count):
        assert {r.word: r.n for r in flow(sentences).collect()} == fixtures.LOWER_COUNTS


def test_case_is_kept_without_lower(sentences):
    counts = {r.word: r.n for r in count_per_key(space_tokens(sentences)).collect()}
    assert len(counts) == 23 and sum(counts.values()) == 29
    assert (counts["the"], counts["Harbour"], counts["Low"], counts["LOW"], counts["tide"]) == (4, 2, 1, 1, 2)


def test_words_keep_their_place_and_the_record(sentences):
    words = [(r.pos, r.word) for r in unicode_tokens(sentences).where("seq = 3").orderBy("pos").collect()]
    assert words == list(enumerate(["the", "tide", "turns", "at", "noon", "or", "later"]))
    assert space_tokens(sentences).columns == ["seq", "key", "value", "pos", "word"]


def test_token_explode_appends_the_word(spark):
    topic = spark.createDataFrame([("t", 0, 7, "k", "A b ", 1)], "topic string, partition int, offset bigint, key string, value string, seq bigint")
    found = flows.token_explode(topic).orderBy("pos").collect()
    assert [tuple(r) for r in found] == [("t", 7, "k", "A b ", 0, 0, "A"), ("t", 7, "k", "A b ", 0, 1, "b")]


def test_null_text_gives_no_words_and_empty_text_gives_one(spark):
    df = spark.createDataFrame([(None,), ("",), ("   ",)], "value string")
    assert [r.word for r in space_tokens(df).collect()] == [""]
    assert [r.word for r in unicode_tokens(df).collect()] == [""]


def test_pairs_and_bad_rows(lines):
    good = {r.seq: (r.key, r.v) for r in parse_pairs(lines, value="v").collect()}
    assert good == {
        1: ("ALICE", "RED"),
        2: ("BOB", "BLUE"),
        3: ("ALICE", "BLUE"),
        4: ("BOB", "YELLOW"),
        7: ("CARL", " RED"),
        8: ("DAVE", "GREEN"),
        10: ("BOB", "BLUE"),
        12: ("", "RED"),
    }
    assert {r.seq for r in bad_pairs(lines).collect()} == {9, 11}


def test_empty_second_part_is_not_bad(spark):
    df = spark.createDataFrame([("a,,b",), ("a,,",)], "value string")
    assert [(r.key, r.v) for r in parse_pairs(df, value="v").collect()] == [("A", "")]
    assert [r.value for r in bad_pairs(df).collect()] == ["a,,"]


def test_allow_list_as_list_and_as_table(spark, lines):
    pairs = parse_pairs(lines)
    for allowed in (["RED", "BLUE", "GREEN"], spark.createDataFrame([("RED",), ("BLUE",), ("GREEN",), ("RED",)], "c string")):
        found = keep_allowed(pairs, "value", allowed).orderBy("seq").select("seq", "key", "value").collect()
        assert [tuple(r) for r in found] == fixtures.COLOUR_UPDATES


def test_rekey_drops_null_keys(spark):
    df = spark.createDataFrame([("k", "v"), ("k", None)], "key string, value string")
    assert [tuple(r) for r in rekey(df, F.col("value")).collect()] == [("v", "v")]
