"""The five dataflows, each as one expression over a topic.

All of them take a batch or a streaming DataFrame.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, types as T

from topicflow.operators.pairs import keep_allowed, parse_pairs
from topicflow.operators.records import FINAL_ACCOUNT, project_records
from topicflow.operators.tables import count_by_current_value, count_per_key, latest_by_event_time
from topicflow.operators.tokens import space_tokens, unicode_tokens
from topicflow.plans.inputs import COLOURS
from topicflow.sources.topics import translate

KEYED_FINAL_ACCOUNT = T.StructType([T.StructField("key", T.StringType(), False), *FINAL_ACCOUNT.fields])


def unicode_word_count(topic: DataFrame) -> DataFrame:
    """Topic → lower-cased words → count per word."""
    return count_per_key(unicode_tokens(topic))


def space_word_count(topic: DataFrame) -> DataFrame:
    """Topic → words between spaces, lower-cased → count per word."""
    return count_per_key(space_tokens(topic, lower=True))


def token_explode(topic: DataFrame) -> DataFrame:
    """Topic → record fields with one word appended per row, case kept."""
    return space_tokens(translate(topic), text="message")


def colour_updates(lines: DataFrame, allowed: Sequence[str] = COLOURS, line: str = "value") -> DataFrame:
    """``user,colour`` lines → (key, value, seq) updates of allowed colours."""
    return keep_allowed(parse_pairs(lines, line=line), "value", allowed).select("key", "value", "seq")


def favourite_colour(lines: DataFrame, allowed: Sequence[str] = COLOURS, line: str = "value") -> DataFrame:
    """``user,colour`` lines → latest colour per user → users per colour (batch only)."""
    return count_by_current_value(colour_updates(lines, allowed, line))


def latest_balance(events: DataFrame) -> DataFrame:
    """Account events → newest record per key, as the final account's fields."""
    return project_records(latest_by_event_time(events), KEYED_FINAL_ACCOUNT)
