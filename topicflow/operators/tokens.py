"""One row per word: the flatten operators.

Each takes a DataFrame with a text column and returns it with the word and its
position in the text added; all other columns stay.  They are narrow (no shuffle)
and work on batch and streaming DataFrames alike.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from topicflow.functions.text import split_spaces, split_words


def unicode_tokens(df: DataFrame, text: str = "value", word: str = "word", pos: str = "pos") -> DataFrame:
    """Lower-case the text, then one row per piece between non-word runs."""
    # a column of its own, so that the several uses in the split share one evaluation
    rows = df.withColumn("_lower", F.lower(F.col(text)))
    return rows.select("*", F.posexplode(split_words(F.col("_lower"))).alias(pos, word)).drop("_lower")


def space_tokens(
    df: DataFrame, text: str = "value", word: str = "word", pos: str = "pos", lower: bool = False
) -> DataFrame:
    """One row per piece between single spaces; ``lower`` lower-cases each piece."""
    rows = df.select("*", F.posexplode(split_spaces(F.col(text))).alias(pos, word))
    return rows.withColumn(word, F.lower(word)) if lower else rows
