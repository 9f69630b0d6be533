"""Delimited ``key,value`` lines: parse, set bad rows aside, filter by allow-list, re-key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from topicflow.functions.text import has_two_parts

SEPARATOR = ","


def _delimited(df: DataFrame, line: str, separator: str) -> DataFrame:
    return df.where(F.col(line).isNotNull() & F.col(line).contains(separator))


def parse_pairs(
    df: DataFrame, line: str = "value", key: str = "key", value: str = "value", separator: str = SEPARATOR
) -> DataFrame:
    """Upper-cased first and second part of each delimited line; nothing is trimmed.

    Null lines and lines without the separator are dropped; lines with fewer than
    two parts are left to :func:`bad_pairs`.
    """
    text, sep = F.col(line), F.lit(separator)
    good = _delimited(df, line, separator).where(has_two_parts(text, separator))
    return good.withColumns(
        {
            key: F.upper(F.split_part(text, sep, F.lit(1))),
            value: F.upper(F.split_part(text, sep, F.lit(2))),
        }
    )


def bad_pairs(df: DataFrame, line: str = "value", separator: str = SEPARATOR) -> DataFrame:
    """Lines that hold the separator but fewer than two parts, such as ``a,`` or ``,``."""
    return _delimited(df, line, separator).where(~has_two_parts(F.col(line), separator))


def keep_allowed(df: DataFrame, column: str, allowed: Sequence[str] | DataFrame) -> DataFrame:
    """Rows whose column is on the allow-list.

    A Python list becomes a pushed-down ``IN``; a one-column DataFrame becomes a
    semi-join, where Spark broadcasts the list only if its size permits.
    """
    if isinstance(allowed, DataFrame):
        names = allowed.toDF(column).distinct()
        return df.join(names, column, "left_semi")
    return df.where(F.col(column).isin(list(allowed)))


def rekey(df: DataFrame, key_expr: Column, key: str = "key") -> DataFrame:
    """Set the key; rows without one cannot be grouped and are dropped."""
    return df.withColumn(key, key_expr).where(F.col(key).isNotNull())
