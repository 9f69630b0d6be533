"""Column functions for splitting text the way the JVM's ``String.split`` does.

The rule (limit 0): leading empty strings stay, trailing empty strings go, and
the empty string splits into itself.  Spark's ``split`` keeps the trailing ones,
so each function below says how it gets rid of them without a second pass over
the text.  All of them are built-in expressions; null in, null out.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The word and non-word classes, Unicode-aware.
WORD_RUN = r"(?U)\w+"
LEADING_SEPARATORS = r"(?U)\A\W+\w"


def _empty() -> Column:
    return F.array().cast("array<string>")


def split_words(text: Column) -> Column:
    r"""Split on runs of non-word characters (``\W+``, Unicode-aware).

    The pieces are exactly the runs of word characters, with one empty string in
    front when the text starts with a separator and has a word after it.  Matching
    the words (not the separators) leaves no trailing piece to remove and stays
    linear on long separator runs.
    """
    words = F.regexp_extract_all(text, F.lit(WORD_RUN), F.lit(0))
    return (
        F.when(text == "", F.array(F.lit("")))
        .when(text.rlike(LEADING_SEPARATORS), F.concat(F.array(F.lit("")), words))
        .otherwise(words)
    )


def split_literal(text: Column, separator: str) -> Column:
    """Split on every occurrence of one character.

    Trailing empty pieces come from trailing separators, so trimming those first
    is enough.
    """
    if len(separator) != 1:
        raise ValueError("separator must be a single character")
    kept = F.rtrim(text, F.lit(separator))
    return (
        F.when(text == "", F.array(F.lit("")))
        .when(kept == "", _empty())
        .otherwise(F.split(kept, rf"\Q{separator}\E", -1))
    )


def split_spaces(text: Column) -> Column:
    """Split on every single space; two spaces in a row give an empty piece."""
    return split_literal(text, " ")


def has_two_parts(text: Column, separator: str) -> Column:
    """True when :func:`split_literal` would give at least two pieces."""
    return F.rtrim(text, F.lit(separator)).contains(separator)
