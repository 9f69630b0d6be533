"""Mixing sources to target weights by Poisson replication.

Each source has a target repetition rate: its share of the mix divided by its share of
the input.  A document appears as often as a Poisson variable of that mean says, found by
inverting the distribution's cumulative function at a uniform number that the document's
id, its text and a seed hash to.  So the mix needs no state, no ordering and no counting beyond one
row per source; it is the same on every run, and a document's count does not depend on
what other tasks hold.  The text has a part in the hash, so that rows without an id, or with one
id, are drawn each by itself.  Copies are then dealt out by a hash of (seed, id, text, copy) and
sorted by it, which is a random order of the whole mix.
"""

from __future__ import annotations

import math
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from topicflow.llm.common import fresh_name, written

SEED = "mix"
#: Without given weights a source weighs as its number of documents to this power.
TEMPERATURE = 0.5
#: Above it a document would be repeated so often that the given weights are surely a mistake.  Weights that
#: follow from the sources' sizes have no limit: at the default temperature no rate is above the root of the rows.
MAX_RATE = 1000
#: Sources that are looked up in a broadcast table; beyond it they are joined.
BROADCAST_SOURCES = 1 << 12
#: From this rate on the probabilities of counts far below it are left out.
LARGE_RATE = 400


def _key(source: str) -> Column:
    """The source as a text that keeps null apart from every name."""
    return F.when(F.col(source).isNull(), F.lit("-")).otherwise(F.concat(F.lit("+"), F.col(source).cast("string")))


def source_rates(
    df: DataFrame,
    source: str = "source",
    weights: Mapping[str | None, float] | None = None,
    temperature: float = TEMPERATURE,
    size: float = 1.0,
) -> DataFrame:
    """(source_key, n, rate) of each source in ``df``.

    ``weights``: relative weight by source; sources that are not named get none.  ``size``:
    documents in the mix for each one in the input.
    """
    counted = df.groupBy(_key(source).alias("source_key")).agg(F.count(F.lit(1)).alias("n"))
    if weights is None:
        weight = F.pow(F.col("n").cast("double"), F.lit(temperature))
    else:
        weight = F.lit(0.0)
        for name, value in weights.items():
            key = "-" if name is None else f"+{name}"
            weight = F.when(F.col("source_key") == key, F.lit(float(value))).otherwise(weight)
    weighed = counted.withColumn("weight", weight)
    total = weighed.agg(F.sum("weight"), F.sum("n")).first()
    if not total[0]:
        return weighed.select("source_key", "n", F.lit(0.0).alias("rate"))
    rate = F.col("weight") / F.lit(float(total[0])) * F.lit(float(total[1]) * size) / F.col("n")
    return weighed.select("source_key", "n", rate.alias("rate"))


def _drawn(seed: str, id: Column, text: Column) -> Column:
    """What a row is drawn by: the seed, its id and a digest of its text."""
    digest = F.md5(F.coalesce(text.cast("string"), F.lit("")).cast("binary"))
    return F.concat_ws("|", F.lit(seed), F.coalesce(id.cast("string"), F.lit("null")), digest)


def uniform(name: Column) -> Column:
    """A number between 0 and 1 from 52 bits of the name's hash."""
    digits = F.substring(F.md5(name.cast("binary")), 1, 13)
    return (F.conv(digits, 16, 10).cast("double") + 0.5) / float(1 << 52)


def least_count(rate: Column) -> Column:
    """The count from which ``cumulative`` starts; what lies below has a probability under 1e-20."""
    return F.when(rate < LARGE_RATE, F.lit(0)).otherwise(F.floor(rate - 10 * F.sqrt(rate) - 25).cast("int"))


def cumulative(rate: Column) -> Column:
    """Poisson probabilities of at most k, from ``least_count`` up to where the rest is below 1e-16."""
    last = F.ceil(rate + 10 * F.sqrt(rate) + 25).cast("int")
    low = least_count(rate)
    # exp(low * ln(rate) - rate) / low!, the factorial by Stirling's series, as it is that of 0 or of 175 and more
    large = low * F.log(rate / low) + (low - rate) - 0.5 * F.log(2 * math.pi * low) - 1 / (12 * low) + 1 / (360 * F.pow(low.cast("double"), F.lit(3.0)))
    first = F.exp(F.when(rate < LARGE_RATE, -rate).otherwise(large))

    def add(done: Column, k: Column) -> Column:
        p = done["p"] * rate / k
        total = done["total"] + p
        return F.struct(p.alias("p"), total.alias("total"), F.concat(done["sums"], F.array(total)).alias("sums"))

    start = F.struct(first.alias("p"), first.alias("total"), F.array(first).alias("sums"))
    sums = F.aggregate(F.sequence(low + 1, last), start, add, lambda done: done["sums"])
    return F.when(rate > 0, sums).otherwise(F.array(F.lit(1.0)))


def mix_sources(
    df: DataFrame,
    id: str = "doc_id",
    source: str = "source",
    text: str = "text",
    weights: Mapping[str | None, float] | None = None,
    temperature: float = TEMPERATURE,
    size: float = 1.0,
    seed: str = SEED,
    copy: str | None = None,
    order: str | None = None,
    max_rate: float = MAX_RATE,
) -> DataFrame:
    """The mix: the columns of ``df``, and, where they are named, a ``copy`` number and the ``order`` key.

    A null source is a source of its own.  Rows with the same id and text share one number of copies per
    source; a repeated row is repeated by itself.  Null and empty texts are alike.  An empty
    table gives an empty mix, and so do weights that name none of its sources.  ``copy`` and ``order`` must
    not be columns of ``df``.  Given weights that would repeat a source more than ``max_rate`` times are an error.
    """
    for name in (copy, order):
        if name is not None and fresh_name(df, name) != name:
            raise ValueError(f"the table has a column {name} already")
    rates = written(source_rates(df, source, weights, temperature, size), "rates")
    sources, highest = rates.agg(F.count(F.lit(1)), F.max("rate")).first()
    if weights is not None and highest is not None and (highest > max_rate or math.isnan(highest)):
        raise ValueError(f"a source would be repeated {highest:.0f} times; the limit is {max_rate}")
    key, cdf, least, number, drawn = (fresh_name(df, n) for n in ("_source_key", "_cdf", "_least", "_copy", "_drawn"))
    order_key = order or fresh_name(df, "_order")
    # one row per source: few of them are looked up where the rows are; among many none is hot enough to matter, or Spark splits it
    table = rates.select(F.col("source_key").alias(key), cumulative(F.col("rate")).alias(cdf), least_count(F.col("rate")).alias(least))
    table = F.broadcast(table) if sources <= BROADCAST_SOURCES else table
    rows = df.withColumns({key: _key(source), drawn: _drawn(seed, F.col(id), F.col(text))}).join(table, key)
    draw = uniform(F.col(drawn))
    times = F.col(least) + F.size(F.filter(F.col(cdf), lambda c: c < draw))
    copies = rows.select(
        *df.columns, drawn, F.explode(F.when(times > 0, F.sequence(F.lit(1), times))).alias(number)
    )
    name = F.concat_ws("|", drawn, F.col(number).cast("string"))
    # copies of a row that very many tasks hold are told apart by the task, so they do not all go to one place
    dealt = copies.withColumn(order_key, F.md5(name.cast("binary"))).repartition(F.col(order_key), F.spark_partition_id())
    dealt = dealt.sortWithinPartitions(order_key)
    kept = [F.col(c) for c in df.columns]
    if copy:
        kept.append(F.col(number).alias(copy))
    if order:
        kept.append(F.col(order_key))
    return dealt.select(*kept)
