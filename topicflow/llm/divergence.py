"""How far the sources of each language lie apart, by the terms they use.

A term is a run of letters and of non-ASCII characters.  On UTF-8 bytes one translate table
lowers A-Z, keeps a-z and everything above ASCII, and blanks the rest, so that the terms of a
text are what ``split`` finds.  Each text is counted in a ``Counter`` of its own, which gives
how often a term occurs and in how many texts; a task adds these up before it hands them on.

A language keeps the terms that enough of its texts hold.  Each group (language, source) gives
each kept term a smoothed share in billionths.  Two groups differ by the sum of their shares'
differences.  Of that sum only terms that one of the groups holds are computed one by one; all
others have the group's share of an absent term, and are counted.  Shares are whole numbers,
computed in decimals, so results do not depend on the sequence of additions.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from topicflow.llm.common import utf8, written

#: Fixed rule: A-Z is lowered, a-z and bytes above ASCII stay, all others separate.
LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
LEAST_DOCS = 30
SMOOTHING = 5
SCALE = 1_000_000_000
TOP_TERMS = 50
#: Bytes of a text that are split at a time.
BLOCK = 1 << 20
#: Different (group, term) pairs that a task holds before it hands them on.
HELD = 1 << 18
#: Terms, and sources on either side, of a block of differences.
BLOCK_TERMS = 1 << 12
TILE = 64


def term_counts(text: bytes, block: int = BLOCK) -> Counter:
    """How often each term occurs in a UTF-8 text."""
    blank, counts, at = text.translate(LETTERS), Counter(), 0
    while at < len(blank):
        end = blank.find(b" ", at + block)
        end = len(blank) if end < 0 else end
        counts.update(blank[at:end].split())
        at = end
    return counts


def count_terms(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs) of (lang, source, text); several rows for one term from several tasks."""

    def rows(held: dict) -> pa.RecordBatch:
        columns = [[], [], [], [], []]
        for (lang, source), (n, docs) in held.items():
            for column, values in zip(columns, ([lang] * len(n), [source] * len(n), n.keys(), n.values(), map(docs.get, n))):
                column.extend(values)
        lang, source, terms, n, found = columns
        return pa.record_batch(
            {
                "lang": pa.array(lang, pa.string()),
                "source": pa.array(source, pa.string()),
                "term": pa.array(terms, pa.binary()).cast(pa.string()),
                "n": pa.array(n, pa.int64()),
                "docs": pa.array(found, pa.int64()),
            }
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = {}, 0
        for batch in batches:
            groups = zip(batch.column("lang").to_pylist(), batch.column("source").to_pylist())
            for group, text in zip(groups, batch.column("text")):
                n, found = held.setdefault(group, (Counter(), Counter()))
                before = len(n)
                own = term_counts(text.as_py())
                n.update(own)
                found.update(own.keys())
                size += len(n) - before
                if size >= HELD:
                    yield rows(held)
                    held, size = {}, 0
        if held:
            yield rows(held)

    return docs.mapInArrow(run, "lang string, source string, term string, n bigint, docs bigint")


def share(n: Column, total: Column, terms: Column, smoothing: int = SMOOTHING) -> Column:
    """The smoothed share of a term in billionths, and one; exact at any count."""
    above = F.lit(SCALE).cast("decimal(10,0)") * (n.cast("decimal(19,0)") + F.lit(smoothing).cast("decimal(3,0)"))
    below = total.cast("decimal(19,0)") + F.lit(smoothing).cast("decimal(3,0)") * terms.cast("decimal(13,0)")
    return F.call_function("div", above, F.nullif(below, F.lit(0).cast("decimal(1,0)"))) + 1


def differences(shares: DataFrame, groups: DataFrame, block_terms: int = BLOCK_TERMS, tile: int = TILE) -> DataFrame:
    """(lang, a, b, value) of every two groups a < b of a language.

    ``shares`` (lang, term, nth, p): shares of the terms that group ``nth`` holds.  ``groups``
    (lang, nth, absent, terms, sources): its share of a term it does not hold, and how many terms and groups the
    language has.  Work is dealt by blocks of terms and tiles of groups.
    """

    def dealt(rows: DataFrame, block: Column) -> DataFrame:
        own = F.floor(F.col("nth") / tile).cast("int")
        others = F.sequence(F.lit(0), F.floor((F.col("sources") - 1) / tile).cast("int"))
        rows = rows.select("lang", block.alias("block"), "term", "nth", "p", own.alias("own"), F.explode(others).alias("other"))
        low, high = F.least("own", "other"), F.greatest("own", "other")
        return rows.select("lang", "block", low.alias("low"), high.alias("high"), "term", "nth", "p")

    def compare(key: tuple, rows: pa.Table) -> pa.Table:
        low, high = key[2].as_py(), key[3].as_py()
        terms, nth = rows.column("term").combine_chunks(), rows.column("nth").to_numpy()
        p = rows.column("p").to_numpy()
        whole = terms.is_null().to_numpy(zero_copy_only=False)  # a group's own row
        numbers, absent = nth[whole], p[whole]
        order = np.argsort(numbers)
        numbers, absent = numbers[order], absent[order]
        names = terms.filter(pa.array(~whole)).dictionary_encode()
        found = np.repeat(absent[None, :], len(names.dictionary), axis=0)
        found[names.indices.to_numpy(), np.searchsorted(numbers, nth[~whole])] = p[~whole]
        a, b, values = [], [], []
        for i in np.flatnonzero(numbers // tile == low):
            others = np.flatnonzero((numbers // tile == high) & (numbers > numbers[i]))
            apart = np.abs(found[:, others] - found[:, i : i + 1]).sum(axis=0)
            # the terms met here are no longer among the absent ones
            a.append(np.full(len(others), numbers[i])), b.append(numbers[others])
            values.append(apart - len(found) * np.abs(absent[others] - absent[i]))
        columns = [np.concatenate(c) if c else np.zeros(0, np.int64) for c in (a, b, values)]
        lang = pa.repeat(key[0], len(columns[0])).cast(pa.string())
        return pa.table({"lang": lang, "a": columns[0].astype(np.int32), "b": columns[1].astype(np.int32), "more": columns[2]})

    blocks = F.greatest(F.ceil(F.col("terms") / block_terms), F.lit(1)).cast("int")
    known = shares.join(groups.select("lang", "nth", "terms", "sources"), ["lang", "nth"])
    known = dealt(known, F.pmod(F.xxhash64("term"), blocks).cast("int"))
    own = groups.withColumns({"term": F.lit(None).cast("string"), "p": F.col("absent")})
    own = own.withColumn("block", F.explode(F.sequence(F.lit(0), blocks - 1)))
    both = known.unionByName(dealt(own, F.col("block")))
    more = both.groupBy("lang", "block", "low", "high").applyInArrow(compare, "lang string, a int, b int, more bigint")
    more = more.groupBy("lang", "a", "b").agg(F.sum("more").alias("more"))
    for end in "ab":
        absent = groups.select("lang", F.col("nth").alias(end), F.col("absent").alias(f"absent_{end}"), F.col("terms").alias(f"terms_{end}"))
        more = more.join(absent, ["lang", end])
    rest = F.col("terms_a") * F.abs(F.col("absent_a") - F.col("absent_b"))
    return more.select("lang", "a", "b", (F.col("more") + rest).alias("value"))


def divergence(
    df: DataFrame,
    text: str = "text",
    lang: str = "lang",
    source: str = "source",
    least_docs: int = LEAST_DOCS,
    smoothing: int = SMOOTHING,
    top_terms: int = TOP_TERMS,
) -> DataFrame:
    """(lang, source, part, item, value, rank): what sets each source of a language apart.

    Part ``pair``: every other source of the language by falling difference.  Part ``term``: the
    ``top_terms`` terms that the source uses more than its language does, by falling difference.
    Ties go to the item that sorts first.  Null texts, languages and sources count as empty.
    Repeated rows count each.  A language without kept terms has differences of zero and no term
    rows; one with a single source has no pairs; an empty table gives no rows.  Other columns
    do not matter.  Long texts are split in blocks, so memory follows the text and its different terms.
    """
    docs = df.select(
        F.coalesce(F.col(lang), F.lit("")).alias("lang"),
        F.coalesce(F.col(source), F.lit("")).alias("source"),
        utf8(text).alias("text"),
    )
    counts = count_terms(docs).groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    # a list is as long as the language has sources
    own = F.collect_list(F.struct("source", "n")).alias("own")
    terms = counts.groupBy("lang", "term").agg(F.sum("n").alias("total"), F.sum("docs").alias("docs"), own)
    terms = written(terms.where(F.col("docs") >= least_docs).drop("docs"), "terms")
    held = terms.select("lang", "term", "total", F.inline("own"))

    by_lang = terms.groupBy("lang").agg(F.sum("total").alias("lang_total"), F.count(F.lit(1)).alias("terms"))
    by_group = held.groupBy("lang", "source").agg(F.sum("n").alias("group_total"))
    in_lang = Window.partitionBy("lang")
    groups = docs.select("lang", "source").distinct().join(by_group, ["lang", "source"], "left").join(by_lang, "lang", "left")
    groups = groups.fillna(0, ["group_total", "lang_total", "terms"]).withColumns(
        {"nth": F.row_number().over(in_lang.orderBy("source")) - 1, "sources": F.count(F.lit(1)).over(in_lang)}
    )
    absent = F.coalesce(share(F.lit(0), F.col("group_total"), F.col("terms"), smoothing), F.lit(0))
    groups = written(groups.withColumn("absent", absent), "groups")

    shares = held.join(groups, ["lang", "source"]).select(
        "lang",
        "source",
        "nth",
        "term",
        share(F.col("n"), F.col("group_total"), F.col("terms"), smoothing).alias("p"),
        share(F.col("total"), F.col("lang_total"), F.col("terms"), smoothing).alias("q"),
    )
    shares = written(shares, "shares")

    apart = differences(shares.select("lang", "term", "nth", "p"), groups.select("lang", "nth", "absent", "terms", "sources"))
    ends = F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))
    apart = apart.select("lang", "value", F.inline(ends))
    for end, name in (("a", "source"), ("b", "item")):
        apart = apart.join(groups.select("lang", F.col("nth").alias(end), F.col("source").alias(name)), ["lang", end])

    def ranked(rows: DataFrame, part: str) -> DataFrame:
        rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
        return rows.select("lang", "source", F.lit(part).alias("part"), "item", "value", rank.alias("rank"))

    above = shares.where("p > q").select("lang", "source", F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))
    return ranked(apart, "pair").unionByName(ranked(above, "term").where(F.col("rank") <= top_terms))
