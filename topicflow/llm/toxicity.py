"""Toxicity by a weighted lexicon, matched with Aho-Corasick on folded text.

Folding lower-cases, removes invisible characters and maps look-alikes (Cyrillic, Greek,
full-width, accented) and digit or sign substitutions onto one letter, so ``1dіo7``
reads ``idiot``.  The automaton finds lexicon terms that stand as words or begin them; a
match inside an exception phrase (the term with a certain neighbour) does not count.
The weights found are set against the text's length and turned into a probability.

The lexicon, its weights, the exceptions and the probability's three coefficients are
learned from labelled rows: from all of them, or from ``MAX_LABELLED`` taken by a hash of
their id.  A term's support is counted in families of texts that share the smallest hash of
their words, so that many copies of one toxic text do not make a term of each of its
words.  All terms with support are taken: there are no more of them than a ``MIN_SUPPORT``-th
of the candidates of the toxic labelled texts.
"""

from __future__ import annotations

import math
import re
import unicodedata
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from topicflow.llm.common import fresh_name, written

#: At most so many labelled rows are learned from.
MAX_LABELLED = 1 << 15
#: A term needs so many families of toxic texts ...
MIN_SUPPORT = 5
#: ... and to be so many times (natural log) as frequent in toxic texts.
MIN_WEIGHT = 2.0
MAX_WEIGHT = 6.0
#: Characters beside a term among which its neighbours are looked for first.
NEAR = 40
#: Beginnings of so many letters can be terms.
STEM_LETTERS = (5, 6, 7)
#: A phrase is an exception if so many clean texts have it, and so small a share of all is toxic.
EXCEPTION_SUPPORT = 5
EXCEPTION_TOXIC = 0.1

# Characters that are read as the Latin letters below them.
LOOKALIKES = "аеорсухіјѕԁһӏвкмнтαεικνορτυχβγωɑıⅼ"
LATIN = "aeopcyxijsdhlbkmhtaeiknoptuxbywail"
# Digits and signs that stand in for letters.
SUBSTITUTES = "0134578!|@$9"
LETTERS = "oieastbiiasg"

INVISIBLE = re.compile("[­​-‏⁠﻿]")
WORD = re.compile(r"[^\W_][\w@$!|]*")


def _folding() -> dict[int, str]:
    table = dict(zip(LOOKALIKES, LATIN)) | dict(zip(SUBSTITUTES, LETTERS))
    for code in (*range(0xC0, 0x250), *range(0x1E00, 0x1F00)):  # accented Latin: the letter without the accent
        base = unicodedata.normalize("NFD", chr(code))[0]
        if base != chr(code):
            table[chr(code)] = base
    for code in range(0xFF01, 0xFF5F):  # full width
        plain = chr(code - 0xFEE0)
        table[chr(code)] = table.get(plain, plain)
    # 1 and | stand for l as well as for i, so all of them become i
    return {ord(k): "i" if v == "l" else v.lower() for k, v in {"l": "i", **table}.items()}


FOLD = _folding()


def visible(text: str) -> str:
    text = text.lower()
    return text if text.isascii() else INVISIBLE.sub("", text)


def fold(text: str) -> str:
    """Character by character, so positions stay those of ``visible`` text."""
    return text.translate(FOLD)


def words(text: str) -> list[str]:
    """Folded words without the signs at their ends."""
    found = [w.rstrip("@$!|_") for w in WORD.findall(visible(text))]
    return fold("\n".join(found)).split("\n") if found else []


def _word_before(shown: str, start: int) -> str:
    """The word that ends last before ``start``, or nothing; looked for in ever longer stretches until it is seen whole."""
    size = NEAR
    while True:
        found = words(shown[max(0, start - size) : start])
        if len(found) > 1 or size >= start:
            return found[-1] if found else ""
        size *= 4


def _word_after(shown: str, end: int) -> str:
    """The word that begins first from ``end`` on, or nothing."""
    size = NEAR
    while True:
        found = words(shown[end : end + size])
        if len(found) > 1 or end + size >= len(shown):
            return found[0] if found else ""
        size *= 4


def family(text: str) -> int:
    """A number that a text shares with most of its near copies."""
    return min((zlib.crc32(w.encode()) for w in words(text)), default=0)


def candidates(text: str) -> set[str]:
    """The words of a text, and as ``stem*`` the beginnings of longer ones."""
    found = set(words(text))
    return found | {w[:n] + "*" for w in found for n in STEM_LETTERS if len(w) > n}


@dataclass
class Lexicon:
    """Weights of folded terms (whole words, or ``stem*`` for what begins longer ones), exception phrases and the coefficients of the probability."""

    weights: dict[str, float] = field(default_factory=dict)
    #: (previous word or "", term, next word or ""): one of the neighbours is given.
    exceptions: set[tuple[str, str, str]] = field(default_factory=set)
    #: Of 1, log(1 + weight found) and log(1 + weight found per 100 words).
    coefficients: tuple[float, float, float] = (-30.0, 0.0, 0.0)
    _automaton: object = field(default=None, repr=False, compare=False)

    def __getstate__(self) -> dict:
        return self.__dict__ | {"_automaton": None}

    @property
    def automaton(self):
        if self._automaton is None:
            self._automaton = ahocorasick.Automaton()
            for term in self.weights:
                self._automaton.add_word(term.removesuffix("*"), term.removesuffix("*"))
            if self.weights:
                self._automaton.make_automaton()
        return self._automaton

    def matches(self, text: str) -> list[tuple[int, str, str, str]]:
        """(start, previous word, term, next word) of each term that stands as a word in ``text``."""
        shown = visible(text)
        folded = fold(shown)
        found = []
        if not self.weights:
            return found
        for last, term in self.automaton.iter(folded):
            start, end = last + 1 - len(term), last + 1
            if start and shown[start - 1].isalpha():
                continue
            if end < len(shown) and shown[end].isalpha():
                term += "*"
            if term not in self.weights:
                continue
            found.append((start, _word_before(shown, start), term, _word_after(shown, end)))
        return found

    def weight(self, text: str) -> float:
        at: dict[int, float] = {}  # a word counts once, by the heaviest of its stems and itself
        for start, before, term, after in self.matches(text):
            if (before, term, "") not in self.exceptions and ("", term, after) not in self.exceptions:
                at[start] = max(at.get(start, 0.0), self.weights[term])
        return sum(at.values())

    def features(self, text: str) -> tuple[float, float]:
        found = self.weight(text)
        return math.log1p(found), math.log1p(100 * found / max(1, text.count(" ") + 1))

    def score(self, text: str | None) -> float:
        a, b, c = self.coefficients
        total, dense = self.features(text or "")
        return 1 / (1 + math.exp(-max(-500.0, min(500.0, a + b * total + c * dense))))


# --- learning ---------------------------------------------------------------------


def labelled_rows(docs: DataFrame, labels: DataFrame, bound: int = MAX_LABELLED) -> DataFrame:
    """(text, toxic) of the labelled documents, of at most ``bound`` labels, written once.

    Labels that are null, or contradict each other for one id, are left out.
    """
    labels = labels.where("doc_id IS NOT NULL AND toxic IN (0, 1)").groupBy("doc_id").agg(
        F.min("toxic").alias("toxic"), F.max("toxic").alias("_other")
    )
    chosen = labels.where("toxic = _other").orderBy(F.xxhash64("doc_id"), "doc_id").limit(bound)
    rows = docs.select("doc_id", "text").where("text IS NOT NULL")
    return written(rows.join(chosen.select("doc_id", "toxic"), "doc_id").select("text", "toxic"), "labelled")


def _counted(df: DataFrame, counted, schema: str, limit: int = 1 << 20) -> DataFrame:
    """Sum what ``counted`` finds in each (text, toxic) row; a task hands on its counts whenever it holds ``limit``."""
    names = [part.split()[0] for part in schema.split(",")]

    def batch(counts: Counter) -> pa.RecordBatch:
        keys = list(counts)
        columns = [pa.array([k[i] for k in keys]) for i in range(len(names))]
        return pa.RecordBatch.from_arrays([*columns, pa.array(list(counts.values()), pa.int64())], names=[*names, "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for rows in batches:
            for text, toxic in zip(rows.column(0).to_pylist(), rows.column(1).to_pylist()):
                counts.update(counted(text, toxic))
                if len(counts) >= limit:
                    yield batch(counts)
                    counts = Counter()
        if counts:
            yield batch(counts)

    rows = df.select("text", F.col("toxic").cast("long")).mapInArrow(run, f"{schema}, n long")
    return rows.groupBy(*names).agg(F.sum("n").alias("n"))


def learn(docs: DataFrame, labels: DataFrame, bound: int = MAX_LABELLED) -> Lexicon:
    """A lexicon from documents (doc_id, text) and their labels (doc_id, toxic).

    Without labelled rows of both kinds the lexicon is empty and every score is nearly 0.
    """
    rows = labelled_rows(docs, labels, bound)
    totals = {r["toxic"]: r["n"] for r in rows.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    clean, toxic = totals.get(0, 0), totals.get(1, 0)
    if not clean or not toxic:
        return Lexicon()

    def found_in(text: str, label: int) -> set[tuple[str, int, int]]:
        of = family(text) if label else 0  # clean texts need no families
        return {(w, label, of) for w in candidates(text)}

    seen = _counted(rows, found_in, "term string, toxic long, family long")
    by_term = seen.groupBy("term").agg(
        F.sum(F.expr("IF(toxic = 1, n, 0)")).alias("toxic"),
        F.sum(F.expr("IF(toxic = 0, n, 0)")).alias("clean"),
        F.count_if(F.col("toxic") == 1).alias("families"),
    )
    odds = F.log((F.col("toxic") + 0.5) / (toxic + 1)) - F.log((F.col("clean") + 0.5) / (clean + 1))
    terms = by_term.withColumn("weight", odds).where(
        (F.col("families") >= MIN_SUPPORT) & (F.col("weight") >= MIN_WEIGHT) & (F.length("term") > 2)
    )
    lexicon = Lexicon({r["term"]: min(r["weight"], MAX_WEIGHT) for r in terms.collect()})

    around = _counted(
        rows,
        lambda text, label: {(family(text), *m[1:], label) for m in lexicon.matches(text)},
        "family long, before string, term string, after string, toxic long",
    )
    around = written(around, "around")
    support = around.where("toxic = 1").groupBy("term").agg(F.countDistinct("family").alias("n"))
    supported = {r["term"] for r in support.where(F.col("n") >= MIN_SUPPORT).collect()}
    lexicon.weights = {term: weight for term, weight in lexicon.weights.items() if term in supported}
    lexicon._automaton = None

    phrases = around.withColumn(
        "phrase",
        F.explode(F.array(F.struct("before", "term", F.lit("").alias("after")), F.struct(F.lit("").alias("before"), "term", "after"))),
    ).where("phrase.before != '' OR phrase.after != ''")
    phrases = phrases.groupBy("phrase").agg(
        F.sum("n").alias("n"), F.sum(F.expr("IF(toxic = 1, n, 0)")).alias("toxic")
    )
    harmless = phrases.where((F.col("n") >= EXCEPTION_SUPPORT) & (F.col("toxic") <= EXCEPTION_TOXIC * F.col("n")))
    # no more of them than the labelled texts have terms, over EXCEPTION_SUPPORT
    lexicon.exceptions = {tuple(r) for r in harmless.select("phrase.*").collect() if r["term"] in lexicon.weights}

    lexicon.coefficients = _coefficients(rows, lexicon)
    return lexicon


def _coefficients(rows: DataFrame, lexicon: Lexicon, ridge: float = 1e-2, steps: int = 50) -> tuple[float, float, float]:
    """Logistic regression of the label on the features, by Newton's method; equal features count together."""

    @F.pandas_udf("total double, dense double")
    def features(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([lexicon.features(t) for t in texts], columns=["total", "dense"]).round(3)

    data = rows.select("toxic", features("text").alias("f")).groupBy("toxic", "f").count().collect()
    x = np.array([[1.0, r["f"]["total"], r["f"]["dense"]] for r in data])
    y = np.array([float(r["toxic"]) for r in data])
    n = np.array([float(r["count"]) for r in data])
    w = np.zeros(3)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (n * (y - p)) - ridge * w
        hessian = (x * (n * p * (1 - p))[:, None]).T @ x + ridge * np.eye(3)
        step = np.linalg.solve(hessian, gradient)
        w += np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-6:
            break
    return tuple(w.tolist())


# --- scoring ----------------------------------------------------------------------


def with_scores(df: DataFrame, lexicon: Lexicon, text: str = "text", out: str = "score") -> DataFrame:
    """Add the probability that ``text`` is toxic; null counts as the empty text.

    Each row is scored by itself from its whole text, so repeated rows score alike.
    """

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        return pd.Series([lexicon.score(t) for t in texts], dtype="float64")

    return df.withColumn(out, score(F.col(text)))


def reject_toxic(df: DataFrame, lexicon: Lexicon, text: str = "text", threshold: float = 0.5) -> DataFrame:
    """The rows that score below ``threshold``, with the columns of ``df``."""
    score = fresh_name(df, "_score")
    return with_scores(df, lexicon, text, score).where(F.col(score) < threshold).select(*df.columns)
