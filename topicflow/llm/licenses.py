"""Licence scans: notices found in texts, and licences inherited from directories.

Each line of a text, each block of lines between blank ones, and the whole of a licence
file is a sparse TF-IDF vector that is compared with the templates' by cosine.  Document
frequencies of the templates' terms are counted over all texts; a term that no template
has takes the weight of one that no text has, so strange words only lower a score.

Few lines need comparing.  Of each template the heaviest terms are anchors, as many as it
takes for the others to fall short of the threshold by themselves: a line, block or file
with no anchor cannot reach the threshold, so it is passed over unread.

A file without a notice of its own has the licence of the nearest directory, from its own
upwards, that holds a licence file.  Ancestors are listed once per directory and joined to
the directories that have licences; the files are joined to the outcome.
"""

from __future__ import annotations

import math
import re
import string
from collections import Counter
from collections.abc import Iterator, Mapping

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from topicflow.llm.common import written

THRESHOLD = 0.75

# Customary notices, by licence.
TEMPLATES: dict[str, list[str]] = {
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance '
        "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    ],
    "MIT": [
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction',
    ],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ],
    "GPL-2.0": [
        "This work is licensed under the GNU General Public License, version 2.",
    ],
    "BSD-3-Clause": [
        "Released under the BSD License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met",
        "Licensed under the BSD 3-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of "
        "conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, "
        "this list of conditions and the following disclaimer in the documentation and/or other materials provided with the "
        "distribution. 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or "
        "promote products derived from this software without specific prior written permission.",
    ],
    "BSD-2-Clause": [
        "Licensed under the BSD 2-Clause License.",
        "Released under the Simplified BSD License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of "
        "conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, "
        "this list of conditions and the following disclaimer in the documentation and/or other materials provided with the "
        "distribution.",
    ],
    "LGPL-3.0": [
        "This work is licensed under the GNU Lesser General Public License, version 3.",
        "This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ],
    "LGPL-2.1": [
        "This work is licensed under the GNU Lesser General Public License, version 2.1.",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public "
        "License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",
    ],
    "AGPL-3.0": [
        "This work is licensed under the GNU Affero General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ],
    "ISC": [
        "Released under the ISC License.",
        "Licensed under the ISC License.",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
        "provided that the above copyright notice and this permission notice appear in all copies.",
    ],
    "Unlicense": [
        "Released under the Unlicense.",
        "This is free and unencumbered software released into the public domain.",
    ],
    "CC0-1.0": [
        "Licensed under CC0 1.0.",
        "This work is licensed under the Creative Commons CC0 1.0 Universal Public Domain Dedication.",
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
    ],
    "MPL-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    ],
    "CC-BY-4.0": ["Licensed under CC BY 4.0.", "This work is licensed under the Creative Commons Attribution 4.0 International License."],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0.", "This work is licensed under the Creative Commons Attribution-NonCommercial 4.0 International License."],
    "CC-BY-SA-4.0": ["Licensed under CC BY-SA 4.0.", "This work is licensed under the Creative Commons Attribution-ShareAlike 4.0 International License."],
    "All-Rights-Reserved": ["All rights reserved.", "Copyright (c). All rights reserved.", "Copyright ©. All rights reserved."],
}
#: Stands beside licences too, as in BSD's copyright line, so any other notice goes before it.
RESERVED = "All-Rights-Reserved"

LICENCE_FILE = r"(?i)^(licen[cs]e|copying|notice)([.-].*)?$"
EDGES = string.punctuation + "“”‘’«»"
BLANK = re.compile(r"\n[ \t\r]*\n")


def terms(text: str) -> list[str]:
    return [t for w in text.lower().split() if (t := w.strip(EDGES))]


def vocabulary(templates: Mapping[str, list[str]]) -> set[str]:
    return {t for texts in templates.values() for text in texts for t in terms(text)}


def document_frequencies(df: DataFrame, text: str, known: set[str]) -> tuple[int, dict[str, int]]:
    """The number of texts, and of those that have each of ``known`` terms, whose number has a bound."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            counts[""] += batch.num_rows
            for one in batch.column(0).to_pylist():
                counts.update({t for w in set(one.lower().split()) if (t := w.strip(EDGES)) in known})
        yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], names=["term", "n"])

    rows = df.select(F.coalesce(F.col(text), F.lit(""))).mapInArrow(run, "term string, n long")
    found = {r["term"]: r["n"] for r in rows.groupBy("term").agg(F.sum("n").alias("n")).collect()}
    return found.pop("", 0), found


class Scanner:
    """Compares texts with templates."""

    def __init__(self, templates: Mapping[str, list[str]], texts: int, frequencies: Mapping[str, int], threshold: float = THRESHOLD):
        self.threshold = threshold
        self.strange = math.log(1 + texts) + 1
        self.idf = {t: math.log((1 + texts) / (1 + frequencies.get(t, 0))) + 1 for t in vocabulary(templates)}
        self.templates: list[tuple[str, dict[str, float]]] = []
        self.postings: dict[str, list[tuple[int, float]]] = {}
        self.anchors: set[str] = set()
        for name, texts_ in sorted(templates.items()):
            for text in texts_:
                weights = self.weights(Counter(terms(text)))
                norm = math.sqrt(sum(w * w for w in weights.values()))
                place = len(self.templates)
                self.templates.append((name, weights))
                rest = 1.0
                for term, w in sorted(weights.items(), key=lambda x: (-x[1], x[0])):
                    self.postings.setdefault(term, []).append((place, w / norm))
                    if rest >= threshold * threshold:
                        self.anchors.add(term)
                        rest -= (w / norm) ** 2
        self.find = re.compile("|".join(map(re.escape, sorted(self.anchors, key=len, reverse=True))))

    def weights(self, counts: Counter) -> dict[str, float]:
        return {t: (1 + math.log(n)) * self.idf.get(t, self.strange) for t, n in counts.items()}

    def compare(self, counts: Counter) -> tuple[float, str] | None:
        """The best template's cosine and licence."""
        if not counts:
            return None
        weights = self.weights(counts)
        dots: dict[int, float] = {}
        for term, w in weights.items():
            for place, v in self.postings.get(term, ()):
                dots[place] = dots.get(place, 0.0) + w * v
        if not dots:
            return None
        norm = math.sqrt(sum(w * w for w in weights.values()))
        place = min(dots, key=lambda p: (-dots[p], self.templates[p][0]))
        return min(1.0, dots[place] / norm), self.templates[place][0]

    def scan(self, text: str | None, whole: bool = False) -> tuple[str | None, float | None]:
        """The licence and cosine of the best line, block, or with ``whole`` also the whole text; reserved rights only if there is no other."""
        lower = (text or "").lower()
        if not self.find.search(lower):
            return None, None
        best: tuple[float, str] | None = None

        def rank(found: tuple[float, str]) -> tuple[bool, float, str]:
            return found[1] == RESERVED, -found[0], found[1]

        def meet(counts: Counter) -> None:
            nonlocal best
            if self.anchors.isdisjoint(counts):
                return
            found = self.compare(counts)
            if found and found[0] >= self.threshold and (best is None or rank(found) < rank(best)):
                best = found

        everything: Counter = Counter()
        for block in BLANK.split(lower):
            if not whole and not self.find.search(block):
                continue
            together: Counter = Counter()
            lines = block.split("\n")
            for line in lines:
                counts = Counter(terms(line))
                together.update(counts)
                meet(counts)
            if len(lines) > 1:
                meet(together)
            if whole:
                everything.update(together)
        if whole:
            meet(everything)
        return (best[1], best[0]) if best else (None, None)


def directory(path: Column) -> Column:
    """The path up to its last slash; the root is the empty text."""
    return F.when(F.instr(path, "/") == 0, F.lit("")).otherwise(F.regexp_replace(path, "/[^/]*$", ""))


def ancestors(dir: Column) -> Column:
    """(at, distance) of the directory and of all above it, the root last."""
    parts = F.when(dir == "", F.array().cast("array<string>")).otherwise(F.split(dir, "/"))
    return F.transform(
        F.sequence(F.lit(0), F.size(parts)),
        lambda up: F.struct(F.array_join(F.slice(parts, F.lit(1), F.size(parts) - up), "/").alias("at"), up.alias("distance")),
    )


def scan_licenses(
    df: DataFrame,
    path: str = "path",
    text: str = "text",
    id: str = "doc_id",
    templates: Mapping[str, list[str]] = TEMPLATES,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """(doc_id, path, license, score, basis, distance), a row for each row of ``df``.

    ``basis``: ``own`` for a notice in the text, ``inherited`` from the licence file of a
    directory ``distance`` levels above the file's (0: its own), or null for none.  Of several
    licence files in a directory the best match counts, ties to the first name.  Reserved rights
    are a notice like any other, but count only where there is no licence beside them.  A null path
    is at the root and no licence file; null and empty texts have no notice; repeated rows
    are scanned each.  An empty table gives no rows.
    """
    texts, frequencies = document_frequencies(df, text, vocabulary(templates))
    scanner = Scanner(templates, texts, frequencies, threshold)

    @F.pandas_udf("license string, score double")
    def scan(found: pd.Series, whole: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([scanner.scan(t, w) for t, w in zip(found, whole)], columns=["license", "score"]).astype({"score": "float64"})

    place = F.coalesce(F.col(path), F.lit(""))
    is_file = F.coalesce(F.substring_index(place, "/", -1).rlike(LICENCE_FILE), F.lit(False))
    rows = df.select(
        F.col(id).alias("doc_id"), F.col(path).alias("path"), directory(place).alias("dir"), is_file.alias("is_file"), scan(F.col(text), is_file).alias("own")
    )
    rows = written(rows.select("doc_id", "path", "dir", "is_file", "own.license", "own.score"), "scanned")
    held = rows.where("is_file AND license IS NOT NULL").groupBy(F.col("dir").alias("at")).agg(
        F.min(F.struct(F.col("license") == RESERVED, -F.col("score"), F.col("license").alias("license"))).alias("best")
    )
    dirs = rows.where("license IS NULL").select("dir").distinct()  # a row for each directory, however many files it has
    above = dirs.select("dir", F.explode(ancestors(F.col("dir"))).alias("up")).select("dir", "up.at", "up.distance")
    nearest = above.join(held, "at").groupBy("dir").agg(F.min(F.struct("distance", F.col("best.license").alias("from_dir"))).alias("nearest"))
    nearest = nearest.select("dir", "nearest.*")
    own = F.col("license").isNotNull()
    return rows.join(nearest, "dir", "left").select(
        "doc_id",
        "path",
        F.coalesce("license", "from_dir").alias("license"),
        "score",
        F.when(own, "own").when(F.col("from_dir").isNotNull(), "inherited").alias("basis"),
        F.when(~own, F.col("distance")).alias("distance"),
    )
