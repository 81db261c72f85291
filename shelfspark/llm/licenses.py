"""Licence scan: sparse TF-IDF cosine of statements to templates, then inheritance from the nearest directory.

Every line of a file that holds a term of a template, at any place of the whole text, is compared with all templates by
the cosine of TF-IDF vectors; the best one at or above ``THRESHOLD`` is the file's own licence. Document frequencies
of the templates' terms are counted over all files; a word that no template has weighs as much as the rarest term.

A file named as a licence (``LICENSE``, ``COPYING`` and so on) speaks for its directory. Files without a licence of
their own take that of the nearest directory above them: the distinct directories are joined with their own ancestors,
so the join grows with directories and their depth and not with files, and a crowded directory is one row.

Ties: the higher cosine, then the earlier line, then the licence's name; of several licence files in a directory the
higher cosine, then the smaller path. A null or empty text has no licence of its own but may inherit; a null path has
no directory and inherits nothing. Rows that repeat a path are judged each by its text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfspark.llm.common import slices

THRESHOLD = 0.7
LICENSE_FILE = r"(?i)^(un)?licen[cs]e|^copying|^copyright|^notice"

# Usual one-line notices by SPDX name.
TEMPLATES = {
    "MIT": ("Released under the MIT License.", "Licensed under the MIT license.", "SPDX-License-Identifier: MIT"),
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
        "SPDX-License-Identifier: Apache-2.0",
    ),
    "GPL-3.0": (
        "This work is licensed under the GNU General Public License, version 3.",
        "it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License",
        "SPDX-License-Identifier: GPL-3.0",
    ),
    "GPL-2.0": ("Licensed under the GNU General Public License, version 2.", "SPDX-License-Identifier: GPL-2.0"),
    "LGPL-3.0": ("Licensed under the GNU Lesser General Public License, version 3.", "SPDX-License-Identifier: LGPL-3.0"),
    "AGPL-3.0": ("Licensed under the GNU Affero General Public License, version 3.", "SPDX-License-Identifier: AGPL-3.0"),
    "BSD-3-Clause": ("Licensed under the BSD 3-Clause License.", "SPDX-License-Identifier: BSD-3-Clause"),
    "BSD-2-Clause": ("Licensed under the BSD 2-Clause License.", "SPDX-License-Identifier: BSD-2-Clause"),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "SPDX-License-Identifier: MPL-2.0",
    ),
    "ISC": ("Licensed under the ISC License.", "SPDX-License-Identifier: ISC"),
    "CC-BY-4.0": ("Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    "CC-BY-SA-4.0": (
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ),
    "CC-BY-NC-4.0": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ),
    "CC-BY-ND-4.0": ("Licensed under CC BY-ND 4.0.",),
    "CC0-1.0": ("Dedicated to the public domain under CC0 1.0.", "SPDX-License-Identifier: CC0-1.0"),
    "Unlicense": ("This is free and unencumbered software released into the public domain.",),
    "Proprietary": ("All rights reserved.", "Copyright. All rights reserved."),
}

_TERM = re.compile(r"[^\W_]+(?:\.\d+)*")
#: Terms that make a line worth comparing.
_STRONG = re.compile(r"(?i)licen[cs]|spdx|copyright|public domain|rights reserved")


def terms(text: str) -> list[str]:
    return _TERM.findall(text.lower())


class Templates:
    """Unit vectors of the templates over their terms, with inverse document frequencies of a corpus."""

    def __init__(self, templates: Mapping[str, tuple[str, ...]], n_files: int, frequency: Mapping[str, int]):
        flat = [(name, terms(t)) for name in sorted(templates) for t in templates[name]]
        self.names = [name for name, _ in flat]
        self.term = {t: k for k, t in enumerate(sorted({t for _, ts in flat for t in ts}))}
        self.rare = float(np.log((1 + n_files) / 1) + 1)
        self.idf = np.array([np.log((1 + n_files) / (1 + frequency.get(t, 0))) + 1 for t in self.term])
        self.vectors = np.array([self.vector(ts)[0] for _, ts in flat])

    def vector(self, words: list[str]) -> tuple[np.ndarray, int]:
        """The unit vector's part over known terms, and the number of those."""
        counts, other = np.zeros(len(self.term)), {}
        for w in words:
            k = self.term.get(w)
            if k is None:
                other[w] = other.get(w, 0) + 1
            else:
                counts[k] += 1
        weighted = counts * self.idf
        norm = np.sqrt((weighted**2).sum() + sum(n * n for n in other.values()) * self.rare**2)
        return (weighted / norm if norm else weighted), int((counts > 0).sum())

    def best(self, text: str | None, threshold: float) -> tuple[str | None, float | None, int | None]:
        """Licence, cosine and line of the best statement."""
        found = (None, None, None)
        if not text or not _STRONG.search(text):
            return found
        for number, line in enumerate(text.split("\n")):
            if not _STRONG.search(line):
                continue
            # A statement may stand within a long line: windows of a template's length are compared too.
            words = terms(line)
            spans = {(0, len(words))}
            for m in (k for k, w in enumerate(words) if w in ("licensed", "license", "licence", "released", "spdx", "this", "all", "dedicated")):
                spans |= {(m, m + n) for n in (3, 4, 6, 7, 8, 11)}
            for a, b in sorted(spans):
                vector, known = self.vector(words[a:b])
                if known < 2:
                    continue
                scores = self.vectors @ vector
                k = int(scores.argmax())
                score = round(float(scores[k]), 9)
                if score >= threshold and (found[1] is None or score > found[1]):
                    found = (self.names[k], score, number)
        return found


def term_frequencies(files: DataFrame, templates: Mapping[str, tuple[str, ...]], text: str) -> tuple[int, dict[str, int]]:
    """How many files there are, and how many hold each term of a template (as many rows as terms)."""
    wanted = frozenset(t for ts in templates.values() for s in ts for t in terms(s))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, int] = {}
        n = 0
        for batch in slices(batches, "text"):
            for t in batch["text"].to_pylist():
                n += 1
                for w in wanted.intersection(terms(t)) if t else ():
                    seen[w] = seen.get(w, 0) + 1
        yield pa.RecordBatch.from_arrays(
            [pa.array([None, *seen], pa.string()), pa.array([n, *seen.values()], pa.int64())], ["term", "n"]
        )

    rows = files.select(F.col(text).alias("text")).mapInArrow(count, "term string, n long").groupBy("term").agg(F.sum("n").alias("n"))
    found = {r["term"]: r["n"] for r in rows.collect()}
    return found.pop(None, 0), found


def own_licenses(files: DataFrame, templates: Templates, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """All columns of ``files`` with ``own_license, own_score, own_line`` of the best statement in the text."""
    shared = files.sparkSession.sparkContext.broadcast(templates)

    @F.pandas_udf("license string, score double, line int")
    def best(texts):
        import pandas as pd

        rows = [shared.value.best(t, threshold) for t in texts]
        return pd.DataFrame(rows, columns=["license", "score", "line"]).astype({"score": "float64", "line": "Int32"})

    found = files.withColumn("own", best(F.col(text)))
    return found.select(
        *files.columns,
        F.col("own.license").alias("own_license"),
        F.col("own.score").alias("own_score"),
        F.col("own.line").alias("own_line"),
    )


def directory_licenses(judged: DataFrame, path: str = "path") -> DataFrame:
    """``directory, license``: what the licence files in each directory say."""
    name, folder = F.element_at(F.split(path, "/"), -1), F.regexp_extract(path, r"^(.*)/[^/]*$", 1)
    best = F.min(F.struct((-F.col("own_score")).alias("s"), F.col(path).alias("p"), F.col("own_license").alias("l")))
    return (
        judged.where(F.col("own_license").isNotNull() & name.rlike(LICENSE_FILE))
        .groupBy(folder.alias("directory"))
        .agg(best.alias("b"))
        .select("directory", F.col("b.l").alias("license"))
    )


def nearest_licenses(directories: DataFrame, licensed: DataFrame) -> DataFrame:
    """``directory, inherited, inherited_from``: for each directory the licence of the nearest one at or above it."""
    parts = F.split("directory", "/")
    above = directories.select("directory", parts.alias("parts")).select(
        "directory", F.explode(F.sequence(F.lit(0), F.size("parts"))).alias("depth"), "parts"
    )
    above = above.select("directory", "depth", F.array_join(F.slice("parts", 1, F.col("depth")), "/").alias("ancestor"))
    # A path with a leading slash has an empty first part: the root and depth 1 are then both "".
    nearest = F.max(F.struct("depth", "license", "ancestor")).alias("x")
    return (
        above.join(licensed.withColumnRenamed("directory", "ancestor"), "ancestor")
        .groupBy("directory")
        .agg(nearest)
        .select("directory", F.col("x.license").alias("inherited"), F.col("x.ancestor").alias("inherited_from"))
    )


def scan_licenses(
    files: DataFrame,
    path: str = "path",
    text: str = "text",
    templates: Mapping[str, tuple[str, ...]] = TEMPLATES,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """``files`` without the text, with ``license, origin (own, inherited, none), score, line, inherited_from``."""
    fitted = Templates(templates, *term_frequencies(files, templates, text))
    kept = files.drop("license", "origin", "score", "line", "inherited_from", "own_license", "own_score", "own_line", "directory")
    judged = own_licenses(kept, fitted, text, threshold).drop(text)
    judged = judged.withColumn("directory", F.regexp_extract(path, r"^(.*)/[^/]*$", 1))
    nearest = nearest_licenses(judged.select("directory").where("directory IS NOT NULL").distinct(), directory_licenses(judged, path))
    joined = judged.join(nearest, "directory", "left")
    own = F.col("own_license").isNotNull()
    return joined.select(
        *(c for c in kept.columns if c != text),
        F.coalesce("own_license", "inherited").alias("license"),
        F.when(own, "own").when(F.col("inherited").isNotNull(), "inherited").otherwise("none").alias("origin"),
        F.col("own_score").alias("score"),
        F.col("own_line").alias("line"),
        F.when(~own, F.col("inherited_from")).alias("inherited_from"),
    )
