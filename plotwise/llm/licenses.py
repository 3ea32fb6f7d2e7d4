"""License scans: TF-IDF cosine of lines to license templates, and nearest-ancestor inheritance.

Every line of every whole text is compared with every template in a sparse TF-IDF space. The vocabulary is that
of the templates; document frequencies are counted over all documents; a word outside the vocabulary
weighs as one that no document holds. A line that reaches ``MIN_COSINE`` carries that license.

Whole license texts and standard headers (``license_texts``) are compared, in a space of their own, with every window of
a text that has as many words as the template; a text with fewer words, but at least half of them, is one
window. Comment marks and line breaks are no words, so wrapped headers and texts match. Cosines are calculated for the
window of the greatest product in each run of windows that could reach ``MIN_COSINE``. A license file
(by its name) speaks for its directory; a file without a license of its own takes that of the nearest
ancestor directory that has one, found by joins on directory paths.

Directories are resolved, not files: ancestors are listed once per distinct directory, so a directory of very many
files costs one row. Neither the ancestors nor the license files' directories are broadcast: both grow with the
tree, and the size of a compressed file tells little about them.

Defined results: null and empty texts carry no license and may inherit one; null paths neither give nor take;
of several matching lines and windows (a window's line is that of its first word) the best counts, then the earliest, ties of templates go to the smaller name; of several
license files in a directory the best score counts, then the smaller license, then the smaller path; repeated
rows give a row each; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plotwise.llm.tables import stage
from plotwise.llm.text import ALNUM, LOWER, buffer, distinct, slices, word_hashes, word_spans

#: License statements (fixed values), by SPDX name.
TEMPLATES = {
    "Apache-2.0": ["Licensed under the Apache License, Version 2.0", "SPDX-License-Identifier: Apache-2.0", "Apache License Version 2.0, January 2004"],
    "BSD-2-Clause": ["Licensed under the BSD 2-Clause License", "SPDX-License-Identifier: BSD-2-Clause"],
    "BSD-3-Clause": ["Licensed under the BSD 3-Clause License", "SPDX-License-Identifier: BSD-3-Clause"],
    "CC-BY-4.0": ["Licensed under CC BY 4.0", "Licensed under the Creative Commons Attribution 4.0 International License"],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0", "Licensed under the Creative Commons Attribution-NonCommercial 4.0 International License"],
    "CC-BY-SA-4.0": ["Licensed under CC BY-SA 4.0", "Licensed under the Creative Commons Attribution-ShareAlike 4.0 International License"],
    "CC0-1.0": ["CC0 1.0 Universal public domain dedication", "SPDX-License-Identifier: CC0-1.0"],
    "GPL-2.0": ["This work is licensed under the GNU General Public License, version 2", "SPDX-License-Identifier: GPL-2.0"],
    "GPL-3.0": ["This work is licensed under the GNU General Public License, version 3", "SPDX-License-Identifier: GPL-3.0"],
    "ISC": ["Licensed under the ISC License", "SPDX-License-Identifier: ISC"],
    "LGPL-3.0": ["This library is licensed under the GNU Lesser General Public License, version 3", "SPDX-License-Identifier: LGPL-3.0"],
    "MIT": ["Released under the MIT License", "Licensed under the MIT License", "SPDX-License-Identifier: MIT"],
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0", "SPDX-License-Identifier: MPL-2.0"],
    "Unlicense": ["This is free and unencumbered software released into the public domain"],
}
MIN_COSINE = 0.75
#: Part of a template's words that a text must have to be compared with it.
LEAST_PART = 0.5
LICENSE_NAME = r"(?i)^(licen[cs]e|copying|unlicense)([.-][^/]*)?$"


@cache
def license_texts() -> dict[str, list[str]]:
    """Whole texts and headers by SPDX name, from ``NAME[.header].txt`` (read on the driver only)."""
    out: dict[str, list[str]] = {}
    for path in sorted(Path(__file__).with_name("license_texts").glob("*.txt")):
        out.setdefault(path.name.removesuffix(".txt").removesuffix(".header"), []).append(path.read_text())
    return out


def _words(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, row and start of every word."""
    low = LOWER[buf]
    s, e, row = word_spans(low, off, ALNUM)
    return word_hashes(low, s, e, ALNUM), row, s


class Space:
    """The templates' vocabulary, and the templates as unit vectors once frequencies are known."""

    def __init__(self, templates: dict[str, list[str]] = TEMPLATES):
        flat = sorted((name, text) for name, texts in templates.items() for text in texts)
        self.names = [n for n, _ in flat]
        h, row, _ = _words(*buffer(pa.array([t for _, t in flat], pa.string())))
        self.terms = np.unique(h)
        self.counts = np.zeros((len(flat), len(self.terms)))
        np.add.at(self.counts, (row, np.searchsorted(self.terms, h)), 1.0)

        self.sizes = np.bincount(row, minlength=len(flat))

    def place(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        k = np.minimum(np.searchsorted(self.terms, h), len(self.terms) - 1)
        return k, self.terms[k] == h

    def weigh(self, df: np.ndarray, n_docs: int) -> None:
        self.idf = np.log((1.0 + n_docs) / (1.0 + df)) + 1.0
        self.rare = float(np.log(1.0 + n_docs) + 1.0)
        v = self.counts * self.idf
        self.units = v / np.linalg.norm(v, axis=1, keepdims=True)

    def matches(self, texts: pa.Array, least: float) -> list[tuple[int, int, float, int]]:
        """(row, template, cosine, line) of each row's best line, where it reaches ``least``."""
        buf, off = buffer(texts)
        h, row, start = _words(buf, off)
        if not len(h):
            return []
        breaks = np.flatnonzero(buf == 0x0A)
        line = np.searchsorted(breaks, start) + row  # rows and line breaks both advance the number
        order = np.lexsort((h, line))
        h, line, row, start = h[order], line[order], row[order], start[order]
        new = np.ones(len(h), bool)
        new[1:] = (h[1:] != h[:-1]) | (line[1:] != line[:-1])
        head = np.flatnonzero(new)
        tf = np.diff(np.concatenate([head, [len(h)]])).astype(float)
        h, line, row, start = h[head], line[head], row[head], start[head]
        k, known = self.place(h)
        weight = tf * np.where(known, self.idf[k], self.rare)
        lines, at = np.unique(line, return_inverse=True)
        norm = np.sqrt(np.bincount(at, weight**2))
        inside = np.sqrt(np.bincount(at, np.where(known, weight**2, 0.0)))
        may = inside >= least * norm  # no cosine exceeds the vocabulary's share of the line
        number = np.cumsum(may) - 1
        use = known & may[at]
        vectors = np.zeros((int(may.sum()), len(self.terms)))
        vectors[number[at[use]], k[use]] = weight[use]
        cos = (vectors @ self.units.T) / norm[may][:, None] if len(vectors) else np.zeros((0, len(self.names)))
        best: dict[int, tuple[float, int, int]] = {}
        row_of = np.zeros(len(lines), np.int64)
        row_of[at] = row
        row_start = np.searchsorted(breaks, off[:-1])
        for i, r, l_ in zip(range(len(cos)), row_of[may].tolist(), lines[may].tolist(), strict=True):
            t = int(np.argmax(np.round(cos[i], 12)))  # equal cosines: the smaller name comes first
            if cos[i, t] >= least and (r not in best or cos[i, t] > best[r][0] + 1e-12):
                best[r] = (float(cos[i, t]), t, int(l_ - r - row_start[r]))
        return [(r, t, c, ln) for r, (c, t, ln) in best.items()]


    def windows(self, texts: pa.Array, least: float) -> list[tuple[int, int, float, int]]:
        """(row, template, cosine, line) of each row's best window, where it reaches ``least``."""
        buf, off = buffer(texts)
        h, row, start = _words(buf, off)
        if not len(h) or not len(self.names):
            return []
        k, known = self.place(h)
        weight = np.where(known, self.idf[k], self.rare)
        mass = np.concatenate([[0.0], np.cumsum(weight**2)])
        edges = np.searchsorted(row, np.arange(len(off)))
        n_words, end = np.diff(edges)[row], edges[1:][row]
        place = np.arange(len(h))
        own = np.where(known, k, len(self.terms))
        best: dict[int, tuple[float, int, int]] = {}
        for t, m in enumerate(self.sizes.tolist()):
            unit = np.append(self.units[t] * self.idf, 0.0)
            total = np.concatenate([[0.0], np.cumsum(unit[own])])
            first = np.flatnonzero((place + m <= end) | ((place == end - n_words) & (n_words >= LEAST_PART * m)))
            if not len(first):
                continue
            last = np.minimum(first + m, end[first])
            product = total[last] - total[first]
            # a word's squared frequency is its frequency at least, so no window's norm is smaller
            may = np.flatnonzero(product >= least * np.sqrt(mass[last] - mass[first]) - 1e-9)
            if not len(may):
                continue
            new = np.concatenate([[True], (np.diff(first[may]) > 1) | (np.diff(row[first[may]]) > 0)])
            for run in np.split(may, np.flatnonzero(new)[1:]):
                j = run[int(np.argmax(np.round(product[run], 9)))]
                a, b = int(first[j]), int(last[j])
                _, one, tf = np.unique(h[a:b], return_index=True, return_counts=True)
                cos = float(product[j] / np.linalg.norm(tf * weight[a:b][one]))
                r = int(row[a])
                if cos >= least and (r not in best or cos > best[r][0] + 1e-12):
                    best[r] = (cos, t, a)
        return [(r, t, c, int(np.count_nonzero(buf[off[r] : start[a]] == 0x0A))) for r, (c, t, a) in best.items()]


def _df_rows(space: Space):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros(len(space.terms), np.int64), 0
        for b in slices(batches):
            h, row, _ = _words(*buffer(b.column("text")))
            k, known = space.place(h)
            k, _ = distinct(k[known].astype(np.uint64), row[known])
            total += np.bincount(k.astype(np.int64), minlength=len(total))
            n += b.num_rows
        yield pa.RecordBatch.from_arrays([pa.array([*range(len(total)), -1], pa.int64()), pa.array([*total.tolist(), n], pa.int64())], ["term", "n"])

    return rows


def own_licenses(files: DataFrame, templates: dict[str, list[str]] = TEMPLATES, least: float = MIN_COSINE, texts: dict[str, list[str]] | None = None) -> DataFrame:
    """doc_id, path, own_license, own_score, line (null where nothing reaches ``least``), one row per row of ``files``
    (doc_id, path, text); ``texts``: whole texts and headers, by default ``license_texts()``."""
    texts = license_texts() if texts is None else texts
    space, whole = Space(templates), Space(texts)
    both = Space({n: [*templates.get(n, []), *texts.get(n, [])] for n in {**templates, **texts}})
    # one row per template word
    df = {r["term"]: r["n"] for r in files.select("text").mapInArrow(_df_rows(both), "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).collect()}
    for s in (space, whole):
        s.weigh(np.array([df.get(i, 0) for i in both.place(s.terms)[0].tolist()], float), df.get(-1, 0))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            name, score, line = ([None] * b.num_rows for _ in range(3))
            for r, t, c, at in space.matches(b.column("text"), least):
                name[r], score[r], line[r] = space.names[t], round(c, 6), at
            for r, t, c, at in whole.windows(b.column("text"), least):
                if score[r] is None or (-round(c, 6), at) < (-score[r], line[r]):
                    name[r], score[r], line[r] = whole.names[t], round(c, 6), at
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("path"), pa.array(name, pa.string()), pa.array(score, pa.float64()), pa.array(line, pa.int64())], ["doc_id", "path", "own_license", "own_score", "line"])

    # scored once: the result is read several times
    return stage(files.select(F.col("doc_id").cast("long").alias("doc_id"), "path", "text").mapInArrow(rows, "doc_id long, path string, own_license string, own_score double, line long"), "licenses")


def directory(path: Column) -> Column:
    """Directory of a file's path; empty for the root."""
    return F.regexp_replace(path, "/?[^/]*$", "")


def inherit(files: DataFrame) -> DataFrame:
    """Adds license (own or inherited), inherited_from (directory, null if own) to (path, own_license, own_score, ...)."""
    name = F.element_at(F.split("path", "/"), -1)
    placed = files.withColumn("_dir", directory(F.col("path")))
    rank = F.struct((-F.col("own_score")).alias("s"), F.col("own_license").alias("l"), "path")
    # staged, so that Spark can split the ancestors of a license that very many directories are below
    speaks = stage(placed.filter(F.col("own_license").isNotNull() & name.rlike(LICENSE_NAME)).groupBy("_dir")
                   .agg(F.min(rank).alias("_best")).select(F.col("_dir").alias("_at"), F.col("_best.l").alias("_license")), "license-directories")
    parts = F.split("_dir", "/")
    up = F.transform(F.sequence(F.lit(0), F.when(F.col("_dir") == "", 0).otherwise(F.size(parts))), lambda i: F.struct(i.alias("_depth"), F.when(i == 0, F.lit("")).otherwise(F.array_join(F.slice(parts, 1, F.greatest(i, F.lit(1))), "/")).alias("_at")))
    listed = placed.filter(F.col("_dir").isNotNull()).select("_dir").distinct().withColumn("_up", F.explode(up)).select("_dir", "_up._depth", "_up._at")
    nearest = listed.hint("merge").join(speaks, "_at").groupBy("_dir").agg(F.max(F.struct("_depth", "_at", "_license")).alias("_near"))
    return (placed.join(nearest, "_dir", "left")
            .withColumn("license", F.coalesce("own_license", "_near._license"))
            .withColumn("inherited_from", F.when(F.col("own_license").isNull(), F.col("_near._at"))).drop("_dir", "_near"))
