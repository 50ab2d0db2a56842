"""Licence scans: TF-IDF cosine to templates, and inheritance from directories.

Every line of a text (its header may stand anywhere), runs of up to ``RUN``
neighbouring lines that are not blank (notices are wrapped) and the text as a whole
are sparse TF-IDF vectors. Lines and runs are held against the notices, the whole text
also against the full licence texts (``license_texts``). What comes close enough gives
the file its own licence; only runs that do are scored. A file that is
little else than a licence (the whole text comes close) is a licence file, and
its licence holds for its directory and all below. A file without a licence
of its own inherits that of the nearest directory above it that has a licence
file, found by joining the directories' paths.

Inverse document frequencies come from all texts; a word in no template weighs
like a word of one document. Of several candidates the largest cosine counts,
then the smaller licence name; of several licence files in a directory likewise (cosines to nine digits), then the smaller path.

Defined results: null and empty texts have no licence of their own but inherit
one; a null path has no directory and inherits nothing; repeated rows are
scanned one by one; an empty table gives an empty result; input columns named
like an added one give way. Very long texts are scanned whole, in time that grows with their words
(each is added to at most ``RUN`` runs) and with blocks of ``BLOCK`` lines in memory beside the text.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from functools import cache
from importlib.resources import files as package_files

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tspanel.llm.common import Scratch

#: Usual notices and the opening words of the licences.
TEMPLATES: tuple[tuple[str, str], ...] = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License. You may obtain a copy of the License at "
                   "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS, "
                   "WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License"),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, "
                "either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the "
                "implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details. You should have received a copy of the GNU General "
                "Public License along with this program. If not, see <https://www.gnu.org/licenses/>."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
)

#: Licences whose full text is in ``license_texts``, without copyright lines.
FULL = ("Apache-2.0", "BSD-3-Clause", "GPL-3.0", "MIT", "MPL-2.0")

WORDS = re.compile(r"[^\W_]+")
#: Comment marks that are words; the others have no letters.
MARKS = re.compile(r"^\s*(?:dnl|rem)\b")

#: Cosine from which a line, a run of lines or a text is taken to state a licence; lines of a run at most.
THRESHOLD, RUN = 0.7, 24

#: Lines whose runs are bounded at a time.
BLOCK = 4096


def terms(text: str) -> list[str]:
    return WORDS.findall(MARKS.sub("", text.lower()))


@cache
def full_texts() -> tuple[tuple[str, str], ...]:
    folder = package_files("tspanel.llm") / "license_texts"
    return tuple((name, (folder / f"{name}.txt").read_text(encoding="utf-8")) for name in FULL)


class Templates:
    """Unit TF-IDF vectors of the templates, and cosines to them."""

    def __init__(self, idf: dict[str, float], rare: float, templates: tuple[tuple[str, str], ...] = TEMPLATES):
        self.idf, self.rare = idf, rare
        self.postings: dict[str, list[tuple[int, float]]] = {}
        self.names = [n for n, _ in templates]
        for i, (_, text) in enumerate(templates):
            vector = {w: n * idf.get(w, rare) for w, n in Counter(terms(text)).items()}
            norm = math.sqrt(sum(x * x for x in vector.values()))
            for w, x in vector.items():
                self.postings.setdefault(w, []).append((i, x / norm))

    def part(self, words: list[str]) -> tuple[float, dict[int, float]]:
        """The squared norm, and the dot product with each template that has one of the words."""
        norm, dots = 0.0, {}
        for w, n in Counter(words).items():
            x = n * self.idf.get(w, self.rare)
            norm += x * x
            for i, y in self.postings.get(w, ()):
                dots[i] = dots.get(i, 0.0) + x * y
        return norm, dots

    def _top(self, norm: float, dots: dict[int, float]) -> tuple[float, str | None]:
        if not dots:
            return 0.0, None
        score, name = max(((d, self.names[i]) for i, d in dots.items()), key=lambda c: (round(c[0], 12), [-ord(ch) for ch in c[1]]))
        return min(1.0, score / math.sqrt(norm)), name

    def best(self, words: list[str]) -> tuple[float, str | None]:
        """The largest cosine and its licence; ties go to the smaller name."""
        return self._top(*self.part(words)) if not self.postings.keys().isdisjoint(words) else (0.0, None)

    def best_run(self, lines: list[list[str]], threshold: float = THRESHOLD, longest: int = RUN) -> tuple[float, str | None]:
        """The same for single lines, and for runs of them (blank ones left out) that reach the threshold.

        Dot products add up over lines and squared norms add up to at least their sum, which bounds a run's
        cosine. Where a bound reaches the threshold, the runs from that line on grow a line at a time, so a line is
        added at most ``longest`` times; equal stretches of ``longest`` lines are grown once a block.
        """
        ids: dict[tuple[str, ...], int] = {}
        at = [ids.setdefault(tuple(x), len(ids)) for x in lines if x]
        parts = [self.part(list(x)) for x in ids]
        top = max((self._top(*p) for p in parts), key=_order, default=(0.0, None))
        # a run that reaches the threshold has a line of threshold / sqrt(lines) or more
        if not any(dots and max(dots.values()) >= threshold / math.sqrt(longest) * math.sqrt(norm) - 1e-9 for norm, dots in parts):
            return top
        bags = [[(w, n, self.idf.get(w, self.rare) ** 2) for w, n in Counter(x).items()] for x in ids]
        for lo in range(0, len(at), BLOCK):
            block, seen = at[lo:lo + BLOCK + longest - 1], set()
            for bound, i, n in self._bounds([parts[x] for x in block], min(BLOCK, len(at) - lo), threshold, longest):
                if bound < max(threshold, top[0]) - 1e-6:
                    break
                run = tuple(block[i:i + n])
                if run not in seen:
                    seen.add(run)
                    top = max((top, *(c for c in self._grown(run, parts, bags) if c[0] >= threshold)), key=_order)
        return top

    def _bounds(self, parts: list[tuple[float, dict[int, float]]], starts: int, threshold: float, longest: int) -> list[tuple[float, int, int]]:
        """(bound, first line, lines of the longest run) of the starts whose runs may reach the threshold, largest bound first."""
        norms, dots = np.zeros(len(parts) + 1), np.zeros((len(parts) + 1, len(self.names)))
        for k, (norm, some) in enumerate(parts):
            norms[k + 1] = norm
            for i, d in some.items():
                dots[k + 1, i] = d
        norms, dots = norms.cumsum(), dots.cumsum(axis=0)
        most, reach = np.zeros(len(parts)), np.zeros(len(parts), np.int64)
        for n in range(2, min(longest, len(parts)) + 1):
            bound = (dots[n:] - dots[:-n]).max(axis=1) / np.sqrt(norms[n:] - norms[:-n])
            ok = np.flatnonzero(bound >= threshold - 1e-6)
            most[ok], reach[ok] = np.maximum(most[ok], bound[ok]), n
        first = np.flatnonzero(reach[:starts])
        first = first[np.argsort(-most[first], kind="stable")]
        return list(zip(most[first].tolist(), first.tolist(), reach[first].tolist(), strict=True))

    def _grown(self, run: tuple[int, ...], parts: list[tuple[float, dict[int, float]]], bags: list[list[tuple[str, int, float]]]):
        """The best of the first two, three, ... lines of ``run``."""
        counts, norm, dots = {}, 0.0, {}
        for k, x in enumerate(run):
            for w, n, weight in bags[x]:
                c = counts.get(w, 0)
                norm += weight * (2 * c + n) * n
                counts[w] = c + n
            for i, d in parts[x][1].items():
                dots[i] = dots.get(i, 0.0) + d
            if k:
                yield self._top(norm, dots)


def _order(c: tuple[float, str | None]):
    return round(c[0], 12), [-ord(ch) for ch in c[1] or ""]


def fit_idf(files: DataFrame, text: str = "text", templates: tuple[tuple[str, str], ...] = TEMPLATES) -> tuple[dict[str, float], float]:
    """Inverse document frequencies of the templates' words over all texts, and that of a word of one text."""
    vocab = {w for _, t in templates for w in terms(t)}

    def count(batches):
        seen, n = Counter(), 0
        for batch in batches:
            for x in batch.column(0):
                n += 1
                seen.update(vocab.intersection(terms(x.as_py() or "")))
        yield pa.RecordBatch.from_arrays([pa.array([*seen, None], pa.string()), pa.array([*seen.values(), n], pa.int64())], names=["word", "n"])

    got = {r["word"]: r["n"] for r in files.select(text).mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).collect()}
    n = got.pop(None, 0)
    return {w: math.log((1 + n) / (1 + got.get(w, 0))) + 1 for w in sorted(vocab)}, math.log((1 + n) / 2) + 1


def scan(files: DataFrame, text: str = "text", threshold: float = THRESHOLD, templates: tuple[tuple[str, str], ...] = TEMPLATES,
         full: tuple[tuple[str, str], ...] | None = None) -> DataFrame:
    """``files`` with own_license, own_score (the largest cosine of a line, a run or the whole) and is_license_file."""
    whole_templates = (*templates, *(full_texts() if full is None else full))
    added = [("own_license", T.StringType()), ("own_score", T.DoubleType()), ("is_license_file", T.BooleanType())]
    files = files.drop(*[c for c, _ in added])
    idf, rare = fit_idf(files, text, whole_templates)
    at = files.columns.index(text)
    schema = T.StructType([*files.schema.fields, *[T.StructField(c, t) for c, t in added]])

    def work(batches):
        held, held_whole = Templates(idf, rare, templates), Templates(idf, rare, whole_templates)
        for batch in batches:
            rows = []
            for x in batch.column(at):
                value = x.as_py() or ""
                lines = [terms(line) for line in value.split("\n")]
                whole = held_whole.best([w for line in lines for w in line])
                top = max(whole, held.best_run(lines, threshold), key=_order)
                rows.append((top[1] if top[0] >= threshold else None, top[0], whole[0] >= threshold))
            yield pa.RecordBatch.from_arrays([*batch.columns, *[pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.string(), pa.float64(), pa.bool_()))]], names=schema.names)

    return files.mapInArrow(work, schema)


def inherit(scanned: DataFrame, path: str = "path") -> DataFrame:
    """``scanned`` with license (own, else inherited) and inherited_from (the directory, if inherited)."""
    scanned = scanned.drop("license", "inherited_from")
    folder = F.regexp_extract(F.col(path), "^(.*)/[^/]*$", 1)
    rows = scanned.withColumn("__dir", F.when(F.col(path).contains("/"), folder))
    notices = rows.where("is_license_file AND __dir IS NOT NULL").groupBy("__dir") \
        .agg(F.min(F.struct(-F.round("own_score", 9), "own_license", path)).alias("best")).select(F.col("__dir").alias("holder"), F.col("best.own_license").alias("held"))
    folders = rows.where("__dir IS NOT NULL").select("__dir").distinct()
    parts = F.split("__dir", "/")
    above = folders.select("__dir", F.explode(F.transform(F.sequence(F.lit(1), F.size(parts)), lambda n: F.array_join(F.slice(parts, 1, n), "/"))).alias("holder"))
    nearest = above.join(notices, "holder").groupBy("__dir").agg(F.max_by(F.struct("held", "holder"), F.length("holder")).alias("up"))
    out = rows.join(nearest, "__dir", "left")
    own = F.col("own_license").isNotNull()
    return out.withColumn("license", F.coalesce("own_license", "up.held")).withColumn("inherited_from", F.when(~own, F.col("up.holder"))).drop("__dir", "up")


def scan_tree(files: DataFrame, path: str = "path", text: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """The path and ``keep`` columns of every file with own_license, own_score, is_license_file, license and inherited_from."""
    scratch = Scratch(files.sparkSession, "licenses")
    return inherit(scratch.keep(scan(files.select(path, text, *keep), text).drop(text), "scanned"), path)
