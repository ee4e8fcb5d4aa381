"""Licence scans (operator 4).

Templates and the notices found in files are sparse TF-IDF vectors over words.
A file's notices stand around licence words anywhere in its text: runs of as
many words as a template has (or half), wherever lines end, and blocks of lines; each is
compared with the templates by cosine. A file in a
directory inherits the licences of the licence files (LICENSE, COPYING, ...,
or a text that is mainly a licence) of the nearest directory above it, by
joins on paths: every distinct directory is exploded into its ancestors and
the deepest one with a licence wins. A notice of its own goes before.
"""

from __future__ import annotations

import math
from bisect import bisect_right
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterflow.llm.scratch import saved
from meterflow.llm.texts import slices

#: Short public notices of well-known licences, by SPDX identifier (fixed values).
TEMPLATES = {
    "Apache-2.0": ("Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License.",
                   "Licensed under the Apache License, Version 2.0."),
    "MIT": ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, "
            "to deal in the Software without restriction.",
            "Released under the MIT License.", "Licensed under the MIT License."),
    "BSD-3-Clause": ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met.",
                     "Use of this source code is governed by a BSD-style license."),
    "GPL-3.0": ("This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License "
                "as published by the Free Software Foundation, either version 3 of the License, or any later version.",
                "This work is licensed under the GNU General Public License, version 3."),
    "GPL-2.0": ("This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License "
                "as published by the Free Software Foundation; either version 2 of the License, or any later version.",
                "Licensed under the GNU General Public License, version 2."),
    "LGPL-2.1": ("This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public "
                 "License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",
                 "Licensed under the GNU Lesser General Public License, version 2.1."),
    "LGPL-3.0": ("You can redistribute it under the terms of the GNU Lesser General Public License, version 3.",),
    "AGPL-3.0": ("You can redistribute it under the terms of the GNU Affero General Public License, version 3.",),
    "MPL-2.0": ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",),
    "CC-BY-4.0": ("This work is licensed under a Creative Commons Attribution 4.0 International License.", "Licensed under CC BY 4.0."),
    "CC-BY-SA-4.0": ("This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.", "Licensed under CC BY-SA 4.0."),
    "CC-BY-NC-4.0": ("This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.", "Licensed under CC BY-NC 4.0."),
    "CC0-1.0": ("To the extent possible under law, the author has waived all copyright and related rights. CC0 1.0 Universal.",),
    "ISC": ("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
            "provided that the above copyright notice and this permission notice appear in all copies.", "Licensed under the ISC License."),
    "0BSD": ("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.",),
    "BSL-1.0": ("Distributed under the Boost Software License, Version 1.0.",),
    "EPL-2.0": ("This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0.",),
    "Unlicense": ("This is free and unencumbered software released into the public domain.",),
    "LicenseRef-Proprietary": ("All rights reserved.", "Confidential and proprietary. Unauthorized copying of this file is strictly prohibited."),
}
RESERVED = "All rights reserved."  # stands beside grants too
#: Full texts of short public licences without their copyright lines, by SPDX identifier (fixed values): a licence file is compared as a file.
FULL_TEXTS = {
    "MIT": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the
        "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish,
        distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the
        following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the
        Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF
        MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY
        CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE
        OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    "ISC": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the
        above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES
        WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY
        SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION
        OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.""",
    "BSD-3-Clause": """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following
        conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following
        disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in
        the documentation and/or other materials provided with the distribution. 3. Neither the name of the copyright holder nor the names of its
        contributors may be used to endorse or promote products derived from this software without specific prior written permission. THIS SOFTWARE IS
        PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED
        WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE
        LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF
        SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN
        CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF
        THE POSSIBILITY OF SUCH DAMAGE.""",
}
FULL = 0.85  # cosine of a whole file with a full text that makes it this licence
COSINE = 0.6  # of a notice with a template
SHORT = 10  # words; of shorter templates, half the words stand in other prose too:
SHORT_COSINE = 0.88  # for these, of a run of words within lines
MAINLY = 0.8  # share of a text's words in matched notices that makes it a licence file
TOKEN = regex.compile(r"[a-z]+|\d+(?:\.\d+)*")
ANCHOR = regex.compile(r"licen[cs]|copyright|\(c\)|rights reserved|redistribut|permission|public domain|spdx|proprietary|free software|all rights|waived", regex.I)
SPDX = regex.compile(r"SPDX-License-Identifier:[ \t]*((?:\([ \t]*)*[\w.+-]+[ \t)]*(?:(?:AND|OR|WITH)\b[ \t(]*[\w.+-]+[ \t)]*)*)", regex.I)
LICENSE_FILE = r"(?i)(^|/)(licen[cs]e|copying|notice|unlicense)([._-][^/]*)?$"


def spdx(text: str) -> list[tuple[str, str]]:
    """(expression, matched notice) of the SPDX lines of a text, blanks and outer brackets put in order."""
    out = []
    for m in SPDX.finditer(text):
        words = regex.findall(r"[()]|[\w.+-]+", m[1])
        while words.count("(") < words.count(")"):
            words.pop(len(words) - 1 - words[::-1].index(")"))
        words = [w.upper() if w.upper() in ("AND", "OR", "WITH") else w for w in words]
        if len(words) > 2 and words[0] == "(" and words[-1] == ")" and "(" not in words[1:]:
            words = words[1:-1]
        out.append((" ".join(words).replace("( ", "(").replace(" )", ")"), m[0].strip()))
    return out


def named(expression: str) -> list[str]:
    """The licences in an SPDX expression, without exceptions."""
    words = regex.findall(r"[\w.+-]+", expression)
    return [w for i, w in enumerate(words) if w not in ("AND", "OR", "WITH") and (i == 0 or words[i - 1] != "WITH")]


def tokens(text: str) -> list[str]:
    return TOKEN.findall(text.lower())


def unit(count: Counter) -> dict[str, float]:
    norm = math.sqrt(sum((1 + math.log(n)) ** 2 for n in count.values())) or 1.0
    return {w: (1 + math.log(n)) / norm for w, n in count.items()}


@dataclass
class Templates:
    names: list[str]
    idf: dict[str, float]
    weights: dict[str, list[tuple[int, float]]]  # term -> (template, weight): sparse postings
    unseen: float
    terms: list[dict[str, float]]  # of each template: its unit vector
    sizes: list[int]  # and its number of words
    reserving: frozenset[int]  # the templates that only reserve rights
    full: list[tuple[str, dict[str, float]]]  # full texts: name and unit vector
    full_sizes: list[int]

    @classmethod
    def build(cls, templates=None) -> Templates:
        rows = [(name, Counter(tokens(t))) for name, texts in (templates or TEMPLATES).items() for t in texts]
        df = Counter(w for _, c in rows for w in c)
        idf = {w: math.log((1 + len(rows)) / (1 + n)) + 1 for w, n in df.items()}
        weights: dict[str, list[tuple[int, float]]] = {}
        for i, (_, c) in enumerate(rows):
            norm = math.sqrt(sum(((1 + math.log(n)) * idf[w]) ** 2 for w, n in c.items()))
            for w, n in c.items():
                weights.setdefault(w, []).append((i, (1 + math.log(n)) * idf[w] / norm))
        terms: list[dict[str, float]] = [{} for _ in rows]
        for w, posted in weights.items():
            for i, y in posted:
                terms[i][w] = y
        reserved = Counter(tokens(RESERVED))
        return cls([n for n, _ in rows], idf, weights, math.log(1 + len(rows)) + 1, terms, [sum(c.values()) for _, c in rows],
                   frozenset(i for i, (_, c) in enumerate(rows) if c == reserved), *cls._full(FULL_TEXTS if templates is None else {}))

    @staticmethod
    def _full(texts) -> tuple[list[tuple[str, dict[str, float]]], list[int]]:
        counts = [(name, Counter(tokens(t))) for name, t in texts.items()]
        return [(name, unit(c)) for name, c in counts], [sum(c.values()) for _, c in counts]

    def whole(self, words: list[str]) -> tuple[str | None, float]:
        """(licence, cosine) of the nearest full text, by the logarithms of counts."""
        mine = unit(Counter(words))
        return max(((name, sum(x * mine.get(w, 0.0) for w, x in v.items())) for name, v in self.full), key=lambda r: r[1], default=(None, 0.0))

    def cosine(self, i: int, words: list[str]) -> float:
        """Of words with template ``i``."""
        dot = norm = 0.0
        for w, n in Counter(words).items():
            x = (1 + math.log(n)) * self.idf.get(w, self.unseen)
            norm += x * x
            dot += x * self.terms[i].get(w, 0.0)
        return dot / math.sqrt(norm) if norm else 0.0

    def nearest(self, words: list[str]) -> tuple[int, float]:
        """(template, cosine) of the nearest template, or -1; ties go to the first."""
        count = Counter(words)
        score, norm = np.zeros(len(self.names)), 0.0
        for w, n in count.items():
            x = (1 + math.log(n)) * self.idf.get(w, self.unseen)
            norm += x * x
            for i, y in self.weights.get(w, ()):
                score[i] += x * y
        if not norm or not score.any():
            return -1, 0.0
        i = int(np.round(score, 12).argmax())
        return i, float(score[i] / math.sqrt(norm))

    def best(self, words: list[str]) -> tuple[str | None, float]:
        """(licence, cosine) of the nearest template."""
        i, cosine = self.nearest(words)
        return (self.names[i] if i >= 0 else None), cosine


def spotted(text: str) -> tuple[list[str], list[int], list[int]]:
    """The words of a text in lower case and where they start and end in it."""
    low = text.lower()
    if len(low) != len(text):  # a few letters grow when lowered
        low = "".join(c if len(d := c.lower()) != 1 else d for c in text)
    found = [(m.group(), m.start(), m.end()) for m in TOKEN.finditer(low)]
    return ([], [], []) if not found else tuple(map(list, zip(*found, strict=True)))


def window(words: list[str], at: int, begin: int, templates: Templates, least: float) -> tuple[int, float, int, int]:
    """(template, cosine, first word, words) of the run of words around the licence word ``at``, not
    before ``begin``, that is nearest to a template of as many words, or up to twice as many; template -1 if none counts."""
    pick = (-1, 0.0, 0, 0)
    for i, (terms, size) in enumerate(zip(templates.terms, templates.sizes, strict=True)):
        need = max(least, SHORT_COSINE) if size < SHORT else least
        lo, hi = max(begin, at - size + 1), min(len(words), at + size)
        # no run can be nearer than the template's part on the words that stand here
        if math.sqrt(sum(terms[w] ** 2 for w in terms.keys() & set(words[lo:hi]))) < max(need, pick[1]) - 1e-12:
            continue
        for n in range(size, size // 2, -max(1, size // 8)):  # shortened notices too
            for first in range(max(begin, at - n + 1), min(at, len(words) - n) + 1):
                c = templates.cosine(i, words[first:first + n])
                if c >= need and c > pick[1] + 1e-12:
                    pick = (i, c, first, n)
    return pick


def notices(text: str | None, templates: Templates, least: float = COSINE) -> tuple[str | None, float, str | None, float, list[str]]:
    """(licence, cosine, matched notice, share of the words in matched notices, all licences) of a whole text.

    A text that as a whole is near a full licence text is that licence; an SPDX
    expression comes before other notices and is given as it stands.

    At every licence word, a notice is the run of words around it, wherever
    lines end, that is nearest to a template of about as many words; or its line from
    there on, alone or with up to three lines after it, if that is nearer. Rights that are only
    reserved count where nothing in the text is granted.
    """
    if not text or not ANCHOR.search(text):
        return None, 0.0, None, 0.0, []
    found = spdx(text)
    words, starts, ends = spotted(text)
    if not found and len(words) <= 2 * max(templates.full_sizes, default=0):
        name, c = templates.whole(words)
        if c >= FULL:
            return name, c, text[starts[0]:ends[min(len(words), 12) - 1]], 1.0, [name]
    every = list(dict.fromkeys(x for e, _ in found for x in named(e)))
    best = {False: (found[0][0], 1.0, found[0][1]) if found else (None, 0.0, None), True: (None, 0.0, None)}
    matched, begin, tried = 0, 0, -1
    for anchor in ANCHOR.finditer(text):
        at = bisect_right(ends, anchor.start())
        if at < begin or at >= len(words):
            continue
        i, c, first, n = window(words, at, begin, templates, least)
        pick = (templates.names[i], c, first, n, i in templates.reserving) if i >= 0 else (None, 0.0, 0, 0, False)
        line = text.rfind("\n", 0, anchor.start()) + 1
        first, stop = bisect_right(ends, line), line
        for _ in range(4 if line != tried and first >= begin else 0):
            stop = text.find("\n", stop)
            stop = len(text) if stop < 0 else stop
            last = bisect_right(ends, stop)
            j, c = templates.nearest(words[first:last])
            if c >= least and c > pick[1] + 1e-12:
                pick = (templates.names[j], c, first, last - first, j in templates.reserving)
            if stop == len(text):
                break
            stop += 1
        tried = line
        if pick[0] is None:
            continue
        name, c, first, n, reserving = pick
        matched += n
        begin = first + n
        if not reserving and name not in every:
            every.append(name)
        if c > best[reserving][1] + 1e-12:
            best[reserving] = (name, c, text[starts[first]:ends[begin - 1]])
    name, cosine, shown = best[False] if best[False][0] else best[True]
    return name, cosine, shown, matched / max(len(words), 1) if name else 0.0, every or ([name] if name else [])


def scan(files: DataFrame, least: float = COSINE, templates=None) -> DataFrame:
    """One row per row of ``files(doc_id, path, text)``: doc_id, path, license,
    cosine, evidence, via (own, inherited or none), inherited_from (a directory)
    and licenses (all that the text itself names, an SPDX expression's one by one).

    Null, empty and licence-free texts have no notice of their own; a null path
    has no directory and inherits nothing. Of several licence files in one
    directory the nearest to its template counts, then the first by name.
    Repeated rows are repeated; other columns are ignored.
    """
    spark = files.sparkSession
    shared = spark.sparkContext.broadcast(Templates.build(templates))

    def run(batches):
        for part in slices(batches, "text", 8 << 20):
            rows = [notices(t, shared.value, least) for t in part.column("text").to_pylist()]
            columns = [list(c) for c in zip(*rows, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id").cast(pa.int64()), part.column("path"), pa.array(columns[0], pa.string()), pa.array(columns[1], pa.float64()),
                 pa.array(columns[2], pa.string()), pa.array(columns[3], pa.float64()), pa.array(columns[4], pa.list_(pa.string()))],
                names=["doc_id", "path", "own", "cosine", "evidence", "share", "found"])

    own = saved(files.select("doc_id", "path", "text").mapInArrow(
        run, "doc_id long, path string, own string, cosine double, evidence string, share double, found array<string>")
        .withColumn("dir", F.regexp_replace("path", r"/?[^/]*$", "")), "license-own")
    grants = (own.filter(F.col("own").isNotNull() & F.col("dir").isNotNull() & (F.col("path").rlike(LICENSE_FILE) | (F.col("share") >= MAINLY)))
              .groupBy(F.col("dir").alias("up")).agg(F.min(F.struct((-F.col("cosine")).alias("c"), "own")).alias("g")).select("up", F.col("g.own").alias("granted")))
    parts = F.split("dir", "/")
    above = F.transform(F.sequence(F.lit(0), F.size(parts)), lambda n: F.array_join(F.slice(parts, F.lit(1), n), "/"))
    dirs = own.select("dir").filter("dir is not null").distinct().select("dir", F.explode(F.array_distinct(above)).alias("up"))
    nearest = saved(dirs.join(grants, "up").groupBy("dir").agg(F.max(F.struct(F.length("up").alias("n"), "up", "granted")).alias("g"))
                    .select(F.col("dir").alias("d"), F.col("g.up").alias("from_dir"), F.col("g.granted").alias("granted")), "license-dirs")
    out = own.join(nearest, F.col("dir") == F.col("d"), "left")
    mine = F.col("own").isNotNull()
    return out.select("doc_id", "path", F.coalesce("own", "granted").alias("license"), F.when(mine, F.col("cosine")).otherwise(0.0).alias("cosine"), "evidence",
                      F.when(mine, "own").when(F.col("granted").isNotNull(), "inherited").otherwise("none").alias("via"),
                      F.when(~mine, F.col("from_dir")).alias("inherited_from"), F.col("found").alias("licenses"))
