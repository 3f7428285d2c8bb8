"""Licence scans: passages against licence templates by sparse TF-IDF cosine, then inheritance along directories.

Inverse document frequencies come from all given files. A passage as long as a template can only be similar to it
if it holds one of a few of the template's words (Cauchy; the rarest are taken), so passages are laid over each
occurrence of those, in files of any length and across lines. Tags that name a licence count as well. Files without a licence of their own
take that of the licence file in the nearest directory above them, found by equi-joins on directory paths.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ratewise.llm.common import chunks, stage

#: One-line statements by SPDX name.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "MIT": "Released under the MIT License.",
}
_WARRANTY = """THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO
THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR
COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR
OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
_BSD_WARRANTY = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES,
INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL,
EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF
USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT,
STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF
ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
_BSD_TERMS = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of
conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this
list of conditions and the following disclaimer in the documentation and/or other materials provided with the
distribution."""
_BSD_THIRD = """3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote
products derived from this software without specific prior written permission."""


def _gnu(name: str, version: str) -> str:
    return f"""This program is free software: you can redistribute it and/or modify it under the terms of the GNU {name}
as published by the Free Software Foundation, either version {version} of the License, or (at your option) any later version.
This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty
of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {name} for more details."""


#: The texts and notices that the licences' publishers give, by SPDX name; of long licences the title.
NOTICES = {
    "AGPL-3.0": (_gnu("Affero General Public License", "3"), "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007 Copyright (C) 2007 Free Software Foundation, Inc."),
    "Apache-2.0": (
        """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with
        the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by
        applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS,
        WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language
        governing permissions and limitations under the License.""",
        "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/ TERMS AND CONDITIONS FOR USE, REPRODUCTION, AND DISTRIBUTION",
    ),
    "BSD-2-Clause": (f"{_BSD_TERMS} {_BSD_WARRANTY}",),
    "BSD-3-Clause": (f"{_BSD_TERMS} {_BSD_THIRD} {_BSD_WARRANTY}",),
    "CC-BY-4.0": ("This work is licensed under a Creative Commons Attribution 4.0 International License.",),
    "CC-BY-SA-4.0": ("This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",),
    "CC-BY-NC-4.0": ("This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",),
    "GPL-2.0": (_gnu("General Public License", "2"), "GNU GENERAL PUBLIC LICENSE Version 2, June 1991 Copyright (C) 1989, 1991 Free Software Foundation, Inc."),
    "GPL-3.0": (_gnu("General Public License", "3"), "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007 Copyright (C) 2007 Free Software Foundation, Inc."),
    "ISC": (
        """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
        granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS
        PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES
        OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR
        CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF
        CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS
        SOFTWARE.""",
    ),
    "LGPL-2.1": (_gnu("Lesser General Public License", "2.1"), "GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999 Copyright (C) 1991, 1999 Free Software Foundation, Inc."),
    "LGPL-3.0": (_gnu("Lesser General Public License", "3"), "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007 Copyright (C) 2007 Free Software Foundation, Inc."),
    "MIT": (
        f"""Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
        documentation files (the "Software"), to deal in the Software without restriction, including without limitation the
        rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit
        persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice
        and this permission notice shall be included in all copies or substantial portions of the Software. {_WARRANTY}""",
    ),
    "MPL-2.0": (
        """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not
        distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.""",
        "Mozilla Public License Version 2.0 1. Definitions",
    ),
}
#: All templates: statements and notices.
LICENCES = {name: (*([TEMPLATES[name]] if name in TEMPLATES else []), *NOTICES.get(name, ())) for name in sorted({*TEMPLATES, *NOTICES})}
#: Least cosine of a passage.
LEAST = 0.75
#: Files of these names speak for their directory, as do files that are as a whole similar to a template.
SPEAKING = re.compile(r"(?i)(.*/)?((un)?licen[cs]e|copying)([.\-_][^/]*)?")
_NAME = r"\(?[A-Za-z0-9][A-Za-z0-9.+\-]*\)?"
TAG = re.compile(rf"SPDX-License-Identifier:[ \t]*({_NAME}(?:[ \t]+(?:OR|AND|WITH)[ \t]+{_NAME})*)")

_WORD = re.compile(r"[^\W_]+(?:[.\-][^\W_]+)*")


def words(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def document_counts(files: DataFrame, vocabulary: set[str]) -> tuple[int, dict[str, int]]:
    """Number of files, and of files with each word of the (bounded) vocabulary."""

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, seen = 0, Counter()
        for batch in chunks(batches):
            for text in batch.column("text").to_pylist():
                n += 1
                seen.update(vocabulary.intersection(words(text or "")))
        names = ["", *seen]
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array([n, *(seen[w] for w in names[1:])], pa.int64())], names=["word", "n"])

    rows = files.select("text").mapInArrow(kernel, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).collect()
    found = {r["word"]: r["n"] for r in rows}
    return found.pop("", 0), found


class Template:
    """One text of a licence: its words' weights, and the words of which similar passages hold one at least."""

    def __init__(self, licence: str, text: str, weight, least: float):
        self.licence, ws = licence, words(text)
        self.size = len(ws)
        self.weights = {w: n * weight(w) for w, n in Counter(ws).items()}
        squares = {w: self.weights[w] ** 2 for w in sorted(self.weights, key=lambda w: (-weight(w), w))}
        total = sum(squares.values())
        self.norm = math.sqrt(total)
        # The rarest words: a passage without them shares less than least ** 2 of the squared weight, so its cosine is less.
        self.anchors, missing = {}, 0.0
        for w, s in squares.items():
            if missing > (1 - least * least) * total:
                break
            self.anchors[w] = [i for i, x in enumerate(ws) if x == w]
            missing += s


class Templates:
    """Weighted templates. Words outside them weigh as much as a word that no file has."""

    def __init__(self, templates: dict[str, Sequence[str]], files: int, counts: dict[str, int], least: float = LEAST):
        self.least, self.other = least, math.log(1 + files) + 1
        self.idf = {w: math.log((1 + files) / (1 + counts.get(w, 0))) + 1 for ts in templates.values() for t in ts for w in words(t)}
        self.all = [Template(name, t, self.idf.__getitem__, least) for name, ts in sorted(templates.items()) for t in ts]
        self.anchors = {w for t in self.all for w in t.anchors}

    def cosine(self, t: Template, counts: Counter) -> float:
        """Cosine of a template and the words of a passage, rounded so that equals are equal."""
        norm = math.sqrt(sum((n * self.idf.get(w, self.other)) ** 2 for w, n in counts.items()))
        shared = sum(x * counts[w] * self.idf[w] for w, x in t.weights.items() if w in counts)
        return round(shared / (t.norm * norm), 12) if norm else 0.0

    def passage(self, ws: list[str]) -> tuple[float, int, str] | None:
        """The most similar passage: -cosine, its first word's place and the licence; of equals the first."""
        at: dict[str, list[int]] = {}
        for i, w in enumerate(ws):
            if w in self.anchors:
                at.setdefault(w, []).append(i)
        found = []
        for t in self.all:
            starts = {max(0, i - o) for w, offsets in t.anchors.items() for i in at.get(w, ()) for o in offsets}
            for s in starts:
                cosine = self.cosine(t, Counter(ws[s : s + t.size]))
                if cosine >= self.least:
                    found.append((-cosine, s, t.licence))
        return min(found, default=None)

    def whole(self, counts: Counter) -> tuple[float, int, str] | None:
        """The template most similar to a file as a whole."""
        found = [(-self.cosine(t, counts), 0, t.licence) for t in self.all if not t.anchors.keys().isdisjoint(counts)]
        return min((f for f in found if -f[0] >= self.least), default=None)


def statements(files: DataFrame, templates: dict[str, Sequence[str]] = LICENCES, least: float = LEAST) -> DataFrame:
    """path, licence, similarity, line, speaks for every file (path, text) with a licence statement.

    The most similar passage counts, of equals the first, then the first licence by name. A tag has similarity 1
    and gives its whole expression. `speaks`: the file has a licence file's name, or is as a whole similar to a
    template. Null and empty texts state nothing. Files of any length are looked through as a whole.
    """
    model = Templates(templates, *document_counts(files, {w for ts in templates.values() for t in ts for w in words(t)}), least)

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            out: list[list] = [[], [], [], [], []]
            for path, text in zip(batch.column("path").to_pylist(), batch.column("text").to_pylist()):
                low = (text or "").lower()
                ws, tag = words(low), TAG.search(text or "")
                if not tag and model.anchors.isdisjoint(ws):
                    continue
                whole = model.whole(Counter(ws))
                best = model.passage(ws) or whole
                if tag and (best is None or best[0] > -1 or next(m.start() for k, m in enumerate(_WORD.finditer(low)) if k == best[1]) > tag.start()):
                    row = (tag.group(1), 1.0, text.count("\n", 0, tag.start()))
                elif best:
                    first = next(m.start() for k, m in enumerate(_WORD.finditer(low)) if k == best[1])
                    row = (best[2], -best[0], low.count("\n", 0, first))
                else:
                    continue
                for column, value in zip(out, (path, *row, whole is not None or bool(SPEAKING.fullmatch(path or "")))):
                    column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, (pa.string(), pa.string(), pa.float64(), pa.int32(), pa.bool_()))], names=["path", "licence", "similarity", "line", "speaks"])

    return files.select("path", "text").mapInArrow(kernel, "path string, licence string, similarity double, line int, speaks boolean")


def scan(files: DataFrame, path_col: str = "path", text_col: str = "text", templates: dict[str, Sequence[str]] = LICENCES, least: float = LEAST) -> DataFrame:
    """path, licence, how (own, inherited, none), similarity, origin of every path.

    A file with a null path is looked at alone and inherits nothing. Rows that repeat a path are one file
    with the most similar statement; directories with several licence files take the most similar, then the
    first by path. Paths are split at ``/``.
    """
    given = files.select(F.col(path_col).cast("string").alias("path"), F.col(text_col).cast("string").alias("text"))
    found = stage(statements(given, templates, least), "licence-statements")
    first = F.min(F.struct((-F.col("similarity")).alias("s"), "line", "licence", "speaks"))
    own = found.groupBy("path").agg(first.alias("f")).select("path", "f.licence", (-F.col("f.s")).alias("similarity"), "f.speaks")
    above = F.regexp_extract("path", r"^(.*)/[^/]*$", 1)
    speakers = own.filter("speaks and path is not null").select(above.alias("dir"), "licence", "similarity", F.col("path").alias("origin"))
    speakers = speakers.groupBy("dir").agg(F.min(F.struct((-F.col("similarity")).alias("s"), "origin", "licence")).alias("f")).select("dir", "f.licence", (-F.col("f.s")).alias("similarity"), "f.origin")
    # One row per directory and directory above it; directories are far fewer than files.
    paths = given.select("path").distinct()
    dirs = paths.filter("path is not null").select(above.alias("dir")).distinct()
    parts = F.split("dir", "/")
    ups = dirs.select("dir", F.explode(F.transform(F.sequence(F.lit(0), F.size(parts)), lambda n: F.struct(F.array_join(F.slice(parts, 1, n), "/").alias("up"), n.alias("depth")))).alias("a")).select("dir", "a.up", "a.depth")
    nearest = ups.join(speakers.withColumnRenamed("dir", "s_dir"), F.col("up") == F.col("s_dir")).groupBy("dir").agg(F.max(F.struct("depth", "licence", "similarity", "origin")).alias("f"))
    inherited = nearest.select(F.col("dir").alias("n_dir"), F.col("f.licence").alias("i_licence"), F.col("f.similarity").alias("i_similarity"), F.col("f.origin").alias("i_origin"))
    own = own.select(F.col("path").alias("o_path"), "licence", "similarity")
    joined = paths.withColumn("dir", F.when(F.col("path").isNotNull(), above)).join(own, F.col("path").eqNullSafe(F.col("o_path")), "left").join(inherited, F.col("dir") == F.col("n_dir"), "left")
    how = F.when(F.col("licence").isNotNull(), "own").when(F.col("i_licence").isNotNull(), "inherited").otherwise("none")
    return joined.select("path", F.coalesce("licence", "i_licence").alias("licence"), how.alias("how"), F.coalesce("similarity", "i_similarity", F.lit(0.0)).alias("similarity"), F.when(F.col("licence").isNotNull(), F.col("path")).otherwise(F.col("i_origin")).alias("origin"))
