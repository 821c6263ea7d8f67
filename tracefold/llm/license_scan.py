"""Licence scans, in DataFrame operations only.

A file is compared with templates (titles, one-line notices, tags, headers and
licence texts) by the cosine of TF-IDF vectors: the whole file, and windows of 1
to 32 lines, so that a header is found wherever it stands and however it is
wrapped. How many files hold a word is counted over the whole table, for every
word. A window can only match a template if it holds one of a few of the
template's rarest words (without them the rest of the template is too short for
the cosine), so only windows around such words are compared; no match is lost.

A file without a licence of its own takes that of the nearest directory above it
that has a licence file. Each folder is joined, one row for each directory above
it, to the directories with licences; the deepest match is kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bounded, cut

_MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"),
to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:
The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY,
WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
_BSD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:
1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation
and/or other materials provided with the distribution."""
_BSD_3 = """3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software
without specific prior written permission."""
_BSD_END = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO,
THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE
FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES;
LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT
(INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
_ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright
notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE
INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL
DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING
OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""
_APACHE = """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy
of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is
distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing
permissions and limitations under the License."""
_GPL = """This program is free software: you can redistribute it and/or modify it under the terms of the GNU {0} as published by the Free Software Foundation,
either version {1} of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY;
without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {0} for more details. You should have received a copy of the
GNU {0} along with this program. If not, see <https://www.gnu.org/licenses/>."""
_MPL = """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can
obtain one at https://mozilla.org/MPL/2.0/."""
_UNLICENSE = """This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute
this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means."""
#: Licences with their titles, notices, headers and texts (fixed values; of the longest texts the title and the opening).
TEMPLATES = (
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("AGPL-3.0", "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007"),
    ("AGPL-3.0", "The GNU Affero General Public License is a free, copyleft license for software and other kinds of works, specifically designed to ensure cooperation with the community in the case of network server software."),
    ("AGPL-3.0", _GPL.format("Affero General Public License", 3)),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Apache License"),
    ("Apache-2.0", "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/"),
    ("Apache-2.0", "TERMS AND CONDITIONS FOR USE, REPRODUCTION, AND DISTRIBUTION 1. Definitions. License shall mean the terms and conditions for use, reproduction, and distribution as defined by Sections 1 through 9 of this document."),
    ("Apache-2.0", _APACHE),
    ("BSD-2-Clause", "Released under the BSD 2-Clause License."),
    ("BSD-2-Clause", "BSD 2-Clause License"),
    ("BSD-2-Clause", f"{_BSD} {_BSD_END}"),
    ("BSD-3-Clause", "Released under the BSD 3-Clause License."),
    ("BSD-3-Clause", "BSD 3-Clause License"),
    ("BSD-3-Clause", f"{_BSD} {_BSD_3}"),
    ("BSD-3-Clause", f"{_BSD} {_BSD_3} {_BSD_END}"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "Creative Commons Attribution 4.0 International Public License"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "Creative Commons Attribution-NonCommercial 4.0 International Public License"),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-SA-4.0", "Creative Commons Attribution-ShareAlike 4.0 International Public License"),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-2.0", "GNU GENERAL PUBLIC LICENSE Version 2, June 1991"),
    ("GPL-2.0", _GPL.format("General Public License", 2)),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "GNU GENERAL PUBLIC LICENSE"),
    ("GPL-3.0", "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("GPL-3.0", "The GNU General Public License is a free, copyleft license for software and other kinds of works."),
    ("GPL-3.0", _GPL.format("General Public License", 3)),
    ("ISC", "ISC License"),
    ("ISC", _ISC),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("LGPL-3.0", "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("LGPL-3.0", _GPL.format("Lesser General Public License", 3)),
    ("MIT", "Released under the MIT License."),
    ("MIT", "MIT License"),
    ("MIT", _MIT),
    ("MPL-2.0", "Licensed under the Mozilla Public License, Version 2.0."),
    ("MPL-2.0", "Mozilla Public License Version 2.0"),
    ("MPL-2.0", _MPL),
    ("Unlicense", _UNLICENSE),
    *((x, f"SPDX-License-Identifier: {x}") for x in ("AGPL-3.0", "Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "GPL-2.0", "GPL-3.0", "ISC", "LGPL-3.0", "MIT", "MPL-2.0", "Unlicense")),
    *((x, f"SPDX-License-Identifier: {x}-{y}") for x in ("AGPL-3.0", "GPL-2.0", "GPL-3.0", "LGPL-3.0") for y in ("only", "or-later")),
)
#: Lines of the windows that are compared, besides the whole file; windows begin at every quarter of their size.
WINDOWS = (1, 2, 4, 8, 16, 32)
#: Least cosine of a match.
SIMILAR = 0.75
#: Names of files that speak for their directory.
LICENCE_FILE = r"(?i)^(licen[cs]e|copying|notice)(\..*)?$"


def words(text: Column) -> Column:
    """The words of text in lower case: letters, digits, and dots and hyphens inside. Null has none."""
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit("[a-z0-9]+(?:[.-]+[a-z0-9]+)*"), F.lit(0))


def anchors(models: list, similar: float) -> list[str]:
    """Words of which a text holds at least one if its cosine with any template is similar or more. models: rows template, term, m (of length 1), idf.

    Without words of a template whose squares sum to more than 1 - similar**2,
    what is left of it is shorter than similar. The rarest words are taken.
    """
    out, own = set(), {}
    for r in models:
        own.setdefault(r["template"], []).append((-r["idf"], r["term"], r["m"]))
    for terms in own.values():
        mass = 0.0
        for _, term, m in sorted(terms):
            if mass > 1 - similar**2 + 1e-6:
                break
            mass += m * m
            out.add(term)
    return sorted(out)


def windows(lines: Column, whole: Column, heavy: Column) -> Column:
    """The words of each window of lines that holds a word of heavy, and of the whole text.

    lines and whole are columns with the words of each line and of the text: an
    expression would be computed anew for each window.
    """
    marked = F.filter(F.transform(lines, lambda x, i: F.when(F.arrays_overlap(x, heavy), i)), lambda i: i.isNotNull())

    def of_size(w: int) -> Column:
        step = max(1, w // 4)
        begins = F.transform(marked, lambda p: F.transform(F.sequence(F.ceil(F.greatest(p - w + 1, F.lit(0)) / step), F.floor(p / step)), lambda k: (k * step).cast("int")))
        return F.transform(F.array_distinct(F.flatten(begins)), lambda i: F.flatten(F.slice(lines, i + 1, F.lit(w))))

    return F.concat(*(of_size(w) for w in WINDOWS), F.array(whole))


def detected(files: DataFrame, templates: tuple[tuple[str, str], ...] = TEMPLATES, similar: float = SIMILAR) -> DataFrame:
    """(name, licence, cosine) of the best match of each text of files (name, text); only matches of similar or more.

    Rows of one name have one text, which is compared once. Ties go to the first
    licence in order of its name. Equal windows are compared once, and only
    their numbers are shuffled with their words.
    """
    spark, n = files.sparkSession, files.count()
    found = files.select(F.explode(F.array_distinct(words(F.col("text")))).alias("term")).groupBy("term").agg(F.count("*").alias("df"))
    idf = cut(found.select("term", (F.log((F.lit(n) + 1) / (F.col("df") + 1)) + 1).alias("idf")), "licence-idf")
    known = spark.createDataFrame([(k, a, b) for k, (a, b) in enumerate(templates)], "template int, licence string, notice string")
    known = known.select("template", "licence", F.explode(words(F.col("notice"))).alias("term")).groupBy("template", "licence", "term").agg(F.count("*").alias("n"))
    vocabulary = F.broadcast(known.select("term").distinct())
    weights = known.join(F.broadcast(idf.join(vocabulary, "term", "left_semi")), "term", "left").withColumn("idf", F.coalesce("idf", F.log(F.lit(n) + 1.0) + 1)).withColumn("m", F.col("n") * F.col("idf"))
    lengths = weights.groupBy("template").agg(F.sqrt(F.sum(F.col("m") * F.col("m"))).alias("length"))
    models = cut(weights.join(lengths, "template").select("template", "licence", "term", "idf", (F.col("m") / F.col("length")).alias("m")), "licence-models")  # as many rows as the templates have words
    heavy = F.array(*map(F.lit, anchors(models.collect(), similar)))

    some = files.where(F.arrays_overlap(words(F.col("text")), heavy)).groupBy("name").agg(F.first("text").alias("text"))
    lined = some.select("name", F.transform(F.split("text", "\\n"), words).alias("lines"), words(F.col("text")).alias("whole"))
    units = lined.select("name", F.explode(windows(F.col("lines"), F.col("whole"), heavy)).alias("words")).where(F.arrays_overlap("words", heavy))
    units = cut(units.withColumn("key", F.sha2(F.array_join("words", " "), 256)), "licence-windows")
    kinds = cut(units.groupBy("key").agg(F.first("words").alias("words")).withColumn("unit", F.monotonically_increasing_id()), "licence-kinds")
    terms = kinds.select("unit", F.explode("words").alias("term")).groupBy("unit", "term").agg(F.count("*").alias("tf"))
    weighted = cut(terms.join(idf, "term").select("unit", "term", (F.col("tf") * F.col("idf")).alias("w")), "licence-weights")
    norms = weighted.groupBy("unit").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    dots = weighted.join(F.broadcast(models.drop("idf")), "term").groupBy("unit", "template", "licence").agg(F.sum(F.col("w") * F.col("m")).alias("dot"))
    cosines = dots.join(norms, "unit").select("unit", "licence", F.round(F.col("dot") / F.col("norm"), 6).alias("cosine")).where(F.col("cosine") >= similar)
    best = F.min_by(F.struct("licence", "cosine"), F.struct(-F.col("cosine"), "licence")).alias("best")
    matches = cut(kinds.select("key", "unit").join(cosines, "unit").groupBy("key").agg(best).select("key", "best.*"), "licence-matches")
    return units.select("name", "key").join(bounded(matches), "key").groupBy("name").agg(best).select("name", "best.*")


def scanned(files: DataFrame, templates: tuple[tuple[str, str], ...] = TEMPLATES, similar: float = SIMILAR, licence_file: Column | None = None, key: str | None = None) -> DataFrame:
    """One row per row of files (path, text): path, licence, cosine, origin ('own', 'inherited' or null), licence_path, and with key that column and licence_key.

    licence_file: which rows are licence files; by default their name says so.
    A licence file in the root speaks for all paths without a nearer one. Of
    several licence files in a directory the most similar counts, then the first
    path, then the first row. A null or empty text has no licence of its own; a
    null path inherits none. Rows that share a path are judged each by its own
    text. Texts and lines of any length are read whole. An empty table gives no
    rows. Other columns of files are ignored.

    key: a column of files that tells rows apart better than their paths.
    """
    is_file = F.regexp_extract(F.col("path"), "[^/]*$", 0).rlike(LICENCE_FILE) if licence_file is None else licence_file
    parts = F.split("path", "/")
    folder = F.when(F.size(parts) > 1, F.array_join(F.slice(parts, 1, F.size(parts) - 1), "/")).when(F.col("path").isNotNull(), "")
    rows = files.select(F.monotonically_increasing_id().alias("row"), F.col("path" if key is None else key).alias("key"), "path", folder.alias("folder"), is_file.alias("speaks"), F.sha2("text", 256).alias("name"))
    rows = cut(rows, "licence-rows")
    own = cut(detected(files.select(F.sha2("text", 256).alias("name"), "text"), templates, similar), "licence-own")
    marked = rows.join(bounded(own), "name", "left")
    first = F.struct((-F.col("cosine")).alias("less"), "path", "row", "licence", "cosine", "key")
    speak = cut(marked.where("speaks and licence is not null and path is not null").groupBy("folder").agg(F.min(first).alias("s")), "licence-folders")
    root = speak.where("folder = ''").select(F.col("s").alias("root"))  # one row at most
    above = F.expr("transform(sequence(1, size(split(folder, '/'))), k -> struct(k as depth, substring_index(folder, '/', k) as above))")
    up = rows.where("folder != ''").select("folder").distinct().select("folder", F.inline(above))
    near = up.join(bounded(speak.withColumnRenamed("folder", "above")), "above").groupBy("folder").agg(F.max_by("s", "depth").alias("near"))
    joined = marked.join(bounded(cut(near, "licence-near")), "folder", "left").join(F.broadcast(root), F.lit(True), "left")
    owned, s = F.col("licence").isNotNull(), F.when(F.col("path").isNotNull(), F.coalesce("near", "root"))
    joined = joined.withColumn("s", s)
    return joined.select(
        *([] if key is None else [F.col("key").alias(key)]),
        "path",
        F.coalesce("licence", F.col("s.licence")).alias("licence"),
        F.coalesce("cosine", F.col("s.cosine")).alias("cosine"),
        F.when(owned, "own").when(F.col("s").isNotNull(), "inherited").alias("origin"),
        F.when(owned, F.col("path")).otherwise(F.col("s.path")).alias("licence_path"),
        *([] if key is None else [F.when(owned, F.col("key")).otherwise(F.col("s.key")).alias("licence_key")]),
    )
