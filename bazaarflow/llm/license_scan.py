"""Licences of files: notices compared with templates, then inherited along paths.

Every line that could be a licence notice becomes a sparse TF-IDF vector; its
cosine with the templates gives a file's own licence. So do whole files and windows of lines,
sentences and words around each notice, which are compared with headers and
full texts too; SPDX lines name theirs. Directories take the
licence of their licence files, and files without one take that of the nearest
directory above them. Column expressions and joins only.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bazaarflow.functions.text import let
from bazaarflow.llm.tasks import written

# Short notices of common licences under their usual identifiers.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0",
    "BSD-3-Clause": "Redistribution and use in source and binary forms, BSD 3-Clause License",
    "CC-BY-4.0": "This work is licensed under the Creative Commons Attribution 4.0 International License, CC BY 4.0",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3",
    "LGPL-3.0": "This library is licensed under the GNU Lesser General Public License, version 3",
    "MIT": "Released under the MIT License",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, version 2.0",
    "Proprietary": "All rights reserved",
}
NOTICE = r"(?i)licen[cs]|\bSPDX\b|all rights reserved|redistribution and use|mozilla public"
# Standard headers of several lines; full texts lie in files named by their identifiers.
_GNU = (
    "This {0} is free software; you can redistribute it and/or modify it under the terms of the GNU {1}General Public License as published by the "
    "Free Software Foundation; either version {2} of the License, or (at your option) any later version."
)
_NO_WARRANTY = (
    " This {0} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or "
    "FITNESS FOR A PARTICULAR PURPOSE. See the GNU {1}General Public License for more details."
)
_GNU_KINDS = {"GPL-2.0": ("program", "", "2"), "GPL-3.0": ("program", "", "3"), "LGPL-2.1": ("library", "Lesser ", "2.1"), "LGPL-3.0": ("library", "Lesser ", "3"), "AGPL-3.0": ("program", "Affero ", "3")}
HEADERS = [
    *[(name, text.format(*of)) for name, of in _GNU_KINDS.items() for text in (_GNU, _GNU + _NO_WARRANTY)],
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. '
     "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software "
     'distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. '
     "See the License for the specific language governing permissions and limitations under the License."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, "
     "You can obtain one at http://mozilla.org/MPL/2.0/."),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
]
TEXTS = Path(__file__).parent / "licence_texts"
#: What passages are sought around; lines before and after in a window, words before and after in one; the name that an SPDX line gives.
PASSAGE = NOTICE + r"|permission is hereby granted|permission to use, copy"
LINES = ((0, 1), (1, 0), (1, 1), (0, 2), (2, 2), (1, 4), (0, 6), (3, 7), (0, 10), (0, 14), (4, 14), (2, 20), (0, 24))
WORDS = ((3, 3), (7, 0), (0, 8), (5, 7), (8, 3))
SPDX = r"(?i)SPDX-License-Identifier:[ \t]*(\(?[A-Za-z0-9.+-]+\)?(?:[ \t]+(?:AND|OR|WITH)[ \t]+\(?[A-Za-z0-9.+-]+\)?)*)"
#: Lines longer than this are cut by words into lines of up to 60 characters and the rest of a word, so that every window
#: is bounded. What is longer than any word of a licence, such as code without blanks, is left out of them.
LONG = 300
CUT = r"\S.{0,59}\S{0,140}"
NO_WORD = r"\S{100,}"
#: Lines around a notice that its windows take from.
BEFORE = max(a for a, _ in LINES)
AROUND = BEFORE + max(a + b for a, b in LINES) + 1
LICENCE_FILE = r"(?i)(?:^|/)(?:licen[cs]e|copying|notice)(?:\.\w+)?$"
#: Cosine from which a notice is that of a template.
LIKE = 0.75


def _terms(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}.-]+|\.(?=\s|$)", -1), lambda t: t != "")


def notices(files: DataFrame, text: str = "text", path: str = "path") -> DataFrame:
    """Lines that could be notices, with the licence each is most like: path, line, license, similarity.

    All lines of the whole text are looked at. Weights count in how many
    different notices of all files a term occurs. Ties go to the first name.
    """
    spark = files.sparkSession
    found = files.where(F.col(text).rlike(NOTICE)).select(
        F.col(path).alias("path"), F.explode(F.filter(F.split(F.col(text), r"\R", -1), lambda x: x.rlike(NOTICE))).alias("line")
    )
    lines = written(found.withColumn("unit", F.md5("line")), "notices")
    # Different lines first: a notice that a third of all files carry is compared once.
    kinds = lines.select("unit", "line").dropDuplicates(["unit"])
    templates = _templates(spark)
    total = kinds.count()
    counted = kinds.select("unit", F.explode(_terms(F.col("line"))).alias("term")).groupBy("unit", "term").agg(F.count(F.lit(1)).alias("tf"))
    often = counted.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    # The terms of the templates, at most a few hundred, with their weights.
    idf = F.log((total + 1) / (F.coalesce("df", F.lit(0)) + 1)) + 1
    known = templates.join(often, "term", "left").select("license", "term", (F.col("t_tf") * idf).alias("t"))
    length = known.groupBy("license").agg(F.sqrt(F.sum(F.col("t") * F.col("t"))).alias("t_length"))
    weighted = counted.join(often, "term").select("unit", "term", (F.col("tf") * idf).alias("w"))
    own = weighted.groupBy("unit").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("w_length"))
    both = weighted.join(F.broadcast(known), "term").groupBy("unit", "license").agg(F.sum(F.col("w") * F.col("t")).alias("dot"))
    like = F.col("dot") / (F.col("w_length") * F.col("t_length"))
    scored = both.join(F.broadcast(length), "license").join(own, "unit").select("unit", "license", F.round(like, 6).alias("similarity"))
    best = scored.groupBy("unit").agg(F.max(F.struct("similarity", _reversed_name(F.col("license")).alias("order"), "license")).alias("best"))
    chosen = best.where(F.col("best.similarity") >= LIKE)
    return lines.join(chosen, "unit").select("path", "line", F.col("best.license").alias("license"), F.col("best.similarity").alias("similarity"))


def _reversed_name(license_: Column) -> Column:
    """Greater for names that come first."""
    names = F.array(*[F.lit(n) for n in sorted(TEMPLATES, reverse=True)])
    return F.array_position(names, license_)


def _templates(spark: SparkSession) -> DataFrame:
    rows = spark.createDataFrame(list(TEMPLATES.items()), "license string, text string")
    return rows.select("license", F.explode(_terms(F.col("text"))).alias("term")).groupBy("license", "term").agg(F.count(F.lit(1)).alias("t_tf"))


def _references() -> list[tuple[str, str, float, float]]:
    """Licence, template, term and its weight over the template's length; the weight of a term falls with the templates that have it."""
    texts = [*TEMPLATES.items(), *HEADERS, *((f.stem, f.read_text(errors="replace")) for f in sorted(TEXTS.glob("*.txt")))]
    counts = [Counter(t for t in re.split(r"[^a-z0-9.-]+|\.(?=\s|$)", text.lower()) if t) for _, text in texts]
    often = Counter(t for c in counts for t in c)
    rows = []
    for number, ((name, _), count) in enumerate(zip(texts, counts, strict=True)):
        weights = {t: n * _rarity(len(texts), often[t]) for t, n in count.items()}
        length = math.sqrt(sum(w * w for w in weights.values()))
        rows += [(name, number, t, w / length, _rarity(len(texts), often[t])) for t, w in weights.items()]
    return rows


def _rarity(total: int, often: int) -> float:
    return math.log((total + 1) / (often + 1)) + 1


def passages(files: DataFrame, text: str = "text", path: str = "path") -> DataFrame:
    """Whole files with a notice and windows around each notice, with the licence each is most like: path, license, similarity, whole.

    Marks of comments at the ends of lines don't count. SPDX expressions are taken as they are, with a
    similarity of 1 and ``whole``. Equal passages are compared once.
    """
    some = files.where(F.col(text).rlike(PASSAGE)).select(F.col(path).alias("path"), F.col(text).alias("text"))
    bare = some.withColumn("lines", F.split(F.regexp_replace("text", r"(?m)^[\s#*/;!%>-]+|[\s*/>-]+$", "\n"), r"\R+", -1))
    cut = F.transform("lines", lambda x: F.when(F.length(x) > LONG, F.regexp_extract_all(F.regexp_replace(x, NO_WORD, " "), F.lit(CUT), F.lit(0))).otherwise(F.array(x)))
    bare = bare.withColumn("given", F.size("lines")).withColumn("lines", F.flatten(cut))
    # A notice may lie over two of the lines that a long one was cut into. Inside a loop
    # the lines are bound, or they could be worked out again for each of them.
    longer = F.size("lines") > F.col("given")
    starts = let(F.col("lines"), lambda lines: F.transform(
        lines, lambda x, i: F.when(x.rlike(PASSAGE) | (longer & F.array_join(F.slice(lines, i + 1, F.lit(2)), " ").rlike(PASSAGE)), i)))
    bare = bare.withColumn("at", F.filter(starts, lambda i: i.isNotNull())).withColumn("joined", F.array_join("lines", " "))
    bare = bare.select("path", "lines", "at", "joined")

    # One row per notice with the lines around it, however many notices a file has.
    around = let(F.col("lines"), lambda lines: F.transform("at", lambda i: F.struct(
        F.least(i, F.lit(BEFORE)).alias("i"), F.slice(lines, F.greatest(i - BEFORE, F.lit(0)) + 1, F.lit(AROUND)).alias("lines"))))
    near = bare.select("path", F.explode(around).alias("n")).select("path", "n.i", "n.lines")
    windows = F.array(*[F.array_join(F.slice("lines", F.greatest(F.col("i") - a, F.lit(0)) + 1, F.lit(a + b + 1)), " ") for a, b in LINES])
    near = near.select("path", F.explode(F.array_distinct(windows)).alias("text"))
    # A sentence too long for a header is left to the windows inside it.
    sentences = F.filter(F.split("joined", r"(?<=[.!?])\s+", -1), lambda x: x.rlike(PASSAGE) & (F.length(x) <= LONG * AROUND))
    words = F.concat(*[F.regexp_extract_all("joined", F.lit(r"(?:(?<!\S)\S++\s){0,%d}(?<!\S)[^\s]*?(?i:licen[cs]|reserved|public)\S*+(?:\s\S++){0,%d}" % w), F.lit(0)) for w in WORDS])
    inside = bare.select("path", F.explode(F.array_distinct(F.concat(sentences, words))).alias("text"))
    units = bare.select("path", F.lit(True).alias("whole"), F.col("joined").alias("text"))
    for part in (near, inside):
        units = units.unionByName(part.select("path", F.lit(False).alias("whole"), "text"))
    found = written(units.withColumn("unit", F.md5("text")), "passages")

    rows = _references()
    total = len({r[1] for r in rows})
    schema = "license string, template int, term string, t double, idf double"
    terms = files.sparkSession.createDataFrame(rows, schema).groupBy("term").agg(
        F.first("idf").alias("idf"), F.collect_list(F.struct("license", "template", "t")).alias("ts")
    )  # a few thousand terms
    counted = found.select("unit", "text").dropDuplicates(["unit"]).select("unit", F.explode(_terms(F.col("text"))).alias("term"))
    counted = counted.groupBy("unit", "term").agg(F.count(F.lit(1)).alias("tf"))
    weighted = counted.join(F.broadcast(terms), "term", "left").withColumn("w", F.col("tf") * F.coalesce("idf", F.lit(_rarity(total, 0))))
    # The length of a passage counts all its terms, also those of no template.
    length = weighted.groupBy("unit").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("length"))
    dots = weighted.where(F.col("ts").isNotNull()).select("unit", "w", F.explode("ts").alias("t"))
    dots = dots.groupBy("unit", "t.template", "t.license").agg(F.sum(F.col("w") * F.col("t.t")).alias("dot"))
    like = F.round(F.col("dot") / F.col("length"), 6)
    best = dots.join(length, "unit").groupBy("unit").agg(F.min(F.struct((-like).alias("less"), "license")).alias("best")).where(-F.col("best.less") >= LIKE)
    chosen = found.select("path", "whole", "unit").join(best, "unit").select("path", "best.license", (-F.col("best.less")).alias("similarity"), "whole")
    named = some.select("path", F.explode(F.regexp_extract_all("text", F.lit(SPDX), F.lit(1))).alias("license"))
    return chosen.unionByName(named.select("path", "license", F.lit(1.0).alias("similarity"), F.lit(True).alias("whole"))).distinct()


def folder(path: Column) -> Column:
    """The folder of a path: ``/`` at the top of absolute paths, empty at the top of relative ones."""
    return F.when(path.rlike("^/[^/]*$"), "/").otherwise(F.regexp_extract(path, r"^(.*)/[^/]*$", 1))


def licences(files: DataFrame, text: str = "text", path: str = "path", licence_file: Column | None = None) -> DataFrame:
    """One row per path: its licence, its similarity, where it comes from and the folder that passed it on.

    ``origin`` is ``notice`` for a notice in the file itself, ``folder`` for one
    inherited from the nearest folder above with a licence file, else null. Paths are separated
    by slashes; a licence file is known by its name, or by ``licence_file``. A file with several
    notices has what an SPDX line or its whole text says, else the most similar one, then the first name;
    that all rights are reserved counts only where nothing else is said. Repeated paths are
    one file; files with a null path or text have no notice, and a null path is one row. Other
    columns are ignored; an empty table gives an empty result.
    """
    wanted = F.col(path).rlike(LICENCE_FILE) if licence_file is None else licence_file
    every = files.select(F.col(path).alias("path"), F.col(text).cast("string").alias("text"), F.coalesce(wanted, F.lit(False)).alias("whole"))
    both = notices(every).select("path", "license", "similarity", F.lit(False).alias("whole")).unionByName(passages(every))
    rank = F.when(F.col("license") == "Proprietary", 2).when(F.col("whole"), 0).otherwise(1)
    found = both.groupBy("path").agg(F.min(F.struct(rank.alias("rank"), (-F.col("similarity")).alias("less"), "license", "similarity")).alias("own"))
    found = written(found, "licences-found")  # used twice below
    paths = every.groupBy("path").agg(F.max("whole").alias("whole"))
    paths = paths.withColumn("folder", folder(F.col("path")))
    named = paths.join(found, "path", "left")
    given = named.where(F.col("whole") & F.col("own").isNotNull()).groupBy("folder").agg(F.min("own").alias("given"))
    # Folders, not files, look for what lies above them: a hot folder asks once.
    parts = F.split("folder", "/", -1)
    above = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda n: F.struct(n.alias("depth"), F.array_join(F.slice(parts, 1, n), "/").alias("above")))
    below = F.filter(above, lambda a: ~a["above"].isin("", "/"))
    every_folder = paths.select("folder").where(F.col("folder").isNotNull()).distinct()
    folders = every_folder.withColumn("a", F.explode(below)).select("folder", "a.depth", "a.above")
    passed = given.select(F.col("folder").alias("above"), "given")
    # The two tops lie above all folders: at most two rows, sent to every task.
    tops = passed.where(F.col("above").isin("", "/"))
    top = F.when(F.col("folder").startswith("/"), "/").otherwise("")
    from_top = every_folder.select("folder", F.lit(0).alias("depth"), top.alias("above")).join(F.broadcast(tops), "above")
    nearest = (
        folders.join(passed.where(~F.col("above").isin("", "/")), "above").unionByName(from_top)
        .groupBy("folder").agg(F.max_by(F.struct("above", "given"), "depth").alias("near"))
    )
    joined = named.join(nearest, "folder", "left")
    own = F.col("own").isNotNull()
    return joined.select(
        "path",
        F.coalesce("own.license", "near.given.license").alias("license"),
        F.coalesce("own.similarity", "near.given.similarity").alias("similarity"),
        F.when(own, "notice").when(F.col("near").isNotNull(), "folder").alias("origin"),
        F.when(~own, F.col("near.above")).alias("passed_on_by"),
    )
