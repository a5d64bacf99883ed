"""Licence scan by sparse TF-IDF cosine, then inheritance along paths; DataFrame functions only.

Units compared with the templates are a file's headers (each run of lines that name a
licence, copyright, warranty or the like), the paragraphs with such a name, windows of words
as long as a template around one, whatever lines they lie in, and, for licence files, the
whole text. Windows start at a quarter of their length from each other, and wherever a
template's first word stands. A licence file is one with such a name, or one whose words are
for the most part in its headers or in one such paragraph or window. Paragraphs and windows
are units only where their terms in common with a template could reach the threshold. Equal
units are compared once. idf covers headers and whole texts; a term outside the templates counts in a unit's norm.

A file has the licence of its best unit at `threshold` or above (ties, to 12 digits: by name); else it
inherits that of the nearest ancestor directory with a licence file (within one
directory: the best cosine, then the name). A null or empty text has no unit; a null path
inherits nothing; repeated rows are each scanned; texts are read whole, however long;
only the id, `path` and `text` are read, so other columns may have any name; an empty
table gives an empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import shared
from .divergence import split_words

#: Standard notices (fixed values).
TEMPLATES = {
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0. Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.',
        "SPDX-License-Identifier: Apache-2.0",
    ],
    "MIT": [
        "Released under the MIT License.",
        'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software.',
        'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.',
        "SPDX-License-Identifier: MIT",
    ],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "SPDX-License-Identifier: GPL-3.0-or-later",
    ],
    "BSD-3-Clause": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met.",
        'Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED.',
        "Licensed under the 3-Clause BSD License.",
        "SPDX-License-Identifier: BSD-3-Clause",
    ],
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.", "SPDX-License-Identifier: MPL-2.0"],
    "CC-BY-4.0": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."],
    "CC-BY-SA-4.0": ["Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."],
}
HEADER = r"(?i)licen[sc]|copyright|spdx|warrant|redistribut|permission is hereby|free software|source code form"
#: Words that can begin a match of HEADER.
KEYWORD = r"(?i)licen[sc]|copyright|spdx|warrant|redistribut|permission|free|source"
#: Between paragraphs: lines of white space and comment marks.
BETWEEN = r"\n(?:[^\p{L}\p{N}\n]*\n)+"
FILE_NAME = r"(?i)(^|/)(un)?licen[sc]e[^/]*$|(^|/)copying[^/]*$"


def terms(text: Column) -> Column:
    """Terms of a notice: runs of letters, digits, points and hyphens, without points at the end."""
    return F.transform(F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}\p{N}][\p{L}\p{N}.-]*"), F.lit(0)), lambda t: F.regexp_replace(t, r"[.-]+$", ""))


def template_energies(found: DataFrame, templates: dict[str, list[str]]) -> list[tuple[list[str], dict[str, float]]]:
    """Terms of every template, and the square of each term's weight under the idf of the units that count."""
    spark = found.sparkSession
    bodies = spark.createDataFrame([(x,) for v in templates.values() for x in v], "body string").select(terms(F.col("body")).alias("t")).collect()
    own = F.array(*[F.lit(x) for x in sorted({t for r in bodies for t in r.t})])
    counted = found.where("counts")
    n = dict(counted.select(F.explode(F.array_intersect(terms(F.col("unit")), own)).alias("term")).groupBy("term").count().collect())
    total = counted.count()
    return [(r.t, {t: (r.t.count(t) * (math.log((1 + total) / (1 + n.get(t, 0))) + 1)) ** 2 for t in r.t}) for r in bodies if r.t]


def _may_match(own: Column, energies: list[tuple[list[str], dict[str, float]]], threshold: float) -> Column:
    """Whether terms hold enough of a template for the threshold: no cosine is above the root of the energy in common."""
    out = F.lit(False)
    for _, e in energies:
        keys = F.array(*[F.lit(t) for t in e])
        weights = F.map_from_arrays(keys, F.array(*[F.lit(v) for v in e.values()]))
        held = _energy(own, keys, weights)
        out = out | (held >= (threshold * threshold - 1e-9) * sum(e.values()))
    return out


def _energy(own: Column, keys: Column, weights: Column) -> Column:
    return F.aggregate(F.array_intersect(own, keys), F.lit(0.0), lambda x, t: x + F.element_at(weights, t))


def windows(own: Column, energies: list[tuple[list[str], dict[str, float]]], threshold: float) -> Column:
    """Windows of the terms `own` that hold a keyword, are as long as a template and may match it."""
    marks = F.filter(F.transform(own, lambda w, i: F.when(w.rlike(KEYWORD), i)), lambda i: i.isNotNull())
    out = [_cut(own, marks, size, [e for e in energies if len(e[0]) == size], threshold) for size in sorted({len(t) for t, _ in energies})]
    return F.array_distinct(F.concat(*out)) if out else F.array().cast("array<string>")


def _cut(own: Column, marks: Column, size: int, energies: list, threshold: float) -> Column:
    """Texts of `size` terms: from places a quarter apart, and from terms that begin a template."""
    step, firsts = max(1, size // 4), sorted({t[0] for t, _ in energies})
    low = lambda i: F.floor(F.greatest(i - size + step, F.lit(0)) / step).cast("int") * step
    grid = F.flatten(F.transform(marks, lambda i: F.sequence(low(i), F.floor(i / step).cast("int") * step, F.lit(step))))
    heads = F.filter(F.transform(own, lambda w, i: F.when(w.isin(firsts), i)), lambda i: i.isNotNull())
    cut = F.transform(F.array_distinct(F.concat(grid, heads)), lambda a: F.slice(own, a + 1, size))
    return F.filter(F.transform(F.filter(cut, lambda x: _may_match(x, energies, threshold)), lambda x: F.array_join(x, " ")), lambda x: x.rlike(HEADER))


def _candidates(files: DataFrame, path: str, text: str) -> DataFrame:
    """Rows with a keyword or a licence file's name."""
    rows = files.select("_row", F.col(path).alias("_path"), F.col(text).alias("_text"), F.coalesce(F.col(path).rlike(FILE_NAME), F.lit(False)).alias("named"))
    return rows.where(F.col("_text").rlike(HEADER) | F.col("named"))


def _plain(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, r"\s+", " "))


def units(files: DataFrame, path: str, text: str) -> DataFrame:
    """(file, unit text, whether the file is a licence file) of every header and licence file; they count in idf."""
    rows = _candidates(files, path, text)
    lines = F.split("_text", "\n")
    marks = F.transform(lines, lambda x: x.rlike(HEADER))
    # consecutive header lines make one unit
    runs = F.filter(F.split(F.array_join(F.transform(lines, lambda x: F.when(x.rlike(HEADER), x).otherwise(F.lit("\x00"))), "\n"), "\x00"), lambda x: F.trim(F.replace(x, F.lit("\n"), F.lit(" "))) != "")
    rows = rows.withColumn("_runs", F.when(F.exists(marks, lambda x: x), runs).otherwise(F.array().cast("array<string>")))
    within = F.size(split_words(F.array_join("_runs", " ")))
    rows = rows.withColumn("is_file", F.col("named") | (2 * within > F.size(split_words(F.col("_text")))))
    all_units = F.when(F.col("named"), F.array_union("_runs", F.array("_text"))).otherwise(F.array_distinct("_runs"))
    return rows.select("_row", "is_file", F.explode(F.transform(all_units, _plain)).alias("unit"), F.lit(True).alias("counts")).where("unit != ''")


def more_units(files: DataFrame, path: str, text: str, energies: list, threshold: float) -> DataFrame:
    """The same of every paragraph with a keyword and every window of a template's length that may reach the threshold; they don't count in idf."""
    rows = _candidates(files, path, text).where(F.col("_text").rlike(HEADER)).withColumn("_terms", terms(F.col("_text")))
    paragraphs = F.transform(F.filter(F.split("_text", BETWEEN), lambda x: x.rlike(HEADER) & _may_match(terms(x), energies, threshold)), _plain)
    found = rows.select("_row", "named", F.size("_terms").alias("_n"), F.explode(F.array_union(paragraphs, windows(F.col("_terms"), energies, threshold))).alias("unit"))
    return found.select("_row", (F.col("named") | (2 * F.size(terms(F.col("unit"))) > F.col("_n"))).alias("is_file"), "unit", F.lit(False).alias("counts"))


def best_licences(found: DataFrame, templates: dict[str, list[str]], threshold: float) -> DataFrame:
    """(key, licence, cosine) of every different unit (key: its md5) that reaches the threshold with a template."""
    spark = found.sparkSession
    counted = found.groupBy(F.md5("unit").alias("key"), "unit").agg(F.count(F.when(F.col("counts"), 1)).alias("count"))
    tokens = counted.select("key", "count", F.explode(terms(F.col("unit"))).alias("term"))
    tokens = tokens.groupBy("key", "count", "term").agg(F.count("*").alias("tf"))
    model = spark.createDataFrame([(f"{k}#{i}", k, t) for k, v in templates.items() for i, t in enumerate(v)], "template string, licence string, body string")
    model = model.select("template", "licence", F.explode(terms(F.col("body"))).alias("term")).groupBy("template", "licence", "term").agg(F.count("*").alias("tf_t"))
    total = counted.agg(F.coalesce(F.sum("count"), F.lit(0))).first()[0]
    weight = lambda df: F.log((1 + F.lit(total)) / (1 + F.coalesce(F.col(df), F.lit(0)))) + 1
    frequencies = tokens.groupBy("term").agg(F.sum("count").alias("df"))
    idf = frequencies.select("term", weight("df").alias("idf"))
    vectors = tokens.join(idf, "term").withColumn("x", F.col("tf") * F.col("idf"))
    norms = vectors.groupBy("key").agg(F.sqrt(F.sum(F.col("x") * F.col("x"))).alias("norm"))
    model = model.join(frequencies, "term", "left").withColumn("y", F.col("tf_t") * weight("df"))
    norms_t = model.groupBy("template").agg(F.sqrt(F.sum(F.col("y") * F.col("y"))).alias("norm_t"))
    dots = vectors.join(model.select("term", "template", "licence", "y"), "term").groupBy("key", "template", "licence").agg(F.sum(F.col("x") * F.col("y")).alias("dot"))
    cosines = dots.join(norms, "key").join(norms_t, "template")
    # the last digits depend on the order of the sums, and equal cosines must be ties
    cosines = cosines.withColumn("cosine", F.round(F.col("dot") / (F.col("norm") * F.col("norm_t")), 12))
    best = cosines.where(F.col("cosine") >= threshold).groupBy("key").agg(F.min(F.struct((-F.col("cosine")).alias("c"), "licence")).alias("b"))
    return best.select("key", F.col("b.licence").alias("licence"), (-F.col("b.c")).alias("cosine"))


def ancestors(path: Column) -> Column:
    """Directories above a path, the nearest first; the root is ''."""
    parts = F.split(path, "/")
    return F.transform(F.sequence(F.size(parts) - 1, F.lit(0), F.lit(-1)), lambda k: F.array_join(F.slice(parts, 1, k), "/"))


def scan(files: DataFrame, file_id: str = "doc_id", path: str = "path", text: str = "text", templates: dict[str, list[str]] = TEMPLATES, threshold: float = 0.7) -> DataFrame:
    """For every file: id, path, licence, cosine, found (header, file or inherited) and the licence file's directory where inherited."""
    # a row is known by its id, path and text: equal rows get equal answers
    row = F.xxhash64(file_id, path, text)
    rows = files.select(F.col(file_id), F.col(path).alias("path"), F.col(text).alias("_text"), row.alias("_row"))
    counted = shared.keep(units(rows, "path", "_text").distinct(), "licence-units")
    more = more_units(rows, "path", "_text", template_energies(counted, templates), threshold).distinct()
    found = shared.keep(counted.unionByName(more), "licence-units")
    scored = found.select("_row", "is_file", F.md5("unit").alias("key")).join(best_licences(found, templates, threshold), "key")
    own = scored.groupBy("_row").agg(F.min(F.struct((-F.col("cosine")).alias("c"), "licence")).alias("b"), F.max("is_file").alias("is_file"))
    own = own.select("_row", F.col("b.licence").alias("licence"), (-F.col("b.c")).alias("cosine"), "is_file")
    plain = rows.drop("_text").join(own, "_row", "left")
    held = plain.where(F.col("is_file") & F.col("path").isNotNull()).select(F.element_at(ancestors(F.col("path")), 1).alias("dir"), "licence", "cosine")
    held = held.groupBy("dir").agg(F.min(F.struct((-F.col("cosine")).alias("c"), "licence")).alias("held"))
    # one lookup for each directory that holds files without a licence
    parents = plain.where(F.col("licence").isNull() & F.col("path").isNotNull()).select(F.element_at(ancestors(F.col("path")), 1).alias("parent")).distinct()
    up = parents.select("parent", F.posexplode(F.concat(F.array("parent"), F.when(F.col("parent") != "", ancestors(F.col("parent"))).otherwise(F.array().cast("array<string>")))).alias("steps", "dir"))
    near = up.join(held, "dir").groupBy("parent").agg(F.min(F.struct("steps", "dir", "held")).alias("near"))
    keyed = plain.withColumn("parent", F.when(F.col("licence").isNull(), F.element_at(ancestors(F.col("path")), 1)))
    joined = keyed.join(near, "parent", "left")
    by = F.when(F.col("licence").isNotNull(), F.when(F.col("is_file"), "file").otherwise("header")).when(F.col("near").isNotNull(), "inherited")
    return joined.select(file_id, "path", F.coalesce("licence", "near.held.licence").alias("licence"), F.coalesce("cosine", -F.col("near.held.c")).alias("cosine"), by.alias("found"), F.col("near.dir").alias("from_dir"))


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence of every document; its path is source / language / doc_id."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", F.concat_ws("/", "source", "lang", "doc_id").alias("path"))
    return scan(docs)


