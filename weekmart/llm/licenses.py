"""Licence scans: lines and files against licence templates, then inheritance from the nearest licensed directory.

Every line, and every whole file, is a sparse vector of its words: (1 + ln count) times the inverse document frequency.
Frequencies of the templates' words cover all files; any other word has the templates' mean weight. A line or file is
compared by cosine with the templates that share a word with it. A candidate must hold at least one of a template's
leading words: the rest of the template is so short a vector that, by the Cauchy-Schwarz inequality, it alone cannot
reach the least cosine. Files without a licence of their own take that of the nearest directory above them that has a
licence file. Headers of several lines and licence texts are compared in the same way, with runs of lines instead of
single ones. The stronger kind of evidence counts, and among equals the better match. All steps are DataFrame expressions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weekmart.session import staging_path

MIN_COSINE = 0.6
TOKEN = r"[a-z0-9]+(?:[.+-][a-z0-9]+)*"
LICENCE_FILE = r"(?i)(?:^|/)(?:un)?(?:licen[cs]es?|copying|notice)(?:[._-][^/]*)?$"

#: Notices by which licences are declared, and opening passages of licence files.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/ Terms and conditions for use, reproduction, and distribution"),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("LGPL-2.1", "Licensed under the GNU Lesser General Public License, version 2.1."),
    ("AGPL-3.0", "Licensed under the GNU Affero General Public License, version 3."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("Proprietary", "All rights reserved."),
)

_GNU = ("you can redistribute it and/or modify it under the terms of the GNU {} as published by the Free Software Foundation; either version {} of "
        "the License, or (at your option) any later version.")
_GNU_ONLY = "you can redistribute it and/or modify it under the terms of the GNU {} as published by the Free Software Foundation, version {}."
_GNU_KINDS = (
    ("GPL-2.0", "General Public License", "2"), ("GPL-3.0", "General Public License", "3"), ("LGPL-2.1", "Lesser General Public License", "2.1"),
    ("LGPL-3.0", "Lesser General Public License", "3"), ("AGPL-3.0", "Affero General Public License", "3"))
_MIT = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), "
    "to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, "
    "and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: ")
_MIT_REST = (
    "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. "
    "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, "
    "FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER "
    "LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.")
_BSD = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: "
    "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
    "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation "
    "and/or other materials provided with the distribution. ")
_BSD_3 = (
    "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software "
    "without specific prior written permission. ")
_BSD_REST = (
    "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE "
    "IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE "
    "FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR "
    "SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, "
    "OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.")

#: Fixed values, compared with runs of lines: standard headers; whole licence texts, compared with whole files too; titles that open a licence text.
PASSAGES = (
    *((name, "header", f"This program is free software: {form.format(title, version)}") for name, title, version in _GNU_KINDS for form in (_GNU, _GNU_ONLY)),
    ("Apache-2.0", "header", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. "
     "You may obtain a copy of the License at"),
    ("MPL-2.0", "header", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with "
     "this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    ("MIT", "header", _MIT), ("BSD-2-Clause", "header", _BSD), ("BSD-3-Clause", "header", _BSD + _BSD_3),
    ("MIT", "text", _MIT + _MIT_REST), ("BSD-2-Clause", "text", _BSD + _BSD_REST), ("BSD-3-Clause", "text", _BSD + _BSD_3 + _BSD_REST),
    ("Apache-2.0", "title", "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/"),
    ("GPL-2.0", "title", "GNU GENERAL PUBLIC LICENSE Version 2, June 1991"), ("GPL-3.0", "title", "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("LGPL-2.1", "title", "GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999"),
    ("LGPL-3.0", "title", "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("AGPL-3.0", "title", "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007"), ("MPL-2.0", "title", "Mozilla Public License Version 2.0"),
)
#: Kinds of evidence, the strongest first. What a line reserves counts only where nothing grants a licence.
EVIDENCE = ("text", "header", "title", "notice", "reserved")
RESERVED = "Proprietary"
#: A line that says that a licence does not apply is no evidence for it.
NEGATED = r"(^|[^a-z])(not|never|no longer)\s+(be\s+|been\s+)?(licen[cs]ed|released|distributed|covered|available)"
COMMENT = r"^\s*(?:#|//|/?\*|--|;|%|<!--)"


def words(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(TOKEN), F.lit(0))


def template_words(spark, templates: Sequence[tuple[str, str]]) -> DataFrame:
    """(template, license, term, n) of the given templates; their number is fixed by the caller."""
    table = spark.createDataFrame([(k, *t) for k, t in enumerate(templates)], "template int, license string, notice string")
    return table.select("template", "license", F.explode(words(F.col("notice"))).alias("term")).groupBy("template", "license", "term").agg(F.count("*").alias("n"))


def vector(n: Column, idf: Column) -> Column:
    return (1 + F.log(n.cast("double"))) * idf


def runs(text: Column) -> Column:
    """(line, terms) of runs of lines: whole ones without a line that has no words between, and those of comments or of other lines only."""
    def once(value: Column, then) -> Column:
        """``then`` of a value that is computed once, not again for each element."""
        return F.get(F.transform(F.array(value), then), F.lit(0))

    def of(kinds: Column) -> Column:
        edge = F.transform(kinds, lambda k, i: F.struct(k.alias("kind"), (i + 1).alias("line")))
        begins = F.filter(edge, lambda x: (x["kind"] > 0) & ((x["line"] == 1) | (F.get(kinds, x["line"] - 2) != x["kind"])))
        ends = F.filter(edge, lambda x: (x["kind"] > 0) & ((x["line"] == F.size(kinds)) | (F.get(kinds, x["line"]) != x["kind"])))
        return F.zip_with(begins, ends, lambda b, e: F.struct(b["line"].alias("line"), e["line"].alias("last")))

    def kind(x: Column) -> Column:
        return F.when(~F.lower(x).rlike(TOKEN), 0).when(x.rlike(COMMENT), 2).otherwise(1)

    def both(kinds: Column) -> Column:
        return F.array_distinct(F.concat(once(F.transform(kinds, lambda k: F.least(k, F.lit(1))), of), of(kinds)))

    def cut(lines: Column) -> Column:
        return F.transform(once(F.transform(lines, kind), both), lambda r: F.struct(
            r["line"].alias("line"), r["last"].alias("last"),
            words(F.array_join(F.slice(lines, r["line"], r["last"] - r["line"] + 1), "\n")).alias("terms")))

    return once(F.split(text, "\n"), cut)


def scan(
    files: DataFrame, path: str = "path", text: str = "text", templates: Sequence[tuple[str, str]] = TEMPLATES, min_cosine: float = MIN_COSINE,
) -> DataFrame:
    """(file, path, rank, license, score, line, licenses) of files with a licence of their own, and whether they license their directory.

    ``files`` has a unique ``file`` key. The best line or whole-file match counts: a notice before a reservation of rights
    (``rank``, the place in EVIDENCE), by score rounded to six digits, then the whole file (line 0), then the first line, then
    the licence's name. ``licenses`` has the best match of every line. A file licenses its directory (``covers``) if its name says so or if
    it matches as a whole. Null and empty texts match nothing, nor do lines with a negated notice.
    """
    rank = F.when(F.col("license") == RESERVED, EVIDENCE.index("reserved")).otherwise(EVIDENCE.index("notice"))
    scored = _scored(files, path, text, templates, min_cosine)
    return _best(scored.withColumns({"rank": rank, "covers": F.col("line") == 0}))


def _best(scored: DataFrame) -> DataFrame:
    """The strongest evidence of every file, the licences that its lines and runs match best, and whether it licenses its directory."""
    first = F.struct(F.col("rank"), (-F.col("score")).alias("score"), F.col("line"), F.col("license"))
    by_line = scored.groupBy("file", "path", "line").agg(F.min(first).alias("best"), F.max("covers").alias("covers"))
    found = by_line.groupBy("file", "path").agg(
        F.min("best").alias("best"), F.array_sort(F.collect_set("best.license")).alias("licenses"), F.max("covers").alias("covers"))
    return found.select(
        "file", "path", F.col("best.rank").alias("rank"), F.col("best.license").alias("license"), (-F.col("best.score")).alias("score"),
        F.col("best.line").alias("line"), "licenses",
        (F.col("covers") | F.coalesce(F.col("path").rlike(LICENCE_FILE), F.lit(False))).alias("covers"))


def scan_runs(
    files: DataFrame, path: str = "path", text: str = "text", passages: Sequence[tuple[str, str, str]] = PASSAGES, min_cosine: float = MIN_COSINE,
) -> DataFrame:
    """Like scan(), by (license, kind, passage): passages are compared with runs of lines, of which ``line`` is the first.

    Whole files are compared with the passages of kind text alone, and license their directory if they match; so does a
    file whose first run is a title.
    """
    kinds = F.array(*(F.lit(kind) for _, kind, _ in passages))
    scored = _scored(files, path, text, [(name, notice) for name, _, notice in passages], min_cosine, True).withColumn(
        "kind", F.get(kinds, F.col("template"))).where("line > 0 or kind = 'text'")
    covers = F.when(F.col("kind") == "text", F.col("line") == 0).otherwise((F.col("kind") == "title") & (F.col("line") == F.col("opening")))
    rank = F.array_position(F.array(*map(F.lit, EVIDENCE)), F.col("kind")).cast("int") - 1
    return _best(scored.withColumns({"rank": rank, "covers": covers}))


def _scored(files: DataFrame, path: str, text: str, templates: Sequence[tuple[str, str]], min_cosine: float, by_runs: bool = False) -> DataFrame:
    """Whole files (line 0) and lines, or runs of lines, beside the templates of which they have the least cosine at least."""
    spark = files.sparkSession
    rows = files.select("file", F.col(path).alias("path"), F.col(text).alias("text"))
    terms = template_words(spark, templates)
    listed = sorted(r[0] for r in terms.select("term").distinct().collect())
    vocabulary = F.array(*map(F.lit, listed))
    seen = rows.select(F.explode_outer(F.array_intersect(words(F.col("text")), vocabulary)).alias("term"), "file")
    total = F.broadcast(rows.agg(F.count("*").alias("files")))
    frequency = seen.where("term is not null").groupBy("term").agg(F.count("*").alias("df"))
    stored = staging_path(spark, "license-terms")
    weighted = terms.join(frequency, "term", "left").join(total).withColumn(
        "idf", F.log((1 + F.col("files")) / (1 + F.coalesce("df", F.lit(0)))) + 1).withColumn("w", vector(F.col("n"), F.col("idf")))
    weighted.select("template", "license", "term", "n", "idf", "w").coalesce(1).write.parquet(stored)
    weighted = spark.read.parquet(stored)

    by_weight = Window.partitionBy("template").orderBy("w", F.desc("term"))
    squares = F.col("w") * F.col("w")
    lead = weighted.withColumn("below", F.sum(squares).over(by_weight)).withColumn("all", F.sum(squares).over(Window.partitionBy("template")))
    leading = sorted(r[0] for r in lead.where(F.col("below") >= min_cosine**2 * F.col("all") * (1 - 1e-9)).select("term").distinct().collect())
    other = weighted.select("term", "idf").distinct().agg(F.avg("idf").alias("other"))

    leads = F.array(*map(F.lit, leading))
    if by_runs:
        rows = rows.where(F.arrays_overlap(words(F.col("text")), leads))
        lines = F.filter(runs(F.col("text")), lambda x: F.arrays_overlap(x["terms"], leads))
    else:
        lines = F.filter(F.transform(F.split("text", "\n"), lambda x, k: F.struct((k + 1).alias("line"), (k + 1).alias("last"), words(x).alias("terms"))),
                         lambda x: F.arrays_overlap(x["terms"], leads) & ~F.get(F.split("text", "\n"), x["line"] - 1).rlike(f"(?i){NEGATED}"))
    opening = F.size(F.split(F.regexp_extract("text", r"^[^A-Za-z0-9]*", 0), "\n"))
    hit = rows.withColumn("lines", lines).where(F.size("lines") > 0).withColumn("opening", opening)
    whole = F.array(F.struct(F.lit(0).alias("line"), F.lit(0).alias("last"), F.flatten(F.array(words(F.col("text")))).alias("terms")))
    if not by_runs:
        whole = F.when(F.col("text").rlike(f"(?i){NEGATED}"), F.slice(whole, 1, 0)).otherwise(whole)
    spans = hit.select("file", "path", "opening", F.explode(F.concat(whole, F.col("lines"))).alias("span"))
    counted = spans.select("file", "path", "opening", F.col("span.line").alias("line"), F.col("span.last").alias("last"), F.explode("span.terms").alias("term")).groupBy(
        "file", "path", "opening", "line", "last", "term").agg(F.count("*").alias("n"))
    known = weighted.select("term", "idf").distinct()
    vectors = counted.join(F.broadcast(known), "term", "left").join(F.broadcast(other)).withColumn(
        "v", vector(F.col("n"), F.coalesce("idf", "other")))
    norms = F.sqrt(F.sum(F.col("v") * F.col("v")))
    in_span = vectors.groupBy("file", "path", "opening", "line", "last").agg(
        norms.alias("length"), F.collect_list(F.when(F.col("idf").isNotNull(), F.struct("term", "v"))).alias("found"))
    lengths = weighted.groupBy("template").agg(F.sqrt(F.sum(squares)).alias("template_length"))
    against = F.broadcast(weighted.join(lengths, "template").select("template", "license", "template_length", "term", "w"))
    return (
        in_span.select("file", "path", "opening", "line", "last", "length", F.explode("found").alias("x")).select("file", "path", "opening", "line", "last", "length", "x.term", "x.v")
        .join(against, "term").groupBy("file", "path", "opening", "line", "last", "length", "template", "license", "template_length")
        .agg(F.sum(F.col("v") * F.col("w")).alias("dot"))
        .withColumn("score", F.round(F.col("dot") / (F.col("length") * F.col("template_length")), 6)).where(F.col("score") >= min_cosine))


def directory(path: Column) -> Column:
    """The directory of a slash-separated path; the empty string is the root."""
    return F.regexp_replace(path, "/?[^/]*$", "")


def nearest_licenses(found: DataFrame, directories: DataFrame) -> DataFrame:
    """(directory, inherited, inherited_from): for each directory the licence of the nearest one at or above it.

    ``found`` is scan()'s result, ``directories`` has one column, the different directories. Where files of one directory
    license it differently, the strongest evidence, then the best score, then the first path, decides.
    """
    choice = F.struct(F.col("rank"), (-F.col("score")).alias("score"), "path", "license")
    licensed = found.where("covers").groupBy(directory(F.col("path")).alias("above")).agg(F.min(choice).alias("by"))
    parts = F.split("directory", "/")
    depth = F.when(F.col("directory") == "", 0).otherwise(F.size(parts))
    above = directories.withColumn("depth", F.explode(F.sequence(F.lit(0), depth))).withColumn(
        "above", F.array_join(F.slice(parts, 1, F.col("depth")), "/"))
    return above.join(licensed, "above").groupBy("directory").agg(
        F.max(F.struct(F.col("depth"), F.col("by.license").alias("license"), F.col("above"))).alias("nearest")).select(
        "directory", F.col("nearest.license").alias("inherited"), F.col("nearest.above").alias("inherited_from"))


def license_files(
    files: DataFrame, id: str = "doc_id", path: str = "path", text: str = "text", templates: Sequence[tuple[str, str]] = TEMPLATES,
    min_cosine: float = MIN_COSINE, passages: Sequence[tuple[str, str, str]] = PASSAGES,
) -> DataFrame:
    """One row a row of ``files``: ``id``, path, own_license, score, line, all_licenses, inherited_from and license (own, else inherited).

    A file's own licence follows from its strongest evidence: a licence text, a header, the title of a text, a notice in a
    line, and last a reservation of rights; among evidence of one kind the best score counts. ``all_licenses`` names, comma-joined,
    all that the file shows evidence of.

    Rows that repeat id and path share the best of their texts. A null path has no directory and inherits nothing; null
    and empty texts have no licence of their own; a null id is an id like any other. Other columns are not read; an empty
    table gives no rows.
    """
    key = F.struct(files[id].alias("id"), files[path].alias("path"))
    rows = files.select(key.alias("file"), files[path].alias("path"), files[text].alias("text"))
    stored = staging_path(files.sparkSession, "licenses")
    scan(rows, "path", "text", templates, min_cosine).unionByName(scan_runs(rows, "path", "text", passages, min_cosine)).write.parquet(stored)
    first = F.struct(F.col("rank"), (-F.col("score")).alias("score"), F.col("line"), F.col("license"))
    found = files.sparkSession.read.parquet(stored).groupBy("file", "path").agg(
        F.min(first).alias("best"), F.max("covers").alias("covers"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("licenses")))).alias("all")).select(
        "file", "path", F.col("best.rank").alias("rank"), F.col("best.license").alias("license"), (-F.col("best.score")).alias("score"),
        F.col("best.line").alias("line"), F.array_join("all", ",").alias("all_licenses"), "covers")
    listed = rows.select("file", directory(F.col("path")).alias("directory"))
    near = nearest_licenses(found, listed.select("directory").where("directory is not null").distinct())
    own = found.select(F.col("file").alias("own_file"), "license", "score", "line", "all_licenses")
    joined = listed.join(own, F.col("file").eqNullSafe(F.col("own_file")), "left").join(near, "directory", "left")
    return joined.select(
        F.col("file.id").alias(id), F.col("file.path").alias("path"), F.col("license").alias("own_license"), "score", "line", "all_licenses",
        F.when(F.col("license").isNull(), F.col("inherited_from")).alias("inherited_from"), F.coalesce("license", "inherited").alias("license"))
