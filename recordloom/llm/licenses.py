"""License scans: TF-IDF cosine to templates, then inheritance from the nearest directory.

All of it runs as DataFrame expressions. Units compared to the short notices are the lines that
mention a license (headers) and, for texts with such a line, the whole text (license files). Beside them
whole texts are compared to the full texts of ``license_texts``, and blocks of lines (runs of comment lines or of other
lines that are not blank, and their paragraphs) that mention a license to full texts, standard headers and the short notices, so it does not
matter where a notice is wrapped; an SPDX-License-Identifier line names its license. Term
weights are tf x idf with document frequencies counted over all texts; words outside the templates
have the weight of a word never seen, so they only lengthen a unit's vector. A file takes the license
of its best line or of its whole text; else that of the nearest directory above it, its own first,
that holds a license file, which is a file whose whole text matches.

NULL and empty texts match nothing but inherit; a NULL path has no directory. Ties go to the
template's name, in a directory to the best score, then the license's name. Repeated rows
are judged alike, each by itself. Only the named columns are read.
"""

from __future__ import annotations

from collections.abc import Callable
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.joins import sized_join
from ..sources.scratch import materialize
from .common import words

# Short notices of common licenses, as published for use in file headers.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-header": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance "
        "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"
    ),
    "BSD-3-Clause": "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License. Licensed under CC BY 4.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or any later version."
    ),
    "MIT": "Released under the MIT License.",
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
        "distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."
    ),
}

_GPL = (
    "{0} is free software: you can redistribute it and/or modify it under the terms of the GNU {1} as published by the Free Software "
    "Foundation, either version {2} of the License, or (at your option) any later version. {0} is distributed in the hope that it will be "
    "useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU "
    "{1} for more details. You should have received a copy of the GNU {1} along with this program. If not, see https://www.gnu.org/licenses/."
)
# Standard headers in full, as the licenses print them; blocks of lines are compared to these.
HEADERS = {
    "AGPL-3.0": _GPL.format("This program", "Affero General Public License", 3),
    "Apache-2.0": TEMPLATES["Apache-2.0-header"] + (
        " Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, "
        "WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing "
        "permissions and limitations under the License."
    ),
    "GPL-2.0": _GPL.format("This program", "General Public License", 2),
    "GPL-3.0": _GPL.format("This program", "General Public License", 3),
    "LGPL-2.1": _GPL.format("This library", "Lesser General Public License", "2.1"),
    "LGPL-3.0": _GPL.format("This library", "Lesser General Public License", 3),
}

SPDX = r"(?i)SPDX-License-Identifier:\s*(\(*[a-z0-9][a-z0-9.+-]*\)*(?:\s+(?:OR|AND|WITH)\s+\(*[a-z0-9][a-z0-9.+-]*\)*)*)"
COMMENT = r"^\s*(?:#|//|/\*|\*|--|;|%|<!--|\.\.\s|(?i:rem)\s)"
MENTION = r"(?i)licen[cs]e|copyright|spdx|all rights reserved|public domain"
LEAST_COSINE = 0.6
LEAST_FULL = 0.8  # full texts hold so many common words that prose comes near 0.6


def _vectors(units: DataFrame, keys: list[str], idf: DataFrame, unseen: Column) -> DataFrame:
    """(keys, term, weight) and the length of each unit's vector; ``units`` has the column words."""
    tf = units.select(*keys, F.explode("words").alias("term")).groupBy(*keys, "term").agg(F.count("*").alias("tf"))
    weighed = tf.join(F.broadcast(idf), "term", "left")  # idf has one row per template word
    return weighed.withColumn("weight", F.col("tf") * F.coalesce("idf", unseen))


def full_texts() -> dict[str, str]:
    """The full license texts by their SPDX names, read on the driver."""
    return {p.stem: p.read_text(encoding="utf-8") for p in sorted((Path(__file__).parent / "license_texts").glob("*.txt"))}


def _blocks(parting: str, which: int) -> tuple[Column, Callable[[Column], Column], Column]:
    """The kind of every line, where the kind turns, and from that in ``_turns``: runs of ``_lines`` that match ``parting`` and are of a kind, comments or not, as (line, unit); only those that mention a license."""
    line = lambda i: F.get("_lines", i)
    kind = lambda i: F.when(~line(i).rlike(parting), 0).when(line(i).rlike(COMMENT), 1).otherwise(2)
    kinds = F.transform(F.sequence(F.lit(0), F.size("_lines") - 1), kind)
    turns = lambda k: F.filter(F.sequence(F.lit(0), F.size(k) - 1), lambda i: (i == 0) | (F.get(k, i) != F.get(k, i - 1)))
    starts = F.col(f"_turns{which}")
    stops = F.concat(F.slice(starts, 2, F.size(starts)), F.array(F.size("_lines")))
    unit = lambda a, b: F.struct((a * 2 + which).alias("line"), F.array_join(F.slice("_lines", a + 1, b - a), "\n").alias("unit"))
    return kinds, turns, F.filter(F.zip_with(starts, stops, unit), lambda s: s.unit.rlike(MENTION))


def _reaches(unit: Column, vocabulary: list[str], least: Column) -> Column:
    """Whether a unit of these words can have a cosine of ``least`` to anything; if not, it surely has not.

    No weight is above that of a word never seen, and a word outside the vocabulary has just that. So of the squared length, in such
    weights squared, words in the vocabulary have the sum of their counts squared at most, and the others their number at least.
    """
    known = F.array_intersect(F.array_distinct(unit), F.split(F.lit(" ".join(vocabulary)), " "))
    # Arrays of one element, so that each step is worked out once.
    counts = F.transform(F.array(known), lambda k: F.transform(k, lambda x: F.size(F.filter(unit, lambda w: w == x)).cast("double")))
    total = lambda c, f: F.aggregate(c, F.lit(0.0), lambda n, x: n + f(x))
    square = (least - 1e-6) ** 2
    enough = lambda c: total(c, lambda x: x * x) * (1 - square) >= square * (F.size(unit) - total(c, lambda x: x))
    return F.transform(counts, enough)[0]


def text_scores(files: DataFrame) -> DataFrame:
    """(k1, k2, line, license, score) of whole texts (line -1) and blocks of lines of ``keyed`` files, by full texts, headers, notices and SPDX."""
    spark, full = files.sparkSession, full_texts()
    patterns = {f"{k}-full": v for k, v in full.items()} | {f"{k}-block": v for k, v in HEADERS.items()} | TEMPLATES
    known = _templates(spark, patterns)
    listing = sorted({w for row in known.collect() for w in row.words})
    vocabulary = spark.createDataFrame([(w,) for w in listing], "term string")
    every = files.select(F.explode_outer(F.concat(F.array_distinct(words(F.col("text"))), F.array(F.lit("")))).alias("term"))
    listed = vocabulary.union(spark.createDataFrame([("",)], "term string"))
    counted = materialize(every.join(F.broadcast(listed), "term").groupBy("term").agg(F.count("*").alias("df")), "frequencies")
    n = (counted.filter("term = ''").first() or [0, 0])[1]
    idf = vocabulary.join(F.broadcast(counted), "term", "left").select("term", (F.log((1 + n) / (1 + F.coalesce("df", F.lit(0)))) + 1).alias("idf"))
    idf = materialize(idf, "block_idf")

    rows = files.select("k1", "k2", "text").filter(F.col("text").rlike(MENTION)).distinct()
    rows = rows.withColumn("_lines", F.split("text", "\n", -1))
    for which, parting in enumerate((r"\S", r"[a-zA-Z0-9]")):
        kinds, turns, units = _blocks(parting, which)
        rows = rows.withColumn(f"_kinds{which}", kinds)
        rows = rows.withColumn(f"_turns{which}", turns(F.col(f"_kinds{which}")))
        rows = rows.withColumn(f"_units{which}", units)
    others = F.filter("_units1", lambda s: ~F.exists("_units0", lambda t: t.unit == s.unit))  # a block of one paragraph counts once
    whole = F.array(F.struct(F.lit(-1).alias("line"), F.col("text").alias("unit")))
    units = F.transform(F.concat(whole, "_units0", others), lambda s: F.struct(s.line.alias("line"), words(s.unit).alias("words")))
    near = F.filter(units, lambda s: _reaches(s.words, listing, F.when(s.line < 0, LEAST_FULL).otherwise(LEAST_COSINE)))
    units = rows.select("k1", "k2", F.inline_outer(near)).filter("line IS NOT NULL")
    least = F.when(F.col("template").endswith("-full"), LEAST_FULL).otherwise(LEAST_COSINE)
    allowed = (F.col("line") >= 0) | F.col("template").endswith("-full")
    scores = _best(units, known, idf, F.log(F.lit(1.0 + n)) + 1, allowed & (F.col("score") >= least))
    named = F.filter(
        F.transform("_lines", lambda s, i: F.struct((i * 2).alias("line"), F.regexp_extract(s, SPDX, 1).alias("license"))), lambda s: s.license != ""
    )
    spdx = rows.select("k1", "k2", F.inline(named)).select("k1", "k2", "line", "license", F.lit(1.0).alias("score"))
    return scores.union(spdx)


def _templates(spark: SparkSession, templates: dict[str, str]) -> DataFrame:
    return spark.createDataFrame(sorted(templates.items()), "template string, notice string").select(
        "template", words(F.col("notice")).alias("words")
    )


def license_scores(files: DataFrame, templates: dict[str, str] = TEMPLATES) -> DataFrame:
    """(k1, k2, line, license, score) of the best template per unit of ``keyed`` files; line -1 is the whole text."""
    spark = files.sparkSession
    known = _templates(spark, templates)
    vocabulary = sorted({w for row in known.collect() for w in row.words})  # of the templates, not of the data
    held = F.array_intersect(F.array_distinct(words(F.col("text"))), F.array(*map(F.lit, vocabulary)))
    seen = files.select(F.explode_outer(F.concat(held, F.array(F.lit("")))).alias("term"))  # "" stands for every file
    counts = {row.term: row.n for row in seen.groupBy("term").agg(F.count("*").alias("n")).collect()}
    n = counts.get("", 0)
    frequencies = spark.createDataFrame([(w, counts.get(w, 0)) for w in vocabulary], "term string, df long")
    idf = frequencies.select("term", (F.log((1 + n) / (1 + F.col("df"))) + 1).alias("idf"))
    unseen = F.log(F.lit(1.0 + n)) + 1

    mentioning = files.select("k1", "k2", "text").filter(F.col("text").rlike(MENTION))
    lines = F.filter(
        F.transform(F.split("text", "\n", -1), lambda s, i: F.struct(i.alias("line"), s.alias("unit"))),
        lambda s: s.unit.rlike(MENTION),
    )
    units = F.concat(F.array(F.struct(F.lit(-1).alias("line"), F.col("text").alias("unit"))), lines)
    units = mentioning.select("k1", "k2", F.inline_outer(units)).distinct().select("k1", "k2", "line", words(F.col("unit")).alias("words"))
    return _best(units, known, idf, unseen, F.col("score") >= LEAST_COSINE)


def _best(units: DataFrame, known: DataFrame, idf: DataFrame, unseen: Column, enough: Column) -> DataFrame:
    """(k1, k2, line, license, score) of the best template per unit, of those with ``enough``."""
    keys = ["k1", "k2", "line"]
    vectors = _vectors(units, keys, idf, unseen)
    patterns = _vectors(known, ["template"], idf, unseen)
    lengths = patterns.groupBy("template").agg(F.sqrt(F.sum(F.col("weight") ** 2)).alias("template_length"))
    patterns = patterns.select("template", "term", F.col("weight").alias("template_weight"))
    length = vectors.groupBy(*keys).agg(F.sqrt(F.sum(F.col("weight") ** 2)).alias("length"))
    dots = vectors.join(F.broadcast(patterns), "term").groupBy(*keys, "template").agg(
        F.sum(F.col("weight") * F.col("template_weight")).alias("dot")
    )
    scored = dots.join(length, keys).join(F.broadcast(lengths), "template")
    score = F.round(F.col("dot") / (F.col("length") * F.col("template_length")), 6)
    ranked = scored.select(*keys, score.alias("score"), "template").filter(enough)
    best = F.min(F.struct((-F.col("score")).alias("minus"), F.col("template")))
    chosen = ranked.groupBy(*keys).agg(best.alias("best"))
    return chosen.select(*keys, F.regexp_replace("best.template", "-(header|block|full)$", "").alias("license"), (-F.col("best.minus")).alias("score"))


def _parent(path: Column) -> Column:
    """Everything before the last slash; '' for a name alone, NULL for NULL."""
    return F.regexp_replace(path, r"/?[^/]*$", "")


def license_scan(files: DataFrame, id_col: str = "doc_id", path_col: str = "path", text_col: str = "text") -> DataFrame:
    """Per file: doc_id, path, license, score, how (header, file, inherited or none) and origin, the directory inherited from."""
    rows = files.select(F.col(id_col).alias("doc_id"), F.col(path_col).alias("path"), F.col(text_col).alias("text"))
    rows = rows.withColumns({"k1": F.xxhash64("doc_id", "path", F.coalesce("text", F.lit(""))), "k2": F.xxhash64("text", "path", "doc_id")})
    rows = rows.withColumn("text", F.coalesce("text", F.lit("")))
    scores = materialize(license_scores(rows).union(text_scores(rows)), "license_scores")
    best = F.min(F.struct((-F.col("score")).alias("minus"), "license", F.col("line")))
    own = scores.groupBy(F.col("k1").alias("o1"), F.col("k2").alias("o2")).agg(
        best.alias("best"), F.min(F.when(F.col("line") < 0, F.struct((-F.col("score")).alias("minus"), "license"))).alias("whole")
    )
    narrow = rows.select("doc_id", "path", "k1", "k2", _parent(F.col("path")).alias("dir"))
    judged = sized_join(narrow, materialize(own, "licenses"), [(F.col("k1"), F.col("o1")), (F.col("k2"), F.col("o2"))], "left")
    judged = materialize(judged, "licensed_files")

    granted = judged.filter("whole IS NOT NULL AND dir IS NOT NULL").groupBy(F.col("dir").alias("origin")).agg(F.min("whole").alias("grant"))
    # Directories, not files, look for the nearest grant above them, so no path is a hot key.
    dirs = judged.filter("dir IS NOT NULL").select("dir").distinct()
    parts = F.split("dir", "/")
    depth = F.size(parts)
    above = F.concat(
        F.transform(F.sequence(F.lit(1), depth), lambda i: F.struct(i.alias("depth"), F.array_join(F.slice(parts, F.lit(1), i), "/").alias("origin"))),
        F.array(F.struct(F.lit(0).alias("depth"), F.lit("").alias("origin"))),
    )
    climbed = dirs.select("dir", F.inline(above)).join(granted, "origin")
    nearest = climbed.groupBy(F.col("dir").alias("n_dir")).agg(F.max_by(F.struct("origin", "grant"), "depth").alias("up"))
    joined = sized_join(judged, materialize(nearest, "nearest_grants"), [(F.col("dir"), F.col("n_dir"))], "left")
    has, up = F.col("best").isNotNull(), F.col("up").isNotNull()
    return joined.select(
        "doc_id",
        "path",
        F.coalesce("best.license", "up.grant.license").alias("license"),
        F.when(has, -F.col("best.minus")).otherwise(-F.col("up.grant.minus")).alias("score"),
        F.when(has & F.col("whole").isNotNull(), "file").when(has, "header").when(up, "inherited").otherwise("none").alias("how"),
        F.when(~has, F.col("up.origin")).alias("origin"),
    )


def query(spark, sf_dir: str) -> DataFrame:
    """Documents have no path: source, hundred of the id and id stand for one."""
    from .common import read

    path = F.concat_ws("/", "source", F.floor(F.col("doc_id") / 100).cast("string"), F.col("doc_id").cast("string"))
    return license_scan(read(spark, sf_dir, "documents").select("doc_id", path.alias("path"), "text"))


_WORDS = r"""list_filter(regexp_split_to_array(translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '')"""
_VALUES = ", ".join("('" + k + "', '" + v.replace("'", "''") + "')" for k, v in sorted(TEMPLATES.items()))
SQL = f"""
WITH tpl AS (SELECT template, {_WORDS.format('notice')} AS ws FROM (VALUES {_VALUES}) AS t(template, notice)),
d AS (SELECT doc_id, source || '/' || (doc_id // 100)::VARCHAR || '/' || doc_id::VARCHAR AS path, coalesce(text, '') AS text FROM documents),
vocabulary AS (SELECT DISTINCT unnest(ws) AS term FROM tpl),
seen AS (SELECT DISTINCT doc_id, unnest({_WORDS.format('text')}) AS term FROM d),
idf AS (
  SELECT v.term, ln((1 + (SELECT count(*) FROM d)) / (1 + count(s.term))) + 1 AS idf
  FROM vocabulary v LEFT JOIN seen s USING (term) GROUP BY v.term),
mention AS (SELECT * FROM d WHERE regexp_matches(text, '{MENTION}')),
lines AS (SELECT doc_id, generate_subscripts(ls, 1) - 1 AS line, unnest(ls) AS unit FROM (SELECT doc_id, string_split(text, chr(10)) AS ls FROM mention)),
units AS (
  SELECT doc_id, -1 AS line, text AS unit FROM mention
  UNION ALL SELECT doc_id, line, unit FROM lines WHERE regexp_matches(unit, '{MENTION}')),
tf AS (
  SELECT doc_id, line, term, count(*) AS tf FROM (SELECT doc_id, line, unnest({_WORDS.format('unit')}) AS term FROM units) GROUP BY ALL),
vec AS (
  SELECT doc_id, line, term, tf * coalesce(idf, ln(1.0 + (SELECT count(*) FROM d)) + 1) AS weight FROM tf LEFT JOIN idf USING (term)),
pat AS (
  SELECT template, term, count(*) * any_value(idf) AS weight FROM (SELECT template, unnest(ws) AS term FROM tpl) JOIN idf USING (term) GROUP BY ALL),
vlen AS (SELECT doc_id, line, sqrt(sum(weight ** 2)) AS len FROM vec GROUP BY ALL),
plen AS (SELECT template, sqrt(sum(weight ** 2)) AS len FROM pat GROUP BY ALL),
dots AS (SELECT doc_id, line, template, sum(vec.weight * pat.weight) AS dot FROM vec JOIN pat USING (term) GROUP BY ALL),
scored AS (
  SELECT doc_id, line, template, round(dot / (vlen.len * plen.len), 6) AS score FROM dots JOIN vlen USING (doc_id, line) JOIN plen USING (template)),
unit_best AS (
  SELECT doc_id, line, score, regexp_replace(template, '-header$', '') AS license FROM scored WHERE score >= {LEAST_COSINE}
  QUALIFY row_number() OVER (PARTITION BY doc_id, line ORDER BY score DESC, template) = 1),
best AS (SELECT * FROM unit_best QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, license, line) = 1),
whole AS (SELECT doc_id, score, license, regexp_replace(path, '/?[^/]*$', '') AS dir FROM unit_best JOIN d USING (doc_id) WHERE line = -1),
grants AS (SELECT * FROM whole QUALIFY row_number() OVER (PARTITION BY dir ORDER BY score DESC, license) = 1),
j AS (SELECT d.doc_id, path, regexp_replace(path, '/?[^/]*$', '') AS dir, b.license, b.score, w.doc_id IS NOT NULL AS is_file
  FROM d LEFT JOIN best b USING (doc_id) LEFT JOIN whole w USING (doc_id)),
up AS (
  SELECT j.doc_id, g.dir AS origin, g.license AS up_license, g.score AS up_score FROM j JOIN grants g
  ON j.dir = g.dir OR g.dir = '' OR starts_with(j.dir, g.dir || '/')
  QUALIFY row_number() OVER (PARTITION BY j.doc_id ORDER BY length(g.dir) DESC) = 1)
SELECT doc_id, path, coalesce(license, up_license) AS license, coalesce(score, up_score) AS score,
  CASE WHEN license IS NOT NULL AND is_file THEN 'file' WHEN license IS NOT NULL THEN 'header' WHEN origin IS NOT NULL THEN 'inherited' ELSE 'none' END AS how,
  CASE WHEN license IS NULL THEN origin END AS origin
FROM j LEFT JOIN up USING (doc_id)
"""
