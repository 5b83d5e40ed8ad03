"""License scan: TF-IDF cosine to templates, then inheritance by directory
(native DataFrame functions only).

Candidates are the lines of a file and all windows of up to LINES consecutive
lines or SENTENCES consecutive sentences, of which at least one has a licence
word; a licence file (by its name) also has its whole text, and all its lines
and sentences count.  A candidate's terms are weighted by
(1 + ln tf) * idf, with document frequencies counted over all files for the
terms of the templates (any other term has the weight of an unseen one), and
compared with every template by cosine.  The best template at or above
``least`` gives the file its own license; of equal scores, the one with more
version terms in the candidate.  A template has no term outside the templates,
so no cosine exceeds the share of known terms in a candidate's norm;
candidates below ``least`` by that bound are not compared.

An SPDX line names its license itself: its (first) identifier is compared as
an identifier, not by cosine, and holds for the file, whether a template knows
it or not; its ending (``-only``, ``-or-later``, ``+``) is left out.  A
template of a license that goes by a proper name (``NAMES``) wins only where
the candidate has that name.

A licence file covers its directory and all below it.  Files without a
license of their own take that of the nearest directory above them, found by
joining the ancestors of each directory with the directories of licence
files.

Cases: NULL or blank text has no license of its own; a NULL path has no
directory and inherits nothing; several licence files in a directory: the
best score of a whole text or single line counts, then the shorter path; repeated rows are scanned and kept
one by one; an empty table gives an empty result; only ``file_id``, ``path``
and ``text`` are read, whatever other columns there are.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickfold.session import write_table

LEAST = 0.6
#: Consecutive lines and sentences of a window, at most.
LINES, SENTENCES = 6, 3
#: Where a sentence ends: after a full stop, or at a line without a letter or digit.
SENTENCE_END = r"(?<=[.:!?])\s+|\n[^\p{L}\p{N}]*\n"
#: Java pattern of the lines looked at.
LICENCE_WORD = "(?i)licen[sc]|copyright|spdx|public domain|permission|redistribut"
LICENCE_FILE = "(?i)(^|/)(licen[sc]e|copying|notice)[^/]*$"

#: The identifier of an SPDX line, and the whole expression.
SPDX_ID = r"(?i)spdx-license-identifier:[ \t]*\(?[ \t]*([a-z0-9](?:[a-z0-9.+-]*[a-z0-9+])?)"
SPDX_LINE = r"(?i)spdx-license-identifier:[ \t]*\S*(?:[ \t]+(?:OR|AND|WITH)[ \t]+\S+)*"
#: The term without which a license is not named.
NAMES = {"Apache-2.0": "apache", "GPL-2.0": "gnu", "GPL-3.0": "gnu", "LGPL-2.1": "lesser",
         "LGPL-3.0": "lesser", "AGPL-3.0": "affero", "MPL-2.0": "mozilla"}

# Notices, file headers and headings of public licenses, several
# per license and version, and the full text of short ones.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the License); you may not use "
                   "this file except in compliance with the License. You may obtain a copy of the "
                   "License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
            "software and associated documentation files (the Software), to deal in the Software "
            "without restriction"),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the "
                "terms of the GNU General Public License as published by the Free Software "
                "Foundation, either version 3 of the License, or (at your option) any later version."),
    ("LGPL-3.0", "Licensed under the GNU Lesser General Public License, version 3."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without "
                     "modification, are permitted provided that the following conditions are met"),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC0-1.0", "Dedicated to the public domain under CC0 1.0."),
    ("Apache-2.0", "Apache License Version 2.0, January 2004"),
    ("Apache-2.0", "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/ "
                   "TERMS AND CONDITIONS FOR USE, REPRODUCTION, AND DISTRIBUTION"),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
            "software and associated documentation files (the Software), to deal in the Software "
            "without restriction, including without limitation the rights to use, copy, modify, merge, "
            "publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons "
            "to whom the Software is furnished to do so, subject to the following conditions:"),
    ("MIT", "MIT License Permission is hereby granted, free of charge, to any person obtaining a copy of this "
            "software and associated documentation files (the Software), to deal in the Software "
            "without restriction, including without limitation the rights to use, copy, modify, merge, "
            "publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons "
            "to whom the Software is furnished to do so, subject to the following conditions: The above "
            "copyright notice and this permission notice shall be included in all copies or substantial "
            "portions of the Software. THE SOFTWARE IS PROVIDED AS IS, WITHOUT WARRANTY OF ANY KIND, "
            "EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS "
            "FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT "
            "HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF "
            "CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE "
            "USE OR OTHER DEALINGS IN THE SOFTWARE."),
    ("GPL-2.0", "GNU GENERAL PUBLIC LICENSE Version 2, June 1991"),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the "
                "terms of the GNU General Public License as published by the Free Software "
                "Foundation; either version 2 of the License, or (at your option) any later version."),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the "
                "terms of the GNU General Public License version 2 as published by the Free Software "
                "Foundation."),
    ("GPL-3.0", "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("LGPL-2.1", "GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999"),
    ("LGPL-2.1", "This library is free software; you can redistribute it and/or modify it under the "
                 "terms of the GNU Lesser General Public License as published by the Free Software "
                 "Foundation; either version 2.1 of the License, or (at your option) any later version."),
    ("LGPL-3.0", "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("LGPL-3.0", "This library is free software: you can redistribute it and/or modify it under the "
                 "terms of the GNU Lesser General Public License as published by the Free Software "
                 "Foundation, either version 3 of the License, or (at your option) any later version."),
    ("AGPL-3.0", "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007"),
    ("AGPL-3.0", "This program is free software: you can redistribute it and/or modify it under the "
                 "terms of the GNU Affero General Public License as published by the Free Software "
                 "Foundation, either version 3 of the License, or (at your option) any later version."),
    ("MPL-2.0", "Mozilla Public License Version 2.0"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. "
                "If a copy of the MPL was not distributed with this file, You can obtain one at "
                "https://mozilla.org/MPL/2.0/."),
)

#: Terms: runs of ASCII letters, digits and inner dots, in lower case.
_TERM = "[a-z0-9]+(?:[.][a-z0-9]+)*"


def template_terms(text: str) -> dict[str, int]:
    counts: dict[str, int] = {}
    for t in re.findall(_TERM, text.lower()):
        counts[t] = counts.get(t, 0) + 1
    return counts


def _terms(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(f"({_TERM})"), 1)


def vocabulary(templates=TEMPLATES) -> list[str]:
    return sorted({t for _, text in templates for t in template_terms(text)})


def term_idf(files: DataFrame, templates=TEMPLATES) -> tuple[dict[str, float], float]:
    """idf of the templates' terms over all files, and that of an unseen term.
    At most one row per term of the templates reaches the driver."""
    terms = vocabulary(templates)
    held = F.filter(F.array_distinct(_terms(F.coalesce("text", F.lit("")))), lambda t: t.isin(terms))
    n = files.count()
    seen = {r["t"]: r["n"] for r in files.select(F.explode(held).alias("t")).groupBy("t").agg(
        F.count(F.lit(1)).alias("n")).collect()}
    return {t: math.log((1 + n) / (1 + seen.get(t, 0))) + 1 for t in terms}, math.log(1 + n) + 1


def template_vectors(idf: dict[str, float], templates=TEMPLATES) -> list[dict[str, float]]:
    vectors = []
    for _, text in templates:
        v = {t: (1 + math.log(n)) * idf[t] for t, n in template_terms(text).items()}
        norm = math.sqrt(sum(x * x for x in v.values()))
        vectors.append({t: x / norm for t, x in v.items()})
    return vectors


def _windows(parts: Column, most: int, least: int, everything: Column) -> Column:
    """All windows of ``least`` to ``most`` consecutive parts of which one has
    a licence word (of ``everything``: all windows), each once, as texts."""
    n = F.size(parts)
    at = F.filter(F.transform(parts, lambda x, i: F.when(everything | x.rlike(LICENCE_WORD), i)),
                  lambda i: i.isNotNull())
    # A window is start * (most + 1) + length.
    spans = F.array_distinct(F.flatten(F.transform(at, lambda i: F.array(
        *[F.when((i >= back) & (i - back + k <= n), (i - back) * (most + 1) + k)
          for k in range(least, most + 1) for back in range(k)]))))
    return F.transform(F.filter(spans, lambda x: x.isNotNull()), lambda x: F.array_join(F.slice(
        parts, F.floor(x / (most + 1)).cast("int") + 1, x % (most + 1)), " "))


def _best(files: DataFrame, idf: dict[str, float], unseen: float, least: float,
          templates) -> DataFrame:
    """Add ``own_license``, ``own_score`` and ``plain_score`` (of the whole
    text and single lines) to files (``_t``, ``_whole``)."""
    vectors = template_vectors(idf, templates)
    versions = [F.array(*[F.lit(t) for t in v if any(x.isdigit() for x in t)]).cast("array<string>")
                for v in vectors]
    # term -> [idf, weight in each template]
    weights = F.create_map(*[x for t in idf for x in (
        F.lit(t), F.array(F.lit(idf[t]), *[F.lit(v.get(t, 0.0)) for v in vectors]))])
    look = F.col("_whole") | F.col("_t").rlike(LICENCE_WORD)
    # Texts with an SPDX line: its identifier, and the text without the line.
    has = F.lower("_t").contains("spdx-license-identifier")
    said = F.regexp_replace(F.regexp_extract("_t", SPDX_ID, 1), "(?i)(-only|-or-later|[+])$", "")
    names = {name.lower(): name for name, _ in templates}
    known = F.create_map(*[F.lit(x) for pair in names.items() for x in pair])
    said = F.when(has & (said != ""), F.coalesce(F.try_element_at(known, F.lower(said)), said))
    files = files.withColumn("_said", said).withColumn(
        "_t", F.when(has, F.regexp_replace("_t", SPDX_LINE, " ")).otherwise(F.col("_t")))
    df = files.withColumns({"_l": F.when(look, F.split("_t", "\n")),
                            "_e": F.when(look, F.split("_t", SENTENCE_END))})
    lines = F.filter("_l", lambda x: F.col("_whole") | x.rlike(LICENCE_WORD))
    df = df.withColumn("_n", F.when(F.col("_whole"), F.concat(F.array("_t"), lines)).otherwise(lines))
    df = df.withColumn("_c", F.concat("_n", _windows(F.col("_l"), LINES, 2, F.col("_whole")),
                                      _windows(F.col("_e"), SENTENCES, 1, F.col("_whole"))))
    df = df.withColumn("_n", F.size("_n")).drop("_l", "_e")
    # Sorted terms of each candidate as runs: (term, how often).
    df = df.withColumn("_s", F.transform("_c", lambda x: F.sort_array(_terms(x))))
    df = df.withColumn("_r", F.transform("_s", lambda s: F.filter(F.transform(
        s, lambda t, i: F.when((i == 0) | (t != F.get(s, i - 1)), i)), lambda i: i.isNotNull())))

    def weighted(s: Column, r: Column) -> Column:
        return F.transform(r, lambda at, k: F.struct(
            F.get(s, at).alias("t"),
            (1 + F.log((F.coalesce(F.get(r, k + 1), F.size(s)) - at).cast("double"))).alias("tf"),
            # Most terms are in no template: a set look-up before the map's search.
            F.when(F.get(s, at).isin(list(idf)), F.try_element_at(weights, F.get(s, at))).alias("w")))

    def weight(x):
        return x["tf"] * F.coalesce(F.get(x["w"], F.lit(0)), F.lit(unseen))

    def square(w):
        return F.aggregate(w, F.lit(0.0), lambda a, x: a + weight(x) * weight(x))

    df = df.withColumn("_w", F.zip_with("_s", "_r", weighted))
    # Squared norm of each candidate, and its known terms.
    df = df.withColumn("_w", F.transform("_w", lambda w: F.struct(
        square(w).alias("all"), F.filter(w, lambda x: x["w"].isNotNull()).alias("known"))))

    def cosines(c: Column) -> Column:
        known, norm = c["known"], F.sqrt(c["all"])

        def dot(k):
            return F.aggregate(known, F.lit(0.0), lambda a, x: a + weight(x) * F.get(x["w"], F.lit(k + 1)))

        def score(k):
            cosine, name = F.round(dot(k) / norm, 9), NAMES.get(templates[k][0])
            return cosine if name is None else F.when(F.exists(known, lambda x: x["t"] == name), cosine)

        found = F.array_max(F.array(*[F.struct(
            score(k).alias("score"),
            F.size(F.array_intersect(F.transform(known, lambda x: x["t"]), versions[k])).alias("versions"),
            F.lit(name).alias("license")) for k, (name, _) in enumerate(templates)]))
        return F.when((c["all"] > 0) & (square(known) >= (least - 1e-6) ** 2 * c["all"]), found)

    df = df.withColumn("_b", F.transform("_w", cosines))
    df = df.withColumn("_p", F.array_max(F.slice("_b", F.lit(1), F.col("_n")))).withColumn("_b", F.array_max("_b"))
    found = F.col("_b.score") >= least
    one = F.when(F.col("_said").isNotNull(), F.lit(1.0))
    return df.withColumns({"own_license": F.coalesce("_said", F.when(found, F.col("_b.license"))),
                           "own_score": F.coalesce(one, F.when(found, F.col("_b.score"))),
                           "plain_score": F.coalesce(one, F.col("_p.score"), F.lit(0.0))}).drop(
        "_c", "_n", "_s", "_r", "_w", "_b", "_p", "_t", "_whole", "_said")


def _directory(path: Column) -> Column:
    return F.regexp_extract(path, "(?s)^(.*)/[^/]*$", 1)


def scan(files: DataFrame, least: float = LEAST, templates=TEMPLATES) -> DataFrame:
    """``file_id, path, own_license, own_score, license, license_path``: the
    license that holds for each file and the file that gives it."""
    base = files.select("file_id", "path", F.coalesce("text", F.lit("")).alias("text"))
    idf, unseen = term_idf(base, templates)
    whole = F.coalesce(F.col("path").rlike(LICENCE_FILE), F.lit(False))
    own = _best(base.select("file_id", "path", F.col("text").alias("_t"), whole.alias("_whole"),
                            whole.alias("is_licence"), _directory(F.col("path")).alias("dir")),
                idf, unseen, least, templates)
    own = write_table(own, name="own_licenses")
    given = own.where("is_licence AND own_license IS NOT NULL").groupBy("dir").agg(
        F.max_by(F.struct("own_license", "path"),
                 F.struct("plain_score", "own_score", F.length("path") * -1, "own_license", "path")).alias("g"))
    given = write_table(given.select(F.col("dir").alias("above"), "g.own_license", "g.path"),
                        name="given")
    # All directories above a directory, itself included; "" is the top.
    names = F.split("dir", "/")
    above = F.transform(F.sequence(F.lit(1), F.size(names)),
                        lambda k: F.struct(k.alias("depth"), F.array_join(
                            F.slice(names, F.lit(1), k), "/").alias("above")))
    dirs = own.where("dir IS NOT NULL").select("dir").distinct()
    # The top directory stands above all others; a relative path has it as "".
    pairs = dirs.select("dir", F.explode(F.array_union(
        F.array(F.struct(F.lit(0).alias("depth"), F.lit("").alias("above"))), above)).alias("a"))
    near = (pairs.select("dir", "a.depth", "a.above").join(given, "above").groupBy("dir").agg(
        F.max_by(F.struct(F.col("own_license").alias("license"), F.col("path").alias("license_path")),
                 "depth").alias("n")))
    near = write_table(near.select("dir", "n.license", "n.license_path"), name="inherited")
    has = F.col("own_license").isNotNull()
    return own.join(near, "dir", "left").select(
        "file_id", "path", "own_license", "own_score",
        F.coalesce("own_license", "license").alias("license"),
        F.when(has, F.col("path")).otherwise(F.col("license_path")).alias("license_path"))
