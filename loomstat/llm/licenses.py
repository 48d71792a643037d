"""Licences of files: TF-IDF cosine to templates, then inheritance from the nearest ancestor directory.

DataFrame expressions throughout. A file is compared as a whole, paragraph by
paragraph and line by line, with and without comment marks, and where none of
these holds a notice by runs of words as long as a template, so that a notice
is found wherever it stands and however it is wrapped. Files without a licence of their own take that of the
nearest directory above them that holds a licence file.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomstat.llm.common import col, unused
from loomstat.operators.joins import lookup_join
from loomstat.session import cut_lineage

THRESHOLD = 0.75
# Possessive repeats: the regex engine of the JVM recurses into other repeated groups.
WORD = r"[a-z0-9]++(?:[.+-][a-z0-9]++)*+"
# What opens a comment line or closes a block; a line of nothing else is an empty one.
COMMENT = r"(?m)^[ \t]*+(?:(?:/\*++|\*++/?|//++[!/]?|#++|--++|;++|%++|<!--++|-->)[ \t\r]*+)++|(?:\*/|-->)[ \t\r]*+$"
LICENSE_FILE = r"(?i)^(?:un)?licen[cs]e(?:[.-].*)?$|^copying(?:[.-].*)?$|^notice(?:[.-].*)?$"



def gnu_notice(label: str, name: str, version: str, mark: str, thing: str = "program") -> list[tuple[str, str]]:
    """First paragraph and whole of the header notice that the GNU licences give."""
    grant = f"This {thing} is free software{mark} you can redistribute it and/or modify it under the terms of the {name} as published by the Free Software Foundation, either version {version} of the License, or (at your option) any later version."
    warranty = f"This {thing} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the {name} for more details."
    copy = f"You should have received a copy of the {name} along with this {thing}. If not, see <https://www.gnu.org/licenses/>."
    return [(label, grant), (label, f"{grant} {warranty} {copy}")]


BSD_CONDITIONS = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: "
    "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
    "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. "
)
BSD_NAMES = "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission. "
BSD_DISCLAIMER = (
    "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS AS IS AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. "
    "IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) "
    "HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)

# Short forms, header notices, and of licence files the title or the text.
TEMPLATES = [
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License. See LICENSE in the project root for license information."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("LGPL-3.0", "This library is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This program is licensed under the GNU Affero General Public License, version 3."),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    # The sentence that opens the conditions is that of both BSD licences, so it names neither.
    ("BSD-3-Clause", BSD_NAMES),
    ("BSD-3-Clause", f"{BSD_CONDITIONS} 3. {BSD_NAMES}"),
    ("BSD-3-Clause", f"{BSD_CONDITIONS} 3. {BSD_NAMES} {BSD_DISCLAIMER}"),
    ("BSD-2-Clause", "Licensed under the BSD 2-Clause License."),
    ("BSD-2-Clause", BSD_CONDITIONS),
    ("BSD-2-Clause", f"{BSD_CONDITIONS} {BSD_DISCLAIMER}"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC0-1.0", "To the extent possible under law, the author has dedicated all copyright and related rights to the public domain worldwide under CC0 1.0."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    *gnu_notice("GPL-3.0", "GNU General Public License", "3", ":"),
    *gnu_notice("GPL-2.0", "GNU General Public License", "2", ";"),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License version 2 as published by the Free Software Foundation."),
    *gnu_notice("LGPL-3.0", "GNU Lesser General Public License", "3", ":"),
    *gnu_notice("LGPL-3.0", "GNU Lesser General Public License", "3", ":", "library"),
    *gnu_notice("LGPL-2.1", "GNU Lesser General Public License", "2.1", ";", "library"),
    *gnu_notice("AGPL-3.0", "GNU Affero General Public License", "3", ":"),
    ("GPL-3.0", "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("GPL-2.0", "GNU GENERAL PUBLIC LICENSE Version 2, June 1991"),
    ("LGPL-3.0", "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("LGPL-2.1", "GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999"),
    ("AGPL-3.0", "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007"),
    ("Apache-2.0", "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/"),
    ("MPL-2.0", "Mozilla Public License Version 2.0"),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-4.0", "Creative Commons Attribution 4.0 International Public License"),
    ("CC-BY-SA-4.0", "Creative Commons Attribution-ShareAlike 4.0 International Public License"),
    ("CC-BY-NC-4.0", "Creative Commons Attribution-NonCommercial 4.0 International Public License"),
    ("CC0-1.0", "CC0 1.0 Universal"),
    ("Unlicense", "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means."),
]


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0))


@dataclass
class LicenseTerms:
    """Template vectors over the corpus: idf of template words, of any other word, unit weights per template, anchor words, words of the templates in order."""

    names: list[str]
    idf: dict[str, float]
    other: float
    weights: list[tuple[str, int, float]]
    anchors: list[str]
    words: list[list[str]]


def fit_terms(texts: DataFrame, text: str, templates: Sequence[tuple[str, str]] = TEMPLATES, threshold: float = THRESHOLD) -> LicenseTerms:
    """Document frequencies of the template words in all texts, and from them the template vectors.

    A word that no template has counts as one that no text has. Anchors are the
    rarest words, as many as it takes until what is left of every template is
    shorter than the threshold: by Cauchy-Schwarz no text without an anchor
    reaches the threshold, so the others need not be looked at. Only as many
    rows as there are template words come to the driver.
    """
    listed = [re.findall(WORD, t.lower()) for _, t in templates]
    counted = [Counter(words) for words in listed]
    vocabulary = sorted(set().union(*counted))
    held = F.explode(F.array_intersect(words_of(col(text)), F.array(*[F.lit(w) for w in vocabulary])))
    seen = {r["term"]: r["df"] for r in texts.select(held.alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df")).collect()}
    n = texts.count()
    idf = {w: math.log((1 + n) / (1 + seen.get(w, 0))) + 1 for w in vocabulary}
    weights, rest = [], []
    for i, counts in enumerate(counted):
        length = math.sqrt(sum((c * idf[w]) ** 2 for w, c in counts.items()))
        unit = {w: c * idf[w] / length for w, c in counts.items()}
        weights += [(w, i, v) for w, v in sorted(unit.items())]
        rest.append(unit)
    anchors = []
    for word in sorted(vocabulary, key=lambda w: (-idf[w], w)):
        open_ = [u for u in rest if sum(v * v for w, v in u.items() if w not in anchors) >= threshold**2]
        if not open_:
            break
        if any(word in u for u in open_):
            anchors.append(word)
    return LicenseTerms([name for name, _ in templates], idf, math.log(1 + n) + 1, weights, anchors, listed)


def detect(texts: DataFrame, text: str, terms: LicenseTerms, threshold: float = THRESHOLD) -> DataFrame:
    """(digest, own_license, score) of the distinct texts that hold a licence: the best template at or above the threshold.

    Equal texts are compared once. Of equal cosines (to nine digits) the first
    template wins.
    """
    anchor = r"(?i)(?<![a-z0-9])(?:" + "|".join(re.escape(a) for a in terms.anchors) + r")(?![a-z0-9])"
    likely = texts.where(col(text).rlike(anchor)).select(F.md5(col(text)).alias("digest"), col(text).alias("text")).dropDuplicates(["digest"])
    bare = F.regexp_replace("text", COMMENT, "")
    blank = r"\n[ \t\r]*\n"
    parts = F.concat(F.array(F.col("text")), F.split("text", blank), F.split(bare, blank), F.split("text", "\n"))
    segments = likely.select("digest", F.posexplode(F.array_distinct(parts)).alias("part", "segment")).where(F.col("segment").rlike(anchor))
    whole = cut_lineage(best_templates(segments.select("digest", "part", words_of(F.col("segment")).alias("words")), terms, threshold))
    runs = windows(likely.join(whole.select("digest"), "digest", "left_anti"), terms, threshold)
    return whole.union(best_templates(runs, terms, threshold))


def windows(texts: DataFrame, terms: LicenseTerms, threshold: float) -> DataFrame:
    """(digest, part, words): runs of words as long as a template, so placed that an anchor word stands where the template has it.

    Runs whose words hold less than the threshold of the template's length
    cannot reach it (Cauchy-Schwarz) and are left out.
    """
    shapes, unit = [], {}
    for word, i, weight in terms.weights:
        unit.setdefault(i, {})[word] = weight
    anchors = set(terms.anchors)
    for i, words in enumerate(terms.words):
        for offset, word in enumerate(words):
            if word in anchors:
                shapes.append((word, i, offset, len(words)))
    spark = texts.sparkSession
    shape = F.broadcast(spark.createDataFrame(shapes, "anchor string, template int, offset int, size int"))
    mass = F.broadcast(spark.createDataFrame([(i, u) for i, u in unit.items()], "template int, unit map<string,double>"))
    spread = texts.select("digest", words_of(F.col("text")).alias("words"))
    placed = spread.select("digest", "words", F.posexplode("words").alias("at", "anchor")).where(F.col("anchor").isin(terms.anchors))
    # Placings of one start and length are one run.
    starts = placed.join(shape, "anchor").select("digest", "words", "template", F.greatest(F.col("at") - F.col("offset"), F.lit(0)).alias("start"), "size")
    run = F.slice("words", F.col("start") + 1, F.col("size"))
    cut = starts.select("digest", "template", "start", "size", run.alias("words")).join(mass, "template")
    held = F.aggregate(F.array_distinct("words"), F.lit(0.0), lambda a, w: a + F.coalesce(F.pow(F.element_at("unit", w), F.lit(2)), F.lit(0.0)))
    kept = cut.where(held >= threshold**2 - 1e-9).dropDuplicates(["digest", "start", "size"])
    return kept.select("digest", F.xxhash64("start", "size").alias("part"), "words")


def best_templates(segments: DataFrame, terms: LicenseTerms, threshold: float) -> DataFrame:
    """(digest, own_license, score) from segments (digest, part, words): the best template of each digest at or above the threshold."""
    spark = segments.sparkSession
    counted = segments.select("digest", "part", F.explode("words").alias("term")).groupBy("digest", "part", "term").agg(F.count(F.lit(1)).alias("tf"))
    # Both tables are as large as the templates, which are literals.
    idf = F.broadcast(spark.createDataFrame(list(terms.idf.items()), "term string, idf double"))
    weights = F.broadcast(spark.createDataFrame(terms.weights, "term string, template int, weight double"))
    weighed = counted.join(idf, "term", "left").select("digest", "part", "term", (F.col("tf") * F.coalesce("idf", F.lit(terms.other))).alias("w"))
    lengths = weighed.groupBy("digest", "part").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("length"))
    products = weighed.join(weights, "term").groupBy("digest", "part", "template").agg(F.sum(F.col("w") * F.col("weight")).alias("product"))
    cosines = products.join(lengths, ["digest", "part"]).select("digest", "template", F.round(F.col("product") / F.col("length"), 9).alias("score"))
    near = cosines.where(F.col("score") >= threshold)
    best = near.groupBy("digest").agg(F.max(F.struct("score", (-F.col("template")).alias("order"))).alias("best"))
    names = F.array(*[F.lit(n) for n in terms.names])
    return best.select("digest", F.element_at(names, (1 - F.col("best.order")).cast("int")).alias("own_license"), F.col("best.score").alias("score"))


def ancestors(path: Column) -> Column:
    """Directories above a path, nearest first, down to the root (the empty text)."""
    parts = F.split(path, "/")
    return F.transform(F.sequence(F.size(parts) - 1, F.lit(0), F.lit(-1)), lambda n: F.array_join(F.slice(parts, 1, n), "/"))


def scan_licenses(files: DataFrame, path: str = "path", text: str = "text", templates: Sequence[tuple[str, str]] = TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """Add own_license, score, license and license_dir to the files; columns of these names are replaced.

    ``own_license`` is what the file's own text says (with its cosine in
    ``score``), ``license`` that or else the one of the nearest ancestor
    directory whose licence file (LICENSE, COPYING, NOTICE and the like) holds one, and
    ``license_dir`` the directory it came from. Of several licence files in a
    directory the one of the smallest path speaks.

    Null and empty texts have no licence of their own; a null path inherits
    nothing; repeated rows are treated alike; an empty table stays empty.
    """
    own = ["own_license", "score", "license", "license_dir"]
    kept = [c for c in files.columns if c.lower() not in own]
    base = files.select(*[col(c) for c in kept])
    digest, place = unused(base, "license_digest", "license_path")
    found = cut_lineage(detect(base, text, fit_terms(base, text, templates, threshold), threshold))
    named = base.withColumns({digest: F.md5(col(text)), place: col(path).cast("string")})
    marked = lookup_join(named, found.select("digest", "own_license", "score"), digest)
    files_only = marked.select(F.col(place).alias("path"), "own_license").where(F.col("path").isNotNull())
    folder = F.element_at(ancestors(F.col("path")), 1)
    speakers = files_only.where(F.col("own_license").isNotNull() & F.element_at(F.split("path", "/"), -1).rlike(LICENSE_FILE))
    spoken = cut_lineage(speakers.groupBy(folder.alias("dir")).agg(F.min(F.struct("path", "own_license")).alias("least")).select("dir", F.col("least.own_license").alias("dir_license")))
    silent = files_only.where(F.col("own_license").isNull()).select("path").distinct()
    above = silent.select("path", F.posexplode(ancestors(F.col("path"))).alias("steps", "dir_up"))
    hits = lookup_join(above, spoken, "dir_up", how="inner")
    nearest = hits.groupBy("path").agg(F.min(F.struct("steps", F.col("dir_up"), "dir_license")).alias("near"))
    nearest = nearest.select(F.col("path").alias("_path"), F.col("near.dir_license").alias("inherited"), F.col("near.dir_up").alias("license_dir"))
    joined = marked.join(nearest, (F.col(place) == F.col("_path")) & F.col("own_license").isNull(), "left")
    return joined.select(*[col(c) for c in kept], "own_license", "score", F.coalesce("own_license", "inherited").alias("license"), "license_dir")
