"""Detection and inheritance against a plain Python reading of the rules."""

import math
import re
from collections import Counter

from loomstat.llm import licenses as lic
from loomstat.llm import queries

MIT = next(t for n, t in lic.TEMPLATES if n == "MIT" and "hereby" in t)


def brute(rows):
    """rows: (path, text) to a list of (own, score, license, dir)."""
    templates = [Counter(re.findall(lic.WORD, t.lower())) for _, t in lic.TEMPLATES]
    vocabulary = set().union(*templates)
    df = Counter(w for _, text in rows for w in set(re.findall(lic.WORD, (text or "").lower())) & vocabulary)
    n = len(rows)

    def idf(w):
        return math.log((1 + n) / (1 + df[w])) + 1 if w in vocabulary else math.log(1 + n) + 1

    def cosine(a, b):
        dot = sum(a[w] * idf(w) * b[w] * idf(w) for w in a if w in b)
        return dot / math.sqrt(sum((a[w] * idf(w)) ** 2 for w in a) * sum((b[w] * idf(w)) ** 2 for w in b)) if a and b else 0

    own = []
    for _, text in rows:
        best = (0, 0)
        parts = {text or "", *re.split(r"\n[ \t\r]*\n", text or ""), *(text or "").split("\n")}
        for part in parts:
            words = Counter(re.findall(lic.WORD, part.lower()))
            if not any(w in vocabulary for w in words):
                continue
            for i, template in enumerate(templates):
                c = round(cosine(words, template), 9)
                if c >= lic.THRESHOLD:
                    best = max(best, (c, -i))
        own.append((lic.TEMPLATES[-best[1]][0], best[0]) if best[0] else (None, None))
    speaks = {}
    for (path, _), (name, _) in sorted(zip(rows, own), key=lambda x: x[0][0] or ""):
        if path is not None and name and re.match(lic.LICENSE_FILE.replace("(?i)", ""), path.split("/")[-1], re.I):
            speaks.setdefault("/".join(path.split("/")[:-1]), name)
    out = []
    for (path, _), (name, score) in zip(rows, own):
        where = None
        if name is None and path is not None:
            parts = path.split("/")[:-1]
            for n in range(len(parts), -1, -1):
                if "/".join(parts[:n]) in speaks:
                    where = "/".join(parts[:n])
                    break
        out.append((path, name, score and round(score, 6), name or (speaks[where] if where is not None else None), where))
    return sorted(out, key=repr)


def test_planted_files(spark, nothing):
    wrapped = "# " + "\n# ".join(re.findall(r".{1,60}(?: |$)", MIT))
    rows = [
        ("a/LICENSE", MIT), ("a/b/LICENSE.md", "Licensed under CC BY-NC 4.0."), ("a/b/COPYING", "Licensed under the Apache License, Version 2.0."), ("a/b/c/x.py", "print(1)"),
        ("a/y.py", wrapped + "\n\nimport os"), ("a/z.py", "import os"), ("b/q.py", "import os"), ("LICENSE", "no licence here"), (None, "Released under the MIT License."),
        (None, None), ("c/LICENSE", None), ("c/n.txt", ""), ("b/m.txt", "some prose\nThis work is licensed under the GNU General Public License, version 3.\nmore prose"),
        ("b/m2.txt", "The license of the house and the permission of the use of the file."), ("a/z.py", "import os"),
    ]
    frame = spark.createDataFrame([(*r, "x", 1.5) for r in rows], "path string, text string, dir string, score double")
    got = lic.scan_licenses(frame)
    assert got.columns == ["path", "text", "dir", "own_license", "score", "license", "license_dir"]
    found = sorted(((r.path, r.own_license, r.score and round(r.score, 6), r.license, r.license_dir) for r in got.collect()), key=repr)
    assert found == brute(rows)
    by_path = {r[0]: r for r in found}
    assert by_path["a/b/c/x.py"][3] == "Apache-2.0" and by_path["a/z.py"][3] == "MIT" and by_path["a/y.py"][1] == "MIT" and by_path["b/q.py"][3] is None
    assert lic.scan_licenses(nothing.withColumnRenamed("source", "path")).collect() == []


def test_awkward(awkward):
    frame = awkward.withColumnRenamed("source", "path")
    got = lic.scan_licenses(frame).collect()
    assert len(got) == frame.count() and all(r.license is None for r in got)


def test_whole_table(spark, folder):
    rows = queries.op2_licenses(spark, folder).collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    want = brute([(r.path, texts[r.doc_id]) for r in rows])
    got = sorted(((r.path, r.own_license, r.score, r.license, r.license_dir) for r in rows), key=repr)
    assert got == want
    assert any(r[1] for r in got)


def gnu(name, version, mark, thing="program"):
    return (
        f"This {thing} is free software{mark} you can redistribute it and/or modify\nit under the terms of the {name} as published by\nthe Free Software Foundation, either version {version} of the License, or\n"
        f"(at your option) any later version.\n\nThis {thing} is distributed in the hope that it will be useful,\nbut WITHOUT ANY WARRANTY; without even the implied warranty of\n"
        f"MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the\n{name} for more details.\n"
    )


BSD2 = """Copyright (c) 2020, A. Writer
All rights reserved.

Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.
"""
DISCLAIMER = """
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS"
AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED.
"""
NAMES = """
3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.
"""
GPL, LGPL, AGPL = (f"GNU {kind}General Public License" for kind in ("", "Lesser ", "Affero "))
NOTICES = [
    ("GPL-3.0", gnu(GPL, "3", ":")), ("GPL-2.0", gnu(GPL, "2", ";")), ("LGPL-3.0", gnu(LGPL, "3", ":")), ("LGPL-3.0", gnu(LGPL, "3", ":", "library")), ("LGPL-2.1", gnu(LGPL, "2.1", ";", "library")),
    ("AGPL-3.0", gnu(AGPL, "3", ":")), ("BSD-2-Clause", BSD2 + DISCLAIMER), ("BSD-3-Clause", BSD2 + NAMES + DISCLAIMER), ("MIT", MIT + ", subject to the following conditions:"),
    ("CC-BY-4.0", "Attribution 4.0 International\n\n=====\n\nCreative Commons Attribution 4.0 International Public License\n\nBy exercising"),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."), ("CC0-1.0", "Creative Commons Legal Code\n\nCC0 1.0 Universal\n"),
    ("LGPL-3.0", "GNU LESSER GENERAL PUBLIC LICENSE\n                       Version 3, 29 June 2007\n\n Copyright (C) 2007"), ("MPL-2.0", "Mozilla Public License Version 2.0\n======\n\n1. Definitions"),
    ("Apache-2.0", "   Apache License\n   Version 2.0, January 2004\n   http://www.apache.org/licenses/\n\n   TERMS AND CONDITIONS"), ("AGPL-3.0", "GNU AFFERO GENERAL PUBLIC LICENSE\n  Version 3, 19 November 2007\n"),
]


def test_standard_notices(spark):
    """Every standard notice gets its own label."""
    frame = spark.createDataFrame([(f"{i}.txt", text) for i, (_, text) in enumerate(NOTICES)] + [(f"x{i}.txt", "words of a document") for i in range(200)], "path string, text string")
    got = {r.path: r.own_license for r in lic.scan_licenses(frame).collect()}
    assert [got[f"{i}.txt"] for i in range(len(NOTICES))] == [name for name, _ in NOTICES]


def test_comment_blocks_and_prose(spark):
    """Notices in comment blocks and amid prose on one line are found."""
    header = gnu(GPL, "3", ":") + "\nYou should have received a copy of the notice with the many pages of this book."
    blocks = ["/*\n * This file is part of a program of many parts.\n *\n" + "".join(f" * {line}".rstrip() + "\n" for line in header.split("\n")) + " */\nint x;"]
    blocks += ["\n".join(f"{mark} {line}".rstrip() for line in ("A heading of the file with words of its own.\n\n" + header).split("\n")) + "\ncode = 1" for mark in ("#", "//", "--")]
    prose = "Many words come before it. This page is Licensed under the Apache License, Version 2.0. and more words follow it on the same line. " + "other words of prose " * 20
    other = [("p.txt", prose), ("q.txt", "A license and a version of the software, with permission to use a copy of the file. " * 5)]
    frame = spark.createDataFrame([(f"{i}.c", text) for i, text in enumerate(blocks)] + other + [(f"x{i}.txt", "words of a document") for i in range(200)], "path string, text string")
    got = {r.path: r.own_license for r in lic.scan_licenses(frame).collect()}
    assert [got[f"{i}.c"] for i in range(len(blocks))] == ["GPL-3.0"] * len(blocks)
    assert got["p.txt"] == "Apache-2.0" and got["q.txt"] is None
