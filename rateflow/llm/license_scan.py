"""License scan: MinHash bands over text windows, then exact shingle containment.

Texts and templates are normalised to lower-case words of letters and digits and cut
into 5-word shingles.  Templates fall into size classes; for each class a text has
overlapping windows a quarter longer than the class, at a stride of a quarter, so
that one window holds a whole occurrence.  A template has at least two thirds of its
class's shingles, so window and template have a Jaccard similarity of 0.38 at least,
even when a fifth of the template is missing.  With 20 bands of one MinHash value each
a pair is missed with a probability of 0.62 to the power of 20, below 0.0001, at that
worst case.
Retrieved pairs are verified exactly: the share of the template's shingles that the
window holds must be 0.8 or more.

Only windows that can pass are hashed: per template a few anchor words are chosen so
that the shingles without any of them are fewer than the 0.8 rule lets be missing;
every true window therefore holds an anchor.

Everything is DataFrame work; the templates are a small fixed table.

Edge cases: a null or empty text, or one of fewer than five words, has no shingles
and no match; repeated rows give one result per doc_id; a null doc_id is a document
of its own; an empty table gives an empty result; further columns are not read.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

SHINGLE = 5
CONTAINED = 0.8
BANDS = 20

# Notices of widely used public licenses, as their texts give them.
TEMPLATES = {
    "MIT": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    "MIT-line": "Released under the MIT License.",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.",
    "Apache-2.0-line": "Licensed under the Apache License, Version 2.0.",
    "BSD-3-Clause": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
    "GPL-3.0-or-later": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "GPL-3.0-line": "This work is licensed under the GNU General Public License, version 3.",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-SA-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "CC-BY-4.0-line": "Licensed under CC BY 4.0.",
    "CC-BY-SA-4.0-line": "Licensed under CC BY-SA 4.0.",
    "CC-BY-NC-4.0-line": "Licensed under CC BY-NC 4.0.",
    "Unlicense": "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
}


def words_of(text: str) -> list[str]:
    return re.findall(r"[a-z0-9]+", text.lower())


def shingles_of(text: str) -> list[str]:
    """Distinct shingles in order."""
    w = words_of(text)
    return list(dict.fromkeys(" ".join(w[i:i + SHINGLE]) for i in range(len(w) - SHINGLE + 1)))


def size_class(shingles: int) -> int:
    """The class's size: 1 to 4 themselves, then twice, three times, four times ... a power of two."""
    for step in range(64):
        for size in ((1 << step), (1 << step) * 3 // 2):
            if size >= shingles:
                return size
    raise ValueError("template too long")


def stride(size: int) -> int:
    return max(1, size // 4)


def window(size: int) -> int:
    """Shingles of a window: wherever an occurrence of ``size`` shingles starts, one window holds it."""
    return size + stride(size) - 1


def needed(shingles: int) -> int:
    """Shingles that a window must hold for the containment."""
    return -(-shingles * 4 // 5)


def anchors(templates: dict[str, str]) -> list[str]:
    """Words of which every sufficient part of each template holds one.

    Greedily the words in most uncovered shingles, until fewer shingles are left than
    a match needs; long words first among equals, as they are rarer.
    """
    chosen: set[str] = set()
    for text in templates.values():
        own = [set(s.split()) for s in shingles_of(text)]
        while True:
            left = [s for s in own if not s & chosen]
            if len(left) < needed(len(own)):
                break
            count: dict[str, int] = {}
            for s in left:
                for w in s:
                    if len(w) > 3 or not any(len(x) > 3 for x in s):
                        count[w] = count.get(w, 0) + 1
            rare = {w: n for w, n in count.items() if w in RARE} or count
            chosen.add(max(rare, key=lambda w: (rare[w], len(w), w)))
    return sorted(chosen)


# Words that mark license texts and are rare elsewhere; anchors are taken from them where they do.
RARE = set("""license licensed licenses licensing sublicense copyright permission permitted redistribution
    redistributions software warranties disclaimer gnu mozilla apache creative commons unencumbered notwithstanding
    distributed distribution contributors cc""".split())


def _templates(spark: SparkSession, templates: dict[str, str]) -> DataFrame:
    """(license, n, size, hashes): the fixed template table."""
    rows = [(name, len(s), size_class(len(s)), s) for name, s in ((n, shingles_of(t)) for n, t in templates.items()) if s]
    return spark.createDataFrame(rows, "license string, n int, size int, shingles array<string>").select(
        "license", "n", "size", F.transform("shingles", lambda s: F.xxhash64(s)).alias("hashes"))


def _bands(hashes: Column) -> Column:
    """BANDS MinHash values, each marked with its number."""
    return F.transform(F.sequence(F.lit(1), F.lit(BANDS)),
                       lambda b: F.xxhash64(b, F.array_min(F.transform(hashes, lambda h: F.xxhash64(h, b)))))


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", templates: dict[str, str] = TEMPLATES) -> DataFrame:
    """Per document and license: the best containment and where its window starts (in shingles)."""
    spark = docs.sparkSession
    known = _templates(spark, templates)
    sizes = sorted({size_class(len(shingles_of(t))) for t in templates.values() if shingles_of(t)})
    anchor = anchors(templates)
    lower = F.lower(F.col(text))
    rows = (docs.select(F.col(doc_id).alias("doc_id"), lower.alias("t"))
            .where(F.col("t").rlike("(?:^|[^a-z0-9])(?:" + "|".join(anchor) + ")(?:[^a-z0-9]|$)"))
            .select("doc_id", F.split(F.trim(F.regexp_replace("t", "[^a-z0-9]+", " ")), " ").alias("w"))
            .where(F.size("w") >= SHINGLE))
    n = F.size("w") - (SHINGLE - 1)
    marks = F.array(*[F.lit(a) for a in anchor])
    places = F.filter(F.transform("w", lambda w, i: F.when(F.array_contains(marks, w), i).otherwise(-1)), lambda i: i >= 0)
    rows = rows.select("doc_id", "w", n.alias("n_shingles"), places.alias("places"))

    def starts(size: int) -> Column:
        """Windows of a size that hold an anchor: shingles start up to four words before it."""
        s, w = stride(size), window(size)
        last = F.greatest(F.floor((F.col("n_shingles") - 1) / s), F.lit(0)).cast("int")
        near = F.transform("places", lambda p: F.sequence(
            F.greatest(F.ceil((p - (SHINGLE - 1) - (w - 1)) / s), F.lit(0)).cast("int"),
            F.least(F.greatest(F.floor(p / s), F.lit(0)).cast("int"), last)))
        return F.transform(F.array_distinct(F.flatten(near)), lambda k: F.struct(
            F.lit(size).alias("size"), (k * s).alias("start"), F.lit(w).alias("length")))

    spans = rows.select("doc_id", "w", "n_shingles", F.explode(F.concat(*[starts(z) for z in sizes])).alias("s"))
    w = F.slice("w", F.col("s.start") + 1, F.least(F.col("s.length"), F.col("n_shingles") - F.col("s.start")) + (SHINGLE - 1))
    cut = spans.select("doc_id", F.col("s.size").alias("size"), F.col("s.start").alias("start"), w.alias("w"))
    hashed = cut.select("doc_id", "size", "start", F.transform(
        F.sequence(F.lit(1), F.size("w") - (SHINGLE - 1)),
        lambda i: F.xxhash64(F.array_join(F.slice("w", i, SHINGLE), " "))).alias("shingles"))
    banded = hashed.select("*", F.explode(_bands(F.col("shingles"))).alias("band"))
    # The template table is fixed and small (a row per template and band).
    index = F.broadcast(known.select("license", "n", "size", "hashes", F.explode(_bands(F.col("hashes"))).alias("band")))
    pairs = banded.join(index, ["size", "band"])
    share = F.size(F.array_intersect("hashes", "shingles")) / F.col("n")
    verified = pairs.select("doc_id", "license", "start", share.alias("containment")).where(F.col("containment") >= CONTAINED)
    # Best containment first, then the earliest window.
    best = F.max(F.struct("containment", (-F.col("start")).alias("back")))
    return (verified.groupBy("doc_id", "license").agg(best.alias("b"))
            .select("doc_id", "license", F.col("b.containment").alias("containment"),
                    (-F.col("b.back")).cast("long").alias("window_start")))


def oracle(templates: dict[str, str] = TEMPLATES) -> str:
    """Brute force in SQL: containment of every template in every window of its class."""
    rows = ", ".join("('%s', %d, %d, %d, %d, [%s])" % (
        name, len(s), size_class(len(s)), stride(size_class(len(s))), window(size_class(len(s))),
        ", ".join(f"'{x}'" for x in s)) for name, s in ((n, shingles_of(t)) for n, t in templates.items()) if s)
    return f"""
WITH t(license, n, size, stride, width, shingles) AS (VALUES {rows}),
ts AS (SELECT license, n, stride, width, unnest(shingles) AS shingle FROM t),
w AS (SELECT doc_id, string_split(trim(regexp_replace(lower(text), '[^a-z0-9]+', ' ', 'g')), ' ') AS w FROM documents),
p AS (SELECT doc_id, w, len(w) - 4 AS n_shingles, unnest(range(0, len(w) - 4)) AS i FROM w WHERE len(w) >= 5),
s AS (SELECT doc_id, n_shingles, i, array_to_string(w[i + 1 : i + 5], ' ') AS shingle FROM p),
h AS (SELECT DISTINCT s.doc_id, ts.license, ts.n, ts.stride, s.n_shingles, s.shingle,
             unnest(range(greatest(0, ceil((s.i - ts.width + 1) / ts.stride)::BIGINT), s.i // ts.stride + 1)) * ts.stride AS start
      FROM s JOIN ts USING (shingle)),
c AS (SELECT doc_id, license, start, count(*) / any_value(n) AS containment FROM h GROUP BY doc_id, license, start)
SELECT doc_id, license, max(containment) AS containment,
       min(start) FILTER (containment = best)::BIGINT AS window_start
FROM (SELECT *, max(containment) OVER (PARTITION BY doc_id, license) AS best FROM c WHERE containment >= 0.8)
GROUP BY doc_id, license
"""
