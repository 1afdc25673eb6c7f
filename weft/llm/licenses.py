"""License scan: MinHash bands over overlapping text windows, verified by exact shingle containment.

Templates are short license notices. Texts and templates become runs of ``SHINGLE`` words (all words of a shorter
template), lower-cased. Templates are dealt by length into classes; for a class of templates of at most L words, a text
is cut into windows of 2 L words at every L words, so each run of L words lies whole in some window. Windows keep only
shingles that occur in templates of the class: others can't add to what they share with one, and windows without any are
skipped. Each window and template is sketched by bands of one minimum hash; where a band agrees, the share of the
template's shingles that the window holds is counted exactly, and ``containment`` or more of it is a match. The number of
bands is such that a match is missed with a chance of ``MISS`` at most, however full of other notices its window is: it
holds 2 L shingles at most, and no more than the class has, so its Jaccard similarity to a template of n shingles is at
least ``containment`` * n / (that number + (1 - ``containment``) * n).

Everything is made of SQL expressions, so it runs in the JVM. The templates are a fixed list, broadcast as literals.

Defined results: null and empty texts match nothing; a text gives one row for each template that it matches, with the
best containment and the first window that reaches it; rows that repeat id and text are one; null ids are kept apart
from others by their text; other columns are not read.
"""

from __future__ import annotations

import math
import re
from collections import defaultdict

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Words of a shingle, and the greatest chance of missing a match.
SHINGLE, MISS = 5, 1e-6
_GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

# Notices as they stand at the head of files or in a last line.
TEMPLATES: dict[str, str] = {
    "MIT-line": "Released under the MIT License.",
    "MIT-licensed": "This project is licensed under the MIT License.",
    "Apache-2.0-line": "Licensed under the Apache License, Version 2.0.",
    "GPL-3.0-line": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-2.0-line": "This work is licensed under the GNU General Public License, version 2.",
    "LGPL-line": "This work is licensed under the GNU Lesser General Public License.",
    "AGPL-3.0-line": "This work is licensed under the GNU Affero General Public License, version 3.",
    "CC-BY-NC-4.0-line": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0-line": "Licensed under CC BY 4.0.",
    "CC-BY-SA-4.0-line": "Licensed under CC BY-SA 4.0.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-NC-4.0": "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    "CC-BY-SA-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "CC0-1.0": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    "Unlicense": "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "BSD-2-Clause": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0. Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
    "MIT": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions.",
    "GPL-3.0": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "reserved-line": "All rights reserved.",
    "reserved": "Copyright. All rights reserved. No part of this publication may be reproduced, distributed, or transmitted in any form or by any means.",
}


def template_words(text: str) -> list[str]:
    return re.findall(_WORD, re.sub("[A-Z]", lambda m: m[0].lower(), text))


def template_rows(templates: dict[str, str]) -> list[tuple[str, int, int, list[str]]]:
    """``(name, class, shingle size, shingles)`` of each template, shingles joined by spaces; the class is the least
    power of two, 8 at least, that its number of words doesn't exceed."""
    out = []
    for name, text in sorted(templates.items()):
        words = template_words(text)
        if words:
            size = min(SHINGLE, len(words))
            shingles = list(dict.fromkeys(" ".join(words[k : k + size]) for k in range(len(words) - size + 1)))
            out.append((name, max(8, 1 << (len(words) - 1).bit_length()), size, shingles))
    return out


def _known_shingles(size: int, known: list[str]) -> Column:
    """Places and words of the shingles of ``w`` that are in ``known``. Only shingles around the longest word of one of
    them are put together. The column goes to ``inline_outer``, as a filter on it would have it computed twice."""
    anchors = sorted({max(s.split(" "), key=lambda w: (len(w), w)) for s in known})
    spots = F.array_compact(F.transform("w", lambda w, k: F.when(w.isin(anchors), k)))
    starts = F.transform(spots, lambda k: F.sequence(F.greatest(k - (size - 1), F.lit(0)), k))
    shingles = F.transform(F.array_distinct(F.flatten(starts)), lambda k: F.struct(k.alias("k"), F.array_join(F.slice("w", k + 1, size), " ").alias("s")))
    return F.filter(shingles, lambda x: x["s"].isin(known))


def bands_for(rows: list[tuple[str, int, int, list[str]]], containment: float) -> int:
    """The number of bands that misses no match of these templates with a chance above ``MISS``."""
    held = defaultdict(set)
    for _, length, size, found in rows:
        held[length, size] |= set(found)
    least = min(math.ceil(containment * len(x)) / (min(2 * length, len(held[length, size])) + len(x) - math.ceil(containment * len(x))) for _, length, size, x in rows)
    return 1 if least >= 1 else max(1, math.ceil(math.log(MISS) / math.log(1 - least)))


def _bands(hashes: Column, bands: int) -> Column:
    """The band hashes of a set of shingle hashes, each with the band's number."""
    least = lambda k: F.array_min(F.transform(hashes, lambda h: F.xxhash64(h, F.lit(k))))
    return F.array(*(F.xxhash64(F.lit(b), least(b)) for b in range(bands)))


def scan(docs: DataFrame, templates: dict[str, str] | None = None, containment: float = 0.8) -> DataFrame:
    """``(doc_id, template, containment, window, n_shared)`` of each matching text and template; ``window`` is the
    number of the first best window's first word."""
    spark = docs.sparkSession
    rows = template_rows(TEMPLATES if templates is None else templates)
    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    text = docs.select("doc_id", F.expr(lower).alias("t"), F.xxhash64("text").alias("h"))
    words = text.select("doc_id", "h", F.filter(F.split("t", _GAP, -1), lambda w: w != "").alias("w"))
    by_size = defaultdict(set)
    for _, _, size, shingles in rows:
        by_size[size] |= set(shingles)
    hits = None
    for size, found in sorted(by_size.items()):
        part = words.select("doc_id", "h", F.lit(size).alias("size"), F.inline_outer(_known_shingles(size, sorted(found)))).filter(F.col("s").isNotNull())
        hits = part if hits is None else hits.unionByName(part)
    if hits is None:
        return docs.select("doc_id").limit(0).selectExpr("doc_id", "'' template", "0D containment", "0L window", "0L n_shared")

    bands = bands_for(rows, containment)
    flat = [(name, length, size, s) for name, length, size, found in rows for s in found]
    shingles = spark.createDataFrame(flat, "template string, length int, size int, s string")
    classes = shingles.select("length", "size", "s").distinct()
    placed = hits.join(F.broadcast(classes), ["size", "s"]).select("doc_id", "h", "size", "length", "s", F.floor(F.col("k") / F.col("length")).alias("j"))
    windows = placed.select("doc_id", "h", "size", "length", "s", F.explode(F.when(F.col("j") > 0, F.array(F.col("j") - 1, "j")).otherwise(F.array("j"))).alias("j")).distinct()
    # few bytes, but much work: dealt to as many tasks as a shuffle has, which adaptive execution doesn't merge
    dealt = windows.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "doc_id", "h")
    sets = dealt.groupBy("doc_id", "h", "size", "length", "j").agg(F.collect_set("s").alias("found"))
    banded = sets.withColumn("band", F.explode(_bands(F.transform("found", lambda s: F.xxhash64(s)), bands)))
    library = shingles.groupBy("template", "length", "size").agg(F.collect_set("s").alias("wanted"))
    library = library.withColumn("band", F.explode(_bands(F.transform("wanted", lambda s: F.xxhash64(s)), bands)))
    pairs = banded.join(F.broadcast(library), ["length", "size", "band"])
    shared = F.size(F.array_intersect("found", "wanted"))
    checked = pairs.select("doc_id", "h", "template", (F.col("j") * F.col("length")).alias("window"), shared.cast("long").alias("n_shared"), (shared / F.size("wanted")).alias("containment"))
    best = Window.partitionBy("doc_id", "h", "template").orderBy(F.desc("containment"), "window")
    kept = checked.filter(F.col("containment") >= containment).withColumn("r", F.row_number().over(best)).filter("r = 1")
    return kept.select("doc_id", "template", F.round("containment", 6).alias("containment"), F.col("window").cast("long").alias("window"), "n_shared")


def oracle_sql() -> str:
    """The same result in DuckDB by exact containment of every window, without bands."""
    quote = lambda s: "'" + s.replace("'", "''") + "'"
    values = ", ".join(f"({quote(n)}, {length}, {size}, {quote(s)})" for n, length, size, found in template_rows(TEMPLATES) for s in found)
    return f"""
with t(template, length, size, s) as (values {values}),
total as (select template, count(*) as n from t group by template),
d as (
  select distinct doc_id, text, list_filter(string_split_regex(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda w: w <> '') as w
  from documents where text is not null
), p as (select doc_id, text, w, unnest(range(0, len(w)::bigint)) as k from d),
h as (
  select distinct p.doc_id, p.text, t.template, t.length, t.s, k // t.length as j
  from p join (select distinct size from t) z on p.k + z.size <= len(p.w)
  join t on t.size = z.size and t.s = array_to_string(p.w[p.k + 1 : p.k + z.size], ' ')
), x as (
  select doc_id, text, template, length, s, j from h union select doc_id, text, template, length, s, j - 1 from h where j > 0
), c as (select doc_id, text, template, j * length as win, count(*) as n_shared from x group by doc_id, text, template, length, j),
b as (
  select c.*, n_shared / n::double as containment, row_number() over (partition by doc_id, text, template order by n_shared desc, win) as r
  from c join total using (template) where n_shared / n::double >= 0.8
)
select doc_id, template, round(containment, 6) as containment, win::bigint as "window", n_shared from b where r = 1"""
