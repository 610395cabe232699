"""Licence notices in documents: MinHash bands over overlapping windows, then exact containment.

Only DataFrame functions. Templates are sets of five-word shingles. A template of t shingles is
looked for in windows of twice the next power of two, each half a window after the last, so an
occurrence lies whole in some window. The number of bands follows from the least similarity that
such a window can have to the template, for a chance of a miss below one in a million.
"""

from __future__ import annotations

import math
import random
import re

from pyspark.sql import Column, DataFrame, functions as F

from geotally.llm.common import empty_if_null

WIDTH, CONTAINED, MISS = 5, 0.8, 1e-6
TOKEN = r"[\p{L}\p{N}]+(?:[.\-][\p{L}\p{N}]+)*"

# fixed values: notices in the words of their licences
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."),
]


def tokens(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(TOKEN), F.lit(0))


def template_size(text: str) -> int:
    """Distinct shingles of a template; its text is plain enough for the same pattern here."""
    words = re.findall(r"[a-z0-9]+(?:[.\-][a-z0-9]+)*", text.lower())
    return len({tuple(words[i : i + WIDTH]) for i in range(len(words) - WIDTH + 1)})


def half_window(shingles: int) -> int:
    return 1 << max(0, (shingles - 1).bit_length())


def bands_needed(half: int, miss: float = MISS) -> int:
    """One-row bands by which a window of 2 * half finds any template of its class but with chance ``miss``."""
    sizes = range(half // 2 + 1, half + 1)
    least = min(math.ceil(CONTAINED * t) / (2 * half + t - math.ceil(CONTAINED * t)) for t in sizes)
    return math.ceil(math.log(miss) / math.log1p(-least))


def masks(n: int, seed: int = 5) -> list[int]:
    """Fixed random numbers; a hash exclusive-or one of them is a hash with an order of its own."""
    draw = random.Random(seed)
    return [draw.getrandbits(64) - (1 << 63) for _ in range(n)]


def _hashed(words: str) -> Column:
    gram = lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(WIDTH)])
    return F.when(F.size(words) >= WIDTH, F.transform(F.sequence(F.lit(0), F.size(words) - WIDTH), gram)).otherwise(F.array().cast("array<long>"))


def _bands(shingles: Column, count: int) -> Column:
    keys = F.array(*[F.lit(m) for m in masks(count)])
    return F.transform(keys, lambda m, b: F.xxhash64(b, F.array_min(F.transform(shingles, lambda h: h.bitwiseXOR(m)))))


def scan(docs: DataFrame, templates: list[tuple[str, str]] = TEMPLATES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document and template found in it: id, license, template, containment, start.

    ``containment`` is the share of the template's distinct shingles that one window has, at least 0.8;
    the best window counts, and of equals the first, which begins at word ``start``. Tokens are runs
    of letters and digits in lower case, joined by inner dots and hyphens. Texts and windows without any
    shingle of the templates cannot contain one and are passed over; all others go through the bands.
    What is broadcast are the templates' bands, which the list of templates bounds.

    Null and short texts have no shingles. A template of fewer than five words is an error. Repeated rows of
    an id are one document. Other columns are not read. An empty table gives no rows.
    """
    spark = docs.sparkSession
    sized = [(i, name, text, template_size(text)) for i, (name, text) in enumerate(templates)]
    if short := [text for _, _, text, n in sized if n == 0]:
        raise ValueError(f"templates need {WIDTH} words: {short}")
    known = spark.createDataFrame([(i, name, text, half_window(n)) for i, name, text, n in sized], "template int, license string, text string, half int")
    known = known.withColumn("words", tokens(F.col("text"))).withColumn("shingles", F.array_distinct(_hashed("words"))).drop("words", "text")
    every = [r["shingles"] for r in known.select("shingles").collect()]  # the list of templates, as numbers
    halves = {}
    for (_, _, _, n), own in zip(sized, every):
        halves.setdefault(half_window(n), set()).update(own)
    literal = lambda values: F.array(*[F.lit(v) for v in sorted(values)])

    rows = docs.select(F.col(id_col).alias("id"), tokens(empty_if_null(text_col)).alias("words"))
    # filtered inside explode: a filter after it would be pushed down, and the shingles built anew for each place
    hit = F.filter(F.array(_hashed("words")), lambda s: F.arrays_overlap(s, literal(set().union(*every))))
    rows = rows.select("id", F.explode(hit).alias("all_shingles"))
    cut = F.array(*[F.struct(F.lit(h).alias("half"), literal(own).alias("of_class")) for h, own in sorted(halves.items())])
    rows = rows.withColumn("class", F.explode(cut)).select("id", "all_shingles", "class.half", "class.of_class").filter(F.arrays_overlap("all_shingles", "of_class"))
    one = lambda start: F.struct(start.alias("start"), F.slice("all_shingles", start + 1, 2 * F.col("half")).alias("window"))
    starts = F.sequence(F.lit(0), F.size("all_shingles") - 1, F.col("half"))
    found = F.filter(F.transform(starts, one), lambda w: F.arrays_overlap(w["window"], F.col("of_class")))
    rows = rows.select("id", "half", F.explode(found).alias("w")).select("id", "half", "w.start", "w.window")
    counts = {h: bands_needed(h) for h in halves}

    def banded(df: DataFrame, shingles: str) -> DataFrame:
        bands = F.lit(None).cast("array<long>")
        for h, n in counts.items():
            bands = F.when(F.col("half") == h, _bands(F.col(shingles), n)).otherwise(bands)
        return df.withColumn("band", F.explode(F.array_distinct(bands)))

    index = F.broadcast(banded(known, "shingles").select("half", "band", "template", "license", "shingles"))
    candidates = banded(rows, "window").join(index, ["half", "band"])
    share = F.size(F.array_intersect("window", "shingles")) / F.size("shingles")
    hits = candidates.withColumn("containment", share).filter(F.col("containment") >= CONTAINED)
    best = F.min(F.struct((-F.col("containment")).alias("less"), "start"))
    hits = hits.groupBy("id", "license", "template").agg(best.alias("best"))
    return hits.select(F.col("id").alias(id_col), "license", "template", (-F.col("best")["less"]).alias("containment"), F.col("best")["start"].cast("long").alias("start"))


def oracle_sql(templates: list[tuple[str, str]] = TEMPLATES) -> str:
    """The same by shingles as text, without bands."""
    rows = []
    for i, (name, text) in enumerate(templates):
        words = re.findall(r"[a-z0-9]+(?:[.\-][a-z0-9]+)*", text.lower())
        grams = {" ".join(words[k : k + WIDTH]) for k in range(len(words) - WIDTH + 1)}
        rows += [f"({i}, '{name}', {half_window(len(grams))}, {len(grams)}, '{g}')" for g in sorted(grams)]
    return rf"""
    with template(template, license, half, size, gram) as (values {", ".join(rows)}),
    words as (select doc_id, regexp_extract_all(lower(coalesce(text, '')), '{TOKEN}') as w from documents),
    grams as (select doc_id, unnest(range(len(w) - {WIDTH - 1})) as place, unnest(list_transform(range(len(w) - {WIDTH - 1}), lambda i: array_to_string(w[i + 1:i + {WIDTH}], ' '))) as gram from words where len(w) >= {WIDTH}),
    found as (select doc_id, template, license, half, size, gram, place from grams join template using (gram)),
    windows as (
        select doc_id, template, license, size, gram, place - place % half as start from found
        union all select doc_id, template, license, size, gram, place - place % half - half from found where place >= half),
    shares as (select doc_id, license, template, start, count(distinct gram) / any_value(size) as containment from windows group by doc_id, license, template, start)
    select doc_id, license, template, max(containment) as containment, min(start) filter (containment = best) as start
    from (select *, max(containment) over (partition by doc_id, template) as best from shares) where best >= {CONTAINED}
    group by doc_id, license, template"""
