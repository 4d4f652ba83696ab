"""License scans with DataFrame functions only.

Words are runs of ASCII letters and digits, in lower case; shingles are five words. Every
template has a window size a little above its length (sizes grow by a quarter, so few
exist), and windows of each size start every ``step`` words, such that any stretch as long
as the template lies wholly inside one of them. A window's MinHash signature is cut into
bands; a window and a template of its size that agree in a band are a candidate pair, found
by an equi-join with the template table (a fixed list in this package, hence broadcast).
Of each candidate the share of the template's distinct shingles that the window has is
computed exactly, and the pair is a match at ``THRESHOLD`` or more.

``BANDS`` bands of ``ROWS`` rows find a pair at the threshold with the probability that
``collision_probability`` states (0.99 or more for every template). Windows without a pivot
word are left out first, without loss: the pivots are chosen such that more than
``1 - THRESHOLD`` of every template's shingles have one, so no match can do without.

Defined results:

* null or empty text, fewer than five words: no license;
* several matches of one license: the one of the highest share, then the first, is reported;
* overlapping matches of one family (``FAMILIES``): those of a lower share than another are
  left out; a match reaches from the first to the last word of the shingles it shares, and
  licenses of different families never displace each other;
* repeated rows and ids: one result row per input row; null doc_id is passed on;
* empty table: empty result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import re
from collections import Counter
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zonepulse.llm.common import read_table

SHINGLE = 5
THRESHOLD = 0.8
BANDS = 10
ROWS = 1

#: License notices and texts.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0",
    "Apache-2.0-header": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance "
        "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless "
        "required by applicable law or agreed to in writing, software distributed under the License is distributed on an "
        "\"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the "
        "specific language governing permissions and limitations under the License."),
    "BSD-3-Clause": "Licensed under the BSD 3-Clause License",
    "BSD-3-Clause-text": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met: Redistributions of source code must retain the above copyright notice, this list of "
        "conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, "
        "this list of conditions and the following disclaimer in the documentation and/or other materials provided with the "
        "distribution. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or "
        "promote products derived from this software without specific prior written permission."),
    "CC-BY-4.0": "Licensed under CC BY 4.0",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0",
    "CC-BY-4.0-notice": "This work is licensed under a Creative Commons Attribution 4.0 International License",
    "CC-BY-SA-4.0-notice": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3",
    "GPL-3.0-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any "
        "later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without "
        "even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public "
        "License for more details. You should have received a copy of the GNU General Public License along with this program."),
    "ISC-text": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies."),
    "MIT": "Released under the MIT License",
    "MIT-notice": "Licensed under the MIT License",
    "MIT-text": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
        "permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright "
        "notice and this permission notice shall be included in all copies or substantial portions of the Software."),
    "MPL-2.0-header": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
        "distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    "Unlicense-text": (
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, "
        "use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any "
        "purpose, commercial or non-commercial, and by any means."),
}


#: Licenses that are variants of each other; any other is a family of its own.
FAMILIES = {
    "Apache": ("Apache-2.0", "Apache-2.0-header"),
    "BSD": ("BSD-3-Clause", "BSD-3-Clause-text"),
    "CC": ("CC-BY-4.0", "CC-BY-NC-4.0", "CC-BY-SA-4.0", "CC-BY-4.0-notice", "CC-BY-SA-4.0-notice"),
    "GPL": ("GPL-2.0", "GPL-3.0", "GPL-3.0-header"),
    "MIT": ("MIT", "MIT-notice", "MIT-text"),
}

#: Words too common to be pivots.
COMMON = frozenset("a all an and any are as at be by can copy either for form free from general has have in is it its list "
                   "may name names not of on one or other person public see shall should that the this to under use used "
                   "useful version was will with without work works you your following general written more details even "
                   "along later option hope terms included include source means".split())


def family(name: str) -> str:
    return next((f for f, names in FAMILIES.items() if name in names), name)


def template_words(text: str) -> list[str]:
    return [w.lower() for w in re.findall("[A-Za-z0-9]+", text)]


def window_of(length: int) -> tuple[int, int]:
    """(window, step) in words for templates of ``length`` words; sizes grow by a quarter."""
    size = SHINGLE
    while size < length:
        size = max(size + 1, size * 5 // 4)
    step = max(1, size // 5)
    return size + step - 1, step


def collision_probability(length: int, threshold: float = THRESHOLD) -> float:
    """Probability that a window holding ``threshold`` of a template's shingles shares a band with it."""
    own, window = length - SHINGLE + 1, window_of(length)[0] - SHINGLE + 1
    common = -int(-own * threshold // 1)
    similar = common / (own + window - common)
    return 1 - (1 - similar ** ROWS) ** BANDS


@lru_cache(maxsize=1)
def pivots() -> tuple[str, ...]:
    """Words such that more than ``1 - THRESHOLD`` of every template's shingles have one of them."""
    left = {}
    for name, text in TEMPLATES.items():
        w = template_words(text)
        left[name] = {tuple(w[i:i + SHINGLE]) for i in range(len(w) - SHINGLE + 1)}
    need = {n: (1 - THRESHOLD) * len(s) for n, s in left.items()}
    covered, chosen = Counter(), []
    while open_ := [n for n in left if covered[n] <= need[n]]:
        gain = Counter(w for n in open_ for s in left[n] for w in set(s) - COMMON if len(w) > 4)
        word = max(gain, key=lambda w: (gain[w], w))
        chosen.append(word)
        for n in left:
            hit = {s for s in left[n] if word in s}
            covered[n] += len(hit)
            left[n] -= hit
    return tuple(chosen)


def _min_hashes(shingles: str) -> str:
    """SQL: array of band keys of an array of shingle hashes."""
    least = f"array_min(transform({shingles}, h -> xxhash64(h, cast(b * {ROWS} + {{r}} AS bigint))))"
    rows = ", ".join(least.replace("{r}", str(r)) for r in range(ROWS))
    return f"transform(sequence(0, {BANDS - 1}), b -> xxhash64(b, {rows}))"


_HASHES = (f"CASE WHEN size(_words) >= {SHINGLE} THEN transform(sequence(1, size(_words) - {SHINGLE - 1}), "
           f"i -> xxhash64(array_join(slice(_words, i, {SHINGLE}), ' '))) ELSE cast(array() AS array<bigint>) END")


def template_table(spark: SparkSession) -> DataFrame:
    """(license, family, window, template, band, key): a row per template and band."""
    rows = [(n, family(n), window_of(len(template_words(t)))[0], template_words(t)) for n, t in TEMPLATES.items()]
    table = spark.createDataFrame(rows, "license string, family string, window int, _words array<string>")
    table = table.select("license", "family", "window", F.expr(f"array_distinct({_HASHES})").alias("template"))
    return table.select("license", "family", "window", "template", F.posexplode(F.expr(_min_hashes("template"))).alias("band", "key"))


def license_matches(docs: DataFrame) -> DataFrame:
    """(doc_id, text_key, license, share, first_word): the best match of each license in a text."""
    words = r"transform(regexp_extract_all(text, r'[A-Za-z0-9]+', 0), w -> lower(w))"
    chosen = ", ".join(f"'{p}'" for p in pivots())
    sizes = sorted({window_of(len(template_words(t))) for t in TEMPLATES.values()})
    some = docs.select("doc_id", "text").where(F.rlike("text", F.lit("(?i)" + "|".join(pivots()))))
    # one-row generators keep each array computed once
    some = some.select("doc_id", F.xxhash64("text").alias("text_key"), F.inline(F.expr(
        f"array(named_struct('_words', {words}))")))
    some = some.select("doc_id", "text_key", F.inline(F.expr(
        f"array(named_struct('_hashes', {_HASHES}, '_pivots', filter(transform(_words, (w, i) -> "
        f"CASE WHEN array_contains(array({chosen}), w) THEN i ELSE -1 END), i -> i >= 0)))"))).where(
        "size(_pivots) > 0 AND size(_hashes) > 0")
    some = some.select("doc_id", "text_key", "_hashes", "_pivots", F.inline(F.expr(
        "array(" + ", ".join(f"named_struct('window', {w}, 'step', {s})" for w, s in sizes) + ")")))
    starts = ("filter(array_distinct(flatten(transform(_pivots, p -> sequence("
              "greatest(0, cast(ceil((p - window + 1) / step) AS int)), p div step)))), k -> k * step < size(_hashes))")
    windows = some.select("doc_id", "text_key", "window", F.inline(F.expr(
        f"transform({starts}, k -> named_struct('first_word', k * step, 'shingles', "
        f"slice(_hashes, cast(k * step + 1 AS int), window - {SHINGLE - 1})))")))
    banded = windows.select("*", F.posexplode(F.expr(_min_hashes("shingles"))).alias("band", "key"))
    pairs = banded.join(F.broadcast(template_table(docs.sparkSession)), ["window", "band", "key"])
    shared = pairs.withColumn("share", F.expr("size(array_intersect(template, shingles)) / size(template)"))
    # the words from the first to the last shared shingle
    places = "filter(transform(shingles, (h, i) -> CASE WHEN array_contains(template, h) THEN i ELSE -1 END), i -> i >= 0)"
    shared = shared.where(F.col("share") >= THRESHOLD).select("*", F.inline(F.expr(f"array(named_struct('_places', {places}))")))
    shared = shared.withColumn("s", F.expr("first_word + array_min(_places)")).withColumn(
        "e", F.expr(f"first_word + array_max(_places) + {SHINGLE}"))
    best = F.max(F.struct("share", (-F.col("first_word")).alias("at"), "s", "e", "family"))
    each = (shared.groupBy("doc_id", "text_key", "license").agg(best.alias("b"))
            .groupBy("doc_id", "text_key").agg(F.collect_list(F.struct(
                "license", "b.share", (-F.col("b.at")).cast("long").alias("first_word"), "b.s", "b.e", "b.family")).alias("m")))
    # at most one entry per template: of a family's overlapping matches those that another one beats are its variants
    beaten = "exists(m, y -> y.family = x.family AND y.share > x.share AND y.s < x.e AND x.s < y.e)"
    return each.select("doc_id", "text_key", F.inline(F.expr(
        f"transform(filter(m, x -> NOT {beaten}), x -> named_struct('license', x.license, 'share', x.share, 'first_word', x.first_word))")))


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licenses of all documents: ids in order, number, highest share, and id:share:first word of each."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    shown = F.concat_ws(":", "license", F.round("share", 4).cast("string"), F.col("first_word").cast("string"))
    found = license_matches(docs).groupBy("doc_id", "text_key").agg(
        F.array_sort(F.collect_list("license")).alias("names"), F.max("share").alias("best"),
        F.array_sort(F.collect_list(shown)).alias("spans"))
    of = found.select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key"), "names", "best", "spans")
    rows = docs.select("doc_id", F.xxhash64("text").alias("text_key"))
    both = rows.join(of, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_key") == F.col("_key")), "left")
    return both.select("doc_id", F.coalesce(F.size("names"), F.lit(0)).cast("long").alias("n_licenses"),
                       F.coalesce(F.array_join("names", ","), F.lit("")).alias("licenses"),
                       F.coalesce("best", F.lit(0.0)).alias("best_share"),
                       F.coalesce(F.array_join("spans", ","), F.lit("")).alias("spans"))
