"""License notices in texts: MinHash bands of overlapping windows, then exact shingle containment.

Texts and templates are lower-cased (A-Z) and cut into words of letters and digits, words into
shingles of five, and shingles into windows of two that start at every shingle. A window's key in a
band is the smallest of its shingles' hashes in that band. A window that lies in an occurrence of a
template equals a window of that template and shares all its keys; an occurrence of a single shingle
misses a band only if both its neighbours in the text have smaller hashes, one time in three, so it
misses all ten bands one time in 59,049. The shingles of retrieved windows are compared with those of the
templates, and a region opens at every one that a template has; so where a notice stands does not matter, and
words may be put into it. A template of fewer than five words is one shingle, whose window has one
hash and needs one band.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortflow.llm.common import quoted
from cohortflow.llm.scaled_sketch import let

SHINGLE_WORDS = 5
WINDOW_SHINGLES = 2
BANDS = 10
LEAST_CONTAINMENT = 0.8
#: A region of ``notices`` has so many shingles for each of the template's: words put into a notice may
#: be twice its length.
REGION_WIDTH = 3

# Public license notices.
TEMPLATES = {
    "apache-2.0-line": "Licensed under the Apache License, Version 2.0.",
    "apache-2.0-header": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in '
        "compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0"
    ),
    "bsd-redistribution": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met"
    ),
    "cc-by-nc-4.0-line": "Licensed under CC BY-NC 4.0.",
    "gpl-3.0-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
        "General Public License as published by the Free Software Foundation, either version 3 of the License, or "
        "(at your option) any later version."
    ),
    "gpl-3.0-line": "This work is licensed under the GNU General Public License, version 3.",
    "mit-line": "Released under the MIT License.",
    "mit-permission": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        'associated documentation files (the "Software"), to deal in the Software without restriction'
    ),
    "mpl-2.0-header": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL "
        "was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."
    ),
}
#: With notices of fewer than five words.
NOTICES = {
    **TEMPLATES,
    "all-rights-reserved": "All rights reserved.",
    "spdx-apache-2.0": "SPDX-License-Identifier: Apache-2.0",
    "spdx-gpl-3.0": "SPDX-License-Identifier: GPL-3.0",
    "spdx-mit": "SPDX-License-Identifier: MIT",
}
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words(text: Column) -> Column:
    lower = F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER)
    return F.filter(F.split(lower, "[^a-z0-9]+"), lambda w: w != "")


def _starts(n: Column) -> Column:
    return F.coalesce(F.when(n > 0, F.sequence(F.lit(0), n - 1)), F.array().cast("array<int>"))


def shingles(of: Column, length: int = SHINGLE_WORDS) -> Column:
    """Word shingles of an array of words as strings, none for fewer than ``length`` words."""
    return let(
        of,
        lambda w: F.transform(
            _starts(F.size(w) - (length - 1)),
            lambda i: F.concat_ws(" ", *[F.get(w, i + k) for k in range(length)]),
        ),
    )


def shingle_hashes(of: Column) -> Column:
    return let(
        F.transform(of, lambda w: F.xxhash64(w)),
        lambda h: F.transform(
            _starts(F.size(h) - (SHINGLE_WORDS - 1)),
            lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(SHINGLE_WORDS)]),
        ),
    )


def band_key(hashes: Column, at: Column, band: int) -> Column:
    """The key of the window that starts at a shingle; the last window is shorter."""
    own = [F.get(hashes, at + k) for k in range(WINDOW_SHINGLES)]
    return F.least(*[F.when(h.isNotNull(), F.xxhash64(h, F.lit(band))) for h in own])


def _band_keys(named: DataFrame, bands: int) -> list[list[int]]:
    """The keys of all windows of all templates, in each band."""
    keyed = named.withColumn("hashes", shingle_hashes(words(F.col("text"))))

    def band(b: int) -> Column:
        return F.transform(_starts(F.size("hashes")), lambda i: band_key(F.col("hashes"), i, b))

    rows = keyed.select(F.array(*[band(b) for b in range(bands)]).alias("keys")).collect()  # a row per template
    return [sorted({key for row in rows for key in row["keys"][b]}) for b in range(bands)]


def scan(
    docs: DataFrame, templates: dict[str, str] = NOTICES, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """A row per row of ``docs`` and template it holds: the id, ``template``, ``containment`` (the largest
    part of the template's shingles found in one region, at least 0.8) and ``regions``.

    A region opens at any shingle of a retrieved window that the template has and is ``REGION_WIDTH`` times as long as
    the template; ``regions`` counts those with containment of at least 0.8 that overlap no earlier one with
    so much. Null, empty and short texts hold nothing, texts of any length are read whole, a null id stays
    null, repeated rows each give theirs, an empty table gives an empty one. Other columns are not read, whatever
    their names. No row is shuffled: the templates' keys are literals of the plan.
    """
    return _found(docs, templates, id_col, text_col, BANDS)


def notices(
    docs: DataFrame, templates: dict[str, str] = NOTICES, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """What ``scan`` gives, with retrieval by single exact shingles in place of the bands."""
    return _found(docs, templates, id_col, text_col, 0)


def _found(docs: DataFrame, templates: dict[str, str], id_col: str, text_col: str, bands: int) -> DataFrame:
    named = docs.sparkSession.createDataFrame(sorted(templates.items()), "name string, text string")
    split = {r["name"]: r["w"] for r in named.select("name", words(F.col("text")).alias("w")).collect()}
    bare = sorted(name for name, w in split.items() if not w)
    if bare:
        raise ValueError(f"templates without words: {bare}")
    length = {name: min(SHINGLE_WORDS, len(w)) for name, w in split.items()}
    wanted = {
        name: sorted({" ".join(w[i : i + length[name]]) for i in range(len(w) - length[name] + 1)})
        for name, w in split.items()
    }
    every = {k: sorted({s for name in wanted if length[name] == k for s in wanted[name]}) for k in set(length.values())}

    def hashed(h: Column, at: Column, k: int) -> Column:
        return F.xxhash64(*[F.get(h, at + j) for j in range(k)])

    def hashes(of: Column) -> Column:
        return F.transform(of, lambda w: F.xxhash64(w))

    listed = docs.sparkSession.createDataFrame([(k, s) for k in every for s in every[k]], "k int, s string")
    listed = listed.withColumn("h", hashes(F.split("s", " ")))
    keys: dict[int, list[int]] = {k: [] for k in every}
    for k in every:
        keys[k] = [r[0] for r in listed.where(F.col("k") == k).select(hashed(F.col("h"), F.lit(0), k)).collect()]

    long = {name: t for name, t in templates.items() if length[name] == SHINGLE_WORDS}
    banded = _band_keys(named.where(F.col("name").isin(sorted(long))), bands) if bands and long else []

    def windowed(h: Column) -> Column:
        """The places of the shingles of retrieved windows."""
        whole = F.transform(_starts(F.size(h) - (SHINGLE_WORDS - 1)), lambda i: hashed(h, i, SHINGLE_WORDS))

        def retrieved(by_band: Column) -> Column:
            # Every shingle is hashed once for each band; a window takes the least of its own.
            def least(i: Column, b: int) -> Column:
                return F.least(*[F.get(F.get(by_band, F.lit(b)), i + j) for j in range(WINDOW_SHINGLES)])

            n = F.size(F.get(by_band, F.lit(0)))
            own = lambda i: reduce(Column.__or__, [least(i, b).isin(k) for b, k in enumerate(banded)])
            every = F.flatten(F.transform(F.filter(_starts(n), own), lambda i: F.sequence(i, i + (WINDOW_SHINGLES - 1))))
            return F.filter(F.array_distinct(every), lambda i: i < n)

        def by_bands(sh: Column) -> Column:
            return F.array(*[in_band(sh, b) for b in range(len(banded))])

        def in_band(sh: Column, band: int) -> Column:
            return F.transform(sh, lambda s: F.xxhash64(s, F.lit(band)))

        return let(let(whole, by_bands), retrieved)

    def places(h: Column) -> Column:
        """For each length of shingles, the places of those that some template has, or may have."""

        def of(k: int) -> Column:
            if banded and k == SHINGLE_WORDS:
                return windowed(h).alias(f"of_{k}")
            return F.filter(_starts(F.size(h) - (k - 1)), lambda i: hashed(h, i, k).isin(keys[k])).alias(f"of_{k}")

        return F.struct(*map(of, sorted(every)))

    def by_template(found: Column) -> Column:
        def hits(k: int) -> Column:
            def hit(i: Column) -> Column:
                return F.struct(i.alias("at"), F.concat_ws(" ", *[F.get("words", i + j) for j in range(k)]).alias("s"))

            return F.transform(found[f"of_{k}"], hit)

        def own(name: str) -> Column:
            shingle = F.array(*map(F.lit, wanted[name]))
            mine = F.filter(hits(length[name]), lambda x: F.array_contains(shingle, x["s"]))
            return F.struct(F.lit(name).alias("template"), F.lit(len(wanted[name])).alias("n"), mine.alias("hits"))

        return F.filter(F.array(*map(own, sorted(wanted))), lambda t: F.size(t["hits"]) >= LEAST_CONTAINMENT * t["n"])

    some = reduce(Column.__or__, [F.size(F.col("places")[f"of_{k}"]) > 0 for k in every])
    rows = docs.select(F.col(quoted(id_col)).alias("doc_id"), words(F.col(quoted(text_col))).alias("words"))
    rows = rows.select("doc_id", "words", let(hashes(F.col("words")), places).alias("places"))
    # An outer generator takes no inferred filter, which would work every text out twice.
    pairs = rows.select("doc_id", F.explode_outer(F.when(some, by_template(F.col("places")))).alias("found"))
    pairs = pairs.where(F.col("found").isNotNull()).select("doc_id", "found.*")
    width = F.col("n") * REGION_WIDTH

    def region(hit: Column, k: Column) -> Column:
        inside = F.filter(F.slice("hits", k + 1, width), lambda x: x["at"] < hit["at"] + width)
        return F.struct(hit["at"].alias("at"), (F.size(F.array_distinct(F.transform(inside, lambda x: x["s"]))) / F.col("n")).alias("part"))

    pairs = pairs.select("doc_id", "template", "n", F.transform("hits", region).alias("all"))
    pairs = pairs.withColumn("enough", F.filter("all", lambda r: r["part"] >= LEAST_CONTAINMENT))

    def opens(r: Column, k: Column) -> Column:
        before = F.get(F.col("enough"), k - 1)["at"]
        return before.isNull() | (r["at"] - before >= width)

    return pairs.where(F.size("enough") > 0).select(
        F.col("doc_id").alias(id_col),
        "template",
        F.array_max(F.transform("enough", lambda r: r["part"])).alias("containment"),
        F.size(F.filter("enough", opens)).cast("long").alias("regions"),
    )


def notices_sql(templates: dict[str, str] = NOTICES) -> str:
    """``notices`` without retrieval, in DuckDB's SQL over ``documents``: from every shingle of every text."""
    listed = ", ".join(f"('{n}', '{t.replace(chr(39), chr(39) * 2)}')" for n, t in sorted(templates.items()))
    split = "regexp_extract_all(translate(coalesce(text, ''), '" + _UPPER + "', '" + _LOWER + "'), '[a-z0-9]+')"
    cut = "[array_to_string(w[i:i + k - 1], ' ') for i in range(1, len(w) - k + 2)]"
    return f"""
WITH named(name, text) AS (VALUES {listed}),
templates AS (
  SELECT name, k, list_distinct({cut}) AS wanted
  FROM (SELECT name, w, least({SHINGLE_WORDS}, len(w)) AS k FROM (SELECT name, {split} AS w FROM named))),
lengths AS (SELECT DISTINCT k FROM templates),
texts AS (SELECT doc_id, k, {cut} AS shingles FROM (SELECT doc_id, {split} AS w FROM documents), lengths),
opened AS (
  SELECT doc_id, name, wanted, shingles, {REGION_WIDTH} * len(wanted) AS width,
         [i for i in range(1, len(shingles) + 1) if list_contains(wanted, shingles[i])] AS starts
  FROM texts JOIN templates USING (k)),
compared AS (
  SELECT doc_id, name AS template, width, starts,
         [len(list_intersect(shingles[i:i + width - 1], wanted)) / len(wanted) for i in starts] AS parts
  FROM opened WHERE len(starts) > 0),
kept AS (
  SELECT doc_id, template, width, parts, [starts[j] for j in range(1, len(starts) + 1) if parts[j] >= {LEAST_CONTAINMENT}] AS enough
  FROM compared)
SELECT doc_id, template, CAST(list_max(parts) AS DOUBLE) AS containment,
       CAST(len([j for j in range(1, len(enough) + 1) if j = 1 OR enough[j] - enough[j - 1] >= width]) AS BIGINT) AS regions
FROM kept WHERE len(enough) > 0
"""
