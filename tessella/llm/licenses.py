"""License scans: MinHash bands over text windows bring up templates, shingle containment decides; DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

WIDTH, CONTAINED = 5, 0.75
#: A window's length in shingles, by the length of the templates that it serves; windows start at every half of it. Minima
#: are taken over blocks first, of which windows are made.
SCALES, BLOCK = ((1, 1), (6, 9), (24, 36)), 3
#: Bands of one MinHash each: a window and a template's window of Jaccard similarity j share a band with 1 - (1 - j)^4,
#: which is 99.6 % at 0.75.
BANDS = 4
#: Templates are a parameter; their index is part of the plan, so their number is bounded.
MOST_SHINGLES = 20_000
#: Notices and opening clauses of common licenses.
TEMPLATES = {
    "apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "apache-2.0-header": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0. Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.",
    "bsd-conditions": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
    "cc-by-4.0": "Licensed under CC BY 4.0.",
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0.",
    "cc-by-sa-4.0": "Licensed under CC BY-SA 4.0.",
    "cc-by-4.0-notice": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "cc-by-sa-4.0-notice": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "gpl-2.0-or-later": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
    "gpl-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-3.0-or-later": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "isc": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "mit": "Released under the MIT License.",
    "mit-permission": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
    "mpl-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    "unlicense": "This is free and unencumbered software released into the public domain.",
}


def _words(text: Column) -> Column:
    """Runs of letters and digits, lowered."""
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def _shingles(words: Column) -> Column:
    """Shingles in order; none for fewer words."""
    at = F.when(F.size(words) >= WIDTH, F.sequence(F.lit(1), F.size(words) - (WIDTH - 1))).otherwise(F.array().cast("array<int>"))
    return F.transform(at, lambda i: F.array_join(F.slice(words, i, WIDTH), " "))


def _hashes(words: Column) -> Column:
    at = F.when(F.size(words) >= WIDTH, F.sequence(F.lit(1), F.size(words) - (WIDTH - 1))).otherwise(F.array().cast("array<int>"))
    return F.transform(at, lambda i: F.xxhash64(F.slice(words, i, WIDTH)))


def _permuted(hashes: Column, band: int) -> Column:
    return F.transform(hashes, lambda h: F.xxhash64(h, F.lit(band)))


def _all_minima(permuted: Column, length: int) -> Column:
    """The MinHash of each window of a template; what is shorter than a window is one."""
    starts = F.sequence(F.lit(0), F.greatest(F.lit(0), F.size(permuted) - length))
    return F.when(F.size(permuted) == 0, F.array().cast("array<bigint>")).otherwise(F.transform(starts, lambda i: F.array_min(F.slice(permuted, i + 1, length))))


def _blocks(permuted: Column) -> Column:
    starts = F.when(F.size(permuted) > 0, F.sequence(F.lit(1), F.size(permuted), F.lit(BLOCK))).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda i: F.array_min(F.slice(permuted, i, BLOCK)))


def _minima(blocks: Column, length: int) -> Column:
    """The MinHash of each window of a text, from its blocks' minima; the last windows may be shorter."""
    n, step = length // BLOCK, length // BLOCK // 2
    starts = F.when(F.size(blocks) > 0, F.sequence(F.lit(0), F.size(blocks) - 1, F.lit(step))).otherwise(F.array().cast("array<int>"))
    if n == 2:
        return F.transform(starts, lambda i: F.least(F.get(blocks, i), F.get(blocks, i + 1)))
    return F.transform(starts, lambda i: F.array_min(F.slice(blocks, i + 1, n)))


def _kept_apart(df: DataFrame, **columns: Column) -> DataFrame:
    """Columns that are made once: what uses them in a lambda can't pull their making into it, past the generator."""
    return df.withColumn("_made", F.explode(F.array(F.struct(*(c.alias(n) for n, c in columns.items()))))).select(*df.columns, *(F.col(f"_made.{n}").alias(n) for n in columns))


def _index(spark: SparkSession, templates: dict[str, str]) -> tuple[DataFrame, dict[tuple[int, int], dict[int, list[str]]]]:
    """The templates' shingles (broadcast later) and, for each scale and band, which templates a MinHash brings up."""
    t = _kept_apart(spark.createDataFrame(sorted(templates.items()), "license string, body string").coalesce(1), words=_words(F.col("body")))
    t = _kept_apart(t, parts=F.array_distinct(_shingles(F.col("words"))), hashes=_hashes(F.col("words")))
    t = _kept_apart(t, **{f"p{b}": _permuted(F.col("hashes"), b) for b in range(BANDS)})
    columns = {f"m{length}_{b}": _all_minima(F.col(f"p{b}"), length) for length, _ in SCALES for b in range(BANDS if length > 1 else 1)}
    rows = t.select("license", "parts", *(c.alias(n) for n, c in columns.items())).collect()
    if sum(len(r.parts) for r in rows) > MOST_SHINGLES:
        raise ValueError(f"the templates have more than {MOST_SHINGLES} shingles")
    index: dict = {}
    for r in rows:
        serving = [length for length, least in SCALES if len(r.parts) >= least]
        for b in range(BANDS if serving and serving[-1] > 1 else 1):
            for key in r[f"m{serving[-1]}_{b}"] if serving else ():
                index.setdefault((serving[-1], b), {}).setdefault(key, set()).add(r.license)
    return spark.createDataFrame([(r.license, r.parts) for r in rows if r.parts], "license string, parts array<string>"), index


def scan(docs: DataFrame, templates: dict[str, str] | None = None, contained: float = CONTAINED) -> DataFrame:
    """docs (doc_id, text): doc_id, license, matched long, total long, containment double; a row for each license found.

    A template is found where at least `contained` of its distinct shingles of five words are among the text's. Windows
    that overlap by half, of three lengths, are compared with all windows of the templates of such length by MinHash
    bands (a run of a template's shingles one and a half windows long holds a whole window, which certainly meets its
    like); the templates that come up are verified by exact containment. All in one pass, without a shuffle.

    Null, empty and wordless texts: no rows. Templates of fewer than five words are never found. Null ids are kept,
    repeated rows answered as often as they occur, and an empty table gives an empty table.
    """
    table, index = _index(docs.sparkSession, TEMPLATES if templates is None else templates)
    rows = _kept_apart(docs.select("doc_id", "text"), words=_words(F.col("text"))).select("doc_id", "words")
    rows = _kept_apart(rows, hashes=_hashes(F.col("words")))
    bands = sorted({b for _, b in index})
    rows = _kept_apart(rows, **{f"p{b}": _permuted(F.col("hashes"), b) for b in bands}) if bands else rows
    rows = _kept_apart(rows, **{f"b{b}": _blocks(F.col(f"p{b}")) for b in bands}) if any(length > 1 for length, _ in index) else rows
    none = F.array().cast("array<bigint>")
    keys = {f"k{length}_{b}": F.filter(F.col(f"p{b}") if length == 1 else _minima(F.col(f"b{b}"), length), lambda m: m.isin(*wanted)) for (length, b), wanted in index.items()}
    rows = rows.select("doc_id", "words", *(c.alias(n) for n, c in keys.items()))
    rows = rows.where(F.size(F.concat(none, *(F.col(n) for n in keys))) > 0)

    def licenses(length: int, b: int, wanted: dict) -> Column:
        m = F.create_map(*(x for k, v in sorted(wanted.items()) for x in (F.lit(k), F.array(*(F.lit(n) for n in sorted(v))))))
        return F.flatten(F.transform(F.array_distinct(F.col(f"k{length}_{b}")), lambda k: F.element_at(m, k)))

    up = F.array_distinct(F.concat(F.array().cast("array<string>"), *(licenses(length, b, wanted) for (length, b), wanted in index.items())))
    rows = _kept_apart(rows.select("doc_id", "words", up.alias("up")), own=F.array_distinct(_shingles(F.col("words"))))
    pairs = rows.select("doc_id", "own", F.explode("up").alias("license")).join(F.broadcast(table), "license")
    found = pairs.select("doc_id", "license", F.size(F.array_intersect("parts", "own")).cast("long").alias("matched"), F.size("parts").cast("long").alias("total"))
    return found.withColumn("containment", F.col("matched") / F.col("total")).where(F.col("containment") >= contained)


def op9_license_scan(docs: DataFrame) -> DataFrame:
    return scan(docs)


def _sql_text(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


OP9_SQL = (
    "WITH templates AS (SELECT * FROM (VALUES "
    + ", ".join(f"({_sql_text(k)}, {_sql_text(v)})" for k, v in sorted(TEMPLATES.items()))
    + r""") v(license, body)
), t AS (
  SELECT license, list_filter(regexp_split_to_array(lower(body), '[^\pL\pN]+'), lambda w: w <> '') AS w FROM templates
), parts AS (
  SELECT DISTINCT license, array_to_string(w[i:i + 4], ' ') AS s FROM (SELECT license, w, unnest(range(1, len(w) - 3)) AS i FROM t)
), totals AS (
  SELECT license, count(*) AS total FROM parts GROUP BY license
), d AS (
  SELECT doc_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\pL\pN]+'), lambda w: w <> '') AS w FROM documents
), own AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM d)
), hits AS (
  SELECT o.doc_id, p.license, count(*) AS matched FROM own o JOIN parts p ON o.s = p.s GROUP BY o.doc_id, p.license
)
SELECT doc_id, license, CAST(matched AS BIGINT) AS matched, CAST(total AS BIGINT) AS total, matched::DOUBLE / total AS containment
FROM hits JOIN totals USING (license) WHERE matched::DOUBLE / total >= 0.75
"""
)
