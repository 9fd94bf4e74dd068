"""Licence scans, in DataFrame functions only.

Lines that mention a licence (headers, anywhere in a text) and the whole text of
licence files are compared with templates by the cosine of sparse TF-IDF vectors.
The best template at or above the threshold is the file's own licence. A text that
mentions a licence but has no such line is searched across its line breaks, comment
marks aside: windows as long as a template, from where its first two terms stand, are
compared with short and long templates, so wrapped headers and whole licence texts
match as well. SPDX identifiers and a bare "MIT License" title name a licence outright
(cosine 1); of an SPDX expression the first licence counts, in the spelling of the
templates, and an identifier that no template has names nothing. A file without one inherits that of the nearest directory above it that holds a licence
file with a licence, found by joining the directories' ancestor paths.

Texts are read once for the few lines that mention a licence. Ancestors are
listed per directory, not per file, and results are stored before files are
joined to them, so adaptive execution can split a directory that holds a third of
all files. Template vectors are constants of this module.

* NULL and empty texts have no licence of their own but may inherit one.
* A NULL path has no directory: such a file neither gives nor inherits.
* Of equally close templates the first by name counts, of equally close licence
  files in a directory likewise. Repeated rows get the same answer each.
* Rows with equal id, path and text are one file.
* No rows give no rows.
"""

from __future__ import annotations

import math
import re
from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerstrata.llm.common import stored

# Names and opening words of public licences and their usual notices.
TEMPLATES = (
    ("AGPL-3.0", "Licensed under the GNU Affero General Public License, version 3."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use "
     "this file except in compliance with the License."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without "
     "modification, are permitted provided that the following conditions are met"),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license that can be found "
     "in the LICENSE file."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 "
     "International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 "
     "International License."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related "
     "rights to this work under CC0 1.0."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the "
     "terms of the GNU General Public License as published by the Free Software Foundation; either "
     "version 2 of the License, or (at your option) any later version."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the "
     "terms of the GNU General Public License as published by the Free Software Foundation, either "
     "version 3 of the License, or (at your option) any later version."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or "
     "without fee is hereby granted"),
    ("LGPL-3.0", "Licensed under the GNU Lesser General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
     "software and associated documentation files, to deal in the Software without restriction"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
)
# Only for windows: headers and titles of whole texts that differ in few words.
_FREE = ("you can redistribute it and/or modify it under the terms of the GNU {0} as published by the Free "
         "Software Foundation, either version {1} of the License, or (at your option) any later version.")
LONG_TEMPLATES = TEMPLATES + tuple(
    (name, text)
    for name, title, version in (
        ("AGPL-3.0", "Affero General Public License", "3"), ("LGPL-3.0", "Lesser General Public License", "3"),
        ("LGPL-2.1", "Lesser General Public License", "2.1"), ("GPL-2.0", "General Public License", "2"),
        ("GPL-3.0", "General Public License", "3"),
    )
    for text in (
        "This program is free software: " + _FREE.format(title, version),
        "This library is free software; " + _FREE.format(title, version),
    )
) + (
    ("AGPL-3.0", "GNU Affero General Public License Version 3, 19 November 2007"),
    ("Apache-2.0", "Apache License Version 2.0, January 2004"),
    ("GPL-2.0", "GNU General Public License Version 2, June 1991"),
    ("GPL-3.0", "GNU General Public License Version 3, 29 June 2007"),
    ("LGPL-2.1", "GNU Lesser General Public License Version 2.1, February 1999"),
    ("LGPL-3.0", "GNU Lesser General Public License Version 3, 29 June 2007"),
    ("MPL-2.0", "Mozilla Public License Version 2.0 1. Definitions"),
)
SPDX = r"(?i)SPDX-License-Identifier:[ \t(]*([a-z0-9.+-]+)"
TITLE = r"(?im)^[^a-z0-9\n]*(?:the )?(mit|isc) licen[cs]e(?: \(mit\))?[^a-z0-9\n]*$"
MENTIONS = (
    r"(?i)licen[cs]e|copyright|creative commons|public domain|cc0|cc by|"
    r"permission (is hereby granted|to use)|redistribution and use|free software"
)
LICENCE_FILE = r"(?i)(^|/)(un)?(licen[cs]e|copying|notice)[^/]*$"
THRESHOLD = 0.75
TERM_BREAK = r"[^a-z0-9.]+"


def terms(text: str) -> list[str]:
    """Lower-case runs of ASCII letters, digits and inner full stops."""
    return [word for word in (part.strip(".") for part in re.split(TERM_BREAK, text.lower())) if word]


def template_weights(templates=TEMPLATES) -> tuple[list[tuple[str, int, str, float]], dict[str, float], float]:
    """Rows ``(licence, template, term, weight / norm)``, the idf of terms, and that of others."""
    bags = [(name, Counter(terms(text))) for name, text in templates]
    seen = Counter(term for _, bag in bags for term in bag)
    idf = {term: math.log((1 + len(bags)) / (1 + n)) + 1 for term, n in seen.items()}
    rows = []
    for at, (name, bag) in enumerate(bags):
        norm = math.sqrt(sum((n * idf[term]) ** 2 for term, n in bag.items()))
        rows += [(name, at, term, n * idf[term] / norm) for term, n in sorted(bag.items())]
    return rows, idf, math.log(1 + len(bags)) + 1


def _key(id_col: Column, path: Column, text: Column) -> Column:
    return F.xxhash64(id_col, path, text)


def own_licences(files: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``(key, licence, cosine)`` of the files that match a template themselves.

    ``files`` has ``id``, ``path`` and ``text``.
    """
    key = _key(F.col("id"), F.col("path"), F.col("text")).alias("key")
    lines = F.filter(F.split("text", "\n"), lambda line: line.rlike(MENTIONS))
    whole = F.when(F.col("path").rlike(LICENCE_FILE), F.array("text")).otherwise(F.array())
    mentioned = F.when(F.col("text").rlike(MENTIONS), lines).otherwise(F.array())
    units = files.where("text IS NOT NULL").select(
        key, F.posexplode(F.concat(F.coalesce(whole, F.array()), mentioned)).alias("unit", "content")
    )
    lined = stored(_matched(units, TEMPLATES, threshold), "line-licences")
    mentioning = files.where(F.col("text").rlike(MENTIONS)).select(key, "text")
    rest = stored(mentioning.join(lined.select("key"), "key", "left_anti"), "unlined-texts")
    named = rest.select("key", _named("text").alias("licence")).where("licence <> ''").distinct()
    wide = rest.join(named.select("key"), "key", "left_anti")
    windows = _matched(wide.select("key", F.posexplode(_windows("text")).alias("unit", "content")), LONG_TEMPLATES, threshold)
    return lined.unionByName(named.withColumn("cosine", F.lit(1.0))).unionByName(windows)


def _terms(text: Column) -> Column:
    return F.filter(
        F.transform(F.split(F.lower(text), TERM_BREAK), lambda word: F.trim(word, F.lit("."))),
        lambda word: word != "",
    )


def _named(text: str) -> Column:
    """The licence that an SPDX identifier or a bare title names, or an empty text."""
    names = sorted({name for name, _ in (*TEMPLATES, *LONG_TEMPLATES)})
    by_lower = F.create_map(*[F.lit(x) for name in names for x in (name.lower(), name)])
    spdx = F.regexp_replace(F.lower(F.regexp_extract(text, SPDX, 1)), r"(-only|-or-later|\+)$", "")
    return F.when(spdx != "", F.coalesce(F.try_element_at(by_lower, spdx), F.lit(""))).otherwise(F.upper(F.regexp_extract(text, TITLE, 1)))


def _windows(text: str) -> Column:
    """Runs of terms as long as a template, from where its first two terms stand."""
    starts = sorted({(*bag[:2], len(bag)) for bag in (terms(template) for _, template in LONG_TEMPLATES)})
    firsts = sorted({first for first, _, _ in starts})

    def found(words: Column) -> Column:
        places = F.filter(
            F.sequence(F.lit(0), F.greatest(F.size(words) - 1, F.lit(0))), lambda i: F.get(words, i).isin(firsts)
        )
        cuts = F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.lit(n).alias("n")) for a, b, n in starts])
        return F.flatten(
            F.transform(
                places,
                lambda i: F.transform(
                    F.filter(cuts, lambda c: (c["a"] == F.get(words, i)) & (c["b"] == F.get(words, i + 1))),
                    lambda c: F.concat_ws(" ", F.slice(words, i + 1, c["n"])),
                ),
            )
        )

    return F.transform(F.array(_terms(F.col(text))), found)[0]


def _matched(units: DataFrame, templates_of: tuple, threshold: float) -> DataFrame:
    """``(key, licence, cosine)`` of the best template of any unit ``(key, unit, content)``."""
    spark = units.sparkSession
    counts = (
        units.select("key", "unit", F.explode(_terms(F.col("content"))).alias("term"))
        .groupBy("key", "unit", "term")
        .agg(F.count("*").alias("n"))
    )
    rows, idf, other = template_weights(templates_of)
    rarity = spark.createDataFrame(sorted(idf.items()), "term string, idf double")
    templates = spark.createDataFrame(rows, "licence string, template int, term string, part double")
    # Both are a few hundred constant rows.
    weights = stored(
        counts.join(F.broadcast(rarity), "term", "left").select(
            "key", "unit", "term", (F.col("n") * F.coalesce("idf", F.lit(other))).alias("weight")
        ),
        "licence-terms",
    )
    norms = weights.groupBy("key", "unit").agg(F.sqrt(F.sum(F.col("weight") * F.col("weight"))).alias("norm"))
    products = (
        weights.join(F.broadcast(templates), "term")
        .groupBy("key", "unit", "licence", "template")
        .agg(F.sum(F.col("weight") * F.col("part")).alias("product"))
    )
    scored = products.join(norms, ["key", "unit"]).select(
        "key", "licence", F.round(F.col("product") / F.col("norm"), 6).alias("cosine")
    )
    best = (
        scored.where(F.col("cosine") >= threshold)
        .groupBy("key")
        .agg(F.min(F.struct((-F.col("cosine")).alias("far"), "licence")).alias("best"))
    )
    return best.select("key", "best.licence", (-F.col("best.far")).alias("cosine"))


def nearest_licences(directories: DataFrame, held: DataFrame) -> DataFrame:
    """``(dir, from_dir, licence)``: the licence of the nearest directory at or above ``dir``.

    ``directories`` has distinct ``dir``; ``held`` has one ``licence`` per ``dir``.
    """
    parts = F.split("dir", "/")
    depths = F.when(F.col("dir") == "", F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), F.size(parts)))
    above = directories.select("dir", F.explode(depths).alias("depth")).select(
        "dir", "depth", F.concat_ws("/", F.slice(parts, F.lit(1), F.col("depth"))).alias("from_dir")
    )
    found = above.join(held.withColumnRenamed("dir", "from_dir"), "from_dir")
    return found.groupBy("dir").agg(F.max(F.struct("depth", "from_dir", "licence")).alias("near")).select(
        "dir", "near.from_dir", "near.licence"
    )


def scan_licences(
    files: DataFrame,
    id_col: str = "doc_id",
    path_col: str = "path",
    text_col: str = "text",
    threshold: float = THRESHOLD,
) -> DataFrame:
    """One row per file: id, path, licence, basis (own, inherited, none), cosine, from_dir."""
    named = files.select(
        F.col(id_col).alias("id"), F.col(path_col).cast("string").alias("path"),
        F.col(text_col).cast("string").alias("text"),
    )
    own = stored(own_licences(named, threshold), "own-licences")
    folder = F.when(F.col("path").contains("/"), F.regexp_replace("path", "/[^/]*$", "")).otherwise("")
    listed = stored(
        named.select(
            "id", "path", _key(F.col("id"), F.col("path"), F.col("text")).alias("key"),
            F.when(F.col("path").isNotNull(), folder).alias("dir"),
        ),
        "file-list",
    )
    known = stored(listed.join(own, "key", "left"), "file-licences")
    held = (
        known.where(F.col("path").rlike(LICENCE_FILE) & F.col("licence").isNotNull())
        .groupBy("dir")
        .agg(F.min(F.struct((-F.col("cosine")).alias("far"), "licence")).alias("best"))
        .select("dir", "best.licence")
    )
    directories = known.select("dir").where("dir IS NOT NULL").distinct()
    near = stored(
        nearest_licences(directories, held).select(
            F.col("dir").alias("in_dir"), "from_dir", F.col("licence").alias("inherited")
        ),
        "directory-licences",
    )
    mine = F.col("licence").isNotNull()
    return known.join(near, F.col("dir") == F.col("in_dir"), "left").select(
        F.col("id").alias(id_col),
        "path",
        F.coalesce("licence", "inherited").alias("licence"),
        F.when(mine, "own").when(F.col("inherited").isNotNull(), "inherited").otherwise("none").alias("basis"),
        "cosine",
        F.when(~mine, F.col("from_dir")).alias("from_dir"),
    )


# --- the given documents as a tree of files -------------------------------------------------

# Every directory of 20, 500 and 10,000 ids has one document as its licence file.
PATH_SQL = """
    concat('d', CAST(floor(doc_id / 10000) AS BIGINT),
        CASE WHEN doc_id % 10000 = 30 THEN '/LICENSE'
             WHEN doc_id % 500 = 10 THEN concat('/d', CAST(floor(doc_id / 500) AS BIGINT), '/LICENSE')
             ELSE concat('/d', CAST(floor(doc_id / 500) AS BIGINT),
                         '/d', CAST(floor(doc_id / 20) AS BIGINT), '/',
                         CASE WHEN doc_id % 20 = 0 THEN 'LICENSE' ELSE concat('doc-', doc_id, '.txt') END)
        END)"""


def documents_as_files(documents: DataFrame) -> DataFrame:
    """``documents`` with a path made from the id, as they have none."""
    return documents.select("doc_id", F.expr(PATH_SQL).alias("path"), "text")


def licence_sql() -> str:
    """The scan of :func:`documents_as_files` as DuckDB SQL."""
    rows, idf, other = template_weights()
    templates = ", ".join(f"('{name}', {at}, '{term}', {part!r}::DOUBLE)" for name, at, term, part in rows)
    rarity = ", ".join(f"('{term}', {value!r}::DOUBLE)" for term, value in sorted(idf.items()))
    mentions = MENTIONS.removeprefix("(?i)")
    licence_file = LICENCE_FILE.removeprefix("(?i)")
    return f"""
        WITH templates(licence, template, term, part) AS (VALUES {templates}),
        rarity(term, idf) AS (VALUES {rarity}),
        files AS (SELECT doc_id, {PATH_SQL} AS path, text FROM documents),
        flagged AS (SELECT *, regexp_matches(path, '{licence_file}', 'i') AS is_licence,
                           regexp_replace(path, '/[^/]*$', '') AS dir FROM files),
        lines AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS content FROM flagged),
        units AS (
            SELECT doc_id, 0 AS unit, text AS content FROM flagged WHERE is_licence
            UNION ALL
            SELECT doc_id, row_number() OVER (), content FROM lines
            WHERE regexp_matches(content, '{mentions}', 'i')),
        words AS (
            SELECT doc_id, unit, trim(unnest(regexp_split_to_array(lower(content), '{TERM_BREAK}')), '.') AS term
            FROM units),
        weights AS (
            SELECT doc_id, unit, term, count(*) * coalesce(any_value(idf), {other!r}::DOUBLE) AS weight
            FROM words LEFT JOIN rarity USING (term) WHERE term <> '' GROUP BY ALL),
        norms AS (SELECT doc_id, unit, sqrt(sum(weight * weight)) AS norm FROM weights GROUP BY ALL),
        products AS (
            SELECT doc_id, unit, licence, template, sum(weight * part) AS product
            FROM weights JOIN templates USING (term) GROUP BY ALL),
        scored AS (SELECT doc_id, licence, round(product / norm, 6) AS cosine
                   FROM products JOIN norms USING (doc_id, unit)),
        own AS (
            SELECT doc_id, licence, cosine FROM scored WHERE cosine >= {THRESHOLD}
            QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY cosine DESC, licence) = 1),
        known AS (SELECT f.doc_id, path, dir, is_licence, licence, cosine
                  FROM flagged f LEFT JOIN own USING (doc_id)),
        held AS (
            SELECT dir AS from_dir, licence AS inherited FROM known
            WHERE is_licence AND licence IS NOT NULL
            QUALIFY row_number() OVER (PARTITION BY dir ORDER BY cosine DESC, licence) = 1),
        near AS (
            SELECT k.doc_id, from_dir, inherited FROM known k
            JOIN held h ON k.dir = h.from_dir OR starts_with(k.dir, h.from_dir || '/')
            QUALIFY row_number() OVER (PARTITION BY k.doc_id ORDER BY length(from_dir) DESC) = 1)
        SELECT doc_id, path, coalesce(licence, inherited) AS licence,
               CASE WHEN licence IS NOT NULL THEN 'own' WHEN inherited IS NOT NULL THEN 'inherited'
                    ELSE 'none' END AS basis,
               cosine, CASE WHEN licence IS NULL THEN from_dir END AS from_dir
        FROM known LEFT JOIN near USING (doc_id)"""
