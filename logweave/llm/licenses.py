"""License scans: MinHash bands over overlapping windows retrieve templates, exact shingle containment verifies them."""

from __future__ import annotations

import random
import re
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from logweave.llm.common import id_or_last, literal_rows, read, text_or_empty

#: Notices in the words that their licenses and common usage give.
TEMPLATES = (
    ("apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.'),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("cc-by-4.0", "Licensed under CC BY 4.0."),
    ("cc-by-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0."),
    ("cc-by-sa-4.0", "Licensed under CC BY-SA 4.0."),
    ("gpl-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("mit", "Released under the MIT License."),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("unlicense", "This is free and unencumbered software released into the public domain."),
    # usual short wordings, openings and headings of full texts; most have four shingles at most and must be there word for word
    ("afl-3.0", "Licensed under the Academic Free License version 3.0"),
    ("agpl-3.0", "under the GNU Affero General Public License"),
    ("agpl-3.0", "terms of the GNU Affero General Public License"),
    ("agpl-3.0", "GNU AFFERO GENERAL PUBLIC LICENSE Version 3"),
    ("apache-2.0", "Apache License, Version 2.0"),
    ("apache-2.0", "under the Apache License 2.0"),
    ("apache-2.0", "under the Apache 2.0 License"),
    ("artistic-2.0", "The Artistic License 2.0"),
    ("bsd", "Licensed under the BSD License"),
    ("bsd", "Released under the BSD License"),
    ("bsd", "under the BSD 2-Clause License"),
    ("bsd", "under the BSD 3-Clause License"),
    ("bsl-1.0", "Boost Software License, Version 1.0"),
    ("bsl-1.0", "Boost Software License - Version 1.0"),
    ("cc-by-4.0", "under a CC BY 4.0"),
    ("cc-by-4.0", "Creative Commons Attribution 4.0 International"),
    ("cc-by-nc-4.0", "under a CC BY-NC 4.0"),
    ("cc-by-nc-4.0", "Creative Commons Attribution-NonCommercial 4.0 International"),
    ("cc-by-nc-nd-4.0", "Licensed under CC BY-NC-ND 4.0"),
    ("cc-by-nc-nd-4.0", "Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International"),
    ("cc-by-nc-sa-4.0", "Licensed under CC BY-NC-SA 4.0"),
    ("cc-by-nc-sa-4.0", "Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International"),
    ("cc-by-nd-4.0", "Licensed under CC BY-ND 4.0"),
    ("cc-by-nd-4.0", "Creative Commons Attribution-NoDerivatives 4.0 International"),
    ("cc-by-sa-4.0", "under a CC BY-SA 4.0"),
    ("cc-by-sa-4.0", "Creative Commons Attribution-ShareAlike 4.0 International"),
    ("cc0-1.0", "CC0 1.0 Universal Public Domain"),
    ("cc0-1.0", "Creative Commons Zero v1.0 Universal"),
    ("epl-2.0", "Eclipse Public License - v 2.0"),
    ("epl-2.0", "Eclipse Public License, version 2.0"),
    ("gpl-2.0", "GNU General Public License, version 2"),
    ("gpl-2.0", "GNU General Public License v2"),
    ("gpl-2.0", "Free Software Foundation; either version 2 of the"),
    ("gpl-3.0", "GNU General Public License, version 3"),
    ("gpl-3.0", "GNU General Public License v3"),
    ("isc", "Licensed under the ISC License"),
    ("isc", "Released under the ISC License"),
    ("lgpl", "under the GNU Lesser General Public License"),
    ("lgpl", "terms of the GNU Lesser General Public License"),
    ("lgpl", "GNU LESSER GENERAL PUBLIC LICENSE Version"),
    ("lgpl", "terms of the GNU Library General Public License"),
    ("mit", "Licensed under the MIT License"),
    ("mit", "Distributed under the MIT License"),
    ("mit", "Available under the MIT License"),
    ("mit", "under the terms of the MIT License"),
    ("mit", "licensed under the terms of MIT"),
    ("mpl-2.0", "Mozilla Public License, v. 2.0"),
    ("mpl-2.0", "Mozilla Public License, version 2.0"),
    ("mpl-2.0", "Mozilla Public License 2.0"),
    ("unlicense", "Released under the Unlicense License"),
    ("unlicense", "dedicated to the public domain under the Unlicense"),
    ("zlib", "Licensed under the zlib License"),
    ("zlib", "This software is provided as-is, without any express or implied warranty"),
)
#: Words in a shingle, and shingles in a window; windows start at every STEP-th word, so each shingle is in one of them.
WIDTH, STEP = 5, 2
#: A notice that lies whole in a text has at least one of the two shingles of some window; so all bands miss it with a
#: chance of at most (1/2)^13, one in eight thousand. A band is one row: it holds on any collision.
BANDS = 13


def plain_words(text: str) -> list[str]:
    """As word_array splits a text."""
    return re.findall(r"[^\x00-\x2f:-@\[-`{-\x7f]+", text.lower())


def word_array(text: Column) -> Column:
    """Runs of ASCII letters and digits and of all characters beyond ASCII, in lower case."""
    return F.array_remove(F.split(F.lower(text), r"[\x00-\x2f:-@\[-`{-\x7f]+"), "")


def _window(words: Column, at: Column, put_in: int = STEP) -> list[Column]:
    """Hashes of the shingles that start at `at` and after it; null where the text ends before they do."""
    return [F.when(at + k + WIDTH <= F.size(words), F.xxhash64(*[F.get(words, at + k + j) for j in range(WIDTH)])) for k in range(put_in)]


def _bands(hashes: list[Column], bands: int) -> list[Column]:
    """The least of each band's own hashes of the shingles: their bits turned round and flipped, by other amounts in each band."""
    wild = random.Random(64)
    out = []
    for band in range(bands):
        turn, mask = band * 64 // bands, wild.getrandbits(63)
        own = [F.shiftleft(h, turn).bitwiseOR(F.shiftrightunsigned(h, (64 - turn) % 64)).bitwiseXOR(F.lit(mask)) for h in hashes]
        out.append(F.least(*own))
    return out


def template_rows(spark: SparkSession, templates: tuple[tuple[str, str], ...]) -> DataFrame:
    """(template, license, words, shingles)"""
    rows = []
    for k, (name, text) in enumerate(templates):
        own = plain_words(text)
        if len(own) < WIDTH:
            raise ValueError(f"the notice {text!r} has fewer than {WIDTH} words")
        rows.append((k, name, own, sorted({" ".join(own[i : i + WIDTH]) for i in range(len(own) - WIDTH + 1)})))
    return literal_rows(spark, rows, "template int,license string,words array<string>,shingles array<string>")


def scan(docs: DataFrame, templates: tuple[tuple[str, str], ...] = TEMPLATES, least: float = 0.8, bands: int = BANDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, license, containment, first_word): the licenses whose notices a document holds.

    A notice is held if at least `least` of its distinct shingles lie within its longest template's length of a window
    that it was retrieved for; containment is the largest such share, first_word the first such window's place. Texts
    are windowed whole, without any shuffle; only (id, license) pairs found are aggregated, and the templates, a
    parameter, are constants of the plan. Null, empty and too short texts hold none; a null id comes out as 2^63 - 1;
    rows of one id are one document; other columns aren't carried.
    """
    spark = docs.sparkSession
    known = template_rows(spark, templates)
    reach = max(len(plain_words(text)) for _, text in templates)
    # every window of a template, from each of its words on, also those that its end cuts short
    cut = known.select("template", "words", F.explode(F.sequence(F.lit(1 - STEP), F.size("words") - WIDTH)).alias("at"))
    inside = [F.when((F.col("at") + k >= 0) & (F.col("at") + k + WIDTH <= F.size("words")), F.xxhash64(*[F.get("words", F.col("at") + k + j) for j in range(WIDTH)])) for k in range(STEP)]
    cut = cut.select("template", *[h.alias(f"h{k}") for k, h in enumerate(inside)])
    mins = _bands([F.col(f"h{k}") for k in range(STEP)], bands)
    # as many rows as the templates have words
    bounded = cut.select("template", *mins).distinct().collect()
    pairs = sorted({(row[0], band, row[band + 1]) for row in bounded for band in range(bands) if row[band + 1] is not None})
    keys = literal_rows(spark, pairs, "template int,band int,key long")
    wanted = [sorted({key for _, at, key in pairs if at == band}) for band in range(bands)]
    texts = docs.select(id_or_last(id_col).alias("id"), word_array(text_or_empty(text_col)).alias("words"))
    # outer, since for others a filter on the size would be inferred, and the words split once more for it
    starts = texts.select("id", "words", F.explode_outer(F.when(F.size("words") >= WIDTH, F.sequence(F.lit(0), F.size("words") - WIDTH, F.lit(STEP)))).alias("at"))
    hashed = starts.select("id", "words", "at", *[h.alias(f"h{k}") for k, h in enumerate(_window(F.col("words"), F.col("at")))])
    # the row number keeps the filter above these columns, so that each is computed once
    keyed = hashed.select("id", "words", "at", *[m.alias(f"m{band}") for band, m in enumerate(mins)], F.monotonically_increasing_id().alias("row"))
    some = reduce(Column.__or__, [F.col(f"m{band}").isin(wanted[band]) for band in range(bands)])
    retrieved = keyed.where(some & (F.col("row") >= 0)).select(
        "id", "at", F.slice("words", F.greatest(F.col("at") - reach, F.lit(0)) + 1, 2 * reach + STEP + WIDTH).alias("near"), F.posexplode(F.array(*[F.col(f"m{band}") for band in range(bands)])).alias("band", "key")
    )
    found = retrieved.join(F.broadcast(keys), ["band", "key"]).select("id", "at", "near", "template").distinct()
    held = found.join(F.broadcast(known.select("template", "license", "shingles")), "template")
    near = F.transform(F.sequence(F.lit(1), F.size("near") - WIDTH + 1), lambda i: F.concat_ws(" ", F.slice("near", i, WIDTH)))
    share = F.size(F.array_intersect("shingles", near)) / F.size("shingles")
    verified = held.select("id", "license", "at", share.alias("containment"))
    return verified.groupBy("id", "license").agg(F.max("containment").alias("containment"), F.min(F.when(F.col("containment") >= least, F.col("at"))).cast("long").alias("first_word")).where(F.col("containment") >= least)


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    found = scan(docs).groupBy(F.col("id").alias("_of")).agg(F.array_sort(F.collect_list("license")).alias("names"), F.max("containment").alias("containment"), F.min("first_word").alias("first_word"))
    return docs.select("doc_id").join(found, id_or_last("doc_id") == F.col("_of"), "left").select(
        "doc_id", F.coalesce(F.array_join("names", ","), F.lit("")).alias("licenses"), F.coalesce("containment", F.lit(0.0)).alias("containment"), "first_word"
    )


SQL = r"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ws
  FROM documents
), t AS (
  SELECT template, license, regexp_extract_all(lower(notice), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ws
  FROM (VALUES NOTICES) v(template, license, notice)
), ts AS (
  SELECT DISTINCT template, license, array_to_string(ws[i:i + 4], ' ') AS shingle
  FROM (SELECT template, license, ws, unnest(range(1, len(ws) - 3)) AS i FROM t)
), n AS (
  SELECT template, count(*) AS n, (SELECT max(len(ws)) FROM t) AS reach FROM ts GROUP BY template
), ds AS (
  SELECT doc_id, len(ws) AS total, i - 1 AS p, array_to_string(ws[i:i + 4], ' ') AS shingle
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 3)) AS i FROM w WHERE len(ws) >= 5)
), hit AS (
  SELECT doc_id, total, p, template, license, shingle FROM ds JOIN ts USING (shingle)
), win AS (
  SELECT DISTINCT doc_id, template, license, (p // 2) * 2 AS s FROM hit
), share AS (
  SELECT win.doc_id, win.license, win.template, s, count(DISTINCT shingle) / any_value(n.n)::DOUBLE AS containment
  FROM win JOIN n USING (template) JOIN hit ON hit.doc_id = win.doc_id AND hit.template = win.template
    AND p >= greatest(s - reach, 0) AND p + 5 <= greatest(s - reach, 0) + 2 * reach + 7
  GROUP BY ALL
), best AS (
  SELECT doc_id, license, max(containment) AS containment, min(s) FILTER (WHERE containment >= 0.8) AS first_word
  FROM share GROUP BY ALL HAVING max(containment) >= 0.8
), told AS (
  SELECT doc_id, string_agg(license, ',' ORDER BY license) AS licenses, max(containment) AS containment, min(first_word) AS first_word FROM best GROUP BY doc_id
)
SELECT doc_id, coalesce(licenses, '') AS licenses, coalesce(containment, 0.0)::DOUBLE AS containment, first_word
FROM documents LEFT JOIN told USING (doc_id)
""".replace("NOTICES", ", ".join(f"({k}, '{name}', '{text}')" for k, (name, text) in enumerate(TEMPLATES)))
