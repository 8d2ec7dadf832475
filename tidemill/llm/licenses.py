"""License notices and whole license texts by MinHash bands over overlapping windows of a text.

The templates are a table (``license_templates.jsonl``, or any that the caller gives). Windows are
cut for each template length so that every stretch of that length lies inside one window. A window
and a template each have ``BANDS`` minima, one per hash function over their five-word shingles; a
window retrieves a template if at least one minimum agrees. Retrieved windows alone are verified, by
exact containment of shingles.

A window that holds 0.8 of a template has at most 1.7 times its shingles between them, so a minimum
agrees with a probability of 0.8 / 1.7 at least, and all disagree with 0.53 ** BANDS (2.4e-7) at
most; for a whole copy with 0.34 ** BANDS.

Minima are only worked out where they can agree: a window shares one with a template only if it
holds the template's shingle of that band, so shingles are first looked up among those. The lookup
passes on a slice of the text per place found; texts are never shuffled. Equal texts are one text
until their matches are joined back.
"""

from __future__ import annotations

import json
import re
from functools import reduce
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.llm.common import ascii_lower, let, stored

SHINGLE = 5
CONTAINED = 0.8
BANDS = 24
#: Shingles of templates up to which they are sent to every executor (about 100 bytes each); a
#: larger table is joined as Spark sees fit.
SENT_PARTS = 1_000_000
#: Templates whose bands are sent at once (24 rows of some 350 bytes each); more go in blocks.
SENT_TEMPLATES = 8_000

#: Notices and opening clauses that the check SQL knows; part of the table of templates.
TEMPLATES = {
    "apache-2.0-notice": "Licensed under the Apache License, Version 2.0.",
    "mit-notice": "Released under the MIT License.",
    "cc-by-nc-4.0-notice": "Licensed under CC BY-NC 4.0.",
    "gpl-3.0-notice": "This work is licensed under the GNU General Public License, version 3.",
    "mit": "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
           "software and associated documentation files (the \"Software\"), to deal in the "
           "Software without restriction, including without limitation the rights to use, copy, "
           "modify, merge, publish, distribute, sublicense, and/or sell copies of the Software",
    "bsd": "Redistribution and use in source and binary forms, with or without modification, are "
           "permitted provided that the following conditions are met",
    "apache-2.0": "Unless required by applicable law or agreed to in writing, software distributed "
                  "under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR "
                  "CONDITIONS OF ANY KIND, either express or implied.",
    "gpl": "This program is free software: you can redistribute it and/or modify it under the "
           "terms of the GNU General Public License as published by the Free Software Foundation",
}

#: One ``license, text`` per line: whole license texts and usual notices.
TABLE = Path(__file__).with_name("license_templates.jsonl")

_WORD = r"[a-z0-9\x{80}-\x{10ffff}]+"


def template_words(text: str) -> list[str]:
    low = "".join(c.lower() if c.isascii() else c for c in text)
    return re.findall("[a-z0-9\x80-\U0010ffff]+", low)


def shingles(words: list[str]) -> list[str]:
    return [" ".join(words[k:k + SHINGLE]) for k in range(len(words) - SHINGLE + 1)]


def template_table(spark: SparkSession) -> DataFrame:
    """``license, text`` of all templates that come with the package."""
    rows = [json.loads(line) for line in TABLE.read_text(encoding="utf-8").splitlines()]
    return spark.createDataFrame(
        [*TEMPLATES.items(), *((r["license"], r["text"]) for r in rows)],
        "license string, text string")


def _words(text: Column) -> Column:
    return F.regexp_extract_all(ascii_lower(text), F.lit(_WORD), 0)


def _shingle(words: Column, pos: Column) -> list[Column]:
    return [F.get(words, pos + k) for k in range(SHINGLE)]


def _minimum(hashes: Column, band: Column) -> Column:
    return F.array_min(F.transform(hashes, lambda h: F.xxhash64(band, h)))


def _shingled(rows: DataFrame) -> DataFrame:
    """One row per shingle of rows with ``words``: the other columns and ``part``."""
    places = F.explode(F.sequence(F.lit(0), F.size("words") - SHINGLE))
    return rows.where(F.size("words") >= SHINGLE).select("*", places.alias("__pos")).select(
        *[c for c in rows.columns if c != "words"],
        F.concat_ws(" ", *_shingle(F.col("words"), F.col("__pos"))).alias("part"))


def parts_of(templates: DataFrame) -> DataFrame:
    """``license, part, size, stride, width`` of every distinct shingle of a template.

    ``size``: distinct shingles of the template; ``stride, width``: of its windows, in shingles.
    """
    rows = templates.select("license", _words(F.col("text")).alias("words"))
    short = [r.license for r in rows.where(F.size("words") < SHINGLE).collect()]
    if short:
        raise ValueError(f"{sorted(short)} have fewer than {SHINGLE} words")
    length = F.size("words") - SHINGLE + 1
    lengths = rows.select("license", length.alias("n"), F.greatest(
        F.lit(1), F.floor(length / 2).cast("int")).alias("stride"))
    parts = _shingled(rows).distinct()
    sizes = parts.groupBy("license").agg(F.count("*").alias("size"))
    return parts.join(sizes, "license").join(lengths, "license").select(
        "license", "part", "size", "stride", (F.col("n") + F.col("stride") - 1).alias("width"))


def signatures(parts: DataFrame, bands: int = BANDS) -> DataFrame:
    """``license, size, stride, width, hash, own, sign``, one row per shingle that is a minimum.

    ``own``: the bands whose minimum the shingle gives; ``sign``: the minima of all bands in order.
    """
    hashed = parts.select("license", "size", "stride", "width",
                          F.xxhash64(*_shingle(F.split("part", " "), F.lit(0))).alias("hash"))
    band = F.explode(F.sequence(F.lit(0), F.lit(bands - 1)))
    minima = hashed.select("*", band.alias("band")).groupBy(
        "license", "size", "stride", "width", "band").agg(
            F.min(F.struct(F.xxhash64("band", "hash").alias("least"), "hash")).alias("m"))
    ordered = F.array_sort(F.collect_list(F.struct("band", "m.least")))
    signs = minima.groupBy("license").agg(
        F.transform(ordered, lambda s: s["least"]).alias("sign"))
    return minima.groupBy("license", "size", "stride", "width", F.col("m.hash").alias("hash")).agg(
        F.array_sort(F.collect_list("band")).alias("own")).join(signs, "license")


def _retrieved(texts: DataFrame, signs: DataFrame, bands: int) -> DataFrame:
    """``digest, license, window, words``: the windows that share a minimum with a template.

    Of the places in a window that could retrieve it, the one that gives the first agreeing minimum
    does, so a window comes once (or as often as that shingle is repeated in it).
    """
    places = F.explode(F.sequence(F.lit(0), F.size("words") - SHINGLE))
    shingled = texts.where(F.size("words") >= SHINGLE).select(
        "digest", "words", places.alias("pos")).withColumn(
            "hash", F.xxhash64(*_shingle(F.col("words"), F.col("pos"))))
    # the windows that begin at multiples of the stride and hold the shingle
    low = F.greatest(F.lit(0), F.floor((F.col("pos") - F.col("width") + F.col("stride"))
                                       / F.col("stride")).cast("int"))
    high = F.floor(F.col("pos") / F.col("stride")).cast("int")
    # a text with too few shingles for the containment has no window to look at
    enough = (F.size("words") - SHINGLE + 1) / F.col("size").cast("double") >= CONTAINED
    found = shingled.join(F.broadcast(signs), "hash").where(enough).select(
        "digest", "license", "stride", "width", "own", "sign", low.alias("low"),
        high.alias("high"),
        F.slice("words", low * F.col("stride") + 1,
                (high - low) * F.col("stride") + F.col("width") + SHINGLE - 1).alias("span"))
    words = F.slice("span", (F.col("window") - F.col("low")) * F.col("stride") + 1,
                    F.col("width") + SHINGLE - 1)
    all_bands = F.array(*[F.lit(b) for b in range(bands)])

    def first_agreeing(hashes: Column) -> Column:
        def agrees(b):
            return _minimum(hashes, b) == F.get("sign", b)

        return F.exists("own", lambda b: agrees(b) & ~F.exists(
            all_bands, lambda before: (before < b) & agrees(before)))

    chosen = let(words, lambda w: let(
        F.transform(F.sequence(F.lit(0), F.size(w) - SHINGLE),
                    lambda p: F.xxhash64(*_shingle(w, p))), first_agreeing))
    return found.select("*", F.explode(F.sequence("low", "high")).alias("window")).where(
        chosen).select("digest", "license", "window", words.alias("words"))


def scan(docs: DataFrame, templates: DataFrame | dict[str, str] | None = None,
         id_col: str = "doc_id", text_col: str = "text", bands: int = BANDS) -> DataFrame:
    """``doc_id, matches`` for every row: array of ``license, containment`` sorted by name.

    ``containment`` is the best over the windows that share a minimum with the template, 0.8 or more. Words are runs of ASCII letters
    (A-Z lower-cased), digits and all characters beyond ASCII. Null and empty texts and texts of
    fewer than five words have no match. Repeated rows are scanned each. ``templates`` is a table
    ``license, text`` with one row per license, by default ``template_table``; each needs five
    words.
    """
    session = docs.sparkSession
    if templates is None:
        templates = template_table(session)
    elif isinstance(templates, dict):
        templates = session.createDataFrame(list(templates.items()), "license string, text string")
    parts = stored(parts_of(templates).coalesce(1), "templates")
    signs = stored(signatures(parts, bands).coalesce(1), "signatures")
    blocks = max(1, -(-signs.select("license").distinct().count() // SENT_TEMPLATES))

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    digest = F.md5("text")  # matches hang on the text alone
    texts = rows.select(digest.alias("digest"), _words(F.col("text")).alias("words"))
    block = F.pmod(F.xxhash64("license"), F.lit(blocks))
    windows = reduce(DataFrame.unionAll, [
        _retrieved(texts, signs.where(block == k), bands) for k in range(blocks)])

    # its size is the templates' alone
    known = parts.select("license", "part", "size", F.xxhash64("part").alias("id"))
    if parts.count() <= SENT_PARTS:
        known = F.broadcast(known)
    # one row per shingle and window, then one per window; both with map-side combine
    held = _shingled(windows).join(known, ["license", "part"]).groupBy(
        "digest", "license", "size", "window", "id").agg(F.lit(1).alias("one")).groupBy(
            "digest", "license", "size", "window").agg(F.count("*").alias("held"))
    best = held.groupBy("digest", "license").agg(
        F.max(F.col("held") / F.col("size").cast("double")).alias("containment")).where(
            F.col("containment") >= CONTAINED)
    matches = stored(best.groupBy("digest").agg(
        F.array_sort(F.collect_list(F.struct("license", "containment"))).alias("matches")),
        "matches")
    none = F.array().cast("array<struct<license:string,containment:double>>")
    return rows.select("doc_id", digest.alias("digest")).join(matches, "digest", "left").select(
        "doc_id", F.coalesce("matches", none).alias("matches"))
