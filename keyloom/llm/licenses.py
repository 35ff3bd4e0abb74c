"""License scans by MinHash bands over overlapping windows.

A text is its lower-case words (letters a-z and digits), taken as shingles of ``SHINGLE`` words; a text with
fewer words is one shingle. Windows of ``WINDOW`` shingles, ``STEP`` apart, are hashed into MinHash bands and
retrieve the templates one of whose own windows (at every offset) shares a band. What is retrieved is
verified: the share of the template's different shingles that stand, as texts, within a template's length of
the window must reach ``CONTAINMENT``.

Whole license texts are templates, too. A template of more than ``SECTION`` shingles is cut into sections of about
equal size, and each is retrieved and looked for like a short template. A section counts with what was found at its
best window, and the shares of all its sections together must reach ``CONTAINMENT``; their order does not matter.

Two windows meet in a band only if they share a shingle, so windows without any template shingle are left out
before hashing; nothing is lost by that. ``bands_for`` gives the number of bands for which a window with a
wanted similarity collides with a wanted probability.

Null and empty texts match nothing. Texts are scanned whole, other columns are ignored, an empty table gives an empty
result. Rows with equal id and text count as one. So do templates with equal license and text; several texts of one
license are scanned apart, and the best one counts. A template of fewer than 3 shingles is
found if a window that starts at a multiple of ``STEP`` holds it, with less than the certainty stated below.
Sections are broadcast in blocks of at most ``MAX_TEMPLATE_KEYS`` band keys; every block is a pass over the documents.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from keyloom.llm.common import quoted, written

SHINGLE, WINDOW, STEP, CONTAINMENT, SECTION = 3, 8, 4, 0.75, 64
#: The least similarity of a window that holds a shortest template (3 shingles), and how surely it is found.
SIMILARITY, CERTAINTY = 0.375, 0.9999
#: Band keys broadcast at a time.
MAX_TEMPLATE_KEYS = 200_000

# How licenses are commonly stated.
TEMPLATES = (
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("BSD-2-Clause", "Licensed under the BSD 2-Clause License."),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related rights to this work."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    ("MIT-notice", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
)


def bands_for(similarity: float, certainty: float, rows: int = 1) -> int:
    """The fewest bands of so many rows in which a pair collides with the wanted probability."""
    return math.ceil(math.log(1 - certainty) / math.log(1 - similarity**rows))


BANDS = bands_for(SIMILARITY, CERTAINTY)


def templates(spark: SparkSession, stated=TEMPLATES) -> DataFrame:
    return spark.createDataFrame(list(stated), "license string, template string")


def words(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), "[^a-z0-9]+"), lambda w: w != "")


def shingles(tokens: Column, each) -> Column:
    """``each`` of the words of every shingle, in their order; none for no words."""
    last = F.greatest(F.size(tokens) - (SHINGLE - 1), F.lit(1))
    return F.when(F.size(tokens) == 0, F.array()).otherwise(
        F.transform(F.sequence(F.lit(1), last), lambda i: each(F.slice(tokens, i, F.lit(SHINGLE))))
    )


def band_keys(window: Column) -> Column:
    """The smallest hash of a window under each band's own hash function, with the band's number."""
    smallest = lambda b: F.array_min(F.transform(window, lambda h: F.xxhash64(h, F.lit(b))))
    return F.array(*[F.xxhash64(smallest(b), F.lit(-1 - b)) for b in range(BANDS)])


def windows(hashes: Column, step: int, width: int = WINDOW) -> Column:
    """(start, hashes) of windows ``step`` apart; the last ones may be shorter."""
    starts = F.sequence(F.lit(0), F.greatest(F.size(hashes) - 1, F.lit(0)), F.lit(step))
    return F.transform(starts, lambda s: F.struct(s.alias("start"), F.slice(hashes, s + 1, F.lit(width)).alias("hashes")))


def once(value: Column) -> Column:
    """The value, worked out once per row: a generator, which the optimizer does not copy into its uses."""
    return F.explode_outer(F.array(value))


def sections(known: DataFrame) -> DataFrame:
    """(license, template, n_sections, section, shingles, hashes) of (license, tokens): templates cut into sections, in text order."""
    known = known.filter(F.size("tokens") > 0).dropDuplicates(["license", "tokens"])
    each = known.select(
        "license",
        F.xxhash64("tokens").alias("template"),
        shingles(F.col("tokens"), lambda s: F.concat_ws(" ", s)).alias("every"),
        shingles(F.col("tokens"), F.xxhash64).alias("hashed"),
    )
    parts = F.ceil(F.size("every") / F.lit(SECTION)).cast("int")
    each = each.withColumn("n_sections", parts)
    each = each.withColumn("section", F.explode(F.sequence(F.lit(0), F.col("n_sections") - 1)))
    begin = F.floor(F.size("every") * F.col("section") / F.col("n_sections")).cast("int")
    end = F.floor(F.size("every") * (F.col("section") + 1) / F.col("n_sections")).cast("int")
    return each.select(
        "license",
        "template",
        "n_sections",
        "section",
        F.array_distinct(F.slice("every", begin + 1, end - begin)).alias("shingles"),
        F.slice("hashed", begin + 1, end - begin).alias("hashes"),
    )


def in_blocks(known: DataFrame, most: int) -> DataFrame:
    """Sections with the ``block`` they are in: about ``most`` band keys each, by running totals over the template table."""
    keys = F.size("hashes") * BANDS
    running = F.sum(keys).over(Window.orderBy("license", "template", "section").rowsBetween(Window.unboundedPreceding, -1))
    return known.withColumn("block", F.floor(F.coalesce(running, F.lit(0)) / F.lit(max(1, most - SECTION * BANDS))).cast("int"))


def scan(
    docs: DataFrame,
    stated: DataFrame | None = None,
    text: str = "text",
    id_column: str = "doc_id",
    block_keys: int = MAX_TEMPLATE_KEYS,
) -> DataFrame:
    """(doc_id, text_key, license, containment, n_windows): licenses that a document states, and how completely.

    ``stated`` has (license, template). ``n_windows`` counts the windows around which a section is found as
    completely as a license must be.
    """
    known = templates(docs.sparkSession) if stated is None else stated
    known = sections(known.select("license", words(F.coalesce("template", F.lit(""))).alias("tokens")))
    known = written(in_blocks(known, block_keys), "templates")
    blocks = [r[0] for r in known.select("block").distinct().orderBy("block").collect()]  # one number per pass
    reach = known.agg(F.max(F.size("hashes"))).first()[0] or 1  # of all blocks, so that these change no result
    found = [section_windows(docs, known.filter(F.col("block") == b), reach, text, id_column) for b in blocks or [0]]
    met = found[0]
    for more in found[1:]:
        met = met.unionByName(more)
    sizes = known.groupBy("license", "template").agg(F.sum(F.size("shingles")).alias("_size"))
    best = met.groupBy("doc_id", "text_key", "license", "template", "section").agg(
        F.max("n_found").alias("n_found"), F.count_distinct(F.when(F.col("share") >= CONTAINMENT, F.col("start"))).alias("n_windows")
    )
    whole = best.groupBy("doc_id", "text_key", "license", "template").agg(F.sum("n_found").alias("n_found"), F.sum("n_windows").alias("n_windows"))
    whole = whole.join(sizes, ["license", "template"]).withColumn("containment", F.col("n_found") / F.col("_size"))
    fits = whole.filter(F.col("containment") >= CONTAINMENT)
    pick = F.max(F.struct("containment", "n_windows")).alias("_best")
    return fits.groupBy("doc_id", "text_key", "license").agg(pick).select("doc_id", "text_key", "license", "_best.*")


def section_windows(docs: DataFrame, known: DataFrame, reach: int, text: str, id_column: str) -> DataFrame:
    """(doc_id, text_key, license, template, section, start, n_found, share) of the windows that meet a section in a band."""
    full = F.filter(windows(F.col("hashes"), 1), lambda w: (w["start"] == 0) | (F.size(w["hashes"]) == WINDOW))
    name = ["license", "template", "section"]
    keys = known.select(*name, F.explode_outer(full).alias("w"))
    keys = keys.select(*name, F.explode_outer(band_keys(F.col("w.hashes"))).alias("key")).distinct()
    any_shingle = known.agg(F.array_distinct(F.flatten(F.collect_list("hashes")))).first()[0]
    any_of = F.array(*[F.lit(h) for h in sorted(any_shingle or [0])])

    split = docs.filter(F.length(quoted(text)) > 0).select(
        quoted(id_column).alias("doc_id"), F.xxhash64(quoted(text)).alias("text_key"), once(words(quoted(text))).alias("tokens")
    )
    hashed = split.select("*", once(shingles(F.col("tokens"), F.xxhash64)).alias("hashes"))
    hashed = hashed.filter(F.arrays_overlap("hashes", any_of))
    some = F.filter(windows(F.col("hashes"), STEP), lambda w: F.arrays_overlap(w["hashes"], any_of))
    around = F.transform(
        some,
        lambda w: F.struct(
            w["start"].alias("start"),
            w["hashes"].alias("hashes"),
            F.slice(F.col("tokens"), F.greatest(w["start"] - reach, F.lit(0)) + 1, F.lit(2 * reach + WINDOW + SHINGLE)).alias("near"),
        ),
    )
    spots = hashed.select("doc_id", "text_key", F.explode_outer(around).alias("w")).filter("w is not null")
    spots = spots.select("doc_id", "text_key", "w.start", "w.near", F.explode_outer(band_keys(F.col("w.hashes"))).alias("key"))
    met = spots.join(F.broadcast(keys), "key").drop("key")  # a block has at most MAX_TEMPLATE_KEYS keys
    met = met.dropDuplicates(["doc_id", "text_key", *name, "start"])  # several bands
    met = met.join(F.broadcast(known.select(*name, "n_sections", "shingles")), name)  # of one block
    met = met.withColumn("n_found", F.size(F.array_intersect("shingles", shingles(F.col("near"), lambda s: F.concat_ws(" ", s)))))
    met = met.withColumn("share", F.col("n_found") / F.size("shingles"))
    # A short template is found at one window or not at all.
    met = met.filter((F.col("n_sections") > 1) | (F.col("share") >= CONTAINMENT))
    return met.select("doc_id", "text_key", *name, "start", "n_found", "share")
