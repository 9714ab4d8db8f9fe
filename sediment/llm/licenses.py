"""License scans: canonical digests of texts, looked up among those of known licences.

A text is brought to one form: lower case, copyright lines out, equivalent spellings made one, all else but letters and digits
a space. Its digest is joined with the digests of the known licences, so only whole texts match. A document is
looked up as a whole, and each of its lines too, as notices stand on a line of their own. Texts and headers of several lines are looked
up wherever they begin in a document, however its lines are broken: the piece of a known text's length from there is digested too.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sediment.llm.license_blocks import DIGESTS, TEXTS
from sediment.llm.words import text_key, whole

# Licence names and notice texts as their stewards publish them.
KNOWN = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "This project is licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "This project is licensed under the MIT License."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("BSD-3-Clause", "SPDX-License-Identifier: BSD-3-Clause"),
    ("BSD-2-Clause", "Licensed under the BSD 2-Clause License."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "Licensed under the GNU General Public License v3."),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0-only"),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-2.0", "SPDX-License-Identifier: GPL-2.0-only"),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC0-1.0", "Licensed under CC0 1.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0."),
    ("proprietary", "All rights reserved."),
)
# Spellings that mean the same, applied in order to text in lower case.
EQUIVALENT = (
    ("licence", "license"),
    ("sub license", "sublicense"),
    ("creative commons attribution", "cc by"),
    ("noncommercial", "non-commercial"),
    ("non-commercial", "nc"),
    ("sharealike", "sa"),
    ("organisation", "organization"),
    ("copyright holder", "copyright owner"),
    ("https:", "http:"),
)
COPYRIGHT_LINE = r"(^|\n)[ \t]*(copyright|\(c\)|©)[^\n]*"
VERSION = r"\b(version|ver|v)[. ]*([0-9])"
REST = r"[^a-z0-9\x{80}-\x{10FFFF}]+"


def canonical(text: Column) -> Column:
    """The text in its one form; empty if nothing is left."""
    out = F.regexp_replace(F.lower(whole(text)), COPYRIGHT_LINE, " ")
    for one, other in EQUIVALENT:
        out = F.replace(out, F.lit(one), F.lit(other))
    out = F.regexp_replace(out, VERSION, "$2")
    return F.trim(F.regexp_replace(out, REST, " "))


# In the flowing form, where words are one space apart, typographic marks are no letters, and wrapped lines may begin with "copyright" or "(c)".
FLOWING = tuple((one.replace("-", " "), other.replace("-", " ")) for one, other in EQUIVALENT[:-1]) + ((" https ", " http "),)
OWNER_LINE = r"(^|\n)[^a-z0-9\n(©]*(copyright[ \t:]*(\(c\)|©|[0-9]|by\b|[<\[{])|\(c\)[ \t]*(copyright|[0-9])|©)[^\n]*"
FLOWING_VERSION = r"\b(version|ver|v) ?([0-9])"
FLOWING_REST = r"[^a-z0-9\x{C0}-\x{1FFF}\x{2070}-\x{10FFFF}]+"
# Every known block has one of these; its first and last characters find it.
GUARDS = ("licen", "permi")
EDGE = 40


def flowing(text: Column) -> Column:
    """The text in one form that does not depend on its line breaks, between spaces."""
    out = F.regexp_replace(F.lower(whole(text)), OWNER_LINE, " ")
    out = F.concat(F.lit(" "), F.regexp_replace(out, FLOWING_REST, " "), F.lit(" "))
    for one, other in FLOWING:
        out = F.replace(out, F.lit(one), F.lit(other))
    out = F.regexp_replace(out, FLOWING_VERSION, "$2")
    return F.concat(F.lit(" "), F.trim(out), F.lit(" "))


def known_blocks(spark: SparkSession, texts=TEXTS, digests=DIGESTS) -> list[tuple[str, str, str, int, str]]:
    """(license, opening, end, length, digest) of the texts and of what is given so; as long as its source."""
    form = F.trim(flowing(F.col("text")))
    rows = spark.createDataFrame(list(texts), "license string, text string").select("license", form.alias("form"))
    edges = F.substring("form", 1, EDGE), F.expr(f"right(form, {EDGE})")
    made = rows.select("license", *edges, F.char_length("form"), F.sha2("form", 256)).distinct().collect()
    return [*(tuple(r) for r in made), *digests]


def blocks_of(text: Column, blocks: list[tuple[str, str, str, int, str]]) -> Column:
    """(`unit`, `full`: whether it is all) of each piece of the flowing text that begins, ends and is as long as a known block; the digest has the say."""
    shapes = sorted({(opening, end, n) for _, opening, end, n, _ in blocks})
    patterns = (
        F.struct(F.lit(f" {opening}").alias("opening"), F.lit(rf"(?= ({opening}.{{{n - len(opening) - len(end)}}}{end}) )").alias("pattern"))
        for opening, end, n in shapes
    )
    known = F.array(*patterns)

    def pieces(f: Column) -> Column:
        here = F.filter(known, lambda b: F.contains(f, b.opening))
        found = F.flatten(F.transform(here, lambda b: F.regexp_extract_all(f, b.pattern, F.lit(1))))
        return F.transform(found, lambda x: F.struct(x.alias("unit"), (F.char_length(x) + 2 == F.char_length(f)).alias("full")))

    guarded = F.lit(False)
    for word in GUARDS:
        guarded |= F.contains(F.lower(text), F.lit(word))
    # Bound once, as an array of one.
    found = F.flatten(F.transform(F.array(flowing(text)), pieces))
    return F.when(guarded, found).otherwise(F.array().cast("array<struct<unit:string,full:boolean>>"))


def known_digests(spark: SparkSession, known=KNOWN) -> DataFrame:
    """`license`, `digest` of a list of known texts, which is as long as its source and so may be broadcast."""
    rows = spark.createDataFrame(list(known), "license string, text string")
    return rows.select("license", F.sha2(canonical(F.col("text")), 256).alias("digest")).distinct()


def scan_licenses(docs: DataFrame, known: DataFrame | None = None, doc: str = "doc_id", text: str = "text", blocks: list[tuple[str, str, str, int, str]] | None = None) -> DataFrame:
    """One row per document: `doc_id`, `whole_licenses` and `line_licenses` (sorted, comma-joined), `n_lines` matched, `licensed`.

    A block of lines is among `line_licenses`, and among `whole_licenses` if the document is nothing else; `n_lines` counts lines that
    match by themselves. Lists are empty texts where nothing matches; a null or empty text matches nothing, and neither does a line with
    nothing but punctuation or a copyright line; repeated rows give a row each.
    `known` (`license`, `digest`) is broadcast and defaults to KNOWN; `blocks` are those of known_blocks(), by default all.
    """
    spark = docs.sparkSession
    known = known_digests(spark) if known is None else known
    blocks = known_blocks(spark) if blocks is None else blocks
    listed = spark.createDataFrame([(b[0], b[-1]) for b in blocks], "license string, digest string").distinct()
    both = known.select("license", "digest", F.lit(False).alias("block")).unionByName(listed.withColumn("block", F.lit(True)))
    t = F.col(text).cast("string")
    given = docs.select(F.col(doc).alias("doc_id"), text_key(t).alias("text_key"), whole(t).alias("text"))

    def plain(some: Column) -> Column:
        return F.transform(some, lambda x: F.struct(x.alias("unit"), F.lit(None).cast("boolean").alias("full")))

    # Place 0 is the whole text and stays without a match; the lines follow, then blocks.
    split = plain(F.concat(F.array("text"), F.split("text", "\n", -1)))
    units = given.select("doc_id", "text_key", F.posexplode(F.concat(split, blocks_of(F.col("text"), blocks))).alias("no", "u"))
    block = F.col("u.full").isNotNull()
    form = units.select("doc_id", "text_key", "no", "u.full", block.alias("block"), F.when(block, F.col("u.unit")).otherwise(canonical(F.col("u.unit"))).alias("form"))
    digests = form.select("doc_id", "text_key", "no", "full", "block", F.when(F.col("form") != "", F.sha2("form", 256)).alias("digest"))
    found = digests.join(F.broadcast(both), ["digest", "block"], "left").where((F.col("no") == 0) | F.col("license").isNotNull())
    first = F.col("no") == 0
    # A text may match several known licences of one digest; its own row counts once.
    per_doc = found.groupBy("doc_id", "text_key", "no", "block", "full").agg(F.collect_set("license").alias("ls"), F.count(F.lit(1)).alias("n"))
    per_doc = per_doc.groupBy("doc_id", "text_key").agg(
        F.max(F.when(first, F.col("n") / F.greatest(F.size("ls"), F.lit(1)))).cast("long").alias("copies"),
        F.array_distinct(F.flatten(F.collect_list(F.when(first | F.col("full"), F.col("ls"))))).alias("whole"),
        F.array_distinct(F.flatten(F.collect_list(F.when(~first, F.col("ls"))))).alias("lines"),
        F.count(F.when(~first & ~F.col("block"), 1)).alias("n_lines"),
    )
    return per_doc.select(
        "doc_id",
        F.array_join(F.array_sort("whole"), ",").alias("whole_licenses"),
        F.array_join(F.array_sort("lines"), ",").alias("line_licenses"),
        "n_lines",
        ((F.size("whole") > 0) | (F.size("lines") > 0)).alias("licensed"),
        F.explode(F.sequence(F.lit(1).cast("long"), "copies")).alias("_copy"),
    ).drop("_copy")
