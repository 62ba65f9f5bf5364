"""Licence scan by canonical digest lookup.

A text is brought to a canonical form (lower case; copyright lines dropped;
equivalent spellings unified; punctuation and white space as single spaces)
and looked up by the SHA-256 of that form among known licences.  The units
looked up are whole: the entire document, each run of consecutive paragraphs
and each line.

Scale: documents are read once and stay in the JVM.  The known digests are a
fixed, bounded list, so they reach every task as an inline table; no text is
shuffled, only one row per document and per match.  All steps are DataFrame
expressions.
"""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from logloom.llm.common import ROW_ID, stored, with_row_id

# Spellings that mean the same, (from, to), in order of use.
EQUIVALENT = [
    ("&", " and "), ("©", "copyright"), ("(c)", "copyright"), ("https://", "http://"),
    ("acknowledgement", "acknowledgment"), ("analogue", "analog"), ("analyse", "analyze"),
    ("artefact", "artifact"), ("authoris", "authoriz"), ("cancelled", "canceled"),
    ("catalogue", "catalog"), ("centre", "center"), ("copyright owner", "copyright holder"),
    ("favour", "favor"), ("fulfilment", "fulfillment"), ("initialis", "initializ"),
    ("judgement", "judgment"), ("labelled", "labeled"), ("licence", "license"),
    ("merchantibility", "merchantability"), ("modelling", "modeling"),
    ("non-commercial", "noncommercial"), ("offence", "offense"), ("organis", "organiz"),
    ("per cent", "percent"), ("programme", "program"), ("recognis", "recogniz"),
    ("sub-license", "sublicense"), ("utilis", "utiliz"), ("whilst", "while"),
    ("wilful", "willful"),
]

# Known licences, (id, text); texts as published.
_MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE
SOFTWARE."""
_ISC = """Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH
REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY
AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM
LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR
OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR
PERFORMANCE OF THIS SOFTWARE."""
_ZLIB = """This software is provided 'as-is', without any express or implied
warranty. In no event will the authors be held liable for any damages
arising from the use of this software.

Permission is granted to anyone to use this software for any purpose,
including commercial applications, and to alter it and redistribute it
freely, subject to the following restrictions:

1. The origin of this software must not be misrepresented; you must not
claim that you wrote the original software. If you use this software
in a product, an acknowledgment in the product documentation would be
appreciated but is not required.
2. Altered source versions must be plainly marked as such, and must not be
misrepresented as being the original software.
3. This notice may not be removed or altered from any source distribution."""
KNOWN = [
    ("MIT", _MIT),
    ("MIT", "MIT License\n\n" + _MIT),
    ("MIT", "The MIT License (MIT)\n\n" + _MIT),
    ("ISC", _ISC),
    ("ISC", "ISC License\n\n" + _ISC),
    ("Zlib", _ZLIB),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Released under the Apache License, Version 2.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("LGPL-3.0", "Licensed under the GNU Lesser General Public License, version 3."),
    ("MPL-2.0", "Licensed under the Mozilla Public License, Version 2.0."),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("CC0-1.0", "Released under CC0 1.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
]
#: Start and end (not included) of the notices that licences give for use in
#: files, and the end of the terms where an appendix follows.
HEADERS = [
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License");', None),
    ("GPL-2.0", "This program is free software;", "Also add information on"),
    ("GPL-3.0", "This program is free software:", "Also add information on"),
    ("LGPL-2.1", "This library is free software;", "Also add information on"),
    ("MPL-2.0", "This Source Code Form is subject to the terms", "If it is not possible"),
]
END_OF_TERMS = "END OF TERMS AND CONDITIONS"
#: Leading canonical characters by which the start of a known text is found.
LEAD = 8


def published_texts() -> list[tuple[str, str]]:
    """``(license, text)`` of the shipped whole texts (``licenses/<id>.txt``),
    without their appendix too, and of their notices for files."""
    whole = {p.stem: p.read_text("utf-8") for p in sorted((Path(__file__).parent / "licenses").glob("*.txt"))}
    out = list(whole.items())
    out += [(i, t[:t.index(END_OF_TERMS) + len(END_OF_TERMS)]) for i, t in whole.items() if END_OF_TERMS in t]
    for i, start, end in HEADERS:
        at = whole[i].index(start)
        out.append((i, whole[i][at:whole[i].index(end, at) if end else None]))
    return out


#: Lines that only say who holds the copyright.
COPYRIGHT_LINE = r"(?m)^[^\p{L}\p{N}\n]*(copyright[^\p{L}\n]*[0-9]|copyright by |copyright copyright|all rights reserved)[^\n]*$"
NOT_WORD = r"[^\p{L}\p{N}\n]+"


def canonical_lines(text: Column) -> Column:
    """Canonical form that still has its line ends."""
    t = F.lower(F.replace(F.replace(text, F.lit("\r\n"), F.lit("\n")), F.lit("\r"), F.lit("\n")))
    for a, b in EQUIVALENT:
        t = F.replace(t, F.lit(a), F.lit(b))
    t = F.when(F.contains(t, F.lit("copyright")) | F.contains(t, F.lit("all rights reserved")),
               F.regexp_replace(t, COPYRIGHT_LINE, "")).otherwise(t)
    return F.regexp_replace(t, NOT_WORD, " ")


def _one_line(t: Column) -> Column:
    return F.trim(F.regexp_replace(t, r"[ \n]+", " "))


def canonical(text: Column) -> Column:
    return _one_line(canonical_lines(text))


def _leads(lead: str, length: int) -> set[str]:
    """What a paragraph that starts a text with these first characters may start
    with: all of them, or fewer whole words if the paragraph ends there."""
    return {lead} | {lead[:n] for n in range(1, min(LEAD, length)) if lead[n] == " "}


def known_table(spark: SparkSession, known) -> DataFrame:
    """``license, digest, length, lead`` of the canonical known texts; null and
    empty ones are none."""
    df = known if isinstance(known, DataFrame) else spark.createDataFrame(
        list(known), "license string, text string")
    c = canonical(F.col("text"))
    return df.select("license", F.sha2(c, 256).alias("digest"), F.char_length(c).alias("length"),
                     F.substring(c, 1, LEAD).alias("lead")).where(
        F.col("license").isNotNull() & (F.col("length") > 0)).distinct()


def known_digests(spark: SparkSession, known=KNOWN) -> list[tuple[str, str, int]]:
    """``(license, digest, length)`` of the canonical known texts."""
    return sorted({tuple(r) for r in known_table(spark, known).select("license", "digest", "length").collect()})


def running_ends(sizes: Column, block: int = 256) -> Column:
    """0 and the running sums of an array of sizes.  A fold copies the array it
    appends to, so it only runs within blocks and over the blocks' sums."""
    def sums(xs: Column, start: Column) -> Column:
        return F.aggregate(xs, F.array(start), lambda a, x: F.concat(a, F.array(F.element_at(a, -1) + x)))
    blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(sizes) - 1) / block).cast("int")),
                         lambda b: F.slice(sizes, b * block + 1, F.lit(block)))
    zero = F.lit(0)
    starts = sums(F.transform(blocks, lambda xs: F.aggregate(xs, zero, lambda a, x: a + x)), zero)
    ends = F.flatten(F.transform(blocks, lambda xs, i: F.slice(
        sums(xs, F.get(starts, i)), F.lit(2), F.lit(block))))
    return F.when(F.size(sizes) > 0, F.concat(F.array(zero), ends)).otherwise(F.array(zero))


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  known: DataFrame | list[tuple[str, str]] | None = None) -> DataFrame:
    """One row per input row: ``__row_id, id, text_sha256, whole, licenses, n_units``.

    ``text_sha256`` is the digest of the canonical whole text; ``whole`` the
    licence that the entire text is (else null); ``licenses`` the sorted ids
    found in the text, comma-joined (empty: none); ``n_units`` the number of
    distinct units (whole, runs of paragraphs, lines) that are known.  A null
    or empty text, and one that is only punctuation, has no licence.

    ``known`` is a table of ``license, text``, or a list; without it ``KNOWN``
    and ``published_texts``.  Their digests are joined as the planner sees fit;
    only their distinct lengths and first ``LEAD`` characters reach the driver.
    """
    spark = docs.sparkSession
    table = stored(known_table(spark, KNOWN + published_texts() if known is None else known).coalesce(1),
                   "known_licenses")
    lookup = table.select("license", "digest").distinct()
    lengths = sorted(r[0] for r in table.select("length").distinct().collect()) or [0]
    leads = sorted(set().union(*(_leads(r[0], r[1]) for r in table.select("lead", "length").distinct().collect()))) \
        or ["\n"]

    lines = canonical_lines(F.col("text"))
    rows = with_row_id(docs, id_col, text_col).select(ROW_ID, "id", lines.alias("lines"))
    whole = _one_line(F.col("lines"))
    parts = F.concat(F.split("lines", r"\n[ \n]*\n"), F.split("lines", r"\n"))
    # a unit can only equal a known text of the same length
    units = F.array_distinct(F.filter(
        F.transform(F.filter(parts, lambda u: F.char_length(u) <= 4 * max(lengths)), _one_line),
        lambda u: F.char_length(u).isin(lengths)))
    paragraphs = F.filter(F.transform(F.split("lines", r"\n[ \n]*\n"), _one_line), lambda u: u != "")
    rows = rows.select(ROW_ID, "id", whole.alias("whole_text"), units.alias("units"),
                       paragraphs.alias("paragraphs"))
    # where paragraphs start that may start a known text, and where all end, as
    # places in the whole text (its paragraphs joined by one space)
    ends = running_ends(F.transform("paragraphs", lambda u: F.char_length(u) + 1))
    begins = F.exists("paragraphs", lambda u: F.substring(u, 1, LEAD).isin(leads))
    rows = rows.select(ROW_ID, "id", "whole_text", "units", "paragraphs",
                       F.when(begins, ends).alias("ends"))
    starts = F.filter(F.transform("paragraphs", lambda u, i: F.when(
        F.substring(u, 1, LEAD).isin(leads), F.get("ends", i))), lambda s: s.isNotNull())
    sizes = F.array(*[F.lit(n) for n in lengths])
    runs = F.flatten(F.transform(starts, lambda s: F.transform(
        F.filter(sizes, lambda n: F.array_contains("ends", s + n + 1)),
        lambda n: F.substring("whole_text", s + 1, n))))
    rows = rows.select(ROW_ID, "id", "whole_text", F.when(
        F.col("ends").isNotNull(), F.array_union("units", runs)).otherwise(F.col("units")).alias("units"))
    rows = rows.select(ROW_ID, "id", F.explode(F.concat(
        F.array(F.struct(F.lit(True).alias("whole"), F.sha2("whole_text", 256).alias("digest"))),
        F.transform(F.array_except("units", F.array("whole_text")),
                    lambda u: F.struct(F.lit(False).alias("whole"), F.sha2(u, 256).alias("digest"))),
    )).alias("u"))
    hit = rows.select(ROW_ID, "id", "u.whole", "u.digest").join(
        lookup, "digest", "left").where(F.col("whole") | F.col("license").isNotNull())
    return hit.groupBy(ROW_ID).agg(
        F.first("id").alias("id"),
        F.max(F.when(F.col("whole"), F.col("digest"))).alias("text_sha256"),
        F.max(F.when(F.col("whole"), F.col("license"))).alias("whole"),
        F.array_join(F.array_sort(F.collect_set("license")), ",").alias("licenses"),
        F.count("license").alias("n_units"))
