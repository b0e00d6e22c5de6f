"""License scans: canonical digests looked up in the digests of known license texts.

A text is brought to a canonical form (case, punctuation, copyright lines, equivalent
spellings, white space), hashed whole, and hash-joined to the digests of known texts. The same
is done for every line of a document as a text of its own, which finds license notices
inside other prose. Only built-in functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wattframe.llm.common import free_name
from wattframe.llm.license_texts import DIGESTS, TEXTS

# fixed values: spellings that count as equal, in lower case, after punctuation is gone
SPELLINGS = {
    "licence": "license",
    "licences": "licenses",
    "licenced": "licensed",
    "sub license": "sublicense",
    "non commercial": "noncommercial",
    "copyright holder": "copyright owner",
    "copyright holders": "copyright owners",
    "favour": "favor",
    "organisation": "organization",
    "acknowledgement": "acknowledgment",
    "wilful": "willful",
    "merchantibility": "merchantability",
    "whilst": "while",
}
# fixed values: license notices, and one license text; whole texts are in ``license_texts``
KNOWN = (
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("MIT", "Released under the MIT License."),
    ("reserved", "All rights reserved."),
    (
        "0BSD",
        "Permission to use, copy, modify, and/or distribute this software for any purpose"
        " with or without fee is hereby granted.\n"
        'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO'
        " THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO"
        " EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL"
        " DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER"
        " IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN"
        " CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
    ),
)
#: Known texts that are broadcast; more of them are joined by shuffle.
BROADCAST_TEXTS = 50_000
COPYRIGHT_LINE = r"(?im)^[ \t]*(?:copyright\b|\(c\)|©).*$"


def canonical(text: Column) -> Column:
    """``text`` without copyright lines, in lower case, words by single spaces, one spelling.

    A null stays null; a text without words becomes empty.
    """
    words = F.regexp_replace(text, COPYRIGHT_LINE, " ")
    words = F.trim(F.regexp_replace(F.lower(words), r"[^\p{L}\p{N}]+", " "))

    def spelled(form: Column) -> Column:
        found, changed = F.lit(False), form
        for old, new in SPELLINGS.items():
            found = found | F.contains(form, F.lit(old))
            changed = F.regexp_replace(changed, rf"\b{old}\b", new)
        return F.when(found, changed).otherwise(form)

    return _once(words, spelled)


def _once(value: Column, use) -> Column:
    """``use(value)``, with the value computed once however often it is used."""
    return F.element_at(F.transform(F.array(value), use), 1)


def canonical_digest(text: Column) -> Column:
    """SHA-256 of the canonical form; null where that is empty."""
    return _once(canonical(text), lambda form: F.when(form != "", F.sha2(form.cast("binary"), 256)))


def known_table(spark: SparkSession, known=KNOWN + TEXTS, digests=DIGESTS) -> DataFrame:
    """Known texts, and texts known by their digest only, as rows (license, digest), one per digest,
    broadcast while they are few."""
    if not known and not digests:
        return spark.createDataFrame([], "license string, digest string")

    def rows(pairs, name: str) -> DataFrame:
        structs = [F.struct(F.lit(k).alias("license"), F.lit(t).alias(name)) for k, t in pairs]
        kind = f"array<struct<license:string,{name}:string>>"
        return spark.range(1).select(F.inline(F.array(*structs).cast(kind)))

    table = rows(known, "body").select("license", canonical_digest(F.col("body")).alias("digest"))
    table = table.unionAll(rows(digests, "digest").select("license", "digest"))
    table = table.groupBy("digest").agg(F.min("license").alias("license"))
    table = table.filter("digest is not null")
    return F.broadcast(table) if len(known) + len(digests) <= BROADCAST_TEXTS else table


def scan_licenses(
    docs: DataFrame, known: DataFrame, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row per row of ``docs``: its id, ``license`` of the whole text or null,
    ``n_license_lines`` and ``line_licenses`` (sorted distinct names found in lines).

    Null and empty texts, and lines without words, match nothing. Rows that share an id share
    the lines found under that id; rows with a null id only have their whole text looked up.
    An empty table gives no rows. Other columns of ``docs`` are not read.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    whole = known.select(F.col("digest"), F.col("license"))
    line = F.explode(F.split("text", r"\r\n|\n|\r", -1)).alias("line")
    lines = rows.filter("doc_id is not null and text is not null").select("doc_id", line)
    found = (
        lines.withColumn("digest", canonical_digest(F.col("line")))
        .join(whole, "digest")
        .groupBy("doc_id")
        .agg(
            F.count("*").alias("n_license_lines"),
            F.array_sort(F.collect_set("license")).alias("line_licenses"),
        )
    )
    found = found.withColumnRenamed("doc_id", free_name(rows.columns, "found_id"))
    return (
        rows.select("doc_id", canonical_digest(F.col("text")).alias("digest"))
        .join(whole, "digest", "left")
        .join(found, F.col("doc_id") == F.col("found_id"), "left")
        .select(
            "doc_id",
            "license",
            F.coalesce("n_license_lines", F.lit(0).cast("long")).alias("n_license_lines"),
            F.coalesce("line_licenses", F.array().cast("array<string>")).alias("line_licenses"),
        )
    )
