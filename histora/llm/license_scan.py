"""Licence scan by canonical digest: canonicalise an entire text, hash it, look the digest up.

Canonical form: A-Z lower-cased, lines of a copyright notice dropped, equivalent spellings made one,
every run of white space and punctuation turned into one space, ends trimmed. Two texts that differ only
in these respects share a digest. The digest of the whole document is joined to the digests of the known
licence texts and notices (a list of fixed length, hence broadcast), and so is the digest of each line, so
that a notice standing on its own line is found inside other prose.

Defined cases: null and empty texts, and texts that are nothing but a copyright notice or punctuation,
have the digest of the empty string, no licence and no notices. Repeated rows give repeated results;
columns other than id and text are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from histora.llm.license_texts import NOTICES, TEXTS

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_COPYRIGHT_LINE = r"(?:^|\n)[^0-9a-z\n]*(?:copyright|\(c\)|©)[^\n]*"
# Typographic punctuation that counts as white space, and separators of other scripts' typography.
_TYPOGRAPHIC = " ‘’“”–—…®™«»•"
_SEPARATORS = r"[\x00-/:-`{-\x7f]+"

# Spellings that count as one (written as they stand in the canonical form).
SPELLINGS = (
    ("licence", "license"),
    ("sub license", "sublicense"),
    ("non infringement", "noninfringement"),
    ("non commercial", "noncommercial"),
    ("merchantibility", "merchantability"),
    ("acknowledgement", "acknowledgment"),
    ("organisation", "organization"),
    ("recognise", "recognize"),
    ("favour", "favor"),
    ("judgement", "judgment"),
    ("wilful", "willful"),
    ("fulfil ", "fulfill "),
    ("whilst", "while"),
    ("http ", "https "),
)


def canonical(text: Column) -> Column:
    """The canonical form of an entire text."""
    t = F.translate(F.coalesce(text, F.lit("")), _UPPER, _UPPER.lower())
    t = F.regexp_replace(t, _COPYRIGHT_LINE, F.lit("\n"))
    t = F.translate(t, _TYPOGRAPHIC, " " * len(_TYPOGRAPHIC))
    t = F.trim(F.regexp_replace(t, _SEPARATORS, " "))
    for spelling, canon in SPELLINGS:
        t = F.replace(t, F.lit(spelling), F.lit(canon))
    return t


def digest(text: Column) -> Column:
    return F.sha2(canonical(text), 256)


def known_licenses(spark: SparkSession) -> DataFrame:
    """(digest, license): one row for each known text or notice, a list of fixed length."""
    rows = [(t, name) for name, t in TEXTS.items()] + list(NOTICES.items())
    return (spark.createDataFrame(rows, "text string, license string")
            .groupBy(digest(F.col("text")).alias("digest")).agg(F.min("license").alias("license")))


def scan_licenses(docs: DataFrame, known: DataFrame | None = None, *, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """Per row: doc_id, digest of the whole text, its license (or null), the sorted licences of its lines.

    ``known`` (digest, license) must be small enough to broadcast; by default the list of this module.
    """
    known = known_licenses(docs.sparkSession) if known is None else known
    lines = F.broadcast(known.agg(F.map_from_entries(
        F.collect_list(F.struct("digest", "license"))).alias("_by_digest")))
    whole = F.broadcast(known.select(F.col("digest"), F.col("license")))
    # A line can only be a notice if it has a word of one; the test spares other lines the digest.
    notice = F.filter(F.split(F.coalesce("_text", F.lit("")), r"\n"),
                      lambda x: x.rlike(r"(?i)licen[sc]e|spdx|cc by"))
    found = F.array_sort(F.array_distinct(F.array_compact(
        F.transform(notice, lambda x: F.element_at("_by_digest", digest(x))))))
    return (docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("_text"))
            .join(lines, F.lit(True), "left")
            .select("doc_id", digest(F.col("_text")).alias("digest"), found.alias("_found"))
            .join(whole, "digest", "left")
            .select("doc_id", "digest", "license", F.array_join("_found", ",").alias("notices"),
                    F.size("_found").cast("bigint").alias("n_notices")))


def _sql_text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _sql_canonical(text: str) -> str:
    t = f"translate(coalesce({text}, ''), '{_UPPER}', '{_UPPER.lower()}')"
    t = f"regexp_replace({t}, {_sql_text(_COPYRIGHT_LINE)}, chr(10), 'g')"
    t = f"translate({t}, {_sql_text(_TYPOGRAPHIC)}, {_sql_text(' ' * len(_TYPOGRAPHIC))})"
    t = f"trim(regexp_replace({t}, {_sql_text(_SEPARATORS)}, ' ', 'g'))"
    for spelling, canon in SPELLINGS:
        t = f"replace({t}, '{spelling}', '{canon}')"
    return t


def license_oracle() -> str:
    """DuckDB SQL for ``scan_licenses`` over ``documents``."""
    rows = [(t, name) for name, t in TEXTS.items()] + list(NOTICES.items())
    values = ", ".join(f"({_sql_text(t)}, '{name}')" for t, name in rows)
    return f"""
WITH raw(text, license) AS (VALUES {values}),
known AS (SELECT sha256({_sql_canonical('text')}) AS digest, min(license) AS license FROM raw GROUP BY 1),
lines AS (SELECT DISTINCT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents),
hits AS (SELECT DISTINCT l.doc_id, k.license FROM lines l JOIN known k ON sha256({_sql_canonical('l.line')}) = k.digest),
per_doc AS (SELECT doc_id, string_agg(license, ',' ORDER BY license) AS notices, count(*) AS n FROM hits GROUP BY 1),
whole AS (SELECT doc_id, sha256({_sql_canonical('text')}) AS digest FROM documents)
SELECT w.doc_id, w.digest, k.license, coalesce(p.notices, '') AS notices, coalesce(p.n, 0)::BIGINT AS n_notices
FROM whole w LEFT JOIN known k ON w.digest = k.digest LEFT JOIN per_doc p ON w.doc_id = p.doc_id"""
