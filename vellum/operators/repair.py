"""Legacy font encodings and uncomposed accents in stored units, repaired or only reported.

The VNI decoder writes every character of a text once, batch by batch over Arrow; only
texts with evidence of VNI, or that composing may change, are sent to it.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from vellum.functions import text as text_functions
from vellum.functions.columns import UNSTABLE, nfc, strip, word_count
from vellum.functions.text import VNI_PAIRS  # noqa: F401  the chart, for SQL

#: Letters that only VNI text has, and letters that only Unicode text has.
VNI_LETTERS = "[öÖøØûÛïÏäÄåÅñÑëËüÜæÆ]"
UNICODE_LETTERS = "[Ạ-ỹăĂđĐơƠưƯ]"
EVIDENCE = "[aeiouyAEIOUYôÔöÖ][øûïäåëüØÛÏÄÅËÜ]"


def has_vni_evidence(c: Column) -> Column:
    """A vowel directly followed by a letter that modifies it in VNI."""
    return c.rlike(EVIDENCE)


def looks_vni(c: Column) -> Column:
    return c.rlike(VNI_LETTERS)


def looks_unicode(c: Column) -> Column:
    return c.rlike(UNICODE_LETTERS)


_EVIDENCE, _VNI, _UNICODE = map(re.compile, (EVIDENCE, VNI_LETTERS, UNICODE_LETTERS))
_PIECES = re.compile(r"(\s+)")


def converted(text: str) -> str:
    """VNI decoded in the widest scope that is all VNI: the text, else a line, else a word."""
    if not _EVIDENCE.search(text):
        return text
    if not _UNICODE.search(text):
        return text_functions.decode_vni(text)

    def word(w: str) -> str:
        return text_functions.decode_vni(w) if _EVIDENCE.search(w) or _VNI.search(w) else w

    def line(x: str) -> str:
        if not _EVIDENCE.search(x):
            return x
        return "".join(map(word, _PIECES.split(x))) if _UNICODE.search(x) else text_functions.decode_vni(x)

    return "\n".join(map(line, text.split("\n")))


def _each(f):
    return lambda texts: pa.array([None if t is None else f(t) for t in texts.to_pylist()], pa.string())


def decode_vni(c: Column) -> Column:
    """Every character merged at most once into the one written before it, from left to right."""
    return F.arrow_udf(_each(text_functions.decode_vni), StringType())(c)


def convert(c: Column) -> Column:
    """converted() of a column; texts without evidence stay in the JVM."""
    return F.coalesce(F.arrow_udf(_each(converted), StringType())(F.when(has_vni_evidence(c), c)), c)


def repaired(units: DataFrame) -> DataFrame:
    """Units with `fixed`: converted and composed, texts of scans untouched. Only rows that can change pass through Python."""
    own = ~F.coalesce("ocr", F.lit(False)) & F.col("text").isNotNull()
    may = own & (has_vni_evidence(F.col("text")) | F.col("text").rlike(UNSTABLE))
    changed = units.where(F.coalesce(may, F.lit(False))).withColumn("fixed", nfc(convert(F.col("text"))))
    return units.where(~F.coalesce(may, F.lit(False))).withColumn("fixed", F.col("text")).unionByName(changed)


def repair_report(units: DataFrame) -> DataFrame:
    """(doc, changed, residue, safe): units that a repair rewrites, units that still look like VNI after it, and whether the document may be rewritten at all.

    A repair may not empty a unit nor change the number of its words.
    """
    rows = repaired(units)
    own = ~F.coalesce("ocr", F.lit(False))
    intact = (strip(F.col("fixed")) != "") & (word_count(F.col("fixed")) == word_count(F.col("text")))
    return rows.groupBy("doc").agg(
        F.count_if(own & (F.col("fixed") != F.col("text"))).alias("changed"),
        F.count_if(own & looks_vni(F.col("fixed"))).alias("residue"),
        F.min(~own | F.coalesce(intact, F.lit(False))).alias("safe"),
    )


def apply_repair(units: DataFrame) -> DataFrame:
    """Units after the repair; documents that are not safe stay as they are. Running it again changes nothing."""
    safe = repair_report(units).where("safe and changed > 0").select("doc", F.lit(True).alias("_fix"))
    rows = repaired(units).join(safe, "doc", "left")
    return rows.withColumn("text", F.when(F.col("_fix"), F.col("fixed")).otherwise(F.col("text"))).select(*units.columns)
