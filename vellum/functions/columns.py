"""Column expressions with the same meaning in Spark, in DuckDB and in Python.

White space and digits are written as explicit classes: the shorthand classes of the
three regular expression engines differ.
"""

from __future__ import annotations

import unicodedata

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

WS = r"[\t-\r \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
#: The same characters, for functions that take a list of them.
BLANKS = "\t\n\x0b\x0c\r \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"
DIGITS = r"\p{Nd}+"
WORD = r"[\p{L}\p{Nl}\p{No}]+"


def strip(c: Column) -> Column:
    """Without white space of any kind at both ends; trim() knows only U+0020."""
    return F.btrim(c, F.lit(BLANKS))


def squash(c: Column) -> Column:
    """Stripped, with every run of white space as one plain space."""
    return F.regexp_replace(strip(c), f"{WS}+", " ")


def word_count(c: Column) -> Column:
    """Number of words between white space; 0 for a blank text."""
    return F.when(strip(c) == "", 0).otherwise(F.size(F.split(strip(c), f"{WS}+")))


def masked(c: Column) -> Column:
    """The key under which lines repeat: squashed, lower case, numbers as #."""
    return F.regexp_replace(F.lower(squash(c)), DIGITS, "#")


def solid_length(c: Column) -> Column:
    """Characters that are no white space."""
    return F.length(F.regexp_replace(c, WS, ""))


def tokens(c: Column) -> Column:
    """Lower-case words of letters and letter-like numbers, without combining marks."""
    return F.regexp_extract_all(F.lower(c), F.lit(f"({WORD})"), 1)


def stem(name: Column) -> Column:
    """File name without its last suffix; a leading dot begins no suffix."""
    return F.regexp_replace(name, r"(?<=.)\.[^.]*$", "")


def suffix(name: Column) -> Column:
    """The last suffix in lower case with its dot, or an empty string."""
    return F.lower(F.regexp_extract(name, r".(\.[^./]*)$", 1))


def _composed(texts: pa.Array) -> pa.Array:
    return pa.array([t if t is None or t.isascii() else unicodedata.normalize("NFC", t) for t in texts.to_pylist()], pa.string())


#: A character that composing may change: none of the blocks whose characters all stay as they are.
UNSTABLE = r"[^\x{0}-\x{2FF}\x{1E00}-\x{1EFF}\x{2002}-\x{20CF}\x{2190}-\x{2328}\x{2500}-\x{27FF}]"


def nfc(c: Column) -> Column:
    """Composed letters; the one function on text that Spark has no built-in for. Only texts that may change go through Python."""
    return F.coalesce(F.arrow_udf(_composed, StringType())(F.when(c.rlike(UNSTABLE), c)), c)


def template(text: str, **values: Column) -> Column:
    """A text with {name} filled in from columns; nulls are empty."""
    out = F.lit(text)
    for name, c in values.items():
        out = F.replace(out, F.lit("{" + name + "}"), F.coalesce(c.cast("string"), F.lit("")))
    return out
