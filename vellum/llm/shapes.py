"""Characters that look alike, print nothing or are other spaces: the tables that bring text to plain form."""

from __future__ import annotations

import re
import unicodedata

#: Printed alike in upright type: Cyrillic, Greek and extended Latin letters with the Latin letter they pass for (fixed values).
LOOKALIKE = dict(
    zip(
        "аеорсухіјѕԁһԛԝɡ" "АВЕКМНОРСТХІЈЅУ" "ουνικρτγαχ" "ΑΒΕΖΗΙΚΜΝΟΡΤΥΧ" "ðÐƉ",
        "aeopcyxijsdhqwg" "ABEKMHOPCTXIJSY" "ouvikptyax" "ABEZHIKMNOPTYX" "đĐĐ",
        strict=True,
    )
)
#: Print nothing: zero-width characters, joiners, direction marks, soft hyphen, byte order mark.
IGNORABLE = "­͏؜᠎​‌‍‎‏‪‫‬‭‮⁠⁡⁢⁣⁤﻿"
#: Spaces other than the plain one.
SPACES = "               　"
#: Plain width for full-width forms; superscripts and other compatibility characters stay.
WIDTH = {chr(c + 0xFEE0): chr(c) for c in range(0x21, 0x7F)}

_PLAIN = str.maketrans(WIDTH | dict.fromkeys(SPACES, " ") | dict.fromkeys(IGNORABLE))
_ALIKE = str.maketrans(LOOKALIKE)
_HAS_ALIKE = re.compile("[" + "".join(LOOKALIKE) + "]")
_ODD = re.compile("[^\x00-\x7fÀ-ÖØ-öø-ƿḀ-ỿ]")


def plain_shape(text: str) -> str:
    """Composed letters, plain width, plain spaces, nothing invisible; look-alikes of other scripts stay."""
    if text.isascii():
        return text
    if _ODD.search(text) or not unicodedata.is_normalized("NFC", text) or " " in text or "­" in text:
        return unicodedata.normalize("NFC", text.translate(_PLAIN))
    return text


def latin_shape(text: str) -> str:
    """plain_shape with every look-alike replaced, whatever the word: for comparing, not for keeping."""
    if text.isascii():
        return text
    text = plain_shape(text)
    return text.translate(_ALIKE) if _HAS_ALIKE.search(text) else text
