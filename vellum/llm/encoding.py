"""Problem 6: text decoded with the wrong character encoding.

Round-trip repair, word by word: a word is written back to bytes under each legacy
encoding it could have been read with and decoded strictly as UTF-8, again and again
for nested layers. A step is accepted if the garbling cost falls. Two font encodings
that are no byte round trip, VNI and TCVN3, are decoded by their code charts and
accepted only where a word becomes a Vietnamese syllable that it was not before.
Letters lost to a replacement mark are found and cannot be restored.
"""

from __future__ import annotations

import re
from functools import lru_cache

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vellum.functions.text import ALPHABET, LETTERS, VNI_ONLY, decode_vni, is_syllable
from vellum.llm.common import arrow_map


def _bytes_of(encoding: str) -> dict[str, int]:
    out = {}
    for b in range(256):
        try:
            out[bytes([b]).decode(encoding)] = b
        except UnicodeDecodeError:
            pass
    return out


_CP1252 = {chr(b): b for b in range(256)} | _bytes_of("cp1252")  # codes without a character come through as controls
_MAC = _bytes_of("mac_roman")
_CP1258 = {chr(b): b for b in range(128, 160)} | _bytes_of("cp1258")
#: What UTF-8 may have been read as: Western, Macintosh and Vietnamese; and Central European, Cyrillic and two code pages of DOS, which must end in plain Vietnamese.
_READ_AS = (_CP1252, _MAC, _CP1258)
_SELDOM = tuple(_bytes_of(e) for e in ("cp1250", "cp1251", "cp437", "cp850"))

#: What a Vietnamese text of plain characters is made of.
_PLAIN = frozenset(map(chr, range(128))) | frozenset(LETTERS + "“”‘’–—•…²")
_GAP = re.compile(r"([ \n\t\r]+)")
_LOST = re.compile(r"�|[^\W\d_]\?+[^\W\d_]|(?:^|[\s(“\"])\?+[^\W\d_]|[^\W\d_]\?+ +(?=[a-zđ?])")
_WORD = re.compile(r"[^\W\d_]+")
_EDGES = ".,;:!?()[]\"“”‘’'…-–—"


def _cost(text: str) -> int:
    return sum(c not in ALPHABET and ord(c) > 127 for c in text)


#: What a round trip may end in: western letters, Greek, Cyrillic, marks, and typographic characters of running text.
_PLAUSIBLE = re.compile(r"[\x00-\x7fÀ-ÖØ-öø-ſƠơƯưŁł\u0300-\u0331Ά-ώЀ-џḀ-ỹ“”‘’„–—•…²³°§«»\xa0]*\Z")
#: Signs that a round trip may end in besides, but in scans: × is none, for its garbled form is a capital Ã and a dash.
_SIGNS = str.maketrans(dict.fromkeys("¹‹›€£¥¢©®™÷±·¼½¾¿¡†‡‰−≤≥≠→"))
_LETTER = re.compile(r"[^\W\d_]")


def _utf8(word: str, scanned: bool = False) -> str:
    """The word after all layers of UTF-8 read as a one-byte encoding are undone; unchanged if no plausible word comes out.

    Junk of scans makes round trips by chance: there no sign is admitted, and a longer result needs two letters.
    """
    given = word
    while True:
        best, cost = None, _cost(word)
        for n, chart in enumerate(_READ_AS + _SELDOM):
            try:
                step = bytes(chart[c] for c in word).decode("utf-8")
            except (KeyError, UnicodeDecodeError):
                continue
            if n >= len(_READ_AS) and not _PLAIN.issuperset(step):
                continue
            if (now := _cost(step)) < cost or (best is None and now == cost and len(step) < len(word)):
                best, cost = step, now
        if best is None:
            if scanned:
                return word if _PLAUSIBLE.match(word) and (len(_LETTER.findall(word)) > 1 or len(word) <= 3) else given
            return word if _PLAUSIBLE.match(word.translate(_SIGNS)) else given
        word = best


#: TCVN 5712:1993 VN3 in code order from 0xA1; "." marks a code that is no letter.
TCVN3 = {
    0xA1 + i: c
    for i, c in enumerate(
        "ĂÂÊÔƠƯĐăâêôơưđ......àảãáạ.ằẳẵắ.......ặầẩẫấậè.ẻẽéẹềểễếệìỉ...ĩíịò.ỏõóọồổỗốộờởỡớợù.ủũúụừửữứựỳỷỹýỵ"
    )
    if c != "."
}
_TCVN3 = {c: v for c, v in TCVN3.items() if c not in (0xAC, 0xAD)}
_CHARTS = {"vni": decode_vni, "tcvn3": lambda w: w.translate(TCVN3)}


def _by_letters(word: str, decoded: str) -> bool:
    """Whether a chart turned letters that are no syllable into one."""
    after = decoded.strip(_EDGES).lower()
    if len(after) < 2 or not is_syllable(after):
        return False
    return not is_syllable(word.strip(_EDGES).lower())


@lru_cache(maxsize=500_000)
def mend(word: str, scanned: bool = False) -> tuple[str, str]:
    """(restored word, evidence): utf8, or those of vni, tcvn3 and weak that apply; empty if nothing was found.

    weak: only a soft hyphen or a not sign speaks for TCVN3, which may be a hyphen as well.
    """
    if all(c in ALPHABET or ord(c) < 128 for c in word):
        return word, ""
    if (out := _utf8(word, scanned)) != word:
        return out, "utf8"
    if any(ord(c) > 0x17F or c in "ăĂđĐ" for c in word.strip(_EDGES)):
        return word, ""  # a letter that no one-byte chart of western text has
    kinds = []
    if any(c in VNI_ONLY for c in word) and _by_letters(word, decode_vni(word)):
        kinds.append("vni")
    if any("a" <= c.lower() <= "z" for c in word) and _cost(word):
        core = word.rstrip("¬­")  # at its end these two are hyphens of a cut word
        if _cost(core) and _by_letters(core, core.translate(TCVN3)):
            strong = any(ord(c) in _TCVN3 and c not in ALPHABET for c in core)
            kinds.append("tcvn3" if strong else "weak")
    return word, "+".join(kinds)


def is_plain(text: str) -> bool:
    """Whether a text is made of plain Vietnamese characters only, and lost none."""
    return _PLAIN.issuperset(text) and ("?" not in text or not _LOST.search(text))


def repair(text: str | None, scanned: bool = False) -> tuple[str | None, str]:
    """(text restored as far as possible, kinds of damage joined by "+", empty if none).

    The chart that explains most words of a text decodes all of them. Text of scans
    holds misread characters by itself, so that there a word that the TCVN3 chart
    explains proves nothing; it takes three.
    """
    if not text:
        return text, ""
    kinds = {"lost"} if ("?" in text or "�" in text) and _LOST.search(text) else set()
    if _PLAIN.issuperset(text):
        return text, "+".join(kinds)
    pieces = _GAP.split(text)
    done = [mend(w, scanned) for w in pieces]
    fixed = [d for d, _ in done]
    evidence = [set(h.split("+")) for _, h in done]
    if any("utf8" in h for h in evidence):
        kinds.add("utf8")
    vni = sum("vni" in h for h in evidence)
    strong = sum("tcvn3" in h for h in evidence)
    weak = sum("weak" in h for h in evidence)
    if (strong >= (3 if scanned else 1) or weak >= 3) and strong + weak >= vni:
        kind = "tcvn3"
    else:
        kind = "vni" if vni else ""
    if kind:
        kinds.add(kind)
        chart = _CHARTS[kind]
        marks = {"vni": {"vni"}, "tcvn3": {"tcvn3", "weak"}}[kind]
        at = [i for i, h in enumerate(evidence) if h & marks]
        for i, w in enumerate(pieces):
            if "utf8" in evidence[i] or (out := chart(w)) == w or not is_syllable(out.strip(_EDGES).lower()):
                continue
            if at[0] <= i <= at[-1] or not is_syllable(w.strip(_EDGES).lower()):
                fixed[i] = out
    return "".join(fixed), "+".join(sorted(kinds))


def restore_encoding(df: DataFrame, key: str = "unit_id", text: str = "text", scanned: str | None = "ocr") -> DataFrame:
    """(key, damage, restored): one row for each row of df whose text is damaged.

    damage names the kinds found (utf8, vni, tcvn3, lost), restored is the text with
    every word that could be read again. Row-local: no shuffle, any size of table or
    text. Null and empty texts, rows with a null key and tables without rows give no
    row; repeated rows give a row each time; other columns of df are not read.
    """
    scan = F.coalesce(F.col(scanned), F.lit(False)) if scanned else F.lit(False)
    rows = df.select(F.col(key).cast("bigint").alias("_key"), F.col(text).alias("_text"), scan.alias("_scan"))
    rows = rows.where(F.col("_key").isNotNull() & F.col("_text").rlike(r"[^\x00-\x7f]|\?"))

    def found(cols: dict[str, list]) -> dict[str, list]:
        hits = [(k, kinds, new) for k, t, s in zip(cols["_key"], cols["_text"], cols["_scan"], strict=True) for new, kinds in (repair(t, s),) if kinds]
        return {n: list(v) for n, v in zip((key, "damage", "restored"), zip(*hits, strict=True), strict=True)} if hits else {}

    return arrow_map(rows, found, f"{key} bigint, damage string, restored string")


def found(units: DataFrame) -> DataFrame:
    """p6_found: each unit of which a word at least is damaged."""
    return restore_encoding(units).select("unit_id").distinct()
