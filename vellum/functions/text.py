"""Character tables and string helpers for Vietnamese text.

Plain Python on str, called batch by batch inside Arrow functions. Everything
here is a pure function of its arguments.
"""

from __future__ import annotations

import re
import unicodedata
from functools import lru_cache
from itertools import product

TONES = "̣̀́̃̉"
#: Letters that carry a tone, without one.
VOWELS = "aăâeêioôơuưy"


def _toned(letter: str) -> str:
    return "".join(unicodedata.normalize("NFC", letter + tone) for tone in TONES)


#: Every lower- and upper-case letter of the Vietnamese alphabet beyond ASCII.
LETTERS = "".join(sorted({c for v in VOWELS for c in v + _toned(v) if ord(c) > 127} | {"đ"}))
LETTERS += LETTERS.upper()
ALPHABET = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ" + LETTERS)

_BASE = {c: unicodedata.normalize("NFD", c)[0] for c in LETTERS} | {"đ": "d", "Đ": "D"}
FOLD = str.maketrans(_BASE)

#: Onsets and toneless rimes of Vietnamese syllables (fixed values of the orthography).
ONSETS = "ngh ng nh ch gh gi kh ph qu th tr b c d đ g h k l m n p r s t v x".split()
RIMES = frozenset(
    """a ac ach ai am an ang anh ao ap at au ay ăc ăm ăn ăng ăp ăt âc âm ân âng âp ât âu ây
    e ec em en eng eo ep et ê êch êm ên ênh êp êt êu i ia ich im in inh ip it iu iêc iêm iên iêng iêp iêt iêu
    o oc oi om on ong op ot oa oac oach oai oam oan oang oanh oao oap oat oay oăc oăm oăn oăng oăt oe oen oeo oet ooc oong
    ô ôc ôi ôm ôn ông ôp ôt ơ ơi ơm ơn ơp ơt u ua uc ui um un ung up ut uân uâng uât uây uê uêch uênh uêu uơ
    uy uya uych uynh uyt uyn uyp uyu uyên uyêt uôc uôi uôm uôn uông uôt ư ưa ưc ưi ưm ưng ưt ưu
    ươc ươi ươm ươn ương ươp ươt ươu y yê yêm yên yêng yêt yêu""".split()
)


@lru_cache(maxsize=200_000)
def is_syllable(word: str) -> bool:
    """Whether a lower-case word is spelt as a Vietnamese syllable: onset, rime, one tone at most."""
    plain = unicodedata.normalize("NFD", word)
    if sum(c in TONES for c in plain) > 1:
        return False
    bare = unicodedata.normalize("NFC", "".join(c for c in plain if c not in TONES))
    if bare in RIMES:
        return True
    for onset in ONSETS:
        if bare.startswith(onset) and (bare[len(onset) :] in RIMES or (onset == "gi" and bare == "gi")):
            return True
    return False


def strip_accents(text: str) -> str:
    """Base letters only; the stroke of đ goes too."""
    if text.isascii():
        return text
    text = text.translate(FOLD)
    return text if text.isascii() else "".join(c for c in unicodedata.normalize("NFD", text) if not unicodedata.combining(c))


# --- Legacy font encodings (fixed values of the published code charts) ---------------------

#: VNI: single letters, then base + modifier pairs merged from left to right.
VNI_SINGLE = str.maketrans("ñÑöÖôÔæÆòÒóÓ", "đĐưƯơƠỉỈịỊĩĨ")
VNI_PAIRS = {
    b + m: r
    for base, row in (("a", "áàảãạ"), ("e", "éèẻẽẹ"), ("i", "íìỉĩị"), ("o", "óòỏõọ"), ("u", "úùủũụ"), ("y", "ýỳỷỹỵ"), ("ơ", "ớờởỡợ"), ("ư", "ứừửữự"))
    for b, m, r in zip(base * 5, "ùøûõï", row, strict=True)
}
VNI_PAIRS |= {
    b + m: r
    for base, mods, row in (("a", "âáàåãä", "âấầẩẫậ"), ("a", "êéèúüë", "ăắằẳẵặ"), ("e", "âáàåãä", "êếềểễệ"), ("o", "âáàåãä", "ôốồổỗộ"))
    for b, m, r in zip(base * 6, mods, row, strict=True)
}
_cased = {}
for _pair, _result in VNI_PAIRS.items():
    for _b, _m in product((_pair[0], _pair[0].upper()), (_pair[1], _pair[1].upper())):
        _cased[_b + _m] = _result.upper() if _b.isupper() else _result
VNI_PAIRS = _cased
#: Letters VNI text has and Vietnamese has not.
VNI_ONLY = frozenset("öÖøØûÛïÏäÄåÅñÑëËüÜæÆ")


def decode_vni(text: str) -> str:
    """Two passes: single letters by table, then each character merges at most once into the one written before it."""
    out: list[str] = []
    for c in text.translate(VNI_SINGLE):
        merged = VNI_PAIRS.get(out[-1] + c) if out else None
        if merged is None:
            out.append(c)
        else:
            out[-1] = merged
    return "".join(out)
