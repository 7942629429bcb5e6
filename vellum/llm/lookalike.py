"""Problem 5: text that looks the same but is made of other characters.

Characters that print nothing, other spaces, full-width forms and uncomposed accents
are wrong wherever they stand. Letters of another script that pass for Latin ones are
wrong only in a word meant as Latin, which the vocabulary decides: plain words of all
texts, counted, go into tries, and a weighted edit automaton walks a trie along each
doubtful word. A look-alike or an ignorable costs nothing, a letter that is only near in
look costs 1, another edit 1000. A word all of the other script may cost nothing; one that
mixes scripts was meant as Latin and may cost 1 for each near letter it has. The
cheapest plain word, of these the most frequent, is the canonical spelling. A word that
reaches none is normalised by the table if it mixes scripts and the table knows all its
letters, and left alone otherwise.
"""

from __future__ import annotations

import re
from collections import Counter
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vellum.llm.shapes import IGNORABLE, LOOKALIKE, SPACES, WIDTH, latin_shape, plain_shape
from vellum.llm.common import arrow_map, once
from vellum.llm.encoding import repair

_ALWAYS = re.compile("[" + IGNORABLE + SPACES + "".join(WIDTH) + "]")
_MARK = re.compile("[̀-ͯ]")
_OTHER = "Ͱ-ӿðÐƉԀ-ԯ"
_DOUBT = re.compile(f"[{_OTHER}]")
_ANY = re.compile("[" + IGNORABLE + SPACES + "".join(WIDTH) + f"̀-ͯ{_OTHER}]")
_WORD = re.compile(r"[^\W\d_]+")
#: Small letters of other scripts with the Latin letters that they are near to in look, beside the one they pass for (fixed values).
NEAR = {"υ": "vy", "ν": "u", "η": "nh", "ω": "w", "μ": "u", "σ": "o", "θ": "o", "β": "b", "δ": "d", "ε": "e", "г": "r", "п": "n", "и": "u", "й": "u", "в": "b", "н": "h", "к": "k", "м": "m", "т": "t", "ь": "b", "ъ": "b", "ш": "w", "ӏ": "l", "ԍ": "g"}
_LATIN = re.compile("[a-zA-ZÀ-ÏÑ-ïñ-ƈƊ-ƿḀ-ỿ]")
BUCKETS = 256
#: Cost of a near letter and of any other edit, which is more than any word is allowed here.
NEARLY, EDIT = 1, 1000


def _classes() -> dict[int, str]:
    """Latin small letters that one and the same letter may stand for, all under the first of them."""
    group = {c: c for c in "abcdefghijklmnopqrstuvwxyzđ"}
    for c in sorted({*NEAR, *LOOKALIKE}):
        alike = [*({LOOKALIKE[c].lower()} if c in LOOKALIKE else ()), *NEAR.get(c.lower(), "")]
        for other in alike[1:]:
            old, new = group[other], group[alike[0]]
            group |= {k: new for k, v in group.items() if v == old}
    return {ord(k): v for k, v in group.items() if k != v}


CLASSES = _classes()


class Trie:
    """Plain words with their counts; walk() is an automaton over it with free look-alikes and ignorables."""

    def __init__(self) -> None:
        self.root: dict = {}

    def add(self, word: str, count: int) -> None:
        node = self.root
        for c in word:
            node = node.setdefault(c, {})
        node[""] = node.get("", 0) + count

    def walk(self, word: str, budget: int = 0) -> str | None:
        """The most frequent word within the budget, cheapest first; ties go to the first in order.

        States are (node, cost); a letter moves along its own edge or that of the Latin
        letter it looks like at no cost, along that of a near letter for NEARLY, and any
        other edit costs EDIT; an ignorable stays at no cost. Edges are small letters; a
        capital is mapped before its case goes, for it may look like another letter than
        its small form, or like one alone.
        """
        states = {(id(self.root), ""): (self.root, 0)}

        def go(to: dict, node: dict, path: str, cost: int) -> None:
            if cost <= budget and to.get((id(node), path), (None, budget + 1))[1] > cost:
                to[id(node), path] = (node, cost)

        def added(to: dict) -> dict:
            """The states with letters of the vocabulary that the word lacks."""
            if budget >= EDIT:
                queue = list(to.items())
                for (_, path), (node, cost) in queue:
                    for edge, child in node.items():
                        if edge and cost + EDIT <= budget:
                            key = (id(child), path + edge)
                            if to.get(key, (None, budget + 1))[1] > cost + EDIT:
                                to[key] = (child, cost + EDIT)
                                queue.append((key, to[key]))
            return to

        added(states)
        for c in word:
            following: dict = {}
            free, near = (c.lower(), LOOKALIKE.get(c, c).lower()), NEAR.get(c.lower(), "")
            for (_, path), (node, cost) in states.items():
                if c in IGNORABLE:
                    go(following, node, path, cost)
                    continue
                for edge, child in node.items():
                    if edge:
                        go(following, child, path + edge, cost + (0 if edge in free else NEARLY if edge in near else EDIT))
                go(following, node, path, cost + EDIT)
            states = added(following)
        ends = [(cost, -node[""], path) for (_, path), (node, cost) in states.items() if "" in node]
        return min(ends)[2] if ends else None


def _skeleton(word: str) -> str:
    """The same for a word and every plain word that it may reach."""
    latin = (LOOKALIKE[c].lower() if c in LOOKALIKE else NEAR.get(c.lower(), c.lower())[0] for c in plain_shape(word) if c not in IGNORABLE)
    return "".join(latin).translate(CLASSES)


def _near(word: str) -> int:
    """Letters of a word that are near to Latin ones: what walking it may cost. A word all of the other script may cost nothing."""
    return sum(c.lower() in NEAR for c in word) * NEARLY if _mixed(word) else 0


@lru_cache(maxsize=100_000)
def _mixed(word: str) -> bool:
    return bool(_LATIN.search(word))


def inspect(text: str) -> tuple[bool, list[str]]:
    """(whether characters are wrong wherever they stand, words with letters of another script that may pass for Latin)."""
    if not _ANY.search(text):
        return False, []
    sure = bool(_ALWAYS.search(text)) or bool(_MARK.search(text)) and plain_shape(text) != text
    if not _DOUBT.search(text):
        return sure, []
    words = _WORD.findall(plain_shape(text))
    doubtful = []
    for i, w in enumerate(words):
        if not _DOUBT.search(w) or not all(c in LOOKALIKE or c.lower() in NEAR and len(w) > 2 and _mixed(w) for c in w if _DOUBT.match(c)):
            continue
        if not _mixed(w):
            near = words[max(0, i - 1) : i] + words[i + 1 : i + 2]
            if any(_DOUBT.search(x) and not _mixed(x) and not all(c in LOOKALIKE for c in x) for x in near):
                continue  # a short word within a phrase of the other script
        doubtful.append(w)
    return sure, doubtful


def _suspects(cols: dict[str, list]) -> dict[str, list]:
    out: dict[str, list] = {"tab": [], "row_id": [], "word": []}
    for tab, key, text, scan in zip(cols["tab"], cols["row_id"], cols["text"], cols["scan"], strict=True):
        sure, doubtful = inspect(text)
        if not sure and not doubtful or tab == "units" and repair(text, scan)[1]:
            continue
        words = [None] if sure else list(dict.fromkeys(doubtful))
        out["tab"] += [tab] * len(words)
        out["row_id"] += [key] * len(words)
        out["word"] += words
    return out


def _vocabulary(cols: dict[str, list]) -> dict[str, list]:
    counts: Counter = Counter()
    for text in cols["text"]:
        counts.update(_WORD.findall(text.lower()))
    plain = {w: n for w, n in counts.items() if not _DOUBT.search(w)}
    return {"word": list(plain), "n": list(plain.values())}


def _cased(plain: str, word: str) -> str:
    """A spelling that was reached letter by letter, in the case of the word."""
    if len(plain) != len(word):
        return plain
    return "".join(c if p == c.lower() else p.upper() if c.isupper() else p for p, c in zip(plain, word, strict=True))


def _spelling(word: str, trie: Trie) -> str:
    """The canonical spelling of a doubtful word."""
    plain = trie.walk(word, _near(word))
    if plain is not None:
        return _cased(plain, word)
    return latin_shape(word) if _mixed(word) and all(c in LOOKALIKE for c in word if _DOUBT.match(c)) else word


def _decide(words: pd.DataFrame, vocabulary: pd.DataFrame) -> pd.DataFrame:
    trie = Trie()
    for word, n in zip(vocabulary["word"], vocabulary["n"], strict=True):
        trie.add(word, int(n))
    form = [_spelling(w, trie) for w in words["word"]]
    return pd.DataFrame({"word": pd.Series(list(words["word"]), dtype=object), "form": pd.Series(form, dtype=object)})


def texts(units: DataFrame | None = None, ocr_lines: DataFrame | None = None) -> DataFrame:
    """(tab, row_id, text, scan) of the tables given; rows without id or text are left out."""
    parts = []
    if units is not None:
        parts.append(units.select(F.lit("units").alias("tab"), F.col("unit_id").cast("bigint").alias("row_id"), "text", F.coalesce("ocr", F.lit(False)).alias("scan")))
    if ocr_lines is not None:
        parts.append(ocr_lines.select(F.lit("ocr_lines").alias("tab"), F.col("ocr_line_id").cast("bigint").alias("row_id"), "text", F.lit(True).alias("scan")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.where("row_id is not null and text is not null")


def spellings(rows: DataFrame) -> DataFrame:
    """(word, form): every word of other-script letters that occurs, with its canonical spelling.

    The vocabulary is counted over all rows, each batch by itself first. Only plain
    words that a doubtful one can reach are kept, by a join on the skeleton that both
    must share: Latin letters that one letter may stand for are one class in it. They
    meet in buckets of it, each with a trie of its own.
    """
    doubtful = arrow_map(rows, _words_of, "tab string, row_id bigint, word string, skeleton string")
    words = doubtful.select("word", "skeleton").distinct()
    counted = arrow_map(rows.select("text"), _vocabulary, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    skeleton = F.translate("word", "".join(map(chr, CLASSES)), "".join(CLASSES.values())).alias("skeleton")
    reached = counted.select("word", "n", skeleton).join(words.select("skeleton").distinct(), "skeleton", "left_semi")

    def bucket(name: str) -> Column:
        return F.pmod(F.crc32(F.col(name).cast("binary")), F.lit(BUCKETS)).cast("int").alias("bucket")

    left = words.select("word", bucket("skeleton")).groupBy("bucket")
    return left.cogroup(reached.select("word", "n", bucket("skeleton")).groupBy("bucket")).applyInPandas(_decide, "word string, form string")


def look_alikes(rows: DataFrame) -> DataFrame:
    """(tab, row_id): rows of texts() with a character that the consistent form does not have.

    Units damaged by a wrong encoding are left out (problem 6). Empty texts give no
    row; a repeated row is given once; ties between spellings go to the more frequent,
    then to the first in code order.
    """
    odd = arrow_map(rows, _suspects, "tab string, row_id bigint, word string")
    changed = spellings(rows).where("form != word").select("word", F.lit(True).alias("changed"))
    return odd.join(changed, "word", "left").where("word is null or changed").select("tab", "row_id").distinct()


def consistent(rows: DataFrame) -> DataFrame:
    """(tab, row_id, text): every row of texts() in its consistent form, each row id once.

    Damaged units are restored first. Words of other-script letters take their
    canonical spelling; the pairs of a row travel with the row, not as a broadcast.
    """
    each = once(rows.withColumn("_id", F.concat_ws(":", "tab", "row_id")), "_id").drop("_id")
    odd = arrow_map(rows, _words_of, "tab string, row_id bigint, word string, skeleton string")
    forms = odd.join(spellings(rows).where("form != word"), "word").groupBy("tab", "row_id")
    forms = forms.agg(F.map_from_entries(F.collect_set(F.struct("word", "form"))).alias("forms"))

    def write(cols: dict[str, list]) -> dict[str, list]:
        out = []
        for text, scan, pairs in zip(cols["text"], cols["scan"], cols["forms"], strict=True):
            text, known = plain_shape(repair(text, scan)[0]), dict(pairs or ())
            out.append(_WORD.sub(lambda m, known=known: known.get(m.group(), m.group()), text) if known else text)
        return {"tab": cols["tab"], "row_id": cols["row_id"], "text": out}

    return arrow_map(each.join(forms, ["tab", "row_id"], "left"), write, "tab string, row_id bigint, text string")


def _words_of(cols: dict[str, list]) -> dict[str, list]:
    out: dict[str, list] = {"tab": [], "row_id": [], "word": [], "skeleton": []}
    for tab, key, text in zip(cols["tab"], cols["row_id"], cols["text"], strict=True):
        words = list(dict.fromkeys(inspect(text)[1]))
        out["tab"] += [tab] * len(words)
        out["row_id"] += [key] * len(words)
        out["word"] += words
        out["skeleton"] += map(_skeleton, words)
    return out


def found(units: DataFrame, ocr_lines: DataFrame) -> DataFrame:
    """p5_found: rows whose characters only look right."""
    return look_alikes(texts(units, ocr_lines))
