"""Problem 3: noise in text from scanned pages.

Misread characters are corrected by a noisy channel: every token that is no plain word
gets the words it may have been, by a chart of character confusions; the probability
of a confusion is counted over the whole corpus, that of a word after its neighbour
from the word pairs of all clean units; Viterbi picks the words of a line. Words cut at
line ends are put together, rows that are a page number or the running title go, and
the lines of a block become one paragraph.

The words a token may have been are the syllables that the chart can make of it, all
of them: a reading is given up only where no syllable begins with it. A token of five
characters or more of which no syllable comes is read as a foreign word: it meets the
words of the clean units that share its skeleton, in which confused forms are one, and
the reading of the best channel probability stands beside them for words that no unit
has, which all are equally likely. So tokens may have any length.

Nothing of the corpus is broadcast: candidates are met with the language model by
joins on the word pairs that the noisy rows need.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Callable
from functools import lru_cache
from math import log

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vellum.llm.shapes import latin_shape
from vellum.functions.text import ONSETS, RIMES, TONES, VOWELS, is_syllable, strip_accents
from vellum.llm import quality
from vellum.llm.common import arrow_map, once
from vellum.llm.encoding import is_plain, repair
from vellum.session import written

#: What a character may be read as (fixed values of the scanner's usual mistakes): mistaken form -> letters that were printed.
CONFUSIONS = {
    "!": "iíìị", "1": "iíìịl", "|": "lI", "€": "c", "†": "t", "9": "g", "6": "b", "@": "aạ", "0": "oôơóò", "5": "s", "8": "B", "$": "s",
    "ii": "nu", "!i": "nu", "i!": "nu", "li": "h", "l!": "h", "|i": "h", "rn": "m", "cl": "d", "c|": "d", "vv": "w",
}
_SEQ = re.compile("|".join(re.escape(k) for k in sorted(CONFUSIONS, key=len, reverse=True)))
_CHUNK = re.compile(r"[^\s,;:.()\[\]“”\"'’‘?…«»/\\]+")
_LETTERS = re.compile(r"[^\W\d_]+\Z")
#: Words of a lower-case text in Latin letters.
_LOWER = re.compile("[a-zß-öø-ỹ]+")
_PAGE = re.compile(r"\s*[-–—\[(]?\s*(?:trang\s+|page\s+)?\d{1,4}(?:\s*/\s*\d{1,4})?\s*[-–—\])]?\s*\.?\s*\Z", re.IGNORECASE)
_MARKS = ("-", "¬", "=", "‐")
_CUT = re.compile(r"([^\W\d_]+)[-¬=‐]\Z")


@lru_cache(maxsize=1)
def _starts() -> frozenset[str]:
    """Every proper beginning of a syllable, without tones."""
    out = set()
    for onset in ["", *ONSETS]:
        for rime in RIMES:
            word = onset + rime
            out.update(word[:i] for i in range(1, len(word) + 1))
    return frozenset(out)


_BARE = str.maketrans({c: b for b in VOWELS for c in (unicodedata.normalize("NFC", b + t) for t in TONES)})


def cut_word(line: str) -> str:
    """The beginning of a word that a line cuts at its end, or empty."""
    line = line.rstrip()
    m = _CUT.search(line) if line[-1:] in _MARKS else None
    if not m or " " not in line:
        return ""
    if m[1].istitle() and len(m[1]) > 1:  # the beginning of a name
        return m[1]
    return m[1] if any(h.lower().translate(_BARE) in _starts() for h in (m[1], *(w for w, _ in readings(m[1])))) else ""


@lru_cache(maxsize=200_000)
def readings(token: str) -> tuple[tuple[str, str], ...]:
    """(word, confusions used) for every reading of a token by the chart that begins a syllable or is one, fewest confusions first."""
    if not _SEQ.search(token):
        return ()
    ways: list[dict[str, tuple[str, ...]]] = [{"": ()}] + [{} for _ in token]
    for i, c in enumerate(token):
        for word, used in ways[i].items():
            steps = [(c, (), 1)] if c.isalpha() else []
            steps += [(r, (f"{token[i : i + n]}>{r}",), n) for n in (1, 2) for r in CONFUSIONS.get(token[i : i + n], "") if i + n <= len(token)]
            for letter, how, n in steps:
                longer = word + letter
                if longer.lower().translate(_BARE) not in _starts():
                    continue
                to = ways[i + n]
                if longer not in to or len(to[longer]) > len(used) + len(how):
                    to[longer] = used + how
    found = sorted(((w, u) for w, u in ways[-1].items() if u), key=lambda x: len(x[1]))
    return tuple((w, "+".join(u)) for w, u in found)


@lru_cache(maxsize=200_000)
def doubtful(token: str) -> bool:
    """Whether a token is worth a reading: no plain syllable, no number, and the chart makes a word of it."""
    low = token.lower()
    if is_syllable(low) or not _SEQ.search(token) or not any(c.isalpha() for c in token):
        return False
    if token[:-1].isdigit() or token[0].isalpha() and token[1:].isdigit():  # numbers of articles and forms with a letter
        return False
    return bool(plausible(token)) or foreign(token)


@lru_cache(maxsize=200_000)
def plausible(token: str) -> tuple[tuple[str, str], ...]:
    """Readings that are spelt as syllables."""
    return tuple(x for x in readings(token) if is_syllable(x[0].lower()) and len(x[0]) > 1)


def foreign(token: str) -> bool:
    """Whether a token that no syllable comes of may be a misread word all the same: four letters, and none but letters beside confused forms."""
    return len(token) >= 5 and bool(_LETTERS.match(_SEQ.sub("", token) or "1")) and sum(c.isalpha() for c in token) >= 4 and not plausible(token)


#: Forms that are confused, each as the strokes it may be taken for, so that a word and its misreadings have one skeleton.
_STROKES = {"m": "rii", "n": "ii", "u": "ii", "h": "ii", "d": "ci", "w": "vv"}
_ALIKE = {"l": "i", "!": "i", "1": "i", "|": "i", "€": "c", "†": "t", "9": "g", "6": "b", "8": "b", "@": "a", "0": "o", "5": "s", "$": "s"}
_ALIKE |= {c: strip_accents(c) for k in ("!", "@", "0") for c in CONFUSIONS[k] if not c.isascii()}
_SKELETON = str.maketrans(_STROKES | _ALIKE)


def skeleton(word: str) -> str:
    return word.lower().translate(_SKELETON)


def _skeleton_column(c: Column) -> Column:
    out = F.translate(c, "".join(_ALIKE), "".join(_ALIKE.values()))
    for letter, strokes in _STROKES.items():
        out = F.replace(out, F.lit(letter), F.lit(strokes))
    return out


def channel(token: str, cost: Callable[[str], float], word: str | None = None) -> tuple[str, tuple[str, ...]] | None:
    """The reading of a token with the greatest sum of cost() over its confusions, of the given word if there is one."""
    small = word.lower() if word is not None else None
    # by place in the token and letters written: the best sum, the word, the confusions
    ways: list[dict[int, tuple[float, str, tuple[str, ...]]]] = [{0: (0.0, "", ())}] + [{} for _ in token]
    for i, c in enumerate(token):
        for size, (score, done, used) in ways[i].items():
            steps = [(c, None, 1)] if c.isalpha() else []
            steps += [(r, f"{token[i : i + n]}>{r}", n) for n in (1, 2) for r in CONFUSIONS.get(token[i : i + n], "") if i + n <= len(token)]
            for letter, how, n in steps:
                at = 0 if small is None else size + 1
                if small is not None and small[size : size + 1] != letter.lower():
                    continue
                new = (score + (cost(how) if how else 0.0), done + letter, (*used, how) if how else used)
                known = ways[i + n].get(at)
                if known is None or new[0] > known[0]:
                    ways[i + n][at] = new
    best = ways[-1].get(0 if small is None else len(small))
    return (best[1], best[2]) if best and best[2] else None


_TAIL = re.compile(r"\W*\d+\W*\Z")
#: What a scanner may put for another letter or for two, and everything that is no letter.
_UNSURE = re.compile(r"[\W\d_cdhilmnruvw]+")
_ONE = str.maketrans("!1|€†96@05$", "illctgbaoss")


def title_key(line: str) -> str:
    """The letters of a line that scanners do not confuse, without accents, case and a number at the end: to compare title lines of one document."""
    key = strip_accents(latin_shape(line).lower())
    return _UNSURE.sub("", (_TAIL.sub("", key) if key[-1:].isdigit() else key).translate(_ONE))


def _inspect(cols: dict[str, list]) -> dict[str, list]:
    """Of every row: whether it is a page number, whether it cuts a word, its doubtful places, and its first line if it may be a title.

    A row that another row of its page in the same batch comes before is not the first
    of the page and has no title.
    """
    out = {n: cols[n] for n in ("tab", "row_id", "doc", "page", "ord")}
    keys, numbers, cuts, places, codes = [], [], [], [], []
    top: dict[tuple, int] = {}
    pages = list(zip(cols["tab"], cols["doc"], cols["page"], strict=True))
    for page, n in zip(pages, cols["ord"], strict=True):
        if n is not None and n < top.get(page, n + 1):
            top[page] = n
    for text, page, n in zip(cols["text"], pages, cols["ord"], strict=True):
        shape = latin_shape(text)
        lines = shape.split("\n")
        codes.append(quality.code_of(shape) if page[0] == "ocr_lines" and text and not text.isspace() else None)
        keys.append(lines[0] if top.get(page) == n else "")
        short = len(shape) <= 20 and any(c.isdigit() for c in shape)
        numbers.append(short and bool(_PAGE.match(shape) or _PAGE.match(" ".join(plausible(t)[0][0] if doubtful(t) and plausible(t) else t for t in shape.split()))))
        cuts.append(any(cut_word(line) for line in lines))
        spots = []
        for line in lines:
            words = _CHUNK.findall(line)
            for i, w in enumerate(words):
                if doubtful(w) and not (i == len(words) - 1 and cut_word(line)):
                    spots.append((words[i - 1] if i else "", w, words[i + 1] if i + 1 < len(words) else ""))
        places.append([{"before": a, "word": w, "after": b} for a, w, b in spots])
    return out | {"title": keys, "number": numbers, "cut": cuts, "places": places, "code": codes}


_ROW = "tab string, row_id bigint, doc string, page int, ord int, title string, number boolean, cut boolean, places array<struct<before:string,word:string,after:string>>, code int"


def scanned(ocr_lines: DataFrame | None, units: DataFrame | None) -> DataFrame:
    """(tab, row_id, doc, page, ord, text) of recognised lines and of units of scans; rows without id, document or text are left out."""
    parts = []
    if ocr_lines is not None:
        parts.append(ocr_lines.select(F.lit("ocr_lines").alias("tab"), F.col("ocr_line_id").cast("bigint").alias("row_id"), "doc", "page", F.col("line_no").alias("ord"), "text"))
    if units is not None:
        parts.append(units.where("ocr").select(F.lit("units").alias("tab"), F.col("unit_id").cast("bigint").alias("row_id"), "doc", "page", F.col("unit_no").alias("ord"), "text"))
    rows = parts[0]
    for p in parts[1:]:
        rows = rows.unionByName(p)
    return rows.where("row_id is not null and doc is not null and text is not null")


def running_titles(rows: DataFrame) -> DataFrame:
    """(tab, row_id): the first row of a page whose title key begins two pages of the document at least. rows: as of _inspect."""
    top = rows.groupBy("tab", "doc", "page").agg(F.min("ord").alias("ord"))
    first = rows.where("title <> ''").select("tab", "doc", "page", "ord", "row_id", "title").join(top, ["tab", "doc", "page", "ord"])

    def key(cols: dict[str, list]) -> dict[str, list]:
        return cols | {"title": [title_key(t) for t in cols["title"]]}

    keyed = arrow_map(first.select("tab", "doc", "page", "row_id", "title"), key, "tab string, doc string, page int, row_id bigint, title string").where("length(title) >= 4")
    often = keyed.groupBy("doc", "title").agg(F.count_distinct("page").alias("n")).where("n >= 2")
    return keyed.join(often, ["doc", "title"], "left_semi").select("tab", "row_id")


# --- language model ------------------------------------------------------------------------


class _Ids(dict):
    """A number for every word, in the order of their first use."""

    def __missing__(self, word: str) -> int:
        self[word] = n = len(self)
        return n


def _pairs(cols: dict[str, list]) -> dict[str, list]:
    """Words and neighbouring pairs of a batch with their counts, over numbers instead of strings."""
    ids = _Ids({"": 0})
    stream: list[int] = [0]
    for text in cols["text"]:
        if not is_plain(text):
            if repair(text)[1]:
                continue
            text = latin_shape(text)
        stream += map(ids.__getitem__, _LOWER.findall(text.lower()))
        stream.append(0)
    words = list(ids)
    seq = np.array(stream, np.int64)
    one, n_one = np.unique(seq[seq > 0], return_counts=True)
    inner = (seq[:-1] > 0) & (seq[1:] > 0)
    two, n_two = np.unique(seq[:-1][inner] * len(words) + seq[1:][inner], return_counts=True)
    grams = [words[i] for i in one.tolist()] + [f"{words[a]} {words[b]}" for a, b in zip((two // len(words)).tolist(), (two % len(words)).tolist(), strict=True)]
    return {"gram": grams, "n": n_one.tolist() + n_two.tolist()}


def language_model(units: DataFrame) -> DataFrame:
    """(gram, n): words and pairs of neighbouring words of all units that are no scans and not damaged."""
    clean = units.where("text is not null and not coalesce(ocr, false)").select("text")
    return arrow_map(clean, _pairs, "gram string, n bigint").groupBy("gram").agg(F.sum("n").alias("n"))


#: What the skeletons of foreign words begin with among the grams.
KEY = "~"


def _wanted(cols: dict[str, list]) -> dict[str, list]:
    """The words and pairs that the places of a row ask the language model for."""
    out: dict[str, list] = {"gram": []}
    for places in cols["places"]:
        for p in places:
            if foreign(p["word"]):
                out["gram"].append(KEY + skeleton(p["word"]))
            for word in {w.lower() for w, _ in plausible(p["word"])} | {p["word"].lower()}:
                out["gram"].append(word)
                out["gram"] += [f"{w.lower()} {word}" for w in _sides(p["before"])] + [f"{word} {w.lower()}" for w in _sides(p["after"])]
    out["gram"] = list(dict.fromkeys(out["gram"]))
    return out


def _sides(word: str) -> list[str]:
    if not word:
        return []
    return list(dict.fromkeys(w for w, _ in plausible(word))) or [word] if doubtful(word) else [word]


def confusion_table(rows: DataFrame) -> dict[str, float]:
    """Log probability of each confusion, counted over all places with a single plausible reading. At most as many rows as the chart has."""

    def single(cols: dict[str, list]) -> dict[str, list]:
        counts: Counter = Counter()
        for places in cols["places"]:
            for p in places:
                found = plausible(p["word"])
                if len(found) == 1:
                    counts.update(found[0][1].split("+"))
        return {"confusion": list(counts), "n": list(counts.values())}

    got = {r["confusion"]: r["n"] for r in arrow_map(rows.select("places"), single, "confusion string, n bigint").groupBy("confusion").agg(F.sum("n").alias("n")).collect()}
    chart = [f"{s}>{c}" for s, letters in CONFUSIONS.items() for c in letters]
    total = sum(got.values()) + len(chart)
    return {c: log((got.get(c, 0) + 1) / total) for c in chart}


#: Log probability that a token of a scan is misread at all, and that it is right.
MISREAD, RIGHT = log(0.05), log(0.95)
#: The same for a token that holds a character which no word is printed with.
STRANGE = log(1e-8)


def decode(places: list[dict], grams: dict[str, int], chart: dict[str, float], total: int = 1_000_000, words: dict[str, list[str]] | None = None) -> list[str]:
    """The most probable words of the places of a row, by Viterbi over the candidates of neighbouring places.

    grams: the counts of words and pairs; total: that of all words; words: of each skeleton the foreign words that have it.
    """
    total = max(1, total)

    def unigram(w: str) -> float:
        return log((grams.get(w, 0) + 0.01) / total)

    def follows(a: str, b: str) -> float:
        if not a or not b:
            return 0.0
        n = grams.get(f"{a} {b}", 0)
        return log((n + 0.1) / (grams.get(a, 0) + 1000)) - log((grams.get(b, 0) + 1) / total) * 0.1

    out: list[str] = []

    def candidates(token: str) -> list[tuple[str, float]]:
        cost = lambda c: chart.get(c, -12.0)
        own = [(token, RIGHT if token.isalpha() else STRANGE)]
        if foreign(token):
            found = [channel(token, cost), *(channel(token, cost, w) for w in (words or {}).get(skeleton(token), ()))]
            return list(dict(own + [(x[0], MISREAD + sum(map(cost, x[1]))) for x in found if x]).items())
        return own + [(w, MISREAD + sum(map(cost, used.split("+")))) for w, used in plausible(token)]

    def finish(run: list[tuple[dict, list[tuple[str, float]]]]) -> list[str]:
        best: list[dict[str, tuple[float, str | None]]] = []
        for k, (p, cands) in enumerate(run):
            here = {}
            for w, score in cands:
                score += unigram(w.lower())
                if k:
                    prev = max(((s + follows(a.lower(), w.lower()), a) for a, (s, _) in best[-1].items()), key=lambda x: x[0])
                else:
                    prev = (follows(p["before"].lower(), w.lower()), None)
                here[w] = (score + prev[0], prev[1])
            best.append(here)
        last = run[-1][0]
        word = max(best[-1], key=lambda w: best[-1][w][0] + follows(w.lower(), last["after"].lower()))
        words = [word]
        for here in reversed(best[1:]):
            word = here[word][1]
            words.append(word)
        return words[::-1]

    run = []
    for p in places:
        if run and not (p["before"] == run[-1][0]["word"] and run[-1][0]["after"] == p["word"]):
            out += finish(run)
            run = []
        run.append((p, candidates(p["word"])))
    if run:
        out += finish(run)
    return out


def corrections(rows: DataFrame, units: DataFrame, tab: str | None = None) -> DataFrame:
    """(tab, row_id, wrong, right): the misread tokens of rows (as of _inspect) in order, and what was printed. tab: only of this; confusions are counted over all rows."""
    noisy = rows.where(F.size("places") > 0).select("tab", "row_id", "places")
    chart = confusion_table(noisy)
    noisy = noisy.where(F.col("tab") == tab) if tab else noisy
    model = written(language_model(units))
    single = ~F.contains("gram", F.lit(" "))
    total = model.where(single).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()["n"]
    by_skeleton = model.where(single & (F.length("gram") >= 3)).select(F.concat(F.lit(KEY), _skeleton_column(F.col("gram"))).alias("gram"), F.col("gram").alias("word"), "n")
    model = model.select("gram", F.lit(None).cast("string").alias("word"), "n").unionByName(by_skeleton)

    def ask(cols: dict[str, list]) -> dict[str, list]:
        out: dict[str, list] = {"tab": [], "row_id": [], "gram": []}
        for tab, key, places in zip(cols["tab"], cols["row_id"], cols["places"], strict=True):
            grams = _wanted({"places": [places]})["gram"]
            out["tab"] += [tab] * len(grams)
            out["row_id"] += [key] * len(grams)
            out["gram"] += grams
        return out

    answers = arrow_map(noisy, ask, "tab string, row_id bigint, gram string").join(model, "gram")
    answers = answers.groupBy("tab", "row_id").agg(F.collect_set(F.struct("gram", "word", "n")).alias("grams"))

    def solve(cols: dict[str, list]) -> dict[str, list]:
        out: dict[str, list] = {"tab": [], "row_id": [], "wrong": [], "right": []}
        for tab, key, places, grams in zip(cols["tab"], cols["row_id"], cols["places"], cols["grams"], strict=True):
            counts, others = {}, {}
            for g in grams or ():
                counts[g["word"] or g["gram"]] = g["n"]
                if g["word"]:
                    others.setdefault(g["gram"][len(KEY) :], []).append(g["word"])
            words = decode(places, counts, chart, total, {k: sorted(v) for k, v in others.items()})
            pairs = [(p["word"], w) for p, w in zip(places, words, strict=True) if w != p["word"]]
            if pairs:
                out["tab"].append(tab)
                out["row_id"].append(key)
                out["wrong"].append([a for a, _ in pairs])
                out["right"].append([b for _, b in pairs])
        return out

    return arrow_map(noisy.join(answers, ["tab", "row_id"], "left"), solve, "tab string, row_id bigint, wrong array<string>, right array<string>")


def inspected(ocr_lines: DataFrame, units: DataFrame | None) -> DataFrame:
    """Rows of scans whose documents are running text. Each row is looked at once, for problem 2 as well."""
    rows = written(arrow_map(scanned(ocr_lines, units), _inspect, _ROW))
    coded = rows.where("tab = 'ocr_lines' and code is not null").select("doc", "page", F.col("ord").alias("line_no"), F.col("row_id").alias("id"), "code")
    return rows.join(written(quality.no_prose(coded)), "doc", "left_anti")


def scan_noise(ocr_lines: DataFrame, units: DataFrame) -> DataFrame:
    """(tab, row_id, noise): one row for each kind of noise a row holds.

    Documents of lists, tables or junk (problem 2) are left out. Repeated rows count
    once. Empty texts hold no noise; ties between readings go to the first of the chart.
    """
    rows = inspected(ocr_lines, units)
    title = running_titles(rows).withColumn("noise", F.lit("running_header"))
    single = rows.select("tab", "row_id", F.explode(F.array_compact(F.array(F.when(F.col("number"), F.lit("page_number")), F.when(F.col("cut"), F.lit("broken_word"))))).alias("noise"))
    misread = corrections(rows, units).select("tab", "row_id", F.lit("misread").alias("noise"))
    return title.unionByName(single).unionByName(misread).distinct()


def found(ocr_lines: DataFrame, units: DataFrame) -> DataFrame:
    """p3_found: the noise of each row of a scan."""
    return scan_noise(ocr_lines, units)


# --- continuous text -----------------------------------------------------------------------

_OPEN = re.compile(r"[.;:?!”\"…)\]]\s*\Z")
_NEW = re.compile(r"\s*(?:[•*+-]\s|[a-zđ]\)|\d+[.)]|[\"“(]?[A-ZĐÀ-Ý])")


def corrected(text: str, wrong: list[str] | None, right: list[str] | None) -> str:
    """The text in Latin letters with each misread token, in order, replaced by what was printed."""
    text, at = latin_shape(text), 0
    for a, b in zip(wrong or (), right or (), strict=True):
        i = text.find(a, at)
        if i >= 0:
            text = text[:i] + b + text[i + len(a) :]
            at = i + len(b)
    return text


def joined(lines: list[str]) -> str:
    """Lines of a block as running text; a word cut at a line's end is put together."""
    out = ""
    for line in lines:
        line = " ".join(line.split())
        if not line:
            continue
        if out and cut_word(out):
            out = out.rstrip()[:-1] + line
        else:
            out = f"{out} {line}" if out else line
    return out


def paragraphs(ocr_lines: DataFrame, units: DataFrame) -> DataFrame:
    """(doc, paragraph_no, page, text): the running text of scanned documents in readable paragraphs.

    Running titles and page numbers are gone, misread words corrected, cut words put
    together. A block is a paragraph; one that does not end a sentence goes on in the
    next block if that begins in lower case, over the page too. Documents of problem 2
    are left out, a line id counts once, null texts are no lines, ties of line numbers
    go by id. Blocks are bounded by their page; the paragraphs of a document are found
    by a window, never collected.
    """
    rows = inspected(ocr_lines, None)
    fixes = corrections(rows, units).select("row_id", "wrong", "right").dropDuplicates(["row_id"])
    drop = running_titles(rows).select("row_id").withColumn("gone", F.lit(True))
    kept = rows.where("not number").select("row_id").distinct().join(drop, "row_id", "left").where("gone is null").select("row_id")
    lines = once(ocr_lines.select(F.col("ocr_line_id").cast("bigint").alias("row_id"), "doc", "page", "line_no", "block", "text").where("text is not null"), "row_id")
    lines = lines.join(kept, "row_id", "left_semi").join(fixes, "row_id", "left")

    def write(cols: dict[str, list]) -> dict[str, list]:
        texts = [corrected(t, a, b) for t, a, b in zip(cols["text"], cols["wrong"], cols["right"], strict=True)]
        return {n: cols[n] for n in ("doc", "page", "b", "line_no", "row_id")} | {"text": texts}

    flat = lines.withColumn("b", F.to_json("block")).select("doc", "page", "b", "line_no", "row_id", "text", "wrong", "right")
    fixed = arrow_map(flat, write, "doc string, page int, b string, line_no int, row_id bigint, text string")
    blocks = fixed.groupBy("doc", "page", "b").agg(F.sort_array(F.collect_list(F.struct("line_no", "row_id", "text"))).alias("lines"))

    def join(cols: dict[str, list]) -> dict[str, list]:
        texts = [joined([x["text"] for x in block]) for block in cols["lines"]]
        goes_on = [bool(t) and not _OPEN.search(t) for t in texts]
        return {"doc": cols["doc"], "page": cols["page"], "first": [b[0]["line_no"] for b in cols["lines"]], "text": texts, "open": goes_on, "fresh": [bool(_NEW.match(t)) for t in texts]}

    whole = arrow_map(blocks, join, "doc string, page int, first int, text string, open boolean, fresh boolean").where("text <> ''")
    order = Window.partitionBy("doc").orderBy("page", "first", "text")
    begins = F.col("fresh") | ~F.coalesce(F.lag("open").over(order), F.lit(False))
    numbered = whole.withColumn("begins", begins).withColumn("paragraph_no", F.sum(F.col("begins").cast("int")).over(order))
    parts = numbered.groupBy("doc", "paragraph_no").agg(F.min("page").alias("page"), F.sort_array(F.collect_list(F.struct("page", "first", "text"))).alias("parts"))

    def glue(cols: dict[str, list]) -> dict[str, list]:
        return {n: cols[n] for n in ("doc", "paragraph_no", "page")} | {"text": [joined([x["text"] for x in p]) for p in cols["parts"]]}

    return arrow_map(parts, glue, "doc string, paragraph_no bigint, page int, text string")


def repaired_units(ocr_lines: DataFrame, units: DataFrame) -> DataFrame:
    """(tab, row_id, text): the text of every OCR unit as one readable paragraph, each unit id once.

    Corrections, titles and page numbers are those of p3_found: misread words are
    corrected, a running title goes from the top of its unit, words cut within the unit
    are put together. A unit that was nothing but noise comes out empty. Documents of
    problem 2 and null texts are left out. A word cut at the end of a unit stays cut,
    for its rest is the text of another row.
    """
    rows = inspected(ocr_lines, units)
    fixes = corrections(rows, units, "units").select("row_id", "wrong", "right").dropDuplicates(["row_id"])
    titles = running_titles(rows).where("tab = 'units'").select("row_id", F.lit(True).alias("titled")).distinct()
    marks = rows.where("tab = 'units'").groupBy("row_id").agg(F.max("number").alias("number"))
    marks = marks.join(titles, "row_id", "left").join(fixes, "row_id", "left")
    texts = units.where("ocr and unit_id is not null and doc is not null and text is not null")
    texts = texts.groupBy(F.col("unit_id").cast("bigint").alias("row_id")).agg(F.min("text").alias("text"))

    def write(cols: dict[str, list]) -> dict[str, list]:
        out = []
        for text, number, titled, wrong, right in zip(*(cols[n] for n in ("text", "number", "titled", "wrong", "right")), strict=True):
            lines = corrected(text, wrong, right).split("\n")
            out.append("" if number else joined(lines[1:] if titled else lines))
        return {"tab": ["units"] * len(out), "row_id": cols["row_id"], "text": out}

    return arrow_map(texts.join(marks, "row_id"), write, "tab string, row_id bigint, text string")
