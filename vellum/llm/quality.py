"""Problem 2: what kind of text a document's lines are, and statistics of its words and confidence.

A hidden Markov model labels each line prose, list (list entries, index and contents
lines), table or junk. What it sees of a line is one symbol for each of a few simple
features, taken as independent given the label. It starts from the lines that a rule
finds clear, and only from those; Baum-Welch rounds over all lines then count what each
label shows and which follows which, each line by its share in every label; the clear
lines count once more, as they stand, so that a label keeps its meaning. Only those
counts (features x symbols x labels, a fixed number) come to the driver. Viterbi
decodes each page.

A page longer than PIECE lines is decoded in pieces with the same result as in one: for
every label before a piece and every label at its end the best score of the piece is
computed, the labels at the borders follow from these, and each piece is decoded between
its borders. The counting rounds take a piece as a chain of its own.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vellum.llm.shapes import latin_shape
from vellum.functions.text import is_syllable
from vellum.llm.common import arrow_map
from vellum.session import written

LABELS = ("prose", "list", "table", "junk")
#: Lines of a page that travel in one row.
PIECE = 512
#: Passes over all lines that refine the probabilities.
ROUNDS = 3

_LEAD = re.compile(r"\s*(?:([•*+·▪‣–—-])|(?:[a-zđ]|\d{1,3})[.)])\s+")
_INDEX = re.compile(r"(?:,\s*\d+)+\s*$")
_LEADERS = re.compile(r"\.{4,}|(?:\. ){4,}|…{2,}")
_END = re.compile(r"[.;:?!]\W*\Z")
_CELLS = re.compile(r" {2,}|\||\t")
_EDGES = ".,;:!?()[]{}<>\"'“”‘’«»|/\\-–—•*+=~^`_#°"
_PAGE = re.compile(r"\W*(?:trang\s+)?\d+(?:\s*/\s*\d+)?\W*\Z", re.IGNORECASE)
#: Frequent short words of other languages that are no Vietnamese syllables (fixed values).
_FOREIGN = frozenset("the of and is are be by with for shall which its this that des les est une dans sur sans pour qui der die das und ist für von".split())
SYMBOLS = (3, 4, 5, 4, 4, 3, 3)


_SYMBOL = re.compile(r"[^\w\s.,;:?!()\"“”'/-]")
_NUMBER = re.compile(r"(?:[.,%()|-]*\d[\d.,]*[.,%()|-]*|[-|])\Z")


@lru_cache(maxsize=300_000)
def _token(token: str) -> tuple[int, int, int, int]:
    """Of a token: whether it is a word, a known one, a number, and its letters."""
    word = token.strip(_EDGES).lower()
    number = int(bool(_NUMBER.match(token)))
    if not word or not word[0].isalpha():
        return 0, 0, number, 0
    return 1, int(is_syllable(word) or word in _FOREIGN), number, len(word)


def features(text: str) -> tuple[list[int], dict[str, float]]:
    """Symbols of a line (lead, end, words, numbers, words known, cells, first letter) and its counts."""
    f, count, letters, symbols, solid, known = _measured(latin_shape(text))
    return f, {"words": count, "letters": letters, "symbols": symbols, "chars": solid, "known": known, "ends": int(f[1] == 1)}


def _measured(line: str) -> tuple[list[int], int, int, int, int, int]:
    lead = _LEAD.match(line)
    tokens = line.split()
    count = known = numbers = letters = 0
    for a, b, c, d in map(_token, tokens):
        count += a
        known += b
        numbers += c
        letters += d
    solid = sum(map(len, tokens))
    symbols = len(_SYMBOL.findall(line))
    tail = 3 if "..." in line and _LEADERS.search(line) or "……" in line else 2 if line[-1:].isdigit() and _INDEX.search(line) else 1 if _END.search(line, max(0, len(line) - 4)) else 0
    share = known / max(1, count)
    spread = numbers / max(1, len(tokens))
    noise = symbols / max(1, solid)
    cells = len(_CELLS.findall(line.strip())) if "  " in line or "|" in line or "\t" in line else 0
    first = next((c for c in line if c.isalpha()), "1")
    out = [
        0 if not lead else 1 if lead.group(1) else 2,
        tail,
        0 if count == 0 else 1 if count <= 3 else 2 if count <= 7 else 3 if count <= 11 else 4,
        0 if spread < 0.15 else 1 if spread < 0.35 else 2 if spread < 0.6 else 3,
        0 if share >= 0.75 and noise < 0.15 and count else 1 if share >= 0.5 and noise < 0.25 and count else 2 if count else 3,
        0 if cells == 0 else 1 if cells < 3 else 2,
        0 if first.islower() else 1 if first.isupper() else 2,
    ]
    return out, count, letters, symbols, solid, known


def first_label(f: list[int]) -> int:
    """A label by rule for a line that is clear by itself, else -1; it only starts the counting."""
    lead, tail, count, spread, known, cells, first = f
    if cells == 2 or spread >= 3 and count <= 2:
        return 2
    if tail == 3:
        return 1
    if known >= 2 and cells == 0 and not lead:
        return 3
    if lead and count <= 2 and tail == 0 and known == 0:
        return 1
    if not lead and count >= 2 and spread == 0 and known == 0 and cells == 0 and tail < 2:
        return 0
    return -1


COUNTS = ("words", "letters", "symbols", "chars", "known", "ends")
#: Code of a line that is only a page number, which says nothing of its label.
NUMBER = -1


def _code(f: list[int]) -> int:
    code = 0
    for s, n in zip(f, SYMBOLS, strict=True):
        code = code * n + s
    return code


def _features_of(code: int) -> list[int]:
    out = []
    for n in reversed(SYMBOLS):
        code, s = divmod(code, n)
        out.append(s)
    return out[::-1]


def code_of(line: str) -> int:
    """All symbols of a line in Latin letters as one number."""
    if len(line) < 20 and _PAGE.match(line):
        return NUMBER
    a, b, c, d, e, f, g = _measured(line)[0]
    return ((((((a * 4 + b) * 5 + c) * 4 + d) * 4) + e) * 3 + f) * 3 + g  # as _code(), with SYMBOLS written out


def _codes(cols: dict[str, list]) -> dict[str, list]:
    return cols | {"code": [code_of(latin_shape(t)) for t in cols["text"]]}


def _symbols(cols: dict[str, list]) -> dict[str, list]:
    rows = [features(t) for t in cols["text"]]
    out = cols | {"code": [NUMBER if len(t) < 20 and _PAGE.match(latin_shape(t)) else _code(f) for t, (f, _) in zip(cols["text"], rows, strict=True)]}
    return out | {name: [c[name] for _, c in rows] for name in COUNTS}


def _coded(df: DataFrame, key: str, counts: bool) -> DataFrame:
    """Lines of a document with a text, with their code, and with counts if asked for."""
    rows = df.select("doc", "page", "line_no", F.col(key).cast("bigint").alias("id"), *([F.col("conf").cast("double").alias("conf")] if counts else []), "text")
    rows = rows.where(F.col("doc").isNotNull() & F.col("text").rlike(r"\S"))
    schema = "doc string, page int, line_no int, id bigint, code int"
    return arrow_map(rows, _symbols, schema + ", conf double, " + ", ".join(f"{c} bigint" for c in COUNTS)) if counts else arrow_map(rows, _codes, schema)


def _pages(coded: DataFrame) -> DataFrame:
    """(doc, page, piece, lines): the coded lines of each page in order, each line id once, in pieces of PIECE line numbers."""
    fields = ["line_no", "id", "code", *[c for c in ("conf", *COUNTS) if c in coded.columns]]
    piece = F.coalesce(F.floor(F.col("line_no") / PIECE).cast("int"), F.lit(-1)).alias("piece")
    return coded.groupBy("doc", "page", piece).agg(F.sort_array(F.collect_set(F.struct(*fields))).alias("lines"))


K = len(LABELS)
CODES = int(np.prod(SYMBOLS))


class Model:
    """Probabilities of a page's first label, of a label given the one before, and of each symbol given a label."""

    def __init__(self, start: np.ndarray, trans: np.ndarray, emit: list[np.ndarray]):
        self.start, self.emit = start / start.sum(), [e / e.sum(1, keepdims=True) for e in emit]
        # a floor keeps steps possible that a corpus of one kind would never take
        self.trans = trans / trans.sum(1, keepdims=True) * 0.9 + 0.1 / K
        seen = np.zeros((*SYMBOLS, K))
        for axis, e in enumerate(self.emit):
            shape = [1] * len(SYMBOLS) + [K]
            shape[axis] = -1
            seen = seen + np.log(e.T).reshape(shape)
        #: Log probability of every code under every label; the last row is a page number, which says nothing.
        self.seen = np.vstack([seen.reshape(CODES, K), np.zeros((1, K))])


def _steps(ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[int]]:
    """Chains that end at the given places, longest first: their order, where each begins, and how many have a line at each step."""
    begins = np.concatenate([[0], ends[:-1]])
    length = ends - begins
    order = np.argsort(-length, kind="stable")
    longest = int(length.max()) if len(length) else 0
    active = np.searchsorted(-length[order], -np.arange(longest), "left")
    return order, begins[order], active.tolist()


def expected(codes: np.ndarray, ends: np.ndarray, model: Model) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first labels, steps, codes x labels): how often each is to be expected in chains of codes, by the forward-backward method over all chains at once."""
    order, begins, active = _steps(ends)
    shown = np.exp(model.seen[codes])
    ahead, scale = np.zeros((len(codes), K)), np.ones((len(codes), 1))
    for t, n in enumerate(active):
        at = begins[:n] + t
        now = (model.start if t == 0 else ahead[at - 1] @ model.trans) * shown[at]
        scale[at] = now.sum(1, keepdims=True)
        ahead[at] = now / scale[at]
    back, steps = np.ones((len(codes), K)), np.zeros((K, K))
    for t in range(len(active) - 1, 0, -1):
        at = begins[: active[t]] + t
        after = shown[at] * back[at] / scale[at]
        back[at - 1] = after @ model.trans.T
        steps += ahead[at - 1].T @ after
    share = ahead * back
    counts = np.stack([np.bincount(codes, share[:, k], CODES + 1) for k in range(K)], 1)
    return share[begins].sum(0), steps * model.trans, counts


def clear(codes: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The same counts from lines that the rule finds clear, and from steps between two of them."""
    label = _by_rule()[codes]
    first = np.zeros(len(codes), bool)
    first[np.concatenate([[0], ends[:-1]])] = True
    sure = label >= 0
    start = np.bincount(label[first & sure], minlength=K).astype(float)
    pair = sure[1:] & sure[:-1] & ~first[1:]
    steps = np.bincount(label[:-1][pair] * K + label[1:][pair], minlength=K * K).reshape(K, K).astype(float)
    counts = np.zeros((CODES + 1, K))
    np.add.at(counts, (codes[sure], label[sure]), 1.0)
    return start, steps, counts


@lru_cache(maxsize=1)
def _by_rule() -> np.ndarray:
    return np.array([first_label(_features_of(c)) for c in range(CODES)] + [-1])


def _chains(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Codes of all pieces of a batch, a page number as the last code, and where each piece ends."""
    lines = batch.column("lines")
    codes = pc.struct_field(lines.flatten(), "code").to_numpy(zero_copy_only=False).astype(np.int64)
    return np.where(codes == NUMBER, CODES, codes), np.cumsum(pc.list_value_length(lines).to_numpy(zero_copy_only=False))


_COUNTED = pa.schema([("kind", pa.int32()), ("a", pa.int32()), ("b", pa.int32()), ("n", pa.float64())])


Counts = tuple[np.ndarray, np.ndarray, list[np.ndarray]]


def _counted(pages: DataFrame, model: Model | None) -> Counts:
    """(first labels, steps, symbols of each feature) counted over all pages: of the clear lines, or what a model expects of every line.

    Each task gives out its counts once; their number is that of SYMBOLS times the labels.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        start, steps, counts = np.zeros(K), np.zeros((K, K)), np.zeros((CODES + 1, K))
        for batch in batches:
            codes, ends = _chains(batch)
            if len(codes):
                for sum_, part in zip((start, steps, counts), clear(codes, ends) if model is None else expected(codes, ends, model), strict=True):
                    sum_ += part
        rows = [(0, 0, k, start[k]) for k in range(K)] + [(1, i, j, steps[i, j]) for i in range(K) for j in range(K)]
        shaped = counts[:CODES].reshape(*SYMBOLS, K)
        for axis, n in enumerate(SYMBOLS):
            by = shaped.sum(tuple(i for i in range(len(SYMBOLS)) if i != axis))
            rows += [(2 + axis, k, x, by[x, k]) for k in range(K) for x in range(n)]
        yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows, strict=True), _COUNTED, strict=True)], schema=_COUNTED)

    start, trans, emit = np.zeros(K), np.zeros((K, K)), [np.zeros((K, n)) for n in SYMBOLS]
    rows = pages.select("lines").mapInArrow(count, "kind int, a int, b int, n double").groupBy("kind", "a", "b").agg(F.sum("n").alias("n"))
    for r in rows.collect():
        if r["kind"] == 0:
            start[r["b"]] += r["n"]
        elif r["kind"] == 1:
            trans[r["a"], r["b"]] += r["n"]
        else:
            emit[r["kind"] - 2][r["a"], r["b"]] += r["n"]
    return start, trans, emit


def _fitted(*counts: Counts) -> Model:
    """The model of the sum of counts; what was never seen is possible."""
    start, trans, emit = np.ones(K), np.ones((K, K)), [np.full((K, n), 0.5) for n in SYMBOLS]
    for a, b, c in counts:
        start, trans, emit = start + a, trans + b, [x + y for x, y in zip(emit, c, strict=True)]
    return Model(start, trans, emit)


def viterbi(codes: np.ndarray, ends: np.ndarray, model: Model, entry: np.ndarray | None = None, leave: np.ndarray | None = None) -> np.ndarray:
    """The most probable labels of the lines of all chains at once.

    entry: the label before each chain, -1 where it begins a page; leave: the label of
    its last line, -1 where it is free. Ties go to the first of LABELS.
    """
    order, begins, active = _steps(ends)
    out = np.zeros(len(codes), np.int64)
    if not len(codes):
        return out
    log = np.log(model.trans)
    first = np.tile(np.log(model.start), (len(ends), 1)) if entry is None else np.where((entry < 0)[:, None], np.log(model.start), log[np.maximum(entry, 0)])
    score, back = first[order], np.zeros((len(codes), K), np.int8)
    for t, n in enumerate(active):
        at = begins[:n] + t
        if t:
            paths = score[:n, :, None] + log
            back[at] = paths.argmax(1)
            score[:n] = paths.max(1)
        score[:n] += model.seen[codes[at]]
    last = score.argmax(1)
    if leave is not None:
        last = np.where(leave[order] < 0, last, leave[order])
    for t in range(len(active) - 1, -1, -1):
        n, longer = active[t], active[t + 1] if t + 1 < len(active) else 0
        at = begins[:n] + t
        out[at] = last[:n]
        if longer:
            out[at[:longer]] = back[at[:longer] + 1, out[at[:longer] + 1]]
    return out


def crossing(codes: np.ndarray, ends: np.ndarray, model: Model, begin: np.ndarray) -> np.ndarray:
    """Of each chain the best score from every label before it to every label at its end; of one that begins a page, from its start in every row."""
    order, begins, active = _steps(ends)
    log = np.log(model.trans)
    score = np.where(begin[order][:, None, None], np.log(model.start), log)
    for t, n in enumerate(active):
        if t:
            score[:n] = (score[:n, :, :, None] + log).max(2)
        score[:n] += model.seen[codes[begins[:n] + t]][:, None, :]
    out = np.empty_like(score)
    out[order] = score
    return out


def borders(crossings: list[np.ndarray]) -> list[int]:
    """The label at the end of every piece of a page on its best path."""
    score, back = crossings[0][0], []
    for step in crossings[1:]:
        paths = score[:, None] + step
        back.append(paths.argmax(0))
        score = paths.max(0)
    out = [int(score.argmax())]
    for b in reversed(back):
        out.append(int(b[out[-1]]))
    return out[::-1]


_KEY = "doc string, page int, piece int"


def _bordered(pages: DataFrame, model: Model) -> DataFrame:
    """pages with (entry, leave): the labels at the borders of the pieces of pages that have several; null elsewhere.

    A page is one row here with 16 numbers for each of its pieces. Both tables that meet
    the pages are written first, so that their size is known when the joins are planned.
    """
    place = F.struct(F.col("page").alias("page"))
    several = pages.groupBy("doc", "page").agg(F.count("*").alias("_n"), F.min("piece").alias("_first")).where("_n > 1")
    several = written(several.select(F.col("doc").alias("_doc"), F.col("page").alias("_page"), "_first"))
    parts = pages.join(several, (F.col("doc") == F.col("_doc")) & F.col("page").eqNullSafe(F.col("_page"))).withColumn("begin", F.col("piece") == F.col("_first"))

    def cross(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes, ends = _chains(batch)
            best = crossing(codes, ends, model, batch.column("begin").to_numpy(zero_copy_only=False).astype(bool))
            yield pa.RecordBatch.from_arrays([batch.column("doc"), batch.column("page"), batch.column("piece"), pa.array(best.reshape(len(best), K * K).tolist(), pa.list_(pa.float64()))], names=["doc", "page", "piece", "best"])

    def solve(cols: dict[str, list]) -> dict[str, list]:
        out: dict[str, list] = {"doc": [], "page": [], "piece": [], "entry": [], "leave": []}
        for doc, page, parts in zip(cols["doc"], cols["page"], cols["parts"], strict=True):
            leave = borders([np.array(x["best"]).reshape(K, K) for x in parts])
            n = len(leave)
            for name, values in zip(out, ([doc] * n, [page] * n, [x["piece"] for x in parts], [-1, *leave[:-1]], leave), strict=True):
                out[name] += values
        return out

    crossed = parts.select("doc", "page", "piece", "begin", "lines").mapInArrow(cross, f"{_KEY}, best array<double>")
    ordered = crossed.groupBy("doc", "page").agg(F.sort_array(F.collect_list(F.struct("piece", "best"))).alias("parts"))
    found = written(arrow_map(ordered, solve, f"{_KEY}, entry int, leave int")).withColumn("_at", place).drop("page")
    return pages.withColumn("_at", place).join(found, ["doc", "_at", "piece"], "left").select(*pages.columns, "entry", "leave")


def label_lines(df: DataFrame, key: str = "ocr_line_id") -> DataFrame:
    """Every line with its label: (doc, page, line_no, id, label, page_number, conf, COUNTS).

    A line id counts once; null and blank texts are no lines and are left out, as are
    lines without a document. Lines without a number come first on their page, by id.
    Ties between labels go to the first of LABELS. A page is decoded on its own.
    """
    return labelled(_coded(df, key, True))


def model_of(pages: DataFrame, rounds: int = ROUNDS) -> Model:
    """Probabilities from the clear lines of all pages, refined over all lines."""
    sure = _counted(pages, None)
    model = _fitted(sure)
    for _ in range(rounds):
        model = _fitted(sure, _counted(pages, model))
    return model


def labelled(coded: DataFrame) -> DataFrame:
    """Coded lines (doc, page, line_no, id, code, ...) with label and page_number."""
    counts = "conf" in coded.columns
    pages = written(_pages(coded))
    model = model_of(pages)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes, ends = _chains(batch)
            entry, leave = (batch.column(n).fill_null(-1).to_numpy(zero_copy_only=False) for n in ("entry", "leave"))
            labels = viterbi(codes, ends, model, entry, leave)
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]), pa.int32()), pa.array(labels, pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column("doc"), batch.column("page"), batch.column("lines"), lists], names=["doc", "page", "lines", "labels"])

    kind = pages.schema["lines"].dataType.simpleString()
    decoded = _bordered(pages, model).select("doc", "page", "lines", "entry", "leave").mapInArrow(decode, f"doc string, page int, lines {kind}, labels array<int>")
    one = decoded.select("doc", "page", F.explode(F.arrays_zip("lines", "labels")).alias("x"))
    named = F.element_at(F.array(*map(F.lit, LABELS)), F.col("x.labels") + 1)
    fields = [F.col(f"x.lines.{c}").alias(c) for c in ("line_no", "id", *(("conf", *COUNTS) if counts else ()))]
    return one.select("doc", "page", *fields, named.alias("label"), (F.col("x.lines.code") == NUMBER).alias("page_number"))


def document_statistics(df: DataFrame, key: str = "ocr_line_id") -> DataFrame:
    """One row per document: its lines, words, mean word length, shares of symbols, of known words, of lines with an end mark, of each label, and mean confidence.

    Shares are over the document's lines that are more than a page number. A document
    without such lines has null shares; null confidences are left out of the mean.
    """
    lines = label_lines(df, key)
    told = ~F.col("page_number")
    share = [F.avg(F.when(told, (F.col("label") == n).cast("double"))).alias(f"{n}_share") for n in LABELS]
    return lines.groupBy("doc").agg(
        F.count("*").alias("lines"),
        F.sum("words").alias("words"),
        (F.sum("letters") / F.nullif(F.sum("words"), F.lit(0))).alias("mean_word_length"),
        (F.sum("symbols") / F.nullif(F.sum("chars"), F.lit(0))).alias("symbol_ratio"),
        (F.sum("known") / F.nullif(F.sum("words"), F.lit(0))).alias("known_words"),
        F.avg(F.when(told, F.col("ends"))).alias("ended_lines"),
        F.avg("conf").alias("mean_conf"),
        *share,
    )


def no_prose(coded: DataFrame) -> DataFrame:
    """(doc): documents of whose coded lines less than half are prose; page numbers do not count."""
    lines = labelled(coded.select("doc", "page", "line_no", "id", "code")).where("not page_number")
    return lines.groupBy("doc").agg(F.avg((F.col("label") == "prose").cast("double")).alias("prose")).where("prose < 0.5").select("doc")


def found(df: DataFrame, key: str = "ocr_line_id") -> DataFrame:
    """p2_found: documents of whose lines more than half are no running sentences."""
    return no_prose(_coded(df, key, False))
