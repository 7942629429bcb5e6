"""Problem 7: passages of held-out test items inside training documents.

Q-gram lemma filtering. Items and documents are reduced to base letters and digits
with one space between words. Every q-gram that a document shares with an item is a
hit on a diagonal (its place in the document less its place in the item); a passage of
L characters with e words exchanged keeps L - q + 1 - e * (q - 1 + word length) hits at
least, all within a band of diagonals as wide as exchanges can shift them. Hits are
counted in bands that overlap by half; a band that reaches the bound is a region, and
regions are verified by banded alignment of the words.

The documents are read once to count the hits of each pair, and once more for the pairs
whose hits on all diagonals together reach the bound, however many items there are. A
bit table of the items' grams, of a bounded size, goes to the tasks; grams of a document
that it knows, and that stand closely enough for any bound to be met, are joined with
the items' grams by their hash, and the hits of a pair are counted where they arise.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vellum.functions.text import strip_accents
from vellum.llm.common import arrow_map
from vellum.llm.shapes import IGNORABLE, latin_shape
from vellum.session import written

#: Lengths of q-grams; the first is taken with which the lemma has a bound of 1 at least for every item.
QS = (22, 18, 14, 10, 6)
#: Diagonals of a band in characters; bands begin every half of that.
BAND = 64
#: Bits of the table of the items' grams: 2 to this power, as the number of grams needs, within these limits (2 MB at most).
BITS = (16, 24)
_WORD = re.compile(r"[a-z0-9]+")


def words_of(text: str) -> list[str]:
    """Words of base letters and digits, lower case; words of other scripts are none."""
    return _WORD.findall(strip_accents(latin_shape(text)).lower())


_SPACE, _END, _DROP = 0, 1, 255


@lru_cache(maxsize=1)
def _fold_table() -> np.ndarray:
    """For every character of the basic plane the base letter or digit it is compared as, a separator, or nothing."""
    table = np.zeros(1 << 16, np.uint8)
    for code in range(1 << 16):
        c = chr(code)
        if c in IGNORABLE or unicodedata.combining(c):
            table[code] = _DROP
        elif not 0xD800 <= code < 0xE000 and len(base := strip_accents(latin_shape(c)).lower()) == 1 and base.isascii() and base.isalnum():
            table[code] = ord(base)
    table[0xFFFF] = _END
    return table


def folded(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, begins): the words of all texts as words_of() gives them, with one space between words and a line feed after each text."""
    codes = np.frombuffer("".join(t + "\uffff" for t in (x.replace("\uffff", " ") for x in texts)).encode("utf-32-le", "surrogatepass"), np.uint32)
    b = _fold_table()[np.where(codes < 1 << 16, codes, 0x20)]
    b = b[b != _DROP]
    letter = b > _END
    keep = b != _SPACE
    keep[1:] |= letter[:-1]
    b = b[keep]
    space = b == _SPACE
    space[:-1] &= b[1:] == _END
    b = b[~space]
    out = np.where(b == _SPACE, 32, np.where(b == _END, 10, b)).astype(np.uint8)
    return out, np.concatenate([[0], np.flatnonzero(b == _END) + 1])


def _grams(data: np.ndarray, q: int) -> np.ndarray:
    """A 64-bit hash of every q-gram of a byte array."""
    n = len(data) - q + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for k in range(q):
        out *= np.uint64(0x9E3779B97F4A7C15)
        out += data[k : k + n]
        out ^= out >> np.uint64(29)
    return out


def bound(words: list[str], q: int, least: int, exchanged: float) -> int:
    """Hits that any passage of `least` words keeps, so many of them exchanged: the shortest stretch less the grams that the longest words would take."""
    ends = np.cumsum([0] + [len(w) + 1 for w in words])
    shortest = int((ends[least:] - ends[:-least]).min()) - 1
    wrong = int(least * exchanged)
    return shortest - q + 1 - sum(sorted((len(w) for w in words), reverse=True)[:wrong]) - wrong * (q - 1)


def _prepared(items: DataFrame, least: int, exchanged: float) -> DataFrame:
    """(item_id, words, bounds, stretch): items long enough, the bound for each of QS, and the longest stretch of `least` words."""

    def prepare(cols: dict[str, list]) -> dict[str, list]:
        out: dict[str, list] = {"item_id": [], "words": [], "bounds": [], "stretch": []}
        for key, text in zip(cols["item_id"], cols["text"], strict=True):
            words = words_of(text)
            if len(words) >= least:
                ends = np.cumsum([0] + [len(w) + 1 for w in words])
                row = key, " ".join(words), [bound(words, q, least, exchanged) for q in QS], int((ends[least:] - ends[:-least]).max())
                for values, v in zip(out.values(), row, strict=True):
                    values.append(v)
        return out

    return arrow_map(items, prepare, "item_id bigint, words string, bounds array<int>, stretch int")


def _item_grams(items: DataFrame, q: int) -> DataFrame:
    def cut(cols: dict[str, list]) -> dict[str, list]:
        grams = [_grams(np.frombuffer(w.encode(), np.uint8), q).view(np.int64) for w in cols["words"]]
        owner = np.repeat(np.array(cols["item_id"], np.int64), [len(g) for g in grams])
        return {"gram": np.concatenate(grams), "item_id": owner, "in_item": np.concatenate([np.arange(len(g)) for g in grams])} if grams else {}

    return arrow_map(items.select("item_id", "words"), cut, "gram bigint, item_id bigint, in_item int")


def _slots(grams: np.ndarray, bits: int) -> np.ndarray:
    return (grams.view(np.uint64) >> np.uint64(64 - bits)).astype(np.int64)


def _bit_table(grams: DataFrame, bits: int) -> np.ndarray:
    """The slots of all grams as packed bits; each task gives out those of its own grams once, and 2 ** bits of them come to the driver at most."""

    def slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(1 << bits, bool)
        for batch in batches:
            seen[_slots(batch.column("gram").to_numpy(), bits)] = True
        found = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(found // 32768 + 1), pa.array(found % 32768)], names=["bucket", "bit"])

    rows = grams.select("gram").mapInArrow(slots, "bucket bigint, bit bigint").groupBy("bucket").agg(F.bitmap_construct_agg("bit").alias("bits"))
    out = np.zeros((1 << bits) // 8, np.uint8)
    for r in rows.collect():
        part = np.frombuffer(bytes(r["bits"]), np.uint8)
        begin = (r["bucket"] - 1) * 4096
        out[begin : begin + 4096] = part[: len(out) - begin]
    return out


def dense(at: np.ndarray, owner: np.ndarray, width: int, least: int) -> np.ndarray:
    """Which of the places (in order) lie in a window of so many characters that holds `least` of them, all with one owner."""
    last = np.minimum(np.searchsorted(at, at + width, "left"), np.searchsorted(owner, owner, "right"))
    full = np.flatnonzero(last - np.arange(len(at)) >= least)
    depth = np.zeros(len(at) + 1, np.int64)
    np.add.at(depth, full, 1)
    np.add.at(depth, last[full], -1)
    return np.cumsum(depth)[:-1] > 0


_HITS = pa.schema([("gram", pa.int64()), ("doc_id", pa.int64()), ("in_doc", pa.int64())])


def _document_grams(texts: DataFrame, q: int, bits: int, table: np.ndarray, width: int, least: int) -> DataFrame:
    """(gram, doc_id, in_doc): grams of documents that an item may have, where enough of them stand together."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, texts = batch.column("doc_id").to_numpy(), batch.column("text").to_pylist()
            for a, b in pieces(texts):
                data, begins = folded(texts[a:b])
                g = _grams(data, q)
                slot = _slots(g, bits)
                at = np.flatnonzero((table[slot >> 3] >> (slot & 7).astype(np.uint8)) & 1)
                doc = np.searchsorted(begins, at, "right") - 1
                # grams over the end of a text are none of it
                inside = at + q < begins[doc + 1]
                at, doc = at[inside], doc[inside]
                kept = dense(at, doc, width, least)
                at, doc = at[kept], doc[kept]
                if len(at):
                    yield pa.RecordBatch.from_arrays([pa.array(g[at].view(np.int64)), pa.array(keys[a + doc]), pa.array(at - begins[doc])], schema=_HITS)

    return texts.mapInArrow(search, "gram bigint, doc_id bigint, in_doc bigint")


def _begins(words: list[str]) -> np.ndarray:
    return np.cumsum([0] + [len(w) + 1 for w in words])[:-1]


class Item:
    """Words, sorted grams and places of an item that documents are compared with."""

    def __init__(self, words: str, q: int):
        self.words = words.split(" ")
        self.grams = _grams(np.frombuffer(words.encode(), np.uint8), q)
        self.begins = _begins(self.words)


def regions(ranked: np.ndarray, order: np.ndarray, begins: np.ndarray, item: Item, least: int) -> list[int]:
    """The shifts in words of the bands of diagonals that hold hits enough, those with most hits first.

    ranked, order, begins: the sorted grams of a document, their places, and where its words begin.
    """
    first, last = np.searchsorted(ranked, item.grams, "left"), np.searchsorted(ranked, item.grams, "right")
    n = last - first
    if n.sum() < least:
        return []
    place = np.repeat(np.arange(len(n)), n)
    at = order[np.repeat(first - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())]
    half = (at - place + len(n)) // (BAND // 2)
    # each hit lies in the band that begins at its half and in the one before
    count = np.bincount(half + 1)
    count[:-1] += count[1:]
    full = np.flatnonzero(count >= least)
    shifts: dict[int, None] = {}
    for b in full[np.argsort(-count[full], kind="stable")]:
        mine = (half == b) | (half + 1 == b)
        shift = np.searchsorted(begins, at[mine], "right") - np.searchsorted(item.begins, place[mine], "right")
        shifts[int(np.median(shift))] = None
    return list(shifts)


def aligned(item: list[str], text: list[str], shift: int, least: int, width: int = 12, tolerance: float = 0.125) -> bool:
    """Whether the text holds `least` words in a row of the item, up to a share of exchanged words.

    Banded local alignment around the given shift, a match for 1, an exchanged, missing
    or added word for -1.5; then the longest stretch of item words on the best paths
    that begins and ends with matches and keeps within the tolerance.
    """
    n, m = len(item), len(text)
    best = 0
    # of every cell: its score, and its path back as (path before, item word, whether it matches)
    paths: dict[int, tuple[float, tuple | None]] = {}
    for i in range(n):
        now: dict[int, tuple[float, tuple | None]] = {}
        left: tuple[float, tuple | None] = (0.0, None)
        for j in range(max(0, i + shift - width), min(m, i + shift + width + 1)):
            diag = paths.get(j - 1, (0.0, None))
            up = paths.get(j, (0.0, None))
            same = item[i] == text[j]
            cell = (diag[0] + (1.0 if same else -1.5), (diag[1], i, same))
            if up[0] - 1.5 > cell[0]:
                cell = (up[0] - 1.5, (up[1], i, False))
            if left[0] - 1.5 > cell[0]:
                cell = (left[0] - 1.5, left[1])
            if cell[0] <= 0:
                cell = (0.0, None)
            now[j] = left = cell
            if same and cell[0] >= least * (1 - 2.5 * tolerance) - 1e-9:
                best = max(best, _stretch(cell[1], tolerance))
                if best >= least:
                    return True
        paths = now
    return False


def _stretch(path: tuple | None, tolerance: float) -> int:
    """Item words of the longest stretch, from the end of a path back, that keeps within the tolerance and begins with a match."""
    longest, wrong, end = 0, 0, path[1] if path else 0
    while path is not None:
        path, i, same = path
        wrong += not same
        length = end - i + 1
        if same and wrong <= tolerance * length:
            longest = max(longest, length)
    return longest


def pieces(texts: list[str], chars: int = 2_000_000) -> Iterator[tuple[int, int]]:
    """Stretches of a list of at most so many characters, or of one text."""
    start = size = 0
    for i, t in enumerate(texts):
        if size and size + len(t) > chars:
            yield start, i
            start, size = i, 0
        size += len(t)
    if start < len(texts):
        yield start, len(texts)


def leaked_passages(documents: DataFrame, items: DataFrame, least: int = 30, exchanged: float = 0.1) -> DataFrame:
    """(doc_id, item_id): each document that holds `least` words in a row of an item, up to about `exchanged` of them replaced.

    Letter case, accents, punctuation, line breaks and character form do not count.
    Items of fewer words are no cases. Null ids and null or empty texts give no rows;
    every document, copies too, counts for itself, a repeated doc_id once. Tables
    without rows give none. Whole texts are read, of any length.
    """
    asked = items.select(F.col("item_id").cast("bigint").alias("item_id"), F.col("text").alias("text")).where("item_id is not null and text is not null")
    asked = written(_prepared(asked, least, exchanged))
    texts = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").alias("text")).where("doc_id is not null and text is not null")
    told = asked.agg(*[F.min(F.col("bounds")[i]).alias(f"b{i}") for i in range(len(QS))], F.max("stretch").alias("stretch"), F.max(F.length("words")).alias("longest"), F.sum(F.length("words")).alias("chars")).first()
    if told["stretch"] is None:
        return texts.join(asked, texts["doc_id"] == asked["item_id"]).select("doc_id", "item_id").where("false")
    use = next((i for i in range(len(QS)) if told[f"b{i}"] >= 1), len(QS) - 1)
    q, lowest = QS[use], max(1, told[f"b{use}"])
    # bands are counted in the next shorter grams: fewer hits are lost to an exchange
    fine = min(use + 1, len(QS) - 1)
    bits = min(BITS[1], max(BITS[0], int(told["chars"]).bit_length() + 6))
    grams = _item_grams(asked, q)
    hits = _document_grams(texts, q, bits, _bit_table(grams, bits), told["stretch"] + BAND, lowest).join(grams, "gram")
    counted = hits.groupBy("doc_id", "item_id").agg(F.count("*").alias("n")).join(asked, "item_id").where(F.col("n") >= F.greatest(F.lit(1), F.col("bounds")[use]))
    # written, so that its size is known: the texts are moved only if it is large
    asks = written(counted.groupBy("doc_id").agg(F.collect_list(F.struct("item_id", "words", F.col("bounds")[fine].alias("bound"))).alias("asked")))

    def verify(cols: dict[str, list]) -> dict[str, list]:
        out: dict[str, list] = {"doc_id": [], "item_id": []}
        items: dict[int, Item] = {}
        for key, text, asked in zip(cols["doc_id"], cols["text"], cols["asked"], strict=True):
            words = words_of(text)
            grams = _grams(np.frombuffer(" ".join(words).encode(), np.uint8), QS[fine])
            order = np.argsort(grams, kind="stable")
            ranked, begins = grams[order], _begins(words)
            for x in asked:
                item = items.get(x["item_id"]) or items.setdefault(x["item_id"], Item(x["words"], QS[fine]))
                if any(aligned(item.words, words, shift, least) for shift in regions(ranked, order, begins, item, max(1, x["bound"]))):
                    out["doc_id"].append(key)
                    out["item_id"].append(x["item_id"])
        return out

    return arrow_map(texts.join(asks, "doc_id"), verify, "doc_id bigint, item_id bigint").distinct()


def found(documents: DataFrame, items: DataFrame) -> DataFrame:
    """p7_found: the documents with the items that leaked."""
    return leaked_passages(documents, items)
