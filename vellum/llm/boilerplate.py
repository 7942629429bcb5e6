"""Problem 1: lines repeated across the documents of one origin.

Every line is parsed into a template by a token tree of fixed depth. A line goes down
from its origin along its first DEPTH tokens, one level each, where a number takes the
wildcard branch; the leaf holds templates. A line joins the template of its leaf that
has the same words, and a number in which it differs from that template becomes a
wildcard slot there. Every partition grows a tree of its own over all its batches; two
trees are merged node by node, in any order with the same result. What comes out of a
tree is each template with the documents it covers, and the trees of all partitions are
merged by a grouping on (origin, template), for their documents do not fit one task.
Templates that cover enough documents of the origin are removed.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from hashlib import blake2b

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vellum.functions.columns import WS
from vellum.llm.common import arrow_map
from vellum.llm.shapes import IGNORABLE, LOOKALIKE, SPACES, WIDTH, latin_shape
from vellum.session import written

#: Levels of tokens below the origin.
DEPTH = 3
#: What stands for a number.
SLOT = "0"
#: What stands in a template for numbers that differ: a character for private use, which no text is taken to have.
WILD = "\ue000"
#: Templates with their documents that the tree of a partition holds before it is given out and begun again.
HELD = 200_000
_TOKEN = re.compile(r"\d+|[^\W\d_]+|[^\w\s]|_")
_NUMBER = re.compile(r"\d+")


def _bare(text: str) -> str:
    """A line without letter case, character form and the marks and spaces behind its wording; a line of marks only keeps them."""
    line = latin_shape(text).lower()
    end = len(line)
    while end and not line[end - 1].isalnum():
        end -= 1
    return line[:end] or line


def template(text: str) -> str:
    """The wording of a line: its words, numbers and marks, with a slot for every number."""
    return " ".join(_TOKEN.findall(_NUMBER.sub(SLOT, _bare(text))))


class TokenTree:
    """Origin, then one level for each of the first DEPTH tokens of a template; below them a leaf maps the words of a template to [tokens, documents].

    A token of a template is a word, a number that all its lines share, or WILD where
    their numbers differ: a wildcard slot. A template of fewer tokens has its leaf under
    None. Tokens are kept as the line they came from until another line differs, and as
    nothing once every number is a slot. Documents are one name, or a dict of names once
    there are several.
    """

    def __init__(self) -> None:
        self.root: dict = {}
        self.held = 0

    def add(self, origin: str, doc: str, line: str) -> None:
        bare = _bare(line)
        words = _TOKEN.findall(_NUMBER.sub(SLOT, bare))
        if words:
            key = " ".join(words)
            self._put(origin, words, key, bare if SLOT in words else key, (doc,))

    def _put(self, origin: str, words: list[str], key: str, found: str, docs) -> None:
        leaf = self.root.get(origin)
        if leaf is None:
            leaf = self.root[origin] = {}
        for token in words[:DEPTH]:
            child = leaf.get(token)
            if child is None:
                child = leaf[token] = {}
            leaf = child
        if len(words) < DEPTH:
            leaf = leaf.setdefault(None, {})
        known = leaf.get(key)
        if known is None:
            first, *docs = docs
            known = leaf[key] = [found, first]
            self.held += 1
        elif known[0] is not None and known[0] != found and SLOT in words:
            same = [a if a == b else WILD for a, b in zip(_TOKEN.findall(known[0]), _TOKEN.findall(found), strict=True)]
            known[0] = " ".join(same) if any(w == SLOT and t != WILD for w, t in zip(words, same, strict=True)) else None
        for doc in docs:
            if isinstance(known[1], str):
                if known[1] == doc:
                    continue
                known[1] = {known[1]: None}
            before = len(known[1])
            known[1][doc] = None
            self.held += len(known[1]) - before

    def leaves(self) -> Iterator[tuple[str, str, str, tuple[str, ...]]]:
        """(origin, words with slots, tokens, documents) of every template."""

        def below(node: dict, depth: int) -> Iterator[tuple[str, list]]:
            if depth == DEPTH:
                yield from node.items()
                return
            for token, child in node.items():
                yield from child.items() if token is None else below(child, depth + 1)

        for origin, node in self.root.items():
            for key, (found, docs) in below(node, 0):
                if found is None:
                    found = " ".join([WILD if w == SLOT else w for w in key.split(" ")])
                elif found != key:
                    found = " ".join(_TOKEN.findall(found))
                yield origin, key, found, (docs,) if isinstance(docs, str) else tuple(docs)

    def merge(self, other: TokenTree) -> TokenTree:
        """This tree with all templates of another; the order of merging does not matter."""
        for origin, key, found, docs in other.leaves():
            self._put(origin, key.split(" "), key, found, docs)
        return self


def _key(found: str) -> bytes:
    return blake2b(found.encode(), digest_size=16).digest()


_COVERED = pa.schema([("origin", pa.string()), ("doc", pa.string()), ("template", pa.binary())])


def _trees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The tree of a partition as rows (origin, doc, template), each once; a tree grown large is given out before the next begins."""

    def out(tree: TokenTree) -> Iterator[pa.RecordBatch]:
        cols: tuple[list, list, list] = ([], [], [])
        for origin, key, _, docs in tree.leaves():
            cols[0].extend([origin] * len(docs))
            cols[1].extend(docs)
            cols[2].extend([_key(key)] * len(docs))
        if cols[0]:
            yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(cols, _COVERED, strict=True)], schema=_COVERED)

    tree = TokenTree()
    for batch in batches:
        for origin, doc, text in zip(*(batch.column(n).to_pylist() for n in ("origin", "doc", "text")), strict=True):
            tree.add(origin, doc, text)
        if tree.held >= HELD:
            yield from out(tree)
            tree = TokenTree()
    yield from out(tree)


def _keys(cols: dict[str, list]) -> dict[str, list]:
    found = [template(t) if t else "" for t in cols["text"]]
    return cols | {"template": [_key(f) if f else None for f in found]}


def repeated_lines(lines: DataFrame, share: float = 0.2, least: int = 3) -> DataFrame:
    """(line_id): lines whose template stands in at least `share` of the documents of their origin, and in at least `least`.

    Lines without origin, document or text repeat nothing and are not counted; lines
    of punctuation only are templates too; a repeated line_id is given once. Documents
    are counted over all lines of the origin. An empty table gives no rows. No group is
    collected anywhere: a hot origin is spread over its templates, and each template
    reaches the shuffle once per document from each partition.
    """
    text = lines.where("origin is not null and doc is not null and text is not null").select("line_id", "origin", "text")
    keyed = arrow_map(text, _keyed, "line_id bigint, origin string, template binary")
    return keyed.join(_covering(lines, share, least), ["origin", "template"], "left_semi").select("line_id").distinct()


def _keyed(cols: dict[str, list]) -> dict[str, list]:
    out = _keys(cols)
    return {"line_id": out["line_id"], "origin": out["origin"], "template": out["template"]}


def _covering(lines: DataFrame, share: float, least: int) -> DataFrame:
    """(origin, template): templates that stand in documents enough of their origin.

    Written as a table: the engine then knows its size before it plans the join with
    the lines, and moves the lines only if it is large.
    """
    rows = lines.select("origin", "doc", "text").where("origin is not null and doc is not null")
    docs = rows.select("origin", "doc").distinct().groupBy("origin").agg(F.count("*").alias("_docs"))
    merged = rows.where("text is not null").mapInArrow(_trees, "origin string, doc string, template binary").distinct()
    counted = merged.groupBy("origin", "template").agg(F.count("*").alias("_in")).join(docs, "origin")
    return written(counted.where((F.col("_in") >= least) & (F.col("_in") >= F.lit(share) * F.col("_docs"))).select("origin", "template"))


def without_repeated(lines: DataFrame, share: float = 0.2, least: int = 3) -> DataFrame:
    """(doc, text): every document without the repeated lines, its other lines in reading order, joined by line feeds.

    A line_id counts once; lines without text are left out; a document that has no
    other lines keeps an empty text. The text of a line is shuffled once, to its
    document.
    """
    rows = lines.select("line_id", "origin", "doc", "page", "line_no", "text").where("doc is not null")
    keyed = arrow_map(rows, _keys, "line_id bigint, origin string, doc string, page int, line_no int, text string, template binary")
    drop = _covering(lines, share, least).withColumn("_drop", F.lit(True))
    kept = keyed.join(drop, ["origin", "template"], "left")
    line = F.when(F.col("_drop").isNull() & F.col("text").isNotNull(), F.struct("page", "line_no", "line_id", "text"))
    ordered = F.sort_array(F.collect_set(line))
    listed = kept.groupBy("doc").agg(ordered.alias("_lines"))
    first = F.filter("_lines", lambda x, i: (i == 0) | ~x["line_id"].eqNullSafe(F.get("_lines", i - 1)["line_id"]))
    return listed.select("doc", F.array_join(F.transform(first, lambda x: x["text"]), "\n").alias("text"))


def found(lines: DataFrame) -> DataFrame:
    """p1_found: each line to be removed."""
    return repeated_lines(lines)


# --- the same in SQL -----------------------------------------------------------------------


def _quoted(chars: str) -> str:
    return "'" + chars.replace("'", "''") + "'"


def _template_sql(c: str) -> str:
    """template() of a column in DuckDB."""
    shape = f"lower(translate(nfc_normalize(translate({c}, {_quoted(''.join(WIDTH) + SPACES + IGNORABLE)}, {_quoted(''.join(WIDTH.values()) + ' ' * len(SPACES))})), {_quoted(''.join(LOOKALIKE))}, {_quoted(''.join(LOOKALIKE.values()))}))"
    bare = f"regexp_replace({shape}, '[^\\p{{L}}\\p{{N}}]+$', '')"
    line = f"regexp_replace(CASE WHEN {bare} = '' THEN {shape} ELSE {bare} END, '\\p{{Nd}}+', '{SLOT}', 'g')"
    return f"array_to_string(regexp_extract_all({line}, '{SLOT}|[\\p{{L}}\\p{{Nl}}\\p{{No}}]+|[^\\p{{L}}\\p{{N}}\\x1C-\\x1F{WS[1:-1]}]'), ' ')"


_COVERING_SQL = f"""WITH x AS (SELECT *, {_template_sql("text")} AS t FROM doc_lines),
n AS (SELECT origin, count(DISTINCT doc) AS docs FROM x WHERE origin IS NOT NULL AND doc IS NOT NULL GROUP BY origin),
c AS (SELECT origin, t FROM x JOIN n USING (origin) WHERE doc IS NOT NULL AND t <> '' GROUP BY origin, t HAVING count(DISTINCT doc) >= 3 AND count(DISTINCT doc) >= 0.2::DOUBLE * any_value(docs))"""
FOUND_SQL = f"{_COVERING_SQL} SELECT DISTINCT line_id FROM x JOIN c USING (origin, t) WHERE doc IS NOT NULL"
DOCUMENTS_SQL = f"""{_COVERING_SQL}, d AS (SELECT DISTINCT doc, page, line_no, line_id, text, c.t IS NULL AND text IS NOT NULL AS kept FROM x LEFT JOIN c USING (origin, t) WHERE doc IS NOT NULL)
SELECT doc, coalesce(string_agg(text, chr(10) ORDER BY page NULLS FIRST, line_no NULLS FIRST, line_id NULLS FIRST) FILTER (kept), '') AS text FROM d GROUP BY doc"""
