"""Pages of units that come without one, found by the beginning of their text."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vellum.functions.columns import squash

SNIPPET = 40


def normal(c: Column) -> Column:
    return F.lower(squash(c))


class Pages:
    """The pages of one document in order, with the places of every stretch of `snippet` characters."""

    def __init__(self, snippet: int):
        self.snippet, self.texts, self.where = snippet, [], {}

    def add(self, page: int, text: str) -> None:
        self.texts.append((page, text))
        for i in range(len(text) - self.snippet + 1):
            at = self.where.setdefault(hash(text[i : i + self.snippet]), [])
            if not at or at[-1] != len(self.texts) - 1:
                at.append(len(self.texts) - 1)

    def first(self, start: str, floor: int) -> int | None:
        """The first page from `floor` on that holds the text; only pages that can hold it are looked at."""
        for n in self.where.get(hash(start), ()) if len(start) == self.snippet else range(len(self.texts)):
            page, text = self.texts[n]
            if page >= floor and start in text:
                return page
        return None


_PLACED = pa.schema([("doc", pa.string()), ("unit_no", pa.int64()), ("page", pa.int32())])


def anchored(units: DataFrame, pages: DataFrame, snippet: int = SNIPPET) -> DataFrame:
    """(doc, unit_no, page): the first page, not before that of the unit before, that holds the first `snippet` characters of the unit.

    Pages and units of a document come in order, pages first, in one pass over sorted
    partitions: the monotone floor is carried from unit to unit, and only the pages of
    one document are held. What is found nowhere stays on the floor, which begins at 1.
    """
    start = F.substring(normal(F.col("text")), 1, snippet)
    held = pages.where("page is not null").select("doc", F.lit(0).alias("kind"), F.col("page").cast("bigint").alias("no"), normal(F.col("text")).alias("text"))
    wanted = units.select("doc", F.lit(1).alias("kind"), F.col("unit_no").cast("bigint").alias("no"), start.alias("text"))
    rows = held.unionByName(wanted).repartition("doc").sortWithinPartitions("doc", "kind", "no")

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begun, doc, known, floor = False, None, Pages(snippet), 1
        for batch in batches:
            out = ([], [], [])
            for name, kind, no, text in zip(*(batch.column(c).to_pylist() for c in ("doc", "kind", "no", "text")), strict=True):
                if not begun or name != doc:
                    begun, doc, known, floor = True, name, Pages(snippet), 1
                if kind == 0:
                    known.add(no, text or "")
                    continue
                floor = (known.first(text, floor) if text else None) or floor
                for values, v in zip(out, (doc, no, floor), strict=True):
                    values.append(v)
            if out[0]:
                yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(out, _PLACED, strict=True)], schema=_PLACED)

    kind = units.schema["unit_no"].dataType.simpleString()
    return rows.mapInArrow(place, "doc string, unit_no bigint, page int").withColumn("unit_no", F.col("unit_no").cast(kind))
