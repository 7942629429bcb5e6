"""Units out of lines: legal structure as windows, prose by blocks, text documents by paragraphs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vellum.functions.columns import squash, strip
from vellum.operators import rules
from vellum.operators.lines import article, chapter, clause, kept_lines, union_box

ORDER = ("page", "block_no", "line_no", "line_id")


def _read(rows: DataFrame, order: tuple[str, ...]) -> DataFrame:
    """Lines with the reading state: what they begin, and the chapter and article that are open."""
    by = Window.partitionBy("doc").orderBy(*order)
    so_far, before = by.rowsBetween(Window.unboundedPreceding, 0), by.rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("_ch", squash(chapter(F.col("_text"))))
    rows = rows.withColumn("_d", F.when(F.col("_ch").isNull(), article(F.col("_text")))).withColumn("_k", F.when(F.col("_ch").isNull() & F.col("_d").isNull(), clause(F.col("_text"))))
    rows = rows.withColumn("_part", F.count("_ch").over(so_far)).withColumn("_chapter", F.last("_ch", True).over(so_far)).withColumn("_earlier", F.last("_ch", True).over(before))
    # the open article is the last one since the last chapter: the newest of both, told apart by a tag
    mark = F.when(F.col("_ch").isNotNull(), F.struct(F.lit(None).cast("string").alias("n"))).when(F.col("_d").isNotNull(), F.struct(F.col("_d").alias("n")))
    rows = rows.withColumn("_article", F.last(mark, True).over(so_far)["n"])
    kind = (
        F.when(F.col("_ch").isNotNull(), "heading")
        .when(F.col("_d").isNotNull(), "dieu")
        .when(F.col("_k").isNotNull() & F.col("_article").isNotNull(), "khoan")
        .when(F.col("_article").isNull(), "paragraph")
    )
    return rows.withColumn("_kind", kind).withColumn("unit_no", F.count("_kind").over(so_far))


def _units(rows: DataFrame, order: tuple[str, ...], around: Column | None = None) -> DataFrame:
    """Units out of numbered lines: type, label, path, page and box from the first line, text from all. Where `around` holds the box is the one around all lines."""
    label = F.when(F.col("_kind") == "heading", F.col("_ch")).when(F.col("_kind") == "dieu", F.concat(F.lit("Điều "), "_d")).when(F.col("_kind") == "khoan", F.concat(F.lit("Khoản "), "_k")).otherwise("")
    path = F.array_compact(
        F.when(F.col("_kind") == "heading", F.array("_earlier"))
        .when(F.col("_kind") == "khoan", F.array("_chapter", F.concat(F.lit("Điều "), "_article")))
        .otherwise(F.array("_chapter"))
    )
    place = F.struct(*order)
    first = F.min_by(F.struct(F.col("_kind").alias("type"), label.alias("label"), path.alias("path"), "page", "bbox"), place).alias("first")
    ordered = F.array_sort(F.collect_list(F.struct(place.alias("place"), F.col("_text").alias("text"))))
    text = F.array_join(F.transform(ordered, lambda x: x["text"]), "\n").alias("text")
    if around is None:
        units = rows.groupBy("doc", "unit_no").agg(first, text)
        return units.select("doc", "unit_no", "first.type", "first.label", "first.path", "text", "first.page", "first.bbox")
    box = union_box(F.when(around, F.col("bbox")))
    units = rows.groupBy("doc", "unit_no").agg(first, text, F.max(around).alias("_around"), *box)
    whole = F.when(F.col("x0").isNotNull(), F.array("x0", "y0", "x1", "y1"))
    return units.select("doc", "unit_no", "first.type", "first.label", "first.path", "text", "first.page", F.when(F.col("_around"), whole).otherwise(F.col("first.bbox")).alias("bbox"))


def legal_units(lines: DataFrame, order: tuple[str, ...] = ORDER) -> DataFrame:
    """(doc, unit_no, type, label, path, text, page, bbox): chapters, articles and clauses of each document.

    The reading state is carried by windows over the lines in order: the open article is
    the last one since the last chapter, a clause counts only while an article is open,
    a heading's path is the chapter before it, and any other line goes on with the open
    unit or stands as a paragraph. A unit keeps the page and the box of its first line.
    One shuffle by document serves all windows and the grouping.
    """
    rows = lines.withColumn("_text", strip(F.col("text"))).where("_text <> ''")
    return _units(_read(rows, order), order)


def document_kinds(lines: DataFrame) -> DataFrame:
    """(doc, kind): legal if any line begins an article, else prose."""
    legal = F.max(article(strip(F.col("text"))).isNotNull())
    return lines.groupBy("doc").agg(F.when(legal, "legal").otherwise("prose").alias("kind"))


def is_heading(c: Column) -> Column:
    """Heading of a text document: 60 characters at most and no closing mark."""
    return (F.length(c) <= 60) & ~c.rlike("[.?!:]$")


def text_units(lines: DataFrame) -> DataFrame:
    """(doc, unit_no, type, label, text): paragraphs of text documents without legal structure, short ones as headings."""
    rows = lines.withColumn("text", strip(F.col("text"))).where("text <> ''")
    number = F.row_number().over(Window.partitionBy("doc").orderBy("line_no", "line_id"))
    head = is_heading(F.col("text"))
    return rows.select("doc", number.alias("unit_no"), F.when(head, "heading").otherwise("paragraph").alias("type"), F.when(head, F.col("text")).otherwise("").alias("label"), "text")


def document_units(lines: DataFrame, pages: DataFrame) -> DataFrame:
    """(doc, unit_no, type, label, path, text, page, bbox): boilerplate dropped, then legal structure, or a paragraph per block where there is none.

    A legal unit has the box of its first line, a paragraph the box around its lines.

    Both kinds go through the same windows: a document without an article numbers its
    units by blocks and keeps its lines as they are.
    """
    doc = Window.partitionBy("doc")
    stripped = strip(F.col("text"))
    rows = kept_lines(lines, pages).withColumn("_text", stripped)
    rows = rows.withColumn("_legal", F.max(article(F.col("_text")).isNotNull()).over(doc)).where("not _legal or _text <> ''")
    block = F.dense_rank().over(doc.orderBy("page", "block_no")).cast("bigint")
    rows = _read(rows, ORDER)
    for name, other in (("unit_no", block), ("_kind", F.lit("paragraph")), ("_text", F.col("text")), ("_chapter", F.lit(None).cast("string"))):
        rows = rows.withColumn(name, F.when(F.col("_legal"), F.col(name)).otherwise(other))
    return _units(rows, ORDER, ~F.col("_legal"))


def marker_units(pages: DataFrame, lines: DataFrame) -> DataFrame:
    """(doc, page, label, text, x1, y1): a placeholder for every page of documents of which no page has text."""
    bare = pages.select("doc", "page", "width", "height").join(lines.where("text is not null").select("doc"), "doc", "left_anti").distinct()
    text = F.concat(F.lit(rules.MARKER + " (trang "), F.col("page").cast("string"), F.lit(")"))
    return bare.select("doc", "page", F.concat(F.lit("Trang "), F.col("page").cast("string")).alias("label"), text.alias("text"), F.col("width").alias("x1"), F.col("height").alias("y1"))


def page_markers(pages: DataFrame) -> DataFrame:
    """(doc, type, label, path, text, page, bbox): the placeholder unit of each page given, in the box of the page."""
    rows = pages.groupBy("doc", "page").agg(F.max("width").alias("w"), F.max("height").alias("h"))
    number = F.col("page").cast("string")
    box = F.when(F.col("w").isNotNull() & F.col("h").isNotNull(), F.array(F.lit(0.0), F.lit(0.0), "w", "h"))
    text = F.concat(F.lit(rules.MARKER + " (trang "), number, F.lit(")"))
    return rows.select("doc", F.lit("paragraph").alias("type"), F.concat(F.lit("Trang "), number).alias("label"), F.array().cast("array<string>").alias("path"), text.alias("text"), "page", box.alias("bbox"))


def is_marker(c: Column) -> Column:
    return c.startswith(rules.MARKER)
