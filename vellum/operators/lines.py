"""Lines of pages: running headers and footers, signature stamps, gazette covers.

Input frames: lines(line_id, doc, page, block_no, line_no, text, bbox) and
pages(doc, page, height). All work is partitioned by document once; the windows and
aggregates of one document reuse that partitioning.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vellum.functions.columns import masked, strip
from vellum.operators import rules


def article(c: Column) -> Column:
    """Number of the article that a line begins, or null. Only a dotted number begins one."""
    return F.nullif(F.regexp_extract(c, rules.ARTICLE, 1), F.lit(""))


def chapter(c: Column) -> Column:
    """Label of the chapter that a line begins, or null."""
    return F.nullif(F.regexp_extract(c, rules.CHAPTER, 1), F.lit(""))


def clause(c: Column) -> Column:
    """Number of the clause that a line begins, or null."""
    return F.nullif(F.regexp_extract(c, rules.CLAUSE, 1), F.lit(""))


def is_structural(c: Column) -> Column:
    """Whether a line begins a legal unit; such a line is never dropped."""
    return c.rlike(rules.ARTICLE) | c.rlike(rules.CHAPTER)


def in_margin(top: Column, height: Column) -> Column:
    return F.coalesce((top < height * rules.TOP) | (top > height * rules.BOTTOM), F.lit(False))


def is_signature(c: Column) -> Column:
    """A line of the signature stamp or a bare contact address."""
    line = strip(c)
    return F.lower(line).rlike(f"^(?:{'|'.join(rules.SIGNATURE_STARTS)})") | (line.contains("@") & line.rlike(f"{rules.EMAIL_LINE}|{rules.EMAIL_CONTACT}"))


def is_cover(c: Column) -> Column:
    """A line that only the cover of the gazette prints."""
    return F.lower(strip(c)).rlike("|".join([*rules.COVER_PARTS, *rules.COVER_LINES]))


def with_heights(lines: DataFrame, pages: DataFrame) -> DataFrame:
    """Lines with the height of their page and the place of their upper edge.

    The heights of a document travel as one map, so that the join is on the document
    alone and its partitioning serves everything after it.
    """
    heights = pages.where("page is not null and height is not null").groupBy("doc", "page").agg(F.max("height").alias("height"))
    per_doc = heights.groupBy("doc").agg(F.map_from_entries(F.collect_list(F.struct("page", "height"))).alias("_heights"))
    rows = lines.join(per_doc, "doc", "left").withColumn("height", F.try_element_at("_heights", F.col("page")))
    return rows.drop("_heights").withColumn("top", F.try_element_at("bbox", F.lit(2)))


def _running(placed: DataFrame, pages: DataFrame) -> DataFrame:
    """(doc, key, n_pages) of lines with heights."""
    margin = placed.where(in_margin(F.col("top"), F.col("height"))).where(~is_structural(F.col("text")))
    size = pages.groupBy("doc").agg(F.count_distinct("page").alias("pages"))
    keys = margin.select("doc", "page", masked(F.col("text")).alias("key")).where("key <> ''")
    often = keys.groupBy("doc", "key").agg(F.count_distinct("page").alias("n_pages")).join(size, "doc")
    return often.where(F.col("n_pages") >= F.greatest(F.lit(2), F.floor((F.col("pages") + 1) / 2))).select("doc", "key", "n_pages")


def running_lines(lines: DataFrame, pages: DataFrame) -> DataFrame:
    """(doc, key, n_pages): keys of margin lines that stand on half of a document's pages, on two at least."""
    return _running(with_heights(lines, pages), pages)


def kept_lines(lines: DataFrame, pages: DataFrame) -> DataFrame:
    """The lines that are content, in a cascade: structural lines stay, stamps go anywhere, cover lines only on page 1 before the first unit, running lines in margins."""
    order = Window.partitionBy("doc").orderBy("page", "block_no", "line_no", "line_id").rowsBetween(Window.unboundedPreceding, 0)
    text = F.col("text")
    placed = with_heights(lines.where("text is not null"), pages)
    keys = _running(placed, pages).groupBy("doc").agg(F.collect_set("key").alias("_running"))
    marked = placed.join(keys, "doc", "left").withColumn("structural", is_structural(text)).withColumn("seen", F.max("structural").over(order))
    margin = in_margin(F.col("top"), F.col("height"))
    # only lines in margins are compared with the running ones
    running = F.when(margin & F.col("_running").isNotNull(), F.array_contains("_running", masked(text))).otherwise(F.lit(False))
    cover = F.when((F.col("page") == 1) & ~F.col("seen"), is_cover(text)).otherwise(F.lit(False))
    return marked.where(F.col("structural") | ~(is_signature(text) | cover | running)).select(*lines.columns)


def union_box(c: Column) -> list[Column]:
    """Aggregates of the box around all boxes."""
    return [F.min(c[0]).alias("x0"), F.min(c[1]).alias("y0"), F.max(c[2]).alias("x1"), F.max(c[3]).alias("y1")]


def block_paragraphs(lines: DataFrame) -> DataFrame:
    """(doc, page, block_no, text, x0, y0, x1, y1): the lines of each block as one paragraph in the box around them."""
    ordered = F.sort_array(F.collect_list(F.struct("line_no", "line_id", "text")))
    text = F.array_join(F.transform(ordered, lambda x: x["text"]), "\n").alias("text")
    return lines.where("text is not null").groupBy("doc", "page", "block_no").agg(text, *union_box(F.col("bbox")))
