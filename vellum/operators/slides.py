"""Slides that lost their structure: found by their fingerprint and regrouped by page."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vellum.operators.lines import union_box


def degraded_slides(sidecars: DataFrame, units: DataFrame) -> DataFrame:
    """(doc): slide decks whose units are all unlabelled paragraphs, one with a box at least."""
    prose = sidecars.where("sourceformat = 'pptx' and kind = 'prose'").select("doc").distinct()
    plain = (F.col("type") == "paragraph") & (F.coalesce("label", F.lit("")) == "")
    marks = units.groupBy("doc").agg(F.min(plain).alias("plain"), F.max(F.col("bbox").isNotNull()).alias("boxed"))
    return prose.join(marks.where("plain and boxed"), "doc", "left_semi")


def slide_units(units: DataFrame, page_counts: DataFrame) -> DataFrame:
    """(doc, page, label, text, x0, y0, x1, y1): one slide for each page that has text.

    Pages are carried, never computed; a document with a block on a page it does not
    have, or without any text, is left alone.
    """
    known = units.join(page_counts.where("pagecount >= 1"), "doc")
    safe = known.groupBy("doc").agg(F.min(F.coalesce(F.col("page").between(1, F.col("pagecount")), F.lit(False))).alias("safe")).where("safe").select("doc")
    ordered = F.sort_array(F.collect_list(F.when(F.coalesce("text", F.lit("")).rlike(r"\S"), F.struct("unit_no", "unit_id", "text"))))
    text = F.array_join(F.transform(ordered, lambda x: x["text"]), "\n").alias("text")
    pages = known.join(safe, "doc", "left_semi").groupBy("doc", "page").agg(text, *union_box(F.col("bbox")))
    return pages.where("text <> ''").select("doc", "page", F.concat(F.lit("Slide "), F.col("page").cast("string")).alias("label"), "text", "x0", "y0", "x1", "y1")
