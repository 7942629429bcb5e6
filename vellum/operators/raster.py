"""Geometry of pages and images: what a scan weighs and how it is rendered. Pixels come from adapters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HEAVY_DPI, RENDER_DPI = 200, 150
COLOUR, GRAY_SHARE, LONG_SIDE = 24, 0.004, 842.0


def effective_dpi(px_width: Column, page_width: Column) -> Column:
    return px_width / (page_width / 72)


def heavy_documents(images: DataFrame) -> DataFrame:
    """(doc, heavy): any image of more than 200 dpi on its page, or of the JPX kind."""
    heavy = (effective_dpi(F.col("px_w"), F.col("page_w")) > HEAVY_DPI) | F.col("filter").contains("JPX")
    return images.groupBy("doc").agg(F.max(F.coalesce(heavy, F.lit(False))).alias("heavy"))


def render_dpi(images: DataFrame) -> DataFrame:
    """(doc, page, dpi): 150 at most, never above the finest image of the page, at least 1."""
    finest = F.max(effective_dpi(F.col("px_w"), F.col("page_w")))
    return images.groupBy("doc", "page").agg(F.greatest(F.lit(1), F.least(F.lit(RENDER_DPI), F.coalesce(finest, F.lit(RENDER_DPI))).cast("int")).alias("dpi"))


def gray_pages(pixels: DataFrame) -> DataFrame:
    """(doc, page, gray): less than 0.4 % of the sampled pixels (r, g, b) are coloured."""
    spread = F.greatest("r", "g", "b") - F.least("r", "g", "b")
    return pixels.groupBy("doc", "page").agg((F.avg((spread > COLOUR).cast("int")) < GRAY_SHARE).alias("gray"))


def page_size(width: Column, height: Column) -> Column:
    """struct(width, height) in points of the page of one image: the long side is 842."""
    wide = width >= height
    return F.struct(F.when(wide, F.lit(LONG_SIDE)).otherwise(LONG_SIDE * width / height).alias("width"), F.when(wide, LONG_SIDE * height / width).otherwise(F.lit(LONG_SIDE)).alias("height"))
