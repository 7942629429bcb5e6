"""Recognised pages: words to lines, line heights, lexicon, the verdict on a page, units of scans."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vellum.functions.columns import nfc, solid_length, strip, tokens
from vellum.operators import rules
from vellum.operators.lines import union_box
from vellum.operators.structure import document_units, page_markers
from vellum.session import written


def read_tsv(spark, path: str) -> DataFrame:
    """The word table of a recogniser: tab-separated with a header, quotes are ordinary characters."""
    schema = "level string, page_num string, block_num string, par_num string, line_num string, word_num string, left string, top string, width string, height string, conf string, text string"
    return spark.read.csv(path, sep="\t", header=True, quote="", schema=schema)


def words_of(tsv: DataFrame) -> DataFrame:
    """Rows of level 5 with a text, numbers that are numbers and a confidence."""
    numbers = ["page_num", "block_num", "par_num", "line_num", "word_num", "left", "top", "width", "height"]
    cast = tsv.where("level = '5'").select(*[F.col(n).try_cast("int").alias(n) for n in numbers], F.col("conf").try_cast("double").alias("conf"), "text")
    valid = F.col("conf") >= 0
    for n in numbers:
        valid = valid & F.col(n).isNotNull()
    return cast.where(valid & (strip(F.col("text")) != ""))


def lines_of_words(words: DataFrame, keys: tuple[str, ...], order: str, dpi: int = rules.COARSE) -> DataFrame:
    """One row per line: words joined by spaces in their order, the box around them in points, mean confidence, both to two places."""
    text = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct(order, "text"))), lambda x: x["text"]), " ").alias("text")
    scale = F.lit(72.0 / dpi)
    box = F.array(F.col("left") * scale, F.col("top") * scale, (F.col("left") + F.col("width")) * scale, (F.col("top") + F.col("height")) * scale)
    placed = words.withColumn("_box", box)
    out = placed.groupBy(*keys).agg(text, *union_box(F.col("_box")), F.avg("conf").alias("conf"))
    return out.select(*keys, "text", *[F.round(c, 2).alias(c) for c in ("x0", "y0", "x1", "y1", "conf")])


def line_heights(lines: DataFrame, dpi: int = rules.COARSE) -> DataFrame:
    """(doc, page, pixels, again): median height of long lines, null if there are none, and whether a finer pass is due."""
    height = F.when(F.length("text") > rules.LONG, (F.col("bbox")[3] - F.col("bbox")[1]) * dpi / 72)
    pages = lines.groupBy("doc", "page").agg(F.median(height).alias("pixels"))
    return pages.withColumn("again", F.coalesce(F.col("pixels") < rules.LOW, F.lit(False)))


def cleaned(c: Column) -> Column:
    """Composed letters, and đ where recognisers put a letter that looks like it."""
    return F.translate(nfc(c), "Ðð", "Đđ")


def lexicon(units: DataFrame) -> DataFrame:
    """(word, uses, docs): short words, composed, of clean units that are used often enough, in documents enough."""
    own = units.where(F.col("text").isNotNull() & ~F.coalesce("ocr", F.lit(False)) & ~F.col("text").startswith(rules.MARKER))
    words = own.select("doc", F.explode(tokens(nfc(F.col("text")))).alias("word")).where(F.length("word") <= rules.WORD_LETTERS)
    counts = words.groupBy("word", "doc").count().groupBy("word").agg(F.sum("count").alias("uses"), F.count("*").alias("docs"))
    return counts.where((F.col("uses") >= rules.WORD_USES) & (F.col("docs") >= rules.WORD_DOCS))


def page_verdicts(lines: DataFrame, words: DataFrame) -> DataFrame:
    """(doc, page, chars, conf, words, unknown, reason): the first gate that a page fails, empty if it passes all.

    The lexicon meets the distinct words of the pages in a join that the engine
    broadcasts only if it measures it small.
    """
    named = lines.where(strip(F.coalesce("text", F.lit(""))) != "").withColumn("text", cleaned(F.col("text")))
    stats = named.groupBy("doc", "page").agg(F.sum(solid_length(F.col("text"))).alias("chars"), F.avg("conf").alias("conf"))
    counted = named.select("doc", "page", F.explode(tokens(F.col("text"))).alias("word")).groupBy("doc", "page", "word").agg(F.count("*").alias("n"))
    known = counted.join(words.select("word", F.lit(True).alias("known")), "word", "left")
    seen = known.groupBy("doc", "page").agg(F.sum("n").alias("words"), F.sum(F.when(F.col("known").isNull(), F.col("n")).otherwise(0)).alias("unknown"))
    out = stats.join(seen, ["doc", "page"], "left").fillna(0, ["words", "unknown"])
    reason = (
        F.when(F.col("chars") < rules.PAGE_CHARS, "too little text")
        .when(F.coalesce("conf", F.lit(0.0)) < rules.PAGE_CONF, "low confidence")
        .when(F.col("words") == 0, "no words")
        .when(F.col("unknown") / F.col("words") > rules.PAGE_UNKNOWN, "unrecognised words")
        .otherwise("")
    )
    return out.withColumn("reason", reason)


def scan_units(lines: DataFrame, words: DataFrame, pages: DataFrame) -> DataFrame:
    """(doc, kind, unit_no, type, label, path, text, page, bbox, ocr): units of recognised documents.

    Lines of pages that pass go through the same cleanup and structure as lines of a
    text layer, block after block; a page that does not pass keeps its placeholder. Units
    are in page order, text before placeholders.
    """
    verdicts = written(page_verdicts(lines, words).select("doc", "page", "reason"))
    passed = verdicts.where("reason = ''").select("doc", "page")
    good = lines.where(strip(F.coalesce("text", F.lit(""))) != "").join(passed, ["doc", "page"], "left_semi")
    block = F.min("line_no").over(Window.partitionBy("doc", "page", "block"))
    placed = good.select(F.col("ocr_line_id").alias("line_id"), "doc", "page", block.alias("block_no"), "line_no", cleaned(F.col("text")).alias("text"), "bbox")
    scans = pages.join(lines.select("doc").distinct(), "doc", "left_semi")
    text = document_units(placed, scans)
    heads = ["doc", "type", "label", "path", "text", "page", "bbox"]
    blocks = text.select(*heads, F.col("unit_no").alias("seq"), F.lit(0).alias("order"), F.lit(True).alias("ocr"))
    bare = page_markers(scans.join(passed, ["doc", "page"], "left_anti"))
    units = blocks.unionByName(bare.select(*heads, F.lit(0).cast("bigint").alias("seq"), F.lit(1).alias("order"), F.lit(None).cast("boolean").alias("ocr")))
    doc = Window.partitionBy("doc")
    legal = F.max(F.col("type") == "dieu").over(doc)
    number = F.row_number().over(doc.orderBy("page", "order", "seq"))
    return units.select("doc", F.when(legal, "legal").otherwise("prose").alias("kind"), number.alias("unit_no"), *heads[1:], "ocr")


def latest_pages(results: DataFrame, keys: tuple[str, ...] = ("doc", "page"), order: tuple[str, ...] = ("ocr_at",)) -> DataFrame:
    """The last result of every page, as a cache of page results is read: later records replace earlier ones."""
    latest = Window.partitionBy(*keys).orderBy(*[F.col(o).desc() for o in order])
    return results.withColumn("_n", F.row_number().over(latest)).where("_n = 1").drop("_n")
