"""Whole passes over a library, put together from the operators. Each returns frames; nothing is written here."""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vellum.functions.columns import nfc, stem, suffix
from vellum.operators import anchor, health, lines, recognition, repair, rules, sidecar, slides, structure
from vellum.session import written
from vellum.sources import discovery, images, names, office
from vellum.streaming import inbox


@dataclass(frozen=True)
class Outcome:
    """What a pass leaves: valid sidecars, refused ones with their errors, and a report of one row."""

    published: DataFrame
    refused: DataFrame
    report: DataFrame


def intake(files: DataFrame, doc_lines: DataFrame, pages: DataFrame, added_at: str) -> Outcome:
    """Files (doc, name) with their lines and pages to sidecars.

    The name gives the destination; lines lose their boilerplate and get structure;
    documents without a text layer get a placeholder per page; texts are normalised
    after that; sidecars that break the contract are refused.
    """
    named = files.where(names.is_candidate(F.col("name"))).withColumn("to", names.destination(F.col("name")))
    header = named.select("doc", "to.subject", "to.clean_name", "to.source", names.source_format(F.col("name")).alias("sourceformat"))
    counts = pages.groupBy("doc").agg(F.max("page").alias("pagecount"))
    columns = ["doc", "unit_no", "type", "label", "path", "text", "page", "bbox"]
    text = structure.document_units(doc_lines, pages).select(*columns)
    empty = pages.join(doc_lines.where("text is not null").select("doc"), "doc", "left_anti")
    bare = structure.page_markers(empty).withColumn("unit_no", F.col("page").cast("bigint")).select(*columns)
    units = text.unionByName(bare).withColumn("text", nfc(repair.convert(F.col("text")))).withColumn("ocr", F.lit(None).cast("boolean"))
    kinds = structure.document_kinds(lines.kept_lines(doc_lines, pages))
    rows = header.join(counts, "doc").join(kinds, "doc", "left")
    rows = rows.select("doc", "subject", "clean_name", F.lit(rules.SCHEMA_VERSION).alias("schemaversion"), stem(F.col("clean_name")).alias("title"), "source", F.lit(added_at).alias("addedat"), "sourceformat", "pagecount", F.coalesce("kind", F.lit("prose")).alias("kind"))
    checked = sidecar.validation_errors(sidecar.sidecar_json(rows, units)).join(rows.select("doc", "subject", "clean_name"), "doc")
    report = checked.agg(F.count_if(F.size("errors") == 0).alias("processed"), F.count_if(F.size("errors") > 0).alias("failed"))
    return Outcome(checked.where("size(errors) = 0").drop("errors"), checked.where("size(errors) > 0"), report)


def inbox_pass(spark: SparkSession, library: str, added_at: str, read: Callable[[DataFrame], DataFrame] = office.read_pdf, apply: bool = False) -> DataFrame:
    """(name, error) of the candidates in the inbox of a library, one row each: published, or why not.

    Names are gated before contents are read, a file is read on its own, and its name is
    made free in its folder. With apply, each valid document is published as a pair
    beside the others of its subject, in tasks, and its original goes last; without, the
    pass only tells what it would do. An image becomes a PDF of one page; other kinds
    need a program that makes a PDF of them first and stay with an error until there is one.
    """
    root = Path(library)
    found = inbox.inbox_files(spark, str(root / "_inbox"), batch=True)
    files = written(found.select(names.document_id(F.col("path")).alias("doc"), "name", F.url_decode(F.regexp_replace("path", "^file:", "")).alias("path"), "content", "subject", "clean_name"))
    ending = suffix(F.col("name"))
    pdf, image = ending == ".pdf", ending.isin(*rules.IMAGES)
    made = written(images.image_pages(files.where(image)))
    shown = made.withColumn("page", F.when(F.col("error").isNull(), F.lit(1)))
    got = written(read(files.where(pdf).select("doc", "content")).unionByName(shown.drop("pdf"), allowMissingColumns=True))
    doc_lines = got.where("text is not null").withColumn("line_id", F.xxhash64("doc", "page", "block_no", "line_no"))
    pages = got.where("page is not null").groupBy("doc", "page").agg(F.max("width").alias("width"), F.max("height").alias("height"))
    done = intake(files.where(pdf | image).select("doc", "name"), doc_lines.select("line_id", "doc", "page", "block_no", "line_no", "text", "bbox"), pages, added_at)
    listed = discovery.listing(spark, library).where(~F.col("rel_path").startswith("_")).select("rel_path")
    taken = listed.select(F.regexp_replace("rel_path", "/[^/]*$", "").alias("subject"), stem(F.element_at(F.split("rel_path", "/"), -1)).alias("stem")).distinct()
    free = names.free_stems(files.where(pdf | image).select("subject", F.col("path").alias("seq"), F.col("clean_name").alias("name")), taken).select(F.col("seq").alias("path"), "stem")
    ready = done.published.select("doc", "json").join(files.select("doc", "name", "path", "subject"), "doc").join(free, "path").join(made.select("doc", "pdf"), "doc", "left").select("name", "path", "json", "subject", "stem", "pdf")
    refused = done.refused.select("doc", F.array_join("errors", "; ").alias("error")).join(files.select("doc", "name"), "doc").select("name", "error")
    unread = got.where("error is not null").select("doc", "error").join(files.select("doc", "name"), "doc").select("name", "error")
    other = files.where(~pdf & ~image).select("name", F.lit("no program makes a PDF of it").alias("error"))

    def publish(row: dict) -> None:
        folder = root.joinpath(*row["subject"].split("/"))
        source = Path(row["path"])
        if not inbox.publish_pair(bytes(row["pdf"]) if row["pdf"] is not None else source, json.loads(row["json"]), folder / f"{row['stem']}.pdf", folder / f"{row['stem']}.json", source):
            raise OSError("the original cannot be removed")

    told = inbox.published(ready, publish).select(F.col("row").alias("name"), "error") if apply else ready.select("name", F.lit(None).cast("string").alias("error"))
    return told.unionByName(refused).unionByName(unread).unionByName(other)


def inbox_passes(spark: SparkSession, libraries: list[str], added_at: str, read: Callable[[DataFrame], DataFrame] = office.read_pdf, apply: bool = False) -> dict[str, dict]:
    """What the pass over each library did, or the error that ended it; no library stops another."""
    out: dict[str, dict] = {}
    for library in libraries:
        try:
            rows = written(inbox_pass(spark, library, added_at, read, apply))
            out[library] = rows.agg(F.count_if(F.col("error").isNull()).alias("processed"), F.count_if(F.col("error").isNotNull()).alias("failed")).first().asDict()
        except Exception as problem:
            out[library] = {"error": f"{type(problem).__name__}: {problem}"[:400]}
    return out


def anchored_text_document(units: DataFrame, page_texts: DataFrame) -> DataFrame:
    """Units of a text document with the pages of its PDF, found by their beginnings."""
    return units.drop("page").join(anchor.anchored(units, page_texts), ["doc", "unit_no"])


def repair_pass(units: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(units after the repair, prior rows for the history, report per document). Writing any of them is up to the caller: report only is the default of the command."""
    after = repair.apply_repair(units)
    report = repair.repair_report(units)
    changed = report.where("safe and changed > 0").select("doc")
    return after, units.join(changed, "doc", "left_semi"), report


def slide_pass(sidecars: DataFrame, units: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(slides of documents that lost them, prior rows for the history)."""
    lost = slides.degraded_slides(sidecars, units)
    prior = units.join(lost, "doc", "left_semi")
    return slides.slide_units(prior, sidecars.select("doc", "pagecount")), prior


def recognition_queue(sidecars: DataFrame, units: DataFrame, results: DataFrame, progress: DataFrame, budget_seconds: float, seconds_a_page: float = 2.0, workers: int = 2) -> DataFrame:
    """(doc, page, rank): the pages that the next time-boxed pass starts.

    Candidates have placeholders and no text of their own; documents in reading come
    first; pages with a result are skipped, so that a pass goes on where the last stopped.
    """
    facts = discovery.inspected(units).where("marker and not foreign")
    candidates = sidecars.join(facts, "doc", "left_semi").select(F.col("doc").alias("rel"), F.col("pagecount").alias("pages"))
    order = discovery.prioritised(candidates, progress).select(F.col("rel").alias("doc"), F.col("rank").alias("doc_rank"))
    todo = discovery.missing_pages(sidecars, results).join(order, "doc")
    from vellum.operators.ranking import ranked

    pages = ranked(todo, [F.col("doc_rank"), F.col("page")]).withColumn("seconds", F.lit(seconds_a_page))
    return health.admitted(pages, budget_seconds, workers).select("doc", "page", "rank")


def recognised(sidecars: DataFrame, results: DataFrame, units: DataFrame, pages: DataFrame) -> DataFrame:
    """Units of documents all of whose pages have a result: text blocks of the pages that pass, placeholders for the rest.

    A document is left alone if it has another number of pages than its sidecar says, if
    it no longer holds placeholders and recognised text only, or if no page of it passes.
    """
    missing = discovery.missing_pages(sidecars, results).select("doc").distinct()
    same = pages.groupBy("doc").agg(F.count_distinct("page").alias("pagecount")).join(sidecars.select("doc", "pagecount"), ["doc", "pagecount"], "left_semi")
    targets = discovery.inspected(units).where("marker and not foreign").join(same, "doc", "left_semi").select("doc")
    complete = results.join(missing, "doc", "left_anti").join(targets, "doc", "left_semi")
    made = recognition.scan_units(complete, recognition.lexicon(units), pages)
    return made.withColumn("_text", F.max(F.coalesce("ocr", F.lit(False))).over(Window.partitionBy("doc"))).where("_text").drop("_text")


def numbered(units: DataFrame, order: list[str]) -> DataFrame:
    """Units numbered within their document in the given order."""
    return units.withColumn("unit_no", F.row_number().over(Window.partitionBy("doc").orderBy(*order)))
