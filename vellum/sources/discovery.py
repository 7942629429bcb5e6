"""What lies in a library: listings, pairs, facts kept from earlier passes, reading progress."""

from __future__ import annotations

from collections.abc import Iterator
from pathlib import Path

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vellum.functions.columns import nfc, stem, suffix
from vellum.operators.ranking import ranked
from vellum.operators.structure import is_marker


def listing(spark: SparkSession, root: str) -> DataFrame:
    """(rel_path, size, mtime) of every file below a root in a folder that all executors share.

    The driver lists the root alone; what lies below each of its folders is listed in
    tasks. File sources of the engine hide names with a leading underscore even when
    named, and a library has some.
    """
    base = Path(root)
    tops = [(p.name,) for p in sorted(base.iterdir())]

    def walk(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for top in frame["top"]:
                for p in [base / top, *sorted((base / top).rglob("*"))]:
                    try:
                        if p.is_file():
                            rows.append((p.relative_to(base).as_posix(), p.stat().st_size, p.stat().st_mtime_ns // 1000))
                    except OSError:  # gone since
                        continue
            yield pd.DataFrame(rows, columns=["rel_path", "size", "mtime"])

    folders = spark.createDataFrame(tops, "top string")
    return folders.repartition(max(1, min(len(tops), 1000))).mapInPandas(walk, "rel_path string, size bigint, mtime bigint")


def contents(files: DataFrame, root: str) -> DataFrame:
    """(rel_path, content) of the files (rel_path) of any name, read in tasks; unreadable ones are left out."""

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for rel in frame["rel_path"]:
                try:
                    rows.append((rel, (Path(root) / rel).read_text(encoding="utf-8")))
                except (OSError, UnicodeDecodeError):
                    continue
            yield pd.DataFrame(rows, columns=["rel_path", "content"])

    return files.select("rel_path").mapInPandas(read, "rel_path string, content string")


def _folders(c: Column) -> Column:
    parts = F.split(c, "/")
    return F.slice(parts, 1, F.size(parts) - 1)


def _file(c: Column) -> Column:
    return F.element_at(F.split(c, "/"), -1)


def sidecar_paths(files: DataFrame, policy: str) -> DataFrame:
    """(rel_path): the JSON files that are sidecars, under one of four policies.

    repair: no folder of the sync, inbox or print areas above it, and a PDF of the same
    name beside it. ocr and lexicon: first folder not hidden or reserved, file not
    reserved. validate: no part of a sync folder, not directly in the inbox or print
    area, file not reserved, and a PDF beside it.
    """
    path = F.col("rel_path")
    folders, name = _folders(path), _file(path)
    json = files.where(suffix(name) == ".json")
    top = F.coalesce(F.try_element_at(folders, F.lit(1)), F.lit(""))
    if policy == "repair":
        kept = json.where(~F.arrays_overlap(F.concat(folders, F.array(F.lit(""))), F.array(*map(F.lit, (".stversions", ".stfolder", "_inbox", "_print")))))
    elif policy in ("ocr", "lexicon"):
        kept = json.where(~top.rlike("^[_.]") & ~name.startswith("_"))
    elif policy == "validate":
        parent = F.coalesce(F.try_element_at(folders, F.lit(-1)), F.lit(""))
        kept = json.where(~F.exists(folders, lambda x: x.startswith(".st")) & ~parent.isin("_inbox", "_print") & ~name.startswith("_"))
    else:
        raise ValueError(policy)
    return paired(kept, files) if policy in ("repair", "validate") else kept.select("rel_path")


def paired(json: DataFrame, files: DataFrame) -> DataFrame:
    """(rel_path): JSON files with a PDF of the same stem in the same folder."""
    pdf = files.where(suffix(_file(F.col("rel_path"))) == ".pdf").select(stem(F.col("rel_path")).alias("_stem"))
    return json.withColumn("_stem", stem(F.col("rel_path"))).join(pdf, "_stem", "left_semi").select("rel_path")


def inspected(units: DataFrame) -> DataFrame:
    """(doc, marker, foreign): any placeholder unit; any other unit that is no recognised text."""
    mark = is_marker(F.coalesce("text", F.lit("")))
    return units.groupBy("doc").agg(F.max(mark).alias("marker"), F.max(~mark & ~F.coalesce("ocr", F.lit(False))).alias("foreign"))


def due(files: DataFrame, index: DataFrame) -> DataFrame:
    """Files whose facts are not known or whose signature changed: all that a pass has to look at again."""
    known = index.select("rel_path", F.col("size").alias("_size"), F.col("mtime").alias("_mtime"))
    rows = files.join(known, "rel_path", "left")
    return rows.where(~(F.col("size").eqNullSafe(F.col("_size")) & F.col("mtime").eqNullSafe(F.col("_mtime")))).select(*files.columns)


def reading_entries(files: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(entries, tombstones) of reading-progress files (rel_path, content): one per device, unreadable ones skipped."""
    shape = "struct<entries: map<string, struct<page: variant, total: variant, lastReadAt: bigint>>, tombstones: map<string, bigint>>"
    rows = files.select("rel_path", F.from_json("content", shape).alias("r"))
    entries = rows.select("rel_path", F.explode("r.entries").alias("key", "e")).select(F.col("rel_path").alias("device"), nfc(F.col("key")).alias("key"), F.try_variant_get("e.page", "$", "int").alias("page"), F.try_variant_get("e.total", "$", "int").alias("total"), F.col("e.lastReadAt").alias("last_read"))
    stones = rows.select("rel_path", F.explode("r.tombstones").alias("key", "ts")).select(F.col("rel_path").alias("device"), nfc(F.col("key")).alias("key"), "ts")
    return entries, stones


def reading_progress(entries: DataFrame, tombstones: DataFrame) -> DataFrame:
    """(key, fraction, last_read): per document the farthest place and the latest time, from any device each.

    An entry that is not newer than the newest tombstone of its key is gone before the
    maxima are taken; without a usable page count the fraction is 0.
    """
    gone = tombstones.groupBy("key").agg(F.max("ts").alias("_ts"))
    alive = entries.join(gone, "key", "left").where(F.col("_ts").isNull() | (F.col("last_read") > F.col("_ts")))
    fraction = F.when(F.col("page").isNotNull() & (F.col("total") > 0), F.col("page") / F.col("total")).otherwise(0.0)
    return alive.groupBy("key").agg(F.max(fraction).alias("fraction"), F.max("last_read").alias("last_read"))


def prioritised(candidates: DataFrame, progress: DataFrame) -> DataFrame:
    """Candidates (rel, pages) with `rank`: opened ones first, farthest and latest first; then the others, short ones first."""
    rows = candidates.join(progress.withColumnRenamed("key", "rel"), "rel", "left")
    opened = F.col("fraction").isNotNull()
    order = [opened.desc(), F.col("fraction").desc(), F.col("last_read").desc(), F.when(~opened, F.col("pages")), F.col("rel")]
    return ranked(rows, order)


def missing_pages(documents: DataFrame, results: DataFrame) -> DataFrame:
    """(doc, page): pages 1..pagecount of each document that have no result yet."""
    every = documents.where("pagecount >= 1").select("doc", F.explode(F.sequence(F.lit(1), F.col("pagecount"))).alias("page"))
    return every.join(results.select("doc", "page"), ["doc", "page"], "left_anti")


def orphans(cached: DataFrame, live: DataFrame, key: str = "doc") -> DataFrame:
    """Cached results of documents that are gone."""
    return cached.join(live.select(key), key, "left_anti")


def mirror_diff(source: DataFrame, target: DataFrame, key: str = "rel_path") -> DataFrame:
    """(key, action): copy what is new or changed in the source, delete what it no longer has."""
    s = source.select(key, F.struct("size", "mtime").alias("_s"))
    t = target.select(key, F.struct("size", "mtime").alias("_t"))
    action = F.when(F.col("_t").isNull(), "copy").when(F.col("_s").isNull(), "delete").when(F.col("_s") != F.col("_t"), "copy")
    return s.join(t, key, "full_outer").select(key, action.alias("action")).where("action is not null")


def expired_snapshots(names: DataFrame, keep: int = 4) -> DataFrame:
    """(name): dated snapshots beyond the newest `keep`; names of another form are never touched. A few names, one ordering."""
    dated = names.where(F.col("name").rlike(r"^\d{4}-\d{2}-\d{2}$")).select("name").distinct()
    return dated.withColumn("_n", F.row_number().over(Window.orderBy(F.col("name").desc()))).where(F.col("_n") > keep).select("name")
