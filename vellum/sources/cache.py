"""Results of recognised pages kept between passes, settings of a pass, archives of originals."""

from __future__ import annotations

import hashlib
import json
import os
import shutil
from dataclasses import dataclass
from pathlib import Path

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Engine:
    """A recogniser; its key is part of every cached result, so that another engine invalidates them."""

    name: str
    version: str
    model: str
    dpi: int

    @property
    def key(self) -> str:
        return "|".join((self.name, self.version, self.model, str(self.dpi)))


def settings(text: str | None) -> tuple[bool, int]:
    """(enabled, workers) of a settings file: enabled only by a true boolean, workers 1 to 8 by a true integer, else 2."""
    try:
        data = json.loads(text or "")
    except ValueError:
        return False, 2
    if not isinstance(data, dict):
        return False, 2
    workers = data.get("workers")
    return data.get("enabled") is True, workers if type(workers) is int and 1 <= workers <= 8 else 2


def cached_pages(records: DataFrame, expected: Column) -> DataFrame:
    """The usable results of JSON-lines caches (doc, seq, value): the last record of each page of caches whose first line is the expected header.

    A torn line is skipped, a cache with another header is void as a whole.
    """
    header = records.where("seq = 0").select("doc", "value")
    valid = header.where(F.try_parse_json("value").cast("string") == F.parse_json(expected).cast("string")).select("doc")
    shape = "struct<page: int, dpi: int, lines: array<string>, error: string>"
    rows = records.where("seq > 0").join(valid, "doc", "left_semi").withColumn("r", F.from_json("value", shape)).where("r.page is not null")
    last = Window.partitionBy("doc", "r.page").orderBy(F.col("seq").desc())
    return rows.withColumn("_n", F.row_number().over(last)).where("_n = 1").select("doc", "r.*")


def append_pages(results: DataFrame, folder: str, engine: Engine, signature: Column) -> None:
    """Results (doc, page, ...) appended to the cache table, partitioned by engine, with the signature of the PDF they were made from."""
    results.withColumn("signature", signature).withColumn("engine", F.lit(engine.key)).write.mode("append").partitionBy("engine").parquet(folder)


def usable(cache: DataFrame, engine: Engine, signatures: DataFrame) -> DataFrame:
    """Cached results of this engine whose PDF is still the one they were made from."""
    now = signatures.select("doc", F.col("signature").alias("_now"))
    return cache.where(F.col("engine") == engine.key).join(now, "doc").where(F.col("signature").eqNullSafe(F.col("_now"))).drop("_now")


def file_hash(path: Path, block: int = 1 << 20) -> str:
    digest = hashlib.sha256()
    with path.open("rb") as f:
        while part := f.read(block):
            digest.update(part)
    return digest.hexdigest()


def label(root: Path) -> str:
    """Name of a library: that of the folder above its root, else its own."""
    return root.parent.name or root.name


def archive(original: Path, folder: Path, claimed: set[str]) -> Path:
    """The original moved to an archive under the first free name."""
    folder.mkdir(parents=True, exist_ok=True)
    name, k = original.name, 0
    while name in claimed or (folder / name).exists():
        k += 1
        name = f"{original.stem} ({k}){original.suffix}"
    claimed.add(name)
    target = folder / name
    try:
        os.replace(original, target)
    except OSError:
        shutil.move(original, target)
    return target


def newest_common(ours: DataFrame, theirs: DataFrame) -> DataFrame:
    """(digest): the newest version (ord, digest; 0 is the newest) of one history that the other one has too: the base of a three-way merge."""
    shared = ours.join(theirs.select("digest"), "digest", "left_semi")
    return shared.agg(F.min_by("digest", "ord").alias("digest"))
