"""The inbox as a stream: files that have stopped growing, each published once."""

from __future__ import annotations

import json
import os
import shutil
import time
from collections.abc import Callable, Iterator
from pathlib import Path

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from vellum.sources.names import destination, is_candidate


class Stability(StatefulProcessor):
    """One state per path: its last size. A path comes out when two listings in a row agree on it."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("size", "size bigint, done boolean")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        size, done = self.state.get() if self.state.exists() else (None, False)
        ready = None
        for r in pd.concat(list(rows)).sort_values("seen").itertuples():
            if size == r.size and not done:
                ready, done = r.size, True
            elif size != r.size:
                done = False
            size = int(r.size)
        self.state.update((size, done))
        if ready is not None:
            yield pd.DataFrame({"path": [key[0]], "size": [int(ready)]})

    def close(self) -> None:
        pass


def stable_files(listings: DataFrame) -> DataFrame:
    """(path, size) of a stream of listings (path, size, seen). The listing is streamed, not the content: a file source gives a path once only."""
    return listings.groupBy("path").transformWithStateInPandas(Stability(), "path string, size bigint", "Append", "None")


def inbox_files(spark: SparkSession, inbox: str, batch: bool = False) -> DataFrame:
    """(path, name, length, modified, content, subject, clean_name, source) of the candidates in an inbox. Names are filtered before contents are read."""
    reader = spark.read if batch else spark.readStream
    shape = "path string, modificationTime timestamp, length bigint, content binary"
    files = reader.schema(shape).format("binaryFile").load(inbox)
    name = F.element_at(F.split(F.url_decode("path"), "/"), -1)
    rows = files.withColumn("name", name).where(is_candidate(F.col("name"))).withColumn("to", destination(F.col("name")))
    rows = rows.select("path", "name", "length", F.col("modificationTime").alias("modified"), "content", "to.subject", "to.clean_name", "to.source")
    if batch:
        return rows
    # the stream source takes a name with brackets for a pattern and then gives its neighbours again
    return rows.withWatermark("modified", "7 days").dropDuplicatesWithinWatermark(["path", "modified"])


def remove_patiently(path: Path, tries: int = 25, delay: float = 0.2, sleep: Callable[[float], None] = time.sleep) -> bool:
    """Delete with a bounded number of tries; a file that is gone is a success."""
    for _ in range(tries):
        try:
            path.unlink()
            return True
        except FileNotFoundError:
            return True
        except OSError:
            sleep(delay)
    return False


def write_whole(path: Path, data: str) -> None:
    """Readers see the old or the new file, never a part."""
    path.parent.mkdir(parents=True, exist_ok=True)
    part = path.with_name(path.name + ".tmp")
    part.write_text(data, encoding="utf-8")
    os.replace(part, path)


def publish_pair(source: Path | bytes, sidecar: dict, pdf: Path, js: Path, original: Path | None = None) -> bool:
    """PDF (a file or its content) and sidecar together or neither; the original goes last, and the pair is withdrawn if it cannot go."""
    pdf.parent.mkdir(parents=True, exist_ok=True)
    if isinstance(source, bytes):
        pdf.write_bytes(source)
    else:
        shutil.copyfile(source, pdf)
    try:
        write_whole(js, json.dumps(sidecar, ensure_ascii=False, indent=2))
    except OSError:
        remove_patiently(pdf)
        raise
    if original is not None and not remove_patiently(original, sleep=lambda _: None):
        remove_patiently(js)
        remove_patiently(pdf)
        return False
    return True


def replace_if_unchanged(js: Path, expected: bytes, new: str, pdf: Path, signature: tuple[int, int], tries: int = 5, sleep: Callable[[float], None] = time.sleep) -> bool:
    """Compare and swap: only if the PDF's (size, mtime) and the old sidecar are what the work began from. A file that is held is tried again, a few times."""
    try:
        now = pdf.stat()
        if (now.st_size, now.st_mtime_ns) != tuple(signature) or js.read_bytes() != expected:
            return False
    except OSError:
        return False
    for _ in range(tries):
        try:
            write_whole(js, new)
            return True
        except PermissionError:
            sleep(0.2)
    return False


def published(rows: DataFrame, publish: Callable[[dict], None]) -> DataFrame:
    """(row, error): every row handed to an idempotent publisher, in tasks; one that fails is told and never stops the others."""

    def each(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for row in frame.to_dict("records"):
                try:
                    publish(row)
                    out.append((str(row[frame.columns[0]]), None))
                except Exception as problem:  # one bad file never stops the others
                    out.append((str(row[frame.columns[0]]), f"{type(problem).__name__}: {problem}"[:400]))
            yield pd.DataFrame(out, columns=["row", "error"])

    return rows.mapInPandas(each, "row string, error string")


def publish_stream(rows: DataFrame, checkpoint: str, publish: Callable[[dict], None], trigger: dict | None = None):
    """Micro-batches of rows handed to an idempotent publisher once each; the checkpoint is the single-writer lock.

    Published in tasks. What was published and what failed is appended to a table beside the checkpoint.
    """

    def each(batch: DataFrame, _: int) -> None:
        published(batch, publish).write.mode("append").parquet(f"{checkpoint.rstrip('/')}-report")

    return rows.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()
