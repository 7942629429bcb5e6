"""Problem 4: how often every distinct term occurs and in how many records.

Last-seen counters. Rows are put in the order of their records, so that a task sees a
record whole before the next begins; a counter per term keeps occurrences, records and
the last record it was seen in, never a set of records. Tasks give out their counters
and these are hash-partitioned by term and added. The order is cut into ranges of
(record, key), not hashed by record, so that a record that holds a third of all rows
is spread over many tasks: only the first and the last record of a task can go on in
another one, and of those the terms are given out with the record and counted once.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_TERM = regex.compile(r"[\p{L}\p{M}]+")
#: Counters that a task keeps before it gives them out and starts anew.
HELD = 500_000


def _batch(terms: list[str], records: list[str | None], occurrences: list[int], seen: list[int]) -> pa.RecordBatch:
    columns = [pa.array(terms, pa.string()), pa.array(records, pa.string()), pa.array(occurrences, pa.int64()), pa.array(seen, pa.int64())]
    return pa.RecordBatch.from_arrays(columns, names=["term", "shared", "occurrences", "records"])


def _open(counts: dict[str, int], record: str) -> pa.RecordBatch:
    """Terms of a record that may go on in another task."""
    return _batch(list(counts), [record] * len(counts), list(counts.values()), [0] * len(counts))


def _last_seen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in the order (record, key) to counters; a key delivered again is skipped."""
    counters: dict[str, list] = {}  # term: occurrences, records, number of the last record
    edge: dict[str, int] = {}  # terms of the first record, then of the newest one until the next begins
    record, key, number = None, None, 0
    for batch in batches:
        for r, k, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if r == record and k is not None and k == key:
                continue
            if r != record:
                if number == 1 and edge:
                    yield _open(edge, record)
                elif number > 1:
                    for term, n in edge.items():
                        c = counters.get(term)
                        if c is None:
                            counters[term] = [n, 1, number]
                        else:
                            c[0] += n
                            if c[2] != number:
                                c[1] += 1
                                c[2] = number
                    if len(counters) > HELD:
                        yield _batch(list(counters), [None] * len(counters), [c[0] for c in counters.values()], [c[1] for c in counters.values()])
                        counters = {}
                record, edge, number = r, {}, number + 1
            key = k
            if text:
                get = edge.get
                for term in _TERM.findall(text.lower()):
                    edge[term] = get(term, 0) + 1
    if edge:
        yield _open(edge, record)
    if counters:
        yield _batch(list(counters), [None] * len(counters), [c[0] for c in counters.values()], [c[1] for c in counters.values()])


def term_statistics(df: DataFrame, record: str = "doc", text: str = "text", key: str | None = "unit_id", rare: int = 3, common: float = 0.25) -> DataFrame:
    """(term, occurrences, records, mark) for every term of a table.

    A term is a longest run of letters and combining marks of the lower-cased text.
    mark is "rare" below `rare` occurrences or in one record only, else "common" in
    more than the share `common` of all records, else null. With a key, a key delivered
    again within its record counts once; rows with a null key all count. Null texts have
    no terms, but their records count; rows whose record is null count as one unnamed
    record. An empty table gives no rows.
    """
    rows = df.select(F.coalesce(F.col(record), F.lit("")).alias("record"), (F.col(key) if key else F.lit(None)).cast("string").alias("key"), F.col(text).alias("text"))
    every = rows.agg(F.count_distinct("record")).scalar()
    spread = F.when(F.col("key").isNull(), F.xxhash64("text"))  # rows without a key can be spread too
    ordered = rows.repartitionByRange("record", "key", spread).sortWithinPartitions("record", "key")
    counted = ordered.mapInArrow(_last_seen, "term string, shared string, occurrences bigint, records bigint")
    # a shared record counts one for each of its terms, whatever number of tasks gave it out
    shared = counted.where("shared is not null").groupBy("term", "shared").agg(F.sum("occurrences").alias("occurrences"), F.lit(1).cast("bigint").alias("records"))
    parts = counted.where("shared is null").select("term", "occurrences", "records").unionByName(shared.select("term", "occurrences", "records"))
    totals = parts.groupBy("term").agg(F.sum("occurrences").alias("occurrences"), F.sum("records").alias("records"))
    is_rare = (F.col("occurrences") < rare) | (F.col("records") == 1)
    return totals.withColumn("mark", F.when(is_rare, "rare").when(F.col("records") > F.lit(common) * every, "common"))


def found(units: DataFrame) -> DataFrame:
    """p4_found: the terms too rare or too common to be useful."""
    return term_statistics(units).where("mark is not null").select("term", "mark")


TERMS_SQL = r"""
WITH u AS (SELECT unit_id, min(doc) AS doc, min(text) AS text FROM units GROUP BY unit_id),
t AS (SELECT doc, unnest(regexp_extract_all(lower(text), '[\p{L}\p{M}]+')) AS term FROM u),
s AS (SELECT term, count(*) AS occurrences, count(DISTINCT doc) AS records FROM t GROUP BY term)
SELECT term, occurrences, records, CASE WHEN occurrences < 3 OR records = 1 THEN 'rare'
  WHEN records > 0.25 * (SELECT count(DISTINCT doc) FROM units) THEN 'common' END AS mark FROM s
"""

FOUND_SQL = f"SELECT term, mark FROM ({TERMS_SQL}) WHERE mark IS NOT NULL"
