"""Problem 8: records of several sources mixed to target weights.

Systematic sampling. Of a source with size S, weight w and cap c in a mix of size T each
document is expected min(c, w * T / S) times. Expected copies are prefix-summed over
the documents of the source, one random offset in [0, 1) is added, and a document is
given out once for each integer that its stretch of the sum crosses: the copies of any
two documents differ by one at most, and of a source by less than one from what is
expected. The prefix sum runs in two levels, within buckets of a hash of the id and
over the buckets, so that a source with a third of all rows is many tasks.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vellum.session import written

#: Documents of a bucket, about, if all were of one source; and the least number of buckets.
IN_BUCKET, BUCKETS = 50_000, 512


def default_vocabulary() -> str:
    """Path of a public byte-level vocabulary where this machine has one."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@lru_cache(maxsize=2)
def _encoding(path: str):
    import public_tokenizers
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def sized(documents: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """(doc_id, source, tokens): the size of every document in tokens; a null text has none."""
    path = vocabulary or default_vocabulary()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _encoding(path)
        for batch in batches:
            n = [len(x) for x in coder.encode_ordinary_batch([t or "" for t in batch.column("text").to_pylist()], num_threads=1)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("source"), pa.array(n, pa.int64())], names=["doc_id", "source", "tokens"])

    rows = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("source").cast("string").alias("source"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(count, "doc_id bigint, source string, tokens bigint")


def plan(sizes: DataFrame, targets: DataFrame) -> DataFrame:
    """(source, weight, max_repeat, size, wanted, copies, short) of every target source.

    wanted is the source's share of a mix as large as all documents; copies is what a
    document is expected to be used; short says that even max_repeat uses do not reach
    wanted. A source without documents or without tokens is short if its weight is
    positive; null weights count as 0, null caps as 1.
    """
    by_source = sizes.groupBy("source").agg(F.sum("tokens").alias("size"))
    total = by_source.agg(F.coalesce(F.sum("size"), F.lit(0))).scalar()
    named = targets.select("source", F.coalesce("weight", F.lit(0.0)).alias("weight"), F.coalesce("max_repeat", F.lit(1)).alias("max_repeat")).where("source is not null").dropDuplicates(["source"])
    out = named.join(by_source, "source", "left").withColumn("size", F.coalesce("size", F.lit(0)))
    out = out.withColumn("wanted", F.col("weight") * total)
    need = F.when(F.col("size") > 0, F.col("wanted") / F.col("size")).otherwise(F.lit(0.0))
    short = F.col("wanted") > F.col("max_repeat") * F.col("size")
    return out.withColumn("copies", F.least(need, F.col("max_repeat").cast("double"))).withColumn("short", short)


def mix(documents: DataFrame, targets: DataFrame, vocabulary: str | None = None, seed: int = 7) -> DataFrame:
    """(doc_id, source, tokens, copies): the documents of the mix, with the times each is used.

    Documents of sources without a target, of a null source or of an expected zero are
    not in it. Rows of one doc_id are documents of their own. The same seed gives the
    same mix whatever the partitioning; ties of ids go by size.
    """
    sizes = written(sized(documents, vocabulary))
    rates = plan(sizes, targets).select("source", F.col("copies").alias("rate"))
    return _drawn(sizes, rates, seed)


def _drawn(sizes: DataFrame, rates: DataFrame, seed: int) -> DataFrame:
    buckets = max(BUCKETS, sizes.count() // IN_BUCKET)
    rows = sizes.where("source is not null").withColumn("bucket", F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.lit(buckets)).cast("int"))
    within = Window.partitionBy("source", "bucket").orderBy("doc_id", "tokens")
    over = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    # as many rows a source as there are buckets
    offsets = rows.groupBy("source", "bucket").agg(F.count("*").alias("n")).withColumn("before", F.coalesce(F.sum("n").over(over), F.lit(0))).select("source", "bucket", "before")
    ranked = rows.withColumn("rank", F.row_number().over(within)).join(offsets, ["source", "bucket"]).join(rates, "source")
    offset = F.pmod(F.xxhash64("source", F.lit(seed + 1)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    upto = F.col("before") + F.col("rank")
    copies = F.floor(upto * F.col("rate") + offset) - F.floor((upto - 1) * F.col("rate") + offset)
    return ranked.withColumn("copies", copies.cast("int")).where("copies > 0").select("doc_id", "source", "tokens", "copies")


def report(documents: DataFrame, targets: DataFrame, vocabulary: str | None = None, seed: int = 7) -> DataFrame:
    """(source, weight, size, copies, used, share, actual, short): target and actual shares of the mix by source.

    used is the number of documents given out, actual their share of the mix in tokens
    (null for an empty mix), short as of plan().
    """
    sizes = written(sized(documents, vocabulary))
    planned = plan(sizes, targets)
    drawn = _drawn(sizes, planned.select("source", F.col("copies").alias("rate")), seed)
    got = drawn.groupBy("source").agg(F.sum("copies").alias("used"), F.sum(F.col("tokens") * F.col("copies")).alias("mixed"))
    out = planned.join(got, "source", "left").fillna(0, ["used", "mixed"])
    whole = out.agg(F.sum("mixed")).scalar()
    return out.select("source", "weight", "max_repeat", "size", "wanted", "copies", "used", "mixed", (F.col("mixed") / F.nullif(whole, F.lit(0))).alias("actual"), "short")


def found(documents: DataFrame, targets: DataFrame) -> DataFrame:
    """p8_found: sources that, used as often as they may be, still fall short of their weight in the mix."""
    return report(documents, targets).where("short and mixed < wanted").select("source")
