"""What the operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def once(df: DataFrame, key: str) -> DataFrame:
    """Every row id once.

    Only rows whose id was delivered again are shuffled; of those the smallest row in
    the order of the columns stays, whatever the partitioning. Rows without an id are
    taken as different rows. Columns must be orderable.
    """
    ids = df.where(F.col(key).isNotNull()).groupBy(key).count().where("count > 1").select(key)
    rest = [c for c in df.columns if c != key]
    again = df.join(ids, key, "left_semi").groupBy(key).agg(F.min(F.struct(*rest)).alias("_row"))
    again = again.select(key, *[F.col(f"_row.`{c}`").alias(c) for c in rest])
    return df.join(ids, key, "left_anti").select(*df.columns).unionByName(again.select(*df.columns))


def arrow_map(df: DataFrame, rows: Callable[[dict[str, list]], dict[str, list]], schema: str) -> DataFrame:
    """mapInArrow over columns as Python lists; an empty result of a batch is skipped."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    target = to_arrow_schema(_parse_datatype_string(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cols = batch.to_pydict()
            out = rows(cols)
            if out and len(next(iter(out.values()))):
                # a column that is handed on as it came is not built again
                same = {f.name for f in target if out[f.name] is cols.get(f.name) and batch.schema.field(f.name).type == f.type}
                yield pa.RecordBatch.from_arrays([batch.column(f.name) if f.name in same else pa.array(out[f.name], f.type) for f in target], names=[f.name for f in target])

    return df.mapInArrow(run, schema)
