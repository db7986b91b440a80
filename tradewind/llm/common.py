"""Small helpers that several text operators share."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewind.sources.staging import stage

__all__ = ["clear_of", "crc_share", "pick", "read_table", "slots_for", "stage", "text_slices"]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def crc_share(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo `modulus`; a NULL id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % modulus


def clear_of(df: DataFrame, *names: str) -> DataFrame:
    """Rename columns of `df` that clash with the names an operator is about to add: `x` to `x_given`, `x_given_given`, ..."""
    taken = {*df.columns, *names}
    renamed = {}
    for name in names:
        if name in df.columns:
            free = f"{name}_given"
            while free in taken:
                free += "_given"
            taken.add(free)
            renamed[name] = free
    return df.withColumnsRenamed(renamed) if renamed else df


def pick(df: DataFrame, *names: str) -> DataFrame:
    return df.select(*[F.col(f"`{name}`") for name in names])


def slots_for(df: DataFrame, bytes_each: int, least: int = 1) -> int:
    """Number of parts of about `bytes_each` bytes, from the planner's size of `df`.

    It follows the input and nothing else, so that it needs no pass over the data. For
    inputs that the planner knows no size of, which are not files, it is their partitions.
    """
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    if size >= 1 << 62:
        return max(least, df.rdd.getNumPartitions())
    return max(least, -(-size // bytes_each))


def text_slices(batch: pa.RecordBatch, characters: int = 4_000_000, column: str = "text") -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of rows of at most about `characters`, so that few texts are Python strings at once."""
    lengths = pc.coalesce(pc.binary_length(batch.column(column)), pa.scalar(0, pa.int32())).to_pylist()
    start, held = 0, 0
    for i, length in enumerate(lengths):
        if held and held + length > characters:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += length
    if start < batch.num_rows:
        yield batch.slice(start)
