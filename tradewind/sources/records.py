"""CSV files whose quoted values hold line ends, read by many tasks.

Spark reads such a file in one task, because a task that starts in the middle cannot know
whether it is inside quotes. Counting tells: after an even number of quote characters from
the beginning of the file it is outside. A first pass counts the quotes of every block (the
byte range of a task); their running sums over the blocks of a file, a few bytes for each
block, give the state at the beginning of each. A second pass puts the lines of a block
together to records and parses them with Spark's own CSV reader. What a block holds of records that
begin before it or end after it, some lines at either end, is joined on its own; nothing
else is shuffled.

The quote is `"`, and a quote inside quotes is doubled, so it changes no state. Lines end
with LF or CRLF, also inside quotes, where they are kept. A byte order mark is left out. The first
record of a file is its header; empty records are left out. A file that ends inside quotes
gives its last record as far as it goes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# What a piece of a block is: a whole record, the end of one that began before, the beginning of one that goes on,
# or all of the block, inside one record.
WHOLE, END, BEGINNING, MIDDLE = range(4)
_PIECES = "file bigint, block bigint, place bigint, kind int, value string"


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """The lines of the files with the block they begin in; lines of a block are neighbours, in order."""
    return spark.read.text(path, lineSep="\n").select(
        F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value")


def _states(lines: DataFrame) -> DataFrame:
    """(file, block, inside): whether a block begins inside quotes. One row of 17 bytes per block."""
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    blocks = lines.groupBy("file", "block").agg(F.sum(quotes).alias("quotes"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    return blocks.select("file", "block", (F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2 == 1).alias("inside"))


def _joined(lines: pa.Array, starts: np.ndarray) -> pa.Array:
    """Lines from each start to the next as one text."""
    offsets = pa.array(np.append(starts, len(lines)), pa.int32())
    return pc.binary_join(pa.ListArray.from_arrays(offsets, lines), "\n")


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The pieces of every block, from its lines in order."""
    block, number, inside, first = None, 0, False, True
    open_lines: list[pa.Array] = []     # of the record that has begun and not ended
    open_place, open_kind = 0, WHOLE

    def piece(values: pa.Array, places: np.ndarray, kinds: np.ndarray) -> pa.RecordBatch:
        n = len(values)
        return pa.RecordBatch.from_arrays(
            [pa.array(np.full(n, block[0], np.int64)), pa.array(np.full(n, block[1], np.int64)), pa.array(places, pa.int64()),
             pa.array(kinds, pa.int32()), values], ["file", "block", "place", "kind", "value"])

    def left_open() -> Iterator[pa.RecordBatch]:
        nonlocal open_lines
        if open_lines:
            lines = pa.concat_arrays(open_lines)
            kind = MIDDLE if open_kind == END else BEGINNING
            yield piece(_joined(lines, np.array([0])), np.array([open_place]), np.array([kind]))
            open_lines = []

    for batch in batches:
        files, blocks = batch.column("file").to_numpy(), batch.column("block").to_numpy()
        cuts = np.flatnonzero((np.diff(files) != 0) | (np.diff(blocks) != 0)) + 1
        for start, end in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows]):
            if start == end:
                continue
            if (files[start], blocks[start]) != block:
                yield from left_open()
                block = (files[start], blocks[start])
                number, inside = 0, batch.column("inside")[start].as_py()
                open_kind = END if inside else WHOLE
            lines = batch.column("value").slice(start, end - start)
            quotes = np.cumsum(pc.count_substring(lines, '"').to_numpy()) + inside
            closed = quotes % 2 == 0            # after each line
            ends = np.flatnonzero(closed) + 1   # where a record ends
            if len(ends):
                if not open_lines:
                    open_place = block[1] + number
                head = pa.concat_arrays([*open_lines, lines.slice(0, ends[0])])
                yield piece(_joined(head, np.array([0])), np.array([open_place]), np.array([open_kind]))
                if len(ends) > 1:
                    starts = ends[:-1]
                    yield piece(_joined(lines.slice(starts[0], ends[-1] - starts[0]), starts - starts[0]),
                                block[1] + number + starts, np.full(len(starts), WHOLE))
                open_lines, open_kind = [], WHOLE
            rest = ends[-1] if len(ends) else 0
            if rest < len(lines):
                if not open_lines:
                    open_place = block[1] + number + rest
                open_lines.append(lines.slice(rest))
            number += len(lines)
            inside = not closed[-1]
    yield from left_open()


def records(spark: SparkSession, path: str) -> DataFrame:
    """(file, place, value): the records of the files as texts; `place` is in the order of the file."""
    lines = _lines(spark, path)
    # A few bytes for each block, a ten-millionth of the files.
    states = F.broadcast(_states(lines))
    pieces = lines.join(states, ["file", "block"]).select("file", "block", "value", "inside").mapInArrow(_pieces, _PIECES)
    whole = pieces.where(F.col("kind") == WHOLE).select("file", "place", "value")
    # Pieces belong to the last beginning before them.
    order = Window.partitionBy("file").orderBy("block", "place")
    parts = pieces.where(F.col("kind") != WHOLE).withColumn(
        "begun", F.last(F.when(F.col("kind") == BEGINNING, F.col("place")), ignorenulls=True).over(order))
    text = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("block", "place", "value"))), lambda p: p["value"]), "\n")
    joined = parts.groupBy("file", "begun").agg(text.alias("value")).select("file", F.col("begun").alias("place"), "value")
    clean = F.regexp_replace("value", "\\r$", "")
    return whole.unionByName(joined).select("file", "place", clean.alias("value"))


def read_quoted_csv(spark: SparkSession, path: str, schema: T.StructType, place: str | None = None) -> DataFrame:
    """The columns of `schema`, and on request the place of a row in its file as column `place`.

    A value that does not parse is NULL.
    """
    first = F.col("place") == 0  # only the first line of a file begins at 0
    rows = records(spark, path).where(~first & (F.col("value") != ""))
    # The mode of the reader of files: what does not parse is NULL, value by value.
    parsed = F.from_csv("value", schema.simpleString().removeprefix("struct<").removesuffix(">").replace(":", " "), {
        "quote": '"', "escape": '"', "multiLine": "true", "mode": "PERMISSIVE"})
    columns = [F.col(f"parsed.`{name}`") for name in schema.names]
    return rows.select(parsed.alias("parsed"), "place").select(*columns, *([F.col("place").alias(place)] if place else []))
