"""Records of delimited files whose quoted values hold line breaks, found by many tasks for each file.

A file is read as physical lines, split into byte ranges as any text file. Whether a line break ends a record depends
only on whether the quotes before it are even in number, so:

1. one scan counts the quotes of each range and notes its first and last line with an odd number of them;
2. a running sum of these parities over the ranges of a file tells for each range whether it begins and ends inside quotes;
3. lines between a range's first closing and last opening line are joined into records where they lie, in one pass over
   Arrow batches, without a shuffle;
4. the few lines of records that reach over the end of a range are brought together by a shuffle of these lines only.

A closing quote is a quote doubled or before a delimiter, and quotes stand nowhere but in quoted values; a file that breaks
this rule is read in another way by Spark's ``multiLine``. Line breaks inside values are kept as they are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quern.staging import staged

QUOTE = '"'

def _lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Physical lines with their byte range and their order in it."""
    return spark.read.text(path, lineSep="\n").select(
        "value",
        F.xxhash64("_metadata.file_path").alias("range_file"),
        F.col("_metadata.file_block_start").alias("range_start"),
        F.monotonically_increasing_id().alias("place"),
    )


def _quotes(value: Column) -> Column:
    """The parity of a line's quotes."""
    return (F.length(value) - F.length(F.replace(value, F.lit(QUOTE), F.lit("")))) % 2


def ranges(lines: DataFrame) -> DataFrame:
    """For each byte range: its first line, where its inner part starts and stops, and the records that reach over its ends.

    The inner part is what lies behind the line that closes a record begun in an earlier range, number ``goes_on`` of its
    file, and before the line that opens one that a later range goes on with, number ``begins``. The ranges of one file
    are put in order in one task.
    """
    odd = F.when(F.col("odd") == 1, F.col("place"))
    counted = (
        lines.withColumn("odd", _quotes(F.col("value")))
        .groupBy("range_file", "range_start")
        .agg(F.min("place").alias("head"), F.max("place").alias("last"), (F.sum("odd") % 2).alias("turn"),
             F.min(odd).alias("first_odd"), F.max(odd).alias("last_odd"))
    )
    in_file = W.partitionBy("range_file").orderBy("range_start")
    so_far = F.sum("turn").over(in_file)
    ends = counted.withColumns({"opens": (so_far - F.col("turn")) % 2 == 1, "stays": so_far % 2 == 1})
    # A range that is inside quotes throughout has no odd line and begins no record.
    begun = (F.col("stays") & (F.col("first_odd").isNotNull())).cast("int")
    return ends.select(
        "range_file", "range_start", "head",
        F.when(F.col("opens"), F.coalesce(F.col("first_odd"), F.col("last")) + 1).otherwise(F.col("head")).alias("inner"),
        F.when(F.col("stays"), F.coalesce("last_odd", "head")).otherwise(F.col("last") + 1).alias("outer"),
        (F.sum(begun).over(in_file) - begun).alias("goes_on"), F.sum(begun).over(in_file).alias("begins"),
        (F.col("first_odd").isNotNull()).alias("broken"),
    )


def _join_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records of consecutive lines that begin and end outside quotes; an unfinished one waits for the next batch."""
    held: list[str] = []
    held_first = False
    names = ["value", "first"]
    for batch in batches:
        value, first = batch.column(0), batch.column(1)
        odd = pc.count_substring(value, QUOTE).to_numpy(zero_copy_only=False) & 1
        if not held and not odd.any():
            yield batch
            continue
        inside = (np.cumsum(odd) + (1 if held else 0)) & 1
        ends = np.flatnonzero(inside == 0)
        lines, marks = value.to_pylist(), first.to_pylist()
        out, marked, start = [], [], 0
        for end in ends.tolist():
            if held:
                out.append("\n".join([*held, *lines[start : end + 1]]))
                marked.append(held_first)
                held = []
            else:
                out.append(lines[start] if start == end else "\n".join(lines[start : end + 1]))
                marked.append(marks[start])
            start = end + 1
        if start < len(lines):
            if not held:
                held_first = marks[start]
            held += lines[start:]
        if out:
            yield pa.record_batch([pa.array(out, pa.string()), pa.array(marked, pa.bool_())], names)
    if held:
        yield pa.record_batch([pa.array(["\n".join(held)], pa.string()), pa.array([held_first])], names)


def records(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(value, first): the records of the files, and whether each is the first of its file. Their order is not kept.

    The ranges are counted at once, so that files without line breaks in values are left as they are split.
    """
    lines = _lines(spark, path)
    known = staged(ranges(lines))
    first = (F.col("range_start") == 0) & (F.col("place") == F.col("head"))
    # Some 50 bytes for each byte range of the input (128 MB by default): 4 MB for 10 TB.
    placed = lines.join(F.broadcast(known), ["range_file", "range_start"], "left").withColumn("first", first)
    changed = F.raise_error(F.lit("the files, or the size of their ranges, changed since they were counted"))
    value = F.when(F.col("head").isNull(), changed).otherwise(F.col("value"))
    if known.filter("broken").isEmpty():
        return _bare(placed.select(value.alias("value"), "first"))
    inner = placed.filter("head IS NULL OR place >= inner AND place < outer").select(value.alias("value"), "first")
    whole = inner.mapInArrow(_join_lines, "value string, first boolean")
    number = F.when(F.col("place") < F.col("inner"), F.col("goes_on")).otherwise(F.col("begins"))
    together = placed.filter("place < inner OR place >= outer").groupBy("range_file", number.alias("record")).agg(
        F.sort_array(F.collect_list(F.struct("range_start", "place", "value"))).alias("lines"), F.max("first").alias("first")
    )
    return _bare(whole.unionByName(together.select(F.array_join("lines.value", "\n").alias("value"), "first")))


def _bare(found: DataFrame) -> DataFrame:
    """Without the carriage return of the line break that ends a record, and the mark that may begin a file."""
    cut = F.when(F.col("value").endswith("\r"), F.expr("left(value, length(value) - 1)")).otherwise(F.col("value"))
    return found.select(F.when(F.col("first"), F.ltrim(cut, F.lit("\ufeff"))).otherwise(cut).alias("value"), "first")
