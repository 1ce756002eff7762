"""Files of a table that hold near values of several keys, so that readers can leave most files out."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quern.operators.quantiles import GRID, summaries

#: A key's values fall into two to this power stretches of about as many rows each.
BITS = 7


def as_number(df: DataFrame, key: str) -> Column:
    """A number that does not decrease along the key's order; of texts, the first six bytes."""
    kind, value = df.schema[key].dataType, F.col(key)
    if isinstance(kind, (T.StringType, T.BinaryType)):
        first = F.rpad(F.hex(F.substring(value.cast("binary"), 1, 6)), 12, "0")
        return F.conv(first, 16, 10).cast("double")
    if isinstance(kind, T.DateType):
        return F.unix_date(value).cast("double")
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(value.cast("timestamp")).cast("double")
    return value.cast("double")


def _stretch(value: Column, bounds: list[float]) -> Column:
    """How many of the sorted bounds a value exceeds, by halving."""

    def part(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        return F.when(value > bounds[middle], part(middle + 1, high)).otherwise(part(low, middle))

    return part(0, len(bounds))


def curve(df: DataFrame, keys: Sequence[str], bits: int = BITS) -> Column:
    """A place on the Z curve: the bits of the keys' ranks, the highest ones of all keys first.

    Ranks come from sketches of one scan. Absent values come first.
    """
    numbers = df.select(*[as_number(df, key).alias(f"v{i}") for i, key in enumerate(keys)])
    told = summaries(numbers, len(keys))
    places = []
    for i, key in enumerate(keys):
        step = GRID >> bits
        bounds = sorted(set(told[i].values[step:GRID:step])) if told[i].count else []
        rank = F.coalesce(_stretch(as_number(df, key), bounds), F.lit(0)).cast("bigint")
        for bit in range(bits):
            here = F.shiftright(rank, bit).bitwiseAND(F.lit(1).cast("bigint"))
            places.append(F.shiftleft(here, bit * len(keys) + len(keys) - 1 - i))
    return reduce(lambda a, b: a.bitwiseOR(b), places)


def clustered(df: DataFrame, keys: Sequence[str], files: int | None = None) -> DataFrame:
    """Rows in ranges of one key, or of the curve through several, sorted inside each.

    Without ``files`` there are as many ranges as shuffle partitions, of which adaptive execution merges small ones.
    """
    rows = df.withColumn("__curve", curve(df, keys)) if len(keys) > 1 else df
    order = [F.col("__curve")] if len(keys) > 1 else []
    order += [F.col(key) for key in keys]
    ranged = rows.repartitionByRange(files, *order) if files else rows.repartitionByRange(*order)
    return ranged.sortWithinPartitions(*order).drop("__curve")
