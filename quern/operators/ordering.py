"""Rows in order: dense numbering, latest row per key, end date from the next row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quern.staging import discard, staged

LARGEST_SORTED_GROUP = 5_000_000

Order = Sequence[str | tuple[str, str]]


def _sorting(order_by: Order) -> list[Column]:
    """NULL sorts lowest: first ascending, last descending."""
    columns = []
    for item in order_by:
        name, direction = (item, "asc") if isinstance(item, str) else item
        column = F.col(name)
        columns.append(column.desc_nulls_last() if direction == "desc" else column.asc_nulls_first())
    return columns


def largest_group(df: DataFrame, keys: Sequence[str]) -> int:
    """Rows of the most frequent key; counts are combined before they are shuffled."""
    return df.groupBy(*keys).count().agg(F.max("count")).first()[0] or 0


def global_index(
    df: DataFrame, order_by: Order, name: str = "idx", start: int = 1, partitions: int | None = None,
    stage_input: bool = True,
) -> DataFrame:
    """Number all rows 1..n along a total order without sorting them in one task.

    Rows are range-partitioned, sorted, and numbered inside their range while they are written. There are as many ranges
    as ``spark.sql.shuffle.partitions`` says (or ``partitions``), of which adaptive execution merges neighbours that are
    small. How many rows lie before each range is a table of one row per range that is joined, so neither the driver nor
    the plan grows with the rows. Ties in the order are broken by a hash of the row; copies of one row are told apart by
    the partition they came from, so that even a key or a row that makes up a large share of the table is spread over
    several ranges.

    The input is written out first, so that finding the ranges does not compute it a second time, and deleted when the
    numbered rows are written. ``stage_input=False`` saves that for an input that is as cheap to read as a copy of it.
    """
    marked = df.withColumns({"__hash": F.xxhash64(*df.columns), "__source": F.spark_partition_id()})
    once = staged(marked) if stage_input else marked
    order = _sorting(order_by) + [F.col("__hash"), F.col("__source")]
    ranged = once.repartitionByRange(partitions, *order) if partitions else once.repartitionByRange(*order)
    ranged = ranged.sortWithinPartitions(*order).drop("__hash", "__source")
    table = staged(ranged.withColumn("__at", F.monotonically_increasing_id()))
    if stage_input:
        discard(once)
    # The upper bits of __at are the range, the lower 33 the position in it.
    part = F.shiftright("__at", 33).cast("int")
    before, total = [], 0
    for row in sorted(table.groupBy(part.alias("range")).count().collect()):
        before.append((row["range"], total))
        total += row["count"]
    sizes = df.sparkSession.createDataFrame(before, "__range int, __before bigint")
    # At most as many rows as there are shuffle partitions, 12 bytes each.
    placed = table.join(F.broadcast(sizes), part == F.col("__range"))
    position = F.col("__at").bitwiseAND(F.lit((1 << 33) - 1))
    return placed.select(*df.columns, (F.col("__before") + position + start).alias(name))


def latest_per_key(
    df: DataFrame, keys: Sequence[str], order_by: str, tie_breakers: Order = (), drop_null_keys: bool = True
) -> DataFrame:
    """The newest row of each key.

    Each input partition keeps one row per key before the shuffle (the planner limits the window there), so a
    frequent key sends one row per partition, not all of its rows. Equal dates are decided by
    ``tie_breakers`` and at last by a hash of the row: the result does not depend on the run.
    """
    rows = df
    for key in keys if drop_null_keys else ():
        rows = rows.filter(F.col(key).isNotNull())
    order = _sorting([(order_by, "desc"), *tie_breakers]) + [F.xxhash64(*df.columns)]
    window = Window.partitionBy(*keys).orderBy(*order)
    return rows.withColumn("__rank", F.row_number().over(window)).filter("__rank = 1").drop("__rank")


def next_start(
    df: DataFrame,
    keys: Sequence[str],
    start: str,
    name: str,
    tie_breakers: Order = (),
    largest: int = LARGEST_SORTED_GROUP,
) -> DataFrame:
    """The start of the next row of the same key.

    Keys of moderate size are sorted each in one task. When the most frequent key is larger than ``largest``
    the table is numbered in the order of key and start instead, and each row is joined with the one after it.
    """
    order = [start, *tie_breakers]
    if largest_group(df, keys) <= largest:
        window = Window.partitionBy(*keys).orderBy(*_sorting(order), F.xxhash64(*df.columns))
        return df.withColumn(name, F.lead(start).over(window))
    numbered = global_index(df, [*keys, *order], "__n")
    following = numbered.select(
        (F.col("__n") - 1).alias("__n"),
        F.col(start).alias("__start"),
        F.struct(*keys).alias("__keys"),
    )
    same = F.struct(*[F.col(k) for k in keys]).eqNullSafe(F.col("__keys"))
    return (
        numbered.join(following, "__n", "left")
        .withColumn(name, F.when(same, F.col("__start")))
        .drop("__n", "__start", "__keys")
    )


def end_date(
    df: DataFrame,
    keys: Sequence[str],
    start: str,
    name: str,
    tie_breakers: Order = (),
    largest: int = LARGEST_SORTED_GROUP,
) -> DataFrame:
    """The day before the next version starts; NULL for the current version."""
    chained = next_start(df, keys, start, "__next", tie_breakers, largest)
    return chained.withColumn(name, F.date_sub("__next", 1)).drop("__next")


def lookup_keys(
    fact: DataFrame, dimension: DataFrame, natural: str, dimension_natural: str, surrogate: str, ignore_case: bool = False
) -> DataFrame:
    """Attach the surrogate key of a dimension to every fact row, NULL where there is none.

    The engine broadcasts the dimension if its size at run time allows, and splits frequent keys otherwise.
    """
    keys = dimension.select(F.col(dimension_natural).alias("__natural"), F.col(surrogate))
    left, right = F.col(natural), F.col("__natural")
    if ignore_case:
        left, right = F.upper(F.rtrim(left)), F.upper(F.rtrim(right))
    return fact.join(keys, left == right, "left").drop("__natural")
