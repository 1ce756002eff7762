"""Indicators of many categories without a column for each.

The categories of several columns are a distributed table. A row's indicators are an array of (position, value), as a
sparse vector, and what is computed from indicators is computed from counts of (category, class). Nothing here brings
the categories to the driver or writes them into a plan.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.frames import Data, apply_to, training
from quern.operators.ordering import global_index
from quern.staging import staged

ENTRIES = "array<struct<position: bigint, value: double>>"


def _unpivoted(df: DataFrame, columns: Sequence[str], category, *others: Column) -> DataFrame:
    """A row (place of the column, category, others) for each row and column."""
    cells = [F.struct(F.lit(i).alias("place"), category(c).alias("category")) for i, c in enumerate(columns)]
    rows = df.select(*others, F.explode(F.array(*cells)).alias("__cell"))
    return rows.select("__cell.place", "__cell.category", *[c for c in rows.columns if c != "__cell"])


def _named(column: str) -> Column:
    """The category as text, absent values under the name they have as text."""
    return F.coalesce(F.col(column).cast("string"), F.lit("nan"))


def _given(column: str) -> Column:
    return F.col(column).cast("string")


def dictionary(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Table (place, category, position): every category of each column but its first, numbered from 0.

    ``place`` counts the columns. Positions follow the columns, then the categories. One scan for all columns.
    """
    found = staged(_unpivoted(df, list(columns), _named).distinct())
    first = found.groupBy("place").agg(F.min("category").alias("__first"))  # a row for each column
    rest = found.join(F.broadcast(first), "place").filter("category <> __first").select("place", "category")
    return global_index(rest, ["place", "category"], "position", start=0)


def sparse_one_hot(data: Data, columns: Iterable[str], name: str = "indicators") -> tuple[Data, DataFrame]:
    """One array of (position, value) instead of text columns, and the dictionary its positions come from.

    As with a column for each, the first training category and those that the training part lacks have no entry. The
    array follows the remaining columns and is ordered by position.
    """
    names = list(columns)
    known = dictionary(training(data), names)

    def replaced(df: DataFrame) -> DataFrame:
        rest = [c for c in df.columns if c not in names]
        for i, column in enumerate(names):
            listed = known.filter(F.col("place") == i).select(
                F.col("category").alias("__category"), F.col("position").alias(f"__position{i}")
            )
            df = df.join(listed, _named(column) == F.col("__category"), "left").drop("__category")
        entries = [F.struct(F.col(f"__position{i}").alias("position"), F.lit(1.0).alias("value")) for i in range(len(names))]
        present = F.filter(F.array(*entries), lambda e: e["position"].isNotNull())
        return df.select(*rest, present.cast(ENTRIES).alias(name))

    return apply_to(data, replaced), known


def indicator_scores(df: DataFrame, columns: Iterable[str], target: str) -> DataFrame:
    """Table (place, category, f): one-way analysis of variance of every indicator over the classes of the target.

    An indicator is 1 in the rows of its category and 0 in all others, so that its sums per class are counts. They are
    combined before the one shuffle that all columns share; a frequent category costs no more than a rare one. The first
    category of each column has no indicator. ``f`` is NULL where it is undefined and infinite where the class decides.
    """
    names = list(columns)
    # A row without category counts only in its class, which every row has, so classes come out of the same counts.
    cells = staged(_unpivoted(df, names, _given, F.col(target).alias("y")).groupBy("place", "category", "y").count())
    classes = cells.filter("place = 0").groupBy("y").agg(F.sum("count").alias("of_class"))
    n, k = classes.agg(F.coalesce(F.sum("of_class"), F.lit(0)), F.count(F.lit(1))).first()
    given = cells.filter("category is not null").alias("c")
    first = given.groupBy("place").agg(F.min("category").alias("__first"))
    sums = (
        given.join(classes.alias("s"), F.col("c.y").eqNullSafe(F.col("s.y")))
        .groupBy("place", "category")
        .agg(F.sum("count").alias("m"), F.sum(F.col("count") * F.col("count") / F.col("of_class")).alias("b"))
    )
    sums = sums.join(F.broadcast(first), "place").filter("category <> __first")  # a row for each column
    if n <= k or k < 2:
        return sums.select("place", "category", F.lit(None).cast("double").alias("f"))
    m, b = F.col("m").cast("double"), F.col("b")
    whole, inside = m - m * m / n, m - b
    f = F.when(inside <= 1e-12 * whole, float("inf")).otherwise((b - m * m / n) / (k - 1) / (inside / (n - k)))
    return sums.select("place", "category", F.when(F.col("m") < n, f).alias("f"))
