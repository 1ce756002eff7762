"""One histogram of the values of all columns of a table, from which distinct counts, modes and class sizes are read.

Each row is turned into one (column, value) row per column. Equal ones are counted inside each partition before they are
shuffled, so a frequent value costs no more than a rare one, and the input is scanned once whatever the number of columns.
Values lie in slots of three types that order them as their column does: whole numbers and points in time, fractions, text.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quern.frames import missing, sql_text

SLOTS = ("l", "d", "s")


def _slots(df: DataFrame, name: str) -> dict[str, Column]:
    """The slots that hold a column's value."""
    kind, value = df.schema[name].dataType, F.col(f"`{name}`")
    if isinstance(kind, T.IntegralType):
        return {"l": value.cast("bigint")}
    if isinstance(kind, T.BooleanType):
        return {"l": value.cast("int").cast("bigint")}
    if isinstance(kind, T.DateType):
        return {"l": F.unix_date(value).cast("bigint")}
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return {"l": F.unix_micros(value.cast("timestamp"))}
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return {"d": value.cast("double")}
    if isinstance(kind, T.DecimalType):
        return {"d": value.cast("double"), "s": value.cast("string")}
    if isinstance(kind, (T.ArrayType, T.StructType, T.MapType)):
        return {"s": F.to_json(F.struct(value), {"ignoreNullFields": "false"})}
    return {"s": value.cast("string")}


def typed(kind: T.DataType, l: Column, d: Column, s: Column) -> Column:  # noqa: E741
    """The value of slots as its column's type."""
    if isinstance(kind, T.DateType):
        return F.date_from_unix_date(l.cast("int"))
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.timestamp_micros(l).cast(kind)
    if isinstance(kind, T.BooleanType):
        return l == 1
    if isinstance(kind, T.IntegralType):
        return l.cast(kind)
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return d.cast(kind)
    return s.cast(kind) if isinstance(kind, T.AtomicType) else s


def value_histogram(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """(i, l, d, s, absent, n): how often each value of the i-th column occurs; absent values (NULL, NaN) have a row too."""
    cells = []
    for i, name in enumerate(df.columns if columns is None else columns):
        gone, slots = missing(df, name), _slots(df, name)
        kinds = {"l": "bigint", "d": "double", "s": "string"}
        own = [F.when(~gone, slots[k]).cast(t).alias(k) if k in slots else F.lit(None).cast(t).alias(k) for k, t in kinds.items()]
        cells.append(F.struct(F.lit(i).alias("i"), *own, gone.alias("absent")))
    rows = df.select(F.inline(F.array(*cells)))
    return rows.groupBy("i", *SLOTS, "absent").agg(F.count(F.lit(1)).alias("n"))


def profile(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """One row per column: (column, count, missing, distinct_values, freq, least, l, d, s).

    ``l, d, s`` hold the most frequent value, the smallest one among equals, ``freq`` its count and ``least`` that of the
    rarest value.
    """
    names = list(df.columns if columns is None else columns)
    there = F.when(~F.col("absent"), F.col("n"))
    told = value_histogram(df, names).groupBy("i").agg(
        F.coalesce(F.sum(there), F.lit(0)).alias("count"),
        F.coalesce(F.sum(F.when(F.col("absent"), F.col("n"))), F.lit(0)).alias("missing"),
        F.count(there).alias("distinct_values"),
        F.max(there).alias("freq"),
        F.min(there).alias("least"),
        # Absent ones come last, and are no value even where there is no other.
        F.min_by(F.struct(*SLOTS), F.struct("absent", -F.col("n"), *SLOTS)).alias("top"),
    )
    listed = ", ".join(f"{i}, {sql_text(name)}" for i, name in enumerate(names))
    every = df.sparkSession.range(1).selectExpr(f"stack({len(names)}, {listed}) as (i, column)")
    zero = {c: F.coalesce(c, F.lit(0)) for c in ("count", "missing", "distinct_values")}
    return every.join(told, "i", "left").withColumns(zero).select(
        "column", "count", "missing", "distinct_values", "freq", "least", *[F.col(f"top.{s}") for s in SLOTS]
    )


def modes(df: DataFrame, columns: Iterable[str]) -> dict[str, Column]:
    """The most frequent value of each column as a constant of its type; columns without a value are left out."""
    names = list(columns)
    found = profile(df, names).filter("count > 0").collect() if names else []
    return {
        r["column"]: typed(df.schema[r["column"]].dataType, *[F.lit(r[k]).cast(t) for k, t in zip(SLOTS, ("bigint", "double", "string"))])
        for r in found
    }
