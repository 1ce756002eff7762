"""Statistics of every column."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.frames import missing, number, numeric_columns, sql_text, temporal_columns
from quern.operators.profile import SLOTS, profile, typed
from quern.operators.quantiles import linear, order_values

FIELDS = ("column", "count", "unique", "top", "freq", "mean", "std", "min", "p25", "p50", "p75", "max")


def describe_all(df: DataFrame) -> DataFrame:
    """One row per column: count, then either unique, top and freq, or moments and quartiles, as text and double.

    Numbers and points in time share one scan for moments and two for quartiles; all others are counted by value in
    another one.
    """
    numeric, temporal = numeric_columns(df), temporal_columns(df)
    measured = [c for c in df.columns if c in numeric or c in temporal]
    frames = [_measured(df, measured, temporal)] if measured else []
    counted = [c for c in df.columns if c not in measured]
    if counted:
        frames.append(_counted(df, counted))
    return reduce(lambda a, b: a.unionByName(b), frames)


def _counted(df: DataFrame, names: list[str]) -> DataFrame:
    told = profile(df, names)
    text = {c: typed(df.schema[c].dataType, *[F.col(k) for k in SLOTS]).cast("string") for c in names}
    top = F.coalesce(*[F.when(F.col("column") == c, value) for c, value in text.items()])
    absent = [F.lit(None).cast("double").alias(c) for c in FIELDS[5:]]
    return told.select("column", "count", F.col("distinct_values").alias("unique"), top.alias("top"), "freq", *absent)


def _measured(df: DataFrame, names: list[str], temporal: list[str]) -> DataFrame:
    """Points in time are measured in seconds since 1970."""
    seconds = {c: F.unix_micros(F.col(c).cast("timestamp")) / 1e6 for c in temporal}
    value = {c: seconds[c] if c in seconds else number(df, c) for c in names}
    quartiles = order_values(df, {c: (value[c], linear(0.25, 0.5, 0.75)) for c in names})
    parts = []
    for i, c in enumerate(names):
        std = F.lit(None).cast("double") if c in seconds else F.stddev_samp(value[c])
        parts += [
            F.count(value[c]).alias(f"n{i}"),
            F.avg(value[c]).alias(f"a{i}"),
            std.alias(f"s{i}"),
            F.min(value[c]).alias(f"l{i}"),
            F.max(value[c]).alias(f"h{i}"),
        ]
    row = df.agg(*parts)
    cells = []
    for i, c in enumerate(names):
        middle = [f"double('{q!r}')" if q is not None else "double(null)" for q in quartiles[c]]
        cells += [sql_text(c), f"n{i}", f"a{i}", f"s{i}", f"l{i}", *middle, f"h{i}"]
    listed = row.selectExpr(
        f"stack({len(names)}, {', '.join(cells)}) as (column, count, mean, std, min, p25, p50, p75, max)"
    )
    nothing = {"unique": "bigint", "top": "string", "freq": "bigint"}
    return listed.withColumns({c: F.lit(None).cast(kind) for c, kind in nothing.items()}).select(*FIELDS)


def distinct_counts(df: DataFrame, approximate: bool = False) -> DataFrame:
    """Distinct values per column, exact ones from one histogram of all columns, or from sketches."""
    if approximate:
        row = df.agg(*[F.approx_count_distinct(c).alias(f"n{i}") for i, c in enumerate(df.columns)])
        cells = ", ".join(f"{sql_text(c)}, n{i}" for i, c in enumerate(df.columns))
        return row.selectExpr(f"stack({len(df.columns)}, {cells}) as (column, distinct_values)")
    return profile(df).select("column", "distinct_values")


def value_counts(df: DataFrame, column: str) -> DataFrame:
    return df.filter(~missing(df, column)).groupBy(column).agg(F.count(F.lit(1)).alias("count"))


def smallest_class(df: DataFrame, column: str) -> int:
    return value_counts(df, column).agg(F.min("count")).first()[0] or 0


def column_statistics(df: DataFrame) -> DataFrame:
    """Mean, median and mode of every numeric column, in four scans of the table."""
    names = numeric_columns(df)
    medians = order_values(df, {c: (number(df, c), linear(0.5)) for c in names})
    row = df.agg(*[F.avg(number(df, c)).alias(f"a{i}") for i, c in enumerate(names)]).first()
    rows = [(c, row[i], medians[c][0]) for i, c in enumerate(names)]
    known = df.sparkSession.createDataFrame(rows, "column string, mean double, median double")
    mode = F.coalesce(F.col("d"), F.col("l").cast("double"))
    return known.join(profile(df, names).select("column", mode.alias("mode")), "column")
