"""Absent values: report, drop, fill."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quern.frames import missing, number, numeric_columns, sql_text
from quern.operators.profile import modes
from quern.operators.quantiles import exact_quantiles

HIGH_PERCENT = 5.0


def missing_report(df: DataFrame, only_affected: bool = False) -> DataFrame:
    """Count, percentage and severity of absent values, one row per column, from one pass."""
    counts = [F.count_if(missing(df, name)).alias(f"n{i}") for i, name in enumerate(df.columns)]
    totals = df.agg(F.count(F.lit(1)).alias("rows"), *counts)
    pairs = ", ".join(f"{sql_text(name)}, n{i}" for i, name in enumerate(df.columns))
    listed = totals.selectExpr("rows", f"stack({len(counts)}, {pairs}) as (column, missing)")
    share = F.col("missing") / F.nullif(F.col("rows"), F.lit(0)) * 100
    report = listed.select(
        "column",
        "missing",
        F.round(share, 2).alias("missing_percent"),
        F.when(share > HIGH_PERCENT, F.lit("High")).otherwise(F.lit("Low")).alias("severity"),
    )
    return report.filter("missing > 0") if only_affected else report


def columns_with_missing(df: DataFrame) -> list[str]:
    row = df.agg(*[F.bool_or(missing(df, c)).alias(f"m{i}") for i, c in enumerate(df.columns)]).first()
    return [name for name, found in zip(df.columns, row) if found]


def drop_rows(df: DataFrame) -> DataFrame:
    return df.dropna("any")


def drop_columns_with_missing(df: DataFrame) -> DataFrame:
    return df.drop(*columns_with_missing(df))


def _fill_numbers(df: DataFrame, values: dict[str, float | None]) -> DataFrame:
    # An integer column that had absent values carries fractions once filled, so it becomes double.
    filled = {c: F.coalesce(number(df, c), F.lit(v)) for c, v in values.items() if v is not None}
    return df.withColumns(filled) if filled else df


def fill_mean(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Fill numeric columns with their mean; others are left alone."""
    chosen = [c for c in numeric_columns(df) if c in set(columns)]
    if not chosen:
        return df
    row = df.agg(*[F.avg(number(df, c)).alias(f"m{i}") for i, c in enumerate(chosen)]).first()
    return _fill_numbers(df, dict(zip(chosen, row)))


def fill_median(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    chosen = [c for c in numeric_columns(df) if c in set(columns)]
    return _fill_numbers(df, {c: v[0] for c, v in exact_quantiles(df, chosen, [0.5]).items()})


def fill_mode(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Fill with the most frequent value, the smallest one among equals; all columns are counted in one scan."""
    filled = {c: F.when(missing(df, c), mode).otherwise(F.col(c)) for c, mode in modes(df, columns).items()}
    return df.withColumns(filled) if filled else df


def fill_custom(df: DataFrame, value: str) -> DataFrame:
    """Fill the whole table with one value; a column that cannot hold it becomes text."""
    spark = df.sparkSession
    affected = columns_with_missing(df)
    if not affected:
        return df
    fits = spark.range(1).select(
        *[F.lit(str(value)).try_cast(df.schema[c].dataType).isNotNull().alias(c) for c in affected]
    ).first()
    filled = {}
    for name in affected:
        kind = df.schema[name].dataType if fits[name] else T.StringType()
        filled[name] = F.when(missing(df, name), F.lit(str(value)).cast(kind)).otherwise(F.col(name).cast(kind))
    return df.withColumns(filled)
