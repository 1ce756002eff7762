"""Whole-column changes: keep, rename, drop; sizes before and after."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.frames import Data, apply_to, labelled, training


def keep(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    return df.select(*columns)


def renamed(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Keep the listed columns under their new names, in the order listed."""
    return df.select(*[F.col(old).alias(new) for old, new in names.items()])


def rename_column(data: Data, old_name: str, new_name: str) -> Data:
    """Rename one column; nothing happens when it is absent."""
    columns = training(data).columns
    if not new_name or new_name == old_name or new_name in columns:
        raise ValueError(f"{new_name!r} cannot be the new name of {old_name!r}")
    return apply_to(data, lambda df: df.withColumnRenamed(old_name, new_name))


def drop_columns(data: Data, columns: Iterable[str]) -> Data:
    names = list(columns)
    return apply_to(data, lambda df: df.drop(*names))


def exclude_values(df: DataFrame, column: str, values: Iterable) -> DataFrame:
    """Rows whose column is none of the values; NULL does not qualify."""
    return df.filter(~F.col(column).isin(*values))


def shape_report(before: DataFrame, after: Data) -> DataFrame:
    """Rows and columns per part, with the change against the initial frame."""
    width = len(training(after).columns)
    first = before.agg(F.count(F.lit(1)).alias("initial_rows"))
    now = labelled(after).groupBy("Set").agg(F.count(F.lit(1)).alias("rows"))
    total = first.first()[0]
    return now.select(
        "Set",
        "rows",
        F.lit(width).cast("bigint").alias("columns"),
        (F.col("rows") - F.lit(total)).alias("rows_change"),
        F.lit(width - len(before.columns)).cast("bigint").alias("columns_change"),
    )


def head(df: DataFrame, rows: int = 5) -> DataFrame:
    return df.limit(rows)


def tail(df: DataFrame, order_by: str, rows: int = 5) -> DataFrame:
    """The last rows along an explicit order."""
    return df.orderBy(F.col(order_by).desc()).limit(rows)
