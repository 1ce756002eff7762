"""Values that operators take and return, and questions asked of a schema."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class Splits:
    """One table divided into train, test and, when asked for, validation."""

    train: DataFrame
    test: DataFrame
    validation: DataFrame | None = None

    def items(self) -> list[tuple[str, DataFrame]]:
        parts = [("Train", self.train), ("Validation", self.validation), ("Test", self.test)]
        return [(label, df) for label, df in parts if df is not None]

    def map(self, change: Callable[[DataFrame], DataFrame]) -> Splits:
        validation = None if self.validation is None else change(self.validation)
        return Splits(change(self.train), change(self.test), validation)

    def labelled(self, column: str = "Set") -> DataFrame:
        """All rows in one frame, with the part each row belongs to."""
        frames = [df.withColumn(column, F.lit(label)) for label, df in self.items()]
        union = frames[0]
        for df in frames[1:]:
            union = union.unionByName(df)
        return union


Data = DataFrame | Splits


def training(data: Data) -> DataFrame:
    """The frame whose rows decide the parameters of an operator."""
    return data.train if isinstance(data, Splits) else data


def apply_to(data: Data, change: Callable[[DataFrame], DataFrame]) -> Data:
    return data.map(change) if isinstance(data, Splits) else change(data)


def labelled(data: Data, column: str = "Set") -> DataFrame:
    return data.labelled(column) if isinstance(data, Splits) else data.withColumn(column, F.lit("All"))


@dataclass(frozen=True)
class Outcome:
    """What an operator did. Only ``success`` and ``warning`` with ``changed`` carry new data."""

    status: str
    message: str
    data: Any
    details: dict | None = None

    @property
    def ok(self) -> bool:
        return self.status == "success"


CATEGORY = "category"


def _is_category(field: T.StructField) -> bool:
    return bool((field.metadata or {}).get(CATEGORY))


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType) and not _is_category(f)]


def non_numeric_columns(df: DataFrame) -> list[str]:
    numeric = set(numeric_columns(df))
    return [c for c in df.columns if c not in numeric]


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.StringType) and not _is_category(f)]


def temporal_columns(df: DataFrame) -> list[str]:
    kinds = (T.DateType, T.TimestampType, T.TimestampNTZType)
    return [f.name for f in df.schema if isinstance(f.dataType, kinds)]


def all_numeric(df: DataFrame) -> bool:
    return len(numeric_columns(df)) == len(df.columns)


def is_float(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, (T.FloatType, T.DoubleType))


def missing(df: DataFrame, name: str) -> Column:
    """True where a value is absent: NULL, or NaN in a floating column."""
    column = F.col(name)
    return column.isNull() | F.isnan(column) if is_float(df, name) else column.isNull()


def number(df: DataFrame, name: str) -> Column:
    """A numeric column as double with NaN read as NULL."""
    value = F.col(name).cast("double")
    return F.when(~F.isnan(value), value) if is_float(df, name) else value


def sql_text(text: str) -> str:
    """A string literal of Spark SQL."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def kinds_report(df: DataFrame) -> DataFrame:
    """Which columns count as numbers, as text and as points in time."""
    kinds = [set(of(df)) for of in (numeric_columns, string_columns, temporal_columns)]
    rows = ", ".join(f"{sql_text(c)}, {', '.join(str(c in kind).lower() for kind in kinds)}" for c in df.columns)
    listed = f"stack({len(df.columns)}, {rows}) as (column, numeric, text, temporal)"
    return df.sparkSession.range(1).selectExpr(listed)


def dtypes_report(df: DataFrame) -> DataFrame:
    rows = ", ".join(f"{sql_text(name)}, {sql_text(kind)}" for name, kind in df.dtypes)
    one = df.sparkSession.range(1)
    return one.selectExpr(f"stack({len(df.columns)}, {rows}) as (column, data_type)")
