"""Scaling of all numeric columns with parameters from the training part."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.frames import Data, apply_to, number, numeric_columns, training
from quern.operators.quantiles import exact_quantiles

Scaling = dict[str, tuple[float, float]]
"""Per column the value to subtract and the one to divide by."""


def _divisor(size: float | None) -> float:
    return size if size else 1.0


def fit_standard(df: DataFrame, columns: Iterable[str]) -> Scaling:
    """Mean and population standard deviation; a constant column is only centred."""
    names = list(columns)
    row = df.agg(
        *[f(number(df, c)).alias(f"{f.__name__}{i}") for i, c in enumerate(names) for f in (F.avg, F.stddev_pop)]
    ).first()
    return {c: (row[2 * i], _divisor(row[2 * i + 1])) for i, c in enumerate(names) if row[2 * i] is not None}


def fit_minmax(df: DataFrame, columns: Iterable[str]) -> Scaling:
    names = list(columns)
    row = df.agg(
        *[f(number(df, c)).alias(f"{f.__name__}{i}") for i, c in enumerate(names) for f in (F.min, F.max)]
    ).first()
    pairs = {c: (row[2 * i], row[2 * i + 1]) for i, c in enumerate(names)}
    return {c: (low, _divisor(high - low)) for c, (low, high) in pairs.items() if low is not None}


def fit_robust(df: DataFrame, columns: Iterable[str]) -> Scaling:
    """Median and interquartile range."""
    found = exact_quantiles(df, list(columns), [0.25, 0.5, 0.75])
    return {c: (v[1], _divisor(v[2] - v[0])) for c, v in found.items() if v[1] is not None}


SCALERS = {
    "StandardScaler (Z-score)": fit_standard,
    "MinMaxScaler (0-1 range)": fit_minmax,
    "Robust Scaler": fit_robust,
}


def scaled(df: DataFrame, scaling: Scaling) -> DataFrame:
    return df.withColumns({c: (number(df, c) - centre) / size for c, (centre, size) in scaling.items()})


def scale(data: Data, method: str) -> Data:
    df = training(data)
    columns = numeric_columns(df)
    if not columns:
        return data
    scaling = SCALERS[method](df, columns)
    return apply_to(data, lambda part: scaled(part, scaling))
