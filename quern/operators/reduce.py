"""Fewer columns: variance threshold, principal components, best features by F test."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from functools import reduce
from operator import and_

import numpy as np
from pyspark.ml.feature import PCA, PCAModel, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.frames import (
    CATEGORY,
    Data,
    apply_to,
    non_numeric_columns,
    number,
    numeric_columns,
    string_columns,
    training,
)
from quern.operators.encode import short_list
from quern.operators.indicators import indicator_scores
from quern.operators.scale import SCALERS, Scaling, fit_standard, scaled

ONE_PASS_TERMS = 400


def low_variance_columns(df: DataFrame, threshold: float, columns: Iterable[str] | None = None) -> list[str]:
    """Numeric columns whose population variance does not exceed the threshold; all in one pass.

    For a threshold of zero a column counts as constant when either its variance or its range is zero.
    """
    names = list(columns or numeric_columns(df))
    if not names:
        return []
    parts = []
    for i, name in enumerate(names):
        value = number(df, name)
        spread = F.var_pop(value)
        if threshold == 0:
            spread = F.least(spread, F.max(value) - F.min(value))
        parts.append(spread.alias(f"v{i}"))
    row = df.agg(*parts).first()
    return [name for name, spread in zip(names, row) if spread is None or spread <= threshold]


def variance_threshold(data: Data, threshold: float = 0.0) -> Data:
    """Drop numeric columns of low training variance; the other kinds of columns come first."""
    df = training(data)
    dropped = set(low_variance_columns(df, threshold))
    numeric = [c for c in numeric_columns(df) if c not in dropped]
    if not numeric:
        raise ValueError(f"no column has a variance above {threshold}")
    order = non_numeric_columns(df) + numeric
    return apply_to(data, lambda part: part.select(*order))


@dataclass(frozen=True)
class Components:
    """Principal components of numeric columns."""

    columns: list[str]
    scaling: Scaling
    centre: np.ndarray
    loadings: np.ndarray
    """One row per column, one column per component."""
    explained: list[float]
    model: PCAModel

    def cumulative(self) -> list[float]:
        return np.cumsum(self.explained).tolist()


def fit_pca(
    df: DataFrame, n_components: int | None = None, scaler: str | None = "StandardScaler (Z-score)"
) -> Components:
    """Covariance by one distributed pass; only the d x d matrix reaches the driver.

    The sign of each component makes its largest loading positive.
    """
    names = numeric_columns(df)
    if not names:
        raise LookupError("principal components need numeric columns")
    scaling = SCALERS.get(scaler, fit_standard)(df, names) if scaler else {}
    prepared = scaled(df, scaling)
    row = prepared.agg(F.count(F.lit(1)), *[F.avg(number(prepared, c)).alias(f"m{i}") for i, c in enumerate(names)])
    rows, *means = row.first()
    most = min(rows, len(names))
    count = most if n_components is None else min(n_components, most)
    assembled = _assembled(prepared, names)
    model = PCA(k=len(names), inputCol="__x", outputCol="__y").fit(assembled)
    loadings = model.pc.toArray()[:, :count]
    largest = loadings[np.argmax(np.abs(loadings), axis=0), np.arange(count)]
    loadings = loadings * np.where(largest < 0, -1.0, 1.0)
    explained = model.explainedVariance.toArray()[:count].tolist()
    return Components(names, scaling, np.array(means, dtype=float), loadings, explained, model)


def _assembled(df: DataFrame, names: list[str]) -> DataFrame:
    doubles = df.select(*[number(df, c).alias(c) for c in names])
    return VectorAssembler(inputCols=names, outputCol="__x").transform(doubles).select("__x")


def project(df: DataFrame, components: Components) -> DataFrame:
    """The other columns followed by PC1, PC2, ..."""
    rest = [c for c in df.columns if c not in components.columns]
    prepared = scaled(df, components.scaling)
    offset = components.centre @ components.loadings
    width = components.loadings.shape[1]
    if components.loadings.size <= ONE_PASS_TERMS:
        outputs = []
        for j in range(width):
            terms = [number(prepared, c) * float(w) for c, w in zip(components.columns, components.loadings[:, j])]
            total: Column = terms[0]
            for term in terms[1:]:
                total = total + term
            outputs.append((total - float(offset[j])).alias(f"PC{j + 1}"))
        return prepared.select(*rest, *outputs)
    # Many terms: leave the product to the fitted model, whose signs may differ from ours.
    plain = components.model.pc.toArray()[:, :width]
    signs = np.sign((plain * components.loadings).sum(axis=0))
    # A row with an absent value has no components, as above.
    whole = reduce(and_, [number(prepared, c).isNotNull() for c in components.columns])
    assembler = VectorAssembler(inputCols=components.columns, outputCol="__x", handleInvalid="keep")
    vectors = assembler.transform(prepared.withColumn("__whole", whole))
    values = vector_to_array(F.col("__y"))
    outputs = [
        F.when(F.col("__whole"), values[j] * float(signs[j]) - float(offset[j])).alias(f"PC{j + 1}") for j in range(width)
    ]
    return components.model.transform(vectors).select(*rest, *outputs)


def pca(
    data: Data, n_components: int | None = None, scaler: str | None = "StandardScaler (Z-score)"
) -> tuple[Data, Components]:
    components = fit_pca(training(data), n_components, scaler)
    return apply_to(data, lambda df: project(df, components)), components


def explained_variance(df: DataFrame, components: Components) -> DataFrame:
    """Share of the variance per component and its running total."""
    rows = [
        (f"PC{i + 1}", float(share), float(total))
        for i, (share, total) in enumerate(zip(components.explained, components.cumulative()))
    ]
    return df.sparkSession.createDataFrame(rows, "component string, ratio double, cumulative double")


def f_statistics(df: DataFrame, target: str) -> dict[str, float | None]:
    """One-way analysis of variance of every feature over the classes of the target.

    Text columns enter as indicators of each category but the first.
    """
    return _f_of(df, features(df, target), target)


def _f_of(df: DataFrame, values: dict[str, Column], target: str) -> dict[str, float | None]:
    """Sums per class are combined before the shuffle and reduced in a second aggregation.

    Values are centred first, since the sums of their squares are subtracted from each other.
    """
    means = df.agg(*[F.avg(x).alias(f"m{i}") for i, x in enumerate(values.values())]).first()
    centred = df.select(
        F.col(target).alias("y"), *[(x - F.lit(means[i])).alias(f"x{i}") for i, x in enumerate(values.values())]
    )
    sums = [F.count(F.lit(1)).alias("n")]
    for i in range(len(values)):
        sums += [F.sum(f"x{i}").alias(f"s{i}"), F.sum(F.col(f"x{i}") * F.col(f"x{i}")).alias(f"q{i}")]
    classes = centred.groupBy("y").agg(*sums)
    totals = [F.sum("n").alias("n"), F.count(F.lit(1)).alias("k")]
    for i in range(len(values)):
        s = F.col(f"s{i}")
        totals += [F.sum(s * s / F.col("n")).alias(f"b{i}"), F.sum(s).alias(f"s{i}"), F.sum(f"q{i}").alias(f"q{i}")]
    row = classes.agg(*totals).first()
    free = row["n"] - row["k"] if row["n"] else 0
    result: dict[str, float | None] = {}
    for i, name in enumerate(values):
        if free <= 0 or row["k"] < 2 or row[f"b{i}"] is None:
            result[name] = None
            continue
        between = row[f"b{i}"] - row[f"s{i}"] ** 2 / row["n"]
        inside = row[f"q{i}"] - row[f"b{i}"]
        if row[f"q{i}"] <= 0:
            result[name] = None  # constant
        elif inside <= 1e-12 * row[f"q{i}"]:
            result[name] = float("inf")  # the class decides the value
        else:
            result[name] = (between / (row["k"] - 1)) / (inside / free)
    return result


def _texts(df: DataFrame, names: list[str]) -> list[str]:
    """The columns of categories among ``names``."""
    found = set(string_columns(df)) | {f.name for f in df.schema if (f.metadata or {}).get(CATEGORY)}
    return [c for c in names if c in found]


def features(df: DataFrame, target: str, max_categories: int | None = None) -> dict[str, Column]:
    """Every column but the target as a number."""
    names = [c for c in df.columns if c != target]
    texts = _texts(df, names)
    values: dict[str, Column] = {}
    for name in names:
        if name not in texts:
            values[name] = F.col(name).cast("double")
            continue
        listed = short_list(df.filter(F.col(name).isNotNull()), F.col(name), max_categories)
        if listed is None:
            raise ValueError(f"{name} has more than {max_categories} categories")
        for category in listed[1:]:
            values[f"{name}_{category}"] = F.when(F.col(name) == category, 1.0).otherwise(0.0)
    return values


def select_best(df: DataFrame, target: str, k: int) -> DataFrame:
    """The k features with the largest F statistic, in their original order, and the target.

    Text columns enter as indicators of each category but the first. Their statistics are a table, of which only the k
    best are brought to the driver, so a column may have any number of categories.
    """
    names = [c for c in df.columns if c != target]
    texts = _texts(df, names)
    values = {c: F.col(c).cast("double") for c in names if c not in texts}
    scores = _f_of(df, values, target) if values else {}
    # What is compared: undefined last, the largest first, then columns and categories in their order.
    ranked = [(scores[c] is None, -(scores[c] or 0.0), names.index(c), "", c, values[c]) for c in values]
    if texts:
        listed = indicator_scores(df, texts, target).orderBy(F.desc_nulls_last("f"), "place", "category").limit(k)
        for row in listed.collect():
            column, category = texts[row["place"]], row["category"]
            value = F.when(F.col(column) == category, 1.0).otherwise(0.0)
            place = (names.index(column), category, f"{column}_{category}", value)
            ranked.append((row["f"] is None, -(row["f"] or 0.0), *place))
    best = sorted(ranked, key=lambda x: x[:4])[:k]
    return df.select(*[value.alias(name) for *_, name, value in sorted(best, key=lambda x: x[2:4])], target)
