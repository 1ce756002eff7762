"""Removal of rows whose value in one column is extreme. Bounds come from the training part."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.frames import Data, apply_to, number, training
from quern.operators.quantiles import exact_quantiles

# Fixed values of the isolation forest.
TREES, TREE_ROWS, CONTAMINATION, SEED = 100, 256, 0.05, 42


def iqr_bounds(df: DataFrame, column: str) -> tuple[float | None, float | None]:
    low, high = exact_quantiles(df, [column], [0.25, 0.75])[column]
    if low is None:
        return None, None
    reach = 1.5 * (high - low)
    return low - reach, high + reach


def percentage_bounds(
    df: DataFrame, column: str, bottom: float, top: float
) -> tuple[float | None, float | None]:
    for share in (bottom, top):
        if not 0 <= share <= 0.5:
            raise ValueError(f"a share to remove must lie between 0 and 0.5, got {share}")
    low, high = exact_quantiles(df, [column], [bottom, 1 - top])[column]
    return low, high


def within(df: DataFrame, column: str, bounds: tuple[float | None, float | None]) -> DataFrame:
    """Rows inside the closed range; absent values are not inside."""
    low, high = bounds
    return df.filter(F.col(column).between(F.lit(low), F.lit(high)))


def remove_iqr(data: Data, column: str) -> Data:
    bounds = iqr_bounds(training(data), column)
    return apply_to(data, lambda df: within(df, column, bounds))


def remove_percentage(data: Data, column: str, bottom: float = 0.01, top: float = 0.01) -> Data:
    bounds = percentage_bounds(training(data), column, bottom, top)
    return apply_to(data, lambda df: within(df, column, bounds))


@dataclass(frozen=True)
class Forest:
    """Anomaly score of a single column: a step function of the value.

    ``scores[i]`` holds for values in (edges[i-1], edges[i]].
    """

    edges: np.ndarray
    scores: np.ndarray

    def step(self, value: Column) -> Column:
        edges = self.edges

        @F.pandas_udf("int")
        def find(values: pd.Series) -> pd.Series:
            return pd.Series(np.searchsorted(edges, values.to_numpy(), side="left").astype("int32"))

        return find(value)


def _average_path(rows: np.ndarray) -> np.ndarray:
    """Mean depth of an unsuccessful search in a binary tree over so many rows."""
    size = np.maximum(np.asarray(rows, dtype=float), 1.0)
    long = 2.0 * (np.log(np.maximum(size - 1.0, 1.0)) + np.euler_gamma) - 2.0 * (size - 1.0) / size
    return np.where(size <= 1, 0.0, np.where(size == 2, 1.0, long))


def _tree(values: np.ndarray, random: np.random.Generator, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """Cut points of one isolation tree and the path length between them."""
    cuts: list[float] = []
    lengths: list[float] = []

    def grow(part: np.ndarray, depth: int) -> None:
        if depth == limit or part.size <= 1 or part[0] == part[-1]:
            lengths.append(depth + float(_average_path(part.size)))
            return
        cut = random.uniform(part[0], part[-1])
        at = int(np.searchsorted(part, cut, side="right"))
        grow(part[:at], depth + 1)
        cuts.append(cut)
        grow(part[at:], depth + 1)

    grow(np.sort(values), 0)
    return np.array(cuts), np.array(lengths)


def fit_forest(
    df: DataFrame, column: str, trees: int = TREES, tree_rows: int = TREE_ROWS, seed: int = SEED
) -> Forest:
    """Trees over small random samples, as the method prescribes; the sample is all that is fetched.

    The sample holds the values of largest count over a number hashed from seed and value, each with the weight that
    makes up for those left out (priority sampling). So it depends on the values alone, not on how rows are divided.
    """
    counts = df.select(number(df, column).alias("x")).filter("x is not null").groupBy("x").agg(F.count("x").alias("n"))
    # A number above 0 and at most 1 for each value.
    drawn = (F.pmod(F.xxhash64(F.lit(seed), "x"), F.lit(1 << 53)) + 1) / float(1 << 53)
    ranked = counts.withColumn("p", F.col("n") / drawn).orderBy(F.desc("p"), "x").limit(trees * tree_rows + 1).collect()
    if not ranked:
        raise ValueError(f"{column} has no values")
    floor = 0.0
    if len(ranked) > trees * tree_rows:
        floor = ranked.pop()["p"]
    ranked.sort(key=lambda row: row["x"])
    pool = np.array([row["x"] for row in ranked], dtype=float)
    weight = np.maximum([float(row["n"]) for row in ranked], floor)
    random = np.random.default_rng(seed)
    size = int(min(tree_rows, weight.sum()))
    limit = int(np.ceil(np.log2(max(size, 2))))
    if weight.sum() <= trees * tree_rows:
        rows = np.repeat(pool, weight.astype(int))  # every row is here, so trees draw each at most once
        samples = (random.choice(rows, size, replace=False) for _ in range(trees))
    else:
        samples = (random.choice(pool, size, p=weight / weight.sum()) for _ in range(trees))
    grown = [_tree(sample, random, limit) for sample in samples]
    edges = np.unique(np.concatenate([cuts for cuts, _ in grown]))
    # Any value between two neighbouring edges has the same path in every tree; take the upper edge.
    inside = np.append(edges, np.inf)
    depth = sum(lengths[np.searchsorted(cuts, inside, side="left")] for cuts, lengths in grown) / trees
    return Forest(edges, -np.power(2.0, -depth / max(float(_average_path(size)), 1e-12)))


def forest_keeps(df: DataFrame, column: str, forest: Forest, contamination: float = CONTAMINATION) -> np.ndarray:
    """Which steps of the score survive: those not below the ``contamination`` quantile of ``df``'s scores."""
    value = number(df, column)
    counts = df.filter(value.isNotNull()).groupBy(forest.step(value).alias("step")).count().collect()
    steps = np.array([row["step"] for row in counts])
    sizes = np.array([row["count"] for row in counts])
    order = np.argsort(forest.scores[steps], kind="stable")
    scores, ends = forest.scores[steps][order], np.cumsum(sizes[order])
    place = contamination * (ends[-1] - 1)
    low, high = (scores[np.searchsorted(ends, np.floor(place) + extra, side="right")] for extra in (0, place % 1 > 0))
    cutoff = low + (high - low) * (place % 1)
    return forest.scores >= cutoff


def remove_isolated(data: Data, column: str, contamination: float = CONTAMINATION, seed: int = SEED) -> Data:
    fitted = training(data)
    forest = fit_forest(fitted, column, seed=seed)
    kept = _kept_ranges(forest, forest_keeps(fitted, column, forest, contamination))
    return apply_to(data, lambda df: df.filter(_in_ranges(number(df, column), kept)))


def _kept_ranges(forest: Forest, keeps: np.ndarray) -> list[tuple[float | None, float | None]]:
    """Neighbouring surviving steps joined to half-open ranges (low, high]."""
    ranges: list[tuple[float | None, float | None]] = []
    ends = [None, *forest.edges.tolist(), None]
    for step in np.flatnonzero(keeps):
        low, high = ends[step], ends[step + 1]
        if ranges and ranges[-1][1] == low and low is not None:
            ranges[-1] = (ranges[-1][0], high)
        else:
            ranges.append((low, high))
    return ranges


_PLAIN_RANGES = 200


def _in_ranges(value: Column, ranges: list[tuple[float | None, float | None]]) -> Column:
    """A plain predicate for the usual few ranges, a batched search for many."""
    if len(ranges) > _PLAIN_RANGES:
        lows = np.array([-np.inf if low is None else low for low, _ in ranges])
        highs = np.array([np.inf if high is None else high for _, high in ranges])

        @F.pandas_udf("boolean")
        def inside(values: pd.Series) -> pd.Series:
            x = values.to_numpy(dtype=float)
            at = np.searchsorted(lows, x, side="left") - 1
            return pd.Series((at >= 0) & (x <= highs[np.maximum(at, 0)]))

        return value.isNotNull() & inside(value)
    test = F.lit(False)
    for low, high in ranges:
        part = value.isNotNull()
        if low is not None:
            part = part & (value > low)
        if high is not None:
            part = part & (value <= high)
        test = test | part
    return test


REMOVERS = {"IQR": remove_iqr, "Percentage": remove_percentage, "Isolation Forest": remove_isolated}
