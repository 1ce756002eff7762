"""Numbers for categories, learned from the training part."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.frames import Data, Splits, apply_to, number, string_columns, training
from quern.operators.ordering import global_index
from quern.staging import checkpointed, discard

# A list of categories up to this length is sorted on the driver and sent to every task.
SHORT_LIST = 10_000
# Indicators in a plan where all of them are made a block at a time.
BLOCK = 500


def _text(column: str) -> Column:
    """The category as text, absent values under the name they have as text."""
    return F.coalesce(F.col(column).cast("string"), F.lit("nan"))


def short_list(df: DataFrame, category: Column, limit: int | None) -> list[str] | None:
    """Sorted distinct categories, or None when there are more than ``limit`` (None: no limit)."""
    distinct = df.select(category.alias("c")).distinct()
    rows = (distinct if limit is None else distinct.limit(limit + 1)).collect()
    return sorted(row["c"] for row in rows) if limit is None or len(rows) <= limit else None


def category_codes(df: DataFrame, column: str, short: int = SHORT_LIST) -> DataFrame:
    """Table (category, code) with codes 0..k-1 in the order of the categories."""
    listed = short_list(df, _text(column), short)
    if listed is None:
        distinct = df.select(_text(column).alias("__category")).distinct()
        return global_index(distinct, ["__category"], "__code", start=0)
    return _listed_codes(df, listed)


def _listed_codes(df: DataFrame, listed: list[str]) -> DataFrame:
    rows = list(enumerate(listed))
    table = df.sparkSession.createDataFrame(rows, "__code bigint, __category string")
    return F.broadcast(table.select("__category", "__code"))


def _with_codes(df: DataFrame, column: str, codes: DataFrame) -> DataFrame:
    return df.join(codes, _text(column) == F.col("__category"), "left").drop("__category")


def label_encode(data: Data, columns: Iterable[str], short: int = SHORT_LIST) -> Data:
    """Replace text by its rank among the training categories. A category unknown there is an error."""
    for column in columns:
        codes = category_codes(training(data), column, short)
        order = training(data).columns
        if isinstance(data, Splits):
            for label, part in data.items()[1:]:
                unseen = _with_codes(part, column, codes).filter("__code is null").select(column).limit(1).collect()
                if unseen:
                    raise ValueError(f"{label}: {column} has {unseen[0][0]!r}, which the training part lacks")
        data = apply_to(data, lambda df: _replaced(df, column, codes, order, F.col("__code")))
    return data


def ordinal_encode(data: Data, columns: Iterable[str], unknown: float = -1.0, short: int = SHORT_LIST) -> Data:
    """The same as floating codes, with ``unknown`` for categories the training part lacks."""
    for column in columns:
        codes = category_codes(training(data), column, short)
        order = training(data).columns
        value = F.coalesce(F.col("__code").cast("double"), F.lit(unknown))
        data = apply_to(data, lambda df: _replaced(df, column, codes, order, value))
    return data


def _replaced(df: DataFrame, column: str, codes: DataFrame, order: list[str], value: Column) -> DataFrame:
    return _with_codes(df, column, codes).withColumn(column, value).select(*order)


def category_blocks(data: Data, column: str, width: int = BLOCK) -> Iterator[list[str]]:
    """Every training category but the first, in order, in lists of ``width`` at most, for ``only`` of ``one_hot_encode``.

    The driver holds a bounded number of them at a time; the others stay in a distributed table.
    """
    distinct = training(data).select(_text(column).alias("__category")).distinct()
    codes = global_index(distinct, ["__category"], "__code", start=0)
    step = width * max(1, SHORT_LIST // width)
    for start in range(1, codes.count(), step):
        rows = codes.filter(F.col("__code").between(start, start + step - 1)).collect()
        listed = [category for _, category in sorted((row["__code"], row["__category"]) for row in rows)]
        yield from (listed[i : i + width] for i in range(0, len(listed), width))
    discard(codes)


def one_hot_encode(
    data: Data, columns: Iterable[str], max_categories: int | None = None, only: Mapping[str, Sequence[str]] | None = None
) -> Data:
    """One column per training category but the first; an unknown category has zero in all of them.

    The new columns follow the remaining ones. Every category is a column of the result; ``max_categories`` refuses
    columns with more of them. A row's place among the categories is joined, so the plan has only a comparison with a
    number for each column; a list in the plan would be copied for each of them when a filter on them is moved down.

    A plan grows with its columns, on the driver and in each task. For more categories than these hold, ``only`` names
    those that get a column (see ``category_blocks``), so that all columns are made a block at a time. Blocks of one
    length differ in names alone, and tasks compile their code once.
    """
    names = list(columns)
    indicators: dict[str, str] = {}
    places: dict[str, DataFrame] = {}
    for i, column in enumerate(names):
        if only is None:
            listed = short_list(training(data), _text(column), max_categories)
            if listed is None:
                raise ValueError(f"{column} has more than {max_categories} categories")
            listed = listed[1:]
        else:
            listed = only[column]
        places[column] = _listed_codes(training(data), listed).withColumnRenamed("__code", f"__place{i}")
        for k, category in enumerate(listed):
            indicators[f"{column}_{category}"] = f"double(__place{i} <=> {k}L)"

    def widened(df: DataFrame) -> DataFrame:
        chosen = dict.fromkeys(c for c in df.columns if c not in names) | indicators
        for column, codes in places.items():
            df = _with_codes(df, column, codes)
        if any("${" in c for c in chosen):  # in a parsed text, ${x} would be replaced by a setting
            return df.select(*[F.expr(value).alias(c) if value else F.col(_quoted(c)) for c, value in chosen.items()])
        return df.selectExpr(*[f"{value} as {_quoted(c)}" if value else _quoted(c) for c, value in chosen.items()])

    return apply_to(data, widened)


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def category_means(df: DataFrame, column: str, target: str, smoothing: float = 0.0) -> DataFrame:
    """Mean of the target per category, drawn towards the overall mean by ``smoothing``.

    Sums are combined before the shuffle, so a frequent category costs no more than a rare one.
    """
    value = number(df, target)
    means = df.groupBy(F.col(column).alias("__category")).agg(
        F.avg(value).alias("__mean"), F.count(value).alias("__n")
    )
    if smoothing > 0:
        overall = df.agg(F.avg(value)).first()[0]
        blended = (F.col("__mean") * F.col("__n") + overall * smoothing) / (F.col("__n") + smoothing)
        means = means.withColumn("__mean", blended)
    return means.select("__category", "__mean")


def target_encode(
    data: Data, columns: Iterable[str], target: str, smoothing: float = 0.0, short: int = SHORT_LIST
) -> Data:
    """Add ``<column>_TargetEncoded``.

    With splits, categories without a training mean get the overall training mean. Without splits an absent
    category has no mean and stays NULL.
    """
    df = training(data)
    default = F.lit(None)
    if isinstance(data, Splits):
        default = F.lit(df.agg(F.avg(number(df, target))).first()[0])
    for column in columns:
        if column == target:
            continue
        means = checkpointed(category_means(df, column, target, smoothing))
        if means.count() <= short:
            means = F.broadcast(means)
        data = apply_to(data, lambda part: _with_mean(part, column, means, default))
    return data


def _with_mean(df: DataFrame, column: str, means: DataFrame, default: Column) -> DataFrame:
    joined = df.join(means, F.col(column) == F.col("__category"), "left").drop("__category")
    return joined.withColumn(f"{column}_TargetEncoded", F.coalesce("__mean", default)).drop("__mean")


def group_statistic(df: DataFrame, column: str, target: str, name: str, statistic: str = "mean") -> DataFrame:
    """Every row with the mean or count of the target in its group.

    The groups are aggregated first and joined back, so no group is gathered in one task.
    """
    value = number(df, target)
    measure = {"mean": F.avg, "count": F.count}[statistic](value)
    groups = df.groupBy(F.col(column).alias("__group")).agg(measure.alias(name))
    return df.join(groups, F.col(column) == F.col("__group"), "left").drop("__group")


def encode(data: Data, method: str, columns: Iterable[str] | None = None, target: str | None = None) -> Data:
    present = string_columns(training(data))
    chosen = [c for c in (present if columns is None else columns) if c in present]
    if not chosen:
        raise LookupError("no text columns to encode")
    if method == "Label Encoding":
        return label_encode(data, chosen)
    if method == "Ordinal Encoding":
        return ordinal_encode(data, chosen)
    if method == "One-Hot Encoding":
        return one_hot_encode(data, chosen)
    if method == "Target Encoding":
        if not target or target not in training(data).columns:
            raise LookupError(f"target column {target!r} not found")
        return target_encode(data, chosen, target)
    raise ValueError(f"unknown encoding method: {method}")


