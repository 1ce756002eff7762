"""Change of a column's type, with a count of what would be lost."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quern.frames import CATEGORY, Data, Outcome, Splits, apply_to, missing, training

# Texts read as true and as false, compared in lower case.
TRUE_WORDS = ("true", "1", "yes", "t", "y", "approved")
FALSE_WORDS = ("false", "0", "no", "f", "n", "rejected")

# Forms tried in this order.
DATETIME_FORMATS = (
    "yyyy-MM-dd HH:mm:ss[.SSSSSS]",
    "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]",
    "yyyy-MM-dd HH:mm",
    "yyyy-MM-dd",
    "yyyy/MM/dd",
    "MM/dd/yyyy",
    "yyyyMMdd",
)

_NUMBER = r"(?i)^\s*[+-]?((\d+\.?\d*|\.\d+)(e[+-]?\d+)?|inf|infinity)\s*$"

# Limits above which a column is no use as a category.
CATEGORY_ROWS, CATEGORY_SHARE, CATEGORY_VALUES = 100, 0.8, 200


def _is_text(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, T.StringType)


def as_number(df: DataFrame, name: str) -> Column:
    """The value as double, NULL where the text is not a number."""
    value = F.col(name)
    if _is_text(df, name):
        return F.when(value.rlike(_NUMBER), F.trim(value).try_cast("double"))
    kind = df.schema[name].dataType
    if isinstance(kind, T.DateType):
        return F.unix_micros(value.cast("timestamp")).cast("double") * 1000
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(value.cast("timestamp")).cast("double") * 1000
    return F.when(~missing(df, name), value.cast("double"))


def as_datetime(df: DataFrame, name: str, formats=DATETIME_FORMATS) -> Column:
    """The value as timestamp: text by the first form that fits, numbers as nanoseconds since 1970."""
    value = F.col(name)
    kind = df.schema[name].dataType
    if isinstance(kind, T.StringType):
        return F.coalesce(*[F.try_to_timestamp(F.trim(value), F.lit(form)) for form in formats])
    if isinstance(kind, T.NumericType):
        return F.timestamp_micros((value.cast("double") / 1000).cast("bigint"))
    return value.cast("timestamp")


def as_boolean(df: DataFrame, name: str) -> Column:
    word = F.lower(F.col(name).cast("string"))
    return F.when(word.isin(*TRUE_WORDS), True).when(word.isin(*FALSE_WORDS), False)


def _losses(df: DataFrame, name: str, converted: Column) -> dict:
    """Rows, absent values, values that fail to convert, and whether all fail: one pass."""
    absent = missing(df, name)
    row = df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(absent).alias("absent"),
        F.count_if(~absent & converted.isNull()).alias("failed"),
    ).first()
    return row.asDict()


def convert(data: Data, name: str, target: str) -> Outcome:
    """Convert one column to int, float, datetime, category, str or bool.

    With splits, the training part decides whether the conversion is offered at all.
    """
    if target == "str":
        changed = apply_to(data, lambda df: df.withColumn(name, F.col(name).cast("string")))
        return Outcome("success", f"{name} converted to str", changed)
    if target == "category":
        return _to_category(data, name)
    if target == "bool":
        return _to_boolean(data, name)
    if target == "int":
        return _to_integer(data, name)
    if target in ("float", "datetime"):
        return _coerce(data, name, target)
    return Outcome("error", f"unsupported target type: {target}", data)


def _frames(data: Data) -> list[tuple[str, DataFrame]]:
    return data.items() if isinstance(data, Splits) else [("All", data)]


def _to_integer(data: Data, name: str) -> Outcome:
    for label, df in _frames(data):
        seen = _losses(df, name, as_number(df, name))
        if seen["rows"] and seen["failed"] and seen["failed"] + seen["absent"] == seen["rows"]:
            return Outcome("error", f"{label}: no value of {name} is numeric", data, seen)
        if seen["failed"] or seen["absent"]:
            reason = f"{seen['failed']} values are not numeric and {seen['absent']} are missing"
            return Outcome("warning", f"{label}: {name} cannot become int, {reason}", data, seen)
    changed = apply_to(data, lambda df: df.withColumn(name, _whole(df, name)))
    return Outcome("success", f"{name} converted to int", changed)


def _whole(df: DataFrame, name: str) -> Column:
    """Fractions are cut off; integers are taken as they are, without a detour through double."""
    value = F.col(name)
    if isinstance(df.schema[name].dataType, T.IntegralType):
        return value.cast("bigint")
    if _is_text(df, name):
        exact = F.when(value.rlike(r"^\s*[+-]?\d+\s*$"), F.trim(value).try_cast("bigint"))
        return F.coalesce(exact, as_number(df, name).cast("bigint"))
    return as_number(df, name).cast("bigint")


def _coerce(data: Data, name: str, target: str) -> Outcome:
    change = as_number if target == "float" else as_datetime
    failed = []
    for label, df in _frames(data):
        seen = _losses(df, name, change(df, name))
        if not failed and seen["failed"] and seen["failed"] + seen["absent"] == seen["rows"]:
            return Outcome("error", f"no value of {name} converts to {target}", data, seen)
        failed.append(seen["failed"])
    changed = apply_to(data, lambda df: df.withColumn(name, change(df, name)))
    details = {"failed": sum(failed)}
    if sum(failed):
        return Outcome("warning", f"{sum(failed)} values of {name} did not convert to {target}", changed, details)
    return Outcome("success", f"{name} converted to {target}", changed, details)


def _to_category(data: Data, name: str) -> Outcome:
    df = training(data)
    seen = df.agg(F.count(F.lit(1)).alias("rows"), F.count_distinct(name).alias("values")).first()
    high = seen["rows"] > CATEGORY_ROWS and (
        seen["values"] / seen["rows"] > CATEGORY_SHARE or seen["values"] > CATEGORY_VALUES
    )
    if high:
        return Outcome("info", f"{name} has {seen['values']} values in {seen['rows']} rows", data, seen.asDict())
    marked = F.col(name).cast("string").alias(name, metadata={CATEGORY: True})
    changed = apply_to(data, lambda part: part.withColumn(name, marked))
    return Outcome("success", f"{name} converted to category", changed, seen.asDict())


def _to_boolean(data: Data, name: str) -> Outcome:
    if isinstance(training(data).schema[name].dataType, T.BooleanType):
        return Outcome("success", f"{name} is already bool", data)
    examples: list[str] = []
    for _, df in _frames(data):
        bad = df.filter(~missing(df, name) & as_boolean(df, name).isNull())
        examples += [r[0] for r in bad.select(F.col(name).cast("string")).distinct().limit(3).collect()]
    if examples:
        return Outcome("error", f"{name} has values that are neither true nor false: {examples[:3]}", data)
    changed = apply_to(data, lambda df: df.withColumn(name, as_boolean(df, name)))
    return Outcome("success", f"{name} converted to bool", changed)


