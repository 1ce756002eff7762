"""Mapping of codes to labels."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Longer lists are looked up in one map instead of compared one after the other; the labels are the same.
_CHAIN_LIMIT = 100


def folded(value: Column) -> Column:
    """Text compared without regard to case and outer blanks."""
    return F.upper(F.trim(value))


def map_codes(value: Column, labels: Mapping, default: Column | str | None = None, fold: bool = True) -> Column:
    """Replace codes by labels; anything not listed, NULL included, becomes ``default``."""
    compared = folded(value) if fold else value
    if len(labels) > _CHAIN_LIMIT:
        known: dict = {}
        for code, label in labels.items():
            known.setdefault(code.strip().upper() if fold and isinstance(code, str) else code, label)
        listed = F.create_map(*[F.lit(x) for pair in known.items() for x in pair])
        other = default if isinstance(default, Column) else F.lit(default)
        return F.when(F.map_contains_key(listed, compared), F.try_element_at(listed, compared)).otherwise(other)
    codes_of: dict = {}
    for code, label in labels.items():
        codes_of.setdefault(label, []).append(code.strip().upper() if fold and isinstance(code, str) else code)
    otherwise = default if isinstance(default, Column) else F.lit(default)
    chain = None
    for label, codes in codes_of.items():
        hit = compared == codes[0] if len(codes) == 1 else compared.isin(codes)
        chain = F.when(hit, F.lit(label)) if chain is None else chain.when(hit, F.lit(label))
    return otherwise if chain is None else chain.otherwise(otherwise)


def map_codes_by_join(
    df: DataFrame, column: str, labels: DataFrame, code: str, label: str, result: str, default: str | None = None
) -> DataFrame:
    """The same for a long code list held in a table with unique ``code``.

    No broadcast is forced: the size found at run time decides how the join is done.
    """
    listed = labels.select(F.col(code).alias("__code"), F.col(label).alias("__label"))
    joined = df.join(listed, F.col(column) == F.col("__code"), "left")
    return joined.withColumn(result, F.coalesce("__label", F.lit(default))).drop("__code", "__label")


def above(value: Column, bound: float, high: str, low: str) -> Column:
    """``high`` when the value exceeds the bound, ``low`` otherwise and for NULL."""
    return F.when(value > bound, F.lit(high)).otherwise(F.lit(low))
