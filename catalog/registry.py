"""Registration of queries and reading of the test tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings",
    "pages", "benchmark", "labels", "conversations",
)


class Tables:
    """The parquet tables of one folder as attributes."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        if name not in TABLES:
            raise AttributeError(name)
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def sql(self, text: str) -> DataFrame:
        """Run a derivation that names tables in braces."""
        named = {name: getattr(self, name) for name in TABLES if "{" + name + "}" in text}
        return self.spark.sql(text, **named)


def query(sql: str | None = None):
    """Register a function of ``Tables`` under its name, with the SQL that gives the same rows."""

    def register(build: Callable[[Tables], DataFrame]):
        name = build.__name__
        QUERIES[name] = lambda spark, folder: build(Tables(spark, folder))
        if sql is not None:
            ORACLES[name] = sql
        return build

    return register


def plain(derivation: str) -> str:
    """A derivation with its tables named as they are registered for the other engine."""
    for name in TABLES:
        derivation = derivation.replace("{" + name + "}", name)
    return derivation


def rounded(column: Column | str, digits: int = 6) -> Column:
    value = F.col(column) if isinstance(column, str) else column
    return F.round(value, digits)


def round_all(df: DataFrame, columns: list[str], digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})
