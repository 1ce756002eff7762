"""Tables of a relational database. The driver jar must be on the class path."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Database:
    url: str
    user: str | None = None
    password: str | None = field(default=None, repr=False)
    driver: str | None = None

    def options(self) -> dict[str, str]:
        known = {"url": self.url, "user": self.user, "password": self.password, "driver": self.driver}
        return {key: value for key, value in known.items() if value is not None}

    def fetch(self, spark: SparkSession, query: str, fetch_size: int = 10_000) -> DataFrame:
        return spark.read.format("jdbc").options(**self.options(), query=query, fetchsize=str(fetch_size)).load()

    def fetch_table(
        self, spark: SparkSession, table: str, column: str, low: int, high: int, partitions: int
    ) -> DataFrame:
        """Parallel read: each task fetches one range of a numeric column."""
        bounds = {"partitionColumn": column, "lowerBound": low, "upperBound": high, "numPartitions": partitions}
        return spark.read.format("jdbc").options(**self.options(), dbtable=table, **bounds).load()

    def insert(self, df: DataFrame, table: str, truncate: bool = False, batch: int = 1000) -> None:
        """Append, or empty the table first and keep its definition."""
        self.writer(df, table, truncate, batch).save()

    def writer(self, df: DataFrame, table: str, truncate: bool, batch: int):
        return (
            df.write.format("jdbc")
            .options(**self.options(), dbtable=table, batchsize=str(batch), truncate=str(truncate).lower())
            .mode("overwrite" if truncate else "append")
        )
