"""Rows equal in every column."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

COPIES_PER_STEP = 100_000


def _grouped(df: DataFrame) -> DataFrame:
    """Distinct rows with their count; copies are combined before the shuffle."""
    for field in df.schema:
        if isinstance(field.dataType, (T.MapType, T.VariantType)):
            raise TypeError(f"column {field.name!r}: rows with a {field.dataType.simpleString()} cannot be compared")
    return df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("__copies"))


def copies(counted: DataFrame, count: str, per_step: int = COPIES_PER_STEP) -> DataFrame:
    """Repeat each row as often as ``count`` says.

    Counts beyond ``per_step`` are first cut into steps that are spread over the cluster, so no task writes
    out a large group alone.
    """
    kept = [c for c in counted.columns if c != count]
    left = F.col(count) - F.col("__step") * per_step
    steps = counted.filter(F.col(count) > 0).withColumn(
        "__step", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col(count) - 1) / per_step)))
    )
    spread = steps.withColumn("__size", F.least(left, F.lit(per_step)).cast("int"))
    parts = int(counted.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = spread.repartition(parts, F.xxhash64(*kept), "__step")
    return spread.withColumn("__copy", F.explode(F.array_repeat(F.lit(1), F.col("__size")))).select(*kept)


def drop_duplicates(df: DataFrame) -> DataFrame:
    """Keep one of each set of copies."""
    return df.dropDuplicates()


def drop_all_duplicated(df: DataFrame) -> DataFrame:
    """Keep only rows that occur once."""
    return _grouped(df).filter("__copies = 1").drop("__copies")


def duplicate_counts(df: DataFrame) -> DataFrame:
    """How many rows belong to sets of copies, and how many are left over after keeping one of each."""
    repeated = F.when(F.col("__copies") > 1, F.col("__copies"))
    return _grouped(df).agg(
        F.coalesce(F.sum(repeated), F.lit(0)).alias("all_members"),
        F.coalesce(F.sum(repeated - 1), F.lit(0)).alias("all_but_first"),
    )


def list_duplicates(df: DataFrame, keep_first: bool = False) -> DataFrame:
    """The rows that removing duplicates would delete.

    Copies are indistinguishable, so they are rebuilt from their count instead of being gathered.
    """
    counted = _grouped(df).filter("__copies > 1")
    if keep_first:
        counted = counted.withColumn("__copies", F.col("__copies") - 1)
    return copies(counted, "__copies")
