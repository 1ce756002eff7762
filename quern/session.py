"""A session with the settings the operators are written for."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    # Re-plan at run time: merge small partitions, split skewed ones, broadcast what proves small.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cores: int | str = "*", partitions: int = 8, **extra: str) -> SparkSession:
    builder = SparkSession.builder.master(f"local[{cores}]").appName("quern")
    settings = SETTINGS | {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.ui.enabled": "false",
        "spark.driver.memory": "8g",
    }
    for key, value in (settings | extra).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
