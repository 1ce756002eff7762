"""Monthly price index by country and product group."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.functions.dates import month_start
from quern.operators.columns import keep


def extract_prices(raw: DataFrame) -> DataFrame:
    """Group, country and value, with the month as a point in time."""
    chosen = keep(raw, ["coicop", "geo", "TIME_PERIOD", "OBS_VALUE"])
    return chosen.withColumn("date", month_start(F.col("TIME_PERIOD"))).drop("TIME_PERIOD")
