import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from quern.operators.quantiles import exact_quantiles, halves, linear, midpoint, order_values

SHARES = [0.0, 0.01, 0.25, 1 / 3, 0.5, 0.75, 0.99, 1.0]


@pytest.mark.parametrize(
    "name", ["uniform", "heavy_tail", "hot_value", "few_values", "negative", "one", "wide"]
)
@pytest.mark.parametrize("fetched", [200_000, 64, 1])
def test_quantiles_equal_the_sorted_column(spark, name, fetched):
    random = np.random.default_rng(5)
    data = {
        "uniform": random.uniform(-5, 5, 4001),
        "heavy_tail": np.exp(random.normal(0, 12, 3000)),
        "hot_value": np.concatenate([np.full(3000, 2.5), random.uniform(2, 3, 1000)]),
        "few_values": random.integers(0, 3, 1000).astype(float),
        "negative": -np.exp(random.normal(0, 3, 1001)),
        "one": np.array([4.25]),
        "wide": np.array([-1e308, -1.0, 0.0, 1e-300, 1.0, 1e308] * 50),
    }[name]
    df = spark.createDataFrame(pd.DataFrame({"x": data}))
    wanted = {"x": (F.col("x"), linear(*SHARES))}
    got = order_values(df, wanted, fetched)["x"]
    assert np.allclose(got, np.sort(data)[[0]].tolist() + list(np.quantile(data, SHARES[1:])), rtol=1e-12, atol=0)


def test_absent_values_do_not_count(spark):
    df = spark.createDataFrame([(1.0, None), (None, None), (float("nan"), None), (3.0, None)], "x double, y double")
    assert exact_quantiles(df, ["x", "y"], [0.5]) == {"x": [2.0], "y": [None]}


def test_quartiles_by_halves():
    at = lambda positions, n: positions(n)
    assert at(halves(False), 5) == [0.5, 2.0, 3.5]
    assert at(halves(True), 5) == [1.0, 2.0, 3.0]
    assert at(halves(False), 4) == at(halves(True), 4) == [0.5, 1.5, 2.5]
    assert at(midpoint(0.25, 0.5), 10) == [2.0, 4.5]
    assert at(midpoint(0.25), 1) == [0.0]


@pytest.mark.parametrize(
    "data",
    [[0.0, 1e16, 1e16 + 2], [0.0, 1e18, 1e18 + 256], [float("-inf"), 0.0, float("inf")], [0.0, 5e-324, 1e-323], [-1e16 - 2, -1e16, 1e300]],
)
def test_values_with_one_logarithm(spark, data):
    df = spark.createDataFrame([(x,) for x in data * 100], "x double")
    got = order_values(df, {"x": (F.col("x"), lambda n: [0.0, 50.0, 150.0, 250.0, 299.0])}, fetched=64)["x"]
    assert got == [data[0], data[0], data[1], data[2], data[2]]
