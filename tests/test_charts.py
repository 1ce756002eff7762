import numpy as np
import pandas as pd
import pytest
from helpers import values
from pyspark.sql import functions as F

from quern.frames import Splits, dtypes_report
from quern.operators import charts, summaries


@pytest.fixture(scope="module")
def parts(spark):
    random = np.random.default_rng(9)
    frame = pd.DataFrame({"x": random.gamma(2, 2, 900), "y": random.normal(size=900), "k": ["a", "b", "c"] * 300})
    df = spark.createDataFrame(frame).coalesce(2).cache()
    return frame, df


def density(x, points):
    reach = x.std(ddof=1) * len(x) ** -0.2
    grid = x.min() + (x.max() - x.min()) / points * np.arange(points)
    return grid, np.exp(-0.5 * ((grid[:, None] - x[None, :]) / reach) ** 2).sum(1) / (len(x) * reach * (2 * np.pi) ** 0.5)


@pytest.mark.parametrize("bins", [16_384, 256])
def test_curve_equals_the_sum_over_all_values(parts, bins):
    frame, df = parts
    got = sorted(charts.kde(df, "x", 50, bins).collect())
    grid, expected = density(frame.x.to_numpy(), 50)
    assert np.allclose([r["x"] for r in got], grid)
    assert np.allclose([r["density"] for r in got], expected, rtol=0, atol=1e-6 if bins == 256 else 1e-10)


def test_curve_per_category_has_bins_of_its_own_range(spark):
    x = np.random.default_rng(1).normal(size=300)
    frame = pd.concat([pd.DataFrame({"k": "near", "x": x}), pd.DataFrame({"k": "far", "x": x * 1e6})])
    got = charts.violin(spark.createDataFrame(frame), "k", "x", 20)
    for k, scale in (("near", 1.0), ("far", 1e6)):
        rows = sorted(got.filter(F.col("k") == k).collect(), key=lambda r: r["x"])
        assert np.allclose([r["density"] * scale for r in rows], density(x, 20)[1], atol=1e-8)


def test_constant_column_has_no_curve(spark):
    assert charts.kde(spark.range(5).select(F.lit(1.0).alias("x")), "x").count() == 0


def test_histograms(parts):
    frame, df = parts
    counts, edges = np.histogram(frame.x, 12)
    got = {r["bin"]: r for r in charts.histogram(df, "x", 12, density=True).collect()}
    assert [got[i]["count"] if i in got else 0 for i in range(12)] == counts.tolist()
    assert sum(r["density"] * (r["high"] - r["low"]) for r in got.values()) == pytest.approx(1.0)
    assert got[0]["low"] == pytest.approx(edges[0])
    assert values(charts.category_histogram(df, "k"), "k", "count") == [("a", 300), ("b", 300), ("c", 300)]
    cells = charts.density_heatmap(df, "x", "y", 5)
    expected = np.histogram2d(frame.x, frame.y, 5)[0]
    assert {(r[0], r[1]): r[2] for r in cells.collect()} == {
        (i, j): int(expected[i, j]) for i in range(5) for j in range(5) if expected[i, j]
    }


def test_empty_and_constant_histograms(spark):
    assert charts.histogram(spark.range(0), "id").count() == 0
    assert charts.histogram(spark.range(4).select(F.lit(2).alias("x")), "x").first()["count"] == 4


def test_boxes(spark):
    df = spark.createDataFrame([(float(v),) for v in (1, 2, 3, 4, 5, 6, 7, 100)], "x double")
    row = charts.box_stats(df, "x", "exclusive").first()
    assert (row["q1"], row["median"], row["q3"], row["lower_whisker"], row["upper_whisker"], row["outliers"]) == (
        2.5, 4.5, 6.5, 1.0, 7.0, 1,
    )
    assert values(charts.box_points(df, "x", "outliers", "exclusive"), "x", "suspected") == [(100.0, False)]
    assert values(charts.box_points(df, "x", "suspectedoutliers", "exclusive"), "suspected") == [(True,)]
    assert charts.box_points(df, "x", "all").count() == 8
    assert charts.box_points(df, "x", False).count() == 0


@pytest.mark.parametrize("method", list(charts.QUARTILES))
def test_many_groups_and_few_agree(spark, monkeypatch, method):
    df = spark.range(500).select((F.col("id") % 7).cast("string").alias("k"), (F.col("id") * 31 % 97).alias("x"))
    uneven = df.unionByName(df.limit(1))
    few = {r["k"]: r for r in charts.box_stats(uneven, "x", method, by="k").collect()}
    curves = sorted(charts.violin(uneven, "k", "x", 5).collect())
    monkeypatch.setattr(charts, "GROUPS", 3)
    many = {r["k"]: r for r in charts.box_stats(uneven, "x", method, by="k").collect()}
    assert few.keys() == many.keys()
    for k, row in few.items():
        for name, value in row.asDict().items():
            assert many[k][name] == (value if name == "k" else pytest.approx(value)), (k, name)
    others = sorted(charts.violin(uneven, "k", "x", 5).collect())
    assert np.allclose([r["density"] for r in curves], [r["density"] for r in others])


def test_lines(spark):
    train = spark.createDataFrame([(float(i), 2.0 * i + 1) for i in range(5)], "x double, y double")
    test = spark.createDataFrame([(0.0, 0.0), (1.0, 3.0)], "x double, y double")
    got = {r["Set"]: r for r in charts.trend_line(Splits(train, test), "x", "y").collect()}
    assert (got["Train"]["slope"], got["Train"]["intercept"], got["Train"]["r2"]) == pytest.approx((2, 1, 1))
    assert got["Test"]["slope"] == pytest.approx(3)
    assert charts.scatter(Splits(train, test), "x", "y").count() == 7
    assert charts.rug(train, "x").count() == 5
    assert [r[0] for r in charts.line_series(train, "x", "y").collect()] == [0.0, 1.0, 2.0, 3.0, 4.0]


def test_description(spark, frame):
    got = {r["column"]: r for r in summaries.describe_all(frame.withColumn("at", F.to_timestamp("when"))).collect()}
    numbers = frame.select("num_a").toPandas()["num_a"].describe()
    row = got["num_a"]
    assert [row[c] for c in ("count", "mean", "std", "min", "p25", "p50", "p75", "max")] == pytest.approx(
        numbers.tolist()
    )
    assert (got["cat_lo"]["count"], got["cat_lo"]["unique"], got["cat_lo"]["top"], got["cat_lo"]["freq"]) == (
        200, 4, "a", 50,
    )
    assert got["at"]["std"] is None and got["at"]["max"] == 1706400000.0
    assert values(dtypes_report(frame.select("id", "flag"))) == [("flag", "string"), ("id", "bigint")]


def test_counts(frame):
    counts = dict(summaries.distinct_counts(frame.select("cat_lo", "cat_hi")).collect())
    assert counts == {"cat_lo": 4, "cat_hi": 200}
    rough = dict(summaries.distinct_counts(frame.select("cat_lo"), approximate=True).collect())
    assert rough == {"cat_lo": 4}
    assert summaries.smallest_class(frame, "cat_lo") == 50
