import math

import numpy as np
import pytest
from helpers import values
from pyspark.sql import functions as F

from quern.frames import Splits
from quern.operators import outliers, split


def parts_are_exact(df, parts, sizes):
    assert {label: part.count() for label, part in parts.items()} == sizes
    union = parts.labelled().drop("Set")
    assert union.exceptAll(df).isEmpty() and df.exceptAll(union).isEmpty()


def test_two_and_three_parts(frame):
    parts_are_exact(frame, split.train_test_split(frame, 0.203), {"Train": 159, "Test": 41})
    three = split.train_test_val_split(frame, 0.2, 0.1)
    parts_are_exact(frame, three, {"Train": 140, "Validation": 20, "Test": 40})


def test_seed_decides(frame):
    ids = lambda seed: values(split.train_test_split(frame, 0.2, seed).test, "id")
    assert ids(1) == ids(1) != ids(2)


def test_parts_are_filters_on_the_input(spark):
    parts = split.train_test_val_split(spark.range(1000), 0.2, 0.1)
    for _, part in parts.items():
        assert "Exchange" not in part._jdf.queryExecution().executedPlan().toString()


def test_copies_are_dealt_out_exactly(spark):
    df = spark.range(1000).select(F.when(F.col("id") < 900, F.lit(0)).otherwise(F.col("id")).alias("a"))
    parts_are_exact(df, split.train_test_val_split(df, 0.3, 0.3), {"Train": 400, "Validation": 300, "Test": 300})
    same = spark.range(10).select(F.lit(1).alias("a"))
    parts_are_exact(same, split.train_test_val_split(same, 0.3, 0.3), {"Train": 4, "Validation": 3, "Test": 3})


def test_stratified_shares(spark):
    df = spark.range(1003).select("id", F.when(F.col("id") % 10 < 7, "a").when(F.col("id") % 10 < 9, "b").alias("k"))
    parts = split.train_test_val_split(df, 0.2, 0.1, stratify_col="k")
    parts_are_exact(df, parts, {"Train": 701, "Validation": 101, "Test": 201})
    for label, part in parts.items():
        whole = part.count()
        for name, count in part.groupBy("k").count().collect():
            share = {"a": 0.7, "b": 0.2, None: 0.1}[name]
            assert abs(count - share * whole) <= 1.5, (label, name, count)


def test_stratified_copies(spark):
    df = spark.range(600).select((F.col("id") % 3).cast("string").alias("k"))
    parts = split.train_test_val_split(df, 0.2, 0.2, stratify_col="k")
    parts_are_exact(df, parts, {"Train": 360, "Validation": 120, "Test": 120})
    assert values(parts.test.groupBy("k").count()) == [("0", 40), ("1", 40), ("2", 40)]


def test_many_valued_numbers_are_binned(spark, frame):
    df = spark.range(1000).select("id", (F.col("id") * 1.5).alias("x"))
    parts = split.train_test_split(df, 0.2, stratify_col="x")
    tenths = parts.test.groupBy(F.floor(F.col("id") / 100)).count()
    assert [r[1] for r in tenths.collect()] == [20] * 10


def test_bins_are_closed_on_the_right(spark):
    df = spark.range(1, 10).select(F.col("id").cast("double").alias("x"))
    got = values(df.select("x", split.quantile_bin(df, "x", 2).alias("b")))
    assert got == [(float(i), 0 if i <= 5 else 1) for i in range(1, 10)]
    constant = df.select(F.lit(1.0).alias("x"))
    assert constant.select(split.quantile_bin(constant, "x", 4)).first()[0] is None


def test_refusals(spark, frame):
    for test, validation in ((0, 0.1), (1.0, 0.1), (0.2, 0), (0.6, 0.4)):
        with pytest.raises(ValueError):
            split.train_test_val_split(frame, test, validation)
    with pytest.raises(ValueError, match="least frequent"):
        split.train_test_split(frame, 0.2, stratify_col="cat_hi")
    with pytest.raises(ValueError):
        split.train_test_split(frame, 0.2, shuffle=False, stratify_col="cat_lo")
    with pytest.raises(ValueError, match="too few"):
        split.train_test_split(spark.range(1), 0.5)


def test_in_order_the_end_is_the_test_part(spark):
    parts = split.train_test_val_split(spark.range(10), 0.2, 0.2, shuffle=False, order_by=["id"])
    assert values(parts.test) == [(8,), (9,)]
    assert values(parts.validation) == [(6,), (7,)]


def test_bounds_come_from_the_training_part(spark):
    train = spark.range(1, 101).select(F.col("id").cast("double").alias("x"))
    test = spark.createDataFrame([(0.0,), (50.0,), (500.0,), (None,)], "x double")
    kept = outliers.remove_iqr(Splits(train, test), "x")
    assert kept.train.count() == 100 and values(kept.test) == [(0.0,), (50.0,)]
    kept = outliers.remove_percentage(Splits(train, test), "x", 0.1, 0.2)
    assert kept.train.agg(F.min("x"), F.max("x")).first() == (11.0, 80.0)
    with pytest.raises(ValueError):
        outliers.remove_percentage(train, "x", 0.6, 0.1)


def test_forest_removes_the_contaminated_share(spark):
    random = np.random.default_rng(3)
    data = np.concatenate([random.normal(0, 1, 1900), random.uniform(20, 60, 100)])
    df = spark.createDataFrame([(float(v),) for v in data], "x double")
    kept = outliers.remove_isolated(df, "x")
    gone = df.exceptAll(kept)
    assert abs(gone.count() - 100) <= 5
    assert gone.filter("x > 15").count() >= 85
    assert kept.count() == outliers.remove_isolated(df, "x").count()


def test_forest_scores_match_a_walk_down_the_trees(spark):
    """The step function equals the mean path length computed value by value."""
    values_ = np.random.default_rng(1).normal(size=200)
    random = np.random.default_rng(outliers.SEED)
    pool = np.sort(values_)
    limit = math.ceil(math.log2(200))
    trees = [outliers._tree(random.choice(pool, 200, replace=False), random, limit) for _ in range(10)]
    df = spark.createDataFrame([(float(v),) for v in values_], "x double").coalesce(1)
    forest = outliers.fit_forest(df, "x", trees=10, tree_rows=256)
    for x in (-5.0, -0.3, 0.0, 0.7, 9.0):
        depth = np.mean([lengths[int((cuts < x).sum())] for cuts, lengths in trees])
        expected = -(2 ** (-depth / float(outliers._average_path(200))))
        assert forest.scores[np.searchsorted(forest.edges, x)] == pytest.approx(expected)


def test_many_ranges_and_few_agree(spark, monkeypatch):
    df = spark.range(1000).select((F.col("id") / 10).alias("x"))
    ranges = [(i + 0.2, i + 0.7) for i in range(100)] + [(99.8, None)]
    plain = df.filter(outliers._in_ranges(F.col("x"), ranges)).count()
    monkeypatch.setattr(outliers, "_PLAIN_RANGES", 1)
    assert df.filter(outliers._in_ranges(F.col("x"), ranges)).count() == plain == 501


def test_forest_does_not_depend_on_partitions(spark):
    df = spark.range(40_000).selectExpr("CASE WHEN id % 3 = 0 THEN 5.0 ELSE (id * 7919 % 10007) / 7.0 END AS x")
    first, second = (outliers.fit_forest(df.repartition(n), "x", trees=5, tree_rows=64) for n in (2, 7))
    assert first.edges.tolist() == second.edges.tolist() and first.scores.tolist() == second.scores.tolist()
