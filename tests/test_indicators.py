import random

import pytest
from pyspark.sql import functions as F

from quern.frames import Splits
from quern.operators import encode, indicators, reduce


@pytest.fixture(scope="module")
def rows(spark):
    draw = random.Random(3)
    made = [
        (i, draw.choice(["a", "b", "c", None]), draw.choice(["x", "y z", "", "nan"]), draw.choice([0, 1, 1, None]), float(i % 7))
        for i in range(400)
    ]
    return spark.createDataFrame(made, "id long, p string, q string, y int, v double")


def test_scores_are_those_of_columns(rows):
    """The statistics from counts are those from a column of zeros and ones for each category, nulls included."""
    expected = reduce.f_statistics(rows.drop("id", "v"), "y")
    found = indicators.indicator_scores(rows, ["p", "q"], "y").collect()
    assert {f"{'pq'[r.place]}_{r.category}": r.f for r in found} == pytest.approx(expected)


def test_undefined_and_infinite_scores(spark):
    df = spark.createDataFrame([("a", "k", 0), ("b", "k", 1), ("a", "k", 0), ("b", "k", 1)], "p string, one string, y int")
    assert [tuple(r) for r in indicators.indicator_scores(df, ["p", "one"], "y").collect()] == [(0, "b", float("inf"))]
    assert [r.f for r in indicators.indicator_scores(df.filter("y = 1 or p = 'a'").withColumn("y", F.lit(1)), ["p"], "y").collect()] == [None]
    assert indicators.indicator_scores(df.limit(0), ["p"], "y").count() == 0


def test_sparse_rows_are_the_columns(rows):
    """A position is in a row where the column of its category has a one; unknown categories have none."""
    splits = Splits(train=rows.filter("id < 300 and coalesce(p, '') <> 'c'"), test=rows.filter("id >= 300"))
    wide = encode.one_hot_encode(splits, ["p", "q"])
    sparse, known = indicators.sparse_one_hot(splits, ["p", "q"])
    names = {r.position: f"{'pq'[r.place]}_{r.category}" for r in known.collect()}
    assert sorted(names) == list(range(len(names)))
    for dense, short in zip((wide.train, wide.test), (sparse.train, sparse.test)):
        expected = {r.id: sorted(n for n in names.values() if r[n] == 1.0) for r in dense.collect()}
        assert short.columns == ["id", "y", "v", "indicators"]
        assert {r.id: sorted(names[e.position] for e in r.indicators) for r in short.collect()} == expected


def test_many_categories_stay_off_the_driver(spark):
    """Only the winners are in the plan."""
    df = spark.range(3000).selectExpr("concat('k', id) AS key", "if(id < 4, 'odd', 'plain') AS kind", "int(id < 4) AS y")
    best = reduce.select_best(df, "y", 2)
    assert best.columns == ["key_k1", "kind_plain", "y"]
    assert "k2999" not in best._jdf.queryExecution().toString()
