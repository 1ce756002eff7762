import datetime as dt

from helpers import values
from pyspark.sql import functions as F

from quern.operators import ordering


def test_latest_takes_the_newest_and_drops_null_keys(spark):
    rows = [(1, 1, "a"), (1, 3, "b"), (1, None, "c"), (2, 5, "d"), (None, 9, "e")]
    df = spark.createDataFrame(rows, "k int, at int, x string")
    assert values(ordering.latest_per_key(df, ["k"], "at")) == [(1, 3, "b"), (2, 5, "d")]


def test_latest_decides_ties_by_the_given_order(spark):
    df = spark.createDataFrame([(1, 3, "a"), (1, 3, "b")], "k int, at int, x string")
    assert ordering.latest_per_key(df, ["k"], "at", [("x", "desc")]).first()["x"] == "b"


def test_latest_keeps_one_row_per_key_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), "id")
    plan = ordering.latest_per_key(df, ["k"], "id")._jdf.queryExecution().executedPlan().toString()
    partial, exchange = plan.index("Partial"), plan.index("Exchange")
    assert "WindowGroupLimit" in plan and exchange < partial  # printed top down


def test_end_date_both_ways(spark):
    day = dt.date(2024, 1, 1)
    rows = [("a", day, 1), ("a", day + dt.timedelta(5), 2), ("a", day + dt.timedelta(5), 3), ("b", day, 4)]
    df = spark.createDataFrame(rows, "k string, start date, id int")
    expected = [
        ("a", day, 1, day + dt.timedelta(4)),
        ("a", day + dt.timedelta(5), 2, day + dt.timedelta(4)),
        ("a", day + dt.timedelta(5), 3, None),
        ("b", day, 4, None),
    ]
    for largest in (100, 1):
        got = ordering.end_date(df, ["k"], "start", "stop", ["id"], largest)
        assert values(got) == sorted(expected, key=str)


def test_index_is_a_dense_permutation_along_the_order(spark):
    df = spark.range(5000).select((F.col("id") * 7919 % 5003).alias("a"), (F.col("id") % 7).alias("b"))
    rows = sorted(ordering.global_index(df, ["b", ("a", "desc")], "n").collect(), key=lambda r: r["n"])
    assert [r["n"] for r in rows] == list(range(1, 5001))
    assert [(r["b"], -r["a"]) for r in rows] == sorted((r["b"], -r["a"]) for r in rows)


def test_index_with_null_keys_and_a_start(spark):
    df = spark.createDataFrame([(3,), (None,), (1,)], "a int")
    assert values(ordering.global_index(df, ["a"], "n", start=0)) == sorted([(None, 0), (1, 1), (3, 2)], key=str)


def test_index_of_an_empty_table(spark):
    assert ordering.global_index(spark.range(0), ["id"], "n").count() == 0


def test_index_spreads_copies_of_one_row_over_ranges(spark):
    """Two thirds of the rows are copies of one: no single range may hold them all."""
    df = spark.range(0, 30_000, 1, 8).select(F.when(F.col("id") % 3 == 0, F.col("id")).otherwise(F.lit(-1)).alias("a"))
    numbered = ordering.global_index(df, ["a"], "n", partitions=8)
    assert numbered.agg(F.count_distinct("n"), F.max("n")).first() == (30_000, 30_000)
    largest = numbered.groupBy(F.input_file_name()).count().agg(F.max("count")).first()[0]
    assert largest < 12_000


def test_no_operator_sorts_everything_in_one_task(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), "id")
    for result in (
        ordering.global_index(df, ["k", "id"], "n"),
        ordering.end_date(df.withColumn("d", F.current_date()), ["k"], "d", "e"),
        ordering.latest_per_key(df, ["k"], "id"),
    ):
        assert "SinglePartition" not in result._jdf.queryExecution().executedPlan().toString()


def test_lookup_keeps_unmatched_facts(spark):
    facts = spark.createDataFrame([("A ",), ("b",), (None,)], "code string")
    dimension = spark.createDataFrame([("a", 1)], "nat string, dim_key int")
    assert values(ordering.lookup_keys(facts, dimension, "code", "nat", "dim_key", ignore_case=True)) == sorted(
        [("A ", 1), ("b", None), (None, None)], key=str
    )
    assert ordering.lookup_keys(facts, dimension, "code", "nat", "dim_key").filter("dim_key is not null").count() == 0


def test_numbering_computes_its_input_once_and_leaves_one_copy(spark):
    import os

    from quern import staging

    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(len(batch))
            yield batch

    df = spark.range(3000, numPartitions=3).mapInPandas(count, "id long")
    before = set(os.listdir(staging.shared_folder(spark)))
    numbered = ordering.global_index(df, ["id"], partitions=5)
    assert seen.value == 3000
    assert [r.idx for r in numbered.orderBy("id").limit(3).collect()] == [1, 2, 3]
    assert len(set(os.listdir(staging.shared_folder(spark))) - before) == 1
