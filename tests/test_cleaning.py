import pytest
from helpers import values
from pyspark.sql import functions as F

from quern.frames import Splits
from quern.operators import columns, duplicates, missing, types


@pytest.fixture(scope="module")
def gaps(spark):
    rows = [(1, 2.0, "a"), (2, None, "b"), (3, float("nan"), None), (4, 4.0, "b"), (None, 6.0, "a")]
    return spark.createDataFrame(rows, "i int, x double, s string")


def test_missing_report_reads_nan_as_missing(gaps):
    assert values(missing.missing_report(gaps)) == [
        ("i", 1, 20.0, "High"), ("s", 1, 20.0, "High"), ("x", 2, 40.0, "High"),
    ]


def test_drops(gaps):
    assert values(missing.drop_rows(gaps), "i") == [(1,), (4,)]
    assert missing.drop_columns_with_missing(gaps.select("i", F.lit(1).alias("k"))).columns == ["k"]


def test_fills(gaps):
    assert values(missing.fill_mean(gaps, ["x", "i", "s"]), "x") == [(2.0,), (4.0,), (4.0,), (4.0,), (6.0,)]
    assert values(missing.fill_mean(gaps, ["i"]), "i") == [(1.0,), (2.0,), (2.5,), (3.0,), (4.0,)]
    assert values(missing.fill_median(gaps, ["x"]), "x") == [(2.0,), (4.0,), (4.0,), (4.0,), (6.0,)]
    # Equal counts: the smallest value.
    assert values(missing.fill_mode(gaps, ["s"]), "s") == [("a",), ("a",), ("a",), ("b",), ("b",)]


def test_custom_value_turns_a_column_to_text_only_if_it_must(gaps):
    as_number = missing.fill_custom(gaps, "9")
    assert dict(as_number.dtypes) == {"i": "int", "x": "double", "s": "string"}
    as_text = missing.fill_custom(gaps, "none")
    assert dict(as_text.dtypes) == {"i": "string", "x": "string", "s": "string"}
    assert values(as_text, "i") == [("1",), ("2",), ("3",), ("4",), ("none",)]


def test_all_missing_column_keeps_its_gaps(spark):
    df = spark.createDataFrame([(None,), (None,)], "x double")
    for fill in (missing.fill_mean, missing.fill_median, missing.fill_mode):
        assert fill(df, ["x"]).filter("x is null").count() == 2


def test_duplicates(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, 1.0), (3, 2.0), (3, 2.0), (3, 2.0)], "a int, b double")
    assert values(duplicates.drop_duplicates(df)) == sorted([(1, None), (2, 1.0), (3, 2.0)], key=str)
    assert values(duplicates.drop_all_duplicated(df)) == [(2, 1.0)]
    assert tuple(duplicates.duplicate_counts(df).first()) == (5, 3)
    assert duplicates.list_duplicates(df).count() == 5
    assert values(duplicates.list_duplicates(df, keep_first=True)) == sorted([(1, None), (3, 2.0), (3, 2.0)], key=str)


def test_a_large_group_of_copies_is_written_by_several_tasks(spark):
    counted = spark.createDataFrame([("x", 1000), ("y", 3), ("z", 0)], "a string, n bigint")
    rebuilt = duplicates.copies(counted, "n", per_step=50)
    assert values(rebuilt.groupBy("a").count()) == [("x", 1000), ("y", 3)]
    tasks = rebuilt.filter("a = 'x'").groupBy(F.spark_partition_id()).count().count()
    assert tasks > 1


def test_maps_cannot_be_compared(spark):
    with pytest.raises(TypeError):
        duplicates.drop_all_duplicated(spark.sql("select map('a', 1) as m"))


def converted(spark, texts, target):
    df = spark.createDataFrame([(t,) for t in texts], "x string")
    outcome = types.convert(df, "x", target)
    return outcome.status, [r[0] for r in outcome.data.collect()], outcome.data.schema["x"].dataType.simpleString()


def test_to_int_is_all_or_nothing(spark):
    assert converted(spark, ["1", " 2.9 ", "-3.9", "1e2"], "int") == ("success", [1, 2, -3, 100], "bigint")
    assert converted(spark, ["9007199254740993"], "int")[1] == [9007199254740993]
    assert converted(spark, ["1", "x"], "int") == ("warning", ["1", "x"], "string")
    assert converted(spark, ["1", None], "int")[0] == "warning"
    assert converted(spark, ["x", "y"], "int")[0] == "error"


def test_to_float_leaves_gaps_for_other_text(spark):
    assert converted(spark, ["1.5", "1.5d", ".5", "1e3", None], "float") == (
        "warning", [1.5, None, 0.5, 1000.0, None], "double",
    )
    assert converted(spark, ["a"], "float")[0] == "error"
    assert converted(spark, ["1", "2"], "float")[0] == "success"


def test_to_datetime(spark):
    status, got, kind = converted(spark, ["2024-05-06", "2024-05-06 07:08:09", "5th"], "datetime")
    assert (status, kind) == ("warning", "timestamp")
    assert [str(v) for v in got] == ["2024-05-06 00:00:00", "2024-05-06 07:08:09", "None"]


def test_to_bool_is_all_or_nothing(spark):
    assert converted(spark, ["Yes", "no", "T", "0", None, "Approved"], "bool") == (
        "success", [True, False, True, False, None, True], "boolean",
    )
    status, got, _ = converted(spark, ["yes", "maybe"], "bool")
    assert (status, got) == ("error", ["yes", "maybe"])


def test_to_category_refuses_many_values(spark, frame):
    assert types.convert(frame, "cat_hi", "category").status == "info"
    done = types.convert(frame, "cat_lo", "category")
    assert done.ok and done.data.schema["cat_lo"].metadata == {"category": True}


def test_training_part_decides(spark):
    make = lambda *texts: spark.createDataFrame([(t,) for t in texts], "x string")
    assert types.convert(Splits(make("1"), make("2")), "x", "int").ok
    assert not types.convert(Splits(make("1"), make("b")), "x", "int").ok
    assert types.convert(Splits(make("1"), make("b")), "x", "unknown").status == "error"


def test_columns(spark, frame):
    assert columns.rename_column(frame, "id", "key").columns[0] == "key"
    for bad in ("", "id", "num_a"):
        with pytest.raises(ValueError):
            columns.rename_column(frame, "id", bad)
    assert "id" not in columns.drop_columns(frame, ["id", "nothing"]).columns
    assert columns.exclude_values(frame, "id", (1, 2)).count() == 198
    row = columns.shape_report(frame, frame.limit(3).drop("id")).first()
    assert tuple(row) == ("All", 3, 8, -197, -1)
