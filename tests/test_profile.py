"""Histograms of all columns, versions and clusters of stored tables, remembered steps of recipes."""

import datetime as dt
import uuid
from collections import Counter
from decimal import Decimal

import numpy as np
import pytest
from helpers import values
from pyspark.sql import functions as F

from quern.operators import missing, profile, quantiles, summaries
from quern.plans.recipe import Recipe
from quern.sources import clustering, tables

KINDS = (
    "i int, b boolean, day date, at timestamp, f float, d decimal(20,4), t string, raw binary, list array<int>, "
    "parts struct<a:int,b:string>, empty int"
)


def mixed_rows():
    rows = []
    for k in range(60):
        day = dt.date(2024, 1, 1 + k % 5)
        rows.append(
            (
                k % 7 - 3, k % 3 == 0, day, dt.datetime(2024, 1, 1, k % 4), float("nan") if k % 9 == 0 else k % 4 / 2 - 0.0,
                Decimal(k % 6) / 4, "xyz"[k % 3] if k % 5 else None, bytes([k % 2, 255]), [k % 2, 1], (None if k % 2 else 1, "s"), None,
            )
        )
    return rows


def plain_profile(df):
    """count, missing, distinct, freq, least of each column, by counting texts of values."""
    out = {}
    for name in df.columns:
        seen = [r[0] for r in df.select(name).collect()]
        there = Counter(repr(x) for x in seen if x is not None and x == x)
        n = sum(there.values())
        out[name] = (n, len(seen) - n, len(there), max(there.values(), default=None), min(there.values(), default=None))
    return out


def test_profile_equals_counts_of_each_column(spark):
    df = spark.createDataFrame(mixed_rows(), KINDS).repartition(3)
    got = {r[0]: tuple(r)[1:6] for r in profile.profile(df).collect()}
    assert got == plain_profile(df)
    assert dict(summaries.distinct_counts(df).collect()) == {c: x[2] for c, x in plain_profile(df).items()}
    nothing = profile.profile(df.limit(0)).collect()
    assert [r["count"] for r in nothing] == [0] * len(df.columns) and nothing[0].freq is None


def test_modes_are_the_smallest_of_the_most_frequent(spark):
    df = spark.createDataFrame(mixed_rows(), KINDS)
    found = df.limit(1).select(*[mode.alias(c) for c, mode in profile.modes(df, df.columns).items()]).first().asDict()
    for name, value in found.items():
        seen = Counter(r[0] for r in df.select(name).collect() if r[0] is not None and r[0] == r[0]) if name not in ("list", "parts", "raw") else None
        if seen:
            best = max(seen.values())
            assert value == min(x for x, n in seen.items() if n == best), name
    assert "empty" not in found
    filled = missing.fill_mode(df, ["t", "f", "empty"])
    assert filled.filter("t is null or isnan(f)").isEmpty() and filled.dtypes == df.dtypes


def test_one_scan_for_any_number_of_columns(spark):
    df = spark.range(50).select(*[(F.col("id") % k).alias(f"c{k}") for k in range(1, 9)])
    plan = summaries.distinct_counts(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Range (0, 50") == 1


def jobs_of(spark, work):
    """The result of a piece of work and the number of jobs it ran."""
    group, context = uuid.uuid4().hex, spark.sparkContext
    context.setJobGroup(group, "counted")
    try:
        return work(), len(context.statusTracker().getJobIdsForGroup(group))
    finally:
        context.setJobGroup(uuid.uuid4().hex, "others")


@pytest.mark.parametrize("columns", [1, 12])
def test_quantiles_take_two_scans(spark, columns):
    random = np.random.default_rng(1)
    data = random.normal(size=(20_000, columns))
    df = spark.createDataFrame([tuple(map(float, r)) for r in data], ", ".join(f"c{i} double" for i in range(columns))).coalesce(2)
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    scanned = df.mapInArrow(counted, df.schema)
    got = quantiles.exact_quantiles(scanned, df.columns, [0.0, 0.25, 0.5, 0.9, 1.0])
    assert seen.value == 2 * len(data)
    for i, c in enumerate(df.columns):
        assert np.allclose(got[c], np.quantile(data[:, i], [0.0, 0.25, 0.5, 0.9, 1.0]), rtol=1e-12)


def test_a_failed_load_leaves_the_version_before(spark, tmp_path):
    store = tables.Store(str(tmp_path))
    with pytest.raises(LookupError):
        store.read(spark, "silver", "t")
    store.refresh(spark.range(5), "silver", "t", unique=("id",))
    before = store.read(spark, "silver", "t")
    bad = [
        spark.range(5).select((F.col("id") % 4).alias("id")),
        spark.range(5).select(F.when(F.col("id") > 2, F.raise_error(F.lit("x"))).otherwise(F.col("id")).cast("bigint").alias("id")),
        spark.range(3).select(F.when(F.col("id") > 0, F.col("id")).alias("id")),
    ]
    for load in bad:
        with pytest.raises(Exception):
            store.refresh(load, "silver", "t", unique=("id",))
        assert store.versions(spark, "silver", "t") == [1]
        assert [p.name for p in (tmp_path / "silver" / "t").iterdir() if not p.name.startswith(".")] == ["v00000001"]
    store.refresh(spark.range(7), "silver", "t")
    assert before.count() == 5 and store.read(spark, "silver", "t").count() == 7
    store.refresh(spark.range(8), "silver", "t")
    assert store.versions(spark, "silver", "t") == [2, 3]


def test_clusters_of_two_keys(spark, tmp_path):
    store = tables.Store(str(tmp_path))
    df = spark.range(4000).select(
        (F.col("id") * 7919 % 4001).alias("a"), F.concat(F.lit("k"), F.lpad((F.col("id") * 31 % 997).cast("string"), 4, "0")).alias("b"),
        F.when(F.col("id") % 50 != 0, F.col("id")).alias("c"),
    )
    store.refresh(df, "silver", "t", cluster_by=("a", "b"), files=16)
    assert values(store.read(spark, "silver", "t")) == values(df)
    ranges = store.file_ranges(spark, "silver", "t", ("a", "b")).collect()
    assert 12 <= len(ranges) <= 16 and sum(r.rows for r in ranges) == 4000
    for needed in (sum(r.a_min <= 200 for r in ranges), sum(r.b_max >= "k0950" for r in ranges)):
        assert needed <= len(ranges) / 2
    one = clustering.clustered(df, ("c",), files=4).select(F.spark_partition_id().alias("p"), "c")
    spans = one.groupBy("p").agg(F.min("c").alias("low"), F.max("c").alias("high")).orderBy("p").collect()
    assert all(x.high <= y.low for x, y in zip(spans, spans[1:], strict=False))


def test_steps_are_fitted_once(spark):
    df = spark.range(300).select("id", F.when(F.col("id") % 5 != 0, F.col("id") * 1.5).alias("x"), (F.col("id") % 3).cast("string").alias("c"))
    work = Recipe(df)
    work.add("missing_values", {"fill_strategy": "Fill with Median", "cols_with_na": ["x"]})
    work.add("remove_duplicates", {"keep_first": True})
    work.add("remove_outliers", {"selected_outlier_column": "x", "outlier_removal_method": "IQR"})
    work.add("scale_columns", {"scaling_method": "Robust Scaler"})
    again, jobs = jobs_of(spark, work.replay)
    assert jobs == 0 and values(again) == values(work.current)
    _, all_jobs = jobs_of(spark, lambda: Recipe(df, work.steps))
    changed, jobs = jobs_of(spark, lambda: work.change(3, {"scaling_method": "MinMaxScaler (0-1 range)"}))
    assert 0 < jobs < all_jobs
    assert values(changed) == values(Recipe(df, work.steps).current)
    work.change(1, None)
    assert [s["op_type"] for s in work.steps] == ["missing_values", "remove_outliers", "scale_columns"]
    other = df.filter("id < 100")
    assert values(work.replay(other)) == values(Recipe(other, work.steps).current)
    work.forget()
    assert jobs_of(spark, work.replay)[1] > 0
