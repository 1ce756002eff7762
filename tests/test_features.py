import numpy as np
import pandas as pd
import pytest
from helpers import values
from pyspark.sql import functions as F

from catalog import features
from catalog.registry import Tables
from quern.frames import Splits, numeric_columns
from quern.operators import encode, power, reduce, scale


def column(df, name):
    return np.array([r[0] for r in df.select(name).collect()], dtype=float)


@pytest.mark.parametrize("method", list(scale.SCALERS))
def test_scalers(spark, method):
    x = np.array([1.0, 2.0, 4.0, 8.0, 100.0])
    df = spark.createDataFrame(pd.DataFrame({"x": x, "k": 3.0})).coalesce(1)
    got = scale.scale(df, method)
    expected = {
        "StandardScaler (Z-score)": (x - x.mean()) / x.std(),
        "MinMaxScaler (0-1 range)": (x - 1) / 99,
        "Robust Scaler": (x - 4) / 6,
    }[method]
    assert np.allclose(column(got, "x"), expected)
    assert set(column(got, "k")) == {0.0}  # a constant column is only centred


def test_scaling_is_fitted_on_train(spark):
    make = lambda *v: spark.createDataFrame([(float(x),) for x in v], "x double")
    scaled = scale.scale(Splits(make(0, 10), make(20)), "MinMaxScaler (0-1 range)")
    assert column(scaled.test, "x").tolist() == [2.0]


@pytest.fixture(scope="module")
def parts(spark):
    train = spark.createDataFrame([("b", 1.0), ("a", 2.0), ("b", 4.0), (None, 9.0)], "c string, y double")
    test = spark.createDataFrame([("a", 0.0), ("z", 0.0), (None, 0.0)], "c string, y double")
    return Splits(train, test)


@pytest.mark.parametrize("short", [100, 1])
def test_label_and_ordinal(parts, short):
    got = encode.label_encode(parts.train, ["c"], short)
    assert values(got, "c") == [(0,), (1,), (1,), (2,)]
    with pytest.raises(ValueError, match="'z'"):
        encode.label_encode(parts, ["c"], short)
    got = encode.ordinal_encode(parts, ["c"], short=short)
    assert values(got.test, "c") == [(-1.0,), (0.0,), (2.0,)]


def test_one_hot(parts, frame):
    got = encode.one_hot_encode(parts, ["c"])
    assert got.test.columns == ["y", "c_b", "c_nan"]
    assert values(got.test, "c_b", "c_nan") == [(0.0, 0.0), (0.0, 0.0), (0.0, 1.0)]
    with pytest.raises(ValueError):
        encode.one_hot_encode(frame, ["cat_hi"], max_categories=100)


def test_one_hot_of_many_categories(spark):
    """The plan has no list of categories: a filter moved below the columns took a copy of it for each of them."""
    rows = spark.range(300).selectExpr("id", "concat('k', id) AS c")
    got = encode.one_hot_encode(rows, ["c"])
    assert len(got.columns) == 300
    summed = got.select("id", F.aggregate(F.array(*got.columns[1:]), F.lit(0.0), lambda n, x: n + x).alias("one"))
    summed = summed.filter("one > 0")
    assert "k298,k299" not in summed._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(values(summed, "id", "one")) == [(i, 1.0) for i in range(1, 300)]


@pytest.mark.parametrize("width", [1, 2, 100])
def test_one_hot_by_blocks(parts, width):
    """The blocks together have the columns of the whole, in order, with the same values."""
    whole = encode.one_hot_encode(parts, ["c"])
    blocks = list(encode.category_blocks(parts, "c", width))
    assert [len(block) for block in blocks] == {1: [1, 1], 2: [2], 100: [2]}[width]
    frames = [encode.one_hot_encode(parts, ["c"], only={"c": block}) for block in blocks]
    assert ["y", *(c for f in frames for c in f.test.columns[1:])] == whole.test.columns
    for f in frames:
        assert values(f.train) == values(whole.train, *f.train.columns)
        assert values(f.test) == values(whole.test, *f.test.columns)


def test_blocks_of_categories(spark):
    rows = spark.range(25).selectExpr("concat('k', id % 24) AS c").repartition(3)
    listed = sorted(f"k{i}" for i in range(24))[1:]
    assert list(encode.category_blocks(rows, "c", 10)) == [listed[:10], listed[10:20], listed[20:]]
    assert list(encode.category_blocks(rows.filter("c = 'k1'"), "c")) == []
    assert list(encode.category_blocks(rows.filter("c = 'no'"), "c")) == []


def test_one_hot_per_row_holds_a_block(spark, tmp_path, monkeypatch):
    """Neither the width of a plan nor the lists on the driver grow with the number of rows."""
    spark.range(2_500).selectExpr("id as s_suppkey", "concat('Supplier `', 9999 - id) as s_name").write.parquet(
        f"{tmp_path}/supplier.parquet"
    )
    widths, whole = [], encode.one_hot_encode

    def watched(*args, **options):
        made = whole(*args, **options)
        widths.append(len(made.columns))
        return made

    monkeypatch.setattr(encode, "one_hot_encode", watched)
    got = features.encode_one_hot_per_row(Tables(spark, str(tmp_path)))
    kept = [i for i in range(2_500) if i != 2_499]  # its name is the first category
    assert values(got) == sorted(
        ((p, sum(i % 10 == p for i in kept), float(sum(i for i in kept if i % 10 == p))) for p in range(10)), key=str
    )
    assert sum(widths) >= 2_499 and max(widths) <= 1_003


def test_one_hot_names_are_kept(spark):
    """Categories are names of columns as they are, whatever they mean in SQL."""
    odd = ["a", "b`c", "d.e", "f g", "h'i", "${spark.app.name}", "l\nm", "\\n", "n--", "nan"]
    rows = spark.createDataFrame([(i, c) for i, c in enumerate([*odd, None])], "`i.d` long, c string")
    for chosen in (rows, rows.filter("coalesce(c, '') not like '$%'")):
        listed = sorted({r.c or "nan" for r in chosen.collect()})
        got = encode.one_hot_encode(chosen, ["c"])
        assert got.columns == ["i.d", *(f"c_{c}" for c in listed[1:])]
        ones = {r["i.d"]: [c for c, x in r.asDict().items() if c != "i.d" and x] for r in got.collect()}
        assert ones == {r["i.d"]: [f"c_{r.c or 'nan'}"] if (r.c or "nan") != listed[0] else [] for r in chosen.collect()}


@pytest.mark.parametrize("short", [100, 1])
def test_target_encoding(parts, short):
    got = encode.target_encode(parts, ["c"], "y", short=short)
    assert values(got.test, "c", "c_TargetEncoded") == sorted([("a", 2.0), ("z", 4.0), (None, 4.0)], key=str)
    # Without splits an absent category stays without a mean.
    alone = encode.target_encode(parts.train, ["c"], "y", short=short)
    assert values(alone, "c", "c_TargetEncoded") == sorted(
        [("a", 2.0), ("b", 2.5), ("b", 2.5), (None, None)], key=str
    )
    smooth = encode.category_means(parts.train, "c", "y", smoothing=2.0)
    assert dict(smooth.collect())["b"] == pytest.approx((2.5 * 2 + 4.0 * 2) / 4)


def test_group_statistics(parts):
    got = encode.group_statistic(parts.train, "c", "y", "n", "count")
    assert values(got, "c", "n") == sorted([("a", 1), ("b", 2), ("b", 2), (None, None)], key=str)


def test_encode_by_name(frame):
    for method in ("Label Encoding", "Ordinal Encoding"):
        assert not [c for c in encode.encode(frame, method).dtypes if c[1] == "string"]
    with pytest.raises(LookupError):
        encode.encode(frame.select("id"), "Label Encoding")
    with pytest.raises(LookupError):
        encode.encode(frame, "Target Encoding", target="nothing")
    with pytest.raises(ValueError):
        encode.encode(frame, "Other")


def boxcox_score(x, e):
    y = np.log(x) if e == 0 else (x**e - 1) / e
    return (e - 1) * np.log(x).mean() - 0.5 * np.log(y.var())


def yeojohnson_values(x, e):
    out = np.empty_like(x)
    up = x >= 0
    out[up] = ((x[up] + 1) ** e - 1) / e
    out[~up] = -((1 - x[~up]) ** (2 - e) - 1) / (2 - e)
    return out


def yeojohnson_score(x, e):
    return (e - 1) * (np.sign(x) * np.log1p(np.abs(x))).mean() - 0.5 * np.log(yeojohnson_values(x, e).var())


def test_exponents_maximise_the_likelihood(spark):
    random = np.random.default_rng(7)
    positive, mixed = random.gamma(2, 3, 3000), random.normal(1, 4, 3000) ** 3 / 20
    df = spark.createDataFrame(pd.DataFrame({"p": positive, "m": mixed}))
    fine = np.arange(-3, 3, 1e-3) + 1e-5
    for fitted, score, x in (
        (power.fit_boxcox(df, "p"), boxcox_score, positive),
        (power.fit_yeojohnson(df, "m"), yeojohnson_score, mixed),
    ):
        best = max(score(x, e) for e in fine)
        assert score(x, fitted) >= best - 1e-12
        for step in (1e-3, -1e-3):
            assert score(x, fitted) > score(x, fitted + step)
    assert np.allclose(np.sort(column(df.select(power.yeojohnson(F.col("m"), 0.7).alias("m")), "m")),
                       np.sort(yeojohnson_values(mixed, 0.7)))


def test_transform_guards(spark):
    df = spark.createDataFrame([(-1.0, 0.0, 5.0), (3.0, 2.0, 5.0)], "neg double, zero double, k double")
    assert power.transform(df, "neg", "Log Transform").status == "warning"
    assert power.transform(df, "zero", "Log Transform").ok
    assert power.transform(df, "zero", "Box-Cox Transform").status == "warning"
    assert power.transform(df, "k", "Box-Cox Transform").status == "error"
    assert power.transform(df, "none", "Log Transform").status == "error"
    assert power.transform(df, "neg", "Yeo-Johnson Transform").ok
    with pytest.raises(ValueError):
        power.transform(df, "neg", "Other")


def test_boxcox_nudges_other_parts(spark):
    make = lambda *v: spark.createDataFrame([(float(x),) for x in v], "x double").coalesce(1)
    done = power.transform(Splits(make(1, 2, 4, 9), make(0, 3), make(3)), "x", "Box-Cox Transform")
    e = done.details["lambda"]
    f = lambda x: (x**e - 1) / e
    assert np.allclose(column(done.data.test, "x"), [f(1e-6), f(3 + 1e-6)])
    assert np.allclose(column(done.data.validation, "x"), [f(3.0)])


def test_variance_threshold(spark, frame):
    got = reduce.variance_threshold(frame, 0.0)
    assert "const" not in got.columns
    assert got.columns == ["cat_lo", "cat_hi", "flag", "when", "id", "num_a", "num_b", "target"]
    with pytest.raises(ValueError):
        reduce.variance_threshold(frame.select("const", "flag"), 0.0)


@pytest.mark.parametrize("terms", [10_000, 1])
def test_components(spark, monkeypatch, terms):
    monkeypatch.setattr(reduce, "ONE_PASS_TERMS", terms)
    random = np.random.default_rng(2)
    x = random.normal(size=(500, 4)) @ random.normal(size=(4, 4)) + [5, 0, -3, 100]
    df = spark.createDataFrame(pd.DataFrame(x, columns=list("abcd")).assign(name="n")).coalesce(1)
    projected, fitted = reduce.pca(df, 3)
    z = (x - x.mean(0)) / x.std(0)
    _, s, v = np.linalg.svd(z - z.mean(0), full_matrices=False)
    v = v * np.sign(v[np.arange(4), np.abs(v).argmax(1)])[:, None]
    assert projected.columns == ["name", "PC1", "PC2", "PC3"]
    got = np.array([row[1:] for row in projected.collect()])
    assert np.allclose(got, z @ v[:3].T, atol=1e-8)
    assert np.allclose(fitted.explained, (s**2 / (s**2).sum())[:3])
    assert np.allclose(fitted.loadings.T @ fitted.loadings, np.eye(3), atol=1e-9)
    everything = reduce.fit_pca(df, None, None)
    assert everything.cumulative()[-1] == pytest.approx(1.0) and not everything.scaling


def test_no_more_components_than_rows(spark):
    df = spark.createDataFrame([(1.0, 2.0, 0.0), (2.0, 1.0, 5.0)], "a double, b double, c double")
    assert reduce.fit_pca(df, 3).loadings.shape == (3, 2)


def test_best_features(spark):
    random = np.random.default_rng(4)
    y = np.repeat([0, 1, 2], 100)
    frame = pd.DataFrame({"good": y + random.normal(0, 0.1, 300), "bad": random.normal(size=300), "y": y})
    frame["text"] = np.where(y == 1, "p", "q")
    frame["flat"] = 1.0
    df = spark.createDataFrame(frame)
    scores = reduce.f_statistics(df, "y")
    groups = [frame.good[y == c] for c in range(3)]
    between = sum(100 * (g.mean() - frame.good.mean()) ** 2 for g in groups) / 2
    inside = sum(((g - g.mean()) ** 2).sum() for g in groups) / 297
    assert scores["good"] == pytest.approx(between / inside)
    assert scores["flat"] is None
    assert reduce.select_best(df, "y", 1).columns == ["text_q", "y"]
    assert reduce.select_best(df, "y", 2).columns == ["good", "text_q", "y"]
    assert numeric_columns(df) == ["good", "bad", "y", "flat"]
