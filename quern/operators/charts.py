"""The data behind charts: bins, curves, boxes and lines. Bins and curves are sums, never samples."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.frames import Data, Splits, labelled, number, training
from quern.operators.ordering import global_index
from quern.operators.quantiles import halves, midpoint, order_values

KDE_POINTS = 500
# Cells to a bandwidth, and bandwidths beyond which a kernel is below the last digit of its sum.
KDE_CELLS, _REACH = 64, 8.5
# Beyond so many groups their facts are joined instead of written into the plan.
GROUPS = 24

QUARTILES = {"linear": midpoint(0.25, 0.5, 0.75), "inclusive": halves(True), "exclusive": halves(False)}


def _together(data: Data) -> DataFrame:
    return labelled(data)


def _per_group(group: Column, facts: dict[str, dict[str, float]]) -> Column:
    """The known facts of each row's group as a struct of constants, NULL for other groups. No join."""
    chain = None
    for name, values in facts.items():
        record = F.struct(*[F.lit(float(value)).alias(key) for key, value in values.items()])
        chain = F.when(group == name, record) if chain is None else chain.when(group == name, record)
    return F.lit(None) if chain is None else chain


def _extent(df: DataFrame, column: str) -> tuple[float, float, dict[str, dict[str, float]]]:
    """Common range of a column and the number of its values in each part."""
    value = number(df, column)
    rows = df.groupBy("Set").agg(F.min(value).alias("low"), F.max(value).alias("high"), F.count(value).alias("n"))
    known = [r for r in rows.collect() if r["n"]]
    sizes = {r["Set"]: {"n": r["n"]} for r in known}
    low, high = min((r["low"] for r in known), default=0.0), max((r["high"] for r in known), default=0.0)
    return low, high, sizes


def _bin(value: Column, low: float, high: float, bins: int) -> Column:
    """Zero-based number of the equal-width bin; the highest value belongs to the last bin."""
    if high == low:
        return F.when(value.isNotNull(), F.lit(0))
    at = F.floor((value - F.lit(low)) / F.lit((high - low) / bins))
    return F.least(at, F.lit(bins - 1)).cast("int")


def histogram(data: Data, column: str, bins: int = 30, density: bool = False) -> DataFrame:
    """Count per part and equal-width bin over the common range, or its probability density."""
    df = _together(data)
    low, high, sizes = _extent(df, column)
    width = (high - low) / bins or 1.0
    value = number(df, column)
    counts = (
        df.filter(value.isNotNull())
        .groupBy("Set", _bin(value, low, high, bins).alias("bin"))
        .agg(F.count(F.lit(1)).alias("count"))
        .withColumns({"low": F.col("bin") * width + low, "high": (F.col("bin") + 1) * width + low})
    )
    return _with_density(counts, sizes, width) if density else counts


def _with_density(counts: DataFrame, sizes: dict[str, dict[str, float]], width: float) -> DataFrame:
    if not sizes:
        return counts.withColumn("density", F.lit(None).cast("double"))
    return counts.withColumn("density", F.col("count") / (_per_group(F.col("Set"), sizes)["n"] * width))


def category_histogram(data: Data, column: str, density: bool = False) -> DataFrame:
    df = _together(data)
    counts = df.filter(F.col(column).isNotNull()).groupBy("Set", column).agg(F.count(F.lit(1)).alias("count"))
    if not density:
        return counts
    sizes = {r["Set"]: {"n": r["n"]} for r in df.groupBy("Set").agg(F.count(column).alias("n")).collect()}
    return _with_density(counts, sizes, 1.0)


def density_heatmap(data: Data, x: str, y: str, bins: int = 20) -> DataFrame:
    """Count per cell of a grid over both ranges, all parts together."""
    df = data.labelled() if isinstance(data, Splits) else data
    vx, vy = number(df, x), number(df, y)
    low_x, high_x, low_y, high_y = df.agg(F.min(vx), F.max(vx), F.min(vy), F.max(vy)).first()
    both = df.filter(vx.isNotNull() & vy.isNotNull())
    if low_x is None or low_y is None:
        low_x = high_x = low_y = high_y = 0.0
    cells = [_bin(vx, low_x, high_x, bins).alias("x_bin"), _bin(vy, low_y, high_y, bins).alias("y_bin")]
    return both.groupBy(*cells).agg(F.count(F.lit(1)).alias("count"))


def kde(data: Data, column: str, points: int = KDE_POINTS, cells: int = KDE_CELLS) -> DataFrame:
    """Gaussian density per part at evenly spaced points, bandwidth by Scott's rule.

    Values are first summed into cells of a ``cells``-th of the bandwidth, each represented by the mean and the
    variance of its values. Only cells with values count, and each reaches the points some bandwidths around it.
    """
    df = _together(data)
    return _curves(df.select(F.col("Set").alias("group"), number(df, column).alias("x")), points, cells).select(
        F.col("group").alias("Set"), "x", "density"
    )


def rug(data: Data, column: str) -> DataFrame:
    """The single values drawn below a density curve."""
    return _together(data).select("Set", number(training(data), column).alias("x")).filter("x is not null")


def _curves(values: DataFrame, points: int, cells: int) -> DataFrame:
    """Density curve of each group of (group, x), for any number of groups and any range of values.

    The rows in between are at most the values themselves and ``cells`` times ``2 * _REACH`` times ``points`` a group.
    """
    known = values.filter("x is not null and group is not null")
    stats = known.groupBy("group").agg(
        F.count("x").alias("n"), F.stddev_samp("x").alias("s"), F.min("x").alias("low"), F.max("x").alias("high")
    )
    stats = stats.filter("s > 0").select(
        "group", "n", "low", (F.col("s") * F.pow("n", F.lit(-0.2))).alias("h"), ((F.col("high") - F.col("low")) / points).alias("step")
    )
    placed = known.join(stats, "group")
    at = F.floor((F.col("x") - F.col("low")) / (F.col("h") / cells))
    summed = placed.groupBy("group", "low", "h", "step", at.alias("cell")).agg(
        F.count("x").alias("w"), F.avg("x").alias("c"), F.var_pop("x").alias("v")
    )
    nearest = (F.col("c") - F.col("low")) / F.col("step")
    reach = _REACH * F.col("h") / F.col("step")
    first = F.greatest(F.ceil(nearest - reach), F.lit(0)).cast("int")
    last = F.least(F.floor(nearest + reach), F.lit(points - 1)).cast("int")
    # The spread inside a cell enters through the second derivative.
    u2 = F.pow((F.col("low") + F.col("step") * F.col("i") - F.col("c")) / F.col("h"), 2)
    part = F.col("w") * F.exp(-0.5 * u2) * (1 + 0.5 * F.col("v") / (F.col("h") * F.col("h")) * (u2 - 1))
    near = summed.filter(first <= last).withColumn("i", F.explode(F.sequence(first, last)))
    sums = near.groupBy("group", "i").agg(F.sum(part).alias("__sum"))
    grid = stats.withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(points - 1))))
    density = F.coalesce("__sum", F.lit(0.0)) / (F.col("n") * F.col("h") * math.sqrt(2 * math.pi))
    return grid.join(sums, ["group", "i"], "left").select(
        "group", (F.col("low") + F.col("step") * F.col("i")).alias("x"), density.alias("density")
    )


_BOX = ("q1", "median", "q3", "lower_fence", "upper_fence")


def _fences(q1, median, q3) -> dict:
    reach = 1.5 * (q3 - q1)
    return dict(zip(_BOX, (q1, median, q3, q1 - reach, q3 + reach)))


def _boxed(df: DataFrame, column: str, method: str, group: str) -> DataFrame:
    """Rows (group, x) with the quartiles and fences of their group."""
    found = df.select(group).filter(F.col(group).isNotNull()).distinct().limit(GROUPS + 1).collect()
    value = number(df, column)
    rows = df.select(group, value.alias("x")).filter(F.col("x").isNotNull() & F.col(group).isNotNull())
    if len(found) > GROUPS:
        return rows.join(_quartiles_by_rank(rows, group, method), group)
    wanted = {row[0]: (F.when(F.col(group) == row[0], value), QUARTILES[method]) for row in found}
    quartiles = order_values(df, wanted)
    boxes = {name: _fences(*q) for name, q in quartiles.items() if q[0] is not None}
    boxes = boxes or {None: dict.fromkeys(_BOX, 0.0)}
    placed = rows.withColumn("__box", _per_group(F.col(group), boxes)).filter("__box is not null")
    return placed.select(group, "x", "__box.*")


def _places(method: str, rows: Column) -> list[Column]:
    """Zero-based positions of the three quartiles among so many values."""
    last = rows - 1
    if method == "linear":
        return [F.greatest(F.least(rows * share - 0.5, last.cast("double")), F.lit(0.0)) for share in (0.25, 0.5, 0.75)]
    half = F.greatest(F.floor((rows + (1 if method == "inclusive" else 0)) / 2), F.lit(1))
    return [(half - 1) / 2, last / 2, last - (half - 1) / 2]


def _quartiles_by_rank(rows: DataFrame, group: str, method: str) -> DataFrame:
    """Quartiles of any number of groups: values are numbered in order, and each group fetches its six ranks.

    Numbers are unique, so the lookup is even however uneven the groups are.
    """
    numbered = global_index(rows, [group, "x"], "__n", start=0)
    sizes = numbered.groupBy(group).agg(F.min("__n").alias("first"), F.count(F.lit(1)).alias("rows"))
    ends = [
        F.struct(
            F.lit(name).alias("name"),
            (place - F.floor(place)).alias("share"),
            F.lit(side).alias("side"),
            (F.col("first") + end(place)).cast("bigint").alias("at"),
        )
        for name, place in zip(_BOX, _places(method, F.col("rows")))
        for side, end in (("low", F.floor), ("high", F.ceil))
    ]
    wanted = sizes.select(F.inline(F.array(*ends)))
    found = numbered.join(wanted, F.col("__n") == F.col("at")).groupBy(group)
    values = []
    for name in _BOX[:3]:
        mine = F.col("name") == name
        low, high = (F.max(F.when(mine & (F.col("side") == side), F.col("x"))) for side in ("low", "high"))
        share = F.max(F.when(mine, F.col("share")))
        # From the nearer end, as ``quantiles`` does for few groups.
        upper = high - (high - low) * (1 - share)
        values.append(F.when(low == high, low).when(share < 0.5, low + (high - low) * share).otherwise(upper).alias(name))
    return found.agg(*values).select(group, *[c.alias(k) for k, c in _fences(*map(F.col, _BOX[:3])).items()])


def box_stats(
    data: Data, column: str, quartile_method: str = "linear", by: str | None = None
) -> DataFrame:
    """Quartiles, whiskers, mean and number of outliers per part, or per category of ``by``.

    Whiskers reach the last value within one and a half interquartile ranges of the box.
    """
    group = by or "Set"
    boxed = _boxed(_together(data), column, quartile_method, group)
    inside = F.col("x").between(F.col("lower_fence"), F.col("upper_fence"))
    return boxed.groupBy(group, *_BOX).agg(
        F.count(F.lit(1)).alias("count"),
        F.avg("x").alias("mean"),
        F.least(F.min(F.when(inside, F.col("x"))), F.col("q1")).alias("lower_whisker"),
        F.greatest(F.max(F.when(inside, F.col("x"))), F.col("q3")).alias("upper_whisker"),
        F.count_if(~inside).alias("outliers"),
    )


def box_points(
    data: Data, column: str, show: str | bool = "outliers", quartile_method: str = "linear"
) -> DataFrame:
    """The single points drawn beside a box: all of them, none, or those outside the whiskers.

    ``suspectedoutliers`` also marks the ones beyond three interquartile ranges.
    """
    df = _together(data)
    if show == "all" or show is False:
        rows = df.select("Set", number(df, column).alias("x"), F.lit(False).alias("suspected"))
        return rows.filter(F.col("x").isNotNull() & F.lit(bool(show)))
    boxed = _boxed(df, column, quartile_method, "Set")
    reach = 3 * (F.col("q3") - F.col("q1"))
    far = (F.col("x") < F.col("q1") - reach) | (F.col("x") > F.col("q3") + reach)
    outside = boxed.filter((F.col("x") < F.col("lower_fence")) | (F.col("x") > F.col("upper_fence")))
    return outside.select("Set", "x", (far if show == "suspectedoutliers" else F.lit(False)).alias("suspected"))


def violin(df: DataFrame, category: str, column: str, points: int = KDE_POINTS, cells: int = KDE_CELLS) -> DataFrame:
    """Density curve of a number for each category."""
    values = df.select(F.col(category).cast("string").alias("group"), number(df, column).alias("x"))
    return _curves(values, points, cells).withColumnRenamed("group", category)


def scatter(data: Data, x: str, y: str) -> DataFrame:
    return _together(data).select("Set", x, y)


def trend_line(data: Data, x: str, y: str) -> DataFrame:
    """Least-squares line of y over x for each part."""
    df = _together(data)
    vx, vy = number(df, x), number(df, y)
    return df.groupBy("Set").agg(
        F.regr_slope(vy, vx).alias("slope"),
        F.regr_intercept(vy, vx).alias("intercept"),
        F.regr_r2(vy, vx).alias("r2"),
        F.regr_count(vy, vx).alias("count"),
    )


def line_series(data: Data, time: str, value: str) -> DataFrame:
    """Points of a line over time, in order."""
    return training(data).select(time, value).orderBy(time)
