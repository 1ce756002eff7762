"""Scaling, encoding, transforms, reduction and the data behind charts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalog.registry import Tables, plain, query, round_all
from quern.frames import Splits
from quern.operators import charts, encode, indicators, power, reduce, scale, split
from quern.plans.recipe import Recipe
from quern.staging import discard, staged

_SCALED = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
_LINES = ["l_shipdate", *_SCALED]


def _scaled_sql(centre: str, size: str) -> str:
    stats = ", ".join(
        f"{centre.format(c)} as c{i}, coalesce(nullif({size.format(c)}, 0), 1) as s{i}" for i, c in enumerate(_SCALED)
    )
    values = ", ".join(f"round(({c} - c{i}) / s{i}, 6) as {c}" for i, c in enumerate(_SCALED))
    return f"select l_shipdate, {values} from lineitem, (select {stats} from lineitem) as f"


@query(_scaled_sql("avg({0})", "stddev_pop({0})"))
def scale_standard(t: Tables) -> DataFrame:
    return round_all(scale.scale(t.lineitem.select(*_LINES), "StandardScaler (Z-score)"), _SCALED)


@query(_scaled_sql("min({0})", "(max({0}) - min({0}))"))
def scale_minmax(t: Tables) -> DataFrame:
    return round_all(scale.scale(t.lineitem.select(*_LINES), "MinMaxScaler (0-1 range)"), _SCALED)


@query(_scaled_sql("quantile_cont({0}, 0.5)", "(quantile_cont({0}, 0.75) - quantile_cont({0}, 0.25))"))
def scale_robust(t: Tables) -> DataFrame:
    return round_all(scale.scale(t.lineitem.select(*_LINES), "Robust Scaler"), _SCALED)


# Parts whose sizes decide: known splits for operators that are fitted on one part and applied to others.
_TRAIN, _TEST = "p_partkey % 10 < 7", "p_partkey % 10 >= 7"


def _parts(t: Tables) -> Splits:
    """A division by key, so that the other engine can repeat it."""
    part = t.part
    return Splits(part.filter(_TRAIN), part.filter(_TEST))


@query(
    "select p_partkey, case when p_partkey % 10 < 7 then 'Train' else 'Test' end as \"Set\", "
    "round((p_size - a) / b, 6) as p_size from part, (select avg(p_size) as a, stddev_pop(p_size) as b "
    f"from part where {_TRAIN}) as f"
)
def scale_fitted_on_train(t: Tables) -> DataFrame:
    parts = _parts(t).map(lambda df: df.select(F.col("p_partkey").cast("string"), "p_size"))
    scaled = scale.scale(parts, "StandardScaler (Z-score)").labelled()
    return scaled.select(F.col("p_partkey").cast("bigint"), "Set", F.round("p_size", 6).alias("p_size"))


@query(
    "select p_partkey, p_size, dense_rank() over (order by p_brand) - 1 as p_brand, "
    "dense_rank() over (order by p_type) - 1 as p_type from part"
)
def encode_label(t: Tables) -> DataFrame:
    return encode.label_encode(t.part.select("p_partkey", "p_size", "p_brand", "p_type"), ["p_brand", "p_type"])


@query("select p_partkey, dense_rank() over (order by p_name) - 1 as p_name from part")
def encode_label_many_categories(t: Tables) -> DataFrame:
    return encode.label_encode(t.part.select("p_partkey", "p_name"), ["p_name"], short=3)


@query(
    "select o_orderkey, case when o_orderkey % 10 < 7 then 'Train' else 'Test' end as \"Set\", "
    "coalesce(cast(k as double), -1) as o_custkey from orders left join (select o_custkey as c, dense_rank() over "
    "(order by cast(o_custkey as varchar)) - 1 as k from orders where o_orderkey % 10 < 7 group by o_custkey) as f "
    "on o_custkey = c"
)
def encode_ordinal(t: Tables) -> DataFrame:
    orders = t.orders.select("o_orderkey", F.col("o_custkey").cast("string").alias("o_custkey"))
    parts = Splits(orders.filter("o_orderkey % 10 < 7"), orders.filter("o_orderkey % 10 >= 7"))
    return encode.ordinal_encode(parts, ["o_custkey"]).labelled()


_TYPES = ("LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD")


@query(
    "select p_partkey, p_size, "
    + ", ".join(f"case when p_type = '{c}' then 1.0 else 0.0 end::double as \"p_type_{c}\"" for c in _TYPES)
    + " from part"
)
def encode_one_hot(t: Tables) -> DataFrame:
    return encode.one_hot_encode(t.part.select("p_partkey", "p_size", "p_type"), ["p_type"])


def _added(df: DataFrame, total: str, keep: int) -> DataFrame:
    """The first ``keep`` columns, with all others added to ``total``, which is one of them."""
    kept, terms = df.columns[:keep], [f"__{i}" for i in range(len(df.columns) - keep)]
    # As they stand, sum and columns would become one expression, whose code is too long for a method. No steps are
    # merged over a coalesce, and this one leaves the partitions as they are. Short names keep the plan's text short.
    df = df.toDF(*kept, *terms).coalesce(100_000)
    while len(terms) > 1:  # sums of sums, since one chain would be as deep as it is long
        sums = [" + ".join(terms[i : i + 32]) for i in range(0, len(terms), 32)]
        terms = [f"__{i}" for i in range(len(sums))]
        df = df.selectExpr(*kept, *[f"{of} as {name}" for of, name in zip(sums, terms)])
    return df.selectExpr(*[f"{total} + {terms[0]} as {total}" if c == total else c for c in kept])


@query(
    "select s_suppkey % 10 as part, count(*) as rows, sum(s_suppkey)::double as ones from supplier where s_suppkey > "
    "(select min(s_suppkey) from supplier) and s_name <> (select min(s_name) from supplier) group by 1"
)
def encode_one_hot_per_row(t: Tables) -> DataFrame:
    """As many categories as rows: each indicator is one in one row. All indicators of a row are added up.

    They are made a block of categories at a time, each block is added to the sums of the rows, and these are written,
    so neither the driver nor a task holds the columns of more than a block.
    """
    # A short file is one task, but each of its rows has as many values as there are rows.
    spread = int(t.spark.conf.get("spark.sql.shuffle.partitions"))
    rows = staged(t.supplier.selectExpr("s_suppkey", "s_name as name", "0D as one").repartition(spread, "s_suppkey"))
    for listed in encode.category_blocks(rows, "name"):
        encoded = encode.one_hot_encode(rows.withColumn("s_name", F.col("name")), ["s_name"], only={"s_name": listed})
        before, rows = rows, staged(_added(encoded, "one", len(rows.columns)))
        discard(before)
    kept = rows.filter("one > 0")
    return kept.groupBy((F.col("s_suppkey") % 10).alias("part")).agg(
        F.count(F.lit(1)).alias("rows"), F.sum(F.col("one") * F.col("s_suppkey")).alias("ones")
    )


@query(
    "select p_partkey, p_brand, round(avg(p_retailprice) over (partition by p_brand), 6) as \"p_brand_TargetEncoded\" "
    "from part"
)
def encode_target(t: Tables) -> DataFrame:
    encoded = encode.target_encode(t.part.select("p_partkey", "p_brand", "p_retailprice"), ["p_brand"], "p_retailprice")
    return round_all(encoded.drop("p_retailprice"), ["p_brand_TargetEncoded"])


@query(
    "select o_orderkey, case when o_orderkey % 10 < 7 then 'Train' else 'Test' end as \"Set\", round(coalesce(m, "
    "(select avg(o_totalprice) from orders where o_orderkey % 10 < 7)), 6) as \"clerk_TargetEncoded\" from orders "
    "left join (select o_custkey as c, avg(o_totalprice) as m from orders where o_orderkey % 10 < 7 group by 1) as f "
    "on o_custkey = c"
)
def encode_target_fitted_on_train(t: Tables) -> DataFrame:
    orders = t.orders.select("o_orderkey", F.col("o_custkey").cast("string").alias("clerk"), "o_totalprice")
    parts = Splits(orders.filter("o_orderkey % 10 < 7"), orders.filter("o_orderkey % 10 >= 7"))
    encoded = encode.target_encode(parts, ["clerk"], "o_totalprice").labelled()
    return round_all(encoded.drop("clerk", "o_totalprice"), ["clerk_TargetEncoded"], 6)


@query(
    "select p_partkey, round((m * n + 10 * g) / (n + 10), 6) as \"p_brand_TargetEncoded\" from part join (select "
    "p_brand as b, avg(p_size) as m, count(*) as n from part group by 1) as f on p_brand = b, (select avg(p_size) as g "
    "from part) as o"
)
def encode_target_smoothed(t: Tables) -> DataFrame:
    part = t.part.select("p_partkey", "p_brand", "p_size")
    encoded = encode.target_encode(part, ["p_brand"], "p_size", smoothing=10)
    return round_all(encoded.select("p_partkey", "p_brand_TargetEncoded"), ["p_brand_TargetEncoded"])


@query(
    "select event_id, round(avg(value) over (partition by event_type), 6) as mean_value, "
    "count(value) over (partition by user_id) as n from events"
)
def group_statistics(t: Tables) -> DataFrame:
    means = encode.group_statistic(t.events, "event_type", "value", "mean_value")
    counted = encode.group_statistic(means, "user_id", "value", "n", "count")
    return round_all(counted.select("event_id", "mean_value", "n"), ["mean_value"])


@query("select p_type, round(avg(p_retailprice), 6) as mean, count(p_retailprice) as n from part group by p_type")
def group_mean_and_count(t: Tables) -> DataFrame:
    return t.part.groupBy("p_type").agg(
        F.round(F.avg("p_retailprice"), 6).alias("mean"), F.count("p_retailprice").alias("n")
    )


@query("select event_id, round(ln(1 + value), 6) as value from events")
def log1p(t: Tables) -> DataFrame:
    changed = power.transform(t.events.select("event_id", "value"), "value", "Log Transform").data
    return round_all(changed, ["value"])


@query("select event_id, round((value ** 0.3 - 1) / 0.3, 6) as a, round(ln(value), 6) as b from events")
def boxcox_given_exponent(t: Tables) -> DataFrame:
    value = F.col("value")
    columns = [F.round(power.boxcox(value, e), 6).alias(name) for name, e in (("a", 0.3), ("b", 0.0))]
    return t.events.select("event_id", *columns)


@query(
    "select c_custkey, round(case when c_acctbal >= 0 then ((c_acctbal + 1) ** 0.8 - 1) / 0.8 "
    "else -((1 - c_acctbal) ** 1.2 - 1) / 1.2 end, 5) as balance from customer"
)
def yeojohnson_given_exponent(t: Tables) -> DataFrame:
    return t.customer.select("c_custkey", F.round(power.yeojohnson(F.col("c_acctbal"), 0.8), 5).alias("balance"))


def _likelihoods(power_sql: str, log_sql: str, source: str) -> str:
    """The most likely exponent among steps of 0.01, by evaluating all of them."""
    return (
        f"select round(arg_max(e, (e - 1) * s - 0.5 * ln(v)), 2) as exponent from (select e, avg({log_sql}) as s, "
        f"var_pop({power_sql}) as v from {source}, (select i / 100.0 as e from range(-195, 196) as r(i) where i <> 0 and "
        "i <> 200) as g group by e) as l"
    )


@query(_likelihoods("(value ** e - 1) / e", "ln(value)", "events"))
def boxcox_exponent(t: Tables) -> DataFrame:
    return _fitted(t.events, power.fit_boxcox(t.events, "value"))


@query(
    _likelihoods(
        "case when c_acctbal >= 0 then ((c_acctbal + 1.0) ** e - 1) / e else -((1.0 - c_acctbal) ** (2 - e) - 1) / (2 - e) "
        "end",
        "sign(c_acctbal) * ln(1 + abs(c_acctbal))",
        "customer",
    )
)
def yeojohnson_exponent(t: Tables) -> DataFrame:
    return _fitted(t.customer, power.fit_yeojohnson(t.customer, "c_acctbal"))


def _fitted(df: DataFrame, exponent: float) -> DataFrame:
    return df.sparkSession.range(1).select(F.round(F.lit(exponent), 2).alias("exponent"))


def _transformed(key: str, column: str, source: str, power_of: str, log: str, of: str | None = None) -> str:
    """Transform ``of`` by the most likely exponent of ``source``, found on ever finer grids and a last parabola."""
    def grid(centre: str, step: float) -> str:
        return (
            f"(select e, (e - 1) * avg({log}) - 0.5 * ln(var_pop({power_of})) as f from {source}, (select {centre} + i * "
            f"{step} + 1e-9 as e from {{0}}range(-20, 21) as r(i)) as g group by e)"
        )

    return (
        f"with a as {grid('0', 0.1).format('')}, a1 as (select arg_max(e, f) as m from a), "
        f"b as {grid('m', 0.006).format('a1, ')}, b1 as (select arg_max(e, f) as m from b), "
        f"c as {grid('m', 0.0005).format('b1, ')}, c1 as (select arg_max(e, f) as m from c), "
        f"d as {grid('m', 0.00003).format('c1, ')}, d1 as (select arg_max(e, f) as m, max(f) as top from d), "
        "p as (select m, (select f from d where abs(e - (m - 0.00003)) < 1e-7) as l, top, "
        "(select f from d where abs(e - (m + 0.00003)) < 1e-7) as r from d1), "
        "o as (select m + 0.00003 * (l - r) / (2 * (l - 2 * top + r)) as e from p) "
        f"select {key}, round({power_of}, 2) as {column} from {of or source}, o"
    )


@query(_transformed("event_id", "value", "events", "((value ** e - 1) / e)", "ln(value)"))
def boxcox(t: Tables) -> DataFrame:
    done = power.transform(t.events.select("event_id", "value"), "value", "Box-Cox Transform")
    return round_all(done.data, ["value"], 2)


@query(
    _transformed(
        "l_orderkey, l_partkey, l_suppkey", "change", "(select *, l_quantity - 20 + l_tax as change from lineitem)",
        "(case when change >= 0 then ((change + 1.0) ** e - 1) / e else -((1.0 - change) ** (2 - e) - 1) / (2 - e) end)",
        "(sign(change) * ln(1 + abs(change)))",
    )
)
def yeojohnson(t: Tables) -> DataFrame:
    lines = t.lineitem.select("l_orderkey", "l_partkey", "l_suppkey", (F.col("l_quantity") - 20 + F.col("l_tax")).alias("change"))
    return round_all(power.transform(lines, "change", "Yeo-Johnson Transform").data, ["change"], 2)


@query(
    _transformed(
        "event_id, case when event_id % 10 < 7 then 'Train' else 'Test' end as \"Set\"", "value",
        "(select event_id, value from events where event_id % 10 < 7)", "((value ** e - 1) / e)", "ln(value)", "events",
    )
)
def boxcox_fitted_on_train(t: Tables) -> DataFrame:
    """The exponent comes from the training part and is applied to both."""
    rows = t.events.select("event_id", "value")
    parts = Splits(rows.filter("event_id % 10 < 7"), rows.filter("event_id % 10 >= 7"))
    return round_all(power.transform(parts, "value", "Box-Cox Transform").data.labelled(), ["value"], 2)


@query("select l_returnflag, l_quantity, l_extendedprice from lineitem")
def variance_threshold(t: Tables) -> DataFrame:
    lines = t.lineitem.select("l_quantity", "l_discount", "l_returnflag", "l_tax", "l_extendedprice")
    return reduce.variance_threshold(lines, 0.01)


# With two columns the components have a closed form.
_TWO = """
with f as (select min(l_quantity) as a, max(l_quantity) - min(l_quantity) as b, min(l_extendedprice) as c,
    max(l_extendedprice) - min(l_extendedprice) as d from lineitem),
z as (select l_orderkey, l_linenumber, (l_quantity - a) / b as x, (l_extendedprice - c) / d as y from lineitem, f),
m as (select avg(x) as mx, avg(y) as my, var_samp(x) as p, var_samp(y) as q, covar_samp(x, y) as r from z),
e as (select *, ((p + q) + sqrt((p - q) ** 2 + 4 * r * r)) / 2 as big, ((p + q) - sqrt((p - q) ** 2 + 4 * r * r)) / 2
    as small from m),
v as (select *, r / sqrt(r * r + (big - p) ** 2) as u1, (big - p) / sqrt(r * r + (big - p) ** 2) as u2,
    r / sqrt(r * r + (small - p) ** 2) as w1, (small - p) / sqrt(r * r + (small - p) ** 2) as w2 from e)
"""


def _two(t: Tables) -> DataFrame:
    keys = [F.col(c).cast("string").alias(c) for c in ("l_orderkey", "l_linenumber")]
    return t.lineitem.select(*keys, "l_quantity", "l_extendedprice")


@query(
    _TWO + "select l_orderkey, l_linenumber, round(((x - mx) * u1 + (y - my) * u2) * "
    "case when case when abs(u1) > abs(u2) then u1 else u2 end < 0 then -1 else 1 end, 6) as \"PC1\", "
    "round(((x - mx) * w1 + (y - my) * w2) * case when case when abs(w1) > abs(w2) then w1 else w2 end < 0 then -1 "
    "else 1 end, 6) as \"PC2\" from z, v"
)
def pca_two_columns(t: Tables) -> DataFrame:
    reduced, _ = reduce.pca(_two(t), 2, "MinMaxScaler (0-1 range)")
    keys = [F.col("l_orderkey").cast("bigint").alias("l_orderkey"), F.col("l_linenumber").cast("int").alias("l_linenumber")]
    return round_all(reduced, ["PC1", "PC2"]).select(*keys, "PC1", "PC2")


@query(
    _TWO + "select 'PC1' as component, round(big / (big + small), 6) as ratio, round(big / (big + small), 6) as "
    "cumulative from v union all select 'PC2', round(small / (big + small), 6), 1.0 from v"
)
def explained_variance(t: Tables) -> DataFrame:
    two = _two(t)
    shares = reduce.explained_variance(two, reduce.fit_pca(two, 2, "MinMaxScaler (0-1 range)"))
    return round_all(shares, ["ratio", "cumulative"])


@query()
def pca(t: Tables) -> DataFrame:
    lines = t.lineitem.select("l_returnflag", "l_quantity", "l_extendedprice", "l_discount", "l_tax")
    return reduce.pca(split.train_test_split(lines, 0.2), 3)[0].labelled()


_F_FEATURES = {
    "l_quantity": "l_quantity",
    "l_extendedprice": "l_extendedprice",
    "l_discount": "l_discount",
    "l_linestatus_O": "case when l_linestatus = 'O' then 1.0 else 0.0 end",
}


def _f_sql(name: str, value: str) -> str:
    return (
        f"select '{name}' as feature, round(sum(n * (m - g) ** 2) / (count(*) - 1) / (sum(v * n) / (sum(n) - count(*))), 4) "
        f"as f from (select count(*) as n, avg({value}) as m, var_pop({value}) as v from lineitem group by l_returnflag) "
        f"as c, (select avg({value}) as g from lineitem) as o"
    )


@query(" union all ".join(_f_sql(name, value) for name, value in _F_FEATURES.items()))
def anova_f(t: Tables) -> DataFrame:
    lines = t.lineitem.select("l_quantity", "l_extendedprice", "l_discount", "l_linestatus", "l_returnflag")
    scores = reduce.f_statistics(lines, "l_returnflag")
    cells = ", ".join(f"'{name}', double('{score!r}')" for name, score in scores.items())
    return t.spark.range(1).selectExpr(f"stack({len(scores)}, {cells}) as (feature, f)").withColumn("f", F.round("f", 4))


_MARKED = """
select l_extendedprice as price, l_quantity + case when l_returnflag = 'A' then 10 else 0 end as quantity,
  l_discount as discount, l_tax + case when l_returnflag = 'R' then 0.5 else 0 end as tax, l_linestatus, l_returnflag
from {lineitem}
"""


@query("select quantity, tax, l_returnflag from (" + _MARKED.replace("{lineitem}", "lineitem") + ") as m")
def feature_selection(t: Tables) -> DataFrame:
    """Two of the features differ by class, so those are the best ones."""
    return reduce.select_best(t.sql(_MARKED), "l_returnflag", 2)


_WIDE = """
select l_orderkey, l_linenumber, p_name, cast(l_partkey as string) as l_partkey, l_quantity, l_returnflag
from {lineitem}, {part} where l_partkey = p_partkey
"""
_WIDE_CELLS = (
    f"w as ({plain(_WIDE)}), cells as (select 0 as place, p_name as category, l_returnflag as y from w union all "
    "select 1, cast(l_partkey as varchar), l_returnflag from w), firsts as (select place, min(category) as first from "
    "cells group by place)"
)
_WIDE_SCORES = f"""
with {_WIDE_CELLS}, counts as (select place, category, y, count(*) as c from cells group by all),
classes as (select l_returnflag as y, count(*) as s from w group by 1),
sums as (select place, category, sum(c) as m, sum(cast(c as double) * c / s) as b from counts join classes using (y)
  group by place, category),
totals as (select count(*) as n, count(distinct l_returnflag) as k from w)
select place, category, (b - m * m / n) / (k - 1) / ((m - b) / (n - k)) as f
from sums join firsts using (place), totals where category <> first
"""


@query(f"select place, category, round(f, 4) as f from ({_WIDE_SCORES}) as x")
def indicator_scores(t: Tables) -> DataFrame:
    """Analysis of variance of an indicator for every name and every key of a part."""
    return round_all(indicators.indicator_scores(t.sql(_WIDE), ["p_name", "l_partkey"], "l_returnflag"), ["f"], 4)


@query(f"""
with {_WIDE_CELLS}, known as (select place, category, row_number() over (order by place, category) - 1 as position
  from (select distinct place, category from cells) join firsts using (place) where category <> first)
select l_orderkey, l_linenumber, l_returnflag,
  concat_ws(',', cast(a.position as varchar), cast(b.position as varchar)) as positions
from w left join known as a on a.place = 0 and a.category = p_name
left join known as b on b.place = 1 and b.category = cast(l_partkey as varchar)
""")
def sparse_one_hot(t: Tables) -> DataFrame:
    """Each line's part by name and key as positions among all indicators."""
    lines, _ = indicators.sparse_one_hot(t.sql(_WIDE).drop("l_quantity"), ["p_name", "l_partkey"])
    positions = F.concat_ws(",", F.col("indicators.position").cast("array<string>"))
    return lines.select("l_orderkey", "l_linenumber", "l_returnflag", positions.alias("positions"))



@query(f"""
with scores as ({_WIDE_SCORES}), best as (select place, category from scores order by f desc, place, category limit 3)
select l_returnflag, sum((select count(*) from best where (place = 0 and category = p_name)
  or (place = 1 and category = cast(l_partkey as varchar)))) as hits, count(*) as lines
from ({plain(_WIDE)}) as w group by l_returnflag
""")
def feature_selection_wide(t: Tables) -> DataFrame:
    """The three best of all indicators of names and keys of parts: how many lines of each class have them."""
    best = reduce.select_best(t.sql(_WIDE).select("p_name", "l_partkey", "l_returnflag"), "l_returnflag", 3)
    hits = sum((F.col(f"`{c}`") for c in best.columns[:-1]), F.lit(0.0))
    return best.groupBy("l_returnflag").agg(F.sum(hits).cast("long").alias("hits"), F.count(F.lit(1)).alias("lines"))


_BIN = "least(cast(floor((value - lo) / ((hi - lo) / 25)) as int), 24)"
_EVENT_BINS = (
    f"select {_BIN} as bin, count(*) as count from events, (select min(value) as lo, max(value) as hi from events) as r "
    "group by 1"
)


@query(
    "select 'All' as \"Set\", bin, count, round(bin * w + lo, 6) as low, round((bin + 1) * w + lo, 6) as high, "
    f"round(count / (n * w), 9) as density from ({_EVENT_BINS}) as b, (select min(value) as lo, "
    "(max(value) - min(value)) / 25 as w, count(value) as n from events) as r"
)
def histogram(t: Tables) -> DataFrame:
    bins = charts.histogram(t.events, "value", 25, density=True)
    return round_all(round_all(bins, ["low", "high"]), ["density"], 9)


@query(
    "select case when p_partkey % 10 < 7 then 'Train' else 'Test' end as \"Set\", "
    "least(cast(floor((p_size - lo) / ((hi - lo) / 7.0)) as int), 6) as bin, count(*) as count from part, "
    "(select cast(min(p_size) as double) as lo, max(p_size) as hi from part) as r group by all"
)
def histogram_by_set(t: Tables) -> DataFrame:
    return charts.histogram(_parts(t), "p_size", 7).select("Set", "bin", "count")


@query("select 'All' as \"Set\", event_type, count(*) as count from events group by event_type")
def category_histogram(t: Tables) -> DataFrame:
    return charts.category_histogram(t.events, "event_type")


@query(
    "select least(cast(floor((l_quantity - a) / ((b - a) / 12)) as int), 11) as x_bin, "
    "least(cast(floor((l_extendedprice - c) / ((d - c) / 12)) as int), 11) as y_bin, count(*) as count from lineitem, "
    "(select min(l_quantity) as a, max(l_quantity) as b, min(l_extendedprice) as c, max(l_extendedprice) as d from "
    "lineitem) as r group by all"
)
def density_heatmap(t: Tables) -> DataFrame:
    return charts.density_heatmap(t.lineitem, "l_quantity", "l_extendedprice", 12)


@query(
    "with s as (select avg(value) as m, stddev_samp(value) * count(value) ** -0.2 as h, count(value) as n, min(value) as a, "
    "max(value) as b from events), g as (select a + i * (b - a) / 500 as x from s, range(500) as r(i)) "
    "select 'All' as \"Set\", round(x, 6) as x, round(sum(exp(-0.5 * ((x - value) / h) ** 2)) / (max(n) * max(h) * "
    "sqrt(2 * pi())), 8) as density from g, s, events group by x"
)
def kde(t: Tables) -> DataFrame:
    return round_all(round_all(charts.kde(t.events, "value"), ["x"]), ["density"], 8)


@query(
    "with t as (select value * value * value / 1e4 as value from events), "
    "s as (select stddev_samp(value) * count(value) ** -0.2 as h, count(value) as n, min(value) as a, "
    "max(value) as b from t), g as (select a + i * (b - a) / 500 as x from s, range(500) as r(i)) "
    "select 'All' as \"Set\", round(x, 5) as x, round(sum(exp(-0.5 * ((x - value) / h) ** 2)) / (max(n) * max(h) * "
    "sqrt(2 * pi())), 8) as density from g, s, t group by x"
)
def kde_heavy_tail(t: Tables) -> DataFrame:
    """Most values lie close together, a few very far away."""
    cubed = t.events.select((F.col("value") * F.col("value") * F.col("value") / 1e4).alias("value"))
    return round_all(round_all(charts.kde(cubed, "value"), ["x"], 5), ["density"], 8)


@query(
    "with s as (select event_type as k, stddev_samp(value) * count(value) ** -0.2 as h, count(value) as n, "
    "min(value) as a, max(value) as b from events group by 1), "
    "g as (select k, h, n, a + i * (b - a) / 100 as x from s, range(100) as r(i)) "
    "select event_type, round(x, 6) as x, round(sum(exp(-0.5 * ((x - value) / h) ** 2)) / (max(n) * max(h) * "
    "sqrt(2 * pi())), 8) as density from g join events on k = event_type group by event_type, x"
)
def violin(t: Tables) -> DataFrame:
    return round_all(round_all(charts.violin(t.events, "event_type", "value", 100), ["x"]), ["density"], 8)


_HAZEN = (
    "case when {q} * n - 0.5 < 0 then a[1] when {q} * n - 0.5 > n - 1 then a[n] else a[1 + floor({q} * n - 0.5)::bigint] + "
    "(a[1 + ceil({q} * n - 0.5)::bigint] - a[1 + floor({q} * n - 0.5)::bigint]) * (({q} * n - 0.5) % 1) end"
)
def _median_of(first: str, size: str) -> str:
    return f"(a[{first} + ({size} - 1) // 2] + a[{first} + {size} // 2]) / 2"


def _halves(half: str) -> tuple[str, str, str]:
    return _median_of("1", half), _median_of("1", "n"), _median_of(f"n - {half} + 1", half)


def _boxes(q1: str, q2: str, q3: str, table: str = "events", key: str = "event_type", x: str = "value") -> str:
    low, high = "q1 - 1.5 * (q3 - q1)", "q3 + 1.5 * (q3 - q1)"
    return (
        f"with s as (select {key} as k, list({x} order by {x}) as a, count({x}) as n from {table} group by 1), "
        f"q as (select k, {q1} as q1, {q2} as q2, {q3} as q3 from s) "
        f"select {key}, round(q1, 6) as q1, round(q2, 6) as median, round(q3, 6) as q3, "
        f"round({low}, 6) as lower_fence, round({high}, 6) as upper_fence, count(*) as count, round(avg({x}), 6) as mean, "
        f"round(least(min({x}) filter (where {x} >= {low}), q1), 6) as lower_whisker, "
        f"round(greatest(max({x}) filter (where {x} <= {high}), q3), 6) as upper_whisker, "
        f"count(*) filter (where {x} < {low} or {x} > {high}) as outliers "
        f"from {table} join q on k = {key} group by {key}, q1, q2, q3"
    )


_BOX = ["q1", "median", "q3", "lower_fence", "upper_fence", "mean", "lower_whisker", "upper_whisker"]


@query(_boxes(*[_HAZEN.format(q=q) for q in (0.25, 0.5, 0.75)]))
def box_stats_linear(t: Tables) -> DataFrame:
    return round_all(charts.box_stats(t.events, "value", "linear", by="event_type"), _BOX)


@query(_boxes(*_halves("((n + 1) // 2)")))
def box_stats_inclusive(t: Tables) -> DataFrame:
    return round_all(charts.box_stats(t.events, "value", "inclusive", by="event_type"), _BOX)


@query(_boxes(*_halves("(n // 2)")))
def box_stats_exclusive(t: Tables) -> DataFrame:
    return round_all(charts.box_stats(t.events, "value", "exclusive", by="event_type"), _BOX)


@query(_boxes(*_halves("(n // 2)"), "lineitem", "l_partkey", "l_quantity"))
def box_stats_many_groups(t: Tables) -> DataFrame:
    return round_all(charts.box_stats(t.lineitem, "l_quantity", "exclusive", by="l_partkey"), _BOX)


@query(
    "with q as (select " + ", ".join(
        _HAZEN.format(q=q) + f" as q{i}" for i, q in ((1, 0.25), (3, 0.75))
    ) + " from (select list(value order by value) as a, count(value) as n from events) as s) "
    "select 'All' as \"Set\", value as x, value < q1 - 3 * (q3 - q1) or value > q3 + 3 * (q3 - q1) as suspected "
    "from events, q where value < q1 - 1.5 * (q3 - q1) or value > q3 + 1.5 * (q3 - q1)"
)
def box_points(t: Tables) -> DataFrame:
    return charts.box_points(t.events, "value", "suspectedoutliers")


@query("select 'All' as \"Set\", l_quantity, l_extendedprice from lineitem")
def scatter(t: Tables) -> DataFrame:
    return charts.scatter(t.lineitem, "l_quantity", "l_extendedprice")


@query(
    "select case when p_partkey % 10 < 7 then 'Train' else 'Test' end as \"Set\", "
    "round(regr_slope(p_retailprice, p_size), 6) as slope, round(regr_intercept(p_retailprice, p_size), 6) as intercept, "
    "round(regr_r2(p_retailprice, p_size), 8) as r2, regr_count(p_retailprice, p_size)::bigint as count "
    "from part group by all"
)
def trend_line(t: Tables) -> DataFrame:
    lines = charts.trend_line(_parts(t), "p_size", "p_retailprice")
    return round_all(round_all(lines, ["slope", "intercept"]), ["r2"], 8)


@query("select ts, value from events order by ts")
def line_series(t: Tables) -> DataFrame:
    return charts.line_series(t.events, "ts", "value")


@query(
    "with g as (select *, coalesce(value, (select quantile_cont(value, 0.5) from h)) as filled from h), "
    "q as (select quantile_cont(filled, 0.25) as a, quantile_cont(filled, 0.75) as b from g), "
    "k as (select g.* from g, q where filled between a - 1.5 * (b - a) and b + 1.5 * (b - a)), "
    "s as (select min(filled) as lo, max(filled) - min(filled) as w, min(user_id) as ulo, max(user_id) - min(user_id) as uw, "
    "min(event_id) as elo, max(event_id) - min(event_id) as ew from k) "
    "select round((event_id - elo) / ew, 6) as number, round((filled - lo) / w, 6) as value, "
    "round((user_id - ulo) / uw, 6) as user_id, event_type from k, s".replace(
        "from h", "from (select event_id, case when event_id % 7 = 0 then null else value end as value, user_id, "
        "event_type from events) as h"
    )
)
def replayed_recipe(t: Tables) -> DataFrame:
    gaps = t.sql(
        "select event_id, case when event_id % 7 = 0 then null else value end as value, user_id, event_type, props "
        "from {events}"
    )
    recipe = Recipe(gaps)
    recipe.add("drop_columns", {"columns": ["props"]})
    recipe.add("remove_duplicates", {"keep_first": True})
    recipe.add("missing_values", {"fill_strategy": "Fill with Median", "cols_with_na": ["value"]})
    recipe.add("rename_column", {"old_name": "event_id", "new_name": "number"})
    recipe.add("remove_outliers", {"selected_outlier_column": "value", "outlier_removal_method": "IQR"})
    recipe.add("scale_columns", {"scaling_method": "MinMaxScaler (0-1 range)"})
    # Refused, since the data are scaled already: leaves them as they are.
    recipe.add("scale_columns", {"scaling_method": "Robust Scaler"})
    return round_all(recipe.replay(), ["number", "value", "user_id"])


_REFUSALS = (
    ("split_twice", {"op_type": "train_test_split", "params": {"test_size": 0.3}}, True),
    ("duplicates_after_split", {"op_type": "remove_duplicates", "params": {}}, True),
    ("fill_after_split", {"op_type": "missing_values", "params": {}}, True),
    ("scale", {"op_type": "scale_columns", "params": {"scaling_method": "Robust Scaler"}}, False),
    ("scale_twice", {"op_type": "scale_columns", "params": {"scaling_method": "Robust Scaler"}}, True),
    ("components_with_text", {"op_type": "pca", "params": {"n_components": 1}}, True),
    ("encode", {"op_type": "encode_columns", "params": {"encoding_method": "Ordinal Encoding", "cat_cols": ["event_type"]}}, False),
    ("transform_encoded", {"op_type": "transform_columns", "params": {"col_to_transform": "value", "transform_method": "Log Transform"}}, True),
    ("outliers_encoded", {"op_type": "remove_outliers", "params": {"col": "value", "method": "IQR"}}, True),
)


@query(
    "select step, refused, (select count(*) from events) as rows from (values "
    + ", ".join(f"('{name}', {str(refused).lower()})" for name, _, refused in _REFUSALS)
    + ") as v(step, refused)"
)
def recipe_refusals(t: Tables) -> DataFrame:
    """Steps that must not follow others are refused and leave the rows as they are."""
    work = Recipe(t.events.select("event_id", "event_type", "value"))
    assert work.add("train_test_split", {"test_size": 0.2}).ok
    rows = []
    for name, step, _ in _REFUSALS:
        outcome = work.add(step["op_type"], step["params"])
        rows.append(f"('{name}', {str(not outcome.ok).lower()}, {work.current.labelled().count()}L)")
    return t.spark.sql("select * from values " + ", ".join(rows) + " as (step, refused, rows)")
