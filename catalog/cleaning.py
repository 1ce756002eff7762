"""Cleaning operators: codes, missing values, duplicates, types, outliers, splits."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalog.registry import Tables, plain, query, round_all
from quern import frames
from quern.functions import codes, dates, numbers, text
from quern.operators import columns, duplicates, missing, outliers, quantiles, split, summaries, types

# Events with gaps in a number, a text and an integer.
GAPS = """
select event_id, case when event_id % 7 = 0 then null else value end as value,
  case when event_id % 50 = 0 then null else event_type end as event_type,
  case when event_id % 11 = 0 then null else user_id end as user_id
from {events}
"""
_GAPS = plain(GAPS)
_STATES = {"P": "pending", "O": "open", "F": "finished"}


@query(
    "select o_orderkey, case o_orderstatus when 'P' then 'pending' when 'O' then 'open' when 'F' then 'finished' "
    "else 'n/a' end as status, case when o_orderpriority in ('1-URGENT', '2-HIGH') then 'first' else 'later' end "
    "as turn from orders"
)
def code_mapping(t: Tables) -> DataFrame:
    messy = t.orders.withColumn("code", F.concat(F.lit(" "), F.lower("o_orderstatus"), F.lit("  ")))
    turn = codes.map_codes(F.col("o_orderpriority"), {"1-urgent": "first", "2-high": "first"}, "later")
    return messy.select("o_orderkey", codes.map_codes(F.col("code"), _STATES, "n/a").alias("status"), turn.alias("turn"))


@query(
    "select s_suppkey, case when n_nationkey < 20 then n_name else 'n/a' end as nation "
    "from supplier left join nation on s_nationkey = n_nationkey"
)
def code_mapping_by_join(t: Tables) -> DataFrame:
    listed = t.nation.filter("n_nationkey < 20")
    mapped = codes.map_codes_by_join(t.supplier, "s_nationkey", listed, "n_nationkey", "n_name", "nation", "n/a")
    return mapped.select("s_suppkey", "nation")


@query(
    "select c_custkey, substr(c_name, 10) as number, replace(c_name, '#', '_') as name, substr(c_name, 1, 4) as head, "
    "case when c_mktsegment like 'BU%' then substr(c_mktsegment, 3) else c_mktsegment end as segment from customer"
)
def key_surgery(t: Tables) -> DataFrame:
    return t.customer.select(
        "c_custkey",
        text.tail_from(F.col("c_name"), 10).alias("number"),
        F.replace("c_name", F.lit("#"), F.lit("_")).alias("name"),
        F.substring("c_name", 1, 4).alias("head"),
        text.strip_prefix(F.col("c_mktsegment"), "BU").alias("segment"),
    )


_INT_DATES = (
    "select o_orderkey, cast(case when o_orderkey % 5 = 0 then 0 when o_orderkey % 7 = 0 then 1234567 "
    "when o_orderkey % 11 = 0 then 20231340 else year(o_orderdate) * 10000 + month(o_orderdate) * 100 + "
    "day(o_orderdate) end as int) as coded from {orders}"
)


@query(
    "select o_orderkey, case when coded <> 0 and length(cast(coded as varchar)) = 8 then "
    f"cast(try_strptime(cast(coded as varchar), '%Y%m%d') as date) end as day from ({plain(_INT_DATES)}) as d"
)
def int_date_parse(t: Tables) -> DataFrame:
    return t.sql(_INT_DATES).select("o_orderkey", dates.date_from_number(F.col("coded")).alias("day"))


_AMOUNTS = """
select l_orderkey, l_linenumber, l_partkey, l_suppkey, cast(l_quantity as bigint) as quantity,
  case when l_partkey % 6 = 0 then null when l_partkey % 6 = 1 then -l_suppkey else l_suppkey end as price,
  case when l_orderkey % 5 = 0 then null when l_orderkey % 5 = 1 then -cast(l_quantity as bigint) * l_suppkey
    else cast(l_quantity as bigint) * l_suppkey + l_orderkey % 3 end as sales
from {lineitem}
"""


@query(
    "select l_orderkey, l_linenumber, l_partkey, quantity, case when sales is null or sales <= 0 or "
    "sales <> quantity * abs(price) then quantity * abs(price) else sales end as sales, case when price is null or "
    f"price <= 0 then sales // nullif(quantity, 0) else price end as price from ({plain(_AMOUNTS)}) as a"
)
def sales_repair(t: Tables) -> DataFrame:
    names = ("sales", "quantity", "price")
    return t.sql(_AMOUNTS).select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "quantity",
        numbers.repaired_sales(*names).alias("sales"),
        numbers.repaired_price(*names).alias("price"),
    )


@query("select event_id, case when event_type in ('view', 'click') then null else event_type end as kind from events")
def sentinel_to_null(t: Tables) -> DataFrame:
    return t.events.select("event_id", text.blank_to_null(F.col("event_type"), ("view", "click")).alias("kind"))


@query("select c_name as customer, c_acctbal as balance from customer")
def project_renamed(t: Tables) -> DataFrame:
    return columns.renamed(t.customer, {"c_name": "customer", "c_acctbal": "balance"})


@query("select event_id, ts as happened, user_id, value from events")
def rename_and_drop(t: Tables) -> DataFrame:
    kept = columns.drop_columns(t.events, ["event_type", "props", "no_such_column"])
    return columns.rename_column(kept, "ts", "happened")


@query(
    "select c as \"column\", missing, round(missing * 100.0 / n, 2) as missing_percent, "
    "case when missing * 100.0 / n > 5 then 'High' else 'Low' end as severity from ("
    + " union all ".join(
        f"select '{c}' as c, count(*) filter (where {c} is null) as missing, count(*) as n from ({_GAPS}) as g"
        for c in ("event_id", "value", "event_type", "user_id")
    )
    + ") as m"
)
def missing_report(t: Tables) -> DataFrame:
    return missing.missing_report(t.sql(GAPS))


@query(f"select * from ({_GAPS}) as g where value is not null and event_type is not null and user_id is not null")
def drop_null_rows(t: Tables) -> DataFrame:
    return missing.drop_rows(t.sql(GAPS))


@query("select event_id from events")
def drop_null_columns(t: Tables) -> DataFrame:
    return missing.drop_columns_with_missing(t.sql(GAPS))


@query(
    "select event_id, event_type, round(coalesce(value, (select avg(value) from g)), 6) as value, "
    "round(coalesce(user_id, (select avg(user_id) from g)), 6) as user_id from g".replace("from g", f"from ({_GAPS}) as g")
)
def fill_mean(t: Tables) -> DataFrame:
    filled = missing.fill_mean(t.sql(GAPS), ["value", "user_id", "event_type"])
    return round_all(filled, ["value", "user_id"])


@query(
    "select event_id, event_type, round(coalesce(value, (select quantile_cont(value, 0.5) from g)), 6) as value, "
    "coalesce(cast(user_id as double), (select quantile_cont(cast(user_id as double), 0.5) from g)) as user_id "
    "from g".replace("from g", f"from ({_GAPS}) as g")
)
def fill_median(t: Tables) -> DataFrame:
    return round_all(missing.fill_median(t.sql(GAPS), ["value", "user_id"]), ["value"])


def _mode(name: str) -> str:
    return (
        f"(select {name} from ({_GAPS}) as m where {name} is not null group by {name} "
        f"order by count(*) desc, {name} limit 1)"
    )


@query(
    "select event_id, "
    + ", ".join(f"coalesce({c}, {_mode(c)}) as {c}" for c in ("value", "event_type", "user_id"))
    + f" from ({_GAPS}) as g"
)
def fill_mode(t: Tables) -> DataFrame:
    return missing.fill_mode(t.sql(GAPS), ["value", "event_type", "user_id"])


@query(
    "select event_id, coalesce(value, 12.0) as value, coalesce(event_type, '12') as event_type, "
    f"coalesce(user_id, 12) as user_id from ({_GAPS}) as g"
)
def fill_custom(t: Tables) -> DataFrame:
    return missing.fill_custom(t.sql(GAPS), "12")


_FEW = "select l_orderkey, l_linenumber, l_returnflag from {lineitem}"


@query(f"select distinct * from ({plain(_FEW)}) as f")
def dedup_first(t: Tables) -> DataFrame:
    return duplicates.drop_duplicates(t.sql(_FEW))


@query(f"select * from ({plain(_FEW)}) as f group by all having count(*) = 1")
def dedup_all(t: Tables) -> DataFrame:
    return duplicates.drop_all_duplicated(t.sql(_FEW))


@query(
    "select cast(sum(n) as bigint) as all_members, cast(sum(n - 1) as bigint) as all_but_first from (select count(*) as n "
    f"from ({plain(_FEW)}) as f group by l_orderkey, l_linenumber, l_returnflag having count(*) > 1) as d"
)
def duplicate_counts(t: Tables) -> DataFrame:
    return duplicates.duplicate_counts(t.sql(_FEW))


_NUMBERED = "partition by l_orderkey, l_linenumber, l_returnflag"


@query(
    f"select l_orderkey, l_linenumber, l_returnflag from (select *, count(*) over ({_NUMBERED}) as n "
    f"from ({plain(_FEW)}) as f) as d where n > 1"
)
def list_duplicates(t: Tables) -> DataFrame:
    return duplicates.list_duplicates(t.sql(_FEW))


@query(
    f"select l_orderkey, l_linenumber, l_returnflag from (select *, row_number() over ({_NUMBERED} order by 1) as n "
    f"from ({plain(_FEW)}) as f) as d where n > 1"
)
def list_duplicates_but_first(t: Tables) -> DataFrame:
    return duplicates.list_duplicates(t.sql(_FEW), keep_first=True)


_WORDS = """
select event_id, case event_type when 'view' then 'Yes' when 'click' then 'F' when 'error' then 'no'
    when 'signup' then '1' else null end as flag,
  case when event_id % 9 = 0 then 'none' when event_id % 10 = 0 then ' ' || cast(value as string) || ' '
    else cast(value as string) end as amount,
  cast(event_id * 3 as string) || case when event_id % 4 = 0 then '.75' else '' end as whole,
  case when event_id % 6 = 0 then 'soon' when event_id % 2 = 0 then substr(cast(ts as string), 1, 19)
    else substr(cast(ts as string), 1, 10) end as moment
from {events}
"""
_TEXTS = plain(_WORDS)


@query(
    "select event_id, case when lower(flag) in ('yes', '1') then true when lower(flag) in ('f', 'no') then false end "
    f"as flag from ({_TEXTS}) as w"
)
def convert_bool(t: Tables) -> DataFrame:
    return types.convert(t.sql(_WORDS), "flag", "bool").data.select("event_id", "flag")


@query(f"select event_id, try_cast(trim(amount) as double) as amount from ({_TEXTS}) as w")
def convert_float(t: Tables) -> DataFrame:
    return types.convert(t.sql(_WORDS), "amount", "float").data.select("event_id", "amount")


@query(f"select event_id, cast(trunc(cast(whole as double)) as bigint) as whole from ({_TEXTS}) as w")
def convert_int(t: Tables) -> DataFrame:
    return types.convert(t.sql(_WORDS), "whole", "int").data.select("event_id", "whole")


@query(f"select event_id, try_cast(moment as timestamp) as moment from ({_TEXTS}) as w")
def convert_datetime(t: Tables) -> DataFrame:
    converted = types.convert(t.sql(_WORDS), "moment", "datetime").data
    return converted.select("event_id", F.col("moment").cast("timestamp_ntz").alias("moment"))


@query("select event_id, event_type, cast(user_id as varchar) as user_id from events")
def convert_category_and_text(t: Tables) -> DataFrame:
    as_category = types.convert(t.events, "event_type", "category").data
    return types.convert(as_category, "user_id", "str").data.select("event_id", "event_type", "user_id")


_QUARTERS = "select quantile_cont(l_extendedprice, 0.25) as a, quantile_cont(l_extendedprice, 0.75) as b from lineitem"


@query(
    f"select lineitem.* from lineitem, ({_QUARTERS}) as q "
    "where l_extendedprice between a - 1.5 * (b - a) and b + 1.5 * (b - a)"
)
def outlier_iqr(t: Tables) -> DataFrame:
    return outliers.remove_iqr(t.lineitem, "l_extendedprice")


@query(
    "select events.* from events, (select quantile_cont(value, 0.25) as a, quantile_cont(value, 0.75) as b from events) "
    "as q where value between a - 1.5 * (b - a) and b + 1.5 * (b - a)"
)
def outlier_iqr_skewed(t: Tables) -> DataFrame:
    return outliers.remove_iqr(t.events, "value")


@query(
    "select lineitem.* from lineitem, (select quantile_cont(l_extendedprice, 0.013) as a, "
    "quantile_cont(l_extendedprice, 0.977) as b from lineitem) as q where l_extendedprice between a and b"
)
def outlier_percentage(t: Tables) -> DataFrame:
    return outliers.remove_percentage(t.lineitem, "l_extendedprice", 0.013, 0.023)


@query()
def outlier_isolation_forest(t: Tables) -> DataFrame:
    return outliers.remove_isolated(t.events, "value")


@query(
    "select 'Test' as \"Set\", cast(ceil(n * 0.2) as bigint) as rows from (select count(*) as n from orders) as o "
    "union all select 'Validation', cast(ceil((n - ceil(n * 0.2)) * (0.1 / 0.8)) as bigint) from (select count(*) as n "
    "from orders) as o union all select 'Train', cast(n - ceil(n * 0.2) - ceil((n - ceil(n * 0.2)) * (0.1 / 0.8)) as "
    "bigint) from (select count(*) as n from orders) as o"
)
def split_sizes(t: Tables) -> DataFrame:
    parts = split.train_test_val_split(t.orders, 0.2, 0.1)
    return parts.labelled().groupBy("Set").agg(F.count(F.lit(1)).alias("rows"))


@query("select * from orders")
def split_union(t: Tables) -> DataFrame:
    """The parts of a split together are the input, row by row."""
    return split.train_test_val_split(t.orders, 0.2, 0.1).labelled().drop("Set")


@query(f"select l_orderkey, l_linenumber, l_returnflag from ({plain(_FEW)}) as f")
def split_union_with_copies(t: Tables) -> DataFrame:
    return split.train_test_split(t.sql(_FEW), 0.3).labelled().drop("Set")


@query(
    "with c as (select o_orderpriority as s, count(*) as n from orders group by 1), "
    "t as (select cast(sum(n) as bigint) as total, cast(ceil(sum(n) * 0.2) as bigint) as k from c), "
    "q as (select s, n, k, floor(n * k / total) as f, n * k / total - floor(n * k / total) as r from c, t), "
    "z as (select s, n, f + case when row_number() over (order by r desc, n desc, s) <= k - sum(f) over () then 1 "
    "else 0 end as taken from q) "
    "select 'Test' as \"Set\", s as o_orderpriority, cast(taken as bigint) as rows from z union all "
    "select 'Train', s, cast(n - taken as bigint) from z"
)
def split_stratified(t: Tables) -> DataFrame:
    parts = split.train_test_split(t.orders, 0.2, stratify_col="o_orderpriority")
    return parts.labelled().groupBy("Set", "o_orderpriority").agg(F.count(F.lit(1)).alias("rows"))


@query("select * from orders")
def split_stratified_union(t: Tables) -> DataFrame:
    parts = split.train_test_val_split(t.orders, 0.2, 0.1, stratify_col="o_totalprice")
    return parts.labelled().drop("Set")


@query(
    "select o_orderkey, case when row_number() over (order by o_orderdate, o_orderkey) > "
    "(select count(*) - ceil(count(*) * 0.2) from orders) then 'Test' else 'Train' end as \"Set\" from orders"
)
def split_in_order(t: Tables) -> DataFrame:
    parts = split.train_test_split(t.orders, 0.2, shuffle=False, order_by=["o_orderdate", "o_orderkey"])
    return parts.labelled().select("o_orderkey", "Set")


_SENTINEL = "case when l_linenumber = 1 then 0 else 1e16 + 2 * (l_orderkey % 2) end"


@query(f"select quantile_cont(x, 0.25) as a, quantile_cont(x, 0.5) as b, quantile_cont(x, 0.9) as c from (select {_SENTINEL} as x from lineitem)")
def quantiles_far_apart(t: Tables) -> DataFrame:
    """A sentinel beside very large values next to each other, found by narrowing."""
    value = F.when(F.col("l_linenumber") == 1, 0.0).otherwise(F.lit(1e16) + 2 * (F.col("l_orderkey") % 2))
    wanted = {"x": (value, quantiles.linear(0.25, 0.5, 0.9))}
    found = quantiles.order_values(t.lineitem, wanted, fetched=64)["x"]
    return t.spark.range(1).select(*[F.lit(v).alias(n) for n, v in zip("abc", found, strict=True)])


_EDGES = ", ".join(f"quantile_cont(o_totalprice, {i / 10}) as e{i}" for i in range(11))


@query(
    "select o_orderkey, case "
    + " ".join(f"when o_totalprice <= e{i} then {i - 1}" for i in range(1, 11))
    + f" end as bin from orders, (select {_EDGES} from orders) as q"
)
def quantile_bins(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", split.quantile_bin(t.orders, "o_totalprice", 10).alias("bin"))


_SECONDS = "epoch_us(ts) / 1e6"


@query(
    " union all ".join(
        f"select '{c}' as \"column\", count({c}) as count, {unique} as \"unique\", {top} as top, {freq} as freq, "
        f"{stats} from events"
        for c, unique, top, freq, stats in (
            *[
                (
                    c, "cast(null as bigint)", "cast(null as varchar)", "cast(null as bigint)",
                    f"round(avg({c}), 3) as mean, round(stddev_samp({c}), 3) as std, cast(min({c}) as double) as min, "
                    f"round(quantile_cont(cast({c} as double), 0.25), 3) as p25, round(quantile_cont(cast({c} as double), 0.5), 3) as p50, "
                    f"round(quantile_cont(cast({c} as double), 0.75), 3) as p75, cast(max({c}) as double) as max",
                )
                for c in ("event_id", "user_id", "value")
            ],
            (
                "ts", "cast(null as bigint)", "cast(null as varchar)", "cast(null as bigint)",
                f"round(avg({_SECONDS}), 3) as mean, cast(null as double) as std, min({_SECONDS}) as min, "
                f"round(quantile_cont({_SECONDS}, 0.25), 3) as p25, round(quantile_cont({_SECONDS}, 0.5), 3) as p50, "
                f"round(quantile_cont({_SECONDS}, 0.75), 3) as p75, max({_SECONDS}) as max",
            ),
            *[
                (
                    c, f"count(distinct {c})",
                    f"(select {c} from events group by {c} order by count(*) desc, {c} limit 1)",
                    f"(select count(*) from events group by {c} order by count(*) desc limit 1)",
                    "null as mean, null as std, null as min, null as p25, null as p50, null as p75, null as max",
                )
                for c in ("event_type", "props")
            ],
        )
    )
)
def describe_all(t: Tables) -> DataFrame:
    return round_all(summaries.describe_all(t.events), ["mean", "std", "p25", "p50", "p75"], 3)


@query(
    "select 'c_custkey' as \"column\", count(distinct c_custkey) as distinct_values from customer union all "
    "select 'c_nationkey', count(distinct c_nationkey) from customer union all "
    "select 'c_mktsegment', count(distinct c_mktsegment) from customer"
)
def distinct_counts(t: Tables) -> DataFrame:
    return summaries.distinct_counts(t.customer.select("c_custkey", "c_nationkey", "c_mktsegment"))


@query(
    "select k.*, n.present from (select column_name as \"column\", column_type in ('BIGINT', 'INTEGER', 'DOUBLE') as numeric, "
    "column_type = 'VARCHAR' as text, column_type like 'TIMESTAMP%' as temporal from (describe lineitem)) as k join "
    "(unpivot (select count(columns(*)) from lineitem) on columns(*) into name \"column\" value present) as n using (\"column\")"
)
def column_kinds(t: Tables) -> DataFrame:
    """What kind each column counts as, and how many of its values are present."""
    rows = t.lineitem.agg(F.count(F.lit(1))).first()[0]
    present = missing.missing_report(t.lineitem).select("column", (F.lit(rows) - F.col("missing")).alias("present"))
    return frames.kinds_report(t.lineitem).join(present, "column")


@query("select event_type, count(*) as count from events group by event_type")
def value_counts(t: Tables) -> DataFrame:
    return summaries.value_counts(t.events, "event_type")


@query(
    " union all ".join(
        f"select '{c}' as \"column\", round(avg({c}), 6) as mean, round(quantile_cont(cast({c} as double), 0.5), 6) as median, "
        f"(select cast({c} as double) from events group by {c} order by count(*) desc, {c} limit 1) as mode from events"
        for c in ("user_id", "value")
    )
)
def column_statistics(t: Tables) -> DataFrame:
    return round_all(summaries.column_statistics(t.events.select("user_id", "value")), ["mean", "median"])


@query(
    "select 'All' as \"Set\", (select count(*) from events where value < 100) as rows, cast(5 as bigint) as \"columns\", "
    "(select count(*) filter (where value < 100) - count(*) from events) as rows_change, cast(-1 as bigint) "
    "as columns_change"
)
def shape_report(t: Tables) -> DataFrame:
    return columns.shape_report(t.events, t.events.filter("value < 100").drop("props"))


@query("select * from orders order by o_orderdate desc, o_orderkey desc limit 5")
def tail(t: Tables) -> DataFrame:
    dated = t.orders.withColumn("at", F.struct("o_orderdate", "o_orderkey"))
    return columns.tail(dated, "at").drop("at")
