"""Files in and out, and whole loads from files to the final tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalog import places, sales
from catalog.registry import Tables, plain, query, round_all
from quern.operators import columns, power, split, summaries
from quern.plans import census, warehouse
from quern.sources import csv, tables
from quern.sources.tables import LoadAudit, Store
from quern.staging import new_path

_DERIVED = {
    "crm_cust_info": sales.CUSTOMERS,
    "crm_prd_info": sales.PRODUCTS,
    "crm_sales_details": sales.SALES,
    "erp_loc_a101": sales.LOCATIONS,
    "erp_cust_az12": sales.DEMOGRAPHICS,
    "erp_px_cat_g1v2": sales.CATEGORIES,
}


def _sales_files(t: Tables) -> str:
    """The source tables as files without quotes."""
    folder = new_path(t.spark)
    for table, derivation in _DERIVED.items():
        df = t.sql(derivation)
        df = df.drop("o_orderkey")
        df.write.csv(f"{folder}/{warehouse.FILES[table]}", header=True, quote="", emptyValue="", nullValue="",
                     ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    return folder


@query("select o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority from orders")
def csv_round_trip(t: Tables) -> DataFrame:
    """Written with a header, read back by position under a declared schema."""
    path = new_path(t.spark)
    csv.write_csv(t.orders.withColumnRenamed("o_orderkey", "ANOTHER_NAME"), path)
    kinds = ", ".join(f"{name} {kind}" for name, kind in t.orders.dtypes)
    return csv.read_positional(t.spark, path, kinds)


_AWKWARD = "'  ' || text || ' ,\"' || chr(10) || 'end  '"


@query(f"select doc_id, {_AWKWARD} as text from documents")
def csv_text_round_trip(t: Tables) -> DataFrame:
    """Outer blanks, quotes, commas and line breaks inside quotes survive, read by position and by name alike."""
    path = new_path(t.spark)
    padded = F.concat(F.lit("  "), F.col("text"), F.lit(' ,"\nend  '))
    csv.write_csv(t.documents.select("doc_id", padded.alias("text")), path)
    by_name = csv.read_text_columns(t.spark, path).select(F.col("doc_id").cast("bigint"), F.col("text").alias("other"))
    by_place = csv.read_positional(t.spark, path, "doc_id bigint, text string", quoted=True)
    return by_place.join(by_name, "doc_id").filter("text = other").drop("other")


@query("select page_id, html from pages")
def csv_html_round_trip(t: Tables) -> DataFrame:
    path = new_path(t.spark)
    csv.write_csv(t.pages.select("page_id", "html"), path)
    return csv.read_inferred(t.spark, path).select(F.col("page_id").cast("bigint"), "html")


@query("select event_id, user_id, nullif(props, '') as props from events")
def csv_quoted_round_trip(t: Tables) -> DataFrame:
    """Text with quotes and commas in it survives."""
    path = new_path(t.spark)
    csv.write_csv(t.events.select("event_id", "user_id", "props"), path)
    return csv.read_positional(t.spark, path, "event_id bigint, user_id bigint, props string", quoted=True)


@query("select event_id, user_id, value, event_type from events")
def csv_inferred(t: Tables) -> DataFrame:
    path = new_path(t.spark)
    csv.write_csv(t.events.select("event_id", "user_id", "value", "event_type"), path)
    inferred = csv.read_inferred(t.spark, path)
    return inferred.withColumns({c: F.col(c).cast("bigint") for c in ("event_id", "user_id")})


@query("select o_orderkey, o_totalprice from orders")
def export_of_splits(t: Tables) -> DataFrame:
    """The files of all parts together hold the input."""
    parts = split.train_test_val_split(t.orders.select("o_orderkey", "o_totalprice"), 0.2, 0.1)
    paths = csv.export(parts, f"{new_path(t.spark)}/orders.csv")
    schema = "o_orderkey bigint, o_totalprice double"
    frames = [csv.read_positional(t.spark, path, schema) for path in paths]
    return frames[0].unionByName(frames[1]).unionByName(frames[2])


_LOADED = {
    "crm_cust_info": ("orders", "count(distinct case when o_orderkey % 97 <> 0 then o_custkey end)"),
    "crm_prd_info": ("orders", "count(*)"),
    "crm_sales_details": ("lineitem", "count(*)"),
    "erp_cust_az12": ("customer", "count(*)"),
    "erp_loc_a101": ("customer", "count(*)"),
    "erp_px_cat_g1v2": ("part", "count(*)"),
}


@query(
    " union all ".join(
        f"select 'bronze' as layer, '{table}' as \"table\", count(*) as rows, 'loaded' as status from {source} union all "
        f"select 'silver', '{table}', {kept}, 'loaded' from {source}"
        for table, (source, kept) in _LOADED.items()
    )
)
def load_audit(t: Tables) -> DataFrame:
    """Rows recorded while the lower layers of the warehouse are loaded from files."""
    store, audit = Store(new_path(t.spark)), LoadAudit()
    warehouse.load_bronze(t.spark, _sales_files(t), store, audit)
    warehouse.load_silver(t.spark, store, sales.AS_OF, audit)
    return audit.frame(t.spark).select("layer", "table", "rows", "status")


@query("select o_orderkey, o_custkey, o_totalprice from orders")
def failed_load_keeps_rows(t: Tables) -> DataFrame:
    """A load that breaks off half-way and one with a key twice leave the version before them."""
    store, audit = Store(new_path(t.spark)), LoadAudit()
    rows = t.orders.select("o_orderkey", "o_custkey", "o_totalprice")
    breaks = F.when(F.col("o_orderkey") % 1000 == 7, F.raise_error(F.lit("unreadable"))).otherwise(F.col("o_totalprice"))
    again = rows.unionAll(rows.filter("o_orderkey % 1000 = 7"))
    loads = (rows, rows.withColumn("o_totalprice", breaks.cast("double") * 2), again)
    for load in loads:
        try:
            audit.run("silver", "orders", load, lambda df: store.refresh(df, "silver", "orders", unique=("o_orderkey",)))
        except Exception:  # recorded, and asked for below
            continue
    if [r.status for r in audit.records] != ["loaded", "failed", "failed"]:
        raise ValueError(f"outcomes of the loads: {audit.records}")
    return store.read(t.spark, "silver", "orders")


_CLUSTERED = {"l_quantity": ("l_quantity <= 3", "l_quantity_min <= 3"), "l_shipdate": (
    "l_shipdate < timestamp '1992-06-01'", "l_shipdate_min < timestamp '1992-06-01'")}


@query(
    " union all ".join(
        f"select '{key}' as key, count(*) as rows, true as most_files_left_out from lineitem where {asked}"
        for key, (asked, _) in _CLUSTERED.items()
    )
)
def clustered_files(t: Tables) -> DataFrame:
    """Filters on either of two keys need few files of a table clustered by both, as the files' own ranges say."""
    store = Store(new_path(t.spark))
    rows = t.lineitem.select("l_orderkey", "l_quantity", "l_shipdate")
    store.refresh(rows, "silver", "lineitem", cluster_by=("l_quantity", "l_shipdate"), files=32)
    files = store.file_ranges(t.spark, "silver", "lineitem", _CLUSTERED)
    found = []
    for key, (asked, needed) in _CLUSTERED.items():
        hit = store.read(t.spark, "silver", "lineitem").filter(asked).agg(F.count(F.lit(1)).alias("rows"))
        left = files.agg((F.count_if(F.expr(needed)) * 2 < F.count(F.lit(1))).alias("most_files_left_out"))
        found.append(hit.crossJoin(left).select(F.lit(key).alias("key"), "rows", "most_files_left_out"))
    return found[0].unionAll(found[1])


@query(
    f"select product_number, product_name, category, cost, product_line, start_date, product_key from ({sales.DIM_PRODUCTS})"
    " as p"
)
def warehouse_from_files(t: Tables) -> DataFrame:
    """All layers from files; the product dimension is read from the written store."""
    store = Store(new_path(t.spark))
    warehouse.load_bronze(t.spark, _sales_files(t), store)
    warehouse.load_silver(t.spark, store, sales.AS_OF)
    warehouse.load_gold(t.spark, store)
    products = store.read(t.spark, "gold", "dim_products")
    return products.select(
        "product_number", "product_name", "category", "cost", "product_line", "start_date", "product_key"
    )


@query(places.FACT)
def census_from_files(t: Tables) -> DataFrame:
    """Four extracts written as files, loaded through all layers."""
    folder, store = new_path(t.spark), Store(new_path(t.spark))
    raw = t.sql(places.RAW)
    for table, extract in census.EXTRACTS.items():
        csv.write_csv(extract(raw).select(*_order(table)), f"{folder}/{census.FILES[table]}")
    census.load_bronze(t.spark, folder, store)
    census.load_silver(t.spark, store)
    census.load_gold(t.spark, store)
    fact = round_all(store.read(t.spark, "gold", "fact_indigenous_education"), places._IND + places._EDU)
    counts = [*census.POPULATION_NAMES.values(), *census.INDIGENOUS_NAMES.values()]
    counts += [c for c in census.EDUCATION_NAMES.values() if c != "avg_years_of_schooling_over_15"]
    return fact.withColumns({c: F.col(c).cast("bigint") for c in counts})


def _order(table: str) -> list[str]:
    return [part.split()[0] for part in census.BRONZE[table].split(", ")]


@query("select min(n) as smallest from (select count(*) as n from orders group by o_custkey) as c")
def smallest_class(t: Tables) -> DataFrame:
    return summaries.value_counts(t.orders, "o_custkey").agg(F.min("count").alias("smallest"))


@query("select bool_or(c_acctbal < 0) as negative, bool_or(c_acctbal <= -5000) as very from customer")
def any_negative(t: Tables) -> DataFrame:
    found = (power.any_below(t.customer, "c_acctbal"), power.any_below(t.customer, "c_acctbal", -5000.0, or_equal=True))
    return t.spark.range(1).select(F.lit(found[0]).alias("negative"), F.lit(found[1]).alias("very"))


@query(f"select * from ({places.FACT}) as f order by idx")
def ordered_export(t: Tables) -> DataFrame:
    return census.ordered_export(places.fact_indigenous_education(t))


@query(f"select * from ({plain(sales.CATEGORIES)}) as c limit 5")
def head(t: Tables) -> DataFrame:
    return columns.head(t.sql(sales.CATEGORIES))


@query("select c_nationkey, count(*) as rows, sum(c_acctbal) > 0 as solvent from customer group by all")
def read_through_view(t: Tables) -> DataFrame:
    """A layer with a table made from a schema, loaded, and read through a view."""
    root = new_path(t.spark)
    layer = "layer_" + root[-12:]
    tables.create_layers(t.spark, [layer], root)
    tables.recreate_table(t.spark, f"{layer}.customers", t.customer.schema)
    tables.append_table(t.customer, f"{layer}.customers")
    loaded = t.spark.table(f"{layer}.customers")
    tables.publish_view(loaded.groupBy("c_nationkey").agg(
        F.count(F.lit(1)).alias("rows"), (F.sum("c_acctbal") > 0).alias("solvent")
    ), f"{layer}_solvency")
    return t.spark.table(f"{layer}_solvency")
