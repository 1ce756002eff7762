"""Sales warehouse: customer, product and sales records of two source systems to a star schema."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.functions.codes import map_codes
from quern.functions.dates import date_from_number, past_only
from quern.functions.numbers import repaired_price, repaired_sales
from quern.functions.text import strip_prefix, tail_from
from quern.operators.ordering import Order, end_date, global_index, latest_per_key, lookup_keys
from quern.sources.csv import read_positional
from quern.sources.tables import LoadAudit, Store


# Column names and types of the source tables, in file order.
BRONZE = {
    "crm_cust_info": (
        "cst_id int, cst_key string, cst_firstname string, cst_lastname string, cst_marital_status string, "
        "cst_gndr string, cst_create_date date"
    ),
    "crm_prd_info": (
        "prd_id int, prd_key string, prd_nm string, prd_cost int, prd_line string, "
        "prd_start_dt timestamp_ntz, prd_end_dt timestamp_ntz"
    ),
    "crm_sales_details": (
        "sls_ord_num string, sls_prd_key string, sls_cust_id int, sls_order_dt int, sls_ship_dt int, "
        "sls_due_dt int, sls_sales int, sls_quantity int, sls_price int"
    ),
    "erp_loc_a101": ("cid string, cntry string"),
    "erp_cust_az12": "cid string, bdate date, gen string",
    "erp_px_cat_g1v2": "id string, cat string, subcat string, maintenance string",
}

# The cleansed tables add a category id, hold dates as dates, and end with the time of the load.
_LOADED = ", dwh_create_date timestamp"
SILVER = {
    "crm_cust_info": BRONZE["crm_cust_info"] + _LOADED,
    "crm_prd_info": (
        "prd_id int, cat_id string, prd_key string, prd_nm string, prd_cost int, prd_line string, "
        "prd_start_dt date, prd_end_dt date" + _LOADED
    ),
    "crm_sales_details": (
        "sls_ord_num string, sls_prd_key string, sls_cust_id int, sls_order_dt date, sls_ship_dt date, "
        "sls_due_dt date, sls_sales int, sls_quantity int, sls_price int" + _LOADED
    ),
    "erp_loc_a101": BRONZE["erp_loc_a101"] + _LOADED,
    "erp_cust_az12": BRONZE["erp_cust_az12"] + _LOADED,
    "erp_px_cat_g1v2": BRONZE["erp_px_cat_g1v2"] + _LOADED,
}
GOLD = ("dim_customers", "dim_products", "fact_sales")

# Where each source table lies below the data folder.
FILES = {
    "crm_cust_info": "source_crm/cust_info.csv",
    "crm_prd_info": "source_crm/prd_info.csv",
    "crm_sales_details": "source_crm/sales_details.csv",
    "erp_loc_a101": "source_erp/loc_a101.csv",
    "erp_cust_az12": "source_erp/cust_az12.csv",
    "erp_px_cat_g1v2": "source_erp/px_cat_g1v2.csv",
}

# Labels of the codes.
UNKNOWN = "n/a"
MARITAL_STATUS = {"S": "Single", "M": "Married"}
GENDER = {"F": "Female", "M": "Male"}
GENDER_WORDS = {"F": "Female", "FEMALE": "Female", "M": "Male", "MALE": "Male"}
PRODUCT_LINE = {"M": "Mountain", "R": "Road", "S": "Other Sales", "T": "Touring"}
COUNTRY = {"DE": "Germany", "US": "United States", "USA": "United States"}


def clean_customers(bronze: DataFrame, tie_breakers: Order = ()) -> DataFrame:
    """The newest record of each customer with readable codes."""
    newest = latest_per_key(bronze, ["cst_id"], "cst_create_date", tie_breakers)
    return newest.select(
        "cst_id",
        "cst_key",
        F.trim("cst_firstname").alias("cst_firstname"),
        F.trim("cst_lastname").alias("cst_lastname"),
        map_codes(F.col("cst_marital_status"), MARITAL_STATUS, UNKNOWN).alias("cst_marital_status"),
        map_codes(F.col("cst_gndr"), GENDER, UNKNOWN).alias("cst_gndr"),
        "cst_create_date",
    )


def clean_products(bronze: DataFrame, tie_breakers: Order = ("prd_id",)) -> DataFrame:
    """Category and product key taken apart; each version ends the day before the next one starts."""
    versions = end_date(bronze.drop("prd_end_dt"), ["prd_key"], "prd_start_dt", "prd_end_dt", tie_breakers)
    return versions.select(
        "prd_id",
        F.replace(F.substring("prd_key", 1, 5), F.lit("-"), F.lit("_")).alias("cat_id"),
        tail_from(F.col("prd_key"), 7).alias("prd_key"),
        "prd_nm",
        F.coalesce("prd_cost", F.lit(0)).alias("prd_cost"),
        map_codes(F.col("prd_line"), PRODUCT_LINE, UNKNOWN).alias("prd_line"),
        F.col("prd_start_dt").cast("date").alias("prd_start_dt"),
        "prd_end_dt",
    )


def clean_sales(bronze: DataFrame) -> DataFrame:
    """Dates from numbers; amounts and prices made consistent."""
    amounts = ("sls_sales", "sls_quantity", "sls_price")
    return bronze.select(
        "sls_ord_num",
        "sls_prd_key",
        "sls_cust_id",
        *[date_from_number(F.col(c)).alias(c) for c in ("sls_order_dt", "sls_ship_dt", "sls_due_dt")],
        repaired_sales(*amounts).alias("sls_sales"),
        "sls_quantity",
        repaired_price(*amounts).cast(bronze.schema["sls_price"].dataType).alias("sls_price"),
    )


def clean_demographics(bronze: DataFrame, as_of: Column | None = None) -> DataFrame:
    return bronze.select(
        strip_prefix(F.col("cid"), "NAS").alias("cid"),
        past_only(F.col("bdate"), as_of).alias("bdate"),
        map_codes(F.col("gen"), GENDER_WORDS, UNKNOWN).alias("gen"),
    )


def clean_locations(bronze: DataFrame) -> DataFrame:
    country = F.trim("cntry")
    kept = F.when(country.isNull() | (country == ""), F.lit(UNKNOWN)).otherwise(country)
    return bronze.select(
        F.replace("cid", F.lit("-"), F.lit("")).alias("cid"),
        map_codes(country, COUNTRY, kept, fold=False).alias("cntry"),
    )


def clean_categories(bronze: DataFrame) -> DataFrame:
    return bronze.select("id", "cat", "subcat", "maintenance")


CLEANERS = {
    "crm_cust_info": clean_customers,
    "crm_prd_info": clean_products,
    "crm_sales_details": clean_sales,
    "erp_cust_az12": clean_demographics,
    "erp_loc_a101": clean_locations,
    "erp_px_cat_g1v2": clean_categories,
}


def _left(left: DataFrame, right: DataFrame, key: str, other: str, ignore_case: bool) -> DataFrame:
    a, b = left[key], right[other]
    if ignore_case:
        a, b = F.upper(F.rtrim(a)), F.upper(F.rtrim(b))
    return left.join(right, a == b, "left").drop(right[other])


def dim_customers(
    customers: DataFrame, demographics: DataFrame, locations: DataFrame, ignore_case: bool = False
) -> DataFrame:
    """Gender comes from the customer record, from the demographics where that has none."""
    joined = _left(customers, demographics, "cst_key", "cid", ignore_case)
    joined = _left(joined, locations, "cst_key", "cid", ignore_case)
    gender = F.when(F.col("cst_gndr") != UNKNOWN, F.col("cst_gndr")).otherwise(F.coalesce("gen", F.lit(UNKNOWN)))
    named = joined.select(
        F.col("cst_id").alias("customer_id"),
        F.col("cst_key").alias("customer_number"),
        F.col("cst_firstname").alias("first_name"),
        F.col("cst_lastname").alias("last_name"),
        F.col("cntry").alias("country"),
        F.col("cst_marital_status").alias("marital_status"),
        gender.alias("gender"),
        F.col("bdate").alias("birthdate"),
        F.col("cst_create_date").alias("create_date"),
    )
    numbered = global_index(named, ["customer_id"], "customer_key")
    return numbered.select("customer_key", *named.columns)


def dim_products(products: DataFrame, categories: DataFrame, ignore_case: bool = False) -> DataFrame:
    """Current versions with their category."""
    current = products.filter(F.col("prd_end_dt").isNull())
    joined = _left(current, categories, "cat_id", "id", ignore_case)
    named = joined.select(
        F.col("prd_id").alias("product_id"),
        F.col("prd_key").alias("product_number"),
        F.col("prd_nm").alias("product_name"),
        F.col("cat_id").alias("category_id"),
        F.col("cat").alias("category"),
        F.col("subcat").alias("subcategory"),
        "maintenance",
        F.col("prd_cost").alias("cost"),
        F.col("prd_line").alias("product_line"),
        F.col("prd_start_dt").alias("start_date"),
    )
    numbered = global_index(named, ["start_date", "product_number"], "product_key")
    return numbered.select("product_key", *named.columns)


def fact_sales(sales: DataFrame, products: DataFrame, customers: DataFrame, ignore_case: bool = False) -> DataFrame:
    with_product = lookup_keys(sales, products, "sls_prd_key", "product_number", "product_key", ignore_case)
    with_both = lookup_keys(with_product, customers, "sls_cust_id", "customer_id", "customer_key")
    return with_both.select(
        F.col("sls_ord_num").alias("order_number"),
        "product_key",
        "customer_key",
        F.col("sls_order_dt").alias("order_date"),
        F.col("sls_ship_dt").alias("shipping_date"),
        F.col("sls_due_dt").alias("due_date"),
        F.col("sls_sales").alias("sales_amount"),
        F.col("sls_quantity").alias("quantity"),
        F.col("sls_price").alias("price"),
    )


def unmatched_keys(fact: DataFrame, surrogates: tuple[str, ...]) -> DataFrame:
    """How many fact rows found no partner in each dimension."""
    return fact.agg(
        F.count(F.lit(1)).alias("rows"), *[F.count_if(F.col(k).isNull()).alias(f"no_{k}") for k in surrogates]
    )


def impossible_dates(sales: DataFrame) -> DataFrame:
    """How many eight-digit numbers are not days of the calendar, per date column."""
    counts = []
    for name in ("sls_order_dt", "sls_ship_dt", "sls_due_dt"):
        value = F.col(name)
        coded = (value != 0) & (F.length(value.cast("string")) == 8)
        counts.append(F.count_if(coded & date_from_number(value).isNull()).alias(name))
    return sales.agg(*counts)


def load_bronze(spark: SparkSession, folder: str, store: Store, audit: LoadAudit | None = None) -> LoadAudit:
    """Replace every bronze table by the content of its file."""
    audit = audit or LoadAudit()
    root = folder.rstrip("/")
    raw = {table: read_positional(spark, f"{root}/{FILES[table]}", schema) for table, schema in BRONZE.items()}
    audit.run_all("bronze", raw, store.refresh)
    return audit


def load_silver(
    spark: SparkSession, store: Store, as_of: dt.datetime | None = None, audit: LoadAudit | None = None
) -> LoadAudit:
    """Replace every silver table by its cleansed bronze rows, stamped with the time of the load."""
    audit = audit or LoadAudit()
    stamp = F.lit(as_of or dt.datetime.now())
    rows = {
        table: clean(store.read(spark, "bronze", table)).withColumn("dwh_create_date", stamp)
        for table, clean in CLEANERS.items()
    }
    audit.run_all("silver", rows, store.refresh)
    return audit


def load_gold(spark: SparkSession, store: Store, audit: LoadAudit | None = None) -> LoadAudit:
    """Write the star schema, so that its surrogate keys stay what they are."""
    audit = audit or LoadAudit()

    def silver(table: str) -> DataFrame:
        return store.read(spark, "silver", table)

    customers = dim_customers(silver("crm_cust_info"), silver("erp_cust_az12"), silver("erp_loc_a101"))
    audit.run("gold", "dim_customers", customers, lambda df: store.refresh(df, "gold", "dim_customers"))
    products = dim_products(silver("crm_prd_info"), silver("erp_px_cat_g1v2"))
    audit.run("gold", "dim_products", products, lambda df: store.refresh(df, "gold", "dim_products"))
    facts = fact_sales(
        silver("crm_sales_details"),
        store.read(spark, "gold", "dim_products"),
        store.read(spark, "gold", "dim_customers"),
    )
    audit.run("gold", "fact_sales", facts, lambda df: store.refresh(df, "gold", "fact_sales"))
    return audit
