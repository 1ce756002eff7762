"""Warehouse plans on records derived from the test tables."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalog.registry import Tables, plain, query
from quern.operators import ordering
from quern.plans import warehouse

AS_OF = datetime(2024, 1, 1)

CUSTOMERS = """
select case when o_orderkey % 97 = 0 then null else cast(o_custkey as int) end as cst_id,
  'AW' || lpad(cast(o_custkey as string), 8, '0') as cst_key,
  '  First' || cast(o_custkey % 50 as string) || ' ' as cst_firstname,
  'Last' || cast(o_orderkey % 70 as string) || '   ' as cst_lastname,
  case o_orderkey % 5 when 0 then 's' when 1 then ' M ' when 2 then null when 3 then 'X' else 'S' end
    as cst_marital_status,
  case o_orderkey % 4 when 0 then 'f' when 1 then 'M ' when 2 then null else 'Q' end as cst_gndr,
  cast(o_orderdate as date) as cst_create_date,
  o_orderkey
from {orders}
"""

PRODUCTS = """
select cast(o_orderkey as int) as prd_id,
  case o_custkey % 4 when 0 then 'CO-RF' when 1 then 'AC-HE' when 2 then 'BI-MB' else 'CO-PE' end
    || '-P' || lpad(cast(o_custkey as string), 7, '0') as prd_key,
  'Product ' || cast(o_custkey as string) as prd_nm,
  case when o_orderkey % 11 = 0 then null else cast(floor(o_totalprice) as int) end as prd_cost,
  case o_orderkey % 6 when 0 then 'R ' when 1 then 's' when 2 then 'M' when 3 then ' t' when 4 then null else 'X' end
    as prd_line,
  o_orderdate as prd_start_dt,
  o_orderdate as prd_end_dt
from {orders}
"""

SALES = """
select ord_num as sls_ord_num, prd_key as sls_prd_key, cust_id as sls_cust_id, order_dt as sls_order_dt,
  ship_dt as sls_ship_dt, due_dt as sls_due_dt,
  case when l_orderkey % 9 = 0 then null when l_orderkey % 9 = 1 then -quantity * price
    when l_orderkey % 9 = 2 then quantity * price + 5 when l_orderkey % 9 = 3 then 0 else quantity * price end
    as sls_sales,
  case when l_linenumber = 7 and l_orderkey % 4 = 0 then 0 else quantity end as sls_quantity,
  case when l_orderkey % 8 = 0 then null when l_orderkey % 8 = 1 then -price when l_orderkey % 8 = 2 then 0
    else price end as sls_price
from (
  select l_orderkey, l_linenumber,
    'SO' || cast(l_orderkey as string) as ord_num,
    'P' || lpad(cast(l_partkey as string), 7, '0') as prd_key,
    cast(l_suppkey * 16 + l_linenumber as int) as cust_id,
    case when l_orderkey % 13 = 0 then 0 when l_orderkey % 17 = 0 then 12345 when l_orderkey % 19 = 0 then 20230231
      else cast(year(l_shipdate) * 10000 + month(l_shipdate) * 100 + day(l_shipdate) as int) end as order_dt,
    cast(year(l_shipdate) * 10000 + month(l_shipdate) * 100 + day(l_shipdate) as int) as ship_dt,
    case when l_linenumber = 3 then null
      else cast(year(l_shipdate) * 10000 + month(l_shipdate) * 100 + day(l_shipdate) as int) end as due_dt,
    cast(l_quantity as int) as quantity,
    cast(floor(l_extendedprice / l_quantity) as int) as price
  from {lineitem}
) as l
"""

DEMOGRAPHICS = """
select case when c_custkey % 3 = 0 then 'NAS' else '' end || 'AW' || lpad(cast(c_custkey as string), 8, '0') as cid,
  make_date(cast(1930 + c_custkey % 120 as int), cast(1 + c_custkey % 12 as int), cast(1 + c_custkey % 28 as int))
    as bdate,
  case c_custkey % 6 when 0 then 'F' when 1 then 'Female' when 2 then ' male ' when 3 then 'm' when 4 then null
    else '?' end as gen
from {customer}
"""

LOCATIONS = """
select 'AW-' || lpad(cast(c_custkey as string), 8, '0') as cid,
  case c_custkey % 8 when 0 then 'DE' when 1 then 'US' when 2 then 'USA ' when 3 then '' when 4 then '  '
    when 5 then null when 6 then ' France ' else 'Germany' end as cntry
from {customer}
"""

CATEGORIES = """
select case p_partkey when 0 then 'CO_RF' when 1 then 'AC_HE' when 2 then 'BI_MB'
    else 'ZZ_' || cast(p_partkey as string) end as id,
  p_type as cat, p_brand as subcat, case when p_partkey % 2 = 0 then 'Yes' else 'No' end as maintenance
from {part}
"""

SILVER_CUSTOMERS = """
select cst_id, cst_key, trim(cst_firstname) as cst_firstname, trim(cst_lastname) as cst_lastname,
  case upper(trim(cst_marital_status)) when 'S' then 'Single' when 'M' then 'Married' else 'n/a' end
    as cst_marital_status,
  case upper(trim(cst_gndr)) when 'F' then 'Female' when 'M' then 'Male' else 'n/a' end as cst_gndr,
  cst_create_date
from (select *, row_number() over (partition by cst_id order by cst_create_date desc nulls last, o_orderkey desc) as r
  from (%s) as b where cst_id is not null) as n
where r = 1
""" % plain(CUSTOMERS)

SILVER_PRODUCTS = """
select prd_id, replace(substr(prd_key, 1, 5), '-', '_') as cat_id, substr(prd_key, 7) as prd_key, prd_nm,
  coalesce(prd_cost, 0) as prd_cost,
  case upper(trim(prd_line)) when 'M' then 'Mountain' when 'R' then 'Road' when 'S' then 'Other Sales'
    when 'T' then 'Touring' else 'n/a' end as prd_line,
  cast(prd_start_dt as date) as prd_start_dt,
  cast(lead(prd_start_dt) over (partition by prd_key order by prd_start_dt, prd_id) - interval 1 day as date)
    as prd_end_dt
from (%s) as b
""" % plain(PRODUCTS)

SILVER_SALES = """
select sls_ord_num, sls_prd_key, sls_cust_id, %s,
  cast(case when sls_sales is null or sls_sales <= 0 or sls_sales <> sls_quantity * abs(sls_price)
    then sls_quantity * abs(sls_price) else sls_sales end as int) as sls_sales,
  sls_quantity,
  cast(case when sls_price is null or sls_price <= 0 then sls_sales // nullif(sls_quantity, 0) else sls_price end
    as int) as sls_price
from (%s) as b
""" % (
    ", ".join(
        f"case when {c} <> 0 and length(cast({c} as varchar)) = 8 "
        f"then cast(try_strptime(cast({c} as varchar), '%Y%m%d') as date) end as {c}"
        for c in ("sls_order_dt", "sls_ship_dt", "sls_due_dt")
    ),
    plain(SALES),
)

SILVER_DEMOGRAPHICS = """
select case when cid like 'NAS%%' then substr(cid, 4) else cid end as cid,
  case when bdate > date '2024-01-01' then null else bdate end as bdate,
  case when upper(trim(gen)) in ('F', 'FEMALE') then 'Female' when upper(trim(gen)) in ('M', 'MALE') then 'Male'
    else 'n/a' end as gen
from (%s) as b
""" % plain(DEMOGRAPHICS)

SILVER_LOCATIONS = """
select replace(cid, '-', '') as cid,
  case when trim(cntry) = 'DE' then 'Germany' when trim(cntry) in ('US', 'USA') then 'United States'
    when cntry is null or trim(cntry) = '' then 'n/a' else trim(cntry) end as cntry
from (%s) as b
""" % plain(LOCATIONS)

DIM_CUSTOMERS = f"""
select row_number() over (order by cst_id) as customer_key, cst_id as customer_id, cst_key as customer_number,
  cst_firstname as first_name, cst_lastname as last_name, cntry as country, cst_marital_status as marital_status,
  case when cst_gndr <> 'n/a' then cst_gndr else coalesce(gen, 'n/a') end as gender, bdate as birthdate,
  cst_create_date as create_date
from ({SILVER_CUSTOMERS}) as c
left join ({SILVER_DEMOGRAPHICS}) as d on c.cst_key = d.cid
left join ({SILVER_LOCATIONS}) as l on c.cst_key = l.cid
"""

DIM_PRODUCTS = f"""
select row_number() over (order by prd_start_dt, prd_key) as product_key, prd_id as product_id,
  prd_key as product_number, prd_nm as product_name, cat_id as category_id, cat as category, subcat as subcategory,
  maintenance, prd_cost as cost, prd_line as product_line, prd_start_dt as start_date
from ({SILVER_PRODUCTS}) as p left join ({plain(CATEGORIES)}) as c on p.cat_id = c.id
where prd_end_dt is null
"""

FACT_SALES = f"""
select sls_ord_num as order_number, product_key, customer_key, sls_order_dt as order_date,
  sls_ship_dt as shipping_date, sls_due_dt as due_date, sls_sales as sales_amount, sls_quantity as quantity,
  sls_price as price
from ({SILVER_SALES}) as s
left join ({DIM_PRODUCTS}) as p on s.sls_prd_key = p.product_number
left join ({DIM_CUSTOMERS}) as c on s.sls_cust_id = c.customer_id
"""


def _customers(t: Tables) -> DataFrame:
    return warehouse.clean_customers(t.sql(CUSTOMERS), [("o_orderkey", "desc")])


def _dim_customers(t: Tables) -> DataFrame:
    demographics = warehouse.clean_demographics(t.sql(DEMOGRAPHICS), F.lit(AS_OF))
    return warehouse.dim_customers(_customers(t), demographics, warehouse.clean_locations(t.sql(LOCATIONS)))


def _dim_products(t: Tables) -> DataFrame:
    products = warehouse.clean_products(t.sql(PRODUCTS))
    return warehouse.dim_products(products, warehouse.clean_categories(t.sql(CATEGORIES)))


@query(SILVER_CUSTOMERS)
def silver_customers(t: Tables) -> DataFrame:
    return _customers(t)


@query(SILVER_PRODUCTS)
def silver_products(t: Tables) -> DataFrame:
    return warehouse.clean_products(t.sql(PRODUCTS))


@query(SILVER_SALES)
def silver_sales(t: Tables) -> DataFrame:
    return warehouse.clean_sales(t.sql(SALES))


@query(SILVER_DEMOGRAPHICS)
def silver_demographics(t: Tables) -> DataFrame:
    return warehouse.clean_demographics(t.sql(DEMOGRAPHICS), F.lit(AS_OF))


@query(SILVER_LOCATIONS)
def silver_locations(t: Tables) -> DataFrame:
    return warehouse.clean_locations(t.sql(LOCATIONS))


@query(plain(CATEGORIES))
def silver_categories(t: Tables) -> DataFrame:
    return warehouse.clean_categories(t.sql(CATEGORIES))


@query(DIM_CUSTOMERS)
def dim_customers(t: Tables) -> DataFrame:
    return _dim_customers(t)


@query(DIM_PRODUCTS)
def dim_products(t: Tables) -> DataFrame:
    return _dim_products(t)


@query(FACT_SALES)
def fact_sales(t: Tables) -> DataFrame:
    return warehouse.fact_sales(warehouse.clean_sales(t.sql(SALES)), _dim_products(t), _dim_customers(t))


@query(
    f"select count(*) as rows, count(*) filter (where product_key is null) as no_product_key, "
    f"count(*) filter (where customer_key is null) as no_customer_key from ({FACT_SALES}) as f"
)
def unmatched_fact_keys(t: Tables) -> DataFrame:
    fact = warehouse.fact_sales(warehouse.clean_sales(t.sql(SALES)), _dim_products(t), _dim_customers(t))
    return warehouse.unmatched_keys(fact, ("product_key", "customer_key"))


@query(
    "select count(*) filter (where sls_order_dt <> 0 and length(cast(sls_order_dt as varchar)) = 8 "
    "and try_strptime(cast(sls_order_dt as varchar), '%Y%m%d') is null) as sls_order_dt, "
    "cast(0 as bigint) as sls_ship_dt, cast(0 as bigint) as sls_due_dt "
    f"from ({plain(SALES)}) as s"
)
def impossible_dates(t: Tables) -> DataFrame:
    return warehouse.impossible_dates(t.sql(SALES))


@query(
    "select o_custkey, o_orderkey, o_orderdate, o_totalprice from (select *, row_number() over "
    "(partition by o_custkey order by o_orderdate desc nulls last, o_orderkey desc) as r from orders) as o where r = 1"
)
def latest_order_per_customer(t: Tables) -> DataFrame:
    newest = ordering.latest_per_key(t.orders, ["o_custkey"], "o_orderdate", [("o_orderkey", "desc")])
    return newest.select("o_custkey", "o_orderkey", "o_orderdate", "o_totalprice")


_VERSIONS = """
select o_custkey, o_orderkey, cast(o_orderdate as date) as valid_from,
  cast(lead(cast(o_orderdate as date)) over (partition by o_custkey order by cast(o_orderdate as date), o_orderkey)
    - interval 1 day as date) as valid_to
from orders
"""


def _versions(t: Tables) -> DataFrame:
    return t.orders.select("o_custkey", "o_orderkey", F.col("o_orderdate").cast("date").alias("valid_from"))


@query(_VERSIONS)
def version_end_date(t: Tables) -> DataFrame:
    return ordering.end_date(_versions(t), ["o_custkey"], "valid_from", "valid_to", ["o_orderkey"])


@query(_VERSIONS)
def version_end_date_frequent_keys(t: Tables) -> DataFrame:
    return ordering.end_date(_versions(t), ["o_custkey"], "valid_from", "valid_to", ["o_orderkey"], largest=1)


@query(
    "select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, row_number() over (order by l_orderkey, "
    "l_linenumber, l_partkey, l_suppkey, l_extendedprice) as line_key from lineitem"
)
def global_index(t: Tables) -> DataFrame:
    keys = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]
    return ordering.global_index(t.lineitem.select(*keys), keys, "line_key")


@query(
    "select c_custkey, c_mktsegment, row_number() over (order by c_mktsegment desc, c_acctbal, c_custkey) as rank "
    "from customer"
)
def global_index_descending(t: Tables) -> DataFrame:
    order = [("c_mktsegment", "desc"), "c_acctbal", "c_custkey"]
    return ordering.global_index(t.customer, order, "rank").select("c_custkey", "c_mktsegment", "rank")


@query(
    "select l_orderkey, l_linenumber, l_partkey, l_suppkey, p_part_no from lineitem left join (select p_partkey, "
    "row_number() over (order by p_name, p_partkey) as p_part_no from part where p_size <> 7) as p "
    "on l_partkey = p_partkey"
)
def lookup_keys(t: Tables) -> DataFrame:
    part = ordering.global_index(t.part.filter("p_size <> 7"), ["p_name", "p_partkey"], "p_part_no")
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return ordering.lookup_keys(lines, part, "l_partkey", "p_partkey", "p_part_no")
