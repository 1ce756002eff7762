import datetime as dt

import pytest
from helpers import values
from pyspark.sql import functions as F

from quern.frames import Splits, training
from quern.plans import census, prices, recipe, warehouse
from quern.sources import tables
from quern.sources.tables import LoadAudit, Store

DAY = dt.date(2020, 1, 1)

FILES = {
    "source_crm/cust_info.csv": (
        "cst_id,cst_key,cst_firstname,cst_lastname,cst_marital_status,cst_gndr,cst_create_date\r\n"
        "1,AW1, Ann , Lee ,s,f,2020-01-01\r\n1,AW1,Anna,Lee,M,F,2020-02-01\r\n,AW9,No,Id,S,M,2020-01-01\r\n"
        "2,AW2,Bob,Ray, M ,,2020-01-01\r\n"
    ),
    "source_crm/prd_info.csv": (
        "prd_id,prd_key,prd_nm,prd_cost,prd_line,prd_start_dt,prd_end_dt\r\n"
        "10,CO-RF-A1,Frame,,R ,2019-01-01,2010-01-01\r\n11,CO-RF-A1,Frame,12,r,2019-06-01,\r\n"
        "12,AC-HE-B2,Helmet,5,X,2018-01-01,\r\n"
    ),
    "source_crm/sales_details.csv": (
        "sls_ord_num,sls_prd_key,sls_cust_id,sls_order_dt,sls_ship_dt,sls_due_dt,sls_sales,sls_quantity,sls_price\r\n"
        "S1,A1,1,20200105,20200106,0,,2,12\r\nS2,B2,2,5,20200106,20200107,10,2,\r\nS3,Z9,7,,,20200107,1,1,1\r\n"
    ),
    "source_erp/loc_a101.csv": "CID,CNTRY\r\nAW-1,DE\r\nAW-2, \r\n",
    "source_erp/cust_az12.csv": "CID,BDATE,GEN\r\nNASAW1,1980-05-05,Male\r\nAW2,2090-01-01,F\r\n",
    "source_erp/px_cat_g1v2.csv": "ID,CAT,SUBCAT,MAINTENANCE\r\nCO_RF,Components,Road Frames,Yes",
}


@pytest.fixture(scope="module")
def loaded(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("files")
    for name, text in FILES.items():
        (folder / name).parent.mkdir(exist_ok=True)
        (folder / name).write_bytes(text.encode())
    store, audit = Store(str(tmp_path_factory.mktemp("store"))), LoadAudit()
    as_of = dt.datetime(2024, 1, 1)
    warehouse.load_bronze(spark, str(folder), store, audit)
    warehouse.load_silver(spark, store, as_of, audit)
    warehouse.load_gold(spark, store, audit)
    return store, audit


def test_customers(spark, loaded):
    got = values(loaded[0].read(spark, "gold", "dim_customers"))
    assert got == [
        (1, 1, "AW1", "Anna", "Lee", "Germany", "Married", "Female", dt.date(1980, 5, 5), dt.date(2020, 2, 1)),
        (2, 2, "AW2", "Bob", "Ray", "n/a", "Married", "Female", None, DAY),
    ]


def test_products(spark, loaded):
    silver = values(loaded[0].read(spark, "silver", "crm_prd_info").drop("dwh_create_date"), "prd_id", "prd_end_dt")
    assert silver == [(10, dt.date(2019, 5, 31)), (11, None), (12, None)]
    gold = values(loaded[0].read(spark, "gold", "dim_products"))
    assert gold == [
        (1, 12, "B2", "Helmet", "AC_HE", None, None, None, 5, "n/a", dt.date(2018, 1, 1)),
        (2, 11, "A1", "Frame", "CO_RF", "Components", "Road Frames", "Yes", 12, "Road", dt.date(2019, 6, 1)),
    ]


def test_sales(spark, loaded):
    got = values(loaded[0].read(spark, "gold", "fact_sales"))
    d = lambda day: dt.date(2020, 1, day)
    assert got == [
        ("S1", 2, 1, d(5), d(6), None, 24, 2, 12),
        ("S2", 1, 2, None, d(6), d(7), 10, 2, 5),
        ("S3", None, None, None, None, d(7), 1, 1, 1),
    ]


def test_audit_and_stamp(spark, loaded):
    store, audit = loaded
    rows = {(r.layer, r.table): r.rows for r in audit.records}
    assert rows["bronze", "crm_cust_info"] == 4 and rows["silver", "crm_cust_info"] == 2
    assert len(rows) == 15 and {r.status for r in audit.records} == {"loaded"}
    stamps = store.read(spark, "silver", "erp_loc_a101").select("dwh_create_date").distinct().collect()
    assert [s[0] for s in stamps] == [dt.datetime(2024, 1, 1)]


def test_declared_tables_take_the_cleansed_rows(spark, loaded):
    store = loaded[0]
    for layer, schemas in (("bronze", warehouse.BRONZE), ("silver", warehouse.SILVER)):
        for table, schema in schemas.items():
            stored = store.read(spark, layer, table)
            assert stored.dtypes == spark.createDataFrame([], schema).dtypes, (layer, table)
    try:
        tables.recreate_tables(spark, "silver", {"erp_loc_a101": warehouse.SILVER["erp_loc_a101"]})
        tables.append_table(store.read(spark, "silver", "erp_loc_a101"), "silver.erp_loc_a101")
        assert spark.table("silver.erp_loc_a101").count() == 2
    finally:
        spark.sql("drop database if exists silver cascade")
    store.publish(spark, "gold", warehouse.GOLD)
    assert spark.sql("select count(product_key) from gold_fact_sales").first()[0] == 2


def raw_census(spark):
    numbers = [*census.POPULATION, *[census.RAW_NAMES.get(c, c) for c in census.INDIGENOUS], *census.EDUCATION]
    names = [*census.LOCATION, *numbers, *census.SCHOOLING]
    place = lambda state, name, loc, speakers, total: (
        state, name, 1, "Múnicipio", loc, "Ñ", "100°30'0\" W", "NULL",
        *[{"P3YM_HLI": speakers, "POBTOT": total, "P_15YMAS": "80"}.get(n, "*") for n in numbers], "9.5", "N/D", "*",
    )
    rows = [
        place(31, "Yucatán", 2, "11", "100"), place(15, "México", 7, "10", "100"), place(15, "México", 0, "99", "100"),
        place(15, "México", 9998, "99", "100"), place(9, "Elsewhere", 5, "*", "0"),
    ]
    return spark.createDataFrame(
        rows, "ENTIDAD int, NOM_ENT string, MUN int, NOM_MUN string, LOC int, NOM_LOC string, "
        + ", ".join(f"{n} string" for n in names[6:])
    )


def test_census(spark):
    raw = raw_census(spark)
    location = census.clean_location(census.extract_location(raw))
    others = [
        census.with_locality_index(census.EXTRACTS[name](raw), location)
        for name in ("population", "indigenous", "education")
    ]
    fact = census.fact_indigenous_education(location, *others)
    assert len(fact.columns) == 32
    got = values(
        census.ordered_export(fact), "idx", "state", "state_abbreviation", "region", "locality", "longitude", "latitude",
        "perc_indigenous", "group_type", "avg_years_of_schooling_over_15", "perc_illiterate",
    )
    assert got == [
        (1, "Elsewhere", "Total", "Center", "N", -100.5, None, None, "Low Indigenous", 9.5, None),
        (2, "Mexico", "MEX", "Center", "N", -100.5, None, 10.0, "Low Indigenous", 9.5, None),
        (3, "Yucatan", "YUC", "Southeast", "N", -100.5, None, 11.0, "High Indigenous", 9.5, None),
    ]
    assert values(census.unmapped_states(location)) == [("Elsewhere", 1)]
    assert census.unknown_localities(census.extract_population(raw), location).count() == 0
    assert census.unknown_localities(census.extract_population(raw), location.filter("ENTIDAD = 9")).count() == 2


def test_census_numbers_must_be_numbers(spark):
    raw = raw_census(spark).withColumn("POBTOT", F.lit("many"))
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        census.extract_population(raw).collect()


def test_prices(spark):
    raw = spark.createDataFrame(
        [("CP00", "AT", "2020-05", 1.5, "x"), ("CP00", "BE", None, None, "x")],
        "coicop string, geo string, TIME_PERIOD string, OBS_VALUE double, other string",
    )
    got = prices.extract_prices(raw)
    assert got.columns == ["coicop", "geo", "OBS_VALUE", "date"]
    assert values(got, "date") == sorted([(dt.datetime(2020, 5, 1),), (None,)], key=str)


def test_recipe_keeps_only_steps_that_succeed(frame):
    work = recipe.Recipe(frame)
    assert work.add("train_test_split", {"test_size": 0.2}).status == "warning"  # values are missing
    assert work.add("missing_values", {"fill_strategy": "Fill with Mean", "cols_with_na": ["num_a"]}).ok
    assert work.add("datatype_convertion", {"selected_column": "flag", "selected_datatype": "bool"}).ok
    assert work.add("datatype_convertion", {"selected_column": "cat_hi", "selected_datatype": "int"}).status == "error"
    assert work.add("drop_columns", {"columns": ["when", "cat_hi"]}).ok
    assert work.add("nonsense", {}).status == "warning"
    assert work.add("train_test_val_split", {"test_size": 0.2, "validation_size": 0.1}, stage=True).ok
    assert work.add("remove_duplicates", {"keep_first": True}).status == "warning"  # too late
    percentage = {"outlier_removal_method": "Percentage", "bottom_percentage": 0.05, "top_percentage": 0.05}
    assert work.add("remove_outliers", {"selected_outlier_column": "target", **percentage}).ok
    assert work.add("transform_columns", {"col_to_transform": "num_a", "transform_method": "Yeo-Johnson Transform"}).ok
    assert work.add("encode_columns", {"encoding_method": "One-Hot Encoding", "cat_cols": ["cat_lo"]}).ok
    assert work.add("transform_columns", {"col_to_transform": "num_a", "transform_method": "Log Transform"}).status == (
        "warning"
    )
    assert work.add("variance_threshold", {"threshold": "0.0"}).ok
    assert work.add("pca", {"n_components": 2}).status == "warning"  # a boolean column is left
    assert work.add("drop_columns", {"columns": ["flag"]}).ok
    assert work.add("scale_columns", {"scaling_method": "Robust Scaler"}).ok
    assert work.add("scale_columns", {"scaling_method": "Robust Scaler"}).status == "warning"
    done = work.add("pca", {"n_components": 2, "is_data_scaled": True})
    assert done.ok and len(done.details["ratio"]) == 2
    assert work.add("pca", {"n_components": 2, "is_data_scaled": True}).status == "warning"
    assert isinstance(work.current, Splits) and training(work.current).columns == ["PC1", "PC2"]
    again = recipe.Recipe(frame, work.steps).current
    for (_, now), (_, before) in zip(again.items(), work.current.items()):
        a, b = (df.select(*[F.round(c, 6) for c in df.columns]) for df in (now, before))
        assert a.exceptAll(b).isEmpty() and a.count() == b.count()


def test_every_step_of_the_catalogue(frame):
    complete = frame.drop("num_a", "when", "cat_hi")
    params = {
        "rename_column": {"old_name": "id", "new_name": "key"},
        "remove_duplicates": {"keep_first": False},
        "drop_columns": {"columns": ["id"]},
        "missing_values": {"fill_strategy": "Drop", "axis": 0},
        "datatype_convertion": {"selected_column": "id", "selected_datatype": "float"},
        "train_test_split": {"stratify_col": "cat_lo"},
        "train_test_val_split": {},
        "remove_outliers": {"selected_outlier_column": "target", "outlier_removal_method": "Isolation Forest"},
        "scale_columns": {"scaling_method": "StandardScaler (Z-score)"},
        "encode_columns": {"encoding_method": "Target Encoding", "target_column": "target"},
        "transform_columns": {"col_to_transform": "id", "transform_method": "Box-Cox Transform"},
        "variance_threshold": {"threshold": 0.5},
        "pca": {"n_components": 1, "selected_scaler": "Robust Scaler"},
        "feature_selection": {"target_col": "cat_lo", "k": 2},
    }
    assert set(params) == set(recipe.STEPS)
    for kind, settings in params.items():
        outcome = recipe.apply_step(complete, {"op_type": kind, "params": settings})
        assert outcome.ok, (kind, outcome.message)
    for strategy in ("Fill with Median", "Fill with Mode", "Fill with Custom Value"):
        filled = recipe.apply_step(
            frame, {"op_type": "missing_values", "params": {"fill_strategy": strategy, "custom_value": "1"}}
        )
        assert filled.data.filter("num_a is null").isEmpty()


def test_replay_tells_what_it_left_out(spark, frame):
    steps = [
        {"id": "1", "op_type": "encode_columns", "params": {"encoding_method": "no such", "columns_to_encode": ["cat_lo"]}},
        {"id": "2", "op_type": "rename_column", "params": {"old_name": "num_b", "new_name": "b"}},
    ]
    work = recipe.Recipe(frame, steps)
    assert not work._state.encoded
    assert [step["id"] for step, _ in work.left_out][:1] == ["1"]


def test_fact_of_localities_takes_three_joins(spark):
    keys = "ENTIDAD int, MUN int, LOC int"
    frames = []
    for names in (census.LOCATION_NAMES | census.COORDINATE_NAMES, census.POPULATION_NAMES, census.INDIGENOUS_NAMES, census.EDUCATION_NAMES):
        extra = ", ".join(f"{n} int" for n in names if n not in ("ENTIDAD", "MUN", "LOC"))
        frames.append(spark.createDataFrame([], f"{keys}, {extra}"))
    plan = census.fact_indigenous_education(*frames)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join LeftOuter") == 3
