"""Census: one wide file by locality to extracts, cleansed tables and a table of indigenous population and schooling."""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.functions.codes import above, map_codes
from quern.functions.numbers import percentage, ratio
from quern.functions.text import blank_to_null, degrees_from_dms, strip_accents_everywhere
from quern.operators.columns import exclude_values, renamed
from quern.operators.ordering import global_index
from quern.sources.csv import read_positional
from quern.sources.tables import LoadAudit, Store

KEYS = ["ENTIDAD", "MUN", "LOC"]

# Columns of the extracts.
LOCATION = ["ENTIDAD", "NOM_ENT", "MUN", "NOM_MUN", "LOC", "NOM_LOC", "LONGITUD", "LATITUD"]
POPULATION = [
    "POBTOT", "POBFEM", "POBMAS", "P_0A2", "P_0A4", "P_3YMAS", "P_5YMAS", "P_15YMAS", "P_18YMAS",
]
INDIGENOUS = ["PHOG_IND", "P3YM_HLI", "P3HLINHE", "P3HLIHE", "P5_HLI", "P5_HLI_NHE", "P5_HLI_HE"]
EDUCATION = ["P15YM_AN", "P15YM_SE", "P15PRI_IN", "P15PRI_CO", "P15SEC_IN", "P15SEC_CO", "P18YM_PB"]
SCHOOLING = ["GRAPROES", "GRAPROES_F", "GRAPROES_M"]

# The raw file and the table differ in one name.
RAW_NAMES = {"P3HLIHE": "P3HLI_HE"}

# Rows that hold totals, not localities.
TOTAL_ROWS = (0, 9998, 9999)

# Abbreviation of each state, accents removed.
STATES = {
    "Aguascalientes": "AGU",
    "Baja California": "BCN",
    "Baja California Sur": "BCS",
    "Campeche": "CAM",
    "Chiapas": "CHP",
    "Chihuahua": "CHH",
    "Ciudad de Mexico": "CMX",
    "Coahuila de Zaragoza": "COA",
    "Colima": "COL",
    "Durango": "DUR",
    "Guanajuato": "GUA",
    "Guerrero": "GRO",
    "Hidalgo": "HID",
    "Jalisco": "JAL",
    "Mexico": "MEX",
    "Michoacan de Ocampo": "MIC",
    "Morelos": "MOR",
    "Nayarit": "NAY",
    "Nuevo Leon": "NLE",
    "Oaxaca": "OAX",
    "Puebla": "PUE",
    "Queretaro": "QUE",
    "Quintana Roo": "ROO",
    "San Luis Potosi": "SLP",
    "Sinaloa": "SIN",
    "Sonora": "SON",
    "Tabasco": "TAB",
    "Tamaulipas": "TAM",
    "Tlaxcala": "TLA",
    "Veracruz de Ignacio de la Llave": "VER",
    "Yucatan": "YUC",
    "Zacatecas": "ZAC",
}

# States of each region.
REGIONS = {
    "Northwest": (2, 3, 25, 26),
    "Northeast": (5, 8, 10, 19, 28),
    "West": (6, 14, 16, 18),
    "Midwest": (1, 11, 22, 24, 32),
    "Center": (9, 13, 15, 17, 21, 29),
    "East": (27, 30),
    "South": (7, 12, 20),
    "Southeast": (4, 23, 31),
}
ELSEWHERE = "Total"
HIGH_SHARE = 0.1


def _ddl(integers: list[str], doubles: list[str] = ()) -> str:
    return ", ".join([f"{c} int" for c in [*KEYS, *integers]] + [f"{c} double" for c in doubles])


BRONZE = {
    "location": (
        "ENTIDAD int, NOM_ENT string, MUN int, NOM_MUN string, LOC int, NOM_LOC string, "
        "LONGITUD double, LATITUD double"
    ),
    "population": _ddl(POPULATION),
    "indigenous": _ddl(INDIGENOUS),
    "education": _ddl(EDUCATION, SCHOOLING),
}

SILVER = {
    "location": BRONZE["location"] + ", state_abbreviation string, region string, locality_index bigint",
    **{table: BRONZE[table] + ", locality_index bigint" for table in ("population", "indigenous", "education")},
}
GOLD = ("dim_location", "dim_population", "dim_indigenous", "dim_education", "fact_indigenous_education")

# File of each table.
FILES = {
    "location": "location.csv",
    "population": "population.csv",
    "indigenous": "ind_population.csv",
    "education": "education.csv",
}


def _typed(raw: DataFrame, integers: list[str], doubles: list[str] = ()) -> DataFrame:
    """Withheld values become NULL, everything else must be a number."""
    kinds = [(c, "bigint") for c in [*KEYS, *integers]] + [(c, "double") for c in doubles]
    return raw.select(
        *[blank_to_null(F.col(RAW_NAMES.get(c, c)).cast("string")).cast(kind).alias(c) for c, kind in kinds]
    )


def extract_location(raw: DataFrame, any_script: bool = False) -> DataFrame:
    """Names without accents, coordinates in degrees."""
    plain = strip_accents_everywhere(raw.select(*LOCATION), any_script)
    return plain.withColumns({c: degrees_from_dms(F.col(c)) for c in ("LONGITUD", "LATITUD")})


def extract_population(raw: DataFrame) -> DataFrame:
    return _typed(raw, POPULATION)


def extract_indigenous(raw: DataFrame) -> DataFrame:
    return _typed(raw, INDIGENOUS)


def extract_education(raw: DataFrame) -> DataFrame:
    return _typed(raw, EDUCATION, SCHOOLING)


EXTRACTS = {
    "location": extract_location,
    "population": extract_population,
    "indigenous": extract_indigenous,
    "education": extract_education,
}


def localities(table: DataFrame) -> DataFrame:
    """Rows of single localities; totals and rows without a locality number are left out."""
    return exclude_values(table, "LOC", TOTAL_ROWS)


def clean_location(bronze: DataFrame) -> DataFrame:
    """State abbreviation, region and the running number of each locality."""
    region = {code: name for name, codes in REGIONS.items() for code in codes}
    known = localities(bronze).withColumns(
        {
            "state_abbreviation": map_codes(F.col("NOM_ENT"), STATES, ELSEWHERE, fold=False),
            "region": map_codes(F.col("ENTIDAD"), region, ELSEWHERE, fold=False),
        }
    )
    return global_index(known, KEYS, "locality_index")


def with_locality_index(bronze: DataFrame, location: DataFrame) -> DataFrame:
    """The number given to the locality in ``location``, found by its natural key.

    One numbering for all tables: numbering each table by itself agrees only while all hold the same localities.
    """
    index = location.select(*KEYS, "locality_index")
    return localities(bronze).join(index, KEYS, "left")


def unknown_localities(table: DataFrame, location: DataFrame) -> DataFrame:
    return localities(table).join(location, KEYS, "left_anti").select(*KEYS)


def unmapped_states(location: DataFrame) -> DataFrame:
    return location.filter(F.col("state_abbreviation") == ELSEWHERE).groupBy("NOM_ENT").count()


# Names in the final tables.
LOCATION_NAMES = {
    "locality_index": "idx",
    "ENTIDAD": "state_id",
    "NOM_ENT": "state",
    "state_abbreviation": "state_abbreviation",
    "region": "region",
    "NOM_MUN": "municipality",
    "NOM_LOC": "locality",
}
COORDINATE_NAMES = {"LONGITUD": "longitude", "LATITUD": "latitude"}
POPULATION_NAMES = {
    "POBTOT": "total_population",
    "P_3YMAS": "population_over_3",
    "P_15YMAS": "population_over_15",
    "P_18YMAS": "population_over_18",
}
INDIGENOUS_NAMES = {
    "P3YM_HLI": "indigenous_language_over_3",
    "P3HLINHE": "indigenous_language_over_3_no_spanish",
    "P3HLIHE": "indigenous_language_over_3_speaks_spanish",
    "PHOG_IND": "population_indigenous_households",
}
EDUCATION_NAMES = {
    "P15YM_AN": "illiterate_over_15",
    "P15YM_SE": "no_schooling_over_15",
    "P15PRI_CO": "primary_complete_over_15",
    "P15PRI_IN": "primary_incomplete_over_15",
    "P15SEC_CO": "secondary_complete_over_15",
    "P15SEC_IN": "secondary_incomplete_over_15",
    "P18YM_PB": "higher_education_over_18",
    "GRAPROES": "avg_years_of_schooling_over_15",
}


def _indigenous_measures() -> list:
    speakers, everyone = F.col("P3YM_HLI"), F.col("POBTOT")
    return [
        percentage(speakers, everyone).alias("perc_indigenous"),
        percentage(F.col("P3HLINHE"), speakers).alias("perc_no_spanish"),
        percentage(F.col("PHOG_IND"), everyone).alias("perc_household_indigenous"),
        above(ratio(speakers, everyone), HIGH_SHARE, "High Indigenous", "Low Indigenous").alias("group_type"),
    ]


def _education_measures() -> list:
    return [
        percentage(F.col("P15YM_AN"), F.col("P_15YMAS")).alias("perc_illiterate"),
        percentage(F.col("P15YM_SE"), F.col("P_15YMAS")).alias("perc_no_schooling"),
        percentage(F.col("P18YM_PB"), F.col("P_18YMAS")).alias("perc_higher_ed"),
    ]


def _as(names: dict[str, str]) -> list:
    return [F.col(old).alias(new) for old, new in names.items()]


def dim_location(location: DataFrame) -> DataFrame:
    return renamed(location, LOCATION_NAMES)


def dim_population(population: DataFrame) -> DataFrame:
    return renamed(population, {"locality_index": "idx"} | POPULATION_NAMES)


def dim_indigenous(indigenous: DataFrame, population: DataFrame) -> DataFrame:
    joined = indigenous.join(population.select("locality_index", "POBTOT"), "locality_index", "left")
    names = {"locality_index": "idx", "POBTOT": "total_population"} | INDIGENOUS_NAMES
    return joined.select(*_as(names), *_indigenous_measures())


def dim_education(education: DataFrame, population: DataFrame) -> DataFrame:
    sizes = population.select("locality_index", "P_15YMAS", "P_18YMAS")
    joined = education.join(sizes, "locality_index", "left")
    return joined.select(*_as({"locality_index": "idx"} | EDUCATION_NAMES), *_education_measures())


def fact_indigenous_education(
    location: DataFrame, population: DataFrame, indigenous: DataFrame, education: DataFrame
) -> DataFrame:
    """All measures of a locality in one row, found by its natural key; ``location`` alone carries its number.

    All joins share one key, so each table is divided by it once.
    """
    joined = location
    for table, names in (
        (population, POPULATION_NAMES),
        (indigenous, INDIGENOUS_NAMES),
        (education, EDUCATION_NAMES),
    ):
        joined = joined.join(table.select(*KEYS, *names), KEYS, "left")
    return joined.select(
        *_as(LOCATION_NAMES | COORDINATE_NAMES | POPULATION_NAMES | INDIGENOUS_NAMES),
        *_indigenous_measures(),
        *_as(EDUCATION_NAMES),
        *_education_measures(),
    )


def load_bronze(spark: SparkSession, folder: str, store: Store, audit: LoadAudit | None = None) -> LoadAudit:
    audit = audit or LoadAudit()
    root = folder.rstrip("/")
    raw = {
        table: read_positional(spark, f"{root}/{FILES[table]}", schema, quoted=True)
        for table, schema in BRONZE.items()
    }
    audit.run_all("bronze", raw, store.refresh)
    return audit


def load_silver(spark: SparkSession, store: Store, audit: LoadAudit | None = None) -> LoadAudit:
    """Locations first, since the other tables look their running number up there."""
    audit = audit or LoadAudit()
    refresh = partial(store.refresh, cluster_by=tuple(KEYS))
    audit.run_all("silver", {"location": clean_location(store.read(spark, "bronze", "location"))}, refresh)
    location = store.read(spark, "silver", "location")
    others = {
        table: with_locality_index(store.read(spark, "bronze", table), location)
        for table in ("population", "indigenous", "education")
    }
    audit.run_all("silver", others, refresh)
    return audit


def load_gold(spark: SparkSession, store: Store, audit: LoadAudit | None = None) -> LoadAudit:
    audit = audit or LoadAudit()
    location, population, indigenous, education = (store.read(spark, "silver", table) for table in BRONZE)
    tables = {
        "dim_location": dim_location(location),
        "dim_population": dim_population(population),
        "dim_indigenous": dim_indigenous(indigenous, population),
        "dim_education": dim_education(education, population),
        "fact_indigenous_education": fact_indigenous_education(location, population, indigenous, education),
    }
    audit.run_all("gold", tables, store.refresh)
    return audit


def ordered_export(fact: DataFrame) -> DataFrame:
    return fact.orderBy("idx")
