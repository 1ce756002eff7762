"""Census and price plans on tables derived from the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalog.registry import Tables, plain, query, round_all
from quern.functions import numbers, text
from quern.operators import columns
from quern.plans import census, prices

_NAMES = """case c_custkey % 34 when 0 then 'Aguascalientes' when 1 then 'Baja California' when 8
    then 'Ciudad de México' when 14 then 'México' when 15 then 'Michoacán de Ocampo' when 18 then 'Nuevo León'
    when 21 then 'Querétaro' when 23 then 'San Luis Potosí' when 30 then 'Yucatán' when 19 then 'Oaxaca'
    else 'Otro Éstado' end"""

# One locality per customer, with totals, withheld values and unreadable coordinates among them.
RAW = f"""
select cast(1 + c_custkey % 34 as int) as ENTIDAD, {_NAMES} as NOM_ENT,
  cast(1 + c_custkey % 57 as int) as MUN, 'Municipio Ñ' || cast(c_custkey % 57 as string) as NOM_MUN,
  cast(case when c_custkey % 23 = 0 then 0 when c_custkey % 29 = 0 then 9998 when c_custkey % 31 = 0 then 9999
    when c_custkey % 37 = 0 then null else 10000 + c_custkey end as int) as LOC,
  'Localidad Ü' || cast(c_custkey as string) as NOM_LOC,
  case when c_custkey % 11 = 0 then 'NULL' when c_custkey % 13 = 0 then 'somewhere'
    else cast(90 + c_custkey % 30 as string) || '°' || lpad(cast(c_custkey % 60 as string), 2, '0') || chr(39)
      || lpad(cast(c_custkey % 59 as string), 2, '0') || '.' || lpad(cast(c_custkey % 100 as string), 2, '0')
      || '1" ' || case when c_custkey % 2 = 0 then 'W' else 'w' end end as LONGITUD,
  cast(14 + c_custkey % 18 as string) || ' ' || lpad(cast(c_custkey % 60 as string), 2, '0') || ' '
    || lpad(cast(c_custkey % 53 as string), 2, '0') || '.001N' as LATITUD,
  {", ".join(
    f"case when c_custkey % {17 + i} = 0 then '*' when c_custkey % {41 + i} = 0 then 'N/D' "
    f"else cast(cast(floor(abs(c_acctbal)) as int) % {900 + 7 * i} as string) end as {name}"
    for i, name in enumerate(
        [*census.POPULATION, *[census.RAW_NAMES.get(c, c) for c in census.INDIGENOUS], *census.EDUCATION]
    )
  )},
  {", ".join(
    f"case when c_custkey % {19 + i} = 0 then '*' else cast(c_custkey % {12 + i} as string) || '.25' end as {name}"
    for i, name in enumerate(census.SCHOOLING)
  )}
from {{customer}}
"""


def _number(name: str, kind: str = "bigint") -> str:
    raw = census.RAW_NAMES.get(name, name)
    return f"cast(case when {raw} in ('*', 'N/D') then null else {raw} end as {kind}) as {name}"


def _degrees(name: str) -> str:
    pattern = r"""^\s*(\d+)[°\s]*(\d+)[''\s]*([\d.]+)["\s]*([NSWEnswe])\s*$"""
    part = [f"regexp_extract({name}, '{pattern}', {i})" for i in range(1, 5)]
    size = f"(cast({part[0]} as double) + cast({part[1]} as double) / 60 + cast({part[2]} as double) / 3600)"
    sign = f"case when upper({part[3]}) in ('S', 'W') then -1 else 1 end"
    return f"case when regexp_matches({name}, '{pattern}') then round({size} * {sign}, 4) end as {name}"


_RAW = plain(RAW)
_ACCENTS = ", ".join(f"strip_accents({c}) as {c}" for c in ("NOM_ENT", "NOM_MUN", "NOM_LOC"))
EXTRACT_LOCATION = (
    f"select ENTIDAD, MUN, LOC, {_ACCENTS}, {_degrees('LONGITUD')}, {_degrees('LATITUD')} from ({_RAW}) as r"
)


def _extract(names: list[str], doubles: list[str] = ()) -> str:
    parts = [f"cast({c} as bigint) as {c}" for c in census.KEYS]
    parts += [_number(c) for c in names] + [_number(c, "double") for c in doubles]
    return f"select {', '.join(parts)} from ({_RAW}) as r"


EXTRACT_POPULATION = _extract(census.POPULATION)
EXTRACT_INDIGENOUS = _extract(census.INDIGENOUS)
EXTRACT_EDUCATION = _extract(census.EDUCATION, census.SCHOOLING)

_STATE = " ".join(f"when '{name}' then '{code}'" for name, code in census.STATES.items())
_REGION = " ".join(f"when ENTIDAD in {codes} then '{name}'" for name, codes in census.REGIONS.items())
_KEPT = "LOC not in (0, 9998, 9999)"
CLEAN_LOCATION = f"""
select *, case NOM_ENT {_STATE} else 'Total' end as state_abbreviation, case {_REGION} else 'Total' end as region,
  row_number() over (order by ENTIDAD, MUN, LOC) as locality_index
from ({EXTRACT_LOCATION}) as e where {_KEPT}
"""


def _indexed(extract: str) -> str:
    return f"select *, row_number() over (order by ENTIDAD, MUN, LOC) as locality_index from ({extract}) as e where {_KEPT}"


_PERCENTAGES = {
    "perc_indigenous": ("i.P3YM_HLI", "p.POBTOT"),
    "perc_no_spanish": ("i.P3HLINHE", "i.P3YM_HLI"),
    "perc_household_indigenous": ("i.PHOG_IND", "p.POBTOT"),
    "perc_illiterate": ("e.P15YM_AN", "p.P_15YMAS"),
    "perc_no_schooling": ("e.P15YM_SE", "p.P_15YMAS"),
    "perc_higher_ed": ("e.P18YM_PB", "p.P_18YMAS"),
}


def _percentage(name: str) -> str:
    a, b = _PERCENTAGES[name]
    return f"round(cast({a} as double) / nullif({b}, 0) * 100, 6) as {name}"


def _names(alias: str, names: dict[str, str]) -> str:
    return ", ".join(f"{alias}.{old} as {new}" for old, new in names.items())


_GROUP = (
    "case when cast(i.P3YM_HLI as double) / nullif(p.POBTOT, 0) > 0.1 then 'High Indigenous' "
    "else 'Low Indigenous' end as group_type"
)
_IND = ["perc_indigenous", "perc_no_spanish", "perc_household_indigenous"]
_EDU = ["perc_illiterate", "perc_no_schooling", "perc_higher_ed"]

DIM_INDIGENOUS = f"""
select i.locality_index as idx, p.POBTOT as total_population, {_names('i', census.INDIGENOUS_NAMES)},
  {', '.join(map(_percentage, _IND))}, {_GROUP}
from ({_indexed(EXTRACT_INDIGENOUS)}) as i left join ({_indexed(EXTRACT_POPULATION)}) as p using (locality_index)
"""
DIM_EDUCATION = f"""
select e.locality_index as idx, {_names('e', census.EDUCATION_NAMES)}, {', '.join(map(_percentage, _EDU))}
from ({_indexed(EXTRACT_EDUCATION)}) as e left join ({_indexed(EXTRACT_POPULATION)}) as p using (locality_index)
"""
FACT = f"""
select {_names('l', census.LOCATION_NAMES)}, {_names('l', census.COORDINATE_NAMES)},
  {_names('p', census.POPULATION_NAMES)}, {_names('i', census.INDIGENOUS_NAMES)}, {', '.join(map(_percentage, _IND))},
  {_GROUP}, {_names('e', census.EDUCATION_NAMES)}, {', '.join(map(_percentage, _EDU))}
from ({CLEAN_LOCATION}) as l left join ({_indexed(EXTRACT_POPULATION)}) as p on l.locality_index = p.locality_index
left join ({_indexed(EXTRACT_INDIGENOUS)}) as i on l.locality_index = i.locality_index
left join ({_indexed(EXTRACT_EDUCATION)}) as e on l.locality_index = e.locality_index
"""


def _location(t: Tables) -> DataFrame:
    return census.clean_location(census.extract_location(t.sql(RAW)))


def _table(t: Tables, name: str, location: DataFrame) -> DataFrame:
    return census.with_locality_index(census.EXTRACTS[name](t.sql(RAW)), location)


@query(EXTRACT_LOCATION)
def census_location_extract(t: Tables) -> DataFrame:
    return census.extract_location(t.sql(RAW))


@query(EXTRACT_POPULATION)
def census_population_extract(t: Tables) -> DataFrame:
    return census.extract_population(t.sql(RAW))


@query(EXTRACT_INDIGENOUS)
def census_indigenous_extract(t: Tables) -> DataFrame:
    return census.extract_indigenous(t.sql(RAW))


@query(EXTRACT_EDUCATION)
def census_education_extract(t: Tables) -> DataFrame:
    return census.extract_education(t.sql(RAW))


@query(CLEAN_LOCATION)
def census_location(t: Tables) -> DataFrame:
    return _location(t)


@query(_indexed(EXTRACT_EDUCATION))
def census_education(t: Tables) -> DataFrame:
    return _table(t, "education", _location(t))


@query(f"select {_names('l', census.LOCATION_NAMES)} from ({CLEAN_LOCATION}) as l")
def dim_location(t: Tables) -> DataFrame:
    return census.dim_location(_location(t))


@query(
    f"select locality_index as idx, {_names('p', census.POPULATION_NAMES)} "
    f"from ({_indexed(EXTRACT_POPULATION)}) as p"
)
def dim_population(t: Tables) -> DataFrame:
    return census.dim_population(_table(t, "population", _location(t)))


@query(DIM_INDIGENOUS)
def dim_indigenous(t: Tables) -> DataFrame:
    location = _location(t)
    table = census.dim_indigenous(_table(t, "indigenous", location), _table(t, "population", location))
    return round_all(table, _IND)


@query(DIM_EDUCATION)
def dim_education(t: Tables) -> DataFrame:
    location = _location(t)
    return round_all(census.dim_education(_table(t, "education", location), _table(t, "population", location)), _EDU)


@query(FACT)
def fact_indigenous_education(t: Tables) -> DataFrame:
    raw = t.sql(RAW)
    parts = [census.localities(census.EXTRACTS[name](raw)) for name in ("population", "indigenous", "education")]
    return round_all(census.fact_indigenous_education(_location(t), *parts), _IND + _EDU)


@query(f"select NOM_ENT, count(*) as count from ({CLEAN_LOCATION}) as l where state_abbreviation = 'Total' group by 1")
def unmapped_states(t: Tables) -> DataFrame:
    return census.unmapped_states(_location(t))


@query(f"select ENTIDAD, MUN, LOC from ({CLEAN_LOCATION}) as l where ENTIDAD % 4 = 0 or LOC is null")
def unknown_localities(t: Tables) -> DataFrame:
    """Localities of the education extract that a location table lacking a quarter of the states does not know."""
    partial = _location(t).filter("ENTIDAD % 4 <> 0")
    return census.unknown_localities(census.EXTRACTS["education"](t.sql(RAW)), partial)


_PRICE_RAW = """
select o_orderpriority as coicop, o_orderstatus as geo, substr(cast(cast(o_orderdate as date) as string), 1, 7)
  as TIME_PERIOD, o_totalprice as OBS_VALUE, o_orderkey
from {orders}
"""


@query(
    "select coicop, geo, OBS_VALUE, strptime(TIME_PERIOD, '%Y-%m') as date "
    f"from ({plain(_PRICE_RAW)}) as r"
)
def price_index_extract(t: Tables) -> DataFrame:
    extract = prices.extract_prices(t.sql(_PRICE_RAW))
    return extract.withColumn("date", F.col("date").cast("timestamp_ntz"))


# Compared on letters only: the engines treat other signs that carry marks differently.
@query(
    "select doc_id, regexp_replace(strip_accents(text), '[^a-zA-Z]', '', 'g') as plain from documents"
)
def strip_accents(t: Tables) -> DataFrame:
    plain_text = F.regexp_replace(text.strip_accents(F.col("text")), "[^a-zA-Z]", "")
    return t.documents.select("doc_id", plain_text.alias("plain"))


@query("select doc_id, regexp_replace(strip_accents(text), '[^a-zA-Z]', '', 'g') as plain from documents")
def strip_accents_any_script(t: Tables) -> DataFrame:
    plain_text = F.regexp_replace(text.strip_accents_any_script(F.col("text")), "[^a-zA-Z]", "")
    return t.documents.select("doc_id", plain_text.alias("plain"))


# Letters and the signs they are written as: marked, wide and raised ones, ligatures and a fraction; other scripts, with
# what is left of them.
_LATIN = ("aceinouxyACEIMNOUZWqQK", "áçéîñöůｘÿÀÇÉÎḾÑÕÜÅºﬁĳ½")
_OTHER = ("aeoykz", "άέόήйﾊ", "αεοηиハ")


@query(
    "select doc_id, strip_accents(replace(replace(replace(replace(translate(text, 'WZ', 'oA'), 'w', '2a'), 'q', 'fi'), "
    f"'Q', 'ij'), 'K', '1⁄2')) as latin, strip_accents(translate(text, '{_OTHER[0]}', '{_OTHER[2]}')) as any from documents"
)
def strip_accents_whole_text(t: Tables) -> DataFrame:
    """Every sign of the whole texts, whose letters are written with marks first: Latin ones, and those of other scripts."""
    latin = F.replace(F.translate("text", *_LATIN), F.lit("w"), F.lit("²ª"))
    return t.documents.select(
        "doc_id",
        text.strip_accents(latin).alias("latin"),
        text.strip_accents_any_script(F.translate("text", *_OTHER[:2])).alias("any"),
    )


@query(
    "select s_suppkey, case when s_suppkey % 5 <> 0 then round(s_suppkey % 90 + (s_suppkey % 60) / 60.0 + "
    "((s_suppkey % 60) + 0.001) / 3600.0, 4) * case s_suppkey % 4 when 0 then -1 when 1 then 1 when 2 then -1 "
    "else 1 end end as degrees from supplier"
)
def dms_decimal(t: Tables) -> DataFrame:
    angles = t.sql(
        "select s_suppkey, case when s_suppkey % 5 = 0 then 'no angle' else cast(s_suppkey % 90 as string) || '°' || "
        "cast(s_suppkey % 60 as string) || chr(39) || cast(s_suppkey % 60 as string) || '.001\" ' || "
        "substr('SNwE', cast(1 + s_suppkey % 4 as int), 1) end as angle from {supplier}"
    )
    return angles.select("s_suppkey", text.degrees_from_dms(F.col("angle")).alias("degrees"))


@query(
    "select o_orderkey, round(cast(o_totalprice as double) / nullif(c_acctbal, 0) * 100, 4) as share, "
    "case when o_totalprice / nullif(c_acctbal, 0) > 50 then 'High' else 'Low' end as level "
    "from orders left join (select c_custkey, case when c_custkey % 10 = 0 then 0 else c_acctbal end as c_acctbal "
    "from customer) as c on o_custkey = c_custkey"
)
def safe_percentage(t: Tables) -> DataFrame:
    from quern.functions.codes import above

    customers = t.sql(
        "select c_custkey, case when c_custkey % 10 = 0 then 0 else c_acctbal end as c_acctbal from {customer}"
    )
    joined = t.orders.join(customers, F.col("o_custkey") == F.col("c_custkey"), "left")
    total, balance = F.col("o_totalprice"), F.col("c_acctbal")
    return joined.select(
        "o_orderkey",
        F.round(numbers.percentage(total, balance), 4).alias("share"),
        above(numbers.ratio(total, balance), 50, "High", "Low").alias("level"),
    )


@query("select * from events where user_id not in (0, 7, 99)")
def exclude_values(t: Tables) -> DataFrame:
    return columns.exclude_values(t.events, "user_id", (0, 7, 99))
