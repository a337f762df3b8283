"""Queries of label hierarchies: parents, percent detection and conversion, cleaned tables.

Customers are counties, nations are states. A survey row is one of them in one year; its
variables are sums of order cents, or percentages of other sums with one decimal. Row-level
input is text, as it lands.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyloom.functions.labels import classify
from tallyloom.operators import hierarchy as H
from tallyloom.operators import shape
from tallyloom.plans.survey import clean_table
from tallyloom.session import materialise
from workload import query, table
from workload.scalars import _FROM, chain_sql, customers

# Sums per row; b is part of a, c of b, e of d.
_SUMS = {
    "t": "true",
    "a": "o_orderstatus in ('F', 'O')",
    "b": "o_orderstatus = 'F'",
    "c": "o_orderstatus = 'F' and o_orderpriority < '3'",
    "d": "o_orderstatus = 'P'",
    "e": "o_orderstatus = 'P' and o_orderpriority < '3'",
}
_CENTS = "cast(round(o_totalprice * 100) as bigint)"


def sums(spark, sf):
    """One row per level, place and year with the sums above."""
    orders = table(spark, sf, "orders").join(
        customers(spark, sf), F.col("o_custkey") == F.col("c_custkey")
    ).withColumn("year", F.year("o_orderdate"))
    measures = [F.sum(F.expr(f"case when {e} then {_CENTS} else 0 end")).alias(n) for n, e in _SUMS.items()]
    county = orders.groupBy("year", "c_custkey", "c_name", "c_nationkey", "n_name").agg(*measures).select(
        F.lit("county").alias("level"), F.concat("c_name", F.lit(", "), "n_name").alias("name"),
        F.col("c_nationkey").cast("string").alias("state"), F.col("c_custkey").cast("string").alias("county"),
        "year", *_SUMS,
    )
    state = orders.groupBy("year", "c_nationkey", "n_name").agg(*measures).select(
        F.lit("state").alias("level"), F.col("n_name").alias("name"),
        F.col("c_nationkey").cast("string").alias("state"), F.lit(None).cast("string").alias("county"),
        "year", *_SUMS,
    )
    return state.unionByName(county)


_MEASURES = ", ".join(f"cast(sum(case when {e} then {_CENTS} else 0 end) as bigint) as {n}" for n, e in _SUMS.items())
SUMS = f"""o as (select cast(year(o_orderdate) as integer) as year, * from orders join {_FROM.replace('customer', 'customer on o_custkey = c_custkey', 1)}),
    sums as (
    select 'county' as level, c_name || ', ' || n_name as name, cast(c_nationkey as varchar) as state,
        cast(c_custkey as varchar) as county, year, {_MEASURES} from o group by year, c_custkey, c_name, c_nationkey, n_name
    union all select 'state', n_name, cast(c_nationkey as varchar), null, year, {_MEASURES}
        from o group by year, c_nationkey, n_name)"""


def share(part: str, whole: str) -> str:
    """Text of a percentage with one decimal, cut and not rounded, so that both sides agree
    exactly. DIV stands for the whole-number division of either dialect."""
    tenths = f"(case when {whole} = 0 then 0 else ({part} * 1000) DIV {whole} end)"
    return f"(cast({tenths} DIV 10 as varchar(20)) || '.' || cast({tenths} % 10 as varchar(20)))"


def count(name: str) -> str:
    return f"cast({name} as varchar(20))"


def in_sql(text: str) -> str:
    return text.replace(" DIV ", " // ")


# Variables of the detailed table: id → (label, text). Suppression codes stand in for one
# measure of one state.
_TREE = {
    "B18120_001E": ("Estimate!!Total:", count("t")),
    "B18120_002E": ("Estimate!!Total:!!In the labor force:", share("a", "t")),
    "B18120_003E": ("Estimate!!Total:!!In the labor force:!!Employed:", share("b", "a")),
    "B18120_004E": ("Estimate!!Total:!!In the labor force:!!Employed:!!With a disability",
                    share("c", "b")),
    "B18120_005E": ("Estimate!!Total:!!Not in labor force:", count("d")),
    "B18120_006E": ("Estimate!!Total:!!Not in labor force:!!No disability", f"case when state = '3' then '-666666666' else {share('e', 'd')} end"),
    "B18120_005PE": ("Percent!!Total:!!Not in labor force:!!With a disability", share("e", "d")),
    "B18120_009PE": ("Percent!!Total:!!Of nothing", share("e", "t")),
}


def rows(spark, sf, table_id, tree):
    """Survey rows of a tree of variables, landed as a table of their own."""
    cells = [F.lit(v) for v in tree]
    texts = [F.expr(text) for _, text in tree.values()]
    landed = sums(spark, sf).select(
        F.lit(table_id).alias("table_id"), "year", "level", "name", "state", "county",
        F.map_from_arrays(F.array(*cells), F.array(*texts)).alias("vars"),
    )
    # One file per core: a row is wide, and everything after works row by row.
    files = spark.sparkContext.defaultParallelism
    return materialise(landed.repartition(files, "year", "state", "county"), "landed")


def meta(data, tree):
    """Metadata for every year the data has."""
    entries = [
        F.struct(
            F.lit(v).alias("var_id"), F.lit(i).alias("position"), F.lit(label).alias("label"),
            F.lit(v[:-2] + "E" if v.endswith("PE") and v[:-2] + "E" in tree else None).cast("string").alias("pe_parent"),
            F.lit(v.endswith("PE")).alias("has_parent_entry"),
        )
        for i, (v, (label, _)) in enumerate(tree.items())
    ]
    return data.select("table_id", "year").distinct().select("*", F.inline(F.array(*entries)))


def long(df):
    return df.select(
        "year", "level", "state", F.coalesce("county", F.lit("")).alias("county"),
        F.explode("values").alias("var_id", "value"),
    )


def _number(text: str) -> str:
    return f"case when cast({text} as double) >= -100000000 then cast({text} as double) end"


_PARSED = f"{SUMS}, v as (select year, level, name, state, county, " + ", ".join(
    f"{_number(in_sql(text))} as v{i}" for i, (_, text) in enumerate(_TREE.values())
) + " from sums)"


def _melt(columns: dict[str, str], source: str) -> str:
    return " union all ".join(
        f"select year, level, state, coalesce(county, '') as county, '{v}' as var_id, {e} as value from {source}"
        for v, e in columns.items()
    )


_RAW = {v: f"v{i}" for i, v in enumerate(_TREE)}


@query("a2_percent_columns", f"with {_PARSED}, m as ({_melt(_RAW, 'v')}) " + """
    select year, var_id, max(value) as top, coalesce(max(value) <= 100.5, true) as is_percent from m group by 1, 2""")
def a2(spark, sf):
    data = H.numbers(rows(spark, sf, "B18120", _TREE))
    cells = data.select("table_id", "year", F.explode("values").alias("var_id", "value"))
    return H.percent_columns(cells).drop("table_id")


@query("a3_pe_to_count", f"with {_PARSED} " + _melt(
    {**_RAW, "B18120_005PE": "case when v4 <> 0 then v6 / 100.0 * v4 end", "B18120_009PE": "cast(null as double)"}, "v"))
def a3(spark, sf):
    data = rows(spark, sf, "B18120", _TREE)
    parents = meta(data, _TREE).filter(classify(F.col("var_id")) == "PE")
    return long(H.pe_to_count(H.numbers(data), parents))


# First pass in SQL: what is a percentage is told by each year's maxima.
_FIRST = """tops as (select year, max(v1) as m1, max(v2) as m2, max(v3) as m3, max(v5) as m5 from v group by year),
    c1 as (select v.*, case when coalesce(m1 <= 100.5, true) then case when v0 <> 0 then v1 / 100.0 * v0 end else v1 end as w1,
        m2, m3, m5 from v join tops using (year)),
    c2 as (select *, case when coalesce(m2 <= 100.5, true) then case when w1 <> 0 then v2 / 100.0 * w1 end else v2 end as w2,
        case when coalesce(m5 <= 100.5, true) then case when v4 <> 0 then v5 / 100.0 * v4 end else v5 end as w5 from c1),
    c3 as (select *, case when coalesce(m3 <= 100.5, true) then case when w2 <> 0 then v3 / 100.0 * w2 end else v3 end as w3
        from c2)"""
_CONVERTED = {**_RAW, "B18120_002E": "w1", "B18120_003E": "w2", "B18120_004E": "w3", "B18120_006E": "w5"}


@query("a4_percent_to_count", f"with {_PARSED}, {_FIRST} " + _melt(_CONVERTED, "c3"))
def a4(spark, sf):
    data = rows(spark, sf, "B18120", _TREE)
    estimates = meta(data, _TREE).filter(classify(F.col("var_id")) == "E")
    return long(H.percent_to_count(H.numbers(data), estimates))


# Labelled columns in column order; the third comes before its parent, which is still a
# percentage then, and so stays as it is.
_LABELLED = {
    "S1811_001E": ("Workers", count("t")),
    "S1811_002E": ("Workers | Private", share("a", "t")),
    "S1811_003E": ("Workers | Public | Federal", share("c", "b")),
    "S1811_004E": ("Workers | Public", share("b", "t")),
    "S1811_005E": ("Workers | Private | For profit", share("b", "a")),
    "S1811_006E": ("Workers | Private | For profit | Large", share("c", "b")),
    "S1811_007E": ("Retired | Private", share("e", "d")),
    "S1811_008E": ("Small", share("e", "d")),
    "S1811_009E": ("Small | Part", share("c", "b")),
}
_LABELLED_ROWS = f"{SUMS}, v as (select year, level, name, state, county, " + ", ".join(
    f"{_number(in_sql(text))} as v{i}" for i, (_, text) in enumerate(_LABELLED.values())
) + " from sums)"
# Live maxima of the columns that serve as parents.
_SECOND = """p1 as (select *, case when max(v1) over y <= 100.5 and max(v0) over y > 100.5
        then case when v0 <> 0 then v1 / 100.0 * v0 end else v1 end as w1,
        case when max(v3) over y <= 100.5 and max(v0) over y > 100.5
        then case when v0 <> 0 then v3 / 100.0 * v0 end else v3 end as w3,
        case when max(v2) over y <= 100.5 and max(v3) over y > 100.5
        then case when v3 <> 0 then v2 / 100.0 * v3 end else v2 end as w2 from v window y as (partition by year)),
    p2 as (select *, case when max(v4) over y <= 100.5 and max(w1) over y > 100.5
        then case when w1 <> 0 then v4 / 100.0 * w1 end else v4 end as w4 from p1 window y as (partition by year)),
    p3 as (select *, case when max(v5) over y <= 100.5 and max(w4) over y > 100.5
        then case when w4 <> 0 then v5 / 100.0 * w4 end else v5 end as w5 from p2 window y as (partition by year))"""


@query("a5_labelled_percent_to_count", f"with {_LABELLED_ROWS}, {_SECOND} " + _melt(
    dict(zip(_LABELLED, ["v0", "w1", "w2", "w3", "w4", "w5", "v6", "v7", "v8"])), "p3"))
def a5(spark, sf):
    data = rows(spark, sf, "S1811", _LABELLED)
    names = meta(data, _LABELLED).withColumnRenamed("label", "name")
    return long(H.labelled_percent_to_count(H.numbers(data), names))


# Every customer is a variable below its nation and region; the path to it repeats widely.
_NODE = "case when c_custkey % 3 = 0 then '!!' || c_mktsegment else '' end"
_NODES = f"""with src as (
    select 'T' as table_id, 2012 as year, 'C' || c_custkey as var_id, c_custkey as position,
        'Estimate!!Total:!!' || r_name || ':!!' || n_name || {_NODE} || '!!' || c_name as label from {_FROM}
    union all select 'T', 2012, 'N' || n_nationkey, -1000 + n_nationkey, 'Estimate!!Total:!!' || r_name || '!!' || n_name
        from nation join region on n_regionkey = r_regionkey
    union all select 'T', 2012, 'D' || n_nationkey, -500 + n_nationkey, 'Estimate!!Total!!' || r_name || ':!!' || n_name || ':'
        from nation join region on n_regionkey = r_regionkey where n_nationkey % 2 = 0
    union all select 'T', 2012, 'R' || r_regionkey, -2000 + r_regionkey, 'Estimate!!Total:!!' || r_name from region)"""


@query("j5_nearest_parent", f"""{_NODES},
    k as (select var_id, position, {chain_sql('label')} as chain from src),
    owner as (select chain, arg_max(var_id, position) as owner from k group by 1),
    e as (select var_id, chain[1:n] as prefix, n from k, lateral (select unnest(range(1, len(chain))) as n))
    select var_id, arg_max(owner, n) as parent from e join owner o on o.chain = e.prefix group by 1""")
def j5(spark, sf):
    base = customers(spark, sf)
    nation = table(spark, sf, "nation").join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))

    def nodes(df, var_id, position, label):
        return df.select(
            F.lit("T").alias("table_id"), F.lit(2012).alias("year"), F.expr(var_id).alias("var_id"),
            F.expr(position).cast("bigint").alias("position"), F.expr(label).alias("label"),
        )

    total = "'Estimate!!Total:!!' || r_name"
    found = [
        nodes(base, "'C' || c_custkey", "c_custkey", f"{total} || ':!!' || n_name || {_NODE} || '!!' || c_name"),
        nodes(nation, "'N' || n_nationkey", "-1000 + n_nationkey", f"{total} || '!!' || n_name"),
        nodes(nation.filter("n_nationkey % 2 = 0"), "'D' || n_nationkey", "-500 + n_nationkey",
              "'Estimate!!Total!!' || r_name || ':!!' || n_name || ':'"),
        nodes(table(spark, sf, "region"), "'R' || r_regionkey", "-2000 + r_regionkey", total),
    ]
    stacked, *rest = found
    for other in rest:
        stacked = stacked.unionByName(other)
    return H.nearest_parent(stacked).select("var_id", "parent")


# ---- whitelist and cleaned tables ------------------------------------------------------

_GEO_SQL = """year, '1-Year' as survey_type,
    case when level = 'state' then '0400000US' || lpad(state, 2, '0')
         else '0500000US' || lpad(state, 2, '0') || lpad(county, cast(greatest(3, len(county)) as integer), '0') end as geo_id, level,
    case when level = 'state' then name else string_split(name, ', ')[2] end as state, lpad(state, 2, '0') as state_fips,
    case when level = 'state' then '' else string_split(name, ', ')[1] end as county,
    case when level = 'state' then '' else lpad(county, cast(greatest(3, len(county)) as integer), '0') end as county_fips,
    lpad(state, 2, '0') || case when level = 'state' then '' else lpad(county, cast(greatest(3, len(county)) as integer), '0') end as fips"""


def _published(table_id: str, held: dict[str, str]) -> str:
    from tallyloom.fixed import PUBLISHED_COLUMNS

    return ", ".join(f"{held.get(c, 'cast(null as double)')} as {c}" for c in PUBLISHED_COLUMNS[table_id].values())


@query("p12_apply_schema", """
    select cast(year(o_orderdate) as integer) as year, cast(o_custkey as varchar) as fips,
        o_totalprice as pop_total, o_totalprice / 2 as dis_fulltime from orders""")
def p12(spark, sf):
    wide = table(spark, sf, "orders").select(
        F.year("o_orderdate").alias("year"), F.col("o_custkey").cast("string").alias("fips"),
        F.col("o_totalprice").alias("Total"), F.col("o_orderstatus").alias("Total | Other"),
        (F.col("o_totalprice") / 2).alias("Worked full-time, year round | With a disability"),
    )
    return shape.apply_schema(wide, "B18121")


@query("e1_clean_detailed", f"with {_PARSED}, {_FIRST} select 'B18120' as table_id, {_GEO_SQL}, " + _published("B18120", {
    "pop_total": "v0", "in_labor_force": "w1", "employed_total": "w2", "dis_employed": "w3",
    "not_in_labor_force": "v4", "nodis_not_in_lf": "w5",
}) + " from c3")
def e1_detailed(spark, sf):
    data = rows(spark, sf, "B18120", _TREE)
    return clean_table(data, meta(data, _TREE), "B18120")


# An early subject table: flat labels that only canonical names make children of the employed.
_SUBJECT = {
    "S1811_C01_001E": ("Estimate!!With a Disability!!Employed Population Age 16 and Over", count("t")),
    "S1811_C01_002E": ("Estimate!!With a Disability!!CLASS OF WORKER!!Federal government workers",
                       share("a", "t")),
    "S1811_C01_003E": ("Estimate!!With a Disability!!OCCUPATION!!Service occupations", share("b", "t")),
    "S1811_C02_003E": ("Estimate!!With a Disability!!INDUSTRY!!Construction", share("c", "t")),
    "S1811_C03_003E": ("Estimate!!Percent!!With a Disability!!INDUSTRY!!Retail trade", share("c", "t")),
    "S1811_C01_004E": ("Estimate!!With a Disability!!Population Age 16 and Over", count("a")),
    "S1811_C01_005E": ("Estimate!!With a Disability!!EMPLOYMENT STATUS!!Employed", share("b", "a")),
    "S1811_C01_006E": ("Estimate!!With a Disability!!EMPLOYMENT STATUS!!Employed", share("c", "a")),
}
_SUBJECT_ROWS = f"{SUMS}, v as (select year, level, name, state, county, " + ", ".join(
    f"{_number(in_sql(text))} as v{i}" for i, (_, text) in enumerate(_SUBJECT.values())
) + " from sums)"


@query("e1_clean_subject", f"with {_SUBJECT_ROWS} select 'S1811' as table_id, {_GEO_SQL}, " + _published("S1811", {
    "dis_employed_total": "v0", "dis_sector_federal_govt": "case when v0 <> 0 then v1 / 100.0 * v0 end",
    "dis_occ_service": "case when v0 <> 0 then v2 / 100.0 * v0 end",
    "dis_ind_construction": "case when v0 <> 0 then v3 / 100.0 * v0 end",
    "dis_pop_16_plus": "v5", "dis_employed": "case when v5 <> 0 then v6 / 100.0 * v5 end",
}) + " from v")
def e1_subject(spark, sf):
    data = rows(spark, sf, "S1811", _SUBJECT)
    return clean_table(data, meta(data, _SUBJECT), "S1811")
