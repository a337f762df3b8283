"""Queries of the scalar operators: labels, ids, numbers, geography and names."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyloom.functions import labels as L
from tallyloom.functions import numbers as N
from tallyloom.functions import series as S
from tallyloom.operators import catalogue as C
from tallyloom.operators import geography as G
from tallyloom.operators import naming as M
from tallyloom.operators import shape as H
from workload import query, table

# One label per customer; the same text builds the input in Spark and in the SQL twin.
LABEL = """
    case c_custkey % 6
        when 0 then 'Estimate!!Total:'
        when 1 then 'Estimate!!Total:!!' || r_name || ':!!' || n_name
        when 2 then 'Estimate!!' || c_mktsegment || '!!' || lower(c_mktsegment) || '!! ' || n_name || ' :'
        when 3 then 'Percent!!Total:!!' || r_name || '!!estimate!!!!' || c_name
        when 4 then 'Estimate!!Percent ' || r_name || ':!!' || n_name || '!!' || c_mktsegment || '!!' || c_name
        else 'estimate!! '
    end
"""
_FROM = "customer join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey"


def customers(spark, sf):
    nation = table(spark, sf, "nation")
    region = table(spark, sf, "region")
    return (
        table(spark, sf, "customer")
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    )


def chain_sql(label: str) -> str:
    return f"""list_filter(list_transform(string_split({label}, '!!'),
        lambda p: regexp_replace(trim(p), ':+$', '')), lambda p: p <> '' and lower(p) <> 'estimate')"""


def name_steps(source: str, keys: str) -> str:
    """CTEs l1, l2, l3 and named(keys, label, name) over `source`, which has `keys` and label."""
    return f"""
    l1 as (select {keys}, label, {chain_sql('label')} as parts from {source}),
    l2 as (select {keys}, label, case when len(parts) > 1 and lower(parts[1]) = 'total'
           then parts[2:] else parts end as parts from l1),
    l3 as (select {keys}, label, list_filter(parts, lambda p, i: i = 1 or lower(p) <> lower(parts[i - 1])) as parts
           from l2),
    named as (select {keys}, label, case when len(parts) = 0 then 'Total'
              else array_to_string(parts, ' | ') end as name from l3)"""


_LABELS = f"with src as (select c_custkey, {LABEL} as label from {_FROM})"


@query("p1_label_to_name", f"{_LABELS}, {name_steps('src', 'c_custkey')} select c_custkey, name from named")
def p1(spark, sf):
    return customers(spark, sf).select("c_custkey", L.label_to_name(F.expr(LABEL)).alias("name"))


@query("p2_label_chain", f"""
    {_LABELS}, a as (select c_custkey, {chain_sql('label')} as parts from src)
    select c_custkey, array_to_string(list_filter(parts,
        lambda p, i: i = 1 or lower(p) <> lower(parts[i - 1])), '/') as chain from a""")
def p2(spark, sf):
    chain = L.label_chain(F.expr(LABEL))
    return customers(spark, sf).select("c_custkey", F.array_join(chain, "/").alias("chain"))


# Variables: table by market segment, year by region, a few names shared by very many.
def variables(spark, sf):
    return customers(spark, sf).select(
        F.col("c_mktsegment").alias("table_id"), (F.col("n_regionkey") + 2010).alias("year"),
        F.expr(VARIABLE_ID).alias("var_id"), F.expr(LABEL).alias("label"), F.col("c_custkey").alias("position"),
    )


VARIABLE_ID = "'B' || c_custkey || case when c_custkey % 6 = 3 then '_001PE' else '_001E' end"
_VARIABLES = f"""with src as (select c_mktsegment as table_id, n_regionkey + 2010 as year, {VARIABLE_ID} as var_id,
    {LABEL} as label, c_custkey as position from {_FROM})"""
_DERIVED = r"""case when regexp_matches(name, '(?i)\bpercent\b')
    then regexp_replace(name, '(?i)\bpercent\b', 'Number [derived]', 'g') else name || ' [derived count]' end"""


@query("p3_assign_names", f"""
    {_VARIABLES}, {name_steps('src', 'table_id, year, var_id, position')},
    d as (select *, case when var_id like '%PE' then {_DERIVED} else name end as base,
          var_id like '%PE' as pe from named),
    r as (select *, row_number() over (partition by table_id, year, base order by pe, case when pe then -position else position end) as nth from d)
    select table_id, year, var_id, case when nth = 1 then base else base || ' (' || var_id || ')' end as name from r""")
def p3(spark, sf):
    """The metadata list variables in the reverse of the header's order."""
    listed = variables(spark, sf).withColumn("meta_position", -F.col("position"))
    return M.assign_names(listed).select("table_id", "year", "var_id", "name")


@query("p4_derived_name", f"""
    {_LABELS}, {name_steps('src', 'c_custkey')} select c_custkey, {_DERIVED} as name from named""")
def p4(spark, sf):
    return customers(spark, sf).select(
        "c_custkey", L.derived_name(L.label_to_name(F.expr(LABEL))).alias("name")
    )


# Ids of subject-table variables: one per part, the column group told by the size.
PART_ID = """
    case p_partkey % 9
        when 0 then 'ucgid'
        when 1 then 'NAME'
        when 2 then 'S' || p_size || '_C02_' || lpad(cast(p_partkey - p_partkey % 3 as varchar(20)), 9, '0') || 'E'
        when 3 then 'S' || p_size || '_C03_' || lpad(cast(p_partkey as varchar(20)), 9, '0') || 'PE'
        when 4 then 'S' || p_size || '_C03_' || lpad(cast(p_partkey as varchar(20)), 9, '0') || 'EA'
        when 5 then 'B' || p_partkey || '_' || p_size || 'M'
        when 6 then 'B' || p_partkey || '_' || p_size || 'PM'
        when 7 then 'B' || p_partkey || '_' || p_size || 'PE'
        else 'NAME.' || p_size
    end
"""


@query("p5_classify", f"""
    with v as (select p_partkey, {PART_ID} as var_id from part)
    select p_partkey, case when var_id in ('for', 'in', 'ucgid') or position('_' in var_id) = 0 then null
        when var_id like '%EA' or var_id like '%MA' then null when var_id like '%PE' then 'PE'
        when var_id like '%PM' or var_id like '%M' then 'M' when var_id like '%E' then 'E' end as class from v""")
def p5(spark, sf):
    return table(spark, sf, "part").select("p_partkey", L.classify(F.expr(PART_ID)).alias("class"))


# Estimates and percentages whose partners exist for part of the ids: four ids per part.


def part_meta(spark, sf):
    key = F.lpad(F.col("p_partkey").cast("string"), 9, "0")
    subject = F.concat(F.lit("S"), F.col("p_size").cast("string"))
    ids = [
        F.when(F.col("p_partkey") % 2 == 0, F.concat(subject, F.lit("_C01_"), key, F.lit("E"))),
        F.when(F.col("p_partkey") % 3 == 0, F.concat(subject, F.lit("_C02_"), key, F.lit("E"))),
        F.concat(subject, F.lit("_C03_"), key, F.lit("PE")),
        F.concat(subject, F.lit("_C04_"), key, F.lit("E")),
        F.concat(F.lit("B"), key, F.lit("_001PE")),
    ]
    exploded = table(spark, sf, "part").select(
        F.col("p_type").alias("table_id"), F.lit(2012).alias("year"), "p_partkey", "p_brand",
        F.explode(F.filter(F.array(*ids), lambda i: i.isNotNull())).alias("var_id"),
    )
    label = F.when(F.col("p_partkey") % 5 < 3, F.concat(F.lit("Estimate!!PERCENT "), "p_brand")).otherwise(F.col("p_brand"))
    return exploded.withColumn("label", label).drop("p_brand")


_KEY = "lpad(cast(p_partkey as varchar), 9, '0')"
_META = f"""with ids as (
    select p_type as table_id, 2012 as year, p_partkey, p_brand, 'S' || p_size || '_C01_' || {_KEY} || 'E' as var_id
        from part where p_partkey % 2 = 0
    union all select p_type, 2012, p_partkey, p_brand, 'S' || p_size || '_C02_' || {_KEY} || 'E' from part where p_partkey % 3 = 0
    union all select p_type, 2012, p_partkey, p_brand, 'S' || p_size || '_C03_' || {_KEY} || 'PE' from part
    union all select p_type, 2012, p_partkey, p_brand, 'S' || p_size || '_C04_' || {_KEY} || 'E' from part
    union all select p_type, 2012, p_partkey, p_brand, 'B' || {_KEY} || '_001PE' from part),
    meta as (select table_id, year, p_partkey, var_id,
        case when p_partkey % 5 < 3 then 'Estimate!!PERCENT ' || p_brand else p_brand end as label from ids)"""


@query("p6_pe_parent", f"""{_META},
    c as (select *, case when var_id like 'S%' then regexp_replace(var_id, '_C\\d+_(\\d+)PE$', '_C01_\\1E')
          else regexp_replace(var_id, 'PE$', 'E') end as wanted from meta where var_id like '%PE')
    select c.table_id, c.var_id, m.var_id as pe_parent from c left join meta m
        on m.table_id = c.table_id and m.year = c.year and m.var_id = c.wanted""")
def p6(spark, sf):
    return M.pe_parent(part_meta(spark, sf)).select("table_id", "var_id", "pe_parent")


@query("p7_drop_redundant_pe", f"""{_META}
    select table_id, var_id from meta m where not (var_id like 'S%PE' and exists (select 1 from meta o
        where o.table_id = m.table_id and o.year = m.year
          and o.var_id = regexp_replace(m.var_id, '_C\\d+_(\\d+)PE$', '_C02_\\1E')))""")
def p7(spark, sf):
    return M.drop_redundant_pe(part_meta(spark, sf)).select("table_id", "var_id")


@query("p8_drop_redundant_pct", f"""{_META}
    select table_id, var_id from meta m where not (regexp_matches(var_id, '^S\\d+_C\\d+_\\d+E$')
        and lower(label) like '%percent%' and exists (select 1 from meta o
        where o.table_id = m.table_id and o.year = m.year
          and o.var_id = regexp_replace(m.var_id, '_C\\d+_(\\d+)E$', '_C02_\\1E')))""")
def p8(spark, sf):
    return M.drop_redundant_pct(part_meta(spark, sf)).select("table_id", "var_id")


NUMBER_TEXT = """
    case c_custkey % 9
        when 0 then '-666666666' when 1 then 'abc' when 2 then '1d' when 3 then ' ' || c_custkey || ' '
        when 4 then '' when 5 then null when 6 then '-222222222.0' when 7 then '1.5e3'
        else cast(c_acctbal as varchar(30))
    end
"""
_PARSED = r"""case when regexp_full_match(trim(x), '[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?')
    then cast(trim(x) as double) end"""


@query("p9_census_number", f"""
    with t as (select c_custkey, {NUMBER_TEXT} as x from customer), n as (select c_custkey, {_PARSED} as v from t)
    select c_custkey, case when v >= -100000000 then v end as value from n""")
def p9(spark, sf):
    return table(spark, sf, "customer").select("c_custkey", N.census_number(F.expr(NUMBER_TEXT)).alias("value"))


@query("p25_to_number", f"""
    with t as (select c_custkey, {NUMBER_TEXT} as x from customer), n as (select c_custkey, {_PARSED} as v from t)
    select c_custkey, v as value, case when v = floor(v) then cast(v as integer) end as year from n""")
def p25(spark, sf):
    text = F.expr(NUMBER_TEXT)
    return table(spark, sf, "customer").select(
        "c_custkey", N.to_number(text).alias("value"), N.to_year(text).alias("year")
    )


S1811_NAME = """
    case c_custkey % 7
        when 0 then 'With a Disability | CLASS OF WORKER | ' || c_name
        when 1 then 'No Disability | EMPLOYMENT STATUS | ' || c_mktsegment || ' | ' || c_name
        when 2 then 'Total Civilian Noninstitutionalized Population | OCCUPATION | ' || c_name
        when 3 then 'With a Disability | INDUSTRY | ' || c_name
        when 4 then 'With a Disability | Employed Population Age 16 and Over | CLASS OF WORKER | '
            || 'Customer#' || lpad(cast(c_custkey - 4 as varchar(20)), 9, '0')
        when 5 then 'With a Disability | ' || c_name
        else 'INDUSTRY | ' || c_name
    end
"""
_EMPLOYED = "Employed Population Age 16 and Over | "


def _canon_1811(name: str) -> str:
    text = name
    for old, new in [("CLASS OF WORKER", _EMPLOYED), ("EMPLOYMENT STATUS", "Population Age 16 and Over | "),
                     ("OCCUPATION", _EMPLOYED), ("INDUSTRY", _EMPLOYED)]:
        text = (f"regexp_replace({text}, '^(With a Disability|No Disability|"
                f"Total Civilian Noninstitutionalized Population) \\| {old} \\| ', '\\1 | {new}{old} | ')")
    return text


@query("p10_canon_s1811", f"""
    with t as (select c_nationkey + 2000 as year, c_custkey as position, {S1811_NAME} as name from customer),
    c as (select *, {_canon_1811('name')} as new_name from t),
    f as (select *, row_number() over (partition by year, new_name order by position) as nth from c
          where new_name <> name and not exists (select 1 from t where t.year = c.year and t.name = c.new_name))
    select c.position, case when f.nth = 1 then c.new_name else c.name end as name
    from c left join f on f.year = c.year and f.position = c.position""")
def p10(spark, sf):
    names = table(spark, sf, "customer").select(
        F.lit("S1811").alias("table_id"), (F.col("c_nationkey") + 2000).alias("year"),
        F.col("c_custkey").cast("string").alias("var_id"), F.col("c_custkey").alias("position"),
        F.expr(S1811_NAME).alias("name"),
    )
    return M.canonical_names(names).select("position", "name")


S1810_NAME = """
    case c_custkey % 10
        when 0 then 'Subject | ' || c_name
        when 1 then 'Subject | Total civilian noninstitutionalized population | ' || c_name
        when 2 then 'With a disability | Subject | ' || c_name
        when 3 then 'With a disability | Subject | Total civilian noninstitutionalized population | ' || c_name
        when 4 then 'SEX | ' || c_name
        when 5 then 'RACE AND HISPANIC OR LATINO ORIGIN | One Race | ' || c_name
        when 6 then 'With a disability | AGE | ' || c_name
        when 7 then 'With a disability | Hispanic or Latino (of any race)'
        when 8 then 'With a disability | Total civilian noninstitutionalized population | ' || c_name
        else 'SEXES | ' || c_name
    end
"""
_BASE = "Total civilian noninstitutionalized population"
_CATEGORY = "(SEX|AGE|RACE AND HISPANIC OR LATINO ORIGIN|DISABILITY TYPE BY DETAILED AGE)( \\| |$)"


@query("p11_canon_s1810", f"""
    with t as (select c_custkey, {S1810_NAME} as name from customer)
    select c_custkey, case
        when name like 'Subject | {_BASE}%' then name[11:]
        when name like 'Subject | %' then '{_BASE} | ' || name[11:]
        when name like '% | Subject | {_BASE}%' then replace(name, ' | Subject | ', ' | ')
        when name like '% | Subject | %' then replace(name, ' | Subject | ', ' | {_BASE} | ')
        when regexp_matches(name, '^{_CATEGORY}') then replace('{_BASE} | ' || name, ' | One Race | ', ' | ')
        when regexp_matches(name, '^With a disability \\| {_CATEGORY}')
            then replace('With a disability | {_BASE} | ' || name[21:], ' | One Race | ', ' | ')
        when name = 'With a disability | Hispanic or Latino (of any race)'
            then 'With a disability | {_BASE} | RACE AND HISPANIC OR LATINO ORIGIN | Hispanic or Latino (of any race)'
        else name end as name from t""")
def p11(spark, sf):
    return table(spark, sf, "customer").select("c_custkey", L.canon_s1810(F.expr(S1810_NAME)).alias("name"))


# Raw geography: customers as counties, some without a comma in the name or without a code.
RAW_NAME = """
    case c_custkey % 5 when 0 then c_name when 1 then null when 2 then c_name || ', Old Town, ' || n_name
        else c_name || ', ' || n_name end
"""


def raw_geography(spark, sf):
    return customers(spark, sf).select(
        "c_custkey", F.when(F.col("c_custkey") % 4 == 0, "state").otherwise("county").alias("level"),
        F.expr(RAW_NAME).alias("name"),
        F.when(F.col("c_custkey") % 13 != 0, F.col("c_nationkey").cast("string")).alias("state"),
        F.when(F.col("c_custkey") % 7 != 0, (F.col("c_custkey") % 1200).cast("string")).alias("county"),
    )


_GEO = f"""with geo as (select c_custkey, case when c_custkey % 4 = 0 then 'state' else 'county' end as level,
    {RAW_NAME} as name, case when c_custkey % 13 <> 0 then cast(c_nationkey as varchar) end as state,
    case when c_custkey % 7 <> 0 then cast(c_custkey % 1200 as varchar) end as county from {_FROM}),
    pad as (select *, lpad(coalesce(state, ''), 2, '0') as state_fips,
        case when level = 'state' or county is null then '' when len(county) >= 3 then county
             else lpad(county, 3, '0') end as county_fips from geo),
    cut as (select *, case when level = 'state' then '' else
            regexp_extract(coalesce(name, ''), '^(.*?)(, [^,]*)?$', 1) end as county_name,
        case when level = 'state' or position(', ' in coalesce(name, '')) = 0 then coalesce(name, '')
             else trim(list_last(string_split(name, ', '))) end as state_name from pad)"""


@query("p14_pad_fips", f"{_GEO} select c_custkey, state_fips, county_fips from pad")
def p14(spark, sf):
    return G.pad_fips(raw_geography(spark, sf)).select("c_custkey", "state_fips", "county_fips")


@query("p15_geo_keys", f"""{_GEO}
    select c_custkey, '1-Year' as survey_type, case when level = 'state' then '0400000US' || state_fips
        else '0500000US' || state_fips || county_fips end as geo_id, level, state_name as state, state_fips,
        county_name as county, county_fips, state_fips || county_fips as fips from cut""")
def p15(spark, sf):
    return G.geo_keys(raw_geography(spark, sf)).select(
        "c_custkey", "survey_type", "geo_id", "level", "state", "state_fips", "county", "county_fips", "fips"
    )


@query("p16_split_name", f"{_GEO} select c_custkey, state_name, county_name from cut")
def p16(spark, sf):
    return G.split_name(raw_geography(spark, sf)).select("c_custkey", "state_name", "county_name")


@query("p17_fill_geo", f"""{_GEO} select c_custkey, coalesce(state, '') as state, coalesce(county, '') as county,
    coalesce(county, '') as county_fips from geo""")
def p17(spark, sf):
    raw = raw_geography(spark, sf).withColumn("county_fips", F.col("county"))
    return G.fill_geo(raw).select("c_custkey", "state", "county", "county_fips")


RAW_COLUMN = """
    case p_partkey % 6
        when 0 then p_name || ' | ' || p_type || ' >> ' || p_brand
        when 1 then p_size || ' to ' || p_name || '!'
        when 2 then '__' || p_brand || '  (' || p_partkey || ')'
        when 3 then '%%%'
        when 4 then repeat(p_name || ' ', 40)
        else p_name
    end
"""
_SANITIZE = f"""
    a as (select *, trim(regexp_replace(replace(replace(name, ' | ', '__'), ' >> ', '__'), '[^a-zA-Z0-9_]', '_', 'g'), '_') as s0
          from src),
    b as (select *, lower(regexp_replace(s0, '_+', '_', 'g')) as s1 from a),
    c as (select *, case when regexp_matches(s1, '^[0-9]') then 'n_' || s1 else s1 end as s2 from b),
    safe as (select *, case when s2 = '' then 'unknown' else s2[1:300] end as clean from c)"""


@query("p18_sanitize_name", f"""
    with src as (select p_partkey, {RAW_COLUMN} as name from part), {_SANITIZE}
    select p_partkey, clean as column_name from safe""")
def p18(spark, sf):
    return table(spark, sf, "part").select("p_partkey", L.sanitize_name(F.expr(RAW_COLUMN)).alias("column_name"))


@query("p19_sanitize_columns", f"""
    with src as (select p_partkey, p_type, {RAW_COLUMN} as name from part), {_SANITIZE},
    r as (select *, row_number() over (partition by p_type, clean order by p_partkey) as nth from safe)
    select p_partkey, case when nth = 1 then clean else clean || '_' || (nth - 1) end as column_name from r""")
def p19(spark, sf):
    names = table(spark, sf, "part").select(
        "p_type", "p_partkey", F.expr(RAW_COLUMN).alias("name"), F.col("p_partkey").alias("position")
    )
    return H.sanitize_names(names, ["p_type"]).select("p_partkey", "column_name")


@query("p28_rate", """
    select l_orderkey, l_linenumber, l_extendedprice / nullif(case when l_linenumber = 3 then 0 else l_quantity end, 0)
        as unit_price from lineitem""")
def p28(spark, sf):
    quantity = F.when(F.col("l_linenumber") == 3, F.lit(0.0)).otherwise(F.col("l_quantity"))
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", N.rate(F.col("l_extendedprice"), quantity).alias("unit_price")
    )


@query("p29_log_column", """
    select o_orderkey, round(ln(case when o_orderkey % 10 = 0 then null else o_totalprice end), 9) as log_price
    from orders""")
def p29(spark, sf):
    price = F.when(F.col("o_orderkey") % 10 == 0, F.lit(0.0)).otherwise(F.col("o_totalprice"))
    return table(spark, sf, "orders").select("o_orderkey", F.round(N.log_column(price), 9).alias("log_price"))


def series_list(spark, sf):
    """A catalogue with one series per part."""
    return table(spark, sf, "part").select(
        F.expr(SERIES_ID).alias("series_id"),
        F.expr("'(' || case when p_partkey % 2 = 0 then 'unadj' else 'sadj' end || ') ' || p_name").alias("title"),
        F.when(F.col("p_size") % 3 == 0, "A").otherwise("M").alias("periodicity"),
        F.when(F.col("p_size") % 4 == 0, "U").alias("seasonal"),
        F.when(F.col("p_size") % 7 != 0, (F.col("p_partkey") % 3).cast("int")).alias("disa_code"),
    )


# Two thirds unadjusted; a quarter of those have their adjusted twin among the rest.
SERIES_ID = """
    case when p_partkey % 3 = 2 then 'LNS1' || lpad(cast((p_partkey - 2) * 2 as varchar(20)), 9, '0')
         else 'LNU0' || lpad(cast(p_partkey as varchar(20)), 9, '0') end
"""
SERIES = f"""series as (select {SERIES_ID} as series_id,
    '(' || case when p_partkey % 2 = 0 then 'unadj' else 'sadj' end || ') ' || p_name as title,
    case when p_size % 3 = 0 then 'A' else 'M' end as periodicity,
    case when p_size % 4 = 0 then 'U' end as seasonal,
    case when p_size % 7 <> 0 then cast(p_partkey % 3 as integer) end as disa_code from part)"""


@query("p30_sa_counterpart", f"""with {SERIES}
    select 'LNS1' || series_id[5:] as series_id, replace(title, '(unadj)', '(sadj)') as title, 'S' as seasonal,
        periodicity, disa_code from series""")
def p30(spark, sf):
    return C.sa_counterpart(series_list(spark, sf))


@query("p31_join_texts", """
    select event_id, case when event_id % 3 = 0 then '' else event_type || '; ' end
        || cast(user_id as varchar) as footnotes from events""")
def p31(spark, sf):
    notes = F.array(
        F.struct(F.when(F.col("event_id") % 3 != 0, F.col("event_type")).alias("text")),
        F.struct(F.lit("").alias("text")),
        F.struct(F.col("user_id").cast("string").alias("text")),
    )
    return table(spark, sf, "events").select("event_id", S.join_texts(notes).alias("footnotes"))


@query("p32_correct_attribute", f"""with {SERIES}
    select series_id, case when series_id like 'LNU0%' and disa_code = 0 and periodicity = 'A' then 'M'
        else periodicity end as periodicity from series""")
def p32(spark, sf):
    wrong = F.col("series_id").startswith("LNU0") & (F.col("disa_code") == 0) & (F.col("periodicity") == "A")
    fixed = C.correct_attribute(series_list(spark, sf), wrong, "periodicity", "M")
    return fixed.select("series_id", "periodicity")
