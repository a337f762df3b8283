"""Queries of the long time series: decodes, dates, means, percent distributions."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyloom import fixed
from tallyloom.functions import series as S
from tallyloom.operators import timeseries as T
from tallyloom.plans.series import clean_series
from workload import query, table
from workload.relations import PERIOD

CODES = {
    "disa_code": "cast(o_orderkey % 4 as integer)",
    "sexs_code": "cast(o_custkey % 4 as integer)",
    "lfst_code": "cast(10 * (o_orderkey % 7) as integer)",
    "ages_code": "case when o_custkey % 3 = 0 then 8 when o_custkey % 3 = 1 then 65 end",
    "seasonal": "case o_orderstatus when 'F' then 'S' when 'O' then 'U' end",
    "race_code": "case when o_orderkey % 6 = 5 then null else cast(o_orderkey % 6 as integer) end",
    "orig_code": "case when o_custkey % 5 = 0 then 1 when o_custkey % 5 = 1 then 0 end",
}


def _case(col: str, labels: dict) -> str:
    arms = " ".join(f"when {v!r} then '{label}'" for v, label in labels.items())
    return f"case {col} {arms} end"


_CODED = f"with c as (select o_orderkey, {', '.join(f'{e} as {n}' for n, e in CODES.items())} from orders)"
_RACE = """case when orig_code = 1 then 'Hispanic or Latino' when race_code = 1 then 'White'
    when race_code = 3 then 'Black or African American' when race_code = 4 then 'Asian'
    else 'All races/ethnicities' end"""


def coded(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", *[F.expr(e).alias(n) for n, e in CODES.items()])


@query("p20_decode", f"""{_CODED} select o_orderkey, {_case('disa_code', fixed.DISABILITY)} as disability_status,
    {_case('sexs_code', fixed.SEX)} as sex, {_case('lfst_code', fixed.LABOR_FORCE)} as labor_force_status,
    {_case('ages_code', fixed.AGE)} as age_group, {_case('seasonal', fixed.SEASONAL)} as seasonal_adjustment from c""")
def p20(spark, sf):
    return coded(spark, sf).select(
        "o_orderkey",
        S.decode(F.col("disa_code"), fixed.DISABILITY).alias("disability_status"),
        S.decode(F.col("sexs_code"), fixed.SEX).alias("sex"),
        S.decode(F.col("lfst_code"), fixed.LABOR_FORCE).alias("labor_force_status"),
        S.decode(F.col("ages_code"), fixed.AGE).alias("age_group"),
        S.decode(F.col("seasonal"), fixed.SEASONAL).alias("seasonal_adjustment"),
    )


@query("p21_race_ethnicity", f"{_CODED} select o_orderkey, {_RACE} as race_ethnicity from c")
def p21(spark, sf):
    return coded(spark, sf).select(
        "o_orderkey", S.race_ethnicity(F.col("race_code"), F.col("orig_code")).alias("race_ethnicity")
    )


TITLE = """
    case p_partkey % 12
        when 0 then 'Percent employed in ' || p_name || ' occupations, Men'
        when 1 then 'percent employed in ' || p_name || ',Women'
        when 2 then 'Percent employed as ' || p_type || ' workers '
        when 3 then '(unadj) Discouraged workers, ' || p_name
        when 4 then 'Marginally attached, reasons other than discouragement'
        when 5 then 'Marginally attached ' || p_name
        when 6 then 'Not in labor force, WANT a job now'
        when 7 then 'Less than a High School diploma, ' || p_brand
        when 8 then 'High school graduates, no college'
        when 9 then 'Some college or associate degree'
        when 10 then 'Bachelor''s degree and higher'
        else null
    end
"""
_CODE = "case when p_size % 5 = 0 then 0 when p_size % 5 = 1 then null else p_size end"
_TITLED = f"with t as (select p_partkey, {TITLE} as title, {_CODE} as code from part)"


def _breakdown(word: str) -> str:
    return f"""case when coalesce(code, 0) <> 0 and title is not null then
        trim(regexp_extract(title, '[Pp]ercent employed {word} (.+?)(?:,\\s*(?:Men|Women))?$', 1)) else '' end"""


_NILF = """case
    when title is null or not regexp_matches(title,
        '(?i)want a job|marginally attached|discouraged|high school|some college|bachelor') then ''
    when lower(title) like '%discouraged workers%' then 'Discouraged workers'
    when lower(title) like '%reasons other than discouragement%' then 'Other marginally attached'
    when lower(title) like '%marginally attached%' then 'Marginally attached'
    when lower(title) like '%want a job%' then 'Wants a job'
    when lower(title) like '%less than a high school%' then 'Less than high school diploma'
    when lower(title) like '%high school graduates, no college%' then 'High school graduate, no college'
    when lower(title) like '%some college or associate%' then 'Some college or associate degree'
    when lower(title) like '%bachelor%' then 'Bachelor''s degree or higher' else '' end"""


def titled(spark, sf):
    return table(spark, sf, "part").select("p_partkey", F.expr(TITLE).alias("title"), F.expr(_CODE).alias("code"))


@query("p22_title_breakdown", f"""{_TITLED}
    select p_partkey, {_breakdown('in')} as occupation, {_breakdown('as')} as class_of_worker from t""")
def p22(spark, sf):
    title, code = F.col("title"), F.col("code")
    return titled(spark, sf).select(
        "p_partkey", S.title_breakdown(title, code, "in").alias("occupation"),
        S.title_breakdown(title, code, "as").alias("class_of_worker"),
    )


@query("p23_nilf_subcategory", f"{_TITLED} select p_partkey, {_NILF} as nilf_subcategory from t")
def p23(spark, sf):
    return titled(spark, sf).select("p_partkey", S.nilf_subcategory(F.col("title")).alias("nilf_subcategory"))


_DATE = """coalesce(year, 0) || '-' || case when regexp_matches(period, '^M(0[1-9]|1[0-2])$') then period[2:3]
    when period = 'Q02' then '04' when period = 'Q03' then '07' when period = 'Q04' then '10' else '01' end || '-01'"""


@query("p24_period_to_date", f"""
    with p as (select o_orderkey, case when o_orderkey % 11 <> 0 then year(o_orderdate) end as year,
        {PERIOD} as period from orders)
    select o_orderkey, {_DATE} as date from p""")
def p24(spark, sf):
    df = table(spark, sf, "orders").select(
        "o_orderkey", F.when(F.col("o_orderkey") % 11 != 0, F.year("o_orderdate")).alias("year"),
        F.expr(PERIOD).alias("period"),
    )
    return df.select("o_orderkey", S.period_to_date(F.col("year"), F.col("period")).alias("date"))


@query("p26_title_fallback", f"""{_TITLED} select p_partkey, coalesce(title, 'part ' || p_partkey) as series_title from t""")
def p26(spark, sf):
    df = titled(spark, sf).withColumn("series_description", F.concat(F.lit("part "), F.col("p_partkey").cast("string")))
    return T.title_fallback(df).select("p_partkey", "series_title")


@query("p27_blank_dimensions", f"""{_TITLED} select p_partkey, title as series_title,
    {', '.join(f"'' as {c}" for c in fixed.BLANK_DIMENSIONS)} from t""")
def p27(spark, sf):
    df = titled(spark, sf).withColumnRenamed("title", "series_description")
    return T.blank_dimensions(df).drop("series_description", "code")


# ---- series made of orders -------------------------------------------------------------
# Customers are series; their orders are observations, placed in months by key.

SERIES_OF = "'LNU0' || lpad(cast(o_custkey as varchar(20)), 7, '0')"
_RAW = f"""raw as (select {SERIES_OF} as series_id, cast(year(o_orderdate) as varchar) as year, {PERIOD} as period,
    case when o_orderkey % 10 = 0 then '-' else cast(o_orderkey % 1000 / 10.0 as varchar) end as value,
    o_orderpriority as footnotes, o_orderkey from orders)"""


def raw_series(spark, sf):
    orders = table(spark, sf, "orders")
    value = F.when(F.col("o_orderkey") % 10 == 0, "-").otherwise((F.col("o_orderkey") % 1000 / 10.0).cast("string"))
    return orders.select(
        F.expr(SERIES_OF).alias("series_id"), F.lit("described").alias("series_description"),
        F.year("o_orderdate").cast("string").alias("year"), F.expr(PERIOD).alias("period"),
        value.alias("value"), F.col("o_orderpriority").alias("footnotes"), "o_orderkey",
    )


CATALOGUE_TITLE = """
    case when c_custkey % 3 = 0 then 'Percent employed in ' || lower(c_mktsegment) || ', Men'
         when c_custkey % 3 = 1 then 'Percent employed as ' || lower(c_mktsegment)
         when c_custkey % 5 = 0 then 'Bachelor''s degree and higher' end
"""
_CATALOGUE_CODES = {
    "periodicity": "'M'",
    "seasonal": "case when c_custkey % 4 = 0 then 'S' else 'U' end",
    "disa_code": "cast(c_custkey % 3 as integer)",
    "sexs_code": "cast(c_nationkey % 3 as integer)",
    "ages_code": "cast(0 as integer)",
    "race_code": "cast(c_nationkey % 5 as integer)",
    "orig_code": "cast(c_custkey % 2 as integer)",
    "lfst_code": "cast(20 as integer)",
    "occupation_code": "case when c_custkey % 2 = 0 then 5 else 0 end",
    "indy_code": "case when c_custkey % 6 = 3 then 7 end",
    "class_code": "case when c_custkey % 2 = 1 then 1 else 0 end",
}
_CATALOGUE = f"""catalogue as (select 'LNU0' || lpad(cast(c_custkey as varchar), 7, '0') as series_id,
    {CATALOGUE_TITLE} as title, {', '.join(f'{e} as {n}' for n, e in _CATALOGUE_CODES.items())}
    from customer where c_custkey % 7 <> 0)"""


def series_catalogue(spark, sf):
    return table(spark, sf, "customer").filter("c_custkey % 7 <> 0").select(
        F.expr("'LNU0' || lpad(cast(c_custkey as varchar(20)), 7, '0')").alias("series_id"),
        F.expr(CATALOGUE_TITLE).alias("title"), *[F.expr(e).alias(n) for n, e in _CATALOGUE_CODES.items()],
    )


@query("j2_with_catalogue", f"""with {_RAW}, {_CATALOGUE}
    select o_orderkey, r.series_id, title, seasonal, disa_code, lfst_code from raw r
    left join catalogue c on c.series_id = r.series_id""")
def j2(spark, sf):
    joined = T.with_catalogue(raw_series(spark, sf), series_catalogue(spark, sf))
    return joined.select("o_orderkey", "series_id", "title", "seasonal", "disa_code", "lfst_code")


_MEANS = """typed as (select *, try_cast(value as double) as v, cast(year as integer) as y from raw),
    means as (select series_id, y as year, round(avg(v), 6) as annual_value from typed
        where regexp_matches(period, '^M\\d\\d$') group by 1, 2)"""


@query("a1_annual_mean", f"with {_RAW}, {_MEANS} select * from means")
def a1(spark, sf):
    means = T.annual_mean(T.typed(raw_series(spark, sf)))
    return means.withColumn("annual_value", F.round("annual_value", 6))


# Series that stand for total employed, by disability and sex code.
_DENOMINATORS = [(d, s, f"LNU0{3 * s + d + 1:07d}") for d in (0, 1, 2) for s in (0, 1)]
_KNOWN = "known(disa_code, sexs_code, series_id) as (values " + ", ".join(map(str, _DENOMINATORS)) + ")"
_CONVERTED = f"""{_RAW}, {_CATALOGUE}, {_KNOWN},
    typed as (select *, try_cast(value as double) as v, cast(year as integer) as y from raw),
    denom as (select disa_code, sexs_code, y, avg(v) as d from typed join known using (series_id)
        where regexp_matches(period, '^M\\d\\d$') group by 1, 2, 3),
    joined as (select t.*, c.* exclude (series_id), coalesce(c.title, 'described') as series_title, d
        from typed t left join catalogue c on c.series_id = t.series_id
        left join denom n on n.disa_code = c.disa_code and n.sexs_code = c.sexs_code and n.y = t.y),
    done as (select *, case when (series_title like '%Percent employed in%' or series_title like '%Percent employed as%')
        and d is not null and v is not null then cast(format('{{:.1f}}', v / 100.0 * d) as double) else v end as final
        from joined)"""


@query("j4_with_denominator", f"with {_CONVERTED} select o_orderkey, round(d, 6) as denominator from done")
def j4(spark, sf):
    known = T.with_catalogue(T.typed(raw_series(spark, sf)), series_catalogue(spark, sf))
    denominators = T.denominators(T.typed(raw_series(spark, sf)), _DENOMINATORS)
    joined = T.with_denominator(known, denominators, ["disa_code", "sexs_code", "year"])
    return joined.select("o_orderkey", F.round("denominator", 6).alias("denominator"))


@query("a6_percent_to_thousands", f"with {_CONVERTED} select o_orderkey, final as value from done")
def a6(spark, sf):
    typed = T.typed(raw_series(spark, sf))
    known = T.title_fallback(T.with_catalogue(typed, series_catalogue(spark, sf)))
    return T.percent_to_thousands(known, T.denominators(typed, _DENOMINATORS)).select("o_orderkey", "value")


@query("e2_clean_series", f"""with {_CONVERTED}
    select series_id, series_title, periodicity, {_case('seasonal', fixed.SEASONAL)} as seasonal_adjustment,
        {_case('disa_code', fixed.DISABILITY)} as disability_status, {_case('sexs_code', fixed.SEX)} as sex,
        {_case('ages_code', fixed.AGE)} as age_group, {_RACE} as race_ethnicity,
        {_case('lfst_code', fixed.LABOR_FORCE)} as labor_force_status,
        {_breakdown('in').replace('title', 'series_title').replace('code, 0', 'occupation_code, 0')} as occupation,
        {_breakdown('in').replace('title', 'series_title').replace('code, 0', 'indy_code, 0')} as industry,
        {_breakdown('as').replace('title', 'series_title').replace('code, 0', 'class_code, 0')} as class_of_worker,
        {_NILF.replace('title', 'series_title')} as nilf_subcategory,
        y as year, period, {_DATE.replace('coalesce(year, 0)', 'y')} as date, final as value, footnotes from done""")
def e2(spark, sf):
    return clean_series(raw_series(spark, sf), series_catalogue(spark, sf), _DENOMINATORS)
