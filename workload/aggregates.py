"""Queries of profiles, counts, correlation and the study."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyloom.operators import quality as Q
from tallyloom.operators import relational as R
from tallyloom.operators import statistics as S
from tallyloom.plans import study
from tallyloom.session import work_folder
from tallyloom.sources.tables import availability_of, coverage_of, write_cleaned
from workload import query, table

# Orders by year as files, with missing, blank and negative cells put in by projection.
_CELLS = {
    "fips": "case when o_orderkey % 7 = 0 then '' when o_orderkey % 11 = 0 then null else '0' || o_custkey end",
    "year": "cast(year(o_orderdate) as integer)",
    "status": "case when o_orderkey % 3 <> 0 then null else o_orderstatus end",
    "amount": "case when o_orderkey % 5 = 0 then -1 * (o_custkey % 50) when o_orderkey % 5 < 3 then o_custkey % 90 end",
    "code": "case when o_orderkey % 4 = 0 then 'x' || o_orderstatus else cast(o_custkey % 30 as varchar(20)) end",
    "share": "case when o_orderkey % 2 = 0 then o_custkey % 8 / 8.0 end",
}
_FILES = "files as (select 'orders_' || o_orderstatus as file, " + ", ".join(
    f"{e} as {c}" for c, e in _CELLS.items()) + " from orders)"
_DTYPES = {"fips": "string", "year": "int", "status": "string", "amount": "bigint", "code": "string", "share": "double"}


def files(spark, sf):
    return table(spark, sf, "orders").select(
        F.expr("'orders_' || o_orderstatus").alias("file"), *[F.expr(e).alias(c) for c, e in _CELLS.items()]
    ).withColumns({"amount": F.col("amount").cast("bigint"), "share": F.col("share").cast("double")})


def _profile_sql() -> str:
    parts = []
    for i, (c, kind) in enumerate(_DTYPES.items()):
        text = f"nullif({c}, '')" if kind == "string" else c
        number = f"try_cast({c} as double)" if kind == "string" else f"cast({c} as double)"
        parts.append(f"""select file, {i + 1} as position, '{c}' as "column", '{kind}' as dtype,
            count(*) - count({text}) as null_count,
            cast(format('{{:.2f}}', (count(*) - count({text})) / greatest(count(*), 1) * 100) as double) as null_pct,
            count(distinct {text}) as unique_count, min({number}) as min, max({number}) as max,
            case when count({number}) > 0 then count(*) filter ({number} < 0) end as negative_count,
            cast(format('{{:.4f}}', avg({number})) as double) as mean from files group by file""")
    return " union all ".join(parts)


_COLUMNS = ", ".join(["file", *_DTYPES])
_NULLS = " + ".join(
    f"(case when {c} is null" + (f" or {c} = ''" if k == "string" else "") + " then 1 else 0 end)"
    for c, k in _DTYPES.items()
)
_FILE_PROFILE = f"""profile as (select file, count(*) as row_count, 6 as column_count,
    count(*) - (select count(*) from (select distinct {_COLUMNS} from files) d where d.file = files.file) as duplicate_rows,
    count(*) filter (coalesce(fips, '') = '') as missing_fips, min(year) as year_min, max(year) as year_max,
    cast(sum({_NULLS}) as bigint) as total_nulls from files group by file)"""


@query("a7_profile_columns", f"with {_FILES} select * from ({_profile_sql()})")
def a7(spark, sf):
    return Q.profile_columns(files(spark, sf), ["file"])


@query("a7_profile_states", f"""with {_FILES} select file, position, "column", dtype, null_count, null_pct, min, max, negative_count, mean, true as unique_close
    from ({_profile_sql()})""")
def a7_states(spark, sf):
    """Profiles merged from states of the files' parts; distinct values within three percent of the exact count."""
    df = files(spark, sf).withColumn("part", F.pmod(F.xxhash64("fips", "code"), F.lit(5)))
    merged = Q.profile_states(Q.merge_states(Q.column_states(df, ["file", "part"]), ["file"]), ["file"])
    exact = Q.profile_columns(files(spark, sf), ["file"]).select("file", "column", F.col("unique_count").alias("exact"))
    close = F.abs(F.col("unique_count") - F.col("exact")) <= F.greatest(F.lit(1.0), F.col("exact") * 0.03)
    return merged.join(exact, ["file", "column"]).select(
        "file", "position", "column", "dtype", "null_count", "null_pct", "min", "max", "negative_count", "mean", close.alias("unique_close"))


@query("a8_duplicate_rows", """
    with d as (select l_quantity, l_discount, l_tax, l_returnflag, l_linestatus, count(*) as n from lineitem group by all)
    select l_returnflag, l_linestatus, cast(sum(n - 1) as bigint) as duplicate_rows from d group by 1, 2""")
def a8(spark, sf):
    rows = table(spark, sf, "lineitem").select("l_quantity", "l_discount", "l_tax", "l_returnflag", "l_linestatus")
    return Q.duplicate_rows(rows, ["l_returnflag", "l_linestatus"])


@query("a9_profile_file", f"with {_FILES}, {_FILE_PROFILE} select * from profile")
def a9(spark, sf):
    return Q.profile_file(files(spark, sf), ["file"])


@query("a10_quality_flags", f"""with {_FILES}, {_FILE_PROFILE}, columns as ({_profile_sql()}),
    flags as (select file,
        coalesce(string_agg("column", '; ' order by position) filter (null_pct > 50), '') as high_null_cols,
        coalesce(string_agg("column", '; ' order by position) filter (negative_count > 0), '') as negative_cols
        from columns group by file)
    select p.file, row_count, duplicate_rows, high_null_cols, negative_cols,
        case when duplicate_rows > 0 or high_null_cols <> '' or negative_cols <> '' then 'WARN' else 'OK' end as status
    from profile p join flags f on f.file = p.file""")
def a10(spark, sf):
    df = files(spark, sf)
    flagged = Q.quality_flags(Q.profile_columns(df, ["file"]), ["file"], Q.profile_file(df, ["file"]))
    return flagged.select("file", "row_count", "duplicate_rows", "high_null_cols", "negative_cols", "status")


# Two-sided p by Simpson's rule on the angle form: integral of cos^(n-3) from asin|r| to pi/2.
def _angle_integral(low: str) -> str:
    steps = 20000
    return f"""list_sum(list_transform(range(0, {steps} + 1), lambda k:
        (case when k = 0 or k = {steps} then 1.0 when k % 2 = 1 then 4.0 else 2.0 end)
        * pow(greatest(cos({low} + (pi() / 2 - {low}) * k / {steps}), 0.0), n - 3))) * (pi() / 2 - {low}) / {3 * steps}"""


_CORRELATED = f"""finished as (select *, case when n >= 3 and pearson_r is not null then
    ({_angle_integral('asin(abs(pearson_r))')}) / ({_angle_integral('0.0')}) end as p from correlated)"""


def _r(x: str, y: str) -> str:
    return f"""regr_count({y}, {x}) as n, case when regr_count({y}, {x}) >= 3 and regr_sxx({y}, {x}) > 0
        and regr_syy({y}, {x}) > 0 then corr({y}, {x}) end as pearson_r"""


@query("a11_pearson", f"""
    with d as (select l_returnflag, l_linenumber, l_quantity as x, l_extendedprice as y from lineitem),
    correlated as (select l_returnflag, l_linenumber, {_r('case when x > 3 then x end', 'y')} from d group by 1, 2),
    {_CORRELATED}
    select l_returnflag, l_linenumber, round(pearson_r, 8) as pearson_r, round(p, 6) as p_value, n from finished""")
def a11(spark, sf):
    df = table(spark, sf, "lineitem").select(
        "l_returnflag", "l_linenumber", F.when(F.col("l_quantity") > 3, F.col("l_quantity")).alias("x"),
        F.col("l_extendedprice").alias("y"),
    )
    return rounded(S.pearson(df, ["l_returnflag", "l_linenumber"], "x", "y"))


def rounded(df):
    return df.withColumns({"pearson_r": F.round("pearson_r", 8), "p_value": F.round("p_value", 6)})


@query("a12_fit_line", """
    with f as (select regr_slope(o_totalprice, o_custkey) as m, regr_intercept(o_totalprice, o_custkey) as b,
        min(o_custkey) as lo, max(o_custkey) as hi from orders where o_orderkey % 9 <> 0)
    select cast(k as integer) as point, round(x, 5) as x, round(m * x + b, 3) as y from
        (select m, b, k, lo + (hi - lo) / 99.0 * k as x from f, range(100) r(k))""")
def a12(spark, sf):
    df = table(spark, sf, "orders").select(
        F.col("o_custkey").cast("double").alias("x"), F.when(F.col("o_orderkey") % 9 != 0, F.col("o_totalprice")).alias("y")
    )
    return S.fit_line(df, "x", "y").select("point", F.round("x", 5).alias("x"), F.round("y", 3).alias("y"))


# ---- study -----------------------------------------------------------------------------
# Nations are states. Published columns are sums of order cents over disjoint kinds of orders.

_KIND = {
    "dis_edu_bachelors_plus": "o_orderpriority like '1%' and o_orderstatus = 'F'",
    "dis_edu_some_college": "o_orderpriority like '2%' and o_orderstatus = 'F'",
    "dis_edu_hs_grad": "o_orderpriority like '3%' and o_orderstatus = 'F'",
    "dis_edu_less_than_hs": "o_orderpriority like '4%' and o_orderstatus = 'F'",
    "dis_edu_pop_25_plus": "o_orderstatus = 'F' and not (c_nationkey = 3 and year(o_orderdate) = 1999)",
    "dis_employed_total": "o_orderpriority like '1%' or o_orderpriority like '5%'",
    "dis_pop_16_plus": "o_orderstatus in ('F', 'O')",
    "dis_type_hearing_18_64": "o_custkey % 6 = 0",
    "dis_type_vision_18_64": "o_custkey % 6 = 1",
    "dis_type_cognitive_18_64": "o_custkey % 6 = 2",
    "dis_type_ambulatory_18_64": "o_custkey % 6 = 3",
    "dis_type_self_care_18_64": "o_custkey % 6 = 4 and year(o_orderdate) <> 1997",
    "dis_type_indep_living_18_64": "o_custkey % 6 = 5",
    "dis_pop_total": "o_orderstatus = 'O'",
    "dis_employed": "o_orderpriority like '2%'",
    "pop_total": "1 = 1",
}
_TABLES = {
    "s1811": [c for c in _KIND if c.startswith("dis_edu")] + ["dis_employed_total", "dis_pop_16_plus"],
    "s1810": [c for c in _KIND if c.startswith("dis_type")] + ["dis_pop_total", "pop_total"],
    "b18120": ["dis_employed", "pop_total"],
}
_CENTS = "cast(round(o_totalprice * 100) as bigint)"


def state_tables(spark, sf):
    """s1810, s1811 and b18120: state rows of nations, and county rows that must not count."""
    orders = table(spark, sf, "orders").join(
        table(spark, sf, "customer").select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey")
    )
    sums = [
        F.sum(F.expr(f"case when {condition} then {_CENTS} end")).cast("double").alias(c)
        for c, condition in _KIND.items()
    ]
    level = F.when(F.col("o_orderkey") % 5 == 0, "county").otherwise("state")
    cells = orders.groupBy(
        level.alias("level"), F.col("c_nationkey").cast("string").alias("state_fips"),
        F.year("o_orderdate").alias("year"),
    ).agg(*sums).withColumn("state", F.concat(F.lit("N"), "state_fips"))
    return {t: cells.select("level", "state", "state_fips", "year", *columns) for t, columns in _TABLES.items()}


_STATES = "cells as (select cast(c_nationkey as varchar) as state_fips, cast(year(o_orderdate) as integer) as year, " + ", ".join(
    f"cast(sum(case when {e} then {_CENTS} end) as double) as {c}" for c, e in _KIND.items()
) + " from orders join customer on o_custkey = c_custkey where o_orderkey % 5 <> 0 group by 1, 2)"


def _study_sql() -> str:
    rate = "dis_employed_total / nullif(dis_pop_16_plus, 0)"
    pairs = [
        ("Education vs Employment Rate", study.RATE_16, label, f"{c} / nullif(dis_edu_pop_25_plus, 0)", rate,
         "dis_edu_pop_25_plus is not null")
        for c, label in study.EDUCATION.values()
    ]
    some = " or ".join(f"{c} is not null" for c in study.TYPES)
    pairs += [
        ("Disability Type vs Employment Rate", study.RATE_18, label, f"{c} / nullif(pop_total, 0)",
         "dis_employed / nullif(pop_total, 0)", some)
        for c, label in study.TYPES.items()
    ]
    pool = ["dis_pop_total", "ln(nullif(dis_pop_total, 0))", "dis_pop_total / nullif(pop_total, 0)"]
    pairs += [
        ("Talent Pool Size vs Employment Rate", study.RATE_16, label, x, rate, "true")
        for x, label in zip(pool, study.POOL.values())
    ]
    return " union all ".join(
        f"""select '{a}' as analysis, '{label.replace("'", "''")}' as x_variable, '{y_label}' as y_variable,
            {_r(x, y)} from cells where {condition}"""
        for a, y_label, label, x, y, condition in pairs
    )


@query("a13_correlation_summary", f"""with {_STATES}, correlated as ({_study_sql()}), {_CORRELATED}
    select analysis, x_variable, y_variable, round(pearson_r, 8) as pearson_r, round(p, 6) as p_value, n from finished""")
def a13(spark, sf):
    return rounded(study.summary(**state_tables(spark, sf)))


@query("a13_from_states", f"""with {_STATES}, correlated as ({_study_sql()}), {_CORRELATED}
    select analysis, x_variable, y_variable, round(pearson_r, 8) as pearson_r, round(p, 6) as p_value, n from finished""")
def a13_states(spark, sf):
    """The study from the states of each year: first all years, then one of them anew."""
    tables, store = state_tables(spark, sf), work_folder(spark, "study")
    study.refresh_states(store, list(range(1990, 2010)), **tables)
    return rounded(study.summary_of(study.refresh_states(store, [1997], **tables)))


@query("e3_education_rows", f"""with {_STATES}
    select 'N' || state_fips as state, state_fips, year, dis_employed_total / nullif(dis_pop_16_plus, 0) as employment_rate,
        {', '.join(f'{c} / nullif(dis_edu_pop_25_plus, 0) as {out}' for out, (c, _) in study.EDUCATION.items())}
    from cells where dis_edu_pop_25_plus is not null""")
def e3a(spark, sf):
    return study.education(state_tables(spark, sf)["s1811"])


@query("e3_disability_type_rows", f"""with {_STATES}
    select 'N' || state_fips as state, state_fips, year, dis_employed / nullif(pop_total, 0) as employment_rate,
        {', '.join(f'{c} / nullif(pop_total, 0) as {c}_prevalence' for c in study.TYPES)}
    from cells where {' or '.join(f'{c} is not null' for c in study.TYPES)}""")
def e3b(spark, sf):
    tables = state_tables(spark, sf)
    return study.disability_type(tables["b18120"], tables["s1810"])


@query("e3_talent_pool_rows", f"""with {_STATES}
    select 'N' || state_fips as state, state_fips, year, dis_employed_total / nullif(dis_pop_16_plus, 0) as employment_rate,
        dis_pop_total as talent_pool_size, round(ln(nullif(dis_pop_total, 0)), 9) as talent_pool_log,
        dis_pop_total / nullif(pop_total, 0) as talent_pool_share from cells""")
def e3c(spark, sf):
    tables = state_tables(spark, sf)
    rows = study.talent_pool(tables["s1810"], tables["s1811"])
    return rows.withColumn("talent_pool_log", F.round("talent_pool_log", 9))


# ---- counts and summaries --------------------------------------------------------------

@query("a14_value_counts", """
    select o_orderpriority, count(*) as count from orders where o_orderpriority not like '4%' group by 1""")
def a14(spark, sf):
    kept = F.when(~F.col("o_orderpriority").startswith("4"), F.col("o_orderpriority"))
    return R.value_counts(table(spark, sf, "orders").select(kept.alias("o_orderpriority")), "o_orderpriority")


@query("a15_describe", """
    with v as (select case when l_linenumber <> 4 then l_extendedprice end as v from lineitem)
    select count(v) as count, round(avg(v), 4) as mean, round(stddev_samp(v), 4) as std, min(v) as min, max(v) as max,
        round(quantile_cont(v, 0.25), 6) as q25, round(quantile_cont(v, 0.5), 6) as q50,
        round(quantile_cont(v, 0.75), 6) as q75 from v""")
def a15(spark, sf):
    price = F.when(F.col("l_linenumber") != 4, F.col("l_extendedprice"))
    summary = S.describe(table(spark, sf, "lineitem").select(price.alias("v")), "v")
    places = {"mean": 4, "std": 4, "q25": 6, "q50": 6, "q75": 6}
    return summary.withColumns({c: F.round(c, n) for c, n in places.items()})


@query("a16_distinct_where", """
    select count(distinct l_partkey) filter (l_returnflag = 'R') as distinct_count from lineitem""")
def a16(spark, sf):
    return Q.distinct_where(table(spark, sf, "lineitem"), "l_partkey", F.col("l_returnflag") == "R")


@query("a17_null_counts", f"""with {_FILES} select * from (""" + " union all ".join(
    f"""select count(*) as row_count, '{c}' as "column", count(*) - count({c}) as null_count from files"""
    for c in ["file", *_DTYPES]) + ")")
def a17(spark, sf):
    return Q.null_counts(files(spark, sf))


@query("a18_availability", """
    with long as (select 'c' || o_orderpriority[1] as "column", cast(year(o_orderdate) as integer) as year,
        case when o_orderpriority like '1%' and year(o_orderdate) < 1997 or o_orderpriority like '2%'
              and year(o_orderdate) > 1998 or o_orderpriority like '3%' then o_totalprice end as value from orders)
    select "column", min(year) as first_year, max(year) as last_year, count(*) as value_count from long
    where value is not null group by 1""")
def a18(spark, sf):
    first, year = F.substring("o_orderpriority", 1, 1), F.year("o_orderdate")
    present = ((first == "1") & (year < 1997)) | ((first == "2") & (year > 1998)) | (first == "3")
    return Q.availability(table(spark, sf, "orders").select(
        F.concat(F.lit("c"), first).alias("column"), year.alias("year"),
        F.when(present, F.col("o_totalprice")).alias("value"),
    ))


@query("a19_coverage", """
    select o_orderstatus, cast(year(o_orderdate) as integer) as year, count(*) as row_count from orders group by 1, 2""")
def a19(spark, sf):
    df = table(spark, sf, "orders").withColumn("year", F.year("o_orderdate"))
    return Q.coverage(df, ["o_orderstatus", "year"])


def _by_status_and_year(spark, sf):
    path = work_folder(spark, "covered")
    write_cleaned(table(spark, sf, "orders").withColumn("year", F.year("o_orderdate")), path, ("o_orderstatus", "year"))
    return path


@query("a18_availability_of_files", """
    with y as (select cast(year(o_orderdate) as integer) as year, * from orders)
    select 'early' as "column", min(year) as first_year, max(year) as last_year, count(*) as value_count from y where year < 1998
    union all select 'o_totalprice', min(year), max(year), count(*) from y""")
def a18_files(spark, sf):
    """Years in which columns hold values, from the footers of a table in folders of its year."""
    path, year = work_folder(spark, "available"), F.year("o_orderdate")
    write_cleaned(table(spark, sf, "orders").select(
        year.alias("year"), "o_totalprice", F.when(year < 1998, 1).alias("early"), F.lit(None).cast("int").alias("never")), path, ("year",))
    return availability_of(spark, path, ["o_totalprice", "early", "never"])


@query("a19_coverage_of_files", """
    select o_orderstatus, cast(year(o_orderdate) as integer) as year, count(*) as row_count from orders group by 1, 2""")
def a19_files(spark, sf):
    """Rows per folder, from the footers."""
    return coverage_of(spark, _by_status_and_year(spark, sf), ["o_orderstatus", "year"])
