"""Queries of filters, joins, unions and orders."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyloom.operators import catalogue as C
from tallyloom.operators import relational as R
from tallyloom.operators.shape import drop_all_null
from tallyloom.session import materialise, work_folder
from tallyloom.sources import tables as T
from workload import query, table
from workload.scalars import PART_ID, SERIES, VARIABLE_ID, series_list

PERIOD = """
    case o_orderkey % 8
        when 0 then 'Q0' || (1 + o_orderkey % 4) when 1 then 'A01' when 2 then 'M13' when 3 then null
        else 'M0' || (1 + o_orderkey % 9)
    end
"""
_PRIORITY_TITLE = """
    case o_orderkey % 6
        when 0 then 'Percent employed in ' || o_orderpriority || ', Men'
        when 1 then 'percent employed in ' || o_orderpriority
        when 2 then 'Percent employed as ' || o_orderpriority || ', Women'
        when 3 then null
        else o_orderpriority
    end
"""


@query("f1_at_level", "select o_orderkey, o_totalprice from orders where o_orderpriority like '1%'")
def f1(spark, sf):
    """Rush orders stand for state rows; the filter reaches the scan."""
    orders = table(spark, sf, "orders").withColumnRenamed("o_orderpriority", "level")
    return R.at_level(orders, "1-URGENT").select("o_orderkey", "o_totalprice")


@query("f2_not_null", "select c_custkey from customer where c_acctbal >= 0")
def f2(spark, sf):
    df = table(spark, sf, "customer").withColumn("balance", F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")))
    return R.not_null(df, "balance").select("c_custkey")


@query("f3_any_not_null", "select l_orderkey, l_linenumber from lineitem where l_quantity > 45 or l_discount > 0.08")
def f3(spark, sf):
    df = table(spark, sf, "lineitem").withColumns({
        "large": F.when(F.col("l_quantity") > 45, F.col("l_quantity")),
        "cheap": F.when(F.col("l_discount") > 0.08, F.col("l_discount")),
    })
    return R.any_not_null(df, ["large", "cheap"]).select("l_orderkey", "l_linenumber")


@query("f4_complete_pairs", """
    select l_orderkey, l_linenumber from lineitem where l_quantity > 25 and l_discount > 0.05""")
def f4(spark, sf):
    df = table(spark, sf, "lineitem").withColumns({
        "x": F.when(F.col("l_quantity") > 25, F.col("l_quantity")),
        "y": F.when(F.col("l_discount") > 0.05, F.col("l_discount")),
    })
    return R.complete_pairs(df, "x", "y").select("l_orderkey", "l_linenumber")


@query("f5_monthly_only", f"""
    with p as (select o_orderkey, {PERIOD} as period from orders)
    select o_orderkey, period from p where regexp_matches(period, '^M\\d\\d$')""")
def f5(spark, sf):
    return R.monthly_only(table(spark, sf, "orders").select("o_orderkey", F.expr(PERIOD).alias("period")))


@query("f6_percent_series", f"""
    with p as (select o_orderkey, {_PRIORITY_TITLE} as series_title from orders)
    select * from p where series_title like '%Percent employed in%' or series_title like '%Percent employed as%'""")
def f6(spark, sf):
    return R.percent_series(
        table(spark, sf, "orders").select("o_orderkey", F.expr(_PRIORITY_TITLE).alias("series_title"))
    )


@query("f7_non_blank", """
    select c_custkey, c_mktsegment as occupation from customer where c_mktsegment not in ('BUILDING', 'MACHINERY')""")
def f7(spark, sf):
    text = F.when(F.col("c_mktsegment") == "BUILDING", "").when(F.col("c_mktsegment") != "MACHINERY", F.col("c_mktsegment"))
    return R.non_blank(table(spark, sf, "customer").select("c_custkey", text.alias("occupation")), "occupation")


@query("f8_delete_where", f"""with {SERIES}
    select series_id, disa_code from series
    where not (series_id like 'LNS1%' and coalesce(disa_code, 0) in (1, 2))""")
def f8(spark, sf):
    bad = F.col("series_id").startswith("LNS1") & F.col("disa_code").isin(1, 2)
    return C.delete_where(series_list(spark, sf), bad).select("series_id", "disa_code")


@query("f9_select_series", f"""with {SERIES}
    select series_id, title from series where series_id like 'LNU0%' and periodicity = 'M' and disa_code = 0""")
def f9(spark, sf):
    return C.select_series(series_list(spark, sf), "LNU0", periodicity="M", disa_code=0).select("series_id", "title")


@query("f10_usable_variables", f"""
    with v as (select p_partkey, {PART_ID} as var_id from part)
    select p_partkey, var_id from v where position('_' in var_id) > 0 and var_id like '%E' and var_id <> 'ucgid'""")
def f10(spark, sf):
    return R.usable_variables(table(spark, sf, "part").select("p_partkey", F.expr(PART_ID).alias("var_id")))


# ---- joins -----------------------------------------------------------------------------

@query("j1_merge_batches", """
    with a as (select c_custkey as state, c_name as NAME, c_acctbal as v1 from customer where c_custkey % 3 <> 0),
    b as (select o_custkey as state, count(*) as v2 from orders where o_orderstatus = 'F' group by 1),
    c as (select o_custkey as state, count(*) as v3 from orders where o_orderstatus = 'O' group by 1),
    ab as (select coalesce(a.state, b.state) as state, NAME, v1, v2 from a full join b on a.state = b.state)
    select coalesce(ab.state, c.state) as state, NAME, v1, v2, v3 from ab full join c on ab.state = c.state
    union all select null, 'nowhere', 0.5, null, 7""")
def j1(spark, sf):
    """Batches that lack some places each; the first and the last also have a row without a place."""
    customer, orders = table(spark, sf, "customer"), table(spark, sf, "orders")

    def batch(status, out):
        rows = orders.filter(F.col("o_orderstatus") == status)
        counts = rows.groupBy(F.col("o_custkey").alias("state")).agg(F.count(F.lit(1)).alias(out))
        return counts.withColumn("NAME", F.lit("repeated"))

    first = customer.filter("c_custkey % 3 <> 0").select(
        F.col("c_custkey").alias("state"), F.col("c_name").alias("NAME"), F.col("c_acctbal").alias("v1")
    )
    nowhere = table(spark, sf, "region").filter("r_regionkey = 0").withColumn("state", F.lit(None).cast("bigint"))
    first = first.unionByName(nowhere.select("state", F.lit("nowhere").alias("NAME"), F.lit(0.5).alias("v1")))
    last = batch("O", "v3").unionByName(nowhere.select("state", F.lit(7).cast("bigint").alias("v3"), F.lit("repeated").alias("NAME")))
    return R.merge_batches([first, batch("F", "v2"), last], ["state"])


_STATE_YEARS = """
    with o as (select c_nationkey as state_fips, year(o_orderdate) as year, count(*) as orders
               from orders join customer on o_custkey = c_custkey group by 1, 2),
    l as (select s_nationkey as state_fips, year(l_shipdate) as year, count(*) as items
          from lineitem join supplier on l_suppkey = s_suppkey group by 1, 2)
    select o.state_fips, cast(o.year as integer) as year, orders, items from o join l
        on o.state_fips = l.state_fips and o.year = l.year"""


def _state_years(spark, sf):
    orders = (
        table(spark, sf, "orders").join(table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .groupBy(F.col("c_nationkey").alias("state_fips"), F.year("o_orderdate").alias("year"))
        .agg(F.count(F.lit(1)).alias("orders"))
    )
    items = (
        table(spark, sf, "lineitem").join(table(spark, sf, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
        .groupBy(F.col("s_nationkey").alias("state_fips"), F.year("l_shipdate").alias("year"))
        .agg(F.count(F.lit(1)).alias("items"))
    )
    return orders, items


@query("j3_join_state_year", _STATE_YEARS)
def j3(spark, sf):
    return R.join_state_year(*_state_years(spark, sf))


@query("j3_join_colocated", _STATE_YEARS)
def j3_colocated(spark, sf):
    """The same over two tables in buckets of state and year, which are joined without a shuffle."""
    T.ensure_database(spark, "colocated")
    for name, df in zip(("orders_of_states", "items_of_states"), _state_years(spark, sf)):
        T.write_colocated(df, f"colocated.{name}", f"{work_folder(spark, 'colocated')}/{name}", buckets=4)
    return R.join_state_year(spark.table("colocated.orders_of_states"), spark.table("colocated.items_of_states"))


@query("j6_insert_missing", f"""with {SERIES},
    marked as (select series_id, title, periodicity, coalesce(seasonal,
        case when series_id like 'LNS%' then 'S' else 'U' end) as seasonal, disa_code from series),
    twin as (select 'LNS1' || series_id[5:] as series_id, replace(title, '(unadj)', '(sadj)') as title, periodicity,
        'S' as seasonal, disa_code from marked where series_id like 'LNU0%' and periodicity = 'M')
    select * from marked union all
    select * from twin where not exists (select 1 from marked m where m.series_id = twin.series_id)""")
def j6(spark, sf):
    return C.add_adjusted(series_list(spark, sf))


@query("j7_enrich_defaults", """
    with sheet as (select l_partkey, cast(max(l_orderkey * 10 + l_linenumber) as bigint) as occupation_code, cast(arg_max(l_suppkey, l_orderkey * 10 + l_linenumber) as bigint) as indy_code
        from lineitem where l_quantity > 45 group by 1)
    select p.p_partkey,
        case when l_partkey is not null then occupation_code when p_size % 2 = 0 then p_size else 0 end as occupation_code,
        case when l_partkey is not null then indy_code when p_size % 2 = 0 then case when p_size % 4 = 0 then 7 end else 0 end as indy_code
    from part p left join sheet on l_partkey = p_partkey""")
def j7(spark, sf):
    """Keys come several times in the sheet; old rows have all codes, only the first one, or none."""
    size = F.col("p_size")
    old = table(spark, sf, "part").select(
        "p_partkey", F.when(size % 2 == 0, size).cast("bigint").alias("occupation_code"), F.when(size % 4 == 0, 7).when(size % 2 == 1, 9).cast("bigint").alias("indy_code"))
    place = F.col("l_orderkey") * 10 + F.col("l_linenumber")
    sheet = table(spark, sf, "lineitem").filter("l_quantity > 45").select(
        F.col("l_partkey").alias("p_partkey"), place.alias("occupation_code"), F.col("l_suppkey").alias("indy_code"), place.alias("place"))
    return C.enrich_defaults(old, sheet, "p_partkey", ["occupation_code", "indy_code"], 0, order="place")


@query("j8_exists_in", """
    select o_orderkey, o_custkey from orders o where exists (select 1 from customer c
        where c.c_custkey = o.o_custkey and c.c_acctbal < 0)""")
def j8(spark, sf):
    debtors = table(spark, sf, "customer").filter("c_acctbal < 0").select(F.col("c_custkey").alias("o_custkey"))
    return R.exists_in(table(spark, sf, "orders").select("o_orderkey", "o_custkey"), debtors, ["o_custkey"])


# ---- unions ----------------------------------------------------------------------------

@query("u1_union_levels", """
    select 'state' as level, n_nationkey as code, n_name as name, null::double as balance from nation
    union all select 'county', c_nationkey, c_name, c_acctbal from customer""")
def u1(spark, sf):
    state = table(spark, sf, "nation").select(F.col("n_nationkey").alias("code"), F.col("n_name").alias("name"))
    county = table(spark, sf, "customer").select(
        F.col("c_nationkey").alias("code"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance")
    )
    return R.union_levels(state, county)


def year_frames(spark, sf):
    """Orders of early, middle and late years, each with columns of its own."""
    orders = table(spark, sf, "orders").withColumn("year", F.year("o_orderdate"))
    return [
        orders.filter("year <= 1996").select("year", "o_orderkey", "o_totalprice"),
        orders.filter("year between 1997 and 1998").select("year", "o_orderkey", "o_orderstatus"),
        orders.filter("year >= 1999").select("year", "o_orderpriority", "o_orderkey", "o_totalprice"),
    ]


YEARS = """
    y as (select cast(year(o_orderdate) as integer) as year, * from orders),
    combined as (select year, o_orderkey,
        case when year <= 1996 or year >= 1999 then o_totalprice end as o_totalprice,
        case when year between 1997 and 1998 then o_orderstatus end as o_orderstatus,
        case when year >= 1999 then o_orderpriority end as o_orderpriority from y)"""


@query("u2_combine_years", f"with {YEARS} select * from combined")
def u2(spark, sf):
    return R.combine_years(year_frames(spark, sf))


@query("u4_upsert", """
    with old as (select c_custkey, c_name, c_acctbal as balance from customer where c_custkey % 4 <> 0),
    new as (select o_custkey as c_custkey, max(o_totalprice) as balance, min(o_orderpriority) as priority
            from orders where o_orderstatus = 'P' group by 1)
    select coalesce(old.c_custkey, new.c_custkey) as c_custkey, c_name, coalesce(new.balance, old.balance) as balance,
        priority from old full join new on old.c_custkey = new.c_custkey
    union all select null, 'no key', 2, 'last'""")
def u4(spark, sf):
    """Both sides also hold a row without a key, and the new one a key several times, of which the last counts."""
    old = table(spark, sf, "customer").filter("c_custkey % 4 <> 0").select(
        "c_custkey", "c_name", F.col("c_acctbal").alias("balance")
    )
    new = table(spark, sf, "orders").filter("o_orderstatus = 'P'").groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.max("o_totalprice").alias("balance"), F.min("o_orderpriority").alias("priority")
    )
    none = table(spark, sf, "region").filter("r_regionkey = 0").select(F.lit(None).cast("bigint").alias("c_custkey"))
    old = old.unionByName(none.select("c_custkey", F.lit("no key").alias("c_name"), F.lit(1.0).alias("balance"))).withColumn("at", F.lit(0))
    first = new.select("c_custkey", F.lit(-1.0).alias("balance"), F.lit("first").alias("priority"), F.lit(1).alias("at"))
    keyless = none.select("c_custkey", F.lit(2.0).alias("balance"), F.lit("last").alias("priority"), F.lit(2).alias("at"))
    return C.upsert(old, first.unionByName(new.withColumn("at", F.lit(2))).unionByName(keyless), "c_custkey", "at").drop("at")


@query("u4_merge_table", """
    with old as (select o_orderkey, cast(year(o_orderdate) as integer) as year, o_totalprice as price, o_orderstatus as status from orders),
    new as (select o_orderkey + case when o_orderkey % 3 = 0 then 100000000 else 0 end as o_orderkey, o_totalprice + 1 as price, 1996 as year
            from orders where year(o_orderdate) in (1995, 1996) and o_orderkey % 5 = 0)
    select coalesce(new.year, old.year) as year, count(*) as n, cast(sum(cast(round(coalesce(new.price, old.price) * 100) as bigint)) as bigint) as cents,
        count(status) as with_status, coalesce(new.year, old.year) in (1995, 1996) as rewritten
    from old full join new on old.o_orderkey = new.o_orderkey group by 1""")
def u4_table(spark, sf):
    """A table in folders of its year takes rows of two years: new ones, and known ones of which some move to another year."""
    path = work_folder(spark, "merged")
    orders = table(spark, sf, "orders").withColumn("year", F.year("o_orderdate"))
    T.write_cleaned(orders.select("o_orderkey", F.col("o_totalprice").alias("price"), F.col("o_orderstatus").alias("status"), "year"), path, ("year",))
    written = F.max(F.col("_metadata.file_modification_time")).alias("at")
    before = materialise(spark.read.parquet(path).groupBy("year").agg(written.alias("before")), "times")
    new = orders.filter("year in (1995, 1996) and o_orderkey % 5 = 0").select(
        F.when(F.col("o_orderkey") % 3 == 0, F.col("o_orderkey") + 100000000).otherwise(F.col("o_orderkey")).alias("o_orderkey"),
        (F.col("o_totalprice") + 1).alias("price"), F.lit(1996).alias("year"))
    T.merge_table(spark, path, new, ["o_orderkey"], ["year"])
    now = spark.read.parquet(path).groupBy("year").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.round(F.col("price") * 100).cast("bigint")).alias("cents"), F.count("status").alias("with_status"), written)
    return now.join(before, "year").select("year", "n", "cents", "with_status", (F.col("at") > F.col("before")).alias("rewritten"))


@query("u5_change_report", f"""with {SERIES},
    kept as (select * from series where not (series_id like 'LNS1%' and coalesce(disa_code, 0) in (1, 2))),
    monthly as (select series_id, title, case when series_id like 'LNU0%' and disa_code = 0 and periodicity = 'A'
        then 'M' else periodicity end as periodicity, seasonal, disa_code from kept),
    twin as (select 'LNS1' || series_id[5:] as series_id, replace(title, '(unadj)', '(sadj)') as title,
        'M' as periodicity, 'S' as seasonal, disa_code from monthly where series_id like 'LNU0%' and disa_code = 0),
    fresh as (select * from monthly union all
        select * from twin where not exists (select 1 from monthly m where m.series_id = twin.series_id)),
    j as (select case when o.series_id is null then 'added' when f.series_id is null then 'removed'
        when o.title is not distinct from f.title and o.periodicity is not distinct from f.periodicity
         and o.seasonal is not distinct from f.seasonal and o.disa_code is not distinct from f.disa_code
        then 'equal' else 'changed' end as change
        from series o full join fresh f on o.series_id = f.series_id)
    select change, count(*) as n from j group by 1""")
def u5(spark, sf):
    old = series_list(spark, sf)
    return C.change_report(old, C.repair_adjusted(old), "series_id")


# ---- orders ----------------------------------------------------------------------------

@query("o1_state_first", """
    select case when c_custkey % 4 = 0 then 'state' else 'county' end as level,
        cast(c_nationkey as varchar) as state_fips, cast(c_custkey as varchar) as county_fips from customer""")
def o1(spark, sf):
    return R.state_first(table(spark, sf, "customer").select(
        F.when(F.col("c_custkey") % 4 == 0, "state").otherwise("county").alias("level"),
        F.col("c_nationkey").cast("string").alias("state_fips"), F.col("c_custkey").cast("string").alias("county_fips"),
    ))


@query("o2_series_order", """
    select event_type as series_id, cast(year(ts) as integer) as year, cast(event_id as varchar) as period, value
    from events""")
def o2(spark, sf):
    return R.series_order(table(spark, sf, "events").select(
        F.col("event_type").alias("series_id"), F.year("ts").alias("year"),
        F.col("event_id").cast("string").alias("period"), "value",
    ))


@query("o3_top_counts", """
    select l_partkey, count(*) as count from lineitem group by 1 order by 2 desc, 1 limit 20""")
def o3(spark, sf):
    return R.top_counts(table(spark, sf, "lineitem"), "l_partkey", 20)


@query("o4_column_order", f"""
    with v as (select c_mktsegment as table_id, 2010 + c_nationkey % 2 as year, {VARIABLE_ID} as var_id from customer)
    select table_id, year, var_id, row_number() over (partition by table_id, year order by var_id) as position
    from v""")
def o4(spark, sf):
    meta = table(spark, sf, "customer").select(
        F.col("c_mktsegment").alias("table_id"), (F.col("c_nationkey") % 2 + 2010).alias("year"),
        F.expr(VARIABLE_ID).alias("var_id"),
    )
    return R.column_order(meta)


# ---- column sets -----------------------------------------------------------------------

@query("p13_drop_all_null", "select c_custkey, c_name from customer")
def p13(spark, sf):
    df = table(spark, sf, "customer").select(
        "c_custkey", F.lit(None).cast("string").alias("note"), "c_name",
        F.when(F.col("c_acctbal") < -1e9, F.col("c_acctbal")).alias("empty"),
    )
    return drop_all_null(df)
