"""Queries of readers, sinks, routing and planning of work."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyloom.plans.folders import profile_folder, publish_folder, validate_folder
from tallyloom.session import work_folder
from tallyloom.sources import raw as W
from tallyloom.sources import tables as T
from workload import query, table
from workload.relations import YEARS, year_frames
from workload.scalars import PART_ID


@query("s1_read_raw_acs", """
    select 'S1810' as table_id, 2011 as year, 'county' as level, c_name || ', Land "' || c_mktsegment || '"' as name,
        cast(c_nationkey as varchar) as state, cast(c_custkey as varchar) as county, v.var_id, v.value
        from customer, (values ('S1810_C01_001E'), ('S1810_C02_001E')) k(id),
        lateral (select k.id as var_id, case when k.id like '%C01%' then cast(c_acctbal as varchar)
            else case when c_custkey % 3 = 0 then null else c_mktsegment end end as value) v
    union all select 'S1810', 2011, 'state', n_name, cast(n_nationkey as varchar), null, 'S1810_C02_001E',
        cast(n_regionkey as varchar) from nation where n_nationkey % 5 <> 0
    union all select 'B18120', 2012, 'county', s_name || chr(10) || 'second, line', cast(s_nationkey as varchar), cast(s_suppkey as varchar),
        'B18120_001PE', cast(s_acctbal as varchar) from supplier""")
def s1(spark, sf):
    rows = W.land_raw(spark, f"{_raw_folder(spark, sf)}/*", work_folder(spark, "landing"))
    return rows.select("table_id", "year", "level", "name", "state", "county", F.explode("vars").alias("var_id", "value"))


def _raw_folder(spark, sf):
    """Raw files of three shapes: a header with a quoted line break and a name met again, rows that are short or have
    surplus fields, values with quotes and line breaks, a file without a line."""
    folder = work_folder(spark, "raw")
    customers = table(spark, sf, "customer").select(
        F.concat(F.col("c_name"), F.lit(', Land "'), F.col("c_mktsegment"), F.lit('"')).alias("NAME"),
        F.col("c_acctbal").cast("string").alias("S1810_C01_001E"),
        F.when(F.col("c_custkey") % 3 != 0, F.col("c_mktsegment")).alias("S1810_C02_001E"),
        F.lit("stale").alias("NAME.1"), F.col("c_nationkey").alias("state"), F.col("c_custkey").alias("county"),
    )
    line = F.concat_ws(",", "n_nationkey", "n_name", "n_regionkey", F.lit("again"), F.when(F.col("n_nationkey") % 5 == 0, F.lit("extra,more")))
    nations = table(spark, sf, "nation").agg(F.collect_list(line).alias("lines")).select(F.concat(
        F.lit('\nstate,NAME,S1810_C02_001E,NAME,"two\nlines"\n\n'), F.array_join("lines", "\n\n")))
    nations.write.text(f"{folder}/acs_S1810_2011_state_raw.csv")
    suppliers = table(spark, sf, "supplier").select(
        F.concat("s_name", F.lit("\nsecond, line")).alias("NAME"), F.col("s_acctbal").cast("string").alias("B18120_001PE"),
        F.col("s_nationkey").alias("state"), F.col("s_suppkey").alias("county"),
    )
    table(spark, sf, "region").filter("false").select("r_name").coalesce(1).write.text(f"{folder}/acs_S1811_2013_raw.csv")
    for name, df in {"acs_s1810_2011_raw.csv": customers, "acs_B18120_2012_raw.csv": suppliers}.items():
        df.write.csv(f"{folder}/{name}", header=True, escape='"')
    return folder


@query("s1_rejected_rows", """
    select 'S1810' as table_id, 2011 as year, 'state' as level, 'more fields than the header' as reason, count(*) as n,
        min(n_nationkey || ',' || n_name || ',' || n_regionkey || ',again,extra,more') as first_record
        from nation where n_nationkey % 5 = 0
    union all select 'S1811', 2013, 'county', 'no header could be read', 1, null""")
def s1_rejects(spark, sf):
    """What a landing of raw files leaves beside it."""
    beside = work_folder(spark, "rejects")
    W.land_raw(spark, f"{_raw_folder(spark, sf)}/*", work_folder(spark, "landing"), rejects=beside)
    return W.read_rejects(spark, beside).groupBy("table_id", "year", "level", "reason").agg(
        F.count(F.lit(1)).alias("n"), F.min("record").alias("first_record"))


@query("s2_read_acs_meta", """
    select p_type as table_id, 2000 + p_size as year, v.* from part, lateral (
        select 'B' || p_partkey || '_001E' as var_id, 'Estimate!!' || p_name as label, p_brand as concept,
            null as pe_parent, false as has_parent_entry, 0 as meta_position
        union all select 'B' || p_partkey || '_001PE', 'Percent!!' || p_name, p_brand,
            case when p_partkey % 2 = 0 then 'B' || p_partkey || '_001E' end, true, 1) v""")
def s2(spark, sf):
    part = table(spark, sf, "part")
    stem = F.concat(F.lit("B"), F.col("p_partkey").cast("string"))
    estimate, percent = F.concat(stem, F.lit("_001E")), F.concat(stem, F.lit("_001PE"))

    def described(word):
        return F.struct(F.concat(F.lit(f"{word}!!"), "p_name").alias("label"), F.col("p_brand").alias("concept"))

    docs = part.select(F.to_json(F.struct(
        F.col("p_type").alias("table_id"), (F.col("p_size") + 2000).alias("year"), F.lit("detailed").alias("table_type"),
        F.create_map(estimate, described("Estimate"), percent, described("Percent")).alias("variables"),
        F.create_map(percent, F.when(F.col("p_partkey") % 2 == 0, estimate)).alias("pe_parents"),
    ), {"ignoreNullFields": "false"}).alias("value"))
    path = f"{work_folder(spark, 'meta')}/variables"
    docs.write.text(path)
    return W.read_acs_meta(spark, path, lines=True)


@query("s3_explode_matrix", """
    select p_partkey, v.* from part, lateral (
        select 0 as row_number, p_name as name, cast(p_size as varchar) as state, p_type as name_again
        union all select 1, null, p_brand, null where p_partkey % 2 = 0) v where p_partkey % 5 <> 0""")
def s3(spark, sf):
    return W.explode_matrix(_matrices(spark, sf), "payload", ["p_partkey"]).select(
        "p_partkey", "row_number", *[F.try_element_at("record", F.lit(c)).alias(c.lower().replace(".1", "_again")) for c in ("NAME", "state", "NAME.1")])


def _matrices(spark, sf):
    """Responses whose header repeats a name, with short rows; every fifth is broken or has a row that is too long."""
    header = F.array(F.lit("NAME"), F.lit("state"), F.lit("NAME"))
    first = F.array(F.col("p_name"), F.col("p_size").cast("string"), F.col("p_type"))
    second = F.array(F.lit(None).cast("string"), F.col("p_brand"))
    third = F.array(*[F.lit(c) for c in "abcd"])
    key = F.col("p_partkey")
    matrix = F.when(key % 10 == 5, F.array(header, first, third)).when(key % 2 == 0, F.array(header, first, second)).otherwise(F.array(header, first))
    payload = F.when(key % 10 == 0, F.concat(F.lit("oops "), key.cast("string"))).otherwise(F.to_json(matrix))
    return table(spark, sf, "part").select("p_partkey", payload.alias("payload"))


@query("s3_rejected_matrices", """
    select p_partkey, case when p_partkey % 10 = 0 then 'no array of rows' else 'more fields than the header' end as reason
    from part where p_partkey % 5 = 0""")
def s3_rejects(spark, sf):
    return W.rejected_matrices(_matrices(spark, sf), "payload", ["p_partkey"]).select("p_partkey", "reason")


@query("s4_flatten_series", """
    with e as (select * from events where event_id % 7 <> 0 and event_id % 13 <> 0 and event_id % 17 <> 0)
    select 'LNU0' || user_id as series_id, coalesce(c_name, '') as series_description, cast(year(ts) as varchar) as year,
        v.period, v.value, v.footnotes from e left join customer on c_custkey = user_id and c_custkey % 4 <> 0,
        lateral (select 'M01' as period, cast(event_id as varchar) as value, event_type || '; b' as footnotes
                 union all select 'A01', '', '') v""")
def s4(spark, sf):
    catalogue = table(spark, sf, "customer").filter("c_custkey % 4 <> 0").select(
        F.concat(F.lit("LNU0"), F.col("c_custkey").cast("string")).alias("series_id"), F.col("c_name").alias("title")
    )
    return W.flatten_series(_responses(spark, sf), "payload", catalogue)


@query("s4_rejected_responses", """
    select case when event_id % 13 = 0 then 'broken' when event_id % 17 = 0 then 'empty' else 'failed: REQUEST_FAILED' end as reason,
        count(*) as n from events where event_id % 7 = 0 or event_id % 13 = 0 or event_id % 17 = 0 group by 1""")
def s4_rejects(spark, sf):
    """Responses that failed, are cut off, or hold no value."""
    return W.rejected_responses(_responses(spark, sf), "payload").groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


def _responses(spark, sf):
    events = table(spark, sf, "events")
    year = F.year("ts").cast("string").alias("year")

    def note(text):
        return F.struct(text.alias("text"))

    first = F.struct(
        year, F.lit("M01").alias("period"), F.col("event_id").cast("string").alias("value"),
        F.array(note(F.col("event_type")), note(F.lit(None).cast("string")), note(F.lit("b"))).alias("footnotes"),
    )
    second = F.struct(
        year, F.lit("A01").alias("period"), F.lit(None).cast("string").alias("value"),
        F.array().cast("array<struct<text:string>>").alias("footnotes"),
    )
    payload = F.to_json(F.struct(
        F.when(F.col("event_id") % 7 != 0, "REQUEST_SUCCEEDED").otherwise("REQUEST_FAILED").alias("status"),
        F.struct(F.array(F.struct(
            F.concat(F.lit("LNU0"), F.col("user_id").cast("string")).alias("seriesID"), F.array(first, second).alias("data"),
        )).alias("series")).alias("Results"),
    ))
    cut = F.when(F.col("event_id") % 13 == 0, F.substring(payload, 1, 30)).when(F.col("event_id") % 17 == 0, '{"status": "REQUEST_SUCCEEDED"}')
    return events.select(F.coalesce(cut, payload).alias("payload"))


@query("s5_read_catalogue", """
    select case p_partkey % 3 when 0 then 'LNU0' when 1 then 'LNS1' else 'LNX' end || p_partkey as series_id,
        case p_partkey % 3 when 0 then p_name when 1 then p_brand else p_type end as title,
        case when p_partkey % 3 = 0 then 'M' end as periodicity,
        case when p_partkey % 3 = 0 then p_size end as disa_code from part""")
def s5(spark, sf):
    """Documents of three layouts: ids with attributes, with titles in sections, with titles only; some ids come twice."""
    key = F.col("p_partkey").cast("string")
    flat = F.to_json(F.struct(F.create_map(F.concat(F.lit("LNU0"), key), F.struct(
        F.col("p_name").alias("title"), F.lit("M").alias("periodicity"), F.col("p_size").alias("disa_code")
    )).alias("series")))
    older = F.to_json(F.struct(
        F.struct(F.create_map(F.lit("LNX"), F.lit("no series")).alias("series")).alias("_note"),
        F.struct(F.create_map(F.concat(F.lit("LNS1"), key), F.lit("first")).alias("series")).alias("employment"),
        F.struct(F.create_map(F.concat(F.lit("LNS1"), key), F.col("p_brand")).alias("series")).alias("again"),
    ))
    titles = F.to_json(F.struct(F.create_map(F.concat(F.lit("LNX"), key), F.col("p_type")).alias("series")))
    path = f"{work_folder(spark, 'catalogue')}/series"
    kind = F.col("p_partkey") % 3
    table(spark, sf, "part").select(F.when(kind == 0, flat).when(kind == 1, older).otherwise(titles)).write.text(path)
    return W.read_catalogue(spark, path, lines=True).select("series_id", "title", "periodicity", "disa_code")


@query("s6_variable_columns", """
    select n_nationkey, case when n_regionkey % 2 = 0 then n_regionkey end as "B18120_001E", n_name as "S1810_C01_001PE" from nation""")
def s6(spark, sf):
    """Of a wide table the key and the columns that its header tells to be variables."""
    wide = table(spark, sf, "nation").select(
        "n_nationkey", F.col("n_name").alias("NAME"), F.when(F.col("n_regionkey") % 2 == 0, F.col("n_regionkey")).alias("B18120_001E"),
        F.col("n_name").alias("S1810_C01_001PE"), F.lit("stale").alias("NAME_1"), F.lit("01").alias("state"))
    return wide.select("n_nationkey", *W.variable_columns(wide))


_TOKEN = """case c_custkey % 9 when 0 then '' when 1 then 'NA' when 2 then 'N/A' when 3 then 'NaN' when 4 then 'nan'
    when 5 then 'NULL' when 6 then 'null' else {} end"""


@query("s7_read_cleaned", f"""
    select case when c_custkey % 9 < 7 then null else c_name end as state, '0' || c_custkey as fips,
        2000 + c_nationkey as year, case when c_custkey % 9 < 7 then null else c_acctbal end as dis_employed,
        'S' || c_nationkey % 3 as table_id, null as pop_16_plus, null as remark, null as two_lines, null as year_again from customer
    union all select null, '0' || s_suppkey, 2000 + s_nationkey, s_acctbal, 'T1', cast(s_suppkey as double), s_name, null, null from supplier
    union all select null, cast(n_nationkey as varchar), 2010, null, 'T2', null, null, n_name, '1999' from nation where n_nationkey % 4 <> 0""")
def s7(spark, sf):
    """Files whose columns differ in number, order and case, with a text column of no table, a header with a line break and
    rows with surplus fields, in folders that tell the table."""
    path = f"{work_folder(spark, 'cleaned')}/acs_S1811_cleaned.csv"
    T.write_cleaned(table(spark, sf, "customer").select(
        F.expr(_TOKEN.format("c_name")).alias("state"), F.concat(F.lit("0"), F.col("c_custkey").cast("string")).alias("fips"),
        (F.col("c_nationkey") + 2000).alias("year"),
        F.expr(_TOKEN.format("cast(c_acctbal as varchar(30))")).alias("dis_employed"),
        F.concat(F.lit("S"), F.col("c_nationkey") % 3).alias("table_id"),
    ), path, by=("table_id",), kind="csv")
    T.write_cleaned(table(spark, sf, "supplier").select(
        (F.col("s_nationkey") + 2000).alias("year"), F.col("s_name").alias("remark"), F.col("s_suppkey").alias("pop_16_plus"),
        F.col("s_acctbal").alias("dis_employed"), F.concat(F.lit("0"), F.col("s_suppkey").cast("string")).alias("fips"), F.lit("T1").alias("table_id"),
    ), path, by=("table_id",), kind="csv")
    line = F.concat_ws(",", "n_nationkey", "n_name", F.lit("2010,1999"), F.when(F.col("n_nationkey") % 4 == 0, F.lit("surplus")))
    table(spark, sf, "nation").agg(F.collect_list(line).alias("lines")).select(F.concat(
        F.lit('fips,"two\nlines",Year,year\n'), F.array_join("lines", "\n"))).write.text(f"{path}/table_id=T2")
    return T.read_cleaned(spark, path).withColumnsRenamed({"two\nlines": "two_lines", "year.1": "year_again"})


def orders_by_table(spark, sf):
    return table(spark, sf, "orders").withColumns({
        "table_id": F.concat(F.lit("T"), F.col("o_orderstatus")), "year": F.year("o_orderdate")
    })


@query("s8_write_cleaned", """
    with o as (select 'T' || o_orderstatus as table_id, cast(year(o_orderdate) as integer) as year, * from orders)
    select table_id, year, count(*) as row_count, cast(sum(cast(round(o_totalprice * 100) as bigint)) as bigint) as cents,
        cast(case when table_id = 'TF' and year = 1996 then 2 else 1 end as integer) as version from o group by 1, 2""")
def s8(spark, sf):
    path = f"{work_folder(spark, 'cleaned')}/acs"
    rows = orders_by_table(spark, sf).withColumn("version", F.lit(1))
    T.write_cleaned(rows, path)
    again = rows.filter("table_id = 'TF' and year = 1996").withColumn("version", F.lit(2))
    T.write_cleaned(again, path)
    return spark.read.parquet(path).groupBy("table_id", F.col("year").cast("int").alias("year")).agg(
        F.count(F.lit(1)).alias("row_count"),
        F.sum(F.round(F.col("o_totalprice") * 100).cast("bigint")).alias("cents"),
        F.max("version").alias("version"),
    )


def _published(spark, name, frames):
    T.ensure_database(spark, "published")
    return T.publish(frames, f"published.{name}", f"{work_folder(spark, 'published')}/{name}")


@query("s9_publish", f"""with {YEARS}
    select year, count(*) as row_count, count(o_totalprice) as total_price, count(o_orderstatus) as o_orderstatus,
        count(o_orderpriority) as o_orderpriority from combined group by year""")
def s9(spark, sf):
    frames = [
        f.withColumnRenamed("o_totalprice", "Total | price") for f in year_frames(spark, sf)
    ]
    _published(spark, "orders_by_year", frames)
    return spark.table("published.orders_by_year").groupBy("year").agg(
        F.count(F.lit(1)).alias("row_count"),
        *[F.count(c).alias(c) for c in ("total_price", "o_orderstatus", "o_orderpriority")],
    )


_FILE = """
    case p_partkey % 4
        when 0 then 'acs_S' || p_size || '_' || lpad(cast(p_partkey % 10000 as varchar(20)), 4, '0') || '_cleaned.csv'
        when 1 then 'bls_' || replace(p_name, ' ', '-') || '_cleaned.csv'
        when 2 then 'acs_B' || p_size || '_201_cleaned.csv'
        else 'bls_cps_' || p_type || '.csv'
    end
"""
_PUBLISH = """regexp_replace(regexp_replace(replace(lower(regexp_replace(file_name, '\\.[^.]*$', '')), '_cleaned', ''),
    '_\\d{4}$', ''), '[^a-z0-9_]', '_', 'g')"""


@query("s11_route_files", f"""
    with f as (select p_partkey, {_FILE} as file_name from part)
    select p_partkey, nullif(regexp_extract(file_name, '^acs_([A-Za-z0-9]+)_(\\d{{4}})_cleaned\\.csv$', 1), '') as table_id,
        try_cast(nullif(regexp_extract(file_name, '^acs_([A-Za-z0-9]+)_(\\d{{4}})_cleaned\\.csv$', 2), '') as integer) as year,
        {_PUBLISH} as publish_name from f""")
def s11(spark, sf):
    files = table(spark, sf, "part").select("p_partkey", F.expr(_FILE).alias("file_name"))
    return W.route_files(files).select("p_partkey", "table_id", "year", "publish_name")


@query("s12_backlog", """
    with o as (select 'C' || o_custkey as table_id, cast(year(o_orderdate) as integer) as year, * from orders),
    wanted as (select distinct table_id, year, level from o, (values ('county'), ('state')) l(level)),
    landed as (select distinct table_id, year, case when o_orderpriority like '1%' then 'state' else 'county' end as level
               from o where o_orderstatus = 'F'),
    flags as (select distinct table_id, year from landed where level = 'county')
    select w.table_id, w.year, w.level, case when f.year is not null and w.level = 'state' then 'state only' else 'full' end as work
    from wanted w anti join landed l on l.table_id = w.table_id and l.year = w.year and l.level = w.level
    left join flags f on f.table_id = w.table_id and f.year = w.year""")
def s12(spark, sf):
    orders = table(spark, sf, "orders").withColumns({
        "table_id": F.concat(F.lit("C"), F.col("o_custkey").cast("string")), "year": F.year("o_orderdate")
    })
    wanted = orders.select("table_id", "year").distinct().select(
        "*", F.explode(F.array(F.lit("county"), F.lit("state"))).alias("level")
    )
    level = F.when(F.col("o_orderpriority").startswith("1"), "state").otherwise("county")
    landed = orders.filter("o_orderstatus = 'F'").select("table_id", "year", level.alias("level")).distinct()
    return T.backlog(wanted, landed)


@query("s13_table_inventory", """
    select 'nations' as table_name, count(*) as row_count, true as loaded_now from nation
    union all select 'orders_of_customers', count(*), true from orders join customer on o_custkey = c_custkey""")
def s13(spark, sf):
    orders, customer = table(spark, sf, "orders"), table(spark, sf, "customer")
    T.ensure_database(spark, "inventory")
    tables = {
        "nations": table(spark, sf, "nation"),
        "orders_of_customers": orders.join(customer, F.col("o_custkey") == F.col("c_custkey")),
    }
    for name, df in tables.items():
        T.publish([df], f"inventory.{name}", f"{work_folder(spark, 'inventory')}/{name}")
    lately = F.col("last_loaded").between(F.current_timestamp() - F.expr("interval 1 hour"), F.current_timestamp() + F.expr("interval 1 hour"))
    return T.table_inventory(spark, "inventory").select("table_name", "row_count", lately.alias("loaded_now"))


_WIDTH = "p_size + p_partkey % 10000 % 7"


@query("s14_load_preview", f"""
    with f as (select 'acs_t' || p_size || '_' || lpad(cast(p_partkey % 10000 as varchar), 4, '0') || '_cleaned.csv' as file_name,
        cast({_WIDTH} as bigint) as column_count from part),
    r as (select {_PUBLISH} as table_name, * from f)
    select table_name, count(*) as file_count, arg_min(column_count, file_name) as column_count from r group by 1""")
def s14(spark, sf):
    name = F.expr("'acs_t' || p_size || '_' || lpad(cast(p_partkey % 10000 as string), 4, '0') || '_cleaned.csv'")
    files = table(spark, sf, "part").select(name.alias("file_name"), F.expr(_WIDTH).cast("bigint").alias("column_count"))
    return T.load_preview(files)


@query("u3_union_for_publish", f"""with {YEARS}
    select year, o_orderkey, o_totalprice as total_price, o_orderstatus as order_status, o_orderpriority as order_status_1
    from combined""")
def u3(spark, sf):
    frames = [
        f.withColumnsRenamed({"o_totalprice": "Total | price", "o_orderstatus": "Order status",
                              "o_orderpriority": "order >> status"})
        for f in year_frames(spark, sf)
    ]
    return T.union_for_publish(frames)


@query("s15_data_dictionary", """
    with c as (select 2000 + s_nationkey as year, s_suppkey, s_acctbal from supplier),
    y as (select 'year' as column_name, min(year) as first_year, max(year) as last_year, count(distinct year) as n_years, 'int' as type from c
        union all select 'fips', min(year), max(year), count(distinct year), 'string' from c
        union all select 'dis_employed', min(case when s_acctbal > 0 then year end), max(case when s_acctbal > 0 then year end),
            count(distinct case when s_acctbal > 0 then year end), 'double' from c
        union all select 'pop_16_plus', null, null, 0, 'double')
    select 'S1811' as table_id, y.column_name, y.type, description, first_year, last_year, n_years
    from y join (values ('year', 'Calendar year the row is about'),
        ('fips', 'Code of the geography: state code, followed by the county code in rows of counties'),
        ('dis_employed', 'With a Disability, Population Age 16 and Over, EMPLOYMENT STATUS, Employed'),
        ('pop_16_plus', 'Total Civilian Noninstitutionalized Population, Population Age 16 and Over')) d(column_name, description)
        on d.column_name = y.column_name""")
def s15(spark, sf):
    """Dictionary of a published survey table, from the table as it was published."""
    rows = table(spark, sf, "supplier").select(
        (F.col("s_nationkey") + 2000).cast("int").alias("year"), F.col("s_suppkey").cast("string").alias("fips"),
        F.when(F.col("s_acctbal") > 0, F.col("s_acctbal").cast("double")).alias("dis_employed"), F.lit(None).cast("double").alias("pop_16_plus"))
    _published(spark, "dictionary_of", [rows])
    return T.data_dictionary(spark.table("published.dictionary_of"), "S1811").drop("position")


def _folder(spark, sf):
    """Cleaned files of two survey years with different columns, and of a series table."""
    path = work_folder(spark, "folder")
    customers, suppliers = table(spark, sf, "customer"), table(spark, sf, "supplier")
    fips = F.when(F.col("c_custkey") % 5 != 0, F.col("c_custkey")).alias("fips")
    customers.filter("c_custkey % 2 = 0").select(F.lit(2010).alias("year"), fips, F.col("c_acctbal").alias("dis_employed")).write.csv(
        f"{path}/acs_S1811_2010_cleaned.csv", header=True)
    customers.filter("c_custkey % 2 = 1").select(fips, F.lit(2011).alias("year"), F.lit("NA").alias("pop_16_plus")).write.csv(
        f"{path}/acs_S1811_2011_cleaned.csv", header=True)
    suppliers.select(F.col("s_suppkey").alias("series_id"), F.lit(2012).alias("year"), F.col("s_acctbal").alias("value")).write.csv(
        f"{path}/bls_cps_cleaned.csv", header=True)
    return path


@query("e4_publish_folder", """
    select 'folder_published.acs_s1811' as table_name, count(*) as row_count from customer
    union all select 'folder_published.bls_cps', count(*) from supplier""")
def e4(spark, sf):
    return publish_folder(spark, f"{_folder(spark, sf)}/*", "folder_published").select("table_name", "row_count")


_NEGATIVE = "case when count_if({0} < 0) > 0 then '{1}' else '' end"


@query("e5_profile_folder", f"""
    with f as (
        select 'acs_S1811_2010_cleaned.csv' as file, count(*) as row_count, 3 as column_count, count(*) - count(distinct (c_custkey % 5 = 0, case when c_custkey % 5 <> 0 then c_custkey end, c_acctbal)) as duplicate_rows,
            count_if(c_custkey % 5 = 0) as missing_fips, 2010 as year_min, 2010 as year_max, count_if(c_custkey % 5 = 0) as total_nulls, '' as high_null_cols,
            {_NEGATIVE.format('c_acctbal', 'dis_employed')} as negative_cols from customer where c_custkey % 2 = 0
        union all select 'acs_S1811_2011_cleaned.csv', count(*), 3, greatest(count_if(c_custkey % 5 = 0) - 1, 0), count_if(c_custkey % 5 = 0), 2011, 2011, count(*) + count_if(c_custkey % 5 = 0),
            'pop_16_plus', '' from customer where c_custkey % 2 = 1
        union all select 'bls_cps_cleaned.csv', count(*), 3, 0, null, 2012, 2012, 0, '', {_NEGATIVE.format('s_acctbal', 'value')} from supplier)
    select *, case when duplicate_rows > 0 or high_null_cols <> '' or negative_cols <> '' then 'WARN' else 'OK' end as status, null as error from f
    union all select 'empty_cleaned.csv', null, null, null, null, null, null, null, null, null, 'ERROR', 'no header could be read'""")
def e5(spark, sf):
    path = _folder(spark, sf)
    table(spark, sf, "nation").filter("false").select("n_name").coalesce(1).write.text(f"{path}/empty_cleaned.csv")
    return profile_folder(spark, f"{path}/*")


def _detail(file, position, column, value, source):
    text = f"cast({value} as varchar)"
    return f"""select '{file}' as file, {position} as position, '{column}' as "column", count(*) - count({text}) as null_count,
        round((count(*) - count({text})) / count(*) * 100, 2) as null_pct, count(distinct {text}) as unique_count, cast(min({value}) as double) as min,
        cast(max({value}) as double) as max, case when count({text}) > 0 then count_if({value} < 0) end as negative_count, round(avg({value}), 4) as mean from {source}"""


_FIPS = "case when c_custkey % 5 <> 0 then c_custkey end"


@query("e5_validation_detail", " union all ".join([
    _detail("acs_S1811_2010_cleaned.csv", 0, "year", "2010", "customer where c_custkey % 2 = 0"),
    _detail("acs_S1811_2010_cleaned.csv", 1, "fips", _FIPS, "customer where c_custkey % 2 = 0"),
    _detail("acs_S1811_2010_cleaned.csv", 2, "dis_employed", "c_acctbal", "customer where c_custkey % 2 = 0"),
    _detail("acs_S1811_2011_cleaned.csv", 0, "fips", _FIPS, "customer where c_custkey % 2 = 1"),
    _detail("acs_S1811_2011_cleaned.csv", 1, "year", "2011", "customer where c_custkey % 2 = 1"),
    _detail("acs_S1811_2011_cleaned.csv", 2, "pop_16_plus", "cast(null as integer)", "customer where c_custkey % 2 = 1"),
    _detail("bls_cps_cleaned.csv", 0, "series_id", "s_suppkey", "supplier"),
    _detail("bls_cps_cleaned.csv", 1, "year", "2012", "supplier"),
    _detail("bls_cps_cleaned.csv", 2, "value", "s_acctbal", "supplier")]))
def e5_detail(spark, sf):
    """Every column of every file of a folder."""
    return validate_folder(spark, f"{_folder(spark, sf)}/*")[0].drop("dtype").withColumn("mean", F.round("mean", 4))


@query("s9_publish_report", """select 'published.reported' as table_name, count(*) as row_count, true as has_bytes from orders""")
def s9_report(spark, sf):
    """What publishing reports of a table that is written in folders of its year."""
    rows = table(spark, sf, "orders").select(F.year("o_orderdate").alias("year"), "o_orderkey", "o_totalprice")
    T.ensure_database(spark, "published")
    report = T.publish([rows], "published.reported", f"{work_folder(spark, 'published')}/reported", by=("year",))
    return report.select("table_name", "row_count", (F.col("byte_count") > 0).alias("has_bytes"))


@query("s10_ensure_database", """select 'made_by_need' as database_name, count(*) as row_count from supplier""")
def s10(spark, sf):
    """A database that is made once and keeps its tables when it is asked for again."""
    T.ensure_database(spark, "made_by_need")
    T.publish([table(spark, sf, "supplier")], "made_by_need.suppliers", f"{work_folder(spark, 'database')}/suppliers")
    T.ensure_database(spark, "made_by_need")
    return spark.table("made_by_need.suppliers").groupBy(F.lit("made_by_need").alias("database_name")).agg(F.count(F.lit(1)).alias("row_count"))
