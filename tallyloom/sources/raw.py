"""Readers of landed survey files and service responses."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tallyloom.functions.labels import is_variable
from tallyloom.functions.series import join_texts
from tallyloom.operators.relational import lookup
from tallyloom.session import delete, exists
from tallyloom.sources.headers import REJECTS, SURPLUS, file_headers, read_by_header, rejected_rows, sound

RAW_SCHEMA = "table_id string, year int, level string, name string, state string, county string, vars map<string,string>"
RAW_COLUMNS = [field.split()[0] for field in RAW_SCHEMA.replace("string,string", "").split(",")]
META_SCHEMA = """
    table_id string, year int, table_type string,
    variables map<string, struct<label: string, concept: string>>,
    pe_parents map<string, string>
"""
RESPONSE_SCHEMA = """
    struct<status: string, Results: struct<series: array<struct<
        seriesID: string,
        data: array<struct<year: string, period: string, value: string,
                           footnotes: array<struct<text: string>>>>>>>>
"""


def route_files(df: DataFrame, col: str = "file_name") -> DataFrame:
    """Table and year told by a file name, and the warehouse table it is published to."""
    name = F.col(col)
    pattern = r"^acs_([A-Za-z0-9]+)_(\d{4})_cleaned\.csv$"
    stem = F.replace(F.lower(F.regexp_replace(name, r"\.[^.]*$", "")), F.lit("_cleaned"), F.lit(""))
    undated = F.regexp_replace(stem, r"_\d{4}$", "")
    return df.withColumns({
        "table_id": F.when(name.rlike(pattern), F.regexp_extract(name, pattern, 1)),
        "year": F.when(name.rlike(pattern), F.regexp_extract(name, pattern, 2).cast("int")),
        "publish_name": F.regexp_replace(undated, "[^a-z0-9_]", "_"),
    })


def read_raw_acs(
    spark: SparkSession, paths: str | list[str], multi_line: bool = True, headers: dict[tuple[str, ...], list[str]] | None = None
) -> DataFrame:
    """Wide raw files, each with a header of its own, as one table with the variables in a map.

    The path names table, year and level. Files with the same header are one scan. Rows with more
    fields than their header are left out; `rejected_rows` has them.
    """
    return _keyed(spark, [sound(df) for df in read_by_header(spark, paths, multi_line, headers)]).select(*RAW_COLUMNS)


def _keyed(spark: SparkSession, frames: list[DataFrame]) -> DataFrame:
    """The rows of wide files with the variables in a map; what else `read_by_header` adds is kept."""
    names = sorted({c for df in frames for c in df.columns})
    variables = set(variable_names(spark, names))
    parts = []
    for df in frames:
        own = [c for c in df.columns if c in variables]
        keys, values = F.array(*map(F.lit, own)), F.array(*[F.col(f"`{c}`") for c in own])
        entries = F.map_from_arrays(keys, values) if own else F.create_map().cast("map<string,string>")
        field = {c: F.col(c) if c in df.columns else F.lit(None).cast("string") for c in ("NAME", "state", "county")}
        kept = [c for c in ("_path", "_surplus") if c in df.columns]
        parts.append(df.select(*_told(F.col("_path")), *[v.alias(c.lower()) for c, v in field.items()], entries.alias("vars"), *kept))
    if not parts:
        return spark.createDataFrame([], f"{RAW_SCHEMA}, _path string, _surplus string")
    return reduce(DataFrame.unionByName, parts)


def _told(path: Column) -> list[Column]:
    """Table, in upper case, year and level as the path tells them."""
    pattern = r"acs_([A-Za-z0-9]+)_(\d{4})(_state)?_raw"
    return [
        F.upper(F.regexp_extract(path, pattern, 1)).alias("table_id"),
        F.regexp_extract(path, pattern, 2).try_cast("int").alias("year"),
        F.when(F.regexp_extract(path, pattern, 3) == "", "county").otherwise("state").alias("level"),
    ]


def land_raw(
    spark: SparkSession, paths: str | list[str], target: str, multi_line: bool = True, rejects: str | None = None
) -> DataFrame:
    """Raw files as a columnar landing table by table, year and level, which the survey plans prune; returns it.

    Only the folders that the files belong to are replaced. Rows that do not fit their header, and
    files without one, go to a table in folders of the same kind, beside the landing or at `rejects`. They are
    counted while the rest is written, and read again only where there are any.
    """
    by = ["table_id", "year", "level"]
    headers = file_headers(spark, paths)
    seen = Observation()
    rows = _keyed(spark, read_by_header(spark, paths, multi_line, headers)).observe(seen, F.count("_surplus").alias("surplus"))
    rows = rows.where(F.col("_surplus").isNull()).select(*RAW_COLUMNS)
    writer = rows.hint("rebalance", *by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*by).parquet(target)
    beside = rejects or f"{target.rstrip('/')}_rejects"
    files = spark.createDataFrame([(f,) for own in headers.values() for f in own], "file string")
    for table_id, year, level in files.select(*_told(F.col("file"))).distinct().collect():
        delete(spark, f"{beside}/table_id={table_id}/year={year}/level={level}")
    if headers.get(()) or (seen.get["surplus"] if any(headers) else 0):
        lost = rejected_rows(spark, paths, multi_line, headers).select("*", *_told(F.col("file")))
        lost.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(beside)
    return spark.read.schema(rows.schema).parquet(target)


def read_rejects(spark: SparkSession, path: str) -> DataFrame:
    """The rejects that landings left at `path`; none if no landing had any."""
    schema = f"{REJECTS}, table_id string, year int, level string"
    return spark.read.schema(schema).parquet(path) if exists(spark, path) else spark.createDataFrame([], schema)


def variable_names(spark: SparkSession, names: list[str]) -> list[str]:
    """Those of the names that name data variables."""
    rows = spark.createDataFrame([(i, c) for i, c in enumerate(names)], "i int, c string")
    return [r["c"] for r in rows.filter(is_variable(F.col("c"))).orderBy("i").collect()]


def variable_columns(df: DataFrame) -> list[str]:
    """Header fields of a wide table that name data variables."""
    return variable_names(df.sparkSession, df.columns)


def read_acs_meta(spark: SparkSession, paths: str | list[str], lines: bool = False) -> DataFrame:
    """Variables of every table and year with label, concept and denominator.

    A file holds one document, or with `lines` one per line.
    """
    docs = spark.read.schema(META_SCHEMA).json(paths, multiLine=not lines)
    return explode_meta(docs)


def explode_meta(docs: DataFrame) -> DataFrame:
    exploded = docs.select("table_id", "year", "pe_parents", F.posexplode("variables").alias("meta_position", "var_id", "v"))
    return exploded.select(
        F.upper("table_id").alias("table_id"), "year", "var_id", F.col("v.label").alias("label"), F.col("v.concept").alias("concept"),
        F.try_element_at("pe_parents", F.col("var_id")).alias("pe_parent"),
        F.coalesce(F.map_contains_key("pe_parents", F.col("var_id")), F.lit(False)).alias("has_parent_entry"),
        "meta_position",
    )


def _numbered(names: Column) -> Column:
    """Names of a header; one met again gets a number after a dot, and one that is missing is empty."""
    def fresh(array: Column) -> Column:
        def name(x: Column, i: Column) -> Column:
            before = F.size(F.filter(F.slice(array, F.lit(1), i), lambda y: y == x))
            return F.when(before > 0, F.concat(x, F.lit("."), before.cast("string"))).otherwise(x)

        return F.transform(array, name)

    # Twice, as a number may make a name that the header has itself.
    return fresh(fresh(F.transform(names, lambda x: F.coalesce(x, F.lit("")))))


def _matrix(df: DataFrame, payload: str, keep: list[str]) -> DataFrame:
    parsed = df.select(*keep, F.col(payload).alias("_text"), F.from_json(payload, "array<array<string>>").alias("_m"))
    width = F.size(F.element_at("_m", 1))
    fits = F.when(F.size("_m") > 0, F.coalesce(F.forall(F.slice("_m", 2, F.greatest(F.size("_m") - 1, F.lit(0))), lambda r: F.size(r) <= width), F.lit(False)))
    return parsed.withColumn("_reason", F.when(F.col("_m").isNull(), "no array of rows").when(F.size("_m") == 0, "no header").when(~fits, SURPLUS))


def explode_matrix(df: DataFrame, payload: str, keep: list[str] | None = None) -> DataFrame:
    """Array-of-arrays responses as rows: a map from the first row's names to the values.

    A name met again gets a number after a dot; values that a short row lacks are NULL. Responses
    that are no such array, or have a row with more values than names, are left out whole;
    `rejected_matrices` has them.
    """
    keep = keep or []
    parsed = _matrix(df, payload, keep).where("_reason is null")
    rows = parsed.select(
        *keep, _numbered(F.element_at("_m", 1)).alias("_header"),
        F.posexplode(F.slice("_m", F.lit(2), F.greatest(F.size("_m") - 1, F.lit(0)))).alias("row_number", "_row"),
    )
    value = F.transform("_header", lambda name, i: F.struct(name, F.get("_row", i)))
    return rows.select(*keep, "row_number", F.map_from_entries(value).alias("record"))


def rejected_matrices(df: DataFrame, payload: str, keep: list[str] | None = None) -> DataFrame:
    """Responses that `explode_matrix` leaves out, with the reason and their text."""
    keep = keep or []
    return _matrix(df, payload, keep).where("_reason is not null").select(*keep, F.col("_reason").alias("reason"), F.col("_text").alias("record"))


def flatten_series(df: DataFrame, payload: str, catalogue: DataFrame) -> DataFrame:
    """Nested series responses as long rows with the catalogue's titles; only succeeded ones.

    `rejected_responses` has the others.
    """
    parsed = df.select(F.from_json(payload, RESPONSE_SCHEMA).alias("r")).filter("r.status = 'REQUEST_SUCCEEDED'")
    series = parsed.select(F.explode("r.Results.series").alias("s"))
    rows = series.select(F.coalesce("s.seriesID", F.lit("")).alias("series_id"), F.explode("s.data").alias("d"))
    long = rows.select(
        "series_id", *[F.coalesce(f"d.{c}", F.lit("")).alias(c) for c in ("year", "period", "value")],
        join_texts(F.col("d.footnotes")).alias("footnotes"),
    )
    titles = catalogue.select("series_id", F.col("title").alias("series_description"))
    return lookup(long, titles, ["series_id"], measure=True).fillna("", ["series_description"])


def rejected_responses(df: DataFrame, payload: str, keep: list[str] | None = None) -> DataFrame:
    """Responses that `flatten_series` takes no rows from, with the reason and their text.

    A response is broken if it is no JSON of the expected shape, failed if its status says so, and
    empty if it succeeded without any value.
    """
    shape = RESPONSE_SCHEMA.strip().removeprefix("struct<").removesuffix(">")
    parsed = F.from_json(payload, f"struct<{shape}, _broken: string>", {"columnNameOfCorruptRecord": "_broken"})
    rows = df.select(*(keep or []), F.col(payload).alias("record"), parsed.alias("_r"))
    values = F.coalesce(F.aggregate("_r.Results.series", F.lit(0), lambda n, s: n + F.greatest(F.coalesce(F.size(s["data"]), F.lit(0)), F.lit(0))), F.lit(0))
    reason = (
        F.when(F.col("_r").isNull() | F.col("_r._broken").isNotNull(), "broken")
        .when(F.col("_r.status").isNull(), "no status")
        .when(F.col("_r.status") != "REQUEST_SUCCEEDED", F.concat(F.lit("failed: "), "_r.status"))
        .when(values == 0, "empty")
    )
    return rows.select(*(keep or []), reason.alias("reason"), "record").where("reason is not null")


SERIES_SCHEMA = """
    struct<title: string, periodicity: string, seasonal: string, disa_code: int, sexs_code: int, ages_code: int,
        race_code: int, orig_code: int, lfst_code: int, occupation_code: int, indy_code: int, class_code: int>
"""
SERIES_FIELDS = [field.split(":")[0].strip() for field in SERIES_SCHEMA.strip().removeprefix("struct<").removesuffix(">").split(",")]


def explode_catalogue(df: DataFrame, col: str, order: str | None = None) -> DataFrame:
    """Series catalogue documents in any of their layouts, one row per series.

    Ids lie below `series`, each with its attributes or only its title, or in sections of the older layout
    that have such a `series` of titles; sections whose name starts with `_` are notes. Of an id met twice the
    last one counts, by `order` of the documents, then by the order of sections and of ids in them.
    """
    doc = F.col(col)
    said = df.select((F.col(order) if order else F.monotonically_increasing_id()).alias("_doc"), doc.alias("_text"))
    raw = "map<string, string>"
    top = said.withColumn("_series", F.get_json_object("_text", "$.series"))
    flat = top.filter(F.col("_series").isNotNull()).select(
        "_doc", F.lit(0).alias("_section"), F.posexplode(F.from_json("_series", raw)).alias("_place", "series_id", "_body"))
    sections = top.filter(F.col("_series").isNull()).select(
        "_doc", F.posexplode(F.from_json("_text", raw)).alias("_section", "_name", "_inner"))
    older = sections.filter(~F.col("_name").startswith("_")).select("_doc", "_section", F.posexplode(
        F.from_json(F.get_json_object("_inner", "$.series"), raw)).alias("_place", "series_id", "_body"))
    entries = flat.unionByName(older)
    last = entries.groupBy("series_id").agg(F.max_by("_body", F.struct("_doc", "_section", "_place")).alias("_body"))
    is_record = F.col("_body").startswith("{")
    record = F.from_json(F.when(is_record, F.col("_body")), SERIES_SCHEMA)
    title = F.when(is_record, record["title"]).otherwise(F.col("_body"))
    return last.select("series_id", title.alias("title"), *[record[c].alias(c) for c in SERIES_FIELDS if c != "title"])


def read_catalogue(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """Catalogue files; a file holds one document, or with `lines` one per line."""
    return explode_catalogue(spark.read.text(path, wholetext=not lines), "value")
