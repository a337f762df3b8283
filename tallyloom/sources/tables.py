"""Cleaned and published tables: readers, sinks, inventory and comments."""

from __future__ import annotations

import re
import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.fixed import NULL_TOKENS, PUBLISHED_COLUMNS, SURVEY_TABLES, SURVEY_YEARS
from tallyloom.functions.numbers import to_number, to_year
from tallyloom.operators.catalogue import upsert
from tallyloom.operators.relational import combine_years, missing_in
from tallyloom.operators.shape import sanitize_columns
from tallyloom.operators.quality import availability
from tallyloom.session import children, configured, delete, exists, materialise
from tallyloom.sources.headers import read_by_header, sound
from tallyloom.sources.raw import route_files

VERSION = "version-"  # how folders of published versions begin
# Columns that hold numbers: the published measures and the value of a series.
NUMBERS = frozenset(["value", *[name for columns in PUBLISHED_COLUMNS.values() for name in columns.values()]])


def clean_tokens(df: DataFrame) -> DataFrame:
    """NULL for the texts that stand for a missing value."""
    texts = [c for c, kind in df.dtypes if kind == "string"]
    return df.withColumns({c: F.when(~F.col(f"`{c}`").isin(NULL_TOKENS), F.col(f"`{c}`")) for c in texts})


def read_cleaned(spark: SparkSession, path: str | list[str], numbers: frozenset[str] | None = None, multi_line: bool = True) -> DataFrame:
    """Cleaned CSV files, each read by its own header, as one table with all their columns.

    `numbers` (by default the published measures) become doubles and the year an int; everything else stays text, as do values that
    folders such as `table_id=S1811` tell. A column that a file lacks is NULL in its rows; names that
    differ in case only are one column across files, and numbered within one. Rows with more fields
    than their header are left out; `rejected_rows` has them.
    """
    numbers = NUMBERS if numbers is None else numbers
    frames = []
    for df in map(sound, read_by_header(spark, path, multi_line)):
        folders = _folder_values(df)
        told = {k: F.url_decode(F.regexp_extract("_path", f"/{k}=([^/]*)/", 1)) for k in folders}
        told = {k: F.when(v != "__HIVE_DEFAULT_PARTITION__", v) for k, v in told.items()}
        frames.append(clean_tokens(df.withColumns(told).drop("_path")))
    if not frames:
        return spark.createDataFrame([], "year int")
    raw = combine_years(frames)
    raw = raw.withColumnsRenamed({c: "year" for c in raw.columns if c.lower() == "year"})
    typed = {c: to_year(F.col(c)) if c == "year" else to_number(F.col(c)) for c in raw.columns if c == "year" or c in numbers}
    return raw.withColumns(typed)


def _folder_values(df: DataFrame) -> list[str]:
    """Names of the values that the folders of the files tell."""
    return sorted({k for f in df.inputFiles() for k in re.findall(r"/([^/=]+)=[^/]*(?=/)", f)})


def write_cleaned(
    df: DataFrame, path: str, by: tuple[str, ...] = ("table_id", "year"), kind: str = "parquet", order: tuple[str, ...] = ()
) -> None:
    """One folder per table and year, rows of a file in `order`; only the folders written to are replaced.

    The rebalance hint brings the rows of a folder together but lets adaptive execution split a
    folder that holds much of the data over several tasks and files.
    """
    rows = df.hint("rebalance", *by)
    rows = rows.sortWithinPartitions(*by, *order) if order else rows
    writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    if kind == "csv":
        writer = writer.option("header", True)
    writer.partitionBy(*by).format(kind).save(path)


def ensure_database(spark: SparkSession, name: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}")


def union_for_publish(frames: list[DataFrame]) -> DataFrame:
    return sanitize_columns(combine_years(frames))


def publish(frames: list[DataFrame], name: str, path: str | None = None, by: tuple[str, ...] = ()) -> DataFrame:
    """Replace a table by the by-name union of the frames, in folders of `by`; returns its rows and bytes.

    The rows go to a new folder, below `path` or beside the tables of the database, and are counted
    there against what was written. Only then the table takes the new folder: the finished table is
    registered under a name of its own, and names are swapped. So a write that fails, or finds too
    few rows, leaves the table as it was. The version before stays for readers under way; older ones go.
    """
    spark = frames[0].sparkSession
    _recover(spark, name)
    base = path or _home(spark, name)
    folder, staged = f"{base.rstrip('/')}/{VERSION}{uuid.uuid4().hex}", f"{name}__next"
    spark.sql(f"DROP TABLE IF EXISTS {staged}")
    seen = Observation()
    rows = union_for_publish(frames).observe(seen, F.count(F.lit(1)).alias("n"))
    writer = (rows.hint("rebalance", *by) if by else rows).write.format("parquet").option("path", folder)
    try:
        (writer.partitionBy(*by) if by else writer).saveAsTable(staged)
        written = spark.read.parquet(folder).count() if rows.columns else 0
        if written != seen.get["n"]:
            raise RuntimeError(f"{name}: {written} of {seen.get['n']} rows were written")
        spark.sql(f"ANALYZE TABLE {staged} COMPUTE STATISTICS")
    except BaseException:
        spark.sql(f"DROP TABLE IF EXISTS {staged}")
        delete(spark, folder)
        raise
    before = _location(spark, name) if spark.catalog.tableExists(name) else None
    _swap(spark, name, staged)
    for old in _versions(spark, base):
        if old not in (folder.rsplit("/", 1)[-1], (before or "").rstrip("/").rsplit("/", 1)[-1]):
            delete(spark, f"{base.rstrip('/')}/{old}")
    return spark.sql(f"DESCRIBE EXTENDED {name}").filter("col_name = 'Statistics'").select(
        F.lit(name).alias("table_name"),
        F.regexp_extract("data_type", r"(\d+) rows", 1).cast("bigint").alias("row_count"),
        F.regexp_extract("data_type", r"(\d+) bytes", 1).cast("bigint").alias("byte_count"),
    )


def _swap(spark: SparkSession, name: str, staged: str) -> None:
    """Give the staged table the name; renaming touches the catalogue only. If it fails halfway the old table is back."""
    kept = f"{name}__old"
    spark.sql(f"DROP TABLE IF EXISTS {kept}")
    if spark.catalog.tableExists(name):
        spark.sql(f"ALTER TABLE {name} RENAME TO {kept}")
    try:
        spark.sql(f"ALTER TABLE {staged} RENAME TO {name}")
    except BaseException:
        _recover(spark, name)
        raise
    spark.sql(f"DROP TABLE IF EXISTS {kept}")


def _recover(spark: SparkSession, name: str) -> None:
    """Bring back a table that a publication gave up between its two renames."""
    if not spark.catalog.tableExists(name) and spark.catalog.tableExists(f"{name}__old"):
        spark.sql(f"ALTER TABLE {name}__old RENAME TO {name}")


def _home(spark: SparkSession, name: str) -> str:
    database, _, table = name.rpartition(".")
    place = spark.catalog.getDatabase(database or spark.catalog.currentDatabase()).locationUri
    return f"{place.rstrip('/')}/{table}_versions"


def _location(spark: SparkSession, name: str) -> str | None:
    row = spark.sql(f"DESCRIBE EXTENDED {name}").filter("col_name = 'Location'").first()
    return row["data_type"] if row else None


def _versions(spark: SparkSession, base: str) -> list[str]:
    return [name for name in children(spark, base) if name.startswith(VERSION)]


def merge_table(spark: SparkSession, path: str, new: DataFrame, key: list[str], by: list[str]) -> list[tuple]:
    """Merge rows into a Parquet table in folders of `by`, rewriting only folders that change; returns those.

    Columns of `new` that are not NULL win over those of the row with the same key; a key is NULL-safe
    and of a key met twice, on either side, the last row counts. A row whose key lies in another folder moves. Folders
    that hold no row any more go. Columns that the table lacks are added, for readers that merge schemas. Touched folders are found from the keys alone, merged in one shuffle and written
    beside the table before they replace what is there; all others keep their files.
    """
    new = materialise(new, "merge")
    if not exists(spark, path):
        new_rows = upsert(new.limit(0), new, key)
        write_cleaned(new_rows, path, tuple(by))
        return sorted({tuple(r) for r in new_rows.select(*by).distinct().collect()}, key=repr)
    found = spark.read.parquet(path).schema
    kinds = {f.name: f.dataType for f in new.schema if f.name in by}  # names of folders tell no types
    old = spark.read.schema(T.StructType([T.StructField(f.name, kinds.get(f.name, f.dataType)) for f in found])).parquet(path)
    places = new.select(*by).distinct()
    if not set(by) <= set(key):
        # Keys alone are read of the old table, to find where those of the new rows lie.
        keys = new.select(*[F.col(c).alias(f"_{c}") for c in key]).distinct()
        same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in key]
        places = places.unionByName(old.join(keys, same, "left_semi").select(*by)).distinct()
    touched = sorted({tuple(r) for r in places.collect()}, key=repr)  # folders of a table, whose names the driver lists anyhow
    if not touched:
        return []
    hit = reduce(Column.__or__, [reduce(Column.__and__, [F.col(c).eqNullSafe(F.lit(v).cast(old.schema[c].dataType)) for c, v in zip(by, place)]) for place in touched])
    merged = materialise(upsert(old.where(hit), new, key), "merge")
    write_cleaned(merged, path, tuple(by))
    full = {tuple(r) for r in merged.select(*by).distinct().collect()}
    for place in touched:
        if place not in full:
            names = [f"{c}={_folder_text(v)}" for c, v in zip(by, place)]
            delete(spark, "/".join([path.rstrip("/"), *names]))
    return touched


def _folder_text(value) -> str:
    """A value as the names of folders have it."""
    text = "__HIVE_DEFAULT_PARTITION__" if value is None or value == "" else str(value)
    return "".join(f"%{ord(c):02X}" if c in "\"#%'*/:=?\\{[]^" or ord(c) < 32 or ord(c) == 127 else c for c in text)


def _from_footers(spark: SparkSession) -> dict[str, str]:
    """Settings under which counts and extremes of Parquet files are read from their footers."""
    first = spark.conf.get("spark.sql.sources.useV1SourceList")
    others = ",".join(kind for kind in first.split(",") if kind.strip() != "parquet")
    return {"spark.sql.sources.useV1SourceList": others, "spark.sql.parquet.aggregatePushdown": "true"}


def footer_counts(spark: SparkSession, path: str, by: list[str] | None = None, columns: list[str] | None = None) -> DataFrame:
    """Rows, and values of each of `columns`, per folder of `by`, of a Parquet table, from footers and folder names alone.

    `by` are columns that folders tell, all of them or none. The result has as many rows as there are folders.
    """
    with configured(spark, _from_footers(spark)):
        df = spark.read.parquet(path)
        counts = [F.count(F.lit(1)).alias("row_count"), *[F.count(c).alias(c) for c in columns or []]]
        found = (df.groupBy(*by) if by else df).agg(*counts)
        return spark.createDataFrame(found.collect(), found.schema)


def availability_of(spark: SparkSession, path: str, columns: list[str], year: str = "year") -> DataFrame:
    """As `availability`, for columns of a Parquet table in folders of its year: first and last year with values."""
    counts = footer_counts(spark, path, [year], columns)
    each = F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("n")) for c in columns]))
    return counts.select(F.col(year).alias("year"), each).where("n > 0").groupBy("column").agg(
        F.min("year").alias("first_year"), F.max("year").alias("last_year"), F.sum("n").alias("value_count"))


def coverage_of(spark: SparkSession, path: str, by: list[str]) -> DataFrame:
    """As `coverage`, for a Parquet table in folders of `by`."""
    return footer_counts(spark, path, by)


def table_inventory(spark: SparkSession, database: str) -> DataFrame:
    """Tables of a database with rows and the time of the last load.

    Of Parquet tables both come from footers and the list of files, of views and other tables by reading them.
    """
    schema = "table_name string, row_count bigint, last_loaded timestamp"
    found = []
    for t in spark.catalog.listTables(database):
        if t.isTemporary:
            continue
        told = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE EXTENDED {database}.`{t.name}`").collect()}
        if told.get("Provider") == "parquet" and told.get("Location"):
            rows = footer_counts(spark, told["Location"]).first()["row_count"]
            files = spark.read.format("binaryFile").load(told["Location"]).agg(F.max("modificationTime").alias("at"))
            found.append((t.name, rows, files.first()["at"]))
        else:
            found.append((t.name, spark.table(f"{database}.`{t.name}`").count(), None))
    return spark.createDataFrame(found, schema)


def write_colocated(df: DataFrame, name: str, path: str, keys: tuple[str, ...] = ("state_fips", "year"), buckets: int = 64) -> None:
    """A table in sorted buckets of `keys`: two of them with as many buckets are joined and grouped by the keys without a shuffle.

    One task writes a bucket, so `buckets` follows the size of the table and is the same for tables that are joined.
    """
    rows = df.repartition(buckets, *keys)
    rows.write.mode("overwrite").format("parquet").option("path", path).bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(name)


def load_preview(files: DataFrame) -> DataFrame:
    """Per target table the number of files and the width of the first. `files`: file_name, column_count."""
    return route_files(files).groupBy(F.col("publish_name").alias("table_name")).agg(
        F.count(F.lit(1)).alias("file_count"), F.min_by("column_count", "file_name").alias("column_count")
    )


def work_grid(spark: SparkSession, years: list[int] = SURVEY_YEARS, tables: dict[str, str] = SURVEY_TABLES) -> DataFrame:
    """Every table, year and level to be landed."""
    grid = spark.range(1).select(F.explode(F.array(*[F.lit(t) for t in tables])).alias("table_id"))
    grid = grid.select("table_id", F.explode(F.array(*[F.lit(y) for y in years])).alias("year"))
    return grid.select("table_id", "year", F.explode(F.array(F.lit("county"), F.lit("state"))).alias("level"))


def backlog(wanted: DataFrame, landed: DataFrame) -> DataFrame:
    """What is still to be landed, with the kind of work: only the state level where the county
    level is there, everything otherwise. Both: table_id, year, level."""
    flags = landed.groupBy("table_id", "year").agg(F.max(F.when(F.col("level") == "county", True)).alias("has_county"))
    todo = missing_in(wanted, landed, ["table_id", "year", "level"])
    done = todo.join(flags, ["table_id", "year"], "left")
    kind = F.when(F.col("has_county") & (F.col("level") == "state"), "state only").otherwise("full")
    return done.select("table_id", "year", "level", kind.alias("work"))


# What columns mean that no label tells.
COLUMN_TEXTS = {
    "year": "Calendar year the row is about",
    "survey_type": "Kind of survey estimate",
    "geo_id": "Identifier of the geography as the census publishes it",
    "level": "Whether the row is a state or a county",
    "state": "Name of the state",
    "state_fips": "Code of the state, two digits as text",
    "county": "Name of the county, empty in rows of states",
    "county_fips": "Code of the county within its state, three digits as text, empty in rows of states",
    "fips": "Code of the geography: state code, followed by the county code in rows of counties",
    "series_id": "Identifier of the series",
    "series_title": "Name of the series as its publisher writes it",
    "periodicity": "How often the series has a value",
    "seasonal_adjustment": "Whether seasonal effects are taken out",
    "disability_status": "Disability group the series covers",
    "sex": "Sex the series covers",
    "age_group": "Ages the series covers",
    "race_ethnicity": "Race or ethnicity the series covers",
    "labor_force_status": "What the series measures",
    "occupation": "Occupation group, where the series is about one",
    "industry": "Industry, where the series is about one",
    "class_of_worker": "Class of worker, where the series is about one",
    "nilf_subcategory": "Detail on persons outside the labor force",
    "period": "Month, quarter or year within the calendar year",
    "date": "First day of the period",
    "value": "Value of the series: thousands of persons, or percent for rates",
    "footnotes": "Notes of the publisher on the value",
}


def column_texts(table: str) -> dict[str, str]:
    """What the columns of a published table mean; measures are described by the label they come from."""
    labels = {name: ", ".join(label.split(" | ")) for label, name in PUBLISHED_COLUMNS.get(table.upper(), {}).items()}
    return {**COLUMN_TEXTS, **labels}


def data_dictionary(df: DataFrame, table: str, year: str = "year") -> DataFrame:
    """Columns of a published table with the type they have, what they mean, and the years in which they hold values."""
    texts = column_texts(table)
    held = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").isNotNull().alias("held")) for c in df.columns]))
    counted = df.select(F.col(year).alias("year"), held.alias("h")).groupBy("year", "h.column").agg(F.max("h.held").alias("held"))
    long = counted.select("year", "column", F.when(F.col("held"), 1).alias("value"))
    entries = df.sparkSession.createDataFrame(
        [(i, table, c, kind, texts.get(c)) for i, (c, kind) in enumerate(df.dtypes)],
        "position int, table_id string, column_name string, type string, description string")
    years = availability(long).select(F.col("column").alias("column_name"), "first_year", "last_year", F.col("value_count").alias("n_years"))
    return entries.join(F.broadcast(years), "column_name", "left").select(*entries.columns, "first_year", "last_year", F.coalesce("n_years", F.lit(0)).alias("n_years"))


def apply_comments(df: DataFrame, table: str) -> DataFrame:
    """Carry the descriptions as column comments, which tables keep when saved."""
    texts = column_texts(table)
    return df.select(*[
        F.col(f"`{c}`").alias(c, metadata={"comment": texts[c]}) if c in texts else F.col(f"`{c}`") for c in df.columns
    ])
