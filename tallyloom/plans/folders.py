"""Folders of cleaned files: published by table, and profiled file by file."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.operators.quality import column_states, profile_columns, profile_file, quality_flags
from tallyloom.operators.relational import lookup
from tallyloom.session import configured, exists, materialise, workspace
from tallyloom.sources.headers import BROKEN, escaped, file_headers, listing, read_by_header, sound
from tallyloom.sources.raw import route_files
from tallyloom.sources.tables import clean_tokens, ensure_database, publish, read_cleaned

PROFILE = """file string, row_count bigint, column_count int, duplicate_rows bigint, missing_fips bigint, year_min int,
    year_max int, total_nulls bigint, high_null_cols string, negative_cols string, status string, error string"""
DETAIL = """file string, position int, column string, dtype string, null_count bigint, null_pct double, unique_count bigint, min double, max double,
    negative_count bigint, mean double"""
FILE = r"([^/]+\.csv)(?:/[^/]*)?$"


def _name(path: str) -> str:
    return m[1] if (m := re.search(FILE, path)) else path.rsplit("/", 1)[-1]


def publish_folder(spark: SparkSession, paths: str | list[str], database: str) -> DataFrame:
    """Cleaned files of all years combined by the table that their names tell, and published; returns rows and bytes by table."""
    files = sorted(f for group in file_headers(spark, paths).values() for f in group)
    routed = route_files(spark.createDataFrame([(_name(f), f) for f in files], "file_name string, path string"))
    targets: dict[str, list[str]] = {}
    for r in routed.select("publish_name", "path").collect():
        targets.setdefault(r["publish_name"], []).append(r["path"])
    ensure_database(spark, database)
    reports = []
    for name, own in sorted(targets.items()):
        rows = read_cleaned(spark, own)
        reports.append(publish([rows], f"{database}.{name}", by=("year",) if "year" in rows.columns else ()))
    return reduce(DataFrame.unionByName, reports)


def _shaped(df: DataFrame, schema: str) -> DataFrame:
    columns = [c.split() for c in schema.replace("\n", " ").split(",")]
    return df.select(*[F.col(c).cast(kind).alias(c) if c in df.columns else F.lit(None).cast(kind).alias(c) for c, kind in columns])


def validate_folder(spark: SparkSession, paths: str | list[str]) -> tuple[DataFrame, DataFrame]:
    """Column detail and summary of cleaned files, whatever their columns.

    The detail has a row per file and column. The summary has a row per file with its profile, the
    columns more than half empty, those with negative values, and a status: WARN for either or for
    repeated rows, ERROR for a file that cannot be read, else OK. Files of one header are profiled together.
    """
    headers = file_headers(spark, paths)
    lost = spark.createDataFrame([(_name(f), BROKEN, "ERROR") for f in headers.get((), [])], "file string, error string, status string")
    details, summaries = [spark.createDataFrame([], DETAIL)], [_shaped(lost, PROFILE)]
    for df in map(sound, read_by_header(spark, paths, headers=headers)):
        named = clean_tokens(df).withColumn("file", F.regexp_extract("_path", FILE, 1)).drop("_path")
        detail = materialise(_shaped(profile_columns(named, ["file"]), DETAIL), "detail")
        details.append(detail)
        summaries.append(_shaped(quality_flags(detail, ["file"], profile_file(named, ["file"])), PROFILE))
    return reduce(DataFrame.unionByName, details), reduce(DataFrame.unionByName, summaries)


def profile_folder(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """The summary of `validate_folder`."""
    return validate_folder(spark, paths)[1]


def write_validation(spark: SparkSession, paths: str | list[str], target: str) -> None:
    """Both reports as CSV folders below `target`."""
    with workspace(spark):
        detail, summary = validate_folder(spark, paths)
        for name, df, order in (("validation_column_detail", detail, ("file", "position")), ("validation_summary", summary, ("file",))):
            df.sort(*order).write.mode("overwrite").csv(f"{target.rstrip('/')}/{name}", header=True, escape='"')


def refresh_profiles(spark: SparkSession, paths: str | list[str], store: str) -> DataFrame:
    """States of the columns of all files there are, per file: path and what `column_states` gives.

    States are kept at `store` with the time and size of their file. Files that have theirs are not read again; new
    and changed ones are, and states of files that are gone or were changed count no more. `profile_states`
    makes profiles of the result, and `merge_states` before it, of all files at once.
    """
    kept = ["uri", "modified", "bytes"]
    with configured(spark, listing(spark)):
        files = spark.read.format("binaryFile").load(paths).select(
            F.col("_metadata.file_path").alias("uri"), "path", F.col("modificationTime").alias("modified"), F.col("length").alias("bytes"))
        files = materialise(files, "listing")
    have = exists(spark, store)
    fresh = files.join(spark.read.parquet(store).select(*kept).distinct(), kept, "left_anti") if have else files
    new = [r["path"] for r in fresh.select("path").collect()]
    # One list of files goes into the readers; it is as long as there is new work.
    for df in map(sound, read_by_header(spark, new, headers=file_headers(spark, [escaped(f) for f in new])) if new else []):
        named = clean_tokens(df.withColumnRenamed("_path", "uri"))
        states = column_states(named, ["uri"])
        lookup(states, fresh.select(*kept), ["uri"], "inner").write.mode("append").parquet(store)
    if not exists(spark, store):
        return spark.createDataFrame([], "path string, position int, column string")
    return lookup(spark.read.parquet(store), files, kept, "inner").drop(*kept)
