"""Delimited files read by their own headers, with a channel for rows that do not fit them."""

from __future__ import annotations

import csv
import io
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.session import configured

SMALL = 1 << 20  # bytes of a file up to which many are read by one task for their headers
TOGETHER = 1 << 10  # files of that size that one task reads at most
ALONE = 1 << 40  # a split that no file fills, so that a file is a task of its own
LONGEST = 1 << 20  # characters of a header; a longer one has a quote that is never closed
REJECTS = "file string, reason string, record string"
SURPLUS, BROKEN = "more fields than the header", "no header could be read"


def _first_records(alone: bool):
    """Reads lines of files in turn, as Arrow batches, and gives each file's first record that is not empty.

    A record goes on as long as a quote is open. With `alone` a task has one file and stops behind
    the record, so that nothing else of it is read.
    """
    def run(batches):
        import pyarrow as pa

        path, text, wanted = None, "", False
        for batch in batches:
            found = []
            for value, at in zip(batch["value"].to_pylist(), batch["file_path"].to_pylist()):
                if at != path:
                    if wanted and text:
                        found.append((path, text.split("\n")[0]))
                    path, text, wanted = at, "", True
                if not wanted or not (text or value):
                    continue
                text = f"{text}\n{value}" if text else value
                if text.count('"') % 2 == 0 or len(text) > LONGEST:
                    found.append((path, text if len(text) <= LONGEST else text.split("\n")[0]))
                    wanted = False
            yield pa.RecordBatch.from_pydict({"path": [p for p, _ in found], "header": [h for _, h in found]}, pa.schema([("path", pa.string()), ("header", pa.string())]))
            if alone and not wanted:
                return
        if wanted and text:
            yield pa.RecordBatch.from_pydict({"path": [path], "header": [text.split("\n")[0]]})

    return run


def names_of(header: str) -> tuple[str, ...]:
    """Fields of a header; a name met again, in whatever case, gets a number after a dot."""
    names, used = [], set()
    for i, name in enumerate(next(csv.reader(io.StringIO(header.removeprefix("﻿"), newline="")), [])):
        name = fresh = name or f"_c{i}"
        count = 0
        while fresh.lower() in used:
            count += 1
            fresh = f"{name}.{count}"
        used.add(fresh.lower())
        names.append(fresh)
    return tuple(names)


def file_headers(spark: SparkSession, paths: str | list[str]) -> dict[tuple[str, ...], list[str]]:
    """Files by their header, whose names come from one Spark job over the files.

    Small files are read together, of a larger one a task reads the first record only; quotes in a
    header may hold line breaks. Names that differ in case only count as repeated, as Spark's columns
    do; a name met again gets a number after a dot. Files without a line, or that cannot be read, are
    listed under the empty header.
    """
    with configured(spark, listing(spark)):
        listed = spark.read.format("binaryFile").load(paths)
        sizes = listed.select("path", "length").collect()
        # Files without a byte are not scanned.
        paths = sorted({_plain(unquote(uri)) for uri in listed.inputFiles()} | {_plain(r.path) for r in sizes})
    found: dict[str, str] = {}
    for alone in (False, True):
        files = sorted(r.path for r in sizes if (r.length > SMALL) == alone)
        if not files:
            continue
        # Spark cuts no file that is smaller than the cost of opening one: the rest of a cut file would start with another record.
        settings = {"spark.sql.files.maxPartitionBytes": str(ALONE if alone else TOGETHER * SMALL),
                    "spark.sql.files.openCostInBytes": str(ALONE if alone else SMALL), "spark.sql.files.ignoreCorruptFiles": "true"}
        with configured(spark, {**settings, **listing(spark)}):
            lines = spark.read.schema("value string").text([escaped(f) for f in files]).select("value", "_metadata.file_path")
            records = lines.mapInArrow(_first_records(alone), "path string, header string").collect()
        found.update((_plain(unquote(r.path)), r.header) for r in records)
    headers: dict[tuple[str, ...], list[str]] = {}
    for path in paths:
        header = found.get(path)
        headers.setdefault(names_of(header) if header else (), []).append(path)
    return headers


def listing(spark: SparkSession) -> dict[str, str]:
    """Lists many files by a few tasks a core instead of by a task each."""
    return {"spark.sql.sources.parallelPartitionDiscovery.parallelism": str(4 * spark.sparkContext.defaultParallelism)}


def _plain(path: str) -> str:
    """A path with as few slashes as it can have behind its scheme."""
    return path.replace("file:///", "file:/")


def escaped(path: str) -> str:
    """A path that no character of makes a pattern."""
    return "".join(f"\\{c}" if c in "*?[]{}\\" else c for c in path)


def _fields(record: Column) -> Column:
    """How many fields a raw record has."""
    return F.size(F.split(F.regexp_replace(record, r'"(?:[^"]|"")*"', ""), ",", -1))


def read_by_header(
    spark: SparkSession, paths: str | list[str], multi_line: bool = True, headers: dict[tuple[str, ...], list[str]] | None = None
) -> list[DataFrame]:
    """One DataFrame of texts per distinct header, each file read by its own, with its path as `_path`.

    Quotes, blank lines and line breaks within quotes are the CSV reader's. A row with fewer fields
    than the header is filled with NULL; one with more has its raw text in `_surplus`, which is NULL
    otherwise. With `multi_line` a file is read by one task; without it large files are split and no
    value may hold a line break.
    """
    frames = []
    for names, files in (file_headers(spark, paths) if headers is None else headers).items():
        if not names:
            continue
        kinds = T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(len(names))] + [T.StructField("_record", T.StringType())])
        # Without pruning, so that a row's fields are counted whatever columns are asked for.
        reader = spark.read.schema(kinds).options(
            header=True, escape='"', multiLine=multi_line, maxColumns=2 * len(names) + 20_000, columnNameOfCorruptRecord="_record", columnPruning=False)
        with configured(spark, listing(spark)):
            rows = reader.csv([escaped(f) for f in files])
        cells = [F.col(f"c{i}").alias(name) for i, name in enumerate(names)]
        # The reader refuses queries of the raw record alone; so its length is asked along with some field's.
        none = F.length(F.substring(F.coalesce("c0", F.lit("")), 1, 0))
        surplus = F.when(_fields(F.col("_record")) + none > len(names), F.col("_record"))
        frames.append(rows.select(F.col("_metadata.file_path").alias("_path"), *cells, surplus.alias("_surplus")))
    return frames


def sound(df: DataFrame) -> DataFrame:
    """Rows of `read_by_header` that fit their header."""
    return df.where(F.col("_surplus").isNull()).drop("_surplus")


def rejected_rows(
    spark: SparkSession, paths: str | list[str], multi_line: bool = True, headers: dict[tuple[str, ...], list[str]] | None = None
) -> DataFrame:
    """What the readers leave out: file, reason and raw record of every row with more fields than its header,
    and every file without one."""
    headers = file_headers(spark, paths) if headers is None else headers
    parts = [spark.createDataFrame([(f, BROKEN, None) for f in headers.get((), [])], REJECTS)]
    for df in read_by_header(spark, paths, multi_line, headers):
        record = F.regexp_replace("_surplus", r"[\r\n]+$", "")
        parts.append(df.where(F.col("_surplus").isNotNull()).select(F.col("_path").alias("file"), F.lit(SURPLUS).alias("reason"), record.alias("record")))
    return reduce(DataFrame.unionByName, parts)
