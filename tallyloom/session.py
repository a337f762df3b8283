"""Session settings and the shared work folder."""

from __future__ import annotations

import os
import tempfile
import uuid
from contextlib import contextmanager
from functools import cache

from pyspark.sql import DataFrame, SparkSession

# Partition counts and join strategies are left to adaptive execution, which sees the measured
# size of every shuffle; nothing here depends on the size of one data set.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.session.timeZone": "UTC",
    # The plans have many small stages whose compiled code is worth keeping.
    "spark.sql.codegen.cache.maxEntries": "2000",
}

UNPACKED = 8  # times that rows in memory may take the size of their files
SMALL_INPUT = 4 << 20  # bytes of all sources below which a table is written by one job instead of one per shuffle
ONE_JOB = {
    "spark.sql.adaptive.enabled": "false",
    "spark.sql.shuffle.partitions": "4",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
}
_MADE: list[str] = []  # work folders, in the order they were named


def build_session(app: str = "tallyloom", master: str | None = None, **settings: str) -> SparkSession:
    """Session with the settings above; `settings` take dotted names as a mapping."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for name, value in {**SETTINGS, **settings}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def work_folder(spark: SparkSession, purpose: str) -> str:
    """New folder below the shared one the cluster names in `spark.checkpoint.dir`.

    A machine-local folder is used only when the session itself is local. Folders made within a
    `workspace` go at its end.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        shared = _local_folder()
    _MADE.append(os.path.join(shared, f"{purpose}-{uuid.uuid4().hex}"))
    return _MADE[-1]


@cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="run-")


def materialise(df: DataFrame, purpose: str, by: tuple[str, ...] = ()) -> DataFrame:
    """Write `df` to the work folder, in folders by the columns of `by`, and read it back.

    Cuts the lineage with files that outlive any executor, so that a later loss re-reads the
    files instead of repeating the work.
    """
    return weighed(df, purpose, by)[0]


def weighed(df: DataFrame, purpose: str, by: tuple[str, ...] = ()) -> tuple[DataFrame, int]:
    """As `materialise`, with an upper guess of what the rows take in memory.

    Columnar files are smaller than rows in memory; UNPACKED times their size errs towards too much.
    What comes from a few megabytes, as metadata does, is written by one job with a fixed plan: measuring
    each of its shuffles in a job of its own would take longer than the work.
    """
    spark, path = df.sparkSession, work_folder(df.sparkSession, purpose)
    with configured(spark, ONE_JOB if input_bytes(df) <= SMALL_INPUT else {}):
        df.write.partitionBy(*by).parquet(path)
    written = spark.read.schema(df.schema).parquet(path)
    return written, UNPACKED * plan_bytes(written)


def plan_bytes(df: DataFrame) -> int:
    """What the optimizer takes the size of the rows to be: the size of the files for a written table."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def input_bytes(df: DataFrame) -> int:
    """What the optimizer takes the size of all sources of `df` to be."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    return sum(int(str(leaves.apply(k).stats().sizeInBytes())) for k in range(leaves.size()))


def _folder(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    folder, files = _folder(spark, path)
    return files.exists(folder)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies in a folder; none if there is no such folder."""
    folder, files = _folder(spark, path)
    return [f.getPath().getName() for f in files.listStatus(folder)] if files.exists(folder) else []


def delete(spark: SparkSession, path: str) -> None:
    """Remove a folder with all it holds; nothing happens if there is none."""
    folder, files = _folder(spark, path)
    files.delete(folder, True)


@contextmanager
def configured(spark: SparkSession, settings: dict[str, str]):
    """SQL settings that hold within, for work that is planned and done there."""
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


@contextmanager
def workspace(spark: SparkSession):
    """Removes, at its end, the work folders made within it; their tables must be used up by then.

    Folders added to the set it yields stay, and belong to the workspace around this one.
    """
    before, kept = len(_MADE), set()
    try:
        yield kept
    finally:
        made = _MADE[before:]
        _MADE[before:] = [path for path in made if path in kept]
        for path in reversed(made):
            if path not in kept:
                delete(spark, path)
