"""Shared helpers: written tables, connected components, tiles of hot buckets."""

from __future__ import annotations

import ctypes
import os
import shutil
import tempfile
from contextlib import suppress
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark import SparkContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import tallyloom

from tallyloom.session import work_folder


@cache
def ship(context: SparkContext) -> None:
    """Let Spark hand this package to the Python workers, wherever they run."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(tallyloom.__file__)))
    target = os.path.join(os.path.realpath(tempfile.mkdtemp(prefix="package-")), "tallyloom")
    context.addPyFile(shutil.make_archive(target, "zip", root, "tallyloom"))


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    ship(spark.sparkContext)
    return spark.read.parquet(f"{folder}/{name}.parquet")


def stored(df: DataFrame, purpose: str, named: bool = False):
    """`df` written to the shared folder and read again, which cuts the lineage; with its path if `named`."""
    ship(df.sparkSession.sparkContext)
    path = work_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    written = df.sparkSession.read.schema(df.schema).parquet(path)
    return (written, path) if named else written


def remove(spark: SparkSession, path: str) -> None:
    """Delete a written table that nothing reads any more."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def components(edges: DataFrame) -> DataFrame:
    """Columns v, root: every vertex of the edges a, b with the smallest vertex it is linked to.

    Each round takes the smallest label among the neighbours and then follows labels one step, so
    that long chains shrink by half. Rounds are written tables. Both joins have a side that is
    unique on the key, so a hub is a skewed side that adaptive execution splits.
    """
    edges = edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    edges = stored(edges, "edges")
    both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    labels = both.groupBy(F.col("a").alias("v")).agg(F.least(F.min("b"), F.first("a")).alias("root"))
    labels = stored(labels, "labels")
    while True:
        near = (both.join(labels.select(F.col("v").alias("b"), "root"), "b")
                .groupBy(F.col("a").alias("v")).agg(F.min("root").alias("near")))
        hooked = labels.join(near, "v").select("v", F.col("root").alias("old"), F.least("root", "near").alias("root"))
        ahead = hooked.select(F.col("v").alias("root"), F.col("root").alias("next"))
        moved = stored(hooked.join(ahead, "root").select("v", "old", F.col("next").alias("root")), "labels")
        labels = moved.select("v", "root")
        if moved.where("old <> root").isEmpty():
            return labels


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Star edges (vertex, smallest vertex) with the components of the edges a, b."""
    nodes, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    left, right = ends[: len(a)], ends[len(a):]
    label = np.arange(len(nodes))
    while len(left):
        np.minimum.at(label, np.maximum(left, right), np.minimum(left, right))
        while not np.array_equal(up := label[label], label):
            label = up
        left, right = label[left], label[right]
        open_ = left != right
        left, right = left[open_], right[open_]
    out = label != np.arange(len(nodes))
    return nodes[out], nodes[label[out]]


HOME, AWAY, PROBE = 0, 1, 2


def tiles(index: DataFrame, probes: DataFrame | None, keys: list[str], member: str, most: int) -> DataFrame:
    """Rows of both tables with columns tile and role, to be met by keys and tile.

    A bucket with over `most` index rows is cut into as many parts as that takes, both ways: its
    index rows lie along rows of tiles and its probes along columns, so that every probe meets
    every index row in one tile and no tile outgrows its share. In a cut bucket index rows also
    probe the parts before their own. Pairs of index rows are due among those with role HOME.
    """
    heavy = (index.groupBy(*keys).count().where(F.col("count") > most)
             .select(*keys, F.ceil(F.col("count") / most).cast("int").alias("parts")))
    heavy = stored(heavy, "heavy")

    def cut(df):
        df = df.join(heavy, keys, "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
        return df.withColumn("own", F.pmod(F.xxhash64(member), "parts").cast("int"))

    def placed(df, spots):
        return df.withColumn("spot", F.explode(spots)).select("*", "spot.*").drop("spot", "own", "parts")

    every = F.sequence(F.lit(0), F.col("parts") - 1)
    own, parts = F.col("own"), F.col("parts")
    index = cut(index)
    out = placed(index, F.transform(every, lambda i: F.struct(
        (own * parts + i).alias("tile"), F.when(i == own, HOME).otherwise(AWAY).alias("role"))))
    across = F.transform(F.filter(every, lambda i: i < own), lambda i: F.struct(
        (i * parts + own).alias("tile"), F.lit(PROBE).alias("role")))
    out = out.unionByName(placed(index.where("own > 0"), across))
    if probes is not None:
        out = out.unionByName(placed(cut(probes), F.transform(every, lambda i: F.struct(
            (i * parts + own).alias("tile"), F.lit(PROBE).alias("role")))))
    return out


def buckets(batches, keys: list[str]):
    """Regroup pandas batches sorted by `keys` so that no bucket is cut between two of them."""
    import pandas as pd

    held = None
    for batch in batches:
        if held is not None:
            batch = pd.concat([held, batch], ignore_index=True)
        if not len(batch):
            continue
        last = batch[keys].iloc[-1]
        same = np.logical_and.reduce([(batch[k] == last[k]).to_numpy() for k in keys])
        start = len(batch) - np.argmin(same[::-1]) if not same.all() else 0
        held = batch.iloc[start:]
        if start:
            yield batch.iloc[:start].reset_index(drop=True)
    if held is not None and len(held):
        yield held.reset_index(drop=True)


def spans(count: np.ndarray, most: int):
    """Cut rows into runs whose counts sum to about `most`: pairs of row bounds."""
    total = np.concatenate([[0], np.cumsum(count)])
    at = 0
    while at < len(count):
        end = max(at + 1, int(np.searchsorted(total, total[at] + most, "right")) - 1)
        yield at, end
        at = end


def unused(df: DataFrame, name: str) -> str:
    """`name`, with as many underscores as it takes to be no column of `df`."""
    while name.lower() in (c.lower() for c in df.columns):
        name += "_"
    return name


_HELD: dict = {}


def held(key, build):
    """What `build` gives, kept by a Python worker until another key is asked for.

    A worker serves one stage after another; so it holds the model of one stage at a time.
    """
    if key not in _HELD:
        _HELD.clear()
        tidy()
        _HELD[key] = build()
    return _HELD[key]


def tidy() -> None:
    """Give freed memory back to the system, which lets the workers of an executor share its memory."""
    pa.default_memory_pool().release_unused()
    with suppress(OSError, AttributeError):  # only the GNU C library has it
        ctypes.CDLL("libc.so.6").malloc_trim(0)


LIGHT = 48 << 20  # bytes up to which a table is broadcast


def light(df: DataFrame, wide: str | None = None) -> DataFrame:
    """A written table marked for broadcast where it is measured to be small, else as it is.

    The size counts 16 bytes for each column and 24 for each entry of the array column `wide`.
    """
    entries = F.sum(F.size(wide)) if wide else F.lit(0)
    rows, parts = df.agg(F.count(F.lit(1)), entries).first()
    return F.broadcast(df) if rows * (24 + 16 * len(df.columns)) + 24 * (parts or 0) <= LIGHT else df
