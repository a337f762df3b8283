"""Near-duplicate embeddings by spherical-cap filters."""

from __future__ import annotations

from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import HOME, PROBE, buckets, components, forest, ship, stored, table, tiles

TABLES = 6  # independent rotations, each with a product code of its own
SHARED = 16  # filters that a pair at the threshold shares on average
MEMBERS = 256  # members a filter has on average
MOST = 2048  # members that are compared in one tile
ROWS = 512  # rows of a tile multiplied at once


def valid(column: str):
    """Whether a vector is not null or zero and has no null or non-finite component."""
    finite = F.forall(column, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(finite & F.exists(column, lambda x: x != 0), F.lit(False))


@cache
def tail(dim: int) -> tuple[np.ndarray, np.ndarray]:
    """Grid over [-1, 1] and the chance that a random unit vector has a first coordinate above each point."""
    x = np.linspace(-1, 1, 4001)
    density = np.maximum(1 - x * x, 0) ** ((dim - 3) / 2)
    above = np.cumsum(density[::-1])[::-1]
    return x, above / above[0]


def plan(rows: int, dim: int, cosine: float) -> tuple[float, int]:
    """Cap height and code words per half, so that filters hold MEMBERS rows and close pairs share SHARED."""
    x, above = tail(dim)
    chance = min(0.25, MEMBERS / max(rows, 1))
    height = float(np.interp(-chance, -above, x))
    mass = np.where(x >= height, np.maximum(1 - x * x, 0) ** ((dim - 3) / 2), 0)
    y, past = tail(dim - 1)
    need = (height - cosine * x) / np.maximum(np.sqrt((1 - cosine * cosine) * np.maximum(1 - x * x, 0)), 1e-9)
    both = float((mass * np.interp(need, y, past)).sum() / max(mass.sum(), 1e-300))
    words = SHARED / max(both, 1e-3) / TABLES / chance
    return height, max(2, int(np.ceil(np.sqrt(words))))


@cache
def codes(dim: int, words: int, turn: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A random rotation and random code words for either half of the rotated coordinates."""
    random = np.random.default_rng([dim, words, turn])
    rotation = np.linalg.qr(random.standard_normal((dim, dim)))[0]
    halves = []
    for size in (dim // 2, dim - dim // 2):
        some = random.standard_normal((words, size))
        halves.append(some / np.linalg.norm(some, axis=1, keepdims=True) / np.sqrt(2))
    return rotation, *halves


def decode(units: np.ndarray, height: float, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows and filters of all filter directions whose product with a row is at least `height`.

    A direction is a pair of code words. First words whose product cannot reach the height with the
    row's best second word are left out before pairs are formed.
    """
    dim = units.shape[1]
    rows, filters = [], []
    for turn in range(TABLES):
        rotation, first, second = codes(dim, words, turn)
        turned = units @ rotation
        one, two = turned[:, :dim // 2] @ first.T, turned[:, dim // 2:] @ second.T
        row, i = np.nonzero(one >= height - two.max(1, keepdims=True))
        hit, j = np.nonzero(one[row, i][:, None] + two[row] >= height)
        rows.append(row[hit])
        filters.append(((dim * TABLES + turn) << 40) + i[hit].astype(np.int64) * words + j)
    rows, filters = np.concatenate(rows), np.concatenate(filters)
    order = np.lexsort([filters, rows])
    return rows[order], filters[order]


def padded(vectors: np.ndarray) -> np.ndarray:
    """Unit vectors of at least eight coordinates."""
    vectors = vectors / np.abs(vectors).max(1, keepdims=True)
    vectors = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    return np.pad(vectors, [(0, 0), (0, max(0, 8 - vectors.shape[1]))])


def earlier(one: np.ndarray, two: np.ndarray, current: int) -> np.ndarray:
    """Whether rows of sorted filter lists, padded with -1, share a filter before `current`."""
    out = np.zeros(len(one), bool)
    for at in range(0, len(one), 1 << 14):
        a, b = one[at:at + (1 << 14)], two[at:at + (1 << 14)]
        a = np.where(a < current, a, -1)
        out[at:at + (1 << 14)] = ((a[:, :, None] == b[:, None, :]) & (a[:, :, None] >= 0)).any((1, 2))
    return out


def links(vectors: DataFrame, cosine: float) -> DataFrame:
    """Columns a, b, n: per row a the number n of rows linked to it (b null), and edges a, b that span the links.

    `vectors` has a unique id, how often the vector occurs and the vector. Rows of a filter are
    multiplied in tiles of bounded size. A linked pair counts where its first shared filter is, so
    once, and a tile sends out one count and one edge per member, never its pairs.
    """
    total = vectors.count()

    def spread(batches):
        for batch in batches:
            lengths = batch["vector"].map(len).to_numpy()
            for length in np.unique(lengths):
                part = batch[lengths == length]
                x = np.array(part["vector"].tolist(), np.float64)
                for at in range(0, len(x), 2048):
                    units = padded(x[at:at + 2048])
                    height, words = plan(total, units.shape[1], cosine)
                    row, filters = decode(units, height, words)
                    begin = np.searchsorted(row, np.arange(len(units) + 1))
                    lists = [filters[a:z] for a, z in zip(begin[:-1], begin[1:])]
                    yield pd.DataFrame({
                        "filter": filters, "id": part["id"].to_numpy()[at:at + 2048][row],
                        "times": part["times"].to_numpy()[at:at + 2048][row],
                        "vector": [units[r].tobytes() for r in row], "filters": [lists[r] for r in row]})

    members = vectors.mapInPandas(spread, "filter long, id long, times long, vector binary, filters array<long>")
    rows = tiles(stored(members, "members"), None, ["filter"], "id", MOST)

    def meet(batches):
        for batch in buckets(batches, ["filter", "tile"]):
            code = batch[["filter", "tile"]].to_numpy()
            cut = np.flatnonzero((code[1:] != code[:-1]).any(1)) + 1
            found = []
            for low, high in zip(np.append(0, cut), np.append(cut, len(code))):
                if high - low > 1:
                    found.append(tile_links(batch.iloc[low:high], int(code[low, 0]), cosine))
            if found:
                yield pd.concat(found, ignore_index=True).astype({"b": "Int64", "n": "Int64"})

    sorted_rows = rows.repartition("filter", "tile").sortWithinPartitions("filter", "tile", "role")
    return sorted_rows.mapInPandas(meet, "a long, b long, n long")


def tile_links(tile: pd.DataFrame, current: int, cosine: float) -> pd.DataFrame:
    ids, times, role = (tile[c].to_numpy() for c in ("id", "times", "role"))
    units = np.frombuffer(b"".join(tile["vector"]), np.float64).reshape(len(tile), -1)
    width = int(tile["filters"].map(len).max())
    lists = np.full((len(tile), width), -1, np.int64)
    for k, some in enumerate(tile["filters"]):
        lists[k, :len(some)] = some
    held = int((role != PROBE).sum())
    counted, ones, twos = np.zeros(len(tile), np.int64), [], []
    for at in range(0, len(tile), ROWS):
        like = units[at:at + ROWS] @ units[:held].T
        row, col = np.nonzero(like >= cosine)
        row += at
        due = np.where(role[row] == PROBE, True, (role[row] == HOME) & (col < row)) & (ids[row] != ids[col])
        row, col = row[due], col[due]
        ones.append(ids[row])
        twos.append(ids[col])
        new = ~earlier(lists[row], lists[col], current)
        np.add.at(counted, row[new], times[col[new]])
        np.add.at(counted, col[new], times[row[new]])
    a, b = forest(np.concatenate(ones), np.concatenate(twos))
    some = counted > 0
    return pd.concat([pd.DataFrame({"a": ids[some], "b": None, "n": counted[some]}), pd.DataFrame({"a": a, "b": b, "n": None})])


def near_vectors(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", cosine: float = 0.95) -> DataFrame:
    """Columns id, n_links, component, kept for every row.

    Rows are linked at a cosine of at least `cosine` in double precision; `n_links` counts the other
    rows linked directly, `component` is the smallest id reachable and `kept` marks the row that has
    it. Vectors that are null, zero, or hold null or non-finite components link with nothing, nor do
    vectors of different length. Equal vectors are folded and counted, so that a group of copies
    costs one row. A null id stays; its component is the smallest known id, and without one
    it is null and the row is kept.
    """
    ship(rows.sparkSession.sparkContext)
    rows = rows.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("vector"))
    rows = rows.withColumn("good", valid("vector")).withColumn("key", F.when(F.col("good"), F.xxhash64("vector")))
    folded = rows.where("good").groupBy("key").agg(
        F.count(F.lit(1)).alias("times"), F.min("id").alias("least"), F.any_value("vector").alias("vector"))
    folded = stored(folded, "vectors")
    found = stored(links(folded.select(F.col("key").alias("id"), "times", "vector"), cosine), "links")
    counts = found.where("n is not null").groupBy(F.col("a").alias("key")).agg(F.sum("n").alias("n"))
    roots = components(found.where("b is not null").select("a", "b"))
    known = folded.select("key", "times", "least").join(counts, "key", "left")
    known = known.join(roots.withColumnRenamed("v", "key"), "key", "left").withColumn("root", F.coalesce("root", "key"))
    known = stored(known, "known")
    named = known.join(known.groupBy("root").agg(F.min("least").alias("component")), "root")
    named = named.select("key", (F.coalesce("n", F.lit(0)) + F.col("times") - 1).alias("n_links"), "component")
    out = rows.join(named, "key", "left")
    component = F.when(F.col("good"), F.col("component")).otherwise(F.col("id"))
    return out.select("id", F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"), component.alias("component"),
                      F.coalesce(F.col("id") == component, component.isNull()).alias("kept"))


def op3_caps(spark, folder: str) -> DataFrame:
    found = near_vectors(table(spark, folder, "embeddings"))
    return found.select(F.col("id").alias("vec_id"), "n_links", F.col("component").alias("component_id"), "kept")
