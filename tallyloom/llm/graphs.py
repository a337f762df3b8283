"""Largest inner products by robust-pruned directed graphs, one per shard."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.llm.caps import valid
from tallyloom.llm.common import ship, stored, table

SHARDS = 8  # at least
VECTORS = 1 << 14  # vectors of a shard
NUMBERS = 1 << 24  # components of a shard
CLASS = 1.25  # factor between the norms of a shard, but of shards with fewer vectors than a search holds
DEGREE = 32  # out-neighbours after pruning
ROOM = 64  # out-neighbours before a vertex is pruned again
BEAM = 96  # vertices a search holds
WIDE = 4  # vertices expanded in one step
RELAXED = 1.2  # factor by which a detour must be shorter to replace an edge
BATCH = 256  # vertices inserted, or queries searched, together
ASKED = 1 << 22  # components of the queries that one copy of a shard's graph meets


def lifted(vectors: np.ndarray) -> np.ndarray:
    """Vectors with one more coordinate that gives all the same length, so that near means a large product."""
    squares = (vectors.astype(np.float64) ** 2).sum(1)
    last = np.sqrt(np.maximum(squares.max() - squares, 0))
    return np.concatenate([vectors, last[:, None]], axis=1).astype(np.float32)


class Graph:
    """Directed graph over the rows of `points`; `out` holds neighbours, padded with -1."""

    def __init__(self, points: np.ndarray, out: np.ndarray | None = None, entry: int | None = None):
        self.points = points
        self.out = np.full((len(points), ROOM), -1, np.int32) if out is None else out
        self.entry = int(np.argmax(points @ points.mean(0))) if entry is None else entry

    def search(self, queries: np.ndarray, beam: int, inner: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """Greedy beam search for all queries in step: vertices and their distances, nearest first.

        Distances are squared differences, or with `inner` products with the sign changed. Neither
        takes a difference of numbers as large as the longest vector, which would round nearness away.
        """
        def away_from(asked, points):
            apart = asked - points
            return -np.einsum("ij,ij->i", asked, points) if inner else np.einsum("ij,ij->i", apart, apart)

        count = len(queries)
        ids = np.full((count, beam), -1, np.int32)
        far = np.full((count, beam), np.inf, np.float32)
        done = np.zeros((count, beam), bool)
        seen = np.zeros((count, len(self.points)), bool)
        ids[:, 0], far[:, 0], seen[:, self.entry] = self.entry, away_from(queries, np.broadcast_to(self.points[self.entry], queries.shape)), True
        rows = np.arange(count)
        while len(rows):
            open_ = np.where(done[rows], np.inf, far[rows])
            pick = np.argpartition(open_, WIDE, axis=1)[:, :WIDE]
            real = np.isfinite(np.take_along_axis(open_, pick, 1))
            rows, pick, real = rows[real.any(1)], pick[real.any(1)], real[real.any(1)]
            if not len(rows):
                break
            done[rows[:, None], pick] |= real
            node = np.where(real, ids[rows[:, None], pick], -1)
            near = np.where(node[:, :, None] >= 0, self.out[node], -1).reshape(len(rows), -1)
            used = (near >= 0).any(0)
            near = near[:, used]
            fresh = (near >= 0) & ~seen[rows[:, None], near]
            near = np.sort(np.where(fresh, near, -1), axis=1)
            near[:, 1:][near[:, 1:] == near[:, :-1]] = -1
            r, c = np.nonzero(near >= 0)
            seen[rows[r], near[r, c]] = True
            away = np.full(near.shape, np.inf, np.float32)
            away[r, c] = away_from(queries[rows[r]], self.points[near[r, c]])
            all_far = np.concatenate([far[rows], away], 1)
            best = np.argpartition(all_far, beam - 1, axis=1)[:, :beam]
            far[rows] = np.take_along_axis(all_far, best, 1)
            ids[rows] = np.take_along_axis(np.concatenate([ids[rows], near], 1), best, 1)
            done[rows] = np.take_along_axis(np.concatenate([done[rows], np.zeros(near.shape, bool)], 1), best, 1)
        order = np.argsort(far, axis=1, kind="stable")
        far = np.take_along_axis(far, order, 1)
        return np.where(np.isfinite(far), np.take_along_axis(ids, order, 1), -1), far

    def pruned(self, nodes: np.ndarray, candidates: np.ndarray) -> np.ndarray:
        """For each node the candidates, nearest first, without those that a kept one is nearer to by the relaxed factor."""
        kept = np.full((len(nodes), DEGREE), -1, np.int32)
        for at in range(0, len(nodes), BATCH):
            own, some = nodes[at:at + BATCH], candidates[at:at + BATCH]
            some = np.where(some == own[:, None], -1, some)
            points = self.points[some].astype(np.float64)
            far = np.where(some >= 0, ((points - self.points[own][:, None]) ** 2).sum(2), np.inf)
            order = np.argsort(far, axis=1, kind="stable")
            far, some = np.take_along_axis(far, order, 1), np.take_along_axis(some, order, 1)
            points = np.take_along_axis(points, order[:, :, None], 1)
            squares = (points ** 2).sum(2)
            between = squares[:, :, None] + squares[:, None] - 2 * (points @ points.transpose(0, 2, 1))
            alive = np.isfinite(far)
            every = np.arange(len(own))
            for k in range(DEGREE):
                first = alive.argmax(1)
                has = alive[every, first]
                if not has.any():
                    break
                kept[at + every[has], k] = some[every[has], first[has]]
                alive &= ~(RELAXED * between[every, first] <= far) | ~has[:, None]
                alive[every, first] = False
        return kept

    def insert(self, nodes: np.ndarray) -> None:
        found, _ = self.search(self.points[nodes], BEAM)
        kept = self.pruned(nodes, found)
        self.out[nodes, :DEGREE] = kept
        source, target = np.repeat(nodes, DEGREE), kept.ravel()
        source, target = source[target >= 0], target[target >= 0]
        order = np.argsort(target, kind="stable")
        source, target = source[order], target[order]
        first = np.flatnonzero(np.append(True, target[1:] != target[:-1])) if len(target) else np.zeros(0, int)
        ends = np.append(first[1:], len(target))
        hubs = target[first]
        room = int((ends - first).max()) if len(first) else 0
        more = np.full((len(hubs), room), -1, np.int32)
        slot = np.arange(len(target)) - np.repeat(first, ends - first)
        more[np.repeat(np.arange(len(hubs)), ends - first), slot] = source
        held = np.sort(np.concatenate([self.out[hubs], more], 1), axis=1)[:, ::-1]
        held[:, 1:][held[:, 1:] == held[:, :-1]] = -1
        full = (held >= 0).sum(1) > ROOM
        held = np.sort(held, axis=1)[:, ::-1]
        self.out[hubs[~full]] = held[~full][:, :ROOM]
        if full.any():
            self.out[hubs[full]] = -1
            self.out[hubs[full], :DEGREE] = self.pruned(hubs[full], held[full])

    def build(self, random: np.random.Generator) -> Graph:
        order = random.permutation(len(self.points))
        order = order[order != self.entry]
        at = 0
        while at < len(order):
            size = min(BATCH, max(1, at // 2))
            self.insert(order[at:at + size])
            at += size
        self.reach()
        return self

    def reach(self) -> None:
        """An edge from the nearest reached vertex to one that no path from the entry reaches, until all are."""
        seen = np.zeros(len(self.points), bool)
        front = np.array([self.entry])
        while True:
            while len(front):
                seen[front] = True
                front = np.unique(self.out[front])
                front = front[front >= 0]
                front = front[~seen[front]]
            lost = np.flatnonzero(~seen)
            if not len(lost):
                return
            near = self.search(self.points[lost[:1]], BEAM)[0][0, 0]
            if (self.out[near] >= 0).all():
                self.out = np.concatenate([self.out, np.full((len(self.out), 1), -1, np.int32)], 1)
            self.out[near, (self.out[near] >= 0).argmin()] = lost[0]
            front = lost[:1]


def upto(n: int):
    return F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long"))


def norm_class():
    """Number of the class of norms of `vector`, with the norm 1 in the middle of a class."""
    squares = F.aggregate("vector", F.lit(0.0), lambda total, x: total + x * x)
    return F.coalesce(F.floor(F.log(squares) / (2 * math.log(CLASS)) + 0.5).cast("long"), F.lit(0).cast("long"))


def shards_of(classes: list[tuple[int, int]], per: int) -> list[tuple[int, int, int]]:
    """For each class of norms, given in order with its number of vectors, its first shard and number of shards.

    Neighbouring classes that a search holds whole share a shard.
    """
    out, shard, room = [], -1, 0
    for number, count in classes:
        if count <= room:
            out.append((number, shard, 1))
            room -= count
        else:
            own = -(-count // per)
            out.append((number, shard + 1, own))
            shard, room = shard + own, max(0, min(BEAM, per) - count)
    return out


def nearest(rows: DataFrame, queries: DataFrame, top: int = 20, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """Columns query_id, rank, id, score: for each query the `top` rows found with the largest inner product.

    A query's own id is no candidate of it; draws go to the smaller id, and fewer candidates are all
    returned. Vectors that are null, zero, or hold null or non-finite components take no part, nor
    do null ids; a row that is repeated counts once. Equal vectors are one vertex with its `top` + 1
    smallest ids, which is all that a result can need of them. Every other vector is a vertex of its
    own, in a shard of vectors with about its norm, small enough for a task's memory and for the beam to find what
    is near. Blocks of queries meet every shard; what the shards find is ranked by the exact product in double precision.
    """
    ship(rows.sparkSession.sparkContext)
    def some(df):
        df = df.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("vector"))
        return df.where(valid("vector") & F.col("id").isNotNull())

    keyed = some(rows).withColumn("key", F.xxhash64("vector"))
    ids = keyed.groupBy("key", "id").agg(F.lit(1)).select("key", "id")
    place = F.row_number().over(Window.partitionBy("key").orderBy("id"))
    ids = ids.withColumn("r", place).where(F.col("r") <= top + 1).groupBy("key").agg(F.sort_array(F.collect_list("id")).alias("ids"))
    vertices = stored(keyed.groupBy("key").agg(F.any_value("vector").alias("vector")).join(ids, "key"), "vertices")
    count, size = vertices.agg(F.count(F.lit(1)), F.max(F.size("vector"))).first()
    per = max(1, min(VECTORS, NUMBERS // max(size or 1, 1), -(-count // SHARDS)))
    sized = vertices.groupBy(norm_class().alias("class")).agg(F.count(F.lit(1)).alias("n")).sort("class")
    placed = shards_of([(r["class"], r["n"]) for r in sized.collect()], per)  # a double's range has some 6 400 classes
    shards = max((first + own for _, first, own in placed), default=1)
    classes = F.broadcast(rows.sparkSession.createDataFrame(placed, "class long, first long, own long"))

    def build(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("key")
        out = []
        for length in sorted(set(part["vector"].map(len))):
            own = part[part["vector"].map(len) == length]
            vectors = np.array(own["vector"].tolist(), np.float64)
            graph = Graph(lifted(vectors)).build(np.random.default_rng(7))
            listed = own["ids"].tolist()
            out.append((int(part["shard"].iloc[0]), length, vectors.tobytes(), graph.out.tobytes(), graph.out.shape[1], graph.entry,
                        np.concatenate(listed).astype(np.int64).tobytes(), np.array([len(x) for x in listed]).tobytes()))
        return pd.DataFrame(out, columns=["shard", "size", "vectors", "out", "room", "entry", "ids", "counts"])

    sharded = vertices.withColumn("class", norm_class()).join(classes, "class")
    sharded = sharded.select("key", "vector", "ids", (F.col("first") + F.pmod(F.xxhash64(F.lit(3), "key"), F.col("own"))).alias("shard"))
    graphs = sharded.groupBy("shard").applyInPandas(
        build, "shard long, size long, vectors binary, out binary, room long, entry long, ids binary, counts binary")
    graphs = stored(graphs, "graphs")

    def block(batches):
        for batch in batches:
            length = batch["vector"].map(len)
            for n in sorted(set(length)):
                part = batch[length == n]
                for at in range(0, len(part), BATCH):
                    few = part.iloc[at:at + BATCH]
                    ids = few["id"].to_numpy(np.int64)
                    yield pd.DataFrame({"block": [int(ids.min())], "size": [n], "ids": [ids.tobytes()],
                                        "vectors": [np.array(few["vector"].tolist(), np.float64).tobytes()]})

    asked = some(queries).dropDuplicates(["id"])
    blocks = stored(asked.mapInPandas(block, "block long, size long, ids binary, vectors binary"), "blocks")
    # A copy of a graph is as heavy as the queries that it meets, unless more tasks are wanted than that gives.
    many, wanted = blocks.count(), -(-2 * rows.sparkSession.sparkContext.defaultParallelism // shards)
    groups = max(1, -(-many // max(1, ASKED // (BATCH * max(size or 1, 1)))), min(many, wanted))
    none = F.lit(None).cast("binary")
    spread = blocks.select(
        F.explode(upto(shards)).alias("shard"), "size", F.pmod(F.xxhash64("block"), F.lit(groups)).alias("part"),
        F.lit(1).alias("role"), "vectors", none.alias("out"), F.lit(0).cast("long").alias("room"), F.lit(0).cast("long").alias("entry"), "ids", none.alias("counts"))
    copies = graphs.select("shard", "size", F.explode(upto(groups)).alias("part"),
                           F.lit(0).alias("role"), "vectors", "out", "room", "entry", "ids", "counts")
    keys = ["shard", "size", "part"]

    def run(batches):
        graph = own = None
        for batch in batches:
            for row in batch.itertuples(index=False):
                vectors = np.frombuffer(row.vectors, np.float64).reshape(-1, row.size)
                ids = np.frombuffer(row.ids, np.int64)
                if row.role == 0:
                    own = (row.shard, row.size, row.part)
                    points = lifted(vectors)
                    graph = Graph(points, np.frombuffer(row.out, np.int32).reshape(len(points), row.room), row.entry)
                    originals, listed = vectors, np.split(ids, np.cumsum(np.frombuffer(row.counts, np.int64))[:-1])
                elif own == (row.shard, row.size, row.part):
                    yield answers(graph, originals, listed, vectors, ids, top)

    met = copies.unionByName(spread).repartition(*keys).sortWithinPartitions(*keys, "role")
    found = met.mapInPandas(run, "query_id long, id long, score double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= top).select("query_id", "rank", "id", "score")


def answers(graph: Graph, originals: np.ndarray, listed: list[np.ndarray], vectors: np.ndarray, ids: np.ndarray, top: int) -> pd.DataFrame:
    """What one shard has for a block of queries: `top` candidates each, ranked by the exact product."""
    lengthened = np.concatenate([vectors, np.zeros((len(vectors), 1))], 1)
    scale = np.maximum(np.linalg.norm(lengthened, axis=1, keepdims=True), 1e-300)
    found, _ = graph.search((lengthened / scale).astype(np.float32), max(BEAM, top + 1), inner=True)
    out = []
    for query, vector, near in zip(ids.tolist(), vectors, found):
        near = near[near >= 0]
        scores = (originals[near] * vector).sum(1)
        many = [listed[k] for k in near.tolist()]
        every = np.concatenate(many)
        score = np.repeat(scores, [len(x) for x in many])
        other = every != query
        every, score = every[other], score[other]
        best = np.lexsort([every, -score])[:top]
        out.append(pd.DataFrame({"query_id": query, "id": every[best], "score": score[best]}))
    return pd.concat(out, ignore_index=True)


def op2_graphs(spark, folder: str) -> DataFrame:
    rows = table(spark, folder, "embeddings")
    found = nearest(rows, rows.where("vec_id % 20 = 0"))
    return found.select("query_id", "rank", F.col("id").alias("vec_id"), "score")
