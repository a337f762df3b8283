"""Vector code compression: codebooks per part by Lloyd rounds that compare active entries only."""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import light, remove, stored, table
from tallyloom.llm.vectors import binary, blocks, integers, merged, unpacked

PARTS = 4
ENTRIES = 256  # entries of a codebook, so that an index is one byte
ROUNDS = 4
SCALE = 1024
EXACT = 1 << 53  # whole numbers below are exact as doubles


def limit(size: int) -> int:
    """Largest integer whose squared distances over `size` components fit into 64 bits."""
    return min(1 << 30, math.isqrt((1 << 61) // max(1, size)) // 2)


def distances(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Squared distances of all rows to all entries, exact; by one product of doubles where those are exact."""
    most = int(max(np.abs(x).max(initial=0), np.abs(entries).max(initial=0)))
    if 4 * most * most * x.shape[1] < EXACT:
        a, b = x.astype(np.float64), entries.astype(np.float64)
        return ((a * a).sum(1)[:, None] - 2 * (a @ b.T) + (b * b).sum(1)).astype(np.int64)
    return np.stack([((x - e) ** 2).sum(1) for e in entries], 1)


def assign(x: np.ndarray, entries: np.ndarray, code: np.ndarray | None = None, distance: np.ndarray | None = None,
           moved: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Nearest entry of each row and its squared distance, ties to the lower index.

    With the code and exact distance from the entries before, and which entries have moved since, a
    row whose entry stayed meets the moved entries only: those that stayed are no nearer than before.
    All other rows meet every entry.
    """
    if code is None:
        apart = distances(x, entries)
        code = apart.argmin(1)
        return code, apart[np.arange(len(x)), code]
    code, distance = code.copy(), distance.copy()
    lost = moved[code]
    if lost.any():
        code[lost], distance[lost] = assign(x[lost], entries)
    active, stayed = np.flatnonzero(moved), np.flatnonzero(~lost)
    if len(active) and len(stayed):
        apart = distances(x[stayed], entries[active])
        best = apart.argmin(1)
        near, at = apart[np.arange(len(stayed)), best], active[best]
        win = (near < distance[stayed]) | ((near == distance[stayed]) & (at < code[stayed]))
        code[stayed[win]], distance[stayed[win]] = at[win], near[win]
    return code, distance


def cuts(length: int, parts: int) -> list[tuple[int, int]]:
    """Bounds of consecutive parts; equal ones if the length allows it, else the first are longer by one."""
    ends = np.cumsum([length // parts + (k < length % parts) for k in range(parts)]).tolist()
    return list(zip([0, *ends[:-1]], ends))


def assigned(state: DataFrame, books: list[np.ndarray], moved: list[np.ndarray] | None, bounds: list[tuple[int, int]]) -> DataFrame:
    """`state` with columns code (a byte per part) and distance (a 64-bit number per part) for these books."""
    shared, length, parts = state.sparkSession.sparkContext.broadcast((books, moved)), bounds[-1][1], len(bounds)
    kept = [c for c in state.columns if c not in ("code", "distance")]

    def run(batches):
        entries, active = shared.value
        for block in blocks(batches):
            x = unpacked(block["x"], "<i4", length).astype(np.int64)
            code = np.zeros((len(x), parts), np.uint8)
            distance = np.zeros((len(x), parts), "<i8")
            if active is not None:
                code[:], distance[:] = unpacked(block["code"], np.uint8, parts), unpacked(block["distance"], "<i8", parts)
            for p, (a, z) in enumerate(bounds):
                before = () if active is None else (code[:, p].astype(np.int64), distance[:, p], active[p])
                code[:, p], distance[:, p] = assign(x[:, a:z], entries[p], *before)
            yield pa.RecordBatch.from_arrays([*(block[c] for c in kept), binary(code), binary(distance)], names=[*kept, "code", "distance"])

    fields = ", ".join(f"`{c}` {state.schema[c].dataType.simpleString()}" for c in kept)
    return state.mapInArrow(run, f"{fields}, code binary, distance binary")


def moved_books(state: DataFrame, books: list[np.ndarray], bounds: list[tuple[int, int]]) -> list[np.ndarray]:
    """Every entry as the floored mean of its parts; entries without parts stay."""
    length, parts = bounds[-1][1], len(bounds)

    def start():
        return {p: np.zeros((len(books[p]), 1 + z - a), np.int64) for p, (a, z) in enumerate(bounds)}

    def add(sums, block):
        x, code = unpacked(block["x"], "<i4", length).astype(np.int64), unpacked(block["code"], np.uint8, parts)
        for p, (a, z) in enumerate(bounds):
            order = np.argsort(code[:, p], kind="stable")
            held, first = np.unique(code[order, p], return_index=True)
            sums[p][held, 0] += np.diff(np.append(first, len(x)))
            sums[p][held, 1:] += np.add.reduceat(x[order, a:z], first, axis=0)

    found = merged(state.select("x", "code"), start, add, np.add)
    return [np.where(found[p][:, :1] > 0, found[p][:, 1:] // np.maximum(found[p][:, :1], 1), book) for p, book in enumerate(books)]


def compress(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", parts: int = PARTS,
             entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> tuple[DataFrame, list[np.ndarray]]:
    """Columns id, label, code (a byte per part), error of every usable vector; and the codebooks.

    Components become floor(scale * x) and vectors are cut into consecutive parts. A part's codebook
    begins as that part of the `entries` smallest ids (at most 256; nulls last, equal ids by their
    integers, copies as often as they occur); fewer rows give fewer entries. `rounds` times all parts
    go to their nearest entry and entries to the floored mean of their parts; then parts are assigned
    again. `error` sums the final squared distances. Between rounds the code and exact distance of
    every part are written, so that a round compares what moved only; a round's table goes once the
    next is written. The driver holds codebooks, whose size does not depend on the rows.

    Left out are rows whose vector is null or empty, holds null or non-finite components, or has
    another length than most. Null and repeated ids and other columns' names do not matter; an empty
    table gives no rows. Integers are held within `limit`, 1.9 * 10^8 for parts of 16 components.
    """
    spark = rows.sparkSession
    rows = rows.select(F.col(id_col).alias("id"), F.col(label_col).alias("label"), F.col(vector_col).alias("vector"))
    usual = rows.agg(F.max(F.size("vector"))).first()[0] or 0
    state, length = integers(rows, "vector", scale, limit(-(-usual // parts)), "integers")
    bounds = cuts(length, parts)
    first = state.orderBy(F.col("id").asc_nulls_last(), "x").limit(min(entries, 256)).select("x").collect()
    whole = np.array([np.frombuffer(r.x, "<i4") for r in first], np.int64).reshape(len(first), length)
    books, moved, path = [whole[:, a:z] for a, z in bounds], None, None
    for turn in range(rounds + 1):
        old = path
        state, path = stored(assigned(state, books, moved, bounds), "codes", named=True)
        if old:
            remove(spark, old)
        if turn < rounds:
            fresh = moved_books(state, books, bounds)
            moved = [(a != b).any(1) for a, b in zip(books, fresh)]
            books = fresh

    def total(batches):
        for block in blocks(batches):
            error = unpacked(block["distance"], "<i8", parts).sum(1)
            yield pa.RecordBatch.from_arrays([block["id"], block["label"], block["code"], pa.array(error)], names=["id", "label", "code", "error"])

    kinds = [state.schema[c].dataType.simpleString() for c in ("id", "label")]
    found = state.select("id", "label", "code", "distance").mapInArrow(total, f"id {kinds[0]}, label {kinds[1]}, code binary, error long")
    return found, books


def digest(books: list[np.ndarray]) -> str:
    """SHA-256 of all components as decimal numbers with commas between, by part, entry and position."""
    return hashlib.sha256(",".join(str(v) for book in books for v in book.ravel().tolist()).encode()).hexdigest()


def op13_codes(spark, folder: str) -> DataFrame:
    """Codes, errors and their sums per label; a sum beyond 64 bits is null."""
    found, books = compress(table(spark, folder, "embeddings"))
    sums = found.groupBy(F.col("label").alias("group")).agg(F.sum(F.col("error").cast("decimal(20,0)")).alias("total"))
    sums = light(stored(sums.select("group", F.expr("try_cast(total as bigint)").alias("label_error")), "sums"))
    return found.join(sums, F.col("label").eqNullSafe(F.col("group")), "left").select(
        F.col("id").alias("vec_id"), F.lower(F.hex("code")).alias("code"), "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256"))


def _sql() -> str:
    rounds = [f"""
a{r} as (
    select k, p, x, min((list_dot_product(x, x) - 2 * list_dot_product(x, e) + list_dot_product(e, e))::bigint * {ENTRIES} + j) as m
    from parts join b{r} using (p) group by k, p, x
)""" + (f""", s{r} as (
    select p, m % {ENTRIES} as j, i, sum(x[i])::bigint as total, count(*) as n from a{r}, (select unnest(range(1, (select max(len(x)) + 1 from parts))) as i) group by all
), b{r + 1} as (
    select p, j, coalesce(fresh, e) as e from b{r} left join (
        select p, j, list(((total - ((total % n) + n) % n) // n)::double order by i) as fresh from s{r} group by p, j
    ) using (p, j)
)""" if r < ROUNDS else "") for r in range(ROUNDS + 1)]
    return f"""
with kept as (
    select row_number() over (order by vec_id) - 1 as k, vec_id, label, list_transform(embedding, lambda c: floor({SCALE} * c::double)) as v
    from embeddings where len(embedding) > 0 and len(list_filter(embedding, lambda c: c is null or not isfinite(c))) = 0
), parts as (
    select k, p, v[p * (len(v) // {PARTS}) + 1:(p + 1) * (len(v) // {PARTS})] as x from kept, (select unnest(range({PARTS})) as p)
), b0 as (
    select p, k as j, x as e from parts where k < {ENTRIES}
), {",".join(rounds)}, final as (
    select k, string_agg(lower(printf('%02x', (m % {ENTRIES})::int)), '' order by p) as code, sum(m // {ENTRIES})::bigint as error from a{ROUNDS} group by k
), books as (
    select sha256(string_agg(c::bigint::varchar, ',' order by p, j, i)) as codebooks_sha256
    from (select p, j, unnest(e) as c, generate_subscripts(e, 1) as i from b{ROUNDS})
)
select vec_id, code, error, (sum(error) over (partition by label))::bigint as label_error, codebooks_sha256
from kept join final using (k), books
"""


OP13_SQL = _sql()
