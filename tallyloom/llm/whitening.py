"""Whitening of embeddings along the eigenvectors of their covariance, refined from single precision."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import table
from tallyloom.llm.vectors import binary, blocks, integers, merged, unpacked

SCALE = 64
SHIFT = 1_000_000  # added to every integer
MOST = 1 << 30  # floors are held within
COMPONENTS = 32
STEPS = 40  # refinement steps at most
LOW = 16  # bits of the lower half of an integer
SMALL = 1 << 20  # integers up to this size are multiplied whole: BLOCK products of them are exact as doubles


def products(y: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Three 64-bit matrices high, mixed, low: y.T @ y = high * 2^32 + mixed * 2^16 + low, exact for integers up to 2^32."""
    if np.abs(y).max(initial=0) <= SMALL:
        whole = y.astype(np.float64)
        none = np.zeros((y.shape[1], y.shape[1]), np.int64)
        return none, none, (whole.T @ whole).astype(np.int64)
    high, low = (y >> LOW).astype(np.float64), (y & ((1 << LOW) - 1)).astype(np.float64)
    mixed = high.T @ low
    return (high.T @ high).astype(np.int64), (mixed + mixed.T).astype(np.int64), (low.T @ low).astype(np.int64)


def moments(state: DataFrame, length: int) -> tuple[int, list[int]]:
    """Number of rows and the sum of every dimension."""
    def add(sums, block):
        x = unpacked(block["x"], "<i4", length).astype(np.int64)
        sums[0][0] += len(x)
        sums[0][1:] += x.sum(0)

    found = merged(state.select("x"), lambda: {0: np.zeros(length + 1, np.int64)}, add, np.add)[0].tolist()
    return found[0], found[1:]


def covariance(state: DataFrame, n: int, sums: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Covariance (divisor n), whole centres and the rest r: the mean of a dimension is centre + r / n.

    Rows are centred by the whole number next to the mean before they are multiplied, in integers; what
    that leaves, (r_i / n) * (r_j / n), is taken off in integers too. So the only rounding is that of
    the exact covariance to a double.
    """
    length = len(sums)
    centre = [(2 * s + n) // (2 * n) for s in sums]
    rest = [s - n * c for s, c in zip(sums, centre)]
    shared = state.sparkSession.sparkContext.broadcast(np.array(centre, np.int64))

    def add(total, block):
        y = unpacked(block["x"], "<i4", length).astype(np.int64) - shared.value
        for i, row in enumerate(np.stack(products(y), 1)):
            total[i] += row

    found = merged(state.select("x"), lambda: {i: np.zeros((3, length), np.int64) for i in range(length)}, add, np.add)
    exact = [[n * ((h << 2 * LOW) + (m << LOW) + w) - rest[i] * rest[j] for j, (h, m, w) in enumerate(zip(*found[i].tolist()))]
             for i in range(length)]
    return np.array([[v / (n * n) for v in row] for row in exact]), np.array(centre, np.int64), np.array(rest, np.float64) / n


def refined(matrix: np.ndarray, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and eigenvectors of a symmetric matrix, from approximate eigenvectors.

    A step takes R = I - X'X and S = X'AX, first in double and then in extended precision, and corrects
    X by X + XE, where E_ij is (S_ij + e_j R_ij) / (e_j - e_i), or R_ij / 2 for eigenvalues that the
    errors of X do not let tell apart. Those, and any within the root of a double's precision, form
    clusters, whose vectors are turned by the eigenvectors of the small matrix V'(A - m)V around the
    cluster's mean m. Steps end when corrections shrink no more.
    """
    size, small, last = len(matrix), np.finfo(np.float64).eps, np.inf
    for step in range(STEPS):
        wide = np.longdouble if step else np.float64
        a, x, unit = matrix.astype(wide), vectors.astype(wide), np.eye(size, dtype=wide)
        r, s = unit - x.T @ x, x.T @ (a @ x)
        s = (s + s.T) / 2
        values = np.diagonal(s) / (1 - np.diagonal(r))
        spread = 2 * (np.abs(s - np.diag(values)).sum(1).max() + np.abs(values).max(initial=0) * np.abs(r).sum(1).max())
        spread = max(spread, np.sqrt(small) * np.abs(values).max(initial=0))
        gap = values[None, :] - values[:, None]
        near = np.abs(gap) <= spread
        e = np.where(near, r / 2, (s + values[None, :] * r) / np.where(near, 1, gap))
        x = x + x @ e
        order = np.argsort(-values, kind="stable")
        x, values = x[:, order], values[order]
        low = 0
        for high in range(1, size + 1):
            if high < size and values[high - 1] - values[high] <= spread:
                continue
            if high - low > 1:
                v, mean = x[:, low:high], values[low:high].mean()
                inner = v.T @ (a @ v - mean * v)
                turn = np.linalg.eigh(((inner + inner.T) / 2).astype(np.float64))[1][:, ::-1]
                x[:, low:high] = v @ turn.astype(wide)
            low = high
        vectors, change = x, float(np.abs(e).max(initial=0))
        if change <= small or step > 2 and change >= last / 2:
            break
        last = change
    r, s = unit - x.T @ x, x.T @ (a @ x)
    x = x + x @ (r / 2)
    values = np.diagonal(s) / (1 - np.diagonal(r))
    order = np.argsort(-values, kind="stable")
    return values[order].astype(np.float64), x[:, order].astype(np.float64)


def eigen(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors: in single precision first, then refined."""
    scale = np.abs(matrix).max(initial=0) or 1.0
    rough = np.linalg.eigh((matrix / scale).astype(np.float32))[1]
    values, vectors = refined(matrix / scale, rough)
    return values * scale, vectors


def squares(y: np.ndarray) -> list[int | None]:
    """Sum of squares of each row of whole numbers; None where 64 bits do not hold it."""
    about = (y.astype(np.float64) ** 2).sum(1)
    found = (y * y).sum(1).tolist() if about.max(initial=0) < 2.0**62 else [sum(v * v for v in row) for row in y.tolist()]
    return [v if v < 1 << 63 else None for v in found]


def whiten(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS, scale: int = SCALE,
           shift: int = SHIFT) -> DataFrame:
    """Columns id, component (from 1), n, deviation, whitened, explained, identity_error for every usable row.

    Entries become x = floor(scale * entry) + shift. The covariance of all n vectors is computed
    exactly and rounded once; its eigenvectors, at most `components`, come from single precision and
    are refined. `whitened` is x less its mean along a component, over the root of its eigenvalue;
    `explained` the eigenvalue's share of all variance; `deviation` the sum over dimensions of
    (n * x - sum)^2, null beyond 64 bits; `identity_error` the largest absolute entry of the covariance
    of all whitened values, measured on them, less the identity.

    Left out are rows whose vector is null or empty, holds null or non-finite entries, or has another
    length than most. Null ids, repeated rows and copies stay and count as often as they occur. A component without
    variance (an eigenvalue within rounding of the largest) has null whitened and is no part of
    `identity_error`; without any variance `explained` is null and `identity_error` 0. An empty table
    gives no rows. Floors of scaled entries are held within 2^30.
    """
    rows = rows.select(F.col(id_col).alias("id"), F.col(vector_col).alias("vector"))
    state, length = integers(rows, "vector", scale, MOST, "integers", shift)
    n, sums = moments(state, length)
    kind = f"id {state.schema['id'].dataType.simpleString()}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    if not n:
        return state.sparkSession.createDataFrame([], kind)
    matrix, centre, rest = covariance(state, n, sums)
    values, vectors = eigen(matrix)
    trace, count = float(np.trace(matrix)), min(components, length)
    varied = values[:count] > length * np.finfo(np.float64).eps * max(values[0], 0)
    axes = vectors[:, :count] / np.sqrt(np.where(varied, values[:count], 1))
    leftover = [s - n * c for s, c in zip(sums, centre.tolist())]
    model = state.sparkSession.sparkContext.broadcast((centre, rest, axes, leftover))

    def centred(block):
        return unpacked(block["x"], "<i4", length).astype(np.int64) - model.value[0]

    def add(total, block):
        # Centred by the block's own mean before multiplying; blocks are joined by their means.
        w = ((centred(block) - model.value[1]) @ model.value[2])[:, varied]
        mean = w.mean(0)
        away = w - mean
        total[0][:] = joined(total[0], np.vstack([np.full(len(mean), len(w), np.float64), mean, away.T @ away]))

    kept = int(varied.sum())
    found = merged(state.select("x"), lambda: {0: np.zeros((kept + 2, kept))}, add, joined)[0]
    worst = float(np.abs(found[2:] / n - np.eye(kept)).max(initial=0))
    shares = [float(v) / trace if trace > 0 else None for v in values[:count]]

    def run(batches):
        exact = (1 << 62) // max(1, n)
        for block in blocks(batches):
            y = centred(block)
            w = (y - model.value[1]) @ model.value[2]
            if np.abs(y).max(initial=0) < exact:
                apart = squares(y * n - np.array(model.value[3], np.int64))
            else:
                apart = squares(y.astype(object) * n - np.array(model.value[3], object))
            take = pa.array(np.repeat(np.arange(len(block)), count))
            clear = np.broadcast_to(varied, w.shape).ravel()
            each = len(block) * count
            yield pa.RecordBatch.from_arrays([
                block["id"].take(take), pa.array(np.tile(np.arange(1, count + 1, dtype=np.int32), len(block))),
                pa.array(np.full(each, n, np.int64)), pa.array(apart, pa.int64()).take(take), pa.array(w.ravel(), mask=~clear),
                pa.array(shares * len(block), pa.float64()), pa.array(np.full(each, worst))],
                names=["id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return state.mapInArrow(run, kind)


def joined(one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """Count, means and centred products (as rows) of two sets of rows taken together."""
    if not one[0].any() or not two[0].any():
        return one + two
    a, b = one[0, :1], two[0, :1]
    apart = two[1] - one[1]
    both = one[2:] + two[2:] + np.outer(apart, apart) * (a * b / (a + b))
    return np.vstack([one[0] + two[0], one[1] + apart * (b / (a + b)), both])


def op11_whitening(spark, folder: str) -> DataFrame:
    return whiten(table(spark, folder, "embeddings")).withColumnRenamed("id", "vec_id")
