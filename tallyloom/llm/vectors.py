"""Vectors as rows of integers, and partial results of tasks merged step by step."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import ship, stored

FAN = 128  # partial results merged by one task
BLOCK = 4096  # rows computed at once


def finite(column: str):
    """Whether a vector is not null or empty and has no null or non-finite component."""
    good = F.forall(column, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(good & (F.size(column) > 0), F.lit(False))


def integers(rows: DataFrame, vector: str, scale: int, most: int, purpose: str, shift: int = 0) -> tuple[DataFrame, int]:
    """`rows` with `vector` as x, the little-endian 32-bit integers floor(scale * component) + shift, written; and their number.

    Rows whose vector is null or empty, holds null or non-finite components, or is of another length
    than most vectors (of equally frequent lengths the longer one counts) are left out. Floors
    beyond `most` either way are held there. Without rows the length is 0.
    """
    ship(rows.sparkSession.sparkContext)
    rows = rows.where(finite(vector))
    usual = rows.groupBy(F.size(vector).alias("n")).count().orderBy(F.desc("count"), F.desc("n")).first()
    length = usual.n if usual else 0
    names = [c for c in rows.columns if c != vector]

    def run(batches):
        for batch in batches:
            vectors = batch[vector]
            flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            found = (np.clip(np.floor(flat * scale), -most, most) + shift).astype("<i4")
            yield pa.RecordBatch.from_arrays([*(batch[c] for c in names), binary(found.reshape(-1, length))], names=[*names, "x"])

    kept = rows.where(F.size(vector) == length).select(*names, vector)
    fields = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in names)
    return stored(kept.mapInArrow(run, f"{fields}, x binary"), purpose), length


def binary(rows: np.ndarray) -> pa.Array:
    """A column that holds the bytes of each row."""
    rows = np.ascontiguousarray(rows)
    width = rows.dtype.itemsize * rows.shape[1]
    ends = np.arange(len(rows) + 1, dtype=np.int32) * width
    return pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(ends), pa.py_buffer(rows.tobytes())])


def unpacked(column, kind: str, width: int) -> np.ndarray:
    """The rows of such a column as an array of `width` numbers each."""
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(-1, width)


def blocks(batches):
    for batch in batches:
        for at in range(0, len(batch), BLOCK):
            yield batch.slice(at, BLOCK)


def merged(rows: DataFrame, start, add, merge) -> dict[int, np.ndarray]:
    """State per slice over all `rows`: a dict of arrays that tasks begin by start(), grow by add(state, block) and merge.

    A state's size must not grow with the rows. FAN states of a slice meet in one task, then what
    those gave, so neither a task nor the driver holds the states of all tasks.
    """
    ship(rows.sparkSession.sparkContext)
    kinds = {k: (v.dtype.str, v.shape) for k, v in start().items()}

    def run(batches):
        state, some = start(), False
        for block in blocks(batches):
            some = True
            add(state, block)
        if some:
            yield pa.RecordBatch.from_pydict({
                "slice": pa.array(list(state), pa.int32()), "task": pa.array([TaskContext.get().partitionId()] * len(state), pa.int32()),
                "state": pa.array([v.tobytes() for v in state.values()], pa.binary())})

    def fold(key, group):
        kind, shape = kinds[key[0]]
        # In the order of tasks, so that sums of doubles are the same in every attempt.
        states = [np.frombuffer(s, kind).reshape(shape) for s in group.sort_values("task")["state"]]
        total = states[0].copy()
        for state in states[1:]:
            total = merge(total, state)
        return pd.DataFrame({"slice": [key[0]], "task": [int(group["task"].min())], "state": [total.tobytes()]})

    schema = "slice int, task int, state binary"
    parts = rows.mapInArrow(run, schema)
    some = parts.groupBy("slice", F.expr(f"task div {FAN}").alias("pack")).applyInPandas(fold, schema)
    found = some.groupBy("slice").applyInPandas(fold, schema).collect()
    got = {r.slice: np.frombuffer(r.state, kinds[r.slice][0]).reshape(kinds[r.slice][1]) for r in found}
    return {k: got.get(k, v) for k, v in start().items()}
