"""Packing of token ids into windows by non-negative least squares on the histogram of lengths."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.llm.common import light, stored, table, tidy
from tallyloom.llm.tokens import encoder

WINDOW = 2048
END = 1  # id that closes every document
SPREAD = 12  # third lengths tried for every pair
ROUNDS = 400  # steps of the least-squares solver
OWN = 1 << 40  # sequences that one task numbers by itself
STEP = 256  # documents encoded at once


def vocabulary(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def combinations(present: np.ndarray, window: int) -> np.ndarray:
    """Rows of two or three lengths that occur and fill the window exactly, padded with 0."""
    have = np.zeros(window + 1, bool)
    have[present] = True
    pairs = [(a, window - a, 0) for a in present.tolist() if a <= window - a and have[window - a]]
    triples = set()
    for a in present.tolist():
        fits = present[(present <= window - a - 1)]
        for b in fits[np.unique(np.linspace(0, len(fits) - 1, min(SPREAD, len(fits))).astype(int))].tolist():
            if have[window - a - b]:
                triples.add(tuple(sorted((a, b, window - a - b))))
    return np.array(pairs + sorted(triples), np.int64).reshape(-1, 3)


def repeats(patterns: np.ndarray, histogram: np.ndarray) -> np.ndarray:
    """Non-negative repeat counts whose use of lengths is nearest to the histogram, by accelerated projected gradients."""
    def used(x):
        total = np.bincount(patterns.ravel(), np.repeat(x, patterns.shape[1]), len(histogram))
        total[0] = 0
        return total

    goal = histogram.astype(float)
    goal[0] = 0
    touched = np.bincount(patterns.ravel(), minlength=len(histogram))
    touched[0] = 0
    pace = 1.0 / (3.0 * max(1, touched.max()))
    x = ahead = np.zeros(len(patterns))
    t = 1.0
    for _ in range(ROUNDS):
        slope = (used(ahead) - goal)
        slope[0] = 0
        new = np.maximum(ahead - pace * slope[patterns].sum(1), 0)
        t, before = (1 + np.sqrt(1 + 4 * t * t)) / 2, t
        ahead = new + (before - 1) / t * (new - x)
        x = new
    return x


def layout(histogram: np.ndarray, window: int) -> dict:
    """Where the r-th remainder of each length goes.

    The solved counts are rounded down and cut to what is left of each length, then every
    combination takes what it still can. Ranks of a length in [low, high) fill the slot at `offset`
    of sequences from `first` on. Ranks past the last slot form a stream, longest first, which is
    cut at the window's multiples; the stream's end is cut into powers of two, which need no padding.
    """
    left = histogram.astype(np.int64).copy()
    left[0] = 0
    present = np.flatnonzero(left)
    patterns = combinations(present, window) if len(present) else np.zeros((0, 3), np.int64)
    taken = np.zeros(window, np.int64)
    slots, sequences = [], 0
    solved = np.floor(repeats(patterns, histogram)).astype(np.int64) if len(patterns) else np.zeros(0, np.int64)
    for wanted in (solved, np.full(len(patterns), 1 << 60)):
        for k in np.argsort(-wanted, kind="stable").tolist():
            parts = [p for p in patterns[k].tolist() if p]
            n = min(int(wanted[k]), *(int(left[p]) // parts.count(p) for p in parts))
            if n <= 0:
                continue
            offset = 0
            for p in sorted(parts, reverse=True):
                slots.append((p, taken[p], taken[p] + n, sequences, offset))
                taken[p] += n
                left[p] -= n
                offset += p
            sequences += n
    slots = np.array(sorted(slots), np.int64).reshape(-1, 5)
    stream = np.zeros(window, np.int64)
    stream[::-1] = np.cumsum((left * np.arange(window))[::-1]) - (left * np.arange(window))[::-1]
    total = int((left * np.arange(window)).sum())
    whole, rest = total // window * window, total % window
    cuts, at = [whole], whole
    for bit in range(window.bit_length() - 1, -1, -1):
        if rest >> bit & 1:
            at += 1 << bit
            cuts.append(at)
    return {"slots": slots, "begin": np.searchsorted(slots[:, 0], np.arange(window + 1)), "taken": taken,
            "stream": stream, "first": sequences, "whole": whole, "cuts": np.array(cuts), "window": window}


def spots(plan: dict, length: int, rank: int) -> list[tuple[int, int, int]]:
    """Sequence, offset and length of the pieces of one remainder."""
    if rank < plan["taken"][length]:
        own = plan["slots"][plan["begin"][length]:plan["begin"][length + 1]]
        _, low, _, first, offset = own[np.searchsorted(own[:, 1], rank, "right") - 1].tolist()
        return [(first + rank - low, offset, length)]
    window, whole, cuts = plan["window"], plan["whole"], plan["cuts"]
    at = int(plan["stream"][length]) + (rank - int(plan["taken"][length])) * length
    out, end = [], at + length
    while at < end:
        if at < whole:
            sequence, begin = at // window, at // window * window
            stop = begin + window
        else:
            k = int(np.searchsorted(cuts, at, "right")) - 1
            sequence, begin, stop = whole // window + k, int(cuts[k]), int(cuts[k + 1])
        size = min(stop, end) - at
        out.append((plan["first"] + sequence, at - begin, size))
        at += size
    return out


def encoded(docs: DataFrame, path: str, end: int, window: int) -> DataFrame:
    """Columns id, ids, tokens, rest, task, rank, full: ids of every text, and its place among the task's texts.

    `rest` is what full windows leave over, `rank` counts the task's earlier texts of the same rest
    and `full` its earlier full windows.
    """
    def run(batches):
        task, seen, full = TaskContext.get().partitionId(), np.zeros(window, np.int64), 0
        closing = np.array([end], "<u4").tobytes()
        for batch in batches:
            for at in range(0, len(batch), STEP):
                part = batch.slice(at, STEP)
                rows = []
                for ids in encoder(path).encode([t or "" for t in part["text"].to_pylist()]):
                    ids += closing
                    n = len(ids) // 4
                    rows.append((ids, n, n % window, task, int(seen[n % window]), full))
                    seen[n % window] += 1
                    full += n // window
                columns = [pa.array(c, k) for c, k in zip(zip(*rows), (pa.binary(), *[pa.int64()] * 5))]
                yield pa.RecordBatch.from_arrays([part["id"], *columns], names=["id", "ids", "tokens", "rest", "task", "rank", "full"])
            tidy()

    kind = docs.schema["id"].dataType.simpleString()
    return docs.mapInArrow(run, f"id {kind}, ids binary, tokens long, rest long, task long, rank long, full long")


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None, end: int = END,
         window: int = WINDOW) -> DataFrame:
    """Pieces of every document: id, start, length, ids (binary), doc_tokens, sequence_id, offset.

    A document is the ids of its whole text and `end`; a null or empty text is `end` alone. Full windows of a document
    are sequences of their own. What is left over is counted by length, over all documents; the
    driver solves that histogram, of at most `window` numbers, and every task looks up where its
    documents go by their rank within a length. Sequences hold `window` ids or a power of two, so
    nothing is padded. Repeated rows are packed as often as they occur; no rows give no pieces.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    rows = stored(encoded(rows, path or vocabulary(), end, window), "tokens")
    counts = rows.where("rest > 0").groupBy("rest", "task").agg(F.count(F.lit(1)).alias("n"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("rest").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    bases = stored(counts.select("rest", "task", "n", before.alias("base")), "bases")
    histogram = np.zeros(window, np.int64)
    for rest, n in bases.groupBy("rest").agg(F.sum("n")).collect():
        histogram[rest] = n
    plan = docs.sparkSession.sparkContext.broadcast(layout(histogram, window))

    def run(batches):
        found = plan.value
        for batch in batches:
            for at in range(0, len(batch), STEP):
                part = batch.slice(at, STEP)
                take, rows = [], []
                columns = [part[c].to_pylist() for c in ("ids", "tokens", "rest", "task", "rank", "full", "base")]
                for k, (ids, tokens, rest, task, rank, full, base) in enumerate(zip(*columns)):
                    whole = tokens // window
                    pieces = [((task + 1) * OWN + full + i, 0, window) for i in range(whole)]
                    if rest:
                        pieces += spots(found, rest, rank + (base or 0))
                    start = 0
                    for sequence, offset, size in pieces:
                        rows.append((start, size, ids[4 * start:4 * (start + size)], tokens, sequence, offset))
                        take.append(k)
                        start += size
                kinds = (pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64())
                values = [pa.array(c, k) for c, k in zip(zip(*rows), kinds)]
                names = ["id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]
                yield pa.RecordBatch.from_arrays([part["id"].take(pa.array(take)), *values], names=names)

    placed = rows.join(light(bases.drop("n")), ["rest", "task"], "left")
    kind = rows.schema["id"].dataType.simpleString()
    return placed.mapInArrow(run, f"id {kind}, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long")


def op5_packing(spark, folder: str) -> DataFrame:
    found = pack(table(spark, folder, "documents"))
    return found.select(F.col("id").alias("doc_id"), "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
                        "sequence_id", "offset")
