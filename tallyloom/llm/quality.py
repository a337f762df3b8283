"""Quality scores by voting of the nearest labelled documents in a latent space."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.llm.common import held, ship, table, tidy

SAMPLE = 4000  # labelled documents that vote, the bound of what the driver and every task hold
SHAPE = 1024  # hashed counts of a document's shape: classes of its bytes, lengths and repeats of its words
WORDS = 1024  # hashed counts of its words, and
GRAMS = 512  # of four letters in a row
FEATURES = SHAPE + WORDS + GRAMS
TERMS = 0.5  # weight of words and letters beside the shape
RANK = 48  # latent dimensions
TURNS = 6  # rounds of the search for them
NEIGHBOURS = 25
BLOCK = 512  # documents whose products are held at once
SHARPNESS = 8  # power of the similarity that weighs a vote
THRESHOLD = 0.3


def _classes() -> np.ndarray:
    """Bytes as lower, upper, digit, space, line end or part of a longer character; others are themselves."""
    code = np.full(256, 1, np.uint32)
    for c in range(128):
        x = chr(c)
        code[c] = 2 if x.islower() else 3 if x.isupper() else 4 if x.isdigit() else 5 if x == " " else 6 if x == "\n" else 8 + c
    return code


CLASSES = _classes()


def _lower() -> np.ndarray:
    """Bytes in lower case; blanks and line ends are 32, other bytes that are no part of a word 0."""
    code = np.arange(256, dtype=np.uint32)
    for c in range(128):
        x = chr(c)
        code[c] = ord(x.lower()) if x.isalnum() else 32 if x.isspace() else 0
    return code


LOWER = _lower()
PIECE = 1 << 20  # bytes whose terms are hashed at once
ODD = 2654435769  # multiplies hashes; an odd number near 2^32 over the golden ratio


def terms(raw: bytes, out: np.ndarray) -> None:
    """Add hashed counts of words, in lower case, and of four letters in a row to `out`. A word longer than PIECE is hashed in parts."""
    at = 0
    while at < len(raw):
        end = min(len(raw), at + PIECE)
        if end < len(raw) and (cut := max(raw.rfind(b" ", at, end), raw.rfind(b"\n", at, end))) > at:
            end = cut
        code = LOWER[np.frombuffer(raw[at:end], np.uint8)]
        at = end
        inside = code > 32
        letters = np.flatnonzero(inside)
        if not len(letters):
            continue
        begins = np.flatnonzero(np.diff(letters, prepend=-2) > 1)
        size = np.diff(np.append(begins, len(letters)))
        place = (np.arange(len(letters)) - np.repeat(begins, size)).astype(np.uint32)
        # The letters of a word, each turned by its place, added up.
        mixed = (code[letters] + np.uint32(1)) * ((place * np.uint32(2) + np.uint32(1)) * np.uint32(40503) ^ np.uint32(ODD))
        named = np.add.reduceat(mixed, begins) * np.uint32(ODD) >> np.uint32(12)
        out[:WORDS] += np.bincount(named % np.uint32(WORDS), minlength=WORDS)
        if len(code) > 3:
            four = ((code[:-3] * np.uint32(257) + code[1:-2]) * np.uint32(257) + code[2:-1]) * np.uint32(257) + code[3:]
            some = (inside[:-3] & inside[1:-2] & inside[2:-1] & inside[3:])
            gram = (four[some] * np.uint32(ODD)) >> np.uint32(12)
            out[WORDS:] += np.bincount(gram % np.uint32(GRAMS), minlength=GRAMS)


def counts(text: str | None) -> np.ndarray:
    """Hashed counts over the whole text: triples of byte classes, how words repeat, the words and their letters.

    Words count as repeating their neighbour, as repeating any earlier word, and by length.
    """
    raw = (text or "").encode("utf-8", "replace")
    out = np.zeros(FEATURES, np.float32)
    half = SHAPE - 64
    for at in range(0, len(raw), 1 << 20):
        code = CLASSES[np.frombuffer(raw[at:at + (1 << 20) + 2], np.uint8)]
        if len(code) > 2:
            triple = (code[:-2] * np.uint32(40503) + code[1:-1] * np.uint32(30011) + code[2:] * np.uint32(2654435)) >> np.uint32(4)
            out[:half] += np.bincount(triple % np.uint32(half), minlength=half)
    words = raw.split()
    if words:
        size = np.minimum(np.fromiter(map(len, words), np.int64, len(words)), 31)
        out[half:half + 32] += np.bincount(size, minlength=32)
        out[half + 32] = sum(map(bytes.__eq__, words, words[1:]))
        out[half + 33] = len(words) - len(set(words))
        out[half + 34] = len(words)
    terms(raw, out[SHAPE:])
    return out


def weighted(rows: np.ndarray, rarity: np.ndarray) -> np.ndarray:
    """Shares of a document's counts, dampened and weighted by rarity."""
    half, found = SHAPE - 64, []
    words = np.maximum(rows[:, [half + 34]], 1)
    for low, high, weight in ((0, half, 1.0), (half, SHAPE, 1.0), (SHAPE, SHAPE + WORDS, TERMS), (SHAPE + WORDS, FEATURES, TERMS)):
        part = rows[:, low:high]
        total = words if low == half else np.maximum(part.sum(1, keepdims=True), 1)
        found.append(np.sqrt(part / total) * np.float32(weight))
    return np.concatenate(found, axis=1) * rarity


def unit(rows: np.ndarray) -> np.ndarray:
    return rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-12)


def latent(x: np.ndarray) -> np.ndarray:
    """Directions in which the rows of `x` are longest, by rounds of multiplying a random start; the same every time."""
    found = np.random.default_rng(5).standard_normal((x.shape[1], 2 * RANK)).astype(np.float32)
    for _ in range(TURNS):
        found = np.linalg.qr((x.T @ (x @ found)).astype(np.float64))[0].astype(np.float32)
    reached = (x @ found).astype(np.float64)
    values, turn = np.linalg.eigh(reached.T @ reached)
    return (found @ turn[:, np.argsort(-values, kind="stable")[:RANK]]).astype(np.float32)


def fit(rows: np.ndarray, labels: np.ndarray) -> dict:
    """Latent space of the labelled counts, and the labelled documents' unit vectors in it."""
    rarity = np.log((1 + len(rows)) / (1 + (rows > 0).sum(0))).astype(np.float32) + 1
    x = weighted(rows, rarity)
    axes = latent(x)
    return {"rarity": rarity, "axes": axes, "vectors": unit(x @ axes), "labels": labels.astype(np.float32)}


def vote(model: dict, rows: np.ndarray) -> np.ndarray:
    """Share of label 1 among the nearest labelled documents, weighted by similarity; exact, in blocks.

    Of labelled documents equally near, to six digits, those of smaller id vote.
    """
    labels = model["labels"]
    if not len(labels):
        return np.full(len(rows), 0.5)
    near = min(NEIGHBOURS, len(labels))
    scores = []
    for at in range(0, len(rows), BLOCK):
        like = unit(weighted(rows[at:at + BLOCK], model["rarity"]) @ model["axes"]) @ model["vectors"].T
        # Rounded, so that products of equal vectors are equal in every block; votes are in the order of ids.
        like = np.round(like, 6)
        bound = np.partition(like, -near, axis=1)[:, [-near]]
        above, level = like > bound, like == bound
        level &= np.cumsum(level, 1) <= near - above.sum(1, keepdims=True)
        best = np.nonzero(above | level)[1].reshape(len(like), near)
        weight = np.clip(np.take_along_axis(like, best, 1), 1e-6, 1).astype(np.float64) ** SHARPNESS
        scores.append((weight * labels[best]).sum(1) / weight.sum(1))
    return np.clip(np.concatenate(scores), 0, 1) if scores else np.zeros(0)


def fit_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                label_col: str = "quality", sample: int = SAMPLE) -> dict:
    """Model from at most `sample` labelled rows; rows without id, text or label teach nothing.

    The rows are those with the smallest hash of their id, so that any order of the input gives
    the same model. Their counts are computed by tasks, the latent space by the driver.
    """
    ship(docs.sparkSession.sparkContext)
    known = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("double").alias("label")).where("label in (0, 1)")
    known = known.groupBy("id").agg(F.min("label").alias("label"))
    chosen = known.orderBy(F.xxhash64("id"), "id").limit(sample)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).where("text is not null")

    def run(batches):
        for batch in batches:
            yield pd.DataFrame({"id": batch["id"], "label": batch["label"], "counts": [counts(t).tobytes() for t in batch["text"]]})

    kind = rows.schema["id"].dataType.simpleString()
    taught = rows.join(F.broadcast(chosen), "id").dropDuplicates(["id"])
    found = taught.mapInPandas(run, f"id {kind}, label double, counts binary").orderBy("id").toPandas()
    x = np.frombuffer(b"".join(found["counts"]), np.float32).reshape(-1, FEATURES)
    return fit(x, found["label"].to_numpy(np.float32))


def score_quality(docs: DataFrame, model: dict, text_col: str = "text", into: str = "score") -> DataFrame:
    """`docs` with a column `into` between 0 and 1, higher for documents like those labelled 1.

    Null and empty texts have no counts and are scored by the same vote; without any labelled row
    all scores are 0.5. Rows, their order and all other columns stay as they are.
    """
    ship(docs.sparkSession.sparkContext)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        held("quality", dict)
        for batch in batches:
            for at in range(0, len(batch), BLOCK):
                part = batch.slice(at, BLOCK)
                rows = np.array([counts(t.as_py()) for t in part[text_col]], np.float32).reshape(-1, FEATURES)
                kept = part.drop_columns([into]) if into in part.schema.names else part
                yield kept.append_column(into, pa.array(vote(shared.value, rows), pa.float64()))
        tidy()

    kept = [f for f in docs.schema.fields if f.name != into]
    return docs.mapInArrow(run, T.StructType([*kept, T.StructField(into, T.DoubleType())]))


def fold(id_col: str, parts: int):
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % parts


def op4_quality(spark, folder: str) -> DataFrame:
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    model = fit_quality(docs.where(fold("doc_id", 5) != 0), labels.where(fold("doc_id", 5) != 0))
    scored = score_quality(docs.select("doc_id", "text"), model)
    return scored.select("doc_id", (F.coalesce(fold("doc_id", 5), F.lit(1)) == 0).alias("held_out"), "score",
                         (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
