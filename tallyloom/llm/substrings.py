"""Removal of long passages that stand more than once, found by recompression."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import held, light, ship, stored, table, tidy
from tallyloom.llm.recompression import symbols

ROUNDS = 5  # pair rounds before symbols are counted
WORDS = 5  # words that a counted symbol has at least
CHUNK = 1 << 17  # words recompressed at once; a longer text is taken whole
REACH = 1 << 20  # low end and length of an interval in one number


def split(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "replace").split()  # of bytes: ASCII white space only


def chunks(batches, least: int):
    """Keys and words of texts with at least `least` words, some at a time."""
    keys, texts, total = [], [], 0
    for batch in batches:
        for key, text in zip(batch["key"].tolist(), batch["text"]):
            words = split(text)
            if len(words) < least:
                continue
            keys.append(key)
            texts.append(words)
            total += len(words)
            if total >= CHUNK:
                yield keys, texts
                keys, texts, total = [], [], 0
    if keys:
        yield keys, texts


def occurrences(docs: DataFrame, window: int) -> DataFrame:
    """Columns name, key, place: the counted symbols of every text, place negative where no window holds it."""
    def run(batches):
        from xxhash import xxh3_64_intdigest

        held("repeats", dict)
        for keys, texts in chunks(batches, window):
            sizes = np.array([len(w) for w in texts])
            names = np.fromiter((xxh3_64_intdigest(w) for words in texts for w in words), np.uint64, sizes.sum())
            base = np.cumsum(sizes) - sizes
            owner = np.repeat(np.arange(len(sizes)), sizes)
            name, first, size, low, high = symbols(names, owner, ROUNDS)
            kept = size >= WORDS
            name, first, low, high = name[kept], first[kept], low[kept], high[kept]
            whose = owner[first]
            fits = high - low <= window
            place = np.where(fits, (low - base[whose]) * REACH + (high - low), -1)
            yield pd.DataFrame({"name": name.view(np.int64), "key": np.array(keys, np.int64)[whose], "place": place})
        tidy()

    return docs.select("key", "text").mapInPandas(run, "name long, key long, place long")


def open_starts(count: int, places: list[int] | None, window: int) -> np.ndarray:
    """For each window of a text whether no symbol in it is the only one of its name."""
    windows = count - window + 1
    if windows <= 0:
        return np.zeros(0, bool)
    change = np.zeros(windows + 1, np.int64)
    if places is not None and len(places):
        places = np.asarray(places, np.int64)
        low = places // REACH
        high = low + places % REACH
        np.add.at(change, np.clip(high - window, 0, windows), 1)
        np.add.at(change, np.clip(low + 1, 0, windows), -1)
    return np.cumsum(change[:-1]) <= 0


def runs(marks: np.ndarray) -> list[int]:
    """Starts and ends, in turn, of the runs of true values."""
    edge = np.flatnonzero(np.diff(np.concatenate([[False], marks, [False]]).astype(np.int8)))
    return edge.tolist()


def marked(edges, size: int) -> np.ndarray:
    change = np.zeros(size + 1, np.int64)
    edges = np.asarray(edges, np.int64)
    np.add.at(change, edges[::2], 1)
    np.add.at(change, edges[1::2], -1)
    return np.cumsum(change[:-1]) > 0


def windows(docs: DataFrame, window: int) -> DataFrame:
    """Columns h1, h2, key, start: a 128-bit digest of every window that may stand elsewhere."""
    def run(batches):
        from xxhash import xxh3_128_digest

        held("repeats", dict)
        for batch in batches:
            digests, keys, starts = [], [], []
            for key, text, ranges in zip(batch["key"].tolist(), batch["text"], batch["ranges"]):
                words = split(text)
                joined = b" ".join(words)
                ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
                begins = np.concatenate([[0], ends[:-1] + 1])
                at = np.flatnonzero(marked(ranges, len(words) - window + 1))
                digests += [xxh3_128_digest(joined[a:z]) for a, z in zip(begins[at].tolist(), ends[at + window - 1].tolist())]
                keys.append(np.full(len(at), key, np.int64))
                starts.append(at)
                if len(digests) > 1 << 17:
                    yield frame(digests, keys, starts)
                    digests, keys, starts = [], [], []
            if digests:
                yield frame(digests, keys, starts)
        tidy()

    return docs.mapInPandas(run, "h1 long, h2 long, key long, start long")


def frame(digests: list[bytes], keys: list[np.ndarray], starts: list[np.ndarray]) -> pd.DataFrame:
    halves = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
    return pd.DataFrame({"h1": halves[:, 0], "h2": halves[:, 1], "key": np.concatenate(keys), "start": np.concatenate(starts)})


def once(rows: DataFrame, keys: list[str], place: str, into: str) -> DataFrame:
    """Per text the places of what has no second occurrence; sums fold hot values before the shuffle."""
    counted = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.min("key").alias("key"), F.min(place).alias("p"))
    return counted.where("n = 1 and p >= 0").groupBy("key").agg(F.collect_list("p").alias(into))


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 35,
                   carry: tuple[str, ...] = ()) -> DataFrame:
    """Columns id, n_words, n_removed, kept and those of `carry`, for every row of `docs`.

    Removed is each word covered by a window of `window` words whose words also start anywhere else,
    in the same or another row; `kept` holds the remaining words joined by one space. Words are split
    at ASCII white space and compared exactly. Null and blank texts have no words and an empty
    `kept`; repeated rows are repeats of each other.

    Recompression gives equal passages the same interior symbols, named by digests so that all tasks
    agree. A symbol that is counted once in the corpus rules out every window that holds it; what is
    left are the windows made of shared symbols, and those are verified by a 128-bit digest each.
    Only what stands once is sent back to its text, so no list of copies is ever built. Texts go by a
    64-bit key of id and text.
    """
    ship(docs.sparkSession.sparkContext)
    key = F.xxhash64(F.lit(1), F.col(id_col), F.col(text_col))
    docs = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), key.alias("key"),
                       *[F.col(c).alias(f"carry_{i}") for i, c in enumerate(carry)])
    sizes = docs.select("key", F.regexp_count(F.coalesce("text", F.lit("")), F.lit(r"[^\t-\r ]+")).alias("size"))
    sizes = sizes.where(F.col("size") >= window).distinct()
    alone = once(occurrences(docs, window), ["name"], "place", "places")

    def opened(batches):
        for batch in batches:
            found = [runs(open_starts(n, p, window)) for n, p in zip(batch["size"].tolist(), batch["places"])]
            yield pd.DataFrame({"key": batch["key"], "ranges": found})

    shared = sizes.join(alone, "key", "left").mapInPandas(opened, "key long, ranges array<long>")
    shared = stored(shared.where(F.size("ranges") > 0), "shared")
    texts = docs.select("key", "text").join(light(shared, "ranges"), "key")
    single = once(windows(texts, window), ["h1", "h2"], "start", "single")

    def closed(batches):
        for batch in batches:
            found = []
            for ranges, single_starts in zip(batch["ranges"], batch["single"]):
                marks = marked(ranges, max(ranges))
                if single_starts is not None:
                    marks[np.asarray(single_starts, np.int64)] = False
                at = runs(marks)
                at[1::2] = [end + window - 1 for end in at[1::2]]
                found.append(at)
            yield pd.DataFrame({"key": batch["key"], "spans": found})

    spans = shared.join(single, "key", "left").mapInPandas(closed, "key long, spans array<long>")
    spans = stored(spans.where(F.size("spans") > 0), "spans")
    names = [f"carry_{i}" for i in range(len(carry))]
    fields = ", ".join([f"id {docs.schema['id'].dataType.simpleString()}", "n_words long", "n_removed long", "kept string",
                        *[f"{n} {docs.schema[n].dataType.simpleString()}" for n in names]])

    def cut(batches):
        for batch in batches:
            sizes, cuts, kept = [], [], []
            for text, edges in zip(batch["text"].to_pylist(), batch["spans"].to_pylist()):
                words = split(text)
                gone = marked(edges, len(words)) if edges is not None else np.zeros(len(words), bool)
                left = [w for w, g in zip(words, gone.tolist()) if not g] if gone.any() else words
                sizes.append(len(words))
                cuts.append(int(gone.sum()))
                kept.append(b" ".join(left).decode())
            columns = [batch["id"], pa.array(sizes, pa.int64()), pa.array(cuts, pa.int64()), pa.array(kept, pa.string())]
            yield pa.RecordBatch.from_arrays(columns + [batch[n] for n in names],
                                             names=["id", "n_words", "n_removed", "kept", *names])

    done = docs.join(light(spans, "spans"), "key", "left").mapInArrow(cut, fields)
    return done.select("id", "n_words", "n_removed", "kept", *[F.col(n).alias(c) for n, c in zip(names, carry)])


def op8_substrings(spark, folder: str) -> DataFrame:
    found = remove_repeats(table(spark, folder, "documents"))
    return found.select(F.col("id").alias("doc_id"), "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


OP8_SQL = r"""
with w as (
    select doc_id, row_number() over () as k, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') as words
    from documents
), p as (
    select k, unnest(range(1, len(words) - 33)) as i, words from w where len(words) >= 35
), g as (
    select k, i, md5(array_to_string(words[i:i + 34], ' ')) as h from p
), r as (
    select k, i from (select k, i, count(*) over (partition by h) as n from g) where n > 1
), gone as (
    select distinct k, unnest(range(i, i + 35)) as j from r
), marked as (
    select k, list(j) as js from gone group by k
), kept as (
    select w.k, doc_id, words, coalesce(len(js), 0) as n_removed,
           case when js is null then words else list_filter(list_transform(words, lambda x, i: case when list_contains(js, i) then null else x end), lambda x: x is not null) end as left_
    from w left join marked using (k)
)
select doc_id, len(words)::bigint as n_words, n_removed::bigint as n_removed,
       sha256(coalesce(array_to_string(left_, ' '), '')) as kept_sha256
from kept
"""
