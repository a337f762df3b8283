"""SimHash fingerprints and their near pairs by multi-index hashing."""

from __future__ import annotations

from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import HOME, PROBE, buckets, components, forest, held, light, ship, spans, stored, table, tidy, tiles, unused

MOST = 1 << 13  # index rows of a bucket that one task holds
PAIRS = 1 << 21  # distances computed at once
CROWD = 512  # texts of a crowd that one task holds, twice
BANDS, ROWS = 24, 4  # keys of a text, and minima that make a key
FACTORS = np.random.default_rng(11).integers(0, 2**63, BANDS * ROWS, np.uint64) * np.uint64(2) + np.uint64(1)


def shingle_hashes(text: str | None, size: int) -> np.ndarray:
    """XXH64 (seed 42) of the space-joined word shingles, repeats included."""
    import xxhash

    words = (text or "").encode("utf-8", "replace").lower().split()  # of bytes: A-Z and ASCII white space only
    if not words:
        return np.zeros(0, np.uint64)
    joined, digest = b" ".join(words), xxhash.xxh64_intdigest
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    count = max(1, len(words) - size + 1)
    lows, highs = starts[:count].tolist(), (ends[size - 1:] if len(words) > size else ends[-1:]).tolist()
    return np.array([digest(joined[a:z], 42) for a, z in zip(lows, highs)], np.uint64)


def majority(hashes: np.ndarray) -> int:
    """The bits set in over half of the hashes, as a signed 64-bit number."""
    total = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 15):
        part = hashes[at:at + (1 << 15)].astype(">u8")
        total += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
    return int(np.packbits(2 * total > len(hashes)).view(">i8")[0])


def remixed(hashes: np.ndarray, turn: int) -> np.ndarray:
    """Further 64 bits of each hash, by a multiply-and-shift mix; turn 0 leaves them."""
    x = hashes.copy()
    if turn:
        x += np.uint64((0x9E3779B97F4A7C15 * turn) & (2**64 - 1))
        for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
        x ^= x >> np.uint64(31)
    return x


def fingerprints(docs: DataFrame, id_col: str, text_col: str, size: int, bits: int = 64) -> DataFrame:
    """Columns id and f0, f1, ...: the fingerprint of every row as 64-bit numbers.

    Words are split at ASCII white space after lower-casing A-Z. Fewer words than a shingle make
    one shingle; null and blank texts have fingerprint zero. Repeated rows stay repeated.
    """
    turns = bits // 64
    names = [f"f{i}" for i in range(turns)]

    def run(batches):
        for batch in batches:
            found = [[majority(remixed(h, i)) for i in range(turns)]
                     for h in map(lambda t: shingle_hashes(t.as_py(), size), batch["text"])]
            values = np.array(found, np.int64).reshape(-1, turns)
            yield pa.RecordBatch.from_arrays([batch["id"], *map(pa.array, values.T)], names=["id", *names])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, "id long, " + ", ".join(f"{n} long" for n in names))


def minima(hashes: np.ndarray) -> np.ndarray:
    """A key per band: the digest of the smallest of the hashes under each of its ROWS multipliers."""
    least = np.full(BANDS * ROWS, 2**64 - 1, np.uint64)
    for at in range(0, len(hashes), 1 << 10):
        least = np.minimum(least, (FACTORS[:, None] * hashes[None, at:at + (1 << 10)]).min(1))
    key = np.zeros(BANDS, np.uint64)
    for column in least.reshape(BANDS, ROWS).T:
        key = remixed(key ^ column, 1)
    return key.view(np.int64)


def near_links(prints: DataFrame, width: int, radius: int) -> DataFrame:
    """Links a, b between rows of `prints` (unique id, f0, f1, ...) at `radius` or fewer differing bits.

    Fingerprints are cut into segments of `width` bits. Every row is indexed under each segment's
    value, and looks up the Hamming ball of radius one around it: its own value, and those with one
    zero bit set (the pairs with one bit cleared are found from the other side). What meets in a
    bucket is verified by the whole distance. With n segments, all pairs up to 2 n - 1 bits meet.

    Buckets are walked in tiles of bounded size and send out no pairs but a spanning forest: stars
    with the components of all verified links.
    """
    names = [c for c in prints.columns if c != "id"]
    segments, mask = 64 // width, (1 << width) - 1
    parts = [F.struct(F.lit(w * segments + i).alias("seg"),
                      F.shiftrightunsigned(F.col(n), i * width).bitwiseAND(F.lit(mask).cast("long")).alias("key"))
             for w, n in enumerate(names) for i in range(segments)]
    index = prints.withColumn("s", F.explode(F.array(*parts))).select("s.*", "id", *names)
    flips = F.transform(F.filter(F.sequence(F.lit(0), F.lit(width - 1)),
                                 lambda b: F.expr("1L").bitwiseAND(F.call_function("shiftright", F.col("key"), b)) == 0),
                        lambda b: F.col("key").bitwiseOR(F.call_function("shiftleft", F.expr("1L"), b)))
    probes = index.withColumn("key", F.explode(flips))
    keys = ["seg", "key", "tile"]

    def run(batches):
        for batch in buckets(batches, keys):
            ids, found = batch["id"].to_numpy(), []
            for left, right, _ in close(batch, keys, names, radius):
                one, two = forest(ids[left], ids[right])
                found.append(pd.DataFrame({"a": one, "b": two}))
            if found:
                yield pd.concat(found, ignore_index=True)
        tidy()

    rows = tiles(index, probes, ["seg", "key"], "id", MOST).repartition(*keys).sortWithinPartitions(*keys, "role")
    return rows.mapInPandas(run, "a long, b long").distinct()


def close(batch: pd.DataFrame, keys: list[str], names: list[str], radius: int):
    """Pairs due in the tiles of `batch` (sorted by `keys` and role) within the radius: row numbers and distances, in parts."""
    code = batch[keys].to_numpy()
    first = np.concatenate([[True], (code[1:] != code[:-1]).any(1)])
    begin = np.flatnonzero(first)[np.cumsum(first) - 1]
    role, ids = batch["role"].to_numpy(), batch["id"].to_numpy()
    words = batch[names].to_numpy().view(np.uint64)
    inside = np.cumsum(role != PROBE)
    indexed = inside - inside[begin] + (role[begin] != PROBE)
    place = np.arange(len(role)) - begin
    count = np.where(role == PROBE, indexed, np.where(role == HOME, place, 0))
    for low, high in spans(count, PAIRS):
        n = count[low:high]
        left = np.repeat(np.arange(low, high), n)
        step = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        right = begin[left] + step
        apart = np.bitwise_count(words[left] ^ words[right]).sum(1, dtype=np.int64)
        good = (apart <= radius) & (ids[left] != ids[right])
        if good.any():
            yield left[good], right[good], apart[good]


def proposed(texts: DataFrame, names: list[str], radius: int) -> DataFrame:
    """Columns a < b, apart, tree: of all pairs that share a band and lie within the radius, a forest and each row's nearest ones.

    The forest, marked by `tree`, has the components of all these pairs. The nearest partner of a row and its nearest
    one with a smaller id are those that most likely are near copies.
    """
    index = texts.select(F.posexplode("bands").alias("seg", "key"), "id", *names)
    keys = ["seg", "key", "tile"]

    def run(batches):
        for batch in buckets(batches, keys):
            ids, found = batch["id"].to_numpy(), []
            words = batch[names].to_numpy().view(np.uint64)
            for left, right, apart in close(batch, keys, names, radius):
                hub, at = np.unique(ids[np.concatenate([left, right])], return_index=True)
                row = np.concatenate([left, right])[at]
                one, two = (row[np.searchsorted(hub, x)] for x in forest(ids[left], ids[right]))
                far = np.bitwise_count(words[one] ^ words[two]).sum(1, dtype=np.int64)
                found += [pd.DataFrame({"a": ids[one], "b": ids[two], "apart": far, "tree": True}),
                          nearest(ids[left], ids[right], apart).assign(tree=False)]
            if found:
                yield pd.concat(found, ignore_index=True)
        tidy()

    rows = tiles(index, None, ["seg", "key"], "id", MOST).repartition(*keys).sortWithinPartitions(*keys, "role")
    found = rows.mapInPandas(run, "a long, b long, apart long, tree boolean")
    return found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "apart", "tree").distinct()


def nearest(one: np.ndarray, two: np.ndarray, apart: np.ndarray) -> pd.DataFrame:
    both = pd.DataFrame({"a": np.concatenate([one, two]), "b": np.concatenate([two, one]),
                         "apart": np.concatenate([apart, apart])}).sort_values(["a", "apart", "b"])
    kept = [both.drop_duplicates("a"), both[both["b"] < both["a"]].drop_duplicates("a")]
    return pd.concat(kept)


def print_links(texts: DataFrame, radius: int) -> DataFrame:
    """Links a, b between ids of `texts` (unique id, print) whose fingerprints differ in `radius` (at most 3) bits.

    Equal fingerprints are folded before the search: the rows of one are linked to the smallest id among
    them, and the smallest ids of near ones to each other.
    """
    values = stored(texts.groupBy(F.col("print").alias("f0")).agg(F.min("id").alias("least"), F.count(F.lit(1)).alias("n")), "values")
    links = stored(near_links(values.select(F.col("f0").alias("id"), "f0"), 32, radius), "near")
    many = values.where("n > 1").select(F.col("f0").alias("print"), "least")
    same = texts.join(light(many), "print").where("id <> least").select(F.col("id").alias("a"), F.col("least").alias("b"))
    near = links.join(values.select(F.col("f0").alias("a"), F.col("least").alias("one")), "a")
    near = near.join(values.select(F.col("f0").alias("b"), F.col("least").alias("two")), "b")
    return same.unionAll(near.select(F.col("one").alias("a"), F.col("two").alias("b")))


def simhash_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 3,
                   radius: int = 3) -> DataFrame:
    """Columns id, fingerprint (16 hex digits) and component for every row of `docs`.

    Two rows are linked when their 64-bit fingerprints differ in `radius` (at most 3) bits;
    `component` is the smallest id reachable over links, the row's own included. Equal fingerprints
    are folded before the search, so groups of copies cost one row. Null ids keep their row: their
    component is the smallest known id, or null without one. No rows give no rows.
    """
    if radius > 3:
        raise ValueError("two segments with balls of radius one find at most three bits")
    prints = stored(fingerprints(docs, id_col, text_col, size), "prints")
    values = stored(prints.groupBy("f0").agg(F.min("id").alias("least")), "values")
    links = near_links(values.select(F.col("f0").alias("id"), "f0"), 32, radius)
    roots = components(links)
    known = values.join(roots, values["f0"] == roots["v"], "left").withColumn("root", F.coalesce("root", "f0"))
    known = stored(known.select("f0", "root", "least"), "known")
    small = known.groupBy("root").agg(F.min("least").alias("component"))
    named = known.join(small, "root").select("f0", "component")
    digits = F.lower(F.lpad(F.hex("f0"), 16, "0"))
    return prints.join(named, "f0").select("id", digits.alias("fingerprint"), "component")


def alike(one: np.ndarray, two: np.ndarray, similarity: float) -> bool:
    """Whether two sorted sets of hashes have at least this Jaccard similarity."""
    if min(len(one), len(two)) < similarity * max(len(one), len(two)):
        return False
    common = len(np.intersect1d(one, two, assume_unique=True))
    return common >= similarity * (len(one) + len(two) - common)


def crowded(members: DataFrame, names: list[str], size: int, similarity: float, radius: int) -> DataFrame:
    """Links a, b that join different values of `part` within a crowd (columns crowd, part, id, text, f0, ...).

    In tiles all pairs within the radius are verified by their sets of shingles, a text against all
    of its tile at once. Only a forest of verified pairs is sent out.
    """
    keys = ["crowd", "tile"]

    def run(batches):
        for batch in buckets(batches, keys):
            for _, tile in batch.groupby(keys, sort=False):
                tile = tile.reset_index(drop=True)
                ids, part = tile["id"].to_numpy(), tile["part"].to_numpy()
                sets = [np.unique(shingle_hashes(t, size)) for t in tile["text"]]
                count = np.array([len(x) for x in sets])
                begin = np.cumsum(count) - count
                known, codes = np.unique(np.concatenate(sets), return_inverse=True)
                mark = np.zeros(len(known), bool)
                for left, right, _ in close(tile, keys, names, radius):
                    new = part[left] != part[right]
                    left, right, found = left[new], right[new], []
                    each, first = np.unique(left, return_index=True)
                    for i, low, high in zip(each.tolist(), first.tolist(), [*first[1:].tolist(), len(left)]):
                        own = codes[begin[i]:begin[i] + count[i]]
                        mark[own] = True
                        common = np.add.reduceat(mark[codes], begin, dtype=np.int64)[right[low:high]]
                        mark[own] = False
                        found.append(common >= similarity * (count[i] + count[right[low:high]] - common))
                    if found and (good := np.concatenate(found)).any():
                        one, two = forest(ids[left[good]], ids[right[good]])
                        yield pd.DataFrame({"a": one, "b": two})
        tidy()

    rows = tiles(members, None, ["crowd"], "id", CROWD).repartition(*keys).sortWithinPartitions(*keys, "role")
    return rows.mapInPandas(run, "a long, b long")


def between(links: DataFrame, parts: DataFrame) -> DataFrame:
    """Links a, b as links between the parts (columns v, part) of their ends; an end in no part stands for itself."""
    for end in ("a", "b"):
        named = parts.select(F.col("v").alias(end), F.col("part").alias(f"{end}_part"))
        links = links.join(named, end, "left")
    return links.select(F.coalesce("a_part", "a").alias("a"), F.coalesce("b_part", "b").alias("b"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 5,
                    similarity: float = 0.8, radius: int = 76, bits: int | None = None) -> DataFrame:
    """The rows of `docs` without all but one of each group of near copies; all columns stay.

    With `bits` two texts are linked as in `simhash_groups`, when their 64-bit fingerprints of three-word shingles,
    repeats included, differ in at most so many (3 at most) bits; these links are found first. Two texts are linked too when their sets of word shingles have a Jaccard similarity of at least
    `similarity`. Candidates share one of 24 keys, each of four minima over the set, and the 256-bit
    fingerprints of their sets differ in at most `radius` bits. Sets of similarity 0.8 share no key
    with a chance of 3 in a million, and differ by 39 bits on average, short ones by up to 48 with a
    deviation of 6. The nearest partners are verified first,
    which makes parts. Parts that candidates join form crowds, of which all pairs of texts within the
    radius and of different parts are verified. Every link is verified exactly. Of each group the row
    with the smallest id stays, rows with a null id last; equal rows count as copies. Texts without words are copies of each other.
    """
    ship(docs.sparkSession.sparkContext)
    if bits is not None and bits > 3:
        raise ValueError("two segments with balls of radius one find at most three bits")
    key, words = unused(docs, "key"), ["f0", "f1", "f2", "f3"]
    taken = words if bits is None else [*words, "print"]
    rows = docs.withColumn(key, F.xxhash64(F.lit(1), F.col(id_col), F.col(text_col)))
    last = F.lit(2**63 - 1)
    plain = rows.select(F.col(key).alias("key"), F.coalesce(F.col(id_col).cast("long"), last).alias("id"),
                        F.col(text_col).alias("text"))

    def run(batches):
        from xxhash import xxh3_64_intdigest

        held("near copies", dict)
        for batch in batches:
            digests, prints, bands = [], [], []
            for text in batch["text"]:
                text = text.as_py()
                hashes = np.unique(shingle_hashes(text, size))
                digests.append(xxh3_64_intdigest(b" ".join((text or "").encode("utf-8", "replace").lower().split())))
                whole = [] if bits is None else [majority(shingle_hashes(text, 3))]
                prints.append([*(majority(remixed(hashes, i)) for i in range(4)), *whole])
                bands.append(minima(hashes))
            values = np.array(prints, np.int64).reshape(-1, len(taken))
            columns = [batch["key"], batch["id"], pa.array(np.array(digests, np.uint64).view(np.int64)), *map(pa.array, values.T),
                       pa.array(bands, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, names=["key", "id", "digest", *taken, "bands"])
        tidy()

    kinds = ", ".join(f"{w} long" for w in taken)
    prints = stored(plain.mapInArrow(run, f"key long, id long, digest long, {kinds}, bands array<long>"), "prints")
    texts = stored(prints.groupBy("digest").agg(
        F.min("id").alias("id"), F.min_by("key", F.struct("id", "key")).alias("key"), *[F.min(w).alias(w) for w in taken],
        F.min("bands").alias("bands")), "texts")
    known = [] if bits is None else [stored(print_links(texts.select(F.col("digest").alias("id"), "print"), bits), "known")]
    links = stored(proposed(texts.select(F.col("digest").alias("id"), *words, "bands"), words, radius), "links")
    # Components need the forest alone; a row's nearest partners differ from band to band, and are many.
    trees = links.where("tree").select("a", "b")
    ends = trees.select(F.explode(F.array("a", "b")).alias("digest")).distinct()
    wanted = stored(ends.join(texts, "digest").select("digest", "key"), "wanted")
    bodies = stored(plain.select("key", "text").join(light(wanted), "key").groupBy("digest").agg(F.min("text").alias("text")), "held")

    def verify(batches):
        for batch in batches:
            good, last_text, last_set = [], None, None
            for one, two in zip(batch["one"].to_pylist(), batch["two"].to_pylist()):
                if one != last_text:
                    last_text, last_set = one, np.unique(shingle_hashes(one, size))
                good.append(alike(last_set, np.unique(shingle_hashes(two, size)), similarity))
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))
        tidy()

    pairs = links.select("a", "b", "apart")
    both = pairs.unionAll(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"), "apart"))
    first, lower = F.struct("apart", "b"), F.when(F.col("b") < F.col("a"), F.struct("apart", "b"))
    close_by = both.groupBy("a").agg(F.array_distinct(F.array_compact(F.array(F.min(first)["b"], F.min(lower)["b"]))).alias("b"))
    pairs = close_by.select("a", F.explode("b").alias("b")).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    pairs = pairs.join(bodies.select(F.col("digest").alias("a"), F.col("text").alias("one")), "a")
    pairs = pairs.join(bodies.select(F.col("digest").alias("b"), F.col("text").alias("two")), "b")
    sure = stored(pairs.select("a", "b", "one", "two").mapInArrow(verify, "a long, b long"), "sure")
    sure = reduce(DataFrame.unionAll, known, sure)
    parts = components(sure).select("v", F.col("root").alias("part"))
    # Candidates and links that are found later join parts, not texts: what is within a part is settled.
    crowds = components(between(trees, parts)).select(F.col("v").alias("part"), F.col("root").alias("crowd"))
    split = ends.join(parts, ends["digest"] == parts["v"], "left").select("digest", F.coalesce("part", "digest").alias("part"))
    members = split.join(light(crowds), "part")
    members = members.join(texts.select("digest", *words), "digest").join(bodies, "digest").withColumnRenamed("digest", "id")
    more = crowded(stored(members, "members"), words, size, similarity, radius)
    roots = components(between(more, parts)).select(F.col("v").alias("part"), "root")
    grouped = texts.join(parts, texts["digest"] == parts["v"], "left").withColumn("part", F.coalesce("part", "digest"))
    grouped = grouped.join(light(roots), "part", "left").withColumn("root", F.coalesce("root", "part"))
    stay = grouped.groupBy("root").agg(F.min_by("key", F.struct("id", "key")).alias("key")).select("key")
    counts = prints.groupBy("key").count()
    gone = stored(counts.join(stay, "key", "left_anti").select(F.col("key").alias(key)), "gone")
    twice = stored(counts.where("count > 1").select(F.col("key").alias(key)).join(gone, key, "left_anti"), "twice")
    kept = rows.join(light(gone), key, "left_anti")
    once = kept.join(light(twice), key, "left_anti")
    folded = kept.join(light(twice), key, "left_semi").dropDuplicates([key])
    return once.unionByName(folded).drop(key)


def op1_simhash(spark, folder: str) -> DataFrame:
    found = simhash_groups(table(spark, folder, "documents"))
    return found.select(F.col("id").alias("doc_id"), "fingerprint", F.col("component").alias("component_id"))
