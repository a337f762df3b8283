"""Fingerprints, near copies and repeated passages against brute force."""

from collections import Counter

import numpy as np
import xxhash

import corpus_pipeline
from tallyloom.llm.common import components, forest
from tallyloom.llm.recompression import symbols
from tallyloom.llm.simhash import near_duplicates, near_links, simhash_groups
from tallyloom.llm.substrings import remove_repeats
from tests.llm.conftest import prose


def words(text):
    return (text or "").encode().lower().split()


def shingles(text, size):
    w = words(text)
    return [b" ".join(w[i:i + size]) for i in range(max(1, len(w) - size + 1))] if w else []


def fingerprint(text):
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles(text, 3)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(values, linked):
    root = list(range(len(values)))
    changed = True
    while changed:
        changed = False
        for i in range(len(values)):
            for j in range(i):
                if root[i] != root[j] and linked(values[i], values[j]):
                    low, high = sorted((root[i], root[j]))
                    root = [low if r == high else r for r in root]
                    changed = True
    return root


def test_groups_equal_brute_force(odd):
    rows = [r for r in odd.select("doc_id", "text").collect()]
    prints = [fingerprint(r.text) for r in rows]
    root = groups(prints, lambda a, b: (a ^ b).bit_count() <= 3)
    least = {r: min((rows[i].doc_id for i in range(len(rows)) if root[i] == r and rows[i].doc_id is not None), default=None) for r in root}
    want = Counter((row.doc_id, f"{p:016x}", least[r]) for row, p, r in zip(rows, prints, root))
    assert Counter(tuple(r) for r in simhash_groups(odd).collect()) == want


def test_groups_of_nothing(nothing):
    assert simhash_groups(nothing).collect() == []
    assert near_duplicates(nothing).collect() == []
    assert remove_repeats(nothing).collect() == []


def test_links_in_cut_buckets(spark, monkeypatch):
    """All values within three bits, also where a bucket takes many tiles."""
    monkeypatch.setattr("tallyloom.llm.simhash.MOST", 16)
    rng = np.random.default_rng(3)
    centre = int(rng.integers(2**62))
    values = sorted({centre ^ int(sum(1 << int(b) for b in rng.choice(63, rng.integers(0, 5), replace=False))) for _ in range(300)})
    df = spark.createDataFrame([(v, v) for v in values], "id long, f0 long")
    found = {r.v: r.root for r in components(near_links(df, 32, 3)).collect()}
    a, b = zip(*[(x, y) for x in values for y in values if x < y and (x ^ y).bit_count() <= 3])
    nodes, roots = forest(np.array(a), np.array(b))
    assert {v: found.get(v, v) for v in values} == {v: dict(zip(nodes.tolist(), roots.tolist())).get(v, v) for v in values}


def test_components_of_a_chain_and_a_hub(spark):
    edges = [(i, i + 1) for i in range(60)] + [(1000, 1000 + i) for i in range(1, 50)] + [(5, 5)]
    found = {r.v: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {**{i: 0 for i in range(61)}, **{1000 + i: 1000 for i in range(50)}}


def test_near_copies(spark, odd):
    long = prose(500, 300).split()
    changed = list(long)
    changed[150] = "changed"
    other = long[:150] + prose(501, 150).split()
    more = spark.createDataFrame(
        [(70, " ".join(long)), (71, " ".join(changed)), (72, " ".join(other)), (73, prose(502, 40)), (73, prose(502, 40))], "doc_id long, text string")
    docs = odd.unionByName(more, allowMissingColumns=True)
    kept = near_duplicates(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.select("doc_id").collect()]
    # Equal texts but for case, one changed word, blank texts and equal short ones; repeated rows; the null id goes last.
    gone = {20, 21, 22, 50, 71, 41, 42, 44, None, 61}
    every = [r.doc_id for r in docs.select("doc_id").collect()]
    assert sorted(ids) == sorted({i for i in every if i is not None} - gone)


def test_near_copies_but_for_a_repeated_line(spark):
    """Jaccard 0.95 on distinct shingles; with repeats the line would make up half of one fingerprint."""
    text, line = prose(510, 300), prose(511, 12)
    df = spark.createDataFrame([(1, text), (2, text + (" " + line) * 20), (3, prose(512, 300))], "doc_id long, text string")
    assert sorted(r.doc_id for r in near_duplicates(df).collect()) == [1, 3]


def template_crowd(count, words=80):
    """Texts with a few words of one template replaced, so that similarities lie on both sides of 0.8."""
    rng = np.random.default_rng(8)
    base = prose(520, words).split()
    out = []
    for k in range(count):
        own = list(base)
        for at in rng.choice(words, rng.integers(1, 3), replace=False):
            own[at] = f"own{k}x{at}"
        out.append(" ".join(own))
    return out


def test_near_copies_equal_brute_force(spark, monkeypatch):
    """Around 0.8, in crowds whose nearest pairs fail, also where a crowd takes many tiles; short texts too."""
    texts = template_crowd(150) + template_crowd(60, 40)
    for k in range(40):  # four shingles of five
        short = prose(600 + k, 9).split()
        texts += [" ".join(short), " ".join(short[:8])]
    sets = [set(shingles(t, 5)) for t in texts]
    root = groups(sets, lambda a, b: len(a & b) >= 0.8 * len(a | b))
    assert 80 < len(set(root)) < len(texts) - 60
    monkeypatch.setattr("tallyloom.llm.simhash.CROWD", 32)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    assert sorted(r.doc_id for r in near_duplicates(df).collect()) == sorted(set(root))


def brute_repeats(rows, window=35):
    texts = [(t or "").encode().split() for _, t in rows]
    seen = Counter(tuple(t[i:i + window]) for t in texts for i in range(len(t) - window + 1))
    for (i, _), t in zip(rows, texts):
        gone = set()
        for at in range(len(t) - window + 1):
            if seen[tuple(t[at:at + window])] > 1:
                gone.update(range(at, at + window))
        yield i, len(t), len(gone), b" ".join(w for k, w in enumerate(t) if k not in gone).decode()


def test_repeats_equal_brute_force(odd):
    rows = [(r.doc_id, r.text) for r in odd.select("doc_id", "text").collect()]
    got = Counter(tuple(r) for r in remove_repeats(odd).collect())
    assert got == Counter(brute_repeats(rows))
    assert sum(n for (_, _, n, _), _ in got.items()) > 0


def test_repeats_in_periodic_texts(spark):
    rows = [(i, ("a b " * n + "c " * m).strip()) for i, (n, m) in enumerate([(40, 3), (18, 50), (17, 0), (3, 36), (60, 34)])]
    rows += [(9, " ".join(f"w{k % 37}" for k in range(150))), (10, " ".join(f"w{k % 37}" for k in range(5, 60)))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert Counter(tuple(r) for r in remove_repeats(df).collect()) == Counter(brute_repeats(rows))
    assert Counter(tuple(r) for r in remove_repeats(df, window=5).collect()) == Counter(brute_repeats(rows, 5))


def test_repeats_over_a_shuffle(documents, monkeypatch):
    """The same rows where no table is small enough to be broadcast."""
    want = Counter(tuple(r) for r in remove_repeats(documents).collect())
    monkeypatch.setattr("tallyloom.llm.common.LIGHT", -1)
    assert Counter(tuple(r) for r in remove_repeats(documents).collect()) == want


def test_symbols_depend_on_nothing_outside():
    """Equal passages have the same symbols wherever these need no word outside."""
    rng = np.random.default_rng(1)
    passage = rng.integers(1, 6, 60).astype(np.uint64)
    for _ in range(40):
        one, two = (np.concatenate([rng.integers(1, 6, 30).astype(np.uint64), passage, rng.integers(1, 6, 30).astype(np.uint64)]) for _ in range(2))
        found = []
        for text in (one, two):
            name, first, size, low, high = symbols(text, np.zeros(len(text), np.int64), 4)
            inside = (low >= 30) & (high <= 90)
            found.append(set(zip(name[inside].tolist(), first[inside].tolist(), size[inside].tolist())))
        assert found[0] == found[1]


def test_near_copies_by_fingerprints_too(spark):
    """Long texts whose fingerprints lie within three bits and whose sets are less alike than 0.8, or are verified to be alike."""
    line, rng = prose(530, 40), np.random.default_rng(5)
    texts = [(line + " ") * 30 + prose(531 + k, 60 + 40 * (k % 3)) for k in range(12)] + [prose(560, 60), prose(560, 60) + " more", prose(561, 60)]
    prints, sets = [fingerprint(t) for t in texts], [set(shingles(t, 5)) for t in texts]
    alike = lambda a, b: len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])
    root = groups(range(len(texts)), lambda a, b: (prints[a] ^ prints[b]).bit_count() <= 3 or alike(a, b))
    assert len(set(root)) < len(set(groups(range(len(texts)), alike))) and len(set(root)) > 1
    order = rng.permutation(len(texts)).tolist()
    df = spark.createDataFrame([(i, texts[i]) for i in order], "doc_id long, text string")
    assert sorted(r.doc_id for r in near_duplicates(df, bits=3).collect()) == sorted(set(root))


def test_a_stage_of_the_pipeline_links_fingerprints(spark):
    """Without the links of op1 both would stay."""
    line = prose(530, 40)
    texts = [(line + " ") * 60 + prose(531 + k, 40) for k in range(2)]
    assert (fingerprint(texts[0]) ^ fingerprint(texts[1])).bit_count() <= 3
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert near_duplicates(df).count() == 2
    assert [r.doc_id for r in corpus_pipeline.without_near_copies(spark, df, "").collect()] == [0]
