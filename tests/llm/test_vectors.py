"""Near vectors and nearest vectors against brute force."""

import numpy as np
import pytest

from tallyloom.llm.caps import near_vectors
from tallyloom.llm.common import forest
from tallyloom.llm.graphs import CLASS, VECTORS, Graph, answers, lifted, nearest, shards_of


@pytest.fixture(scope="module")
def vectors(spark):
    rng = np.random.default_rng(5)
    x = rng.standard_normal((900, 24)) * rng.uniform(0.2, 3, (900, 1))
    for k in range(0, 300, 3):
        x[k + 1] = x[k] * 1.7 + rng.standard_normal(24) * 0.05
    x[600:640] = x[600]
    x[700:760] = x[700] + rng.standard_normal((60, 24)) * 0.02
    rows = [(i, v.tolist(), 0, 1) for i, v in enumerate(x)]
    odd = [(2000, None), (2001, [0.0] * 24), (2002, [float("nan")] + [1.0] * 23), (2020, [None] + [1.0] * 23),
           (2004, [float("inf")] + [1.0] * 23), (2005, []), (2006, [1.0, 2.0]), (2040, [2.0, 4.1])]
    schema = "vec_id long, embedding array<double>, filter int, key int"
    return spark.createDataFrame(rows + [(i, v, 0, 1) for i, v in odd], schema), x


@pytest.mark.parametrize("most", [2048, 16])
def test_links_equal_brute_force(vectors, monkeypatch, most):
    monkeypatch.setattr("tallyloom.llm.caps.MOST", most)
    df, x = vectors
    found = {r.id: (r.n_links, r.component, r.kept) for r in near_vectors(df).collect()}
    units = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = (units @ units.T >= 0.95) & ~np.eye(len(x), dtype=bool)
    a, b = np.nonzero(near)
    nodes, roots = forest(a, b)
    root = dict(zip(nodes.tolist(), roots.tolist()))
    for i in range(len(x)):
        assert found[i] == (near[i].sum(), root.get(i, i), root.get(i, i) == i)
    for i in (2000, 2001, 2002, 2020, 2004, 2005):
        assert found[i] == (0, i, True)
    assert found[2006] == (1, 2006, True) and found[2040] == (1, 2006, False)


def test_null_and_repeated_ids(spark):
    rows = [(None, [1.0, 0.0, 1.0]), (5, [1.0, 0.0, 1.0]), (5, [1.0, 0.0, 1.0]), (None, [0.0, -1.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    found = sorted((str(r.id), r.n_links, str(r.component), r.kept) for r in near_vectors(df).collect())
    assert found == [("5", 2, "5", True), ("5", 2, "5", True), ("None", 0, "None", True), ("None", 2, "5", False)]


def test_nothing(vectors):
    df, _ = vectors
    assert near_vectors(df.where("false")).collect() == []
    assert nearest(df.where("false"), df.where("false")).collect() == []
    assert nearest(df, df.where("false")).collect() == []


def test_nearest_reaches_the_recall(vectors):
    df, x = vectors
    found: dict[int, list] = {}
    for r in nearest(df, df.where("vec_id % 20 = 0")).collect():
        found.setdefault(r.query_id, []).append((r.rank, r.id, r.score))
    assert set(found) == {*range(0, 900, 20), 2040}
    hits = 0
    for q in range(0, 900, 20):
        scores = (x * x[q]).sum(1)
        scores[q] = -np.inf
        want = np.lexsort([np.arange(len(x)), -scores])[:20]
        got = sorted(found[q])
        assert [g[0] for g in got] == list(range(1, 21))
        assert np.allclose([g[2] for g in got], scores[[g[1] for g in got]], rtol=1e-12)
        assert [(-g[2], g[1]) for g in got] == sorted((-g[2], g[1]) for g in got)
        hits += len({g[1] for g in got} & set(want.tolist()))
    assert hits / (20 * len(range(0, 900, 20))) >= 0.95
    assert [(r, i) for r, i, _ in found[2040]] == [(1, 2006)]  # fewer candidates than asked for: all of them


@pytest.mark.parametrize("norm", [1e4, 1e6])
def test_recall_beside_a_long_vector(norm):
    rng = np.random.default_rng(9)
    x = rng.standard_normal((2000, 16))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    x[77] *= norm
    graph = Graph(lifted(x)).build(np.random.default_rng(7))
    asked = rng.standard_normal((50, 16))
    found = answers(graph, x, [np.array([i]) for i in range(2000)], asked, np.arange(50) + 5000, 20)
    hits = sum(len(set(found[found["query_id"] == 5000 + q]["id"]) & set(np.argsort(-(x @ asked[q]))[:20].tolist())) for q in range(50))
    assert hits / 1000 >= 0.95


def test_draws_go_to_the_smaller_id(vectors):
    df, _ = vectors
    got = [r.id for r in nearest(df, df.where("vec_id = 620")).orderBy("rank").collect()]
    copies = [i for i in range(600, 640) if i != 620]
    some = [i for i in got if 600 <= i < 640]
    assert some and some == copies[:len(some)]


def test_classes_of_norms_get_shards():
    assert shards_of([], 100) == []
    assert shards_of([(-2, 10), (-1, 250), (0, 90), (1, 6), (2, 1), (9, 400)], 100) == [
        (-2, 0, 1), (-1, 1, 3), (0, 4, 1), (1, 4, 1), (2, 5, 1), (9, 6, 4)]


def test_recall_over_six_magnitudes_of_norms(spark):
    rng = np.random.default_rng(4)
    x = rng.standard_normal((3000, 16))
    x *= 10 ** rng.uniform(-3, 3, (3000, 1)) / np.linalg.norm(x, axis=1, keepdims=True)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    found: dict[int, set] = {}
    for r in nearest(df, df.where("vec_id % 20 = 0")).collect():
        found.setdefault(r.query_id, set()).add(r.id)
    hits = 0
    for q in range(0, 3000, 20):
        scores = x @ x[q]
        scores[q] = -np.inf
        hits += len(found[q] & set(np.argsort(-scores)[:20].tolist()))
    assert hits / (20 * 150) >= 0.95


def test_recall_at_the_largest_shard():
    rng = np.random.default_rng(6)
    x = rng.standard_normal((VECTORS, 24))
    x *= rng.uniform(1, CLASS, (VECTORS, 1)) / np.linalg.norm(x, axis=1, keepdims=True)
    graph = Graph(lifted(x)).build(np.random.default_rng(7))
    some = range(0, VECTORS, 128)
    found = answers(graph, x, [np.array([i]) for i in range(VECTORS)], x[some], np.array(some), 20)
    hits = 0
    for q in some:
        scores = x @ x[q]
        scores[q] = -np.inf
        hits += len(set(found[found["query_id"] == q]["id"]) & set(np.argsort(-scores)[:20].tolist()))
    assert hits / (20 * len(some)) >= 0.9
