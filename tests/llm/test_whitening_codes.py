"""Whitening and vector codes against brute force, on odd rows and extreme values."""

import hashlib

import numpy as np
import pytest

from tallyloom.llm import codes, vectors, whitening
from tallyloom.llm.common import table

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def rows(spark):
    """Copies, null and repeated ids, unusable vectors, another length, columns named as operators name their own."""
    rng = np.random.default_rng(3)
    x = rng.standard_normal((700, 10)) @ np.diag(np.linspace(0.2, 3, 10))
    x[100:400] = x[100]  # one vector holds much of the table
    x[:, 7] = 0.25  # no variance
    some = [(i, v.tolist(), i % 3 if i % 7 else None, 1, 2) for i, v in enumerate(x)]
    some += [(5, x[5].tolist(), 1, 1, 2), (5, x[6].tolist(), 1, 1, 2), (None, x[8].tolist(), 4, 1, 2)]
    odd = [(9000, None), (9001, [float("nan")] * 10), (9002, [None] + [1.0] * 9), (9003, [float("inf")] + [1.0] * 9),
           (9004, []), (9005, [1.0, 2.0])]
    df = spark.createDataFrame(some + [(i, v, 1, 1, 2) for i, v in odd], "vec_id long, embedding array<double>, label int, x int, code int")
    return df.repartition(5), some


# whitening

def brute(some, scale=64, shift=1_000_000):
    x = np.array([[int(np.floor(scale * c)) + shift for c in v] for _, v, *_ in some], object)
    n, total = len(x), x.sum(0)
    away = (x * n - total).astype(float) / n
    return n, (x * n - total), away, away.T @ away / n


def test_whitening_equals_brute_force(rows):
    df, some = rows
    n, exact, away, matrix = brute(some)
    values, axes = np.linalg.eigh(matrix)
    values, axes = values[::-1], axes[:, ::-1]
    found = whitening.whiten(df, components=12).collect()
    assert len(found) == n * 10 and {r.n for r in found} == {n} and len({r.identity_error for r in found}) == 1
    assert 0 <= found[0].identity_error < 1e-12
    want, got = {}, {}
    for (key, *_), apart in zip(some, exact):
        want.setdefault(key, []).append(int((apart * apart).sum()))
    for r in found:
        assert r.explained == pytest.approx(values[r.component - 1] / np.trace(matrix), rel=1e-9, abs=1e-15)
        if r.component == 1:
            got.setdefault(r.id, []).append(r.deviation)
        if r.component == 10:
            assert r.whitened is None  # the dimension without variance
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in want.items()}
    single = {(r.id, r.component): r.whitened for r in found if r.id not in (5, None)}
    for k in range(1, 10):
        ours = np.array([single[i, k] for i in range(700) if i != 5])
        theirs = (away[[i for i in range(700) if i != 5]] @ axes[:, k - 1]) / np.sqrt(values[k - 1])
        assert min(np.abs(ours - theirs).max(), np.abs(ours + theirs).max()) < 1e-9


def test_given_vectors_are_whitened(spark):
    found = whitening.op11_whitening(spark, FOLDER).collect()
    some = [(r.vec_id, r.embedding) for r in table(spark, FOLDER, "embeddings").collect()]
    n, exact, away, matrix = brute(some)
    values = np.linalg.eigvalsh(matrix)[::-1]
    assert len(found) == n * 32 and found[0].identity_error < 1e-12
    w = np.zeros((n, 32))
    at = {key: i for i, (key, _) in enumerate(some)}
    for r in found:
        w[at[r.vec_id], r.component - 1] = r.whitened
        assert r.explained == pytest.approx(values[r.component - 1] / values.sum(), rel=1e-12)
        assert r.deviation == int((exact[at[r.vec_id]] ** 2).sum())
    assert np.abs(w.T @ w / n - np.eye(32)).max() < 1e-10


def spectrum(values, seed=1):
    q = np.linalg.qr(np.random.default_rng(seed).standard_normal((len(values), len(values))))[0]
    a = (q * np.array(values, float)) @ q.T
    return (a + a.T) / 2


@pytest.mark.parametrize("values", [
    np.linspace(1, 2, 40), [1 + 1e-8 * i for i in range(40)], [5] * 10 + [3] * 10 + [1 + 1e-12 * i for i in range(10)] + [0] * 10,
    10.0 ** -np.arange(0, 16, 0.5), [1.0] * 5, [0.0] * 4, [7.0]])
def test_refined_vectors_are_double(values):
    a = spectrum(values)
    got, x = whitening.eigen(a)
    size = max(np.abs(a).max(), 1e-300)
    assert np.abs(x.T @ x - np.eye(len(a))).max() < 2e-15
    assert np.abs(a.astype(np.longdouble) @ x - x.astype(np.longdouble) * got).max() / size < 1e-15
    assert np.abs(got - np.linalg.eigvalsh(a)[::-1]).max() / size < 1e-13
    assert (np.diff(got) <= 0).all()


def test_single_precision_alone_would_not_do():
    a = spectrum(np.linspace(1, 2, 40))
    rough = np.linalg.eigh(a.astype(np.float32))[1].astype(float)
    fine = whitening.eigen(a)[1]
    assert np.abs(rough.T @ rough - np.eye(40)).max() > 1e-9 > 1e-14 > np.abs(fine.T @ fine - np.eye(40)).max()


def test_products_are_exact():
    rng = np.random.default_rng(4)
    for most in (1000, 1 << 20, 1 << 31):
        y = rng.integers(-most, most, (300, 5))
        high, mixed, low = (m.astype(object) for m in whitening.products(y))
        assert (high * 2**32 + mixed * 2**16 + low == y.astype(object).T @ y.astype(object)).all()


def test_moments_of_parts_join():
    rng = np.random.default_rng(6)
    w = rng.standard_normal((90, 4)) + 1e6

    def state(part):
        away = part - part.mean(0)
        return np.vstack([np.full(4, len(part), float), part.mean(0), away.T @ away])

    total = np.zeros((6, 4))
    for part in (w[:1], w[1:40], w[40:]):
        total = whitening.joined(total, state(part))
    assert np.allclose(total, state(w), rtol=1e-9, atol=1e-9)


def test_extreme_and_few_rows(spark):
    schema = "vec_id long, embedding array<double>"
    assert whitening.whiten(spark.createDataFrame([], schema)).collect() == []
    one = whitening.whiten(spark.createDataFrame([(1, [1.0, 2.0])], schema)).collect()
    assert [(r.component, r.deviation, r.whitened, r.explained, r.identity_error) for r in one] == [(1, 0, None, None, 0.0), (2, 0, None, None, 0.0)]
    two = whitening.whiten(spark.createDataFrame([(1, [1e300, 0.0]), (2, [-1e300, 0.0]), (3, [0.0, 1.0])], schema)).collect()
    assert {r.id for r in two if r.deviation is None} == {1, 2}  # beyond 64 bits
    assert len(two) == 6 and two[0].identity_error < 1e-9


# codes

def lloyd(x, parts, entries, rounds):
    """The plain method: every part meets every entry in every round."""
    found, books = [], []
    for part in np.split(x, parts, axis=1):
        book = part[:entries].copy()
        for turn in range(rounds + 1):
            apart = ((part[:, None, :] - book[None]) ** 2).sum(2)
            code = apart.argmin(1)
            if turn < rounds:
                book = np.array([part[code == e].sum(0) // (code == e).sum() if (code == e).any() else book[e] for e in range(len(book))])
        found.append((code, apart.min(1)))
        books.append(book)
    return np.array([f[0] for f in found]).T, sum(f[1] for f in found), books


@pytest.mark.parametrize("entries", [4, 64, 256])
def test_codes_equal_plain_rounds(spark, entries):
    rng = np.random.default_rng(entries)
    x = np.round(rng.standard_normal((600, 12)), 1)  # many draws
    x[50:250] = x[50]
    order = rng.permutation(600)
    df = spark.createDataFrame([(int(i), x[i].tolist(), 0) for i in order], "vec_id long, embedding array<double>, label int").repartition(4)
    found, books = codes.compress(df, entries=entries)
    code, error, want = lloyd(np.floor(x * 1024).astype(np.int64), 4, entries, 4)
    got = {r.id: (list(r.code), r.error) for r in found.collect()}
    assert got == {i: (code[i].tolist(), error[i]) for i in range(600)}
    assert all((a == b).all() for a, b in zip(books, want))


def test_fixed_entries_meet_moved_ones_only(monkeypatch):
    rng = np.random.default_rng(8)
    x, old = rng.integers(-9, 9, (500, 3)), rng.integers(-9, 9, (30, 3))
    code, distance = codes.assign(x, old)
    new = old.copy()
    new[[3, 17]] = rng.integers(-9, 9, (2, 3))
    moved = (old != new).any(1)
    seen = []
    plain = codes.distances
    monkeypatch.setattr(codes, "distances", lambda a, b: seen.append((len(a), len(b))) or plain(a, b))
    got = codes.assign(x, new, code, distance, moved)
    lost = int(moved[code].sum())
    assert seen == [(lost, 30), (500 - lost, int(moved.sum()))]
    want = codes.assign(x, new)
    assert (got[0] == want[0]).all() and (got[1] == want[1]).all()


def test_distances_beyond_doubles():
    big = codes.limit(3)
    x, entries = np.array([[big, -big, big], [1, 2, 3]]), np.array([[-big, big, -big], [0, 0, 0]])
    want = [[sum((int(a) - int(b)) ** 2 for a, b in zip(r, e)) for e in entries] for r in x]
    assert codes.distances(x, entries).tolist() == want


def test_codes_of_odd_rows(rows, spark):
    df, some = rows
    found, books = codes.compress(df)
    got = found.collect()
    assert len(got) == len(some) and [b.shape for b in books] == [(256, 3), (256, 3), (256, 2), (256, 2)]
    assert sorted(str(r.id) for r in got) == sorted(str(r[0]) for r in some)
    assert all(len(r.code) == 4 and r.error >= 0 for r in got)
    few, books = codes.compress(df.where("vec_id < 3"))
    assert {(r.id, bytes(r.code), r.error) for r in few.collect()} == {(i, bytes([i] * 2 + [i if some[i][1][6:8] != some[0][1][6:8] else 0, i]), 0) for i in range(3)} and books[0].shape == (3, 3)
    none, books = codes.compress(df.where("false"))
    assert none.collect() == [] and codes.digest(books) == hashlib.sha256(b"").hexdigest()


def test_rounds_leave_one_table(spark, rows, monkeypatch):
    gone = []
    monkeypatch.setattr(codes, "remove", lambda session, path: gone.append(path))
    codes.compress(rows[0])
    assert len(gone) == codes.ROUNDS


def test_states_merge_in_steps(spark, monkeypatch):
    monkeypatch.setattr(vectors, "FAN", 2)
    df = spark.range(0, 1000, 1, 9)

    def add(state, block):
        state[0] += sum(block["id"].to_pylist())
        state[1] += len(block)

    found = vectors.merged(df, lambda: {0: np.zeros(1, np.int64), 1: np.zeros(1, np.int64)}, add, np.add)
    assert found[0].tolist() == [499500] and found[1].tolist() == [1000]
