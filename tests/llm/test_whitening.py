import numpy as np
import pytest

from redeemflow.llm import whitening as wh

SCHEMA = "vec_id long, embedding array<float>"


def symmetric(values, seed=0):
    q = np.linalg.qr(np.random.default_rng(seed).normal(size=(len(values),) * 2))[0]
    return (q * np.array(values, float)) @ q.T


@pytest.mark.parametrize("values", [
    [1.0], [2, 1], [1, 1], [0, 0, 0], [5, 5, 5, 1], [1e8, 1, 1e-4, 0], [3, 2.9999999, 2, 2, 2, 0, 0], [1e-30, 2e-30],
    list(np.random.default_rng(3).exponential(size=64)), list(np.geomspace(1e6, 1e-6, 40)), [4] + [1] * 30, range(1, 100)])
def test_eigenpairs(values):
    a = symmetric(list(values))
    found, v = wh.eigen(a)
    scale = max(np.linalg.norm(a), 1e-300)
    assert np.abs(v.T @ v - np.eye(len(a))).max() < 1e-12
    assert np.linalg.norm(a @ v - v * found) < 1e-11 * scale
    assert np.abs(found - np.sort(values)[::-1]).max() < 1e-11 * scale


def test_polar_factor():
    a = symmetric([5, 3, -1, -1e-6, 1e-9, -7])
    u = wh.polar_factor(a)
    w, v = np.linalg.eigh(a)
    assert np.abs(u - (v * np.sign(w)) @ v.T).max() < 1e-5  # sign at 1e-9 of the norm is hard for eigh too
    assert np.abs(u @ u - np.eye(6)).max() < 1e-12


def plain(data):
    """The report by numpy alone; data are (id, vector) pairs."""
    good = [(i, np.array(e, np.float32).astype(float)) for i, e in data
            if e is not None and len(e) and None not in e and np.isfinite(np.array(e, float)).all()]
    xs = [(i, [int(v) for v in np.floor(256 * e)]) for i, e in good]
    fit = sorted({tuple(x) for _, x in xs})
    size = max({len(f) for f in fit}, key=lambda d: (sum(len(f) == d for f in fit), d))
    fit = [f for f in fit if len(f) == size]
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    y = np.array(fit, float) - np.array([s / n for s in sums])
    v = y.T @ y / n
    e, q = np.linalg.eigh(v)
    e, q = e[::-1], q[:, ::-1]
    k = min(4, int((e > 1e-12 * max(np.trace(v), 0)).sum()))
    out = []
    for i, x in xs:
        if len(x) == size:
            z = (np.array(x, float) - np.array([s / n for s in sums])) @ q[:, :k] / np.sqrt(e[:k])
            dev = sum((n * a - s) ** 2 for a, s in zip(x, sums))
            out += [(i, c + 1, n, dev if dev < 2 ** 63 else None, z[c], e[c] / np.trace(v)) for c in range(k)]
    return out


def check(df, data, tolerance=1e-9):
    got, want = [tuple(r) for r in df.collect()], plain(data)
    key = lambda r: (r[1], r[0] is None, r[0] or 0, str(r[3]), abs(r[4]))
    got, want = sorted(got, key=key), sorted(want, key=key)
    assert [r[:4] for r in got] == [r[:4] for r in want]
    for c in {r[1] for r in want}:
        a = np.array([r[4] for r in got if r[1] == c])
        b = np.array([r[4] for r in want if r[1] == c])
        assert min(np.abs(a - b).max(), np.abs(a + b).max()) < tolerance
    assert all(abs(g[5] - w[5]) < 1e-9 for g, w in zip(got, want))
    assert all(r[6] <= 1e-9 for r in got) and len({r[6] for r in got}) <= 1


def test_planted(spark):
    rng = np.random.default_rng(2)
    base = rng.normal(size=(300, 7)) * [5, 3, 2, 1, 0.6, 0.3, 0]
    data = [(i, e.tolist()) for i, e in enumerate(base)]
    data += [(0, base[0].tolist())] * 200 + [(None, base[1].tolist()), (7, base[1].tolist())]
    data += [(900, None), (901, [None] * 7), (902, [float("nan")] * 7), (903, [float("inf")] + [0.0] * 6), (904, []),
             (905, [1.0, 2.0]), (906, [-0.0] * 7), (907, [-1e-9] * 7)]
    df = spark.createDataFrame(data, SCHEMA).repartition(4).selectExpr("*", "1 as x", "2 as n", "'c' as component", "3 as d")
    check(wh.whiten(df), data)


def test_given_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    check(wh.whiten(df), [(r.vec_id, r.embedding) for r in df.collect()], 1e-8)


def test_beyond_long(spark):
    data = [(1, [1e15, 0.0]), (2, [-1e15, 3.0]), (3, [5e8, 1.0])]
    check(wh.whiten(spark.createDataFrame(data, SCHEMA)), data, 1e-6)


def test_without_variance(spark):
    for data in ([], [(1, [1.0, 2.0])] * 5, [(1, None)], [(1, [])]):
        assert wh.whiten(spark.createDataFrame(data, SCHEMA)).count() == 0
