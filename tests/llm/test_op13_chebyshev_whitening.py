import math

import numpy as np
import pytest

from claimlens.llm import op13_chebyshev_whitening as op


def brute(rows, components=16):
    """{id: [(deviation, projections)]} by a full eigendecomposition in plain numpy, and explained shares."""
    known = [
        (key, [math.floor(64 * float(c)) + 1000000 for c in v])
        for key, v in rows
        if v and all(c is not None and math.isfinite(c) for c in v)
    ]
    distinct = sorted({tuple(x) for _, x in known})
    n = len(distinct)
    sums = [sum(c) for c in zip(*distinct)]
    mean = np.array([s / n for s in sums])
    z = np.array(distinct, float) - mean
    v = z.T @ z / n
    e, u = np.linalg.eigh(v)
    e, u = e[::-1][:components], u[:, ::-1][:, :components]
    out = [
        (key, sum((n * c - s) ** 2 for c, s in zip(x, sums)), (np.array(x, float) - mean) @ u / np.sqrt(e))
        for key, x in known
    ]
    return n, out, e / np.trace(v)


def compare(got, rows, tolerance=1e-8):
    n, want, explained = brute(rows)
    table = {}
    for r in got:
        table.setdefault(r.vec_id, {})[r.component] = r
    assert len(got) == len(want) * len(explained)
    mine = np.array([[table[k][c].whitened for c in range(1, len(explained) + 1)] for k, _, _ in want])
    theirs = np.array([w for _, _, w in want])
    signs = np.sign((mine * theirs).sum(axis=0))
    assert np.abs(mine * signs - theirs).max() < tolerance
    for k, deviation, _ in want:
        assert {(r.n, r.deviation) for r in table[k].values()} == {(n, deviation)}
    for c, share in enumerate(explained, 1):
        assert all(abs(table[k][c].explained - share) <= 1e-10 for k, _, _ in want)
    assert {r.identity_error for r in got} == {got[0].identity_error} and 0 <= got[0].identity_error < 1e-10


@pytest.mark.parametrize("sf", ["0.001", "0.1"])
def test_equals_full_decomposition(spark, sf):
    df = spark.read.parquet(f"/root/testdata/sf{sf}/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    compare(op.whitened(df).collect(), rows)


def test_narrow_gap_and_copies(spark):
    """A flat spectrum behind the block, a hot vector that holds a third of the rows."""
    rng = np.random.default_rng(5)
    x = rng.standard_normal((600, 80)) * np.linspace(1.2, 1.0, 80)
    rows = [(i, v) for i, v in enumerate(x.tolist())] + [(1000 + i, x[0].tolist()) for i in range(300)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    compare(op.whitened(df.repartition(7)).collect(), rows)


def test_block_is_widened_where_the_gap_is_too_narrow(spark, monkeypatch):
    monkeypatch.setattr(op, "MAX_PASSES", 3)
    df = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    compare(op.whitened(df).collect(), [(r.vec_id, r.embedding) for r in df.collect()])


def test_filter_damps_the_unwanted_spectrum():
    values = np.concatenate([[10.0, 9.0, 8.0], np.linspace(5, 1, 40)])
    q, _ = np.linalg.qr(np.random.default_rng(0).standard_normal((43, 43)))
    apply = lambda x: q @ (values[:, None] * (q.T @ x))
    start = np.ones((43, 1))
    out = q.T @ op.chebyshev(apply, q @ start, 12, 1.0, 5.0, 10.0)
    assert np.abs(out[3:]).max() < 1e-4 * np.abs(out[:3]).min()
    e, u = op.leading(apply, 43, 3)
    assert np.allclose(e, [10, 9, 8], rtol=1e-13) and np.allclose(np.abs(np.diag(q.T[:3] @ u)), 1, atol=1e-12)
    low = op.least_bound(apply, 43, np.random.default_rng(1))
    assert 0 <= low <= 1.0 + 1e-9


def test_exact_integers():
    mean = op.Centre(3, [2**62 + 1, -5, 7])
    assert [mean.n * int(c) + o for c, o in zip(mean.near, mean.over)] == mean.sums
    x = np.array([[2**60, 0, 5]], np.int64)
    assert mean.deviations(x) == [None]
    small = op.Centre(2, [3, 4])
    assert small.deviations(np.array([[1, 2], [2, 2]])) == [1, 1]


def test_awkward_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 2.0]), (1, [1.0, 2.0]), (2, [0.0, 1.0]), (2, [5.0, -3.0]), (3, None), (4, []), (5, [1.0, None]),
        (6, [nan, 1.0]), (7, [inf, 1.0]), (8, [1e300, 1.0]), (9, [1.0]), (10, [1.0]), (11, [1.0, 2.0, 3.0]),
        (12, [1.0, 2.5, 3.0]), (None, [0.5, 0.5]),
    ]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "1 as id", "2 as x", "3 as v", "4 as n", "5 as dim")
    got = op.whitened(df).collect()
    pairs = [r for r in got if r.vec_id in (0, 1, 2, None)]
    assert len(pairs) == 10 and {r.n for r in pairs} == {4} and {r.component for r in pairs} == {1, 2}
    first = {r.component: r.whitened for r in pairs if r.vec_id == 0}
    assert first == {r.component: r.whitened for r in pairs if r.vec_id == 1}
    assert not [r for r in got if r.vec_id in (3, 4, 5, 6, 7, 8, 9, 10)]  # 9 and 10: one distinct vector, no variance
    assert sorted(r.whitened for r in got if r.vec_id in (11, 12)) == pytest.approx([-1.0, 1.0])
    assert op.whitened(df.limit(0)).count() == 0
    assert op.whitened(df.filter("vec_id = 0")).count() == 0
