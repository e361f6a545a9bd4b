import math
import random

import numpy as np
import pandas as pd
import pytest

from claimlens.llm import op12_angular_negatives as op
from pyspark.sql import functions as F


def brute(rows, every=100):
    known = []
    for i, (key, label, v) in enumerate(rows):
        if key is not None and label is not None and v and all(c is not None and math.isfinite(c) for c in v):
            known.append((i, key, (label + 1) % 10 if key % 7 == 0 else label, [math.floor(256 * c) for c in v]))
    out = []
    for i, a, label, x in known:
        if a % every:
            continue
        scored = [(sum(p * q for p, q in zip(x, y)), key, mark) for j, key, mark, y in known if j != i and len(y) == len(x)]
        for ps, positive in sorted(((s, k) for s, k, m in scored if m == label), key=lambda t: (-t[0], t[1]))[:5]:
            fit = sorted(((-s, k) for s, k, m in scored if m != label and 80 * ps <= 100 * s <= 100 * ps))[:5]
            out += [(a, positive, r, k, ps, -s) for r, (s, k) in enumerate(fit, 1)]
    return sorted(out)


def mined(df, **more):
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return sorted(map(tuple, op.hard_negatives(df, label=moved, **more).collect()))


def table(spark, rows):
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>")
    return df.selectExpr("*", "1L as block", "2 as dim", "'x' as ids", "0 as score", "1 as g", "3 as v", "4 as id", "5 as pos")


@pytest.mark.parametrize("sizes", [(1024, 65536, 16384, 4096, 64), (16, 50, 60, 3, 2)])
def test_equals_brute_force(spark, monkeypatch, sizes):
    for name, n in zip(("BLOCK_ROWS", "WAITING_ROWS", "CELL_ROWS", "CELL_ANCHORS", "ANCHORS_AT_ONCE"), sizes):
        monkeypatch.setattr(op, name, n)
    rnd = random.Random(3)
    centres = [[rnd.gauss(0, 0.5) for _ in range(10)] for _ in range(6)]
    rows = [(i, rnd.choice((0, 0, 0, 1, 2, 7)), [c + rnd.gauss(0, 0.1) for c in rnd.choice(centres)]) for i in range(900)]
    rows += [(2000 + i, i % 3, rows[i % 4][2]) for i in range(60)]  # ties and copies across labels
    rows += [(0, 1, rows[0][2]), (100, 2, rows[7][2])]  # repeated ids
    got = mined(table(spark, rows).repartition(5), every=20)
    assert got == brute(rows, 20) and len(got) > 500


def test_awkward_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, 1, [1.0, 2.0]), (1, 1, [1.0, 2.0]), (2, 3, [1.0, 1.9]), (100, None, [1.0, 2.0]), (None, 1, [1.0, 2.0]), (3, 1, None),
        (200, 1, [1.0, None]), (4, 1, [nan, 1.0]), (5, 1, [inf, 1.0]), (300, 3, [0.0, 0.0]), (6, 3, [0.0, 0.0]), (8, 4, [0.0, 0.0]),
        (400, 5, [-1.0, -2.0]), (9, 5, [1.0, 2.0]), (500, 5, [0.5] * 5), (10, 6, [0.5] * 5), (11, 5, [0.6] * 5), (12, 5, []), (600, 5, []),
    ]
    df = table(spark, rows)
    assert mined(df) == brute(rows)
    assert mined(df.limit(0)) == []
    assert mined(table(spark, [(0, 1, [1e300, 1.0]), (1, 1, [1e300, 1.0]), (2, 2, [1e300, 1.0])])) == []  # scores fit no long
    assert mined(table(spark, [(0, 1, [1.0])])) == []


def test_large_scores_are_exact(spark):
    rnd = random.Random(1)
    rows = [(i, i % 2, [rnd.uniform(3e5, 5e5) for _ in range(3)]) for i in range(120)]
    assert mined(table(spark, rows)) == brute(rows)


def test_sample(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    rows = [(r.vec_id, r.label, [float(c) for c in r.embedding]) for r in df.collect()]
    got = mined(df)
    assert got == brute(rows) and got


def test_windows_hold_every_score_asked_for_and_leave_others_out():
    """Bounds against true scores; on clustered rows most rows lie outside the windows."""
    rng = np.random.default_rng(0)
    given = {8: np.array([np.eye(8)[0], np.full(8, 8**-0.5), np.eye(8)[1]])}
    x = np.floor(256 * np.concatenate([rng.normal(s, 0.02, (100, 8)) for s in (0.3, -0.3)] + [np.zeros((1, 8))]))
    norms = np.linalg.norm(x, axis=1)
    angles = op._angles(x, norms, given[8])
    order = np.argsort(angles[:, 1])
    block = (8, 0, 1, 1, 201, norms.min(), norms.max(), angles.min(0).tobytes(), angles.max(0).tobytes(),
             np.arange(201).tobytes(), angles[order, 1].tobytes(), x[order].astype(np.int32).tobytes())
    rows = op.Rows(pd.DataFrame([block], columns=op._names(op.BLOCKS)), 8)
    frame = pd.DataFrame([(8, 0, 9, i, i, x[i].astype(np.int32).tobytes()) for i in (0, 150, 200)], columns=op._names(op.ANCHORS))
    some = op.Some(frame, 8, given, rows)
    true = some.exact @ x[order].T
    for low, high in ((-(10**6), 10**6), (30000, 60000), (0, 10), (-50000, 100)):
        first, last = some.windows(0, np.full(3, low), np.full(3, max(high, 0)))
        for i in range(3):
            inside = np.zeros(201, bool)
            inside[first[i] : last[i]] = True
            assert inside[(true[i] >= low) & (true[i] <= high)].all()
    first, last = some.windows(0, np.full(3, 30000), np.full(3, 1 << 62))
    assert ((last - first)[:2] <= 110).all()
