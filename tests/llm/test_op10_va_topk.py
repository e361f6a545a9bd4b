import math
import random

import pytest

from claimlens.llm import op10_va_topk as op


def brute(rows, k=10, every=100):
    known = []
    for i, (key, v) in enumerate(rows):
        if key is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            known.append((i, key, [math.floor(1024 * x) for x in v]))
    out = []
    for i, q, x in known:
        if q % every == 0:
            scored = sorted((-sum(a * b for a, b in zip(x, y)), c) for j, c, y in known if j != i and len(y) == len(x))
            out += [(q, r, c, -s) for r, (s, c) in enumerate(scored[:k], 1)]
    return sorted(out)


def table(spark, rows):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    return df.selectExpr("*", "1L as block", "2 as dim", "'x' as ids", "0 as score", "1 as g")


@pytest.mark.parametrize("sizes", [(1024, 1024, 4), (16, 3, 2)])
def test_equals_brute_force(spark, monkeypatch, sizes):
    for name, n in zip(("BLOCK_ROWS", "QUERY_ROWS", "BLOCKS_PER_GROUP"), sizes):
        monkeypatch.setattr(op, name, n)
    rnd = random.Random(6)
    rows = [(i, [rnd.gauss(0, 0.3) for _ in range(12)]) for i in range(900)]
    rows += [(2000 + i, rows[i % 3][1]) for i in range(40)]  # ties
    rows += [(0, rows[0][1]), (100, rows[7][1])]  # repeated ids
    got = op.top_k(table(spark, rows).repartition(5)).collect()
    assert sorted(map(tuple, got)) == brute(rows)


def test_awkward_rows(spark):
    rows = [
        (0, [1.0, 2.0]), (100, [1.0, 2.0]), (1, None), (200, [1.0, None]), (2, [float("nan"), 1.0]), (3, [float("inf"), 1.0]),
        (None, [1.0, 1.0]), (4, [0.1, -0.1, 0.2]), (300, [0.1, 0.1, 0.1]), (400, []), (5, []), (500, [0.5] * 5), (6, [1e6, -1e6]), (-100, [1e6, 1e6]),
    ]
    got = op.top_k(table(spark, rows)).collect()
    assert sorted(map(tuple, got)) == brute(rows)
    assert op.top_k(table(spark, rows).limit(0)).count() == 0


def test_sample(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    rows = [(r.vec_id, [float(x) for x in r.embedding]) for r in df.collect()]
    assert sorted(map(tuple, op.top_k(df).collect())) == brute(rows)
