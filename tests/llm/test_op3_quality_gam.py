import zlib

import numpy as np

from claimlens.llm import op3_quality_gam as op
from llm_helpers import SF_DIR


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    documents, labels = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")
    rows = op.quality(documents, labels).join(labels, "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in rows)
    tested = [r for r in rows if r.held_out]
    assert np.mean([r.predicted == r.quality for r in tested]) > 0.97


def test_model_is_additive_tables():
    rng = np.random.RandomState(0)
    x = rng.rand(3000, 4)
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)  # only the pair tells
    model = op.fit(x, y)
    assert {(i, j) for i, j, *_ in model.pairs} & {(1, 0), (0, 1)}
    assert np.mean((model.score(x) > 0.5) == (y > 0)) > 0.8
    total = np.full(len(x), model.intercept)
    for k in range(4):
        total += model.tables[k][np.searchsorted(model.cuts[k], x[:, k])]
    for i, j, ci, cj, t in model.pairs:
        total += t[np.searchsorted(ci, x[:, i]), np.searchsorted(cj, x[:, j])]
    assert np.allclose(total, model.margin(x))


def test_labels_of_held_out_rows_teach_nothing(spark):
    documents = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    flipped = labels.withColumn("quality", op.F.when(op.held_out(), 1 - op.F.col("quality")).otherwise(op.F.col("quality")))
    a, b = (sorted(map(tuple, op.quality(documents, x).collect())) for x in (labels, flipped))
    assert a == b


def test_awkward_rows(spark, awkward):
    labels = spark.createDataFrame([(1, 1, 0), (3, 0, 0), (5, 1, 0), (None, 1, 0), (7, None, 0), (1, 0, 0)], "doc_id long, quality int, toxic int")
    rows = op.quality(awkward, labels).collect()
    assert len(rows) == awkward.count()
    scores = {r.doc_id: r.score for r in rows}
    assert scores[2] == scores[3] and scores[5] == scores[6] and scores[1] == scores[4]
    nothing = op.quality(awkward, labels.limit(0)).collect()
    assert all(r.score == 1.0 and r.predicted == 1 for r in nothing)
    assert op.quality(awkward.limit(0), labels).count() == 0
    assert op.kept(awkward, op.fit(np.zeros((0, len(op.FEATURES))), np.zeros(0))).count() == awkward.count()
