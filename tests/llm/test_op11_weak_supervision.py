import zlib

import numpy as np
import pytest

from claimlens.llm import op11_weak_supervision as op


def test_held_out_precision_and_recall(spark):
    folder = "/root/testdata/sf0.1"
    documents, labels = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")
    rows = op.toxicity(documents, labels).join(labels, "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows)
    tested = [r for r in rows if r.held_out]
    toxic, flagged = {r.doc_id for r in tested if r.toxic}, {r.doc_id for r in tested if r.predicted}
    assert len(toxic & flagged) / len(flagged) > 0.97  # precision
    assert len(toxic & flagged) / len(toxic) > 0.87  # about one in 18 is labelled against its text


def test_label_model_estimates_accuracies_and_correlations():
    """Independent voters and copies of one voter, against the truth that made them; a third is labelled."""
    rng = np.random.default_rng(0)
    n = 6000
    y = rng.random(n) < 0.3
    chance = [(0.7, 0.05), (0.6, 0.1), (0.8, 0.15), (0.5, 0.02)]
    votes = np.column_stack([rng.random(n) < np.where(y, a, b) for a, b in chance])
    noisy = rng.random(n) < 0.2  # says nothing about the class, but four voters repeat it
    copies = np.column_stack([noisy ^ (rng.random(n) < 0.02) for _ in range(4)])
    quiet = ~votes.any(axis=1)
    every = np.column_stack([votes, copies, quiet])
    model, q = op.fit_labels(every, np.where(np.arange(n) % 3 == 0, y, -1), np.ones(n), np.where(votes.sum(axis=1) > 1, 0.9, 0.05), 1)
    assert np.abs(model.accuracy[:4] - np.array(chance)[:, ::-1]).max() < 0.15
    linked = {(j, p) for j, p in enumerate(model.parent) if p >= 0}
    assert sum(4 <= j < 8 and 4 <= p < 8 for j, p in linked) == 3  # the copies form one tree
    assert np.mean((q > 0.5) == y) > 0.85
    assert np.abs(q[copies.all(axis=1)].mean() - q.mean()) < 0.1  # four repeats are no proof


def test_posterior_labels_and_classifier():
    rng = np.random.default_rng(1)
    x = rng.random((2000, 3))
    target = 1 / (1 + np.exp(-(8 * x[:, 0] - 4)))
    row, col = np.indices(x.shape)
    sparse = op.Sparse(row.ravel(), col.ravel(), x.ravel(), x.shape)
    beta, intercept = op.fit_linear(sparse, target, np.ones(2000))
    assert np.allclose(beta, [8, 0, 0], atol=0.6) and abs(intercept + 4) < 0.4


def test_terms_and_patterns():
    assert op.terms_of("stupids") == ["stupids", "stu-", "stup-", "stupi-", "stupid-"]
    assert op.terms_of("ab") == ["ab"] and op.terms_of("x" * 41) == []
    words, times, seen = op.Vocabulary(["idiot", "idi-", "nowhere"]).found("Idiot! idiots idio")
    assert words == 3 and times == {0: 1, 1: 3} and seen == (False, False, False, False)
    check = lambda t: op.patterns(t, t.lower())
    assert check("you are such an idiot") == (True, False, False, False)
    assert check("what an i-d-i-o-t he is") == (False, True, False, False)
    assert check("what an 1d10t") == (False, False, False, False)
    assert check("what an id1ot") == (False, False, True, False)
    assert check("WHAT AN IDIOT") == (False, False, False, True)
    assert check("the idea, 10 0f us") == (False, False, False, False)


def test_labels_of_held_out_rows_teach_nothing(spark):
    documents = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    flipped = labels.withColumn("toxic", op.F.when(op.held_out(), 1 - op.F.col("toxic")).otherwise(op.F.col("toxic")))
    a, b = (sorted(map(tuple, op.toxicity(documents, x).collect())) for x in (labels, flipped))
    assert a == b


def test_samples_do_not_vanish_with_size(spark, monkeypatch):
    """The bound is a number of rows, at every size."""
    for name, n in (("TOXIC_ROWS", 7), ("CLEAN_ROWS", 11), ("OTHER_ROWS", 5)):
        monkeypatch.setattr(op, name, n)
    documents = spark.range(4000).selectExpr("id as doc_id", "concat('word ', id) as text")
    labels = spark.range(3000).selectExpr("id as doc_id", "cast(id % 9 = 0 as int) as toxic")
    rows = op.sample_of(documents, labels).collect()
    by = {k: [r for r in rows if r.label == k] for k in (1, 0, -1)}
    assert len(by[1]) == 7 and len(by[0]) == 11 and 0 < len(by[-1]) <= 5
    assert sum(r.weight for r in by[1]) / sum(r.weight for r in by[0]) == pytest.approx(1 / 8, rel=0.1)
    assert not any(zlib.crc32(str(r.doc_id).encode()) % 4 == 2 for r in rows)


def test_awkward_rows(spark, awkward):
    labels = spark.createDataFrame(
        [(1, 1, 0), (3, 0, 0), (5, 1, 1), (None, 1, 1), (7, None, None), (1, 0, 1), (9, 1, 0)], "doc_id long, quality int, toxic int"
    )
    rows = op.toxicity(awkward, labels).collect()
    assert len(rows) == awkward.count() and all(0 <= r.score <= 1 for r in rows)
    scores = {r.doc_id: r.score for r in rows}
    assert scores[2] == scores[3] and scores[5] == scores[6] and scores[1] == scores[4]
    assert not [r for r in rows if r.doc_id is None][0].held_out
    nothing = op.toxicity(awkward, labels.limit(0)).collect()
    assert len(nothing) == awkward.count()
    assert op.toxicity(awkward.limit(0), labels).count() == 0
    one = spark.createDataFrame([(2, "idiot")], "doc_id long, text string")
    assert op.toxicity(one, labels).count() == 1
