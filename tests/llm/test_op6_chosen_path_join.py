import random
from collections import Counter

import pytest

from claimlens.llm import common
from claimlens.llm import op6_chosen_path_join as op
from llm_helpers import texts_of


def grams(text):
    words = text.split()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else ({tuple(words)} if words else set())


def brute(rows):
    """Linked documents and group of each document, repeated rows counted as copies."""
    last = 1 << 62  # stands for no id
    sets = [(last if i is None else i, grams(t), t) for i, t in rows]
    links, label = Counter(), list(range(len(sets)))
    for a in range(len(sets)):
        for b in range(len(sets)):
            x, y = sets[a][1], sets[b][1]
            if a != b and (sets[a][2] == sets[b][2] or x and y and len(x & y) >= 0.8 * len(x | y)):
                links[a] += 1
                if label[a] != label[b]:
                    old, new = max(label[a], label[b]), min(label[a], label[b])
                    label = [new if z == old else z for z in label]
    least = {}
    for k, z in enumerate(label):
        least[z] = min(least.get(z, sets[k][0]), sets[k][0])
    out = [(sets[k][0], least[label[k]], links[k]) for k in range(len(sets))]
    return sorted(((*(None if x == last else x for x in r[:2]), r[2]) for r in out), key=repr)


def result(df):
    return sorted(((r.doc_id, r.class_id, r.n_links) for r in op.near_classes(df).collect()), key=repr)


def near_copies(seed=1, groups=6, copies=25, words=60):
    rnd = random.Random(seed)
    rows = []
    for g in range(groups):
        base = [f"w{rnd.randint(0, 5000)}" for _ in range(words)]
        for _ in range(copies):
            text = list(base)
            for _ in range(rnd.randint(0, 2)):
                text[rnd.randrange(words)] = f"n{rnd.randint(0, 99)}"
            rows.append((len(rows), " ".join(text)))
    return rows


@pytest.mark.parametrize("bucket, block", [(256, 256), (8, 5)])
def test_equals_brute_force(spark, monkeypatch, bucket, block):
    monkeypatch.setattr(op, "BUCKET", bucket)
    monkeypatch.setattr(op, "BLOCK", block)
    rows = near_copies()
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    assert result(df) == brute(rows)


def test_sample_equals_brute_force(documents):
    assert result(documents) == brute(texts_of(documents))


def test_awkward_rows(awkward):
    got = result(awkward)
    assert got == brute(texts_of(awkward))
    assert [r for r in got if r[0] in (5, 6)] == [(5, 5, 1), (6, 5, 1)]
    assert op.near_classes(awkward.limit(0)).count() == 0


def test_intersections_by_blocks_of_columns(monkeypatch):
    import numpy as np

    monkeypatch.setattr(op, "COLUMNS_AT_ONCE", 7)
    rnd = np.random.RandomState(2)
    sets = [np.unique(rnd.randint(0, 60, 25).astype(np.uint32)) for _ in range(9)]
    got = op.shared_counts(sets)
    for i in range(9):
        for j in range(9):
            if i != j:
                assert got[i, j] == len(np.intersect1d(sets[i], sets[j]))


def test_runs_reach_the_recall():
    n = op.runs_for(op.RECALL)
    assert (1 - op.MEET) ** n <= 1 - op.RECALL < (1 - op.MEET) ** (n - 1)


def test_chain_of_links_is_one_group(spark):
    edges = spark.createDataFrame([(i + 1, i) for i in range(40)], "c long, root long")
    assert {tuple(r) for r in op.components(edges).collect()} == {(i, 0) for i in range(41)}


def test_rows_without_an_id_and_shared_ids(spark):
    """No text is lost: a null id comes last, and texts that share an id are told apart."""
    text = " ".join(f"w{i}" for i in range(40))
    near = text + " end"
    rows = [(None, "alone " + text[::-1]), (None, near), (1, "first text of one"), (1, "second text of one"), (5, text), (5, text)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = sorted(((r.doc_id, r.class_id, r.n_links) for r in op.near_classes(df).collect()), key=repr)
    assert got == sorted([(None, None, 0), (None, 5, 2), (1, 1, 0), (1, 1, 0), (5, 5, 2), (5, 5, 2)], key=repr)
    kept = sorted(((r.doc_id, r.text) for r in op.one_of_each(df).collect()), key=repr)
    assert kept == sorted([rows[0], rows[2], rows[3], rows[4]], key=repr)


def test_texts_of_equal_hash_stay_apart(spark, monkeypatch):
    monkeypatch.setattr(common, "text_hash", lambda text: op.F.length(text).cast("long") % 10)
    rows = near_copies(groups=3, copies=8)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert result(df) == sorted(brute(rows), key=repr)
    assert op.one_of_each(df).count() == len({c for _, c, _ in brute(rows)})


def test_bitmap_never_misses_a_key(spark, monkeypatch):
    rows = spark.range(5000).selectExpr("id", "cast(id * 7 as string) as name")
    keys = rows.filter("id % 10 = 3")
    for words in (1 << 18, 2):  # far fewer bits than keys: every row is maybe
        monkeypatch.setattr(common, "FILTER_WORDS", words)
        told = common.possibly(rows, keys, ["id", "name"]).filter(common.MAYBE)
        assert told.filter("id % 10 = 3").count() == 500
        assert (told.count() < 510) == (words > 2)
    assert common.possibly(rows, keys.limit(0), ["id", "name"]).filter(common.MAYBE).count() == 0


def test_one_of_each_by_a_full_bitmap_is_the_same(spark, monkeypatch):
    rows = near_copies(groups=3, copies=8) + [(500, "alone in the world"), (500, "alone in the world")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    want = sorted(map(tuple, op.one_of_each(df).collect()))
    assert len(want) == len({c for _, c, _ in brute(rows)})
    monkeypatch.setattr(common, "FILTER_WORDS", 1)
    assert sorted(map(tuple, op.one_of_each(df).collect())) == want
