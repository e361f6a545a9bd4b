import hashlib
import re

import pytest

from claimlens.llm import op2_spotsigs as op
from llm_helpers import texts_of


def spots(text):
    every = re.findall(r"[^\W_]+", text.lower())
    words = [w for w in every if w not in op.COMMON]
    out = set()
    for i, w in enumerate(words):
        if w in op.ANCHORS:
            chain = [x for x in words[i + 1 :] if x not in op.ANCHORS][: op.CHAIN]
            if len(chain) == op.CHAIN:
                out.add(tuple(chain))
    return out or {tuple(every)}


def jaccard(a, b):
    return len(a & b) / len(a | b)


def brute(rows):
    rows = sorted(rows, reverse=True)
    out = {}
    for k, (i, text) in enumerate(rows):
        after = rows[(k + 1) % len(rows)][1]
        cut = len(text) // 3
        edited = text[: len(text) - cut] + after[:cut]
        out[i] = (
            len(text), hashlib.sha256(edited.encode()).hexdigest(),
            jaccard(spots(text), spots(edited)), jaccard(spots(text), spots(after)),
        )
    return out


def test_equals_brute_force(documents):
    df = documents.filter("n_chars < 3000")
    want = brute(texts_of(df))
    got = op.edited_fingerprints(df).collect()
    assert len(got) == len(want)
    for r in got:
        n, sha, edited, following = want[r.doc_id]
        assert (r.n_chars, r.edited_sha256) == (n, sha)
        assert r.near_edited == pytest.approx(edited) and r.near_next == pytest.approx(following)


def test_equal_texts_have_equal_fingerprints(awkward):
    rows = op.edited_fingerprints(awkward).collect()
    assert len(rows) == awkward.count()
    by_id = {r.doc_id: r for r in rows}
    assert by_id[1].fingerprint == by_id[4].fingerprint and by_id[5].fingerprint == by_id[6].fingerprint
    assert by_id[2].fingerprint == by_id[3].fingerprint
    assert [r.edited_sha256 for r in rows if r.doc_id == 4] == [by_id[4].edited_sha256] * 2
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in rows)
    # the repeated row counts once: 5 is followed by 4, and 4 by 3
    assert (by_id[5].next_id, by_id[4].next_id, by_id[None].next_id) == (4, 3, 9)


def test_one_document_and_none(spark, documents):
    one = spark.createDataFrame([(7, "abcdefghi")], "doc_id long, text string")
    (row,) = op.edited_fingerprints(one).collect()
    assert row.edited_sha256 == hashlib.sha256(b"abcdefabc").hexdigest() and row.next_id == 7
    assert op.edited_fingerprints(documents.limit(0)).count() == 0


def test_near_pairs_equal_brute_force(documents):
    got = {(r.a, r.b): r.likeness for r in op.near_pairs(op.fingerprints(documents), 0.6).collect()}
    sets = {}
    for i, text in texts_of(documents):
        sets.setdefault(frozenset(spots(text)), i)
        sets[frozenset(spots(text))] = min(i, sets[frozenset(spots(text))])
    reps = sorted((i, s) for s, i in sets.items())
    want = {(i, j): jaccard(a, b) for i, a in reps for j, b in reps if i < j and jaccard(a, b) >= 0.6}
    assert set(got) == set(want) and all(got[p] == pytest.approx(want[p]) for p in want)


def test_plan_has_no_python(documents):
    plan = op.edited_fingerprints(documents)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "InPandas" not in plan and "Arrow" not in plan
