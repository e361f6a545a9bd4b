import re
import textwrap

import pytest

from claimlens.llm import op7_license_scan as op
from llm_helpers import texts_of


@pytest.fixture(scope="module")
def model(documents):
    return op.train(documents)


def test_families_of_variations_kept_from_training(model):
    notices = {
        "apache-2.0": "this file is licensed under the apache license version 2.0",
        "mit": "Code: Released under the MIT License.",
        "gpl": "This WORK is licensed under the GNU General Public License, version 3",
        "cc-by-nc": "licensed under cc by-nc 4.0",
        "bsd": "redistribution and use in source and binary forms, with or without modification, are permitted provided that these conditions hold",
    }
    assert {f: (model.judge(t) or (None,))[0] for f, t in notices.items()} == {f: f for f in notices}
    assert model.judge("Licensed under the Foobar Special License, version 9.")[0] == "unknown"
    for plain in ("The general went to the public house.", "MIT der und die", "", "Version 2.0 is here."):
        assert model.judge(plain) is None


def test_sample_finds_every_planted_line(documents, model):
    planted = re.compile(r"^(Licensed under |Released under the MIT|This work is licensed under )")
    want = {(i, n) for i, t in texts_of(documents) for n, p in enumerate(t.split("\n")) if planted.match(p)}
    got = op.licence_paragraphs(documents, model).collect()
    assert want and want <= {(r.doc_id, r.paragraph) for r in got}
    texts = dict(texts_of(documents))
    for r in got:
        assert texts[r.doc_id].split("\n")[r.paragraph] == texts[r.doc_id][r.start : r.end]
        assert re.search("licen|rights", texts[r.doc_id][r.start : r.end], re.I)


def test_skipping_equals_scoring_every_paragraph(documents, model):
    for _, text in texts_of(documents.limit(80)):
        for p in text.split("\n"):
            words = op._words(p.lower())
            scored = bool(words) and 1 - model.probabilities(words)[0] >= op.LICENCE_PROBABILITY
            assert scored == bool(model.judge(p))


def test_awkward_rows(awkward, model):
    assert op.licence_paragraphs(awkward, model).count() == 0
    assert op.licence_paragraphs(awkward).count() == 0
    assert op.licence_paragraphs(awkward.limit(0)).count() == 0


def test_hard_wrapped_notices_keep_their_family(spark, model):
    """Notices over several lines are found as one paragraph."""
    rows = []
    for i, (family, width) in enumerate([("mit", 70), ("gpl", 60), ("bsd", 50)]):
        rows.append((i, "A heading\n\n" + "\n".join(textwrap.wrap(op.TEMPLATES[family][-1], width)) + "\n\nOrdinary words."))
    got = op.licence_paragraphs(spark.createDataFrame(rows, "doc_id long, text string"), model).collect()
    assert {(r.doc_id, r.paragraph): r.family for r in got if r.family != "unknown"} == {(0, 2): "mit", (1, 2): "gpl", (2, 2): "bsd"}
    for r in got:
        assert rows[r.doc_id][1].find("\n\n") < r.start < r.end <= rows[r.doc_id][1].rfind("\n\n")


# notices and sentences that the model was not trained on
UNKNOWN = [
    "Distributed under the ISC License.", "Licensed under the Foobar Special License, version 9.", "Released under the terms of the Frobnitz License.",
    "This module is distributed under the Q Public License.", "Copyright Acme. Licensed for evaluation only.", "Made available under the Clear BSD-like Licence of the institute.",
    "Use of this package is governed by the Initech license agreement.", "Permission to copy and distribute this document is hereby granted by its owner.",
]
PLAIN = [
    "The license plates of both cars were stolen.", "He lost his driving licence last year.", "They fight for the rights of the workers.",
    "She asked her mother for permission to stay out.", "The general public likes the new version.", "All rights and wrongs aside, the house was warm.",
    "The apache tribe lived in the open country.", "A free copy of the book lay under the table.", "The mit der und die", "Version 2.0 is here.",
    "It is subject to the weather.", "No part of the road was dry.", "Creative people and common sense", "Two modifications in source and form of the dress",
]


def test_held_out_precision_and_recall(model):
    """Unknown licences against ordinary sentences with the same words, and calibration on both."""
    p = lambda t: 1 - model.probabilities(op._words(t.lower()))[0]
    found = [model.judge(t) for t in UNKNOWN]
    wrong = [t for t in PLAIN if model.judge(t)]
    assert sum(f is not None and f[0] == "unknown" for f in found) >= 0.75 * len(UNKNOWN), [t for t, f in zip(UNKNOWN, found) if not f]
    assert len(wrong) <= 0.15 * len(PLAIN), wrong
    mean = lambda texts: sum(map(p, texts)) / len(texts)
    assert mean(UNKNOWN) > 0.7 and mean(PLAIN) < 0.25


def test_sample_does_not_vanish_with_size(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(op, "SAMPLE_DOCUMENTS", 20)
    monkeypatch.setattr(op, "fit", lambda paragraphs: seen.append(paragraphs))
    op.train(spark.range(3000).selectExpr("id as doc_id", "concat('text ', id % 2000) as text"))
    assert len(seen[0]) == len(set(seen[0])) == 20
