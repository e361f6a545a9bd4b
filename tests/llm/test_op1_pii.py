import hashlib
import re

from claimlens.llm import op1_pii as op
from llm_helpers import texts_of

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    doubled = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
    return sum(x - 9 * (x > 9) for x in doubled) % 10 == 0


def brute(text):
    counts, spans = [], []
    for rank, (kind, pattern) in enumerate(PLAIN.items()):
        n = 0
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            if kind == "ip" and any(int(p) > 255 for p in m.group().split(".")):
                continue
            if kind == "card" and not (12 <= len(digits) <= 19 and luhn(digits)):
                continue
            if kind == "phone" and not 9 <= len(digits) <= 15:
                continue
            n += 1
            spans.append((m.start(), rank, m.end(), kind))
        counts.append(n)
    return counts, ",".join(f"{k}:{a}:{b}" for a, _, b, k in sorted(spans))


def base_of(row):
    return ",".join(s for s in row.spans.split(",") if s.split(":")[0] in PLAIN)


def test_base_spans_equal_the_plain_patterns(spark, documents):
    tricky = ["a@b.c_d@e.f", "x@y.z%p@q.r", "1.2.3.4.5.6.7.8", "256.1.1.1", "12 34-5", "+1+44 20 7946 0958", "@@a@b", ".a@-.-", "+(1)", "001.002.003.004"]
    df = documents.select("doc_id", "text").union(spark.createDataFrame(list(enumerate(tricky, 10_000)), "doc_id long, text string"))
    want = {i: brute(t) for i, t in texts_of(df)}
    for row in op.personal_data(df).collect():
        counts, spans = want[row.doc_id]
        assert [row.n_email, row.n_ip, row.n_card, row.n_phone] == counts
        assert base_of(row) == spans and row.base_sha256 == hashlib.sha256(spans.encode()).hexdigest()


def test_awkward_rows(awkward):
    rows = op.personal_data(awkward).collect()
    assert len(rows) == awkward.count()
    assert {r.doc_id for r in rows if r.n_email} == {8}
    clean = op.sanitised(awkward)
    assert clean.columns == awkward.columns and clean.count() == awkward.count()
    (eight,) = clean.filter("doc_id = 8").collect()
    assert eight.text == "é😀 ß\u0301 [EMAIL], [PHONE], [IP], [CARD]"


def test_terms_that_disclose_an_entity(spark):
    """A word seen only beside one address is removed, in all documents that hold the address."""
    rows = [(i, f"note {i} zebrafish project of team{i} mail boss@corp.example.org today") for i in range(6)]
    rows += [(100 + i, f"mail someone about the project of team today note {i}") for i in range(60)]
    rows += [(200 + i, f"note {i} mail other{i}@corp.example.org today") for i in range(6)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r for r in op.personal_data(df).collect()}
    assert all("remove:" in got[i].spans and got[i].n_terms == 1 for i in range(6))
    assert not any(got[i].n_terms for i in got if i >= 100)
    clean = {r.doc_id: r.text for r in op.sanitised(df).collect()}
    assert clean[3] == "note 3  project of team3 mail [EMAIL] today"
    # copies of one text prove nothing
    copies = spark.createDataFrame([(i, "zebrafish mail boss@corp.example.org") for i in range(9)] + rows[6:], "doc_id long, text string")
    assert not any(r.n_terms for r in op.personal_data(copies).collect())


def test_empty_table(documents):
    none = documents.limit(0)
    assert op.personal_data(none).count() == 0 and op.sanitised(none).count() == 0


def test_plan_has_no_python(documents):
    plan = op.personal_data(documents)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "InPandas" not in plan and "Arrow" not in plan


def test_copies_do_not_dilute_terms(spark):
    """A text copied 300 times counts once for its terms, as it does for its contexts."""
    rows = [(i, f"note {i} zebrafish project of team{i} mail boss@corp.example.org today") for i in range(6)]
    rows += [(100 + i, f"mail someone about the project of team today note {i}") for i in range(60)]
    rows += [(1000 + i, rows[0][1]) for i in range(300)]
    got = {r.doc_id: r for r in op.personal_data(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all("remove:" in got[i].spans and got[i].n_terms == 1 for i in got if i < 6 or i >= 1000)
    assert not any(got[i].n_terms for i in got if 100 <= i < 1000)


def test_terms_of_the_whole_text_and_of_few_contexts(spark):
    """Two texts are enough for a term that nothing else holds, however far it stands from the entity; one is not."""
    far = " ".join(f"the common line of text {i}" for i in range(40))
    rows = [(i, f"zebrafish note {i}. {far} mail boss{i}x@corp.example.org, then write to chief@corp.example.org {i}") for i in range(2)]
    rows += [(10, f"okapi {far} mail alone@corp.example.org")]
    rows += [(100 + i, f"{far} mail then write to note number {i}") for i in range(300)]
    got = {r.doc_id: r for r in op.personal_data(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all(got[i].n_terms == 1 and "remove:0:9" in got[i].spans for i in range(2))
    assert not any(got[i].n_terms for i in got if i >= 10)


def test_near_copies_with_equal_contexts_prove_nothing(spark):
    """Texts that differ only far from the entity have one context."""
    far = " ".join(f"the common line of text {i}" for i in range(40))
    rows = [(i, f"number {i} {far} zebrafish mail boss@corp.example.org today") for i in range(9)]
    rows += [(100 + i, f"{far} mail today number {i}") for i in range(300)]
    assert not any(r.n_terms for r in op.personal_data(spark.createDataFrame(rows, "doc_id long, text string")).collect())
