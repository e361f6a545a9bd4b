import pytest

from claimlens.llm import op8_url_filter as op


@pytest.mark.parametrize(
    "url, want",
    [
        ("https://A.Example.NET/en/1?x=1", ("a.example.net", "/en/1", "example.net/en/", "allow")),
        ("http://x.net/fr/1", ("x.net", "/fr/1", "net/", "block")),
        ("http://net/", ("net", "/", "net/", "block")),
        ("http://x.net", ("x.net", "", None, "allow")),
        ("http://x.net?/en/", ("x.net", "", None, "allow")),
        ("http://planet/", ("planet", "/", None, "allow")),
        ("http://example.com/de/#a", ("example.com", "/de/", "example.com/de/", "block")),
        ("http://casino.org/fr/", ("casino.org", "/fr/", "org/fr/", "allow")),
        ("http://casino-win.example.com/en/", ("casino-win.example.com", "/en/", None, "block")),
        ("http://free-bets.example.com/", ("free-bets.example.com", "/", None, "block")),  # 0.5 and 1.5
        ("http://free-deals.example.com/buy", ("free-deals.example.com", "/buy", None, "allow")),  # 0.5, 0.75 and 0.5
        ("http://free.example.com/cheap-" + "x" * 50_000 + "/win?offer", ("free.example.com", "/cheap-" + "x" * 50_000 + "/win", None, "block")),
        ("http://freedom.example.com/bets", ("freedom.example.com", "/bets", None, "allow")),
        ("http://free.example.com/free", ("free.example.com", "/free", None, "allow")),
        ("http://ÀB.org/x://y/", ("Àb.org", "/x://y/", None, "allow")),
        ("no scheme casino", ("", "", None, "block")),
        ("", ("", "", None, "allow")),
        (None, ("", "", None, "allow")),
    ],
)
def test_verdicts(spark, url, want):
    df = spark.createDataFrame([(1, url, "casino", "h")], "page_id long, url string, rule string, host string")
    (row,) = op.url_verdicts(df).collect()
    assert (row.host, row.path, row.rule, row.verdict) == want


def test_rows_are_kept(spark):
    df = spark.createDataFrame([(1, "http://a.net/"), (1, "http://a.net/"), (None, None), (1 << 60, "http://b.org/")], "page_id long, url string")
    rows = op.url_verdicts(df).collect()
    assert sorted((r.page_id for r in rows), key=repr) == sorted([1, 1, None, 1 << 60], key=repr)
    assert op.url_verdicts(df.limit(0)).count() == 0


def test_weights_and_boundaries():
    a = op._automaton(op.Vocabulary(("bad",), (("half", 0.5), ("full", 1.5)), 2.0))
    assert op.vocabulary_hits(a, "half/full/half") == (False, 2.0)
    assert op.vocabulary_hits(a, "badly abad 1bad bad9") == (False, 0.0)
    assert op.vocabulary_hits(a, "x.BAD_y") == (True, 0.0)


def test_vocabulary_is_weighted():
    """No soft term rejects alone; the weights differ, and each term is written once in lower case."""
    terms = [t for t, _ in op.SOFT]
    assert len(set(terms)) == len(terms) and not set(terms) & set(op.STRICT) and len(set(op.STRICT)) == len(op.STRICT)
    assert len({w for _, w in op.SOFT}) >= 7 and all(0 < w < op.SOFT_LIMIT for _, w in op.SOFT)
    assert all(t == op._ascii_lower(t) and t.isalnum() for t in [*terms, *op.STRICT])
