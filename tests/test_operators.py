import random
from collections import defaultdict

from helpers import rows
from pyspark.sql import functions as F

from claimlens.operators.carry import carry_forward
from claimlens.operators.joins import absent, coalesced_full_join, column_lookup
from claimlens.operators.latest import latest_row_values, latest_rows
from claimlens.operators.lists import TextList, group_lists, list_items, text_lists
from claimlens.operators.state import insert_absent, update_from


def test_latest_keeps_ties_and_blanks_unknown(spark):
    df = spark.createDataFrame(
        [("a", 1, "x"), ("a", 2, "y"), ("a", 2, "z"), ("b", None, "p"), ("b", None, "q"), (None, 5, "n")],
        "k string, ts int, v string",
    )
    assert rows(latest_rows(df, ["k"], "ts")) == sorted(
        [("a", 2, "y"), ("a", 2, "z"), ("b", None, None), (None, None, None)], key=repr
    )
    assert rows(latest_rows(df, ["k"], "ts", blank_keys=True)).count((None, None, None)) == 2


def test_latest_row_values_is_one_row(spark):
    df = spark.createDataFrame([(1, 1, "x"), (1, 2, "a"), (1, 2, "b"), (2, None, "c")], "k int, ts int, v string")
    assert rows(latest_row_values(df, ["k"], "ts", ["v"])) == [(1, "b"), (2, "c")]


def hot_rows(n=4000, seed=7):
    """A third of the rows belong to one key; some keys and values are NULL."""
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        k = "hot" if i % 3 == 0 else rnd.choice([None, *[f"k{j}" for j in range(60)]])
        out.append((k, rnd.choice([None, *[f"v{j:03d}" for j in range(400)]]), rnd.choice(["p", "q", None])))
    return out


def brute_lists(data, sep):
    sets, bags, sizes = defaultdict(set), defaultdict(list), defaultdict(int)
    for k, v, w in data:
        sizes[k] += 1
        if v is not None:
            sets[k].add(v)
        if w is not None:
            bags[k].append(w)
    cell = lambda items: sep.join(sorted(items)) if items else None
    return sorted(((k, sizes[k], cell(sets[k]), cell(bags[k])) for k in sizes), key=repr)


def two_lists(sep):
    return {"vs": TextList(F.col("v"), sep), "ws": TextList(F.col("w"), sep, distinct=False)}


def test_group_lists_equals_brute_force(spark):
    data = hot_rows()
    df = spark.createDataFrame(data, "k string, v string, w string").repartition(8)
    assert rows(group_lists(df, ["k"], two_lists("; "), [F.count("*").alias("n")])) == brute_lists(data, "; ")


def test_text_lists_hold_every_item_of_a_hot_key(spark):
    data = hot_rows()
    df = spark.createDataFrame(data, "k string, v string, w string").repartition(8)
    want = [(k, v, w) for k, _, v, w in brute_lists(data, ";") if v or w]
    assert rows(text_lists(df, ["k"], two_lists(";"))) == want


def test_items_are_whole(spark):
    data = hot_rows()
    df = spark.createDataFrame(data, "k string, v string, w string")
    items = list_items(df, ["k"], two_lists(";"))
    want = defaultdict(int)
    for k, v, w in data:
        if v is not None:
            want[(k, "vs", v)] = 1
        if w is not None:
            want[(k, "ws", w)] += 1
    assert {tuple(r[:3]): r[3] for r in items.collect()} == dict(want)


def test_copies_weigh_in_bags(spark):
    df = spark.createDataFrame([("a", "x", 3), ("a", "y", 1), ("a", "x", 1)], "k string, v string, n int")
    spec = {"t": TextList(F.col("v"), "-", distinct=False, times=F.col("n"))}
    assert rows(text_lists(df, ["k"], spec)) == [("a", "x-x-x-x-y")]


def test_full_join_first_source_wins(spark):
    a = spark.createDataFrame([("1", "a", None), ("2", "b", "x"), (None, "n", "n")], "k string, p string, q string")
    b = spark.createDataFrame([("1", "A", "Q"), ("3", "C", None), (None, "m", "m")], "k string, p string, q string")
    assert rows(coalesced_full_join(a, b, ["k"])) == sorted(
        [("1", "a", "Q"), ("2", "b", "x"), ("3", "C", None), (None, "n", "n"), (None, "m", "m")], key=repr
    )


def test_column_lookup(spark):
    df = spark.createDataFrame([("TX", "yes", "no"), ("NY", "1", "2"), ("ZZ", "1", "2"), (None, "1", "2")], "s string, TX string, NY string")
    assert rows(df.select("s", column_lookup(F.col("s"), ["TX", "NY"]))) == sorted(
        [("TX", "yes"), ("NY", "2"), ("ZZ", None), (None, None)], key=repr
    )


def test_absent_ignores_copies_and_null(spark):
    left = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], "x int, y string")
    right = spark.createDataFrame([(1, "a")] * 50 + [(None, "c")], "x int, y string")
    assert rows(absent(left, right, ["x", "y"])) == sorted([(2, "b"), (None, "c")], key=repr)


def test_carry_forward_equals_a_loop(spark):
    rnd = random.Random(3)
    data, want = [], {}
    for source in ("a", "b", "c"):
        last, pos = None, 0
        for block in range(6):
            for _ in range(rnd.randint(1, 12)):
                pos += 1
                mark = f"{source}{pos}" if rnd.random() < 0.12 else None
                last = mark or last
                data.append((source, block, pos, mark))
                want[(source, pos)] = last
    rnd.shuffle(data)
    df = spark.createDataFrame(data, "file string, block int, pos int, mark string").repartition(5)
    got = carry_forward(df, "file", "block", "pos", F.col("mark"), "seen")
    assert {(r.file, r.pos): r.seen for r in got.collect()} == want


def test_insert_absent_takes_the_first_new_row(spark):
    state = spark.createDataFrame([(1, None), (2, "b")], "k int, n string")
    batch = spark.createDataFrame([(1, None, 9, "x"), (3, "c", 2, "late"), (3, "c", 1, "early")], "k int, n string, pos int, v string")
    assert rows(insert_absent(state, batch, ["k", "n"], ["pos"])) == [(3, "c", 1, "early")]


def test_update_from_changes_only_matches(spark):
    state = spark.createDataFrame([(1, "a", 1), (2, "b", None), (3, "c", 5)], "k int, v string, n int")
    source = spark.createDataFrame([(1, "A"), (2, "B")], "k int, new string")
    got = update_from(state, source, "k", F.col("n") > 0, {"v": F.col("new")}, "hit")
    assert rows(got) == [(1, "A", 1, True), (2, "b", None, False), (3, "c", 5, False)]
