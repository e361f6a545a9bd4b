import random
from collections import defaultdict

import pytest
from helpers import rows
from pyspark.sql import functions as F

from claimlens.operators.lists import TextList, joined_chunks, list_and_sums, list_chunks, text_lists
from claimlens.operators.positions import AT, numbered


def hot_data(n=6000):
    rnd = random.Random(4)
    out = []
    for i in range(n):
        key = "hot" if i % 3 == 0 else rnd.choice([None, *[f"k{j}" for j in range(40)]])
        out.append((key, rnd.choice([None, *[f"v{j:04d}" for j in range(900)]]), rnd.randint(-5, 50), i))
    return out


SCHEMA = "k string, v string, n int, i int"


def test_numbers_follow_the_order(spark):
    data = hot_data()
    df = spark.createDataFrame(data, SCHEMA).repartition(9)
    got = {r.i: r.position for r in numbered(df, [F.desc_nulls_first("n"), F.asc("i")]).collect()}
    assert got == {d[3]: p for p, d in enumerate(sorted(data, key=lambda d: (-d[2], d[3])), 1)}


def test_numbers_within_keys_and_no_hot_partition(spark, tmp_path):
    data = hot_data()
    df = spark.createDataFrame(data, SCHEMA).repartition(9)
    folder = str(tmp_path / "numbered")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # small partitions stay apart, as large ones do
    try:
        got = {r.i: r.place for r in numbered(df, [F.asc_nulls_last("v"), F.asc("i")], "place", ["k"], folder).collect()}
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    want = {}
    groups = defaultdict(list)
    for d in data:
        groups[d[0]].append(d)
    for members in groups.values():
        for p, d in enumerate(sorted(members, key=lambda d: (d[1] is None, d[1] or "", d[3])), 1):
            want[d[3]] = p
    assert got == want
    # a third of the rows have one key; no partition holds much more than its share
    sizes = [r[1] for r in spark.read.parquet(folder).groupBy(F.shiftright(AT, 33)).count().collect()]
    assert len(sizes) == 4 and max(sizes) < 1.3 * len(data) / 4


@pytest.mark.parametrize("size", [1, 7, 100_000])
def test_chunks_are_the_list(spark, size):
    data = hot_data(2000)
    df = spark.createDataFrame(data, SCHEMA).repartition(6)
    lists = {"set": TextList(F.col("v"), "; "), "bag": TextList(F.col("v"), " | ", distinct=False, times=F.col("n") % 3 + 1)}
    df = df.filter("n >= 0")
    chunks = list_chunks(df, ["k"], lists, size).cache()
    assert rows(joined_chunks(chunks, ["k"], lists)) == rows(text_lists(df, ["k"], lists))
    sizes = chunks.groupBy("k", "list_name").agg(F.max("chunk").alias("last"), F.count("*").alias("n"), F.sum("items").alias("items"))
    assert all(r.last == r.n == -(-r["items"] // size) for r in sizes.collect())
    assert chunks.agg(F.max("items")).first()[0] <= size


def test_list_and_sums_equals_two_passes(spark):
    data = hot_data()
    df = spark.createDataFrame(data, SCHEMA).repartition(6).withColumn("amount", F.when(F.col("i") % 5 != 0, F.col("n").cast("decimal(18,2)")))
    for distinct in (True, False):
        spec = TextList(F.col("v"), "; ", distinct=distinct, times=None if distinct else F.lit(2))
        got = list_and_sums(df, ["k"], "vs", spec, {"total": F.col("amount") * F.col("n")})
        sums = df.groupBy("k").agg(F.sum(F.col("amount") * F.col("n")).alias("total"))
        lists = text_lists(df, ["k"], {"vs": spec}).withColumnRenamed("k", "lk")
        want = sums.join(lists, F.col("k").eqNullSafe(F.col("lk")), "left").select("k", "vs", "total")
        assert rows(got) == rows(want)
    nothing = spark.createDataFrame([("a", None, None)], "k string, v string, amount int")
    assert rows(list_and_sums(nothing, ["k"], "vs", TextList(F.col("v"), "; "), {"total": F.col("amount")})) == [("a", None, None)]


def test_list_and_sums_take_a_report_along(spark):
    data = hot_data()
    df = spark.createDataFrame(data, SCHEMA).repartition(6).filter("k is null or k <> 'k3'")
    spec, sums = TextList(F.col("v"), "; ", distinct=False, times=F.lit(2)), {"total": F.col("n")}
    report = df.select("k").distinct().union(spark.sql("select 'none' k")).withColumn("size", F.length("k")).withColumn("same", F.lit(1.5))
    got = list_and_sums(df, ["k"], "vs", spec, sums, report)
    assert got.columns == ["k", "size", "same", "vs", "total"]
    assert rows(got) == rows(report.join(list_and_sums(df, ["k"], "vs", spec, sums), "k", "left"))


def test_cells_are_made_of_pieces(spark):
    """A list of many pieces is whole, and no step holds its items one by one."""
    df = spark.range(5000).select(F.lit("a").alias("k"), F.format_string("v%05d", F.col("id")).alias("v")).repartition(6)
    cells = text_lists(df, ["k"], {"vs": TextList(F.col("v"), "; ")})
    assert rows(cells) == [("a", "; ".join(f"v{i:05d}" for i in range(5000)))]
    sums = list_and_sums(df, ["k"], "vs", TextList(F.col("v"), "; "), {"n": F.lit(1)})
    assert rows(sums) == [("a", "; ".join(f"v{i:05d}" for i in range(5000)), 5000)]
    for frame in (cells, sums):
        assert "flatten(" not in frame._jdf.queryExecution().optimizedPlan().toString()


def test_empty(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert numbered(df, [F.asc("i")]).count() == 0
    assert list_chunks(df, ["k"], {"set": TextList(F.col("v"), "; ")}).count() == 0
