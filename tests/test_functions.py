import datetime as dt

from pyspark.sql import functions as F

from claimlens.functions import validity as v
from claimlens.functions.dates import clean_date, on_day, run_stamp, years, younger_than, yyyymmdd
from claimlens.functions.flags import not_among, share, yes_no_null
from claimlens.functions.text import blank_to_null, json_record, json_text, labelled, pg_concat, pg_initcap, phone_digits
from claimlens.plans.consolidated import check_columns
from claimlens.plans.reconcile import grouped_amount


def one(spark, column):
    return spark.range(1).select(column).first()[0]


def each(spark, values, make, kind="string"):
    """``make`` applied to every value, in order."""
    df = spark.createDataFrame([(i, x) for i, x in enumerate(values)], f"i int, x {kind}")
    return [r[0] for r in df.orderBy("i").select(make(F.col("x"))).collect()]


def test_concat_skips_null(spark):
    none = F.lit(None).cast("string")
    assert one(spark, pg_concat("a", none, F.lit(3))) == "a3"
    assert one(spark, pg_concat(none, none)) == ""
    assert one(spark, labelled("dob ", none)) is None


def test_initcap_starts_words_after_any_symbol(spark):
    got = each(spark, ["mary-ann o'neil", "ST. JOHN 2nd", "josé maría muñoz-ärzte", None, ""], pg_initcap)
    assert got == ["Mary-Ann O'Neil", "St. John 2nd", "José María Muñoz-Ärzte", None, ""]


def test_clean_date_reads_four_encodings(spark):
    got = each(spark, ["2024-01-05", "20240105", "", "/  /", None, "no"], clean_date)
    good = dt.date(2024, 1, 5)
    assert got == [good, good, None, None, None, None]
    chain = clean_date(F.lit("/  /"), F.lit(""), F.lit("20240203"), F.lit("2020-01-01"))
    assert one(spark, chain) == dt.date(2024, 2, 3)


def test_day_arithmetic(spark):
    a, b = F.lit(dt.date(2024, 1, 1)), F.lit(dt.date(1990, 1, 1))
    assert one(spark, years(a, b)) == (dt.date(2024, 1, 1) - dt.date(1990, 1, 1)).days // 365
    assert one(spark, years(b, a)) == -((dt.date(2024, 1, 1) - dt.date(1990, 1, 1)).days // 365)
    assert one(spark, yyyymmdd(F.lit(20240115))) == dt.date(2024, 1, 15)
    assert one(spark, yyyymmdd(F.lit(1))) is None


def test_age_filter_equals_day_difference(spark):
    as_of = dt.date(2024, 6, 30)
    stamps = [dt.datetime(2024, 6, 30) - dt.timedelta(hours=h) for h in range(0, 24 * 12, 5)]
    df = spark.createDataFrame([(s,) for s in stamps], "x timestamp")
    for days in (1, 3, 10):
        plain = df.filter(F.datediff(F.lit(as_of), F.to_date("x")) < days)
        assert df.filter(younger_than(F.col("x"), as_of, days)).count() == plain.count()
    assert df.filter(on_day(F.col("x"), as_of)).count() == 1
    assert df.filter(on_day(F.col("x"), dt.date(2024, 6, 29))).count() == sum(s.date() == dt.date(2024, 6, 29) for s in stamps)


def test_run_stamp_zone(spark):
    assert one(spark, run_stamp(dt.datetime(2024, 1, 1, 3, 4), "America/New_York")) == "20231231_2204"


def test_flags(spark):
    f = lambda a, b: one(spark, yes_no_null(F.lit(a).cast("int") < F.lit(b).cast("int"), F.lit(a), F.lit(b)))
    assert [f(1, 2), f(2, 1), f(None, 1), f(1, None)] == ["Y", "N", None, None]
    s = lambda a, b: one(spark, share(F.lit(a), F.lit(b)))
    assert float(s(1, 8)) == 0.13 and float(s(29, 200)) == 0.15 and s(1, 0) is None
    df = spark.createDataFrame([(1,), (2,), (None,)], "c int")
    assert df.filter(not_among(F.col("c"), [])).count() == 3
    assert df.filter(not_among(F.col("c"), [1])).count() == 1


def test_json(spark):
    docs = ['{"k": "a"}', '{"k": ""}', '{"k": null}', "{}", '{"k": 7}']
    want = ["a", "", None, None, "7"]
    assert each(spark, docs, lambda x: json_text(x, "k")) == want
    assert each(spark, docs, lambda x: json_record(x, "k", "other")["k"]) == want
    assert each(spark, ["", "/  /", "x"], lambda x: blank_to_null(x, "/  /")) == [None, None, "x"]


def test_address_rule(spark):
    df = spark.createDataFrame([("Po Box 1",), ("unk street",), ("",), ("12 Main St",), (None,)], "x string")
    flags = [
        r[0]
        for r in df.groupBy("x")
        .agg(v.valid_address(F.bool_or(v.bad_address(F.col("x"))), F.bool_or(v.says_something(F.col("x")))).alias("f"))
        .orderBy(F.asc_nulls_last("x"))
        .select("f")
        .collect()
    ]
    assert flags == [0, 1, 0, 0, 0]  # '', 12 Main St, Po Box 1, unk street, NULL


def test_phone_rule(spark):
    values = ["(555) 555-5555", "0125551234", "1125551234", "2120551234", "2121551234", "(212) 555-1234", "", None]
    clean = lambda x: blank_to_null(phone_digits(x))
    flag = lambda x: v.valid_phone(clean(x), v.repeats_one_digit(clean(x)))
    assert each(spark, values, flag) == [0, 0, 0, 0, 0, 1, 0, 0]
    assert each(spark, ["2125551234; 0000000000"], lambda x: v.valid_phone(x, v.repeats_one_digit(x))) == [0]


def test_ssn_rule(spark):
    values = ["900123456", "666123456", "000123456", "123004567", "123450000", "123456789", "", None]
    assert each(spark, values, v.valid_ssn) == [0, 0, 0, 0, 0, 1, 0, 0]
    assert each(spark, ["123004567"], lambda x: v.valid_ssn(x, strict=False)) == [1]


def test_check_notes(spark):
    notes = ["payment of $1,234.50, check # 998877", "payment of $10 by wire check", "Check # 5", "PAYMENT OF $7 CHECK # 12", None]
    assert each(spark, notes, lambda x: check_columns(x)[0]) == ["998877", None, None, "12", None]
    assert each(spark, notes, lambda x: check_columns(x)[1]) == ["1", None, None, "7 CHECK # 12", None]


def test_grouped_amount(spark):
    got = each(spark, [1234, 5, -1234, 999999, 1000000, None], grouped_amount, "int")
    assert got == ["   1,234", "       5", "  -1,234", " 999,999", " ###,###", None]
