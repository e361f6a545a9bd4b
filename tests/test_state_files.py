"""The snapshot log, id lists, sheet contracts and file round trips."""

import datetime as dt
import os

import pytest
from helpers import dicts, frame, rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimlens import schemas
from claimlens.functions.dates import run_stamp
from claimlens.operators.ids import kept_ids, left_out_ids
from claimlens.plans.bills import prepare_bills
from claimlens.plans.opportunity import payer_opportunity
from claimlens.plans.quality import account_quality
from claimlens.plans.traits import account_traits
from claimlens.plans.workbooks import sheet_contracts, write_daily
from claimlens.sinks.bundle import ContractError, sheet_listing, write_bundle
from claimlens.sinks.csv_files import write_counted, write_csv
from claimlens.sinks.files import Files, shared_folder, stamp
from claimlens.sinks.snapshots import BrokenLog, Conflict, SnapshotTable
from claimlens.sources.alert_text import parse_key_lines, read_key_lines, rejected_keys
from claimlens.sources.csv_files import read_csv

STATE = T.StructType([T.StructField("id", T.LongType()), T.StructField("done", T.BooleanType())])


def table_of(spark, tmp_path):
    return SnapshotTable(spark, str(tmp_path / "state"), STATE)


def state(spark, *pairs):
    return spark.createDataFrame(list(pairs), STATE)


def files_of(table, run):
    return sorted(os.path.join(d, f) for d, _, fs in os.walk(f"{table.root}/data/_run={run}") for f in fs if f.endswith(".parquet"))


def test_settled_rows_are_not_written_again(spark, tmp_path):
    table = table_of(spark, tmp_path)
    done = F.col("done")
    assert (table.version(), table.read().count(), table.unsettled().count()) == (0, 0, 0)
    first = table.stage(state(spark, (1, True), (2, False), (3, None), (4, True)), done)
    assert table.version() == 0 and table.after(first).count() == 4 and table.commit(first) == 1
    assert rows(table.unsettled()) == [(2, False), (3, None)]
    changed = table.unsettled().withColumn("done", F.col("done").isNotNull()).withColumn("moved", F.col("id") == 2)
    second = table.stage(changed.unionByName(state(spark, (5, False)).withColumn("moved", F.lit(True))), done)
    assert table.commit(second) == 2
    assert rows(table.read()) == [(1, True), (2, True), (3, False), (4, True), (5, False)]
    assert rows(table.read(1)) == [(1, True), (2, False), (3, None), (4, True)]
    flags = T.StructType([T.StructField("moved", T.BooleanType())])
    assert rows(table.staged(second, flags)) == [(2, True, True), (3, False, False), (5, False, True)]
    assert [r[2] for r in rows(table.read_with(flags))] == [None, True, False, None, True]
    assert table.at().runs == (first, second)
    assert table.compact(done) == 3
    assert len(table.at().runs) == 1 and rows(table.read()) == rows(table.read(2)) and rows(table.unsettled()) == [(3, False), (5, False)]


def test_second_of_two_writers_fails(spark, tmp_path):
    mine, other = table_of(spark, tmp_path), table_of(spark, tmp_path)
    mine.publish(state(spark, (1, False)))
    a, b = mine.stage(mine.unsettled(), F.col("done")), other.stage(state(spark, (9, True)), F.col("done"))
    assert other.commit(b) == 2
    with pytest.raises(Conflict):
        mine.commit(a)
    assert rows(mine.read()) == [(9, True)] and mine.abandoned() == [a]
    again = mine.stage(mine.unsettled(), F.col("done"))
    assert mine.commit(again) == 3 and rows(mine.read()) == [(9, True)]


def test_dead_run_leaves_the_old_version(spark, tmp_path):
    table = table_of(spark, tmp_path)
    table.publish(state(spark, (1, False)))

    def broken(_):
        raise ValueError("executor lost")

    bad = state(spark, (2, False)).select("id", F.udf(broken, "boolean")("done").alias("done"))
    with pytest.raises(Exception, match="executor lost"):
        table.publish(bad)
    assert table.version() == 1 and rows(table.read()) == [(1, False)]
    assert len(table.abandoned()) == 1


def test_broken_log_is_no_empty_table(spark, tmp_path):
    table = table_of(spark, tmp_path)
    table.publish(state(spark, (1, False)))
    table.publish(state(spark, (2, False)))
    log = tmp_path / "state" / "log"
    text = (log / "000000000001.json").read_text()
    for name in os.listdir(log):
        if name.startswith("."):
            os.remove(log / name)  # checksums of the local file system
    (log / "000000000001.json").unlink()
    with pytest.raises(BrokenLog):
        table.read()
    (log / "000000000001.json").write_text(text)
    assert rows(table.read()) == [(2, False)]
    (log / "000000000002.json").write_text("{")
    for broken in (table.read, table.unsettled, table.abandoned):
        with pytest.raises(BrokenLog):
            broken()
    for name in os.listdir(log):
        os.remove(log / name)
    with pytest.raises(BrokenLog):
        table.version()
    with pytest.raises(ValueError):
        SnapshotTable(spark, str(tmp_path / "new"), STATE).read(1)


def test_file_is_made_once(spark, tmp_path):
    files = Files(spark, str(tmp_path))
    path = str(tmp_path / "log" / "1.json")
    assert files.create_once(path, "é1") and not files.create_once(path, "2")
    assert files.read(path) == "é1" and files.names(str(tmp_path / "log")) == ["1.json"]
    assert files.names(str(tmp_path / "none")) == []


def test_shared_folder(spark):
    class Fake:
        def __init__(self, **conf):
            self.conf = conf

    def folder(master, shared=""):
        session = Fake()
        session.conf = {"spark.master": master, "spark.checkpoint.dir": shared}
        return shared_folder(session, "x")

    assert folder("local[8]").startswith("/tmp/")
    assert folder("yarn", "hdfs://shared/dir/").startswith("hdfs://shared/dir/claimlens-x-")
    for master in ("yarn", "spark://host:7077", "local-cluster[3,2,3000]", ""):
        with pytest.raises(RuntimeError):
            folder(master)


def test_id_lists_with_null(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "d")], "id int, v string")
    ids = lambda *values: spark.createDataFrame([(v,) for v in values], "cid int")
    letters = lambda out: "".join(r.v for r in out.orderBy("v").collect())
    for listed in (lambda *v: list(v), ids):
        assert letters(kept_ids(df, "id", listed(1, 1, None))) == "ab"
        assert letters(kept_ids(df, "id", listed(None))) == ""
        assert letters(kept_ids(df, "id", listed())) == ""
        assert letters(left_out_ids(df, "id", listed(1, 1))) == "c"
        assert letters(left_out_ids(df, "id", listed(2, None))) == ""
        assert letters(left_out_ids(df, "id", listed())) == "abcd"
    assert letters(kept_ids(df, "id", None)) == "abcd"


def test_key_lines_and_rejects(spark, tmp_path):
    path = tmp_path / "keys.txt"
    path.write_text("1000001\n1000002  \ncomment\n1000003 done\n12345678\n1000001\n\n   \n1000004\t\n1000005-1\n")
    parsed = read_key_lines(spark, str(path))
    assert sorted({r.pm_sk for r in parsed.collect() if r.reject is None}) == [1000001, 1000002, 1000004]
    assert rows(rejected_keys(parsed)) == [
        ("1000003 done", "text after the key"),
        ("1000005-1", "text after the key"),
        ("12345678", "does not start with a key"),
        ("comment", "does not start with a key"),
    ]
    assert parse_key_lines(spark.createDataFrame([(None,)], "line string")).count() == 0


def test_csv_round_trip(spark, tmp_path):
    schema = "a string, b int, c string, d date, e decimal(18,2)"
    records = [
        (None, None, None, None, None),
        ("", 1, " ", dt.date(2024, 1, 2), None),
        ('say "hi", you', 2, "one\ntwo", None, None),
        ('"', 3, "cr\r\nlf", None, None),
        (" padded ", 4, ",", None, None),
        ("é😀", 5, "\\", None, None),
        ("ends with \\", 6, "None", None, None),
    ]
    df = spark.createDataFrame(records, schema)
    for name, sep in (("lf", None), ("crlf", "\r\n")):
        write_csv(df.repartition(3), str(tmp_path / name), line_sep=sep)
        assert rows(read_csv(spark, str(tmp_path / name), df.schema)) == rows(df)


def test_count_and_preview_of_what_was_written(spark, tmp_path):
    df = spark.range(1000).withColumn("v", F.col("id") % 7).repartition(5)
    first, n = write_counted(df, str(tmp_path / "out"), 3, [F.desc("v"), F.asc("id")])
    assert n == 1000 and [tuple(r) for r in first.collect()] == [(6, 6), (13, 6), (20, 6)]
    assert write_counted(df.limit(0), str(tmp_path / "none"))[1] == 0


def test_sheet_contract_is_checked(spark, tmp_path):
    df = spark.sql("select 'a' name, 1 n, 0.5 share, date'2024-01-01' d")
    contract = {"s": (("name", "text"), ("n", "number"), ("share", "percent"), ("d", "date"))}
    paths = write_bundle({"s": df}, str(tmp_path), contracts=contract, run=stamp(dt.datetime(2024, 1, 5, 8, 30)))
    assert paths == {"s": f"{tmp_path}/20240105_0830/s"}
    listing = sheet_listing(spark.read.parquet(paths["s"]))
    assert [tuple(r) for r in listing.collect()] == [
        (1, "name", "text", 1, 1), (2, "n", "number", 1, 1), (3, "share", "percent", 1, 1), (4, "d", "date", 1, 1),
    ]
    for wrong in (
        (("n", "number"), ("name", "text"), ("share", "percent"), ("d", "date")),
        (("name", "number"), ("n", "number"), ("share", "percent"), ("d", "date")),
        (("name", "text"), ("n", "number"), ("share", "percent")),
    ):
        with pytest.raises(ContractError):
            write_bundle({"s": df}, str(tmp_path / "wrong"), contracts={"s": wrong})
    with pytest.raises(ContractError):
        write_bundle({"s": df}, str(tmp_path / "wrong"), contracts={"t": contract["s"]})
    assert not (tmp_path / "wrong").exists()


@pytest.mark.parametrize("scope", ["all", "not_billed", "no_fax"])
def test_daily_books_keep_their_contracts(spark, tmp_path, make, scope):
    t = make(pre_billing=[{"pm_sk": 1, "pat_acct": "A", "status": "W", "cust_id": 1, "created_at": "2024-01-01T00:00:00", "content": "{}"}])
    paths = write_daily(t, scope, dt.datetime(2024, 1, 5, 23, 30), str(tmp_path), zone="America/New_York")
    assert list(paths) == list(sheet_contracts(scope)) and all("/20240105_1830/" in p for p in paths.values())


@pytest.mark.parametrize("scope", ["all", "not_billed", "no_fax"])
def test_payer_sheets_hold_one_payer_in_a_file(spark, tmp_path, make, scope):
    """A payer's lists have no bound, so neither a task that writes nor one that reads gets those of several payers."""
    row = {"status": "W", "cust_id": 1, "created_at": "2024-01-01T00:00:00", "content": "{}"}
    t = make(
        pre_billing=[{"pm_sk": i, "pat_acct": f"A{i % 3}", "insurance_name": f"P{i % 6}" if i % 6 else None, "charges": i, **row} for i in range(24)],
        payments_a=[{"pat_acct": f"A{i}", "insurance_name": "P1", "payment": 5, "duplicate_payment": False, "not_billed": True} for i in range(3)],
    )
    path = write_daily(t, scope, dt.datetime(2024, 1, 5, 8, 30), str(tmp_path))["opportunity_by_insurance"]
    sheet = spark.read.parquet(path)
    assert [r.n for r in sheet.groupBy(F.input_file_name()).agg(F.count("*").alias("n")).collect()] == [1] * 6
    names = sorted(os.listdir(path))
    order = [r.insurance_name for name in names if name.startswith("part") for r in spark.read.parquet(f"{path}/{name}").collect()]
    assert order == [r.insurance_name for r in payer_opportunity(t, scope).collect()] and len(set(order)) == 6


def test_prepared_bills_give_the_same_reports(spark, tmp_path, make):
    content = '{"patient_dob": "1980-01-01", "patient_gender": "F", "patient_addr1": "1 Main", "patient_phone": "", "facility_state": ""}'
    bill = {"cust_id": 1, "pat_acct": "A", "total_charges": 10, "created_at": "2024-01-05T00:00:00", "admission_date": "2024-01-01"}
    t = make(
        client_raw_bills=[{**bill, "content": content, "claim_content": '{"patient_phone": "2123456789"}'}, {**bill, "content": "broken"}],
        raw_bills=[{"pat_acct": "B", "gross_charges": 5, "created_at": "2024-01-05T00:00:00", "content": '{"patient_gender": "M"}'}],
    )
    p = prepare_bills(t, str(tmp_path / "bills"))
    assert "content" not in p["client_raw_bills"].columns
    assert rows(account_traits(p)) == rows(account_traits(t)) and rows(account_quality(p)) == rows(account_quality(t))
    plan = account_traits(p)._jdf.queryExecution().executedPlan().toString()
    assert "from_json" not in plan and "patient_addr1" not in plan  # only the fields that the report names are read


def test_stamps_agree(spark):
    moment = dt.datetime(2024, 7, 1, 3, 4, 5)
    df = spark.createDataFrame([(moment,)], "at timestamp")
    for zone in ("UTC", "America/New_York"):
        assert df.select(run_stamp(F.col("at"), zone)).first()[0] == stamp(moment, zone)
    assert dicts(frame(spark, schemas.TABLES["account_statuses"], [])) == []
