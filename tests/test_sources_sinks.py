from helpers import day, dicts, frame, rows
from pyspark.sql import functions as F

from claimlens import Tables, schemas
from claimlens.plans.traits import payer_capability, unmatched_payers
from claimlens.sinks.bundle import write_bundle
from claimlens.sinks.charts import chart_points
from claimlens.sinks.csv_files import preview, write_csv, write_plain
from claimlens.sinks.snapshots import SnapshotTable
from claimlens.sources.alert_text import good_lines, read_alerts, read_keys, rejected_lines
from claimlens.sources.csv_files import read_csv_text, read_payer_list, read_remittances
from claimlens.sources.tables import sql_frame

TEXT = """Team North
 1000001, 2000001, A001 - A7 > missing claim number
 1000002, 2000002, A002 - P1 > pending > second look

 1000009, 2000009, A-9 - F1 > dash-ed
Customer
 1000003, 2000003, A003 - F4 > A7:35
 1000004, 2000004, A004 - no code
 1000005, bad, A005 - P1 > x
"""


def test_alert_text(spark, tmp_path):
    path = tmp_path / "alerts_20240115.txt"
    path.write_text(TEXT)
    parsed = read_alerts(spark, str(path))
    d = day("2024-01-15")
    got = rows(good_lines(parsed).select("pm_sk", "src_sk", "pat_acct", "note", "code", "assigned", "effective_date"))
    assert got == [
        (1000001, 2000001, "A001", "A7 - missing claim number", "277-A7", "Team North", d),
        (1000002, 2000002, "A002", "P1 - pending - second look", "277-P1 - pending", "Team North", d),
        (1000003, 2000003, "A003", "F4 - A7:35", "277-F4", "Customer", d),
        (1000009, 2000009, "A-9", "F1 - dashed", "277-F1", "Team North", d),
    ]
    assert [r[-1] for r in rows(rejected_lines(parsed).select("line", "reject"))] == [
        "message has no code",
        "keys cannot be read",
    ]


def test_headings_cross_splits(spark, tmp_path):
    """A file cut into many splits gives the same result as one split."""
    lines = []
    for team in range(3):
        lines.append(f"Team {team}")
        lines += [f" {1000000 + team * 400 + i}, 1, A{i} - F{i % 3} > note" for i in range(400)]
    path = tmp_path / "alerts_20240116.txt"
    path.write_text("\r\n".join(lines))
    key = "spark.sql.files.maxPartitionBytes"
    old = spark.conf.get(key)
    try:
        spark.conf.set(key, "4000")
        parsed = read_alerts(spark, str(path))
        assert parsed.select("block").distinct().count() > 3
        got = {r.pm_sk: r.assigned for r in parsed.collect()}
    finally:
        spark.conf.set(key, old)
    assert got == {1000000 + t * 400 + i: f"Team {t}" for t in range(3) for i in range(400)}


def test_key_list(spark, tmp_path):
    path = tmp_path / "keys.txt"
    path.write_text("1000001\n1000002  \ncomment\n1000003 done\n12345678\n1000001\n")
    assert rows(read_keys(spark, str(path))) == [(1000001,), (1000002,)]


def test_payer_list_and_capability(spark, tmp_path):
    path = tmp_path / "payers.csv"
    path.write_text(
        "Clearinghouse,House ID,Payer ID,Payer Name,WC,Auto,1500,835,TX,NY,Liability,Last Updated\n"
        "c,1,E1,Alpha,N,Y,Y,N,yes,,x,d\n"
        "c,2,E1,Alpha two,Y,N,Y,N,no,maybe,x,d\n"
        "c,3,,Nameless,Y,Y,Y,Y,yes,yes,x,d\n"
    )
    payers = read_payer_list(spark, str(path), ["House_ID"])
    assert payers.columns == ["edi_payer_id", "work_comp", "auto", "prof_1500", "response_all_835", "TX", "NY"]
    assert rows(payers) == [("E1", "Y", "Y", "Y", "N", "yes", "maybe")]
    traits = spark.createDataFrame(
        [(1, "TX", "E1"), (2, "CA", "E1"), (3, None, "E1"), (4, "NY", "E1;  E2"), (5, "NY", None)],
        "pm_sk int, accident_state string, edi_payer_id string",
    )
    got = payer_capability(traits, payers)
    assert got.columns[:4] == ["pm_sk", "accident_state", "accident_state_covered", "edi_payer_id"]
    assert got.columns[-2:] == ["rej_den_clearing_house", "den_payer"]
    assert {r.pm_sk: r.accident_state_covered for r in got.collect()} == {1: "yes", 2: None, 3: None, 4: None, 5: None}
    assert rows(unmatched_payers(traits, payers)) == [("E1;  E2", 1)]


def test_doubled_quotes_in_csv(spark, tmp_path):
    path = tmp_path / "payers.csv"
    path.write_text('Payer ID,Payer Name,TX\nE1,"Acme ""Best"", Inc",yes\n')
    assert rows(read_csv_text(spark, str(path))) == [("E1", 'Acme "Best", Inc', "yes")]


def test_remittance_csv(spark, tmp_path):
    path = tmp_path / "remit.csv"
    path.write_text(
        "cust_id,Patient Account #,Payer,Charged,Paid Amt,Pay Date,ANSI Codes,EFT Check#,Extra\n"
        '7,0012,P1,100.50,2.5,20240105,"CO1,2",55,z\n'
    )
    (r,) = dicts(read_remittances(spark, str(path)))
    assert r == {
        "cust_id": 7,
        "pat_acct": "0012",
        "insurance_name": "P1",
        "charges": 100.5,
        "remit_paymt": 2.5,
        "paymt_date": 20240105,
        "claim_adj_seg": "CO1,2",
        "remit_check_num": "55",
    }


def test_tables_renames_and_sql(spark, tmp_path):
    own = spark.createDataFrame([("1", "X")], "pat_acct string, own_code string")
    t = Tables({"patient_accounts": own}, {"patient_accounts": {"own_code": "status_code"}})
    assert rows(sql_frame(spark, "select status_code from {patient_accounts}", t)) == [("X",)]
    accounts = frame(spark, schemas.TABLES["account_statuses"], [{"pat_acct": "007", "status": "A"}])
    accounts.write.csv(str(tmp_path / "account_statuses"), header=True)
    accounts.write.parquet(str(tmp_path / "pq" / "account_statuses"))
    assert rows(Tables.csv(spark, str(tmp_path))["account_statuses"]) == [("007", "A")]
    assert rows(Tables.parquet(spark, str(tmp_path / "pq"))["account_statuses"]) == [("007", "A")]


def read_bytes(folder):
    return b"".join(p.read_bytes() for p in sorted(folder.glob("part-*")))


def test_csv_sinks(spark, tmp_path):
    df = spark.createDataFrame([("a,b", None), ('"007"', 2)], "x string, y int").coalesce(1)
    write_csv(df, str(tmp_path / "quoted"), line_sep="\r\n", null_value="None")
    assert read_bytes(tmp_path / "quoted") == b'x,y\r\n"a,b",None\r\n"""007""",2\r\n'
    write_plain(df, str(tmp_path / "plain"), line_sep="\r\n")
    assert read_bytes(tmp_path / "plain") == b'x,y\r\na,b,None\r\n"007",2\r\n'
    back = read_csv_text(spark, str(tmp_path / "quoted"))
    assert rows(back) == [('"007"', "2"), ("a,b", "None")]
    head, n = preview(df, 1)
    assert n == 2 and head.count() == 1


def test_bundle_keeps_kinds(spark, tmp_path):
    df = spark.sql("select 'a' name, 1 n, 0.5 pct_x, date'2024-01-01' d")
    paths = write_bundle({"first": df, "second": df.limit(0)}, str(tmp_path / "book"))
    back = spark.read.parquet(paths["first"])
    assert [f.metadata["kind"] for f in back.schema.fields] == ["text", "number", "percent", "date"]
    assert set(paths) == {"first", "second"}


def test_chart_points(spark):
    df = spark.createDataFrame([(i, i * 10) for i in range(100)], "x int, y int")
    got = chart_points(df, "x", "y", [F.desc("x")], (0, 95), None)
    assert [tuple(r) for r in got.collect()] == [(i, i * 10) for i in range(99, -1, -1)]
    assert [f.metadata for f in got.schema.fields] == [{"axis": [0, 95]}, {}]


def test_snapshots(spark, tmp_path):
    table = SnapshotTable(spark, str(tmp_path / "state"), schemas.ALERTS)
    assert table.version() == 0 and table.read().count() == 0
    one = frame(spark, schemas.ALERTS, [{"pm_sk": 1, "note": "n"}])
    assert table.publish(one) == 1
    assert table.publish(table.read().unionByName(one)) == 2
    assert (table.version(), table.read().count(), table.read(1).count()) == (2, 2, 1)
    # a staged snapshot does not count before it is committed
    folder = table.stage(one)
    assert (table.version(), table.staged(folder).count(), table.read().count()) == (2, 1, 2)
    assert table.commit(folder) == 3 and table.read().count() == 1
    assert table.publish(table.read(2)) == 4
    table.backup(str(tmp_path / "backup"))
    assert rows(spark.read.parquet(str(tmp_path / "backup"))) == rows(table.read())
