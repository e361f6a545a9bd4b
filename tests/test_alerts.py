import datetime as dt

import pytest
from helpers import day, dicts, frame, rows
from pyspark.sql import functions as F

from claimlens import schemas
from claimlens.plans import daily
from claimlens.plans.alerts import export_alerts, ingest_alerts, open_alerts, refresh_billed, resolve_alerts
from claimlens.sinks.snapshots import SnapshotTable
from claimlens.sources.alert_text import read_alerts
from claimlens.streaming.alert_drop import watch_alerts

NOW = dt.datetime(2024, 1, 20, 8, 30)


@pytest.fixture
def t(make):
    bill = {"cust_id": 7, "pat_acct": "A001", "charges": 10, "insurance_name": "P"}
    return make(
        billing=[
            {**bill, "pm_sk": 1000001, "created_at": "2024-01-14T00:00:00", "claim_num": "old"},
            {**bill, "pm_sk": 1000001, "created_at": "2024-01-16T05:00:00", "claim_num": "new"},
            {**bill, "pm_sk": 1000002, "created_at": "2024-01-14T23:00:00", "claim_num": "c2"},
            {**bill, "pm_sk": 1000003, "created_at": "2024-01-15T00:00:00", "claim_num": "c3"},
        ],
        pre_billing=[
            {
                "pm_sk": 1000001,
                "created_at": "2024-01-01T00:00:00",
                "content": '{"claim_type": "MVA", "vx_carrier_lob": "auto", "work_comp_flag": ""}',
            }
        ],
    )


def state(spark, *records):
    return frame(spark, schemas.ALERTS, list(records))


def lines(spark, tmp_path, text, name="alerts_20240115.txt"):
    path = tmp_path / name
    path.write_text(text)
    return read_alerts(spark, str(path))


TEXT = """Team North
 1000001, 1, A001 - A7 > note one
 1000001, 1, A001 - A7 > note one
 1000002, 2, A002 - P1 > note two
Team South
 1000001, 1, A001 - F1 > other
 1000004, 4, A004 - P1 > no bill
 1000003, 3, A003 - nothing
"""


def metrics(run):
    return {r["metric"]: r["rows"] for r in dicts(run.metrics)}


def test_ingest(spark, tmp_path, t):
    run = ingest_alerts(state(spark), lines(spark, tmp_path, TEXT), t, NOW)
    assert metrics(run) == {"inserted": 4, "filled": 3, "refreshed": 2, "unmatched": 1}
    assert run.rejects.count() == 1
    by_note = {r["note"]: r for r in dicts(run.state)}
    one, two, none = by_note["A7 - note one"], by_note["P1 - note two"], by_note["P1 - no bill"]
    # latest bill, billed after the alert's day: processed on the bill's day
    assert (one["claim_num"], one["assigned"], one["processed"], one["processed_at"]) == ("new", "Team North", True, day("2024-01-16"))
    assert (one["claim_type"], one["vx_carrier_lob"], one["work_comp_flag"]) == ("MVA", "auto", None)
    assert by_note["F1 - other"]["assigned"] == "Team South"
    # billed the day before the alert: still open
    assert (two["claim_num"], two["processed"], two["processed_at"], two["effective_date"]) == ("c2", False, None, day("2024-01-15"))
    assert (none["processed"], none["effective_date"], none["cust_id"]) == (None, None, None)
    assert one["created_at"] == NOW


def test_ingest_twice_is_ingest_once(spark, tmp_path, t):
    parsed = lines(spark, tmp_path, TEXT)
    first = ingest_alerts(state(spark), parsed, t, NOW)
    again = ingest_alerts(first.state, parsed, t, NOW)
    assert rows(again.state) == rows(first.state)
    assert metrics(again) == {"inserted": 0, "filled": 0, "refreshed": 0, "unmatched": 0}


def test_unset_alert_is_filled_by_a_later_line(spark, tmp_path, t, make):
    waiting = {"created_at": "2024-01-20T01:00:00", "pm_sk": 1000002, "src_sk": 2, "pat_acct": "A002", "note": "old", "code": "277-X"}
    yesterday = {**waiting, "created_at": "2024-01-19T01:00:00", "note": "older"}
    run = ingest_alerts(state(spark, waiting, yesterday), lines(spark, tmp_path, TEXT), t, NOW)
    got = {r["note"]: (r["assigned"], r["processed"]) for r in dicts(run.state) if r["pm_sk"] == 1000002}
    assert got == {"old": ("Team North", False), "P1 - note two": ("Team North", False), "older": (None, None)}


def test_refresh_before_on_after(spark, t):
    rows_in = [
        {"pm_sk": 1000003, "note": n, "effective_date": d, "processed": p}
        for n, d, p in [
            ("before", "2024-01-14", False),
            ("on", "2024-01-15", False),
            ("after", "2024-01-16", False),
            ("done", "2024-01-14", True),
            ("unset", "2024-01-14", None),
        ]
    ]
    got = {r["note"]: (r["processed"], r["refreshed"]) for r in dicts(refresh_billed(state(spark, *rows_in), t))}
    assert got == {"before": (True, True), "on": (True, True), "after": (False, False), "done": (True, False), "unset": (None, False)}


def test_resolve(spark, t):
    alerts = [
        {"pm_sk": 1, "note": "open", "processed": False},
        {"pm_sk": 1, "note": "open too", "processed": False},
        {"pm_sk": 2, "note": "done", "processed": True, "processed_at": "2024-01-01"},
        {"pm_sk": 3, "note": "other", "processed": False},
    ]
    keys = spark.createDataFrame([(1,), (1,), (2,), (99,)], "pm_sk bigint")
    run = resolve_alerts(state(spark, *alerts), keys, t, NOW.date())
    assert metrics(run) == {"refreshed": 0, "resolved": 2}
    got = {r["note"]: (r["processed"], r["processed_at"]) for r in dicts(run.state)}
    assert got == {
        "open": (True, NOW.date()),
        "open too": (True, NOW.date()),
        "done": (True, day("2024-01-01")),
        "other": (False, None),
    }


def test_open_alerts(spark, t):
    base = {"pm_sk": 1000002, "src_sk": 1, "pat_acct": "007", "note": "n", "assigned": "The TEAM north", "charges": 1234.5, "claim_num": None}
    as_of = day("2024-01-20")
    old = lambda n: str(as_of - dt.timedelta(days=n))
    alerts = [
        {**base, "effective_date": old(364), "processed": False, "src_sk": 1},
        {**base, "effective_date": old(365), "processed": False, "src_sk": 2},
        {**base, "effective_date": old(3), "processed": None, "src_sk": 3},
        {**base, "effective_date": old(3), "processed": True, "src_sk": 4},
        {**base, "effective_date": old(3), "processed": False, "assigned": "Team South", "src_sk": 5},
        {**base, "effective_date": old(3), "processed": False, "src_sk": 6, "pm_sk": 55, "note": None, "charges": None},
    ]
    report = open_alerts(state(spark, *alerts), t, as_of, "team north")
    got = {r["src_sk"]: r for r in dicts(report)}
    assert set(got) == {1, 3, 6}
    assert list(got)[-1] == 1  # latest day first
    assert (got[1]["not_done"], got[3]["not_done"], got[6]["not_done"]) == ("2 of 4", None, "1 of 1")
    assert (got[1]["bill_sent_after"], got[3]["bill_sent_after"], got[6]["bill_sent_after"]) == ("Y", "N", "Y")
    assert (got[1]["aging"], got[3]["aging"], got[6]["aging"]) == (6, None, None)
    assert (got[1]["charges"], got[6]["charges"]) == ("$1235", "$")
    assert (got[1]["pat_acct"], got[1]["claim_num"]) == ('"007"', '""')
    plain = {r["src_sk"]: r for r in dicts(export_alerts(report))}
    assert (plain[1]["charges"], plain[1]["pat_acct"], plain[6]["charges"]) == ("$1,235", "007", None)


def test_file_stream_runs_each_file_once(spark, tmp_path, t):
    drop, table = tmp_path / "drop", SnapshotTable(spark, str(tmp_path / "state"), schemas.ALERTS)
    drop.mkdir()
    (drop / "alerts_20240115.txt").write_text(TEXT)
    watch = lambda: watch_alerts(spark, str(drop), table, t, str(tmp_path / "cp"), lambda: NOW).awaitTermination(120)
    watch()
    assert (table.version(), table.read().count()) == (1, 4)
    watch()
    assert table.version() == 1
    (drop / "alerts_20240116.txt").write_text("Team West\n 1000003, 3, A003 - P1 > more\n")
    watch()
    assert (table.version(), table.read().count()) == (2, 5)
    assert table.read().filter(F.col("assigned") == "Team West").count() == 1


def test_daily_runs_are_all_or_nothing(spark, tmp_path, t, monkeypatch):
    table = SnapshotTable(spark, str(tmp_path / "state"), schemas.ALERTS)
    parsed = lines(spark, tmp_path, TEXT)
    first = daily.run_daily(table, parsed, t, NOW, "team", str(tmp_path / "day1"))
    assert (first.version, metrics(first)["inserted"], first.rejects.count()) == (1, 4, 1)
    text = b"".join(p.read_bytes() for p in sorted((tmp_path / "day1" / "open_alerts").glob("part-*"))).decode()
    assert text.startswith("effective_date,") and '"A002"' in text
    assert spark.read.parquet(str(tmp_path / "day1" / "export")).count() == 1

    def broken(*_, **__):
        raise OSError("disk full")

    more = lines(spark, tmp_path, "Team West\n 1000003, 3, A003 - P1 > more\n", "alerts_20240116.txt")
    monkeypatch.setattr(daily, "write_plain", broken)
    with pytest.raises(OSError):
        daily.run_daily(table, more, t, NOW, "team", str(tmp_path / "day2"))
    assert (table.version(), table.read().count()) == (1, 4)
    monkeypatch.undo()
    assert daily.run_daily(table, more, t, NOW, "team", str(tmp_path / "day3")).version == 2
    keys = spark.createDataFrame([(1000002,)], "pm_sk int")
    done = daily.run_resolve(table, keys, t, NOW.date(), "team", str(tmp_path / "day4"))
    assert (done.version, metrics(done)["resolved"], table.read().count()) == (3, 1, 5)
    assert rows(spark.read.parquet(str(tmp_path / "day3" / "backup"))) == rows(table.read(1))
