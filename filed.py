"""Registered queries of the file and state side: each writes in the shared folder and returns what it reads back."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import bindings as b
from claimlens import schemas
from claimlens.functions.dates import run_stamp
from claimlens.operators.lists import TextList, list_chunks
from claimlens.operators.positions import numbered
from claimlens.plans import aging, alerts, daily, opportunity, quality, reconcile, summaries, traits
from claimlens.plans.bills import prepare_bills
from claimlens.plans.workbooks import write_daily
from claimlens.sinks.bundle import sheet_listing
from claimlens.sinks.csv_files import write_counted, write_csv, write_plain
from claimlens.sinks.files import shared_folder
from claimlens.sinks.snapshots import Conflict, SnapshotTable
from claimlens.sources.alert_text import good_keys, parse_alert_lines, read_key_lines, rejected_keys
from claimlens.sources.csv_files import read_csv
from claimlens.sources.tables import sql_frame

INGEST_AT = dt.datetime(2024, 2, 15)
TEAM = "team north"
SCOPES = ("all", "not_billed", "no_fax")


def stacked(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def alert_lines(t) -> DataFrame:
    """Alert files as lines: each detail line with its heading line before it."""
    d = t["alert_details"]
    heading = F.struct((F.col("pos") - 1).alias("pos"), F.col("team").alias("line"))
    detail = F.struct("pos", "line")
    return d.select("file", "block", F.explode(F.array(heading, detail)).alias("l")).select("file", "block", "l.*")


def moved_back(t) -> DataFrame:
    """Alert state whose days lie among the bills."""
    return t["alert_seed"].withColumn("effective_date", F.date_sub("effective_date", 9000))


# ---------------------------------------------------------------- state


def _seeded(spark: SparkSession, t, root: str) -> SnapshotTable:
    """The alert state as version 1."""
    table = SnapshotTable(spark, f"{root}/state", schemas.ALERTS)
    table.commit(table.stage(alerts.alert_state(t["alert_seed"]), alerts.settled(INGEST_AT.date())))
    return table


def daily_run(spark: SparkSession, t) -> DataFrame:
    """The state that a whole daily run publishes, with the flags of its changes."""
    root = shared_folder(spark, "daily")
    table = _seeded(spark, t, root)
    run = daily.run_daily(table, parse_alert_lines(alert_lines(t)), t, INGEST_AT, TEAM, f"{root}/out")
    state = table.read_with(alerts.flag_schema(alerts.INGEST_FLAGS), run.version)
    flags = {f: F.coalesce(f, F.lit(False)) for f in alerts.INGEST_FLAGS}
    return state.withColumns(flags).withColumn("version", F.lit(run.version).cast("long"))


def published_versions(spark: SparkSession, t) -> DataFrame:
    """Counts of every version after a daily run, a run that started too early, one that died, and a resolve run."""
    root = shared_folder(spark, "versions")
    table = _seeded(spark, t, root)
    late = table.stage(table.unsettled().limit(0), alerts.settled(INGEST_AT.date()))
    daily.run_daily(table, parse_alert_lines(alert_lines(t)), t, INGEST_AT, TEAM, f"{root}/day1")
    refused = 0
    try:
        table.commit(late)
    except Conflict:
        refused = 1
    table.stage(table.unsettled(), alerts.settled(INGEST_AT.date()))  # never counts
    keys = t["pre_billing"].filter(F.col("status") == "W").select("pm_sk")
    last = daily.run_resolve(table, keys, t, b.EVENTS_AS_OF, TEAM, f"{root}/day2").version

    def counts(version: int) -> DataFrame:
        return table.read(version).agg(
            F.lit(version).cast("long").alias("version"),
            F.count("*").alias("alerts"),
            F.count(F.when(~F.col("processed"), 1)).alias("open_alerts"),
            F.count(F.when(F.col("processed"), 1)).alias("processed_alerts"),
            F.max("processed_at").alias("last_processed_at"),
            F.lit(refused).cast("long").alias("refused"),
            F.lit(len(table.abandoned())).cast("long").alias("abandoned"),
        )

    return stacked([counts(v) for v in range(1, last + 1)])


def backup(spark: SparkSession, t) -> DataFrame:
    """A backup of version 1 that was made when version 2, an empty one, was in force."""
    root = shared_folder(spark, "backup")
    table = _seeded(spark, t, root)
    table.publish(table.read().limit(0))
    table.backup(f"{root}/copy", 1)
    return spark.read.schema(schemas.ALERTS).parquet(f"{root}/copy")


def _key_lines(spark: SparkSession, t) -> DataFrame:
    folder = f"{shared_folder(spark, 'keys')}/resolved"
    t["key_lines"].select("line").write.text(folder)
    return read_key_lines(spark, folder)


def resolve_from_lines(spark: SparkSession, t) -> alerts.AlertRun:
    return alerts.resolve_alerts(moved_back(t), good_keys(_key_lines(spark, t)), t, b.EVENTS_AS_OF)


# ---------------------------------------------------------------- order and lists


def _placed(label: str, report: DataFrame, order, *keys: str) -> DataFrame:
    key = F.concat_ws("|", *[F.coalesce(F.col(k).cast("string"), F.lit("-")) for k in keys])
    return numbered(report, order).select(F.lit(label).alias("report"), "position", key.alias("key"))


def status_positions(spark: SparkSession, t) -> DataFrame:
    ex = b.EXCLUDED_CUSTOMERS
    kinds = [("insurance", s) for s in SCOPES] + [("account", s) for s in SCOPES[:2]]
    return stacked(
        [_placed(f"{by} {s}", summaries.status_summary(t, by, s, ex), summaries.status_order(s), "pat_acct_status") for by, s in kinds]
    )


def stage_positions(spark: SparkSession, t) -> DataFrame:
    ex = b.EXCLUDED_CUSTOMERS
    kinds = [("insurance", s) for s in SCOPES] + [("account", s) for s in SCOPES[:2]]
    order = summaries.stage_order()
    return stacked([_placed(f"{by} {s}", summaries.prebill_summary(t, by, s, ex), order, "pre_billing_record_status") for by, s in kinds])


def payer_positions(spark: SparkSession, t) -> DataFrame:
    ex = b.EXCLUDED_CUSTOMERS
    return stacked(
        [_placed(s, opportunity.payer_opportunity(t, s, ex), opportunity.payer_order(s), "insurance_name") for s in SCOPES]
    )


def reconcile_positions(spark: SparkSession, t) -> DataFrame:
    report = reconcile.reconcile_transactions(t, t["remittances"], cust_name="All customers")
    return _placed("transactions", report, reconcile.reconcile_order(), "pat_acct", "cust_id")


def _digested(chunks: DataFrame) -> DataFrame:
    return chunks.withColumns({"chars": F.length("text").cast("long"), "digest": F.md5("text")}).drop("text")


def whole_list_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lists of far more than 100,000 items in pieces of 10,000."""
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet").withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(3))))
    item = F.concat(F.lit("A"), F.concat_ws("-", "l_orderkey", "l_linenumber", "k"))
    lists = {"cell": TextList(item, "; ")}
    return _digested(list_chunks(lines.withColumnRenamed("l_linestatus", "flag"), ["flag"], lists)).drop("list_name")


def payer_chunks(spark: SparkSession, t) -> DataFrame:
    return _digested(opportunity.payer_opportunity_chunks(t, "not_billed", size=100))


# ---------------------------------------------------------------- ids and documents


def listed_customers(t) -> DataFrame:
    """Customer ids with copies and a NULL among them."""
    c = t["customers"]
    return c.filter(F.col("cust_id") % 3 == 1).select("cust_id").unionByName(
        c.select(F.when(F.col("cust_id") % 5 == 2, F.col("cust_id")).alias("cust_id"))
    )


def prepared(spark: SparkSession, t):
    return prepare_bills(t, shared_folder(spark, "bills"))


# ---------------------------------------------------------------- files


def csv_round_trip(spark: SparkSession, t) -> DataFrame:
    rows = t["awkward_notes"]
    folder = shared_folder(spark, "csv")
    write_csv(rows, folder)
    return read_csv(spark, folder, rows.schema)


def crlf_round_trip(spark: SparkSession, t) -> DataFrame:
    """CSV with CRLF line ends and plain lines of the same rows, as lines."""
    rows = t["awkward_notes"].filter("id % 7 not in (3, 4)")  # lines hold no line breaks
    folder = shared_folder(spark, "crlf")
    write_csv(rows, f"{folder}/csv", line_sep="\r\n", null_value="None")
    write_plain(rows, f"{folder}/plain", line_sep="\r\n")
    header = ",".join(rows.columns)
    lines = [
        spark.read.option("lineSep", "\r\n").text(f"{folder}/{kind}").select(F.lit(kind).alias("kind"), F.col("value").alias("line"))
        for kind in ("csv", "plain")
    ]
    return stacked(lines).filter(F.col("line") != header)


def sheet_contracts(spark: SparkSession, t) -> DataFrame:
    """What the written workbooks of all scopes hold."""
    folder = shared_folder(spark, "books")
    at = dt.datetime.combine(b.AS_OF, dt.time(8, 30))
    out = []
    for scope in SCOPES:
        for sheet, path in write_daily(t, scope, at, f"{folder}/{scope}", b.EXCLUDED_CUSTOMERS).items():
            listing = sheet_listing(spark.read.parquet(path))
            run = path.split("/")[-2]
            out.append(listing.select(F.lit(scope).alias("scope"), F.lit(run).alias("run"), F.lit(sheet).alias("sheet"), "*"))
    return stacked(out)


PREVIEW = ["created_at", "cust_id", "pat_acct", "response_from", "code", "note"]


def counted_preview(spark: SparkSession, t) -> DataFrame:
    """The first rows of a written report and its number of rows."""
    report = aging.actionable_responses(t).select(*PREVIEW)
    order = [F.desc_nulls_first(PREVIEW[0]), *[F.asc_nulls_last(c) for c in PREVIEW[1:]]]
    first, n = write_counted(report, shared_folder(spark, "preview"), 5, order)
    return first.withColumn("rows", F.lit(n).cast("long"))


STAGE_TEXT = """
select insurance_name, count(*) as records, count(distinct pat_acct) as accounts, max(created_at) as latest
from {pre_billing} where status = :stage and charges >= :least group by insurance_name"""


def sql_text(spark: SparkSession, t) -> DataFrame:
    return sql_frame(spark, STAGE_TEXT, t, stage="W", least=1000)


def run_stamps(spark: SparkSession, t) -> DataFrame:
    stamps = {"utc": run_stamp(F.col("created_at")), "new_york": run_stamp(F.col("created_at"), "America/New_York")}
    return t["alert_seed"].select("pm_sk", *[c.alias(n) for n, c in stamps.items()])


QUERIES = {
    "R24_daily_run": daily_run,
    "M06_published_versions": published_versions,
    "K06_backup": backup,
    "S08_key_rejects": lambda spark, t: rejected_keys(_key_lines(spark, t)),
    "R25_resolve_from_lines_state": lambda spark, t: resolve_from_lines(spark, t).state,
    "R25_resolve_from_lines_metrics": lambda spark, t: resolve_from_lines(spark, t).metrics,
    "O01_status_summary_positions": status_positions,
    "O01_stage_summary_positions": stage_positions,
    "O01_payer_opportunity_positions": payer_positions,
    "O04_reconcile_positions": reconcile_positions,
    "payer_opportunity_chunks_not_billed": payer_chunks,
    "S11_data_quality_ids": lambda spark, t: quality.data_quality(t, listed_customers(t), b.SUPPRESSED_CUSTOMERS),
    "S11_account_quality_ids": lambda spark, t: quality.account_quality(t, listed_customers(t)),
    "R10_account_traits_prepared": lambda spark, t: traits.account_traits(prepared(spark, t)),
    "R23_account_quality_prepared": lambda spark, t: quality.account_quality(prepared(spark, t)),
    "K01_S04_csv_round_trip": csv_round_trip,
    "K02_K03_crlf_lines": crlf_round_trip,
    "K04_sheet_contracts": sheet_contracts,
    "K09_counted_preview": counted_preview,
    "S02_sql_text": sql_text,
    "F39_run_stamps": run_stamps,
}
