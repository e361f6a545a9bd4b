"""Alert state: ingest of daily text files, refresh, manual resolve, open-alert report.

The state is a snapshot: every step takes a frame and gives the next one. Publishing the new
snapshot (``sinks.snapshots``) is the only write, so a failed run changes nothing.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimlens.functions.dates import days_old, on_day, younger_than
from claimlens.functions.flags import yes_no
from claimlens.functions.text import blank_to_null, contains_ci, grouped_money_text, json_text, money_text, quoted
from claimlens.operators.latest import latest_row_values
from claimlens.operators.state import insert_absent, update_from
from claimlens.plans.rules import ALERT_MAX_DAYS
from claimlens.schemas import ALERTS
from claimlens.sources.alert_text import good_lines, rejected_lines

ALERT_KEYS = ["pm_sk", "src_sk", "pat_acct", "note", "code"]
LINE_ORDER = ["effective_date", "file", "block", "pos"]
BILLING_FIELDS = ["cust_id", "claim_num", "charges", "patient_name", "policy_number", "insurance_name"]


class AlertRun(NamedTuple):
    state: DataFrame
    metrics: DataFrame
    rejects: DataFrame | None = None


def alert_state(df: DataFrame) -> DataFrame:
    """Columns and types of the state; missing columns become NULL."""
    return df.select(
        *[
            (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in ALERTS.fields
        ]
    )


def _only_keys(df: DataFrame, keys: DataFrame) -> DataFrame:
    """Rows whose ``pm_sk`` occurs in a small key frame, so that the large table is cut down before
    it is grouped."""
    return df.join(keys.select("pm_sk").distinct(), "pm_sk", "left_semi")


def _metrics(changed: DataFrame, counts: Mapping[str, Column]) -> DataFrame:
    """``metric``, ``rows``: number of rows passing each test."""
    names = list(counts)
    sums = changed.agg(*[F.coalesce(F.sum(F.when(test, 1)), F.lit(0)).cast("bigint").alias(n) for n, test in counts.items()])
    pairs = F.array(*[F.struct(F.lit(n).alias("metric"), F.col(n).alias("rows")) for n in names])
    return sums.select(F.explode(pairs).alias("m")).select("m.*")


def _with_lines(state: DataFrame, known: DataFrame, lines: DataFrame, as_of: dt.datetime) -> DataFrame:
    """State plus the alerts that are not ``known``, each row with the team and day of its line.

    A new alert takes them from its own line; an alert of today that is still unset takes them from
    the first line that names its record.
    """
    new = insert_absent(known, lines, ALERT_KEYS, LINE_ORDER)
    heads = lines.groupBy(F.col("pm_sk").alias("line_pm_sk")).agg(
        F.min_by(F.struct("assigned", "effective_date"), F.struct(*LINE_ORDER)).alias("line")
    )
    old = (
        state.join(heads, F.col("pm_sk") == F.col("line_pm_sk"), "left")
        .withColumn("line_assigned", F.col("line.assigned"))
        .withColumn("line_day", F.col("line.effective_date"))
        .withColumn("inserted", F.lit(False))
        .drop("line", "line_pm_sk")
    )
    blank = {"assigned", "effective_date", *BILLING_FIELDS}
    rows = new.withColumnsRenamed({"assigned": "line_assigned", "effective_date": "line_day"}).withColumn(
        "created_at", F.lit(as_of)
    )
    added = rows.select(
        *[
            (F.col(f.name) if f.name in rows.columns and f.name not in blank else F.lit(None))
            .cast(f.dataType)
            .alias(f.name)
            for f in ALERTS.fields
        ],
        "line_assigned",
        "line_day",
        F.lit(True).alias("inserted"),
    )
    return old.unionByName(added)


def _latest_bills(keys: DataFrame, t: Mapping[str, DataFrame]) -> DataFrame:
    """Per record of ``keys`` its latest bill: claim columns as ``b_*`` and the day, from one grouping of
    the billing table."""
    bills = latest_row_values(
        _only_keys(t["billing"], keys).withColumn("bill_at", F.col("created_at")), ["pm_sk"], "created_at", [*BILLING_FIELDS, "bill_at"]
    )
    return bills.select(
        F.col("pm_sk").alias("b_pm_sk"),
        F.to_date("bill_at").alias("bill_date"),
        *[F.col(c).alias("b_" + c) for c in BILLING_FIELDS],
    )


def _fill_from_billing(rows: DataFrame, bills: DataFrame, today: dt.date) -> DataFrame:
    """Claim columns of today's unset alerts from the record's latest bill; they become unprocessed.
    ``bill_date`` stays with every row for the refresh."""
    joined = rows.join(bills, F.col("pm_sk") == F.col("b_pm_sk"), "left")
    unset = on_day(F.col("created_at"), today) & F.col("processed").isNull() & F.col("line_day").isNotNull()
    joined = joined.withColumn("filled", F.coalesce(F.col("b_pm_sk").isNotNull() & unset, F.lit(False)))
    values = {c: F.col("b_" + c) for c in BILLING_FIELDS} | {
        "effective_date": F.col("line_day"),
        "assigned": F.col("line_assigned"),
        "processed": F.lit(False),
    }
    return joined.select(
        *[
            F.when(F.col("filled"), values[c].cast(rows.schema[c].dataType)).otherwise(F.col(c)).alias(c) if c in values else F.col(c)
            for c in rows.columns
        ],
        "filled",
        "bill_date",
    )


def _fill_from_pre_billing(rows: DataFrame, keys: DataFrame, t: Mapping[str, DataFrame], today: dt.date) -> DataFrame:
    """Attributes of today's alerts from the record's JSON."""
    fields = {k: json_text(F.col("content"), k) for k in ("claim_type", "vx_carrier_lob", "work_comp_flag")}
    fields["work_comp_flag"] = blank_to_null(fields["work_comp_flag"])
    records = _only_keys(t["pre_billing"], keys).select(
        "pm_sk", "created_at", *[c.alias("p_" + n) for n, c in fields.items()]
    )
    latest = latest_row_values(records, ["pm_sk"], "created_at", ["p_" + n for n in fields])
    return update_from(
        rows,
        latest,
        "pm_sk",
        on_day(F.col("created_at"), today),
        {n: F.col("p_" + n) for n in fields},
        "described",
    )


def _refresh(rows: DataFrame) -> DataFrame:
    """The refresh for rows that carry the day of their record's latest bill."""
    hit = F.coalesce(~F.col("processed") & (F.col("effective_date") <= F.col("bill_date")), F.lit(False))
    return rows.withColumn("refreshed", hit).withColumns(
        {
            "processed": F.col("processed") | F.col("refreshed"),
            "processed_at": F.when(F.col("refreshed"), F.col("bill_date")).otherwise(F.col("processed_at")),
        }
    )


def refresh_billed(state: DataFrame, t: Mapping[str, DataFrame], flag: str = "refreshed") -> DataFrame:
    """Unprocessed alerts whose record was billed on or after the alert's day become processed on
    the day of its latest bill. ``flag`` marks the changed rows."""
    waiting = state.filter(~F.col("processed"))
    bills = (
        _only_keys(t["billing"], waiting).groupBy("pm_sk").agg(F.to_date(F.max("created_at")).alias("bill_date"))
    )
    return update_from(
        state,
        bills,
        "pm_sk",
        ~F.col("processed") & (F.col("effective_date") <= F.col("bill_date")),
        {"processed": F.lit(True), "processed_at": F.col("bill_date")},
        flag,
    )


#: flags of an ingest and of a resolve run, kept with the rows that it writes
INGEST_FLAGS = ("inserted", "filled", "refreshed")
RESOLVE_FLAGS = ("refreshed", "resolved")


def flag_schema(flags: tuple[str, ...]) -> T.StructType:
    return T.StructType([T.StructField(f, T.BooleanType()) for f in flags])


def settled(as_of: dt.date) -> Column:
    """Alerts that no later run changes: processed, and not of the day of the run."""
    return F.col("processed") & (F.col("created_at") < F.lit(as_of))


def ingest_changes(
    state: DataFrame,
    known: DataFrame,
    lines: DataFrame,
    t: Mapping[str, DataFrame],
    as_of: dt.datetime,
    attributes: bool = True,
) -> DataFrame:
    """``state`` after a batch of good lines, with the flags of the changed rows.

    ``known`` holds the keys of all alerts; ``state`` may leave out the settled ones. ``attributes=False`` spares
    the look at the pre-billing records where only the flags are wanted.
    """
    today = as_of.date()
    # records of alerts that may change, taken from the inputs and not from the steps between
    unset = F.col("processed").isNull() & on_day(F.col("created_at"), today)
    added = lines.select("pm_sk")
    waiting = state.filter(~F.col("processed") | unset).select("pm_sk").union(added)
    rows = _fill_from_billing(_with_lines(state, known, lines, as_of), _latest_bills(waiting, t), today)
    if attributes:
        of_today = state.filter(on_day(F.col("created_at"), today)).select("pm_sk").union(added)
        rows = _fill_from_pre_billing(rows, of_today, t, today)
    return _refresh(rows).select(*[f.name for f in ALERTS.fields], *INGEST_FLAGS)


def ingest_metrics(changes: DataFrame) -> DataFrame:
    """Number of inserted, filled and refreshed alerts, and ``unmatched``: inserted without a bill, which
    leaves them out of the refresh and the report."""
    tests = {f: F.col(f) for f in INGEST_FLAGS} | {"unmatched": F.col("inserted") & ~F.col("filled")}
    return _metrics(changes, tests)


def ingest_alerts(
    state: DataFrame, parsed: DataFrame, t: Mapping[str, DataFrame], as_of: dt.datetime
) -> AlertRun:
    """Next state after a batch of parsed alert lines (``sources.alert_text``), as frames that are not run yet.

    Lines whose keys, note and code are in the state already are not inserted again. State and metrics are each
    computed from the inputs; ``plans.daily`` writes the changes once and takes both from there.
    """
    state = alert_state(state)
    lines = good_lines(parsed)
    changes = ingest_changes(state, state, lines, t, as_of)
    metrics = ingest_metrics(ingest_changes(state, state, lines, t, as_of, attributes=False))
    return AlertRun(changes.select(*state.columns), metrics, rejected_lines(parsed))


def resolve_changes(state: DataFrame, keys: DataFrame, t: Mapping[str, DataFrame], as_of: dt.date) -> DataFrame:
    """Refreshes, then marks the unprocessed alerts of the listed ``pm_sk`` as processed; with flags."""
    return update_from(
        refresh_billed(state, t),
        keys.select("pm_sk").distinct(),
        "pm_sk",
        ~F.col("processed"),
        {"processed": F.lit(True), "processed_at": F.lit(as_of)},
        "resolved",
    )


def resolve_metrics(changes: DataFrame) -> DataFrame:
    return _metrics(changes, {f: F.col(f) for f in RESOLVE_FLAGS})


def resolve_alerts(state: DataFrame, keys: DataFrame, t: Mapping[str, DataFrame], as_of: dt.date) -> AlertRun:
    """Next state after a list of resolved records."""
    state = alert_state(state)
    rows = resolve_changes(state, keys, t, as_of)
    return AlertRun(rows.select(*state.columns), resolve_metrics(rows))


def open_alerts(
    state: DataFrame,
    t: Mapping[str, DataFrame],
    as_of: dt.date,
    assigned_like: str,
    quotes: bool = True,
) -> DataFrame:
    """Unprocessed alerts of a team that are younger than a year.

    ``not_done`` tells how many alerts of the same note are open, over all teams. The counts are
    aggregated per note and joined back, so a note on very many alerts needs no window.
    """
    recent = alert_state(state).filter(younger_than(F.col("effective_date"), as_of, ALERT_MAX_DAYS))
    counts = recent.groupBy(F.col("note").alias("counted_note")).agg(
        F.count(F.when(~F.col("processed"), 1)).alias("open_count"), F.count("*").alias("note_count")
    )
    mine = recent.filter(
        contains_ci(F.col("assigned"), assigned_like) & ~F.coalesce("processed", F.lit(False))
    )
    bills = (
        _only_keys(t["billing"], mine).groupBy("pm_sk").agg(F.to_date(F.max("created_at")).alias("bill_date"))
    )
    is_open = F.col("processed") == F.lit(False)
    wrap = quoted if quotes else (lambda c: c)
    return (
        mine.join(counts, F.col("note").eqNullSafe(F.col("counted_note")))
        .join(bills, "pm_sk", "left")
        .select(
            "effective_date",
            "pm_sk",
            "src_sk",
            "cust_id",
            wrap(F.col("pat_acct")).alias("pat_acct"),
            wrap(F.col("claim_num")).alias("claim_num"),
            money_text(F.col("charges")).alias("charges"),
            wrap(F.col("policy_number")).alias("policy_number"),
            "claim_type",
            "insurance_name",
            "patient_name",
            "vx_carrier_lob",
            F.when(F.col("work_comp_flag") == "Y", "T").otherwise("F").alias("work_comp_flag"),
            F.col("note").alias("payer_response"),
            "code",
            yes_no(F.col("processed")).alias("processed"),
            F.when(is_open, F.format_string("%s of %s", "open_count", "note_count")).alias("not_done"),
            "processed_at",
            "assigned",
            "bill_date",
            F.when(F.col("effective_date") > F.col("bill_date"), "N").otherwise("Y").alias("bill_sent_after"),
            F.when(is_open, days_old(F.col("bill_date"), as_of)).alias("aging"),
        )
        .orderBy(F.desc_nulls_first("effective_date"), F.asc_nulls_last("pm_sk"), F.asc_nulls_last("cust_id"))
    )


def export_alerts(report: DataFrame) -> DataFrame:
    """Open-alert report for a typed workbook: quotes stripped, charges as ``$1,234``."""
    plain = {c: F.replace(F.col(c), F.lit('"'), F.lit("")) for c in ("pat_acct", "claim_num", "policy_number")}
    amount = F.replace(F.col("charges"), F.lit("$"), F.lit("")).try_cast("decimal(38,0)")
    return report.withColumns({**plain, "charges": grouped_money_text(amount)})
