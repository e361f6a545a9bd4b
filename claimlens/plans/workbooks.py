"""The daily report bundles: sheet names and their frames."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimlens.plans.opportunity import account_opportunity, payer_opportunity
from claimlens.plans.summaries import prebill_summary, status_summary
from claimlens.sinks.bundle import Contract, write_bundle
from claimlens.sinks.charts import chart_points
from claimlens.sinks.files import stamp


def _status_sheet(scope: str, counted: str) -> Contract:
    number = "pre_billing_record" if scope == "all" else "not_billed_record"
    return (
        ("pat_acct_status", "text"), (number, "number"), (f"distinct_{counted}", "number"), ("description", "text"),
        ("x12_code", "text"), ("note", "text"),
    )


def _stage_sheet(counted: str) -> Contract:
    return (
        ("pre_billing_record_status", "text"), ("not_billed_record", "number"), (f"distinct_{counted}", "number"),
        ("description", "text"),
    )


# The columns of the payer sheets in order, with their kinds.
PAYER_SHEETS: dict[str, Contract] = {
    "all": (
        ("insurance_name", "text"), ("pat_acct_status", "text"), ("pre_billing_record_status", "text"),
        ("pre_billing_record", "number"), ("billed_record", "number"), ("not_billed_record", "number"),
        ("pct_not_billed_record", "percent"), ("not_billed_avg_record_charge", "number"),
        ("not_billed_tot_acct_payment", "number"), ("not_billed_tot_acct_payer", "text"),
    ),
    "not_billed": (
        ("insurance_name", "text"), ("pat_acct_status", "text"), ("pre_billing_record_status", "text"),
        ("pre_billing_record", "number"), ("not_billed_record", "number"), ("pat_acct", "text"), ("cust_id", "text"),
        ("assigned_record_at", "text"), ("pct_not_billed_record", "percent"), ("not_billed_avg_record_charge", "number"),
        ("not_billed_tot_acct_payment", "number"), ("not_billed_tot_acct_payer", "text"),
    ),
    "no_fax": (
        ("insurance_name", "text"), ("pat_acct_status", "text"), ("pre_billing_record_status", "text"),
        ("pre_billing_record", "number"), ("not_billed_record", "number"), ("no_fax", "number"), ("cust_id", "text"),
        ("pat_acct", "text"), ("assigned_insurance_at", "text"), ("pct_no_fax_record_not_billed", "percent"),
        ("no_fax_avg_record_charge", "number"),
    ),
}


def _account_sheet(paid: str, posted: str) -> Contract:
    return (
        ("master_id", "number"), ("cust_id", "number"), ("pat_acct", "text"), ("pat_acct_status", "text"),
        ("pre_billing_record_status", "text"), ("pre_billing_record", "number"), ("billed_record", "number"),
        ("not_billed_record", "number"), ("pct_not_billed_record", "percent"), ("placed_days", "number"),
        ("not_billed_acct_charge", "number"), ("not_billed_insurance", "text"), ("not_billed_acct_payment", "number"),
        ("not_billed_acct_payer", "text"), ("payment_date", "date"), ("posting_date", "date"),
        ("first_billing_date", "date"), (paid, "text"), (posted, "text"), ("insured_state", "text"),
        ("accident_state", "text"), ("insured_eq_accident_state", "text"),
    )


ACCOUNT_SHEETS = {
    "all": _account_sheet("paid_then_billed", "posted_then_billed"),
    "not_billed": _account_sheet("paid_bef_billing", "posted_bef_billing"),
}


def sheet_contracts(scope: str) -> dict[str, Contract]:
    """What is declared for each sheet of a daily workbook: its columns in order and their kinds."""
    out = {
        "status_by_insurance": _status_sheet(scope, "insurance_name"),
        "stage_by_insurance": _stage_sheet("insurance_name"),
        "opportunity_by_insurance": PAYER_SHEETS[scope],
    }
    if scope != "no_fax":
        out["status_by_account"] = _status_sheet(scope, "pat_acct")
        out["stage_by_account"] = _stage_sheet("pat_acct")
        out["opportunity_by_account"] = ACCOUNT_SHEETS[scope]
    return out


def daily_sheets(
    t: Mapping[str, DataFrame],
    scope: str,
    as_of: dt.date,
    excluded_customers=(),
    agency: str = "Agency",
    prefix: str = "AGY",
) -> dict[str, DataFrame]:
    """Sheets of one daily workbook. The report on missing fax numbers is by payer only."""
    texts = {"agency": agency}
    out = {
        "status_by_insurance": status_summary(t, "insurance", scope, excluded_customers, prefix=prefix, **texts),
        "stage_by_insurance": prebill_summary(t, "insurance", scope, excluded_customers, **texts),
        "opportunity_by_insurance": payer_opportunity(t, scope, excluded_customers, PAYER_SHEETS[scope]),
    }
    if scope != "no_fax":
        out["status_by_account"] = status_summary(t, "account", scope, prefix=prefix, **texts)
        out["stage_by_account"] = prebill_summary(t, "account", scope, **texts)
        out["opportunity_by_account"] = account_opportunity(t, scope, as_of)
    return out


def write_daily(
    t: Mapping[str, DataFrame], scope: str, as_of: dt.datetime, out: str, excluded_customers=(), zone: str = "UTC"
) -> dict[str, str]:
    """Writes one daily workbook under the stamp of its run; the sheets must be what was declared."""
    sheets = daily_sheets(t, scope, as_of.date(), excluded_customers)
    return write_bundle(sheets, out, contracts=sheet_contracts(scope), run=stamp(as_of, zone))


# Charts as (x, y, window of the x axis, window of the y axis).
CHARTS = {
    "aging_of_account_charge": ("placed_days", "not_billed_acct_charge", (0, 550), (0, 90_000)),
    "aging_of_account_charge_inner": ("placed_days", "not_billed_acct_charge", (0, 200), (0, 10_000)),
    "no_fax_charge": ("pct_no_fax_record_not_billed", "no_fax_avg_record_charge", (0, 1), (0, 10_000)),
    "no_fax_charge_inner": ("pct_no_fax_record_not_billed", "no_fax_avg_record_charge", (0, 1), (0, 2_000)),
}


def report_chart(report: DataFrame, name: str) -> DataFrame:
    """Points of a named chart over the account report (not billed) or the payer report (no fax).

    Rows of equal rank in the report are ordered by their key, so that reruns agree.
    """
    x, y, xs, ys = CHARTS[name]
    if y == "not_billed_acct_charge":
        order = [F.desc_nulls_first("pct_not_billed_record"), F.desc_nulls_first(y), F.asc_nulls_last("pat_acct")]
    else:
        order = [F.desc_nulls_first(x), F.desc_nulls_first(y), F.asc_nulls_last("insurance_name")]
    return chart_points(report, x, y, order, xs, ys)
