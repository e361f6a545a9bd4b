"""Opportunity reports by payer and by account."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimlens.functions.dates import day
from claimlens.functions.flags import not_among, rows_where, share, yes_no_null
from claimlens.functions.text import json_text
from claimlens.operators.lists import TextList, list_and_sums, list_chunks, list_items, set_text, text_lists
from claimlens.plans.accounts import (
    account_payments,
    first_billing,
    first_received,
    statuses_text,
    unbilled_payments,
    with_statuses,
)
from claimlens.plans.rules import BILLED, in_scope, no_fax
from claimlens.sinks.bundle import Contract, with_kinds


# Rows with long lists go to so many tasks at most; up to this number a shuffle writes rows without gathering them.
LIST_TASKS = 200


# The account is the last key, so that no value of the others fills one partition of the sort.
def account_order() -> list[Column]:
    return [
        F.desc_nulls_first("pct_not_billed_record"),
        F.desc_nulls_first("not_billed_acct_charge"),
        F.asc_nulls_last("pat_acct"),
    ]


def payer_order(scope: str) -> list[Column]:
    columns = {
        "all": ("pct_not_billed_record", "not_billed_avg_record_charge"),
        "not_billed": ("pct_not_billed_record", "not_billed_avg_record_charge"),
        "no_fax": ("pct_no_fax_record_not_billed", "no_fax_avg_record_charge"),
    }[scope]
    return [*(F.desc_nulls_first(c) for c in columns), F.asc_nulls_last("insurance_name")]


def _billed() -> Column:
    return F.col("status") == BILLED


def _unbilled() -> Column:
    return F.col("status") != BILLED


def _known(key: str, value: Column) -> Column:
    """A value that comes from an equi join on the key: nothing is found for a NULL key."""
    return F.when(F.col(key).isNotNull(), value)


def _payer_accounts(t: Mapping[str, DataFrame], test: Column) -> DataFrame:
    """``insurance_name``, ``pat_acct``, ``records`` of the rows passing a test."""
    return t["pre_billing"].filter(test).groupBy("insurance_name", "pat_acct").agg(F.count("*").alias("records"))


def _payer_statuses(t: Mapping[str, DataFrame], test: Column) -> DataFrame:
    """Resolved status list per payer."""
    return (
        with_statuses(_payer_accounts(t, test), t)
        .select("insurance_name", F.explode("statuses").alias("one"))
        .distinct()
        .groupBy("insurance_name")
        .agg(set_text(F.col("one"), ";  ").alias("pat_acct_status"))
    )


def _in_order(rows: DataFrame, scope: str, contract: Contract | None) -> DataFrame:
    """``orderBy`` for rows with long lists, which compress so well that a task would get many of them: by range, to
    tasks that are not merged. The kinds of a sheet's columns are set before, as every later step copies the lists."""
    order = payer_order(scope)
    rows = with_kinds(rows, contract) if contract else rows
    return rows.repartitionByRange(LIST_TASKS, *order).sortWithinPartitions(*order)


def _payer_payment_rows(t: Mapping[str, DataFrame]) -> DataFrame:
    """Account payments of a payer's unbilled records: one row per payer, account and payment
    source; it stands for ``records`` equal rows."""
    return _payer_accounts(t, _unbilled()).join(unbilled_payments(t, ";   "), "pat_acct", "left")


def _with_payments(report: DataFrame, t: Mapping[str, DataFrame], lists: Mapping[str, TextList]) -> DataFrame:
    """Adds payments and payer list of each payer, from one pass over the payment rows."""
    ((name, spec),) = lists.items()
    paid = {"not_billed_tot_acct_payment": F.col("amount") * F.col("records")}
    return list_and_sums(_payer_payment_rows(t), ["insurance_name"], name, spec, paid, report)


def _payment_lists(scope: str) -> dict[str, TextList]:
    times = None if scope == "all" else F.col("records")
    return {
        "not_billed_tot_acct_payer": TextList(F.col("payers"), ";   ", distinct=scope == "all", times=times)
    }


def _account_list() -> dict[str, TextList]:
    return {"pat_acct": TextList(F.col("acct"), ";  ")}


def _accounts_in(t: Mapping[str, DataFrame], test: Column) -> DataFrame:
    return t["pre_billing"].filter(test).select("insurance_name", F.col("pat_acct").alias("acct"))


def payer_opportunity(
    t: Mapping[str, DataFrame], scope: str = "all", excluded_customers=(), contract: Contract | None = None
) -> DataFrame:
    """One row per payer: stages, record counts, unbilled share and charge, payments.

    The report on all claims has every payer, the others the payers with rows in scope.
    ``payer_opportunity_items`` has the open-ended lists in long form. With a ``contract`` the columns have its kinds.
    """
    if scope == "all":
        return _payer_all(t, contract)
    if scope == "not_billed":
        return _payer_not_billed(t, contract)
    return _payer_no_fax(t, excluded_customers, contract)


def _open_lists(t: Mapping[str, DataFrame], scope: str, excluded_customers) -> list[tuple[DataFrame, dict[str, TextList]]]:
    """Rows and lists of the payer report whose length has no bound."""
    parts = []
    if scope != "no_fax":
        parts.append((_payer_payment_rows(t), _payment_lists(scope)))
    if scope != "all":
        parts.append((_accounts_in(t, in_scope(scope, excluded_customers)), _account_list()))
    return parts


def _stacked(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for more in frames[1:]:
        out = out.unionByName(more)
    return out


def payer_opportunity_items(t: Mapping[str, DataFrame], scope: str = "all", excluded_customers=()) -> DataFrame:
    """Long form of the payer report's open-ended lists: ``insurance_name``, ``list_name``,
    ``item``, ``copies``."""
    parts = _open_lists(t, scope, excluded_customers)
    return _stacked([list_items(rows, ["insurance_name"], lists) for rows, lists in parts])


def payer_opportunity_chunks(
    t: Mapping[str, DataFrame], scope: str = "all", excluded_customers=(), size: int = 10_000
) -> DataFrame:
    """The same lists in numbered pieces, for payers whose list is too long for one cell."""
    parts = _open_lists(t, scope, excluded_customers)
    return _stacked([list_chunks(rows, ["insurance_name"], lists, size) for rows, lists in parts])


def _payer_all(t: Mapping[str, DataFrame], contract: Contract | None) -> DataFrame:
    base = (
        t["pre_billing"]
        .groupBy("insurance_name")
        .agg(
            set_text(F.col("status"), "; ").alias("pre_billing_record_status"),
            F.count("*").alias("pre_billing_record"),
            rows_where(_billed()).alias("billed_record"),
            rows_where(_unbilled()).alias("not_billed_record"),
            F.round(F.avg(F.when(_unbilled(), F.col("charges"))), 0).alias("charge"),
        )
        .withColumn("pct_not_billed_record", share(F.col("not_billed_record"), F.col("pre_billing_record")))
        .withColumn("not_billed_avg_record_charge", _known("insurance_name", F.col("charge")))
    )
    report = base.join(_payer_statuses(t, F.lit(True)), "insurance_name", "left")
    rows = _with_payments(report, t, _payment_lists("all")).select(
        "insurance_name",
        "pat_acct_status",
        "pre_billing_record_status",
        "pre_billing_record",
        "billed_record",
        "not_billed_record",
        "pct_not_billed_record",
        "not_billed_avg_record_charge",
        "not_billed_tot_acct_payment",
        "not_billed_tot_acct_payer",
    )
    return _in_order(rows, "all", contract)


def _scope_columns(test: Column, dates: str, charge: str) -> list[Column]:
    """Aggregates over the rows in scope, taken in the same pass as the totals."""
    return [
        set_text(F.when(test, F.col("status")), "; ").alias("pre_billing_record_status"),
        set_text(F.when(test, F.col("cust_id")), "; ").alias("cust_id"),
        set_text(F.when(test, F.to_date("created_at")), ";  ").alias(dates),
        F.round(F.avg(F.when(test, F.col("charges"))), 0).alias(charge),
    ]


def _payer_not_billed(t: Mapping[str, DataFrame], contract: Contract | None) -> DataFrame:
    base = (
        t["pre_billing"]
        .groupBy("insurance_name")
        .agg(
            F.count("*").alias("records"),
            rows_where(_unbilled()).alias("unbilled"),
            *_scope_columns(_unbilled(), "assigned_record_at", "not_billed_avg_record_charge"),
        )
        .filter(F.col("unbilled") > 0)
        .withColumn("pre_billing_record", _known("insurance_name", F.col("records")))
        .withColumn("not_billed_record", _known("insurance_name", F.col("unbilled")))
        .withColumn("pct_not_billed_record", share(F.col("not_billed_record"), F.col("pre_billing_record")))
    )
    accounts = text_lists(_accounts_in(t, _unbilled()), ["insurance_name"], _account_list())
    report = base.join(
        accounts.withColumnRenamed("insurance_name", "payer"), F.col("insurance_name").eqNullSafe(F.col("payer")), "left"
    ).join(_payer_statuses(t, _unbilled()), "insurance_name", "left")
    rows = _with_payments(report, t, _payment_lists("not_billed")).select(
        "insurance_name",
        "pat_acct_status",
        "pre_billing_record_status",
        "pre_billing_record",
        "not_billed_record",
        "pat_acct",
        "cust_id",
        "assigned_record_at",
        "pct_not_billed_record",
        "not_billed_avg_record_charge",
        "not_billed_tot_acct_payment",
        "not_billed_tot_acct_payer",
    )
    return _in_order(rows, "not_billed", contract)


def _payer_no_fax(t: Mapping[str, DataFrame], excluded_customers, contract: Contract | None) -> DataFrame:
    kept = not_among(F.col("cust_id"), excluded_customers)
    faxless = no_fax(excluded_customers)
    base = (
        t["pre_billing"]
        .groupBy("insurance_name")
        .agg(
            rows_where(kept).alias("records"),
            rows_where(_unbilled() & kept).alias("unbilled"),
            rows_where(faxless).alias("faxless"),
            *_scope_columns(faxless, "assigned_insurance_at", "no_fax_avg_record_charge"),
        )
        .filter(F.col("faxless") > 0)
        .withColumn("pre_billing_record", _known("insurance_name", F.col("records")))
        .withColumn("not_billed_record", _known("insurance_name", F.col("unbilled")))
        .withColumn("no_fax", _known("insurance_name", F.col("faxless")))
        .withColumn("pct_no_fax_record_not_billed", share(F.col("no_fax"), F.col("not_billed_record")))
    )
    accounts = text_lists(_accounts_in(t, faxless), ["insurance_name"], _account_list())
    report = base.join(
        accounts.withColumnRenamed("insurance_name", "payer"), F.col("insurance_name").eqNullSafe(F.col("payer")), "left"
    ).join(_payer_statuses(t, faxless), "insurance_name", "left")
    rows = report.select(
        "insurance_name",
        "pat_acct_status",
        "pre_billing_record_status",
        "pre_billing_record",
        "not_billed_record",
        "no_fax",
        "cust_id",
        "pat_acct",
        "assigned_insurance_at",
        "pct_no_fax_record_not_billed",
        "no_fax_avg_record_charge",
    )
    return _in_order(rows, "no_fax", contract)


def account_opportunity(
    t: Mapping[str, DataFrame], scope: str, as_of: dt.date, one_row_per_account: bool = False
) -> DataFrame:
    """One row per account: counts, unbilled charge and payers, payments, first dates, states.

    ``not_billed`` keeps the accounts with unbilled rows. An account with results in both payment
    tables has a row per combination unless ``one_row_per_account`` is set. All satellites are
    aggregated by account first, so each table is shuffled once, on the account.
    """
    if scope not in ("all", "not_billed"):
        raise ValueError("scope must be 'all' or 'not_billed'")
    narrow = scope == "not_billed"
    rows = _unbilled() if narrow else F.lit(True)
    payer_sep, payment_sep = ("; ", ";   ") if narrow else (";   ", ";    ")
    paid_flag, posted_flag = (
        ("paid_bef_billing", "posted_bef_billing") if narrow else ("paid_then_billed", "posted_then_billed")
    )
    # Columns that the report looks up by account stay empty for a NULL account: for all claims
    # those of the unbilled rows and the states, for not-billed claims those of the totals.
    found = lambda value: _known("acct", value)
    totals, parts = (found, lambda value: value) if narrow else (lambda value: value, found)

    state = lambda key: set_text(F.when(rows, json_text(F.col("content"), key)), "")
    base = (
        t["pre_billing"]
        .groupBy(F.col("pat_acct").alias("acct"))
        .agg(
            F.min("cust_id").alias("cust"),
            set_text(F.when(rows, F.col("status")), "; ").alias("pre_billing_record_status"),
            F.count("*").alias("records"),
            rows_where(_billed()).alias("billed"),
            rows_where(_unbilled()).alias("unbilled"),
            F.round(F.avg(F.when(_unbilled(), F.col("charges"))), 0).alias("charge"),
            set_text(F.when(_unbilled(), F.col("insurance_name")), payer_sep).alias("payers"),
            state("cms_10_place").alias("place"),
            state("cms_7_insured_state").alias("home"),
        )
        .filter(F.col("unbilled") > 0 if narrow else F.lit(True))
        .select(
            F.col("acct").alias("pat_acct"),
            totals(F.col("cust")).alias("cust_id"),
            "pre_billing_record_status",
            totals(F.col("records")).alias("pre_billing_record"),
            totals(F.col("billed")).alias("billed_record"),
            totals(F.col("unbilled")).alias("not_billed_record"),
            totals(share(F.col("unbilled"), F.col("records"))).alias("pct_not_billed_record"),
            parts(F.col("charge")).alias("not_billed_acct_charge"),
            parts(F.col("payers")).alias("not_billed_insurance"),
            parts(F.col("place")).alias("accident_state"),
            parts(F.col("home")).alias("insured_state"),
        )
    )
    payments = account_payments(t, payment_sep, one_row_per_account).withColumnsRenamed(
        {"amount": "not_billed_acct_payment", "payers": "not_billed_acct_payer"}
    )
    star = (
        with_statuses(base, t)
        .join(payments, "pat_acct", "left")
        .join(first_received(t), "pat_acct", "left")
        .join(first_billing(t), "pat_acct", "left")
        .join(t["customers"].select("cust_id", "master_id"), "cust_id", "left")
    )
    paid, posted, billed = F.col("payment_date"), F.col("posting_date"), F.col("first_billing_date")
    place, home = F.col("accident_state"), F.col("insured_state")
    return star.select(
        "master_id",
        "cust_id",
        "pat_acct",
        statuses_text().alias("pat_acct_status"),
        "pre_billing_record_status",
        "pre_billing_record",
        "billed_record",
        "not_billed_record",
        "pct_not_billed_record",
        F.datediff(day(as_of), "received").alias("placed_days"),
        "not_billed_acct_charge",
        "not_billed_insurance",
        "not_billed_acct_payment",
        "not_billed_acct_payer",
        "payment_date",
        "posting_date",
        "first_billing_date",
        yes_no_null(paid < billed, paid, billed).alias(paid_flag),
        yes_no_null(posted < billed, posted, billed).alias(posted_flag),
        "insured_state",
        "accident_state",
        yes_no_null(place == home, place, home).alias("insured_eq_accident_state"),
    ).orderBy(*account_order())
