"""One claim report for several customers."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimlens.functions.dates import parse_date
from claimlens.functions.text import blank_to_null, contains_ci, json_fields, pg_concat
from claimlens.operators.ids import kept_ids
from claimlens.operators.latest import latest_rows
from claimlens.operators.lists import TextList, group_lists, set_text

KEYS = ["cust_id", "pat_acct"]

# Where a note names a check number and an amount.
CHECK_NUMBER = r"(?<=# )(\d{1,30})"
CHECK_AMOUNT = r"(?<=\$)[^,]*"
SHORT_NOTE = 100
# JSON keys of a claim.
CLAIM_FACTS = ("accident_state", "facility", "service_date")


def check_columns(note: Column) -> tuple[Column, Column]:
    """Check number and amount mined from a payment note; the amount only beside a number."""
    pays = contains_ci(note, "payment of") & contains_ci(note, "check")
    number = F.when(pays, F.regexp_substr(note, F.lit(CHECK_NUMBER)))
    amount = F.when(number.isNotNull(), F.regexp_substr(note, F.lit(CHECK_AMOUNT)))
    return number, amount


def received_claims(t: Mapping[str, DataFrame], cust_ids=None) -> DataFrame:
    """Raw bills as they are, not deduplicated."""
    bills = t["client_raw_bills"]
    service = blank_to_null(F.col("j.service_date"))
    return (
        kept_ids(bills, "cust_id", cust_ids)
        .withColumn("j", json_fields(bills, "claim_content", *CLAIM_FACTS))
        .select(
            *KEYS,
            F.col("total_charges").alias("charges"),
            F.col("j.accident_state").alias("accident_state"),
            F.col("j.facility").alias("facility"),
            F.when(service.isNotNull(), parse_date(service)).otherwise(F.col("admission_date")).alias("date_of_service"),
        )
    )


def latest_status(t: Mapping[str, DataFrame], cust_ids=None) -> DataFrame:
    """Latest status rows per account, ties kept, with the dictionary text."""
    rows = kept_ids(t["patient_accounts"], "cust_id", cust_ids).select(*KEYS, "status_code", "status_date")
    texts = t["status_codes"].select(
        "status_code",
        pg_concat(F.col("status_desc"), " -- ", F.col("default_x12_code"), " -- ", F.col("usage")).alias("status_description"),
    )
    return (
        latest_rows(rows, KEYS, "status_date", keep_unknown=False)
        .join(texts, "status_code", "left")
        .select(*KEYS, "status_date", F.col("status_code").alias("account_status"), "status_description")
    )


def latest_bill(t: Mapping[str, DataFrame], cust_ids=None) -> DataFrame:
    """Latest bill rows per account, ties kept."""
    rows = (
        kept_ids(t["billing"], "cust_id", cust_ids)
        .select(
            *KEYS,
            F.col("bill_sent_at").alias("bill_drop_date"),
            pg_concat(F.col("sending_method"), "_OB_", F.col("vendor")).alias("claim_submission_date"),
        )
    )
    return latest_rows(rows, KEYS, "bill_drop_date", keep_unknown=False)


def latest_response_lists(t: Mapping[str, DataFrame], cust_ids=None) -> DataFrame:
    """Lists over the responses with the account's latest timestamp.

    The lists are distinct per column, so they are taken straight from the rows; pairing every
    response with every payment note of the same moment would give the same lists.
    """
    rows = kept_ids(t["claim_responses"], "cust_id", cust_ids)
    note = blank_to_null(F.col("note"))
    number, amount = check_columns(F.col("note"))
    tops = (
        rows.groupBy(*KEYS)
        .agg(F.max("created_at").alias("top"))
        .select(F.col("cust_id").alias("top_cust"), F.col("pat_acct").alias("top_acct"), "top")
    )
    last = rows.join(
        tops,
        (F.col("cust_id") == F.col("top_cust"))
        & (F.col("pat_acct") == F.col("top_acct"))
        & (F.col("created_at") == F.col("top")),
    ).select(*KEYS, "code", "note", "created_at")
    lists = {
        "check_num": TextList(number, "; "),
        "check_amount": TextList(amount, "; "),
        "response_code": TextList(F.col("code"), "; "),
        "description": TextList(F.when(F.length(note) <= SHORT_NOTE, note), "; "),
        "all_notes": TextList(F.when(F.length(note) > SHORT_NOTE, note), "; "),
    }
    day = F.to_date(F.max("created_at")).cast("string").alias("response_date")
    return group_lists(last, KEYS, lists, [day])


def posted_payments(t: Mapping[str, DataFrame], cust_ids=None) -> DataFrame:
    return (
        kept_ids(t["transactions"], "cust_id", cust_ids)
        .filter(~F.col("duplicate_payment"))
        .groupBy(*KEYS)
        .agg(F.round(F.sum("trans_amt"), 0).alias("tot_payment"), F.max("trans_date").alias("payment_date"))
    )


def account_sources(t: Mapping[str, DataFrame], cust_ids=None) -> DataFrame:
    return group_lists(
        kept_ids(t["pre_billing"], "cust_id", cust_ids),
        KEYS,
        {"claim_num": TextList(F.col("claim_num"), "; ")},
        [
            F.countDistinct("src_sk").alias("acct_num_of_src"),
            set_text(F.col("claim_type"), "; ").alias("claim_type"),
            set_text(F.col("insurance_name"), "; ").alias("insurance_name"),
        ],
    )


def consolidated_claims(t: Mapping[str, DataFrame], cust_ids=None) -> DataFrame:
    """Raw bills with latest status, bill and response, payments and payers of their account.

    ``cust_ids``, a list or a frame, restricts every table; ``None`` takes all customers. An account has a row per raw
    bill, tied latest status and tied latest bill, as the plain joins give.
    """
    joined = received_claims(t, cust_ids)
    for satellite in (
        latest_status(t, cust_ids),
        latest_bill(t, cust_ids),
        latest_response_lists(t, cust_ids),
        posted_payments(t, cust_ids),
        account_sources(t, cust_ids),
    ):
        joined = joined.join(satellite, KEYS, "left")
    return joined.select(
        "cust_id",
        "acct_num_of_src",
        "pat_acct",
        "accident_state",
        "facility",
        "date_of_service",
        "status_date",
        "account_status",
        "status_description",
        "bill_drop_date",
        "claim_submission_date",
        "charges",
        "check_num",
        "check_amount",
        "tot_payment",
        "payment_date",
        "claim_type",
        "insurance_name",
        "claim_num",
        "response_date",
        "response_code",
        "description",
        "all_notes",
    ).orderBy(F.asc_nulls_last("cust_id"), F.desc_nulls_first("date_of_service"), F.asc_nulls_last("pat_acct"))
