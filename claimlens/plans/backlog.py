"""Backlog of pending and rejected bills."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimlens.functions.dates import clean_date, parse_date
from claimlens.functions.flags import not_among
from claimlens.functions.text import (
    blank_to_null,
    contains_ci,
    first_text,
    json_record,
    labelled,
    pg_initcap,
    quoted,
)
from claimlens.operators.joins import absent

# JSON keys of the two kinds of bills.
REJECTED_KEYS = (
    "patient_firstname",
    "patient_lastname",
    "patient_dob",
    "patient_ssn",
    "admission_date",
    "discharge_date",
    "LX01_service_date",
    "reject_info",
)
PENDING_KEYS = (
    "patient_firstname",
    "patient_first_name",
    "patient_lastname",
    "patient_last_name",
    "patient_dob",
    "patient_ssn",
    "admit_date_or_service_date",
    "discharge_date_or_end_service_date",
    "LX01_service_date",
    "holding_info",
    "ml_reason",
)


def _bills(
    rows: DataFrame,
    keys: tuple[str, ...],
    tag: str,
    first: list[str],
    last: list[str],
    dates: list[str],
    reason: list[str] | None,
    agency_pattern: str,
    excluded_customers,
    quotes: bool,
) -> DataFrame:
    parsed = rows.filter(not_among(F.col("cust_id"), excluded_customers)).withColumn(
        "j", json_record(F.col("content"), *keys)
    )
    ssn = F.lpad(blank_to_null(F.col("j.patient_ssn")), 9, "0")
    internal = F.col("j.reject_info") if reason is None else first_text(*[F.col(r) for r in reason])
    note = F.when(contains_ci(F.col("notes"), agency_pattern), internal).otherwise(F.col("notes"))
    return parsed.select(
        F.to_date("created_at").alias("created_at"),
        F.lit(tag).alias("table"),
        "cust_id",
        "pat_acct",
        first_text(*[F.col(c) for c in first]).alias("pat_firstname"),
        first_text(*[F.col(c) for c in last]).alias("pat_lastname"),
        labelled("dob ", parse_date(blank_to_null(F.col("j.patient_dob")))).alias("pat_dob"),
        F.when(ssn.isNotNull(), labelled("ssn ", quoted(ssn) if quotes else ssn)).alias("pat_ssn"),
        labelled("dos ", clean_date(*[F.col(c) for c in dates])).alias("approx_dos"),
        blank_to_null(F.replace(note, F.lit(","), F.lit(";"))).alias("user_note"),
        F.when(F.col("processed"), "processed Y").otherwise("processed N").alias("processed"),
        labelled("processed at ", F.to_date("processed_at")).alias("processed_at"),
        F.col("orig_file_name").alias("data_file"),
    )


def pending_rejected(
    t: Mapping[str, DataFrame],
    excluded_customers=(),
    agency_pattern: str = "AGY",
    quotes: bool = True,
) -> DataFrame:
    """Rejected and pending bills whose account never became a raw bill.

    Notes that mention the agency (``agency_pattern``) are replaced by the reason in the bill's
    JSON. ``quotes`` wraps the account and SSN in double quotes for spreadsheets; the accounts are
    compared before that.
    """
    dates = ["admit_date_or_service_date", "discharge_date"]
    rejected = _bills(
        t["rejected_bills"],
        REJECTED_KEYS,
        "rejected_raw_bills",
        ["patient_firstname", "j.patient_firstname"],
        ["patient_lastname", "j.patient_lastname"],
        [*dates, "j.admission_date", "j.discharge_date", "j.LX01_service_date"],
        None,
        agency_pattern,
        excluded_customers,
        quotes,
    )
    pending = _bills(
        t["pending_bills"],
        PENDING_KEYS,
        "pending_raw_bills",
        ["j.patient_firstname", "j.patient_first_name"],
        ["j.patient_lastname", "j.patient_last_name"],
        [*dates, "j.admit_date_or_service_date", "j.discharge_date_or_end_service_date", "j.LX01_service_date"],
        ["j.holding_info", "j.ml_reason"],
        agency_pattern,
        excluded_customers,
        quotes,
    )
    received = t["client_raw_bills"].filter(not_among(F.col("cust_id"), excluded_customers))
    account: Column = quoted(F.col("pat_acct")) if quotes else F.col("pat_acct")
    names = t["customers"].select("cust_id", pg_initcap(F.col("cust_name")).alias("cust_name"))
    return (
        absent(rejected.unionByName(pending), received, ["cust_id", "pat_acct"])
        .join(names, "cust_id", "left")
        .select(
            "created_at",
            "table",
            "cust_id",
            "cust_name",
            account.alias("pat_acct"),
            "pat_firstname",
            "pat_lastname",
            "pat_dob",
            "pat_ssn",
            "approx_dos",
            "user_note",
            "processed",
            "processed_at",
            "data_file",
        )
        .orderBy(F.desc_nulls_first("created_at"), F.asc_nulls_last("cust_id"), F.asc_nulls_last("pat_acct"))
    )
