"""Summaries by workflow status and by pre-billing stage."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimlens.plans.accounts import account_status_text
from claimlens.plans.rules import in_scope, stage_text, status_dictionary

COUNTED = {"insurance": "insurance_name", "account": "pat_acct"}


def status_order(scope: str) -> list[Column]:
    number = "pre_billing_record" if scope == "all" else "not_billed_record"
    return [F.desc_nulls_first(number), F.asc_nulls_last("pat_acct_status")]


def stage_order() -> list[Column]:
    return [F.desc_nulls_first("not_billed_record"), F.asc_nulls_last("pre_billing_record_status")]


def status_summary(
    t: Mapping[str, DataFrame],
    by: str = "insurance",
    scope: str = "all",
    excluded_customers=(),
    agency: str = "Agency",
    prefix: str = "AGY",
) -> DataFrame:
    """Records and distinct payers (or accounts) per workflow status, with the status texts.

    A record counts once per patient-account row of its account. Records and patient accounts are
    both reduced to counts per account before they meet, so the product is never written out.
    """
    counted = COUNTED[by]
    records = (
        t["pre_billing"]
        .filter(in_scope(scope, excluded_customers))
        .groupBy(*dict.fromkeys(["pat_acct", counted]))
        .agg(F.count("*").alias("records"))
    )
    patients = t["patient_accounts"].groupBy("pat_acct", "status_code").agg(F.count("*").alias("copies"))
    number = "pre_billing_record" if scope == "all" else "not_billed_record"
    counts = (
        records.join(account_status_text(t), "pat_acct", "left")
        .join(patients, "pat_acct", "left")
        .withColumn("pat_acct_status", F.coalesce("status_code", "status"))
        .groupBy("pat_acct_status")
        .agg(
            F.sum(F.col("records") * F.coalesce("copies", F.lit(1))).alias(number),
            F.countDistinct(counted).alias(f"distinct_{counted}"),
        )
    )
    texts = status_dictionary(counts.sparkSession, t["status_codes"], agency, prefix)
    return (
        counts.join(texts, "pat_acct_status", "left")
        .select("pat_acct_status", number, f"distinct_{counted}", "description", "x12_code", "note")
        .orderBy(*status_order(scope))
    )


def prebill_summary(
    t: Mapping[str, DataFrame],
    by: str = "insurance",
    scope: str = "all",
    excluded_customers=(),
    agency: str = "Agency",
) -> DataFrame:
    """Records and distinct payers (or accounts) per pre-billing stage, with its description."""
    counted = COUNTED[by]
    return (
        t["pre_billing"]
        .filter(in_scope(scope, excluded_customers))
        .groupBy("status")
        .agg(F.count("*").alias("not_billed_record"), F.countDistinct(counted).alias(f"distinct_{counted}"))
        .select(
            F.col("status").alias("pre_billing_record_status"),
            "not_billed_record",
            f"distinct_{counted}",
            stage_text(F.col("status"), scope, agency).alias("description"),
        )
        .orderBy(*stage_order())
    )
