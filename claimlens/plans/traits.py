"""Claim-response traits and payer capability."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimlens.functions.dates import days_old, parse_date, years
from claimlens.functions.flags import one_zero, without
from claimlens.functions.text import blank_to_null, json_fields, json_text
from claimlens.operators.joins import coalesced_full_join, column_lookup
from claimlens.operators.latest import latest_rows
from claimlens.operators.lists import set_text
from claimlens.plans.rules import (
    CLIENT_BILL_NO_DIAGNOSIS,
    CLIENT_BILL_NO_GENDER,
    RAW_BILL_NO_DIAGNOSIS,
    RAW_BILL_NO_GENDER,
    RESPONSE_RULES,
    response_rule,
)


# JSON keys of the raw-bill tables.
CLIENT_BILL_FACTS = ("patient_dob", "patient_gender")
RAW_BILL_FACTS = ("patient_dob", "patient_gender", "primary_diagnostic_code")


def ruled_responses(
    t: Mapping[str, DataFrame], excluded_source: str | None = None, rules=RESPONSE_RULES
) -> DataFrame:
    """Responses that meet a rule and do not come from the excluded source."""
    rows = t["claim_responses"].filter(response_rule(F.col("code"), F.col("note"), rules))
    if excluded_source is None:
        return rows
    return rows.filter(~F.col("response_from").eqNullSafe(excluded_source))


def latest_responses(
    t: Mapping[str, DataFrame], as_of: dt.date, excluded_source: str | None = None, rules=RESPONSE_RULES
) -> DataFrame:
    """Latest ruled responses per account and payer, ties kept; groups without a payer give an
    empty row."""
    payers = t["pre_billing"].select("pm_sk", "insurance_name")
    named = ruled_responses(t, excluded_source, rules).join(payers, "pm_sk", "left").select(
        "pm_sk",
        "cust_id",
        "pat_acct",
        "insurance_name",
        F.col("code").alias("claim_x12_code"),
        F.col("note").alias("user_note"),
        "created_at",
    )
    return latest_rows(named, ["pat_acct", "insurance_name"], "created_at", blank_keys=True).withColumn(
        "days_frm_response", days_old(F.col("created_at"), as_of)
    )


def _list_initial(value: Column) -> Column:
    """First character of the distinct list of a column: an empty first item shows the separator."""
    low, high = F.min(value), F.max(value)
    return F.when((low == "") & (high != ""), ";").otherwise(F.left(low, F.lit(1)))


def _traits(
    bills: DataFrame,
    charge: Column,
    start: Column,
    end: Column,
    diagnosis: Column,
    born: Column,
    gender: Column,
    no_diagnosis: list[str],
    no_gender: list[str],
) -> DataFrame:
    age = F.col("pat_age")
    return (
        bills.groupBy("pat_acct")
        .agg(
            F.max(F.round(charge, 0).cast("bigint")).alias("acct_charge"),
            F.min(F.datediff(F.to_date("created_at"), F.greatest(start, end))).alias("days_dos_to_received"),
            _list_initial(diagnosis).alias("principal_diagnosis"),
            F.max(years(F.least(start, end), parse_date(born))).alias("pat_age"),
            set_text(gender, "; ").alias("pat_gender"),
        )
        .select(
            "pat_acct",
            "acct_charge",
            "days_dos_to_received",
            without(F.col("principal_diagnosis"), no_diagnosis).alias("principal_diagnosis"),
            F.when(age > 0, age.cast("string")).alias("pat_age"),
            without(F.col("pat_gender"), no_gender).alias("pat_gender"),
        )
    )


def account_traits(t: Mapping[str, DataFrame]) -> DataFrame:
    """Charge, received lag, diagnosis class, age and gender per account from both raw-bill tables;
    the client table goes first, column by column."""
    client, older = t["client_raw_bills"], t["raw_bills"]
    client = client.withColumn("j", json_fields(client, "content", *CLIENT_BILL_FACTS))
    older = older.withColumn("j", json_fields(older, "content", *RAW_BILL_FACTS))
    first = _traits(
        client,
        F.col("total_charges"),
        F.col("admission_date"),
        F.col("discharge_date"),
        F.col("principal_diagnosis"),
        F.col("j.patient_dob"),
        F.col("j.patient_gender"),
        CLIENT_BILL_NO_DIAGNOSIS,
        CLIENT_BILL_NO_GENDER,
    )
    second = _traits(
        older,
        F.col("gross_charges"),
        F.col("admit_date_or_service_date"),
        F.col("discharge_date"),
        F.col("j.primary_diagnostic_code"),
        blank_to_null(F.col("j.patient_dob")),
        F.col("j.patient_gender"),
        RAW_BILL_NO_DIAGNOSIS,
        RAW_BILL_NO_GENDER,
    )
    return coalesced_full_join(first, second, ["pat_acct"])


def billing_traits(t: Mapping[str, DataFrame]) -> DataFrame:
    """One row per record: independent maxima, so columns may come from different bills."""
    return (
        t["billing"]
        .groupBy("pm_sk")
        .agg(
            F.max("claim_type").alias("claim_type"),
            F.max("accident_state").alias("accident_state"),
            F.max("patient_state").alias("patient_state"),
            F.greatest(F.max("ldos"), F.max("fdos")).alias("last_service"),
            F.max("accident_date").alias("accident_date"),
        )
        .select(
            "pm_sk",
            "claim_type",
            one_zero(F.col("accident_state") == F.col("patient_state")).alias("pat_eq_accident_state"),
            "accident_state",
            F.datediff("last_service", "accident_date").alias("days_accident_to_dos"),
        )
    )


def claim_response_traits(
    t: Mapping[str, DataFrame], as_of: dt.date, excluded_source: str | None = None, rules=RESPONSE_RULES
) -> DataFrame:
    """Latest actionable responses with the traits of their customer, account, bill and payer."""
    edi = (
        t["pre_billing"]
        .groupBy("insurance_name")
        .agg(set_text(json_text(F.col("content"), "edi_payer_id"), ";  ").alias("edi_payer_id"))
    )
    return (
        latest_responses(t, as_of, excluded_source, rules)
        .join(t["customers"].select("master_id", F.col("cust_id").alias("known_cust"), "cust_name"), F.col("cust_id") == F.col("known_cust"), "left")
        .join(account_traits(t), "pat_acct", "left")
        .join(billing_traits(t), "pm_sk", "left")
        .join(edi, "insurance_name", "left")
        .select(
            "pm_sk",
            "master_id",
            F.col("known_cust").alias("cust_id"),
            "cust_name",
            "pat_acct",
            "insurance_name",
            "claim_x12_code",
            "user_note",
            "days_frm_response",
            "acct_charge",
            "claim_type",
            "days_accident_to_dos",
            "days_dos_to_received",
            "principal_diagnosis",
            "pat_age",
            "pat_gender",
            "pat_eq_accident_state",
            "accident_state",
            "edi_payer_id",
        )
    )


def payer_capability(traits: DataFrame, payer_list: DataFrame, state_columns: Sequence[str] | None = None) -> DataFrame:
    """Traits with the payer list's columns, and whether the payer covers the accident state.

    ``payer_list`` has one row per ``edi_payer_id`` (``clean_payer_list``). A payer whose id is a
    list of ids matches nothing, see ``unmatched_payers``.
    """
    columns = [c for c in payer_list.columns if c != "edi_payer_id"]
    joined = traits.join(payer_list, "edi_payer_id", "left")
    covered = column_lookup(F.col("accident_state"), list(state_columns) if state_columns is not None else columns)
    front = traits.columns[: traits.columns.index("edi_payer_id")]
    return joined.select(
        *front,
        covered.alias("accident_state_covered"),
        "edi_payer_id",
        *[F.col(f"`{c}`") for c in columns],
        F.lit(None).cast("double").alias("rej_den_clearing_house"),
        F.lit(None).cast("double").alias("den_payer"),
    )


def unmatched_payers(traits: DataFrame, payer_list: DataFrame) -> DataFrame:
    """Payer ids of the traits that the payer list does not hold, with their row counts."""
    return (
        traits.filter(F.col("edi_payer_id").isNotNull())
        .groupBy("edi_payer_id")
        .agg(F.count("*").alias("responses"))
        .join(payer_list.select("edi_payer_id"), "edi_payer_id", "left_anti")
    )
