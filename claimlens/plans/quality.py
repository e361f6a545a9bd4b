"""Hit rate and quality of demographic data."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimlens.functions import validity as v
from claimlens.functions.flags import not_among, share
from claimlens.functions.text import blank_to_null, first_text, json_fields, phone_digits
from claimlens.operators.ids import kept_ids
from claimlens.operators.lists import TextList, group_lists, set_text
from claimlens.plans.aging import recent_customers
from claimlens.plans.rules import ACTIVE_DAYS

KEYS = ["cust_id", "pat_acct"]

# JSON keys of a raw bill and of its claim.
BILL_KEYS = (
    "facility_state",
    "servicing_provider_location_state",
    "patient_lastname",
    "patient_firstname",
    "patient_addr1",
    "patient_city",
    "patient_state",
    "patient_phone",
    "patient_ssn",
)
CLAIM_KEYS = ("patient_phone", "patient_ssn")

DEMOGRAPHICS = (
    "facility_or_svc_prvd_state",
    "patient_lastname",
    "patient_firstname",
    "patient_addr1",
    "patient_city",
    "patient_state",
    "patient_phone",
    "patient_ssn",
)


def active_customers(t: Mapping[str, DataFrame], as_of: dt.date, days: int = ACTIVE_DAYS) -> DataFrame:
    """Customers billed within the last ``days`` days."""
    return recent_customers(t, as_of, days).orderBy(F.asc_nulls_last("cust_id"))


def known_customers(t: Mapping[str, DataFrame], exclude=()) -> DataFrame:
    """Distinct customers of the raw bills with their names."""
    ids = t["client_raw_bills"].filter(not_among(F.col("cust_id"), exclude)).select("cust_id").distinct()
    return ids.join(t["customers"].select("cust_id", "cust_name"), "cust_id", "left").distinct()


def demographics(t: Mapping[str, DataFrame], cust_ids=None) -> DataFrame:
    """One row per raw bill: demographic values from its JSON, phone stripped to digits.

    ``cust_ids`` is a list of customers or a frame of them (``operators.ids``); ``None`` takes all.
    """
    bill = F.col("bill")
    claim = F.col("claim")
    phone = phone_digits(first_text(bill["patient_phone"], claim["patient_phone"]))
    ssn = first_text(bill["patient_ssn"], claim["patient_ssn"])
    plain = ["patient_lastname", "patient_firstname", "patient_addr1", "patient_city", "patient_state"]
    bills = t["client_raw_bills"]
    return (
        kept_ids(bills, "cust_id", cust_ids)
        .select(
            *KEYS,
            "created_at",
            json_fields(bills, "content", *BILL_KEYS).alias("bill"),
            json_fields(bills, "claim_content", *CLAIM_KEYS).alias("claim"),
        )
        .select(
            *KEYS,
            "created_at",
            first_text(bill["facility_state"], bill["servicing_provider_location_state"]).alias("facility_or_svc_prvd_state"),
            *[bill[c].alias(c) for c in plain],
            blank_to_null(phone).alias("patient_phone"),
            blank_to_null(ssn).alias("patient_ssn"),
        )
    )


def account_profiles(
    t: Mapping[str, DataFrame],
    cust_ids=None,
    lists: Sequence[str] = DEMOGRAPHICS,
    strict: bool = True,
) -> DataFrame:
    """One row per account: the requested lists, presence of each value, validity flags, payers."""
    address, phone = F.col("patient_addr1"), F.col("patient_phone")
    accounts = group_lists(
        demographics(t, cust_ids),
        KEYS,
        {name: TextList(F.col(name), "; ") for name in lists},
        [
            F.to_date(F.min("created_at")).cast("string").alias("info_received"),
            *[F.max(F.when(F.col(c).isNotNull(), 1)).alias("has_" + c) for c in DEMOGRAPHICS],
            F.bool_or(v.bad_address(address)).alias("bad_address"),
            F.bool_or(v.says_something(address)).alias("any_address"),
            F.bool_or(v.repeats_one_digit(phone)).alias("repeated_phone"),
        ],
    )
    payers = (
        kept_ids(t["pre_billing"], "cust_id", cust_ids)
        .groupBy(*KEYS)
        .agg(set_text(F.col("insurance_name"), ";  ").alias("payers_match"))
    )
    return (
        accounts.join(payers, KEYS, "left")
        .withColumn("flag_valid_addr1", v.valid_address(F.col("bad_address"), F.col("any_address")))
        .withColumn("flag_valid_phone", v.valid_phone(phone, F.col("repeated_phone")))
        .withColumn("flag_valid_ssn", v.valid_ssn(F.col("patient_ssn"), strict))
        .withColumn("eligibility_found", v.found(F.col("payers_match")))
    )


def account_quality(
    t: Mapping[str, DataFrame], cust_ids=None, strict: bool = True
) -> DataFrame:
    """Accounts with demographics, validity flags and matched payers."""
    return (
        account_profiles(t, cust_ids, DEMOGRAPHICS, strict)
        .select(
            *KEYS,
            "info_received",
            "facility_or_svc_prvd_state",
            "patient_lastname",
            "patient_firstname",
            "patient_addr1",
            "flag_valid_addr1",
            "patient_city",
            "patient_state",
            "patient_phone",
            "flag_valid_phone",
            "patient_ssn",
            "flag_valid_ssn",
            "eligibility_found",
            "payers_match",
        )
        .orderBy(
            F.desc_nulls_first("info_received"),
            F.asc_nulls_last("facility_or_svc_prvd_state"),
            *[F.asc_nulls_last(k) for k in KEYS],
        )
    )


def data_quality(
    t: Mapping[str, DataFrame], cust_ids=None, suppressed_customers=(), strict: bool = True
) -> DataFrame:
    """Hit rate and shares of usable values per customer, lowest hit rate first.

    The hit rate of ``suppressed_customers`` is left empty. Only the phone and SSN lists are built,
    as their rules read leading characters.
    """
    rows = F.col("cnt_accts")
    shown = not_among(F.col("cust_id"), suppressed_customers)
    per_customer = (
        account_profiles(t, cust_ids, ("patient_phone", "patient_ssn"), strict)
        .groupBy("cust_id")
        .agg(
            F.sum("eligibility_found").alias("found"),
            F.count("*").alias("cnt_accts"),
            F.count("has_patient_firstname").alias("firstnames"),
            F.count("has_patient_lastname").alias("lastnames"),
            F.sum("flag_valid_addr1").alias("addresses"),
            F.count("has_patient_city").alias("cities"),
            F.count("has_patient_state").alias("states"),
            F.sum("flag_valid_phone").alias("phones"),
            F.sum("flag_valid_ssn").alias("ssns"),
        )
        .select(
            "cust_id",
            F.when(shown, F.col("found")).alias("cnt_accts_eligibility_found"),
            "cnt_accts",
            F.when(shown, share(F.col("found"), rows)).alias("hit_rate"),
            share(F.col("firstnames"), rows).alias("perc_valid_firstname"),
            share(F.col("lastnames"), rows).alias("perc_valid_lastname"),
            share(F.col("addresses"), rows).alias("pct_valid_addr1"),
            share(F.col("cities"), rows).alias("pct_valid_city"),
            share(F.col("states"), rows).alias("pct_valid_state"),
            share(F.col("phones"), rows).alias("pct_valid_phone"),
            share(F.col("ssns"), rows).alias("pct_valid_ssn"),
        )
    )
    names = t["customers"].select("cust_id", "master_id", "cust_name", "cust_type")
    front = ["master_id", "cust_id", "cust_name", "cust_type"]
    return (
        per_customer.join(names, "cust_id", "left")
        .select(*front, *[c for c in per_customer.columns if c != "cust_id"])
        .orderBy(F.asc_nulls_last("hit_rate"), F.desc_nulls_first("cnt_accts"))
    )
