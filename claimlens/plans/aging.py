"""Time from a received bill to a matched payer, and response listings."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimlens.functions.dates import younger_than
from claimlens.functions.flags import one_zero, rows_where, share
from claimlens.functions.text import pg_concat
from claimlens.operators.lists import bag_text
from claimlens.plans.rules import ACTIVE_DAYS, MATCH_BUCKETS, RESPONSE_RULES, bucket_test, response_rule

BUCKETS = [name for name, _, _ in MATCH_BUCKETS]


def response_overview(t: Mapping[str, DataFrame]) -> DataFrame:
    """Latest response and row count per source, latest first."""
    return (
        t["claim_responses"]
        .groupBy("response_from")
        .agg(F.max("created_at").alias("latest"), F.count("*").alias("responses"))
        .orderBy(F.desc_nulls_first("latest"))
    )


def actionable_responses(t: Mapping[str, DataFrame], rules=RESPONSE_RULES) -> DataFrame:
    """Responses of a known source that meet a rule, newest first."""
    return (
        t["claim_responses"]
        .filter(F.col("response_from").isNotNull() & response_rule(F.col("code"), F.col("note"), rules))
        .orderBy(
            F.desc_nulls_first("created_at"),
            *[F.asc_nulls_last(c) for c in ("cust_id", "pat_acct", "response_from", "code", "note")],
        )
    )


def recent_customers(t: Mapping[str, DataFrame], as_of: dt.date, days: int = ACTIVE_DAYS) -> DataFrame:
    """Distinct customers with a bill younger than ``days`` days."""
    return t["billing"].filter(younger_than(F.col("created_at"), as_of, days)).select("cust_id").distinct()


def first_matches(t: Mapping[str, DataFrame]) -> DataFrame:
    """First match day per customer, account and payer."""
    return (
        t["pre_billing"]
        .groupBy("cust_id", "pat_acct", "insurance_name")
        .agg(F.to_date(F.min("created_at")).alias("info_matched"))
    )


def match_aging(t: Mapping[str, DataFrame], as_of: dt.date, days: int = ACTIVE_DAYS) -> DataFrame:
    """One row per account of the recently billed customers: matches and their waiting time.

    An account's list holds one item per payer. Received bills are reduced to accounts before the
    customers are filtered, so a customer with very many bills is spread by account.
    """
    received = (
        t["client_raw_bills"]
        .groupBy("cust_id", "pat_acct")
        .agg(F.to_date(F.min("created_at")).alias("info_received"))
        .join(recent_customers(t, as_of, days), "cust_id", "left_semi")
    )
    matched = received.join(first_matches(t), ["cust_id", "pat_acct"], "left").withColumn(
        "days_to_match", F.datediff("info_matched", "info_received")
    )
    item = F.nullif(pg_concat(F.col("info_matched"), " -- ", F.col("insurance_name")), F.lit(" -- "))
    return matched.groupBy("cust_id", "pat_acct", "info_received").agg(
        bag_text(item, ";  ").alias("info_matched_payer_name"),
        F.count("info_matched").alias("tot_matches"),
        *[rows_where(bucket_test(F.col("days_to_match"), low, high)).alias(name) for name, low, high in MATCH_BUCKETS],
    )


def match_aging_accounts(t: Mapping[str, DataFrame], as_of: dt.date, days: int = ACTIVE_DAYS) -> DataFrame:
    """One row: accounts matched and not, and per bucket. An account counts once in every bucket it
    has a match in, so ``matched_accts`` may exceed the accounts with a match."""
    sums = match_aging(t, as_of, days).agg(
        F.count("pat_acct").alias("tot_accts"),
        *[F.sum(one_zero(F.col(b) > 0)).alias(f"{b}_accts") for b in BUCKETS],
    )
    matched = sum((F.col(f"{b}_accts") for b in BUCKETS[1:]), F.col(f"{BUCKETS[0]}_accts"))
    total = F.col("tot_accts")
    columns = [
        total,
        matched.alias("matched_accts"),
        share(matched, total).alias("matched_accts_perc"),
        (total - matched).alias("unmatched_accts"),
        share(total - matched, total).alias("unmatched_accts_perc"),
    ]
    for b in BUCKETS:
        columns += [F.col(f"{b}_accts"), share(F.col(f"{b}_accts"), matched).alias(f"{b}_of_matched_accts_perc")]
    return sums.select(*columns)


def match_aging_matches(t: Mapping[str, DataFrame], as_of: dt.date, days: int = ACTIVE_DAYS) -> DataFrame:
    """One row: matches and accounts per bucket. The total of matches leaves out the last bucket."""
    sums = match_aging(t, as_of, days).agg(
        *[F.sum(b).alias(f"{b}_matches") for b in BUCKETS],
        *[F.sum(one_zero(F.col(b) > 0)).alias(f"{b}_accts") for b in BUCKETS],
    )
    matches = sum((F.col(f"{b}_matches") for b in BUCKETS[1:-1]), F.col(f"{BUCKETS[0]}_matches"))
    accounts = sum((F.col(f"{b}_accts") for b in BUCKETS[1:]), F.col(f"{BUCKETS[0]}_accts"))
    columns = [
        matches.alias("tot_matches"),
        accounts.alias("matched_accts"),
        share(matches, accounts).alias("matches_per_acct"),
    ]
    for b in BUCKETS:
        m, a = F.col(f"{b}_matches"), F.col(f"{b}_accts")
        columns += [m, a, share(m, a).alias(f"matches_per_{b}_acct")]
    return sums.select(*columns)


def match_aging_listing(t: Mapping[str, DataFrame], as_of: dt.date, days: int = ACTIVE_DAYS) -> DataFrame:
    """Accounts with their matches, latest received first."""
    names = t["customers"].select("cust_id", "cust_name")
    return (
        match_aging(t, as_of, days)
        .join(names, "cust_id", "left")
        # the account is the last key, so that one day of a customer does not fill one partition of the sort
        .orderBy(F.desc_nulls_first("info_received"), F.asc_nulls_last("cust_id"), F.asc_nulls_last("pat_acct"))
        .select("cust_id", "cust_name", "info_received", "info_matched_payer_name", "tot_matches", *BUCKETS)
    )
