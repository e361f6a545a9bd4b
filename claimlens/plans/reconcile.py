"""Comparison of remittance files with posted transactions."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimlens.functions.dates import yyyymmdd
from claimlens.functions.flags import yes_no
from claimlens.functions.text import pg_concat
from claimlens.operators.ids import kept_ids
from claimlens.operators.lists import TextList, group_lists

KEYS = ["cust_id", "pat_acct"]


def grouped_amount(amount: Column) -> Column:
    """Whole amount with thousands separator in a field of eight characters; ``#`` when too wide."""
    whole = F.round(amount, 0).cast("bigint")
    return F.when(F.abs(whole) > 999_999, " ###,###").otherwise(F.lpad(F.format_number(whole, 0), 8, " "))


def transaction_accounts(t: Mapping[str, DataFrame], cust_ids=None) -> DataFrame:
    """Posted transactions per account without duplicates."""
    rows = kept_ids(t["transactions"], "cust_id", cust_ids).filter(~F.col("duplicate_payment"))
    paid = pg_concat(F.col("insurance_name"), " -- ", F.concat(F.lit("$"), grouped_amount(F.col("trans_amt"))))
    return group_lists(
        rows,
        KEYS,
        {"trans_carrier": TextList(paid, ";  ", distinct=False)},
        [
            F.round(F.max("charges"), 0).alias("charges"),
            F.round(F.sum("trans_amt"), 0).alias("tot_trans_amt"),
            F.min("trans_date").alias("earliest_cust_trans"),
            F.max("trans_date").alias("latest_cust_trans"),
        ],
    )


def remittance_accounts(remittances: DataFrame, cust_ids=None) -> DataFrame:
    """Remittances per account; amounts are rounded half to even."""
    rows = kept_ids(remittances, "cust_id", cust_ids).filter(F.col("pat_acct").isNotNull())
    lists = {
        "claim_adj_seg": TextList(F.col("claim_adj_seg"), ";  "),
        "remit_check_num": TextList(F.col("remit_check_num"), ";  "),
        "remit_carrier": TextList(F.col("insurance_name"), ";  "),
    }
    return group_lists(
        rows,
        KEYS,
        lists,
        [
            F.count("*").alias("paymt_cnt"),
            F.bround(F.max("charges"), 0).alias("charges"),
            F.bround(F.coalesce(F.sum("remit_paymt"), F.lit(0)), 0).alias("remit_paymt"),
            F.max("paymt_date").alias("latest_paymt_date"),
        ],
    )


def reconcile_order() -> list[Column]:
    return [F.desc_nulls_first("pat_acct"), F.asc_nulls_last("cust_id")]


def reconcile_transactions(
    t: Mapping[str, DataFrame],
    remittances: DataFrame,
    cust_ids=None,
    cust_name: str | None = None,
) -> DataFrame:
    """One row per remitted account: was it posted, in full, and after the latest remittance?

    ``cust_ids``, a list or a frame, restricts both sides; ``cust_name`` is a constant, or NULL.
    """
    trans = transaction_accounts(t, cust_ids).drop("charges")
    total, remitted = F.col("tot_trans_amt"), F.col("remit_paymt")
    response, posted = F.col("latest_remit_response"), F.col("latest_cust_trans")
    return (
        remittance_accounts(remittances, cust_ids)
        .withColumn("latest_remit_response", yyyymmdd(F.col("latest_paymt_date")))
        .join(trans, KEYS, "left")
        .select(
            "cust_id",
            F.lit(cust_name).cast("string").alias("cust_name"),
            "pat_acct",
            "charges",
            "claim_adj_seg",
            "remit_check_num",
            "paymt_cnt",
            "remit_paymt",
            "tot_trans_amt",
            yes_no(total.isNotNull()).alias("exist_paymt"),
            yes_no(total >= remitted).alias("exist_suffic_paymt"),
            "latest_remit_response",
            "latest_cust_trans",
            yes_no(posted >= response).alias("trans_after_response"),
            "remit_carrier",
            "trans_carrier",
        )
        .orderBy(*reconcile_order())
    )
