"""Per-account satellites used by several reports.

Every satellite has one row per account (or says otherwise) and is made by partial aggregation,
so an account with very many rows is reduced before any join.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimlens.operators.lists import set_text


def account_status_text(t: Mapping[str, DataFrame]) -> DataFrame:
    """``pat_acct``, ``status``: list of the account's statuses."""
    return t["account_statuses"].groupBy("pat_acct").agg(set_text(F.col("status"), ";  ").alias("status"))


def account_codes(t: Mapping[str, DataFrame]) -> DataFrame:
    """``pat_acct``, ``codes`` (distinct status codes), ``uncoded`` (any row without a code)."""
    return (
        t["patient_accounts"]
        .groupBy("pat_acct")
        .agg(
            F.collect_set("status_code").alias("codes"),
            F.coalesce(F.bool_or(F.col("status_code").isNull()), F.lit(False)).alias("uncoded"),
        )
    )


def with_statuses(rows: DataFrame, t: Mapping[str, DataFrame]) -> DataFrame:
    """Adds ``statuses``: the distinct resolved statuses of the row's account as a sorted array.

    A patient-account code goes before the account's status list; the list is used where there is
    no patient-account row, or one without a code.
    """
    fallback = F.coalesce(F.col("uncoded"), F.lit(True)) & F.col("status_text").isNotNull()
    codes = F.coalesce(F.col("codes"), F.array().cast("array<string>"))
    both = F.when(fallback, F.array_union(codes, F.array("status_text"))).otherwise(codes)
    return (
        rows.join(account_status_text(t).withColumnRenamed("status", "status_text"), "pat_acct", "left")
        .join(account_codes(t), "pat_acct", "left")
        .withColumn("statuses", F.sort_array(both))
        .drop("codes", "uncoded", "status_text")
    )


def statuses_text(sep: str = ";  ") -> Column:
    return F.when(F.size("statuses") > 0, F.array_join("statuses", sep))


def _per_source(t: Mapping[str, DataFrame], parts: Mapping[str, Callable]) -> DataFrame:
    """Results of both payment tables side by side, in one pass and one shuffle.

    ``parts`` maps a name to a function from a row test to named aggregates. The column
    ``<name>_a`` (``_b``) holds the first (second) table's results as a struct, NULL where the
    account has no such payment there. Duplicates are left out.
    """
    rows = (
        t["payments_a"]
        .select("*", F.lit("a").alias("source"))
        .unionByName(t["payments_b"].select("*", F.lit("b").alias("source")))
        .filter(~F.col("duplicate_payment"))
    )
    aggs, cells = [], []
    for name, (keep, values) in parts.items():
        for source in ("a", "b"):
            test = keep & (F.col("source") == source)
            named = values(lambda c, test=test: F.when(test, F.col(c)))
            prefix = f"_{name}_{source}_"
            aggs += [F.count(F.when(test, 1)).alias(prefix), *[v.alias(prefix + n) for n, v in named.items()]]
            cell = F.struct(*[F.col(prefix + n).alias(n) for n in named])
            cells.append(F.when(F.col(prefix) > 0, cell).alias(f"{name}_{source}"))
    return rows.groupBy("pat_acct").agg(*aggs).select("pat_acct", *cells)


def _union(name: str) -> Column:
    """The distinct results of the two tables (``UNION``) as an array."""
    return F.array_distinct(F.array_compact(F.array(f"{name}_a", f"{name}_b")))


def _unbilled(pick: Callable[[str], Column]) -> dict[str, Column]:
    return {
        "amount": F.round(F.sum(pick("payment")), 0),
        "payer_set": F.sort_array(F.collect_set(pick("insurance_name"))),
    }


def _billed(pick: Callable[[str], Column]) -> dict[str, Column]:
    return {"payment_date": F.min(pick("payment_date")), "posting_date": F.min(pick("payment_post_date"))}


def _payers_text(payers: Column, sep: str) -> Column:
    return F.when(F.size(payers) > 0, F.array_join(payers, sep))


def unbilled_payments(t: Mapping[str, DataFrame], sep: str) -> DataFrame:
    """``pat_acct``, ``amount``, ``payers`` of payments that are no duplicates and not billed.

    An account in both payment tables has two rows, one if they say the same.
    """
    pairs = _per_source(t, {"unbilled": (F.col("not_billed"), _unbilled)})
    rows = pairs.select("pat_acct", F.explode(_union("unbilled")).alias("r"))
    return rows.select("pat_acct", F.col("r.amount").alias("amount"), _payers_text(F.col("r.payer_set"), sep).alias("payers"))


def account_payments(t: Mapping[str, DataFrame], sep: str, one_row_per_account: bool = False) -> DataFrame:
    """``unbilled_payments`` together with the earliest ``payment_date`` and ``posting_date`` of the
    billed payments.

    An account has a row for every combination of distinct results of the two tables. With
    ``one_row_per_account`` the rounded amounts are added, the payers merged, and the earliest dates
    taken.
    """
    pairs = _per_source(
        t, {"unbilled": (F.col("not_billed"), _unbilled), "billed": (~F.col("not_billed"), _billed)}
    )
    if not one_row_per_account:
        return (
            pairs.select("pat_acct", F.explode_outer(_union("unbilled")).alias("u"), _union("billed").alias("dates"))
            .select("pat_acct", "u", F.explode_outer("dates").alias("d"))
            .select(
                "pat_acct",
                F.col("u.amount").alias("amount"),
                _payers_text(F.col("u.payer_set"), sep).alias("payers"),
                F.col("d.payment_date").alias("payment_date"),
                F.col("d.posting_date").alias("posting_date"),
            )
        )
    none = F.array().cast("array<string>")
    a, b = F.col("unbilled_a"), F.col("unbilled_b")
    amount = F.when(
        F.coalesce(a["amount"], b["amount"]).isNotNull(),
        F.coalesce(a["amount"], F.lit(0)) + F.coalesce(b["amount"], F.lit(0)),
    )
    payers = F.sort_array(F.array_union(F.coalesce(a["payer_set"], none), F.coalesce(b["payer_set"], none)))
    earliest = lambda c: F.least(F.col("billed_a")[c], F.col("billed_b")[c]).alias(c)
    return pairs.select(
        "pat_acct",
        amount.alias("amount"),
        payers.alias("payer_set"),
        earliest("payment_date"),
        earliest("posting_date"),
    ).select("pat_acct", "amount", _payers_text(F.col("payer_set"), sep).alias("payers"), "payment_date", "posting_date")


def first_received(t: Mapping[str, DataFrame]) -> DataFrame:
    """``pat_acct``, ``received``: day of the first raw bill."""
    return t["client_raw_bills"].groupBy("pat_acct").agg(F.to_date(F.min("created_at")).alias("received"))


def first_billing(t: Mapping[str, DataFrame]) -> DataFrame:
    """``pat_acct``, ``first_billing_date``."""
    return t["billing"].groupBy("pat_acct").agg(F.min("bill_sent_at").alias("first_billing_date"))
