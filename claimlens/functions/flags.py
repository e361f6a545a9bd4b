"""Flags and shares."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def yes_no_null(test: Column, *needed: Column) -> Column:
    """``Y``/``N``, NULL when one of the compared values is missing."""
    known = F.lit(True)
    for value in needed:
        known = known & value.isNotNull()
    return F.when(known, F.when(test, "Y").otherwise("N"))


def yes_no(test: Column) -> Column:
    """``Y``/``N``; an unknown test counts as no."""
    return F.when(test, "Y").otherwise("N")


def one_zero(test: Column) -> Column:
    """1/0; an unknown test counts as 0."""
    return F.when(test, 1).otherwise(0)


def rows_where(test: Column) -> Column:
    """Number of rows passing a test (NULL over no rows at all, like a sum)."""
    return F.sum(one_zero(test).cast("bigint"))


def share(part: Column, whole: Column, digits: int = 2) -> Column:
    """Decimal share, NULL when the whole is 0."""
    return F.round(F.try_divide(part.cast("decimal(18,0)"), whole.cast("decimal(18,0)")), digits)


def without(value: Column, codes: list[str]) -> Column:
    """NULL for the listed codes."""
    return F.when(~value.isin(codes), value)


def not_among(value: Column, ids) -> Column:
    """``value NOT IN (ids)``; an empty list excludes nothing."""
    ids = list(ids)
    return ~value.isin(ids) if ids else F.lit(True)


def among(value: Column, ids) -> Column:
    """``value IN (ids)``; ``None`` means every value."""
    return F.lit(True) if ids is None else value.isin(list(ids))
