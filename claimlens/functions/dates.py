"""Date expressions. ``as_of`` always replaces the wall clock."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from claimlens.functions.text import blank_to_null


def parse_date(text: Column) -> Column:
    """ISO or ``YYYYMMDD`` text to a date; NULL when it is neither."""
    return F.coalesce(F.try_to_date(text), F.try_to_date(text, "yyyyMMdd"))


def clean_date(*texts: Column) -> Column:
    """Date of the first text that holds anything; ``''`` and ``'/  /'`` hold nothing."""
    return parse_date(F.coalesce(*[blank_to_null(t, "/  /") for t in texts]))


def yyyymmdd(number: Column) -> Column:
    """``20240115`` as a number to a date."""
    return F.try_to_date(number.cast("string"), "yyyyMMdd")


def years(later: Column, earlier: Column) -> Column:
    """Whole years of 365 days."""
    return F.call_function("div", F.datediff(later, earlier), F.lit(365))


def day(as_of: dt.date) -> Column:
    return F.lit(as_of).cast("date")


def days_old(stamp: Column, as_of: dt.date) -> Column:
    return F.datediff(day(as_of), F.to_date(stamp))


def younger_than(stamp: Column, as_of: dt.date, days: int) -> Column:
    """Fewer than ``days`` days old, as a plain lower bound that a scan can use."""
    return stamp >= F.lit(as_of - dt.timedelta(days=days - 1))


def on_day(stamp: Column, as_of: dt.date) -> Column:
    """Same calendar day, as a range on the raw column."""
    return (stamp >= F.lit(as_of)) & (stamp < F.lit(as_of + dt.timedelta(days=1)))


def run_stamp(as_of: dt.datetime | Column, zone: str = "UTC") -> Column:
    """``YYYYMMDD_HHMM`` of a UTC moment in a time zone, for output names and messages
    (``sinks.files.stamp`` gives the same as plain text)."""
    moment = as_of if isinstance(as_of, Column) else F.lit(as_of)
    return F.date_format(F.from_utc_timestamp(moment, zone), "yyyyMMdd_HHmm")
