"""Validity rules for demographic values.

The tests read the text list of an account's distinct values (separator ``'; '``).
``any_*`` tests run on single values and are combined with ``bool_or``, so that
they never need the list itself.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from claimlens.functions.flags import one_zero
from claimlens.functions.text import contains_ci

# Patterns of the rules.
BAD_ADDRESS = "PO BOX|UNK"
TEN_EQUAL_DIGITS = r"([0-9])\1{9}"
BAD_AREA_START = ["0", "1"]
BAD_SSN_START = ["666", "000"]


def says_something(value: Column) -> Column:
    """Text is left after removing the list separator."""
    return F.nullif(F.replace(value, F.lit("; "), F.lit("")), F.lit("")).isNotNull()


def bad_address(value: Column) -> Column:
    return contains_ci(value, BAD_ADDRESS)


def repeats_one_digit(value: Column) -> Column:
    return value.rlike(TEN_EQUAL_DIGITS)


def valid_address(any_bad: Column, any_text: Column) -> Column:
    return F.when(any_bad | ~F.coalesce(any_text, F.lit(False)), 0).otherwise(1)


def valid_phone(phones: Column, any_repeated: Column) -> Column:
    bad = (
        any_repeated
        | F.substring(phones, 1, 1).isin(BAD_AREA_START)
        | F.substring(phones, 4, 1).isin(BAD_AREA_START)
        | ~says_something(phones)
    )
    return F.when(bad, 0).otherwise(1)


def valid_ssn(numbers: Column, strict: bool = True) -> Column:
    """``strict`` tests the two-digit group; otherwise one character is compared with ``00``
    and the group test never fires."""
    group = F.substring(numbers, 4, 2 if strict else 1) == "00"
    bad = (
        (F.substring(numbers, 1, 1) == "9")
        | F.substring(numbers, 1, 3).isin(BAD_SSN_START)
        | group
        | (F.substring(numbers, 6, 4) == "0000")
        | ~says_something(numbers)
    )
    return F.when(bad, 0).otherwise(1)


def found(payers: Column) -> Column:
    """1 when any payer matched."""
    return one_zero(F.nullif(payers, F.lit("")).isNotNull())
