"""Text expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _text(part: Column | str) -> Column:
    return F.lit(part) if isinstance(part, str) else part.cast("string")


def pg_concat(*parts: Column | str) -> Column:
    """Concatenation that treats NULL as empty text. Plain strings are literals."""
    return F.concat_ws("", *[_text(p) for p in parts])


def blank_to_null(value: Column, *placeholders: str) -> Column:
    """NULL for empty text and for each placeholder such as ``'/  /'``."""
    for placeholder in (*placeholders, ""):
        value = F.nullif(value, F.lit(placeholder))
    return value


def first_text(*values: Column) -> Column:
    """First value that is neither NULL nor empty."""
    return F.coalesce(*[blank_to_null(v) for v in values])


def labelled(label: str, value: Column) -> Column:
    """``label`` followed by the value; NULL when the value is missing."""
    return F.concat(F.lit(label), value.cast("string"))


def quoted(value: Column) -> Column:
    """Double quotes around a value, so spreadsheets keep leading zeros."""
    return pg_concat('"', value, '"')


def pg_initcap(value: Column) -> Column:
    """Upper-case the first letter of every run of letters and digits, lower-case the rest.

    Every other character is followed by a mark and a blank while the built-in function runs, which
    takes words at blanks only.
    """
    marked = F.initcap(F.regexp_replace(value, r"([^\p{L}\p{N} ])", "$1\u0001 "))
    return F.replace(marked, F.lit("\u0001 "), F.lit(""))


def contains_ci(value: Column, pattern: str) -> Column:
    """Case-insensitive regular expression search."""
    return value.rlike("(?i)" + pattern)


def json_text(document: Column, key: str) -> Column:
    """Text of a top-level JSON key; NULL for a missing key or JSON null, ``''`` stays ``''``."""
    return F.get_json_object(document, f"$.{key}")


def json_record(document: Column, *keys: str) -> Column:
    """Several top-level keys as one struct of strings, parsing the document once."""
    return F.from_json(document, ", ".join(f"`{k}` string" for k in keys))


#: ending of the typed column that can take the place of a JSON column
FIELDS = "_fields"


def json_fields(rows: DataFrame, document: str, *keys: str) -> Column:
    """Keys of a JSON column as a struct: from its typed column where the table has one, else parsed here."""
    return F.col(document + FIELDS) if document + FIELDS in rows.columns else json_record(F.col(document), *keys)


def phone_digits(value: Column) -> Column:
    """Phone number without brackets, dashes and spaces."""
    return F.translate(value, "()- ", "")


def money_text(amount: Column) -> Column:
    """``$`` and the amount rounded to whole units; only ``$`` when the amount is missing."""
    return pg_concat("$", F.round(amount, 0).cast("decimal(38,0)"))


def grouped_money_text(amount: Column) -> Column:
    """``$1,234``."""
    return F.concat(F.lit("$"), F.format_number(F.round(amount, 0), 0))
