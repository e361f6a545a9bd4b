"""CSV and plain text output."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


def write_csv(df: DataFrame, path: str, line_sep: str | None = None, null_value: str | None = None) -> None:
    """CSV with header; values with commas, quotes or line breaks are quoted, quotes inside are doubled, blanks
    around a value are kept. One file per partition."""
    writer = df.write.mode("errorifexists").option("header", True).option("escape", '"')
    writer = writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
    if line_sep is not None:
        writer = writer.option("lineSep", line_sep)
    if null_value is not None:
        writer = writer.option("nullValue", null_value)
    writer.csv(path)


def plain_lines(df: DataFrame, sep: str = ",", null_text: str = "None") -> DataFrame:
    """One text column: values joined as they are, no quoting, NULL as ``null_text``."""
    cells = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(null_text)) for c in df.columns]
    return df.select(F.concat_ws(sep, *cells).alias("value"))


def write_plain(df: DataFrame, path: str, sep: str = ",", null_text: str = "None", line_sep: str = "\n") -> None:
    """Unquoted text lines; every file of the folder starts with the header, as with ``write_csv``.

    The lines are written as a one-column CSV whose header is the joined one, without any quoting.
    """
    header = sep.join(df.columns)
    # separator and quote are characters that text does not hold, so lines are written as they are
    bare = {"sep": "\u0001", "quote": "\u0000", "escape": "\u0000", "emptyValue": ""}
    lines = plain_lines(df, sep, null_text).select(F.col("value").alias(header))
    lines.write.mode("errorifexists").options(header=True, lineSep=line_sep, **bare).csv(path)


def preview(df: DataFrame, rows: int = 5) -> tuple[DataFrame, int]:
    """First rows and the row count of a result."""
    return df.limit(rows), df.count()


def write_counted(
    df: DataFrame, path: str, rows: int = 5, order: Sequence[Column] = ()
) -> tuple[DataFrame, int]:
    """Writes a result as parquet and gives its first rows (in ``order``) and its row count.

    The count is taken by the job that writes; the first rows are read from what it has written.
    """
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("errorifexists").parquet(path)
    written = df.sparkSession.read.schema(df.schema).parquet(path)
    return (written.orderBy(*order) if order else written).limit(rows), seen.get["rows"]
