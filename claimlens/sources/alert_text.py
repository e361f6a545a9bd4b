"""Sectioned alert text: a heading line, then detail lines that belong to it.

    Team North
     1000001, 2000001, A001 - A7 > missing claim number

Lines are read in splits like any text file; nothing needs a whole file in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from claimlens.operators.carry import carry_forward

# Line patterns and the code prefix.
DETAIL_LINE = r"^\s+\d{7}"
KEY_SEPARATOR = r"\s-\s"
CODE_PREFIX = "277-"


def file_day(name: Column) -> Column:
    """Date from the digits of a file's base name, as in ``alerts_20240115.txt``."""
    base = F.regexp_extract(name, r"([^/]*)$", 1)
    return F.try_to_date(F.regexp_extract(base, r"(\d+)", 1), "yyyyMMdd")


def read_lines(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """``file``, ``block``, ``pos``, ``line`` of text files; block and pos give the order in a file."""
    return (
        spark.read.text(paths)
        .select(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            F.col("value").alias("line"),
        )
        .withColumn("pos", F.monotonically_increasing_id())
        .select("file", "block", "pos", "line")
    )


def parse_alert_lines(lines: DataFrame) -> DataFrame:
    """One row per detail line, in the order columns of the file.

    ``reject`` holds the reason when the line cannot be used, NULL otherwise. The keys end at the
    first dash that has blanks around it, so an account may hold a dash. Blank lines are ignored.
    """
    detail = F.col("line").rlike(DETAIL_LINE)
    heading = F.when(~detail & (F.trim("line") != ""), F.trim(F.regexp_replace("line", r"[\r\t]", " ")))
    rows = carry_forward(lines, "file", "block", "pos", heading, "assigned").filter(detail)

    keys = F.split(F.split("line", KEY_SEPARATOR, 2)[0], ",")
    message = F.regexp_extract("line", KEY_SEPARATOR + r"(.*)$", 1)
    note = F.regexp_replace(F.trim(F.replace(message, F.lit("-"), F.lit(""))), r"\s+>\s+", " - ")
    key = lambda n: F.trim(F.get(keys, F.lit(n)))
    parsed = rows.select(
        "file",
        "block",
        "pos",
        "line",
        key(0).try_cast("bigint").alias("pm_sk"),
        key(1).try_cast("bigint").alias("src_sk"),
        key(2).alias("pat_acct"),
        F.trim(note).alias("note"),
        "assigned",
        file_day(F.col("file")).alias("effective_date"),
    )
    head = F.regexp_substr("note", F.lit(r"^.*(?= -)"))
    return parsed.withColumn("code", F.concat(F.lit(CODE_PREFIX), head)).withColumn(
        "reject",
        F.when(F.col("pm_sk").isNull() | F.col("src_sk").isNull() | F.col("pat_acct").isNull(), "keys cannot be read")
        .when(F.col("code").isNull(), "message has no code")
        .when(F.col("effective_date").isNull(), "file name has no date"),
    )


def good_lines(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col("reject").isNull()).drop("reject", "line")


def rejected_lines(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col("reject").isNotNull()).select("file", "block", "pos", "line", "reject")


def read_alerts(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    return parse_alert_lines(read_lines(spark, paths))


def parse_key_lines(lines: DataFrame) -> DataFrame:
    """One row per line that holds anything: ``line``, ``pm_sk``, and ``reject`` with the reason where it has no key.

    A key is a seven-digit number at the start of its line. A line with text after the key holds no usable key,
    as its whole text is compared with the key.
    """
    whole = F.trim(F.regexp_replace("line", r"\s+", " "))
    starts = F.col("line").rlike(r"^\d{7}\b")
    key = F.when(starts, whole.try_cast("bigint"))
    return lines.filter(whole != "").select(
        "line",
        key.alias("pm_sk"),
        F.when(~starts, "does not start with a key").when(key.isNull(), "text after the key").alias("reject"),
    )


def good_keys(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col("reject").isNull()).select("pm_sk").distinct()


def rejected_keys(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col("reject").isNotNull()).select("line", "reject")


def parse_keys(lines: DataFrame) -> DataFrame:
    """The distinct keys of the lines."""
    return good_keys(parse_key_lines(lines))


def read_key_lines(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Parsed lines of key-list files, read in splits."""
    return parse_key_lines(spark.read.text(paths).withColumnRenamed("value", "line"))


def read_keys(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    return good_keys(read_key_lines(spark, paths))
