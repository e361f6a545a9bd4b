"""CSV files with header."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimlens.schemas import REMITTANCE_COLUMNS

# Headers of the payer list and what they are called afterwards.
PAYER_LIST_RENAMES = {
    "Payer_ID": "edi_payer_id",
    "WC": "work_comp",
    "Auto": "auto",
    "1500": "prof_1500",
    "UB04": "inst_UB04",
    "Rx": "prsc_rx",
    "835": "response_all_835",
    "277": "response_all_277",
    "direct": "direct_connect",
    "indirect": "indirect_connect",
}
# stands for a quoted empty cell while a file is read, as the reader takes an empty text for NULL
EMPTY = "\u0001"

PAYER_LIST_DROPS = ("Clearinghouse", "Payer_Name", "Liability", "Last_Updated")


def underscored(df: DataFrame) -> DataFrame:
    """Spaces in headers become ``_``."""
    return df.toDF(*[c.replace(" ", "_") for c in df.columns])


def read_csv_text(spark: SparkSession, path: str) -> DataFrame:
    """Every column as text under its own header (no inference pass); quotes inside a value are doubled."""
    return underscored(spark.read.option("header", True).option("escape", '"').csv(path))


def read_csv(spark: SparkSession, path: str, schema: T.StructType, line_sep: str | None = None) -> DataFrame:
    """Columns of a schema from files as ``sinks.csv_files.write_csv`` makes them.

    Values may hold line breaks, so a file is read by one task; the writer makes one per partition. An empty
    cell is NULL, a quoted empty one is empty text.
    """
    options = {"header": True, "escape": '"', "multiLine": True, "emptyValue": EMPTY, "mode": "FAILFAST"}
    if line_sep is not None:
        options["lineSep"] = line_sep
    rows = spark.read.schema(schema).options(**options).csv(path)
    texts = {f.name for f in schema.fields if isinstance(f.dataType, T.StringType)}
    return rows.select(*[F.replace(c, F.lit(EMPTY), F.lit("")).alias(c) if c in texts else F.col(f"`{c}`") for c in rows.columns])


def clean_payer_list(raw: DataFrame, extra_drops: Iterable[str] = ()) -> DataFrame:
    """Payer list with one row per payer id: the greatest value of every other column.

    ``extra_drops`` names house columns to leave out as well.
    """
    df = underscored(raw).drop(*PAYER_LIST_DROPS, *extra_drops).withColumnsRenamed(PAYER_LIST_RENAMES)
    others = [c for c in df.columns if c != "edi_payer_id"]
    return (
        df.filter(F.col("edi_payer_id").isNotNull())
        .groupBy("edi_payer_id")
        .agg(*[F.max(f"`{c}`").alias(c) for c in others])
    )


def read_payer_list(spark: SparkSession, path: str, extra_drops: Iterable[str] = ()) -> DataFrame:
    return clean_payer_list(read_csv_text(spark, path), extra_drops)


def typed_remittances(raw: DataFrame) -> DataFrame:
    """The needed remittance columns, renamed and typed; further columns are ignored."""
    columns = []
    for header, target in REMITTANCE_COLUMNS.items():
        name, kind = target.split(" ", 1)
        columns.append(F.col(f"`{header}`").cast(kind).alias(name))
    return underscored(raw).select(*columns)


def read_remittances(spark: SparkSession, path: str) -> DataFrame:
    return typed_remittances(read_csv_text(spark, path))
