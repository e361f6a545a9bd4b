"""A report bundle: named sheets, one folder each, with a kind per column."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

KIND = "kind"
LONG = "long"  # column metadata: each text may take a large part of a task's memory
NUMBERS = (T.NumericType,)
DATES = (T.DateType, T.TimestampType, T.TimestampNTZType)
TYPES = {"text": (T.StringType,), "number": NUMBERS, "percent": NUMBERS, "date": DATES}

#: the columns of a sheet in order, each with its kind: ``text``, ``number``, ``percent`` or ``date``
Contract = Sequence[tuple[str, str]]


class ContractError(ValueError):
    """A sheet does not have the columns that were declared for it."""


def column_kind(field: T.StructField) -> str:
    """The kind of a column that nothing was declared for, by its name and type."""
    if field.name.startswith(("pct_", "perc_")) or field.name.endswith("_perc") or field.name == "hit_rate":
        return "percent"
    if isinstance(field.dataType, NUMBERS):
        return "number"
    return "date" if isinstance(field.dataType, DATES) else "text"


def checked_kinds(df: DataFrame, contract: Contract, sheet: str = "sheet") -> list[str]:
    """The declared kinds; an error where names, order or types are others."""
    names = [name for name, _ in contract]
    if df.columns != names:
        raise ContractError(f"{sheet}: columns are {df.columns}, declared are {names}")
    for field, (name, kind) in zip(df.schema.fields, contract):
        if not isinstance(field.dataType, TYPES[kind]):
            raise ContractError(f"{sheet}: {name} is {field.dataType.simpleString()}, which is no {kind}")
    return [kind for _, kind in contract]


def with_kinds(df: DataFrame, contract: Contract | None = None, sheet: str = "sheet") -> DataFrame:
    """Keeps the kind of every column as column metadata; a frame that has these kinds is left as it is."""
    kinds = [column_kind(f) for f in df.schema.fields] if contract is None else checked_kinds(df, contract, sheet)
    if [f.metadata.get(KIND) for f in df.schema.fields] == kinds:
        return df
    return df.select(
        *[F.col(f"`{f.name}`").alias(f.name, metadata={**f.metadata, KIND: k}) for f, k in zip(df.schema.fields, kinds)]
    )


def _long_texts(df: DataFrame) -> dict[str, str]:
    """Parquet options of a sheet with long texts. The writer keeps values for a column's dictionary and for its least
    and greatest value, and Snappy needs a page in one piece, twice; long texts go without these."""
    long = [f.name for f in df.schema.fields if f.metadata.get(LONG)]
    copies = ("parquet.enable.dictionary", "parquet.column.statistics.enabled")
    return {f"{what}#{name}": "false" for name in long for what in copies} | ({"compression": "zstd"} if long else {})


def write_bundle(
    sheets: Mapping[str, DataFrame],
    out: str,
    fmt: str = "parquet",
    contracts: Mapping[str, Contract] | None = None,
    run: str | None = None,
) -> dict[str, str]:
    """Writes each sheet to ``<out>/<run>/<sheet>`` and gives the folders by sheet.

    With ``contracts`` every sheet must be declared and is checked before anything is written. ``run`` is the
    run's stamp (``sinks.files.stamp``); without it the sheets lie in ``out`` itself.
    """
    if contracts is not None and list(contracts) != list(sheets):
        raise ContractError(f"sheets are {list(sheets)}, declared are {list(contracts)}")
    frames = {name: with_kinds(df, contracts[name] if contracts else None, name) for name, df in sheets.items()}
    folder = f"{out}/{run}" if run else out
    for name, df in frames.items():
        writer = df.write.mode("errorifexists")
        if fmt == "csv":
            writer = writer.option("header", True)
        if fmt == "parquet":
            writer = writer.options(**_long_texts(df))
        writer.format(fmt).save(f"{folder}/{name}")
    return {name: f"{folder}/{name}" for name in frames}


def sheet_listing(sheet: DataFrame) -> DataFrame:
    """One row per column of a written sheet: ``position``, ``column``, ``kind``, ``rows``, ``filled`` (cells that
    hold anything)."""
    cells = [
        F.struct(
            F.lit(i).alias("position"),
            F.lit(f.name).alias("column"),
            F.lit(f.metadata.get(KIND)).alias("kind"),
            F.count("*").alias("rows"),
            F.count(f"`{f.name}`").alias("filled"),
        )
        for i, f in enumerate(sheet.schema.fields, 1)
    ]
    return sheet.agg(F.array(*cells).alias("cells")).select(F.explode("cells").alias("c")).select("c.*")
