"""Join helpers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def coalesced_full_join(first: DataFrame, second: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Full outer join of two frames with the same columns; the first frame's value wins."""
    keys = list(keys)
    values = [c for c in first.columns if c not in keys]
    a, b = first.alias("a"), second.alias("b")
    test = F.lit(True)
    for k in keys:
        test = test & (F.col(f"a.{k}") == F.col(f"b.{k}"))
    return a.join(b, test, "full").select(
        *[F.coalesce(F.col(f"a.{c}"), F.col(f"b.{c}")).alias(c) for c in [*keys, *values]]
    )


def column_lookup(name: Column, columns: Sequence[str]) -> Column:
    """Value of the column whose name is in ``name``; NULL when there is no such column."""
    if not columns:
        return F.lit(None).cast("string")
    pairs = [part for c in columns for part in (F.lit(c), F.col(f"`{c}`").cast("string"))]
    return F.try_element_at(F.create_map(*pairs), name)


def absent(rows: DataFrame, present: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose keys do not occur in ``present``. The present keys are made distinct first,
    so a key with many copies is one row in the join."""
    return rows.join(present.select(*keys).distinct(), list(keys), "left_anti")
