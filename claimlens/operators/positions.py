"""Row numbers over any number of rows, without a window that sorts a whole group in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimlens.sinks.files import shared_folder

AT, PART = "_at", "_part"


def numbered(
    df: DataFrame, order: Sequence[Column], name: str = "position", keys: Sequence[str] = (), folder: str | None = None
) -> DataFrame:
    """Every row with its place, from 1, in the given order (within its keys).

    The rows are dealt out by range, sorted inside their partition, and written to ``folder`` (a new one in the
    shared folder by default) with their place there; a key with very many rows spreads over many partitions.
    Then only the row counts per key and partition are added up, one row each. Rows that the order does not
    tell apart are numbered in any order. The result keeps the written rows.
    """
    keys = list(keys)
    path = folder or shared_folder(df.sparkSession, "numbered")
    by = [*(F.asc_nulls_first(k) for k in keys), *order]
    sorted_rows = df.repartitionByRange(*by).sortWithinPartitions(*by).withColumn(AT, F.monotonically_increasing_id())
    sorted_rows.write.parquet(path)
    rows = df.sparkSession.read.schema(sorted_rows.schema).parquet(path).withColumn(PART, F.shiftright(AT, 33))

    twins = [f"_k_{k}" for k in keys]
    counts = rows.groupBy(*[F.col(k).alias(t) for k, t in zip(keys, twins)], F.col(PART).alias("_in")).agg(
        F.count("*").alias("_rows"), F.min(AT).alias("_first")
    )
    # one row per key and partition: at most the number of partitions for any key
    before = Window.partitionBy(*(twins or [F.lit(0)])).orderBy("_in").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.withColumn("_before", F.coalesce(F.sum("_rows").over(before), F.lit(0))).drop("_rows")
    test = F.col(PART) == F.col("_in")
    for k, t in zip(keys, twins):
        test = test & F.col(k).eqNullSafe(F.col(t))
    return rows.join(starts, test).select(
        (F.col("_before") + F.col(AT) - F.col("_first") + 1).alias(name), *[F.col(f"`{c}`") for c in df.columns]
    )
