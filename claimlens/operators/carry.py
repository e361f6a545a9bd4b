"""Carry a value forward over ordered rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def carry_forward(rows: DataFrame, source: str, block: str, position: str, value: Column, name: str) -> DataFrame:
    """Last non-NULL ``value`` up to and including each row of a source, in order of block and
    position.

    A source is never ordered in one task: inside a block (one split of a file) a window carries
    the value; then only one row per block is ordered, to hand the value on to the next blocks.
    """
    inside = Window.partitionBy(source, block).orderBy(position).rowsBetween(Window.unboundedPreceding, 0)
    marked = rows.withColumn("_mark", value)
    ends = marked.groupBy(source, block).agg(
        F.max_by("_mark", F.when(F.col("_mark").isNotNull(), F.col(position))).alias("_end")
    )
    before = Window.partitionBy(source).orderBy(block).rowsBetween(Window.unboundedPreceding, -1)
    handed = ends.select(source, block, F.last("_end", ignorenulls=True).over(before).alias("_handed"))
    return (
        marked.withColumn("_here", F.last("_mark", ignorenulls=True).over(inside))
        .join(handed, [source, block], "left")
        .withColumn(name, F.coalesce("_here", "_handed"))
        .select(*rows.columns, name)
    )
