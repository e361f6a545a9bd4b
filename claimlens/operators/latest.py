"""Latest rows of a group, ties kept."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest_rows(
    df: DataFrame, keys: Sequence[str], stamp: str, blank_keys: bool = False, keep_unknown: bool = True
) -> DataFrame:
    """Rows of each group that carry its greatest ``stamp``.

    A group whose stamps are all NULL, or with a NULL key, gives one row that holds its keys
    (NULL too with ``blank_keys``) and nothing else. ``keep_unknown=False`` leaves those rows out,
    for results that are left-joined on the keys and would show nothing of them.

    The maximum is a partial aggregate and the join back is an inner join on the keys and the
    stamp, so a group with very many rows is spread by stamp and can be split by the skew join.
    """
    keys = list(keys)
    tops = df.groupBy(*keys).agg(F.max(stamp).alias("_top"))
    known = F.col("_top").isNotNull()
    for k in keys:
        known = known & F.col(k).isNotNull()

    twins = tops.filter(known).withColumnsRenamed({k: "_k_" + k for k in keys})
    test = F.col(stamp) == F.col("_top")
    for k in keys:
        test = test & (F.col(k) == F.col("_k_" + k))
    hits = df.join(twins, test).select(*df.columns)

    if not keep_unknown:
        return hits
    empty = [
        F.col(f.name) if f.name in keys and not blank_keys else F.lit(None).cast(f.dataType).alias(f.name)
        for f in df.schema.fields
    ]
    misses = tops.filter(~known).select(*empty)
    return hits.unionByName(misses)


def latest_row_values(df: DataFrame, keys: Sequence[str], stamp: str, columns: Sequence[str]) -> DataFrame:
    """Exactly one row per group: ``columns`` of the row with the greatest stamp, ties broken
    by the values themselves so that reruns agree. Partial aggregation, no window."""
    picked = F.max(F.struct(F.col(stamp).alias("_stamp"), *columns)).alias("_picked")
    return df.groupBy(*keys).agg(picked).select(*keys, *[F.col("_picked")[c].alias(c) for c in columns])
