"""Insert-if-absent and update-from on snapshot frames."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimlens.operators.lists import prefixed, same_key


def insert_absent(state: DataFrame, batch: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Rows of ``batch`` to add to ``state``: keys not there yet, and of rows with equal keys
    only the first one in ``order``."""
    keys = list(keys)
    rest = [c for c in batch.columns if c not in keys]
    first = batch.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("_row"))
    known = prefixed(state.select(*keys), keys, "_s_")
    return first.join(known, same_key(keys, "_s_"), "left_anti").select(*keys, "_row.*")


def update_from(
    state: DataFrame,
    source: DataFrame,
    key: str,
    when: Column,
    sets: Mapping[str, Column],
    flag: str,
) -> DataFrame:
    """Set columns of the state rows that match ``source`` (one row per key) and pass ``when``.

    ``source`` columns other than the key may be used in ``when`` and ``sets`` and are dropped
    afterwards. ``flag`` is added and tells which rows were changed.
    """
    side = source.withColumnsRenamed({key: "_src_" + key})
    joined = state.join(side, F.col(key) == F.col("_src_" + key), "left")
    hit = F.coalesce(F.col("_src_" + key).isNotNull() & when, F.lit(False))
    joined = joined.withColumn(flag, hit)
    return joined.select(
        *[
            F.when(F.col(flag), sets[c].cast(state.schema[c].dataType)).otherwise(F.col(c)).alias(c)
            if c in sets
            else F.col(c)
            for c in state.columns
        ],
        flag,
    )
