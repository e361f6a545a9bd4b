"""Rows by a list of ids of any size, with the rules of SQL for NULL."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimlens.functions.flags import not_among

ID = "_listed_id"


def _listed(ids: DataFrame) -> DataFrame:
    return ids.select(F.col(f"`{ids.columns[0]}`").alias(ID))


def kept_ids(df: DataFrame, column: str, ids=None) -> DataFrame:
    """``column IN (ids)``: a NULL on either side matches nothing. ``None`` keeps every row.

    ``ids`` is a list, or a frame whose first column holds them; a frame is met in a semi join, so it may be as
    large as the rows, and copies in it add nothing.
    """
    if ids is None:
        return df
    if not isinstance(ids, DataFrame):
        return df.filter(F.col(column).isin([i for i in ids if i is not None]))
    listed = _listed(ids)
    return df.join(listed, F.col(column) == F.col(ID), "left_semi")


def left_out_ids(df: DataFrame, column: str, ids) -> DataFrame:
    """``column NOT IN (ids)``: no id leaves every row, a NULL among the ids leaves none, and a row
    whose own value is NULL stays only where there is no id at all.

    For a frame, whether it is empty or holds a NULL is looked up first (one row); then it is an anti join.
    """
    if not isinstance(ids, DataFrame):
        ids = list(ids)
        return df.filter(F.lit(False)) if None in ids else df.filter(not_among(F.col(column), ids))
    listed = _listed(ids)
    seen = listed.agg(F.count("*").alias("ids"), F.count(ID).alias("known")).first()
    if not seen.ids:
        return df
    if seen.known < seen.ids:
        return df.filter(F.lit(False))
    return df.filter(F.col(column).isNotNull()).join(listed, F.col(column) == F.col(ID), "left_anti")
