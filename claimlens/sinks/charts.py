"""Point data for charts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def chart_points(
    report: DataFrame,
    x: str,
    y: str,
    order: Sequence[Column],
    x_axis: tuple[float, float] | None = None,
    y_axis: tuple[float, float] | None = None,
) -> DataFrame:
    """The two columns of the whole report, in its order.

    The axis windows say what a chart shows at first, not what the series holds: they are kept as
    metadata (``axis``) of the columns and drop no point. ``order`` should be total, so that reruns
    agree.
    """
    axes = [
        F.col(c).alias(c, metadata={"axis": list(window)} if window else {}) for c, window in ((x, x_axis), (y, y_axis))
    ]
    return report.orderBy(*order).select(*axes)
