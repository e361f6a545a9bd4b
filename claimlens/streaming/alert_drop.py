"""Daily alert files as a file stream.

Each micro-batch of new files goes through the batch ingest and publishes one snapshot. The
ingest inserts a line once, so a batch that is run again after a failure changes nothing.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from claimlens.plans.alerts import AlertRun
from claimlens.plans.daily import stage_ingest
from claimlens.sinks.snapshots import SnapshotTable
from claimlens.sources.alert_text import parse_alert_lines


def watch_alerts(
    spark: SparkSession,
    folder: str,
    table: SnapshotTable,
    t: Mapping[str, DataFrame],
    checkpoint: str,
    now: Callable[[], dt.datetime],
    also: Callable[[AlertRun, int], None] | None = None,
) -> StreamingQuery:
    """Ingests the files that are new in ``folder`` and stops (``availableNow``).

    ``also`` gets each batch's run (metrics, rejected lines) and number before its state is
    published, to keep what it needs.
    """

    def ingest(batch: DataFrame, batch_id: int) -> None:
        lines = batch.withColumn("pos", F.monotonically_increasing_id()).select("file", "block", "pos", "line")
        # a batch that is run again after a failure writes its folder again
        staged = stage_ingest(table, parse_alert_lines(lines), t, now(), f"{table.root}/batches/{batch_id}")
        if also is not None:
            also(AlertRun(table.after(staged.run), staged.metrics, staged.rejects), batch_id)
        table.commit(staged.run)

    lines = spark.readStream.text(folder).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.col("value").alias("line"),
    )
    return (
        lines.writeStream.foreachBatch(ingest)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
