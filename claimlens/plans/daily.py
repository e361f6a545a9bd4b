"""The daily runs around the alert state: all steps, or the old version stays in force.

A run reads the unsettled alerts and the keys of the others, writes the changed part once, with a flag per kind of
change, and takes metrics, reports and the published state from what it has written. The version it started from must
still be the last one when it publishes.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from typing import NamedTuple

from pyspark.sql import DataFrame

from claimlens.plans.alerts import (
    ALERT_KEYS,
    INGEST_FLAGS,
    RESOLVE_FLAGS,
    export_alerts,
    flag_schema,
    ingest_changes,
    ingest_metrics,
    open_alerts,
    resolve_changes,
    resolve_metrics,
    settled,
)
from claimlens.sinks.csv_files import write_plain
from claimlens.sinks.files import stamp
from claimlens.sinks.snapshots import SnapshotTable
from claimlens.sources.alert_text import good_lines, rejected_lines


class Published(NamedTuple):
    version: int
    metrics: DataFrame
    rejects: DataFrame | None
    run: str


class Staged(NamedTuple):
    run: str
    metrics: DataFrame
    rejects: DataFrame | None


def _kept(df: DataFrame, path: str) -> DataFrame:
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stage_ingest(
    table: SnapshotTable, parsed: DataFrame, t: Mapping[str, DataFrame], as_of: dt.datetime, out: str
) -> Staged:
    """Writes parsed lines, changes, metrics and rejects of an ingest that does not count yet."""
    base = table.at().number
    lines = _kept(parsed, f"{out}/lines")
    known = table.read(base).select(*ALERT_KEYS)
    changes = ingest_changes(table.unsettled(base), known, good_lines(lines), t, as_of)
    run = table.stage(changes, settled(as_of.date()), base, stamp(as_of))
    metrics = _kept(ingest_metrics(table.staged(run, flag_schema(INGEST_FLAGS))), f"{out}/metrics")
    return Staged(run, metrics, _kept(rejected_lines(lines), f"{out}/rejects"))


def run_daily(
    table: SnapshotTable,
    parsed: DataFrame,
    t: Mapping[str, DataFrame],
    as_of: dt.datetime,
    team: str,
    out: str,
) -> Published:
    """Ingests parsed alert lines, backs up the state before, and writes the open alerts of a team.

    ``out`` is a folder of the run's own: ``backup``, ``lines``, ``metrics``, ``rejects``, ``open_alerts`` (plain
    lines) and ``export`` (typed). The state changes with the last step only.
    """
    table.backup(f"{out}/backup")
    staged = stage_ingest(table, parsed, t, as_of, out)
    state, day = table.after(staged.run), as_of.date()
    write_plain(open_alerts(state, t, day, team), f"{out}/open_alerts")
    export_alerts(open_alerts(state, t, day, team, quotes=False)).write.parquet(f"{out}/export")
    return Published(table.commit(staged.run), staged.metrics, staged.rejects, staged.run)


def run_resolve(
    table: SnapshotTable, keys: DataFrame, t: Mapping[str, DataFrame], as_of: dt.date, team: str, out: str
) -> Published:
    """Refreshes the state, resolves the listed records and writes the open alerts of a team again."""
    base = table.at().number
    changes = resolve_changes(table.unsettled(base), keys, t, as_of)
    run = table.stage(changes, settled(as_of), base, as_of.strftime("%Y%m%d"))
    metrics = _kept(resolve_metrics(table.staged(run, flag_schema(RESOLVE_FLAGS))), f"{out}/metrics")
    write_plain(open_alerts(table.after(run), t, as_of, team), f"{out}/open_alerts")
    return Published(table.commit(run), metrics, None, run)
