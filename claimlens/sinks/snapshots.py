"""Versioned snapshots of a state table on any file system that Spark writes to.

A run writes its rows once, apart by whether they are settled, that is, whether no later run can change them. A version
consists of the settled rows of all runs since the last whole one, and of the unsettled rows of its own run. So
a run reads and rewrites the unsettled part only; the history lies where it was written.

    <root>/data/_run=<name>/_settled=<true|false>/...     rows of a run, counting or not
    <root>/log/<version>.json                             which run made the version

A version counts once its log entry is there. The entry is made in one step and only if nobody else has made it, so of
two runs that started from the same version the second one fails with ``Conflict``, and a run that dies before leaves
the old version in force. The log is read as it is: a missing or unreadable entry is an error, not an empty table.
"""

from __future__ import annotations

import json
import re
import uuid
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimlens.sinks.files import Files

RUN, SETTLED = "_run", "_settled"
ENTRY = re.compile(r"(\d{12})\.json")


class Conflict(RuntimeError):
    """Another run has published the version that this one would have been."""


class BrokenLog(RuntimeError):
    """The log does not tell which data counts."""


class Version(NamedTuple):
    number: int
    runs: tuple[str, ...]  # since the last whole one, its own run last


class SnapshotTable:
    def __init__(self, spark: SparkSession, root: str, schema: T.StructType) -> None:
        self.spark, self.root, self.schema = spark, root.rstrip("/"), schema
        self._files = Files(spark, self.root)
        self._bases: dict[str, tuple[int, bool]] = {}

    # ---------------------------------------------------------------- log

    def _entry(self, number: int) -> str:
        return f"{self.root}/log/{number:012d}.json"

    def _read_entry(self, number: int) -> dict:
        try:
            entry = json.loads(self._files.read(self._entry(number)))
            return {"run": entry["run"], "whole": entry["whole"]}
        except (ValueError, KeyError, TypeError) as error:
            raise BrokenLog(f"entry of version {number} of {self.root} cannot be read") from error

    def version(self) -> int:
        """Current version, 0 when nothing was published."""
        numbers = [int(m.group(1)) for m in map(ENTRY.fullmatch, self._files.names(f"{self.root}/log")) if m]
        if not numbers and self._files.names(f"{self.root}/data"):
            raise BrokenLog(f"{self.root} holds data but no log")
        if sorted(numbers) != list(range(len(numbers))):
            raise BrokenLog(f"{self.root}/log misses a version below {max(numbers)}")
        return max(numbers, default=0)

    def at(self, number: int | None = None) -> Version:
        """A version (the current one by default) and the runs it consists of."""
        last = self.version()
        number = last if number is None else number
        if not 0 <= number <= last:
            raise ValueError(f"there is no version {number}, the last one is {last}")
        runs, whole = [], number == 0
        while not whole:
            entry = self._read_entry(number - len(runs))
            whole = entry["whole"]
            runs.append(entry["run"])
        return Version(number, tuple(reversed(runs)))

    # ---------------------------------------------------------------- reading

    def _rows(self, runs: tuple[str, ...], extra: T.StructType | None = None) -> DataFrame:
        fields = [*self.schema.fields, *(extra.fields if extra else [])]
        schema = T.StructType([*fields, T.StructField(RUN, T.StringType()), T.StructField(SETTLED, T.BooleanType())])
        if not runs:
            return self.spark.createDataFrame([], schema)
        data = f"{self.root}/data"
        return self.spark.read.schema(schema).option("basePath", data).parquet(*[f"{data}/{RUN}={r}" for r in runs])

    def _state(self, runs: tuple[str, ...], extra: T.StructType | None = None) -> DataFrame:
        rows = self._rows(runs, extra)
        return rows.filter(F.col(SETTLED) | (F.col(RUN) == runs[-1])) if runs else rows

    def read(self, version: int | None = None) -> DataFrame:
        return self._state(self.at(version).runs).select(*self.schema.names)

    def read_with(self, extra: T.StructType, version: int | None = None) -> DataFrame:
        """The rows of a version with further columns of its own run; NULL in rows that it did not write."""
        runs = self.at(version).runs
        own = F.col(RUN) == (runs[-1] if runs else "")
        return self._state(runs, extra).select(*self.schema.names, *[F.when(own, F.col(c)).alias(c) for c in extra.names])

    def unsettled(self, version: int | None = None) -> DataFrame:
        """The rows that a run may change."""
        return self._state(self.at(version).runs).filter(~F.col(SETTLED)).select(*self.schema.names)

    # ---------------------------------------------------------------- writing

    def stage(
        self, df: DataFrame, settled: Column | None = None, base: int | None = None, name: str | None = None
    ) -> str:
        """Writes the rows of a run that does not count yet and gives the run's name.

        Without ``settled`` the rows are the whole table. With it they take the place of the unsettled rows of
        version ``base`` (the current one by default), and those that pass it will not be read for changes again.
        Columns beyond the schema, such as flags of changed rows, are kept with the run.
        """
        base = self.version() if base is None else base
        self._files.create_once(self._entry(0), "{}")  # from now on a missing log is an error
        run = "-".join(filter(None, (name, uuid.uuid4().hex)))
        rows = df.withColumn(SETTLED, F.lit(False) if settled is None else F.coalesce(settled, F.lit(False)))
        rows.write.partitionBy(SETTLED).parquet(f"{self.root}/data/{RUN}={run}")
        self._bases[run] = (base, settled is None)
        return run

    def staged(self, run: str, extra: T.StructType | None = None) -> DataFrame:
        """The rows of a run alone, with its further columns."""
        return self._rows((run,), extra).drop(RUN, SETTLED)

    def after(self, run: str) -> DataFrame:
        """The table as it is once the staged run counts."""
        base, whole = self._bases[run]
        runs = () if whole else self.at(base).runs
        return self._state((*runs, run)).select(*self.schema.names)

    def commit(self, run: str) -> int:
        """Makes a staged run the next version and gives its number."""
        base, whole = self._bases[run]
        entry = json.dumps({"run": run, "whole": whole or base == 0})
        if not self._files.create_once(self._entry(base + 1), entry):
            raise Conflict(f"version {base + 1} of {self.root} was published by another run")
        return base + 1

    def publish(self, df: DataFrame) -> int:
        """Writes the whole table as the next version and gives its number."""
        return self.commit(self.stage(df))

    def compact(self, settled: Column) -> int:
        """Writes the table anew as one run, so that readers open few files."""
        base = self.at()
        run = self.stage(self.read(base.number), settled, base.number)
        self._bases[run] = (base.number, True)
        return self.commit(run)

    def abandoned(self) -> list[str]:
        """Runs that no version names, left by runs that died or lost; their folders can go."""
        used = {self._read_entry(n)["run"] for n in range(1, self.version() + 1)}
        names = [n.removeprefix(f"{RUN}=") for n in self._files.names(f"{self.root}/data")]
        return [n for n in names if n not in used]

    def backup(self, path: str, version: int | None = None) -> None:
        """Copies a version (the current one by default) over a backup folder."""
        self.read(version).write.mode("overwrite").parquet(path)
