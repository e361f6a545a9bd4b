"""Table catalogue: table name to DataFrame."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession

from claimlens import schemas


class Tables(Mapping):
    """Tables by name, each opened (not read) once, when it is first asked for.

    ``renames`` maps table name to ``{own column: library column}``, for a database whose
    columns carry other names than ``schemas``.
    """

    def __init__(
        self,
        openers: Mapping[str, Callable[[], DataFrame] | DataFrame],
        renames: Mapping[str, Mapping[str, str]] | None = None,
    ) -> None:
        self._openers = dict(openers)
        self._renames = dict(renames or {})
        self._open: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._open:
            opener = self._openers[name]
            df = opener() if callable(opener) else opener
            renames = self._renames.get(name)
            self._open[name] = df.withColumnsRenamed(dict(renames)) if renames else df
        return self._open[name]

    def __iter__(self):
        return iter(self._openers)

    def __len__(self) -> int:
        return len(self._openers)

    @classmethod
    def parquet(cls, spark: SparkSession, root: str, renames=None) -> Tables:
        """One parquet folder per table under ``root``."""
        return cls(
            {name: (lambda n=name: spark.read.parquet(f"{root}/{n}")) for name in schemas.TABLES}, renames
        )

    @classmethod
    def csv(cls, spark: SparkSession, root: str, renames=None) -> Tables:
        """One CSV folder with header per table under ``root``, with the declared types."""
        return cls(
            {
                name: (lambda n=name, s=schema: spark.read.schema(s).csv(f"{root}/{n}", header=True, escape='"'))
                for name, schema in schemas.TABLES.items()
            },
            renames,
        )

    @classmethod
    def metastore(cls, spark: SparkSession, database: str, renames=None) -> Tables:
        """Tables of a catalogue database."""
        return cls({name: (lambda n=name: spark.table(f"{database}.{n}")) for name in schemas.TABLES}, renames)

    @classmethod
    def jdbc(
        cls,
        spark: SparkSession,
        url: str,
        table_names: Mapping[str, str],
        partitioning: Mapping[str, Mapping[str, object]] | None = None,
        options: Mapping[str, str] | None = None,
        renames=None,
    ) -> Tables:
        """Tables of a database.

        ``partitioning[name]`` holds ``column``, ``lowerBound``, ``upperBound`` and
        ``numPartitions``, so that large tables are read by many tasks. Log-in data comes from
        the caller's ``options``.
        """
        parts = partitioning or {}

        def opener(name: str, table: str) -> Callable[[], DataFrame]:
            return lambda: spark.read.jdbc(url, table, properties=dict(options or {}), **parts.get(name, {}))

        return cls({name: opener(name, table) for name, table in table_names.items()}, renames)


def sql_frame(spark: SparkSession, text: str, tables: Tables, **args) -> DataFrame:
    """A SQL text over the catalogue; ``{name}`` stands for the table ``name``."""
    used = {name: tables[name] for name in tables if "{" + name + "}" in text}
    return spark.sql(text, **used, args=args or None)
