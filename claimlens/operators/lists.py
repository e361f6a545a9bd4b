"""Text lists per group (``string_agg``). A cell always holds every item of its list.

Forms, by what is known about the groups:

* ``set_text`` / ``bag_text`` are plain aggregates, for values from a small domain
  (stage codes, statuses, payers of one account, states).
* ``text_lists`` is for few large groups, such as the accounts of one payer. Items are
  made distinct first, spread over ``(keys, list, item)``, dealt out by range and joined to
  pieces of text; then the pieces are joined, one task per key.
* ``list_and_sums`` is the same for one list, with sums taken in the same passes.
* ``group_lists`` is for many groups, such as accounts: one aggregation, with partial lists
  per task before the shuffle.
* ``list_chunks`` cuts lists of any length into numbered pieces of a fixed number of items,
  made from a range partitioning, so that no task holds a whole list; ``joined_chunks`` puts
  them together where a cell is wanted after all.

A list that does not fit one cell of Spark (2 GB) makes the query fail; it is never cut.
``list_items`` is the long form and always holds every item of every list.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimlens.operators.positions import numbered
from claimlens.sinks.bundle import LONG

@dataclass(frozen=True)
class TextList:
    """One list column: its items, the separator, and whether copies are kept."""

    value: Column
    sep: str
    distinct: bool = True
    times: Column | None = None  # copies each row stands for


def _joined(items: Column, sep: str | Column) -> Column:
    return F.when(F.size(items) > 0, F.array_join(items, sep))


def set_text(value: Column, sep: str) -> Column:
    """Distinct values in order; NULL when there is none."""
    return _joined(F.sort_array(F.collect_set(value.cast("string"))), sep)


def bag_text(value: Column, sep: str) -> Column:
    """All values in order, copies kept; NULL when there is none."""
    return _joined(F.sort_array(F.collect_list(value.cast("string"))), sep)


def same_key(keys: Sequence[str], prefix: str) -> Column:
    """Null-safe equality of each key with its prefixed twin."""
    test = F.lit(True)
    for k in keys:
        test = test & F.col(k).eqNullSafe(F.col(prefix + k))
    return test


def prefixed(df: DataFrame, keys: Sequence[str], prefix: str) -> DataFrame:
    return df.withColumnsRenamed({k: prefix + k for k in keys})


def list_items(df: DataFrame, keys: Sequence[str], lists: Mapping[str, TextList]) -> DataFrame:
    """Every list in long form: keys, ``list_name``, ``item``, ``copies``."""
    entries = F.array(
        *[
            F.struct(
                F.lit(name).alias("list_name"),
                spec.value.cast("string").alias("item"),
                (F.lit(1) if spec.times is None else spec.times).cast("bigint").alias("times"),
            )
            for name, spec in lists.items()
        ]
    )
    long = df.select(*keys, F.explode(entries).alias("entry")).select(*keys, "entry.*")
    bags = [name for name, spec in lists.items() if not spec.distinct]
    return (
        long.filter(F.col("item").isNotNull())
        .groupBy(*keys, "list_name", "item")
        .agg(F.sum("times").alias("copies"))
        .withColumn("copies", F.when(F.col("list_name").isin(bags), F.col("copies")).otherwise(1) if bags else F.lit(1).cast("bigint"))
    )


def _separator(lists: Mapping[str, TextList]) -> Column:
    sep = F.lit(None).cast("string")
    for name, spec in lists.items():
        sep = F.when(F.col("list_name") == name, F.lit(spec.sep)).otherwise(sep)
    return sep


def _pieces(items: DataFrame, group: Sequence[str], sep: Column, sums: Sequence[str] = ()) -> DataFrame:
    """The items of every list as texts of up to 1,024 different items each: the group, ``_piece``, ``_text``, sums.

    ``items`` has ``item``, ``copies`` and the sums. The items are dealt out by range, so the pieces of a list, taken by
    number, are in its order. Both times they go to a fixed number of tasks, which are not merged: the size of
    compressed texts says little about the memory they take.
    """
    tasks = int(items.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    by = [*(F.asc_nulls_first(k) for k in group), F.asc_nulls_first("item")]
    placed = items.repartitionByRange(tasks, *by).sortWithinPartitions(*by).withColumn("_at", F.monotonically_increasing_id())
    dealt = placed.withColumn("_piece", F.shiftright("_at", 10)).repartition(tasks, *group, "_piece")
    text = F.concat(F.call_function("repeat", F.concat("item", sep), F.col("copies").cast("int") - 1), "item")
    entry = F.when(F.col("item").isNotNull() & (F.col("copies") > 0), F.struct("_at", text.alias("text")))
    texts = F.sort_array(F.collect_list(entry))
    return dealt.groupBy(*group, "_piece").agg(
        F.when(F.size(texts) > 0, F.call_function("concat_ws", sep, texts["text"])).alias("_text"),
        *[F.sum(n).alias(n) for n in sums],
    )


def _cell(test: Column, sep: str, filled: Column | None = None) -> Column:
    """The pieces that pass a test, in order, as one text. It is made inside the aggregation, and the length of the
    text is known before it is made, so that a task holds the pieces and the text, and no more forms of them."""
    pieces = F.sort_array(F.collect_list(F.when(test & F.col("_text").isNotNull(), F.struct("_piece", "_text"))))
    return F.when(F.size(pieces) > 0 if filled is None else filled, F.concat_ws(sep, pieces["_text"]))


def text_lists(df: DataFrame, keys: Sequence[str], lists: Mapping[str, TextList]) -> DataFrame:
    """One row per key that has any item, one text column per list."""
    keys = list(keys)
    pieces = _pieces(list_items(df, keys, lists), [*keys, "list_name"], _separator(lists))
    own = {name: F.col("list_name") == name for name in lists}
    return pieces.groupBy(*keys).agg(
        *[_cell(own[name], spec.sep, F.count(F.when(own[name], 1)) > 0).alias(name, metadata={LONG: True}) for name, spec in lists.items()]
    )


def list_and_sums(
    df: DataFrame, keys: Sequence[str], name: str, spec: TextList, sums: Mapping[str, Column], report: DataFrame | None = None
) -> DataFrame:
    """One row per key: one list as with ``text_lists``, NULL where it has no item, and exact sums.

    Rows are reduced to (keys, item), then to pieces of the list, then to the keys; the sums go along, so the rows are
    read once. Sums of integers or decimals only, as they are added up in any order.

    ``report``, one row per key with every key of the rows, is what a left join on the keys would add these columns to.
    Its columns come along in the last step, so that no join copies a list.
    """
    keys, totals = list(keys), {n: f"_sum_{i}" for i, n in enumerate(sums)}
    times = (F.lit(1) if spec.times is None else spec.times).cast("bigint")
    rows = df.select(*keys, spec.value.cast("string").alias("item"), times.alias("_times"), *[c.alias(totals[n]) for n, c in sums.items()])
    copies = F.lit(1).cast("bigint") if spec.distinct else F.sum("_times")
    items = rows.groupBy(*keys, "item").agg(copies.alias("copies"), *[F.sum(t).alias(t) for t in totals.values()])
    pieces = _pieces(items, keys, F.lit(spec.sep), list(totals.values()))
    made = [_cell(F.lit(True), spec.sep).alias(name, metadata={LONG: True}), *[F.sum(t).alias(n) for n, t in totals.items()]]
    if report is None:
        return pieces.groupBy(*keys).agg(*made)
    others = [F.first(f.name, ignorenulls=True).alias(f.name, metadata=f.metadata) for f in report.schema.fields if f.name not in keys]
    known = pieces.dropna(subset=keys).unionByName(report, allowMissingColumns=True)
    return known.groupBy(*keys).agg(*others, *made)


def list_chunks(
    df: DataFrame, keys: Sequence[str], lists: Mapping[str, TextList], size: int = 10_000, folder: str | None = None
) -> DataFrame:
    """Every list in numbered pieces of ``size`` different items: keys, ``list_name``, ``chunk`` (from 1), ``items``,
    ``copies`` and ``text`` (its items in order, joined, copies kept where the list keeps them).

    The pieces in order, joined by the separator, are the list. The items are numbered by range partitions
    (``positions.numbered``), so the work of a key with very many items is spread, and a task holds pieces only.
    """
    keys = list(keys)
    group = [*keys, "list_name"]
    placed = numbered(list_items(df, keys, lists), [F.asc("item")], "_place", group, folder)
    entry = F.struct("_place", "item", F.col("copies").cast("int").alias("copies"))
    sep = _separator(lists)
    chunks = placed.groupBy(*group, (F.floor((F.col("_place") - 1) / size) + 1).alias("chunk")).agg(
        F.sort_array(F.collect_list(entry)).alias("_bag"), F.count("*").alias("items"), F.sum("copies").alias("copies")
    )
    texts = F.flatten(F.transform("_bag", lambda x: F.array_repeat(x["item"], x["copies"])))
    return chunks.select(*group, "chunk", "items", "copies", F.call_function("array_join", texts, sep).alias("text"))


def joined_chunks(chunks: DataFrame, keys: Sequence[str], lists: Mapping[str, TextList]) -> DataFrame:
    """The pieces put together: one row per key, one text column per list."""
    cells = chunks.groupBy(*keys).agg(
        *[
            F.sort_array(F.collect_list(F.when(F.col("list_name") == n, F.struct("chunk", "text")))).alias(n)
            for n in lists
        ]
    )
    return cells.select(*keys, *[_joined(F.col(n)["text"], spec.sep).alias(n) for n, spec in lists.items()])


def group_lists(
    df: DataFrame, keys: Sequence[str], lists: Mapping[str, TextList], aggs: Sequence[Column] = ()
) -> DataFrame:
    """One row per key: the aggregates and one text column per list, in one aggregation."""
    text = lambda spec: (set_text if spec.distinct else bag_text)(spec.value, spec.sep)
    return df.groupBy(*keys).agg(*aggs, *[text(spec).alias(name) for name, spec in lists.items()])
