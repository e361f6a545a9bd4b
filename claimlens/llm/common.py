"""Helpers shared by the operators: reading tables, tables written in the shared folder."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimlens.sinks.files import shared_folder


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path in the folder that driver and executors share (``spark.checkpoint.dir``); an error where it is
    unset on a cluster."""
    return shared_folder(spark, name)


def written(df: DataFrame, name: str, codec: str = "snappy") -> DataFrame:
    """``df`` as a table in the shared folder: lineage ends here and lost executors lose nothing."""
    path = shared_path(df.sparkSession, name)
    df.write.option("compression", codec).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def texts(documents: DataFrame) -> DataFrame:
    """The two columns that text operators read; a null text counts as an empty one."""
    return documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text")
    )


def text_slices(texts: pa.Array, most: int) -> Iterator[pa.Array]:
    """A batch's texts in runs of about ``most`` bytes; a longer text is a run of its own."""
    ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False)) if len(texts) else np.zeros(0, np.int64)
    start = 0
    while start < len(texts):
        before = int(ends[start - 1]) if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + most, "right")))
        yield texts.slice(start, stop - start)
        start = stop


#: the place of rows without an id, behind all others
LAST_ID = (1 << 63) - 1

#: at most so many hashes may stand for several texts each; with 64 bits one pair is expected among 6e9 texts
MOST_CLASHES = 10_000


def order_id():
    return F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST_ID))


def text_hash(text):
    return F.xxhash64(text)


def other_hash(text):
    """A second hash, which tells texts of equal ``text_hash`` apart."""
    return F.xxhash64(text, F.lit(1))


def text_key(text, clashes: list[int]):
    """A number per text: its hash, or one made from both hashes where that hash stands for several texts."""
    th = text_hash(text)
    return F.when(th.isin(clashes), F.xxhash64(th, other_hash(text))).otherwise(th) if clashes else th


def clashing(groups: DataFrame, key: str) -> list[int]:
    """The keys of ``groups`` that stand for several texts, as their least and greatest second hashes ``a`` and ``b``
    differ (as good as always none)."""
    found = [r[0] for r in groups.filter("a <> b").select(key).limit(MOST_CLASHES + 1).collect()]
    if len(found) > MOST_CLASHES:
        raise RuntimeError(f"more than {MOST_CLASHES} text hashes stand for several texts")
    return found


FILTER_WORDS = 1 << 18
MAYBE = "_maybe"


def possibly(source: DataFrame, keys: DataFrame, columns: list[str]) -> DataFrame:
    """``source`` with ``MAYBE``: false where the values of ``columns`` are surely not among ``keys``.

    It is told by a bitmap of ``FILTER_WORDS`` words of 64 bits, whose size does not depend on the data. So rows
    that need not meet the keys can stay where they lie; with far more keys than bits most rows are maybe.
    """
    slot = F.pmod(F.xxhash64(*columns, F.lit(2)), F.lit(64 * FILTER_WORDS))
    place = {"_word": F.shiftright(slot, 6).cast("int"), "_bit": (slot % 64).cast("int")}
    words = keys.select(*columns).withColumns(place).groupBy("_word").agg(F.expr("bit_or(shiftleft(1L, _bit))").alias("_mask"))
    marked = source.withColumns(place).join(F.broadcast(words), "_word", "left")  # at most FILTER_WORDS rows of two numbers
    told = F.coalesce(F.expr("shiftright(_mask, _bit) & 1L = 1L"), F.lit(False))
    return marked.withColumn(MAYBE, told).select(*source.columns, MAYBE)
