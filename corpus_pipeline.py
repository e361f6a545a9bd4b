"""The corpus pipeline: five stages over the documents table, each written and read again.

1. quality: documents that the quality model rejects go.
2. near_duplicates: of each group of near copies the document with the least doc_id stays, no other goes.
3. repeats: byte strings that start earlier in the corpus are cut out; a document that they leave empty goes.
4. personal_data: personal data and the terms that disclose them are replaced.
5. packing: the documents are tokenized and packed into sequences.

All but the last stage return the columns of documents. Rows are told apart by doc_id and text: rows without an id
take part and come last, texts that share an id are documents of their own, and a row that repeats both goes. Null
texts count as empty ones; empty documents are rejected by the quality model where it has learnt anything.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimlens.llm import (
    op1_pii,
    op3_quality_gam,
    op5_suffix_dedup,
    op6_chosen_path_join,
    op9_best_fit_packing,
)
from claimlens.llm.common import shared_path, table

#: stages cannot be told as SQL; they are tested against brute force
ORACLE_SQL = None


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score reaches the threshold; scored where they lie, without a join."""
    return op3_quality_gam.kept(docs, op3_quality_gam.train(docs, table(spark, sf_dir, "labels")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the least doc_id of each group of near copies."""
    return op6_chosen_path_join.one_of_each(docs)


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the byte strings that start earlier."""
    return op5_suffix_dedup.without_repeats(docs).filter(F.length(F.trim("text")) > 0)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data and disclosing terms replaced."""
    return op1_pii.sanitised(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their sequence and offset."""
    import public_tokenizers

    return op9_best_fit_packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("repeats", repeats),
    ("personal_data", personal_data),
    ("packing", packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table; each result is written to the shared folder and read by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = shared_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
