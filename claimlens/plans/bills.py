"""Bill tables with their JSON documents read once, for runs that make several reports.

Each report on raw bills looks at a few keys of a document. ``prepare_bills`` parses every document once and writes
the keys that any report asks for as a typed struct beside the other columns. A report that meets the struct reads its
fields, and a scan reads only those of them that the report names; the text is neither read nor parsed again.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

from claimlens.functions.text import FIELDS, json_record
from claimlens.plans.consolidated import CLAIM_FACTS
from claimlens.plans.quality import BILL_KEYS, CLAIM_KEYS
from claimlens.plans.traits import CLIENT_BILL_FACTS, RAW_BILL_FACTS
from claimlens.sources.tables import Tables

DOCUMENTS = {
    "client_raw_bills": {"content": (*BILL_KEYS, *CLIENT_BILL_FACTS), "claim_content": (*CLAIM_KEYS, *CLAIM_FACTS)},
    "raw_bills": {"content": RAW_BILL_FACTS},
}


def parsed_bills(bills: DataFrame, table: str) -> DataFrame:
    """A bill table with a struct of text fields in place of each document."""
    documents = DOCUMENTS[table]
    return bills.withColumns({d + FIELDS: json_record(bills[d], *dict.fromkeys(k)) for d, k in documents.items()}).drop(*documents)


def prepare_bills(t: Mapping[str, DataFrame], folder: str) -> Tables:
    """Writes the parsed bill tables under ``folder`` and gives a catalogue that has them in their place."""
    openers = {name: (lambda n=name: t[n]) for name in t}
    for table in DOCUMENTS:
        parsed = parsed_bills(t[table], table)
        path = f"{folder}/{table}"
        parsed.write.parquet(path)
        spark, schema = parsed.sparkSession, parsed.schema
        openers[table] = lambda s=spark, schema=schema, path=path: s.read.schema(schema).parquet(path)
    return Tables(openers)
