"""Small inputs with the awkward cases that every operator must take."""

import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

from llm_helpers import SF_DIR  # noqa: E402



@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]")
        .appName("llm-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "4g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    return session


#: columns whose names clash with those that operators use inside
CLASHING = (
    "key long, th long, c long, n int, base string, spans string, spot string, sig string, part int, nth int, rank int, "
    "length int, score double, x string, h long, size int, path string, block int, at int, digest string, need int"
)


def clashing():
    return [None] * len(CLASHING.split(","))


@pytest.fixture(scope="session")
def awkward(spark):
    """Nulls, empty, very long, tied and repeated rows, and columns with clashing names."""
    long_text = " ".join(f"word{i % 977} and the other{i % 131}" for i in range(12_000))
    rows = [
        (1, "The quick brown fox is near the old river bank in this quiet town.", "en", "a", 5),
        (2, None, None, None, None),
        (3, "", "en", "a", 0),
        (4, "The quick brown fox is near the old river bank in this quiet town.", "en", "b", 5),
        (4, "The quick brown fox is near the old river bank in this quiet town.", "en", "b", 5),
        (5, long_text, "de", "a", 1),
        (6, long_text, "de", "a", 1),
        (7, "   \n \t ", "fr", "a", 7),
        (8, "é😀 ß\u0301 a.b@c.de, +1 (386) 555-3733, 10.0.0.1, 4111 1111 1111 1111", "fr", "a", 7),
        (None, "a row without an id is still the text of someone", "en", "a", 7),
        (9, "x" * 60_000, "en", "a", 7),
    ]
    return spark.createDataFrame(
        [(*r, *clashing()) for r in rows], f"doc_id long, text string, lang string, source string, n_chars long, {CLASHING}"
    )


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet")
