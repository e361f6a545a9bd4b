import duckdb
import pytest

import __spark_entry__ as entry
import check
from claimlens.llm import registered
from llm_helpers import SF_DIR


def test_every_operator_is_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in registered.QUERIES) == list(range(1, 14))
    assert set(registered.QUERIES) | {"pipeline"} <= set(entry.queries())


@pytest.mark.parametrize("name", registered.ORACLES)
def test_check_query(spark, name):
    con = duckdb.connect()
    for t in ("pages", "embeddings", "documents"):
        con.execute(f"create view {t} as select * from '{SF_DIR}/{t}.parquet'")
    _, problem, _ = check.compare(spark, con, SF_DIR, name, registered.QUERIES[name], registered.ORACLES[name])
    assert problem is None, problem
