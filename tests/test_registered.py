"""Every registered query against its check query, and the shape of its plan."""

import duckdb
import pytest

import __spark_entry__ as e
import check

SF_DIR = "/root/testdata/sf0.001"
QUERIES = e.report_queries()
ORACLES = {k: v for k, v in e.oracle_sql().items() if k in QUERIES}
UNWANTED = ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "MapInPandas", "FlatMapGroups")


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for t in check.TABLES.split():
        con.execute(f"create view {t} as select * from '{SF_DIR}/{t}.parquet'")
    return con


def test_every_query_has_a_check_query():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, con, name):
    plans = []

    def run(session, sf_dir):
        df = QUERIES[name](session, sf_dir)
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return df

    _, problem, _ = check.compare(spark, con, SF_DIR, name, run, ORACLES[name])
    assert problem is None, problem
    assert not [word for word in UNWANTED if word in plans[0]]


ORDERED = {
    "R08_account_opportunity_all": [("pct_not_billed_record", "desc"), ("not_billed_acct_charge", "desc"), ("pat_acct", "asc")],
    "R13_pending_rejected": [("created_at", "desc"), ("cust_id", "asc"), ("pat_acct", "asc")],
    "R20_actionable_responses": [("created_at", "desc"), ("cust_id", "asc"), ("pat_acct", "asc")],
    "R22_data_quality": [("hit_rate", "asc"), ("cnt_accts", "desc")],
}


@pytest.mark.parametrize("name", ORDERED)
def test_rows_come_in_report_order(spark, name):
    """Descending columns start with NULL, ascending ones end with it."""
    rows = [tuple(r[c] for c, _ in ORDERED[name]) for r in QUERIES[name](spark, SF_DIR).collect()]

    def after(a, b):
        for (_, way), x, y in zip(ORDERED[name], a, b):
            if x == y:
                continue
            if x is None or y is None:
                return (x is None) == (way == "desc")
            return (x > y) == (way == "desc")
        return True

    assert len(rows) > 1 and all(after(a, b) for a, b in zip(rows, rows[1:]))


def test_no_job_starts_while_a_report_is_built(spark):
    tracker = spark.sparkContext.statusTracker()
    before = set(tracker.getJobIdsForGroup(None))
    for name in ("R05_payer_opportunity_all", "R12_reconcile_transactions", "R14_consolidated_claims", "R22_data_quality"):
        QUERIES[name](spark, SF_DIR)
    assert set(tracker.getJobIdsForGroup(None)) == before


def test_entry(spark):
    assert e.entry(spark).count() > 0


def plan_of(spark, name):
    return QUERIES[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()


def test_cells_are_not_split(spark):
    """Items of a whole list are counted in the cell, without an object of each."""
    plan = plan_of(spark, "A08_whole_lists")
    assert "split(" not in plan and "flatten(" not in plan


def test_date_filter_reaches_the_scan(spark):
    plan = plan_of(spark, "R21_active_customers")
    assert "GreaterThanOrEqual(l_shipdate,2001-10-22" in plan


def test_scan_reads_needed_columns_only(spark):
    schemas = [line.split("ReadSchema: ")[1] for line in plan_of(spark, "R04_prebill_summary_account_all").splitlines() if "ReadSchema" in line]
    assert schemas and all("totalprice" not in s and "orderdate" not in s for s in schemas)


def test_account_satellites_are_shuffled_once(spark):
    """After the satellites are grouped by account, no join on the account moves them again."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        plan = plan_of(spark, "R08_account_opportunity_all").splitlines()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    # pre-billing, statuses, patient accounts, payments, raw bills, billing
    assert sum("Exchange hashpartitioning(pat_acct#" in line for line in plan) == 6
    assert sum("SortMergeJoin [pat_acct#" in line for line in plan) == 5
