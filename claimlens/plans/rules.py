"""Rule data of the reports, and the expressions made from it."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from claimlens.functions.flags import not_among
from claimlens.functions.text import contains_ci, json_text

# ---------------------------------------------------------------------------
# Stage codes of a pre-billing record.
BILLED = "B"
STAGE_TEXTS = {
    "E": "Exception: Data missing or error from customer; {agency} cannot fill in crucial information such as procedure or diagnosis codes etc.",
    "PB": "Pre-Bill: Ready to bill",
    "PC": "Pre-Closed: Do not need to send; Customer already paid",
    "W": "Waiting: Data missing or error from non-customer sources; {agency} can attempt to fill in such a fax #, patient zip code etc.",
    "X": "Withdrawn by Customer: Do not need to send; Customer may have already been paid 70%",
}
BILLED_TEXT = "Billed"
NO_FAX_STAGES = ["W", "PB"]

# Workflow status codes (without the agency's code prefix), description, X12 code, note.
STATUS_ROWS = (
    ("REQ00", "{agency} request for account placement", " ", "{agency} request for placement"),
    ("ACK00", "{agency} acknowledges receipt of account, placement successful", " ", "{prefix} reserved, placement acknowledged"),
    ("DUP00", "{agency} returns placement as duplicate, the original account placement will remain with {agency}", " ", "{prefix} reserved, placement duplicate"),
    ("PND00", "Placement accepted but pended for data edit review", " ", "{prefix} reserved, pended for review"),
    ("REJ00", "Placement returned for rejection (does not meet processing criteria or failed data edit review)", " ", "{prefix} returned, placement rejected"),
    ("DRP00", "Bill has been dropped to the carrier, may provide a carrier name", " ", "{prefix} reserved, dropped bill"),
    ("RLS01", "{agency} workflows have ended and an account has been returned to the client", " ", "{prefix} returned, not eligible"),
    ("RLS02", "{agency} reserves the account for MVA payment, the client may bill the next responsible party. This code may be used to trigger the client’s billing system to bill the next responsible party after a mutually defined number of days following initial placement with {agency}. Presence of “carrier” is advising that the health payer can be considered as secondary to the MVA carrier (per client’s discretion).", " ", "{prefix} reserved, move to next carrier"),
    ("RLS03", "{agency} reserves the account for continued pursuit of recovery with an attorney, client should not bill other parties, {agency} may provide law firm as carrier", " ", "{prefix} reserved, attorney on record"),
    ("RLS04", "Agency placement returned without payment", " ", "{prefix} returned, without payment"),
    ("RLS05", "Agency placement returned with payment", " ", "{prefix} returned, with payment"),
    ("RLS06", "{agency} reserves account with partial payment", " ", "{prefix} reserved, partial payment received"),
    ("RLS99", "Audit", " ", "{prefix} reserved, audit"),
)

# Payer responses worth acting on: code, how the note is compared, note.
RESPONSE_RULES = (
    ("277-F4", "matches", "A7:35"),
    ("277-F4", "matches", "A7:97"),
    ("277-F4", "equals", "missing Claim Number"),
    ("277-F4", "equals", "patient cannot be identified as our insured"),
    ("835-N587", "equals", "lifetime benefit maximum has been reached for this service"),
    ("835-N650", "equals", "incomplete/invalid documentation"),
    ("277-P1", "equals", "pending"),
    ("835-B13", "matches", "CAS code"),
    ("277-A7", "matches", "missing or wrong diagnosis code"),
)

# Diagnosis letters and genders that say nothing, per raw-bill table.
CLIENT_BILL_NO_DIAGNOSIS = ["", ";", "1"]
CLIENT_BILL_NO_GENDER = ["F; U", "F; M", "M; U"]
RAW_BILL_NO_DIAGNOSIS = ["3", "", "9", "2", "1", "4", "7", "8", "5", "6", "0"]
RAW_BILL_NO_GENDER = ["F; M", ""]

# Match-time buckets as (name, more than, up to) days.
MATCH_BUCKETS = (
    ("currnt", None, 3),
    ("over_3", 3, 7),
    ("over_7", 7, 30),
    ("over_30", 30, 90),
    ("over_90", 90, None),
)

ALERT_MAX_DAYS = 365
ACTIVE_DAYS = 180
# ---------------------------------------------------------------------------

SCOPES = ("all", "not_billed", "no_fax")


def response_rule(code: Column, note: Column, rules: Sequence[tuple[str, str, str]] = RESPONSE_RULES) -> Column:
    """True for a response that meets any of the rules."""
    tests = [
        (code == rule_code) & (contains_ci(note, text) if how == "matches" else note == text)
        for rule_code, how, text in rules
    ]
    return reduce(lambda a, b: a | b, tests)


def stage_text(status: Column, scope: str, agency: str) -> Column:
    """Description of a stage code; anything else is billed in the report of all claims."""
    text = F.lit(BILLED_TEXT if scope == "all" else None).cast("string")
    for code, words in reversed(STAGE_TEXTS.items()):
        text = F.when(status == code, words.format(agency=agency)).otherwise(text)
    return text


def status_dictionary(
    spark: SparkSession, status_codes: DataFrame, agency: str = "Agency", prefix: str = "AGY"
) -> DataFrame:
    """Status texts: the fixed ones with the agency's name and code prefix filled in, and the table.

    A code that has other texts in the table gives two rows.
    """
    fixed = [
        (prefix + code, *[text.format(agency=agency, prefix=prefix) for text in texts]) for code, *texts in STATUS_ROWS
    ]
    names = "pat_acct_status string, description string, x12_code string, note string"
    table = status_codes.select(
        F.col("status_code").alias("pat_acct_status"),
        F.col("status_desc").alias("description"),
        F.col("default_x12_code").alias("x12_code"),
        F.col("usage").alias("note"),
    )
    return spark.createDataFrame(fixed, names).union(table).distinct()


def no_fax(excluded_customers=()) -> Column:
    """Waiting or ready records without a fax number, outside the excluded customers."""
    fax = json_text(F.col("content"), "send_fax_number")
    return (
        F.col("status").isin(NO_FAX_STAGES)
        & F.nullif(fax, F.lit("")).isNull()
        & not_among(F.col("cust_id"), excluded_customers)
    )


def in_scope(scope: str, excluded_customers=()) -> Column:
    """The rows a report is about."""
    if scope == "all":
        return F.lit(True)
    if scope == "not_billed":
        return F.col("status") != BILLED
    if scope == "no_fax":
        return no_fax(excluded_customers)
    raise ValueError(f"scope must be one of {SCOPES}")


def bucket_test(days: Column, more_than: int | None, up_to: int | None) -> Column:
    test = F.lit(True)
    if more_than is not None:
        test = test & (days > more_than)
    if up_to is not None:
        test = test & (days <= up_to)
    return test & days.isNotNull()


