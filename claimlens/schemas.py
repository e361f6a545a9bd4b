"""Schemas of the claim tables and files."""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = "decimal(18,2)"


_TYPES = {
    "bigint": T.LongType(),
    "int": T.IntegerType(),
    "string": T.StringType(),
    "boolean": T.BooleanType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
    MONEY: T.DecimalType(18, 2),
}


def _schema(text: str) -> T.StructType:
    """``name type, name type`` without needing a session."""
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in (c.split(" ") for c in text.split(", "))])


TABLES: dict[str, T.StructType] = {
    "pre_billing": _schema(
        "pm_sk bigint, src_sk bigint, cust_id int, pat_acct string, insurance_name string, status string, "
        f"charges {MONEY}, claim_type string, claim_num string, created_at timestamp, content string"
    ),
    "billing": _schema(
        "pm_sk bigint, cust_id int, pat_acct string, insurance_name string, claim_type string, "
        "accident_state string, patient_state string, fdos date, ldos date, accident_date date, "
        "bill_sent_at timestamp, created_at timestamp, sending_method string, vendor string, "
        f"claim_num string, patient_name string, policy_number string, charges {MONEY}"
    ),
    "claim_responses": _schema(
        "pm_sk bigint, cust_id int, pat_acct string, code string, note string, created_at timestamp, "
        "response_from string"
    ),
    "client_raw_bills": _schema(
        f"cust_id int, pat_acct string, total_charges {MONEY}, admission_date date, discharge_date date, "
        "principal_diagnosis string, created_at timestamp, content string, claim_content string"
    ),
    "raw_bills": _schema(
        f"pat_acct string, gross_charges {MONEY}, admit_date_or_service_date date, discharge_date date, "
        "created_at timestamp, content string"
    ),
    "pending_bills": _schema(
        "created_at timestamp, cust_id int, pat_acct string, admit_date_or_service_date string, "
        "discharge_date string, notes string, processed boolean, processed_at timestamp, "
        "orig_file_name string, content string"
    ),
    "rejected_bills": _schema(
        "created_at timestamp, cust_id int, pat_acct string, patient_firstname string, patient_lastname string, "
        "admit_date_or_service_date string, discharge_date string, notes string, processed boolean, "
        "processed_at timestamp, orig_file_name string, content string"
    ),
    "customers": _schema("master_id int, cust_id int, cust_name string, cust_type string"),
    "account_statuses": _schema("pat_acct string, status string"),
    "patient_accounts": _schema("cust_id int, pat_acct string, status_code string, status_date date"),
    "status_codes": _schema("status_code string, status_desc string, default_x12_code string, usage string"),
    "payments_a": _schema(
        f"pat_acct string, insurance_name string, payment {MONEY}, payment_date date, payment_post_date date, "
        "duplicate_payment boolean, not_billed boolean"
    ),
    "payments_b": _schema(
        f"pat_acct string, insurance_name string, payment {MONEY}, payment_date date, payment_post_date date, "
        "duplicate_payment boolean, not_billed boolean"
    ),
    "transactions": _schema(
        f"cust_id int, pat_acct string, charges {MONEY}, trans_amt {MONEY}, trans_date date, trans_id string, "
        "insurance_name string, created_at timestamp, duplicate_payment boolean"
    ),
}

ALERTS = _schema(
    "created_at timestamp, pm_sk bigint, src_sk bigint, pat_acct string, note string, code string, cust_id int, "
    f"claim_num string, charges {MONEY}, patient_name string, policy_number string, insurance_name string, "
    "effective_date date, assigned string, processed boolean, processed_at date, claim_type string, "
    "vx_carrier_lob string, work_comp_flag string"
)

# Headers of the remittance file, spaces already replaced.
REMITTANCE_COLUMNS = {
    "cust_id": "cust_id int",
    "Patient_Account_#": "pat_acct string",
    "Payer": "insurance_name string",
    "Charged": f"charges {MONEY}",
    "Paid_Amt": f"remit_paymt {MONEY}",
    "Pay_Date": "paymt_date int",
    "ANSI_Codes": "claim_adj_seg string",
    "EFT_Check#": "remit_check_num string",
}
