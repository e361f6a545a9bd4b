"""The claim tables as views over the sample tables, for both engines.

Each view is one select list over one join; the expressions are written in the part of SQL that
Spark and DuckDB share, so the same text makes the Spark frames and the CTEs of the check queries.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimlens import Tables, tune

AS_OF = dt.date(2002, 1, 1)
EVENTS_AS_OF = dt.date(2024, 2, 15)
EXCLUDED_CUSTOMERS = (3, 17)
SUPPRESSED_CUSTOMERS = (5, 11)
EXCLUDED_SOURCE = "SRC1"


@dataclass(frozen=True)
class View:
    tables: tuple[str, ...]
    on: tuple[str, ...]
    columns: dict[str, str]
    where: str | None = None

    def duckdb(self) -> str:
        source = self.tables[0] + "".join(f" join {t} on {c}" for t, c in zip(self.tables[1:], self.on))
        items = ", ".join(f'{e} as "{n}"' for n, e in self.columns.items())
        return f"select {items} from {source}" + (f" where {self.where}" if self.where else "")

    def spark(self, samples: Tables) -> DataFrame:
        df = samples[self.tables[0]]
        for table, test in zip(self.tables[1:], self.on):
            df = df.join(samples[table], F.expr(test))
        if self.where:
            df = df.filter(F.expr(self.where))
        return df.selectExpr(*[f"{e} as `{n}`" for n, e in self.columns.items()])


def _money(column: str) -> str:
    return f"cast({column} as decimal(18,2))"


def _text(expression: str) -> str:
    return f"cast({expression} as string)"


def _json(**fields: str) -> str:
    """JSON text from SQL text expressions."""
    return "'{' || " + " || ', ' || ".join(f"""'"{k}": "' || {v} || '"'""" for k, v in fields.items()) + " || '}'"


ORDERS = ("orders", "customer")
ORDERS_ON = ("o_custkey = c_custkey",)
EVENTS = ("events", "customer")
EVENTS_ON = ("user_id = c_custkey",)
LINES = ("lineitem", "orders", "customer")
LINES_ON = ("l_orderkey = o_orderkey", "o_custkey = c_custkey")

ACCOUNT = _text("o_custkey")
USER = _text("user_id")
# 45 payers; every 50th order has none
PAYER = "case when o_orderkey % 50 = 0 then null else o_orderpriority || ' plan ' || " + _text("o_orderkey % 9") + " end"
STAGE = (
    "case when o_orderkey % 97 = 0 then null when o_orderstatus = 'F' then 'B' "
    "when o_orderstatus = 'O' then case when o_orderkey % 5 = 0 then 'X' else 'PB' end "
    "else case when o_orderkey % 4 = 0 then 'E' else 'W' end end"
)
# no key, empty text or a number
FAX = (
    "case when o_orderkey % 10 = 1 then '' when o_orderkey % 3 = 0 then ', \"send_fax_number\": \"\"' "
    "else ', \"send_fax_number\": \"555-' || " + _text("o_orderkey") + " || '\"' end"
)
PRE_CONTENT = (
    "'{\"cms_10_place\": \"S' || " + _text("o_orderkey % 4") + " || '\", \"cms_7_insured_state\": \"S' || "
    + _text("o_custkey % 4") + " || '\", \"edi_payer_id\": \"E' || " + _text("case when o_orderkey % 9 = 4 then o_orderkey % 18 else o_orderkey % 9 end")
    + " || '\", \"claim_type\": \"' || c_mktsegment || '\", \"vx_carrier_lob\": \"L' || " + _text("o_orderkey % 3")
    + " || '\", \"work_comp_flag\": \"' || case when o_orderkey % 3 = 0 then 'Y' when o_orderkey % 3 = 1 then 'N' else '' end || '\"' || "
    + FAX + " || '}'"
)
RESPONSE_CODE = (
    "case event_type when 'error' then '277-F4' when 'signup' then '277-P1' when 'view' then '835-B13' "
    "when 'click' then '835-N650' else '835-PAY' end"
)
EVENT_AMOUNT = _text(_money("value"))
RESPONSE_NOTE = (
    "case event_type when 'error' then case event_id % 4 when 0 then 'reject a7:35 id ' || " + USER
    + " when 1 then 'A7:97 late' when 2 then 'missing Claim Number' else 'other' end "
    "when 'signup' then 'pending' when 'view' then 'has cas CODE ' || " + _text("event_id % 5")
    + " when 'click' then case when event_id % 2 = 0 then 'incomplete/invalid documentation' "
    "else repeat('long note ', 11) || " + _text("event_id % 3") + " end "
    "else case when event_id % 3 = 0 then 'Payment of $' || " + EVENT_AMOUNT + " || ', check # ' || " + _text("event_id")
    + " when event_id % 3 = 1 then 'payment of $' || " + EVENT_AMOUNT + " || ' by transfer' else '' end end"
)
# days, so that several responses of an account share the latest one
RESPONSE_DAY = "cast(date_trunc('day', ts) as timestamp)"
NAMES_JSON = dict(
    facility_state="case when o_orderkey % 3 = 0 then '' else 'S' || " + _text("o_custkey % 4") + " end",
    servicing_provider_location_state="'P' || " + _text("o_custkey % 3"),
    patient_lastname="'Last' || " + _text("o_custkey % 13"),
    patient_firstname="'First' || " + _text("o_custkey % 7"),
    patient_addr1="case o_custkey % 5 when 0 then 'Po Box ' || " + ACCOUNT + " when 1 then 'unknown' when 2 then '' else "
    + ACCOUNT + " || ' Main St' end",
    patient_city="'City' || " + _text("o_custkey % 11"),
    patient_phone="case o_custkey % 6 when 0 then '' when 1 then '(555) 555-5555' when 2 then '(012) 345-6789' "
    "when 3 then '212-045-' || " + ACCOUNT + " else '(212) 345-' || " + _text("1000 + o_custkey % 9000") + " end",
    patient_ssn="case o_custkey % 7 when 0 then '900123456' when 1 then '666123456' when 2 then '123004567' "
    "when 3 then '123450000' when 4 then '' else '12345' || " + _text("1000 + o_custkey % 9000") + " end",
    patient_dob="'19' || " + _text("60 + o_custkey % 40") + " || '-03-15'",
    patient_gender="case o_custkey % 5 when 0 then 'F' when 1 then 'M' else case when o_orderkey % 2 = 0 then 'F' else 'M' end end",
)
# the state key is missing for some accounts
RAW_CONTENT = (
    "case when o_custkey % 10 = 0 then " + _json(**NAMES_JSON) + " else "
    + _json(**NAMES_JSON, patient_state="'S' || " + _text("o_custkey % 4")) + " end"
)
CLAIM_CONTENT = _json(
    accident_state="'S' || " + _text("o_orderkey % 4"),
    facility="'Facility ' || " + _text("o_orderkey % 6"),
    service_date="case o_orderkey % 3 when 0 then '' when 1 then '1997-02-' || " + _text("10 + o_orderkey % 18")
    + " else '199803' || " + _text("10 + o_orderkey % 18") + " end",
    patient_phone="case when o_custkey % 12 = 0 then '(313) 999-' || " + _text("1000 + o_custkey % 9000") + " else '' end",
    patient_ssn="case when o_custkey % 14 = 4 then '98765' || " + _text("1000 + o_custkey % 9000") + " else '' end",
)
BILL_DATES = ("case event_id % 5 when 0 then '/  /' when 1 then '' when 2 then '2024-01-' || " + _text("10 + event_id % 18")
    + " when 3 then '202401' || " + _text("10 + event_id % 18") + " else null end")
EVENT_JSON = dict(
    patient_dob="case event_id % 4 when 0 then '' when 1 then '19800101' else '1975-06-' || " + _text("10 + event_id % 20") + " end",
    patient_ssn="case event_id % 3 when 0 then '' else " + _text("event_id") + " end",
    LX01_service_date="case event_id % 2 when 0 then '2023-12-31' else '' end",
)


def _bill(**more: str) -> dict[str, str]:
    return {
        "created_at": "ts",
        # some customers are not known
        "cust_id": "case when event_id % 5 = 0 then cast(user_id % 30 as int) else c_nationkey end",
        "pat_acct": "case when event_id % 4 = 0 then 'N-' || " + USER + " else " + USER + " end",
        "admit_date_or_service_date": BILL_DATES,
        "discharge_date": "case event_id % 3 when 0 then '/  /' when 1 then '' else '2024-02-01' end",
        "notes": "case event_id % 4 when 0 then 'held by agy, see file' when 1 then 'no, address' when 2 then '' else null end",
        "processed": "case event_id % 3 when 0 then true when 1 then false else null end",
        "processed_at": "case event_id % 3 when 0 then ts else null end",
        "orig_file_name": "'file_' || " + _text("event_id % 8") + " || '.txt'",
        **more,
    }


def _payments(where: str) -> View:
    return View(
        LINES,
        LINES_ON,
        {
            "pat_acct": ACCOUNT,
            "insurance_name": PAYER,
            "payment": _money("l_extendedprice"),
            "payment_date": "cast(l_shipdate as date)",
            "payment_post_date": "cast(l_shipdate as date) + cast(l_linenumber as int)",
            "duplicate_payment": "l_linenumber >= 5",
            "not_billed": "l_linestatus = 'O'",
        },
        where,
    )


VIEWS: dict[str, View] = {
    "pre_billing": View(
        ORDERS,
        ORDERS_ON,
        {
            "pm_sk": "1000000 + o_orderkey",
            "src_sk": "o_orderkey % 7",
            "cust_id": "c_nationkey",
            "pat_acct": ACCOUNT,
            "insurance_name": PAYER,
            "status": STAGE,
            "charges": _money("o_totalprice"),
            "claim_type": "c_mktsegment",
            "claim_num": "'CN' || " + _text("o_orderkey % 400"),
            "created_at": "o_orderdate",
            "content": PRE_CONTENT,
        },
    ),
    "billing": View(
        LINES,
        LINES_ON,
        {
            "pm_sk": "1000000 + l_orderkey",
            "cust_id": "c_nationkey",
            "pat_acct": ACCOUNT,
            "insurance_name": PAYER,
            "claim_type": "c_mktsegment",
            "accident_state": "'S' || " + _text("o_orderkey % 4"),
            "patient_state": "'S' || " + _text("o_custkey % 4"),
            "fdos": "cast(o_orderdate as date)",
            "ldos": "case when l_linenumber = 1 then null else cast(o_orderdate as date) + cast(l_linenumber as int) end",
            "accident_date": "cast(o_orderdate as date) - cast(o_orderkey % 40 as int)",
            "bill_sent_at": "l_shipdate",
            "created_at": "l_shipdate",
            "sending_method": "l_returnflag",
            "vendor": "l_linestatus",
            "claim_num": "'CN' || " + _text("l_linenumber"),
            "patient_name": "c_name",
            "policy_number": "'P' || " + _text("l_suppkey"),
            "charges": _money("l_extendedprice"),
        },
    ),
    "claim_responses": View(
        EVENTS,
        EVENTS_ON,
        {
            "pm_sk": "1000000 + event_id",
            "cust_id": "c_nationkey",
            "pat_acct": USER,
            "code": RESPONSE_CODE,
            "note": RESPONSE_NOTE,
            "created_at": RESPONSE_DAY,
            "response_from": "case when event_id % 6 = 0 then null else 'SRC' || " + _text("event_id % 6") + " end",
        },
    ),
    "client_raw_bills": View(
        ORDERS,
        ORDERS_ON,
        {
            "cust_id": "c_nationkey",
            "pat_acct": ACCOUNT,
            "total_charges": _money("o_totalprice"),
            "admission_date": "cast(o_orderdate as date) - cast(o_orderkey % 20 as int)",
            "discharge_date": "case when o_orderkey % 3 = 0 then null else cast(o_orderdate as date) - cast(o_orderkey % 11 as int) end",
            "principal_diagnosis": "case o_custkey % 4 when 0 then '' when 1 then '1' when 2 then case when o_orderkey % 2 = 0 then '' else 'S13' end else 'M54' end",
            "created_at": "o_orderdate",
            "content": RAW_CONTENT,
            "claim_content": CLAIM_CONTENT,
        },
    ),
    "raw_bills": View(
        ("lineitem",),
        (),
        {
            "pat_acct": _text("l_partkey + 300"),
            "gross_charges": _money("l_extendedprice"),
            "admit_date_or_service_date": "cast(l_shipdate as date) - 9",
            "discharge_date": "case when l_linenumber = 2 then null else cast(l_shipdate as date) - 2 end",
            "created_at": "l_shipdate",
            "content": _json(
                primary_diagnostic_code="case l_partkey % 3 when 0 then '7' when 1 then 'K20' else '' end",
                patient_dob="case l_partkey % 3 when 0 then '' else '1981-05-06' end",
                patient_gender="case l_partkey % 2 when 0 then 'F' else '' end",
            ),
        },
    ),
    "pending_bills": View(
        EVENTS,
        EVENTS_ON,
        _bill(
            content=_json(
                **EVENT_JSON,
                patient_firstname="case event_id % 2 when 0 then '' else 'Ann' end",
                patient_first_name="'Bea'",
                patient_last_name="'Smith'",
                admit_date_or_service_date="case event_id % 2 when 0 then '' else '2024-01-05' end",
                holding_info="case event_id % 8 when 0 then '' else 'hold, wait' end",
                ml_reason="'zip, missing'",
            )
        ),
        "event_type not in ('error', 'signup')",
    ),
    "rejected_bills": View(
        EVENTS,
        EVENTS_ON,
        _bill(
            patient_firstname="case event_id % 2 when 0 then '' else 'Cyn' end",
            patient_lastname="case event_id % 3 when 0 then null else 'Jones' end",
            content=_json(
                **EVENT_JSON,
                patient_firstname="'Dee'",
                patient_lastname="'Brown'",
                admission_date="case event_id % 2 when 0 then '' else '20240107' end",
                reject_info="'no policy, resend'",
            ),
        ),
        "event_type in ('error', 'signup')",
    ),
    "customers": View(
        ("nation", "region"),
        ("n_regionkey = r_regionkey",),
        {
            "master_id": "n_regionkey",
            "cust_id": "n_nationkey",
            "cust_name": "lower(n_name) || '-care o''neil josé MUÑOZ-ärzte GROUP'",
            "cust_type": "r_name",
        },
    ),
    "account_statuses": View(("events",), (), {"pat_acct": USER, "status": "upper(event_type)"}),
    "patient_accounts": View(
        ORDERS,
        ORDERS_ON,
        {
            "cust_id": "c_nationkey",
            # accounts of one segment have no bills
            "pat_acct": "case when c_mktsegment = 'BUILDING' then 'X-' || " + ACCOUNT + " else " + ACCOUNT + " end",
            "status_code": "case o_orderpriority when '1-URGENT' then 'AGYREQ00' when '2-HIGH' then 'AGYACK00' "
            "when '3-MEDIUM' then 'AGYRLS01' when '4-NOT SPECIFIED' then null else 'LOC01' end",
            "status_date": "cast(date_trunc('month', o_orderdate) as date)",
        },
    ),
    "status_codes": View(
        ("region",),
        (),
        {
            "status_code": "case r_regionkey when 0 then 'AGYREQ00' else 'LOC0' || " + _text("r_regionkey") + " end",
            "status_desc": "'Local ' || lower(r_name)",
            "default_x12_code": "case r_regionkey when 2 then null else 'X' || " + _text("r_regionkey") + " end",
            "usage": "'local use'",
        },
    ),
    "payments_a": _payments("l_returnflag = 'A'"),
    "payments_b": _payments("l_returnflag <> 'A'"),
    "transactions": View(
        LINES,
        LINES_ON,
        {
            "cust_id": "c_nationkey",
            "pat_acct": ACCOUNT,
            "charges": _money("o_totalprice"),
            "trans_amt": _money("l_extendedprice"),
            "trans_date": "cast(l_shipdate as date)",
            "trans_id": _text("l_orderkey") + " || '-' || " + _text("l_linenumber"),
            "insurance_name": PAYER,
            "created_at": "l_shipdate",
            "duplicate_payment": "l_linenumber >= 5",
        },
    ),
    # files
    "remittances": View(
        LINES,
        LINES_ON,
        {
            "cust_id": "c_nationkey",
            # most remitted accounts have no transaction
            "pat_acct": "case when l_returnflag = 'R' then " + ACCOUNT + " else 'R-' || " + ACCOUNT + " end",
            "insurance_name": PAYER,
            "charges": _money("o_totalprice"),
            "remit_paymt": "case when l_linenumber = 7 then null else " + _money("l_extendedprice") + " end",
            "paymt_date": "cast(year(l_shipdate) * 10000 + month(l_shipdate) * 100 + day(l_shipdate) as int)",
            "claim_adj_seg": "case when l_linenumber = 3 then null else 'CO' || " + _text("l_linenumber") + " end",
            "remit_check_num": "'C' || " + _text("l_suppkey"),
        },
    ),
    # 15 ids, greatest column value per id; columns are named like states
    "payer_list": View(
        ("part",),
        (),
        {
            "Payer ID": "'E' || " + _text("p_size % 15"),
            "Payer Name": "p_name",
            "WC": "case when p_size % 2 = 0 then 'Y' else 'N' end",
            "S0": "substr(p_brand, 1, 5)",
            "S1": "substr(p_type, 1, 3)",
            "S2": "cast(null as string)",
        },
    ),
    "alert_seed": View(
        ("events",),
        (),
        {
            "created_at": "ts",
            "pm_sk": "1000000 + event_id",
            "src_sk": "event_id % 7",
            "pat_acct": USER,
            "note": "'N' || " + _text("event_id % 40"),
            "code": "'277-' || upper(substr(event_type, 1, 2))",
            "cust_id": "cast(user_id % 25 as int)",
            "claim_num": "case when event_id % 3 = 0 then null else 'CN' || " + _text("event_id % 50") + " end",
            "charges": "case when event_id % 9 = 0 then null else cast(value as decimal(18,2)) * 100 end",
            "patient_name": "'Pat ' || " + USER,
            "policy_number": "'P' || " + _text("event_id % 70"),
            "insurance_name": "'Payer ' || " + _text("event_id % 12"),
            "effective_date": "case when event_id % 7 = 0 then null else cast(ts as date) - cast(event_id % 400 as int) * 22 end",
            "assigned": "case event_id % 3 when 0 then 'Team North' when 1 then 'team NORTH east' else 'Team South' end",
            "processed": "case event_id % 7 when 0 then null when 1 then true else false end",
            "processed_at": "case when event_id % 7 = 1 then cast(ts as date) else null end",
            "claim_type": "'T' || " + _text("event_id % 4"),
            "vx_carrier_lob": "cast(null as string)",
            "work_comp_flag": "case event_id % 3 when 0 then 'Y' when 1 then 'N' else null end",
        },
    ),
    # lines of key-list files
    "key_lines": View(
        ("orders",),
        (),
        {
            "line": "case o_orderkey % 7 when 0 then " + _text("1000000 + o_orderkey") + " when 1 then " + _text("1000000 + o_orderkey")
            + " || '  ' when 2 then " + _text("1000000 + o_orderkey") + " || ' done' when 3 then 'see ' || " + _text("1000000 + o_orderkey")
            + " when 4 then " + _text("1000000 + o_orderkey") + " || '1' when 5 then '   ' else "
            + _text("1000000 + o_orderkey - o_orderkey % 100") + " end",
        },
        "o_orderstatus <> 'F'",
    ),
    # text that is hard on CSV files
    "awkward_notes": View(
        ORDERS,
        ORDERS_ON,
        {
            "id": "o_orderkey",
            "note": "case o_orderkey % 7 when 0 then null when 1 then 'say \"hi\", ' || c_name when 2 then '\"' || c_name || '\"' "
            "when 3 then 'one' || chr(10) || c_name when 4 then 'one' || chr(13) || chr(10) || 'two' when 5 then '  padded, ' || c_name || ' ' "
            "else c_name end",
            "charges": _money("o_totalprice"),
            "day": "cast(o_orderdate as date)",
            "other": "case when o_orderkey % 2 = 0 then '' else c_mktsegment end",
        },
    ),
    # alert text, one row per line: a file per day, a heading per hour, then its detail lines
    "alert_details": View(
        ("events",),
        (),
        {
            "file": "'drop/alerts_' || replace(cast(cast(ts as date) as string), '-', '') || '.txt'",
            "block": "cast(floor(hour(ts) / 6) as int)",
            "pos": "2 * event_id + 1",
            "event_id": "event_id",
            "team": "'Team ' || event_type",
            "line": "' ' || " + _text("1000000 + event_id") + " || ', ' || " + _text("event_id % 7") + " || ', ' || "
            "case when event_id % 5 = 0 then 'A-' else '' end || " + USER
            + " || ' - ' || case when event_id % 11 = 0 then 'no code here' when event_id % 2 = 0 "
            "then 'F' || " + _text("event_id % 4") + " || ' > pay-ment  >  note ' || " + _text("event_id % 40")
            + " else 'P1 > pending' end",
        },
    ),
}


SAMPLES = ("region", "nation", "customer", "part", "orders", "lineitem", "events")


_schemas: dict[str, T.StructType] = {}


def _sample(spark: SparkSession, path: str) -> DataFrame:
    """A sample table; its footer is looked at once per process."""
    if path not in _schemas:
        _schemas[path] = spark.read.parquet(path).schema
    return spark.read.schema(_schemas[path]).parquet(path)


def tables(spark: SparkSession, sf_dir: str) -> Tables:
    """The claim tables over the sample tables."""
    tune(spark)
    samples = Tables({n: (lambda n=n: _sample(spark, f"{sf_dir}/{n}.parquet")) for n in SAMPLES})
    return Tables({name: (lambda v=view: v.spark(samples)) for name, view in VIEWS.items()})
