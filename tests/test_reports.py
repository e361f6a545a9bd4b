import datetime as dt

from helpers import day, dicts, rows

from claimlens.plans.aging import match_aging, match_aging_accounts, match_aging_matches
from claimlens.plans.backlog import pending_rejected
from claimlens.plans.consolidated import consolidated_claims
from claimlens.plans.opportunity import account_opportunity, payer_opportunity, payer_opportunity_items
from claimlens.plans.quality import account_quality, active_customers, data_quality, known_customers
from claimlens.plans.reconcile import reconcile_transactions
from claimlens.plans.summaries import prebill_summary, status_summary
from claimlens.plans.traits import account_traits, claim_response_traits
from claimlens.plans.workbooks import daily_sheets, report_chart

AS_OF = day("2024-02-01")


def pre(n, payer, acct, status, charges=100, cust=7, fax="", created="2024-01-10T00:00:00", **content):
    import json

    doc = {**({} if fax is None else {"send_fax_number": fax}), **content}
    return {
        "pm_sk": n,
        "src_sk": n % 2,
        "insurance_name": payer,
        "pat_acct": acct,
        "status": status,
        "charges": charges,
        "cust_id": cust,
        "created_at": created,
        "content": json.dumps(doc),
    }


def pay(acct, payer, amount, not_billed=True, duplicate=False, date="2024-01-05"):
    return {
        "pat_acct": acct,
        "insurance_name": payer,
        "payment": amount,
        "payment_date": date,
        "payment_post_date": date,
        "duplicate_payment": duplicate,
        "not_billed": not_billed,
    }


def claims(make):
    return make(
        pre_billing=[
            pre(1, "P1", "a1", "B", cms_10_place="TX", cms_7_insured_state="TX"),
            pre(2, "P1", "a1", "PB", 300, cms_10_place="NY", cms_7_insured_state="TX"),
            pre(3, "P1", "a2", "W", 101, fax="555"),
            pre(4, "P2", "a2", "B"),
            pre(5, None, "a3", "W", 50),
            pre(6, "P3", "a4", "PB", 40, cust=8, fax=None),
            pre(7, "P1", "a1", None),
            pre(8, "P4", "a5", "W", 10, cust=9),
        ],
        account_statuses=[
            {"pat_acct": "a1", "status": "S2"},
            {"pat_acct": "a1", "status": "S1"},
            {"pat_acct": "a3", "status": "S3"},
        ],
        patient_accounts=[
            {"pat_acct": "a2", "status_code": "AGYACK00"},
            {"pat_acct": "a3", "status_code": None},
            {"pat_acct": "a3", "status_code": "AGYREQ00"},
        ],
        status_codes=[{"status_code": "AGYACK00", "status_desc": "own text", "default_x12_code": "x", "usage": "u"}],
        payments_a=[
            pay("a1", "Z", 10.4),
            pay("a1", "A", 10.2),
            pay("a1", "D", 99, duplicate=True),
            pay("a2", "A", 5),
            pay("a1", "A", 7, not_billed=False, date="2024-01-02"),
        ],
        payments_b=[pay("a1", "B", 3), pay("a2", "A", 5), pay("a1", "A", 7, not_billed=False, date="2024-01-20")],
        client_raw_bills=[{"pat_acct": "a1", "cust_id": 7, "created_at": "2024-01-01T10:00:00"}],
        billing=[{"pat_acct": "a1", "cust_id": 7, "pm_sk": 1, "bill_sent_at": "2024-01-10T00:00:00"}],
        customers=[{"master_id": 70, "cust_id": 7}, {"master_id": 80, "cust_id": 8}],
    )


def test_status_summary(make):
    t = claims(make)
    got = {(r["pat_acct_status"], r["description"]): r for r in dicts(status_summary(t))}
    counts = {k: (r["pre_billing_record"], r["distinct_insurance_name"]) for k, r in got.items()}
    # a3 has two patient-account rows and counts twice; a2 finds two dictionary texts
    assert counts == {
        ("S1;  S2", None): (3, 1),
        ("AGYACK00", "Agency acknowledges receipt of account, placement successful"): (2, 2),
        ("AGYACK00", "own text"): (2, 2),
        ("S3", None): (1, 0),
        ("AGYREQ00", "Agency request for account placement"): (1, 0),
        (None, None): (2, 2),
    }
    by_account = {r["pat_acct_status"]: r["distinct_pat_acct"] for r in dicts(status_summary(t, "account", "not_billed"))}
    assert by_account == {"S1;  S2": 1, "AGYACK00": 1, "S3": 1, "AGYREQ00": 1, None: 2}


def test_prebill_summary(make):
    t = claims(make)
    got = {r["pre_billing_record_status"]: r for r in dicts(prebill_summary(t))}
    assert {k: r["not_billed_record"] for k, r in got.items()} == {"B": 2, "PB": 2, "W": 3, None: 1}
    assert got["B"]["description"] == got[None]["description"] == "Billed"
    assert got["PB"]["description"] == "Pre-Bill: Ready to bill"
    faxless = {r["pre_billing_record_status"]: r["not_billed_record"] for r in dicts(prebill_summary(t, scope="no_fax", excluded_customers=[9]))}
    assert faxless == {"PB": 2, "W": 1}


def test_payer_opportunity_all(make):
    got = {r["insurance_name"]: r for r in dicts(payer_opportunity(claims(make), "all"))}
    one = got["P1"]
    assert (one["pre_billing_record"], one["billed_record"], one["not_billed_record"]) == (4, 1, 2)
    assert (one["pct_not_billed_record"], one["not_billed_avg_record_charge"]) == (0.5, 201.0)
    # a1: 21 and 3 from two tables, a2: 5 once as both tables give the same row
    assert one["not_billed_tot_acct_payment"] == 29.0
    assert one["not_billed_tot_acct_payer"] == "A;   A;   Z;   B"
    assert one["pat_acct_status"] == "AGYACK00;  S1;  S2"
    assert one["pre_billing_record_status"] == "B; PB; W"
    two = got["P2"]
    assert (two["pct_not_billed_record"], two["not_billed_avg_record_charge"], two["pat_acct_status"]) == (0.0, None, "AGYACK00")
    assert (got[None]["not_billed_record"], got[None]["not_billed_avg_record_charge"], got[None]["pat_acct_status"]) == (1, None, None)


def test_payer_opportunity_not_billed(make):
    got = {r["insurance_name"]: r for r in dicts(payer_opportunity(claims(make), "not_billed"))}
    assert set(got) == {"P1", "P3", "P4", None}
    assert (got["P1"]["pat_acct"], got["P1"]["cust_id"], got["P1"]["assigned_record_at"]) == ("a1;  a2", "7", "2024-01-10")
    assert got["P1"]["not_billed_tot_acct_payer"] == "A;   A;   Z;   B"
    assert (got[None]["pre_billing_record"], got[None]["pat_acct"], got[None]["pct_not_billed_record"]) == (None, "a3", None)


def test_payer_opportunity_no_fax(make):
    got = {r["insurance_name"]: r for r in dicts(payer_opportunity(claims(make), "no_fax", [9]))}
    assert set(got) == {"P1", "P3", None}  # P4 has excluded customers only
    one = got["P1"]
    assert (one["pre_billing_record"], one["not_billed_record"], one["no_fax"]) == (4, 2, 1)
    assert (one["pct_no_fax_record_not_billed"], one["no_fax_avg_record_charge"], one["pat_acct"]) == (0.5, 300.0, "a1")


def test_lists_are_whole_in_the_report_and_the_items(make):
    t = claims(make)
    cells = {r["insurance_name"]: r["pat_acct"] for r in dicts(payer_opportunity(t, "not_billed"))}
    assert cells == {"P1": "a1;  a2", "P3": "a4", "P4": "a5", None: "a3"}
    items = {(r["insurance_name"], r["item"]) for r in dicts(payer_opportunity_items(t, "not_billed")) if r["list_name"] == "pat_acct"}
    assert items == {("P1", "a1"), ("P1", "a2"), ("P3", "a4"), ("P4", "a5"), (None, "a3")}


def test_account_opportunity(make):
    t = claims(make)
    report = dicts(account_opportunity(t, "all", AS_OF))
    ones = [r for r in report if r["pat_acct"] == "a1"]
    assert len(ones) == 4  # two payment results times two date results
    assert {(r["not_billed_acct_payment"], r["not_billed_acct_payer"]) for r in ones} == {(21.0, "A;    Z"), (3.0, "B")}
    assert {(str(r["payment_date"]), r["paid_then_billed"]) for r in ones} == {("2024-01-02", "Y"), ("2024-01-20", "N")}
    one = ones[0]
    assert (one["master_id"], one["placed_days"], one["pat_acct_status"]) == (70, 31, "S1;  S2")
    assert (one["accident_state"], one["insured_state"], one["insured_eq_accident_state"]) == ("NYTX", "TX", "N")
    assert (one["not_billed_acct_charge"], one["not_billed_insurance"]) == (300.0, "P1")
    single = dicts(account_opportunity(t, "all", AS_OF, one_row_per_account=True))
    assert sorted(r["pat_acct"] for r in single) == ["a1", "a2", "a3", "a4", "a5"]
    merged = {r["pat_acct"]: r for r in single}
    assert (merged["a1"]["not_billed_acct_payment"], merged["a1"]["not_billed_acct_payer"]) == (24.0, "A;    B;    Z")
    assert (merged["a2"]["not_billed_acct_payment"], str(merged["a1"]["payment_date"])) == (10.0, "2024-01-02")
    narrow = {r["pat_acct"]: r for r in dicts(account_opportunity(t, "not_billed", AS_OF, True))}
    assert (narrow["a1"]["accident_state"], narrow["a1"]["pre_billing_record_status"]) == ("NY", "PB")
    assert narrow["a3"]["pat_acct_status"] == "AGYREQ00;  S3"
    pcts = [r["pct_not_billed_record"] for r in report]
    assert pcts == sorted(pcts, reverse=True)


def test_daily_sheets_and_chart(make):
    t = claims(make)
    assert len(daily_sheets(t, "all", AS_OF)) == 6 and len(daily_sheets(t, "no_fax", AS_OF)) == 3
    report = account_opportunity(t, "not_billed", AS_OF, True)
    points = rows(report_chart(report, "aging_of_account_charge"))
    assert (31, 300.0) in points and len(points) == report.count()


def test_account_traits(make):
    def raw(acct, gender, diagnosis, born, charge=10.5):
        return {
            "pat_acct": acct,
            "total_charges": charge,
            "admission_date": "2024-01-02",
            "discharge_date": None,
            "principal_diagnosis": diagnosis,
            "created_at": "2024-01-10T00:00:00",
            "content": f'{{"patient_gender": {gender}, "patient_dob": "{born}"}}',
        }

    t = make(
        client_raw_bills=[
            raw("both", '"F"', "", "1990-01-01"),
            raw("both", '"M"', "S13", "1990-01-01", 12.4),
            raw("first", '"M"', "M54", "2023-12-30"),
            raw("first", "null", "1", "2023-12-30"),
        ],
        raw_bills=[
            {
                "pat_acct": a,
                "gross_charges": 99,
                "admit_date_or_service_date": "2024-01-02",
                "discharge_date": "2024-01-04",
                "created_at": "2024-01-10T00:00:00",
                "content": '{"primary_diagnostic_code": "K2", "patient_dob": "", "patient_gender": "F"}',
            }
            for a in ("both", "second")
        ],
    )
    got = {r["pat_acct"]: tuple(r.values())[1:] for r in dicts(account_traits(t))}
    assert got == {
        # two genders and an empty first diagnosis say nothing, so the older table is used
        "both": (12, 8, "K", "34", "F"),
        "first": (11, 8, None, None, "M"),
        "second": (99, 6, "K", None, "F"),
    }


def test_claim_response_traits(make):
    def response(n, acct, code, note, at, source=None):
        return {"pm_sk": n, "cust_id": 7, "pat_acct": acct, "code": code, "note": note, "created_at": at, "response_from": source}

    t = make(
        claim_responses=[
            response(1, "a", "277-P1", "pending", "2024-01-01T00:00:00"),
            response(1, "a", "277-F4", "says a7:35 here", "2024-01-05T00:00:00"),
            response(1, "a", "277-P1", "pending", "2024-01-05T00:00:00"),
            response(1, "a", "277-P1", "pending now", "2024-01-06T00:00:00"),
            response(2, "b", "277-P1", "pending", "2024-01-05T00:00:00", "SKIP"),
            response(9, "c", "277-P1", "pending", "2024-01-05T00:00:00"),
        ],
        pre_billing=[pre(1, "P1", "a", "B", edi_payer_id="E1"), pre(2, "P1", "b", "B", edi_payer_id="E2")],
        customers=[{"master_id": 70, "cust_id": 7, "cust_name": "c"}],
        billing=[
            {"pm_sk": 1, "claim_type": "T", "accident_state": "TX", "patient_state": "NY", "ldos": "2024-01-03", "accident_date": "2024-01-01"},
            {"pm_sk": 1, "accident_state": "AL", "patient_state": "TX", "fdos": "2024-01-04"},
        ],
    )
    got = dicts(claim_response_traits(t, AS_OF, "SKIP"))
    kept = [r for r in got if r["pm_sk"] is not None]
    assert sorted(r["user_note"] for r in kept) == ["pending", "says a7:35 here"]
    assert len(got) == 3  # the response without a payer leaves an empty row
    r = kept[0]
    assert (r["master_id"], r["days_frm_response"], r["edi_payer_id"]) == (70, 27, "E1;  E2")
    assert (r["pat_eq_accident_state"], r["accident_state"], r["days_accident_to_dos"]) == (1, "TX", 3)


def test_reconcile(spark, make):
    def trans(acct, amount, date, duplicate=False, payer="P"):
        return {"cust_id": 7, "pat_acct": acct, "charges": 50, "trans_amt": amount, "trans_date": date, "insurance_name": payer, "duplicate_payment": duplicate}

    t = make(
        transactions=[
            trans("equal", 2, "2024-01-05"),
            trans("below", 1, "2024-01-04"),
            trans("many", 1000, "2024-01-01"),
            trans("many", 1000, "2024-01-09"),
            trans("dup", 5, "2024-01-09", True),
        ]
    )
    remit = spark.createDataFrame(
        [(7, a, p, 2.5, paid, 20240105, seg, chk) for a, p, paid, seg, chk in [
            ("equal", "R1", 2.5, "s", "c1"),
            ("below", "R1", 3.5, None, "c2"),
            ("many", "R2", 1.0, "s2", "c1"),
            ("many", "R1", 1.0, "s1", "c1"),
            ("dup", "R1", 1.0, "s", "c"),
            (None, "R1", 1.0, "s", "c"),
        ]],
        "cust_id int, pat_acct string, insurance_name string, charges double, remit_paymt double, paymt_date int, claim_adj_seg string, remit_check_num string",
    )
    report = dicts(reconcile_transactions(t, remit, [7], "Seven"))
    assert [r["pat_acct"] for r in report] == ["many", "equal", "dup", "below"]
    got = {r["pat_acct"]: r for r in report}
    flags = {k: (r["exist_paymt"], r["exist_suffic_paymt"], r["trans_after_response"]) for k, r in got.items()}
    # 2.5 and 3.5 round half to even: 2 and 4
    assert flags == {"equal": ("Y", "Y", "Y"), "below": ("Y", "N", "N"), "many": ("Y", "Y", "Y"), "dup": ("N", "N", "N")}
    assert (got["equal"]["remit_paymt"], got["below"]["remit_paymt"], got["below"]["claim_adj_seg"]) == (2.0, 4.0, None)
    many = got["many"]
    assert (many["paymt_cnt"], many["claim_adj_seg"], many["remit_check_num"], many["remit_carrier"]) == (2, "s1;  s2", "c1", "R1;  R2")
    assert many["trans_carrier"] == "P -- $   1,000;  P -- $   1,000"
    assert many["cust_name"] == "Seven"


def test_backlog(make):
    bill = {"cust_id": 7, "created_at": "2024-01-02T05:00:00"}
    t = make(
        rejected_bills=[
            {**bill, "pat_acct": "r1", "patient_firstname": "", "admit_date_or_service_date": "/  /", "discharge_date": "", "processed": True,
             "processed_at": "2024-01-03T00:00:00", "notes": "ask agy", "orig_file_name": "f",
             "content": '{"patient_firstname": "Ann", "patient_ssn": "123", "patient_dob": "19900102", "LX01_service_date": "2023-12-01", "reject_info": "zip, state"}'},
            {**bill, "pat_acct": "known", "content": "{}"},
            {**bill, "pat_acct": "r1", "cust_id": 3, "content": "{}"},
        ],
        pending_bills=[
            {**bill, "pat_acct": "p1", "admit_date_or_service_date": "20240101", "notes": "a, b",
             "content": '{"patient_first_name": "Bo", "patient_ssn": ""}'},
            {**bill, "pat_acct": "p2", "cust_id": 8, "content": "{}", "notes": ""},
        ],
        client_raw_bills=[{"cust_id": 7, "pat_acct": "known"}] * 3,
        customers=[{"cust_id": 7, "cust_name": "st. mary-ann o'neil"}],
    )
    report = dicts(pending_rejected(t, [3]))
    assert [r["pat_acct"] for r in report] == ['"p1"', '"r1"', '"p2"']
    r1, p1 = report[1], report[0]
    assert (r1["cust_name"], r1["pat_firstname"], r1["pat_dob"], r1["pat_ssn"]) == ("St. Mary-Ann O'Neil", "Ann", "dob 1990-01-02", 'ssn "000000123"')
    assert (r1["approx_dos"], r1["user_note"], r1["processed"], r1["processed_at"]) == ("dos 2023-12-01", "zip; state", "processed Y", "processed at 2024-01-03")
    assert (p1["pat_firstname"], p1["pat_ssn"], p1["approx_dos"], p1["user_note"], p1["processed"]) == ("Bo", None, "dos 2024-01-01", "a; b", "processed N")
    assert dicts(pending_rejected(t, [3], quotes=False))[1]["pat_ssn"] == "ssn 000000123"


def test_consolidated(make):
    def note(text, at, acct="a"):
        return {"cust_id": 7, "pat_acct": acct, "code": "c" + text[:1], "note": text, "created_at": at}

    long, hundred = "x" * 101, "y" * 100
    t = make(
        client_raw_bills=[
            {"cust_id": 7, "pat_acct": "a", "total_charges": 5, "admission_date": "2024-01-01",
             "claim_content": '{"accident_state": "TX", "service_date": ""}'},
            {"cust_id": 7, "pat_acct": "a", "total_charges": 6, "claim_content": '{"service_date": "20240203"}'},
            {"cust_id": 8, "pat_acct": "z"},
        ],
        patient_accounts=[
            {"cust_id": 7, "pat_acct": "a", "status_code": "A", "status_date": "2024-01-01"},
            {"cust_id": 7, "pat_acct": "a", "status_code": "B", "status_date": "2024-01-02"},
        ],
        status_codes=[{"status_code": "B", "status_desc": "d", "usage": "u"}],
        billing=[
            {"cust_id": 7, "pat_acct": "a", "bill_sent_at": "2024-01-02T00:00:00", "sending_method": "fax", "vendor": "v"},
            {"cust_id": 7, "pat_acct": "a", "bill_sent_at": "2024-01-01T00:00:00", "sending_method": "old"},
        ],
        claim_responses=[
            note("payment of $1,234.50, check # 998877", "2024-01-05T00:00:00"),
            note(long, "2024-01-05T00:00:00"),
            note(hundred, "2024-01-05T00:00:00"),
            note("payment of $9 check # 1", "2024-01-04T00:00:00"),
        ],
        transactions=[
            {"cust_id": 7, "pat_acct": "a", "trans_amt": 2.5, "trans_date": "2024-01-09", "duplicate_payment": False},
            {"cust_id": 7, "pat_acct": "a", "trans_amt": 9, "trans_date": "2024-01-19", "duplicate_payment": True},
        ],
        pre_billing=[pre(1, "P2", "a", "B"), pre(2, "P1", "a", "B"), pre(3, "P1", "a", "B")],
    )
    report = dicts(consolidated_claims(t, [7]))
    assert [str(r["date_of_service"]) for r in report] == ["2024-02-03", "2024-01-01"]
    r = report[0]
    assert (r["account_status"], r["status_description"], r["claim_submission_date"]) == ("B", "d --  -- u", "fax_OB_v")
    assert (r["check_num"], r["check_amount"], r["all_notes"], r["response_date"]) == ("998877", "1", long, "2024-01-05")
    assert r["description"] == "payment of $1,234.50, check # 998877; " + hundred
    assert (r["response_code"], r["tot_payment"], str(r["payment_date"])) == ("cp; cx; cy", 3.0, "2024-01-09")
    assert (r["acct_num_of_src"], r["insurance_name"]) == (2, "P1; P2")


def test_match_aging(make):
    received = dt.datetime(2024, 1, 1, 15)
    waits = {"w3": 3, "w4": 4, "w7": 7, "w8": 8, "w30": 30, "w31": 31, "w90": 90, "w91": 91}
    bills = [{"cust_id": 7, "pat_acct": a, "created_at": received} for a in [*waits, "none", "two"]]
    matches = [
        {"cust_id": 7, "pat_acct": a, "insurance_name": "P", "created_at": received + dt.timedelta(days=n)} for a, n in waits.items()
    ] + [
        {"cust_id": 7, "pat_acct": "two", "insurance_name": p, "created_at": received + dt.timedelta(days=n)}
        for p, n in (("Q", 1), ("P", 50), ("P", 60))
    ]
    t = make(
        client_raw_bills=[*bills, {"cust_id": 8, "pat_acct": "old", "created_at": received}],
        pre_billing=matches,
        billing=[
            {"cust_id": 7, "created_at": dt.datetime(2024, 1, 20)},
            {"cust_id": 8, "created_at": dt.datetime(2023, 1, 1)},
            {"cust_id": None, "created_at": dt.datetime(2024, 1, 20)},
        ],
    )
    got = {r["pat_acct"]: tuple(r[b] for b in ("currnt", "over_3", "over_7", "over_30", "over_90")) for r in dicts(match_aging(t, AS_OF))}
    assert got == {
        "w3": (1, 0, 0, 0, 0), "w4": (0, 1, 0, 0, 0), "w7": (0, 1, 0, 0, 0), "w8": (0, 0, 1, 0, 0), "w30": (0, 0, 1, 0, 0),
        "w31": (0, 0, 0, 1, 0), "w90": (0, 0, 0, 1, 0), "w91": (0, 0, 0, 0, 1), "none": (0, 0, 0, 0, 0), "two": (1, 0, 0, 1, 0),
    }
    two = next(r for r in dicts(match_aging(t, AS_OF)) if r["pat_acct"] == "two")
    assert (two["info_matched_payer_name"], two["tot_matches"]) == ("2024-01-02 -- Q;  2024-02-20 -- P", 2)
    (a,) = dicts(match_aging_accounts(t, AS_OF))
    # the account with matches in two buckets counts twice
    assert (a["tot_accts"], a["matched_accts"], a["unmatched_accts"], a["matched_accts_perc"]) == (10, 10, 0, 1.0)
    (m,) = dicts(match_aging_matches(t, AS_OF))
    assert (m["tot_matches"], m["over_90_matches"], m["matched_accts"], m["matches_per_acct"]) == (9, 1, 10, 0.9)
    assert rows(active_customers(t, AS_OF)) == [(7,), (None,)]
    assert rows(known_customers(t, [8])) == [(7, None)]
    empty = make()
    assert dicts(match_aging_accounts(empty, AS_OF))[0]["matched_accts_perc"] is None


def test_quality(make):
    def bill(acct, cust=7, **content):
        import json

        return {"cust_id": cust, "pat_acct": acct, "created_at": "2024-01-01T00:00:00", "content": json.dumps(content), "claim_content": '{"patient_phone": "(212) 555-1234"}'}

    t = make(
        client_raw_bills=[
            bill("good", patient_firstname="A", patient_lastname="L", patient_addr1="1 Main St", patient_city="C", patient_state="TX", patient_ssn="123456789", facility_state="", servicing_provider_location_state="NY"),
            bill("good", patient_firstname="B", patient_addr1="2 Main St"),
            bill("bad", patient_addr1="Po box 3", patient_phone="(012) 555-1234", patient_ssn="123004567"),
            bill("none", cust=8),
        ],
        pre_billing=[pre(1, "P2", "good", "B"), pre(2, "P1", "good", "B")],
        customers=[{"cust_id": 7, "master_id": 70, "cust_name": "seven", "cust_type": "x"}],
    )
    got = {r["pat_acct"]: r for r in dicts(account_quality(t))}
    good = got["good"]
    assert (good["patient_firstname"], good["patient_addr1"], good["payers_match"], good["facility_or_svc_prvd_state"]) == ("A; B", "1 Main St; 2 Main St", "P1;  P2", "NY")
    flags = {k: (r["flag_valid_addr1"], r["flag_valid_phone"], r["flag_valid_ssn"], r["eligibility_found"]) for k, r in got.items()}
    assert flags == {"good": (1, 1, 1, 1), "bad": (0, 0, 0, 0), "none": (0, 1, 0, 0)}
    assert {r["pat_acct"]: r["flag_valid_ssn"] for r in dicts(account_quality(t, strict=False))}["bad"] == 1
    report = dicts(data_quality(t, suppressed_customers=[8]))
    assert [r["cust_id"] for r in report] == [7, 8]
    seven, eight = report
    assert (seven["cnt_accts"], seven["cnt_accts_eligibility_found"], seven["hit_rate"], seven["perc_valid_firstname"]) == (2, 1, 0.5, 0.5)
    assert (seven["pct_valid_addr1"], seven["pct_valid_phone"], seven["pct_valid_ssn"], seven["master_id"]) == (0.5, 0.5, 0.5, 70)
    assert (eight["hit_rate"], eight["cnt_accts_eligibility_found"], eight["cnt_accts"]) == (None, None, 1)
    assert [r["cust_id"] for r in dicts(data_quality(t, [7]))] == [7]
