"""The original entry point on contracts in the original format."""

import datetime as dt

import pytest

from rowgate.compat import ContractValidator

AS_OF = dt.date(2025, 6, 15)
# The original format: the uniqueness key and the rules' texts are not what decides.
CONTRACT = {
    "dataset": "payments", "version": 1.0,
    "schema": [
        {"name": "record_id", "type": "string", "required": True, "unique_within_file": True},
        {"name": "event_ts", "type": "timestamp", "required": True},
        {"name": "business_date", "type": "date", "required": True},
        {"name": "source_system", "type": "string", "required": True, "allowed_values": ["CARD_PROC", "WALLET_X"]},
        {"name": "amount", "type": "decimal(18,2)", "required": True, "min_value": 0},
        {"name": "status", "type": "string", "required": True, "allowed_values": ["NEW", "SETTLED"]},
        {"name": "country_code", "type": "string", "required": True, "regex": "^[A-Z]{2}$"},
    ],
    "business_rules": [
        {"name": "settled_amount_positive", "condition": "status == 'SETTLED'", "assert": "amount > 0"},
        {"name": "event_ts_near_business_date", "assert": "abs(datediff(to_date(event_ts), business_date)) <= 7"},
        {"name": "business_date_not_far_future", "assert": "business_date <= current_date + interval 1 day"},
        {"name": "small", "assert": "amount < 5000"},
        {"name": "nonsense", "assert": "no_such_column > 1"},
    ],
}
NAMES = ["record_id", "event_ts", "business_date", "source_system", "amount", "status", "country_code", "_source_file"]
GOOD = dict(zip(NAMES, ["Q1", "2025-06-10 08:00:00", "2025-06-11", "WALLET_X", "12.75", "NEW", "CL", "one.csv"]))

CASES = {
    "good": ({}, []),
    "no id": ({"record_id": None}, ["record_id: required field is null or empty"]),
    "blank country": ({"country_code": "  "}, ["country_code: required field is null or empty", "country_code: '  ' does not match pattern ^[A-Z]{2}$"]),
    "other system": ({"source_system": "FAX"}, ["source_system: 'FAX' not in allowed_values ['CARD_PROC', 'WALLET_X']"]),
    "status in small letters": ({"status": "new"}, ["status: 'new' not in allowed_values ['NEW', 'SETTLED']"]),
    "no time": ({"event_ts": "teatime"}, ["event_ts: 'teatime' is not a valid timestamp"]),
    "no amount": ({"amount": "7 or so"}, ["amount: '7 or so' is not a valid decimal"]),
    "long country": ({"country_code": "CHL"}, ["country_code: 'CHL' does not match pattern ^[A-Z]{2}$"]),
    "below zero": ({"amount": "-0.50"}, ["amount: -0.50 is below min_value 0"]),
    "settled for nothing": ({"amount": "0", "status": "SETTLED"}, ["business_rule: settled_amount_positive - amount must be > 0 when status=SETTLED"]),
    "new for nothing": ({"amount": "0"}, []),
    "far apart": ({"event_ts": "2025-05-20 08:00:00"}, ["business_rule: event_ts_near_business_date - event_ts 2025-05-20 08:00:00 is more than 7 days from business_date 2025-06-11"]),
    "to come": ({"event_ts": "2025-06-17 08:00:00", "business_date": "2025-06-17"}, ["business_rule: business_date_not_far_future - business_date 2025-06-17 is more than 1 day in the future"]),
    "a rule of its own": ({"amount": "6000"}, ["business_rule: small failed"]),
}


def _frame(spark, *rows):
    return spark.createDataFrame([tuple((GOOD | r)[n] for n in NAMES) for r in rows], ", ".join(f"{n} string" for n in NAMES))


def test_cases(spark):
    rows = [c | ({} if "record_id" in c else {"record_id": f"Q{i}"}) for i, (c, _) in enumerate(CASES.values())]
    df = _frame(spark, *[r | {"_source_file": name} for r, name in zip(rows, CASES)])
    got = {r._source_file: r for r in ContractValidator(CONTRACT, as_of=AS_OF).apply(df).collect()}
    for name, (_, messages) in CASES.items():
        assert got[name].rejection_reasons == "|".join(messages), name
        assert got[name].is_valid == (not messages)


@pytest.mark.parametrize("ids,files,duplicate", [(("D", "D"), ("a", "b"), True), (("D", "D"), ("a", "a"), True), (("D", " D "), ("a", "b"), True), (("D", "E"), ("a", "a"), False)])
def test_ids_across_files(spark, ids, files, duplicate):
    df = _frame(spark, *[{"record_id": i, "_source_file": f} for i, f in zip(ids, files)])
    got = ContractValidator(CONTRACT, as_of=AS_OF).apply(df).collect()
    assert all(r.rejection_reasons == ("record_id: duplicate record_id found across files" if duplicate else "") for r in got)
