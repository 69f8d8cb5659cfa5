"""Row rules as a table: rule id, what a good row is changed to, the messages.

All rows of the table are judged in one frame; every row has an id of its own.
"""

import datetime as dt

import pytest

from rowgate import Contract, ContractError, evaluate
from tests.conftest import CONTRACT

AS_OF = dt.date(2031, 10, 5)
GOOD = {
    "event_ts": "2031-10-02 17:45:10", "business_date": "2031-10-03", "source_system": "ACH_GATEWAY", "currency": "GBP",
    "amount": "77.70", "status": "REVERSED", "merchant_category": None, "country_code": "NZ", "_source_file": "load-1",
}
SYSTEMS = "['CARD_PROC', 'ACH_GATEWAY', 'WIRE_HUB', 'WALLET_X']"
NEAR = "business_rule: event_ts_near_business_date - event_ts {} is more than 7 days from business_date {}"

# (rule, changes to the good row, messages in order)
TABLE = [
    ("C4", {}, []),
    ("R1", {"event_ts": None}, ["event_ts: required field is null or empty"]),
    ("R1", {"source_system": ""}, ["source_system: required field is null or empty", f"source_system: '' not in allowed_values {SYSTEMS}"]),
    ("R1", {"merchant_category": "   "}, []),
    ("R2", {"source_system": "PIGEON"}, [f"source_system: 'PIGEON' not in allowed_values {SYSTEMS}"]),
    ("R2", {"currency": "gbp"}, ["currency: 'gbp' not in allowed_values ['USD', 'EUR', 'GBP']"]),
    ("R2", {"status": "  NEW "}, []),
    ("R3", {"event_ts": "2031-10-02T26:00"}, ["event_ts: '2031-10-02T26:00' is not a valid timestamp"]),
    ("R3", {"event_ts": "2031-10-02T22:30:00+11:00"}, []),
    ("R4", {"business_date": "3 October"}, ["business_date: '3 October' is not a valid date"]),
    ("R5", {"amount": "77,70"}, ["amount: '77,70' is not a valid decimal"]),
    ("R5", {"amount": "7.77e1"}, []),
    ("R6", {"country_code": "N7"}, ["country_code: 'N7' does not match pattern ^[A-Z]{2}$"]),
    ("R6", {"country_code": "NZL"}, ["country_code: 'NZL' does not match pattern ^[A-Z]{2}$"]),
    ("R7", {"amount": "-0.01"}, ["amount: -0.01 is below min_value 0"]),
    ("R7", {"amount": "0"}, []),
    ("R11", {"amount": "0", "status": "SETTLED"}, ["business_rule: settled_amount_positive - amount must be > 0 when status=SETTLED"]),
    ("R11", {"amount": "0.01", "status": "SETTLED"}, []),
    ("R11", {"amount": "nil", "status": "SETTLED"}, ["amount: 'nil' is not a valid decimal"]),
    ("R12", {"event_ts": "2031-09-25 23:59:59"}, [NEAR.format("2031-09-25 23:59:59", "2031-10-03")]),
    ("R12", {"event_ts": "2031-09-26 00:00:00"}, []),
    ("R13", {"business_date": "2031-10-07"}, ["business_rule: business_date_not_far_future - business_date 2031-10-07 is more than 1 day in the future"]),
    ("R13", {"business_date": "2031-10-06"}, []),
    ("C1", {"currency": "XAU", "amount": "-2", "country_code": "n"}, [
        "currency: 'XAU' not in allowed_values ['USD', 'EUR', 'GBP']", "country_code: 'n' does not match pattern ^[A-Z]{2}$", "amount: -2 is below min_value 0"]),
    ("R15", {"record_id": "twin", "_source_file": "load-1"}, ["record_id: duplicate record_id found across files"]),
    ("R15", {"record_id": "  twin", "_source_file": "load-2"}, ["record_id: duplicate record_id found across files"]),
]
COLUMNS = ["record_id", *GOOD]


def frame(spark, rows):
    return spark.createDataFrame([tuple(r[c] for c in COLUMNS) for r in rows], ", ".join(f"{c} string" for c in COLUMNS))


@pytest.fixture(scope="module")
def judged(spark):
    rows = [{"record_id": f"row {i}"} | GOOD | change for i, (_, change, _) in enumerate(TABLE)]
    df = frame(spark, rows)
    out = evaluate(df, CONTRACT, as_of=AS_OF)
    assert out.columns == [*COLUMNS, "violations", "rejection_reasons", "is_valid"]
    assert out.schema.fields[:len(COLUMNS)] == df.schema.fields
    return {r.record_id: r for r in out.collect()}


@pytest.mark.parametrize("i", range(len(TABLE)), ids=[f"{i}-{rule}" for i, (rule, _, _) in enumerate(TABLE)])
def test_row(judged, i):
    _, change, messages = TABLE[i]
    got = judged[change.get("record_id", f"row {i}")]
    assert [v.message for v in got.violations] == messages
    assert got.rejection_reasons == "|".join(messages) and got.is_valid == (not messages)


def reasons(spark, contract, column, values, kind="string"):
    df = spark.createDataFrame([(v,) for v in values], f"`{column}` {kind}")
    return [r.rejection_reasons for r in evaluate(df, Contract.from_dict(contract), as_of=AS_OF).orderBy(f"`{column}`").collect()]


def test_bounds_and_scale(spark):
    top = {"schema": [{"name": "n", "type": "decimal(9,1)", "max_value": 5}]}
    assert reasons(spark, top, "n", ["4.9", "5", "5.1"]) == ["", "", "n: 5.1 exceeds max_value 5"]
    strict = {"schema": [{"name": "n", "type": "decimal(9,1)", "strict_scale": True}]}
    assert reasons(spark, strict, "n", ["1.5", "1.55", "2e1"]) == ["", "n: '1.55' has more decimals than decimal(9,1)", ""]


def test_a_rule_without_a_message(spark):
    rule = {"schema": [{"name": "n", "type": "int"}], "business_rules": [{"name": "even", "assert": "n % 2 = 0"}]}
    assert reasons(spark, rule, "n", ["1", "2"]) == ["business_rule: even failed", ""]
    assert reasons(spark, rule, "n", [None]) == [""]


@pytest.mark.parametrize("kind,allowed,values,bad", [
    ("boolean", [True], [False, True], [True, False]),
    ("double", ["0.10", 2], [0.1, 0.2, 2.0], [False, True, False]),
    ("int", [3, "x"], [3, 4], [False, True]),
])
def test_allowed_values_in_the_columns_own_type(spark, kind, allowed, values, bad):
    got = reasons(spark, {"schema": [{"name": "n", "allowed_values": allowed}]}, "n", values, kind)
    assert [bool(r) for r in got] == bad


@pytest.mark.parametrize("schema", [{"name": "n", "regex": "(["}, {"name": "n", "type": "colour"}, {"name": "n", "min_value": "low"}])
def test_contracts_that_make_no_sense(spark, schema):
    with pytest.raises(ContractError):
        reasons(spark, {"schema": [schema]}, "n", ["1"])


def test_names_with_dots_and_other_case(spark):
    df = spark.createDataFrame([("a", "1", "z"), ("b", "x", "z")], "`k.1` string, Amount string, `odd.name` string")
    contract = {"schema": [{"name": "k.1", "unique": True}, {"name": "amount", "type": "int"}]}
    got = {r["k.1"]: r.is_valid for r in evaluate(df, contract, as_of=AS_OF).collect()}
    assert got == {"a": True, "b": False}


def test_a_data_column_called_as_of(spark):
    df = spark.createDataFrame([("a", "b")], "as_of string, n string")
    rule = {"schema": [{"name": "n"}], "business_rules": [{"name": "r", "assert": "as_of > date '2000-01-01'"}]}
    with pytest.raises(ContractError):
        evaluate(df, rule)
    assert evaluate(df, {"schema": [{"name": "n"}]}).first().is_valid


def test_errors_stay_errors_after_a_rule_check(spark):
    from pyspark.errors import AnalysisException

    df = frame(spark, [{"record_id": "a"} | GOOD])
    evaluate(df, CONTRACT, as_of=AS_OF)
    with pytest.raises(AnalysisException):
        df.select("nope")


def test_keys_are_counted_on_the_input(spark):
    from rowgate.operators import keys

    df = spark.range(2000).selectExpr("id % 700 AS a", "id % 900 AS b", "id % 1100 AS c", "id % 4 AS d")
    names = "abcd"
    for n in (1, 2, 4):
        out = keys.flag_all(df, [([c], f"dup_{c}", False, "group") for c in names[:n]], hot_key_rows=400)
        plan = out._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("Range (0, 2000") <= 2 * n + 1
    rows = out.collect()
    for c, m in zip(names, (700, 900, 1100, 4)):
        assert sum(r[f"dup_{c}"] for r in rows) == sum(1 for i in range(2000) if len(range(i % m, 2000, m)) > 1)


# --- rules that fail on a row

FAILING = [("by_zero", "id / d > 0"), ("again", "id / d > 1"), ("cast", "cast(s as int) > 0"), ("index", "element_at(array(1, 2), id) > 0"),
           ("overflow", "id * 2147483647 > 0"), ("message", "id < 3")]


def _failing(mode, **more):
    rules = [{"name": n, "assert": a} for n, a in FAILING]
    rules[-1]["message"] = "{s} of {id}"
    return {"schema": [], "business_rules": rules, **({"on_rule_error": mode} if mode else {}), **more}


@pytest.fixture(scope="module")
def failing_rows(spark):
    return spark.createDataFrame([(1, 0, "x"), (2, 1, "5"), (3, None, None), (4, 3, "7")], "id int, d int, s string").repartition(2)


def test_rules_that_fail_flag_the_row(spark, failing_rows):
    for contract in (_failing("flag"), _failing(None, on_bad_rule="skip")):
        got = {r.id: [(v.kind, v.rule) for v in r.violations] for r in evaluate(failing_rows, contract, as_of="2026-01-01").collect()}
        error = lambda *names: [("rule_error", n) for n in names]
        assert got == {1: error("by_zero", "again", "cast"), 2: error("overflow"), 3: error("index", "overflow") + [("business_rule", "message")],
                       4: error("index", "overflow") + [("business_rule", "message")]}


def test_rules_that_fail_pass_or_end_the_job(spark, failing_rows):
    passed = evaluate(failing_rows, _failing("pass"), as_of="2026-01-01").collect()
    assert {r.id: r.rejection_reasons for r in passed} == {1: "", 2: "", 3: "business_rule: message - null of 3", 4: "business_rule: message - 7 of 4"}
    for contract in (_failing("fail"), _failing(None)):
        with pytest.raises(Exception, match="DIVIDE_BY_ZERO|CAST_INVALID_INPUT|INVALID_ARRAY_INDEX|OVERFLOW"):
            evaluate(failing_rows, contract, as_of="2026-01-01").collect()
    with pytest.raises(ContractError):
        Contract.from_dict({"on_rule_error": "maybe"})


def test_failing_rules_in_the_catalogue(spark, failing_rows):
    from rowgate.operators.evaluate import rule_catalog, rule_hits

    contract = _failing("flag")
    hits = rule_hits(rule_catalog(failing_rows, contract), evaluate(failing_rows, contract, as_of="2026-01-01"), errors=True).collect()
    assert {r.rule: (r.violations, r.errors) for r in hits} == {
        "by_zero": (0, 1), "again": (0, 1), "cast": (0, 1), "index": (0, 2), "overflow": (0, 3), "message": (2, 0)}
