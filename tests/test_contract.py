"""Contract loading, checking (R14) and the rule catalog."""

import json

import pytest

from rowgate import Contract, ContractError, evaluate, rule_catalog
from tests.conftest import CONTRACT


def test_load_yaml_dict_json(tmp_path):
    c = Contract.load(CONTRACT)
    assert c.column_names[0] == "record_id" and len(c.business_rules) == 3
    assert [k.columns for k in c.unique_keys] == [("record_id",)]
    p = tmp_path / "c.json"
    p.write_text(json.dumps(c.raw, default=str))
    assert Contract.load(str(p)).column_names == c.column_names
    assert Contract.load(c.raw).business_rules == c.business_rules


@pytest.mark.parametrize("doc", [
    {"schema": [{"name": "a", "requird": True}]},
    {"schema": [{"name": "a"}, {"name": "a"}]},
    {"schema": [{"type": "int"}]},
    {"business_rules": [{"name": "x"}]},
    {"unique_keys": [{"columns": ["a"], "scope": "table"}]},
    {"on_bad_rule": "maybe"},
])
def test_malformed_contracts(doc):
    with pytest.raises(ContractError):
        Contract.from_dict(doc)


def test_bad_rule_fails_by_default(spark):
    df = spark.createDataFrame([("1",)], "n string")
    c = Contract.from_dict({"schema": [{"name": "n", "type": "int"}],
                            "business_rules": [{"name": "broken", "assert": "no_such_column > 1"}]})
    with pytest.raises(ContractError):
        evaluate(df, c)


def test_bad_rule_skipped_and_catalogued(spark):
    df = spark.createDataFrame([("1",), ("20",)], "n string")
    c = Contract.from_dict({"schema": [{"name": "n", "type": "int", "required": True}],
                            "on_bad_rule": "skip",
                            "business_rules": [{"name": "broken", "assert": "n >>> 1"},
                                               {"name": "not_bool", "assert": "n + 1"},
                                               {"name": "small", "assert": "n < 10"}]})
    got = [r.rejection_reasons for r in evaluate(df, c).orderBy("n").collect()]
    assert got == ["", "business_rule: small failed"]
    cat = {r.rule: r.status for r in rule_catalog(df, c).collect()}
    assert cat == {"required": "ok", "type:int": "ok", "broken": "skipped", "not_bool": "skipped",
                   "small": "ok"}


def test_missing_column_policy(spark):
    df = spark.createDataFrame([("x",)], "record_id string")
    with pytest.raises(ContractError):
        evaluate(df, CONTRACT)
    out = evaluate(df, CONTRACT, on_missing="null_fill", as_of="2026-01-01").first()
    assert "amount: required field is null or empty" in out.rejection_reasons
