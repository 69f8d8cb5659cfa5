"""Plan shape: no Python in the row path, pruned scans, one key aggregation."""

import re

from rowgate.plans import queries as Q
from tests.conftest import SF


def _final_plan(df) -> str:
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_python_evaluation_anywhere(spark):
    for name in ("verdict", "report", "unique_dataset_skew", "delimiter_repair"):
        plan = Q.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert not re.search(r"BatchEvalPython|ArrowEvalPython|PythonUDF|MapInPandas|FlatMapGroupsInPandas", plan)


def test_key_count_reads_key_columns_only_and_is_reused(spark):
    plan = _final_plan(Q.unique_composite(spark, SF))
    schemas = re.findall(r"ReadSchema: (struct<[^>]*>)", plan)
    assert "struct<l_orderkey:bigint,l_linenumber:int>" in schemas
    assert all("l_shipdate" not in s and "l_extendedprice" not in s for s in schemas)
    assert "ReusedExchange" in plan


def test_string_key_count_is_reused_too(spark):
    plan = _final_plan(Q.unique_dataset(spark, SF))
    assert "ReusedExchange" in plan


def test_verdict_holds_every_rule_once(spark):
    """Predicates stand in one projection and messages in another, each once."""
    plan = Q.verdict(spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count(": required field is null or empty") == 7 and plan.count("not in allowed_values") == 2
    assert plan.count("RLIKE") == 1 and plan.count("array_max(__flags") >= 1
