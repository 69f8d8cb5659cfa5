"""Uniqueness (R15/R16): strategies agree with a brute-force count, hot keys included."""

from collections import Counter

from hypothesis import given, settings
from hypothesis import strategies as st

from rowgate.operators.keys import flag_duplicates

VALUES = st.one_of(st.none(), st.sampled_from(["", " ", "a", "a ", " a", "b", "c", "HOT"]))


def brute(rows, idx):
    def norm(x):
        return None if x is None else x.strip(" ")
    counts = Counter(tuple(norm(r[i]) for i in idx) for r in rows)
    return [counts[tuple(norm(r[i]) for i in idx)] > 1 for r in rows]


def flags(spark, rows, cols, **kw):
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "id int, f string, k string, j string")
    out = flag_duplicates(df, cols, "dup", **kw).orderBy("id").collect()
    return [r.dup for r in out]


@settings(max_examples=12, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["f0", "f1"]), VALUES, VALUES), min_size=1, max_size=40))
def test_strategies_match_brute_force(spark, rows):
    want_k = brute(rows, [1])
    assert flags(spark, rows, ["k"]) == want_k
    assert flags(spark, rows, ["k"], strategy="window") == want_k
    assert flags(spark, rows, ["k"], strategy="window", hot_key_rows=2, max_hot_keys=1) == want_k
    assert flags(spark, rows, ["k"], hot_key_rows=3) == want_k
    assert flags(spark, rows, ["k"], strategy="window", hot_key_rows=2) == want_k
    assert flags(spark, rows, ["k"], hot_key_rows=2, max_hot_keys=1) == want_k
    assert flags(spark, rows, ["f", "k", "j"], hot_key_rows=2) == brute(rows, [0, 1, 2])
    assert flags(spark, rows, ["k"], hashed=True) == want_k


def test_hot_key_holding_a_third_of_rows(spark):
    rows = [("f0", "HOT", None)] * 300 + [("f1", f"k{i}", None) for i in range(600)] + [("f1", "k7", None)]
    got = flags(spark, rows, ["k"], hot_key_rows=100)
    assert flags(spark, rows, ["k"], hot_key_rows=100, strategy="window") == got
    assert got == brute(rows, [1])
    assert sum(got) == 302


def test_hot_key_plan_broadcasts_bounded_set(spark):
    df = spark.createDataFrame([("a",)] * 10, "k string")
    plan = flag_duplicates(df, ["k"], "dup", hot_key_rows=5, max_hot_keys=7)._jdf.queryExecution() \
        .executedPlan().toString()
    assert "TakeOrderedAndProject(limit=7" in plan.replace(" ", "") or "limit=7" in plan
    assert "BroadcastHashJoin" in plan or "BroadcastExchange" in plan


def test_null_keys_ignored(spark):
    rows = [("f0", None, None), ("f0", None, None), ("f1", "a", None), ("f1", "a ", None), ("f1", "", None)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "id int, f string, k string, j string")
    for kw in ({}, {"strategy": "window"}, {"hot_key_rows": 2}):
        got = [r.dup for r in flag_duplicates(df, ["k"], "dup", null_keys="ignore", **kw).orderBy("id").collect()]
        assert got == [False, False, True, True, False]
