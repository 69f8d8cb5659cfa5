"""Patterns that can hang are refused, all others judged as before."""

import re
import time

import pytest

from rowgate import ContractError, evaluate
from rowgate.functions.patterns import ambiguous_loop

HANGING = [r"(a+)+$", r"(a*)*$", r"(a|aa)+$", r"(\w+\s?)*$", r"^(([a-z])+.)+[A-Z]([a-z])+$", r"^(\d+)*x", r"(x+x+)+y", r"(.*a){12}$", r"(a|b|ab)*c",
           r"^(?:[a-z]+|[a-z0-9]+)+!$", r"^((ab)*|(ab))*c"]
FINE = [r"^[A-Z]{2}$", r"^https://[a-z]+\.example\.(com|org)/", r"^Customer#0{5}[0-9]{4}$", r"^\d{4}-\d{2}-\d{2}$", r"(a+)+", r"^(\d+,)*\d+$",
        r"^[\w.]+@[\w.]+\.\w+$", r"(?:a++)+$", r"^[A-Z]+(-[A-Z0-9]+)*$", r"^\s*\S+\s*$", r"^(ab|cd)+$", r"^(a|b)*c$", r"\p{Lu}+$", r"^(\w+)\1$",
        r"^.*foo.*$", r"", r"^(?=.*\d).{8,}$", r"^[^,]*(,[^,]*){3}$"]


def test_ambiguous_loops():
    assert [p for p in HANGING if ambiguous_loop(p) is None] == []
    assert [p for p in FINE if ambiguous_loop(p) is not None] == []


def test_what_is_fine_is_fast():
    """Values made of what the patterns repeat, with an end that fails."""
    for p in FINE:
        if "\\p{" in p:
            continue
        for piece in ("a", "A-", "1,", "ab", "x.", " "):
            t = time.perf_counter()
            re.search(p, piece * 400 + "!")
            assert time.perf_counter() - t < 2, p


def test_contracts_with_hanging_patterns_are_refused(spark):
    df = spark.createDataFrame([("aaaa",), ("b",)], "x string")
    for p in HANGING[:3]:
        with pytest.raises(ContractError, match="exponential"):
            evaluate(df, {"schema": [{"name": "x", "regex": p}]})
    got = evaluate(df, {"schema": [{"name": "x", "regex": "^a+$"}]}).collect()
    assert sorted((r.x, r.is_valid) for r in got) == [("aaaa", True), ("b", False)]
