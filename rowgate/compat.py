"""The original library entry point: ``ContractValidator(contract).apply(df)``.

Contracts in the original format get the original verdict:

* ``record_id`` is unique across all files, whatever the contract's uniqueness
  keys say;
* the rules known by name judge by their fixed wording and messages, whatever
  their text; other rules are evaluated, and skipped where that fails.

The result has the original columns (``rejection_reasons``, ``is_valid``) and the
structured ``violations``.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame

from .contract import BusinessRule, Contract, UniqueKey
from .operators.evaluate import evaluate

# Rules that the original tool knows by name, with their messages.
KNOWN_RULES = {
    r.name: r for r in (
        BusinessRule("settled_amount_positive", "amount > 0", "upper(trim(status)) = 'SETTLED'",
                     "amount must be > 0 when status=SETTLED"),
        BusinessRule("event_ts_near_business_date", "abs(datediff(to_date(event_ts), business_date)) <= 7", None,
                     "event_ts {event_ts} is more than 7 days from business_date {business_date}"),
        BusinessRule("business_date_not_far_future", "business_date <= date_add(as_of, 1)", None,
                     "business_date {business_date} is more than 1 day in the future"),
    )
}
ID = "record_id"


def original(contract) -> Contract:
    """A contract with the meaning that the original tool gives it."""
    contract = Contract.load(contract)
    keys = tuple(k for k in contract.unique_keys if k.columns != (ID,))
    if ID in contract.column_names:
        keys += (UniqueKey((ID,)),)
    rules = tuple(r if r.message else KNOWN_RULES.get(r.name, r) for r in contract.business_rules)
    return replace(contract, unique_keys=keys, business_rules=rules, on_bad_rule="skip", on_rule_error="pass")


class ContractValidator:
    def __init__(self, contract, *, as_of=None, **evaluate_kw):
        self.contract = original(contract)
        self.as_of = as_of
        self.evaluate_kw = evaluate_kw

    def apply(self, df: DataFrame) -> DataFrame:
        """``df`` with ``violations``, ``rejection_reasons`` and ``is_valid``."""
        return evaluate(df, self.contract, as_of=self.as_of, **self.evaluate_kw)
