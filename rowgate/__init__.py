"""rowgate - data contracts judged at scale on Spark.

A contract declares columns, types, required fields, allowed values,
patterns, ranges, unique keys and SQL business rules; rowgate turns it into
Spark column expressions that judge every row of a DataFrame, keep every
violation, and route rows to silver, quarantine and report tables.
"""

from .compat import ContractValidator
from .contract import BusinessRule, ColumnSpec, Contract, ContractError, UniqueKey
from .operators.evaluate import evaluate, evaluate_rows, rule_catalog
from .operators.route import quarantine, report, silver, stage_counts, summary_by, summary_by_rule

__all__ = [
    "BusinessRule", "ColumnSpec", "Contract", "ContractError", "ContractValidator", "UniqueKey",
    "evaluate", "evaluate_rows", "rule_catalog",
    "silver", "quarantine", "report", "summary_by_rule", "summary_by", "stage_counts",
]
