"""Data contracts.

A contract declares the columns of a table (type, required, allowed values,
pattern, numeric range, uniqueness) plus table-level uniqueness keys and SQL
business rules.  It is loaded once on the driver from YAML, JSON or a plain
dict; it is tiny, so it never touches the cluster until it is turned into
column expressions by :mod:`rowgate.operators.evaluate`.
"""

from __future__ import annotations

import json
import os
from collections.abc import Mapping
from dataclasses import dataclass, field
from typing import Any

try:  # YAML is optional: dict and JSON contracts work without it.
    import yaml as _yaml
except ImportError:  # pragma: no cover - depends on the image
    _yaml = None


class ContractError(ValueError):
    """The contract itself is malformed (unknown key, bad rule, bad type...)."""


SCOPE_DATASET = "dataset"
SCOPE_FILE = "file"

_COLUMN_KEYS = {
    "name", "type", "required", "allowed_values", "regex", "min_value",
    "max_value", "unique", "unique_within_file", "strict_scale", "description",
}
_RULE_KEYS = {"name", "assert", "condition", "message", "description"}
_KEY_KEYS = {"columns", "scope", "hashed", "name", "null_keys"}
_TOP_KEYS = {
    "dataset", "version", "schema", "business_rules", "unique_keys",
    "file_column", "on_bad_rule", "on_rule_error", "description",
}


@dataclass(frozen=True)
class ColumnSpec:
    name: str
    type: str | None = None
    required: bool = False
    allowed_values: tuple[Any, ...] | None = None
    regex: str | None = None
    min_value: Any = None
    max_value: Any = None
    strict_scale: bool = False

    @property
    def allowed_text(self) -> str:
        """The allowed list rendered as the contract author wrote it."""
        return repr(list(self.allowed_values or ()))


@dataclass(frozen=True)
class BusinessRule:
    name: str
    assert_sql: str
    condition: str | None = None
    message: str | None = None


@dataclass(frozen=True)
class UniqueKey:
    columns: tuple[str, ...]
    scope: str = SCOPE_DATASET
    hashed: bool = False
    name: str | None = None
    null_keys: str = "group"  # "group": null keys are one group; "ignore": never duplicates

    @property
    def label(self) -> str:
        if len(self.columns) == 1:
            return self.columns[0]
        return "(" + ", ".join(self.columns) + ")"

    @property
    def rule(self) -> str:
        return "unique" if self.scope == SCOPE_DATASET else "unique_within_file"

    @property
    def message(self) -> str:
        from .functions import messages

        template = messages.DUPLICATE if self.scope == SCOPE_DATASET else messages.DUPLICATE_IN_FILE
        return template.format(key=self.label)


@dataclass(frozen=True)
class Contract:
    columns: tuple[ColumnSpec, ...]
    business_rules: tuple[BusinessRule, ...] = ()
    unique_keys: tuple[UniqueKey, ...] = ()
    dataset: str | None = None
    version: str | None = None
    file_column: str = "_source_file"
    on_bad_rule: str = "fail"
    on_rule_error: str | None = None
    raw: Mapping[str, Any] = field(default_factory=dict, compare=False, repr=False)

    # ------------------------------------------------------------------ load
    @classmethod
    def load(cls, source: "Contract | str | os.PathLike | Mapping[str, Any]") -> "Contract":
        if isinstance(source, Contract):
            return source
        if isinstance(source, Mapping):
            return cls.from_dict(source)
        path = os.fspath(source)
        with open(path, encoding="utf-8") as fh:
            text = fh.read()
        if path.endswith(".json"):
            doc = json.loads(text)
        else:
            if _yaml is None:
                raise ContractError("PyYAML is not installed; pass a dict or a .json contract")
            doc = _yaml.safe_load(text)
        return cls.from_dict(doc or {})

    @classmethod
    def from_dict(cls, doc: Mapping[str, Any]) -> "Contract":
        _check_keys("contract", doc, _TOP_KEYS)
        columns: list[ColumnSpec] = []
        keys: list[UniqueKey] = []
        seen: set[str] = set()
        for item in doc.get("schema") or []:
            _check_keys("schema entry", item, _COLUMN_KEYS)
            name = item.get("name")
            if not name or not isinstance(name, str):
                raise ContractError(f"schema entry without a name: {item!r}")
            if name in seen:
                raise ContractError(f"column {name!r} declared twice")
            seen.add(name)
            allowed = item.get("allowed_values")
            if allowed is not None and not isinstance(allowed, (list, tuple)):
                raise ContractError(f"{name}: allowed_values must be a list")
            regex = item.get("regex")
            columns.append(ColumnSpec(
                name=name,
                type=_norm_type(item.get("type")),
                required=bool(item.get("required", False)),
                allowed_values=tuple(allowed) if allowed else None,
                regex=str(regex) if regex else None,
                min_value=item.get("min_value"),
                max_value=item.get("max_value"),
                strict_scale=bool(item.get("strict_scale", False)),
            ))
            if item.get("unique"):
                keys.append(UniqueKey((name,), SCOPE_DATASET))
            if item.get("unique_within_file"):
                keys.append(UniqueKey((name,), SCOPE_FILE))
        for item in doc.get("unique_keys") or []:
            _check_keys("unique_keys entry", item, _KEY_KEYS)
            cols = item.get("columns")
            if isinstance(cols, str):
                cols = [cols]
            if not cols:
                raise ContractError(f"unique key without columns: {item!r}")
            scope = item.get("scope", SCOPE_DATASET)
            if scope not in (SCOPE_DATASET, SCOPE_FILE):
                raise ContractError(f"unique key scope must be dataset or file, got {scope!r}")
            null_keys = item.get("null_keys", "group")
            if null_keys not in ("group", "ignore"):
                raise ContractError(f"null_keys must be group or ignore, got {null_keys!r}")
            keys.append(UniqueKey(tuple(cols), scope, bool(item.get("hashed", False)), item.get("name"),
                                  null_keys))
        rules: list[BusinessRule] = []
        for item in doc.get("business_rules") or []:
            _check_keys("business rule", item, _RULE_KEYS)
            if not item.get("name") or not item.get("assert"):
                raise ContractError(f"business rule needs name and assert: {item!r}")
            rules.append(BusinessRule(
                name=str(item["name"]),
                assert_sql=str(item["assert"]),
                condition=str(item["condition"]) if item.get("condition") else None,
                message=str(item["message"]) if item.get("message") else None,
            ))
        on_bad = doc.get("on_bad_rule", "fail")
        if on_bad not in ("fail", "skip"):
            raise ContractError(f"on_bad_rule must be fail or skip, got {on_bad!r}")
        on_error = doc.get("on_rule_error")
        if on_error not in (None, "fail", "flag", "pass"):
            raise ContractError(f"on_rule_error must be fail, flag or pass, got {on_error!r}")
        version = doc.get("version")
        return cls(
            columns=tuple(columns),
            business_rules=tuple(rules),
            unique_keys=tuple(keys),
            dataset=doc.get("dataset"),
            version=None if version is None else str(version),
            file_column=doc.get("file_column", "_source_file"),
            on_bad_rule=on_bad,
            on_rule_error=on_error,
            raw=dict(doc),
        )

    # --------------------------------------------------------------- helpers
    @property
    def rule_errors(self) -> str:
        """What a business rule that fails on a row does: ``fail`` the job, ``flag``
        the row, or ``pass`` it.  Where bad rules are skipped, rows are flagged."""
        return self.on_rule_error or ("flag" if self.on_bad_rule == "skip" else "fail")

    @property
    def column_names(self) -> list[str]:
        return [c.name for c in self.columns]

    def column(self, name: str) -> ColumnSpec:
        for c in self.columns:
            if c.name == name:
                return c
        raise KeyError(name)

    def with_rules(self, business_rules) -> "Contract":
        """Copy with another business-rule list (used after rule checking)."""
        return Contract(self.columns, tuple(business_rules), self.unique_keys, self.dataset,
                        self.version, self.file_column, self.on_bad_rule, self.on_rule_error, self.raw)


def _norm_type(value: Any) -> str | None:
    if value is None:
        return None
    text = str(value).strip().lower().replace(" ", "")
    return text or None


def _check_keys(what: str, item: Any, allowed: set[str]) -> None:
    if not isinstance(item, Mapping):
        raise ContractError(f"{what} must be a mapping, got {item!r}")
    unknown = set(item) - allowed
    if unknown:
        raise ContractError(f"{what}: unknown keys {sorted(unknown)}")
