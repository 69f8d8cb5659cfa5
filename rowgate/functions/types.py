"""Declared contract types mapped onto Spark types.

Only names are handled here; casting itself is Spark's ``try_cast`` so the
accepted grammar (ISO dates, offset timestamps, ``1e3`` decimals...) is exactly
Spark's own.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Spellings a contract may use for the same Spark type.
_ALIASES = {
    "integer": "int",
    "long": "bigint",
    "short": "smallint",
    "byte": "tinyint",
    "bool": "boolean",
    "real": "float",
    "text": "string",
    "varchar": "string",
    "decimal": "decimal(10,0)",
    "numeric": "decimal(10,0)",
}

_NUMERIC = ("tinyint", "smallint", "int", "bigint", "float", "double", "decimal")


def canonical(declared: str | None) -> str | None:
    if declared is None:
        return None
    text = declared.strip().lower().replace(" ", "")
    if text.startswith("numeric("):
        text = "decimal(" + text[len("numeric("):]
    return _ALIASES.get(text, text)


def check(declared: str | None, column: str) -> None:
    """Raise a contract error for a type that Spark doesn't know."""
    from ..contract import ContractError

    if declared is None:
        return
    try:
        T.DataType.fromDDL(canonical(declared))
    except Exception as exc:
        raise ContractError(f"column {column!r} has unknown type {declared!r}") from exc


def column(name: str) -> Column:
    """The column of exactly this name, dots and backticks included."""
    return F.col("`" + name.replace("`", "``") + "`")


def spark_type_name(dt: T.DataType) -> str:
    return dt.simpleString().replace(" ", "")


def type_word(declared: str) -> str:
    """Word used in type-check messages: ``decimal(18,2)`` reads ``decimal``."""
    name = canonical(declared) or "string"
    return "decimal" if name.startswith("decimal") else name


def is_string(dt: T.DataType) -> bool:
    return isinstance(dt, (T.StringType, T.VarcharType, T.CharType))


def is_numeric_name(name: str | None) -> bool:
    return bool(name) and any(name == n or name.startswith(n + "(") for n in _NUMERIC)


def needs_cast(raw_type: T.DataType, declared: str | None) -> bool:
    name = canonical(declared)
    if name is None or name == "string" and is_string(raw_type):
        return False
    return name != spark_type_name(raw_type)


def typed(raw: Column, raw_type: T.DataType, declared: str | None) -> Column:
    """The value under its declared type; null where it does not parse."""
    if not needs_cast(raw_type, declared):
        return raw
    return raw.try_cast(canonical(declared))
