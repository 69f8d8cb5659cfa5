"""Row rules as Spark column expressions.

Every rule is a :class:`Check`: a "violated" predicate plus the struct
``(kind, column, rule, message)`` it reports; null predicates count as pass.  All rules are evaluated for every row (no
short-circuit), so a row carries its full list of problems.  Nothing here runs
Python per row: the functions only build expressions on the driver.
"""

from __future__ import annotations

import re
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..contract import BusinessRule, ColumnSpec, ContractError, UniqueKey
from . import messages as M
from . import types as ty
from .patterns import ambiguous_loop

VIOLATION_TYPE = T.StructType([
    T.StructField("kind", T.StringType()),
    T.StructField("column", T.StringType()),
    T.StructField("rule", T.StringType()),
    T.StructField("message", T.StringType()),
])

# Rule kinds, in the order rules are collected for a row.
KIND_ORDER = ("required", "allowed_values", "type", "regex", "range", "business_rule", "rule_error",
              "unique", "malformed")


def sql_string(text: str | None) -> str:
    """A Spark SQL string literal (backslash escapes are on by default)."""
    if text is None:
        return "CAST(NULL AS STRING)"
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def violation(kind: str, column: str | None, rule: str, message: Column) -> Column:
    # Constant fields in one expression (few JVM round trips per rule when a
    # contract has hundreds of rules); the optimizer folds withField away.
    head = F.expr(f"named_struct('kind', {sql_string(kind)}, 'column', {sql_string(column)}, "
                  f"'rule', {sql_string(rule)}, 'message', CAST(NULL AS STRING))")
    return head.withField("message", message.cast("string"))


def _none() -> Column:
    return F.array().cast(T.ArrayType(VIOLATION_TYPE))


class Check:
    """One rule: the "violated" predicate and the violation it reports."""

    __slots__ = ("bad", "value")

    def __init__(self, bad: Column, value: Column):
        self.bad, self.value = bad, value


def when_violated(bad: Column, kind: str, column: str | None, rule: str, message: Column) -> Check:
    return Check(bad, violation(kind, column, rule, message))


def _with_value(template: str, value: Column, **fixed) -> Column:
    before, after = M.split(template, **fixed)
    return F.concat(F.lit(before), value, F.lit(after))


def as_text(raw: Column, raw_type: T.DataType) -> Column:
    return raw if ty.is_string(raw_type) else raw.cast("string")


# --------------------------------------------------------------------------- R1
def required(spec: ColumnSpec, raw: Column, raw_type: T.DataType) -> Check | None:
    if not spec.required:
        return None
    bad = raw.isNull()
    if ty.is_string(raw_type):
        bad = bad | (F.trim(raw) == F.lit(""))
    return when_violated(bad, "required", spec.name, "required",
                         F.lit(M.REQUIRED.format(column=spec.name)))


# --------------------------------------------------------------------------- R2
def allowed_values(spec: ColumnSpec, raw: Column, raw_type: T.DataType) -> Check | None:
    if not spec.allowed_values:
        return None
    text = as_text(raw, raw_type)
    if ty.is_string(raw_type):
        bad = raw.isNotNull() & ~F.trim(text).isin([str(v) for v in spec.allowed_values])
    else:  # compared in the column's own type; a value that has none there matches nothing
        among = F.lit(False)
        for v in spec.allowed_values:
            among = among | F.coalesce(raw == F.lit(str(v)).try_cast(raw_type), F.lit(False))
        bad = raw.isNotNull() & ~among
    msg = _with_value(M.ALLOWED_VALUES, text, column=spec.name, allowed=spec.allowed_text)
    return when_violated(bad, "allowed_values", spec.name, "allowed_values", msg)


# ------------------------------------------------------------------------ R3-R5
def type_check(spec: ColumnSpec, raw: Column, raw_type: T.DataType, typed: Column) -> Check | None:
    if not ty.needs_cast(raw_type, spec.type):
        return None
    word = ty.type_word(spec.type)
    bad = raw.isNotNull() & typed.isNull()
    msg = _with_value(M.TYPE, as_text(raw, raw_type), column=spec.name, type=word)
    return when_violated(bad, "type", spec.name, f"type:{ty.canonical(spec.type)}", msg)


def scale_check(spec: ColumnSpec, raw: Column, raw_type: T.DataType, typed: Column) -> Check | None:
    """Opt-in ``strict_scale``: a decimal with more fractional digits than the
    declared scale is rejected instead of rounded."""
    name = ty.canonical(spec.type) or ""
    if not spec.strict_scale or not name.startswith("decimal") or not ty.is_string(raw_type):
        return None
    exact = raw.try_cast("decimal(38,18)")
    bad = typed.isNotNull() & exact.isNotNull() & (exact != typed)
    msg = _with_value(M.STRICT_SCALE, raw, column=spec.name, type=name)
    return when_violated(bad, "type", spec.name, "strict_scale", msg)


def check_pattern(pattern: str, name: str, spark=None) -> None:
    """Reject a pattern the engine's (Java) regex cannot compile, or that some
    values would hold up without end."""
    jvm = getattr(spark, "_jvm", None) if spark is not None else None
    try:
        if jvm is not None:
            jvm.java.util.regex.Pattern.compile(pattern)
        elif spark is not None:  # a session without its own JVM: let the engine match one row
            spark.range(1).select(F.lit("").rlike(pattern)).collect()
    except Exception as exc:
        raise ContractError(f"invalid regex for column {name!r}: {pattern}") from exc
    if reason := ambiguous_loop(pattern):
        raise ContractError(f"regex for column {name!r} may take exponential time ({reason}): {pattern}")


# --------------------------------------------------------------------------- R6
def regex(spec: ColumnSpec, raw: Column, raw_type: T.DataType) -> Check | None:
    if not spec.regex:
        return None
    text = as_text(raw, raw_type)
    bad = raw.isNotNull() & ~text.rlike(spec.regex)
    msg = _with_value(M.REGEX, text, column=spec.name, pattern=spec.regex)
    return when_violated(bad, "regex", spec.name, "regex", msg)


# ------------------------------------------------------------------------ R7-R8
def _number(value) -> Column:
    try:
        return F.lit(Decimal(str(value)))
    except ArithmeticError as exc:  # decimal.InvalidOperation
        raise ContractError(f"range bound {value!r} is not a number") from exc


def numeric_value(spec: ColumnSpec, raw: Column, raw_type: T.DataType, typed: Column) -> Column:
    """Numeric view used by range rules: the typed value when the declared (or
    stored) type is numeric, otherwise a double parsed from the text."""
    declared = ty.canonical(spec.type)
    if ty.is_numeric_name(declared):
        return typed
    if isinstance(raw_type, T.NumericType):
        return raw
    return as_text(raw, raw_type).try_cast("double")


def ranges(spec: ColumnSpec, raw: Column, raw_type: T.DataType, typed: Column) -> list[Check]:
    out: list[Check] = []
    if spec.min_value is None and spec.max_value is None:
        return out
    num = numeric_value(spec, raw, raw_type, typed)
    text = as_text(raw, raw_type)
    if spec.min_value is not None:
        bad = num.isNotNull() & (num < _number(spec.min_value))
        msg = _with_value(M.MIN_VALUE, text, column=spec.name, bound=spec.min_value)
        out.append(when_violated(bad, "range", spec.name, "min_value", msg))
    if spec.max_value is not None:
        bad = num.isNotNull() & (num > _number(spec.max_value))
        msg = _with_value(M.MAX_VALUE, text, column=spec.name, bound=spec.max_value)
        out.append(when_violated(bad, "range", spec.name, "max_value", msg))
    return out


# ----------------------------------------------------------------------- R9-R13
_PLACEHOLDER = re.compile(r"\{([A-Za-z_][A-Za-z0-9_]*)\}")


def render_template(template: str, sql_of) -> str:
    """``'event_ts {event_ts} ...'`` -> SQL ``concat`` of literals and raw values.

    ``sql_of(name)`` returns SQL text for a placeholder's raw value; nulls
    print as ``null`` so a message is never lost to null propagation.
    """
    parts: list[str] = []
    pos = 0
    for m in _PLACEHOLDER.finditer(template):
        if m.start() > pos:
            parts.append(sql_string(template[pos:m.start()]))
        parts.append(f"coalesce({sql_of(m.group(1))}, 'null')")
        pos = m.end()
    if pos < len(template):
        parts.append(sql_string(template[pos:]))
    return "concat(" + ", ".join(parts) + ")" if parts else "''"


def broken(rule: BusinessRule) -> str:
    """SQL of the predicate that a row violates a business rule."""
    bad = f"NOT ({rule.assert_sql})"
    return f"({rule.condition}) AND {bad}" if rule.condition else bad


def null_on_error(column: Column, spark) -> Column:
    """``column``, or null where its evaluation raises an error.

    The expression stands in a lambda: elsewhere Spark may evaluate what two
    expressions share ahead of both, outside of what catches the error.
    """
    from pyspark.sql.classic.column import Column as ClassicColumn

    utils = spark._jvm.org.apache.spark.sql.classic.ExpressionUtils

    def tried(_: Column) -> Column:
        inner = utils.expression(column._jc)
        return ClassicColumn(utils.column(spark._jvm.org.apache.spark.sql.catalyst.expressions.TryEval(inner)))

    return F.transform(F.array(F.lit(0)), tried)[0]


def tried(rules: list[BusinessRule], spark) -> Column:
    """A struct with one field for every rule: a struct with its predicate (``bad``),
    or null where the rule fails on the row.  Any error counts: a division by zero, an
    overflow, a cast, an index."""
    return F.struct(*[null_on_error(F.struct(F.expr(broken(r)).alias("bad")), spark).alias(f"r{i}") for i, r in enumerate(rules)])


def business_tried(rule: BusinessRule, result: Column, sql_of, flag_errors: bool) -> list[Check]:
    """The checks of a rule whose predicate was tried: violated, and not evaluated."""
    checks = [Check(result["bad"], business(rule, sql_of).value)]
    if flag_errors:
        checks.append(when_violated(result.isNull(), "rule_error", None, rule.name, F.lit(M.RULE_ERROR.format(name=rule.name))))
    return checks


def business(rule: BusinessRule, sql_of) -> Check:
    """Violated when ``condition AND NOT assert`` is true; null counts as pass.

    Built as two SQL expressions (predicate, violation struct) so a contract
    with hundreds of rules plans quickly."""
    bad = broken(rule)
    if rule.message:
        head, tail = M.BUSINESS_RULE.format(name=rule.name, message="\0").split("\0")
        msg = f"concat({sql_string(head)}, {render_template(rule.message, sql_of)}, {sql_string(tail)})"
    else:
        msg = sql_string(M.BUSINESS_RULE_FAILED.format(name=rule.name))
    value = F.expr(f"named_struct('kind', 'business_rule', 'column', CAST(NULL AS STRING), "
                   f"'rule', {sql_string(rule.name)}, 'message', {msg})")
    return Check(F.expr(bad), value)


# -------------------------------------------------------------------- R15, R16
def duplicate(key: UniqueKey, flag: Column) -> Check:
    return when_violated(flag, "unique", ",".join(key.columns), key.rule, F.lit(key.message))


# --------------------------------------------------------------------- verdict
def flags(checks: list[Check]) -> Column:
    """For every rule its number where it is violated, else null.

    Predicates only: small generated code, whatever the number of rules.
    """
    if not checks:
        return F.array().cast("array<int>")
    return F.array(*[F.when(c.bad, F.lit(i)) for i, c in enumerate(checks)])


#: Rules of one branch when a violation is looked up by its rule's number.
BRANCH = 32


def is_clean(found: Column) -> Column:
    """No rule is violated (a compiled pass over the numbers)."""
    return F.array_max(found).isNull()


def collect(found: Column, checks: list[Check]) -> Column:
    """The violations of the rules in ``found`` (a column of :func:`flags`),
    in rule order.  Messages are built for violations only: a row without one
    runs no lambda."""
    if not checks:
        return _none()

    def branch(i: Column, start: int) -> Column:
        out = None
        for n, c in enumerate(checks[start:start + BRANCH], start):
            out = F.when(i == n, c.value) if out is None else out.when(i == n, c.value)
        return out

    def value(i: Column) -> Column:
        out = None
        for start in range(0, len(checks), BRANCH):
            own = branch(i, start)
            out = F.when(i < start + BRANCH, own) if out is None else out.when(i < start + BRANCH, own)
        return out

    some = F.transform(F.filter(found, lambda i: i.isNotNull()), value)
    return F.when(is_clean(found), _none()).otherwise(some)


def reasons(violations: Column) -> Column:
    """The messages joined by ``|`` ('' for a clean row)."""
    return F.array_join(violations["message"], "|")
