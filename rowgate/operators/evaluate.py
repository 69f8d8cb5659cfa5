"""Verdict (C1-C5): every rule of a contract on every row, one projection.

Plan shape: ``[uniqueness joins] -> Project(typed scope) -> Project(flags) ->
Project(verdict)``: the second projection holds every rule's predicate once, the
third builds the violations of rows that have any.
Rules see *typed* columns under the contract's names (so ``amount > 0`` in a
business rule compares decimals, not strings), messages print the raw text.
The raw values ride along as hidden columns ``__raw_<i>`` and are renamed back
at the end, so the output keeps the input's columns and types unchanged plus

* ``violations``        array<struct<kind, column, rule, message>>
* ``rejection_reasons`` the messages joined by ``|`` ('' when clean)
* ``is_valid``          no violation at all
"""

from __future__ import annotations

import contextlib
import datetime as _dt
import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..contract import SCOPE_DATASET, BusinessRule, Contract, ContractError
from ..functions import messages as M
from ..functions import rules as R
from ..functions import types as ty
from . import key_state
from . import keys as K

RAW = "__raw_"
#: The business rules' predicates, each null where it fails on the row.
TRIED = "__tried"


@dataclass(frozen=True)
class RuleStatus:
    name: str
    status: str  # "ok" | "skipped" | "error"
    detail: str = ""


def as_of_date(spark, as_of=None) -> _dt.date:
    """The date of a run: as given, else today in the session's time zone."""
    if as_of is None:
        return spark.range(1).select(F.current_date()).first()[0]
    if isinstance(as_of, str):
        return _dt.date.fromisoformat(as_of)
    return as_of.date() if isinstance(as_of, _dt.datetime) else as_of


def _as_of_column(df: DataFrame, as_of) -> Column:
    """One literal a run; on a stream without a given date, each batch's own."""
    if as_of is None and df.isStreaming:
        return F.current_date()
    return F.lit(as_of_date(df.sparkSession, as_of))


def _own_names(df: DataFrame, contract: Contract) -> DataFrame:
    """Columns under the contract's spelling, where only their case differs."""
    if df.sparkSession.conf.get("spark.sql.caseSensitive", "false") == "true":
        return df
    spelled = {c.lower(): c for c in contract.column_names}
    names = [spelled.get(c.lower(), c) for c in df.columns]
    return df if names == list(df.columns) else df.toDF(*names)


class _Scope:
    """The typed rule scope plus where each contract column's raw value lives."""

    def __init__(self, df: DataFrame, contract: Contract, as_of):
        declared = {c.name: c for c in contract.columns}
        for c in contract.columns:
            ty.check(c.type, c.name)
        if "as_of" in df.columns and any(re.search(r"\bas_of\b", f"{r.condition} {r.assert_sql} {r.message}") for r in contract.business_rules):
            raise ContractError("rules name as_of, the date of the run, but the data has a column as_of")
        self.present = [c for c in contract.column_names if c in df.columns]
        self.raw_name = {c: f"{RAW}{i}" for i, c in enumerate(self.present)}
        self.raw_type = {c: df.schema[c].dataType for c in self.present}
        cols = []
        for name in df.columns:
            if name in declared:
                cols.append(ty.typed(ty.column(name), df.schema[name].dataType, declared[name].type).alias(name))
            else:
                cols.append(ty.column(name))
        cols += [ty.column(c).alias(self.raw_name[c]) for c in self.present]
        if "as_of" not in df.columns:
            cols.append(_as_of_column(df, as_of).alias("as_of"))
        self.df = df.select(*cols)

    def raw(self, name: str) -> Column:
        return F.col(self.raw_name[name])


def _scope(df: DataFrame, contract: Contract, as_of) -> DataFrame:
    """Typed columns at top level under their own names (raw ones hidden)."""
    return _Scope(df, contract, as_of).df


@contextlib.contextmanager
def _quiet_analysis():
    """PySpark logs every analysis error it raises, even when caught; rule
    checking expects some and reports them itself."""
    from pyspark.logger import PySparkLogger

    names = ("SQLQueryContextLogger", "DataFrameQueryContextLogger")
    loggers = [PySparkLogger.getLogger(n) for n in names]  # of PySpark's own class, as it makes them
    before = [lg.disabled for lg in loggers]
    for lg in loggers:
        lg.disabled = True
    try:
        yield
    finally:
        for lg, was in zip(loggers, before):
            lg.disabled = was


def check_rules(scope: DataFrame, contract: Contract) -> tuple[list[BusinessRule], list[RuleStatus]]:
    with _quiet_analysis():
        return _check_rules(scope, contract)


def _check_rules(scope: DataFrame, contract: Contract) -> tuple[list[BusinessRule], list[RuleStatus]]:
    """Analyse each business rule alone against the typed scope.

    Analysis only - no job runs.  A rule that does not parse, names an
    unknown column or is not boolean either fails the run (``on_bad_rule:
    fail``, the default) or is skipped and reported (``skip``).
    """
    good: list[BusinessRule] = []
    report: list[RuleStatus] = []
    rules = list(contract.business_rules)
    if not rules:
        return good, report
    try:  # common case: every rule is fine - one analysis for all of them
        exprs = []
        for i, rule in enumerate(rules):
            exprs.append(F.expr(rule.assert_sql).alias(f"a{i}"))
            if rule.condition:
                exprs.append(F.expr(rule.condition).alias(f"c{i}"))
        if all(f.dataType.typeName() == "boolean" for f in scope.select(*exprs).schema.fields):
            return rules, [RuleStatus(r.name, "ok") for r in rules]
    except Exception:  # find the culprits one by one below
        pass
    for rule in rules:
        try:
            exprs = [F.expr(rule.assert_sql).alias("a")]
            if rule.condition:
                exprs.append(F.expr(rule.condition).alias("c"))
            schema = scope.select(*exprs).schema
            bad_types = [f.name for f in schema.fields if f.dataType.typeName() != "boolean"]
            if bad_types:
                raise ContractError(f"rule {rule.name!r} is not boolean")
        except Exception as exc:  # ParseException, AnalysisException, ContractError
            detail = str(exc).strip().splitlines()[0][:300] if str(exc).strip() else type(exc).__name__
            if contract.on_bad_rule == "skip":
                report.append(RuleStatus(rule.name, "skipped", detail))
                continue
            raise ContractError(f"business rule {rule.name!r} is invalid: {detail}") from exc
        good.append(rule)
        report.append(RuleStatus(rule.name, "ok"))
    return good, report


def _sql_of(sc: _Scope):
    """SQL text of a message placeholder's raw value."""
    columns = set(sc.df.columns)

    def sql_of(name: str) -> str:
        if name in sc.raw_name:
            ref = f"`{sc.raw_name[name]}`"
            return ref if ty.is_string(sc.raw_type[name]) else f"CAST({ref} AS STRING)"
        if name in columns:
            return f"CAST(`{name}` AS STRING)"
        raise ContractError(f"message placeholder {{{name}}} names no column")

    return sql_of


def row_checks(sc: _Scope, contract: Contract, rules: list[BusinessRule]) -> list[R.Check]:
    """R1-R13 in the fixed order: required, allowed, type, regex, range, business."""
    specs = [c for c in contract.columns if c.name in sc.raw_name]
    parts = {k: [] for k in ("required", "allowed", "type", "regex", "range")}
    for spec in specs:
        raw = sc.raw(spec.name)
        raw_type = sc.raw_type[spec.name]
        typed = ty.column(spec.name)
        parts["required"].append(R.required(spec, raw, raw_type))
        parts["allowed"].append(R.allowed_values(spec, raw, raw_type))
        parts["type"].append(R.type_check(spec, raw, raw_type, typed))
        parts["type"].append(R.scale_check(spec, raw, raw_type, typed))
        if spec.regex:
            R.check_pattern(spec.regex, spec.name, sc.df.sparkSession)
        parts["regex"].append(R.regex(spec, raw, raw_type))
        parts["range"].extend(R.ranges(spec, raw, raw_type, typed))
    checks = [c for k in ("required", "allowed", "type", "regex", "range") for c in parts[k] if c is not None]
    sql_of = _sql_of(sc)
    if contract.rule_errors == "fail":
        checks.extend(R.business(rule, sql_of) for rule in rules)
    else:
        for i, rule in enumerate(rules):
            checks.extend(R.business_tried(rule, F.col(f"{TRIED}.r{i}"), sql_of, contract.rule_errors == "flag"))
    return checks


def _missing(df: DataFrame, contract: Contract, on_missing: str) -> DataFrame:
    missing = [c for c in contract.column_names if c not in df.columns]
    if not missing:
        return df
    if on_missing == "null_fill":
        return df.select("*", *[F.lit(None).cast("string").alias(c) for c in missing])
    raise ContractError(f"columns missing from data: {missing}")


def with_contract_columns(df: DataFrame, contract: Contract, on_missing: str) -> DataFrame:
    """``df`` with the contract's columns under its spelling."""
    return _missing(_own_names(df, contract), contract, on_missing)


def evaluate(
    df: DataFrame,
    contract,
    *,
    as_of=None,
    unique_strategy: str = "aggregate",
    include_unique: bool = True,
    reject_malformed: bool = False,
    on_missing: str = "fail",
    hot_key_rows: int = K.DEFAULT_HOT_KEY_ROWS,
    max_hot_keys: int = K.DEFAULT_MAX_HOT_KEYS,
    key_totals: DataFrame | None = None,
) -> DataFrame:
    """Judge every row of ``df`` against ``contract``.

    Row count and input columns are preserved; see module doc for the added
    columns.  ``as_of`` is the date business rules see as ``as_of`` (one
    literal per call, today in the session's time zone by default, so every
    action of a run agrees on it).  ``key_totals`` (``rule, digest, n``) are counts of
    dataset keys made elsewhere (:mod:`rowgate.operators.key_state`); such keys are
    not counted on ``df``.  Columns that differ from the contract's
    names in case only come out under the contract's spelling.
    """
    contract = Contract.load(contract)
    df = with_contract_columns(df, contract, on_missing)
    original = list(df.columns)

    flags: list[tuple] = []
    # A file is identified by its full path when the reader recorded it (two
    # files may share a base name in different folders).
    file_id = contract.file_column
    if file_id == "_source_file" and "_source_path" in df.columns:
        file_id = "_source_path"
    if include_unique:
        flags = [(key, f"__dup{i}") for i, key in enumerate(contract.unique_keys)]
        elsewhere = [(key, flag) for key, flag in flags if key_totals is not None and key.scope == SCOPE_DATASET]
        df = K.flag_all(df, [(K.key_columns(key, file_id), flag, key.hashed, key.null_keys) for key, flag in flags if (key, flag) not in elsewhere],
                        strategy=unique_strategy, hot_key_rows=hot_key_rows, max_hot_keys=max_hot_keys)
        for key, flag in elsewhere:
            df = K.flag_counted(df, key_state.digest(df, key), key_totals.where(F.col("rule") == key_state.rule_id(key)).select("digest", "n"), flag,
                                hot_key_rows=hot_key_rows, max_hot_keys=max_hot_keys)

    sc = _Scope(df, contract, as_of)
    scope = sc.df
    rules, _ = check_rules(scope, contract)
    if rules and contract.rule_errors != "fail":
        scope = scope.withColumn(TRIED, R.tried(rules, scope.sparkSession))
    checks = row_checks(sc, contract, rules)
    checks.extend(R.duplicate(key, F.col(flag)) for key, flag in flags)
    if reject_malformed and "_malformed" in scope.columns:
        checks.append(R.when_violated(F.col("_malformed"), "malformed", None, "malformed",
                                      F.lit(M.MALFORMED)))

    out = [sc.raw(c).alias(c) if c in sc.raw_name else ty.column(c) for c in original]
    flagged = scope.withColumn("__flags", R.flags(checks))
    # the flags are read twice, so Spark keeps them in a projection of their own
    verdict = flagged.select(*out, R.collect(F.col("__flags"), checks).alias("violations"),
                             R.is_clean(F.col("__flags")).alias("__valid"))
    return verdict.select(*[ty.column(c) for c in original], "violations",
                          R.reasons(F.col("violations")).alias("rejection_reasons"), F.col("__valid").alias("is_valid"))


def evaluate_rows(df: DataFrame, contract, *, as_of=None, reject_malformed: bool = False,
                  on_missing: str = "fail") -> DataFrame:
    """Stateless rules only (R1-R14): no shuffle, so it also runs on streams."""
    return evaluate(df, contract, as_of=as_of, include_unique=False,
                    reject_malformed=reject_malformed, on_missing=on_missing)


def rule_catalog(df: DataFrame, contract) -> DataFrame:
    """One row per rule the contract applies to ``df``, in verdict
    order, with its check status (``ok`` / ``skipped``).  Built on the driver
    from the contract and the schema only; no job reads data."""
    contract = Contract.load(contract)
    filled = _missing(_own_names(df, contract), contract, "null_fill")
    scope = _scope(filled, contract, None)
    _, statuses = check_rules(scope, Contract.from_dict({**contract.raw, "on_bad_rule": "skip"}))
    by_name = {s.name: s for s in statuses}
    raw_type = {c: filled.schema[c].dataType for c in contract.column_names}
    rows = []

    def add(kind, column, rule, detail, status="ok", note=""):
        rows.append((len(rows) + 1, kind, column, rule, detail, status, note))

    for c in contract.columns:
        if c.required:
            add("required", c.name, "required", None)
    for c in contract.columns:
        if c.allowed_values:
            add("allowed_values", c.name, "allowed_values", c.allowed_text)
    for c in contract.columns:
        if ty.needs_cast(raw_type[c.name], c.type):
            add("type", c.name, f"type:{ty.canonical(c.type)}", c.type)
        if c.strict_scale and (ty.canonical(c.type) or "").startswith("decimal"):
            add("type", c.name, "strict_scale", c.type)
    for c in contract.columns:
        if c.regex:
            add("regex", c.name, "regex", c.regex)
    for c in contract.columns:
        if c.min_value is not None:
            add("range", c.name, "min_value", str(c.min_value))
        if c.max_value is not None:
            add("range", c.name, "max_value", str(c.max_value))
    for r in contract.business_rules:
        s = by_name[r.name]
        text = r.assert_sql if not r.condition else f"{r.condition} => {r.assert_sql}"
        add("business_rule", None, r.name, text, s.status, s.detail)
    for k in contract.unique_keys:
        add("unique", ",".join(k.columns), k.rule, k.scope)
    return df.sparkSession.createDataFrame(
        rows, "position int, kind string, column string, rule string, detail string, status string, note string")


def rule_hits(catalog: DataFrame, verdict: DataFrame, errors: bool = False) -> DataFrame:
    """The catalog with each rule's violation count over a verdict frame, and with
    ``errors`` the rows on which a business rule could not be evaluated.

    The counts are one aggregation over the data (map-side partial); both
    sides of the join hold at most one row per contract rule, so the
    broadcast is bounded by the contract's size."""
    from .route import summary_by_rule

    failed = F.col("kind") == "rule_error"
    counted = [F.sum(F.when(~failed, F.col("violations"))).alias("violations"), F.sum(F.when(failed, F.col("violations"))).alias("errors")]
    hits = (summary_by_rule(verdict)
            .groupBy(F.when(failed, "business_rule").otherwise(F.col("kind")).alias("h_kind"), F.col("column").alias("h_column"),
                     F.col("rule").alias("h_rule")).agg(*counted))
    on = ((catalog["kind"] == hits["h_kind"]) & catalog["column"].eqNullSafe(hits["h_column"])
          & (catalog["rule"] == hits["h_rule"]))
    return (catalog.join(F.broadcast(hits), on, "left")
            .select(*catalog.columns, *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("violations", *(["errors"] if errors else []))]))
