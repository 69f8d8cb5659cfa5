"""Routing of a verdict frame (F1-F4, F7): silver, quarantine, report, summaries.

All functions are lazy projections/filters/aggregations over the output of
:func:`rowgate.operators.evaluate.evaluate`; none of them shuffles rows
except the summaries, which aggregate with map-side partial aggregation.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..contract import Contract

VERDICT_COLUMNS = ("violations", "rejection_reasons", "is_valid")


def _contract_columns(v: DataFrame, contract) -> list[str]:
    if contract is None:
        return [c for c in v.columns if not c.startswith("_") and c not in VERDICT_COLUMNS]
    return [c for c in Contract.load(contract).column_names if c in v.columns]


def silver(v: DataFrame, contract=None, *, typed: bool = False, extra: tuple[str, ...] = ()) -> DataFrame:
    """valid rows, contract columns only (metadata dropped).

    ``typed=True`` returns the values under their declared types - safe
    because every typed cast succeeded on a valid row.  ``extra`` columns are
    kept besides the contract's.
    """
    cols = _contract_columns(v, contract)
    extra = [c for c in extra if c not in cols]
    rows = v.where(F.col("is_valid"))
    if not typed or contract is None:
        return rows.select(*cols, *extra)
    from ..functions import types as ty

    c = Contract.load(contract)
    out = []
    for name in cols:
        spec = c.column(name)
        out.append(ty.typed(F.col(name), v.schema[name].dataType, spec.type).alias(name))
    return rows.select(*out, *extra)


def quarantine(v: DataFrame, contract=None, *, extra: tuple[str, ...] = ()) -> DataFrame:
    """invalid rows with their reasons and lineage columns."""
    cols = _contract_columns(v, contract)
    keep = [c for c in ("rejection_reasons", "violations", *extra) if c in v.columns and c not in cols]
    meta = [c for c in v.columns if c.startswith("_") and c not in cols and c not in keep]
    return v.where(~F.col("is_valid")).select(*cols, *keep, *meta)


def report(v: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """one row per violation (struct explode, so a ``|`` inside a message
    never splits it).  ``keep`` lists identifying columns to carry along."""
    keep = [c for c in (keep or []) if c in v.columns]
    return (_exploded(v, keep)
            .select(*keep, "violation_index",
                    F.col("v.kind").alias("kind"), F.col("v.column").alias("column"),
                    F.col("v.rule").alias("rule"), F.col("v.message").alias("violation")))


def _exploded(v: DataFrame, keep: list[str]) -> DataFrame:
    """One row per violation.  The outer explode and the filter *above* it keep
    Spark from inferring a size filter that it would push below the verdict,
    which would then be evaluated twice."""
    return (v.select(*keep, F.posexplode_outer("violations").alias("violation_index", "v"))
            .where(F.col("violation_index").isNotNull()))


def summary_by_rule(v: DataFrame, *by: str) -> DataFrame:
    """violations per (kind, column, rule), and per ``by`` columns."""
    return (_exploded(v, list(by))
            .groupBy(*by, F.col("v.kind").alias("kind"), F.col("v.column").alias("column"),
                     F.col("v.rule").alias("rule"))
            .agg(F.count(F.lit(1)).alias("violations")))


def summary_by(v: DataFrame, *by: str) -> DataFrame:
    """rows, valid, invalid and violation counts per group (e.g. file, date)."""
    return v.groupBy(*by).agg(*_count_exprs())


LEVELS = ("kind", "column", "rule")


def summary_levels(v: DataFrame, *by: str) -> DataFrame:
    """all levels of a summary in one pass: in total, for each of the ``by``
    columns, for each rule, and for each rule within each ``by`` column.

    ``level`` names the columns that a row is grouped by (the others are null there, as
    they may be in the data).  A row of the verdict is exploded to its violations once;
    its first one, or none, stands for the row, so rows and violations come from the same
    grouping sets.  Rule levels count rows that break the rule.  The results of parts of
    a table add up: ``merge_levels``.
    """
    rows = v.select(*by, "is_valid", F.posexplode_outer("violations").alias("at", "v")).select(
        *by, "is_valid", *[F.col(f"v.{c}").alias(c) for c in LEVELS], (F.coalesce("at", F.lit(0)) == 0).alias("one"), F.col("v").isNotNull().alias("hit"))
    sets = [[], *[[b] for b in by], list(LEVELS), *[[b, *LEVELS] for b in by]]
    names = [*by, *LEVELS]
    grouped = rows.groupingSets([[F.col(f"`{c}`") for c in s] for s in sets], *[F.col(f"`{c}`") for c in names]).agg(
        F.grouping_id().alias("gid"), F.count_if("one").alias("rows"), F.count_if(F.col("one") & F.col("is_valid")).alias("valid_rows"),
        F.count_if("hit").alias("violations"))
    # a bit of the id for each name, set where the level leaves it out
    level = F.lit(None).cast("string")
    for s in sets:
        gid = int("".join("0" if c in s else "1" for c in names), 2)
        level = F.when(F.col("gid") == gid, ",".join(s)).otherwise(level)
    out = grouped.withColumn("level", level)
    of_rule = F.col("level").endswith("rule")
    return (out.where(~of_rule | F.col("kind").isNotNull())  # rows without a violation belong to no rule
            .select("level", *names, F.when(~of_rule, F.col("rows")).alias("rows"), F.when(~of_rule, F.col("valid_rows")).alias("valid_rows"), "violations"))


def merge_levels(parts: DataFrame) -> DataFrame:
    """Sums of :func:`summary_levels` of several parts of a table."""
    counts = ("rows", "valid_rows", "violations")
    return parts.groupBy(*[c for c in parts.columns if c not in counts]).agg(*[F.sum(c).alias(c) for c in counts])


def stage_counts(v: DataFrame) -> DataFrame:
    """one-row totals in a single aggregation pass."""
    return v.agg(*_count_exprs(v))


def _count_exprs(v: DataFrame | None = None):
    exprs = [
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col("is_valid")).alias("valid_rows"),
        F.count_if(~F.col("is_valid")).alias("invalid_rows"),
        F.sum(F.size("violations")).cast("long").alias("violations"),
    ]
    if v is not None and "_delimiter_issue" in v.columns:
        exprs.append(F.count_if(F.col("_delimiter_issue")).alias("repaired_rows"))
    return exprs
