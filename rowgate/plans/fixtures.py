"""Driver-table fixtures: the clean TPC-H-style tables with planted defects.

``dirty_orders`` derives a payments-like feed from *every* row of ``orders``
(no row is filtered out); key residues only decide which rows get a defect.
The same projection is written in DuckDB SQL in :mod:`rowgate.plans.oracle`.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..contract import Contract

# Fixed value: the date the bundled fixture contracts treat as "today".
AS_OF = _dt.date(2020, 1, 1)

# The five order priorities of the driver tables.
PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _every(k: Column, n: int) -> Column:
    return (k % n) == 0


def dirty_orders(spark: SparkSession, sf_dir: str, *, with_year: bool = False) -> DataFrame:
    return dirty_orders_from(table(spark, sf_dir, "orders"), with_year=with_year)


def orders_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ``orders`` table as a file stream (a glob, since the table is one file)."""
    schema = table(spark, sf_dir, "orders").schema
    return spark.readStream.schema(schema).parquet(f"{sf_dir}/orders.parque[t]")


def write_orders_part(orders: DataFrame, number: int, parts: int, out_dir: str) -> None:
    """Add one of ``parts`` parts of the orders, by their keys, to a folder: no task gets more
    rows than the session's advisory size holds (null keys are in the first part)."""
    part = F.coalesce(F.pmod("o_orderkey", F.lit(parts)), F.lit(0))
    orders.where(part == number).hint("rebalance").write.mode("append").parquet(out_dir)


def dirty_orders_from(o: DataFrame, *, with_year: bool = False) -> DataFrame:
    """The feed projection over an ``orders`` frame (batch or streaming)."""
    extra = [F.year("o_orderdate").alias("order_year")] if with_year else []
    k = F.col("o_orderkey")
    day = F.to_date("o_orderdate")
    day_text = day.cast("string")
    return o.select(
        k.alias("order_key"),
        F.when(_every(k, 101), F.lit(None).cast("string"))
        .when(_every(k, 103), F.lit(" "))
        .when(_every(k, 53), F.concat(F.lit("K"), (k - 1).cast("string"), F.lit(" ")))
        .otherwise(F.concat(F.lit("K"), k.cast("string"))).alias("record_id"),
        F.when(_every(k, 97), F.lit("noon on day 41"))
        .when(_every(k, 89), F.date_add(day, 9).cast("string"))
        .otherwise(day_text).alias("event_ts"),
        F.when(_every(k, 83), F.lit("2021-13-01"))
        .when(_every(k, 79), F.lit("2044-07-09"))
        .otherwise(day_text).alias("business_date"),
        F.when(_every(k, 73), F.lower("o_orderpriority"))
        .otherwise(F.col("o_orderpriority")).alias("source_system"),
        F.when(_every(k, 71), F.concat(F.lit(" "), F.col("o_orderstatus")))
        .when(_every(k, 67), F.lit("?"))
        .otherwise(F.col("o_orderstatus")).alias("status"),
        F.when(_every(k, 61), F.lit("12,5 EUR"))
        .when(_every(k, 59), F.lit("-0.75"))
        .when(_every(k, 47), F.lit("0.00"))
        .when(_every(k, 43), F.lit(None).cast("string"))
        .otherwise(F.col("o_totalprice").cast("decimal(18,2)").cast("string")).alias("amount"),
        F.when(_every(k, 41), F.lit("Z9"))
        .when(_every(k, 37), F.lit(" "))
        .otherwise(F.lit("US")).alias("country_code"),
        F.when((F.col("o_custkey") % 2) == 0, F.lit("f0")).otherwise(F.lit("f1")).alias("source_file"),
        *extra,
    )


# Column order of the dirty-orders feed (also its CSV header).
FEED_COLUMNS = ["order_key", "record_id", "event_ts", "business_date", "source_system", "status",
                "amount", "country_code", "source_file"]

FEED_CONTRACT = {
    "dataset": "orders_feed",
    "version": "1",
    "file_column": "source_file",
    "schema": [
        {"name": "order_key", "type": "bigint"},
        {"name": "record_id", "type": "string", "required": True, "unique": True},
        {"name": "event_ts", "type": "timestamp", "required": True},
        {"name": "business_date", "type": "date", "required": True},
        {"name": "source_system", "type": "string", "required": True, "allowed_values": PRIORITIES},
        {"name": "status", "type": "string", "required": True, "allowed_values": ["F", "O", "P"]},
        {"name": "amount", "type": "decimal(18,2)", "required": True, "min_value": 0},
        {"name": "country_code", "type": "string", "required": True, "regex": "^[A-Z]{2}$"},
        {"name": "source_file", "type": "string"},
    ],
    "business_rules": [
        {"name": "final_amount_positive", "condition": "upper(trim(status)) = 'F'",
         "assert": "amount > 0", "message": "amount must be > 0 when status=F"},
        {"name": "event_ts_near_business_date",
         "assert": "abs(datediff(to_date(event_ts), business_date)) <= 7",
         "message": "event_ts {event_ts} is more than 7 days from business_date {business_date}"},
        {"name": "business_date_not_far_future", "assert": "business_date <= date_add(as_of, 1)",
         "message": "business_date {business_date} is more than 1 day in the future"},
    ],
}


def feed_contract(**overrides) -> Contract:
    return Contract.from_dict({**FEED_CONTRACT, **overrides})


def feed_subset(*, columns=None, rules=None, unique=False, within_file=False) -> Contract:
    """The feed contract cut down to some column rules / business rules."""
    schema = []
    for c in FEED_CONTRACT["schema"]:
        c = dict(c)
        if not unique:
            c.pop("unique", None)
        if columns is not None:
            keep = columns.get(c["name"], ())
            for rule in ("required", "allowed_values", "regex", "min_value", "max_value"):
                if rule not in keep:
                    c.pop(rule, None)
            if "type" not in keep and c["name"] != "order_key":
                c["type"] = "string"
        if within_file and c["name"] == "record_id":
            c["unique_within_file"] = True
        schema.append(c)
    brules = [r for r in FEED_CONTRACT["business_rules"] if rules and r["name"] in rules]
    return Contract.from_dict({**FEED_CONTRACT, "schema": schema, "business_rules": brules})


# ------------------------------------------------------------ text feed files
# Which separator / defect a feed line gets, by key residue.
PIPE_RESIDUE, SEMI_RESIDUE, SEP_MODULUS = 3, 5, 7
EXTRA_FIELD_MODULUS = 29
# Header of the 1997 folder in the drift fixture: two columns swapped, one renamed.
DRIFT_YEAR = 1997


def _field(text: Column, sep: Column) -> Column:
    """A field as it stands in a line: in quotes where it holds one, or the line's separator."""
    quoted = F.concat(F.lit('"'), F.regexp_replace(text, '"', '""'), F.lit('"'))
    return F.when(F.contains(text, F.lit('"')) | F.contains(text, sep), quoted).otherwise(text)


# Rows with keys of this modulus reach the files of the year after their own.
LATE_MODULUS = 11


# Year whose rows carry the ids of the next order but one, in the fixture of other ids.
OTHER_IDS_YEAR, OTHER_IDS_STEP = 1996, 2


def feed_lines(spark: SparkSession, sf_dir: str, *, late: bool = False, other_ids: bool = False) -> DataFrame:
    """Every feed row as one delimited line, with the folder it belongs to."""
    d = dirty_orders(spark, sf_dir, with_year=True)
    k = F.col("order_key")
    if other_ids:
        d = d.withColumn("record_id", F.when(F.col("order_year") == OTHER_IDS_YEAR, F.concat(F.lit("K"), (k + OTHER_IDS_STEP).cast("string")))
                         .otherwise(F.col("record_id")))
    sep = (F.when(k % SEP_MODULUS == PIPE_RESIDUE, F.lit("|"))
           .when(k % SEP_MODULUS == SEMI_RESIDUE, F.lit(";")).otherwise(F.lit(",")))
    texts = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in FEED_COLUMNS]
    d = d.select(*texts, k.alias("__key"), "order_year", sep.alias("__sep"))
    k = F.col("__key")
    # fields in an array, and one expression for all of them: spelled out for each, they make a
    # generated method so long that the JVM doesn't compile it
    fields = F.transform(F.array(*FEED_COLUMNS), lambda text: _field(text, F.col("__sep")))
    line = F.call_function("concat_ws", F.col("__sep"), fields)
    line = F.when(k % EXTRA_FIELD_MODULUS == 0, F.concat(line, F.col("__sep"), F.lit("EXTRA"))).otherwise(line)
    year = F.col("order_year") + F.when((k % LATE_MODULUS == 0) & F.lit(late), 1).otherwise(0)
    return d.select(F.concat(F.lit("orders_"), year.cast("string"), F.lit("-01-01")).alias("folder"),
                    line.alias("value"))


# Writer options that emit each line verbatim: a single column, with a field
# separator and quote character that never occur in the lines.
_VERBATIM = {"sep": "\u0001", "quote": "\u0002", "escapeQuotes": "false",
             "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


def _write_lines(lines: DataFrame, out_dir: str, header: str, mode: str) -> None:
    # The CSV writer puts the header (the column's name) at the top of every
    # file it writes, so tasks write their own files: no per-folder shuffle.
    (lines.select("folder", F.col("value").alias(header))
     .write.mode(mode).options(header="true", **_VERBATIM).partitionBy("folder").csv(out_dir))


def write_feed_files(spark: SparkSession, sf_dir: str, out_dir: str, *, drift: bool = False, late: bool = False, other_ids: bool = False) -> str:
    """Write the feed as text, one folder per order year (``orders_<yyyy>-01-01``),
    every file starting with a header line.  With ``drift`` the files of one
    year carry a header with two columns swapped and one renamed; with ``late``
    some rows come in the files of the next year; with ``other_ids`` one year's rows
    carry other rows' ids.  Returns ``out_dir``."""
    lines = feed_lines(spark, sf_dir, late=late, other_ids=other_ids)
    header = ",".join(FEED_COLUMNS)
    if not drift:
        _write_lines(lines, out_dir, header, "overwrite")
        return out_dir
    swapped = list(FEED_COLUMNS)
    i, j = swapped.index("source_system"), swapped.index("status")
    swapped[i], swapped[j] = swapped[j], swapped[i]
    swapped[swapped.index("amount")] = "amt"
    odd = F.col("folder") == f"orders_{DRIFT_YEAR}-01-01"
    _write_lines(lines.where(~odd), out_dir, header, "overwrite")
    _write_lines(lines.where(odd), out_dir, ",".join(swapped), "append")
    return out_dir


def write_plain_lines(lines: DataFrame, out_dir: str, header: str | None) -> str:
    """``value`` rows as text files, with a header line each or none."""
    if header is None:
        lines.select("value").write.text(out_dir)
    else:
        lines.select(F.col("value").alias(header)).write.options(header="true", **_VERBATIM).csv(out_dir)
    return out_dir
