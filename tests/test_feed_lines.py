"""Lines of the text feed: their fields, and code that the JVM compiles."""

import contextlib
import csv
import io
import re

from pyspark.sql import functions as F

from rowgate.plans import fixtures as fx


def _orders(spark, scratch):
    rows = [(i, i % 7, "O" if i % 3 else "F", i + 0.5, p) for i, p in zip(range(420), ["1-URGENT", "a,b", 'say "x"', "c|d;e", '";', None] * 70)]
    df = spark.createDataFrame([*rows, (None, 1, "O", 1.0, "5-LOW")], "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderpriority string")
    df.withColumn("o_orderdate", F.lit("1996-05-01").cast("timestamp_ntz")).write.parquet(f"{scratch}/orders.parquet")


def test_lines_hold_the_fields(spark, scratch):
    _orders(spark, scratch)
    want = {r.order_key: [("" if v is None else str(v)) for v in r] for r in fx.dirty_orders(spark, scratch).select(*fx.FEED_COLUMNS).collect()}
    lines = [r.value for r in fx.feed_lines(spark, scratch).collect()]
    assert len(lines) == len(want) == 421
    for line in lines:
        key = int(re.match(r"\d+", line).group()) if line[0].isdigit() else None
        sep = "|" if key is not None and key % 7 == 3 else ";" if key is not None and key % 7 == 5 else ","
        fields = next(csv.reader([line], delimiter=sep))
        extra = ["EXTRA"] if key is not None and key % 29 == 0 else []
        assert fields == want[key] + extra


def test_line_code_is_short_enough_to_be_compiled(spark, scratch):
    _orders(spark, scratch)
    for kw in ({}, {"late": True}, {"other_ids": True}):
        shown = io.StringIO()
        with contextlib.redirect_stdout(shown):
            fx.feed_lines(spark, scratch, **kw).explain("codegen")
        sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", shown.getvalue())]
        assert sizes and max(sizes) <= 8000  # the JVM interprets longer methods
