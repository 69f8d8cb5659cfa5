"""Stateless rules on a stream; micro-batches routed idempotently."""

import datetime as dt
import os

import pytest
from pyspark.sql import types as T

from rowgate.contract import ContractError
from rowgate.streaming.stream import route_stream, validate_stream
from tests import feed_files
from tests.conftest import CONTRACT

SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in feed_files.HEADER.split(",")])


def test_stream_routes_batches(spark, scratch):
    src = feed_files.write(os.path.join(scratch, "in"), {"payments_2026-03-03.csv": feed_files.FILES[
        "payments_2026-03-03.csv"]})
    stream = spark.readStream.schema(SCHEMA).option("header", "true").csv(src)
    with pytest.raises(ContractError):
        validate_stream(stream, CONTRACT)
    assert validate_stream(stream, CONTRACT, ignore_unique=True).isStreaming
    out = os.path.join(scratch, "out")
    q = route_stream(stream, CONTRACT, out, os.path.join(scratch, "ckpt"), as_of=dt.date(2026, 4, 1),
                     ignore_unique=True, trigger={"availableNow": True})
    q.awaitTermination(120)
    assert spark.read.parquet(f"{out}/silver").count() == 3
    assert spark.read.parquet(f"{out}/quarantine").count() == 2


def test_keys_over_micro_batches_in_any_split(spark, scratch):
    """However rows come in batches, the outputs are those of one run over all; a late
    twin moves the earlier row to quarantine."""
    from rowgate.plans.job import run
    from rowgate.sinks.versions import Outputs
    from rowgate.streaming.stream import route_stream_with_keys

    contract = {"schema": [{"name": "id", "required": True, "unique": True}, {"name": "x", "type": "int", "max_value": 8}]}
    schema = "id string, x string"
    rows = [("a", "1"), ("b", "2"), ("c", "9"), ("a ", "3"), ("d", "4"), ("b", "5"), (None, "6"), ("e", "y"), ("f", "7")]
    outputs = []
    for n, split in enumerate(([3, 3, 3], [1, 7, 1])):
        src, out = os.path.join(scratch, f"in{n}"), os.path.join(scratch, f"out{n}")
        at = 0
        for k, size in enumerate(split):  # one file a batch, in order of their times
            spark.createDataFrame(rows[at:at + size], schema).coalesce(1).write.mode("append").parquet(f"{src}/p={k}")
            at += size
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(src)
        query = route_stream_with_keys(stream, contract, out, f"{out}-checkpoint", as_of="2026-01-01", trigger={"availableNow": True}, silver_partition=None)
        query.awaitTermination()
        assert query.exception() is None
        outs = Outputs(spark, out)
        outputs.append((sorted((r.id, r.x) for r in outs.read("silver").collect()),
                        sorted((str(r.id), r.x, r.rejection_reasons) for r in outs.read("quarantine").collect())))
    whole = os.path.join(scratch, "whole")
    run(spark, spark.createDataFrame(rows, schema), whole, contract, as_of="2026-01-01", silver_partition=None)
    outs = Outputs(spark, whole)
    want = (sorted((r.id, r.x) for r in outs.read("silver").collect()),
            sorted((str(r.id), r.x, r.rejection_reasons) for r in outs.read("quarantine").collect()))
    assert outputs[0] == outputs[1] == want and [i for i, _ in want[0]] == ["d", "f"]
    # a batch that is replayed replaces what it gave
    out = os.path.join(scratch, "replayed")
    batch = lambda k, *some: spark.createDataFrame([(*r, k) for r in some], schema + ", _batch long")
    for k, some in ((0, rows[:4]), (1, rows[4:]), (1, rows[4:]), (0, rows[:4])):
        run(spark, batch(k, *some), out, contract, as_of="2026-01-01", silver_partition=None, overwrite="dynamic", keys_across_runs=True, key_column="_batch")
    assert sorted((r.id, r.x) for r in Outputs(spark, out).read("silver").collect()) == want[0]


def test_thirds_of_a_stream_come_in_files_of_bounded_size(spark, scratch):
    """A third of the orders is one micro-batch, but not one file (and so one task)."""
    from pyspark.sql import functions as F

    from rowgate.plans import queries
    from rowgate.session import shared_dir

    k = F.when(F.col("id") < 8990, F.col("id"))  # the last ones are null
    spark.range(9000).select(
        k.alias("o_orderkey"), (F.col("id") % 7).alias("o_custkey"), F.lit("O").alias("o_orderstatus"), F.rand(1).alias("o_totalprice"),
        F.lit("1996-05-01").cast("timestamp_ntz").alias("o_orderdate"), F.lit("2-HIGH").alias("o_orderpriority")).write.parquet(f"{scratch}/orders.parquet")
    small = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "8k", "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1k"}
    base = shared_dir(spark)
    before = set(os.listdir(f"{base}/rowgate")) if os.path.isdir(f"{base}/rowgate") else set()
    for name, value in small.items():
        spark.conf.set(name, value)
    try:
        out = queries.stream_keys(spark, scratch)
        assert out.count() == 9000 and out.where("order_key is null").count() == 10
    finally:
        for name in small:
            spark.conf.unset(name)
    made = {n.rsplit("-", 1)[0]: f"{base}/rowgate/{n}" for n in set(os.listdir(f"{base}/rowgate")) - before}
    files = spark.read.option("recursiveFileLookup", "true").parquet(made["stream-parts"]).groupBy(F.input_file_name()).count()
    assert files.agg(F.max("count")).first()[0] < 2000
    verdict = spark.read.parquet(f"{made['stream-keys']}/run_metrics")  # a run a micro-batch
    assert verdict.count() == 3 and verdict.agg(F.sum("rows")).first()[0] == 9000
