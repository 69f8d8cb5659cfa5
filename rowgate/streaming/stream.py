"""Contract checks on streaming DataFrames.

Row rules (required, allowed values, types, patterns, ranges, business
rules) are stateless projections, so :func:`evaluate_rows` applies to a
``readStream`` frame unchanged.  Uniqueness needs state across batches:
:func:`route_stream_with_keys` keeps it.  Elsewhere a contract with unique keys is
refused, unless the caller says that its keys are checked elsewhere
(``ignore_unique=True``).

:func:`route_stream` writes every micro-batch to silver and quarantine from one
evaluation.  Each batch lands in its own ``_batch=<id>`` partition with dynamic
overwrite, so a batch replayed after a failure replaces its own output instead
of appending it twice; progress lives in the checkpoint folder (shared
storage).  Without a given date, rules see the date on which a batch runs.

:func:`route_stream_with_keys` makes every micro-batch a run of the job
(:mod:`rowgate.plans.job`) whose run key is the batch's number: the outputs, and the
key state with them, change by one commit a batch.  A key that a later batch brings
again flags the row of the earlier batch too, which moves from silver to quarantine in
that commit, so however the rows are split into batches, the outputs are those of one
batch run over all of them.  A batch that is replayed replaces what it gave before.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..contract import Contract, ContractError
from ..operators import route
from ..operators.evaluate import evaluate_rows
from ..plans.job import run
from ..sinks.versions import Outputs

#: The run key of a stream: the number of the micro-batch.
BATCH = "_batch"


def _without_keys(contract, ignore_unique: bool) -> Contract:
    contract = Contract.load(contract)
    if contract.unique_keys and not ignore_unique:
        raise ContractError("uniqueness can't be checked on a stream; pass ignore_unique=True to leave it out")
    return contract


def validate_stream(stream: DataFrame, contract, *, as_of=None, ignore_unique: bool = False) -> DataFrame:
    """Verdict columns on a stream (R1-R14; no uniqueness)."""
    return evaluate_rows(stream, _without_keys(contract, ignore_unique), as_of=as_of)


def route_stream(stream: DataFrame, contract, output_dir: str, checkpoint: str, *, as_of=None,
                 ignore_unique: bool = False, trigger: dict | None = None) -> StreamingQuery:
    contract = _without_keys(contract, ignore_unique)

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        tagged = evaluate_rows(batch, contract, as_of=as_of).withColumn("_batch", F.lit(batch_id))
        tagged.persist()
        try:
            for name, part in (("silver", route.silver(tagged, contract)),
                               ("quarantine", route.quarantine(tagged, contract))):
                part = part if "_batch" in part.columns else part.withColumn("_batch", F.lit(batch_id))
                (part.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
                 .partitionBy("_batch").parquet(f"{output_dir}/{name}"))
        finally:
            tagged.unpersist()

    writer = stream.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
    if trigger:
        writer = writer.trigger(**trigger)
    return writer.start()


def route_stream_with_keys(stream: DataFrame, contract, output_dir: str, checkpoint: str, *, as_of=None, trigger: dict | None = None,
                           compact_every: int = 100, **run_kw) -> StreamingQuery:
    """Every micro-batch routed with its dataset keys judged over all batches so far.

    Read the outputs with ``Outputs(spark, output_dir)``; after ``compact_every`` batches
    small files of earlier ones are packed.
    """
    contract = Contract.load(contract)

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if batch.isEmpty():
            return
        run(spark, batch.withColumn(BATCH, F.lit(batch_id).cast("long")), output_dir, contract, as_of=as_of, overwrite="dynamic",
            keys_across_runs=True, key_column=BATCH, **run_kw)
        if batch_id % compact_every == compact_every - 1:
            Outputs(spark, output_dir).compact()

    writer = stream.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
    if trigger:
        writer = writer.trigger(**trigger)
    return writer.start()
