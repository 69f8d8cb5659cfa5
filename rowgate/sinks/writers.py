"""Writers (K1-K5): how rows are dealt into files, and single CSV files.

Rows go to files by a rebalancing shuffle on the folder columns: Spark joins small
folders' rows in one task and splits a large folder (a hot date or file) over
several, both by the sizes that the shuffle itself has measured
(``spark.sql.adaptive.advisoryPartitionSizeInBytes``).  Nothing is counted before.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..functions import types as ty


def packed(df: DataFrame, folders: list[str], order: str | None = None) -> DataFrame:
    """Rows dealt into tasks of about equal bytes, those of a folder together; within
    a file by ``order``, so that a filter on it reads few pages."""
    columns = [ty.column(c) for c in folders]
    out = df.hint("rebalance", *columns)
    return out.sortWithinPartitions(*columns, ty.column(order)) if order else out


def write_csv_file(df: DataFrame, path: str) -> None:
    """K3: the whole of a small table as one CSV file with a header (one task writes
    it; what comes before still runs in parallel)."""
    df.repartition(1).write.mode("overwrite").format("csv").option("header", "true").save(path)
