"""Schema drift by content (D1-D3): which unexpected column is which missing one.

A renamed column shows as one missing and one unexpected name.  Here the columns that
a table lacks are compared by their values with those that it has too many: both
tables are read once, each value of such a column is folded to one row of
``(value, column)``, and columns that share a value are counted where they meet.  A
missing and an unexpected column are taken for the same where each is the other's
nearest by the Jaccard similarity of their distinct values, and it is high enough.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import types as ty
from ..sources.delimited import drift_rows

#: Least similarity of a rename.
SIMILAR = 0.5


def content_drift(df: DataFrame, before: DataFrame, contract, similar: float = SIMILAR) -> DataFrame:
    """One row for every missing or unexpected column of ``df``: ``column, drift, rows,
    non_null, distinct, renamed, similarity``.

    Missing columns are counted in ``before``, an earlier table of the contract that has
    them; ``renamed`` is the other name, null where there is none.
    """
    found = drift_rows(df.columns, contract)
    missing = [c for c, kind in found if kind == "missing" and c in before.columns]
    unexpected = [c for c, kind in found if kind == "unexpected"]
    sides = [(before, missing, "missing"), (df, unexpected, "unexpected")]
    frames = []
    for side, columns, kind in sides:
        if columns:
            each = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), ty.column(c).cast("string").alias("value")) for c in columns])).alias("c")
            # one row for every different value: copies are folded before the shuffle
            frames.append(side.select(each).groupBy("c.column", "c.value").agg(F.count(F.lit(1)).alias("n"))
                          .select("column", F.lit(kind).alias("drift"), "value", "n"))
    if not frames:
        return df.sparkSession.createDataFrame([], "column string, drift string, rows long, non_null long, distinct long, renamed string, similarity double")
    values = reduce(DataFrame.unionByName, frames)
    there = F.col("value").isNotNull()
    profile = values.groupBy("column", "drift").agg(
        F.sum("n").alias("rows"), F.coalesce(F.sum(F.when(there, F.col("n"))), F.lit(0)).cast("long").alias("non_null"),
        F.count_if(there).alias("distinct"))
    # the columns that hold a value: at most as many as the contract and the table have
    meet = values.where(there).groupBy("value").agg(
        F.collect_list(F.when(F.col("drift") == "missing", F.col("column"))).alias("m"),
        F.collect_list(F.when(F.col("drift") == "unexpected", F.col("column"))).alias("u"))
    shared = (meet.select(F.explode("m").alias("m"), "u").select("m", F.explode("u").alias("u"))
              .groupBy("m", "u").agg(F.count(F.lit(1)).alias("both")))
    sizes = profile.select(F.col("column").alias("name"), F.col("drift").alias("of"), "distinct")
    pairs = (shared.join(sizes.where("of = 'missing'").select(F.col("name").alias("m"), F.col("distinct").alias("dm")), "m")
             .join(sizes.where("of = 'unexpected'").select(F.col("name").alias("u"), F.col("distinct").alias("du")), "u")
             .withColumn("similarity", F.col("both") / (F.col("dm") + F.col("du") - F.col("both"))).where(F.col("similarity") >= similar))
    # each the other's nearest: one row for a pair of columns, not of values
    for mine, other in (("m", "u"), ("u", "m")):
        pairs = pairs.withColumn(f"best_{mine}", F.row_number().over(Window.partitionBy(mine).orderBy(F.desc("similarity"), other)))
    pairs = pairs.where("best_m = 1 and best_u = 1")
    names = (pairs.select(F.col("m").alias("column"), F.lit("missing").alias("drift"), F.col("u").alias("renamed"), "similarity")
             .unionByName(pairs.select(F.col("u").alias("column"), F.lit("unexpected").alias("drift"), F.col("m").alias("renamed"), "similarity")))
    return profile.join(names, ["column", "drift"], "left").select(*profile.columns, "renamed", "similarity")
