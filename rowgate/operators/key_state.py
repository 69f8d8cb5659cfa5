"""Dataset keys across runs (R15 with K4): how often a key occurs in every file.

A run that reads some files again can't see the other files' rows, but whether a key
is a duplicate depends on them.  The *key state* remembers it: one narrow row

    (rule, digest of the normalised key, file key, n)

for every key and file, an output like the others, so a run replaces the counts of the
files it has read (what they held before is subtracted, what they hold now is added)
together with everything else, or not at all.

From the state and the counts of the files just read follow

* the total of every key, hence the flags of the rows read;
* the keys whose verdict changes in files that were *not* read: those that had one
  row there and got a twin, or lost their last one;
* the files that hold such keys.  Their stored rows are judged again in the same run,
  without reading or parsing the files themselves.

The work is a scan of the digests of the state, which Spark joins to the keys of the
files read without moving it where these are few, and the rows of files read or
changed.  Keys are compared by SHA-256 of their values.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..contract import SCOPE_DATASET, Contract, UniqueKey
from .keys import normalised

#: The output that holds the state.
NAME = "key_state"
KEY = ["rule", "digest"]


def feed_keys(contract: Contract) -> list[UniqueKey]:
    """The keys of a contract that hold for all files together."""
    return [k for k in contract.unique_keys if k.scope == SCOPE_DATASET]


def rule_id(key: UniqueKey) -> str:
    return ",".join(key.columns) + ("" if key.null_keys == "group" else f" ({key.null_keys})")


def digest(df: DataFrame, key: UniqueKey) -> Column:
    """SHA-256 of a row's key; null where the key's nulls are no duplicates."""
    parts = [normalised(df, c) for c in key.columns]
    text = F.to_json(F.struct(*[p.alias(f"k{i}") for i, p in enumerate(parts)]), {"ignoreNullFields": "false"})
    code = F.unhex(F.sha2(text, 256))
    if key.null_keys == "ignore":
        return F.when(reduce(lambda a, b: a & b, [p.isNotNull() for p in parts]), code)
    return code


def counts(df: DataFrame, keys: list[UniqueKey], file_key: str) -> DataFrame:
    """``rule, digest, n`` and the file key: all keys of a frame in one scan."""
    each = F.explode(F.array(*[F.struct(F.lit(rule_id(k)).alias("rule"), digest(df, k).alias("digest")) for k in keys]))
    rows = df.select(F.col(f"`{file_key}`").alias(file_key), each.alias("k")).where(F.col("k.digest").isNotNull())
    return rows.groupBy("k.rule", "k.digest", file_key).agg(F.count(F.lit(1)).alias("n"))


def same(file_key: str, other: str) -> Column:
    return F.col(file_key).eqNullSafe(F.col(other))


def changed_files(others: DataFrame, before: DataFrame, now: DataFrame, file_key: str) -> DataFrame:
    """File keys whose rows get another verdict.

    ``others`` is the state of the files that were not read; ``before`` and ``now`` are
    the state of those that were, as it was and as it is.
    """
    touched = (before.select(*KEY, F.col("n").alias("old"), F.lit(0).cast("long").alias("new"))
               .unionByName(now.select(*KEY, F.lit(0).cast("long").alias("old"), F.col("n").alias("new")))
               .groupBy(*KEY).agg(F.sum("old").alias("old"), F.sum("new").alias("new")).where("old <> new"))
    # what matters for a key with one row elsewhere is whether it has one here; a key
    # with more rows elsewhere stays a duplicate
    flips = touched.where((F.col("old") == 0) != (F.col("new") == 0)).select(*KEY)
    single = (others.join(flips, KEY, "left_semi").groupBy(*KEY)
              .agg(F.sum("n").alias("n"), F.min_by(F.struct(file_key), F.col("n")).alias("at")).where("n = 1"))
    return single.select(F.col(f"at.{file_key}").alias(file_key)).distinct()


def totals(others: DataFrame, now: DataFrame, file_key: str, changed: DataFrame | None) -> DataFrame:
    """``rule, digest, n`` of the keys in files read or changed, over all files."""
    relevant = now.select(*KEY)
    if changed is not None:
        here = changed.select(F.col(file_key).alias("__file"))
        relevant = relevant.unionByName(others.join(here, same(file_key, "__file"), "left_semi").select(*KEY))
    rows = others.join(relevant.distinct(), KEY, "left_semi").unionByName(now)
    return rows.groupBy(*KEY).agg(F.sum("n").alias("n"))
