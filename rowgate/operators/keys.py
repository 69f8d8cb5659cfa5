"""Uniqueness (R15 across the dataset, R16 within a file).

A row is a duplicate when its normalised key (strings trimmed; null and blank
stay separate groups, as ``trim`` keeps null as null) occurs more than once.

Built to survive a key that holds a third of all rows:

1. ``groupBy(key).count()`` over the key columns of the *input* only.  Partial
   (map-side) aggregation folds a hot key to one row per input partition
   before the shuffle, so skew never reaches a single task here.  Several keys
   are all counted on the input, so the plan grows with the number of keys.
2. Hot keys (``count >= hot_key_rows``) are duplicates by definition.  The
   ``max_hot_keys`` largest are taken with a deterministic top-k - a size
   bound proven by construction, as only keys of at most ``MAX_HOT_KEY_BYTES``
   and of types whose size is known take part - and broadcast-joined to the
   rows: no shuffle of the big side for them.
3. Every other row is flagged by a null-safe equi-join against the duplicate
   keys.  Hot rows enter that join with a salt that the duplicate side never
   carries (it has salt 0), so they spread over all shuffle partitions and
   match nothing.  The salt is a hash of the row's own values, computed for hot
   rows only: a map task that runs again deals the same rows to the same
   partitions.  Hot keys beyond the
   top-k bound are matched exactly there (AQE skew-join splits what remains).
   When the duplicate set is small AQE turns the join into a broadcast at run
   time, after measuring it.

Strategy ``window`` replaces step 3 by a count over each key's rows, hot rows
apart under their salts: one shuffle and sort of the rows in place of a join.  A
key with fewer rows than ``hot_key_rows`` is one window group.

``hashed=True`` groups by SHA-256 digests of the keys instead of the values,
so long texts are not shuffled during counting (exact up to a SHA-256
collision).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..contract import SCOPE_FILE, ContractError, UniqueKey
from ..functions import types as ty

DEFAULT_HOT_KEY_ROWS = 1_000_000
DEFAULT_MAX_HOT_KEYS = 10_000
MAX_HOT_KEY_BYTES = 1024


def normalised(df: DataFrame, name: str, hashed: bool = False) -> Column:
    if name not in df.columns:
        raise ContractError(f"unique key column {name!r} not in data")
    col = ty.column(name)
    if ty.is_string(df.schema[name].dataType):
        col = F.trim(col)
    if hashed:
        col = F.sha2(col.cast("string"), 256)
    return col


def key_columns(key: UniqueKey, file_column: str) -> list[str]:
    cols = list(key.columns)
    if key.scope == SCOPE_FILE:
        cols = [file_column] + cols
    return cols


def flag_duplicates(df: DataFrame, columns: list[str], flag: str, *, strategy: str = "aggregate", hashed: bool = False,
                    hot_key_rows: int = DEFAULT_HOT_KEY_ROWS, max_hot_keys: int = DEFAULT_MAX_HOT_KEYS,
                    null_keys: str = "group") -> DataFrame:
    """``df`` plus boolean column ``flag``: the row's key occurs more than once.

    ``null_keys="ignore"`` never flags a row with a null key column; those
    rows are left out of the counting entirely.
    """
    return flag_all(df, [(columns, flag, hashed, null_keys)], strategy=strategy,
                    hot_key_rows=hot_key_rows, max_hot_keys=max_hot_keys)


def flag_all(df: DataFrame, keys: list[tuple[list[str], str, bool, str]], *, strategy: str = "aggregate",
             hot_key_rows: int = DEFAULT_HOT_KEY_ROWS, max_hot_keys: int = DEFAULT_MAX_HOT_KEYS) -> DataFrame:
    """``df`` plus one flag per ``(columns, flag, hashed, null_keys)``; every key
    is counted on ``df`` itself."""
    if strategy not in ("aggregate", "window"):
        raise ValueError(f"unknown uniqueness strategy {strategy!r}")
    out = df
    for i, (columns, flag, hashed, null_keys) in enumerate(keys):
        out = _flag_one(out, df, f"__k{i}_", columns, flag, hashed, null_keys, hot_key_rows, max_hot_keys, strategy)
    return out


def flag_counted(df: DataFrame, code: Column, totals: DataFrame, flag: str, *, hot_key_rows: int = DEFAULT_HOT_KEY_ROWS,
                 max_hot_keys: int = DEFAULT_MAX_HOT_KEYS) -> DataFrame:
    """``df`` plus ``flag`` by counts made elsewhere: ``totals`` has ``digest, n`` of
    the keys whose digest is ``code`` (null: never a duplicate)."""
    name = f"{flag}_code"
    dups = totals.where("n > 1").select(F.col("digest").alias(name), F.col("n").alias("__n"))
    hot = (dups.where(F.col("__n") >= hot_key_rows).orderBy(F.desc("__n"), name).limit(max_hot_keys)
           .select(F.col(name).alias(f"{name}_h"), F.lit(True).alias("__hot")))
    return _flag_by(df.withColumn(name, code), df.columns, [name], dups, hot, [f"{name}_h"], F.col(name).isNull(), flag, "aggregate")


def _row_salt(names: list[str], df: DataFrame) -> Column:
    """A hash of a row's values, never 0."""
    hashable = [c for c in names if not _holds_map(df.schema[c].dataType)]
    return (F.xxhash64(*[ty.column(c) for c in hashable]) if hashable else F.lit(1).cast("long")).bitwiseOR(F.lit(1).cast("long"))


def _holds_map(dt: T.DataType) -> bool:
    """Types that ``xxhash64`` can't take."""
    if isinstance(dt, T.ArrayType):
        return _holds_map(dt.elementType)
    if isinstance(dt, T.StructType):
        return any(_holds_map(f.dataType) for f in dt.fields)
    return isinstance(dt, T.MapType) or dt.typeName() == "variant"


def _width(df: DataFrame, column: str, name: str, hashed: bool) -> Column | None:
    """Bytes of a key column; None for types whose size isn't known."""
    dt = df.schema[column].dataType
    if hashed or ty.is_string(dt) or isinstance(dt, T.BinaryType):
        return F.coalesce(F.octet_length(F.col(name)), F.lit(0))
    if isinstance(dt, (T.NumericType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)):
        return F.lit(16)
    return None


def _flag_one(out: DataFrame, df: DataFrame, prefix: str, columns: list[str], flag: str, hashed: bool, null_keys: str,
              hot_key_rows: int, max_hot_keys: int, strategy: str) -> DataFrame:
    """``out`` (rows of ``df`` with flags of other keys) plus the flag of one key."""
    names = [f"{prefix}k{j}" for j in range(len(columns))]
    normal = [normalised(df, c, hashed).alias(n) for c, n in zip(columns, names)]
    # "ignore": rows with a null key column are never duplicates; they skip
    # the count and enter the join salted (spread out, never matching).
    any_null = (reduce(lambda a, b: a | b, [F.col(n).isNull() for n in names])
                if null_keys == "ignore" else F.lit(False))
    counted = df.select(*normal)
    if null_keys == "ignore":
        counted = counted.where(~any_null)
    dups = counted.groupBy(*names).agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") > 1)

    # Hot keys: bounded top-k, deterministic (total order on count, then key).
    # One predicate over the count (not a separate key-only conjunct), so it
    # stays above the aggregation and both branches reuse one key count.
    widths = [_width(df, c, n, hashed) for n, c in zip(names, columns)]
    known = all(w is not None for w in widths)
    short = reduce(lambda a, b: a + b, widths) <= MAX_HOT_KEY_BYTES if known else F.lit(False)
    hot_names = [f"{prefix}h{j}" for j in range(len(names))]
    hot = (
        dups.where(F.when(short, F.col("__n")).otherwise(F.lit(0)) >= hot_key_rows)
        .orderBy(F.desc("__n"), *[F.asc_nulls_first(n) for n in names])
        .limit(max_hot_keys)
        .select(*[F.col(n).alias(h) for n, h in zip(names, hot_names)], F.lit(True).alias("__hot"))
    )
    return _flag_by(out.select("*", *normal), df.columns, names, dups, hot, hot_names, any_null, flag, strategy)


def _flag_by(base: DataFrame, of_row: list[str], names: list[str], dups: DataFrame, hot: DataFrame, hot_names: list[str], any_null: Column,
             flag: str, strategy: str) -> DataFrame:
    """Rows of ``base`` flagged by the hot keys (broadcast) and all duplicate keys."""
    marked = base.join(F.broadcast(hot), _null_safe(names, hot_names), "left").drop(*hot_names)
    marked = marked.withColumn("__salt", F.when(F.col("__hot") | any_null, _row_salt(of_row, base)).otherwise(F.lit(0).cast("long")))
    if strategy == "window":
        again = F.count(F.lit(1)).over(Window.partitionBy(*names, "__salt")) > 1
        is_dup = F.coalesce(F.col("__hot"), again & ~any_null)
        return marked.withColumn(flag, is_dup).drop(*names, "__hot", "__salt")
    dup_names = [f"{n}_d" for n in names]
    dup_side = dups.select(*[F.col(n).alias(d) for n, d in zip(names, dup_names)],
                           F.lit(0).cast("long").alias("__dsalt"), F.lit(True).alias("__dup"))
    joined = marked.join(dup_side, _null_safe(names, dup_names) & (F.col("__salt") == F.col("__dsalt")), "left")
    is_dup = F.coalesce(F.col("__hot"), F.lit(False)) | F.coalesce(F.col("__dup"), F.lit(False))
    return joined.withColumn(flag, is_dup).drop(*names, *dup_names, "__hot", "__salt", "__dsalt", "__dup")


def _null_safe(left: list[str], right: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(l).eqNullSafe(F.col(r)) for l, r in zip(left, right)])


def key_counts(df: DataFrame, columns: list[str], hashed: bool = False) -> DataFrame:
    """Occurrences per normalised key (for summaries and tests)."""
    return (df.select(*[normalised(df, c, hashed).alias(c) for c in columns])
            .groupBy(*columns).agg(F.count(F.lit(1)).alias("occurrences")))
