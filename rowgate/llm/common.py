"""Small shared pieces of the training-data operators.

Words are maximal runs of characters other than the six ASCII blanks
(``[^\\x20\\x09-\\x0D]+``).  ``bytes.split()`` splits at exactly these six, so
Python tasks split UTF-8 bytes and never need a pattern.
"""

from __future__ import annotations

import math
import tempfile
import zipfile
from collections.abc import Callable, Iterable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rowgate.session import fresh_dir

#: One word, in Java's and Python's pattern language alike.
WORD = r"[^\x20\x09-\x0D]+"
#: One multiplier for rolling word hashes (odd, from the golden ratio).
_MULT = np.uint64(0x9E3779B97F4A7C15)
_MIX1 = np.uint64(0xBF58476D1CE4E5B9)
_MIX2 = np.uint64(0x94D049BB133111EB)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def quoted(df: DataFrame) -> list[Column]:
    """All columns of a table, whatever their names hold (dots and backticks)."""
    return [F.col("`" + c.replace("`", "``") + "`") for c in df.columns]


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the cluster's shared folder and read it back.

    This cuts the lineage: a lost executor never repeats what came before, and
    a table that several branches read is computed once.
    """
    spark = df.sparkSession
    path = fresh_dir(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def word_count(text: Column | str) -> Column:
    """Words of a text, null as 0 (JVM side)."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)).cast("long"), F.lit(0).cast("long"))


def words_of(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").split() if text else []


def word_hashes(words: list[bytes]) -> np.ndarray:
    """A 64-bit hash per word; the same in every process."""
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread every input bit over the 64 output bits."""
    x = (x ^ (x >> np.uint64(30))) * _MIX1
    x = (x ^ (x >> np.uint64(27))) * _MIX2
    return x ^ (x >> np.uint64(31))


def gram_hashes(h: np.ndarray, n: int) -> np.ndarray:
    """Hash of every run of ``n`` consecutive words (empty if there is none)."""
    m = len(h) - n + 1
    if m <= 0:
        return np.empty(0, np.uint64)
    out = h[:m].copy()
    for i in range(1, n):
        out *= _MULT
        out += h[i:i + m]
    return mixed(out)


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once an application, so that Python
    tasks import it wherever they run."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    package = Path(__file__).resolve().parent.parent
    archive = Path(tempfile.mkdtemp(prefix="rowgate-package-")) / "rowgate-package.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for f in sorted(package.rglob("*.py")):
            z.write(f, f.relative_to(package.parent))
    sc.addPyFile(str(archive))
    _SHIPPED.add(sc.applicationId)


def map_batches(df: DataFrame, f: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema) -> DataFrame:
    """``mapInArrow`` with this package on the executors."""
    ship(df.sparkSession)
    return df.mapInArrow(f, schema)


def map_rows(df: DataFrame, make: Callable[[], Callable[[dict[str, list]], dict[str, list]]], schema: str) -> DataFrame:
    """``mapInArrow`` over columns as Python lists; ``make`` runs once a task.

    The function that ``make`` returns gets one Arrow batch as lists and gives
    lists of equal length, in the order of ``schema``.
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    out_schema = to_arrow_schema(_parse_datatype_string(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = make()
        for batch in batches:
            for part in pieces(batch):
                out = f({n: part.column(i).to_pylist() for i, n in enumerate(part.schema.names)})
                yield pa.RecordBatch.from_arrays(
                    [pa.array(out[field.name], field.type) for field in out_schema], schema=out_schema)

    return map_batches(df, run, schema)


#: Bytes of one piece of an Arrow batch that a Python function gets at once.
PIECE_BYTES = 8 << 20


def pieces(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Slices of a batch of about ``PIECE_BYTES`` each, one row at least."""
    n = max(1, math.ceil(batch.nbytes / PIECE_BYTES))
    step = max(1, math.ceil(batch.num_rows / n))
    for i in range(0, batch.num_rows, step):
        yield batch.slice(i, step)


def runs(batches: Iterable[pa.RecordBatch], keys: list[str]) -> Iterator[list[dict]]:
    """Groups of consecutive rows with equal ``keys``, from sorted batches."""
    group: list[dict] = []
    last = None
    for batch in batches:
        for row in batch.to_pylist():
            key = tuple(row[k] for k in keys)
            if group and key != last:
                yield group
                group = []
            group.append(row)
            last = key
    if group:
        yield group


def vocabulary(name: str) -> bytes:
    """Bytes of a public tokenizer's file, read on the driver and then broadcast.

    The size is that of the file (a few MB), whatever the corpus.
    """
    import public_tokenizers

    with open(public_tokenizers.path(name), "rb") as f:
        return f.read()
