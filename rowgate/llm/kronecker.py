"""Hard-negative mining by Kronecker-packed products.

Components become integers, and the inner product of two rows is their score.
A block of candidates is packed one component at a time: the components of all
its rows, shifted by a bias so that none is negative, stand in separated fields
of one wide integer, each field wide enough for a whole inner product.  One
multiplication of that integer by an anchor's component (biased too) multiplies
the component of every candidate at once; the sum over all components holds the
biased score of every candidate in its field.  Taking the two biases off again
gives the exact scores, whatever the range of the components: the fields are as
wide as the values in hand ask for.

An anchor's positives are the first ``POSITIVES`` other rows of its label by
score.  The negatives of an anchor and positive are the first ``NEGATIVES`` rows
of another label whose score is between ``FLOOR`` percent of the positive's and
the positive's.  Both are found in every block of candidates for every chunk of
anchors, and the best of all blocks are merged by a window over an anchor.  A
block holds rows of any label, dealt by a hash of their id, so a label that a
third of all rows share fills no task.

Defined cases: rows whose label, vector or id is null, or whose vector is empty
or holds null or non-finite components take no part; neither do vectors of
another length than most; rows that share an id are one row, the one of the
smallest label and then vector; anchors without a positive, and positives without
a negative, give no rows (a negative score admits none: its floor lies above it);
ties go to the smaller id; scores outside 64 bits are compared as they are and
written as the nearest 64-bit number; the columns read are picked by name, so
further columns, whatever their names, play no part; an empty table gives an
empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rowgate.llm.common import ship, staged, table
from rowgate.llm.vectors import common_length, fine, matrix

POSITIVES = 5
NEGATIVES = 5
#: Least score of a negative, as a percentage of the positive's.
FLOOR = 80
#: Integer steps of a component of 1.
SCALE = 256
#: Candidates of a block and anchors of a chunk, at most about so many.
BLOCK = 1 << 16
CHUNK = 1 << 16
#: Candidates of a block at least, where there are cores for more blocks.
SMALL_BLOCK = 2048
#: Candidates that one wide integer holds.
FIELDS = 4096
_LONG = 1 << 63


def integers(x: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """floor(scale * x), exactly: 64-bit integers, or Python's where those end."""
    if x.size and np.abs(x).max() >= (1 << 52) / scale:
        whole = [[int(v) * scale if abs(v) >= 1 << 52 else int(v * scale // 1) for v in row] for row in x.tolist()]
        return np.array(whole, object).reshape(x.shape)
    return np.floor(x * scale).astype(np.int64)


class Packed:
    """Candidates with one wide integer for each component.

    ``most`` is the largest component of any anchor, biased; it sets the width of
    a field.
    """

    def __init__(self, x: np.ndarray, most: int) -> None:
        n, d = x.shape
        self.n = n
        self.bias = -int(x.min())
        up = x + self.bias
        self.sums = up.sum(axis=1)
        largest = d * most * int(up.max())
        self.width = next((w for w in (4, 8) if largest >> (8 * w) == 0), (largest.bit_length() + 7) // 8)
        if x.dtype != object:
            raw = up.astype("<u8").view(np.uint8).reshape(n, d, 8)
            fields = np.zeros((d, n, self.width), np.uint8)
            fields[:, :, :min(8, self.width)] = raw[:, :, :min(8, self.width)].transpose(1, 0, 2)
            self.wide = [int.from_bytes(f.tobytes(), "little") for f in fields]
        else:
            self.wide = [int.from_bytes(b"".join(v.to_bytes(self.width, "little") for v in up[:, j].tolist()), "little") for j in range(d)]

    def scores(self, anchor: np.ndarray, anchor_bias: int) -> np.ndarray:
        """Inner products of one anchor with all candidates."""
        parts = anchor.tolist()
        total = 0
        for a, wide in zip(parts, self.wide):
            if a + anchor_bias:
                total += (a + anchor_bias) * wide
        raw = total.to_bytes(self.n * self.width, "little")
        off = self.bias * sum(parts)
        if self.width <= 8 and self.sums.dtype != object and abs(off) + anchor_bias * int(self.sums.max()) < _LONG >> 1:
            field = np.frombuffer(raw, f"<u{self.width}")
            if self.width == 4 or not field.size or int(field.max()) < _LONG >> 1:
                return field.astype(np.int64) - anchor_bias * self.sums - off
        w = self.width
        return np.array([int.from_bytes(raw[i * w:i * w + w], "little") - anchor_bias * s - off
                         for i, s in enumerate(self.sums.tolist())], object)


def packed_block(x: np.ndarray, most: int) -> list[tuple[int, Packed]]:
    """Wide integers for the rows of ``x`` with the first row of each."""
    return [(i, Packed(x[i:i + FIELDS], most)) for i in range(0, len(x), FIELDS)]


def all_scores(packs: list[tuple[int, Packed]], anchor: np.ndarray, bias: int) -> np.ndarray:
    parts = [p.scores(anchor, bias) for _, p in packs]
    return parts[0] if len(parts) == 1 else np.concatenate(parts)


def _first(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` largest scores, smaller ids first among equals."""
    if scores.dtype == object:
        return np.array(sorted(range(len(scores)), key=lambda i: (-scores[i], ids[i]))[:k], np.int64)
    if len(scores) > 4 * k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        among = np.flatnonzero(scores >= least)
    else:
        among = np.arange(len(scores))
    return among[np.lexsort((ids[among], -scores[among]))[:k]]


def _clamped(scores: np.ndarray) -> pa.Array:
    return pa.array([max(-_LONG, min(_LONG - 1, int(s))) for s in scores.tolist()], pa.int64())


def usable(rows: DataFrame) -> DataFrame:
    """``vec_id, label, embedding`` of the rows that take part, one an id."""
    v = F.col("embedding").cast("array<double>")
    named = rows.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & fine(F.col("embedding")))
    one = named.groupBy(F.col("vec_id").cast("long").alias("vec_id")).agg(
        F.min(F.struct(F.col("label").cast("long").alias("label"), v.alias("embedding"))).alias("row"))
    rows = staged(one.select("vec_id", "row.label", "row.embedding"), "mining-rows")
    return rows.where(F.size("embedding") == common_length(rows))


def _grid(rows: DataFrame, anchors: DataFrame, block: int, chunk: int) -> DataFrame:
    """Every block of ``rows`` with every chunk of ``anchors``; these have the columns of
    ``rows`` and ``wanted``."""
    spark = rows.sparkSession
    cores = spark.sparkContext.defaultParallelism
    n, n_anchors = rows.count(), anchors.count()
    n_blocks = max(1, -(-n // block), min(2 * cores, -(-n // min(SMALL_BLOCK, block))))
    n_chunks = max(1, -(-n_anchors // chunk))
    place = F.xxhash64("vec_id", F.lit(11))
    own = rows.select(
        F.pmod(place, F.lit(n_blocks)).cast("int").alias("block"), F.explode(F.sequence(F.lit(0), F.lit(n_chunks - 1))).alias("chunk"),
        F.lit(False).alias("anchor"), "vec_id", "label", "embedding", F.lit(None).cast(anchors.schema["wanted"].dataType).alias("wanted"))
    asked = anchors.select(
        F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))).alias("block"), F.pmod(place, F.lit(n_chunks)).cast("int").alias("chunk"),
        F.lit(True).alias("anchor"), "vec_id", "label", "embedding", "wanted")
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), n_blocks * n_chunks)
    ship(spark)
    return own.unionByName(asked).repartition(parts, "block", "chunk")


def _sides(group: pa.Table):
    """Candidates and anchors of a group, both as ids, labels and integers; and ``wanted``."""
    is_anchor = group.column("anchor").to_numpy()
    out = []
    for some in (~is_anchor, is_anchor):
        part = group.filter(pa.array(some))
        out.append((part.column("vec_id").to_numpy(), part.column("label").to_numpy(), integers(matrix(part.column("embedding"))), part))
    (ids, labels, x, _), (a_ids, a_labels, a, part) = out
    return ids, labels, x, a_ids, a_labels, a, part.column("wanted").to_pylist()


_POSITIVE = pa.schema([("anchor_id", pa.int64()), ("positive_id", pa.int64()), ("positive_score", pa.int64())])
_NEGATIVE = pa.schema([*_POSITIVE, ("negative_id", pa.int64()), ("negative_score", pa.int64())])


def _positives(group: pa.Table, k: int) -> pa.Table:
    ids, labels, x, a_ids, a_labels, a, _ = _sides(group)
    found = [[], [], []]
    if len(ids) and len(a_ids):
        bias = -int(a.min())
        most = int(a.max()) + bias
        packs: dict = {}
        for i, label, anchor in zip(a_ids.tolist(), a_labels.tolist(), a):
            if label not in packs:
                mine = np.flatnonzero(labels == label)
                packs[label] = mine, packed_block(x[mine], most) if len(mine) else []
            mine, packed = packs[label]
            if not packed:
                continue
            scores = all_scores(packed, anchor, bias)
            other = np.flatnonzero(ids[mine] != i)
            top = other[_first(scores[other], ids[mine][other], k)]
            found[0] += [i] * len(top)
            found[1] += ids[mine][top].tolist()
            found[2] += _clamped(scores[top]).to_pylist()
    return pa.table([pa.array(c, pa.int64()) for c in found], schema=_POSITIVE)


def _negatives(group: pa.Table, k: int, floor: int) -> pa.Table:
    ids, labels, x, a_ids, a_labels, a, wanted = _sides(group)
    found = [[], [], [], [], []]
    if len(ids) and len(a_ids):
        bias = -int(a.min())
        packed = packed_block(x, int(a.max()) + bias)
        for i, label, anchor, positives in zip(a_ids.tolist(), a_labels.tolist(), a, wanted):
            scores = all_scores(packed, anchor, bias)
            # the bounds as whole numbers: floor * positive <= 100 * negative <= 100 * positive
            bounds = [(p["positive_id"], p["positive_score"], -(-floor * p["positive_score"] // 100)) for p in positives]
            among = np.flatnonzero((scores >= min(low for _, _, low in bounds)) & (labels != label))
            for positive, high, low in bounds:
                fit = among[(scores[among] >= low) & (scores[among] <= high)]
                top = fit[_first(scores[fit], ids[fit], k)]
                for column, values in zip(found, ([i] * len(top), [positive] * len(top), [high] * len(top), ids[top].tolist(), _clamped(scores[top]).to_pylist())):
                    column += values
    return pa.table([pa.array(c, pa.int64()) for c in found], schema=_NEGATIVE)


def mine(rows: DataFrame, is_anchor: Column, positives: int = POSITIVES, negatives: int = NEGATIVES, floor: int = FLOOR,
         block: int = BLOCK, chunk: int = CHUNK) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    ``rows`` has ``vec_id, label, embedding``; ``is_anchor`` is a condition on ``vec_id``.
    """
    rows = usable(rows)
    anchors = rows.where(is_anchor)
    near = _grid(rows, anchors.withColumn("wanted", F.lit(None).cast("int")), block, chunk).groupBy("block", "chunk").applyInArrow(
        lambda group: _positives(group, positives), "anchor_id long, positive_id long, positive_score long")
    by_score = Window.partitionBy("anchor_id").orderBy(F.col("positive_score").desc(), "positive_id")
    near = near.withColumn("nth", F.row_number().over(by_score)).where(F.col("nth") <= positives)
    wanted = near.groupBy(F.col("anchor_id").alias("vec_id")).agg(F.collect_list(F.struct("positive_id", "positive_score")).alias("wanted"))
    asked = staged(anchors.join(wanted, "vec_id"), "mining-anchors")
    found = _grid(rows, asked, block, chunk).groupBy("block", "chunk").applyInArrow(
        lambda group: _negatives(group, negatives, floor),
        "anchor_id long, positive_id long, positive_score long, negative_id long, negative_score long")
    order = Window.partitionBy("anchor_id", "positive_id").orderBy(F.col("negative_score").desc(), "negative_id")
    return (found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= negatives)
            .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"))


def op11_kronecker_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Anchors are the ids divisible by 100; every seventh label is moved on by one."""
    rows = table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(rows.select("vec_id", moved.alias("label"), "embedding"), F.col("vec_id") % 100 == 0)
