"""Embedding near-dedup by iterative quantisation and multi-index Hamming tables.

*Codes.*  A rotation is learnt on a bounded sample: principal axes of the unit
vectors, then the orthogonal matrix that brings them nearest to the corners of a
cube, by turns of taking signs and solving for the rotation.  The signs of a rotated
vector are its code, ``BITS`` balanced bits.

*Retrieval.*  A code is cut in ``TABLES`` substrings, one for each hash table.  A
vector is posted under its own substring and under those that differ from it in one
bit, so that two vectors whose substrings differ in up to two bits meet in a bucket.
By the pigeonhole principle every pair of codes that differ in at most
``3 * TABLES - 1`` of all bits meets in some table.  A pair is taken in the first
bucket in which it meets (a condition on the two codes, so no pair is met twice),
if its codes differ in at most ``RADIUS`` bits.

*Reranking.*  Pairs retrieved are judged by the cosine of the original vectors.

*Large groups.*  Pairs of a dense group are proved by a bound in place of one product
a pair.  Around dense places of the sample (a bounded number) there are balls, with
half the angle of a link as their radius: any two vectors of a ball are linked.  They
are counted, not listed, and the tables retrieve only pairs that do not share a ball:
two vectors outside all balls, one inside and one outside, or vectors of two balls
that are near enough to each other.  Equal vectors are folded to one before all that.

Defined cases: vectors that are null, empty, zero, hold null or non-finite components
or have another length than most link with nothing and are their own component; a row
without an id links with nothing, has no component and is kept; rows that share an
id are one vector, the smallest that can link, and give one row; the columns read
are picked by name, whatever further columns there are; an empty table gives an
empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rowgate.llm.common import map_batches, pieces, staged, table
from rowgate.llm.components import components
from rowgate.llm.vectors import common_length, fine, matrix, unit

#: Least cosine of a link.
THRESHOLD = 0.95
#: Bits of a code, at most the length of the vectors.
BITS = 64
#: Substrings of a code, each with a hash table.
TABLES = 4
#: Bits in which the codes of a pair may differ.
RADIUS = 20
#: Vectors that the rotation is learnt from, the first by a hash of their id.
SAMPLE = 4096
TURNS = 30
#: Vectors of the sample that a dense place has around it, at least.
DENSE = 4
#: Kept free at the edge of a ball against rounding (radians).
EDGE = 1e-6


class Coder:
    """Centre, axes and rotation learnt from a sample, and the balls of its dense places."""

    def __init__(self, sample: np.ndarray, bits: int = BITS, threshold: float = THRESHOLD, dense: int = DENSE, seed: int = 12) -> None:
        u = unit(sample)
        self.centre = u.mean(axis=0)
        v = u - self.centre
        _, _, axes = np.linalg.svd(v, full_matrices=True)
        self.axes = axes[:min(bits, axes.shape[0], 64)].T
        projected = v @ self.axes
        n = projected.shape[1]
        rotation, _ = np.linalg.qr(np.random.RandomState(seed).normal(size=(n, n)))
        for _ in range(TURNS):
            corners = np.where(projected @ rotation >= 0, 1.0, -1.0)
            left, _, right = np.linalg.svd(corners.T @ projected)
            rotation = (left @ right).T
        self.rotation = rotation
        self.reach = np.arccos(threshold)
        self.balls = self._balls(u, dense)
        near = np.cos(np.minimum(np.pi, 2 * self.reach + EDGE))
        product = self.balls @ self.balls.T
        #: pairs of balls that a link can join
        self.meeting = [(int(i), int(j)) for i, j in zip(*np.nonzero(np.triu(product >= near, 1)))]

    def _balls(self, u: np.ndarray, dense: int) -> np.ndarray:
        """Centres of dense places, densest first; the sample in a ball makes no other."""
        inside = np.cos(self.reach / 2 - EDGE)
        near = u @ u.T >= np.cos(self.reach)
        count = near.sum(axis=1)
        free = np.ones(len(u), bool)
        centres = []
        for i in np.argsort(-count, kind="stable").tolist():
            if count[i] <= dense:
                break
            if not free[i]:
                continue
            middle = u[near[i]].mean(axis=0)
            middle /= np.sqrt((middle * middle).sum())
            covered = u @ middle >= inside
            free[i] = False
            if (covered & free).sum() + 1 > dense:
                centres.append(middle)
                free &= ~covered
        return np.array(centres).reshape(-1, u.shape[1])

    def codes(self, x: np.ndarray) -> np.ndarray:
        """Codes of the rows as 64-bit integers."""
        bits = ((unit(x) - self.centre) @ self.axes @ self.rotation) >= 0
        weight = np.left_shift(np.uint64(1), np.arange(bits.shape[1], dtype=np.uint64))
        return (bits * weight).sum(axis=1, dtype=np.uint64).view(np.int64)

    def ball_of(self, x: np.ndarray) -> np.ndarray:
        """Number of the ball that holds a row (of its nearest centre), or -1."""
        if not len(self.balls):
            return np.full(len(x), -1, np.int32)
        near = np.clip(unit(x) @ self.balls.T, -1, 1)
        best = near.argmax(axis=1)
        held = near[np.arange(len(x)), best] >= np.cos(self.reach / 2 - EDGE)
        return np.where(held, best, -1).astype(np.int32)


def cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (unit(a) * unit(b)).sum(axis=1)


def coded(vectors: DataFrame, coder: Coder) -> DataFrame:
    """``id, code, ball`` of ``id, embedding`` rows."""
    shared = vectors.sparkSession.sparkContext.broadcast(coder)
    schema = pa.schema([("id", pa.int64()), ("code", pa.int64()), ("ball", pa.int32())])

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = shared.value
        for batch in batches:
            for part in pieces(batch):
                if part.num_rows:
                    x = matrix(part.column("embedding"))
                    yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(c.codes(x)), pa.array(c.ball_of(x))], schema=schema)

    return map_batches(vectors.select("id", "embedding"), encode, "id long, code long, ball int")


def _substring(code: Column, at: Column, width: int) -> Column:
    # `at` differs from row to row, so the shift is an expression
    shifted = F.call_function("shiftrightunsigned", code, (at * width).cast("int"))
    return shifted.bitwiseAND(F.lit((1 << width) - 1).cast("long"))


def retrieve(nodes: DataFrame, meeting: list[tuple[int, int]], bits: int, tables: int = TABLES, radius: int = RADIUS) -> DataFrame:
    """``a, b``: pairs of nodes (``id, code, ball``) from the multi-index tables.

    Every pair that does not share a ball is met in one *court*: court 0 is for pairs
    with a vector outside all balls, and every two balls that a link can join have one.
    """
    width = -(-bits // tables)
    posted = (nodes.select("id", "code", "ball", F.explode(F.sequence(F.lit(0), F.lit(tables - 1))).alias("t"))
              .withColumn("own", _substring(F.col("code"), F.col("t"), width))
              .withColumn("key", F.explode(F.array(F.col("own"), *[F.col("own").bitwiseXOR(F.lit(1 << j).cast("long")) for j in range(width)]))))
    # the number of the court above the key's bits and the table's
    key = F.shiftleft(F.shiftleft(F.col("court").cast("long"), 8).bitwiseOR(F.col("t").cast("long")), 32).bitwiseOR(F.col("key"))
    outside = F.col("ball") < 0
    pairs = {i: [] for pair in meeting for i in pair}
    for n, (i, j) in enumerate(meeting, 1):
        pairs[i].append((n, True))
        pairs[j].append((n, False))
    spark = nodes.sparkSession
    seats = spark.createDataFrame([(i, n, left) for i, of in pairs.items() for n, left in of], "ball int, court long, left boolean")

    def side(left: bool) -> DataFrame:
        everyone = posted.where(outside) if left else posted
        out = everyone.withColumn("court", F.lit(0).cast("long"))
        if meeting:  # at most one row for every two balls, and balls are bounded by the sample
            out = out.unionByName(posted.join(F.broadcast(seats.where(F.col("left") == left).drop("left")), "ball"), allowMissingColumns=True)
        return out.select(key.alias("key"), "id", "code", "own", "ball", "t")

    l, r = side(True).alias("l"), side(False).alias("r")
    apart = F.col("l.own").bitwiseXOR(F.col("r.own"))
    at = F.col("l.key").bitwiseAND(F.lit((1 << 32) - 1))
    # of several buckets of a table in which two substrings meet, the first
    lowest = apart.bitwiseAND(-apart)
    first_here = F.when(F.bit_count(apart) == 2, at.bitwiseXOR(F.col("l.own")) == lowest).otherwise(at == F.col("l.own"))
    differ = F.col("l.code").bitwiseXOR(F.col("r.code"))
    first_table = F.lit(True)
    for t in range(tables - 1):
        part = F.shiftrightunsigned(differ, t * width).bitwiseAND(F.lit((1 << width) - 1).cast("long"))
        first_table = first_table & ((F.col("l.t") <= t) | (F.bit_count(part) > 2))
    ordered = (F.col("r.ball") >= 0) | (F.col("l.id") < F.col("r.id"))
    on = (F.col("l.key") == F.col("r.key")) & (F.bit_count(differ) <= radius) & ordered & first_here & first_table
    return l.join(r, on).select(F.col("l.id").alias("a"), F.col("r.id").alias("b"))


def reranked(pairs: DataFrame, vectors: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The pairs whose original vectors have a cosine of ``threshold`` at least."""
    both = (pairs.join(vectors.select(F.col("id").alias("a"), F.col("embedding").alias("x")), "a")
            .join(vectors.select(F.col("id").alias("b"), F.col("embedding").alias("y")), "b").select("a", "b", "x", "y"))
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch):
                if part.num_rows:
                    fit = pa.array(cosines(matrix(part.column("x")), matrix(part.column("y"))) >= threshold)
                    yield pa.RecordBatch.from_arrays([part.column("a").filter(fit), part.column("b").filter(fit)], schema=schema)

    return map_batches(both, judge, "a long, b long")


def near_duplicates(rows: DataFrame, threshold: float = THRESHOLD, tables: int = TABLES, radius: int = RADIUS,
                    sample: int = SAMPLE, dense: int = DENSE) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` of ``vec_id, embedding`` rows."""
    v = F.col("embedding").cast("array<double>")
    able = fine(F.col("embedding")) & F.exists(v, lambda x: x != 0)
    one = (rows.where(F.col("vec_id").isNotNull()).groupBy(F.col("vec_id").cast("long").alias("vec_id"))
           .agg(F.min(F.when(able, v)).alias("embedding")))
    one = staged(one, "itq-rows")
    length = common_length(one.where(F.col("embedding").isNotNull()))
    one = one.withColumn("embedding", F.when(F.size("embedding") == length, F.col("embedding")))
    # equal vectors are one node, named by the smallest id
    equal = one.where(F.col("embedding").isNotNull())
    vectors = staged(equal.groupBy("embedding").agg(F.min("vec_id").alias("id"), F.count(F.lit(1)).alias("n")), "itq-vectors")
    members = (equal.join(vectors.where("n > 1"), "embedding").select("vec_id", "id")
               .unionByName(vectors.where("n = 1").select(F.col("id").alias("vec_id"), "id")))
    first = vectors.orderBy(F.xxhash64("id"), "id").limit(sample).select("embedding").toArrow()
    lone = one.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    if first.num_rows:
        coder = Coder(matrix(first.column("embedding")), threshold=threshold, dense=dense)
        nodes = staged(coded(vectors, coder), "itq-codes")
        bits = coder.rotation.shape[0]
        links = staged(reranked(retrieve(nodes, coder.meeting, bits, tables, radius), vectors, threshold), "itq-links")
        weighed = vectors.select("id", "n").join(nodes.select("id", "ball"), "id")
        # a row a ball, and balls are bounded by the sample
        balls = weighed.where("ball >= 0").groupBy("ball").agg(F.min("id").alias("least"), F.sum("n").alias("held"))
        known = staged(weighed.join(F.broadcast(balls), "ball", "left")
                       .select("id", "n", F.coalesce("least", "id").alias("node"), F.coalesce("held", "n").alias("held")), "itq-nodes")
        n_of = known.select("id", "n", "node")
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        listed = (both.join(n_of.select(F.col("id").alias("b"), "n"), "b").groupBy(F.col("a").alias("id")).agg(F.sum("n").alias("listed")))
        edges = (links.join(n_of.select(F.col("id").alias("a"), F.col("node").alias("x")), "a")
                 .join(n_of.select(F.col("id").alias("b"), F.col("node").alias("y")), "b")
                 .select(F.col("x").alias("a"), F.col("y").alias("b")).distinct())
        found = components(edges)
        result = (known.join(listed, "id", "left").join(found, "node", "left")
                  .select("id", (F.col("held") - 1 + F.coalesce("listed", F.lit(0))).alias("n_links"), F.coalesce("component", "node").alias("component_id")))
        linked = members.join(result, "id").select("vec_id", "n_links", "component_id")
        lone = lone.join(linked.select("vec_id"), "vec_id", "left_anti").unionByName(linked)
    nameless = rows.where(F.col("vec_id").isNull()).select(
        F.lit(None).cast("long").alias("vec_id"), F.lit(0).cast("long").alias("n_links"), F.lit(None).cast("long").alias("component_id"))
    return lone.unionByName(nameless).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def op12_itq_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "embeddings"))
