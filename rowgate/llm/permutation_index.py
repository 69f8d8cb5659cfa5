"""Approximate nearest neighbours by a permutation index.

A vector is represented by its nearest pivots in order.  Pivots are chosen from
a bounded sample of the data (the first in the order of a hash of their id),
each the one least like those before.  In the inverted file, each pivot's posting list holds the vectors that
have it among their ``PREFIX`` nearest, with its place in their order.  A query
reads the lists of its own ``PREFIX`` nearest pivots - an eighth of all lists, each
with an eighth of the vectors - and ranks vectors by the
footrule distance, the sum of the differences of places (a pivot that a vector
lacks stands at place ``PREFIX``).  The best ``SHARE`` of a block's vectors are
ranked again by their exact cosine.

The index holds every vector.  It is dealt in blocks of at most about ``BLOCK`` vectors
by a hash of the id, each with its posting lists; the queries go to every block
in chunks of about ``CHUNK``, so neither side grows in a task, and a vector
that a third of all rows share fills blocks like any other.  Each block gives
the nearest ``k`` of its candidates for a query, and the last step merges them.

Defined cases: vectors that are null, empty, zero, or hold null or non-finite
components or have another length than most, and rows without an id take no part;
an id in several rows counts with its best score; equal vectors are one entry
of a block's index, so copies don't crowd out others; ties go to the smaller id,
in the choice of candidates too; the columns read are picked by name, whatever
further columns there are; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rowgate.llm.common import ship, staged, table
from rowgate.llm.vectors import common_length, fine, matrix, unit

PIVOTS = 256
#: Vectors that pivots are chosen from.
PIVOT_SAMPLE = 1024
#: Nearest pivots by which a vector is represented.
PREFIX = 32
#: Share of a block's distinct vectors that are ranked by exact score, and at least so many.
SHARE = 0.18
LEAST = 256
#: Vectors of a block and queries of a chunk, at most about so many.
BLOCK = 1 << 15
CHUNK = 1 << 16
#: Vectors of a block at least, where there are cores for more blocks.
SMALL_BLOCK = 2048
K = 5
EVERY = 50


def usable(vectors: DataFrame) -> DataFrame:
    """``vec_id, embedding`` (doubles) of the vectors that may take part."""
    v = F.col("embedding").cast("array<double>")
    return (vectors.where(F.col("vec_id").isNotNull() & fine(F.col("embedding")) & F.exists(v, lambda x: x != 0))
            .select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("embedding")))


def choose_pivots(vectors: DataFrame, n: int = PIVOTS) -> np.ndarray:
    rows = vectors.orderBy(F.xxhash64("vec_id"), "vec_id").limit(PIVOT_SAMPLE).collect()
    return spread([r["embedding"] for r in rows], n)


def spread(sample: list[list[float]], n: int) -> np.ndarray:
    """``n`` vectors of a sample, each the one least like those before: a cluster
    that holds many vectors still gets few pivots."""
    x = np.array(list(dict.fromkeys(map(tuple, sample))), float)
    if not len(x):
        return x
    u = unit(x)
    chosen = [0]
    likest = u @ u[0]
    while len(chosen) < min(n, len(x)):
        likest[chosen] = np.inf
        chosen.append(int(np.argmin(likest)))
        likest = np.maximum(likest, u @ u[chosen[-1]])
    return x[chosen]


def nearest_pivots(x: np.ndarray, pivots: np.ndarray, prefix: int) -> np.ndarray:
    """Numbers of the nearest pivots of every row, nearest first."""
    near = np.einsum("ij,kj->ik", unit(x), unit(pivots), optimize=False)  # equal rows get equal values
    if prefix >= near.shape[1]:
        return np.argsort(-near, axis=1, kind="stable")
    # the nearest in order; a tie at the end of the prefix goes to the smaller number
    least = np.partition(near, near.shape[1] - prefix, axis=1)[:, near.shape[1] - prefix]
    near[near < least[:, None]] = -np.inf
    return np.argsort(-near, axis=1, kind="stable")[:, :prefix]


class InvertedFile:
    """Posting lists of a block: for each pivot, vectors and the pivot's place."""

    def __init__(self, x: np.ndarray, pivots: np.ndarray, prefix: int) -> None:
        self.n, self.pivots, self.prefix = len(x), pivots, min(prefix, len(pivots))
        order = nearest_pivots(x, pivots, self.prefix)
        flat = order.reshape(-1)
        by_pivot = np.argsort(flat, kind="stable")
        self.vector = (by_pivot // self.prefix).astype(np.int32)
        self.place = (by_pivot % self.prefix).astype(np.int32)
        self.start = np.searchsorted(flat[by_pivot], np.arange(len(pivots) + 1))

    def footrule(self, pivots_of_query: np.ndarray) -> np.ndarray:
        """Distance of every vector to a query's pivots."""
        gain = self.prefix - np.arange(self.prefix)  # of a pivot that only one side has
        out = np.full(self.n, int(2 * gain.sum()), np.int32)
        for place, p in enumerate(pivots_of_query.tolist()):
            a, b = self.start[p], self.start[p + 1]
            of_vector = self.place[a:b]
            out[self.vector[a:b]] += np.abs(of_vector - place) - (2 * self.prefix - place - of_vector)
        return out


def cosines(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Cosines in double precision; equal vectors get equal values."""
    return (x * q).sum(axis=1) / (np.sqrt((x * x).sum(axis=1)) * np.sqrt((q * q).sum()))


class Block:
    """The index of a block: its distinct vectors and the ids that have them."""

    def __init__(self, ids: np.ndarray, x: np.ndarray, pivots: np.ndarray, prefix: int) -> None:
        order = np.argsort(ids, kind="stable")
        self.ids, x = ids[order], x[order]
        _, first, entry = np.unique(x, axis=0, return_index=True, return_inverse=True)
        entry = entry.reshape(-1)
        self.first, self.x = first, x[first]
        self.u = unit(self.x)
        self.members = np.argsort(entry, kind="stable")
        self.start = np.searchsorted(entry[self.members], np.arange(len(first) + 1))
        self.index = InvertedFile(self.x, pivots, prefix)

    def nearest(self, own: int, q: np.ndarray, its_pivots: np.ndarray, k: int, share: float) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the ``k`` nearest found, without the query's own id."""
        n = min(len(self.first), max(LEAST, int(np.ceil(share * len(self.first)))))
        far = self.index.footrule(its_pivots).astype(np.int64) * len(self.ids) + self.first
        chosen = np.argpartition(far, n - 1)[:n]
        score = self.u[chosen] @ unit(q[None])[0]
        # the best entries, one more than k for the query's own; each with its smallest ids
        if n > k + 1:
            chosen = chosen[score >= np.partition(score, n - k - 1)[n - k - 1] - 1e-9]
        score = cosines(q, self.x[chosen])
        places, scores = [], []
        for c, value in zip(chosen.tolist(), score.tolist()):
            some = self.members[self.start[c]:self.start[c] + self._ids(c, k + 1)]
            places.append(some)
            scores.append(np.full(len(some), value))
        at, found = np.concatenate(places), np.concatenate(scores)
        ids = self.ids[at]
        by_score = np.lexsort((ids, -found))
        by_score = by_score[ids[by_score] != own]
        top = by_score[np.sort(np.unique(ids[by_score], return_index=True)[1])[:k]]  # an id's best score counts
        return ids[top], found[top]

    def _ids(self, entry: int, k: int) -> int:
        """Rows of an entry that hold its ``k`` smallest ids (repeated rows come together)."""
        rows = self.ids[self.members[self.start[entry]:self.start[entry + 1]]]
        if len(rows) <= k:
            return len(rows)
        new = np.flatnonzero(np.append(True, rows[1:] != rows[:-1]))
        return len(rows) if len(new) <= k else int(new[k])


_FOUND = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])


def _search_block(group: pa.Table, pivots: np.ndarray, k: int, prefix: int, share: float) -> pa.Table:
    asked = group.column("query").to_numpy()
    own, queries = group.filter(pa.array(~asked)), group.filter(pa.array(asked))
    out = [[], [], []]
    if own.num_rows and queries.num_rows:
        block = Block(own.column("vec_id").to_numpy(), matrix(own.column("embedding")), pivots, prefix)
        q = matrix(queries.column("embedding"))
        for i, vector, mine in zip(queries.column("vec_id").to_pylist(), q, nearest_pivots(q, pivots, block.index.prefix)):
            ids, score = block.nearest(i, vector, mine, k, share)
            for column, values in zip(out, (np.full(len(ids), i), ids, score)):
                column.append(values)
    return pa.table([pa.array(np.concatenate(c) if c else [], t) for c, t in zip(out, _FOUND.types)], schema=_FOUND)


def search(vectors: DataFrame, queries: DataFrame, k: int = K, n_pivots: int = PIVOTS, prefix: int = PREFIX,
           share: float = SHARE, block: int = BLOCK, chunk: int = CHUNK) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest found of each query.

    Both tables have ``vec_id, embedding``; a query's own id is no candidate.
    """
    spark = vectors.sparkSession
    vectors = staged(usable(vectors), "ann-vectors")
    length = common_length(vectors)
    vectors, queries = (t.where(F.size("embedding") == length) for t in (vectors, usable(queries)))
    n, n_queries = vectors.count(), queries.count()
    cores = spark.sparkContext.defaultParallelism
    n_blocks = max(1, -(-n // block), min(2 * cores, -(-n // min(SMALL_BLOCK, block))))
    n_chunks = max(1, -(-n_queries // chunk))
    shared = spark.sparkContext.broadcast(choose_pivots(vectors, n_pivots))
    near = F.xxhash64("vec_id", F.lit(7))
    own = vectors.select(
        F.pmod(near, F.lit(n_blocks)).cast("int").alias("block"),
        F.explode(F.sequence(F.lit(0), F.lit(n_chunks - 1))).alias("chunk"), F.lit(False).alias("query"), "vec_id", "embedding")
    asked = queries.select(
        F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))).alias("block"),
        F.pmod(near, F.lit(n_chunks)).cast("int").alias("chunk"), F.lit(True).alias("query"), "vec_id", "embedding")
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), n_blocks * n_chunks)
    ship(spark)
    found = (own.unionByName(asked).repartition(parts, "block", "chunk").groupBy("block", "chunk").applyInArrow(
        lambda group: _search_block(group, shared.value, k, prefix, share), "query_id long, vec_id long, score double"))
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return (found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
            .withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def op3_permutation_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return search(vectors, vectors.where(F.col("vec_id") % EVERY == 0))
