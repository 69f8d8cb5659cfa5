"""N-gram Jaccard join by a MinHash LSH forest.

A document is its set of runs of five words (all its words, if they are fewer);
two documents are linked if the Jaccard similarity of their sets is at least
the threshold.  Equal texts are folded to one *class* first: everything below
runs on distinct texts.

The forest has ``TREES`` prefix tries.  A text's label in a trie is ``DEPTH``
min-hashes of one byte each, packed into one long, so sorted labels are the trie
and a prefix is a shift.  Matched prefixes are shortened from the full depth
down to the depth at which a pair at the threshold shares a prefix in some trie
with the target recall.  On the way only texts are compared that deeper
prefixes haven't joined yet, by the share of equal bytes in their signatures; a
comparison that leaves a similarity at the threshold possible joins them.

Texts joined in that way (connected components) are then verified exactly: all
pairs of a component by their whole sets of shingles.  That gives every text
its number of links, and the classes of near-duplicates are the components of
the verified links.

Buckets and components have no cap.  One of more than a block of members is cut
into blocks, and every pair of blocks is a task group of its own, so memory is
bounded and one large group spreads over all tasks.  No pair leaves a task:
only link counts and a spanning forest do.

Defined cases: texts without words (null ones too) have no links and are
classes of their own; a very long text has one signature like any other, and is compared
whole; every input row gives one result row; null ids are
ignored where a class takes its smallest id; extra columns, whatever their names, are
carried by :func:`first_of_each_class` and play no part; an empty table gives an empty
result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rowgate.llm.common import WORD, gram_hashes, map_batches, map_rows, quoted, runs, staged, table, word_hashes, words_of
from rowgate.llm.components import components

SHINGLE = 5
THRESHOLD = 0.8
TREES = 32
DEPTH = 8
#: Chance that a pair right at the threshold shares a prefix in some trie.
RECALL = 0.9999
#: Standard errors below the threshold at which signatures rule a pair out.
MARGIN = 4.5
#: Members of a bucket, or texts of a component, that one task group compares.
BUCKET_BLOCK = 512
VERIFY_BLOCK = 128
#: Shingles that are hashed at a time, to stay in the processor's cache.
_CHUNK = 1 << 15
#: Columns of the incidence matrix that is multiplied at a time.
_COLUMNS = 2048


def stop_depth(threshold: float = THRESHOLD, trees: int = TREES, recall: float = RECALL, depth: int = DEPTH) -> int:
    """The longest prefix that still has the target recall at the threshold."""
    for k in range(depth, 0, -1):
        if 1 - (1 - threshold**k) ** trees >= recall:
            return k
    return 1


def shingles(text: str | None) -> np.ndarray:
    """Sorted distinct hashes of the runs of five words."""
    words = words_of(text)
    if not words:
        return np.empty(0, np.uint64)
    h = word_hashes(words)
    return np.unique(gram_hashes(h, min(SHINGLE, len(h))))


def signatures(sets: list[np.ndarray], trees: int = TREES) -> np.ndarray:
    """One row of ``trees`` labels a set; sets must not be empty."""
    n = trees * DEPTH
    factors = np.random.RandomState(20).randint(1, 1 << 31, n).astype(np.uint32) * np.uint32(2) + np.uint32(1)
    out = np.empty((len(sets), n), np.uint8)
    i = 0
    while i < len(sets):
        j, held = i, 0
        while j < len(sets) and (j == i or held + len(sets[j]) <= _CHUNK):
            held += len(sets[j])
            j += 1
        x = (np.concatenate(sets[i:j]) >> np.uint64(32)).astype(np.uint32)
        starts = np.cumsum([0] + [len(s) for s in sets[i:j - 1]])
        least = np.empty((n, j - i), np.uint32)
        for k in range(n):
            np.minimum.reduceat(x * factors[k], starts, out=least[k])
        out[i:j] = ((least * np.uint32(0x9E3779B1)) >> np.uint32(24)).T
        i = j
    return out.reshape(len(sets), trees, DEPTH)


def _labels(rows: dict[str, list]) -> dict[str, list]:
    sets = [shingles(t) for t in rows["text"]]
    some = [i for i, s in enumerate(sets) if len(s)]
    labels: list[bytes | None] = [None] * len(sets)
    if some:
        for i, sig in zip(some, signatures([sets[i] for i in some])):
            labels[i] = sig.tobytes()
    return {"doc_id": rows["doc_id"], "key": rows["key"], "labels": labels}


class Joined:
    """Union-find over ``0 .. n - 1``; a root is the smallest of its set."""

    def __init__(self, n: int) -> None:
        self.up = list(range(n))

    def root(self, i: int) -> int:
        up = self.up
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    def join(self, i: int, j: int) -> bool:
        a, b = self.root(i), self.root(j)
        if a == b:
            return False
        self.up[max(a, b)] = min(a, b)
        return True


def compare_bucket(sigs: np.ndarray, tree: int, stop: int, least: float, sides: np.ndarray | None = None) -> list[tuple[int, int]]:
    """What may be similar in a bucket (rows of bytes): each row that is joined to
    others, with the first row of its set.

    Prefixes of the bucket's own trie are shortened from the full depth to
    ``stop``; at each depth texts with equal prefixes that aren't joined yet are
    compared.  With ``sides``, only rows of different sides are.
    """
    n = len(sigs)
    joined = Joined(n)
    flat = sigs.reshape(n, -1)
    label = np.ascontiguousarray(sigs[:, tree]).view(">u8").reshape(-1)
    order = np.argsort(label, kind="stable")
    for depth in range(DEPTH, stop - 1, -1):
        prefix = label[order] >> np.uint64(64 - 8 * depth)
        cuts = np.flatnonzero(np.append(True, prefix[1:] != prefix[:-1]))
        for a, b in zip(cuts, np.append(cuts[1:], n)):
            own = order[a:b]
            for at in range(len(own) - 1):
                i = int(own[at])
                rest = own[at + 1:]
                mine = joined.root(i)
                rest = rest[[joined.root(int(j)) != mine for j in rest]]
                if sides is not None:
                    rest = rest[sides[rest] != sides[i]]
                if len(rest):
                    alike = (flat[rest] == flat[i]).mean(axis=1)
                    for j in rest[alike >= least].tolist():
                        joined.join(i, j)
    return [(joined.root(i), i) for i in range(n) if joined.root(i) != i]


def similar_pairs(sets: list[np.ndarray], threshold: float) -> np.ndarray:
    """Boolean matrix of the exact Jaccard similarities at the threshold."""
    n = len(sets)
    sizes = np.array([len(s) for s in sets], np.int64)
    row = np.repeat(np.arange(n), sizes)
    values, col = np.unique(np.concatenate(sets), return_inverse=True)
    shared = np.bincount(col, minlength=len(values)) > 1
    number = np.cumsum(shared) - 1
    keep = shared[col]
    row, col = row[keep], number[col[keep]]
    order = np.argsort(col, kind="stable")
    row, col = row[order], col[order]
    both = np.zeros((n, n), np.float64)
    for c in range(0, int(shared.sum()), _COLUMNS):
        a, b = np.searchsorted(col, [c, c + _COLUMNS])
        m = np.zeros((n, _COLUMNS), np.float32)
        m[row[a:b], col[a:b] - c] = 1
        both += m @ m.T
    union = sizes[:, None] + sizes[None, :] - both
    found = both >= threshold * union - 1e-9
    np.fill_diagonal(found, False)
    return found


def in_blocks(members: DataFrame, by: list[str], size: Column, block: int, key: str) -> DataFrame:
    """Members copied to every pair of blocks that they are compared in.

    A group of ``size`` members has ``ceil(size / block)`` blocks; a member of
    block ``i`` goes to the pairs ``(i, j)`` and ``(j, i)`` with the smaller
    first, and ``side`` tells which of the two it is from.
    """
    n = F.ceil(size / F.lit(block)).cast("int")
    return (members.withColumn("_n", n)
            .withColumn("_own", F.pmod(F.xxhash64(key), F.col("_n")).cast("int"))
            .withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_n") - 1)))
            .withColumn("low", F.least("_own", "_other")).withColumn("high", F.greatest("_own", "_other"))
            .withColumn("side", (F.col("_own") == F.col("high")).cast("int"))
            .drop("_n", "_own", "_other")
            .repartition(*by, "low", "high").sortWithinPartitions(*by, "low", "high", key))


def _sides(group: list[dict]) -> np.ndarray | None:
    """Sides of a group of two blocks; None for one block with itself."""
    return None if group[0]["low"] == group[0]["high"] else np.array([r["side"] for r in group])


_LINK = pa.schema([("a", pa.binary()), ("b", pa.binary())])
_VERIFIED = pa.schema([("a", pa.binary()), ("b", pa.binary()), ("links", pa.int64())])
_FLUSH = 4096


def _batches(rows: Iterator[dict], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    held: list[dict] = []
    for row in rows:
        held.append(row)
        if len(held) >= _FLUSH:
            yield pa.RecordBatch.from_pylist(held, schema=schema)
            held = []
    if held:
        yield pa.RecordBatch.from_pylist(held, schema=schema)


def candidate_links(classes: DataFrame, threshold: float, recall: float, trees: int = TREES, block: int = BUCKET_BLOCK) -> DataFrame:
    """``a, b``: a spanning forest of what the tries leave as possibly similar."""
    stop = stop_depth(threshold, trees, recall)
    least = threshold - MARGIN * float(np.sqrt(threshold * (1 - threshold) / (trees * DEPTH)))
    tree = F.explode(F.sequence(F.lit(0), F.lit(trees - 1)))
    rows = (classes.where("labels is not null").select("key", "labels", tree.alias("tree"))
            .select("key", "tree", F.substring("labels", F.col("tree") * DEPTH + 1, F.lit(stop)).alias("prefix"))
            .select("key", "tree", F.xxhash64("tree", "prefix").alias("bucket")))
    sizes = rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    rows = (rows.join(sizes, "bucket").join(classes.select("key", "labels"), "key"))
    rows = in_blocks(rows, ["bucket"], F.col("size"), block, "key")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def links() -> Iterator[dict]:
            for group in runs(batches, ["bucket", "low", "high"]):
                if len(group) < 2:
                    continue
                sigs = np.frombuffer(b"".join(r["labels"] for r in group), np.uint8).reshape(len(group), trees, DEPTH)
                # rows come by key: the trees of one group name the same links
                for i, j in compare_bucket(sigs, group[0]["tree"], stop, least, _sides(group)):
                    yield {"a": group[i]["key"], "b": group[j]["key"]}

        return _batches(links(), _LINK)

    return map_batches(rows.select("bucket", "low", "high", "side", "tree", "key", "labels"), compare, "a binary, b binary")


def verified_links(texts: DataFrame, threshold: float, block: int = VERIFY_BLOCK) -> DataFrame:
    """``a, b, links`` from ``key, component, size, text``: with ``b`` null, part
    of the number of links of ``a``; else a link of a spanning forest."""
    sets = map_rows(
        texts.select("key", "component", "size", "text"),
        lambda: lambda rows: {"key": rows["key"], "component": rows["component"], "size": rows["size"],
                              "shingles": [shingles(t).tobytes() for t in rows["text"]]},
        "key binary, component binary, size long, shingles binary")
    rows = in_blocks(sets, ["component"], F.col("size"), block, "key")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found() -> Iterator[dict]:
            for group in runs(batches, ["component", "low", "high"]):
                group = [r for i, r in enumerate(group) if not i or r["key"] != group[i - 1]["key"]]  # repeated rows
                if len(group) < 2:
                    continue
                similar = similar_pairs([np.frombuffer(r["shingles"], np.uint64) for r in group], threshold)
                if (sides := _sides(group)) is not None:
                    similar &= sides[:, None] != sides[None, :]
                joined = Joined(len(group))
                for r, n in zip(group, similar.sum(1).tolist()):
                    if n:
                        yield {"a": r["key"], "b": None, "links": n}
                for i, j in np.argwhere(np.triu(similar)).tolist():
                    joined.join(i, j)
                for i in range(len(group)):
                    if joined.root(i) != i:
                        yield {"a": group[joined.root(i)]["key"], "b": group[i]["key"], "links": 0}

        return _batches(found(), _VERIFIED)

    return map_batches(rows.select("component", "low", "high", "side", "key", "shingles"), verify, "a binary, b binary, links long")


def text_key() -> Column:
    """16 bytes that stand for a text; null and empty texts are alike."""
    return F.unhex(F.md5(F.coalesce("text", F.lit("")).cast("binary")))


def near_duplicates(docs: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """``doc_id, class_id, n_links, n_copies, text_key`` for every row of ``docs``.

    ``class_id`` is the smallest id of the near-duplicate class, ``n_links`` the
    number of other distinct texts that the text is linked to, ``n_copies`` the
    number of rows with this very text.
    """
    base = docs.select("doc_id", "text", text_key().alias("key"))
    labels = map_rows(base, lambda: _labels, "doc_id long, key binary, labels binary")
    classes = staged(labels.groupBy("key").agg(
        F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("n_copies"), F.first("labels").alias("labels")), "classes")
    maybe = components(candidate_links(classes, threshold, recall))
    sizes = maybe.groupBy("component").agg(F.count(F.lit(1)).alias("size"))
    wanted = (maybe.join(sizes, "component").withColumnRenamed("node", "key")
              .join(classes.select("key", "first"), "key"))
    w = wanted.alias("w")
    texts = (base.alias("d").join(w, (F.col("d.key") == F.col("w.key")) & F.col("d.doc_id").eqNullSafe(F.col("w.first")))
             .select("d.key", "w.component", "w.size", "d.text"))
    links = staged(verified_links(texts, threshold), "verified")
    counts = links.where("b is null").groupBy(F.col("a").alias("key")).agg(F.sum("links").alias("n_links"))
    groups = components(links.where("b is not null").select("a", "b")).withColumnRenamed("node", "key")
    firsts = (groups.join(classes.select("key", "first"), "key")
              .groupBy("component").agg(F.min("first").alias("class_id")))
    groups = groups.join(firsts, "component").withColumnRenamed("component", "class_key")
    per_class = (classes.select("key", "first", "n_copies", F.col("labels").isNotNull().alias("has_words"))
                 .join(groups, "key", "left").join(counts, "key", "left")
                 .select("key", "n_copies", "has_words", F.coalesce("class_key", "key").alias("class_key"),
                         F.when(F.col("class_key").isNotNull(), F.col("class_id")).otherwise(F.col("first")).alias("class_id"),
                         F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links")))
    return (docs.select("doc_id", text_key().alias("key")).join(per_class, "key")
            .select("doc_id", F.when(F.col("has_words"), F.col("class_id")).otherwise(F.col("doc_id")).alias("class_id"),
                    "n_links", "n_copies", F.col("key").alias("text_key"), "class_key", "has_words"))


def first_of_each_class(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` without near-duplicates: of each class the row of
    smallest id stays (null last, then by text), and one of equal rows.  Texts
    without words all stay."""
    found = near_duplicates(docs, threshold)
    first = (found.where("has_words").groupBy("class_key")
             .agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key")).alias("first"))
             .select(_id_key(F.col("first.doc_id")), F.col("first.text_key").alias("text_key")))
    rows = docs.select(F.struct(*quoted(docs)).alias("row"), F.col("text").rlike(WORD).alias("has_words"), _id_key(F.col("doc_id")), text_key().alias("text_key"))
    kept = rows.where("has_words").join(first, ["id_key", "text_key"])
    equal = Window.partitionBy("id_key", "text_key").orderBy(F.xxhash64("row"))
    kept = kept.withColumn("nth", F.row_number().over(equal)).where("nth = 1")
    return kept.select("row").unionByName(rows.where("has_words is null or not has_words").select("row")).select("row.*")


def _id_key(doc_id: Column) -> Column:
    """An id that is never null, so that plain joins and windows on it agree."""
    return F.coalesce(doc_id.cast("string"), F.lit("-")).alias("id_key")


def op6_lsh_forest_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "class_id", "n_links", "n_copies")
