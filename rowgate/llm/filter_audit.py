"""Which filter of a chain removes what, in every order of the chain.

Every document has a *mask*, the set of filters that it fails, and all that an
audit counts depends on masks alone.  So the documents are first counted by part,
mask and label - a part has at most ``4 * 2**n`` such cells for ``n`` filters -
and the rest is arithmetic on cells by higher-order functions: a cell's mask is
folded along every order of the literal array of orders (``transform`` over the
orders, ``aggregate`` along each), which gives a struct of counts for each order
and step, 600 for five filters.  The arrays of a part's cells, weighted by the
cells' counts, are merged by elementwise sums.

The filter for copies asks for the smallest id among equal texts.  Equal texts
fail all other filters alike, so copies are folded by digest, part and label first
(on the map side); what meets under one digest is one row for each part and label,
never the copies themselves.

Defined cases: a null text is an empty one; a null source is the part ``''``; a row
without an id is a document that is no copy of a smaller id and that none is a copy
of; rows that share an id are documents of their own, and none of them is a copy of
the other; an id that ``labels`` has in several rows has the label 1 if one of them
says so; documents are picked by the columns ``doc_id``, ``text`` and ``source``,
whatever further columns there are; an empty table has no parts and gives no rows.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rowgate.llm.common import WORD, table

#: The filters in the order of their bits; the last is the one for copies.
FILTERS = "ABCDE"
MIN_WORDS = 200
COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")


def text_mask(text: Column) -> Column:
    """Bits of the filters that a text fails by itself."""
    words = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
    n, distinct = F.size(words), F.size(F.array_distinct(words))
    fails = (n < MIN_WORDS,
             100 * distinct < 50 * n,
             100 * F.regexp_count(text, F.lit("[A-Z]")) > 2 * F.length(text),
             text.rlike("[#$%&*|]"))
    return sum((F.when(f, 1 << i).otherwise(0) for i, f in enumerate(fails)), F.lit(0)).cast("int")


def cells(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``part, mask, good, toxic, n``: documents by all that the audit looks at."""
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        # rows without an id meet no label; this deals them over all tasks
        F.when(F.col("doc_id").isNull(), F.xxhash64("text", "source")).otherwise(F.lit(0)).alias("salt"),
        F.coalesce("source", F.lit("")).alias("part"), F.unhex(F.sha2(text, 256)).alias("digest"), text_mask(text).alias("mask"))
    marked = (labels.where((F.col("quality") == 1) | (F.col("toxic") == 1))
              .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
              .agg(F.coalesce(F.max((F.col("quality") == 1).cast("int")), F.lit(0)).alias("good"),
                   F.coalesce(F.max((F.col("toxic") == 1).cast("int")), F.lit(0)).alias("toxic"))
              .withColumn("salt", F.lit(0).cast("long")))
    labelled = rows.join(marked, ["doc_id", "salt"], "left").fillna(0, ["good", "toxic"])
    by = ["digest", "part", "mask", "good", "toxic"]
    # rows that share an id stay countable: the partitioning of the join serves this too
    ids = labelled.groupBy("doc_id", "salt", *by).agg(F.count(F.lit(1)).alias("n"))
    # min of a struct ignores a null struct: rows without an id are never the first
    place = F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "n"))
    folded = ids.groupBy(*by).agg(F.sum("n").alias("n"), F.min(place).alias("first"),
                                  F.sum(F.when(F.col("doc_id").isNull(), F.col("n")).otherwise(0)).alias("no_id"))
    smallest = F.min("first.doc_id").over(Window.partitionBy("digest"))
    originals = F.col("no_id") + F.when(F.col("first.doc_id") == F.col("smallest"), F.col("first.n")).otherwise(0)
    copy_bit = 1 << (len(FILTERS) - 1)
    split = folded.withColumn("smallest", smallest).select(
        "part", "good", "toxic",
        F.explode(F.array(F.struct("mask", originals.alias("n")),
                          F.struct((F.col("mask") + copy_bit).alias("mask"), (F.col("n") - originals).alias("n")))).alias("cell"))
    return (split.groupBy("part", F.col("cell.mask").alias("mask"), "good", "toxic").agg(F.sum("cell.n").alias("n"))
            .where("n > 0"))


def orders(filters: str = FILTERS) -> Column:
    """All orders of the filters, each an array of their bits: one literal."""
    return F.array(*[F.array(*[F.lit(filters.index(f)) for f in order]) for order in permutations(filters)])


def _count(x: Column) -> Column:
    return x.cast("long")


def fold_cell(mask: Column, good: Column, toxic: Column, n: Column, chains: Column) -> Column:
    """The counts of one cell for every order and step, as one flat array."""
    def step(state: Column, bit: Column) -> Column:
        fails = F.getbit(mask, bit) == 1
        alive = state["alive"]
        hit = alive & fails
        one = lambda c: F.when(c, n).otherwise(F.lit(0).cast("long"))
        counts = F.struct(
            one(alive & ~fails).alias("kept"), one(hit).alias("removed"), one(~alive & fails).alias("redundant"),
            one(fails & (F.bit_count(mask) == 1)).alias("unique_fails"),
            one(hit & (good == 1)).alias("good_lost"), one(hit & (toxic == 1)).alias("toxic_lost"))
        return F.struct((alive & ~fails).alias("alive"), F.concat(state["steps"], F.array(counts)).alias("steps"))

    counts_type = "struct<" + ",".join(f"{c}:bigint" for c in COUNTS) + ">"
    start = F.struct(F.lit(True).alias("alive"), F.array().cast(f"array<{counts_type}>").alias("steps"))
    return F.flatten(F.transform(chains, lambda order: F.aggregate(order, start, step, lambda state: state["steps"])))


def plus(a: Column, b: Column) -> Column:
    """Elementwise sums of two arrays of counts."""
    return F.zip_with(a, b, lambda x, y: F.struct(*[(x[c] + y[c]).alias(c) for c in COUNTS]))


def audit(cells_: DataFrame, filters: str = FILTERS) -> DataFrame:
    """``part, filter_order, step`` with the counts of each; ``cells_`` as of :func:`cells`."""
    chains = orders(filters)
    names = ["".join(o) for o in permutations(filters)]
    per = len(filters)
    counts_type = "struct<" + ",".join(f"{c}:bigint" for c in COUNTS) + ">"
    zero = F.array_repeat(F.struct(*[F.lit(0).cast("long").alias(c) for c in COUNTS]).cast(counts_type), len(names) * per)
    # at most 4 * 2**n cells a part
    parts = cells_.groupBy("part").agg(F.collect_list(F.struct("mask", "good", "toxic", "n")).alias("cells"))
    merged = F.aggregate("cells", zero, lambda acc, c: plus(acc, fold_cell(c["mask"], c["good"], c["toxic"], c["n"], chains)))
    bits = F.flatten(chains)
    removed = F.transform(F.sequence(F.lit(0), F.lit(per - 1)), lambda bit: F.aggregate(
        F.zip_with("counts", bits, lambda c, b: F.when(b == bit, c["removed"]).otherwise(F.lit(0).cast("long"))),
        F.lit(0).cast("long"), lambda acc, x: acc + x))
    table_ = parts.select("part", merged.alias("counts")).select("part", "counts", removed.alias("by_filter"))
    order_names = F.array(*[F.lit(x) for x in names])
    return table_.select("part", "by_filter", F.posexplode("counts").alias("at", "c")).select(
        "part", F.element_at(order_names, (F.floor(F.col("at") / per) + 1).cast("int")).alias("filter_order"),
        (F.col("at") % per + 1).cast("int").alias("step"), *[F.col(f"c.{c}").alias(c) for c in COUNTS],
        F.element_at("by_filter", F.element_at(bits, F.col("at") + 1) + 1).alias("shapley"))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(cells(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")))
