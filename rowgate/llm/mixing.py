"""Mixing sources to target weights by Pareto order sampling.

Every source has a target of words.  Its documents are first taken as often as
the ratio target / size says in whole copies; these are certain.  The rest of
the target, less words than the source has, is drawn without replacement by Pareto
order sampling with an inclusion probability for every document,

    p = min(1, level * size ** SIZE_POWER),

where the level of a source is the one at which the probabilities times the sizes
sum up to its rest.  With a negative power long documents are drawn more rarely than
short ones, so that a few of them don't make up a source's sample; documents with
``p = 1`` are certain.  A document gets the ranking value

    (u / (1 - u)) / (p / (1 - p))

of a uniform ``u`` that is a hash of its id and text, and the documents of
smallest value are taken until the words of the rest are reached.  The sample
has a fixed size in words: the draw stops before the document that would exceed
the rest, and the gap that it leaves is closed, as far as may be, by one more document:
the largest of the source not taken that fits in it.

Only DataFrame operations are used.  No source is ever sorted as a whole: the level
comes from sums over different sizes, the words before a document come from sums over
``BINS`` ranges of the ranking value, and only the range in which the rest is reached
is sorted.

Defined cases: a null or empty text has size 0 and takes nothing; null is a
source of its own, after all others; a null ``doc_id`` is a document like any
other; a very long text is a document like any other, and may be the larger part of
its source's rest or none of it; repeated rows are documents of their own, but rows
equal in id and text are told apart by a number within their group; extra columns,
whatever their names, are carried by :func:`mixed_documents` and play no part; an
empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rowgate.llm.common import quoted, staged, word_count

#: Weights of the sources in code-point order, repeating.
WEIGHTS = (5.0, 2.0, 1.0)
#: Size of the mix as a share of all words.
MIX_SHARE = 1.5
#: Targets stop at so many times their source's size.
MAX_COPIES = 2.0
#: Inclusion probabilities go with this power of a document's size.
SIZE_POWER = -0.5
#: Ranges of the ranking value for which words are summed.
BINS = 4096


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = MIX_SHARE,
                   max_copies: float = MAX_COPIES) -> DataFrame:
    """``source, source_size, target`` from ``source, size`` rows.

    A target is ``min(max_copies * size, weight * level)`` with the one level
    at which all targets sum up to the mix: the end of sharing the excess of
    stopped sources again and again.  Sources are few (rows of a catalogue), so
    the two windows over them run on one row a source.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    nth = (F.row_number().over(by_name) - 1) % len(weights)
    per = per.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (nth + 1).cast("int")))
    per = per.withColumn("most", F.col("source_size") * F.lit(float(max_copies)))
    # Sources stop in the order of most / weight.  With the first k stopped, the
    # level is what the others have to share; the level wanted is the largest
    # over all k for which the sources up to k do stop.
    stops = Window.orderBy(F.col("most") / F.col("weight"), F.col("source").asc_nulls_last())
    everything = Window.partitionBy()
    per = (per
           .withColumn("_total", F.lit(float(share)) * F.sum("source_size").over(everything))
           .withColumn("_stopped", F.coalesce(F.sum("most").over(stops.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
           .withColumn("_sharing", F.sum("weight").over(stops.rowsBetween(Window.currentRow, Window.unboundedFollowing)))
           .withColumn("_level", (F.col("_total") - F.col("_stopped")) / F.col("_sharing")))
    # the first that doesn't stop; of sources that would stop alike, the one of the largest level
    stop = F.col("most") / F.col("weight")
    free = F.min(F.when(F.col("_level") <= stop, F.struct(stop.alias("stop"), (-F.col("_level")).alias("less")))).over(everything)
    level = -free["less"]
    target = F.when(level.isNull(), F.col("most")).otherwise(F.least(F.col("most"), F.col("weight") * level))
    return per.select("source", "source_size", target.alias("target"))


def _row_key() -> list[Column]:
    """``id, h``: never null, so that plain joins and windows on them agree."""
    return [F.coalesce(F.col("doc_id").cast("long"), F.lit(-1).cast("long")).alias("id"),
            F.xxhash64("text", F.col("text").isNull(), "source", F.col("source").isNull(), F.col("doc_id").isNull()).alias("h")]


def pareto_rank(u: Column, p: Column) -> Column:
    """Random odds divided by inclusion odds; certain documents come first."""
    return F.when(p >= 1, F.lit(0.0)).when(p <= 0, F.lit(float("inf"))).otherwise((u / (1 - u)) / (p / (1 - p)))


def levels(sizes: DataFrame, rests: DataFrame, power: float = SIZE_POWER) -> DataFrame:
    """``source, level`` of the sources (``source, rest``) with something to draw.

    Documents are certain from the largest ``size ** power`` on.  With all before a
    size certain, the level is what the others have to share; the level wanted is the
    first at which the next one isn't certain.  One row for each different size.
    """
    per = (sizes.where("size > 0").groupBy("source", "size").agg(F.count(F.lit(1)).alias("m")).alias("s")
           .join(rests.where("rest > 0").alias("r"), F.col("s.source").eqNullSafe(F.col("r.source"))).select("s.*", "r.rest"))
    g = F.pow(F.col("size").cast("double"), F.lit(float(power)))
    per = per.withColumn("g", g).withColumn("words", F.col("m") * F.col("size")).withColumn("share", F.col("words") * F.col("g"))
    order = Window.partitionBy("source").orderBy(F.col("g").desc(), "size")
    certain = F.coalesce(F.sum("words").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    sharing = F.sum("share").over(order.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    level = (F.col("rest") - certain) / sharing
    return (per.select("source", "size", "g", level.alias("level")).where(F.col("level") * F.col("g") <= 1)
            .groupBy("source").agg(F.max_by("level", F.struct("g", -F.col("size"))).alias("level")))


def _drawn(ranked: DataFrame) -> DataFrame:
    """``ranked`` (``source, size, key, rank, rest``) with ``taken``: per source, the first
    in rank order as long as their words stay within the rest."""
    # certain documents have a range of their own: their words never exceed the rest
    at = F.when(F.col("rank") <= 0, F.lit(-1)).otherwise(F.floor(F.col("rank") / (1 + F.col("rank")) * BINS)).cast("int")
    ranked = ranked.withColumn("bin", at)
    bins = ranked.groupBy("source", "bin").agg(F.sum("size").alias("words"), F.max("rest").alias("rest"))
    upto = F.sum("words").over(Window.partitionBy("source").orderBy("bin").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    # the range in which the rest is exceeded, if there is one
    crossed = (bins.withColumn("upto", upto).where(F.col("upto") > F.col("rest"))
               .groupBy("source").agg(F.min(F.struct("bin", (F.col("upto") - F.col("words")).alias("before"))).alias("cross")))
    placed = (ranked.alias("f").join(crossed.alias("c"), F.col("f.source").eqNullSafe(F.col("c.source")), "left")
              .select("f.*", "c.cross"))
    outside = placed.where(F.col("cross").isNull() | (F.col("bin") != F.col("cross.bin")))
    outside = outside.withColumn("taken", F.col("cross").isNull() | (F.col("bin") < F.col("cross.bin")))
    order = Window.partitionBy("source").orderBy("rank", "key").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    inside = (placed.where(F.col("bin") == F.col("cross.bin"))
              .withColumn("taken", F.col("cross.before") + F.sum("size").over(order) <= F.col("rest")))
    return outside.unionByName(inside).drop("cross", "bin")


def mix(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = MIX_SHARE,
        max_copies: float = MAX_COPIES, power: float = SIZE_POWER, seed: int = 5) -> DataFrame:
    """``doc_id, source, key, size, source_size, target, p, copies`` for every row.

    ``docs`` has ``doc_id, text, source``.  ``key`` is a row's own key (id, hash
    of the text and number among equal rows), the same on every run; ``p`` is its
    probability to be drawn besides its whole copies, and ``copies`` is how often the
    mix takes the row.
    """
    base = docs.select("doc_id", "source", *_row_key(), word_count("text").alias("size"))
    equal = base.groupBy("doc_id", "source", "id", "h", "size").agg(F.count(F.lit(1)).alias("times"))
    rows = (equal.withColumn("nth", F.explode(F.sequence(F.lit(1).cast("long"), F.col("times"))))
            .select("doc_id", "source", "size", F.struct("id", "h", "nth").alias("key")))
    rows = staged(rows, "mix-rows")
    targets = source_targets(rows.select("source", "size"), weights, share, max_copies)
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    certain = F.least(F.floor(ratio + F.lit(1e-12)), F.lit(int(max_copies))).cast("long")
    targets = targets.withColumn("certain", certain).withColumn("rest", F.col("target") - F.col("source_size") * F.col("certain"))
    targets = staged(targets, "mix-targets")
    level = levels(rows.select("source", "size"), targets.select("source", "rest"), power)
    targets = (targets.alias("t").join(level.alias("l"), F.col("t.source").eqNullSafe(F.col("l.source")), "left")
               .select("t.*", F.coalesce("l.level", F.lit(0.0)).alias("level")))
    rows = (rows.alias("r").join(targets.alias("t"), F.col("r.source").eqNullSafe(F.col("t.source")))
            .select("r.*", "t.source_size", "t.target", "t.certain", "t.rest", "t.level"))
    p = F.when(F.col("size") > 0, F.least(F.lit(1.0), F.col("level") * F.pow(F.col("size").cast("double"), F.lit(float(power))))).otherwise(F.lit(0.0))
    # 53 bits of a hash, never 0 or 1
    u = (F.shiftrightunsigned(F.xxhash64(F.lit(seed), "key"), 11).cast("double") + 0.5) / float(1 << 53)
    ranked = rows.withColumn("p", p).withColumn("rank", pareto_rank(u, F.col("p")))
    drawn = staged(_drawn(ranked.where("p > 0").select("key", "source", "size", "rank", "rest")), "mix-drawn")
    gaps = drawn.groupBy("source").agg((F.max("rest") - F.sum(F.when(F.col("taken"), F.col("size")).otherwise(0))).alias("gap"))
    closing = (drawn.where(~F.col("taken")).alias("d").join(gaps.alias("g"), F.col("d.source").eqNullSafe(F.col("g.source")))
               .where(F.col("d.size") <= F.col("g.gap"))
               .groupBy("d.source").agg(F.min(F.struct((-F.col("d.size")).alias("off"), "d.rank", "d.key")).alias("best")))
    extra = drawn.where("taken").select("key").unionByName(closing.select("best.key")).withColumn("extra", F.lit(1).cast("long"))
    return (ranked.join(extra, "key", "left")
            .select("doc_id", "source", "key", "size", "source_size", "target", "p",
                    (F.col("certain") + F.coalesce("extra", F.lit(0))).alias("copies")))


def op5_pareto_mix(spark, sf_dir: str) -> DataFrame:
    """The whole of ``documents`` mixed; ``taken`` counts words with repeats."""
    from rowgate.llm.common import table

    m = mix(table(spark, sf_dir, "documents"))
    return m.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "copies")


def mixed_documents(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the mix takes, each as often as it does."""
    chosen = (mix(docs).where("copies > 0").select("key.id", "key.h", "key.nth", "copies"))
    equal = Window.partitionBy("id", "h").orderBy(F.xxhash64("row"))
    rows = (docs.select(F.struct(*quoted(docs)).alias("row"), *_row_key())
            .withColumn("nth", F.row_number().over(equal).cast("long")))
    joined = rows.join(chosen, ["id", "h", "nth"])
    return joined.select("row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).select("row.*")
