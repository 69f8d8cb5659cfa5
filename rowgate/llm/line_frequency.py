"""Quality rules: word and line rules of a text, and cross-document line frequency.

A line is normalised (lower case, digits to 0, runs of blanks to one) and
hashed.  Per host (``source``) the distinct documents that hold it are counted;
texts that are equal as a whole count as one document, so exact copies of a
document don't turn its lines into boilerplate.  Lines in more documents than
the host's limit are removed, and a document that is left with too few words is
rejected as depleted.

Counting is two partial aggregations, first to distinct (host, line, text),
then to documents a line: a line that a third of all documents hold is folded
before each shuffle.  Verdicts belong to a (host, text) pair and come back by a
join on it, so equal rows, repeated ids and null ids all get theirs.

Defined cases: a null text has no words and no lines; an empty text fails the
word rule; a very long text is judged whole, line by line; null is a host of its own;
every input row gives one result row, repeated rows and null ids too; the columns read
are picked by name, whatever further columns there are; an empty table gives an empty
result.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowgate.llm.common import gram_hashes, map_rows, table, word_count, word_hashes, words_of

#: A line is removed in a host where more distinct documents than this hold it ...
MIN_LINE_DOCS = 20
#: ... and more than this share of the host's distinct documents.
MAX_LINE_SHARE = 0.05
#: A document is depleted with a smaller share of its words left, or fewer words.
MIN_LEFT_SHARE = 0.5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
SYMBOLS = "#*$%&|<>"
#: Words of a window that must not repeat in a text.
WINDOW = 5
_BLANKS = " \t\n\x0b\x0c\r"


def text_rules(text: str | None) -> tuple[int, int, int, int, int]:
    """``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words``."""
    if not text:
        return 0, 0, 0, 0, 0
    words = words_of(text)
    chars = len(text) - sum(map(text.count, _BLANKS))
    lines = [x for x in text.split("\n") if x.strip(_BLANKS)]
    return (len(words), chars, sum(map(text.count, SYMBOLS)), len(lines) - len(set(lines)), repeat_words(words))


def repeat_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words covered by windows that are found twice or more in the text."""
    grams = gram_hashes(word_hashes(words), window)
    if len(grams) < 2:
        return 0
    order = np.argsort(grams, kind="stable")
    same = grams[order[1:]] == grams[order[:-1]]
    if not same.any():
        return 0
    hit = np.zeros(len(grams), bool)
    hit[order[1:][same]] = True
    hit[order[:-1][same]] = True
    edge = np.zeros(len(words) + 1, np.int64)
    starts = np.flatnonzero(hit)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + window, -1)
    return int((np.cumsum(edge[:-1]) > 0).sum())


def _rules(rows: dict[str, list]) -> dict[str, list]:
    found = [text_rules(t) for t in rows["text"]]
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return {"doc_id": rows["doc_id"], "host": rows["host"], "text_hash": rows["text_hash"]} | {
        n: [x[i] for x in found] for i, n in enumerate(names)}


def normalised(line: Column) -> Column:
    return F.trim(F.regexp_replace(F.regexp_replace(F.lower(line), r"\p{Nd}", "0"), r"[\x20\x09-\x0D]+", " "))


def host_of(source: Column | str) -> Column:
    """A host name that is never null and keeps null apart from every text."""
    return F.when(F.isnull(source), F.lit("-")).otherwise(F.concat(F.lit("+"), F.col(source).cast("string")))


def frequent_lines(lines: DataFrame, texts: DataFrame, min_docs: int, max_share: float) -> DataFrame:
    """``host, line`` above the host's limit.

    ``lines`` has one row per host, line and text, ``texts`` one per host and text.
    """
    counts = lines.groupBy("host", "line").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > min_docs)
    hosts = texts.groupBy("host").agg(F.count(F.lit(1)).alias("docs"))
    return counts.join(hosts, "host").where(F.col("n") > F.col("docs") * max_share).select("host", "line")


def line_frequency(docs: DataFrame, min_docs: int = MIN_LINE_DOCS, max_share: float = MAX_LINE_SHARE,
                   min_left: float = MIN_LEFT_SHARE, min_words: int = MIN_WORDS) -> DataFrame:
    """One row per row of ``docs`` (``doc_id, text, source``) with its verdict."""
    base = docs.select("doc_id", "text", host_of("source").alias("host"), F.xxhash64("text", F.col("text").isNull()).alias("text_hash"))
    rules = map_rows(
        base.select("doc_id", "host", "text_hash", "text"), lambda: _rules,
        "doc_id long, host string, text_hash long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long")
    lines = (base.select("host", "text_hash", F.explode(F.split("text", "\n", -1)).alias("raw"))
             .select("host", "text_hash", F.xxhash64(normalised(F.col("raw"))).alias("line"), word_count("raw").alias("words"))
             .where("words > 0")
             .groupBy("host", "text_hash", "line")
             .agg(F.count(F.lit(1)).alias("times"), F.sum("words").alias("words")))
    texts = base.groupBy("host", "text_hash").agg(F.count(F.lit(1)).alias("copies"))
    frequent = frequent_lines(lines, texts, min_docs, max_share)
    # the lines above are summed over the copies of a text
    removed = (lines.join(frequent, ["host", "line"])
               .groupBy("host", "text_hash").agg(F.sum("times").alias("times"), F.sum("words").alias("words"))
               .join(texts, ["host", "text_hash"])
               .select("host", "text_hash", (F.col("times") / F.col("copies")).cast("long").alias("n_removed_lines"),
                       (F.col("words") / F.col("copies")).cast("long").alias("n_removed_words")))
    left = F.col("n_words") - F.col("n_removed_words")
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    depleted = (F.col("n_removed_words") > 0) & ((left < min_words) | (left < F.col("n_words") * min_left))
    return (rules.join(removed, ["host", "text_hash"], "left")
            .withColumn("n_removed_lines", F.coalesce("n_removed_lines", F.lit(0).cast("long")))
            .withColumn("n_removed_words", F.coalesce("n_removed_words", F.lit(0).cast("long")))
            .withColumn("base_failed", failed)
            .withColumn("depleted", depleted)
            .withColumn("kept", ~failed & ~depleted)
            .select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
                    "n_removed_lines", "n_removed_words", "depleted"))


def op1_line_frequency(spark, sf_dir: str) -> DataFrame:
    return line_frequency(table(spark, sf_dir, "documents"))
