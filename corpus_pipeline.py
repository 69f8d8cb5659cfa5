"""A corpus pipeline over ``documents``: five stages, each one operator of
``rowgate.llm`` at work on all that the stage before it kept.

Every stage takes ``(spark, docs, sf_dir)``; its result is written as Parquet
in the shared folder and read back as the next one's ``docs``.  All but the last
return the columns of ``documents``; the mix may take a row more than once.

Defined cases, in every stage: further columns, whatever their names, are carried along
and play no part; null and empty texts score 0, are near duplicates of nothing, hold no
passage and no words for the mix (which takes none of them); very long texts are
processed whole; rows without an id come after all others where a smallest id is
asked for; of rows equal in id and text one stays, and rows that share an id are told
apart by their text; an empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rowgate.llm.common import staged, table
from rowgate.llm.mixing import mixed_documents
from rowgate.llm.ngram_join import first_of_each_class
from rowgate.llm.sentencepiece_bpe import encode_decode
from rowgate.llm.substring_dedup import dedup_documents
from rowgate.llm.toxicity import clean_documents, train


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the multiple-instance model rejects go."""
    return clean_documents(docs, train(docs, table(spark, sf_dir, "labels")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class stays."""
    return first_of_each_class(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words in windows that start earlier in the corpus are cut out."""
    return dedup_documents(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixed_documents(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every text encoded and decoded; one row per row of the mix."""
    return encode_decode(docs)


STAGES = [
    ("toxicity", toxicity),
    ("near duplicates", near_duplicates),
    ("repeated passages", repeated_passages),
    ("mixing", mixing),
    ("tokens", tokens),
]

#: SQL can't express the stages; they are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), "stage")
    return STAGES[-1][1](spark, docs, sf_dir)
