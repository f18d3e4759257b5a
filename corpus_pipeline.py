"""Corpus pipeline: documents that have a language, one of each group of near copies, free
of benchmark passages, mixed over sources by temperature and packed into shards.

STAGES are (name, function(spark, docs, sf_dir)); ``run`` applies them to ``documents``,
each written as Parquet in the shared folder and read again by the next. All but the last
return the columns of ``documents``; the last adds ``shard``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tabsmith.llm import decontaminate, langid, mixing, neardup, sharding
from tabsmith.session import materialize
from tabsmith.sources.tables import read


def with_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without any letter (``und``) go. Without labelled rows the texts with a letter stay; the score isn't used."""
    return langid.in_known_language(docs, langid.trained(docs))


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest doc_id of each group stays (five-word shingles, similarity 0.8)."""
    return neardup.one_of_each_group(docs, shingle=5, percent=80)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which a ten-word window of a benchmark item occurs go."""
    return decontaminate.without_hits(docs, read(spark, sf_dir, "benchmark"), n=10)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at 0.95 of the entropy of equal shares, no source more than four times, as
    many tokens as there are."""
    return mixing.mixed_documents(docs, entropy=0.95, max_repeats=4.0)


def sharded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """24 shards of near equal size, equal texts together."""
    return sharding.sharded_documents(docs, n_shards=24)


STAGES = [("language_id", with_language), ("ngram_jaccard", without_near_copies), ("decontamination", without_benchmark),
          ("mixing", mixed), ("sharding", sharded)]

#: a trained network (language_id) has no SQL form
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
