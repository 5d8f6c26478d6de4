"""A training-corpus pipeline: each stage takes all rows its predecessor kept and its decisions take effect.

Stages read a table that was written before, so each of them starts from files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sensorlab.llm import decontaminate, jaccard, queries, spans, toxicity
from sensorlab.llm.common import staged


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity stays below the threshold of their language."""
    return toxicity.drop_toxic(docs, queries.table(spark, sf_dir, "labels"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that n-gram Jaccard links connect."""
    return jaccard.one_of_each(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the sentences of passages that stand elsewhere before."""
    return spans.dedup_spans(docs).select(docs.columns)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no copy or edited copy of a benchmark item."""
    return decontaminate.drop_leaks(docs, queries.table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences whose sources are mixed as in the corpus."""
    return queries.packed_digest(docs)


STAGES = [("toxicity", drop_toxic), ("ngram_jaccard", drop_near_copies), ("substring_dedup", cut_repeats), ("decontamination", drop_leaks), ("packing", pack)]

#: The classifier and the tokenizer can't be written in SQL; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = queries.table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
