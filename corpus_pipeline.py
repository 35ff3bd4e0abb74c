"""From raw documents to training shards: every stage is one operator of ``keyloom.llm`` over all its rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from keyloom.llm import decontamination, mixing, sharding, similar, toxicity
from keyloom.llm.common import free_name, quoted, table, text_batches, written


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier chain rejects go."""
    chain = toxicity.fit_chain(docs, table(spark, sf_dir, "labels"))
    scored = chain.score(docs)
    return scored.filter(~chain.rejects(scored)).select(*map(quoted, docs.columns))


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return similar.keep_one(docs)


def drop_benchmark_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with benchmark passages in a twentieth of their words or more go."""
    return decontamination.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at their target weights; a document is there as often as the mix takes it."""
    return mixing.mix_documents(docs, table(spark, sf_dir, "labels"))


def deal_into_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows with their shard, their slot in it and their virtual slot."""
    size = free_name(docs, "size")
    placed, _ = sharding.assign(docs.withColumn(size, sharding.record_size()), ["doc_id", "text"], size)
    return placed


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("near_duplicates", keep_one_of_near_copies),
    ("decontamination", drop_benchmark_copies),
    ("mixing", mix_sources),
    ("sharding", deal_into_shards),
]

# No SQL has the hashes and models of these stages; tests/llm/test_corpus_pipeline.py holds each stage against a plain
# version, but takes the toxicity model's probabilities as given and holds them against the labels of invented rows.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each reads what the one before has written."""
    docs = text_batches(table(spark, sf_dir, "documents"))
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage_{name}")
    return docs
