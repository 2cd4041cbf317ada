"""The corpus pipeline: stages over ``documents``, each written as Parquet and read again by the next.

Every stage but the last returns documents with their columns: without toxic texts, then one document of each class of
near duplicates, without contaminated documents, and mixed to target weights (a document stands there as often as the
mix takes it). The last says in which shard and slot each of them goes. All stages take empty tables and give empty ones,
keep columns of any name and read texts whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelflow.llm import mixing, near, sharding, suffixes, toxicity
from parcelflow.llm.queries import n_words, source_weights
from parcelflow.llm.shared import table, written


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score is below the limit; the classifier is learnt from ``docs`` and the labels of the folder.

    A null text is scored as an empty one, repeated rows alike. Without a confirmed text all documents stay.
    """
    model = toxicity.learnt(docs.select("doc_id", "text"), table(spark, sf_dir, "labels"))
    return toxicity.scored(docs, model).where(F.col("score") < toxicity.LEAST).select("row.*")


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates.

    It is the one with the smallest doc_id, a missing one last. Documents without words, null texts too, all stay; of rows
    that agree in every column one does.
    """
    return near.without_copies(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the benchmark of the folder does not contaminate.

    A null text has no words and stays, repeated rows go or stay together. Without benchmark items all stay.
    """
    return suffixes.clean(docs, table(spark, sf_dir, "benchmark"))


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """150 % of all words by source weights 5, 2, 1 and so on, no document more than twice.

    A null source is one of its own, the last. Documents without words are never taken. Ties are settled by the content of
    a row, so the mix does not depend on how rows lie; equal rows share what is taken of them.
    """
    return mixing.repeated(docs, n_words(), source_weights(docs), share=1.5, repeats=2)


def in_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Shard and slot of each document, in 40 shards of near equal bytes.

    Equal texts are in one shard, null and empty ones together; each row has a slot of its own.
    """
    return sharding.sharded(docs, shards=40)


STAGES = [
    ("toxicity", without_toxic),
    ("near_duplicates", without_near_copies),
    ("decontamination", without_benchmark),
    ("mixing", mixed_sources),
    ("sharding", in_shards),
]

#: A trained classifier decides the first stage, which SQL cannot state.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder."""
    docs = table(spark, sf_dir, "documents")
    for place, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if place + 1 < len(STAGES):
            docs = written(docs)
    return docs
