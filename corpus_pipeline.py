"""The corpus pipeline: stages applied to ``documents`` one after the other, each
written as Parquet and read again for the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from vereda.llm import decontamination, mixing, near_duplicates, sharding, toxicity
from vereda.llm.common import documents
from vereda.session import materialize


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents below 0.5 of the chain, which is fitted on the labelled ones among them."""
    return toxicity.drop_toxic(docs, toxicity.fit_chain(docs, table(spark, sf_dir, "labels")))


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each near-duplicate component; rows are told
    apart by id and text, so rows without an id or with a shared one are judged by their own text.
    Documents are near at a similarity of 0.8 of their shingles of five words."""
    return near_duplicates.one_of_each(docs, 5)


def without_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents into which no benchmark item leaks."""
    return decontamination.drop_leaks(docs, table(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The words that the mix takes of each document; a document may be taken twice over."""
    return mixing.mixed_documents(docs)


def sharded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document with its place in 24 shards along the curve, in this order."""
    return sharding.sharded_documents(docs, ["source", "lang", "size"], 24)


STAGES = [
    ("toxicity", without_toxic),
    ("near_duplicates", one_of_each),
    ("decontamination", without_leaks),
    ("source_mix", mixed),
    ("hilbert_shards", sharded),
]

#: the fitted classifier and the keyed permutation have no SQL form
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs
