"""The corpus pipeline: five stages over documents, each the next one's input.

quality classifier -> exact dedup -> n-gram Jaccard join -> mixing to target weights ->
byte-level BPE. Every stage but the last returns the columns of documents; each is
written as Parquet under the cluster's shared folder and read again, so a lost
executor costs no stage that is done.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quakeloom.llm import bpe, exact_dedup, mixing, quality, setjoin
from quakeloom.llm.common import materialise, table
from quakeloom.session import prepare


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, learned from the labels, doesn't reject."""
    spark = prepare(spark)
    model = quality.fit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return quality.keep_good(docs, model)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the one with the largest doc_id."""
    prepare(spark)
    return exact_dedup.keep_one(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by similar shingle sets the one with the least doc_id."""
    prepare(spark)
    return setjoin.keep_one(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix has them."""
    prepare(spark)
    return mixing.repeat(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids and decoded bytes of each document, as counts and digests."""
    prepare(spark)
    return bpe.digest(bpe.decode(bpe.encode(docs)))


STAGES = [
    ("quality classifier", keep_good),
    ("exact dedup", drop_copies),
    ("n-gram Jaccard join", drop_near_copies),
    ("mixing sources", mix_sources),
    ("byte-level BPE", encode),
]

#: The classifier is learned, so no SQL gives these rows; tests/llm compares the stages with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = table(prepare(spark), sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return docs
