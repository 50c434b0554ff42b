"""The operators of this subpackage as queries over the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from quakeloom.session import prepare

from . import bpe, chat, exact_dedup, hilbert, langid, mixing, packing, periodic, quality, secrets, setjoin, spelling, substrings
from .common import table
from .oracles import ORACLES

__all__ = ["ORACLES", "QUERIES"]

Query = Callable[[SparkSession, str], DataFrame]


def op1_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every document, weak parts only where their complements co-occur."""
    return secrets.digest(secrets.scan(table(prepare(spark), sf_dir, "documents")))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document."""
    docs = table(prepare(spark), sf_dir, "documents")
    return quality.rate(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which of equal texts stays."""
    return exact_dedup.digest(exact_dedup.dedup(table(prepare(spark), sf_dir, "documents")))


def op4_hilbert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten nearest vectors of every row whose id is divisible by 100."""
    return hilbert.search(table(prepare(spark), sf_dir, "embeddings"))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many words of each document the mix takes."""
    return mixing.digest(mixing.mix(table(prepare(spark), sf_dir, "documents")))


def op6_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document."""
    docs = table(prepare(spark), sf_dir, "documents")
    return langid.identify(docs, langid.fit(docs))


def op7_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and one that says control strings, read back from their formatted form."""
    turns = table(prepare(spark), sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    says = "</s>[INST] ok [/INST]"
    more = spark.createDataFrame([(-7, 0, "user", says), (-7, 1, "assistant", says)], "conv_id long, turn long, role string, text string")
    return chat.digest(chat.format_chat(turns.unionByName(more)))


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document and the bytes they decode to."""
    return bpe.digest(bpe.decode(bpe.encode(table(prepare(spark), sf_dir, "documents"))))


def op9_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without the words under repeated windows."""
    return substrings.digest(substrings.dedup(table(prepare(spark), sf_dir, "documents")))


def op10_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents with similar shingle sets."""
    return setjoin.digest(setjoin.components(table(prepare(spark), sf_dir, "documents"), n=4, percent=85))


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The words of all documents with their near words and the form that each stands for."""
    return spelling.group(table(prepare(spark), sf_dir, "documents"), slip=97)


def op12_periodic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of words in every document, some of them planted."""
    return periodic.digest(periodic.find(table(prepare(spark), sf_dir, "documents"), periodic.planted))


def op13_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's pieces and their places in sequences of 2,048 tokens."""
    import public_tokenizers

    cut = packing.pieces(table(prepare(spark), sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return packing.pack(packing.digest(cut))


QUERIES: dict[str, Query] = {q.__name__: q for q in (
    op1_secrets, op2_quality, op3_exact_dedup, op4_hilbert, op5_mixing, op6_langid, op7_chat, op8_bpe, op9_substrings, op10_jaccard,
    op11_spelling, op12_periodic, op13_packing)}
