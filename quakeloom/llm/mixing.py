"""Mixing sources to target weights by hash-threshold histograms, without sorting documents.

Each document has a fixed 60-bit hash. A source takes whole passes over its
documents as its target allows, and one more copy of every document whose hash
lies below the source's threshold. The threshold is found by nested histograms:
words are summed by source and by 12 bits of the hash, the bucket where the
budget runs out is the boundary, and only the boundary's documents enter the
next, finer histogram. A larger budget keeps every document of a smaller one.

Defined cases: a null text has size 0; a null source is a source, the last;
repeated rows are documents of their own (equal ids share a hash and go
together); documents of a source without a word come once; an empty table gives no row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import WORD, materialise

#: Weights by the source's place in the order, repeating.
WEIGHTS = (3, 1, 2)
#: The mix has so many words for each word of the corpus.
SHARE = 1.5
#: A source is repeated so often at most.
MOST = 2
LEVEL_BITS, LEVELS = 12, 5


def hash60(key: str = "doc_id") -> Column:
    """The first 15 hexadecimal digits of the md5 of the id as text."""
    text = F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def words(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def ranked(sources: DataFrame) -> DataFrame:
    """Sources with their place (from 0) in code-point order, null last, ranked range by range."""
    dealt = materialise(sources.repartitionByRange(F.col("source").asc_nulls_last())
                        .withColumn("part", F.spark_partition_id()), "sources")
    before = dealt.groupBy("part").agg(F.count("*").alias("n")).withColumn(
        "before", F.sum("n").over(W.orderBy("part")) - F.col("n")).select("part", "before")
    own = F.row_number().over(W.partitionBy("part").orderBy(F.col("source").asc_nulls_last()))
    return dealt.join(before, "part").select(*sources.columns, (F.col("before") + own - 1).alias("place"))


def targets(sources: DataFrame, weights=WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """Each source's target: its weighted share, capped, the excess reshared until nobody is above."""
    w = F.get(F.array(*map(F.lit, weights)), (F.col("place") % len(weights)).cast("int")).cast("double")
    known = materialise(ranked(sources).select("source", "source_size", w.alias("weight"),
                                               (F.lit(float(most)) * F.col("source_size")).alias("cap")), "weighted")
    total = known.agg(F.sum("source_size")).first()[0] or 0
    level, capped = 0.0, 0
    while True:  # each turn caps at least one more source, or ends
        full = F.col("weight") * level >= F.col("cap")
        a = known.agg(F.sum(F.when(full, F.col("cap")).otherwise(0.0)), F.sum(F.when(~full, F.col("weight")).otherwise(0.0)),
                      F.sum(full.cast("int"))).first()
        if level and a[2] == capped or not a[1]:
            break
        capped, level = a[2], max(0.0, share * total - a[0]) / a[1]
    return known.withColumn("target", F.least("cap", F.col("weight") * level))


def thresholds(sized: DataFrame, goals: DataFrame) -> DataFrame:
    """For each source its whole passes and the hash below which documents come once more."""
    passes = F.floor(F.col("target") / F.greatest("source_size", F.lit(1))).cast("long")
    open_ = goals.withColumn("passes", F.when(F.col("source_size") > 0, passes).otherwise(0)).select(
        "source", "passes", (F.col("target") - F.col("passes") * F.col("source_size")).alias("budget"), F.lit(0).cast("long").alias("prefix"))
    inside = sized.select("source", "size", "hash")
    for level in range(LEVELS):
        shift = LEVEL_BITS * (LEVELS - 1 - level)
        finer = F.shiftright("hash", shift)
        if level:  # only the documents of the boundary buckets are refined
            edge = open_.select(F.col("source").alias("s"), "prefix")
            inside = inside.join(edge, F.col("source").eqNullSafe(F.col("s")) & (F.shiftright("hash", shift + LEVEL_BITS) == F.col("prefix"))).select("source", "size", "hash")
        sums = inside.groupBy("source", finer.alias("bucket")).agg(F.sum("size").alias("tokens"))
        upto = sums.withColumn("upto", F.sum("tokens").over(W.partitionBy("source").orderBy("bucket")))
        joined = upto.join(open_.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s")))
        # the first bucket that the budget doesn't cover, and what is spent before it
        over = joined.filter(F.col("upto") > F.col("budget")).groupBy("source").agg(
            F.min(F.struct("bucket", (F.col("upto") - F.col("tokens")).alias("spent"), F.col("tokens"))).alias("edge"))
        open_ = materialise(open_.withColumnRenamed("source", "s").join(over, F.col("source").eqNullSafe(F.col("s")), "left").select(
            F.col("s").alias("source"), "passes",
            # a budget that covers all its buckets lets every document of the range in
            F.when(F.col("edge").isNull(), F.lit(1 << 60)).otherwise(F.col("edge.bucket")).alias("prefix"),
            (F.col("budget") - F.coalesce(F.col("edge.spent"), F.lit(0))).alias("budget"),
            F.coalesce(F.col("edge.tokens"), F.lit(0)).alias("tokens")), "thresholds")
        if level < LEVELS - 1:
            open_ = open_.drop("tokens")
    # the boundary itself comes along if that ends nearer to the target
    return open_.select("source", "passes", (F.col("prefix") + F.when(2 * F.col("budget") >= F.col("tokens"), 1).otherwise(0)).alias("below"))


def _plan(docs: DataFrame, weights, share: float, most: int) -> tuple[DataFrame, DataFrame]:
    """The documents' sizes, and of each source its target and how its documents are taken."""
    sized = materialise(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
                                    words().alias("size")).withColumn("hash", hash60()), "sizes")
    goals = materialise(targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, most), "targets")
    edge = thresholds(sized, goals).withColumnRenamed("source", "s2")
    plan = goals.join(edge, F.col("source").eqNullSafe(F.col("s2"))).select(F.col("source").alias("s"), "source_size", "target", "passes", "below")
    return sized, materialise(plan, "plan")


def _copies(most: int) -> Column:
    """Documents without a word cost no budget, so the most is held here too."""
    return F.least(F.col("passes") + (F.col("hash") < F.col("below")).cast("long"), F.lit(most))


def mix(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """doc_id, source, size, source_size, target and ``copies``, how often the mix has the document."""
    sized, plan = _plan(docs, weights, share, most)
    return sized.join(plan, F.col("source").eqNullSafe(F.col("s"))).select(
        "doc_id", "source", "size", "source_size", "target",
        _copies(most).alias("copies"))


def repeat(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """The documents with all their columns, each as often as the mix has it."""
    _, plan = _plan(docs, weights, share, most)
    whole = docs.select(F.struct(*docs.columns).alias("doc"), F.col("source").cast("string").alias("from"),
                        F.col("doc_id").cast("long").alias("doc_id")).withColumn("hash", hash60())
    met = whole.join(plan, F.col("from").eqNullSafe(F.col("s"))).select("doc", _copies(most).alias("copies")).filter("copies > 0")
    return met.select("doc", F.explode(F.sequence(F.lit(1).cast("long"), "copies"))).select("doc.*")


def digest(mixed: DataFrame) -> DataFrame:
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))
