"""N-gram Jaccard join by set relations: block-skipped lists, answers derived from similar sets.

A document's set holds the fingerprints of its distinct word shingles. Documents with
equal sets are one class from the start. Exactness rests on the prefix filter: under
one global order of the shingles, two sets that reach the threshold share a shingle
among each one's first ``n - ceil(t n) + 1``. The order is by fingerprint, but shingles
that many documents share come last, so few prefixes hold them; which ones those are
is a matter of speed alone.

*Set relations.* Classes with min-hashes in common are compared to a central one of
them, the pivot, and join its family if they are like it at all. Only the pivot's
answers are computed from whole sets; a member's follow incrementally, from what it
lacks of its pivot and what it has beyond it. Members linked to their pivot are in
its component. Of a family's other pairs, one with a member too far from the pivot
must share shingles that the pivot lacks, so only members that share such are
compared, by a prefix filter of their own with the family's rarest additions first;
their overlap follows from the differences, and no whole set travels for it.
For pairs across families the overlap of the pivots bounds the members'; only pairs
that the bound leaves open are compared.

*Block skipping.* Lists are split into blocks of like set sizes, and a set is joined
with the blocks of its own size and the next only; the positions of shared shingles
and their number bound the overlap that is still possible.

Components spread by the least label with pointer jumping over written tables.

Defined cases: a null or empty text has an empty set and is a component of its own;
texts of fewer words than a shingle have one shingle, the whole; rows with equal
texts are linked; a null doc_id counts as no id for the least one; other columns are
ignored; an empty table gives no row.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import blocks, materialise, mix, prefix_hash, row_key, screen, span_hash, text_bytes, texts, word_hashes

#: Words of a shingle, and the least similarity in hundredths.
SHINGLE, PERCENT = 5, 80
#: Min-hashes by which classes find a pivot.
PIVOT_KEYS = 8
#: At most so many shingles are known as frequent (1 MB); beyond, the order is by fingerprint alone.
FREQUENT, FREQUENT_FROM = 1 << 17, 32
#: Shingles whose counts a task holds while it looks for frequent ones; beyond, it forgets the rarest.
HELD = 1 << 19
#: A family member has this Jaccard similarity to its pivot at least (in hundredths).
KIN = 50
#: Families from this size on move to their most typical member, told from so many of them.
LARGE, TOLD = 16, 64
#: Numbers that one task counts at once (8 MB).
PART_NUMBERS = 1_000_000


def shingle_sets(names: np.ndarray, at: np.ndarray, n: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """The rows' distinct shingles, ascending within a row, one row after another, and the rows' offsets."""
    prefix = prefix_hash(names)
    size = np.diff(at)
    count = np.where(size >= n, size - n + 1, (size > 0).astype(np.int64))
    first = np.repeat(at[:-1], count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    every = span_hash(prefix, first, first + np.minimum(np.repeat(size, count), n))
    cut = np.r_[0, np.cumsum(count)].tolist()
    for a, b in zip(cut[:-1], cut[1:]):
        every[a:b].sort()
    new = np.ones(len(every), bool)
    new[1:] = every[1:] != every[:-1]
    new[[c for c in cut[:-1] if c < len(every)]] = True
    return every[new], np.r_[0, np.cumsum(new)][cut]


def _sets(batches, n: int):
    for batch in batches:
        raw, at = text_bytes(batch.column(batch.schema.get_field_index("text")))
        for first, last in blocks(at):
            names, _, _, words = word_hashes(raw[at[first]:at[last]], at[first:last + 1] - at[first], lower=True)
            yield batch, first, last, *shingle_sets(names, words, n)


def _class_ids(every: np.ndarray, cut: np.ndarray) -> list[bytes]:
    """128-bit fingerprints of the rows' sets; empty for an empty set."""
    sums = [np.r_[np.uint64(0), np.cumsum(x, dtype=np.uint64)] for x in (every, mix(every))]
    both = np.stack([x[cut[1:]] - x[cut[:-1]] for x in sums], 1)
    return [both[i].tobytes() if full else b"" for i, full in enumerate(np.diff(cut) > 0)]


def frequent(rows: DataFrame, n: int) -> np.ndarray:
    """The most frequent of the shingles that recur within tasks.

    A task first counts by the leading bits of the fingerprint, in an array of fixed size; only shingles
    whose bits came up before are counted themselves.
    """
    def count(batches):
        seen = np.zeros(1 << 23, np.uint16)
        token, times = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        waiting, size, level = [], 0, 1

        def merged():
            every, where = np.unique(np.concatenate([token, *waiting]), return_inverse=True)
            return every, np.bincount(where, np.concatenate([times, np.ones(size, np.int64)]), len(every)).astype(np.int64)

        for _, _, _, every, _ in _sets(batches, n):
            slot = (every >> np.uint64(41)).astype(np.int64)
            np.add.at(seen, slot, np.uint16(1))
            waiting.append(every[seen[slot] > 2])
            size += len(waiting[-1])
            if size >= HELD:
                token, times = merged()
                waiting, size = [], 0
                while len(token) > HELD:  # forget the rarest
                    token, times, level = token[times > level], times[times > level], level + 1
        token, times = merged()
        many = times > 2
        yield pa.RecordBatch.from_arrays([pa.array(token[many].view(np.int64)), pa.array(times[many])], ["token", "n"])

    top = (rows.select("text").mapInArrow(count, "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))
           .filter(F.col("n") >= FREQUENT_FROM).orderBy(F.desc("n"), "token").limit(FREQUENT))
    return np.sort(np.array([r[0] for r in top.collect()], np.int64).view(np.uint64))


def prefix_of(shingles: np.ndarray, often: np.ndarray, percent: int) -> tuple[np.ndarray, float]:
    """The set's first shingles in the order, the frequent ones last, else by fingerprint; and where in the order they end."""
    n = len(shingles)
    length = n + 1 - -(-percent * n // 100)
    for most in (2 * length, n):
        head = shingles[:most]
        rare = head[~_in(often, head)]
        if len(rare) >= length or most >= n:
            break
    few = len(rare) < length
    if few:
        rare = np.concatenate([rare, shingles[_in(often, shingles)]])
    return rare[:length], float(rare[length - 1]) / 2.0**64 + few


def _in(ordered: np.ndarray, values: np.ndarray) -> np.ndarray:
    if not len(ordered):
        return np.zeros(len(values), bool)
    return ordered[np.minimum(np.searchsorted(ordered, values), len(ordered) - 1)] == values


def described(rows: DataFrame, n: int, percent: int) -> DataFrame:
    """k1, k2, doc_id, n, c (fingerprint of the set), keys (min-hashes), prefix and stop (its end in the order) of each row."""
    spark = rows.sparkSession
    often = spark.sparkContext.broadcast(frequent(rows, n))

    def build(batches):
        for batch, first, last, every, cut in _sets(batches, n):
            size, rows_ = np.diff(cut), np.flatnonzero(np.diff(cut))
            least = np.zeros((last - first, PIVOT_KEYS), np.uint64)
            for k in range(PIVOT_KEYS if len(every) else 0):  # an odd factor orders fingerprints anew
                least[rows_, k] = np.minimum.reduceat(every * np.uint64(0x9E3779B97F4A7C15 ^ (k << 33)), cut[rows_])
            keys = mix(least + np.arange(1, PIVOT_KEYS + 1, dtype=np.uint64)[None, :]).view(np.int64)
            prefix = [prefix_of(every[a:b], often.value, percent) if b > a else (every[:0], 0.0) for a, b in zip(cut[:-1].tolist(), cut[1:].tolist())]
            rest = [batch.column(batch.schema.get_field_index(x)).slice(first, last - first) for x in ("k1", "k2", "doc_id")]
            yield pa.RecordBatch.from_arrays(
                [*rest, pa.array(size.astype(np.int32)), pa.array(_class_ids(every, cut), pa.binary()),
                 pa.array([k if full else [] for k, full in zip(keys, size > 0)], pa.list_(pa.int64())),
                 pa.array([p.view(np.int64) for p, _ in prefix], pa.list_(pa.int64())), pa.array([e for _, e in prefix], pa.float64())],
                ["k1", "k2", "doc_id", "n", "c", "keys", "prefix", "stop"])

    return rows.mapInArrow(build, "k1 long, k2 long, doc_id long, n int, c binary, keys array<long>, prefix array<long>, stop double")


def mark(c: Column) -> Column:
    """The leading 64 bits of a set's fingerprint, for screens."""
    return F.conv(F.hex(F.substring(c, 1, 8)), 16, -10).cast("long")


def one_each(table: DataFrame) -> DataFrame:
    """The described rows with a shingle, one of each set: rows without an equal pass without a shuffle where the screen applies."""
    rows = table.filter("n > 0")
    groups = rows.groupBy("c").agg(F.count("*").alias("m"), F.min(F.struct("k1", "k2")).alias("k")).filter("m > 1").select("c", "k")
    groups = materialise(groups, "equal-sets")
    twice, lone = screen(rows, mark(F.col("c")), groups.select(mark(F.col("c")).alias("h")).distinct())
    met = twice.join(groups, "c", "left").filter(F.col("k").isNull() | ((F.col("k.k1") == F.col("k1")) & (F.col("k.k2") == F.col("k2"))))
    # whole rows that repeat agree in their keys too
    alone, again = met.filter("k IS NULL").select(*rows.columns), met.filter("k IS NOT NULL").dropDuplicates(["c"]).select(*rows.columns)
    kept = alone.unionByName(again)
    return kept if lone is None else kept.unionByName(lone)


def repeated(lists: DataFrame, column: str) -> DataFrame:
    """token: the numbers that occur more than once in the lists.

    Tasks pack their distinct numbers by a part of them, so a row of the shuffle is a block of numbers
    rather than a number, and a frequent one comes once a block; each part is counted by itself.
    """
    total = lists.agg(F.sum(F.size(column))).first()[0] or 0
    parts = 1 + total // PART_NUMBERS

    def pack(batches):
        for batch in batches:
            held = batch.column(0).flatten().to_numpy(zero_copy_only=False).view(np.uint64)
            token, times = np.unique(held, return_counts=True)
            part = (token % np.uint64(parts)).astype(np.int64)
            order = np.argsort(part, kind="stable")
            cut = np.searchsorted(part[order], np.arange(parts + 1))
            used = np.flatnonzero(np.diff(cut))
            # what a block holds twice is written twice
            blocks_ = [np.repeat(token[order[cut[p]:cut[p + 1]]], np.minimum(times[order[cut[p]:cut[p + 1]]], 2)).tobytes() for p in used]
            yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(blocks_, pa.binary())], ["part", "tokens"])

    def count(group: pa.Table) -> pa.Table:
        every = np.sort(np.concatenate([np.frombuffer(t, np.int64) for t in group.column("tokens").to_pylist()]))
        again = every[1:][every[1:] == every[:-1]]
        return pa.table({"token": np.unique(again)})

    return lists.select(column).mapInArrow(pack, "part int, tokens binary").groupBy("part").applyInArrow(count, "token long")


def overlaps(rows: DataFrame, classes: DataFrame, pairs: DataFrame, n: int, beyond: bool = False) -> DataFrame:
    """pairs (a, na, b, nb) with ``o``, the size of the intersection of the two sets, and for kin ``added`` and ``gone``, a without b and b without a.

    The one set of each pair travels to the other, once a pair; of the documents only those of a pair travel.
    Other columns of the pairs stay.
    """
    kept = [c for c in pairs.columns if c not in ("a", "b")]
    keyed = classes.select("c", "k1", "k2")
    left = pairs.join(keyed.withColumnRenamed("c", "a"), "a").groupBy("k1", "k2").agg(
        F.first("a").alias("c"), F.collect_list(F.struct("b", *kept)).alias("to"))
    right = keyed.join(pairs.select(F.col("b").alias("c")).distinct(), "c").select("k1", "k2", "c")

    def sets_of(wanted: DataFrame, label: str) -> DataFrame:
        wanted = materialise(wanted, label)
        near, _ = screen(rows.select("k1", "k2", "text"), F.col("k2"), wanted.select("k2").distinct())
        more = [c for c in wanted.columns if c not in ("k1", "k2")]

        def build(batches):
            for batch, first, last, every, cut in _sets(batches, n):
                sets = pa.ListArray.from_arrays(pa.array(cut.astype(np.int32)), pa.array(every.view(np.int64)))
                rest = [batch.column(batch.schema.get_field_index(x)).slice(first, last - first) for x in more]
                yield pa.RecordBatch.from_arrays([*rest, sets], [*more, "s"])

        met = near.join(wanted, ["k1", "k2"]).select(*more, "text")
        schema = ", ".join(f"{c} {wanted.schema[c].dataType.simpleString()}" for c in more)
        return met.mapInArrow(build, f"{schema}, s array<bigint>")

    sent = sets_of(left, "left").select(F.col("c").alias("a"), F.col("s").alias("sa"), F.explode("to").alias("t")).select("a", "sa", "t.*")
    met = sent.join(sets_of(right, "right").select(F.col("c").alias("b"), F.col("s").alias("sb")), "b")
    found = met.select("a", "b", *kept, F.size(F.array_intersect("sa", "sb")).alias("o"),
                       *([F.array_except("sa", "sb").alias("added"), F.array_except("sb", "sa").alias("gone")] if beyond else []))
    if beyond:
        like = enough(F.col("o"), F.col("na"), F.col("nb"), KIN)
        found = found.withColumns({x: F.when(like, F.col(x)) for x in ("added", "gone")})
    return materialise(found.dropDuplicates(["a", "b"]), "overlaps")


def enough(o: Column, na: Column, nb: Column, percent: int) -> Column:
    return F.lit(100) * o >= F.lit(percent) * (na + nb - o)


def alike(na: Column, nb: Column, percent: int) -> Column:
    """Sizes that don't rule the threshold out."""
    return (F.lit(100) * F.least(na, nb)) >= (F.lit(percent) * F.greatest(na, nb))


def kin(rows: DataFrame, classes: DataFrame, n: int, percent: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Links of classes to pivots; the families; and the members with what they have beyond their roots and lack of them.

    A family row has c, n, stop, root, away (shingles of the root that c lacks), extra (of c that the root
    lacks) and near (linked to the root); a member c, n, root, o (shingles shared with it), near, added and gone.
    """
    keys = classes.select("c", "n", F.explode("keys").alias("key"))
    shared = materialise(keys.withColumn("m", F.count("*").over(W.partitionBy("key"))).filter("m > 1"), "shared-keys")
    # a class whose keys many others have is central: an unedited copy rather than an edited one
    ranked = shared.join(shared.groupBy("c").agg(F.sum("m").alias("score")), "c")
    pivots = ranked.groupBy("key").agg(F.max(F.struct("score", "c", "n")).alias("p"))
    met = (ranked.join(pivots, "key").filter((F.col("c") != F.col("p.c")) & alike(F.col("n"), F.col("p.n"), 50))
           .groupBy(F.col("c").alias("a"), F.col("n").alias("na"), "p").agg(F.count("*").alias("m")).filter("m > 1"))
    # each class is compared to the most central pivot and to the one it has most in common with
    two = met.groupBy("a", "na").agg(F.array_distinct(F.array(F.max(F.struct("p", "m"))["p"], F.max(F.struct("m", "p"))["p"])).alias("ps"))
    pairs = materialise(two.select("a", "na", F.explode("ps").alias("p")).select("a", "na", F.col("p.c").alias("b"), F.col("p.n").alias("nb"), "p.score"), "pivot-pairs")
    known = overlaps(rows, classes, pairs, n, beyond=True)
    near = enough(F.col("o"), F.col("na"), F.col("nb"), percent)
    links = known.filter(near).select("a", "b")
    best = known.filter(F.col("added").isNotNull()).groupBy(F.col("a").alias("c")).agg(
        F.max(F.struct("score", F.col("b").alias("root"))).alias("x")).select("c", "x.root")
    # a pivot that is a member itself founds no family
    best = materialise(best.join(best.select(F.col("c").alias("root")), "root", "left_anti"), "kin")
    kin_rows = known.select(F.col("a").alias("c"), F.col("na").alias("n"), F.col("b").alias("root"), F.col("nb").alias("nr"), "added", "gone").join(best, ["c", "root"], "left_semi")
    members = materialise(moved(materialise(kin_rows, "members")), "moved")
    o = F.col("n") - F.size("added")
    near = enough(o, F.col("n"), F.col("nr"), percent)
    links = links.unionByName(members.filter(near & (F.col("c") != F.col("root"))).select(F.col("c").alias("a"), F.col("root").alias("b"))).distinct()
    kept = members.filter(enough(o, F.col("n"), F.col("nr"), KIN) & (F.col("c") != F.col("root"))).select(
        F.col("c").alias("k"), F.col("n").alias("nk"), "root", F.size("gone").alias("away"), F.size("added").alias("extra"), near.alias("near"), "added", "gone")
    family = classes.select("c", "n", "stop").join(kept.drop("nk", "added", "gone"), F.col("c") == F.col("k"), "left").select(
        "c", "n", "stop", F.coalesce("root", "c").alias("root"), F.coalesce("away", F.lit(0)).alias("away"),
        F.coalesce("extra", F.lit(0)).alias("extra"), F.coalesce("near", F.lit(True)).alias("near"))
    return materialise(links, "pivot-links"), materialise(family, "families"), kept.select(
        F.col("k").alias("c"), F.col("nk").alias("n"), "root", (F.col("nk") - F.col("extra")).alias("o"), "near", "added", "gone")


def moved(members: DataFrame) -> DataFrame:
    """Members (c, n, root, nr, added, gone), and the roots themselves, of large families seen from their most typical member.

    The differences from the root that most of some members have make up what is typical of the family; of
    all members the one that differs least from that is the new root. What the others differ by from it
    follows from what both differ by from the old root.
    """
    none = F.array().cast("array<bigint>")
    roots = members.groupBy(F.col("root").alias("c"), F.col("nr").alias("n")).agg(F.count("*").alias("m"))
    own = roots.filter(F.col("m") >= LARGE).select("c", "n", F.col("c").alias("root"), F.col("n").alias("nr"), none.alias("added"), none.alias("gone"))
    every = members.unionByName(own)
    some = members.join(own.select("root"), "root", "left_semi").withColumn("i", F.row_number().over(W.partitionBy("root").orderBy("c"))).filter(F.col("i") <= TOLD)
    told = some.groupBy("root").agg(F.count("*").alias("m"))
    differs = some.select("root", F.explode(F.concat("added", "gone")).alias("token")).groupBy("root", "token").agg(F.count("*").alias("k"))
    usual = differs.join(told, "root").filter(2 * F.col("k") > F.col("m")).groupBy("root").agg(F.collect_list("token").alias("usual"))
    usual = materialise(usual, "usual-differences")
    from_root = F.concat("added", "gone")
    away = F.size(from_root) + F.size("usual") - 2 * F.size(F.array_intersect(from_root, "usual"))
    chosen = every.join(usual, "root").groupBy("root").agg(F.min(F.struct(away, "c")).alias("x")).select("root", F.col("x.c").alias("c"))
    hub = materialise(every.join(chosen, ["root", "c"]).select("root", F.col("c").alias("hub"), F.col("n").alias("nh"), F.col("added").alias("plus"), F.col("gone").alias("minus")), "hubs")
    far = every.join(hub, "root", "left")
    seen = lambda a, b, c, d: F.concat(F.array_except(a, b), F.array_except(c, d))
    to = F.col("hub").isNotNull()
    return far.select("c", "n", F.coalesce("hub", "root").alias("root"), F.coalesce("nh", "nr").alias("nr"),
                      F.when(to, seen("added", "plus", "minus", "gone")).otherwise(F.col("added")).alias("added"),
                      F.when(to, seen("plus", "added", "gone", "minus")).otherwise(F.col("gone")).alias("gone"))


def within(beyond: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) between members of one family, one of them far from the root at least.

    Both overlap the root in some of its shingles; what a link needs beyond the lesser overlap they must
    share among what the root lacks. So the prefix filter holds for these additions too, in an order by the
    number of the family's members that have them: one that many share is in few prefixes. A link needs no
    addition only if one of the two is smaller than the root by enough, so such pairs meet by their sizes.
    The overlap of the pairs found follows from what either has beyond the root and lacks of it.
    """
    facts = ["c", "root", "n", "o", "near"]
    members = beyond.select(*facts)
    tokens = materialise(repeated(beyond, "added"), "shared-additions")
    listed, _ = screen(beyond.select(*facts, F.explode("added").alias("token")), F.col("token"), tokens)
    one = W.partitionBy("root", "token")
    listed = listed.withColumns({"f": F.count("*").over(one), "far": F.count_if(~F.col("near")).over(one)}).filter((F.col("f") > 1) & (F.col("far") > 0))
    own = W.partitionBy("root", "c")
    listed = listed.withColumns({"m": F.count("*").over(own), "i": F.row_number().over(own.orderBy("f", "token"))})
    # what c has to share with the least partner there may be; its last additions but as many are the prefix
    least = F.ceil(percent * F.col("n") / 100)
    short = F.ceil(percent * (F.col("n") + least) / (100 + percent)) - F.col("o")
    listed = listed.filter(F.col("i") <= F.col("m") - F.greatest(short, F.lit(1)) + 1)
    listed = materialise(listed.select(*facts, "token", (F.col("m") - F.col("i") + 1).alias("rest")), "additions")
    named = lambda df, *more: df.select(*(F.col(x).alias(f"l_{x}") for x in (*facts, *more)))
    both = (F.col("l_root") == F.col("root")) & ~(F.col("l_near") & F.col("near")) & alike(F.col("l_n"), F.col("n"), percent)
    need = lambda most: (100 + percent) * most >= percent * (F.col("l_n") + F.col("n"))
    sharing = named(listed, "token", "rest").join(listed, both & (F.col("l_token") == F.col("token")) & (F.col("l_c") < F.col("c"))
                                                  & need(F.least("l_rest", "rest") + F.least("l_o", "o")))
    # of the far ones, those that lie in the root mostly, with each size that the other may have
    last = F.floor((100 + percent) * F.col("o") / percent).cast("int") - F.col("n")
    first = F.ceil(percent * F.col("n") / 100).cast("int")
    far = members.filter(~F.col("near") & (last >= first)).withColumn("size", F.explode(F.sequence(first, last)))
    inside = named(far, "size").join(members, both & (F.col("l_size") == F.col("n")) & (F.col("l_c") != F.col("c")) & need(F.least("l_o", "o")))
    found = sharing.select("l_c", "c").unionByName(inside.select(F.least("l_c", "c").alias("l_c"), F.greatest("l_c", "c").alias("c"))).distinct()
    found = materialise(found, "family-pairs")
    side = beyond.select("c", "n", "o", "added", "gone")
    met = found.join(side, "c").join(side.select(*(F.col(x).alias(f"l_{x}") for x in side.columns)), "l_c")
    shared = F.size(F.array_intersect("added", "l_added")) + F.size(F.array_intersect("gone", "l_gone")) + F.col("o") - F.size("l_gone")
    return met.filter(enough(shared, F.col("l_n"), F.col("n"), percent)).select(F.col("l_c").alias("a"), F.col("c").alias("b"))


def joined(classes: DataFrame, links: DataFrame) -> DataFrame:
    """c and the pivot it is linked to, or the pivot's own: classes with one such are connected already."""
    up = links.groupBy(F.col("a").alias("from")).agg(F.min("b").alias("up"))
    one = classes.select("c").join(up, F.col("c") == F.col("from"), "left").select("c", F.coalesce("up", "c").alias("via"))
    two = one.join(up, F.col("via") == F.col("from"), "left")
    return materialise(two.select("c", F.coalesce("up", "via").alias("met")), "joined")


def candidates(classes: DataFrame, family: DataFrame, beyond: DataFrame, met: DataFrame, percent: int) -> DataFrame:
    """Pairs of different roots, not connected already, whose families can hold a link: a, na, b, nb.

    The prefix that ends first in the order has all its common shingles in the other prefix, so those
    found in the lists, and what follows that prefix, bound the overlap; so does what follows the
    first common shingle in either set.
    """
    shared = materialise(repeated(classes, "prefix"), "shared-shingles")
    # most classes are their own root and need not be looked up among the members
    roots = beyond.select("c", "root")
    some, alone = screen(classes.select("c", "n", "prefix"), mark(F.col("c")), beyond.select(mark(F.col("c")).alias("h")).distinct())
    rooted = some.join(roots, "c", "left").select(F.coalesce("root", "c").alias("root"), "n", "prefix")
    if alone is not None:
        rooted = rooted.unionByName(alone.select(F.col("c").alias("root"), "n", "prefix"))
    block = F.floor(F.log(F.col("n").cast("double")) / (F.log(F.lit(100.0 / percent)) * 1.0001)).cast("int")
    some, rare = screen(rooted.select("root", "n", F.posexplode("prefix").alias("i", "token")), F.col("token"), shared)
    if rare is None:
        some = some.join(shared, "token", "left_semi")
    # one entry for a family in a block of a list: its sizes and its earliest position
    listed = some.select("token", "root", "n", "i", block.alias("block")).repartition("token").groupBy("token", "block", "root").agg(
        F.min("n").alias("least"), F.max("n").alias("most"), F.max(F.col("n") - F.col("i")).alias("rest"))
    # lists of one family join nothing
    one = W.partitionBy("token")
    listed = listed.withColumns({"from": F.min("root").over(one), "to": F.max("root").over(one)}).filter(F.col("from") < F.col("to")).drop("from", "to")
    listed = materialise(listed, "lists")
    left = listed.select(*(F.col(x).alias(f"l_{x}") for x in listed.columns), F.explode(F.array(F.lit(0), F.lit(1))).alias("step"))
    shares = left.join(listed, (F.col("l_token") == F.col("token")) & (F.col("l_block") + F.col("step") == F.col("block"))
                    & (F.col("l_root") != F.col("root"))
                    & ((F.col("step") == 1) | (F.col("l_root") < F.col("root")))
                    & (100 * F.col("l_most") >= percent * F.col("least")) & (100 * F.col("most") >= percent * F.col("l_least")))
    pairs = shares.groupBy(F.least("l_root", "root").alias("a"), F.greatest("l_root", "root").alias("b")).agg(
        F.count("*").alias("common"), F.max(F.least("l_rest", "rest")).alias("rest"))
    spans = family.groupBy("root").agg(F.min("near").alias("near"), *(f(x).alias(f"{x}_{f.__name__}") for x in ("n", "stop") for f in (F.min, F.max)),
                                       F.max(F.when(F.col("c") == F.col("root"), F.col("n"))).alias("n"))
    spans = materialise(spans.join(met.withColumnRenamed("c", "root"), "root"), "spans")
    side = lambda x: spans.withColumnsRenamed({"root": x, "n": f"n{x}", "met": f"met_{x}", "near": f"near_{x}", **{f"{c}_{f}": f"{c}_{f}_{x}" for c in ("n", "stop") for f in ("min", "max")}})
    both = pairs.join(side("a"), "a").join(side("b"), "b")
    follows = lambda x: F.ceil(percent * F.col(f"n_max_{x}") / 100) - 1
    after = (F.when(F.col("stop_max_a") < F.col("stop_min_b"), follows("a")).when(F.col("stop_max_b") < F.col("stop_min_a"), follows("b"))
             .otherwise(F.greatest(follows("a"), follows("b"))))
    need = percent * (F.col("n_min_a") + F.col("n_min_b"))
    can = ((100 + percent) * (F.col("common") + after) >= need) & ((100 + percent) * F.col("rest") >= need)
    apart = (F.col("met_a") != F.col("met_b")) | ~F.col("near_a") | ~F.col("near_b")
    return materialise(both.filter(can & apart).select("a", "na", "b", "nb"), "root-pairs")


def across(met: DataFrame, family: DataFrame, percent: int) -> DataFrame:
    """Pairs of members of two families whose roots' overlap leaves a link open, other than the roots themselves."""
    stats = family.groupBy("root").agg(
        F.min("n").alias("least"), F.max("n").alias("most"), F.max("extra").alias("extra"), F.max("away").alias("away"),
        F.count("*").alias("members"), F.min("near").alias("near"))
    stats = materialise(stats, "family-sizes")
    side = lambda x: stats.withColumnsRenamed({"root": x, **{c: f"{x}_{c}" for c in ("least", "most", "extra", "away", "members", "near")}})
    member = lambda x: family.select(F.col("root").alias(f"root_{x}"), *(F.col(c).alias(f"{x}{c}") for c in ("c", "n", "away", "extra", "near")))
    c = F.col
    linked = enough(c("o"), c("na"), c("nb"), percent)
    need = lambda most, na, nb: (100 + percent) * most >= percent * (na + nb)
    open_ = met.join(side("a"), "a").join(side("b"), "b").filter(
        (c("a_members") + c("b_members") > 2) & (~linked | ~c("a_near") | ~c("b_near")))
    # of a root's overlap with a set, a member keeps no more than it has of the root, and adds no more than it has beyond
    some = F.least(c("o") + c("b_extra"), c("na") - c("yaway")) + F.least(c("yextra"), c("b_most") - c("o") + c("b_away"))
    left = open_.join(member("y"), (c("a") == c("root_y")) & need(some, c("yn"), c("b_least"))
                      & ((c("b_members") > 1) | (c("yc") != c("a"))))
    high = F.least(c("o"), c("nb") - c("zaway")) + F.least(c("zextra"), c("na") - c("o"))
    most = F.least(high, c("na") - c("yaway")) + F.least(c("yextra"), c("zn") - c("o") + c("zaway"))
    again = F.least(c("o"), c("na") - c("yaway")) + F.least(c("yextra"), c("nb") - c("o"))
    other = F.least(again, c("nb") - c("zaway")) + F.least(c("zextra"), c("yn") - c("o") + c("yaway"))
    both = left.join(member("z"), (c("b") == c("root_z")) & need(F.least(most, other), c("yn"), c("zn")) & alike(c("yn"), c("zn"), percent)
                     & ((c("yc") != c("a")) | (c("zc") != c("b"))) & (~linked | ~c("ynear") | ~c("znear")))
    return both.select(c("yc").alias("a"), c("yn").alias("na"), c("zc").alias("b"), c("zn").alias("nb"))


def class_links(rows: DataFrame, classes: DataFrame, n: int, percent: int) -> DataFrame:
    """Links (a, b) between classes from which every other link's ends can be reached."""
    own, family, beyond = kin(rows, classes, n, percent)
    linked = enough(F.col("o"), F.col("na"), F.col("nb"), percent)
    met = overlaps(rows, classes, candidates(classes, family, beyond, joined(classes, own), percent), n)
    finer = materialise(across(met, family, percent).distinct(), "member-pairs")
    found = own.unionByName(met.filter(linked).select("a", "b")).unionByName(within(beyond, percent))
    if not finer.isEmpty():
        found = found.unionByName(overlaps(rows, classes, finer, n).filter(linked).select("a", "b"))
    return materialise(found, "links")


def spread(links: DataFrame) -> DataFrame:
    """c, label: the least class reachable, for every class with a link."""
    both = materialise(links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    labels = materialise(both.groupBy(F.col("a").alias("c")).agg(F.least(F.min("b"), F.col("c")).alias("label")), "labels")
    while True:
        offered = both.join(labels.withColumnsRenamed({"c": "b", "label": "offer"}), "b").groupBy(F.col("a").alias("c")).agg(F.min("offer").alias("offer"))
        lower = labels.join(offered, "c").select("c", F.col("label").alias("old"), F.least("label", "offer").alias("label"))
        jump = labels.withColumnsRenamed({"c": "via", "label": "far"})
        after = materialise(lower.join(jump, F.col("label") == F.col("via"), "left").select(
            "c", "old", F.least("label", F.coalesce("far", "label")).alias("label")), "labels")
        labels = after.select("c", "label")
        if after.filter("old <> label").isEmpty():
            return labels


def labelled(docs: DataFrame, n: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """The rows (k1, k2, doc_id, n, c) and, of every class with a shingle, c and the label of its component."""
    rows = row_key(texts(docs))
    table = materialise(described(rows, n, percent), "described")
    classes = materialise(one_each(table).drop("doc_id"), "classes")
    labels = spread(class_links(rows, classes, n, percent))
    every = classes.select("c").join(labels, "c", "left").select("c", F.coalesce("label", "c").alias("label"))
    return table.select("k1", "k2", "doc_id", "n", "c"), materialise(every, "components")


def components(docs: DataFrame, n: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles and component_id, the least doc_id reachable by links; a row for each input row."""
    rows, labels = labelled(docs, n, percent)
    ids = rows.filter("n > 0").groupBy("c").agg(F.min("doc_id").alias("least")).join(labels, "c")
    ids = materialise(ids, "least-ids")
    least = ids.groupBy("label").agg(F.min("least").alias("component_id"))
    by_class = ids.join(least, "label").select(F.col("c").alias("k"), "component_id")
    found = rows.join(by_class, F.col("c") == F.col("k"), "left")
    return found.select("doc_id", F.col("n").cast("long").alias("n_shingles"),
                        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))


def keep_one(docs: DataFrame, n: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """The documents with all their columns, of each component the row with the least id (of texts without a word, all).

    Documents alone in their component pass without a shuffle where the screen applies.
    """
    rows, labels = labelled(docs, n, percent)
    tagged = materialise(rows.filter("n > 0").join(labels, "c").select("label", "k1", "k2"), "tagged")
    groups = tagged.groupBy("label").agg(F.count("*").alias("m"), F.min(F.struct("k1", "k2")).alias("least")).filter("m > 1")
    groups = materialise(groups.select("label", F.col("least.k1").alias("o1"), F.col("least.k2").alias("o2")), "groups")
    stays = (F.col("k1") == F.col("o1")) & (F.col("k2") == F.col("o2"))
    told = materialise(tagged.join(groups, "label").select("k1", "k2", stays.alias("stays")).distinct(), "decided")
    whole = row_key(docs.select(F.struct(*docs.columns).alias("doc"), F.col("doc_id").cast("long").alias("doc_id"),
                                F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")))
    hit, clean = screen(whole, F.col("k2"), told.select("k2").distinct())
    met = hit.select("doc", "k1", "k2").join(told, ["k1", "k2"], "left")
    alone = met.filter("stays IS NULL").select("doc.*")
    one = met.filter("stays").groupBy("k1", "k2").agg(F.first("doc").alias("doc")).select("doc.*")
    kept = alone.unionByName(one)
    return kept if clean is None else kept.unionByName(clean.select("doc.*"))


def digest(found: DataFrame) -> DataFrame:
    return found.select("doc_id", "n_shingles", "component_id")
