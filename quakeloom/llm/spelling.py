"""Spelling variants by dense prefix-suffix tiling.

Two words differ by a single edit exactly when their common prefix and common suffix
together reach the longer length minus one. Blocks of words are laid out as padded
code-point matrices, one aligned to the left and one to the right, and pairs of blocks
are compared in bulk: the first column that differs is the length of the common prefix
or suffix.

Which blocks meet follows from the same sum. With ``d``, the lesser length minus one,
cut into quarters, near words agree in the first i quarters and in about the last 3 - i of
them, for some i. So the words of a *band* (those of a length and of the next) are sorted
by each of these four keys in turn, and only blocks that share a key are compared; a pair
counts at the first key that it agrees in. Keys that many words share are split into
blocks whose pairs go to different tasks; no group is larger than a block.

Words are counted in the tasks before the shuffle. A word follows its more frequent
near word; the ends of these chains come by pointer jumping over written tables, as
counts at least double from step to step.

Defined cases: a null text has no word, a null id counts as the empty text in the
checksum; repeated rows count again; other columns are ignored; an empty table gives no row.
Words of a long text are counted as they are read.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialise, ship, texts

#: Code points of a word and occurrences, at least; how many times as frequent a form is.
LENGTH, TIMES, RATIO = 5, 3, 2
#: Parts that the common prefix and suffix are cut into.
CUTS = 4
#: Words in a task's bin, in a block of a frequent key, and in the matrices compared at once.
BIN, BLOCK, TILE = 8192, 2048, 96
#: Distinct words that a task counts before it passes them on; characters of a text read at once.
HELD, SLICE = 200_000, 1 << 20

RUN = re.compile(rb"[a-z\xc0-\xff]+")


def tally(docs: DataFrame, slip: int = 0) -> DataFrame:
    """word and n: how often each run of letters occurs, A-Z lowered.

    Where ``slip`` divides the crc32 of ``<doc_id>:<run>``, the run counts without one of its code points.
    """
    def build(batches):
        held: dict[bytes, int] = {}
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                start = zlib.crc32(b":" if doc_id is None else b"%d:" % doc_id)
                for word, n in _runs(text.as_py()).items():
                    if slip:
                        h = zlib.crc32(word if word.isascii() else word.decode("latin-1").encode(), start)
                        if h % slip == 0:
                            at = h % len(word)
                            word = word[:at] + word[at + 1:]
                    held[word] = held.get(word, 0) + n
                if len(held) >= HELD:
                    yield _counted(held)
                    held = {}
        yield _counted(held)

    return texts(docs).mapInArrow(build, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def _runs(text: str) -> dict[bytes, int]:
    """The lowered runs of a text with their counts. They lie within Latin-1, where every code point is one byte."""
    found: dict[bytes, int] = {}
    get = found.get
    first, n = 0, len(text)
    while first < n:
        last = min(n, first + SLICE)
        while last < n and text[last] > " ":  # not inside a run
            last += 1
        for word in RUN.findall(text[first:last].encode("latin-1", "replace").lower()):
            found[word] = get(word, 0) + 1
        first = last
    return found


def _counted(held: dict[bytes, int]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([w.decode("latin-1") for w in held], pa.string()), pa.array(list(held.values()), pa.int64())], ["word", "n"])


# ---------------------------------------------------------------- near words

def quarters(d, i: int):
    """The lengths of prefix and suffix that near words agree in at key ``i``: of a number or a column."""
    upto = lambda k: (d * k - d * k % CUTS) / CUTS if isinstance(d, Column) else d * k // CUTS
    rest = d - upto(i + 1) + (1 if i + 1 < CUTS else 0)
    return (upto(i).cast("int"), rest.cast("int")) if isinstance(d, Column) else (upto(i), rest)


def keyed(words: DataFrame) -> DataFrame:
    """word, n, band (the lesser length), i and key: a row for each key in the word's two bands."""
    d = F.col("band") - 1
    keys = []
    for i in range(CUTS):
        prefix, suffix = quarters(d, i)
        end = F.reverse(F.substring(F.reverse("word"), F.lit(1), suffix))
        keys.append(F.struct(F.lit(i).alias("i"), F.concat(F.substring("word", F.lit(1), prefix), F.lit("\n"), end).alias("key")))
    banded = words.withColumn("band", F.explode(F.array(F.length("word"), F.length("word") - 1)))
    return banded.select("word", "n", "band", F.explode(F.array(*keys)).alias("k")).select("word", "n", "band", "k.i", "k.key")


def tiles(words: DataFrame) -> DataFrame:
    """The keyed words dealt to tiles: ``tile``, and ``side``, 0 in the bins; two blocks of a frequent key meet as sides 1 and 2."""
    rows = materialise(keyed(words), "word-keys")
    often = rows.groupBy("band", "i", "key").agg(F.count("*").alias("m")).filter(F.col("m") > BLOCK)
    often = materialise(often.withColumn("parts", F.ceil(F.col("m") / BLOCK).cast("int")).drop("m"), "frequent-keys")
    size = rows.groupBy("band", "i").agg((1 + F.floor(F.count("*") / BIN)).cast("int").alias("bins"))
    whole = rows.join(often, ["band", "i", "key"], "left_anti").join(materialise(size, "bands"), ["band", "i"])
    bins = whole.select("word", "n", "band", "i", "key", F.lit(0).alias("side"),
                        F.concat_ws(":", F.lit("bin"), "band", "i", F.pmod(F.xxhash64("key"), F.col("bins"))).alias("tile"))
    part = rows.join(often, ["band", "i", "key"]).withColumn("part", F.pmod(F.xxhash64("word"), F.col("parts")).cast("int"))
    meets = part.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    low, high = F.least("part", "other"), F.greatest("part", "other")
    split = meets.select("word", "n", "band", "i", "key", F.when(F.col("part") == F.col("other"), 0).when(F.col("part") < F.col("other"), 1).otherwise(2).alias("side"),
                         F.concat_ws(":", F.lit("key"), "band", "i", "key", low, high).alias("tile"))
    return bins.unionByName(split)


def matrices(words: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code points of words (a fixed-width array) aligned to the left and, read backwards, to the right; and the lengths.

    One column more than the longest word, so that a row always ends in padding.
    """
    codes = np.zeros((len(words), width + 1), np.uint32)
    plain = np.ascontiguousarray(words.astype(f"<U{width}")).view(np.uint32).reshape(len(words), width)
    codes[:, :width] = plain
    size = (plain != 0).sum(1)
    back = (size[:, None] - 1 - np.arange(width + 1)[None, :])
    right = np.where(back >= 0, np.take_along_axis(codes, np.maximum(back, 0), 1), 0)
    if codes.max(initial=0) < 256:
        codes, right = codes.astype(np.uint8), right.astype(np.uint8)
    return codes, right, size


def near_pairs(left: tuple, right: tuple, d: int, i: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows of two blocks of matrices whose words are a single edit apart, of lengths d + 1 or d + 2, at their first key only."""
    (a, ar, na), (b, br, nb) = left, right
    size_a, size_b = na[:, None], nb[None, :]
    # the one side's padding differs from the other's, so every row has a first column that differs
    prefix, suffix = ((x[:, None, :] != np.where(y == 0, 1, y).astype(y.dtype)[None, :, :]).argmax(2) for x, y in ((a, b), (ar, br)))
    longer, shorter = np.maximum(size_a, size_b), np.minimum(size_a, size_b)
    near = (prefix + suffix >= longer - 1) & (longer - shorter <= 1) & (shorter == d + 1) & ~((prefix == longer) & (size_a == size_b))
    x, y = np.nonzero(near)
    p, s = prefix[x, y], suffix[x, y]
    agrees = lambda k: (p >= quarters(d, k)[0]) & (s >= quarters(d, k)[1])
    first = agrees(i)
    for k in range(i):
        first &= ~agrees(k)
    return x[first], y[first]


def compare(group: pa.Table) -> pa.Table:
    """Of a tile's words: near words found, and the best of them (most frequent, then first in code-point order)."""
    # sorted by band and key, words of one key lie together
    group = group.sort_by([("band", "ascending"), ("i", "ascending"), ("key", "ascending"), ("word", "ascending")])
    word, n, side = (group.column(c).to_numpy() for c in ("word", "n", "side"))
    band, i = group.column("band").to_numpy(), group.column("i").to_numpy()
    key = group.column("key").combine_chunks().dictionary_encode()
    key = (key.chunk(0) if isinstance(key, pa.ChunkedArray) else key).indices.to_numpy()
    out: list[tuple] = []
    cut = np.flatnonzero(np.r_[True, (band[1:] != band[:-1]) | (i[1:] != i[:-1]), True])
    for a, b in zip(cut[:-1], cut[1:]):
        d, number, width = int(band[a]) - 1, int(i[a]), int(band[a]) + 1
        words = np.array(word[a:b].tolist(), f"<U{width}")
        whole = matrices(words, width)
        s = side[a:b]
        head = np.flatnonzero(np.r_[True, key[a + 1:b] != key[a:b - 1]])
        ends = np.repeat(np.r_[head[1:], b - a], np.diff(np.r_[head, b - a]))  # where a word's key ends
        for x in range(0, b - a, TILE):
            mine = slice(x, x + TILE)
            # words of the block's last key may reach into blocks behind it
            last = int(ends[min(x + TILE, b - a) - 1])
            for y in range(x, last, TILE):
                theirs = slice(y, y + TILE)
                p, q = near_pairs(tuple(m[mine] for m in whole), tuple(m[theirs] for m in whole), d, number)
                p, q = p + x, q + y
                once = (p < q) & ((s[p] == 0) | (s[p] != s[q]))
                out.append((p[once] + a, q[once] + a))
    p = np.concatenate([o[0] for o in out]) if out else np.zeros(0, np.int64)
    q = np.concatenate([o[1] for o in out]) if out else np.zeros(0, np.int64)
    mine, other = np.r_[p, q], np.r_[q, p]
    # by word, the best near word first: a word may stand in the tile under several keys
    order = np.lexsort((np.argsort(np.argsort(word))[other] if len(word) else other, -n[other], mine)) if len(mine) else mine
    mine, other = mine[order], other[order]
    head = np.flatnonzero(np.r_[True, mine[1:] != mine[:-1]]) if len(mine) else np.zeros(0, np.int64)
    count = np.diff(np.r_[head, len(mine)])
    return pa.table({"word": pa.array(word[mine[head]], pa.string()), "near": pa.array(count.astype(np.int64)),
                     "best": pa.array(word[other[head]], pa.string()), "best_n": pa.array(n[other[head]], pa.int64())})


def near(words: DataFrame) -> DataFrame:
    """word, n_near, best and best_n of words (word, n) that have a near word."""
    ship(words.sparkSession)
    found = tiles(words).groupBy("tile").applyInArrow(compare, "word string, near long, best string, best_n long")
    best = F.min(F.struct((-F.col("best_n")).alias("m"), "best"))
    return found.groupBy("word").agg(F.sum("near").alias("n_near"), best.alias("b")).select(
        "word", "n_near", F.col("b.best").alias("best"), (-F.col("b.m")).alias("best_n"))


def roots(forms: DataFrame) -> DataFrame:
    """word and root of (word, form): the last word that forms lead to. Each round doubles the steps taken."""
    at = materialise(forms.filter("form IS NOT NULL").select("word", F.col("form").alias("root")), "roots")
    while True:
        jump = at.select(F.col("word").alias("root"), F.col("root").alias("far"))
        after = materialise(at.join(jump, "root", "left").select("word", F.coalesce("far", "root").alias("root"), F.col("far").isNotNull().alias("went")), "roots")
        at = after.select("word", "root")
        if after.filter("went").isEmpty():
            return at


def group(docs: DataFrame, slip: int = 0) -> DataFrame:
    """word, form, root, n, n_near and form_n of every word that is long and frequent enough."""
    words = materialise(tally(docs, slip).filter((F.length("word") >= LENGTH) & (F.col("n") >= TIMES)), "words")
    form = F.col("best_n") >= RATIO * F.col("n")
    told = words.join(near(words), "word", "left").select(
        "word", F.when(form, F.col("best")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(form, F.col("best_n")).alias("form_n"))
    told = materialise(told, "forms")
    return told.join(roots(told), "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
