"""Periodic runs of words by Baier grouping: Lyndon arrays under both orders, roots extended into runs.

The first phase of Baier's suffix sorter handles groups of suffixes from the highest
down. A group's *context* is the word its members share; when a group is handled, the
nearest place to the left that isn't handled yet gets the group's context added to its
own, so it moves to a new group. A member's context at the time its group is handled is
the longest Lyndon word that starts there, so the phase yields the Lyndon array without
sorting the rest. Every run holds a root that is such a word under the order of the
words or under its reverse; common extensions to the right and the left make it a run.

Documents are independent, so the work is one pass over the partitions without a
shuffle. Words are exact numbers, not hashes. A run of exponent four or more holds each
of its words four times, so a word that occurs less often in a stretch cuts the stretch;
the word behind a run's end that continued it would occur in the run, hence is no cut.

Defined cases: a null or empty text has no words, no runs and an empty rest; repeated rows
give a row each; other columns are ignored; an empty table gives none. Texts are numbered in
slices, so a very long one costs 4 bytes a word and a few arrays of that size.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import blocks, text_bytes, texts, word_numbers

#: A run is at least so many words long, and so many times its period.
LEAST, TIMES = 6, 4
#: Bytes of text handled at once.
BLOCK = 1 << 19
RUN = "struct<start:bigint,length:bigint,period:bigint>"


def lyndon(word: list[int]) -> list[int]:
    """Length of the longest Lyndon word from each place on, the end counting as the smallest letter."""
    places: dict[int, list[int]] = {}
    for i, letter in enumerate(word):
        places.setdefault(letter, []).append(i)
    members = [places[letter] for letter in sorted(places)]
    group = [0] * len(word)
    for number, own in enumerate(members):
        for i in own:
            group[i] = number
    context = [1] * len(members)
    lower = list(range(-1, len(members) - 1))
    higher = [*range(1, len(members)), -1]
    left = list(range(-1, len(word) - 1))  # of a handled place: one to the left with none unhandled between
    length = [0] * len(word)
    top = len(members) - 1
    while top >= 0:
        size = context[top]
        own = [i for i in members[top] if group[i] == top]
        for i in own:
            length[i] = size
        times: dict[int, int] = {}
        for i in own:
            j = left[i]
            while j >= 0 and length[j]:
                far = left[j]
                if far >= 0 and length[far]:
                    left[j] = far = left[far]
                j = far
            left[i] = j
            if j >= 0:
                times[j] = times.get(j, 0) + 1
        moved: dict[tuple[int, int], list[int]] = {}
        for j, k in times.items():
            moved.setdefault((k, group[j]), []).append(j)
        for k, old in sorted(moved, reverse=True):  # the more often the context follows, the higher
            new = len(members)
            members.append(moved[k, old])
            context.append(context[old] + k * size)
            for j in members[new]:
                group[j] = new
            above = higher[old]
            lower.append(old)
            higher.append(above)
            higher[old] = new
            lower[above] = new
        top = lower[top]
    return length


def common_right(word: np.ndarray, a: int, b: int, stop: int) -> int:
    """Length of the longest common extension of places a < b to the right, up to ``stop``."""
    done, size = 0, 32
    while (size := min(size, stop - b - done)) > 0:
        differ = word[a + done:a + done + size] != word[b + done:b + done + size]
        if (at := int(differ.argmax())) or differ[0]:
            return done + at
        done, size = done + size, size * 2
    return done


def common_left(word: np.ndarray, a: int, b: int, first: int) -> int:
    """The same to the left, of the places before a < b, down to ``first``."""
    done, size = 0, 32
    while (size := min(size, a - first - done)) > 0:
        differ = (word[a - done - size:a - done] != word[b - done - size:b - done])[::-1]
        if (at := int(differ.argmax())) or differ[0]:
            return done + at
        done, size = done + size, size * 2
    return done


def stretches(ids: np.ndarray, at: np.ndarray, least: int = LEAST, times: int = TIMES) -> np.ndarray:
    """First and last places (end exclusive) of the stretches in which each word occurs ``times`` times."""
    place = np.arange(len(ids), dtype=np.int64)
    part = np.repeat(np.arange(len(at) - 1, dtype=np.int64), np.diff(at))
    most = int(ids.max()) + 1 if len(ids) else 1
    while len(place):
        _, which, count = np.unique(part * most + ids[place], return_inverse=True, return_counts=True)
        often = count[which] >= times
        place, old = place[often], part[often]
        cut = np.ones(len(place), bool)
        cut[1:] = (place[1:] != place[:-1] + 1) | (old[1:] != old[:-1])
        part = np.cumsum(cut) - 1
        long = np.bincount(part, minlength=1)[part] >= least if len(part) else np.zeros(0, bool)
        if often.all() and long.all():
            break
        place, part = place[long], part[long]
    head = np.flatnonzero(np.r_[True, part[1:] != part[:-1]]) if len(part) else np.zeros(0, np.int64)
    tail = np.r_[head[1:], len(part)]
    return np.stack([place[head], place[tail - 1] + 1], 1) if len(head) else np.zeros((0, 2), np.int64)


def runs_of(word: np.ndarray, least: int = LEAST, times: int = TIMES) -> set[tuple[int, int, int]]:
    """All (start, length, period) of a word of numbers whose length reaches ``least`` and ``times`` periods (3 at least)."""
    n, found = len(word), set()
    letters = np.unique(word, return_inverse=True)[1]
    for order in (letters, -letters):
        size = np.array(lyndon(order.tolist()), np.int64)
        root = np.arange(n)
        again = root + size
        # a run of ``times`` periods holds its first root so many times less one, each a longest Lyndon word of that length
        fits = np.ones(n, bool)
        for _ in range(times - 2):
            inside = again < n
            fits &= inside
            fits[inside] &= size[again[inside]] == size[inside]
            again = again + size
        root = np.flatnonzero(fits)
        period, end = 0, 0
        for i in root[np.lexsort((root, size[root]))].tolist():
            p = int(size[i])
            if p == period and i + p <= end:
                continue  # in the run that was found last
            right = i + p + common_right(word, i, i + p, n)
            start = i - common_left(word, i, i + p, 0)
            if right - start >= max(least, times * p):
                found.add((start, right - start, p))
                period, end = p, right
    return found


def find(docs: DataFrame, edit: Callable[[np.ndarray, np.ndarray, list], np.ndarray] | None = None) -> DataFrame:
    """doc_id, ``runs`` (by start, then period) and ``collapsed``, the text without the words that repeat a run's first period.

    ``edit`` may change the numbered words of a block before: it gets them, their offsets by row and the ids.
    """
    def build(batches):
        for batch in batches:
            raw, at = text_bytes(batch.column(batch.schema.get_field_index("text")))
            doc_id = batch.column(batch.schema.get_field_index("doc_id"))
            for first, last in blocks(at, BLOCK):
                ids, words, names = word_numbers(raw[at[first]:at[last]], at[first:last + 1] - at[first])
                if edit:
                    ids = edit(ids, words, doc_id.slice(first, last - first).to_pylist())
                listed: list[list] = [[] for _ in range(last - first)]
                change = np.zeros(len(ids) + 1, np.int32)
                for a, b in stretches(ids, words):
                    row = int(np.searchsorted(words, a, "right")) - 1
                    for start, length, period in runs_of(ids[a:b]):
                        listed[row].append((int(a + start - words[row]), length, period))
                        change[a + start + period] += 1
                        change[a + start + length] -= 1
                kept = np.cumsum(change[:-1]) == 0
                cut = np.r_[0, np.cumsum(kept)][words].astype(np.int32)
                rest = pa.ListArray.from_arrays(pa.array(cut), names.take(pa.array(ids[kept])))
                runs = [sorted(r, key=lambda x: (x[0], x[2])) for r in listed]
                flat = np.array([x for r in runs for x in r], np.int64).reshape(-1, 3)
                fields = pa.StructArray.from_arrays([pa.array(flat[:, i]) for i in range(3)], ["start", "length", "period"])
                ends = np.cumsum([0, *map(len, runs)]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [doc_id.slice(first, last - first), pa.ListArray.from_arrays(pa.array(ends), fields), pc.binary_join(rest, " ")],
                    ["doc_id", "runs", "collapsed"])

    return texts(docs).mapInArrow(build, f"doc_id long, runs array<{RUN}>, collapsed string")


def planted(ids: np.ndarray, at: np.ndarray, doc_ids: list) -> np.ndarray:
    """The query's documents: of one in ten, by the crc32 of the id, the words from some place on repeat a period."""
    out = ids.copy()
    for i, doc_id in enumerate(doc_ids):
        h = zlib.crc32(b"" if doc_id is None else str(doc_id).encode())
        n, g = int(at[i + 1] - at[i]), h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            out[at[i] + a:at[i + 1]] = ids[at[i] + a + np.arange(n - a) % p]
    return out


def digest(found: DataFrame) -> DataFrame:
    """The counts, the run of the greatest exact exponent, and digests of all runs and of the words left."""
    less = lambda x, y: x["length"] * y["period"] < y["length"] * x["period"]
    best = F.aggregate("runs", F.lit(None).cast(RUN), lambda most, run: F.when(most.isNull() | less(most, run), run).otherwise(most))
    lines = F.transform("runs", lambda r: F.concat(r["start"], F.lit(","), r["length"], F.lit(","), r["period"], F.lit("\n")))
    told = found.withColumn("best", best)
    return told.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.concat_ws("", lines), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
