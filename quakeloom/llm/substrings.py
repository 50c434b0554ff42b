"""Substring dedup by recompression: words under any repeated window of words.

Every word gets a 64-bit name. Rounds of recompression then name maximal runs of one
symbol and pairs of neighbours, where a hash bit of each symbol says whether it may
begin or end a pair. A name depends only on what it stands for, so equal passages
get equal symbols wherever they lie; names are fingerprints that every task computes
alike, so no round needs a dictionary. Each symbol carries its *extent*: the words
that its existence depends on, the neighbours that kept it from merging included.

For each window the deepest symbol whose extent lies within it is its witness
(lowest level number last, then the smallest name, then the leftmost). The choice is a
function of the window's words alone, so two equal windows have equal witnesses at
equal places. Successive windows mostly share one, and such a *run* of windows is
the row that Spark counts: its key is the fingerprint of the witness's extent.

Keys that occur once settle their windows. For the others the fingerprint of the whole
span of the run is counted: if it recurs, all its windows do. What is left are the
runs at the rims of repeats; their windows are counted one by one, from the texts.
Counts are partially aggregated before each shuffle, so a passage that a third of
all documents hold is one row a task.

Defined cases: a null text has no words; fewer words than a window repeat nothing;
repeated rows repeat each other; other columns are ignored; an empty table gives none.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Spans, blocks, materialise, mix, row_key, screen, text_bytes, texts, word_hashes

WINDOW = 35
ROUNDS = 4


def recompress(names: np.ndarray, doc: np.ndarray, rounds: int = ROUNDS):
    """The symbols of each level, deepest first: (level, name, extent start, extent end), as word positions.

    ``doc`` numbers the row of each word; nothing merges across rows, and a row's rim is
    an extent that reaches beyond it (start - 1 or end + 1), as no window does.
    """
    n = len(names)
    start, end = np.arange(n), np.arange(1, n + 1)  # the words a symbol covers
    low, high = start.copy(), end.copy()             # its extent
    levels = [(0, names, low, high)]
    for level in range(1, rounds + 1):
        m = len(names)
        if m < 2:
            break
        joint = doc[start[1:]] == doc[start[:-1]]
        if level % 2:
            # runs: a maximal run of one symbol is one symbol; it depends on what ends it on either side
            same = (names[1:] == names[:-1]) & joint
            head = np.flatnonzero(np.r_[True, ~same])
            tail = np.r_[head[1:], m]
            many = tail - head > 1
            name = names[head].copy()
            name[many] = mix(names[head[many]] ^ mix((tail - head)[many].astype(np.uint64) + np.uint64(level << 40)))
            new_low, new_high = low[head].copy(), high[tail - 1].copy()
            before, after = np.maximum(head - 1, 0), np.minimum(tail, m - 1)
            # only a run needs to know that it is maximal, and a single symbol that it is no run
            new_low = np.minimum(new_low, np.where(head > 0, low[before], low[head] - 1))
            new_high = np.maximum(new_high, np.where(tail < m, high[after], high[tail - 1] + 1))
            names, start, end, low, high = name, start[head], end[tail - 1], new_low, new_high
            if many.any():
                levels.append((level, names[many], low[many], high[many]))
            m = len(names)
            if m < 2:
                break
            joint = doc[start[1:]] == doc[start[:-1]]
        begins = (mix(names ^ np.uint64(level * 0x51ED270B)) & np.uint64(1)).astype(bool)
        pair = np.zeros(m, bool)
        pair[:-1] = begins[:-1] & ~begins[1:] & joint
        second = np.r_[False, pair[:-1]]
        # who stays single because of a neighbour depends on it: a beginner on the next symbol, an ender on the one before
        alone = ~pair & ~second
        next_high = np.r_[np.where(joint, high[1:], high[:-1] + 1), high[-1] + 1]
        last_low = np.r_[low[0] - 1, np.where(joint, low[:-1], low[1:] - 1)]
        new_high = np.where(alone & begins, np.maximum(high, next_high), high)
        new_low = np.where(alone & ~begins, np.minimum(low, last_low), low)
        first = np.flatnonzero(pair)
        name = names.copy()
        name[first] = mix(names[first] * np.uint64(0x9FB21C651E98DF25) + mix(names[first + 1] ^ np.uint64(level)))
        new_low[first] = np.minimum(low[first], low[first + 1])
        new_high[first] = np.maximum(high[first], high[first + 1])
        end = end.copy()
        end[first] = end[first + 1]
        levels.append((level, name[first], new_low[first], new_high[first]))
        keep = ~second
        names, start, end, low, high = name[keep], start[keep], end[keep], new_low[keep], new_high[keep]
    return levels[::-1]


def witnesses(names: np.ndarray, at: np.ndarray, window: int = WINDOW):
    """The runs of windows with one witness: row, first and last window (word positions), extent start and end."""
    n = len(names)
    size = np.diff(at)
    doc = np.repeat(np.arange(len(size)), size)
    windows = n - window + 1
    none = np.zeros(0, np.int64)
    if windows < 1:
        return none, none, none, none, none
    real = doc[:windows] == doc[window - 1:]
    # the best symbol of each window start; a symbol serves the windows from high - window to low
    unset = np.iinfo(np.uint64).max
    best = np.full(windows, unset, np.uint64)
    lows, highs = [], []
    total = 0
    for level, name, low, high in recompress(names, doc):
        fits = high - low <= window
        low, high, name = low[fits], high[fits], name[fits]
        first, last = np.maximum(high - window, 0), np.minimum(low, windows - 1)
        ok = (first <= last) & (low >= 0)
        low, high, name, first, last = low[ok], high[ok], name[ok], first[ok], last[ok]
        if not len(low):
            continue
        # smaller is better among the symbols of a level: 32 bits of the name, then the position
        order = np.lexsort((low, name))
        rank = np.empty(len(order), np.uint64)
        rank[order] = np.arange(total, total + len(order), dtype=np.uint64)
        lows.append(low[order])
        highs.append(high[order])
        total += len(order)
        _cover(best, first, last, rank)
        if not (best[real] == unset).any():
            break
    low, high = np.concatenate(lows), np.concatenate(highs)
    chosen = np.where(real, best, unset)
    cut = np.flatnonzero(np.r_[True, (chosen[1:] != chosen[:-1]) | (doc[1:windows] != doc[:windows - 1])])
    stop = np.r_[cut[1:], windows] - 1
    held = chosen[cut] != unset
    cut, stop = cut[held], stop[held]
    witness = chosen[cut].astype(np.int64)
    return doc[cut], cut, stop, low[witness], high[witness]


def _cover(best: np.ndarray, first: np.ndarray, last: np.ndarray, rank: np.ndarray) -> None:
    """Lower ``best`` to the least rank of the ranges [first, last]; what is set stays.

    A range is two overlapping ranges of a power of two; each power's minima are pushed down by halves.
    """
    unset = np.iinfo(np.uint64).max
    n = len(best)
    span = last - first + 1
    power = np.floor(np.log2(span)).astype(np.int64)
    carried = None
    for k in range(int(power.max()), -1, -1):
        own = np.full(n, unset, np.uint64)
        mine = power == k
        if mine.any():
            np.minimum.at(own, first[mine], rank[mine])
            np.minimum.at(own, last[mine] - (1 << k) + 1, rank[mine])
        if carried is not None:
            np.minimum(own, carried, out=own)
            half = 1 << k
            np.minimum(own[half:], carried[:n - half], out=own[half:])
        carried = own
    np.copyto(best, carried, where=best == unset)


def _per_block(batch: pa.RecordBatch):
    """Blocks of a batch: first row, last row, word hashes and word offsets by row."""
    raw, at = text_bytes(batch.column(batch.schema.get_field_index("text")))
    for first, last in blocks(at):
        names, start, end, words = word_hashes(raw[at[first]:at[last]], at[first:last + 1] - at[first])
        yield first, last, names, start, end, words, raw[at[first]:at[last]]


def _take(batch: pa.RecordBatch, columns: list[str], rows: np.ndarray) -> list[pa.Array]:
    return [batch.column(batch.schema.get_field_index(c)).take(pa.array(rows)) for c in columns]


def runs(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """k1, k2, lo, hi (windows of the row), key and span: fingerprints of the extent and of all words of the run."""
    def build(batches):
        for batch in batches:
            for first, _, names, _, _, at, _ in _per_block(batch):
                row, lo, hi, low, high = witnesses(names, at, window)
                one, two = Spans(names), Spans(names, 1)
                key = one(low, high)
                # where the extent lies in the run is a part of what must be equal
                place = mix((low - lo).astype(np.uint64))
                span, again = mix(one(lo, hi + window) ^ place), mix(two(lo, hi + window) ^ place)
                k1, k2 = _take(batch, ["k1", "k2"], row + first)
                base = at[row]
                yield pa.RecordBatch.from_arrays(
                    [k1, k2, pa.array((lo - base).astype(np.int32)), pa.array((hi - base).astype(np.int32)), pa.array(key.view(np.int64)),
                     pa.array(span.view(np.int64)), pa.array(again.view(np.int64)), pa.array((low - lo).astype(np.int32))],
                    ["k1", "k2", "lo", "hi", "key", "span", "span2", "off"])

    return docs.mapInArrow(build, "k1 long, k2 long, lo int, hi int, key long, span long, span2 long, off int")


def _windows(docs: DataFrame, window: int) -> DataFrame:
    """docs with k1, k2, text and ``runs`` (lo, hi, key, off): each window's place relative to the extent and fingerprint."""
    def build(batches):
        for batch in batches:
            listed = batch.column(batch.schema.get_field_index("runs"))
            for first, last, names, _, _, at, _ in _per_block(batch):
                part = listed.slice(first, last - first)
                counts = np.diff(np.asarray(part.offsets, np.int64)) if len(part) else np.zeros(0, np.int64)
                fields = part.flatten()
                lo, hi, key, off = (fields.field(f).to_numpy(zero_copy_only=False) for f in ("lo", "hi", "key", "off"))
                row = np.repeat(np.arange(last - first), counts)
                number = (hi - lo + 1).astype(np.int64)
                which = np.repeat(np.arange(len(lo)), number)
                step = np.arange(len(which)) - np.repeat(np.cumsum(number) - number, number)
                at_word = at[row[which]] + lo[which] + step
                prints = [pa.array(Spans(names, seed)(at_word, at_word + window).view(np.int64)) for seed in (0, 1)]
                k1, k2 = _take(batch, ["k1", "k2"], row[which] + first)
                yield pa.RecordBatch.from_arrays(
                    [k1, k2, pa.array((lo[which] + step).astype(np.int32)), pa.array(key[which].astype(np.int64)),
                     pa.array((off[which] - step).astype(np.int32)), *prints],
                    ["k1", "k2", "at", "key", "off", "print", "print2"])

    return docs.mapInArrow(build, "k1 long, k2 long, at int, key long, off int, print long, print2 long")


def repeated_ranges(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """k1, k2 and ``ranges``: the first and last starts of windows that also start elsewhere."""
    docs = row_key(texts(docs))
    all_runs = materialise(runs(docs, window), "runs")
    # a key that occurs once has no equal elsewhere; of the others those whose spans are all the same are settled
    keys = materialise(all_runs.groupBy("key").agg(F.count("*").alias("n"), *(f(x).alias(f"{x}_{f.__name__}") for x in ("span", "span2") for f in (F.min, F.max)))
                       .filter("n > 1").selectExpr("key", "span_min = span_max AND span2_min = span2_max AS alike"), "repeated-keys")
    shared, _ = screen(all_runs, F.col("key"), keys.select("key"))
    shared = materialise(shared.join(keys, "key"), "shared-runs")
    spans = shared.filter("NOT alike").groupBy("key", "span", "span2").agg(
        F.count("*").alias("n"), F.min(F.struct("k1", "k2", "lo")).alias("one"))
    spans = materialise(spans, "spans")
    mixed = shared.filter("NOT alike").join(spans, ["key", "span", "span2"])
    full = shared.filter("alike").select("k1", "k2", "lo", "hi").unionByName(mixed.filter("n > 1").select("k1", "k2", "lo", "hi"))
    # rims: runs whose span is unique, and one run of each other span of their keys to compare with
    # written, so that both sides of the join below are plain exchanges, of which a hot key's can be split
    rims = materialise(spans.filter("n = 1").select("key").distinct(), "rim-keys")
    one = (F.col("one.k1") == F.col("k1")) & (F.col("one.k2") == F.col("k2")) & (F.col("one.lo") == F.col("lo"))
    open_ = mixed.filter(one).join(rims, "key", "left_semi").dropDuplicates(["k1", "k2", "lo"])
    by_row = materialise(open_.groupBy("k1", "k2").agg(F.collect_list(F.struct("lo", "hi", "key", "off")).alias("runs")), "rims")
    wanted, _ = screen(docs.select("k1", "k2", "text"), F.col("k2"), by_row.select("k2").distinct())
    # rows that repeat whole have one key; one of them stands for all
    once = wanted.join(by_row, ["k1", "k2"]).groupBy("k1", "k2").agg(F.first("text").alias("text"), F.first("runs").alias("runs"))
    single = materialise(_windows(once, window), "windows")
    again = single.groupBy("key", "off", "print", "print2").agg(F.count("*").alias("n")).filter("n > 1")
    found = single.join(again, ["key", "off", "print", "print2"]).select("k1", "k2", F.col("at").alias("lo"), F.col("at").alias("hi"))
    return full.unionByName(found).groupBy("k1", "k2").agg(F.collect_list(F.struct("lo", "hi")).alias("ranges"))


def _kept(docs: DataFrame, window: int) -> DataFrame:
    """docs with doc_id, text and ``ranges``: the text's kept words, one space apart, and the numbers."""
    def build(batches):
        for batch in batches:
            listed = batch.column(batch.schema.get_field_index("ranges"))
            for first, last, names, start, end, at, raw in _per_block(batch):
                part = listed.slice(first, last - first)
                row = np.repeat(np.arange(last - first), np.diff(np.asarray(part.offsets, np.int64)))
                fields = part.flatten()
                lo, hi = (fields.field(f).to_numpy(zero_copy_only=False).astype(np.int64) for f in ("lo", "hi"))
                change = np.zeros(len(names) + 1, np.int64)
                np.add.at(change, at[row] + lo, 1)
                np.add.at(change, at[row] + hi + window, -1)
                kept = np.cumsum(change)[:-1] == 0
                so_far = np.r_[0, np.cumsum(kept)]
                # of the bytes: the kept words, and the separator after each but a row's last one
                stay = np.zeros(len(raw) + 1, np.int64)
                words = np.flatnonzero(kept)
                stay[start[words]] += 1
                stay[end[words]] -= 1
                stay = np.cumsum(stay)[:-1] > 0
                inner = np.ones(len(words), bool)
                inner[so_far[at[1:]][so_far[at[1:]] > so_far[at[:-1]]] - 1] = False
                data = raw.copy()
                data[end[words[inner]]] = 0x20
                stay[end[words[inner]]] = True
                size = np.r_[0, np.cumsum(stay)]
                edges = np.concatenate([[0], _row_ends(batch, first, last)])
                text = pa.StringArray.from_buffers(last - first, pa.py_buffer(size[edges].astype(np.int32)), pa.py_buffer(data[stay].tobytes()))
                n = np.diff(at)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(batch.schema.get_field_index("doc_id")).slice(first, last - first), pa.array(n),
                     pa.array(n - np.diff(so_far[at])), text], ["doc_id", "n_words", "n_removed", "kept"])

    return docs.select("doc_id", "text", "ranges").mapInArrow(build, "doc_id long, n_words long, n_removed long, kept string")


def _row_ends(batch: pa.RecordBatch, first: int, last: int) -> np.ndarray:
    _, at = text_bytes(batch.column(batch.schema.get_field_index("text")))
    return at[first + 1:last + 1] - at[first]


def dedup(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_removed and ``kept``, the words left, joined by one space; a row for each input row."""
    ranges = materialise(repeated_ranges(docs, window), "ranges")
    rows = row_key(texts(docs))
    none = F.lit(None).cast(ranges.schema["ranges"].dataType).alias("ranges")
    hit, clean = screen(rows, F.col("k2"), ranges.select("k2").distinct())
    out = _kept(hit.join(ranges, ["k1", "k2"], "left"), window)
    return out if clean is None else out.unionByName(_kept(clean.select("doc_id", "text", none), window))


def digest(deduped: DataFrame) -> DataFrame:
    return deduped.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
