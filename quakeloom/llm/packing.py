"""Packing pieces of documents into sequences: bin completion over the histogram of lengths.

Documents are cut into pieces of at most ``capacity`` tokens. How the pieces share
sequences depends on their lengths alone, and there are at most ``capacity`` different
ones, however many documents there are. So the search runs over a histogram of that
bounded size: *bin completion* takes the largest length left, enumerates undominated
fillings of the room beside it, least waste first, and applies one as many times as the
counts allow. Waste bounds prune: a branch is left when the sequences opened and the
room that the rest needs reach the incumbent. The best-fit solution is the first
incumbent; a search that meets the lower bound ends at once, else after ``NODES`` nodes.

The resulting patterns deal the places to the pieces of each length. Pieces are ranked
within their length by slices of a hash, each of bounded size, so a length that a third
of all pieces have is ranked in many tasks; the pattern table, bounded by the histogram,
goes to every task, and a piece finds its sequence and offset by a search in it.

Defined cases: a null or empty text is one piece, the end mark alone; repeated rows are packed one by
one; other columns are ignored; an empty table gives none. A text is encoded chunk by
chunk between spaces, and its pieces leave as they fill up, so its length costs no memory.
"""

from __future__ import annotations

import json
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import materialise, ship, texts

CAPACITY, END = 2048, 0
#: Nodes of the search, steps of one enumeration and fillings that a node tries.
NODES, STEPS, WIDTH = 20_000, 100, 4
#: Pieces of one length that one task ranks.
SLICE_ROWS = 2_000
#: Characters of text split at once, chunks that a task remembers, characters of a chunk worth remembering.
SLICE, KNOWN, SHORT = 1 << 18, 300_000, 48


# ---------------------------------------------------------------- pieces

def _byte_names() -> dict[int, str]:
    """The character that stands for each byte: itself where printable, else the next one from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(rest)}


#: A byte that no text holds stands for the mark at a word's end.
WORD_END = b"\xff"


def _ranks(model: dict, names: dict[int, str]) -> dict[bytes, int] | None:
    """The model's symbols as bytes with their ids, if merging by the least id is what the model does.

    That is so if merges are numbered in their order after the bytes and the bytes at a word's end, and if each
    symbol, taken alone, comes about by its own merge: then no other pair ever stands where it could form (see
    the tests, which check the latter for the given vocabulary).
    """
    end, vocab, bytes_of = model["end_of_word_suffix"], model["vocab"], {c: b for b, c in names.items()}
    merged = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
    plain = {c: vocab.get(c, -1) for c in bytes_of} | {c + end: vocab.get(c + end, -1) for c in bytes_of} if end else {"": -1}
    if sorted(plain.values()) != list(range(512)) or any(vocab.get(c + end, 0) <= max(vocab[x] for x in bytes_of) for c in bytes_of):
        return None
    if [vocab.get(a + b) for a, b in merged] != list(range(512, 512 + len(merged))):
        return None
    symbols = [*plain, *(a + b for a, b in merged)]
    ranks = {bytes(bytes_of[c] for c in x.removesuffix(end)) + WORD_END * x.endswith(end): vocab[x] for x in symbols}
    return ranks | {WORD_END: len(vocab)}


def _merges(path: str, names: dict[int, str]):
    """The library's byte pair merges over these symbols, several times faster than the model's call for one word; or None."""
    from tiktoken._tiktoken import CoreBPE

    with open(path, encoding="utf-8") as file:
        ranks = _ranks(json.load(file)["model"], names)
    return CoreBPE(ranks, {}, "[^ ]+") if ranks else None


class _Kept(dict):
    """A bounded memory. What came late goes first: frequent keys come early."""

    def keep(self, key, value):
        if len(self) >= KNOWN:
            for _ in range(KNOWN // 2):
                self.popitem()
        self[key] = value


class _Chunks(_Kept):
    """Ids of chunks of text without a space, as little-endian 32-bit numbers.

    A chunk of ASCII and Latin-1 letters is lowered and split here, and each part goes to the model once;
    any other goes through the whole tokenizer.
    """

    PLAIN = re.compile("[!-~\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]*")
    PART = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-z\u00df-\u00f6\u00f8-\u00ff]+|[0-9]|[^a-z0-9\u00df-\u00f6\u00f8-\u00ff]+")

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        super().__init__()
        self.core = Tokenizer.from_file(path)
        self.special = re.compile("|".join(re.escape(t.content) for t in self.core.get_added_tokens_decoder().values()) or "(?!)").search
        self.parts, self.names = _Kept(), _byte_names()
        self.merges = _merges(path, self.names)

    def __missing__(self, chunk: str) -> bytes:
        if self.PLAIN.fullmatch(chunk) and not self.special(chunk):
            ids = b"".join(map(self.part, self.PART.findall(chunk.lower())))
        else:
            ids = array("I", self.core.encode(chunk, add_special_tokens=False).ids).tobytes()
        if len(chunk) <= SHORT:
            self.keep(chunk, ids)
        return ids

    def part(self, part: str) -> bytes:
        ids = self.parts.get(part)
        if ids is None:
            if self.merges:
                found = self.merges.encode_single_piece(part.encode() + WORD_END)
            else:
                found = [t.id for t in self.core.model.tokenize(part.encode().decode("latin-1").translate(self.names))]
            ids = array("I", found).tobytes()
            if len(part) <= SHORT:
                self.parts.keep(part, ids)
        return ids


_known: dict[str, _Chunks] = {}


def _chunks(path: str) -> _Chunks:
    """A worker's memory outlives its tasks."""
    if path not in _known:
        _known[path] = _Chunks(path)
    return _known[path]


def encoded(text: str, known: _Chunks) -> Iterator[bytes]:
    """The ids of a text, part by part. A space is a boundary to the tokenizer: it drops white space, and nothing composes with it."""
    first, n = 0, len(text)
    while first < n:
        last = n
        if n - first > SLICE:
            near = max(text.rfind(space, first, first + SLICE) for space in " \n")
            far = [at for space in " \n" if near < 0 and (at := text.find(space, first + SLICE)) >= 0]
            last = near + 1 or min(far, default=n - 1) + 1
        yield b"".join(map(known.__getitem__, text[first:last].replace("\n", " ").split(" ")))
        first = last


def pieces(docs: DataFrame, path: str, capacity: int = CAPACITY) -> DataFrame:
    """doc_id, piece, start, length and ids (little-endian 32-bit numbers) of every document's pieces."""
    def build(batches):
        known = _chunks(path)
        for batch in batches:
            out: list[list] = [[] for _ in range(5)]
            held = 0

            def put(doc_id, piece, data):
                for column, value in zip(out, (doc_id, piece, piece * capacity, len(data) // 4, data)):
                    column.append(value)

            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                piece, rest = 0, b""
                for part in _ended(text.as_py(), known):
                    rest = rest + part if rest else part
                    full = len(rest) // (4 * capacity)
                    for i in range(full):
                        put(doc_id, piece + i, rest[4 * capacity * i:4 * capacity * (i + 1)])
                    piece, rest, held = piece + full, rest[4 * capacity * full:], held + full
                    if held > 512:
                        yield _batch(out)
                        out[:], held = [[] for _ in range(5)], 0
                if rest:
                    put(doc_id, piece, rest)
            yield _batch(out)

    return texts(docs).mapInArrow(build, "doc_id long, piece int, start long, length long, ids binary")


def _ended(text: str, known: _Chunks) -> Iterator[bytes]:
    yield from encoded(text, known)
    yield array("I", [END]).tobytes()


def _batch(out: list[list]) -> pa.RecordBatch:
    types = pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary()
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types)], ["doc_id", "piece", "start", "length", "ids"])


# ---------------------------------------------------------------- bin completion over a histogram

Pattern = tuple[int, tuple[tuple[int, int], ...]]  # times, ((length, copies), ...)


def best_fit(count: dict[int, int], capacity: int) -> list[Pattern]:
    """Best-fit decreasing: each length goes where it leaves least room, in bins alike at once."""
    bins: dict[int, list[tuple[int, tuple]]] = {}
    for size in sorted((s for s in count if count[s]), reverse=True):
        left = count[size]
        for room in sorted(r for r in bins if r >= size):
            fit, groups = room // size, bins.pop(room)
            while groups and left:
                times, held = groups.pop()
                full = min(times, left // fit)
                if full:
                    bins.setdefault(room - fit * size, []).append((full, (*held, (size, fit))))
                left -= full * fit
                times -= full
                if times and left:  # fewer than fill a bin
                    bins.setdefault(room - left * size, []).append((1, (*held, (size, left))))
                    left, times = 0, times - 1
                if times:
                    groups.append((times, held))
            if groups:
                bins.setdefault(room, []).extend(groups)
            if not left:
                break
        fit = capacity // size
        if left >= fit:
            bins.setdefault(capacity - fit * size, []).append((left // fit, ((size, fit),)))
        if left % fit:
            bins.setdefault(capacity - left % fit * size, []).append((1, ((size, left % fit),)))
    return [p for groups in bins.values() for p in groups]


def least_bins(count: dict[int, int], capacity: int) -> int:
    """A bound from below: the room that is needed in all, and beside lengths too large to share a bin."""
    best, sizes = -(-sum(s * c for s, c in count.items()) // capacity), sorted(s for s in count if count[s])
    for small in [s for s in sizes if 2 * s <= capacity] or sizes[:1]:
        alone = sum(count[s] for s in sizes if s > capacity - small)
        half = [(s, count[s]) for s in sizes if 2 * s > capacity and s <= capacity - small]
        rest = sum(s * count[s] for s in sizes if small <= s and 2 * s <= capacity)
        n = sum(c for _, c in half)
        best = max(best, alone + n + max(0, -(-(rest - (n * capacity - sum(s * c for s, c in half))) // capacity)))
    return best


def fillings(count: dict[int, int], mask: int, room: int) -> list[tuple[tuple[int, int], ...]]:
    """Undominated fillings of ``room``, least waste first; ``mask`` has a bit for each length left.

    A filling is dominated where one length left could replace one or two of its own and leave less waste.
    """
    found: list[tuple[int, tuple]] = []
    steps = 0

    def undominated(held, waste):
        sizes = [s for s, _ in held]
        pairs = [a + b for i, a in enumerate(sizes) for b in sizes[i + 1:]] + [2 * s for s, m in held if m > 1]
        for x in {*sizes, *pairs}:
            # a length from x to x + waste (above x itself, where x is one of the filling's own)
            if window := mask >> (x if x not in count or x not in sizes else x + 1) & ((1 << (waste + (x not in sizes))) - 1):
                taken = dict(held)
                while window:
                    y = (window & -window).bit_length() - 1 + x + (x in sizes)
                    if count[y] > taken.get(y, 0):
                        return False
                    window &= window - 1
        return True

    exact = 0

    def descend(room, top, held):
        nonlocal steps, exact
        steps += 1
        able = mask & ((1 << min(room, top) + 1) - 1)
        if not able:
            smaller = mask & ((1 << room + 1) - 1)
            taken = dict(held)
            while smaller:  # a length that still fits makes this no whole filling
                y = smaller.bit_length() - 1
                if count[y] > taken.get(y, 0):
                    return
                smaller ^= 1 << y
            if undominated(held, room):
                found.append((room, held))
                exact += room == 0
            return
        while able and steps < STEPS and exact < WIDTH:
            size = able.bit_length() - 1
            able ^= 1 << size
            for copies in range(min(room // size, count[size]), 0, -1):
                descend(room - copies * size, size - 1, (*held, (size, copies)))
                if steps >= STEPS:
                    break

    descend(room, room, ())
    found.sort(key=lambda f: (f[0], [(-s, -m) for s, m in f[1]]))
    return [held for _, held in found[:WIDTH]]


def complete(count: dict[int, int], capacity: int = CAPACITY, nodes: int = NODES) -> list[Pattern]:
    """Patterns that hold every length as often as ``count`` says, in as few bins as the search finds."""
    left = {s: c for s, c in count.items() if c}
    best = best_fit(left, capacity)
    fewest, bound = sum(t for t, _ in best), least_bins(left, capacity)
    mask = sum(1 << s for s in left)
    rest, opened, path, stack = sum(s * c for s, c in left.items()), 0, [], []

    def branches():
        """The ways to go on: fillings around the largest length, that length included, and how often."""
        size = mask.bit_length() - 1
        left[size] -= 1
        inner = mask if left[size] else mask ^ 1 << size
        ways = fillings(left, inner, capacity - size)
        left[size] += 1
        for held in ways:
            whole = dict(held)
            whole[size] = whole.get(size, 0) + 1
            pattern = tuple(sorted(whole.items(), reverse=True))
            yield min(left[s] // m for s, m in pattern), pattern

    def apply(times, pattern, sign):
        nonlocal mask, rest, opened
        for s, m in pattern:
            left[s] -= sign * times * m
            mask = mask | 1 << s if left[s] else mask & ~(1 << s)
            rest -= sign * times * m * s
        opened += sign * times

    # the first way down is always followed to its end; with it the incumbent is the better of two whole solutions
    dived = False
    if left:
        stack.append(branches())
    while stack and (nodes > 0 or not dived):
        nodes -= 1
        way = next(stack[-1], None)
        if way is None:
            stack.pop()
            if path:
                apply(*path.pop(), -1)
            continue
        apply(*way, 1)
        path.append(way)
        if not mask:
            if opened < fewest or (opened == fewest and not dived):
                fewest, best = opened, list(path)
            dived = True
            if fewest == bound:
                break
        elif not dived or opened + -(-rest // capacity) < fewest:
            stack.append(branches())
            continue
        apply(*path.pop(), -1)
    return best


# ---------------------------------------------------------------- dealing the places

def ranked(rows: DataFrame, count: DataFrame) -> DataFrame:
    """Rows with ``rank``, their number (from 0) among the rows of their length, counted in slices of a hash.

    ``count`` has length and n; a length gets slices for its number of rows.
    """
    slices = count.select("length", (1 + F.floor(F.col("n") / SLICE_ROWS)).alias("_slices"))
    dealt = rows.join(slices, "length").withColumn("_slice", F.pmod(F.xxhash64(*rows.columns), F.col("_slices"))).drop("_slices")
    before = W.partitionBy("length").orderBy("_slice").rowsBetween(W.unboundedPreceding, -1)
    sums = dealt.groupBy("length", "_slice").agg(F.count("*").alias("n")).withColumn("_before", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    own = F.row_number().over(W.partitionBy("length", "_slice").orderBy(*(c for c in rows.columns if c != "length")))
    numbered = dealt.withColumn("_own", own - 1)
    return numbered.join(sums, ["length", "_slice"]).withColumn("rank", F.col("_before") + F.col("_own")).drop("_slice", "_before", "_own")


def pack(rows: DataFrame, capacity: int = CAPACITY, nodes: int = NODES) -> DataFrame:
    """Rows with a long ``length`` (1 to ``capacity``): the same with sequence_id and offset in as few sequences as the search finds."""
    ship(rows.sparkSession)
    rows = materialise(rows, "pieces")
    # at most ``capacity`` rows, whatever the table's size
    lengths = materialise(rows.groupBy("length").agg(F.count("*").alias("n")), "lengths")
    count = {r["length"]: r["n"] for r in lengths.collect()}
    base: dict[int, int] = {}
    total = 0
    for size in sorted(count):
        base[size], total = total, total + count[size]
    used, slots, opened = dict.fromkeys(count, 0), [], 0
    for times, pattern in complete(count, capacity, nodes):
        offset = 0
        for size, copies in pattern:
            slots.append((base[size] + used[size], opened, copies, offset))
            used[size] += times * copies
            offset += size * copies
        opened += times
    table = np.array(sorted(slots), np.int64).reshape(-1, 4)
    bases = np.zeros(capacity + 1, np.int64)
    bases[list(base)] = list(base.values())
    sent = rows.sparkSession.sparkContext.broadcast((table, bases))
    names = rows.columns

    def place(batches):
        table, bases = sent.value
        for batch in batches:
            length = batch.column(batch.schema.get_field_index("length")).to_numpy(zero_copy_only=False)
            at = bases[length] + batch.column(batch.schema.get_field_index("rank")).to_numpy(zero_copy_only=False)
            first, opened, copies, offset = table[np.searchsorted(table[:, 0], at, "right") - 1].T
            which = at - first
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(batch.schema.get_field_index(c)) for c in names), pa.array(opened + which // copies), pa.array(offset + which % copies * length)],
                [*names, "sequence_id", "offset"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    return ranked(rows, lengths).mapInArrow(place, f"{schema}, sequence_id long, offset long")


def sequences(packed: DataFrame, ids: str = "ids") -> DataFrame:
    """sequence_id and the ids of its pieces, one after another: at most ``capacity`` of them."""
    parts = F.sort_array(F.collect_list(F.struct("offset", ids)))
    joined = F.aggregate(parts, F.lit("").cast("binary"), lambda all_, p: F.concat(all_, p[ids]))
    return packed.groupBy("sequence_id").agg(joined.alias("ids"))


def digest(cut: DataFrame) -> DataFrame:
    """The pieces with a checksum in the place of their ids."""
    return cut.withColumn("ids_crc32", F.crc32("ids")).drop("ids")
