"""Helpers the text operators share: reading, hashing words in bulk, static screens."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quakeloom.session import materialise, scratch_path

__all__ = ["materialise", "scratch_path"]

#: Bytes of text handled at once by the bulk word functions.
BLOCK_BYTES = 1 << 19
SEPARATOR = np.zeros(256, bool)
SEPARATOR[[0x20, 9, 10, 11, 12, 13]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: One word as a regular expression, for Java, Python and SQL alike.
WORD = r"[^\x20\x09-\x0D]+"

BYTE_BASE, WORD_BASE = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once a session, so that their Python workers can import it."""
    if (app := spark.sparkContext.applicationId) in _shipped:
        return
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    path = os.path.join(tempfile.mkdtemp(prefix="quakeloom-"), "quakeloom.zip")
    with zipfile.ZipFile(path, "w") as out:
        for top, _, names in os.walk(os.path.join(root, "quakeloom")):
            for name in names:
                if name.endswith(".py"):
                    out.write(os.path.join(top, name), os.path.relpath(os.path.join(top, name), root))
    spark.sparkContext.addPyFile(path)
    _shipped.add(app)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(docs: DataFrame, *more: str) -> DataFrame:
    """doc_id and text alone (and ``more``), null texts as empty; other columns cannot clash."""
    ship(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), *more)


def row_key(df: DataFrame) -> DataFrame:
    """``k1``, ``k2``: the same for one row in every scan, so no row number has to survive a retry.

    Rows with equal keys have the same doc_id and (but for 64-bit collisions) the same text.
    """
    return df.withColumn("k1", F.coalesce("doc_id", F.lit(-2**63 + 1))).withColumn("k2", F.xxhash64("text"))


def remainder(column: str, n: int) -> Column:
    """crc32 of the number as text, modulo ``n``; null counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")), F.lit(n))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit numbers."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _powers(base: int, n: int, modulus: int) -> np.ndarray:
    """The first powers of a base, by doubling."""
    out = np.ones(1, np.uint64)
    while len(out) < n:
        out = np.concatenate([out, out * np.uint64(pow(base, len(out), modulus)) % np.uint64(modulus)])
    return out


class Spans:
    """Fingerprints of spans of named words: two polynomials modulo primes below 2**31, 62 bits in all.

    A modulus of 2**64 would do without the divisions, but words that alternate in the order of Thue and
    Morse have equal values there whatever the base. ``seed`` draws independent polynomials.
    """

    PRIMES = (2_147_483_647, 2_147_483_629)
    _known: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}

    def __init__(self, names: np.ndarray, seed: int = 0):
        self.parts = []
        for k, prime in enumerate(self.PRIMES):
            base = 1_000_003 + 7_919 * (2 * seed + k)
            up, down = self._known.get((seed, k), (np.ones(1, np.uint64),) * 2)
            if len(up) <= len(names):
                size = 1 << len(names).bit_length()
                up, down = _powers(base, size, prime), _powers(pow(base, -1, prime), size, prime)
                if size <= 1 << 20:  # of longer texts they are made anew
                    self._known[seed, k] = up, down
            value = mix(names ^ np.uint64((2 * seed + k + 1) * WORD_BASE & (2**64 - 1))) % np.uint64(prime)
            prefix = np.zeros(len(names) + 1, np.uint64)  # sums of numbers below 2**31 stay below 2**63
            np.cumsum(value * up[:len(names)] % np.uint64(prime), out=prefix[1:])
            self.parts.append((np.uint64(prime), prefix, down))

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        (p, one, down), (q, two, low) = self.parts
        high = (one[end] - one[start]) % p * down[start] % p
        return mix((high << np.uint64(32) | (two[end] - two[start]) % q * low[start] % q) ^ mix((end - start).astype(np.uint64)))


class Powers:
    """Powers of an odd base and of its inverse modulo 2**64, grown on demand."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(1, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = 1 << (n - 1).bit_length()
            grow = lambda b: np.cumprod(np.r_[np.uint64(1), np.full(size - 1, b, np.uint64)], dtype=np.uint64)
            self.up, self.down = grow(self.base), grow(self.inverse)
        return self.up, self.down


_WORDS = Powers(WORD_BASE)


def prefix_hash(values: np.ndarray) -> np.ndarray:
    """Running polynomial sums, from which :func:`span_hash` gets the hash of a short span (see :class:`Spans` for long ones)."""
    up, _ = _WORDS.upto(len(values) + 1)
    out = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[:len(values)], dtype=np.uint64, out=out[1:])
    return out


def span_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    _, down = _WORDS.upto(len(prefix))
    return mix((prefix[end] - prefix[start]) * down[start] + (end - start).astype(np.uint64))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of an Arrow string column and each row's offsets into them, without a copy."""
    wide = pa.types.is_large_string(column.type)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[at[0]:at[-1]], at - at[0]


def blocks(at: np.ndarray, most: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Runs of rows of about ``most`` bytes; a longer row is a block of its own."""
    first = 0
    while first < len(at) - 1:
        last = max(first + 1, int(np.searchsorted(at, at[first] + most, "right")) - 1)
        yield first, last
        first = last


def word_hashes(raw: np.ndarray, at: np.ndarray, lower: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For rows of bytes: each word's 64-bit name, start and end byte, and the words' offsets by row.

    Words are looked up first; a distinct word's name is the xxh3 hash of its bytes.
    """
    if lower:
        raw = LOWER[raw]
    n = len(raw)
    if not n:
        none = np.zeros(0, np.int64)
        return none.astype(np.uint64), none, none, np.zeros(len(at), np.int64)
    inside = ~SEPARATOR[raw]
    edge = np.zeros(n + 1, bool)
    edge[at] = True
    start = np.flatnonzero(inside & (edge[:n] | ~np.r_[False, inside[:-1]]))
    end = np.flatnonzero(inside & (edge[1:] | ~np.r_[inside[1:], False])) + 1
    numbers, offsets, words = word_numbers(raw, at)
    # a view of the words' bytes: some may be cut from text that isn't whole characters
    data = words.cast(pa.binary()).to_pylist()
    names = np.fromiter(map(xxhash.xxh3_64_intdigest, data), np.uint64, len(data))
    return names[numbers], start, end, offsets


# ---------------------------------------------------------------- static screens

def fuse_filter(keys: np.ndarray, seed: int = 0) -> tuple[int, int, int, np.ndarray]:
    """A binary fuse filter over distinct 64-bit keys: seed, segment length, segments, 8-bit prints.

    Three slots a key, peeled in waves: every slot that one key alone uses frees that key, and
    the prints are filled in the reverse order. A member always passes, another key in about 1 of 256.
    """
    n = len(keys)
    length = 1 << max(2, min(18, int(np.floor(np.log(max(n, 2)) / np.log(3.33) + 2.25))))
    factor = max(1.125, 0.875 + 0.25 * np.log(1e6) / np.log(max(n, 2)))
    segments = max(1, -(-int(max(n, 2) * factor) // length) - 2)
    while True:
        h, slots = _slots(keys, seed, length, segments)
        size = (segments + 2) * length
        count = np.bincount(slots.ravel(), minlength=size)
        held = np.zeros(size, np.int64)  # the sum of the key numbers that use a slot
        for column in slots:
            np.add.at(held, column, np.arange(n))
        alive, order = np.ones(n, bool), []
        queue = np.flatnonzero(count == 1)
        while len(queue):
            key, first = np.unique(held[queue], return_index=True)
            slot = queue[first]
            fresh = alive[key]
            key, slot = key[fresh], slot[fresh]
            if not len(key):
                break
            alive[key] = False
            order.append((key, slot))
            touched = slots[:, key]
            np.subtract.at(count, touched.ravel(), 1)
            np.subtract.at(held, touched.ravel(), np.tile(key, 3))
            touched = np.unique(touched)
            queue = touched[count[touched] == 1]
        if not alive.any():
            break
        seed, segments = seed + 1, segments + 1
    prints = np.zeros(size, np.uint8)
    mark = (h ^ (h >> np.uint64(32))).astype(np.uint8)
    for key, slot in reversed(order):
        own = slots[:, key]
        rest = prints[own[0]] ^ prints[own[1]] ^ prints[own[2]]
        prints[slot] = mark[key] ^ rest ^ prints[slot]
    return seed, length, segments, prints


def _slots(keys: np.ndarray, seed: int, length: int, segments: int) -> tuple[np.ndarray, np.ndarray]:
    h = mix(keys.view(np.uint64) + np.uint64((seed * BYTE_BASE + 1) & (2**64 - 1)))
    first = ((h >> np.uint64(32)) * np.uint64(segments * length)) >> np.uint64(32)
    mask = np.uint64(length - 1)
    second = (first + np.uint64(length)) ^ ((h >> np.uint64(18)) & mask)
    third = (first + np.uint64(2 * length)) ^ (h & mask)
    return h, np.stack([first, second, third]).astype(np.int64)


def fuse_contains(built: tuple[int, int, int, np.ndarray], keys: np.ndarray) -> np.ndarray:
    seed, length, segments, prints = built
    h, slots = _slots(keys, seed, length, segments)
    return (h ^ (h >> np.uint64(32))).astype(np.uint8) == prints[slots[0]] ^ prints[slots[1]] ^ prints[slots[2]]


#: A screen goes to every executor only up to this many keys (9 bits each: 9 MB).
SCREEN_KEYS = 8_000_000


def screen(df: DataFrame, column: Column, keys: DataFrame, most: int = SCREEN_KEYS) -> tuple[DataFrame, DataFrame | None]:
    """Split ``df`` by whether the 64-bit ``column`` may be among ``keys`` (one long column, distinct).

    Returns the rows that may be and those that surely are not. The keys are counted first: up to
    ``most`` of them become one static filter that every task holds, so rows that cannot match never
    enter a shuffle. Beyond that the first result is the whole of ``df`` and the second None; the
    exact join that follows in either case then does all of the work.
    """
    spark = df.sparkSession
    if (n := keys.count()) > most:
        return df, None
    if not n:
        return df.limit(0), df
    ship(spark)
    name = keys.columns[0]
    found = np.concatenate([np.zeros(0, np.int64), *(
        np.frombuffer(r[0], np.int64) for r in keys.mapInArrow(_packed(name), "keys binary").toLocalIterator())])
    sent = spark.sparkContext.broadcast(fuse_filter(np.unique(found)))

    def test(values):
        return pa.array(fuse_contains(sent.value, values.fill_null(0).to_numpy(zero_copy_only=False)))

    test.__annotations__ = {"values": pa.Array, "return": pa.Array}
    may = F.arrow_udf(test, "boolean")  # no pandas in the workers
    may = may.asNondeterministic()  # evaluated once, not again in each filter
    marked = df.withColumn("_may", may(column))
    return marked.filter("_may").drop("_may"), marked.filter("NOT _may").drop("_may")


def _packed(name: str):
    def pack(batches):
        for batch in batches:
            keys = batch.column(batch.schema.get_field_index(name)).to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_pydict({"keys": pa.array([keys.astype(np.int64).tobytes()], pa.binary())})
    return pack


# ---------------------------------------------------------------- exact word numbers

#: Bytes of text whose words are numbered at once; a longer text is cut between words.
SLICE_BYTES = 1 << 20


def slices(raw: np.ndarray, at: np.ndarray, most: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Byte ranges of about ``most``, cut at a row's end or in front of a separator, never inside a word."""
    first, n = int(at[0]), int(at[-1])
    while first < n:
        last = min(n, first + most)
        if last < n:
            row = int(at[np.searchsorted(at, last, "right") - 1])
            if row > first:
                last = row
            else:
                while last < n and not len(found := np.flatnonzero(SEPARATOR[raw[last:last + 65_536]])):
                    last += 65_536
                last = min(n, last + int(found[0]) if last < n else n, int(at[np.searchsorted(at, first, "right")]))
        yield first, last
        first = last


def word_numbers(raw: np.ndarray, at: np.ndarray, most: int = SLICE_BYTES) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """For rows of bytes: each word's number, the words' offsets by row, and the distinct words that the numbers stand for.

    Equal numbers mean equal bytes: the words are looked up, not hashed to a name.
    """
    parts, offsets = [], np.zeros(len(at), np.int64)
    for first, last in slices(raw, at, most):
        part = raw[first:last]
        inside = ~SEPARATOR[part]
        begins = inside.copy()
        begins[1:] &= ~inside[:-1]
        edge = at[(at >= first) & (at < last)] - first
        begins[edge] |= inside[edge]
        start = np.flatnonzero(begins)
        cut = np.append(np.cumsum(inside)[start] - 1, np.count_nonzero(inside)).astype(np.int32)
        words = pa.StringArray.from_buffers(len(start), pa.py_buffer(cut), pa.py_buffer(part[inside]))
        parts.append(words.dictionary_encode())
        offsets += np.searchsorted(start + first, at)
    if not parts:
        return np.zeros(0, np.int32), offsets, pa.array([], pa.string())
    whole = pa.chunked_array(parts).unify_dictionaries().combine_chunks()
    whole = whole.chunk(0) if isinstance(whole, pa.ChunkedArray) else whole
    return whole.indices.to_numpy(zero_copy_only=False), offsets, whole.dictionary
