"""Byte-level BPE encoding and decoding of whole texts, long ones in overlapping chunks.

A text of at most a chunk is encoded where it lies. A longer one is cut into chunks
that overlap; tasks split chunks into pre-tokens independently. A split from a
position depends only on what follows it, so two neighbours that share a boundary
agree from there on: the first boundary in the overlap that both have is the
stitch, and each chunk encodes its own pieces between two stitches. The last
pre-tokens of a chunk may have been cut by its end and are never trusted. If the
overlap holds no common boundary (one pre-token may be longer than that), the
document is taken whole in one task, which is exact too.

Decoding concatenates the raw bytes of the ids.

Defined cases: a null text is empty and has no ids; repeated rows give one row
each; other columns are ignored; an empty table gives no row. Special tokens'
strings are ordinary text.
"""

from __future__ import annotations

import base64
import functools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise, texts

RANKS = "byte_bpe_multi_50k.tiktoken"
#: Code points of a chunk, and by how many it reaches into the next.
CHUNK, OVERLAP = 32_768, 2_048
#: Pre-tokens whose ids a worker keeps at hand, and rows it turns out at once.
CACHE, ROWS = 150_000, 128


def default_ranks() -> str:
    import public_tokenizers

    return public_tokenizers.path(RANKS)


class Codec:
    """Ids of pre-tokens by the ranks of a file, and the bytes of ids."""

    def __init__(self, path: str, pattern: str):
        import regex

        with open(path, "rb") as lines:
            self.ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.pattern, self.pieces = pattern, regex.compile(pattern)
        self.known: dict[str, bytes] = {}

    @functools.cached_property
    def core(self):
        import tiktoken

        return tiktoken.Encoding("ranks", pat_str=self.pattern, mergeable_ranks=self.ranks, special_tokens={})

    @functools.cached_property
    def token(self) -> dict[int, bytes]:
        return {rank: token for token, rank in self.ranks.items()}

    def encode(self, pieces: list[str]) -> bytes:
        """The ids of pre-tokens, little-endian unsigned 32-bit integers."""
        known, out = self.known, []
        if len(known) > CACHE:
            known.clear()
        for piece in pieces:
            ids = known.get(piece)
            if ids is None:
                ids = np.array(self.core._encode_single_piece(piece), "<u4").tobytes()
                if len(piece) < 32:
                    known[piece] = ids
            out.append(ids)
        return b"".join(out)

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.token.__getitem__, np.frombuffer(ids, "<u4").tolist()))


@functools.lru_cache(2)
def codec(path: str, pattern: str) -> Codec:
    return Codec(path, pattern)


def slices(batches):
    """Few rows at a time, so that what a worker holds doesn't grow with Spark's batches."""
    for batch in batches:
        for first in range(0, len(batch), ROWS):
            yield batch.slice(first, ROWS)


def boundaries(found: Codec, text: str) -> list[int]:
    """Where pre-tokens end."""
    return [m.end() for m in found.pieces.finditer(text)]


def encode(docs: DataFrame, path: str | None = None, pattern: str | None = None, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """doc_id and ``ids`` (little-endian unsigned 32-bit integers) of each input row."""
    import public_tokenizers

    path, pattern = path or default_ranks(), pattern or public_tokenizers.PATTERN
    rows = texts(docs)

    def whole(batches):
        own = codec(path, pattern)
        for batch in slices(batches):
            ids = [own.encode(own.pieces.findall(text)) for text in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), "ids": pa.array(ids, pa.binary())})

    def cut(batches):
        for batch in slices(batches):
            for row, doc_id, text in zip(*(batch.column(c).to_pylist() for c in ("row", "doc_id", "text"))):
                for i, start in enumerate(range(0, len(text), chunk)):
                    yield pa.RecordBatch.from_pydict({
                        "row": pa.array([row], pa.int64()), "doc_id": pa.array([doc_id], pa.int64()), "i": pa.array([i], pa.int32()),
                        "last": pa.array([start + chunk >= len(text)]), "text": [text[start:start + chunk + overlap]]})

    def split(batches):
        """Each chunk's boundaries that a neighbour looks at: up to the overlap's end, and from the next chunk on."""
        own = codec(path, pattern)
        for batch in slices(batches):
            head, tail = [], []
            for i, last, text in zip(*(batch.column(c).to_pylist() for c in ("i", "last", "text"))):
                ends = boundaries(own, text)
                head.append([b for b in ends if b <= overlap] if i else [])
                # the cut can change the last two pre-tokens: the one at the end and white space before it
                trusted = ends if not ends or last else ends[:-2]
                tail.append([] if last else [b - chunk for b in trusted if b >= chunk])
            keep = [batch.column(c) for c in ("row", "i")]
            yield pa.RecordBatch.from_arrays([*keep, pa.array(head, pa.list_(pa.int32())), pa.array(tail, pa.list_(pa.int32()))], ["row", "i", "head", "tail"])

    def ids_between(batches):
        own = codec(path, pattern)
        for batch in slices(batches):
            out = []
            for begin, end, text in zip(*(batch.column(c).to_pylist() for c in ("begin", "end", "text"))):
                end = len(text) if end is None else end + chunk
                # a boundary is a start as good as the text's: nothing looks behind
                pieces, at = [], begin
                for m in own.pieces.finditer(text, begin):
                    if at >= end:
                        break
                    pieces.append(m.group())
                    at = m.end()
                out.append(own.encode(pieces))
            yield pa.RecordBatch.from_arrays([batch.column("row"), batch.column("doc_id"), batch.column("i"), pa.array(out, pa.binary())], ["row", "doc_id", "i", "ids"])

    size = F.length("text")
    short = rows.filter(size <= chunk).mapInArrow(whole, "doc_id long, ids binary")
    long = rows.filter(size > chunk).withColumn("row", F.monotonically_increasing_id())
    pieces = materialise(long.mapInArrow(cut, "row long, doc_id long, i int, last boolean, text string")
                         .repartition("row", "i"), "chunks")
    if pieces.isEmpty():
        return short
    ends = materialise(pieces.mapInArrow(split, "row long, i int, head array<int>, tail array<int>"), "boundaries")
    left = ends.select("row", (F.col("i") + 1).alias("i"), "tail")
    # position 0 of a chunk is a start of its own, so a boundary for it too
    common = F.array_intersect(F.concat(F.array(F.lit(0)), "head"), "tail")
    seams = ends.filter("i > 0").select("row", "i", "head").join(left, ["row", "i"]).select("row", "i", F.array_min(common).alias("at"))
    seams = materialise(seams, "seams")
    lost = seams.filter("at IS NULL").select("row").distinct()
    parts = (pieces.join(lost, "row", "left_anti")
             .join(seams.select("row", "i", F.col("at").alias("begin")), ["row", "i"], "left")
             .join(seams.select("row", (F.col("i") - 1).alias("i"), F.col("at").alias("end")), ["row", "i"], "left")
             .select("row", "doc_id", "i", F.coalesce("begin", F.lit(0)).alias("begin"), "end", "text"))
    encoded = parts.mapInArrow(ids_between, "row long, doc_id long, i int, ids binary")
    joined = encoded.groupBy("row").agg(F.first("doc_id").alias("doc_id"), F.sort_array(F.collect_list(F.struct("i", "ids"))).alias("c"))
    joined = joined.select("doc_id", F.aggregate("c", F.lit(b""), lambda a, c: F.concat(a, c["ids"])).alias("ids"))
    # chunks of the documents without a common boundary are put together again, less the overlap
    body = F.when(F.col("last"), F.col("text")).otherwise(F.substr("text", F.lit(1), F.lit(chunk)))
    again = (pieces.join(lost, "row", "left_semi").select("row", "doc_id", "i", body.alias("text")).groupBy("row")
             .agg(F.first("doc_id").alias("doc_id"), F.sort_array(F.collect_list(F.struct("i", "text"))).alias("c"))
             .select("doc_id", F.array_join(F.col("c.text"), "").alias("text")))
    return short.unionByName(joined).unionByName(again.mapInArrow(whole, "doc_id long, ids binary"))


def decode(encoded: DataFrame, path: str | None = None, pattern: str | None = None) -> DataFrame:
    """doc_id, ids and ``decoded``, the bytes of the ids one after another."""
    import public_tokenizers

    path, pattern = path or default_ranks(), pattern or public_tokenizers.PATTERN

    def back(batches):
        own = codec(path, pattern)
        for batch in slices(batches):
            out = [own.decode(ids) for ids in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("ids"), pa.array(out, pa.binary())], ["doc_id", "ids", "decoded"])

    return encoded.mapInArrow(back, "doc_id long, ids binary, decoded binary")


def digest(decoded: DataFrame) -> DataFrame:
    return decoded.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
                          F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
