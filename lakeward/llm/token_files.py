"""Token ids in files of patched frame-of-reference blocks.

A file's rows are segments: consecutive documents in ascending order of id, and their ids as one
payload. The payload holds blocks of BLOCK ids. From each block its minimum is subtracted, and what is left is
packed with as many bits as PERCENTILE of the block's ids need; the high bits of the others stand
in the block's list of exceptions. An index of block starts lets a reader unpack only
the blocks that it needs.

Layout of a payload, all numbers little-endian: 4 bytes MAGIC, u32 ids a block, u64 ids, u32 blocks; u32
start of each block, counted from the payload's start, and one past the last; the blocks. A block: u32 minimum, u8 bits,
u8 exceptions; the packed ids, lowest bits first; u8 place of each exception; u32 high bits of each exception.
"""

from __future__ import annotations

import re
import struct
import uuid
import zlib
from array import array
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import shared_dir, stage, table, write

VOCABULARY = "word_bpe_49k.json"
END_ID = 2
MAGIC = b"PFR1"
BLOCK, PERCENTILE = 128, 90
#: A segment is closed after the document that brings it to so many ids.
SEGMENT_IDS = 1 << 16
#: Texts that go to a Python worker at once, and characters that are cut into chunks at once.
TEXTS_AT_ONCE, TOGETHER = 1024, 1 << 23
#: Segments that go to a Python worker at once.
SEGMENTS_AT_ONCE = 16
HEADER = struct.Struct("<4sIQI")
HEAD = 6
#: Chunks that a Python worker remembers the ids of, words being half as many, and how long they may be.
REMEMBERED, LONG = 900_000, 48

SEGMENT = "part int, segment int, first bigint, n_ids bigint, doc_ids array<bigint>, doc_tokens array<bigint>, payload binary"


def _by_bits(bits: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Blocks of the same number of bits, a thousand at once, which bounds what is unpacked in memory."""
    for b in np.unique(bits[bits > 0]).tolist():
        own = np.flatnonzero(bits == b)
        yield from ((b, own[k : k + 1000]) for k in range(0, len(own), 1000))


def pack(ids: np.ndarray, block: int = BLOCK, percentile: int = PERCENTILE) -> bytes:
    """The payload of `ids`, unsigned 32-bit integers; `block` is at most 256 and divisible by 8."""
    n, blocks = len(ids), -(-len(ids) // block)
    if not n:
        return HEADER.pack(MAGIC, block, 0, 0) + struct.pack("<I", HEADER.size + 4)
    grid = np.full(blocks * block, ids[-1], np.int64)  # the last block is filled up with an id that it holds
    grid[:n] = ids
    grid = grid.reshape(blocks, block)
    low = grid.min(axis=1)
    grid -= low[:, None]
    rank = -(-block * percentile // 100) - 1
    bits = np.frexp(np.partition(grid, rank, axis=1)[:, rank].astype(float))[1]  # as many as the value has
    high = grid >> bits[:, None]
    odd = np.count_nonzero(high, axis=1)
    size = HEAD + block // 8 * bits + 5 * odd
    starts = HEADER.size + 4 * (blocks + 1) + np.concatenate([[0], np.cumsum(size)])
    out = np.zeros(starts[-1], np.uint8)
    out[: starts[0]] = np.frombuffer(HEADER.pack(MAGIC, block, n, blocks) + starts.astype("<u4").tobytes(), np.uint8)
    at = starts[:-1]
    out[at[:, None] + np.arange(4)] = low.astype("<u4").view(np.uint8).reshape(-1, 4)
    out[at + 4], out[at + 5] = bits, odd
    for b, own in _by_bits(bits):
        planes = (grid[own, :, None] >> np.arange(b)).astype(np.uint8) & 1
        out[at[own, None] + HEAD + np.arange(block // 8 * b)] = np.packbits(planes.reshape(len(own), -1), axis=1, bitorder="little")
    rows, places = np.nonzero(high)
    nth = np.arange(len(rows)) - np.repeat(np.cumsum(odd) - odd, odd)
    tail = at[rows] + HEAD + block // 8 * bits[rows]
    out[tail + nth] = places
    out[(tail + odd[rows] + 4 * nth)[:, None] + np.arange(4)] = high[rows, places].astype("<u4").view(np.uint8).reshape(-1, 4)
    return out.tobytes()


def unpack(payload: bytes, start: int = 0, stop: int | None = None) -> np.ndarray:
    """Ids start to stop of a payload; only the blocks that hold them are read."""
    magic, block, n, blocks = HEADER.unpack_from(payload)
    if magic != MAGIC:
        raise ValueError("not a payload of token ids")
    stop = n if stop is None else min(stop, n)
    if start >= stop:
        return np.zeros(0, "<u4")
    data = np.frombuffer(payload, np.uint8)
    first, last = start // block, -(-stop // block)
    at = np.frombuffer(payload, "<u4", blocks + 1, HEADER.size)[first:last].astype(np.int64)
    low = data[at[:, None] + np.arange(4)].view("<u4").astype(np.int64)
    bits, odd = data[at + 4].astype(np.int64), data[at + 5].astype(np.int64)
    grid = np.zeros((len(at), block), np.int64)
    for b, own in _by_bits(bits):
        packed = data[at[own, None] + HEAD + np.arange(block // 8 * b)]
        planes = np.unpackbits(packed, axis=1, bitorder="little").reshape(len(own), block, b)
        grid[own] = planes @ (1 << np.arange(b))
    rows = np.repeat(np.arange(len(at)), odd)
    nth = np.arange(len(rows)) - np.repeat(np.cumsum(odd) - odd, odd)
    tail = at[rows] + HEAD + block // 8 * bits[rows]
    high = data[(tail + odd[rows] + 4 * nth)[:, None] + np.arange(4)].view("<u4")[:, 0].astype(np.int64) if len(rows) else np.zeros(0, np.int64)
    grid[rows, data[tail + nth]] += high << bits[rows]
    return (grid + low).astype("<u4").reshape(-1)[start - first * block : stop - first * block]


class Words:
    """Ids of whole texts as the tokenizers library gives them.

    The vocabulary's ids do not reach across white space, so a text's ids are those of its
    chunks between white space in a row, and each chunk is cut and looked up once. That needs
    texts that this class cuts as the library does: ASCII and the Latin-1 letters, of which lower case and normal form are
    beyond doubt. Any other text, and one with a special token's string, goes to the library whole.
    """

    def __init__(self, vocabulary: str = VOCABULARY):
        import os

        import public_tokenizers

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self._library = Tokenizer.from_file(public_tokenizers.path(vocabulary))
        self._special = [t.content for t in self._library.get_added_tokens_decoder().values()]
        self._plain = bytes([*range(128), *range(0xC0, 0xD7), *range(0xD8, 0xF7), *range(0xF8, 0x100)])
        self._words = re.compile(r"'(?:s|t|re|ve|m|ll|d)|[a-z\xdf-\xf6\xf8-\xff]+|[0-9]|[^\t-\r 0-9a-z\xdf-\xf6\xf8-\xff]+").findall
        spell = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str
        self._spelled = lambda w: w if w.isalnum() and w.isascii() else spell(w)[0][0]
        self._tokens = self._library.model.tokenize
        self._known: dict[str, bytes] = {}
        self._known_words: dict[str, bytes] = {}

    def _word(self, word: str) -> bytes:
        out = self._known_words.get(word)
        if out is None:
            out = array("I", [t.id for t in self._tokens(self._spelled(word))]).tobytes()
            if len(word) <= LONG:
                if len(self._known_words) >= REMEMBERED // 2:
                    self._known_words.clear()
                self._known_words[word] = out
        return out

    def _chunk(self, chunk: str) -> bytes:
        if chunk.isalpha():
            out = self._word(chunk)
        elif chunk[:-1].isalpha() and chunk[-1].isascii():  # letters and one other sign
            out = self._word(chunk[:-1]) + self._word(chunk[-1])
        else:
            out = b"".join([self._word(w) for w in self._words(chunk)])
        if len(chunk) <= LONG:
            if len(self._known) >= REMEMBERED:
                self._known.clear()
            self._known[chunk] = out
        return out

    def _simple(self, text: str) -> bool:
        try:
            plain = text.encode("latin-1")
        except UnicodeEncodeError:
            return False
        return not plain.translate(None, self._plain) and not any(s in text for s in self._special)

    def _together(self, texts: list[str]) -> list[bytes]:
        """Ids of simple texts: their chunks are told apart by Arrow, and each distinct one is looked up once."""
        chunks = pc.ascii_split_whitespace(pa.array([t.lower() for t in texts]))
        told = chunks.flatten().dictionary_encode()
        at, known, new = told.indices.to_numpy(), self._known.get, self._chunk
        held = [known(c) or new(c) for c in told.dictionary.to_pylist()]
        flat, size = np.frombuffer(b"".join(held), "<u4"), np.array([*map(len, held)], np.int64) // 4
        n = size[at]
        ends = np.concatenate([[0], np.cumsum(n)])
        ids = flat[np.repeat((np.cumsum(size) - size)[at] - ends[:-1], n) + np.arange(ends[-1])].tobytes()
        cuts = (4 * ends[chunks.offsets.to_numpy()]).tolist()
        return [ids[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]

    def batch(self, texts: list[str]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        out: list[bytes] = [b""] * len(texts)
        groups: list[list[int]] = [[]]
        room = TOGETHER
        for k, text in enumerate(texts):
            if not self._simple(text):
                out[k] = array("I", self._library.encode(text, add_special_tokens=False).ids).tobytes()
                continue
            groups[-1].append(k)
            room -= len(text)
            if room < 0:
                groups.append([])
                room = TOGETHER
        for some in filter(None, groups):
            for k, ids in zip(some, self._together([texts[k] for k in some]), strict=True):
                out[k] = ids
        return out

    def ids(self, text: str) -> bytes:
        return self.batch([text])[0]


@lru_cache(maxsize=2)
def words_of(vocabulary: str) -> Words:
    """One per Python worker, kept from task to task."""
    return Words(vocabulary)


@dataclass(frozen=True)
class TokenFiles:
    """What `write_tokens` has written: a folder of segments, and one of the parts' first positions.
    Both are written by Spark's own writer, so they can stand in any store that Spark reaches, and a lost
    task leaves nothing half written."""

    spark: SparkSession
    path: str

    def segments(self) -> DataFrame:
        """Segments with `start`, the position of their first id among all."""
        held = self.spark.read.schema(SEGMENT).parquet(f"{self.path}/segments")
        starts = self.spark.read.schema("part int, part_start bigint").parquet(f"{self.path}/parts")
        return held.join(F.broadcast(starts), "part").withColumn("start", F.col("part_start") + F.col("first")).drop("part_start")

    def documents(self) -> DataFrame:
        """Rows (doc_id, start, n_tokens, ids_crc32), from the files alone."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for k in range(batch.num_rows):
                    start, docs, n, payload = (c[k] for c in batch.columns)
                    n = n.values.to_numpy()
                    ids, ends = unpack(payload.as_py()).tobytes(), np.cumsum(n)
                    sums = [zlib.crc32(ids[4 * a : 4 * b]) for a, b in zip(ends - n, ends, strict=True)]
                    yield pa.RecordBatch.from_arrays(
                        [docs.values, pa.array(start.as_py() + ends - n), pa.array(n), pa.array(sums, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"]
                    )

        read = self.segments().select("start", "doc_ids", "doc_tokens", "payload").mapInArrow(run, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")
        return stage(read, "token-documents", SEGMENTS_AT_ONCE)

    def read(self, start: int, stop: int) -> DataFrame:
        """Rows (position, ids) that hold the ids at positions start to stop, each at most a segment; other
        segments are passed over, and of those at the ends only the blocks that are needed are unpacked."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for at, payload in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                    ids = unpack(payload.as_py(), max(0, start - at), stop - at)
                    yield pa.RecordBatch.from_arrays([pa.array([max(start, at)]), pa.array([ids.astype(np.int64)], pa.list_(pa.int64()))], ["position", "ids"])

        return self.segments().where((F.col("start") < stop) & (F.col("start") + F.col("n_ids") > start)).select("start", "payload").mapInArrow(run, "position bigint, ids array<bigint>")


def write_tokens(docs: DataFrame, path: str | None = None, vocabulary: str = VOCABULARY, end_id: int = END_ID) -> TokenFiles:
    """Writes the ids of all rows of docs(doc_id, text), each followed by `end_id`, in ascending order of
    id, and returns the files (in a new folder of the shared one by default).

    A null or empty text has the end id alone. Null ids come first; rows that repeat an id stand one
    after another by text, and rows that repeat both are dealt over parts like any other. A
    long text makes a long segment; an empty table makes empty files; other columns are left out.
    Documents are dealt by ranges of id and encoded where they are written; one count a
    range reaches the driver.
    """
    spark = docs.sparkSession
    path = path or f"{shared_dir(spark)}/tokens-{uuid.uuid4().hex}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of, end = words_of(vocabulary).batch, np.array([end_id], "<u4").tobytes()
        part, segment, first = TaskContext.get().partitionId(), 0, 0
        docs, sizes, held, n = [], [], [], 0

        def closed() -> pa.RecordBatch:
            nonlocal segment, first, docs, sizes, held, n
            payload = pack(np.frombuffer(b"".join(held), "<u4"))
            row = [([part], pa.int32()), ([segment], pa.int32()), ([first], pa.int64()), ([n], pa.int64()), ([docs], pa.list_(pa.int64())), ([sizes], pa.list_(pa.int64())), ([payload], pa.binary())]
            segment, first, docs, sizes, held, n = segment + 1, first + n, [], [], [], 0
            return pa.RecordBatch.from_arrays([pa.array(*x) for x in row], ["part", "segment", "first", "n_ids", "doc_ids", "doc_tokens", "payload"])

        for batch in batches:
            for doc, ids in zip(batch.column(0).to_pylist(), ids_of([t or "" for t in batch.column(1).to_pylist()]), strict=True):
                ids += end
                docs.append(doc)
                sizes.append(len(ids) // 4)
                held.append(ids)
                n += sizes[-1]
                if n >= SEGMENT_IDS:
                    yield closed()
        if docs:
            yield closed()

    own = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    order = [F.asc_nulls_first("doc_id"), F.asc("digest"), F.asc("copy")]
    dealt = own.withColumn("digest", F.xxhash64("text")).withColumn("copy", F.monotonically_increasing_id())
    dealt = dealt.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")
    write(dealt.mapInArrow(run, SEGMENT), f"{path}/segments", TEXTS_AT_ONCE)
    parts = spark.read.schema(SEGMENT).parquet(f"{path}/segments").groupBy("part").agg(F.sum("n_ids").alias("n"))
    starts, before = [], 0
    for r in sorted(parts.collect()):
        starts.append((r.part, before))
        before += r.n
    spark.createDataFrame(starts, "part int, part_start bigint").coalesce(1).write.parquet(f"{path}/parts")
    return TokenFiles(spark, path)


def op13_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return write_tokens(table(spark, sf_dir, "documents")).documents()
