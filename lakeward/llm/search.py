"""Ranked lexical search on a bit-sliced impact index.

Documents are dealt into blocks. A block lists its terms, each with the places of the documents
that hold it, and stores their impacts (what a term adds to the score of a document, but for
the term's own weight) bit by bit: slice s is a bitmap with bit s of every impact. A query multiplies
the slices of its terms by their weights and adds them up with bitwise carries, all
documents of the block at once, and finds the best ones from the most significant slice down.
"""

from __future__ import annotations

import math
import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import zip_longest

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import LOWER, UPPER, stage, table, unstage

BEST = 50
#: A block is closed at so many documents (places are 16-bit numbers) or words.
BLOCK_DOCS, BLOCK_WORDS = 4096, 1 << 21
#: Blocks that go to a Python worker at once.
BLOCKS_AT_ONCE = 4
#: Weighted terms that are remembered while one block is searched.
REMEMBERED = 2000
#: Bytes of queries that are searched for in one scan of the index.
QUERY_BYTES = 16 << 20
#: Tasks whose best documents are merged first, before all are.
MERGED_TASKS = 64
#: Bounds an impact: it is below 1,000,000.
IMPACT_BITS = 20

TERMS = re.compile(rb"[0-9a-z\x80-\xff]+").findall


def terms_of(text: str) -> list[bytes]:
    return TERMS(text.encode().lower())  # bytes.lower touches A-Z alone


def impacts(tf: np.ndarray, n: np.ndarray, docs: int, words: int) -> np.ndarray:
    """What `tf` occurrences in documents of `n` terms add; saturating in tf, damped by length."""
    m = 50 + (50 * n * docs) // max(words, 1)
    return (1_000_000_000 * tf) // (1000 * tf + 20 * m)


def weight(docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * docs + 2) / (2 * df + 1)))


def _counted(docs: DataFrame) -> DataFrame:
    """Blocks (block, doc_ids, sizes, terms, starts, places, tf): terms in order, joined by line ends; term i's
    postings are starts[i] to starts[i + 1] of places and tf. The vectors are bytes of little-endian
    integers. Within a block, documents are in order of id, nulls last."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 40

        def fresh() -> tuple:
            known: dict[bytes, int] = defaultdict()
            known.default_factory = known.__len__
            return known, [], [], []

        known, ids, sizes, found = fresh()

        def closed() -> pa.RecordBatch:
            order = sorted(range(len(ids)), key=lambda k: (ids[k] is None, ids[k] or 0))
            place = np.empty(len(ids), np.int64)
            place[order] = np.arange(len(ids))
            names = sorted(known)
            rank = np.empty(len(names), np.int64)
            rank[[known[t] for t in names]] = np.arange(len(names))
            key = (rank[np.concatenate([np.zeros(0, np.int64), *found])] << 32) + np.repeat(place, sizes)
            key, tf = np.unique(key, return_counts=True)
            starts = np.searchsorted(key >> 32, np.arange(len(names) + 1))
            row = [
                ([block], pa.int64()), ([[ids[k] for k in order]], pa.list_(pa.int64())), ([np.array(sizes, "<i4")[order].tobytes()], pa.binary()), ([b"\n".join(names)], pa.binary()),
                ([starts.astype("<i4").tobytes()], pa.binary()), ([(key & 0xFFFFFFFF).astype("<u2").tobytes()], pa.binary()), ([tf.astype("<i4").tobytes()], pa.binary()),
            ]
            return pa.RecordBatch.from_arrays([pa.array(*x) for x in row], ["block", "doc_ids", "sizes", "terms", "starts", "places", "tf"])

        words = 0
        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                own = terms_of(text.as_py() or "")
                ids.append(doc)
                sizes.append(len(own))
                found.append(np.fromiter(map(known.__getitem__, own), np.int32, len(own)))
                words += len(own)
                if len(ids) >= BLOCK_DOCS or words >= BLOCK_WORDS:
                    yield closed()
                    known, ids, sizes, found = fresh()
                    block, words = block + 1, 0
        if ids:
            yield closed()

    fields = "block bigint, doc_ids array<bigint>, sizes binary, terms binary, starts binary, places binary, tf binary"
    own = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return stage(own.mapInArrow(run, fields), "counts")


@dataclass(frozen=True)
class Index:
    """Blocks (block, doc_ids, terms, starts, places, slices), the number of documents with a term, and of all terms with
    repeats. It holds every document and every term, whatever will be asked."""

    blocks: DataFrame
    docs: int
    words: int


def build_index(docs: DataFrame) -> Index:
    """The index of docs(doc_id, text). Texts are read whole; null and wordless ones have no postings; rows that
    repeat an id are documents of their own; other columns are left out. The counts are written first, as
    impacts follow from the mean length of all documents; then the slices are."""
    counts = _counted(docs)

    def lengths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = [np.frombuffer(x.as_buffer(), "<i4") for x in batch.column(0)]
            yield pa.RecordBatch.from_arrays([pa.array([int(np.count_nonzero(x)) for x in n], pa.int64()), pa.array([int(x.sum(dtype=np.int64)) for x in n], pa.int64())], ["docs", "words"])

    sums = counts.select("sizes").mapInArrow(lengths, "docs bigint, words bigint").agg(F.sum("docs"), F.sum("words")).first()
    n_docs, n_words = (x or 0 for x in sums)

    def slice_(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for sizes, places, tf in zip(*(batch.column(k) for k in (5, 4, 6)), strict=True):
                own = np.frombuffer(sizes.as_buffer(), "<i4").astype(np.int64)[np.frombuffer(places.as_buffer(), "<u2")]
                q = impacts(np.frombuffer(tf.as_buffer(), "<i4").astype(np.int64), own, n_docs, n_words)
                out.append([np.packbits((q >> s).astype(np.uint8) & 1, bitorder="little").tobytes() for s in range(IMPACT_BITS)])
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array(out, pa.list_(pa.binary()))], [*batch.schema.names[:5], "slices"])

    sliced = counts.select("block", "doc_ids", "terms", "starts", "places", "sizes", "tf").mapInArrow(
        slice_, "block bigint, doc_ids array<bigint>, terms binary, starts binary, places binary, slices array<binary>"
    )
    out = Index(stage(sliced, "impact-index", BLOCKS_AT_ONCE), n_docs, n_words)
    unstage(counts)
    return out


def added(a: list[int], b: list[int]) -> list[int]:
    """Slice-wise sum of two bit-sliced columns, least significant slice first."""
    out, carry = [], 0
    for x, y in zip_longest(a, b, fillvalue=0):
        s = x ^ y
        out.append(s ^ carry)
        carry = x & y | carry & s
    return [*out, carry] if carry else out


def times(a: list[int], w: int) -> list[int]:
    """A bit-sliced column times a number: its own slices, moved up, added for each bit of it."""
    out: list[int] = []
    for j in range(w.bit_length()):
        if w >> j & 1:
            out = [*out[:j], *[0] * (j - len(out)), *added(out[j:], a)]
    return out


def best_of(slices: list[int], k: int) -> int:
    """Bitmap of the k largest positive numbers of a bit-sliced column, of equal ones those that
    stand first; found from the most significant slice down."""
    sure, tied = 0, 0
    for s in slices:
        tied |= s
    if tied.bit_count() <= k:
        return tied
    for s in reversed(slices):
        more = sure | tied & s
        n = more.bit_count()
        if n > k:
            tied &= s
        else:
            sure = more
            if n == k:
                return sure
            tied &= ~s
    for _ in range(k - sure.bit_count()):
        first = tied & -tied
        sure |= first
        tied ^= first
    return sure


class Block:
    """One block while it is searched."""

    def __init__(self, doc_ids: list, terms: bytes, starts: bytes, places: bytes, slices: list[bytes], wanted: dict[bytes, int]):
        self.doc_ids, self.slices, self.wanted = doc_ids, slices, wanted
        self.at = {t: i for i, t in enumerate(terms.split(b"\n")) if t in wanted}
        self.starts, self.places = np.frombuffer(starts, "<i4"), np.frombuffer(places, "<u2")
        self.width = -(-len(doc_ids) // 8)
        self.known: dict[bytes, list[int]] = {}

    def weighted(self, term: bytes) -> list[int]:
        """Slices, over the block's documents, of the term's impacts times its weight."""
        out = self.known.get(term)
        if out is None:
            a, b = self.starts[self.at[term] : self.at[term] + 2].tolist()
            few = (1 << b - a) - 1
            own = [int.from_bytes(s[a >> 3 : b + 7 >> 3], "little") >> (a & 7) & few for s in self.slices]
            product = times(own, self.wanted[term])
            bits = np.unpackbits(np.frombuffer(b"".join(s.to_bytes(b - a + 7 >> 3, "little") for s in product), np.uint8).reshape(len(product), -1), axis=1, count=b - a, bitorder="little")
            wide = np.zeros((len(product), 8 * self.width), np.uint8)
            wide[:, self.places[a:b]] = bits
            out = [int.from_bytes(row.tobytes(), "little") for row in np.packbits(wide, axis=1, bitorder="little")]
            if len(self.known) >= REMEMBERED:
                self.known.clear()
            self.known[term] = out
        return out

    def best(self, terms: list[bytes], k: int) -> list[tuple]:
        """At most k tuples (-score, whether the id is null, id)."""
        total: list[int] = []
        for t in terms:
            if t in self.at:
                total = added(total, self.weighted(t))
        chosen = best_of(total, k)
        if not chosen:
            return []
        place = np.flatnonzero(np.unpackbits(np.frombuffer(chosen.to_bytes(self.width, "little"), np.uint8), bitorder="little"))
        rows = np.frombuffer(b"".join(s.to_bytes(self.width, "little") for s in total), np.uint8).reshape(len(total), -1)
        score = ((rows[:, place >> 3] >> (place & 7)) & 1).astype(np.int64).T @ (1 << np.arange(len(total), dtype=np.int64))
        return [(-s, self.doc_ids[p] is None, self.doc_ids[p] or 0) for p, s in zip(place.tolist(), score.tolist(), strict=True)]


def frequencies(index: Index, wanted: list[bytes]) -> dict[bytes, int]:
    """Documents per term, for the terms of the queries at hand."""
    sent = index.blocks.sparkSession.sparkContext.broadcast({t: i for i, t in enumerate(wanted)})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(sent.value), np.int64)
        for batch in batches:
            for terms, starts in zip(batch.column(0), batch.column(1), strict=True):
                n = np.diff(np.frombuffer(starts.as_buffer(), "<i4"))
                for t, df in zip(terms.as_py().split(b"\n"), n.tolist(), strict=False):  # a block without terms has one empty name
                    if (i := sent.value.get(t)) is not None:
                        total[i] += df
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(total[held])], ["term", "df"])

    parts = stage(index.blocks.select("terms", "starts").mapInArrow(run, "term bigint, df bigint"), "frequencies", BLOCKS_AT_ONCE)
    out = {wanted[r.term]: r.df for r in parts.groupBy("term").agg(F.sum("df").alias("df")).collect()}
    unstage(parts)
    return out


def search(index: Index, items: DataFrame, k: int = BEST) -> DataFrame:
    """Rows (item_id, rank, doc_id, score): the k best documents of every row of items(item_id, text),
    by falling score, equal ones by rising id (nulls last). Only scores above 0 count.

    A null or wordless item finds nothing; rows that repeat an item are answered each, null item ids
    too; an empty index or no items give an empty result. Queries beyond QUERY_BYTES are searched for in
    several scans. Each task keeps k documents an item over all of its blocks, groups of tasks are merged
    first, so what one item gathers stays small however many blocks there are.
    """
    spark = items.sparkSession
    own = items.select("item_id", F.col("text").cast("string").alias("text")).where("text is not null")
    scans = max(1, -(-(own.agg(F.sum(F.octet_length("text") + 64)).first()[0] or 0) // QUERY_BYTES))
    kind, found = items.schema["item_id"].dataType.simpleString(), []
    for scan in range(scans):
        rows = own.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(scans)) == scan).collect()
        queries = [sorted(set(terms_of(r.text))) for r in rows]
        df = frequencies(index, sorted({t for q in queries for t in q}))
        weights = {t: w for t, n in df.items() if (w := weight(index.docs, n))}
        sent = spark.sparkContext.broadcast(([[t for t in q if t in weights] for q in queries], weights))

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            queries, weights = sent.value
            best: list[list[tuple]] = [[] for _ in queries]
            for batch in batches:
                for n in range(batch.num_rows):
                    block = Block(*(c[n].as_py() for c in batch.columns), weights)
                    for i, q in enumerate(queries):
                        if new := block.best(q, k):
                            best[i] = sorted(best[i] + new)[:k]
            flat = [(i, None if null else doc, -s) for i, rows in enumerate(best) for s, null, doc in rows]
            yield pa.RecordBatch.from_arrays([pa.array([r[j] for r in flat], pa.int64()) for j in range(3)], ["query", "doc_id", "score"])

        blocks = index.blocks.select("doc_ids", "terms", "starts", "places", "slices")
        got = stage(blocks.mapInArrow(run, "query bigint, doc_id bigint, score bigint").withColumn("task", F.spark_partition_id()), "found", BLOCKS_AT_ONCE)
        asked = spark.createDataFrame([(i, r.item_id) for i, r in enumerate(rows)], f"query bigint, item_id {kind}")
        found.append((got, asked))
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    out = None
    for got, asked in found:
        first = F.row_number().over(Window.partitionBy("query", F.floor(F.col("task") / MERGED_TASKS)).orderBy(*order))
        last = F.row_number().over(Window.partitionBy("query").orderBy(*order))
        merged = got.withColumn("nth", first).where(F.col("nth") <= k).withColumn("rank", last).where(F.col("rank") <= k)
        part = merged.join(F.broadcast(asked), "query").select("item_id", "rank", "doc_id", "score")
        out = part if out is None else out.unionByName(part)
    return out


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = build_index(table(spark, sf_dir, "documents"))
    out = search(index, table(spark, sf_dir, "benchmark"))
    unstage(index.blocks)
    return out


_TERM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
OP11_SQL = rf"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{_TERM}') AS w FROM documents
), q AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{_TERM}')) AS t FROM benchmark
), tf AS (SELECT doc_id, t, count(*) AS tf FROM (SELECT doc_id, unnest(w) AS t FROM d) WHERE t IN (SELECT t FROM q) GROUP BY ALL),
size AS (SELECT doc_id, CAST(len(w) AS BIGINT) AS n FROM d WHERE len(w) > 0),
total AS (SELECT count(*) AS nd, CAST(sum(n) AS BIGINT) AS l FROM size),
weights AS (SELECT t, CAST(floor(1000 * ln(CAST(2 * nd + 2 AS DOUBLE) / CAST(2 * df + 1 AS DOUBLE))) AS BIGINT) AS w FROM (SELECT t, count(*) AS df FROM tf GROUP BY t), total),
posting AS (
  SELECT doc_id, t, w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * nd) // l))) AS part
  FROM tf JOIN weights USING (t) JOIN size USING (doc_id), total
), scored AS (SELECT item_id, doc_id, CAST(sum(part) AS BIGINT) AS score FROM q JOIN posting USING (t) GROUP BY ALL),
ranked AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scored WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranked WHERE rank <= {BEST}
"""
