"""Importance resampling towards a target distribution, from a stored count matrix.

The feature counts of all documents form a sparse matrix, a row per document and a column
per hashed bucket. It is written once, as blocks of compressed sparse rows; the
sums of its columns are the corpus' distribution, the same sums over the target's matrix are the
target's, and the matrix times the vector of gains gives every document's weight. Documents are
drawn by weight plus Gumbel noise.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import LOWER, UPPER, stage, table, unstage

BUCKETS = 10_000
SEED = 7
#: Percent of the documents with at least MIN_WORDS words that are drawn.
PERCENT, MIN_WORDS = 25, 20
#: Entries after which a block is closed; a single row has at most BUCKETS.
BLOCK_ENTRIES = 1 << 16
#: Blocks that go to a Python worker at once.
BLOCKS_AT_ONCE = 16

WORDS = re.compile(rb"[0-9a-z\x80-\xff]+").findall
BLOCK = "block bigint, doc_id array<bigint>, n_words array<bigint>, row_starts binary, buckets binary, counts binary"
#: The three vectors of a block, little-endian.
VECTOR = "<i4"


def features(text: str, buckets: int = BUCKETS) -> tuple[int, np.ndarray]:
    """Number of words, and the bucket of every word and every two neighbouring words."""
    words = WORDS(text.encode().lower())  # bytes.lower touches A-Z alone
    crc = zlib.crc32
    sums = [*map(crc, words)]
    pairs = [crc(b" " + w, s) for s, w in zip(sums, words[1:], strict=False)]  # goes on from the first word's sum
    return len(words), np.array(sums + pairs, np.int64) % buckets


def count_matrix(docs: DataFrame, label: str = "matrix", buckets: int = BUCKETS) -> DataFrame:
    """The stored matrix: rows (block, doc_id, n_words, row_starts, buckets, counts), one per block of
    rows. Entries row_starts[i] to row_starts[i + 1] of buckets and counts belong to the block's row i; the three
    are stored as bytes of 32-bit integers, which Spark hands on whole. A null text has an empty row. Blocks are bounded by BLOCK_ENTRIES, whatever the texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, ids, words, starts, at, n = TaskContext.get().partitionId() << 40, [], [], [0], [], []

        def closed() -> pa.RecordBatch:
            nonlocal part, ids, words, starts, at, n
            lists = [pa.array([x], pa.list_(pa.int64())) for x in (ids, words)]
            vectors = [pa.array([np.concatenate([np.zeros(0), *x]).astype(VECTOR).tobytes()], pa.binary()) for x in ([starts], at, n)]
            out = pa.RecordBatch.from_arrays([pa.array([part]), *lists, *vectors], ["block", "doc_id", "n_words", "row_starts", "buckets", "counts"])
            part, ids, words, starts, at, n = part + 1, [], [], [0], [], []
            return out

        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                n_words, own = features(text.as_py() or "", buckets)
                found, times = np.unique(own, return_counts=True)
                ids.append(doc)
                words.append(n_words)
                starts.append(starts[-1] + len(found))
                at.append(found)
                n.append(times)
                if starts[-1] >= BLOCK_ENTRIES:
                    yield closed()
        if ids:
            yield closed()

    return stage(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, BLOCK), label)


def column_sums(matrix: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """Count per bucket. Each task sums its blocks, Spark sums the tasks; `buckets` numbers reach the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for at, n in zip(batch.column(0), batch.column(1), strict=True):
                total += np.bincount(np.frombuffer(at.as_buffer(), VECTOR), np.frombuffer(n.as_buffer(), VECTOR), buckets).astype(np.int64)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(total[held])], ["bucket", "n"])

    out = np.zeros(buckets, np.int64)
    parts = stage(matrix.select("buckets", "counts").mapInArrow(run, "bucket bigint, n bigint"), "sums", BLOCKS_AT_ONCE)
    for r in parts.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r.bucket] = r.n
    unstage(parts)
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of the two distributions, one added to every count, rounded down."""
    s_all, t_all, n = float(corpus.sum()), float(target.sum()), len(corpus)
    return np.array([math.floor(1000 * math.log((t + 1.0) * (s_all + n) / ((s + 1.0) * (t_all + n)))) for s, t in zip(corpus.tolist(), target.tolist(), strict=True)], np.int64)


def times_vector(matrix: DataFrame, vector: np.ndarray) -> DataFrame:
    """Rows (block, row, doc_id, n_words, n_features, weight): the matrix times `vector`, over the row's sum, rounded down."""
    sent = matrix.sparkSession.sparkContext.broadcast(vector)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by = sent.value
        for batch in batches:
            for k in range(batch.num_rows):
                block, ids, words, starts, at, n = (c[k] for c in batch.columns)
                starts, at, n = (np.frombuffer(x.as_buffer(), VECTOR).astype(np.int64) for x in (starts, at, n))
                upto = lambda x: np.concatenate([[0], np.cumsum(x)])[starts]
                size, total = np.diff(upto(n)), np.diff(upto(n * by[at]))
                weight = np.where(size > 0, total // np.maximum(size, 1), 0)
                rows = len(size)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([block.as_py()] * rows, pa.int64()), pa.array(range(rows), pa.int32()), ids.values, words.values, pa.array(size), pa.array(weight)],
                    ["block", "row", "doc_id", "n_words", "n_features", "weight"],
                )

    return matrix.mapInArrow(run, "block bigint, row int, doc_id bigint, n_words bigint, n_features bigint, weight bigint")


def numbered(rows: DataFrame, order: list, label: str) -> DataFrame:
    """`rows` with `rank`, 1, 2, 3 and so on in the order of `order`, which has to be a total one. Rows are
    dealt by ranges of it and numbered within each; one count a range reaches the driver."""
    dealt = stage(rows.repartitionByRange(*order).withColumn("range", F.spark_partition_id()), label)
    first, before = [], 0
    for r in sorted(dealt.groupBy("range").agg(F.count("*").alias("n")).collect()):
        first.append((r.range, before))
        before += r.n
    starts = dealt.sparkSession.createDataFrame(first, "range int, first bigint")
    own = F.row_number().over(Window.partitionBy("range").orderBy(*order))
    return dealt.withColumn("nth", own).join(F.broadcast(starts), "range").withColumn("rank", F.col("first") + F.col("nth")).drop("range", "first", "nth")


def resample_to(docs: DataFrame, target: DataFrame, percent: int = PERCENT, min_words: int = MIN_WORDS, seed: int = SEED, buckets: int = BUCKETS) -> DataFrame:
    """Rows (doc_id, n_features, weight, score, rank), one per row of docs(doc_id, text), drawn towards
    the distribution of target(text).

    Null and empty texts have no features, weigh 0 and are never drawn; texts of any length are
    counted whole. Noise follows from id and seed alone, a null id having noise of its own; equal
    scores go by id, nulls last, and rows that repeat an id take ranks one after another. An empty
    target draws by the corpus' rarity alone, an empty table gives an empty result; other columns
    are dropped.
    """
    matrix = count_matrix(docs, buckets=buckets)
    wanted = count_matrix(target.select(F.lit(None).alias("doc_id"), "text"), "target-matrix", buckets)
    vector = gains(column_sums(matrix, buckets), column_sums(wanted, buckets))
    unstage(wanted)
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    uniform = (F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") + F.lit(0.5)) / F.lit(4294967296.0)
    score = F.col("weight") + F.floor(-1000 * F.log(-F.log(uniform)))
    rows = stage(times_vector(matrix, vector).withColumn("score", score), "weights", BLOCKS_AT_ONCE)
    unstage(matrix)
    fit = F.col("n_words") >= min_words
    drawn = percent * rows.where(fit).count() // 100
    ranked = numbered(rows.where(fit), [F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("block"), F.asc("row")], "ranked")
    out = ["doc_id", "n_features", "weight", "score"]
    return ranked.select(*out, F.when(F.col("rank") <= drawn, F.col("rank")).alias("rank")).unionByName(rows.where(~fit).select(*out, F.lit(None).cast("bigint").alias("rank")))


def drawn(docs: DataFrame, target: DataFrame, **how: int) -> DataFrame:
    """The sample as ids with their ranks, to be joined with whatever holds the texts."""
    return resample_to(docs, target, **how).where("rank is not null").select("doc_id", "rank")


def op12_target_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample_to(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


#: crc32 by its definition: a table of 256 remainders, then one step a byte.
_STEP = "CASE WHEN {x} % 2 = 1 THEN xor({x} // 2, 3988292384) ELSE {x} // 2 END"
_CRC = """xor(4294967295, list_reduce(
    list_prepend(CAST(4294967295 AS BIGINT), list_transform(range(0, strlen({x})), lambda i: CAST('0x' || hex(encode({x}))[2 * i + 1 : 2 * i + 2] AS BIGINT))),
    lambda c, b: xor(c // 256, remainders[xor(c, b) % 256 + 1])))"""

OP12_SQL = rf"""
WITH RECURSIVE bits AS (
  SELECT range AS b, CAST(range AS BIGINT) AS x, 0 AS k FROM range(256)
  UNION ALL SELECT b, {_STEP.format(x="x")}, k + 1 FROM bits WHERE k < 8
), divided AS (SELECT list(x ORDER BY b) AS remainders FROM bits WHERE k = 8),
texts AS (
  SELECT 'd' AS side, doc_id, text FROM documents UNION ALL SELECT 'b', item_id, text FROM benchmark
), w AS (
  SELECT side, doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM texts
), f AS (
  SELECT side, doc_id, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS f FROM w
), n AS (SELECT side, doc_id, f, count(*) AS n FROM f GROUP BY ALL),
hashed AS (SELECT f, {_CRC.format(x="f")} % {BUCKETS} AS bucket FROM (SELECT DISTINCT f FROM n), divided),
c AS (SELECT side, doc_id, bucket, sum(n) AS n FROM n JOIN hashed USING (f) GROUP BY ALL),
sums AS (SELECT bucket, coalesce(sum(n) FILTER (side = 'd'), 0) AS s, coalesce(sum(n) FILTER (side = 'b'), 0) AS t FROM c GROUP BY bucket),
total AS (SELECT coalesce(sum(s), 0) AS sa, coalesce(sum(t), 0) AS ta FROM sums),
g AS (
  SELECT bucket, CAST(floor(1000 * ln((CAST(t AS DOUBLE) + 1) * (CAST(sa AS DOUBLE) + {BUCKETS}) / ((CAST(s AS DOUBLE) + 1) * (CAST(ta AS DOUBLE) + {BUCKETS})))) AS BIGINT) AS gain
  FROM sums, total
), m AS (SELECT doc_id, CAST(sum(n * gain) AS BIGINT) AS total, CAST(sum(n) AS BIGINT) AS n_features FROM c JOIN g USING (bucket) WHERE side = 'd' GROUP BY doc_id),
r AS (
  SELECT w.doc_id, len(w.w) AS n_words, coalesce(n_features, 0) AS n_features,
    CASE WHEN n_features IS NULL THEN 0 ELSE (total - ((total % n_features) + n_features) % n_features) // n_features END AS weight,
    CAST('0x' || sha256('{SEED}:' || w.doc_id)[1:8] AS BIGINT) AS h
  FROM w LEFT JOIN m USING (doc_id) WHERE side = 'd'
), scored AS (SELECT *, weight + CAST(floor(-1000 * ln(-ln((h + 0.5) / 4294967296))) AS BIGINT) AS score FROM r),
ranked AS (SELECT *, CASE WHEN n_words >= {MIN_WORDS} THEN row_number() OVER (ORDER BY n_words < {MIN_WORDS}, score DESC, doc_id) END AS place FROM scored)
SELECT doc_id, CAST(n_features AS BIGINT) AS n_features, CAST(weight AS BIGINT) AS weight, CAST(score AS BIGINT) AS score,
  CASE WHEN place <= {PERCENT} * (SELECT count(*) FROM scored WHERE n_words >= {MIN_WORDS}) // 100 THEN place END AS rank
FROM ranked
"""
