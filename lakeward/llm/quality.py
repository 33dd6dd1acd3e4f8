"""Quality by importance resampling.

Two bag-of-n-gram models over hashed words and word pairs are counted: one on texts labelled good
(the target), one on all texts (the raw model). A text's weight is the mean log
ratio of the two over its n-grams. Texts are sampled without replacement in proportion to
exp(weight / TEMPERATURE): each gets its weight plus Gumbel noise as key, and the k
largest keys are kept.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import stage, table, unstage, within

BUCKETS = 1 << 16
#: Bounds on the labelled good rows of the target model and on those that set k; None: all of them.
TARGET_ROWS = CUT_ROWS = None
#: Share of labelled good rows that the cut behind k keeps.
KEEP_GOOD = 0.998
TEMPERATURE = 0.005
#: Added to every bucket's count.
SMOOTHING = 1.0
#: N-grams without evidence that are added to every text, so few words decide little.
PRIOR = 20
#: Bucket key of a word pair that repeats a word.
REPEAT = 77
REMEMBERED = 30_000

WORDS = re.compile(r"[A-Z]{2,}(?![a-z])|\w+|[^\w\s]+")


class _Hashes(dict):
    """Word hashes, remembered; capitals of a whole word are one shape."""

    def __missing__(self, w: str) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        h = self[w] = zlib.crc32(("\x01CAPS" if len(w) > 1 and w.isupper() else w).encode())
        return h


@lru_cache(maxsize=1)
def _hashes() -> _Hashes:
    """One per Python worker, kept from task to task."""
    return _Hashes()


def ngrams(text: str, buckets: int = BUCKETS) -> np.ndarray:
    """Buckets of the text's words and word pairs."""
    known = _hashes()
    words = np.array([known[w] for w in WORDS.findall(text)], np.int64)
    left, right = words[:-1], words[1:]
    pairs = np.where(left == right, REPEAT, (left * 1_000_003 + right * 8_191 + 7) % 2_147_483_647)
    return np.concatenate([words % buckets, pairs % buckets])


def count_ngrams(docs: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """Counts over all rows. Each task sums its own, Spark sums those per bucket; the
    driver gets `buckets` numbers whatever the input."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for t in batch.column(0):
                if t.is_valid:
                    total += np.bincount(ngrams(t.as_py(), buckets), minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["bucket", "n"])

    parts = docs.select(F.col("text").cast("string").alias("text")).mapInArrow(run, "bucket bigint, n bigint")
    out = np.zeros(buckets)
    for r in parts.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r.bucket] = r.n
    return out


def log_ratio(target: np.ndarray, raw: np.ndarray) -> np.ndarray:
    """Per bucket; zero everywhere if there is no target to go by."""
    if not target.sum():
        return np.zeros(len(raw))
    smooth = lambda c: np.log((c + SMOOTHING) / (c.sum() + SMOOTHING * len(c)))
    return smooth(target) - smooth(raw)


def weigh(docs: DataFrame, ratio: np.ndarray, seed: int = 7) -> DataFrame:
    """Adds to docs text_hash, log_weight (mean log ratio; 0 for a text without words)
    and key. The noise depends on id, text and seed alone."""
    sent = docs.sparkSession.sparkContext.broadcast(ratio)
    buckets = len(ratio)
    docs = docs.drop("text_hash", "log_weight", "key").withColumn("text_hash", F.xxhash64(F.col("text").cast("string")))
    fields = T.StructType([*docs.schema.fields, T.StructField("log_weight", T.DoubleType())])
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by = sent.value
        for batch in batches:
            out = [float(by[g := ngrams(t.as_py() or "", buckets)].sum()) / (len(g) + PRIOR) for t in batch.column(at)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.float64())], [*batch.schema.names, "log_weight"])

    uniform = (F.pmod(F.xxhash64(F.col("doc_id").cast("bigint"), "text_hash", F.lit(seed)), F.lit(1 << 52)) + 0.5) / float(1 << 52)
    return docs.mapInArrow(run, fields).withColumn("key", F.col("log_weight") / TEMPERATURE - F.log(-F.log(uniform)))


def kth_largest(rows: DataFrame, column: str, k: int, bins: int = 2048) -> float | None:
    """The k-th largest value, found by counting in ever narrower bins: no sort, and
    at most `bins` numbers a round reach the driver. None if there are fewer rows."""
    low, high, n = rows.agg(F.min(column), F.max(column), F.count(column)).first()
    if k > n or k <= 0:
        return None
    above = 0
    while low < high:
        width = (high - low) / bins
        at = F.least(F.floor((F.col(column) - low) / width), F.lit(bins - 1)).cast("int") if width > 0 else F.lit(0)
        inside = rows.where((F.col(column) >= low) & (F.col(column) <= high))
        found = sorted(inside.groupBy(at.alias("b")).agg(F.count("*").alias("n"), F.min(column).alias("lo"), F.max(column).alias("hi")).collect(), key=lambda r: -r.b)
        for r in found:
            if above + r.n >= k:
                stuck = len(found) == 1 and (r.lo, r.hi) == (low, high) and width == 0
                low, high = r.lo, r.hi
                break
            above += r.n
        if stuck:
            break
    return high if k == above + 1 else low


def sampled_labels(labels: DataFrame, quality: int, most: int | None = None, for_cut: bool = False) -> DataFrame:
    """Ids of the rows of one label; with `most`, of so many with the smallest checksums. A fifth
    of the labelled rows is for the cut, the others for the model."""
    mine = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    sum_ = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    part = (sum_ % 5 == 0) if for_cut else (sum_ % 5 != 0)
    ids = mine.where((F.col("quality") == quality) & part).select("doc_id")
    return ids if most is None else ids.orderBy(sum_, "doc_id").limit(most)


def fit(docs: DataFrame, labels: DataFrame) -> np.ndarray:
    """Log ratios of the target model, from labelled good rows, and the raw model, from all rows."""
    own = docs.select("doc_id", "text")
    target = count_ngrams(within(own, sampled_labels(labels, 1, TARGET_ROWS), "doc_id"))
    return log_ratio(target, count_ngrams(docs))


def good_cut(rows: DataFrame, labels: DataFrame) -> float:
    """The weight that KEEP_GOOD of labelled good rows reach that the target model has not seen; one weight an id,
    the least of its rows. They are ranked by counting, so none of them reaches the driver."""
    mine = rows.select("doc_id", "log_weight").join(sampled_labels(labels, 1, CUT_ROWS, for_cut=True), "doc_id", "left_semi")
    good = stage(mine.groupBy("doc_id").agg(F.min("log_weight").alias("log_weight")), "cut")
    n = good.count()
    cut = kth_largest(good, "log_weight", n - int((1 - KEEP_GOOD) * n)) if n else None
    unstage(good)
    return cut if cut is not None else float("-inf")


def least_key(rows: DataFrame, labels: DataFrame, keep: int | None = None) -> float:
    """The key of the last row sampled from rows(doc_id, log_weight, key). Without `keep`, k is
    the number of rows whose weight passes `good_cut`."""
    if keep is None:
        keep = rows.where(F.col("log_weight") >= good_cut(rows, labels)).count()
    least = kth_largest(rows, "key", keep)
    return least if least is not None else float("-inf") if keep > 0 else float("inf")


def resample(docs: DataFrame, labels: DataFrame, keep: int | None = None) -> DataFrame:
    """Rows (doc_id, log_weight, key, kept).

    Null and empty texts weigh 0; rows that repeat id and text share weight and noise,
    and rows tied at the k-th key are all kept; without good labels every weight is 0 and
    every row is kept; an empty table gives an empty result; other columns are dropped.
    """
    own = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = stage(weigh(own, fit(docs, labels)).select("doc_id", "log_weight", "key"), "weights")
    return rows.withColumn("kept", F.col("key") >= least_key(rows, labels, keep))


def keep_good(docs: DataFrame, labels: DataFrame, keep: int | None = None) -> DataFrame:
    """`docs` without the rows that `resample` rejects, all columns kept. Rows are written
    with their keys and filtered as they are read again, so texts are weighed once and never
    shuffled. Null texts and null ids are rows like any other; an empty table stays empty."""
    names = [f"__{i}" for i in range(len(docs.columns))]
    plain = docs.select(*(F.col(c).alias(n) for c, n in zip(docs.columns, names, strict=True)), F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = stage(weigh(plain, fit(docs, labels)).select(*names, "doc_id", "log_weight", "key"), "weights")
    return rows.where(F.col("key") >= least_key(rows, labels, keep)).select(*(F.col(n).alias(c) for c, n in zip(docs.columns, names, strict=True)))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
