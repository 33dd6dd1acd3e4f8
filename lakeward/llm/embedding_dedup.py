"""Near copies among vectors by sorted projection passes.

In each pass the vectors are ordered by a key of random hashes, the signs of projections on
random directions; neighbours that share the key's first bits are a run, and a run's vectors
are compared with one another, window by window. Verified pairs of all passes are joined to
components. The number of bits follows from the sizes of the runs that a few passes give, and the
number of passes from the bits, so that a pair at the threshold is missed by all passes with
a chance of MISS at most. A run that is larger than a window, say of vectors in a hot region, is not
cut off: every two of its windows meet in a task of their own.

Products are taken in single precision; those within its error of the threshold are taken
again in double precision, so no link is invented. A pair is counted in the first pass in
which its vectors share a run, which its vectors' keys tell, made anew where a pair is found: neither pairs nor
keys of other passes are sent.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import components, stage, table, unstage

COSINE = 0.95
#: Chance that all passes miss a pair whose cosine is COSINE; closer pairs are missed more rarely.
MISS = 1e-6
#: Passes that measure the runs, bits of their keys, and most passes.
TRIALS, BITS, MOST_PASSES = 4, 24, 256
#: Comparisons that take as long as sending a vector once.
SENDING = 512
#: Components of vectors in a window at most, windows that a large run is dealt over, and vectors of the least window.
CHUNK, SPREAD, LEAST = 1 << 20, 8, 4096
#: Rows of a window that are compared at once.
STRIPE = 256


def unit(column: pa.Array) -> np.ndarray:
    """Rows of a list column of equal lengths as unit vectors in double precision."""
    x = column.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(len(column), -1)
    x /= np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _columns(t: pa.Table, *names: str) -> list[pa.Array]:
    return [t.column(n).combine_chunks() for n in names]


def near(x: np.ndarray, y: np.ndarray, x32: np.ndarray, y32: np.ndarray) -> np.ndarray:
    """Which rows of x and y have COSINE or more; x32 and y32 are the same in single precision."""
    error = (x.shape[1] + 8) * 2.0**-22  # of a product in single precision, with room
    s = x32 @ y32.T
    found = s >= COSINE + error
    i, j = np.nonzero((s >= COSINE - error) & ~found)
    for at in range(0, len(i), 4096):
        p, q = i[at : at + 4096], j[at : at + 4096]
        found[p, q] = (x[p] * y[q]).sum(axis=1) >= COSINE
    return found


def compare(ids: np.ndarray, mult: np.ndarray, x: np.ndarray, keys: Callable[[np.ndarray], np.ndarray], first: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """Per row the number of other vectors with COSINE or more that share none of their `keys`, of the
    passes before, with it, and the smallest id it is joined with. Keys are made anew for those that are
    that near alone. `first` marks the rows of one of two windows that meet; rows of one window alone (None) meet each other."""
    n, label = np.zeros(len(ids), np.int64), np.arange(len(ids))
    rows, columns = (np.arange(len(ids)),) * 2 if first is None else (np.flatnonzero(first), np.flatnonzero(~first))
    x32 = x.astype(np.float32)
    y, y32 = x[columns], x32[columns]
    for at in range(0, len(rows), STRIPE):
        own = rows[at : at + STRIPE]
        found = near(x[own], y, x32[own], y32)
        if first is None:
            found[np.arange(len(own)), own] = False
        i, j = np.nonzero(found)
        if not len(i):
            continue
        i, j = own[i], columns[j]
        some, at_some = np.unique(np.concatenate([i, j]), return_inverse=True)
        seen, a, b = keys(x[some]), at_some[: len(i)], at_some[len(i) :]
        new = np.ones(len(i), bool)
        for q in range(seen.shape[1]):
            new &= seen[a, q] != seen[b, q]
        np.add.at(n, i[new], mult[j[new]])
        if first is not None:
            np.add.at(n, j[new], mult[i[new]])
        for k in np.unique(i):
            joined = np.append(label[j[i == k]], label[k])
            if joined.min() < joined.max():
                into = np.arange(len(ids))
                into[joined] = joined.min()
                label = into[label]
    low = np.full(len(ids), np.iinfo(np.int64).max)
    np.minimum.at(low, label, ids)
    return n, low[label]


def passes_for(bits: int) -> int:
    """Passes with keys of so many bits that miss a pair at COSINE with chance MISS."""
    same = (1 - math.acos(COSINE) / math.pi) ** bits
    return 1 if same == 1 else math.ceil(math.log(MISS) / math.log1p(-same))


@lru_cache(maxsize=MOST_PASSES)
def directions(dim: int, p: int) -> np.ndarray:
    """BITS random directions of one pass, in whole numbers."""
    return np.rint(np.random.default_rng([dim, p]).standard_normal((BITS, dim)) * 2.0**10)


def keys_of(x: np.ndarray, passes: int, bits: int) -> np.ndarray:
    """Per row and pass the signs of its projections on the pass's directions, as a number.
    The directions follow from the length of the vectors, the pass and the bit. Projections are sums of
    whole numbers below 2^53, so a vector has the same keys wherever they are made."""
    out, whole = np.zeros((len(x), passes), np.int32), np.rint(x * 2.0**20)
    for p in range(passes if bits else 0):
        out[:, p] = (whole @ directions(x.shape[1], p)[:bits].T > 0) @ (1 << np.arange(bits)[::-1])
    return out


def with_keys(nodes: DataFrame, passes: int, bits: int) -> DataFrame:
    """Adds to nodes(rep, v, mult, dim) keys, an array of one number a pass."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            for d in np.unique(dims):
                some = batch.filter(pa.array(dims == d))
                keys = keys_of(unit(some.column("v")), passes, bits)
                flat = pa.ListArray.from_arrays(pa.array(np.arange(len(keys) + 1, dtype=np.int32) * passes), pa.array(keys.ravel()))
                yield pa.RecordBatch.from_arrays([*some.columns, flat], [*some.schema.names, "keys"])

    return nodes.mapInArrow(run, T.StructType([*nodes.schema.fields, T.StructField("keys", T.ArrayType(T.IntegerType()))]))


def bits_for(nodes: DataFrame) -> int:
    """The bits with which all passes together cost least, by the runs of TRIALS passes."""
    keyed = with_keys(nodes, TRIALS, BITS).select("dim", F.posexplode("keys").alias("p", "key"))
    runs = stage(keyed.groupBy("dim", "p", "key").agg(F.count("*").alias("n")), "runs")
    vectors = (runs.agg(F.sum("n")).first()[0] or 0) / TRIALS
    tried = [b for b in range(0, BITS + 1, 2) if passes_for(b) <= MOST_PASSES]
    level = F.explode(F.array(*(F.struct(F.lit(b).alias("bits"), F.shiftright("key", BITS - b).alias("k")) for b in tried)))
    size = runs.select("dim", "p", "n", level.alias("l")).groupBy("dim", "p", "l.bits", "l.k").agg(F.sum("n").cast("double").alias("n"))
    pairs = {r.bits: r.n / TRIALS / 2 for r in size.groupBy("bits").agg(F.sum(F.col("n") * F.col("n")).alias("n")).collect()}
    unstage(runs)
    return min(tried, key=lambda b: (passes_for(b) * (pairs.get(b, 0) + SENDING * vectors), b))


GROUP = ["dim", "pass", "key", "i", "j"]


def links(nodes: DataFrame, bits: int | None = None) -> DataFrame:
    """Rows (rep, low, n) per linked vector and two windows that meet: n others there with
    COSINE or more, and low the smallest of those it is joined with."""
    bits = bits_for(nodes) if bits is None else bits
    keyed = stage(with_keys(nodes, passes_for(bits), bits), "keyed")
    rows = keyed.select("*", F.posexplode("keys").alias("pass", "key"))
    sizes = rows.groupBy("dim", "pass", "key").agg(F.count("*").alias("size"))
    most = F.greatest(F.lit(LEAST), F.least(F.floor(F.lit(CHUNK) / F.col("dim")), F.ceil(F.col("size") / SPREAD)))
    # written first: where they are few, as they mostly are, the join sends them and not the vectors
    large = stage(sizes.where(F.col("size") > LEAST).select("dim", "pass", "key", F.ceil(F.col("size") / most).cast("int").alias("windows")), "large-runs")
    k = F.coalesce("windows", F.lit(1))
    each = (
        rows.join(large, ["dim", "pass", "key"], "left")
        .withColumn("window", F.pmod(F.xxhash64("rep"), k).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), k - 1)))
        .select("dim", "pass", "key", F.least("window", "other").alias("i"), F.greatest("window", "other").alias("j"), "window", "rep", "mult", "v")
    )

    def met(t: pa.Table) -> pa.RecordBatch | None:
        if len(t) < 2:
            return None
        rep, v, mult, window, i, j, passed = (t.column(c).combine_chunks() for c in ("rep", "v", "mult", "window", "i", "j", "pass"))
        ids, i, j, passed = rep.to_numpy(), i[0].as_py(), j[0].as_py(), passed[0].as_py()
        n, low = compare(ids, mult.to_numpy(), unit(v), lambda x: keys_of(x, passed, bits), None if i == j else window.to_numpy() == i)
        keep = (n > 0) | (low < ids)
        return pa.RecordBatch.from_arrays([pa.array(ids[keep]), pa.array(low[keep]), pa.array(n[keep])], ["rep", "low", "n"]) if keep.any() else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Sorted rows, a group at a time: only the group that a batch leaves open is held."""
        held: list[pa.Table] = []
        for batch in batches:
            t = pa.Table.from_batches([batch])
            columns = [t.column(c).to_numpy() for c in GROUP]
            ends = np.flatnonzero(np.any([c[1:] != c[:-1] for c in columns], axis=0)) + 1
            if held and len(t) and any(held[-1].column(c)[-1].as_py() != t.column(c)[0].as_py() for c in GROUP):
                if (out := met(pa.concat_tables(held))) is not None:
                    yield out
                held = []
            for a, b in zip(np.r_[0, ends], np.r_[ends, len(t)], strict=True):
                held.append(t.slice(a, b - a))
                if b < len(t):
                    if (out := met(pa.concat_tables(held))) is not None:
                        yield out
                    held = []
        if held and (out := met(pa.concat_tables(held))) is not None:
            yield out

    sorted_ = each.repartition(*GROUP).sortWithinPartitions(*GROUP)
    out = stage(sorted_.mapInArrow(run, "rep bigint, low bigint, n bigint"), "links")
    unstage(keyed, large)
    return out


def link_vectors(rows: DataFrame) -> DataFrame:
    """Rows (vec_id, n_links, component_id, kept), one per row.

    Vectors that are null, empty, zero or hold null or non-finite components link with nothing and
    keep themselves, as do vectors of different lengths with one another; equal vectors are
    one node with a multiplicity, however many; rows that repeat an id are one node; a row with a null id
    links with nothing, has a null component and is kept; an empty table gives an empty result; other columns are dropped.
    """
    v = F.col("v")
    single = rows.schema["embedding"].dataType.simpleString() == "array<float>"
    own = rows.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col("embedding").cast("array<float>" if single else "array<double>").alias("v"))
    sound = (F.size(v) > 0) & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    valid = own.where(F.coalesce(sound, F.lit(False)) & F.col("vec_id").isNotNull())
    groups = valid.groupBy("v").agg(F.min("vec_id").alias("rep"), F.count("*").alias("mult"))
    nodes = stage(groups.withColumn("dim", F.size("v")), "vectors")
    found = links(nodes)
    linked = components(found.select(F.col("rep").alias("a"), F.col("low").alias("b")).distinct())
    counts = found.groupBy("rep").agg(F.sum("n").alias("n"))
    told = (
        nodes.join(linked, F.col("rep") == F.col("node"), "left")
        .select("v", "rep", "mult", "root")
        .join(counts, "rep", "left")
        .select(F.col("v").alias("w"), (F.coalesce("n", F.lit(0)) + F.col("mult") - 1).alias("links"), F.coalesce("root", "rep").alias("least"))
    )
    sure = F.coalesce(sound, F.lit(False)) & F.col("vec_id").isNotNull()
    component = F.coalesce("least", "vec_id")
    return own.join(told, sure & (F.col("v") == F.col("w")), "left").select(
        "vec_id",
        F.coalesce("links", F.lit(0)).cast("bigint").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"),
    )


def op7_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link_vectors(table(spark, sf_dir, "embeddings"))
