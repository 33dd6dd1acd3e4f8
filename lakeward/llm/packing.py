"""Packing by cutting-stock column generation.

Documents are token sequences cut into pieces of at most CAPACITY tokens. The
histogram of piece lengths (a bounded number of length classes) is the demand of
a cutting-stock problem: a linear program over patterns, whose columns a knapsack
recursion prices at the current dual values. Whole multiples of the patterns are
taken, what rounding leaves is packed first-fit-decreasing, and the patterns' places are
given to the pieces by their rank within their length class.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import stage, table
from .tokens import VOCABULARY, encoder

CAPACITY = 2048
END_ID = 1
#: Rounds of pricing; beyond them the program's current patterns are used.
ROUNDS = 100
#: Relative distance from the lower bound at which the program counts as solved.
GAP = 2e-4
#: Pieces numbered in one window group.
GROUP_ROWS = 2_000


def length_class(n: Column, capacity: int = CAPACITY) -> Column:
    """Upper end of the length class: exact up to 128, then 64 classes an octave."""
    out, low, width = n, 128, 2
    while low < capacity:
        out = F.when(n > low, F.least(F.ceil(n / width) * width, F.lit(capacity))).otherwise(out)
        low, width = low * 2, width * 2
    return out.cast("int")


def cut(docs: DataFrame, vocabulary: str = VOCABULARY, capacity: int = CAPACITY) -> DataFrame:
    """Pieces (doc_id, start, length, ids_crc32, doc_tokens): whole sequences as long
    as they last, then the rest. A document's ids end with END_ID, so an empty or
    null text is one piece of length 1."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of, end = encoder(vocabulary).ids, np.array([END_ID], "<u4").tobytes()
        for batch in batches:
            rows: list[list] = [[], [], [], [], []]
            for doc, t in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = ids_of(t.as_py() or "") + end
                n = len(ids) // 4
                for at in range(0, n, capacity):
                    part = ids[4 * at : 4 * (at + capacity)]
                    for to, x in zip(rows, (doc, at, len(part) // 4, zlib.crc32(part), n), strict=True):
                        to.append(x)
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in rows], ["doc_id", "start", "length", "ids_crc32", "doc_tokens"])

    fields = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint"
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, fields)


def knapsack(sizes: np.ndarray, values: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Best value for each room up to `capacity`, and the item taken there (-1: none)."""
    best, item = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    worth = np.flatnonzero(values > 1e-12)
    s, v = sizes[worth], values[worth]
    fits = np.searchsorted(s, np.arange(capacity + 1), side="right")
    for c in range(1, capacity + 1):
        best[c] = best[c - 1]
        if k := fits[c]:
            got = best[c - s[:k]] + v[:k]
            j = int(got.argmax())
            if got[j] > best[c] + 1e-12:
                best[c], item[c] = got[j], worth[j]
    return best, item


def _pattern(sizes: np.ndarray, item: np.ndarray, room: int, first: int | None = None) -> np.ndarray:
    a = np.zeros(len(sizes))
    if first is not None:
        a[first] += 1
        room -= sizes[first]
    while room > 0:
        if item[room] < 0:
            room -= 1
        else:
            a[item[room]] += 1
            room -= sizes[item[room]]
    return a


def first_fit(sizes: np.ndarray, demand: np.ndarray, capacity: int) -> list[tuple[np.ndarray, int]]:
    """First fit decreasing by classes: each pattern is cut as often as it repeats."""
    left, out = demand.astype(np.int64).copy(), []
    while left.any():
        a, room = np.zeros(len(sizes), np.int64), capacity
        for k in np.flatnonzero(left)[::-1]:
            if sizes[k] <= room:
                a[k] = min(left[k], room // sizes[k])
                room -= a[k] * sizes[k]
        used = np.flatnonzero(a)
        times = int((left[used] // a[used]).min())
        out.append((a, times))
        left -= a * times
    return out


class Program:
    """The restricted linear program: fewest sequences over the patterns known so
    far. The basis holds one pattern per class and starts with unmixed ones."""

    def __init__(self, sizes: np.ndarray, demand: np.ndarray, capacity: int):
        self.pool = np.diag((capacity // sizes).astype(float))
        self.basis = np.arange(len(sizes))
        self.inverse = np.diag(1 / np.diag(self.pool))
        self.x = self.inverse @ demand

    def add(self, patterns: list[np.ndarray]) -> None:
        self.pool = np.column_stack([self.pool, *patterns])

    def optimise(self, pivots: int) -> np.ndarray:
        """Simplex steps until no known pattern pays; gives the dual values."""
        for _ in range(pivots):
            dual = self.inverse.sum(axis=0)
            gain = dual @ self.pool
            k = int(gain.argmax())
            if gain[k] <= 1 + 1e-9:
                break
            u = self.inverse @ self.pool[:, k]
            rows = np.flatnonzero(u > 1e-9)
            if not len(rows):
                break
            r = rows[np.argmin(self.x[rows] / u[rows])]
            step = max(0.0, self.x[r] / u[r])
            self.x = self.x - step * u
            self.x[r] = step
            row = self.inverse[r] / u[r]
            self.inverse = self.inverse - np.outer(u, row)
            self.inverse[r] = row
            self.basis[r] = k
        return self.inverse.sum(axis=0)


def solve(sizes: np.ndarray, demand: np.ndarray, capacity: int = CAPACITY) -> list[tuple[np.ndarray, int]]:
    """Patterns (pieces per class) and how often each is cut; together they cut the
    demand exactly. `sizes` ascends. The program starts from the patterns of first fit,
    so it is never worse, and gains columns until it is within GAP of the lower bound."""
    m = len(sizes)
    if not m:
        return []
    greedy = first_fit(sizes, demand, capacity)
    program = Program(sizes, demand, capacity)
    program.add([a for a, _ in greedy])
    low = float(demand @ sizes) / capacity
    for _ in range(ROUNDS):
        dual = program.optimise(8 * m)
        best, item = knapsack(sizes, dual, capacity)
        low = max(low, float(demand @ dual) / max(best[capacity], 1e-9))  # dual values over best are feasible
        if best[capacity] <= 1 + 1e-7 or program.x.sum() <= low * (1 + GAP):
            break
        starts = np.argsort(-(dual + best[capacity - sizes]))[:64]
        fresh = {p.tobytes(): p for p in (_pattern(sizes, item, capacity, k) for k in (None, *starts))}
        program.add([p for p in fresh.values() if dual @ p > 1 + 1e-9])
    left, out = demand.astype(np.int64).copy(), []
    for k in np.argsort(-program.x):
        a = program.pool[:, program.basis[k]].astype(np.int64)
        used = np.flatnonzero(a)
        times = int(min(np.floor(program.x[k] + 1e-6), (left[used] // a[used]).min()))
        if times > 0:
            out.append((a, times))
            left -= a * times
    out += first_fit(sizes, left, capacity)
    return min(out, greedy, key=lambda plan: sum(t for _, t in plan))


def places(sizes: np.ndarray, plan: list[tuple[np.ndarray, int]]) -> dict[int, np.ndarray]:
    """Per class, rows (first rank, pieces in a sequence, first sequence, first slot)
    in order of rank."""
    rank, sequence = np.zeros(len(sizes), np.int64), 0
    out: dict[int, list] = {int(s): [] for s in sizes}
    for a, times in plan:
        slot = 0
        for k in np.flatnonzero(a)[::-1]:
            out[int(sizes[k])].append((rank[k], a[k], sequence, slot))
            rank[k] += a[k] * times
            slot += a[k]
        sequence += times
    return {k: np.array(v, np.int64) for k, v in out.items()}


def pack(docs: DataFrame, vocabulary: str = VOCABULARY, capacity: int = CAPACITY) -> DataFrame:
    """Rows (doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset).

    Null and empty texts are one piece of length 1; repeated rows are packed as often
    as they stand there; null ids are kept; ties in length are ranked by id and start;
    an empty table gives an empty result; other columns are dropped. A class that holds
    a large share of the pieces is numbered in groups of about GROUP_ROWS, into which repeated rows are
    dealt like any other, by their place in the stored pieces; to the driver
    comes one count per length class (at most 384).
    """
    spark = docs.sparkSession
    pieces = stage(cut(docs, vocabulary, capacity).withColumn("cls", length_class(F.col("length"), capacity)).withColumn("row", F.monotonically_increasing_id()), "pieces")
    hist = sorted((r.cls, r.n) for r in pieces.groupBy("cls").agg(F.count("*").alias("n")).collect())
    sizes = np.array([h[0] for h in hist], np.int64)
    where = places(sizes, solve(sizes, np.array([h[1] for h in hist], float), capacity))
    groups = 1 + sum(h[1] for h in hist) // GROUP_ROWS
    ranked = pieces.withColumn("grp", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32", "row"), F.lit(groups)).cast("int"))
    before = Window.partitionBy("cls").orderBy("grp").rowsBetween(Window.unboundedPreceding, -1)
    first = (
        ranked.groupBy("cls", "grp")
        .agg(F.count("*").alias("n"))
        .select("cls", "grp", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    )
    own = Window.partitionBy("cls", "grp").orderBy("doc_id", "start", "row")
    ranked = ranked.withColumn("nth", F.row_number().over(own) - 1).join(first, ["cls", "grp"])

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cls, rank = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            sequence, slot = np.zeros(len(cls), np.int64), np.zeros(len(cls), np.int64)
            for c in np.unique(cls):
                at = np.flatnonzero(cls == c)
                rows = where[int(c)]
                got = rows[np.searchsorted(rows[:, 0], rank[at], side="right") - 1]
                nth = rank[at] - got[:, 0]
                sequence[at] = got[:, 2] + nth // got[:, 1]
                slot[at] = got[:, 3] + nth % got[:, 1]
            rest = [batch.column(i) for i in range(2, 7)]
            yield pa.RecordBatch.from_arrays(
                [*rest, pa.array(sequence), pa.array(slot)], ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "slot"]
            )

    fields = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, slot bigint"
    given = ranked.select("cls", (F.col("first") + F.col("nth")).cast("bigint").alias("rank"), "doc_id", "start", "length", "ids_crc32", "doc_tokens").mapInArrow(
        assign, fields
    )
    inside = Window.partitionBy("sequence_id").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    return given.select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id",
        F.coalesce(F.sum("length").over(inside), F.lit(0)).cast("bigint").alias("offset"),
    )


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))
