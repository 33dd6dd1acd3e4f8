"""Jaccard join on word shingles by token-combination prefixes.

Tokens (hashed shingles) are ordered rare first, frequent last, by a count sketch of
all documents. A document's prefix is extended until its mismatch budget is used up
twice over: rare tokens count singly, frequent ones fall into classes where each token
after the first counts. Two documents over the threshold then share a rare token of their prefixes or
two frequent tokens of one class, so single rare tokens and pairs of frequent ones are
indexed. Candidates are bounded by parity bitmaps and verified on whole sets.

Equal sets are one node, and lists with the same members are one list. First the members
of each list are held against one of them, the one that meets the most others; only
members that this leaves in different components are paired further, so a large group of
near copies costs little more than its size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import components, stage, table, unstage, without

#: Buckets of the count sketch and of the filter for documents to verify.
SKETCH, FILTER_BITS = 1 << 18, 1 << 23
#: A token is frequent if its bucket exceeds the mean by this much, in rows and in roots of the mean.
EXCESS, ROOTS = 48, 8
#: Classes of frequent tokens; sets above LARGE index single tokens only.
CLASSES, LARGE = 32, 8000
#: Longs of the parity bitmap that every set has, and of a wider one for sets above a size.
NARROW, WIDE = 16, ((8000, 256), (1000, 64))
#: Pairs that are verified at once; each holds two whole sets.
PAIRS_AT_ONCE = 32
#: Steps of the order of tokens by their buckets' counts.
LEVELS = 256

MASK = (1 << 64) - 1


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads 64-bit values (a finaliser of two multiplications)."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


with np.errstate(over="ignore"):  # odd multipliers without a pattern among them
    ODD = [int(v) | 1 for v in mix(np.arange(1, 65, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))]


#: Bytes of text hashed at once, up to the next white space.
CHUNK = 1 << 21
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
with np.errstate(over="ignore"):  # a value per byte (A-Z as a-z) and a multiplier per place
    VALUES = mix(np.arange(1000, 1256, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    VALUES[65:91] = VALUES[97:123]
    POWERS = np.cumprod(np.full(1 << 12, ODD[7], np.uint64))


def _powers(n: int) -> np.ndarray:
    """The first n places' multipliers."""
    with np.errstate(over="ignore"):
        return POWERS[:n] if n <= len(POWERS) else np.cumprod(np.full(n, ODD[7], np.uint64))


def _hash_words(b: np.ndarray) -> np.ndarray:
    inside = ~SPACE[b]
    begin = inside.copy()
    begin[1:] &= ~inside[:-1]
    starts = np.flatnonzero(begin)
    if not len(starts):
        return np.zeros(0, np.uint64)
    at = np.flatnonzero(inside)
    first = np.searchsorted(at, starts)
    lengths = np.diff(np.append(first, len(at)))
    place = np.arange(len(at)) - np.repeat(first, lengths)
    sums = np.add.reduceat(VALUES[b[at]] * _powers(int(lengths.max()))[place], first)
    return mix(sums + lengths.astype(np.uint64) * np.uint64(ODD[9]))


def word_hashes(text: str) -> np.ndarray:
    """A hash per word, in order; words are what ASCII white space parts."""
    b = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    if len(b) <= CHUNK:
        return _hash_words(b)
    out, at = [], 0
    while at < len(b):
        end = at + CHUNK
        while end < len(b) and not SPACE[b[end : end + CHUNK]].any():
            end += CHUNK
        end += int(SPACE[b[end : end + CHUNK]].argmax()) if end < len(b) else 0
        out.append(_hash_words(b[at:end]))
        at = end
    return np.concatenate(out)


def shingles(text: str | None, width: int) -> np.ndarray:
    """Sorted distinct hashes of the text's shingles, upper case A-Z read as lower case.
    Fewer words than `width` are one shingle; no words, none."""
    h = word_hashes(text or "")
    if not len(h):
        return h
    n, k = len(h), min(width, len(h))
    out = np.full(n - k + 1, (k * 0x632BE59BD9B4E019) & MASK, np.uint64)
    for i in range(k):
        out += h[i : n - k + 1 + i] * np.uint64(ODD[i % 64])
    return np.unique(mix(out))


class Prefixes:
    """Index signatures of token sets for one threshold (in percent)."""

    def __init__(self, percent: int, frequent: np.ndarray, level: np.ndarray | None = None):
        """`frequent` and `level` (the order) are by sketch bucket."""
        self.percent, self.frequent, self.level = percent, frequent, level
        small = CLASSES + 1
        while not all(n - CLASSES >= self.budget(n) + 1 for n in range(small * percent // 100, small * percent // 100 + 200)):
            small += 1
        self.small = small

    def budget(self, n: int) -> int:
        """Tokens of a set of n that a partner over the threshold may lack."""
        return n - -(-self.percent * n // 100)

    def of(self, h: np.ndarray) -> np.ndarray:
        n = len(h)
        if not n:
            return h
        need = self.budget(n) + 1
        bucket = (h % np.uint64(SKETCH)).astype(np.int64)
        if self.level is not None:
            order = np.argsort(self.level[bucket], kind="stable")
            h, bucket = h[order], bucket[order]
        often = self.frequent[bucket]
        rare, common = h[~often], h[often]
        out = []
        if n <= self.small or n >= LARGE * self.percent // 100:
            out.append(mix(np.concatenate([rare, common])[:need] ^ np.uint64(0x5851F42D4C957F2D)))
        if self.small * self.percent // 100 <= n <= LARGE:
            out.append(mix(rare[:need] + np.uint64(0x14057B7EF767814F)))
            left = need - len(rare)
            if left > 0:
                group = ((common >> np.uint64(24)) % np.uint64(CLASSES)).astype(np.int64)
                first = np.zeros(len(common), np.int64)
                first[np.unique(group, return_index=True)[1]] = 1
                covered = np.arange(1, len(common) + 1) - np.cumsum(first)
                m = int(np.searchsorted(covered, left)) + 1
                for g in range(CLASSES):
                    x = common[:m][group[:m] == g]
                    if len(x) > 1:
                        i, j = np.triu_indices(len(x), 1)
                        out.append(mix(x[i] * np.uint64(ODD[1]) + x[j] * np.uint64(ODD[2])))
        return np.unique(np.concatenate(out))


def count_buckets(docs: DataFrame, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Which sketch buckets hold frequent tokens, and every bucket's place in the order
    of counts, from all rows. The driver gets SKETCH numbers whatever the input."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(SKETCH, np.int64)
        for batch in batches:
            for t in batch.column(0):
                if t.is_valid:
                    np.add.at(total, (shingles(t.as_py(), width) % np.uint64(SKETCH)).astype(np.int64), 1)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], ["bucket", "n"])

    text = docs.select(F.col("text").cast("string").alias("text"))
    found = text.mapInArrow(run, "bucket int, n bigint").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(SKETCH, np.int64)
    counts[found.column("bucket").to_numpy()] = found.column("n").to_numpy()
    mean = counts.sum() / SKETCH
    place = np.empty(SKETCH, np.int64)
    place[np.argsort(counts, kind="stable")] = np.arange(SKETCH)
    return counts > mean + max(EXCESS, ROOTS * mean**0.5), (place * LEVELS // SKETCH).astype(np.uint8)


def parity(h: np.ndarray, longs: int) -> np.ndarray:
    """One bit per bucket, set if an odd number of tokens falls into it: bitmaps of two sets
    differ in no more places than the sets do in tokens."""
    bits = np.bincount(((h >> np.uint64(40)) % np.uint64(64 * longs)).astype(np.int64), minlength=64 * longs) & 1
    return np.packbits(bits.astype(np.uint8)).view(np.int64)


def index_sets(docs: DataFrame, width: int, percent: int, frequent: np.ndarray, level: np.ndarray) -> DataFrame:
    """Per row of docs: doc_id, n (set size), sig (digest of the set), signatures, bitmaps."""
    sent = docs.sparkSession.sparkContext.broadcast((np.packbits(frequent), level))

    def longs(values: list[np.ndarray]) -> pa.Array:
        ends = np.cumsum([0, *map(len, values)]).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(values) if values else np.zeros(0, np.int64)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        flags, order = sent.value
        prefixes = Prefixes(percent, np.unpackbits(flags, count=SKETCH).astype(bool), order)
        for batch in batches:
            n, sig, signatures, narrow, wide = [], [], [], [], []
            for t in batch.column(1):
                h = shingles(t.as_py(), width)
                n.append(len(h))
                sig.append(xxhash.xxh3_128_digest(h.tobytes()) if len(h) else None)
                signatures.append(prefixes.of(h).view(np.int64))
                narrow.append(parity(h, NARROW))
                wide.append(parity(h, next((k for least, k in WIDE if len(h) > least), 0)) if len(h) > WIDE[-1][0] else np.zeros(0, np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(sig, pa.binary()), longs(signatures), longs(narrow), longs(wide)],
                ["doc_id", "n", "sig", "signatures", "narrow", "wide"],
            )
        pa.default_memory_pool().release_unused()

    text = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return text.mapInArrow(run, "doc_id bigint, n bigint, sig binary, signatures array<bigint>, narrow array<bigint>, wide array<bigint>")


def room(percent: int) -> tuple[str, str]:
    """Conditions that every two sets over the threshold meet, sides named _a and _b: on
    sizes and narrow bitmaps (x0_a, x1_a, ...), and on the wider ones."""
    most = f"{100 - percent} * (n_a + n_b) >= {100 + percent} * "
    narrow = " + ".join(f"bit_count(x{i}_a ^ x{i}_b)" for i in range(NARROW))
    wide = "aggregate(zip_with(wide_a, wide_b, (p, q) -> bit_count(p ^ q)), 0, (t, v) -> t + v)"
    return f"100 * least(n_a, n_b) >= {percent} * greatest(n_a, n_b) and {most} ({narrow})", f"(size(wide_a) <> size(wide_b) or {most} {wide})"


def side(info: DataFrame, name: str, *more: str) -> DataFrame:
    return info.selectExpr(f"rep as {name}", f"n as n_{name}", f"wide as wide_{name}", *(f"narrow[{i}] as x{i}_{name}" for i in range(NARROW)), *(f"{c} as {c}_{name}" for c in more))


def whole_sets(ids: DataFrame, docs: DataFrame, width: int) -> DataFrame:
    """Table (doc_id, tokens) of the documents in ids(doc_id), nearly alone: a bit filter
    of fixed size tells which texts to read."""
    word = F.pmod(F.xxhash64("doc_id"), F.lit(FILTER_BITS))
    bits = ids.groupBy((word / 64).cast("int").alias("w")).agg(F.bit_or(F.expr("shiftleft(1L, cast(pmod(xxhash64(doc_id), 64) as int))")).alias("m")).collect()
    mask = np.zeros(FILTER_BITS // 64, np.int64)
    for r in bits:
        mask[r.w] = r.m
    sent = docs.sparkSession.sparkContext.broadcast(mask)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spot = batch.column(2).to_numpy()
            hit = np.flatnonzero((sent.value[spot // 64] >> (spot % 64)) & 1)
            if len(hit):
                some = batch.take(pa.array(hit))
                tokens = pa.array([shingles(t.as_py(), width).tobytes() for t in some.column(1)], pa.binary())
                yield pa.RecordBatch.from_arrays([some.column(0), tokens], ["doc_id", "tokens"])

    named = docs.where("doc_id is not null").select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return stage(named.withColumn("spot", word).mapInArrow(run, "doc_id bigint, tokens binary"), "sets")


def verify(pairs: DataFrame, docs: DataFrame, width: int, percent: int) -> DataFrame:
    """Of pairs(a, b), those with 100 * intersection >= percent * union."""
    sets = whole_sets(pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct(), docs, width)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for s, t in zip(batch.column(2), batch.column(3), strict=True):
                x, y = np.frombuffer(s.as_buffer(), np.uint64), np.frombuffer(t.as_buffer(), np.uint64)
                common = int((x[np.minimum(np.searchsorted(x, y), len(x) - 1)] == y).sum())
                keep.append(100 * common >= percent * (len(x) + len(y) - common))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    first = sets.select(F.col("doc_id").alias("a"), F.col("tokens").alias("x"))
    second = sets.select(F.col("doc_id").alias("b"), F.col("tokens").alias("y"))
    out = stage(pairs.join(first, "a").join(second, "b").select("a", "b", "x", "y").mapInArrow(run, "a bigint, b bigint"), "links", PAIRS_AT_ONCE)
    unstage(sets)
    return out


def link_documents(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """Rows (doc_id, n_shingles, component_id), one per row of docs.

    Documents link when 100 * intersection >= percent * union of their shingle sets;
    component_id is the smallest id reachable by links. Null, empty and blank texts have
    no shingles and link with nothing; a row with a null id gets a null component; rows
    that repeat an id are one node (the union of their links); equal texts are one group whatever their number; an
    empty table gives an empty result; other columns are dropped. Very long texts take one
    set like any other; sets above LARGE index single tokens.
    """
    rows = stage(index_sets(docs, width, percent, *count_buckets(docs, width)), "sets-index")
    named = rows.where("doc_id is not null and n > 0")
    groups = stage(named.groupBy("sig", "n").agg(F.min("doc_id").alias("rep")), "groups")
    copies = stage(named.select("doc_id", "sig", "n").join(groups, ["sig", "n"]).where("doc_id <> rep"), "copies")
    reps = without(named, copies.select("doc_id", "sig", "n"), {c: F.col(c) for c in ("doc_id", "sig", "n")})
    # an id with several sets, the empty one too, joins their groups
    own = groups.selectExpr("rep as doc_id", "rep").unionByName(rows.where("doc_id is not null and n = 0").selectExpr("doc_id", "doc_id as rep"))
    held = copies.select("doc_id", "rep").unionByName(own)
    several = held.groupBy("doc_id").agg(F.min("rep").alias("low"), F.max("rep").alias("high")).where("low < high").select("doc_id", "low")
    same = stage(held.join(several, "doc_id").where("rep <> low").selectExpr("rep as a", "low as b").distinct(), "same-id")
    # lists are found by counting, which tasks do for themselves first; the join with them can be split
    post = reps.select(F.explode("signatures").alias("s"), F.col("doc_id").alias("rep"))
    shared = stage(post.join(post.groupBy("s").agg(F.min("rep").alias("low"), F.max("rep").alias("high")).where("low < high").select("s"), "s"), "shared")
    members = F.struct(F.count("*").alias("c"), F.min("rep").alias("low"), F.max("rep").alias("high"), *(F.bit_xor(F.xxhash64("rep", F.lit(k))).alias(f"x{k}") for k in (1, 2)))
    lists = shared.distinct().groupBy("s").agg(members.alias("m")).groupBy("m").agg(F.min("s").alias("s")).select("s", "m.c")
    listed = stage(shared.distinct().join(lists, "s"), "lists")
    weights = listed.groupBy("rep").agg(F.sum("c").alias("weight"))
    info = stage(reps.withColumnRenamed("doc_id", "rep").join(weights, "rep").select("rep", "n", "narrow", "wide", "weight", "sig").dropDuplicates(["rep", "sig"]), "info")
    quick, slow = room(percent)
    # each list's members with the one that meets the most others
    lot = F.struct((-F.col("weight")).alias("w"), F.col("rep").alias("b"))
    # (what is counted per list is written first: a join of two tables can be split where one list is long)
    pivots = stage(listed.join(info.groupBy("rep").agg(F.max("weight").alias("weight")), "rep").groupBy("s").agg(F.min(lot).alias("p")).select("s", "p.b"), "pivots")
    met = listed.join(pivots, "s").where("rep <> b").select(F.least("rep", "b").alias("a"), F.greatest("rep", "b").alias("b")).distinct()
    likely = stage(met.join(side(info, "a"), "a").join(side(info, "b"), "b").where(f"{quick} and {slow}").select("a", "b").distinct(), "pairs")
    linked = components(verify(likely, docs, width, percent).unionByName(same))
    # what is left, list by list
    placed = listed.join(linked, F.col("rep") == F.col("node"), "left").select("s", "rep", F.coalesce("root", "rep").alias("root"))
    mixed = stage(placed.groupBy("s").agg(F.min("root").alias("low"), F.max("root").alias("high"), F.count("*").alias("c")).where("low < high and c > 2"), "mixed")
    open_ = stage(placed.join(mixed.select("s"), "s").join(info, "rep").select("s", "root", "rep", "n", "narrow", "wide"), "open")
    x, y = side(open_, "a", "s", "root").withColumnRenamed("s_a", "s"), side(open_, "b", "s", "root").withColumnRenamed("s_b", "s")
    pairs = x.join(y, "s").where(f"root_a < root_b and {quick} and {slow}").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    rest = stage(pairs.join(likely, ["a", "b"], "left_anti"), "pairs")
    # with the links so far as components, which are smaller and as good
    if rest.head(1):
        links = verify(rest, docs, width, percent).unionByName(linked.select(F.col("node").alias("a"), F.col("root").alias("b")))
        linked = components(links)
    unstage(copies, same, shared, listed, info, pivots, likely, mixed, open_, rest)
    return (
        rows.select("doc_id", F.col("n").alias("n_shingles"), "sig", "n")
        .join(groups, ["sig", "n"], "left")
        .join(linked, F.coalesce("rep", "doc_id") == F.col("node"), "left")
        .select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("root", "rep", "doc_id")).alias("component_id"))
    )


def plain_scan(docs: DataFrame) -> bool:
    """Whether every row is one of a file's, at most filtered and with other columns: then its place tells it apart."""
    todo = [docs._jdf.queryExecution().analyzed()]
    while todo:
        node = todo.pop()
        if node.getClass().getSimpleName() not in ("Project", "Filter", "SubqueryAlias", "LogicalRelation"):
            return False
        children = node.children()
        todo += [children.apply(k) for k in range(children.size())]
    return True


def numbered_rows(docs: DataFrame) -> DataFrame:
    """`docs` with `__row`, a number of each row that stays the same whenever it is read. Rows of Parquet
    files are numbered by file and place, without being copied; others are written first."""
    spark = docs.sparkSession
    try:
        meta = docs.metadataColumn("_metadata") if plain_scan(docs) else None
    except AnalysisException:  # a scan of something else than files
        meta = None
    if meta is None:
        return stage(docs.withColumn("__row", F.monotonically_increasing_id()), "numbered")
    placed = docs.withColumns({"__in": meta["file_path"], "__at": meta["row_index"]})
    files = [r[0] for r in placed.select("__in").distinct().sort("__in").collect()]  # one name a file
    numbers = spark.createDataFrame([*enumerate(files)], "__number long, __in string")
    row = F.col("__number") * F.lit(1 << 40) + F.col("__at")
    return placed.join(numbers, "__in").select(*docs.columns, row.alias("__row"))


def keep_one(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """`docs` with one row of each group of near copies, the one that stands first in the table, and all
    columns. Rows are told apart by their place, so a repeated or null id neither saves a copy nor
    costs a text that has no other like it. Rows without words are no copies and all stay."""
    rows = numbered_rows(docs)
    own = rows.select(F.col("__row").alias("doc_id"), "text")
    extra = stage(link_documents(own, width, percent).where("component_id < doc_id").select(F.col("doc_id").alias("gone")), "extra")
    return without(rows, extra, {"gone": F.col("__row")}).select(*docs.columns)


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link_documents(table(spark, sf_dir, "documents"), 3, 90)
