"""Helpers that the operators of this package share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows that go to a Python worker at once while a table is written; texts are long.
BATCH_ROWS = 256

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, as the cluster names it in spark.checkpoint.dir.
    Only a session in one process may do without: it gets a temporary folder."""
    where = spark.conf.get("spark.checkpoint.dir", None)
    if where is None:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise ValueError("spark.checkpoint.dir has to name a folder that all executors share")
        where = f"file://{tempfile.mkdtemp(prefix='lakeward-')}"
        spark.conf.set("spark.checkpoint.dir", where)
    return where.rstrip("/")


def write(df: DataFrame, path: str, batch_rows: int = BATCH_ROWS) -> None:
    """Write `df` as Parquet. Python workers get at most `batch_rows` rows at once, which bounds
    their memory and changes no result."""
    spark, rows = df.sparkSession, "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(rows)
    spark.conf.set(rows, str(min(int(before), batch_rows)))
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(rows, before)


def stage(df: DataFrame, label: str, batch_rows: int = BATCH_ROWS) -> DataFrame:
    """Write `df` to the shared folder and read it back: later reads survive
    lost executors, and the lineage before it is cut."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    write(df, path, batch_rows)
    out = spark.read.schema(df.schema).parquet(path)
    out.staged_at = path
    return out


def unstage(*tables: DataFrame) -> None:
    """Delete tables that `stage` wrote, once nothing reads them any more."""
    for df in tables:
        jvm, spark = df.sparkSession._jvm, df.sparkSession
        path = jvm.org.apache.hadoop.fs.Path(df.staged_at)
        path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def lower_ascii(c: Column) -> Column:
    """A-Z only, whatever the locale."""
    return F.translate(c, UPPER, LOWER)


#: A node with more than this share of a graph's edge ends, or so many, is joined apart from the others.
HUB_SHARE, HUB_EDGES = 1000, 64


def _hung(edges: DataFrame, ends: int, down: bool) -> DataFrame:
    """Rows (u, v, m) for edges(u, v): m is the smallest v of u and, with `down`, not above u.
    At most HUB_SHARE nodes can be hubs; theirs are broadcast, so no task holds all
    edges of a hub."""
    low = edges.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("d"))
    if down:
        low = low.withColumn("m", F.least("u", "m"))
    hub = F.col("d") > max(HUB_EDGES, ends // HUB_SHARE)
    marked = edges.join(F.broadcast(low.where(hub).select("u", F.col("m").alias("hub_m"))), "u", "left")
    few = marked.where("hub_m is null").select("u", "v").join(low.where(~hub).select("u", "m"), "u")
    return few.unionByName(marked.where("hub_m is not null").select("u", "v", F.col("hub_m").alias("m")))


def components(edges: DataFrame, label: str = "cc") -> DataFrame:
    """Connected components of `edges(a, b)` as rows (node, root), root being the
    smallest node of the component. Nodes without an edge do not appear.

    Alternates the large-star and small-star steps on tables in the shared
    folder; no component is ever gathered in one task, as each step is a
    minimum per node and a join that adaptive execution can split.
    """
    cur = stage(
        edges.where("a <> b and a is not null and b is not null")
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .distinct(),
        label,
    )
    before, ends = None, 2 * cur.count()
    while True:
        # large star: every larger neighbour of u is hung on u's smallest neighbour
        both = cur.select("u", "v").unionByName(cur.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _hung(both, ends, True).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        # small star: u and its smaller neighbours are hung on the smallest of them
        small = (
            _hung(large, ends, False)
            .select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
            .select("e.u", "e.v")
            .where("u <> v")
            .distinct()
        )
        last, cur = cur, stage(small, label)
        unstage(last)
        now = tuple(cur.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == before:
            return cur.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
                cur.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
            )
        before, ends = now, 2 * now[0]


#: Bits of the filter that spares most rows a shuffle; it has at most 131,072 words.
FILTER_BITS = 1 << 23


def _spotted(docs: DataFrame, known: DataFrame, keys: dict[str, Column]) -> tuple[DataFrame, Column]:
    """docs with helper columns, and whether a row's key values may be among those of known(__key, ...): a bit filter of
    fixed size, made from known and broadcast, lets all others be told without a shuffle."""
    spot = lambda cols: F.pmod(F.xxhash64(*cols), F.lit(FILTER_BITS))
    own = known.withColumn("__spot", spot([F.col(f"__{n}") for n in keys]))
    bits = own.groupBy(F.shiftright("__spot", 6).cast("int").alias("__word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(__spot & 63 as int))")).alias("__mask"))
    marked = docs.withColumn("__at", spot([*keys.values()])).join(F.broadcast(bits), F.shiftright("__at", 6).cast("int") == F.col("__word"), "left")
    return marked, F.coalesce(F.expr("(shiftright(__mask, cast(__at & 63 as int)) & 1) = 1"), F.lit(False))


def within(docs: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """Rows of docs whose `key` is in known(key); null is in nothing. Only rows that may be are joined, so
    the other texts are not shuffled."""
    ids = known.select(F.col(key).cast(docs.schema[key].dataType).alias(f"__{key}")).where(f"__{key} is not null")
    marked, maybe = _spotted(docs, ids, {key: F.col(key)})
    return marked.where(maybe).select(*docs.columns).join(ids, F.col(key) == F.col(f"__{key}"), "left_semi")


def without(docs: DataFrame, bad: DataFrame, keys: dict[str, Column]) -> DataFrame:
    """Rows of docs whose key values are not in bad; `keys` maps columns of bad to
    expressions on docs. Nulls equal each other.

    Only rows that pass a bit filter are joined, so texts are hardly shuffled.
    """
    bad = bad.select(*(F.col(n).alias(f"__{n}") for n in keys)).distinct()
    marked, maybe = _spotted(docs, bad, keys)
    same = [e.eqNullSafe(F.col(f"__{n}")) for n, e in keys.items()]
    return marked.where(~maybe).select(*docs.columns).unionByName(marked.where(maybe).select(*docs.columns).join(bad, same, "left_anti"))
