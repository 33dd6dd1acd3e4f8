r"""Benchmark decontamination with a broadcast hash set of normalised n-grams.

Every window of benchmark words enters a hash table under its rarest-looking word, its anchor. Each
word of a document probes the table once, inside generated code; only where an anchor
stands is the window around it compared word by word. Documents are scanned once and
not shuffled: what leaves the scan is one row per document and one per hit.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import LOWER, UPPER, lower_ascii, stage, table, without

WINDOW = 10
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: The same in a text whose capitals still stand.
CASED_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: Bytes of windows that are broadcast at once; a larger table goes in several scans of the documents.
BROADCAST_BYTES = 32 << 20


def words(text: Column) -> Column:
    """Words of a text, A-Z in lower case; plain ASCII takes the quicker way."""
    text = F.coalesce(text.cast("string"), F.lit(""))
    lower = F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(lower_ascii(text))
    return F.regexp_extract_all(lower, F.lit(WORD), F.lit(0))


def windows(benchmark: DataFrame, size: int = WINDOW) -> DataFrame:
    """Distinct rows (anchor, shift, len, gram, item_id): the windows of all items, a
    shorter item being one window. The anchor is the window's word that the fewest
    windows hold, the longest of those; shift is its place."""
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), words(F.col("text")).alias("w")).where("size(w) > 0")
    grams = items.select(
        "item_id", F.explode(F.expr(f"transform(sequence(1, greatest(size(w) - {size} + 1, 1)), i -> slice(w, i, {size}))")).alias("gram")
    ).distinct()
    seen = grams.select(F.explode(F.array_distinct("gram")).alias("word")).groupBy("word").agg(F.count("*").alias("df"))
    placed = grams.select("item_id", "gram", F.posexplode("gram").alias("shift", "word")).join(seen, "word")
    best = F.row_number().over(Window.partitionBy("item_id", "gram").orderBy("df", F.desc(F.length("word")), "word", "shift"))
    return placed.withColumn("r", best).where("r = 1").select(F.col("word").alias("anchor"), "shift", F.size("gram").alias("len"), "gram", "item_id")


def find_windows(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW) -> DataFrame:
    """Rows (doc_id, text_hash, n_words, hit, items, copies), one per distinct id and
    text: hit lists the hit word positions from 0, items the sorted item ids.

    Null, empty and wordless texts have no words and no hits; items without words count for
    nothing, those without an id mark words but are not among the items; an empty benchmark hits nothing. A word that no text can hold, the
    empty one, stands before each document's words and in the table, so every document
    yields a row in the same pass. Windows beyond BROADCAST_BYTES are dealt over several
    scans by hash, each with a table of that size, so neither a text nor a window is ever shuffled.
    """
    table_ = stage(windows(benchmark, size), "windows")
    held = F.lit(96) + 24 * F.col("len") + F.aggregate("gram", F.lit(0), lambda n, w: n + F.octet_length(w)) + F.coalesce(F.octet_length("item_id"), F.lit(0))
    scans = max(1, -(-(table_.agg(F.sum(held)).first()[0] or 0) // BROADCAST_BYTES))
    mark = docs.sparkSession.sql("select '' as anchor, 0 as shift, 0 as len, cast(null as array<string>) as gram, cast(null as string) as item_id")
    text = F.col("text").cast("string")
    spelled = docs.select("doc_id", F.xxhash64(text).alias("text_hash"), F.concat(F.array(F.lit("")), words(F.col("text"))).alias("w"))
    each = spelled.select("doc_id", "text_hash", "w", F.posexplode_outer("w").alias("p", "word"))
    fits = "word = anchor and (len = 0 or (p > shift and p - shift + len <= size(w) and slice(w, greatest(p - shift + 1, 1), len) = gram))"

    def scan(k: int) -> DataFrame:
        own = table_.where(F.pmod(F.xxhash64("anchor", "shift", "gram", "item_id"), F.lit(scans)) == k)
        return each.join(F.broadcast(own if k else own.unionByName(mark)), F.expr(fits)).select(
            "doc_id", "text_hash", "item_id", (F.size("w") - 1).alias("n"), F.when(F.col("len") > 0, F.struct((F.col("p") - F.col("shift") - 1).alias("at"), "len")).alias("span")
        )

    found = reduce(DataFrame.unionByName, (scan(k) for k in range(scans)))
    grouped = found.groupBy("doc_id", "text_hash").agg(
        F.max("n").cast("bigint").alias("n_words"),
        F.count_if(F.col("span").isNull()).alias("copies"),
        F.collect_set("span").alias("spans"),
        F.array_sort(F.collect_set("item_id")).alias("items"),
    )
    hit = F.expr("array_sort(array_distinct(flatten(transform(spans, s -> sequence(s.at, s.at + s.len - 1)))))")
    return grouped.select("doc_id", "text_hash", "n_words", F.when(F.size("spans") > 0, hit).otherwise(F.array().cast("array<int>")).alias("hit"), "items", "copies")


def contamination(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW) -> DataFrame:
    """Rows (doc_id, n_words, n_hit, n_items, items_sha256, contaminated), one per row of
    docs; rows that repeat id and text get equal rows, null ids are kept. Null and empty texts
    have no words and are clean; an empty table gives an empty result, an empty benchmark no
    hits; other columns are dropped, whatever their names. Texts of any length are read whole."""
    found = find_windows(docs, benchmark, size)
    return found.select(
        "doc_id",
        "n_words",
        F.size("hit").cast("bigint").alias("n_hit"),
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.size("hit") > 0).alias("contaminated"),
        F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy"),
    ).drop("copy")


def decontaminate(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW, spans: bool = False) -> DataFrame:
    """`docs` without documents that hold a window or, with `spans`, without the hit
    words (their place keeps the signs around them). All columns are kept, null texts and
    null ids too; rows that repeat id and text share their fate; an empty table or benchmark
    changes nothing."""
    found = find_windows(docs, benchmark, size).where("size(hit) > 0")
    if not spans:
        hits = stage(found.select("doc_id", "text_hash"), "hits")
        return without(docs, hits, {"doc_id": F.col("doc_id"), "text_hash": F.xxhash64(F.col("text").cast("string"))})
    found = found.select(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash"), "hit")
    same = F.col("doc_id").eqNullSafe(F.col("__id")) & (F.xxhash64(F.col("text").cast("string")) == F.col("__hash"))
    joined = docs.join(found.withColumnRenamed("hit", "__hit"), same, "left")
    own = F.regexp_extract_all("text", F.lit(CASED_WORD), F.lit(0))
    kept = F.zip_with(
        F.transform(own, lambda w, i: F.when(F.array_contains("__hit", i), F.lit("")).otherwise(w)), F.split("text", CASED_WORD, -1), lambda w, gap: F.concat(gap, F.coalesce(w, F.lit("")))
    )
    text = F.when(F.col("__hit").isNotNull(), F.array_join(kept, "")).otherwise(F.col("text"))
    return joined.select(*(text.alias("text") if c == "text" else F.col(c) for c in docs.columns))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


OP8_SQL = rf"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{WORD}') AS w FROM documents
), b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{WORD}') AS w FROM benchmark
), g AS (
  SELECT DISTINCT item_id, list_slice(w, i, i + {WINDOW - 1}) AS gram
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - {WINDOW - 1}, 1) + 1)) AS i FROM b WHERE len(w) > 0)
), k AS (SELECT DISTINCT len(gram) AS k FROM g),
dw AS (
  SELECT doc_id, i, k, list_slice(w, i, i + k - 1) AS gram
  FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM d, k WHERE len(w) >= k)
), h AS (SELECT doc_id, i, k, item_id FROM dw JOIN g USING (gram)),
n AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM h) GROUP BY doc_id),
t AS (
  SELECT doc_id, count(*) AS n_items, sha256(string_agg(item, ',' ORDER BY item)) AS items_sha256
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM h) GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, coalesce(items_sha256, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN t USING (doc_id)
"""
