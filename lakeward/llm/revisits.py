"""Not-modified revisits resolved to the response they stand for.

A web archive stores a short revisit record where a server said that a page had not
changed. Each is joined, by canonical URL, to the latest earlier full response; the
validators of both are checked and the headers a not-modified answer may update are
merged into the stored ones.

The as-of join is a sorted scan: records are range-partitioned by URL and time, so one
URL's captures spread over as many partitions as they fill; the last response of each
partition is carried to the next. Records are shuffled twice, once to be ordered and once for
the window inside a partition and URL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import stage, table

TRACKING = "utm_[a-z]+|ref|fbclid|gclid"
#: Headers that a not-modified answer replaces in the stored response.
UPDATED = ("age", "cache-control", "content-location", "date", "etag", "expires", "last-modified", "vary", "warning")


def canonical_url(url: Column) -> Column:
    """Without scheme, `www.`, default port, fragment, tracking parameters and closing
    slash; the host in lower case. Null stays null."""
    u = F.regexp_replace(F.trim(url), "#.*$", "")
    u = F.regexp_replace(u, "^(?i)https?://", "")
    u = F.regexp_replace(u, "^(?i)www[.]", "")
    host = F.regexp_extract(u, "^[^/?]*", 0)
    rest = F.substring(u, F.length(host) + 1, F.length(u))
    host = F.regexp_replace(F.lower(host), ":(80|443)$", "")
    rest = F.regexp_replace(rest, f"([?&])(?:{TRACKING})=[^&]*", "$1")
    rest = F.regexp_replace(F.regexp_replace(rest, "&&+", "&"), "[?]&+", "?")
    rest = F.regexp_replace(F.regexp_replace(rest, "[?&]+$", ""), "/+$", "")
    return F.concat(host, rest)


def weak(tag: Column) -> Column:
    """Entity tags are compared weakly."""
    return F.regexp_replace(tag, "^W/", "")


def resolve(records: DataFrame) -> DataFrame:
    """Adds to records (record_id, url, captured, kind, etag, last_modified, headers
    map<string,string>, digest) the columns canonical_url, outcome, source_id,
    source_digest and merged_headers.

    outcome is `full` for a response, else `resolved`, `unvalidated` (no validator that
    both have), `mismatch` (the entity tags differ, or without those the dates) or `unmatched` (no earlier
    response, no URL or no time). Only the latest earlier response is asked; of captures at
    one time the smaller id is earlier. Any kind but `response` is a revisit; repeated rows
    stay; null headers count as none; an empty table gives an empty result. Other columns are
    kept unless they bear one of the new names, which replace them.
    """
    spark = records.sparkSession
    new = ("canonical_url", "outcome", "source_id", "source_digest", "merged_headers")
    full = F.coalesce(F.col("kind") == "response", F.lit(False))
    response = F.struct("captured", "record_id", "etag", "last_modified", "headers", "digest")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = ["canonical_url", "captured", "record_id"]
    keyed = records.drop(*new).withColumn("canonical_url", canonical_url(F.col("url")))
    asked = keyed.where("canonical_url is not null and captured is not null")
    ordered = stage(
        asked.repartitionByRange(parts, *order).sortWithinPartitions(*order).withColumn("__m", F.monotonically_increasing_id()).withColumn("__part", F.shiftright("__m", 33)),
        "captures",
    )
    inside = Window.partitionBy("canonical_url", "__part").orderBy("__m").rowsBetween(Window.unboundedPreceding, -1)
    held = F.when(full, response)
    near = ordered.withColumn("__near", F.last(held, ignorenulls=True).over(inside))
    ends = ordered.where(full).groupBy("canonical_url", "__part").agg(F.max_by(response, "__m").alias("end"))
    spans = ordered.groupBy("canonical_url", "__part").agg(F.count("*").alias("n")).join(ends, ["canonical_url", "__part"], "left")
    earlier = Window.partitionBy("canonical_url").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    carried = spans.withColumn("__far", F.last("end", ignorenulls=True).over(earlier)).where("__far is not null").select("canonical_url", "__part", "__far")
    found = near.join(carried, ["canonical_url", "__part"], "left").withColumn("__s", F.coalesce("__near", "__far")).drop("__near", "__far", "__part", "__m")
    rest = keyed.where("canonical_url is null or captured is null")
    every = found.unionByName(rest, allowMissingColumns=True)
    tags, dates = (weak(F.col("etag")), weak(F.col("__s.etag"))), (F.col("last_modified"), F.col("__s.last_modified"))
    both = lambda p: p[0].isNotNull() & p[1].isNotNull()
    outcome = (
        F.when(full, "full")
        .when(F.col("__s").isNull(), "unmatched")
        .when(both(tags), F.when(tags[0] == tags[1], "resolved").otherwise("mismatch"))
        .when(both(dates), F.when(dates[0] == dates[1], "resolved").otherwise("mismatch"))
        .otherwise("unvalidated")
    )
    none = F.expr("map('', '')").cast("map<string,string>")
    own, stored = F.coalesce("headers", F.map_filter(none, lambda k, v: k != "")), F.coalesce("__s.headers", F.map_filter(none, lambda k, v: k != ""))
    fresh = F.map_filter(own, lambda k, v: F.lower(k).isin(*UPDATED))
    kept = F.map_filter(stored, lambda k, v: ~F.array_contains(F.transform(F.map_keys(fresh), F.lower), F.lower(k)))
    good = F.col("outcome").isin("resolved", "unvalidated")
    return (
        every.withColumn("outcome", outcome)
        .withColumn("source_id", F.when(good, F.col("__s.record_id")))
        .withColumn("source_digest", F.when(good, F.col("__s.digest")).when(full, F.col("digest")))
        .withColumn("merged_headers", F.when(good, F.map_concat(kept, fresh)).when(full, F.col("headers")))
        .drop("__s")
    )


def captures(pages: DataFrame) -> DataFrame:
    """Three capture records a page, as a crawler that asks again would leave them: times,
    kinds and validators follow from page_id, digests and lengths from the page."""
    p = pages.select("page_id", "url", F.md5(F.coalesce("html", F.lit(""))).alias("digest"), F.octet_length(F.coalesce("html", F.lit(""))).alias("size"))
    r = p.withColumn("k", F.explode(F.array(F.lit(0), F.lit(1), F.lit(2))))
    return r.selectExpr(
        "page_id * 3 + k as record_id",
        "url",
        "(page_id * 7919 + k * 104729) % 1000003 as captured",
        "case when (k = 0 and page_id % 5 <> 4) or (k = 2 and page_id % 3 = 0) then 'response' else 'revisit' end as kind",
        "case when page_id % 11 = 0 then null when k = 1 and page_id % 7 = 3 then 'stale' when k = 1 then concat('W/', digest) else digest end as etag",
        "case when page_id % 13 = 0 then null else cast(page_id % 28 + k div 2 as string) end as last_modified",
        "size",
        "digest",
        "page_id",
        "k",
    ).selectExpr(
        "*",
        """map_filter(map('content-type', case when kind = 'response' then 'text/html' end,
             'content-length', case when kind = 'response' then cast(size as string) else '0' end,
             'date', cast(captured as string), 'etag', etag, 'last-modified', last_modified,
             'cache-control', concat('max-age=', cast(page_id % 600 + k as string))), (a, b) -> b is not null) as headers""",
    )


def op5_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = resolve(captures(table(spark, sf_dir, "pages")))
    lines = F.transform(F.map_entries("merged_headers"), lambda e: F.concat(e["key"], F.lit(": "), e["value"]))
    return got.select(
        "record_id", "page_id", "canonical_url", "kind", "captured", "outcome", "source_id", "source_digest", F.array_join(F.array_sort(lines), "\n").alias("merged_headers")
    )


OP5_SQL = rf"""
WITH c AS (
  SELECT page_id, k, page_id * 3 + k AS record_id, (page_id * 7919 + k * 104729) % 1000003 AS captured, url,
    md5(coalesce(html, '')) AS digest, strlen(coalesce(html, '')) AS size,
    CASE WHEN (k = 0 AND page_id % 5 <> 4) OR (k = 2 AND page_id % 3 = 0) THEN 'response' ELSE 'revisit' END AS kind
  FROM pages, (SELECT unnest([0, 1, 2]) AS k)
), e AS (
  SELECT *, CASE WHEN page_id % 11 = 0 THEN NULL WHEN k = 1 AND page_id % 7 = 3 THEN 'stale' WHEN k = 1 THEN 'W/' || digest ELSE digest END AS etag,
    CASE WHEN page_id % 13 = 0 THEN NULL ELSE CAST(page_id % 28 + k // 2 AS VARCHAR) END AS last_modified,
    regexp_replace(regexp_replace(regexp_replace(trim(url), '#.*$', ''), '^(?i)https?://', ''), '^(?i)www[.]', '') AS u
  FROM c
), f AS (
  SELECT *, regexp_replace(lower(regexp_extract(u, '^[^/?]*')), ':(80|443)$', '') ||
    regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(substr(u, length(regexp_extract(u, '^[^/?]*')) + 1),
      '([?&])(?:{TRACKING})=[^&]*', '\1', 'g'), '&&+', '&', 'g'), '[?]&+', '?', 'g'), '[?&]+$', ''), '/+$', '') AS canonical_url,
    captured * 10000000000 + record_id AS ord, 'max-age=' || CAST(page_id % 600 + k AS VARCHAR) AS cache
  FROM e
), j AS (
  SELECT v.*, r.record_id AS rid, r.digest AS rdigest, r.size AS rsize, r.etag AS retag, r.last_modified AS rlm,
    regexp_replace(v.etag, '^W/', '') AS a, regexp_replace(r.etag, '^W/', '') AS b
  FROM f v ASOF LEFT JOIN (SELECT * FROM f WHERE kind = 'response') r ON v.canonical_url = r.canonical_url AND v.ord > r.ord
), o AS (
  SELECT *, CASE WHEN kind = 'response' THEN 'full' WHEN rid IS NULL THEN 'unmatched'
    WHEN a IS NOT NULL AND b IS NOT NULL THEN CASE WHEN a = b THEN 'resolved' ELSE 'mismatch' END
    WHEN last_modified IS NOT NULL AND rlm IS NOT NULL THEN CASE WHEN last_modified = rlm THEN 'resolved' ELSE 'mismatch' END
    ELSE 'unvalidated' END AS outcome
  FROM j
)
SELECT record_id, page_id, canonical_url, kind, captured, outcome,
  CASE WHEN outcome IN ('resolved', 'unvalidated') THEN rid END AS source_id,
  CASE WHEN outcome IN ('resolved', 'unvalidated') THEN rdigest WHEN outcome = 'full' THEN digest END AS source_digest,
  CASE WHEN outcome IN ('resolved', 'unvalidated', 'full') THEN
    concat_ws(chr(10), 'cache-control: ' || cache, 'content-length: ' || CAST(CASE WHEN outcome = 'full' THEN size ELSE rsize END AS VARCHAR), 'content-type: text/html',
      'date: ' || CAST(captured AS VARCHAR), 'etag: ' || CASE WHEN outcome = 'full' THEN etag ELSE coalesce(etag, retag) END,
      'last-modified: ' || CASE WHEN outcome = 'full' THEN last_modified ELSE coalesce(last_modified, rlm) END) END AS merged_headers
FROM o
"""
